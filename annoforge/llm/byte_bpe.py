"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

All pre-tokens that a worker has not seen share one queue: a bucket per merge rank holds positions in a
linked list of symbols, a three-level bitmap over ranks gives the next rank by find-first-set, and entries
whose pair has changed are skipped when their bucket is taken. Work is linear in the merges, whatever the
length of a pre-token. Distinct pre-tokens are kept in a bounded cache per worker; the ranks of all pairs of
tokens that make a token are one fixed table. Texts go through in slices of SLICE_BYTES, cut where a
pre-token ends, and missed pre-tokens in queues of QUEUE_BYTES, longer ones alone, so that a worker's memory
follows those bounds, or the longest pre-token at some 40 bytes for each of its bytes. A rank's merges that
are many go at once as array operations.

Results: a null or empty text has no ids and decodes to no bytes. Row order, repeated rows, null ids and
columns besides id and text do not matter: each input row gives one output row, other columns are left out.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.llm import pieces
from annoforge.llm.shared import bounded_batches, named, tidy

#: Pre-tokens that one worker remembers; beyond, the oldest generation goes.
CACHE_PIECES = 300_000
#: Text bytes that are split at a time, and bytes of missed pre-tokens that share a queue.
SLICE_BYTES, QUEUE_BYTES = 512 << 10, 1 << 20
#: Merges of one rank that go as arrays rather than one by one.
MANY = 32


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Ranks from lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


def ints(values: np.ndarray) -> array:
    """An array of C ints: four bytes a value, where a list of numbers takes some forty."""
    return array("i", np.ascontiguousarray(values, np.int32).tobytes())


class RankQueue:
    """Buckets of positions by rank under a bitmap of three levels of 64-bit words."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, array] = {}
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.fill(rank, array("i", (position,)))
        else:
            bucket.append(position)

    def fill(self, rank: int, positions: array) -> None:
        held = self.buckets.get(rank)
        if held is not None:
            held.extend(positions)
            return
        self.buckets[rank] = positions
        block = rank >> 6
        self.low[block] |= 1 << (rank & 63)
        self.mid[block >> 6] |= 1 << (block & 63)
        self.top |= 1 << (block >> 6)

    def fill_all(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        """Each position into the bucket of its rank."""
        own = ranks[positions]
        order = np.argsort(own, kind="stable")
        positions, own = positions[order], own[order]
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
        held = ints(positions)
        for rank, lo, hi in zip(own[cuts[:-1]].tolist() if len(own) else (), cuts, cuts[1:]):
            self.fill(rank, held[lo:hi])

    def pop(self) -> tuple[int, array]:
        """The lowest rank and its positions, leftmost first."""
        high = (self.top & -self.top).bit_length() - 1
        word = self.mid[high]
        block = high << 6 | ((word & -word).bit_length() - 1)
        word = self.low[block]
        rank = block << 6 | ((word & -word).bit_length() - 1)
        word &= word - 1
        self.low[block] = word
        if not word:
            self.mid[high] &= self.mid[high] - 1
            if not self.mid[high]:
                self.top &= self.top - 1
        positions = self.buckets.pop(rank)
        if len(positions) > 1:
            positions = array("i", sorted(positions)) if len(positions) < 256 else ints(np.sort(np.frombuffer(positions, np.int32)))
        return rank, positions


class ByteBpe:
    """Encoder for one rank file; token ids are the ranks."""

    def __init__(self, raw: bytes, cache_pieces: int = CACHE_PIECES):
        self.ranks = read_ranks(raw)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte_ids < 0).any():
            raise ValueError("the rank file lacks a single byte")
        two = np.full(65536, -1, np.int32)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                two[token[0] << 8 | token[1]] = rank
        self.two = two
        self.pairs, self.early = self.joins()
        self.pair_keys = np.sort(np.fromiter(self.pairs, np.int64, len(self.pairs)))
        self.pair_ranks = np.array([self.pairs[k] for k in self.pair_keys.tolist()], np.int32)
        self.cache_pieces = cache_pieces
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.token_array = pa.array(self.tokens, pa.large_binary())

    def joins(self) -> tuple[dict[int, int], np.ndarray]:
        """Rank of every pair of tokens (first << 20 | second) that makes a token, fixed by the vocabulary; and
        which tokens have a pair of lower rank than their own, so that a merge may have to give way to one it made."""
        get, out = self.ranks.get, {}
        early = np.zeros(len(self.tokens), bool)
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                left = get(token[:k])
                if left is not None:
                    right = get(token[k:])
                    if right is not None:
                        out[left << 20 | right] = rank
                        if rank < left:
                            early[left] = True
                        if rank < right:
                            early[right] = True
        return out, early

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 where they make none."""
        keys = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.int32(-1))

    def merge(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as the bytes of an int32 array, each encoded by itself through one shared queue."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(data)
        ends = np.cumsum([len(t) for t in texts])
        links = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        links[0][ends - 1] = -1
        links[1][np.concatenate([[0], ends[:-1]])] = -1
        made = np.full(n, -1, np.int32)
        made[:-1] = self.two[data[:-1].astype(np.int32) << 8 | data[1:]]
        made[ends - 1] = -1
        queue = RankQueue(len(self.tokens))
        queue.fill_all(np.flatnonzero(made >= 0).astype(np.int32), made)
        # each list twice: as an array for single values and as numpy's view of the same memory
        token, after, before, pair = ints(self.byte_ids[data]), ints(links[0]), ints(links[1]), ints(made)
        del links, made
        whole = [np.frombuffer(x, np.int32) for x in (token, after, before, pair)]
        alive, seen, find = bytearray(b"\x01") * n, np.zeros(n, bool), self.pairs.get
        while queue.top:
            rank, positions = queue.pop()
            if len(positions) >= MANY and not self.early[rank]:
                self.merge_all(rank, np.frombuffer(positions, np.int32), whole, np.frombuffer(alive, np.uint8), seen, queue)
                continue
            for k, p in enumerate(positions):
                if pair[p] != rank:
                    continue  # stale: the pair has changed since
                q = after[p]
                token[p] = rank
                pair[q], alive[q] = -1, 0
                nxt = after[p] = after[q]
                lowest = rank
                if nxt >= 0:
                    before[nxt] = p
                    found = pair[p] = find(rank << 20 | token[nxt], -1)
                    if found >= 0:
                        queue.push(found, p)
                        if found < lowest:
                            lowest = found
                else:
                    pair[p] = -1
                left = before[p]
                if left >= 0:
                    found = pair[left] = find(token[left] << 20 | rank, -1)
                    if found >= 0:
                        queue.push(found, left)
                        if found < lowest:
                            lowest = found
                if lowest < rank:  # a merge of lower rank goes first
                    if rest := positions[k + 1 :]:
                        queue.fill(rank, rest)
                    break
        kept = np.frombuffer(alive, np.uint8).astype(bool)
        ids = whole[0][kept].tobytes()
        cuts = [0, *(4 * np.cumsum(kept)[ends - 1]).tolist()]
        return [ids[lo:hi] for lo, hi in zip(cuts, cuts[1:])]

    def merge_all(self, rank: int, p: np.ndarray, whole: list[np.ndarray], alive: np.ndarray, seen: np.ndarray, queue: RankQueue) -> None:
        """All merges of one rank at once, where none of them makes a pair of lower rank."""
        token, after, before, pair = whole
        p = p[pair[p] == rank]  # others are stale
        if not len(p):
            return
        q = after[p]
        runs = np.concatenate([[True], q[:-1] != p[1:]])
        if not runs.all():  # in a run of overlapping pairs every second one goes
            begin = np.flatnonzero(runs)
            even = (np.arange(len(p)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(p)]])))) & 1 == 0
            p, q = p[even], q[even]
        nxt = after[q]
        token[p], pair[q], alive[q], after[p] = rank, -1, 0, nxt
        some = nxt >= 0
        before[nxt[some]] = p[some]
        pair[p] = -1
        seen[p] = True
        left = before[p]
        left = left[left >= 0]
        left = left[~seen[left]]
        seen[p] = False
        changed = np.concatenate([p[some], left])
        if len(changed):
            pair[changed] = self.ranks_of(token[changed], token[after[changed]])
            queue.fill_all(changed[pair[changed] >= 0], pair)

    def queues(self, raws: list[bytes]) -> Iterator[bytes]:
        """The ids of each pre-token, merged in queues of bounded bytes."""
        part, held = [], 0
        for raw in raws:
            if part and held + len(raw) > QUEUE_BYTES:
                yield from self.merge(part)
                part, held = [], 0
            part.append(raw)
            held += len(raw)
        if part:
            yield from self.merge(part)

    def pieces(self, lists: list[list[str]]) -> list[list[bytes]]:
        """The ids of each pre-token of each list as the bytes of an int32 array."""
        new, old, ranks = self.new, self.old, self.ranks
        out, missed = [], {}
        for distinct in lists:
            own = []
            for piece in distinct:
                ids = new.get(piece)
                if ids is None:
                    ids = old.get(piece)
                    if ids is not None:
                        new[piece] = ids
                    elif piece not in missed:
                        whole = ranks.get(raw := piece.encode())
                        if whole is None:
                            missed[piece] = raw
                        else:
                            ids = new[piece] = np.int32(whole).tobytes()
                own.append(ids)
            out.append(own)
        if missed:
            missed = dict(zip(missed, self.queues(list(missed.values())), strict=True))
            for distinct, own in zip(lists, out, strict=True):
                for i, ids in enumerate(own):
                    if ids is None:
                        own[i] = missed[distinct[i]]
            new.update((piece, ids) for piece, ids in missed.items() if len(piece) <= 64)
        if len(new) > self.cache_pieces // 2:
            self.new, self.old = {}, new
        return out

    def encode(self, column: pa.Array) -> pa.ListArray:
        """Ids of each text of an Arrow column."""
        data, offsets = pieces.utf8(column)
        parts, lists = [], []
        for first, begin, bounds in pieces.slices(data, offsets, SLICE_BYTES):
            if bounds[-1]:
                part = data[begin : begin + int(bounds[-1])]
                points, at = pieces.code_points(part, bounds)
                start = np.flatnonzero(pieces.byte_level_starts(points, at)).astype(np.int32)
                begun = np.concatenate([[0], np.cumsum(pieces.widths(points), dtype=np.int32)])
                codes, distinct = pieces.distinct_pieces(part, begun[start])
                parts.append((first, np.searchsorted(start, at), codes))
                lists.append(distinct.to_pylist())
        sizes, ids = np.zeros(len(column), np.int64), []
        for (first, bounds, codes), held in zip(parts, self.pieces(lists), strict=True):
            n = np.fromiter(map(len, held), np.int64, len(held)) >> 2
            by_piece = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]), pa.array(np.frombuffer(b"".join(held), np.int32)))
            ids.append(by_piece.take(pa.array(codes)).flatten())
            sizes[first : first + len(bounds) - 1] += pieces.per_text(n[codes], bounds)
        total = np.concatenate([[0], np.cumsum(sizes)])
        return pa.LargeListArray.from_arrays(total, pa.concat_arrays(ids) if ids else pa.array([], pa.int32()))

    def decode(self, ids: pa.Array) -> pa.Array:
        """Bytes that the ids of each row stand for."""
        tokens = self.token_array.take(ids.values)
        return pc.binary_join(pa.LargeListArray.from_arrays(ids.offsets, tokens), pa.scalar(b"", pa.large_binary()))


_encoders: dict[int, ByteBpe] = {}


def encoder(raw: bytes) -> ByteBpe:
    """The worker's encoder for these ranks."""
    key = hash(raw)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = ByteBpe(raw)
    return _encoders[key]


def encode_documents(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """One row per row of docs: the id, n_tokens, ids, and with `decoded` the bytes the ids decode to."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids array<int>" + (", decoded binary" if decoded else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ranks.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = bpe.encode(batch.column(1))
            out = [batch.column(0), pa.array(np.diff(ids.offsets.to_numpy())), ids.cast(pa.list_(pa.int32()))]
            if decoded:
                out.append(bpe.decode(ids).cast(pa.binary()))
            yield pa.RecordBatch.from_arrays(out, [id_col, "n_tokens", "ids", "decoded"][: len(out)])
            del ids, out
            tidy()
        bpe.new, bpe.old = {}, {}  # the worker lives on, idle or with another operator's work
        tidy()

    return docs.select(named(id_col), named(text_col)).mapInArrow(run, schema)


def op9_byte_bpe(spark, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    """Ids and decoded bytes of every text of documents, as digests."""
    from annoforge.llm.vocabularies import vocabulary
    from annoforge.llm.shared import table

    coded = encode_documents(table(spark, sf_dir, "documents"), ranks_path or vocabulary("byte_bpe_multi_50k.tiktoken"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), ","), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
