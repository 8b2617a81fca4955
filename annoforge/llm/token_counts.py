"""Token counts by a map-side two-tier lookup.

Tier one is a compact hash table of frequent pre-tokens and their token counts, broadcast once: the TIER most
frequent pre-tokens of a bounded sample of the texts, counted in one task. The sample decides speed only, never
a count. Tier two is a bounded cache in every worker; what neither holds is encoded by the tokenizer's
library, once per batch and distinct pre-token. No pre-token is shuffled. Texts are split in slices of bytes,
so that a worker's memory does not follow the longest text.

Results: a null or empty text has 0 bytes and 0 tokens. Each input row gives one output row whatever its
id, so that repeated rows and null ids are kept; columns besides id and text are left out.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.llm import pieces
from annoforge.llm.shared import bounded_batches, named, table, tidy
from annoforge.llm.vocabularies import vocabulary

CACHE_PIECES = 200_000
#: Pre-tokens of tier one; rows and bytes of the sample that they come from; text bytes split at a time.
TIER, SAMPLE_ROWS, SAMPLE_BYTES, SLICE_BYTES = 1 << 15, 2000, 8 << 20, 1 << 20
#: Below this code point composed forms stay as they are and lower case goes by single characters.
PLAIN = 0x300


class Counter:
    """Counts tokens of texts for one tokenizer of the kind with word ends."""

    def __init__(self, raw: str, frequent: dict[str, int], cache_pieces: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(raw)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or r"(?!)")
        self.frequent = frequent
        self.cache_pieces = cache_pieces
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def encode(self, distinct: list[str]) -> list[int]:
        """Token counts by the library; each pre-token is a text of its own."""
        run = getattr(self.library, "encode_batch_fast", self.library.encode_batch)
        return [len(e.ids) for e in run(distinct, add_special_tokens=False)]

    def sizes(self, distinct: pa.Array) -> np.ndarray:
        """Token counts of distinct pre-tokens: tier one, the cache, the library."""
        first, new, old, missing, where, out = self.frequent, self.new, self.old, [], [], []
        for i, piece in enumerate(distinct.to_pylist()):
            n = first.get(piece)
            if n is None:
                n = new.get(piece)
                if n is None:
                    n = old.get(piece)
                    if n is None:
                        missing.append(piece)
                        where.append(i)
                        n = 0
                    else:
                        new[piece] = n
            out.append(n)
        out = np.array(out, np.int64)
        for lo in range(0, len(missing), 8192):
            got = self.encode(missing[lo : lo + 8192])
            out[where[lo : lo + 8192]] = got
            new.update((p, n) for p, n in zip(missing[lo : lo + 8192], got, strict=True) if len(p) <= 64)
        if len(new) > self.cache_pieces // 2:
            self.new, self.old = {}, new
        return out

    def normalised(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points after normalisation, their offsets, and the special strings in each text."""
        points, bounds = pieces.code_points(data, offsets)
        specials = np.zeros(len(bounds) - 1, np.int64)
        odd = (points >= PLAIN) | (points == 0x130)
        mark = (points[:-1] == ord("<")) & (points[1:] == ord("|")) if len(points) > 1 else np.zeros(0, bool)
        if not odd.any() and not mark.any():
            return _lower()[points], bounds, specials
        marked = np.zeros(len(points) + 1, np.int64)
        marked[1:] = np.cumsum(odd)
        marked[2:] += np.cumsum(mark) if len(points) > 1 else 0
        special = marked[bounds[1:]] - marked[bounds[:-1]] > 0
        out = []
        for k, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            text = data[lo:hi].tobytes().decode()
            if special[k]:
                text, specials[k] = self.special.subn(" ", text)
                text = self.library.normalizer.normalize_str(text)
            else:
                text = text.lower()
            out.append(text)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in out])])
        return np.frombuffer("".join(out).encode("utf-32-le"), np.uint32), bounds, specials

    def split(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array, np.ndarray]]:
        """(first text, special strings by text, code of each pre-token, distinct ones, bounds of texts) by slices."""
        data, offsets = pieces.utf8(column)
        for text, begin, own in pieces.slices(data, offsets, SLICE_BYTES):
            if not own[-1]:
                continue
            points, bounds, specials = self.normalised(data[begin : begin + int(own[-1])], own)
            start, kept = pieces.word_end_starts(points, bounds)
            start &= kept
            held = points[kept]
            first = np.flatnonzero(start[kept])
            if not len(first):
                yield text, specials, np.zeros(0, np.int64), pa.array([], pa.large_string()), np.zeros(len(own), np.int64)
                continue
            begun = np.concatenate([[0], np.cumsum(pieces.widths(held))])
            lowered = np.frombuffer(held.tobytes().decode("utf-32-le").encode(), np.uint8)
            codes, distinct = pieces.distinct_pieces(lowered, begun[first])
            yield text, specials, codes, distinct, np.concatenate([[0], np.cumsum(start)])[bounds]

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and tokens of each text."""
        n_bytes = np.diff(pieces.utf8(column)[1])
        n_tokens = np.zeros(len(column), np.int64)
        for text, specials, codes, distinct, bounds in self.split(column):
            n_tokens[text : text + len(specials)] += pieces.per_text(self.sizes(distinct)[codes], bounds) + specials
        return n_bytes, n_tokens


def _lower() -> np.ndarray:
    global _lowered
    if _lowered is None:
        _lowered = np.array([ord(c) if len(c := chr(i).lower()) == 1 else i for i in range(PLAIN)], np.uint32)
    return _lowered


_lowered = None
_counters: dict[str, Counter] = {}


def frequent_pieces(docs: DataFrame, raw: str, tier: int = TIER, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> dict[str, int]:
    """Token counts of the `tier` most frequent pre-tokens of about `rows` texts, at most SAMPLE_BYTES of them.

    The texts are drawn by a hash of the id and counted in one task; the driver sees the table only."""
    n = docs.count()
    if not n:
        return {}
    draw = F.pmod(F.xxhash64(named(id_col), F.lit(5)), F.lit(1 << 30))
    taken = docs.where(named(text_col).isNotNull() & (draw < F.lit(int(min(1.0, rows / n) * (1 << 30))))).select(named(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen, left = Counter(raw, {}), {}, SAMPLE_BYTES
        for batch in batches:
            if left <= 0:
                break
            left -= batch.column(0).nbytes
            for _, _, codes, distinct, _ in counter.split(batch.column(0)):
                for piece, k in zip(distinct.to_pylist(), np.bincount(codes, minlength=len(distinct)).tolist(), strict=True):
                    seen[piece] = seen.get(piece, 0) + k
        best = sorted((p for p in seen if len(p) <= 64), key=lambda p: (-seen[p], p))[:tier]
        sizes = [n for lo in range(0, len(best), 8192) for n in counter.encode(best[lo : lo + 8192])]
        yield pa.RecordBatch.from_arrays([pa.array(best, pa.string()), pa.array(sizes, pa.int32())], ["piece", "n"])
        tidy()

    return dict(map(tuple, taken.repartition(1).mapInArrow(run, "piece string, n int").collect()))


def count_tokens(docs: DataFrame, tokenizer_path: str, frequent: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id, n_bytes, n_tokens. `frequent`: another tier one, pre-tokens and their counts."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        raw = f.read()
    sent = spark.sparkContext.broadcast((raw, frequent_pieces(docs, raw, id_col=id_col, text_col=text_col) if frequent is None else frequent))
    kind, mark = docs.schema[id_col].dataType.simpleString(), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mark not in _counters:
            _counters.clear()
            _counters[mark] = Counter(*sent.value)
        for batch in batches:
            if batch.num_rows:
                n_bytes, n_tokens = _counters[mark].count(batch.column(1))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes.astype(np.int64)), pa.array(n_tokens.astype(np.int64))], [id_col, "n_bytes", "n_tokens"])
                tidy()

    return docs.select(named(id_col), named(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")


def op1_token_counts(spark, sf_dir: str, tokenizer_path: str | None = None, limit: int = 2048) -> DataFrame:
    """Bytes and tokens of every text of documents."""
    counts = count_tokens(table(spark, sf_dir, "documents"), tokenizer_path or vocabulary("word_bpe_49k.json"))
    return counts.withColumn("over_limit", counts.n_tokens > limit)
