"""Periodic runs of words by Lyndon arrays over both orders of the alphabet, in linear time.

A run is a stretch of words with smallest period q that no neighbouring word extends. In one of the two orders of
the alphabet (the end of a text is least in both) its Lyndon root, wherever it starts a period in the run, is the
longest Lyndon word there: it ends at the next smaller suffix. So each order gives, for every position, the next
smaller suffix and the length over which both agree; where that is longer than the root, a run of three periods or
more may start, and its left end is found the same way.

No suffix array, no hash and no index is built. Words are compared only beyond the rightmost (for left ends: the
leftmost) word that any comparison has reached; what lies inside was matched to an earlier stretch before, and its
result is read there. So comparisons are linear in the words (`edges` and `left_ends` say why).

Words that cannot lie in a run of three periods (those that occur less than three times in their stretch) end
stretches before, by counting in arrays; the rest of a text goes through the two orders.

Results: null and empty texts have no words, no runs and an empty collapsed text. Each input row gives one output row,
whatever its id; other columns are left out. Ties and repeated rows do not matter: a text is looked at by itself. A
text is read in slices and held as one 32-bit code a word.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.llm import pieces
from annoforge.llm.shared import bounded_batches, named, table, tidy

#: Words of the shortest run and periods in it, bytes split at a time.
LEAST_WORDS, LEAST_PERIODS, SLICE_BYTES = 24, 3, 1 << 20


def edges(t: array) -> tuple[array, array, int]:
    """(next smaller suffix, words in common with it, comparisons) of every position; none: the end, 0.

    Suffixes that still wait for a smaller one form a chain of growing suffixes. A new suffix j meets them from the
    right; a smaller one ends there, the last becomes its previous smaller suffix. `reach` is the rightmost word
    compared so far, by the pair (reached - shift, reached).
    * The pair before in the chain and its own link tell the common part exactly if they differ.
    * Inside the reach, and right of `reached`, the pair is a copy of one `shift` words to the left: if that one was
      compared and decided within the reach, so is this one. If not, the pair agrees up to the reach: otherwise its
      copy would have met the same smaller suffix.
    * Left of `reached` it agrees up to the reach, for j is below i, and i is below the copy of j.
    So words are only compared at the reach and beyond."""
    n = len(t)
    below, common = array("i", [n]) * n, array("i", [0]) * n  # the next smaller suffix
    parent, link = array("i", [-1]) * n, array("i", [0]) * n  # the previous smaller suffix
    reached = reach = shift = compared = 0
    for j in range(1, n):
        i, last, k = j - 1, -1, j
        while i >= 0:
            m = 0
            if last >= 0:
                m = link[k]
                if m < last:  # i is below j
                    parent[j], link[j] = i, m
                    break
                if m > last:  # j is below i
                    below[i], common[i] = j, last
                    k, i = i, parent[i]
                    continue
            if j < reach:
                m = reach - j
                if reached <= i:
                    a, b = i - shift, j - shift
                    if below[a] == b:
                        c = common[a]
                        if c < m:
                            below[i], common[i] = j, c
                            last, k, i = c, i, parent[i]
                            continue
                    elif parent[b] == a:
                        c = link[b]
                        if c < m:
                            parent[j], link[j] = i, c
                            break
            at = j + m
            while at < n and t[at - j + i] == t[at]:
                at += 1
            m = at - j
            if at >= reach:
                compared += at - max(reach, j)
                reached, reach, shift = j, at, j - i
            compared += 1
            if at < n and t[i + m] < t[at]:
                parent[j], link[j] = i, m
                break
            below[i], common[i] = j, m
            last, k, i = m, i, parent[i]
    return below, common, compared


def left_ends(t: array, roots: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(position, period, words to the left that keep the period) of the leftmost roots (position, period) of runs,
    from the right.

    Each root is followed by more than two periods. If a root lies inside the part that an earlier run has matched
    to the left, its run is smaller and its copy one period of that run to the right has the same left part, as far
    as that run goes; so words are only compared beyond the leftmost one reached."""
    found: dict[int, tuple[int, int]] = {}
    low, shift = len(t), 0
    for i, p in reversed(roots):
        m = 0
        if i > low:
            was, left = found.get(i + shift, (0, 0))
            if was == p and i - left > low:
                found[i] = (p, left)
                yield i, p, left
                continue
            m = i - low
        while i - m > 0 and t[i - m - 1] == t[i - m - 1 + p]:
            m += 1
        if i - m <= low:
            low, shift = i - m, p
        found[i] = (p, m)
        yield i, p, m


def runs(t: array, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least `least` words and `periods` (3 or more) periods, in order."""
    out = set()
    for order in (t, array("i", [-x for x in t])):
        below, common, _ = edges(order)
        roots = []
        for i, (j, c) in enumerate(zip(below, common, strict=True)):
            p = j - i
            if c > p and not (i >= p and below[i - p] == i and common[i - p] >= p):
                roots.append((i, p))
        for i, p, left in left_ends(order, roots):
            length = left + p + common[i]
            if length >= max(least, periods * p):
                out.add((i - left, length, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def stretches(codes: np.ndarray, texts: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """(from, to) of stretches of words that may hold a run: every word of a run occurs `times` times in it.

    texts: the text of every word. Rounds go on while they take a twentieth of the words away."""
    alive = np.arange(len(codes))
    while len(alive):
        new = np.ones(len(alive), bool)
        new[1:] = (np.diff(alive) != 1) | (np.diff(texts[alive]) != 0)
        stretch = np.cumsum(new) - 1
        size = np.bincount(stretch)[stretch]
        key = stretch.astype(np.int64) * (int(codes.max()) + 1) + codes[alive]
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        keep = (count[inverse] >= times) & (size >= least)
        if keep.sum() > 0.95 * len(alive):
            firsts = np.flatnonzero(new)
            return [(int(alive[a]), int(alive[b - 1]) + 1) for a, b in zip(firsts, [*firsts[1:], len(alive)], strict=True) if b - a >= least]
        alive = alive[keep]
    return []


class Coder:
    """32-bit codes of words; equal words have equal codes within one batch."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def code(self, kept: np.ndarray, at: np.ndarray) -> np.ndarray:
        which, distinct = pieces.distinct_pieces(kept, at, pa.large_binary())
        known = self.known
        return np.array([known.setdefault(w, len(known)) for w in distinct.to_pylist()], np.int32)[which]


def sliced(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, bytes of words, start of each word in them, words before each text of the slice) by slices."""
    for text, begin, own in pieces.slices(data, offsets, SLICE_BYTES):
        kept, at, bounds = pieces.words(data[begin : begin + int(own[-1])], own)
        yield text, kept, at, bounds


def collapsed(data: np.ndarray, offsets: np.ndarray, gone: np.ndarray) -> pa.Array:
    """Texts of the words that are not gone, joined by one blank."""
    parts, lengths, word, had = [], np.zeros(len(offsets) - 1, np.int64), 0, np.zeros(len(offsets) - 1, bool)
    for text, kept, at, bounds in sliced(data, offsets):
        stay = ~gone[word : word + len(at)]
        word += len(at)
        sizes = np.diff(np.append(at, len(kept)))
        owner = np.repeat(np.arange(text, text + len(bounds) - 1), np.diff(bounds))[stay]
        first = np.ones(len(owner), bool)
        first[1:] = owner[1:] != owner[:-1]
        first &= ~had[owner]
        had[owner] = True
        held, begun = kept[np.repeat(stay, sizes)], np.concatenate([[0], np.cumsum(sizes[stay])])[:-1]
        parts.append(np.insert(held, begun[~first], 32))
        lengths += np.bincount(owner, sizes[stay] + ~first, len(lengths)).astype(np.int64)
    out = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    where = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(where), pa.py_buffer(np.ascontiguousarray(out))]).cast(pa.string())


def found_in(column: pa.Array, least: int, periods: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Words of each text; runs (start, length, period) with the bounds of each text's; collapsed texts."""
    data, offsets = pieces.utf8(column)
    coder, codes, n = Coder(), [], np.zeros(len(column), np.int64)
    for text, kept, at, bounds in sliced(data, offsets):
        if len(at):
            codes.append(coder.code(kept, at))
            n[text : text + len(bounds) - 1] += np.diff(bounds)
    codes = np.concatenate(codes) if codes else np.zeros(0, np.int32)
    starts = np.concatenate([[0], np.cumsum(n)])
    texts = np.repeat(np.arange(len(n), dtype=np.int32), n)
    gone, rows, per_text = np.zeros(len(codes), bool), [], np.zeros(len(n), np.int64)
    for lo, hi in stretches(codes, texts, least, periods):
        text = int(texts[lo])
        for start, length, period in runs(array("i", codes[lo:hi].tobytes()), least, periods):
            gone[lo + start + period : lo + start + length] = True
            rows.append((lo + start - int(starts[text]), length, period))
            per_text[text] += 1
    return n, np.array(rows, np.int64).reshape(-1, 3), np.concatenate([[0], np.cumsum(per_text)]), collapsed(data, offsets, gone)


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id, n_words, runs (start, length, period in words, by start and period), and the
    text without the words that a run holds after its first period, joined by one blank."""
    if periods < 3:
        raise ValueError("runs of less than three periods are not looked for")
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, rows, bounds, texts = found_in(batch.column(1), least, periods)
                each = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), each), texts], [id_col, "n_words", "runs", "collapsed"])
                tidy()

    schema = f"`{id_col}` {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.select(named(id_col), named(text_col)).mapInArrow(run, schema)


def repeating(docs: DataFrame) -> DataFrame:
    """documents with the periodic ends that the query plants: where the checksum of the id ends in 0, each word from
    the a-th is the one a whole number of p words before it, if that is still the a-th or later."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.col("_n"), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    period = F.slice("_w", a + 1, p)
    copies = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, copies)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice("_w", F.lit(1), a), tail), " ")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_w")).withColumn("_n", F.size("_w"))
    return chosen.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of every whole text of documents, after the planted repetitions."""
    found = periodic_runs(repeating(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast(found.schema["runs"].dataType.elementType)
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    rows = found.withColumns({"_best": best, "_lines": F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))})
    length, period = F.col("_best.length"), F.col("_best.period")
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("_best.start").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"), digest(F.col("_lines")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
