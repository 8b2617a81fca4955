"""Language identification as multilingual mixture inference.

A document is a bag of words, each drawn from one of the learned languages. Trigrams of the words' UTF-8 bytes give
every word its likelihood under each language; expectation-maximisation estimates the document's proportions, until
the likelihood of a word changes by less than CLOSE on average. The languages in the order of their proportions make
sets of the first 1, 2, ...; each set's own proportions are estimated the same way, and the set of highest likelihood
less a penalty by its size stays. A set whose penalty takes more than the likelihood of all languages together has over
the best set so far needs no estimate.

Learning takes trigram counts from at most about `sample` labelled rows, as many per language, chosen by a hash of
the id: executors count, the driver sees one table of at most `most` languages, the most frequent labels (a dirty
column of labels does not fill the driver), by BUCKETS counts.

Results: `und` with score 0 for a null text, a text without a letter, and where no language was learned.
Ids may be null or repeat; each input row gives one output row. Ties go to the language first by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.llm import pieces
from annoforge.llm.shared import bounded_batches, held_out, named, table, tidy

BUCKETS = 1 << 15
#: Documented bound of the sample of labelled rows that the trigram counts come from.
SAMPLE = 8000
#: Documented bound of the languages learned.
MOST = 256
#: Estimates end where a word's log likelihood changes by less on average, or after so many rounds.
CLOSE, ROUNDS = 1e-4, 500


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte trigram of each piece between two boundary marks, and the pieces' offsets."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    wide = np.full(len(data) + 2 * n, 1, np.uint32)
    wide[np.arange(len(data)) + 2 * np.repeat(np.arange(n), sizes) + 1] = data
    codes = wide[:-2] | wide[1:-1] << 8 | wide[2:] << 16
    within = np.ones(len(wide), bool)
    ends = offsets[1:] + 2 * np.arange(1, n + 1)
    within[ends - 1] = within[ends - 2] = False
    codes = codes[within[:-2]]
    return ((codes * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64) % BUCKETS, offsets


def likelihoods(distinct: pa.Array, model: np.ndarray) -> np.ndarray:
    """Log likelihood of each distinct word under each language, by rows."""
    buckets, offsets = trigrams(*pieces.bytes_of(distinct))
    total = np.zeros((len(buckets) + 1, model.shape[1]), np.float64)
    np.cumsum(model[buckets], axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def estimate(like: np.ndarray, bounds: np.ndarray, shares: np.ndarray, close: float = CLOSE, most: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each text by expectation-maximisation from `shares` on, and the log likelihood of its words.

    like: likelihoods of the words, by rows; bounds: the words of each text. Texts that are done leave the rounds."""
    shares, value = shares.astype(np.float64).copy(), np.full(len(shares), -np.inf)
    at = np.flatnonzero(np.diff(bounds) > 0)
    value[np.diff(bounds) == 0] = 0.0
    own, sizes = like, np.diff(bounds)[at]
    if len(at) < len(shares):
        own = like[np.repeat(np.diff(bounds) > 0, np.diff(bounds))]
    for step in range(most + 1):
        if not len(at):
            break
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        part = own * np.repeat(shares[at].astype(np.float32), sizes, axis=0)
        seen = np.maximum(part.sum(axis=1), np.float32(1e-30))
        now = np.add.reduceat(np.log(seen, dtype=np.float64), starts)
        going = (now - value[at] >= close * sizes) & (step < most)
        value[at] = now
        if going.any():
            after = np.add.reduceat((part / seen[:, None]).astype(np.float64), starts, axis=0) / sizes[:, None]
            shares[at[going]] = after[going]
        if not going.all():
            own = own[np.repeat(going, sizes)]
            at, sizes = at[going], sizes[going]
    return shares, value


def mixtures(scores: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """Proportions of the languages in each text, by rows; scores: log likelihoods of its words."""
    n_docs, n_langs = len(bounds) - 1, scores.shape[1]
    sizes = np.diff(bounds)
    like = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60)).astype(np.float32)
    full, top = estimate(like, bounds, np.full((n_docs, n_langs), 1 / n_langs))
    order = np.argsort(-full, axis=1, kind="stable")
    rank = np.argsort(order, axis=1)
    cost = penalty * np.log(np.maximum(sizes, 1) + 1)
    best, out = np.full(n_docs, -np.inf), np.zeros((n_docs, n_langs))
    slack = 2 * CLOSE * np.maximum(sizes, 1)  # what the estimate of all languages may lie below its end
    for k in range(1, n_langs + 1):
        asked = (sizes > 0) & (top + slack - k * cost > best)
        if not asked.any():
            break
        begun = np.where(rank[asked] < k, np.maximum(full[asked], 1e-3), 0)
        begun /= begun.sum(axis=1, keepdims=True)
        within = np.concatenate([[0], np.cumsum(sizes[asked])])
        shares, value = estimate(like[np.repeat(asked, sizes)], within, begun)
        value = value - k * cost[asked]
        better = value > best[asked]
        at = np.flatnonzero(asked)[better]
        best[at], out[at] = value[better], shares[better]
    return out


def _words(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    kept, at, bounds, _ = pieces.letter_runs(*pieces.utf8(column))
    codes, distinct = pieces.distinct_pieces(kept, at, pa.large_binary())
    return codes, distinct, bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of the words of each batch."""
    for batch in batches:
        langs = batch.column(1).to_pylist()
        codes, distinct, bounds = _words(batch.column(0))
        if not len(codes):
            continue
        buckets, offsets = trigrams(*pieces.bytes_of(distinct))
        sizes = np.diff(offsets)
        for lang in sorted(set(langs)):
            rows = np.array([x == lang for x in langs])
            used = np.bincount(codes[np.repeat(rows, np.diff(bounds))], minlength=len(distinct))
            counts = np.bincount(buckets, weights=np.repeat(used, sizes), minlength=BUCKETS)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at].astype(np.int64))], ["lang", "bucket", "n"])


def learn(labelled: DataFrame, sample: int = SAMPLE, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", smooth: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages by name, and the log probability of each trigram bucket under each; of more than `most` labels, the
    most frequent, then the first by name."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(most).collect()}
    if not sizes:
        return [], np.zeros((BUCKETS, 0))
    each = max(1, sample // len(sizes))
    shares = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = rows.where(draw < F.element_at(shares, F.col(lang_col))).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = taken.mapInArrow(_count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(counts.lang))
    table_ = np.full((BUCKETS, len(langs)), smooth)
    for j, lang in enumerate(langs):
        own = counts[counts.lang == lang]
        table_[own.bucket.to_numpy(), j] += own.n.to_numpy()
    return langs, np.log(table_ / table_.sum(axis=0)) if langs else table_


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], penalty: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id, lang_pred, score (its share of the words), proportions by language."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logp = sent.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            shares = np.zeros((n, len(langs)))
            codes, distinct, bounds = _words(batch.column(1))
            if len(codes) and langs:
                shares = mixtures(likelihoods(distinct, logp)[codes], bounds, penalty)
            counted = np.diff(bounds) > 0
            for i in np.flatnonzero(counted):  # bytes beyond ASCII need not be letters
                if not shares[i].sum():
                    counted[i] = False
            lettered = _lettered(batch.column(1), counted)
            top = shares.argmax(axis=1) if langs else np.zeros(n, np.int64)
            names = [langs[t] if ok and langs else "und" for t, ok in zip(top, lettered, strict=True)]
            score = np.where(lettered, shares.max(axis=1, initial=0), 0.0).clip(0, 1)
            found = [{k: float(s) for k, s in zip(langs, row, strict=True) if s > 0} if ok else {} for row, ok in zip(shares, lettered, strict=True)]
            out = [batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array([list(f.items()) for f in found], pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, [id_col, "lang_pred", "score", "proportions"])
            tidy()

    return docs.select(named(id_col), named(text_col)).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, proportions map<string,double>")


def _lettered(column: pa.Array, counted: np.ndarray) -> np.ndarray:
    """Texts with a letter. Those with an ASCII letter need no further look."""
    data, offsets = pieces.utf8(column)
    sure = pieces.per_text(((data | 32) >= 97) & ((data | 32) <= 122), offsets) > 0
    out = sure.copy()
    for i in np.flatnonzero(counted & ~sure):
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return out


def op8_language(spark, sf_dir: str, sample: int = SAMPLE) -> DataFrame:
    """Predicted language of every text of documents, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()), sample)
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("proportions").cast("long").alias("n_langs"))
