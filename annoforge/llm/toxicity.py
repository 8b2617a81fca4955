"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Tokens are runs of letters; features are the token, its first 3, 4 and 5 bytes and its last 3, hashed.
Labels are given for documents only, so learning first labels tokens: those of a toxic document whose
token or prefix is much more frequent in toxic documents than in others. The field is then fitted to these
labelled tokens by its likelihood, with marginals from forward-backward.

With two states, forward and backward messages are single odds, and each step maps odds to odds by a
contraction. The passes are therefore computed for all positions of a batch at once, repeated until no odds
change: the result is that of the sequential passes, without a loop over positions.

A document's score comes from its marginals (expected toxic tokens, the largest marginal, its length) by a
logistic model fitted on the same rows. Learning uses a bounded sample: at most `sample` labelled rows (half
toxic, half not, as far as there are) chosen by a hash of the id, and of a text beyond `window` characters one
window of that many, at a place drawn by the text's hash (None: whole texts). Scores read whole texts.

Results: null and empty texts have no token and get the score of no toxic token, 0 spans. Without any
toxic or any clean labelled row every score is the toxic share (0 without labels). Ids may be of any type,
null or repeat: one output row per input row. Where a labelled id has several texts, the one of least hash
is learned from; where it has several labels, it is toxic if one says so. Neighbouring toxic tokens of a text
are one span. Other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.llm import pieces
from annoforge.llm.shared import bounded_batches, held_out, named, table, tidy

BUCKETS = 1 << 18
#: Documented bounds of the labelled rows that the model is fitted to.
SAMPLE, WINDOW = 3000, 100_000
KINDS = 5


def features(distinct: pa.Array) -> np.ndarray:
    """KINDS feature buckets of each distinct token, by rows."""
    data, offsets = pieces.bytes_of(distinct)
    sizes = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max(initial=1)), 0x9E3779B97F4A7C15, np.uint64))
        whole = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[place], dtype=np.uint64)])
        whole = whole[offsets[1:]] - whole[offsets[:-1]]
        padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
        keys = [whole]
        code = np.zeros(len(sizes), np.uint64)
        for i in range(5):
            code = code << np.uint64(8) | np.where(sizes > i, padded[offsets[:-1] + i], 0).astype(np.uint64)
            if i >= 2:
                keys.append(code.copy())
        tail = np.zeros(len(sizes), np.uint64)
        for i in range(3):
            tail = tail << np.uint64(8) | np.where(sizes > i, padded[np.maximum(offsets[1:] - 1 - i, 0)], 0).astype(np.uint64)
        keys.append(tail)
        out = np.empty((len(sizes), KINDS), np.int64)
        for k, key in enumerate(keys):
            mixed = (key + np.uint64(k + 1)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            out[:, k] = (mixed >> np.uint64(46)).astype(np.int64)
    return out


def odds_passes(emit: np.ndarray, first: np.ndarray, last: np.ndarray, trans: np.ndarray, begin: float) -> tuple[np.ndarray, np.ndarray]:
    """Forward odds u and backward odds v of state 1 against 0. emit: odds of the observations."""
    t00, t01, t10, t11 = np.exp(trans).ravel()
    opening = emit * np.exp(begin)
    u = np.where(first, opening, emit * (t01 + t11) / (t00 + t10))
    todo = np.flatnonzero(~first)
    while len(todo):
        before = u[todo - 1]
        now = emit[todo] * (t01 + t11 * before) / (t00 + t10 * before)
        moved = np.abs(now - u[todo]) > 1e-10 * now
        u[todo] = now
        after = todo[moved] + 1
        after = after[after < len(u)]
        todo = after[~first[after]]
    v = np.ones(len(emit))
    todo = np.flatnonzero(~last)
    while len(todo):
        beyond = emit[todo + 1] * v[todo + 1]
        now = (t10 + t11 * beyond) / (t00 + t01 * beyond)
        moved = np.abs(now - v[todo]) > 1e-10 * now
        v[todo] = now
        ahead = todo[moved] - 1
        ahead = ahead[ahead >= 0]
        todo = ahead[~last[ahead]]
    return u, v


class Field:
    """Weights of the field: one per feature bucket (for state 1), four transitions, one start."""

    def __init__(self):
        self.weights = np.zeros(BUCKETS)
        self.bias = -4.0
        self.trans = np.zeros((2, 2))
        self.begin = 0.0
        self.logistic = np.zeros(4)

    def marginals(self, buckets: np.ndarray, codes: np.ndarray, bounds: np.ndarray):
        """Probability of state 1 at each token, and the odds passes; buckets: features of distinct tokens."""
        score = np.clip(self.weights[buckets].sum(axis=1) + self.bias, -30, 30)
        emit = np.exp(score)[codes]
        first = pieces.text_starts(len(codes), bounds)
        last = np.concatenate([first[1:], [True]])
        u, v = odds_passes(emit, first, last, self.trans, self.begin)
        m = u * v
        return m / (1 + m), u, v, emit, first

    def fit(self, buckets: np.ndarray, codes: np.ndarray, bounds: np.ndarray, truth: np.ndarray, rounds: int = 40, ridge: float = 1e-3) -> None:
        """Adam steps on the likelihood of the token labels, all sequences in each step."""
        first = pieces.text_starts(len(codes), bounds)
        inner = np.flatnonzero(~first)
        pairs = np.zeros((2, 2))
        np.add.at(pairs, (truth[inner - 1], truth[inner]), 1)
        n = max(1.0, truth.sum())
        used = np.unique(buckets)
        where = np.searchsorted(used, buckets)
        seen = np.bincount(codes, weights=truth, minlength=len(buckets))
        flat = np.zeros(len(used) + 6)
        flat[-6] = self.bias
        mean, square = np.zeros_like(flat), np.zeros_like(flat)
        for step in range(1, rounds + 1):
            self.weights[used], self.bias = flat[:-6], flat[-6]
            self.trans, self.begin = flat[-5:-1].reshape(2, 2), flat[-1]
            p, u, v, emit, _ = self.marginals(buckets, codes, bounds)
            miss = seen - np.bincount(codes, weights=p, minlength=len(buckets))
            grad = np.zeros_like(flat)
            grad[:-6] = np.bincount(where.ravel(), weights=np.repeat(miss, KINDS), minlength=len(used))
            grad[-6] = miss.sum()
            a, b = u[inner - 1], emit[inner] * v[inner]
            t = np.exp(self.trans)
            whole = t[0, 0] + t[0, 1] * b + t[1, 0] * a + t[1, 1] * a * b
            joint = np.array([(t[0, 0] / whole).sum(), (t[0, 1] * b / whole).sum(), (t[1, 0] * a / whole).sum(), (t[1, 1] * a * b / whole).sum()])
            grad[-5:-1] = pairs.ravel() - joint
            grad[-1] = truth[first].sum() - p[first].sum()
            grad = grad / n - ridge * flat
            mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
            flat = flat + 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        self.weights[used], self.bias = flat[:-6], flat[-6]
        self.trans, self.begin = flat[-5:-1].reshape(2, 2).copy(), float(flat[-1])

    def summaries(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """What the document score reads of the marginals, by rows."""
        sizes = np.diff(bounds)
        most = np.zeros(len(sizes))
        some = sizes > 0
        if some.any():
            most[some] = np.maximum.reduceat(p, bounds[:-1][some])
        return np.stack([np.ones(len(sizes)), np.log(1e-4 + pieces.per_text(p, bounds)), most, np.log1p(sizes) / 10], axis=1)

    def scores(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.summaries(p, bounds) @ self.logistic, -30, 30)))


def _tokens(column: pa.Array):
    kept, at, bounds, starts = pieces.letter_runs(*pieces.utf8(column))
    codes, distinct = pieces.distinct_pieces(kept, at, pa.large_binary())
    return codes, distinct, bounds, starts, np.diff(np.concatenate([at, [len(kept)]]))


def fit_field(texts: list[str | None], toxic: np.ndarray, share: float) -> Field:
    """A field from labelled documents. share: the toxic share before balancing."""
    field = Field()
    toxic = np.asarray(toxic, np.int64)
    codes, distinct, bounds, _, _ = _tokens(pa.array(texts, pa.large_string()))
    if not toxic.any() or toxic.all() or not len(codes):
        level = min(max(share, 1e-9), 1 - 1e-9)
        field.logistic[0] = np.log(level / (1 - level))
        return field
    buckets = features(distinct)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    held = np.unique(doc * len(distinct) + codes)  # (document, token) pairs, each once
    held_doc, held_code = held // len(distinct), held % len(distinct)
    del held
    odds = np.zeros((len(distinct), KINDS))
    support = np.zeros((len(distinct), KINDS))
    for k in range(KINDS - 1):
        had = np.unique(held_doc * BUCKETS + buckets[held_code, k])
        in_toxic, had = toxic[had // BUCKETS], had % BUCKETS
        a = np.bincount(had, weights=in_toxic, minlength=BUCKETS)
        b = np.bincount(had, minlength=BUCKETS) - a
        ratio = np.log((a + 0.5) / (toxic.sum() + 1)) - np.log((b + 0.5) / ((1 - toxic).sum() + 1))
        odds[:, k], support[:, k] = ratio[buckets[:, k]], a[buckets[:, k]]
    del held_doc, held_code
    marked = ((odds >= 3.0) & (support >= max(5, 0.02 * toxic.sum()))).any(axis=1)
    truth = (marked[codes] & (toxic[doc] == 1)).astype(np.int64)
    field.fit(buckets, codes, bounds, truth)
    p = field.marginals(buckets, codes, bounds)[0]
    x, w = field.summaries(p, bounds), np.zeros(4)
    for _ in range(25):  # Newton steps
        s = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (toxic - s) - 0.1 * w
        w = w + np.linalg.solve((x * (s * (1 - s))[:, None]).T @ x + 0.1 * np.eye(4), grad)
    drawn = toxic.mean()
    w[0] += np.log(max(share, 1e-9) / max(1 - share, 1e-9)) - np.log(drawn / (1 - drawn))
    field.logistic = w
    return field


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, window: int | None = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fit to documents joined with (id, toxic); rows without a label or with a null one are left out.

    A document with several labels is toxic if one of them says so."""
    bounded_batches(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & named(id_col).isNotNull()).groupBy(named(id_col).cast("string").alias("id")).agg(F.max("toxic").alias("toxic"))
    counts = {int(r[0]): r[1] for r in known.groupBy(F.col("toxic") > 0).count().collect()}
    n = sum(counts.values())
    picked = None
    for value in (0, 1):
        part = known.where((F.col("toxic") > 0) == bool(value)).orderBy(F.xxhash64("id", F.lit(3)), "id").limit(sample // 2).select("id", F.lit(value).alias("toxic"))
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(named(id_col).cast("string").alias("id"), named(text_col).alias("text")).where(F.col("text").isNotNull())
    hash_, read = F.xxhash64("text"), F.col("text")
    if window is not None:
        beyond = F.char_length("text") - window
        read = F.when(beyond > 0, F.substring(read, (F.pmod(hash_, beyond) + 1).cast("int"), F.lit(window))).otherwise(read)
    rows = texts.join(F.broadcast(picked), "id").groupBy("id", "toxic").agg(F.min(F.struct(hash_.alias("h"), read.alias("text"))).alias("t")).select("t.text", "toxic")
    share = counts.get(1, 0) / n if n else 0.0

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}  # copies of a text would make its rare words look like signs of its label
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[text] = max(toxic, seen.get(text, 0))
        texts = sorted(seen)
        field = fit_field(texts, np.array([seen[t] for t in texts], np.int64), share)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(field)], pa.binary())], ["field"])
        tidy()

    # one task fits, over at most `sample` rows, so that the driver's memory holds nothing but the field
    made = rows.repartition(1).mapInArrow(fitted, "field binary").collect()
    return pickle.loads(bytes(made[0][0])) if made else fit_field([], np.zeros(0, np.int64), share)


def tag(docs: DataFrame, field: Field, span_at: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id, score, and spans (start, end in code points, end exclusive; p the largest marginal)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(field)
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = pieces.utf8(batch.column(1))
            codes, distinct, bounds, starts, sizes = _tokens(batch.column(1))
            spans = [[] for _ in range(batch.num_rows)]
            p = np.zeros(0)
            if len(codes):
                p = field.marginals(features(distinct), codes, bounds)[0]
                hit = np.flatnonzero(p >= span_at)
                if len(hit):
                    of = np.searchsorted(bounds, hit, side="right") - 1
                    head = np.ones(len(hit), bool)  # of a run of toxic tokens
                    head[1:] = (hit[1:] != hit[:-1] + 1) | (of[1:] != of[:-1])
                    runs = np.flatnonzero(head)
                    tail = np.concatenate([runs[1:], [len(hit)]]) - 1
                    begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    base = begun[offsets[of[runs]]]
                    lo, hi = begun[starts[hit[runs]]] - base, begun[starts[hit[tail]] + sizes[hit[tail]]] - base
                    for d, a, b, q in zip(of[runs].tolist(), lo.tolist(), hi.tolist(), np.maximum.reduceat(p[hit], runs).tolist(), strict=True):
                        spans[d].append({"start": a, "end": b, "p": q})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(field.scores(p, bounds)), pa.array(spans, span)], [id_col, "score", "spans"])
            tidy()

    return docs.select(named(id_col), named(text_col)).mapInArrow(run, f"`{id_col}` {kind}, score double, spans array<struct<start:bigint,end:bigint,p:double>>")


def op3_toxicity(spark, sf_dir: str, sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """Toxicity of every text of documents, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    field = learn(docs, table(spark, sf_dir, "labels").where(~held_out()), sample)
    return tag(docs, field).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE, window: int | None = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text scores below the threshold."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(learn(docs, labels, sample, window, id_col, text_col))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, distinct, bounds, _, _ = _tokens(batch.column(at))
            p = field.marginals(features(distinct), codes, bounds)[0] if len(codes) else np.zeros(0)
            yield batch.filter(pa.array(field.scores(p, bounds) < threshold))
            tidy()

    plain = [f"c{i}" for i in range(len(docs.columns))]  # names may need quoting
    rows = docs.toDF(*plain)
    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
