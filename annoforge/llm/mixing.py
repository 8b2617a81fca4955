"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Weights are source shares of tokens raised to an exponent and normalised. The exponent is bisected: the
largest at which the weights' entropy reaches the target, raised again as far as needed to keep every
source within `max_epochs` passes over its documents. A source's budget of tokens then buys whole passes,
and a prefix of one more pass in the order of a keyed permutation (md5 of seed, epoch and id).

The prefix ends inside one block of that permutation (the first DIGITS hex digits): block sums find it, and
only that block's documents are summed one by one. No text is shuffled and no window holds a whole source.

Tokens are words here (runs of anything but ASCII white space). Results: a null source is a source of its
own; null and empty texts have 0 tokens and go along with their place in the permutation. Rows of one id
share a place and are taken together. Sources without a token get weight 0 and their documents one pass. Where
a source's budget leaves no token for a further pass, nothing of one is taken, no empty document either. An empty table gives an
empty result. All columns stay, whatever their names; the pass of a copy is in `mix_epoch`, with underscores
before it where docs has such a column already.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annoforge.llm.shared import cut, fresh, named, scope, small, table

DIGITS = 4
#: Production targets: share of the largest possible entropy, and passes over a source at most.
ENTROPY, MAX_EPOCHS, SEED = 0.97, 1.5, "mix"


def weights(totals: dict[str, int], alpha: float) -> dict[str, float]:
    """Normalised powers of the shares of tokens."""
    by_total = powers(Counter(totals.values()), alpha)
    return {s: by_total[n] for s, n in totals.items()}


def powers(sources: Counter[int], alpha: float) -> dict[int, float]:
    """weights() by total of tokens; sources: how many sources have each total."""
    whole = sum(n * k for n, k in sources.items())
    raised = {n: (n / whole) ** alpha if n else 0.0 for n in sorted(sources)}
    norm = sum(p * sources[n] for n, p in raised.items())
    return {n: p / norm for n, p in raised.items()}


def bisect(good, lo: float, hi: float, steps: int = 60) -> float:
    """The end of [lo, hi] at which good() holds next to where it stops holding; good(hi) is taken to hold."""
    for _ in range(steps):
        mid = (lo + hi) / 2
        if good(mid):
            hi = mid
        else:
            lo = mid
    return hi


def exponent(totals: dict[str, int], budget: int, entropy: float = ENTROPY, max_epochs: float = MAX_EPOCHS) -> float:
    """The exponent for these totals of tokens; 1 keeps the shares, 0 makes all weights equal."""
    return exponent_of(Counter(totals.values()), budget, entropy, max_epochs)


def exponent_of(sources: Counter[int], budget: int, entropy: float, max_epochs: float) -> float:
    """exponent() from how many sources have each total."""
    some = Counter({n: k for n, k in sources.items() if n})

    def spread(alpha: float) -> float:
        return -sum(some[n] * w * math.log(w) for n, w in powers(some, alpha).items() if w > 0)

    def fits(alpha: float) -> bool:
        return all(budget * w <= max_epochs * n for n, w in powers(some, alpha).items())

    target = entropy * math.log(max(sum(some.values()), 1))
    alpha = 1.0
    if spread(1.0) < target:
        alpha = -bisect(lambda a: spread(-a) >= target, -1.0, 0.0)
    if not fits(alpha):
        alpha = bisect(fits, alpha, 1.0)
    return alpha


def plan(totals: dict[str, int], budget: int | None = None, entropy: float = ENTROPY, max_epochs: float = MAX_EPOCHS) -> dict[str, tuple[int, int]]:
    """Per source its whole passes and the tokens of the pass beyond; budget: tokens in all, else as many as there are."""
    by_total = plan_of(Counter(totals.values()), budget, entropy, max_epochs)
    return {s: by_total[n] for s, n in totals.items()}


def plan_of(sources: Counter[int], budget: int | None = None, entropy: float = ENTROPY, max_epochs: float = MAX_EPOCHS) -> dict[int, tuple[int, int]]:
    """plan() by total: sources with as many tokens get as many passes."""
    whole = sum(n * k for n, k in sources.items())
    budget = whole if budget is None else budget
    if not whole:
        return dict.fromkeys(sources, (1, 0))
    shares = powers(sources, exponent_of(sources, budget, entropy, max_epochs))
    return {n: divmod(math.floor(budget * shares[n] + 0.5), n) if n else (1, 0) for n in sources}


def place(id_col: str, passes: Column, seed: str) -> Column:
    """A document's place in the permutation of a pass."""
    return F.md5(F.encode(F.concat_ws(":", F.lit(seed), passes.cast("string"), F.coalesce(named(id_col).cast("string"), F.lit("null"))), "UTF-8"))


def source_key(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), named(source_col).cast("string")), F.lit("null"))


def word_count(text_col: str) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(named(text_col), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def cuts(sizes: DataFrame, sums: DataFrame, passes: dict[int, tuple[int, int]], seed: str) -> DataFrame:
    """Per source key: whole passes, and the last place taken in the pass beyond (null: none). sums: tokens of each
    source; passes: what a source of so many tokens gets."""
    spark = sizes.sparkSession
    # where no token is left there is no pass beyond, whatever the documents' places
    by_total = spark.createDataFrame([(n, e, r or -1) for n, (e, r) in sorted(passes.items())], "n bigint, _passes bigint, _rest bigint")
    targets = cut(sums.join(small(by_total, F.lit(24)), "n").drop("n"), "mix-targets")
    key_bytes = F.lit(24) + F.octet_length("_source")
    rows = sizes.join(small(targets, key_bytes), "_source").select("_source", "_rest", "n_tokens", place("_id", F.col("_passes"), seed).alias("_place"))
    blocks = rows.groupBy("_source", "_rest", F.substring("_place", 1, DIGITS).alias("_block")).agg(F.sum("n_tokens").alias("_n"))
    run = blocks.withColumn("_to", F.sum("_n").over(Window.partitionBy("_source").orderBy("_block")))
    # blocks that fit whole, and the first that does not
    whole = run.where("_to <= _rest").groupBy("_source").agg(F.max("_block").alias("_whole"), F.max("_to").alias("_spent"))
    open_ = run.where("_to > _rest").groupBy("_source").agg(F.min("_block").alias("_block"))
    edge = targets.join(whole, "_source", "left").join(open_, "_source", "left").select("_source", "_passes", "_whole", "_block", F.coalesce("_spent", F.lit(0)).alias("_spent"))
    edge = cut(edge, "mix-edge")
    inside = rows.join(small(edge.select("_source", F.col("_block").alias("_edge"), "_spent"), key_bytes), "_source").where(F.substring("_place", 1, DIGITS) == F.col("_edge"))
    upto = F.col("_spent") + F.sum("n_tokens").over(Window.partitionBy("_source").orderBy("_place"))
    last = inside.withColumn("_upto", upto).where("_upto <= _rest").groupBy("_source").agg(F.max("_place").alias("_last"))
    ended = F.coalesce(F.col("_last"), F.concat("_whole", F.lit("~")))  # ~ sorts after every hex digit
    return cut(edge.join(last, "_source", "left").select("_source", "_passes", ended.alias("_last")), "mix-cuts")


def mix(docs: DataFrame, budget: int | None = None, entropy: float = ENTROPY, max_epochs: float = MAX_EPOCHS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs, each as often as its source's budget takes it, with all columns and `mix_epoch`."""
    source, passes, last, copies, epoch = fresh(docs.columns, "mix_source", "mix_passes", "mix_last", "mix_copies", "mix_epoch")
    with scope() as held:
        sizes = cut(docs.select(named(id_col).alias("_id"), source_key(source_col).alias("_source"), word_count(text_col).alias("n_tokens")), "mix-sizes")
        sums = cut(sizes.groupBy("_source").agg(F.sum("n_tokens").alias("n")), "mix-sums")
        # sources of one total are alike: the driver holds different totals, whose number grows with the root of the tokens
        sources = Counter({int(n): k for n, k in sums.groupBy("n").count().collect()})
        ends = held.keep(cuts(sizes, sums, plan_of(sources, budget, entropy, max_epochs), seed))
    ends = ends.select(F.col("_source").alias(source), F.col("_passes").alias(passes), F.col("_last").alias(last))
    rows = docs.withColumn(source, source_key(source_col)).join(small(ends, F.lit(64) + F.octet_length(source)), source)
    more = F.when(F.col(last).isNotNull() & (place(id_col, F.col(passes), seed) <= F.col(last)), 1).otherwise(0)
    rows = rows.withColumn(copies, F.col(passes) + more).where(F.col(copies) > 0)
    return rows.select(*map(named, docs.columns), F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)).alias(epoch))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """Every copy of a document that the mixture takes, as many tokens in all as documents has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "source", F.col("mix_epoch").alias("epoch"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))


#: The same mixture by windows over whole sources; the exponent by a recursive bisection.
OP4_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS k, octet_length(encode(coalesce(text, ''))) AS n_bytes,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n
  FROM documents),
t AS (SELECT k, sum(n) AS n FROM d GROUP BY k),
p AS (SELECT k, n, n::DOUBLE / (SELECT sum(n) FROM t) AS p, (SELECT sum(n) FROM t)::DOUBLE AS budget FROM t WHERE n > 0),
target AS (SELECT {ENTROPY} * ln(count(*)) AS h FROM p),
ent(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1,
         CASE WHEN h >= (SELECT h FROM target) THEN (lo + hi) / 2 ELSE lo END,
         CASE WHEN h >= (SELECT h FROM target) THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT step, lo, hi, (SELECT -sum(w * ln(w)) FROM (SELECT pow(p, (lo + hi) / 2) / (SELECT sum(pow(p, (lo + hi) / 2)) FROM p) AS w FROM p)) AS h
        FROM ent WHERE step < 60)),
a0 AS (SELECT CASE WHEN (SELECT -sum(p * ln(p)) FROM p) >= (SELECT h FROM target) THEN 1.0
                   ELSE (SELECT lo FROM ent WHERE step = 60) END AS a),
fit(step, lo, hi) AS (
  SELECT 0, (SELECT a FROM a0), 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN lo ELSE (lo + hi) / 2 END, CASE WHEN ok THEN (lo + hi) / 2 ELSE hi END
  FROM (SELECT step, lo, hi, (SELECT bool_and(budget * w <= {MAX_EPOCHS} * n) FROM (SELECT n, budget, pow(p, (lo + hi) / 2) / (SELECT sum(pow(p, (lo + hi) / 2)) FROM p) AS w FROM p)) AS ok
        FROM fit WHERE step < 60)),
a AS (SELECT CASE WHEN (SELECT bool_and(budget * w <= {MAX_EPOCHS} * n) FROM (SELECT n, budget, pow(p, (SELECT a FROM a0)) / (SELECT sum(pow(p, (SELECT a FROM a0))) FROM p) AS w FROM p))
                  THEN (SELECT a FROM a0) ELSE (SELECT hi FROM fit WHERE step = 60) END AS a),
b AS (SELECT k, n, floor(budget * (pow(p, (SELECT a FROM a)) / (SELECT sum(pow(p, (SELECT a FROM a))) FROM p)) + 0.5)::BIGINT AS target FROM p),
s AS (SELECT t.k, CASE WHEN t.n > 0 THEN b.target // t.n::BIGINT ELSE 1 END AS passes, CASE WHEN t.n > 0 AND b.target % t.n::BIGINT > 0 THEN b.target % t.n::BIGINT ELSE -1 END AS rest FROM t LEFT JOIN b ON t.k = b.k),
r AS (SELECT d.*, s.passes, s.rest, md5(concat('{SEED}:', s.passes, ':', coalesce(d.doc_id::VARCHAR, 'null'))) AS place FROM d JOIN s ON d.k = s.k),
c AS (SELECT *, passes + CASE WHEN sum(n) OVER (PARTITION BY k ORDER BY place) <= rest THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, source, unnest(range(copies))::BIGINT AS epoch, n_bytes::BIGINT AS n_bytes FROM c WHERE copies > 0
"""
