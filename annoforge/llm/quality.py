"""Quality rules: text statistics, a base rule, and robust multivariate outliers per language and source.

Everything is DataFrame expressions. Statistics of a document come from array expressions over its words,
without exploding it. Transformed statistic vectors are kept in fixed point (1/SCALE), so that sums of them
and of their products are exact and do not depend on the order of rows. Per group the minimum covariance
determinant is searched from three starts (medians with given deviations, medians with those of the middle
half, mean and covariance of all rows). A concentration step takes the `share` of rows of least distance from
centre and scatter and their mean and covariance as the next ones. After TRIALS steps the start of least
determinant goes on, until no group's determinant falls any more or after `steps` steps; the estimate of
least determinant stays. Quantiles of values and distances are read off counts by bins of fixed width, so
that no group's values are ever gathered. The covariance of the nearest rows is made consistent with normal
rows (`consistency`) before it is used.

Groups below `least` rows, too few for a covariance, are pooled into one; if even that is smaller, the base
rule alone decides. A coordinate's deviation, given those before it, is the estimated one or its floor
(FLOORS), whichever is larger: a group in which most documents agree exactly in one statistic does not
reject tiny deviations from it.

Results: null text counts as empty: all statistics 0, base_failed. Null lang or source are values of their
own. Ids may be null or repeat: every row is a row of its own. Ties in distance stay together. An empty table
gives an empty one. The columns of docs stay, whatever their names; a statistic or verdict whose name docs
has already gets underscores before it. Windows of five words are compared by a 64-bit hash of their words'
64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annoforge.llm.shared import cut, fresh, named, scope, table

SCALE = 4096
DIMS = 5
#: Standard deviations of the coordinates, in their units, never go below these.
FLOORS = (0.05, 0.02, 0.02, 0.08, 0.08)
#: Deviations that the first distances, from the medians, are measured in.
START = (0.5, 0.3, 0.2, 0.4, 0.24)
SHARE, TRIALS, STEPS, LEAST = 0.75, 2, 20, 50
STARTS = 3
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Fixed value: quantile of chi squared with five degrees of freedom at 0.999.
CUTOFF = 20.515006
#: Groups up to which their estimates are broadcast; beyond, they are joined by a salted shuffle.
BROADCAST_GROUPS, SALTS = 100_000, 32
_SPACE = r"[\x20\x09-\x0D]+"


def statistics(docs: DataFrame, text_col: str = "text", window: int = 5) -> DataFrame:
    """docs without the text, with STATISTICS; a name that docs has already gets underscores before it."""
    rest = [c for c in docs.columns if c != text_col]
    return unpacked(measured(docs.select(packed(rest), named(text_col).alias("text")), window), rest, STATISTICS)


def packed(columns: list[str]) -> Column:
    """These columns as one, `own`, so that no name of theirs meets another."""
    return F.struct(F.lit(0).alias("_"), *[named(c).alias(f"c{i}") for i, c in enumerate(columns)]).alias("own")


def unpacked(rows: DataFrame, columns: list[str], more: tuple[str, ...]) -> DataFrame:
    return rows.select(*[F.col(f"own.c{i}").alias(c) for i, c in enumerate(columns)], *[F.col(m).alias(n) for m, n in zip(more, fresh(columns, *more), strict=True)])


def measured(docs: DataFrame, window: int = 5) -> DataFrame:
    """Rows (text, ...) without the text, with STATISTICS."""
    rest = [c for c in docs.columns if c != "text"]
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, _SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    one = docs.select(*rest, words.alias("_w"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), lines.alias("_l"))
    two = one.select(
        *rest,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    seen = [*rest, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    grams = F.when(
        F.col("n_words") >= window,
        F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - window), lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(window)])),
    ).otherwise(F.array().cast("array<bigint>"))
    three = two.select(*seen, grams.alias("_g"))
    pairs = F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"), F.sort_array(F.transform("_g", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    four = three.select(*seen, pairs.alias("_s"))

    def again(x: Column, i: Column) -> Column:
        """The window's place if an equal one stands beside it in the sorted order, else -1."""
        same = (F.get("_s", i - 1)["h"] == x["h"]) | (F.get("_s", i + 1)["h"] == x["h"])
        return F.when(same, x["i"]).otherwise(-1)

    places = F.sort_array(F.filter(F.transform("_s", again), lambda p: p >= 0))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(window), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return four.select(*seen, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics as fixed-point longs x0..x4."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("n_words", "word_chars", "n_lines"))
    parts = [F.log(words + 1), F.log(chars / words), F.sqrt(F.col("n_symbols") / chars), F.sqrt(F.col("n_dup_lines") / lines), F.sqrt(F.col("n_repeat_words") / words)]
    return [F.round(p * SCALE).cast("long").alias(f"x{i}") for i, p in enumerate(parts)]


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], n_groups: int) -> DataFrame:
    """rows with the columns of their group: broadcast up to a size, beyond it a join with salted keys."""
    if n_groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), keys)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*[f"x{i}" for i in range(DIMS)]), F.lit(SALTS)))
    every = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(every, [*keys, "_salt"]).drop("_salt")


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Per group and name the least whole value at or below which that share of the rows lies, from counts by value."""
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys)
    run = counts.withColumn("_below", F.sum("_n").over(w.orderBy(value))).withColumn("_all", F.sum("_n").over(w))
    return run.groupBy(*keys).agg(*[F.min(F.when(F.col("_below") >= F.lit(share) * F.col("_all"), F.col(value))).alias(name) for name, share in shares.items()])


def chi2_below(x: float, dims: int) -> float:
    """The share of chi squared with an odd number of degrees of freedom that lies below x."""
    term, below = math.sqrt(2 * x / math.pi) * math.exp(-x / 2), math.erf(math.sqrt(x / 2))
    for k in range(1, dims, 2):
        below -= term
        term *= x / (k + 2)
    return below


def consistency(share: float) -> float:
    """What the covariance of the nearest share of normal rows is to be multiplied by to be that of all."""
    if share >= 1:
        return 1.0
    lo, hi = 0.0, 200.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_below(mid, DIMS) < share else (lo, mid)
    return share / chi2_below(lo, DIMS + 2)


def scatter(rows: DataFrame, keys: list[str], factor: float = 1.0) -> DataFrame:
    """Per group the mean m0.. and the Cholesky factor l00.. of factor times the covariance, floored, in units of 1/SCALE."""
    exact = {f"x{i}": F.col(f"x{i}").cast("decimal(20,0)") for i in range(DIMS)}
    sums = [F.sum(exact[f"x{i}"]).alias(f"s{i}") for i in range(DIMS)]
    products = [F.sum(exact[f"x{i}"] * F.col(f"x{j}").cast("decimal(10,0)")).alias(f"p{i}{j}") for i in range(DIMS) for j in range(i + 1)]
    g = rows.groupBy(*keys).agg(F.count("*").alias("_n"), *sums, *products)
    g = g.select(*keys, *[(F.col(f"s{i}").cast("double") / F.col("_n")).alias(f"m{i}") for i in range(DIMS)], *[(F.col(f"p{i}{j}").cast("double") / F.col("_n")).alias(f"p{i}{j}") for i in range(DIMS) for j in range(i + 1)])
    floor = [(f * SCALE) ** 2 for f in FLOORS]
    for i in range(DIMS):
        for j in range(i + 1):
            c = F.lit(factor) * (F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
            for k in range(j):
                c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            g = g.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(floor[i]))) if i == j else c / F.col(f"l{j}{j}"))
    return g.select(*keys, *[f"m{i}" for i in range(DIMS)], *[f"l{i}{j}" for i in range(DIMS) for j in range(i + 1)])


def distance(rows: DataFrame, name: str = "d2") -> DataFrame:
    """Squared Mahalanobis distance from the attached centre and factor; those columns go."""
    for i in range(DIMS):
        z = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            z = z - F.col(f"l{i}{j}") * F.col(f"z{j}")
        rows = rows.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
    rows = rows.withColumn(name, sum(F.col(f"z{i}") * F.col(f"z{i}") for i in range(DIMS)))
    return rows.drop(*[f"{c}{i}" for c in "mz" for i in range(DIMS)], *[f"l{i}{j}" for i in range(DIMS) for j in range(i + 1)])


def starts(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """(keys, start, centre, factor) of every group's starts; how many groups."""
    binned = rows.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("d"), F.floor(F.col(f"x{i}") / 64).alias("b")) for i in range(DIMS)])).alias("v")).select(*keys, "v.d", "v.b")
    middle = cut(quantiles(binned, [*keys, "d"], "b", {"low": 0.25, "mid": 0.5, "high": 0.75}), "middle")
    n = middle.select(*keys).distinct().count()
    parts = [F.max(F.when(F.col("d") == i, F.col(c))).alias(f"{c}{i}") for i in range(DIMS) for c in ("low", "mid", "high")]
    middle = middle.groupBy(*keys).agg(*parts)
    centre = [(F.col(f"mid{i}") * 64.0 + 32).alias(f"m{i}") for i in range(DIMS)]

    def diagonal(start: int, deviation) -> DataFrame:
        factor = [(deviation(i) if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(DIMS) for j in range(i + 1)]
        return middle.select(*keys, F.lit(start).alias("start"), *centre, *factor)

    given = diagonal(0, lambda i: F.lit(START[i] * SCALE))
    half = diagonal(1, lambda i: F.greatest((F.col(f"high{i}") - F.col(f"low{i}")) * (64 / 1.349), F.lit(FLOORS[i] * SCALE)))
    whole = scatter(rows, keys).withColumn("start", F.lit(2))
    return cut(given.unionByName(half).unionByName(whole), "scatter"), n


def determinant() -> Column:
    """Logarithm of the determinant, from the factor."""
    return sum(2 * F.log(F.col(f"l{i}{i}")) for i in range(DIMS))


def robust_scatter(rows: DataFrame, keys: list[str], share: float = SHARE, steps: int = STEPS) -> tuple[DataFrame, int]:
    """Per group centre and factor of the least covariance determinant found; how many groups."""
    now, n = starts(rows, keys)
    every, tried, last = [*keys, "start"], None, None
    for step in range(steps):
        if step == TRIALS:
            least = now.groupBy(*keys).agg(F.min_by("start", F.struct(determinant(), F.col("start"))).alias("start"))
            now = cut(now.join(least, every, "left_semi"), "scatter")
        some = range(STARTS) if step < TRIALS else None
        tries = rows.withColumn("start", F.explode(F.array(*map(F.lit, some)))) if some else attach(rows, now.select(*every), keys, n)
        binned = distance(attach(tries, now, every, n)).withColumn("_b", F.floor(F.log2(F.col("d2") + 1) * 64))
        near = attach(binned, quantiles(binned, every, "_b", {"_cut": share}), every, n).where("_b <= _cut")
        after = cut(scatter(near, every, consistency(share)), "scatter")
        # a step that does not lower a group's determinant is its last: the better estimate stays
        if step > TRIALS:
            old = now.select(*every, determinant().alias("_old"))
            fallen = after.join(old, every).where(determinant() < F.col("_old") - 1e-9).select(*every)
            if fallen.isEmpty():
                break
            after = cut(after.join(fallen, every, "left_semi").unionByName(now.join(fallen, every, "left_anti")), "scatter")
        now = after
    return now.drop("start"), n


def salted(rows: DataFrame, groups: DataFrame, keys: list[str], n_groups: int) -> DataFrame:
    """A left join of groups' columns: broadcast up to a size, beyond it with salted keys."""
    if n_groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), keys, "left")
    salt = F.pmod(F.xxhash64(*[f"x{i}" for i in range(DIMS)]), F.lit(SALTS))
    every = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("_salt", salt).join(every, [*keys, "_salt"], "left").drop("_salt")


def quality(docs: DataFrame, by: tuple[str, ...] = ("lang", "source"), text_col: str = "text", share: float = SHARE, steps: int = STEPS, least: int = LEAST, cutoff: float = CUTOFF) -> DataFrame:
    """One row per row of docs: its columns without the text, the statistics, base_failed, distance, kept."""
    rest, keys = [c for c in docs.columns if c != text_col], [f"k{i}" for i in range(len(by))]
    group = [F.coalesce(F.concat(F.lit("="), named(c).cast("string")), F.lit("null")).alias(k) for k, c in zip(keys, by, strict=True)]
    with scope() as held:
        rows = held.keep(cut(measured(docs.select(packed(rest), *group, named(text_col).alias("text"))).select("*", base_failed().alias("base_failed"), *vector()), "statistics"))
        sizes = cut(rows.where(~F.col("base_failed")).groupBy(*keys).agg(F.count("*").alias("size")), "groups")
        pooled, n_sizes = [f"g{i}" for i in range(len(by))], sizes.count()
        big = held.keep(cut(sizes.where(F.col("size") >= least).select(*keys, F.lit(True).alias("big")), "groups"))
        marked = salted(rows, big, keys, n_sizes)
        marked = marked.withColumns({p: F.when(F.col("big"), F.col(k)).otherwise("*") for p, k in zip(pooled, keys, strict=True)}).drop("big", *keys)
        used = cut(marked.where(~F.col("base_failed")).select(*pooled, *[f"x{i}" for i in range(DIMS)]), "vectors")
        fitted, n = robust_scatter(used, pooled, share, steps)
        enough = used.groupBy(*pooled).agg(F.count("*").alias("size")).where(F.col("size") >= least).select(*pooled)
        fitted = held.keep(cut(fitted.join(enough, pooled), "scatter"))
    out = distance(salted(marked, fitted, pooled, n), "distance")
    out = out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True)))
    return unpacked(out, rest, (*STATISTICS, "base_failed", "distance", "kept"))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Quality verdict on every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("distance", 6).alias("distance"))
