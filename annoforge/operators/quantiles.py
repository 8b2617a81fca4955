"""Exact quantiles by selection: ranks are found by counting values in ever smaller ranges, no group's values are gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ranges counted at a time, and rows in a range from which its values are counted one by one.
BINS, FEW = 1024, 4096


def ranked(rows: DataFrame, group: str, value: str, wanted: DataFrame, bins: int = BINS, few: int = FEW) -> DataFrame:
    """(group, rank, value): the value of each wanted (group, rank), ranks from 0 in ascending order.

    A target starts with its group's least and greatest value. Each round counts the rows in `bins` equal parts of
    every open target's range, and goes on in the part that holds the rank, between that part's own least and greatest
    value, until it has few rows or one value. The driver holds one row a target, not one a value."""
    spark = rows.sparkSession
    clean = rows.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    ends = clean.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    asked = wanted.select(F.col(group).alias("ag"), "rank").distinct()
    targets = asked.join(ends, F.col("ag").eqNullSafe(F.col("g"))).select("g", "rank", "lo", "hi", "n", F.lit(0).cast("bigint").alias("below"))
    kind = targets.schema
    open_, done = targets.collect(), []
    while True:
        still = [t for t in open_ if t["n"] > few and t["lo"] < t["hi"]]
        done += [t for t in open_ if not (t["n"] > few and t["lo"] < t["hi"])]
        if not still:
            break
        now = F.broadcast(spark.createDataFrame(still, kind).withColumnRenamed("g", "tg"))
        inside = clean.join(now, F.col("g").eqNullSafe(F.col("tg")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        share = (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))
        part = F.least(F.floor(share * bins), F.lit(bins - 1)).alias("b")
        parts = inside.groupBy("g", "rank", "below", part).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy("g", "rank").orderBy("b"))
        held = parts.withColumn("_upto", F.col("below") + upto).where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("n")))
        open_ = held.select("g", "rank", "lo", "hi", "n", (F.col("_upto") - F.col("n")).alias("below")).collect()
    if not done:
        return spark.createDataFrame([], f"{group} {wanted.schema[group].dataType.simpleString()}, rank bigint, value double")
    last = F.broadcast(spark.createDataFrame(done, kind).withColumnRenamed("g", "tg"))
    values = clean.join(last, F.col("g").eqNullSafe(F.col("tg")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))).groupBy("g", "rank", "below", "v").agg(F.count("*").alias("n"))
    upto = F.col("below") + F.sum("n").over(Window.partitionBy("g", "rank").orderBy("v"))
    found = values.withColumn("_upto", upto).where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("n")))
    return found.select(F.col("g").alias(group), "rank", F.col("v").alias("value"))


def quantiles(rows: DataFrame, group: str, value: str, shares: dict[str, float], bins: int = BINS, few: int = FEW) -> DataFrame:
    """One row per group with values: each share's quantile by linear interpolation between the two values around it."""
    sizes = rows.where(F.col(value).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))
    at = sizes.select(group, F.explode(F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(share) * (F.col("n") - 1)).alias("at")) for name, share in shares.items()])).alias("q")).select(group, "q.*")
    at = at.withColumns({"low": F.floor("at"), "high": F.ceil("at")})
    wanted = at.select(group, F.explode(F.array("low", "high")).alias("rank")).distinct()
    found = ranked(rows, group, value, wanted, bins, few)
    a, b = (found.select(F.col(group).alias(f"_{side}_g"), F.col("rank").alias(side), F.col("value").alias(f"_{side}")) for side in ("low", "high"))
    both = at.join(a.withColumnRenamed("low", "_lr"), F.col(group).eqNullSafe(F.col("_low_g")) & (F.col("low") == F.col("_lr"))).join(b.withColumnRenamed("high", "_hr"), F.col(group).eqNullSafe(F.col("_high_g")) & (F.col("high") == F.col("_hr")))
    between = F.when(F.col("low") == F.col("high"), F.col("_low")).otherwise((F.col("high") - F.col("at")) * F.col("_low") + (F.col("at") - F.col("low")) * F.col("_high"))
    return both.groupBy(group).agg(*[F.max(F.when(F.col("name") == name, between)).alias(name) for name in shares])

