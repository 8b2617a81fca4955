"""Running values and quantiles over ranges against windows and sorted lists, with one key for all rows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annoforge.operators import events as E
from annoforge.operators import quantiles as Q
from annoforge.operators import scans as S


@pytest.fixture(scope="module", params=["many keys", "one key"])
def rows(spark, request):
    rng = random.Random(3)
    keys = [None, *range(25)] if request.param == "many keys" else [7]
    data = [(rng.choice(keys), rng.randrange(400), i, rng.randrange(-3, 5)) for i in range(1500)]
    return spark.createDataFrame(data, "k bigint, t bigint, id bigint, x bigint").cache()


@pytest.mark.parametrize("size", [10, 97, 5000])
def test_running_values_equal_windows(rows, size):
    w = Window.partitionBy("k").orderBy("t", "id")
    want = rows.select("id", F.lag("x").over(w).alias("before"), F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"), F.row_number().over(w).cast("bigint").alias("nth"))
    got = S.Ranges(rows, "k", "t", "id", range_rows=size).lagged(before=F.col("x")).running(total=F.col("x"), nth=F.lit(1)).done()
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_one_key_is_spread_over_tasks(rows):
    held = S.Ranges(rows, "k", "t", "id", range_rows=50).rows.groupBy("_part").count().collect()
    assert max(r["count"] for r in held) < rows.count() / 10


def test_sessions_and_reversals_and_neighbours_equal_windows(spark, rows):
    timed = rows.withColumn("ts", F.timestamp_seconds(F.col("t") * 700))
    w = Window.partitionBy("k").orderBy("ts", "id")
    gap = F.col("t") * 700 - F.lag(F.col("t") * 700).over(w)
    day = F.to_date("ts") != F.to_date(F.lag("ts").over(w))
    marked = timed.withColumn("_new", F.when(gap.isNull() | (gap > 1000) | day, 1).otherwise(0)).withColumn("session", F.sum("_new").over(w))
    want = marked.groupBy("k", "session").agg(F.count("*").alias("n_events"), F.min("ts").alias("started"), F.max("ts").alias("ended"))
    got = E.gap_sessions(timed, "k", "ts", 1000, "id", split_days=True, range_rows=60)
    key = lambda r: (r[0] is not None, *r[:2])
    assert sorted(map(tuple, got.collect()), key=lambda r: repr(r)) == sorted(map(tuple, want.select(*got.columns).collect()), key=lambda r: repr(r)) and key
    v = Window.partitionBy("k").orderBy("id")
    late = rows.withColumn("b", F.lag("t").over(v)).where("t < b")
    assert {r["id"] for r in E.time_reversals(rows, "k", "id", "t", range_rows=40).collect()} == {r["id"] for r in late.collect()}
    i, last = F.row_number().over(v), F.count("*").over(Window.partitionBy("k"))
    want = rows.select("id", i.alias("i"), F.greatest(i - 1, F.lit(1)).alias("p"), F.least(i + 1, last).alias("n")).collect()
    got = E.neighbours(rows.select("k", "id"), "k", "id", range_rows=40).select("id", "case_index", "previous_index", "next_index").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_no_rows(rows):
    assert S.Ranges(rows.limit(0), "k", "t").lagged(b=F.col("x")).running(n=F.lit(1)).done().count() == 0
    assert Q.quantiles(rows.limit(0), "k", "x", {"p": 0.5}).count() == 0


@pytest.mark.parametrize(("bins", "few"), [(4, 3), (7, 50), (1024, 4096)])
def test_quantiles_equal_those_of_all_values_to_the_bit(spark, bins, few):
    rng = random.Random(bins)
    draws = {"even": lambda: rng.random(), "ties": lambda: rng.choice([0.1, 0.2, 7.5]), "far": lambda: rng.choice([1e-300, 1.0, 1e300, -1e18]) * rng.random(), "one": lambda: 3.25, None: lambda: rng.gauss(0, 1)}
    data = [(g, draw()) for g, draw in draws.items() for _ in range(rng.choice([1, 2, 301]) if g != "even" else 1200)] + [("even", None), ("none", None)]
    shares = {"p00": 0.0, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    rows = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: tuple(r[n] for n in shares) for r in Q.quantiles(rows, "g", "v", shares, bins, few).collect()}
    want = rows.where("v is not null").groupBy("g").agg(*[F.percentile("v", F.lit(s)).alias(n) for n, s in shares.items()]).collect()
    assert got == {r["g"]: tuple(r[n] for n in shares) for r in want}


def test_ranks_are_those_of_the_sorted_values(spark):
    rng = random.Random(8)
    values = [rng.choice([rng.random(), 0.5]) for _ in range(999)]
    rows = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    wanted = spark.createDataFrame([("a", r) for r in (0, 1, 17, 500, 997, 998, 999)], "g string, rank bigint")
    got = {r["rank"]: r["value"] for r in Q.ranked(rows, "g", "v", wanted, 5, 10).collect()}
    assert got == {r: sorted(values)[r] for r in (0, 1, 17, 500, 997, 998)}  # a rank beyond the values has none
