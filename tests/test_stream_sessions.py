"""Sessions of a stream against the batch query, for files in several orders."""

import random

import pytest
from pyspark.sql import functions as F

from annoforge.operators import events as E
from annoforge.streaming import gap_sessions as G
from annoforge.streaming import mirror as M


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", G.PROVIDER)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_equal_the_batch_query_for_any_order_of_files(rocks, tmp_path, seed):
    spark, rng = rocks, random.Random(seed)
    data = [(i, rng.randrange(3), f"2026-01-0{rng.choice([1, 2])} {rng.choice([0, 5, 23]):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}") for i in range(160)]
    events = spark.createDataFrame(data, "id bigint, k bigint, ts string").withColumn("ts", F.to_timestamp("ts"))
    order = list(range(4))
    rng.shuffle(order)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in order:
        events.where(F.col("id") % 4 == part).coalesce(1).write.mode("append").parquet(source)

    def keep(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

    stream = G.gap_sessions(M.event_stream(spark, source, events.schema, files_per_trigger=1), "k", "ts", 600, split_days=True, late="3 days")
    stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start().awaitTermination()
    got = {(r["k"], r["started"], r["ended"], r["n_events"]) for r in G.newest(spark.read.parquet(out), "k", "batch").collect()}
    want = {(r["k"], r["started"], r["ended"], r["n_events"]) for r in E.gap_sessions(events, "k", "ts", 600, "id", split_days=True).collect()}
    assert got == want and len(want) > 20


def test_sessions_close_behind_the_watermark(rocks, tmp_path):
    spark = rocks
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, times in enumerate([["00:00:00", "00:05:00"], ["06:00:00"], ["06:01:00"]]):
        spark.createDataFrame([(n, 1, f"2026-01-01 {t}") for t in times], "id int, k bigint, ts string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema

    def keep(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

    stream = G.gap_sessions(M.event_stream(spark, source, schema, files_per_trigger=1), "k", "ts", 600)
    stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start().awaitTermination()
    got = {(str(r["started"])[11:], r["n_events"], r["closed"]) for r in G.newest(spark.read.parquet(out), "k", "batch").collect()}
    assert got == {("00:00:00", 2, True), ("06:00:00", 2, False)}


def test_neighbouring_sessions_are_joined():
    one = [(0, 0, 1, 0), (20, 20, 1, 0)]
    assert G.joined(one, 10, False) == one
    assert G.joined([*one, (10, 10, 1, 0)], 10, False) == [(0, 20, 3, 0)]
    night = [(99, 99, 1, 0), (101, 101, 1, 1)]
    assert G.joined(night, 10, True) == night and len(G.joined(night, 10, False)) == 1
