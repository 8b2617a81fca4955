from pyspark.sql import functions as F

from annoforge.operators import events as E
from annoforge.operators import review as R
from annoforge.streaming import mirror as M


def rows(spark):
    data = [(i, f"2026-01-01 00:{i:02d}:00", i % 2, i * 10) for i in range(30) if not 10 <= i < 22]
    return spark.createDataFrame(data, "id bigint, ts string, k bigint, v bigint").withColumn("ts", F.to_timestamp("ts"))


def test_mirror_copies_each_event_once(spark, tmp_path):
    events, source, target, mark = rows(spark), str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    events.where("id < 5").write.parquet(source)
    for more in (None, events.where("id >= 5")):
        if more is not None:
            more.write.mode("append").parquet(source)
        M.mirror(M.event_stream(spark, source, events.schema), target, mark).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == sorted(r["id"] for r in events.collect())


def test_stream_sessions_equal_batch(spark, tmp_path):
    events, source = rows(spark), str(tmp_path / "in")
    events.repartition(1).write.parquet(source)
    stream = M.sessions(M.event_stream(spark, source, events.schema), "k", "ts")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("sessions").start()
    q.processAllAvailable()
    q.stop()
    got = {(r["k"], r["n_events"]) for r in spark.table("sessions").collect()}
    batch = E.gap_sessions(events, "k", "ts", 600, "id")
    assert got == {(r["k"], r["n_events"]) for r in batch.collect()} and len(got) >= 2


def test_current_revisions_equal_batch(spark, tmp_path):
    events, source = rows(spark), str(tmp_path / "in")
    events.write.parquet(source)
    q = M.current(M.event_stream(spark, source, events.schema), "k", "id").writeStream.outputMode("complete").format("memory").queryName("current").start()
    q.processAllAvailable()
    q.stop()
    got = {(r["k"], r["row"]["id"]) for r in spark.table("current").collect()}
    assert got == {(r["k"], r["id"]) for r in R.latest(events, "k", "id").collect()}


def test_repeats_are_dropped_within_the_watermark(spark, tmp_path):
    events, source = rows(spark), str(tmp_path / "in")
    events.unionByName(events).repartition(1).write.parquet(source)
    q = M.once(M.event_stream(spark, source, events.schema), "id", "ts").writeStream.format("memory").queryName("once").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("once").count() == events.count()
