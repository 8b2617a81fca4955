"""Structured Streaming: an append-only mirror, current revisions and sessions of an event stream.

Sessions by watermark are an extension; the mirror and the revisions have batch counterparts in operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def mirror(events: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append events to a table; the checkpoint remembers what was copied, so that a restart copies nothing twice.

    Each batch is a folder named by its number and replaced as a whole when it is run again."""

    def copy(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return events.writeStream.foreachBatch(copy).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(events: DataFrame, key: str, revision: str) -> DataFrame:
    """The newest row of each key so far, for complete or update mode."""
    return events.groupBy(key).agg(F.max_by(F.struct(*[c for c in events.columns if c != key]), revision).alias("row"))


def sessions(events: DataFrame, key: str, at: str, gap: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts by session of a key; an event exactly at the gap is still inside."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    out = timed.groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n_events"))
    return out.select(key, F.col("w.start").alias("started"), "n_events")


def once(events: DataFrame, id_col: str, at: str, late: str = "1 hour") -> DataFrame:
    """Events without repeats that arrive within the time."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark([id_col])
