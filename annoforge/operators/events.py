"""Event logs: sessions, pairing in time, revisions, mirrors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.operators.scans import RANGE_ROWS, Ranges


def gap_sessions(events: DataFrame, key: str, at: str, gap_seconds: int, id_col: str, split_days: bool = False, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Sessions of each key: a pause longer than the gap, or a new day, starts the next."""
    ranges = Ranges(events.select(key, at, id_col), key, at, id_col, range_rows=range_rows).lagged(_before=F.col(at))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    new = F.col("_before").isNull() | (micros(at) - micros("_before") > gap_seconds * 1_000_000)
    if split_days:
        new = new | (F.to_date(at) != F.to_date("_before"))
    numbered = ranges.running(session=F.when(new, 1).otherwise(0)).done()
    return numbered.groupBy(key, "session").agg(F.count("*").alias("n_events"), F.min(at).alias("started"), F.max(at).alias("ended"))


def time_reversals(events: DataFrame, group: str, order: str, at: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows whose time is before that of the row ahead of them."""
    rows = events.select(group, order, F.col(at).alias("at"))
    return Ranges(rows, group, order, range_rows=range_rows).lagged(before=F.col("at")).done().where(F.col("at") < F.col("before"))


def neighbours(rows: DataFrame, group: str, *order: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The index of the case before and after, staying at the ends."""
    numbered = Ranges(rows, group, *order, range_rows=range_rows).running(case_index=F.lit(1)).done()
    last = rows.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_last"))
    out = numbered.join(last, F.col(group).eqNullSafe(F.col("_group")))
    i = F.col("case_index")
    return out.select(*rows.columns, i, F.greatest(i - 1, F.lit(1)).alias("previous_index"), F.least(i + 1, F.col("_last")).alias("next_index"))


def pair_before_after(rows: DataFrame, key: str, at: str, id_col: str, max_seconds: int) -> DataFrame:
    """Pairs of a key whose later row follows within the time; time buckets keep a key from meeting itself whole."""
    sec = F.unix_timestamp(F.col(at).cast("timestamp"))
    base = rows.select(F.col(key).alias("key"), F.col(id_col).alias("id"), sec.alias("s"))
    b = F.floor(F.col("s") / max_seconds)
    a = base.select("key", F.col("id").alias("before_id"), F.col("s").alias("before_s"), F.explode(F.array(b, b + 1)).alias("b"))
    z = base.select("key", F.col("id").alias("after_id"), F.col("s").alias("after_s"), b.alias("b"))
    met = a.join(z, ["key", "b"]).where((F.col("before_s") < F.col("after_s")) & (F.col("after_s") - F.col("before_s") <= max_seconds))
    return met.select("key", "before_id", "after_id", (F.col("after_s") - F.col("before_s")).alias("elapsed_seconds"))


def mirror_after(events: DataFrame, id_col: str, last: int) -> DataFrame:
    """Events beyond the last mirrored id, in order."""
    return events.where(F.col(id_col) > last).orderBy(id_col)
