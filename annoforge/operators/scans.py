"""Running values along the rows of a key, in order, without gathering a key in one task.

Rows are cut in ranges of (key, order). A window over each range gives what its own rows add; one summary row for the
first and the last key of each range, scanned over the ranges, gives what earlier ranges have of the same key. A key
with all the rows is spread over all tasks like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annoforge.operators.review import ranged

#: Rows of a range.
RANGE_ROWS = 1 << 15


class Ranges:
    """Rows in ranges of (key, order). Order must be total: rows that it leaves equal may come in any order."""

    def __init__(self, rows: DataFrame, key: str, *order: str, range_rows: int = RANGE_ROWS):
        self.key, self.order = key, order
        self.rows = ranged(rows, key, *order, range_rows=range_rows, name="_part")
        self.inside = Window.partitionBy("_part").orderBy(key, *order)

    def lagged(self, **values: Column) -> Ranges:
        """Adds, by name, the value that the row ahead in the same key has; null for a key's first row."""
        row = F.struct(F.col(self.key).alias("_key"), F.lit(True).alias("_there"), *[v.alias(n) for n, v in values.items()])
        ends = self.rows.groupBy("_part").agg(F.max_by(row, F.struct(self.key, *self.order)).alias("_end"))
        ahead = F.broadcast(ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_scan_ahead")))
        marked = self.rows.withColumn("_scan_before", F.lag(row).over(self.inside)).join(ahead, "_part")
        before = F.coalesce("_scan_before", "_scan_ahead")
        same = before["_key"].eqNullSafe(F.col(self.key)) & before["_there"]
        return self._with(marked.withColumns({n: F.when(same, before[n]) for n in values}).drop("_scan_before", "_scan_ahead"))

    def running(self, **values: Column) -> Ranges:
        """Adds, by name, the sum of a whole-number value over the key's rows up to this one."""
        held = self.rows.withColumns({f"_v_{n}": v.cast("bigint") for n, v in values.items()})
        own = held.groupBy("_part", self.key).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values])
        # keys of several ranges have whole ranges or ends of them: at most two such keys a range
        across = held.groupBy("_part").agg(F.min(F.struct(F.col(self.key).alias("k"))).alias("a"), F.max(F.struct(F.col(self.key).alias("k"))).alias("z"))
        edge = across.select("_part", F.explode(F.array_distinct(F.array("a", "z"))).alias("e")).select(F.col("_part").alias("_p"), F.col("e.k").alias("_k"))
        sums = own.join(F.broadcast(edge), (F.col("_part") == F.col("_p")) & F.col(self.key).eqNullSafe(F.col("_k")))
        w = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        carried = sums.select("_p", "_k", *[F.sum(f"_s_{n}").over(w).alias(f"_c_{n}") for n in values])
        local = Window.partitionBy("_part", self.key).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, 0)
        out = held.withColumns({f"_r_{n}": F.sum(f"_v_{n}").over(local) for n in values})
        out = out.join(F.broadcast(carried), (F.col("_part") == F.col("_p")) & F.col(self.key).eqNullSafe(F.col("_k")), "left")
        out = out.withColumns({n: F.col(f"_r_{n}") + F.coalesce(f"_c_{n}", F.lit(0)) for n in values})
        return self._with(out.drop("_p", "_k", *[f"{p}{n}" for n in values for p in ("_v_", "_r_", "_c_")]))

    def _with(self, rows: DataFrame) -> Ranges:
        out = object.__new__(Ranges)
        out.key, out.order, out.inside, out.rows = self.key, self.order, self.inside, rows
        return out

    def done(self) -> DataFrame:
        return self.rows.drop("_part")
