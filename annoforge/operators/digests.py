"""Digests of frames that merge over any split, and the first place where two frames differ.

A row's hash is 128 bits of its position and its values; a frame's digest is the number of its rows and the sum of
their hashes. Sums do not depend on how rows are dealt to tasks, and a range's digest is the sum of its parts', so that
ranges form a tree: two frames are compared by one pass over each, and the first difference is found by comparing
ranges of positions before rows. No rows are gathered and none are sorted for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructType, VariantType

from annoforge.functions import text as T
from annoforge.operators.review import positions

#: Rows of a range.
RANGE_ROWS = 1024
#: What stands for a null in a row's text.
NULL = "\x00"
#: Stands before what replaces a mark that occurs in a value.
ESCAPE = "\x1e"


def value_text(c: Column, kind: DataType) -> Column:
    """A value as text: equal texts, equal values of one type."""
    if isinstance(kind, BinaryType):
        out = F.hex(c)
    elif isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
        out = F.to_json(c if isinstance(kind, VariantType) else F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    else:
        out = c.cast("string")
    for mark, written in ((ESCAPE, ESCAPE + "0"), (T.UNIT, ESCAPE + "1"), (NULL, ESCAPE + "2")):
        out = F.replace(out, F.lit(mark), F.lit(written))
    return F.coalesce(out, F.lit(NULL))


def hashed(rows: DataFrame, position: str | None, columns: list[str]) -> list[Column]:
    """The two halves of each row's hash as decimals; without a position only values count."""
    parts = [value_text(F.col(f"`{c}`"), rows.schema[c].dataType) for c in columns]
    raw = F.md5(F.encode(F.concat_ws(T.UNIT, F.col(position).cast("string") if position else F.lit(""), *parts), "UTF-8"))
    return [F.conv(F.substring(raw, at, 16), 16, 10).cast("decimal(20,0)").alias(name) for at, name in ((1, "hi"), (17, "lo"))]


def digest() -> Column:
    """Hex digest of sums (n, hi, lo)."""
    return F.md5(F.encode(F.concat_ws(":", *[F.col(c).cast("string") for c in ("n", "hi", "lo")]), "UTF-8")).alias("digest")


def sums() -> list[Column]:
    return [F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)").alias(c) for c in ("hi", "lo")]]


def frame_digest(rows: DataFrame, position: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """One row: n_rows and digest. With a position column (1, 2, ...) order counts, without one it does not."""
    columns = columns or [c for c in rows.columns if c != position]
    return rows.select(*hashed(rows, position, columns)).agg(*sums()).select(F.col("n").alias("n_rows"), digest())


def range_digests(rows: DataFrame, position: str, columns: list[str] | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(range, n_rows, digest) of ranges of positions, counted from 0."""
    columns = columns or [c for c in rows.columns if c != position]
    part = F.floor((F.col(position) - 1) / range_rows).alias("range")
    return rows.select(part, *hashed(rows, position, columns)).groupBy("range").agg(*sums()).select("range", F.col("n").alias("n_rows"), digest())


def first_difference(left: DataFrame, right: DataFrame, position: str, columns: list[str] | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(position, left_row, right_row) of the first position whose rows differ, as structs; empty if there is none.

    Digests of ranges are compared first; rows of the first range that differs are looked at alone."""
    columns = columns or [c for c in left.columns if c != position]
    a, b = (range_digests(x, position, columns, range_rows).select("range", F.col("digest").alias(d)) for x, d in ((left, "a"), (right, "b")))
    worst = a.join(b, "range", "full").where(~F.col("a").eqNullSafe(F.col("b"))).agg(F.min("range")).first()[0]
    at = F.floor((F.col(position) - 1) / range_rows) == F.lit(worst)
    one, two = (x.where(at if worst is not None else F.lit(False)).select(position, F.struct(*[F.col(f"`{c}`") for c in columns]).alias(s)) for x, s in ((left, "left_row"), (right, "right_row")))
    return one.join(two, position, "full").where(~F.col("left_row").eqNullSafe(F.col("right_row"))).orderBy(position).limit(1)


def frame_equal(left: DataFrame, right: DataFrame, position: str | None = None) -> bool:
    """Same columns in order, and same rows: in the same order with a position column, else as often."""
    if [(f.name, f.dataType) for f in left.schema] != [(f.name, f.dataType) for f in right.schema]:
        return False
    return frame_digest(left, position).first() == frame_digest(right, position).first()


def in_file_order(rows: DataFrame, name: str = "position") -> DataFrame:
    """Rows read from files, numbered from 1 by file name and place in the file."""
    at = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    return positions(at, "_file", "_block", "_row", name=name).drop("_file", "_block", "_row")


def in_order(rows: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Rows numbered from 1 by columns; all others break ties, so that equal rows alone may change places."""
    rest = [c for c in rows.columns if c not in order and not isinstance(rows.schema[c].dataType, (MapType, VariantType))]
    return positions(rows, *order, *rest, name=name)


def written_in_order(rows: DataFrame, position: str, write) -> None:
    """Hand the rows over to `write` in files whose names and rows go by position."""
    write(rows.repartitionByRange(position).sortWithinPartitions(position).drop(position))
