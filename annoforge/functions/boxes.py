"""Box geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Slack of the image border checks.
SLACK = 1e-6


def side(lo: Column, hi: Column) -> Column:
    return F.greatest(F.lit(0.0), hi - lo)


def iou(a: str | Column, b: str | Column) -> Column:
    """Intersection over union of two corner boxes held as structs x1, y1, x2, y2; 0 for an empty box."""
    p, q = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    area_p = side(p["x1"], p["x2"]) * side(p["y1"], p["y2"])
    area_q = side(q["x1"], q["x2"]) * side(q["y1"], q["y2"])
    inner = side(F.greatest(p["x1"], q["x1"]), F.least(p["x2"], q["x2"])) * side(F.greatest(p["y1"], q["y1"]), F.least(p["y2"], q["y2"]))
    return F.when((area_p > 0) & (area_q > 0), inner / (area_p + area_q - inner)).otherwise(F.lit(0.0))


def size_bucket(ratio: Column, small_max: float, medium_max: float) -> Column:
    """small, medium or large by share of the image; bounds belong to the smaller class."""
    if not 0 <= small_max < medium_max <= 1:
        raise ValueError("bounds must satisfy 0 <= small < medium <= 1")
    return F.when(ratio <= small_max, "small").when(ratio <= medium_max, "medium").otherwise("large")


def corners(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Corner box of an origin-and-size box."""
    return F.struct(x.alias("x1"), y.alias("y1"), (x + w).alias("x2"), (y + h).alias("y2"))


def centred(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Corner box in pixels of a centre box in shares of the image."""
    return F.struct(((cx - w / 2) * width).alias("x1"), ((cy - h / 2) * height).alias("y1"), ((cx + w / 2) * width).alias("x2"), ((cy + h / 2) * height).alias("y2"))


def clipped(x: Column, size: Column, limit: Column) -> Column:
    """Size after cutting the far side at the image border; the origin stays."""
    return F.least(x + size, limit) - x


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def invalid_reasons(box: Column, width: Column, height: Column) -> Column:
    """Sorted array of what is wrong with an [x, y, w, h] array; structural faults come alone."""
    x, y, w, h = (F.get(box, F.lit(i)) for i in range(4))
    checks = [
        (F.lit("exceeds_image_height"), y + h > height + SLACK),
        (F.lit("exceeds_image_width"), x + w > width + SLACK),
        (F.lit("negative_x"), x < 0),
        (F.lit("negative_y"), y < 0),
        (F.lit("nonpositive_height"), h <= 0),
        (F.lit("nonpositive_width"), w <= 0),
    ]
    found = F.array_compact(F.array(*[F.when(bad, name) for name, bad in checks]))
    return (
        F.when(box.isNull() | (F.size(box) != 4), F.array(F.lit("malformed_bbox")))
        .when(x.isNull() | y.isNull() | w.isNull() | h.isNull(), F.array(F.lit("non_numeric_bbox")))
        .when(~(_finite(x) & _finite(y) & _finite(w) & _finite(h)), F.array(F.lit("non_finite_bbox")))
        .when(~(_finite(width) & _finite(height)), F.array(F.lit("invalid_image_dimensions")))
        .when((width <= 0) | (height <= 0), F.array(F.lit("invalid_image_dimensions")))
        .otherwise(found)
    )


def first_status(box: Column, width: Column, height: Column, has_image: Column) -> Column:
    """The first fault of an [x, y, w, h] array in a fixed order, or valid."""
    x, y, w, h = (F.get(box, F.lit(i)) for i in range(4))
    return (
        F.when(~has_image, "missing_image_reference")
        .when(box.isNull() | (F.size(box) != 4) | x.isNull() | y.isNull() | w.isNull() | h.isNull(), "invalid_bbox_shape")
        .when((w <= 0) | (h <= 0), "non_positive_bbox")
        .when((x < 0) | (y < 0), "negative_bbox_origin")
        .when((x + w > F.coalesce(width, F.lit(0.0)) + SLACK) | (y + h > F.coalesce(height, F.lit(0.0)) + SLACK), "bbox_out_of_bounds")
        .otherwise("valid")
    )


def segmentation_status(raw: Column) -> Column:
    """Kind of a JSON segmentation: run lengths, polygons, or what is wrong."""
    outer = F.from_json(raw, "array<array<string>>")
    number = r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"
    shape = F.exists(outer, lambda p: p.isNull() | (F.size(p) < 6) | (F.size(p) % 2 != 0))
    coordinate = F.exists(outer, lambda p: F.exists(p, lambda v: v.isNull() | ~v.rlike(number)))
    is_object = F.ltrim(raw).startswith("{")
    keys = F.json_object_keys(raw)
    return (
        F.when(is_object & F.array_contains(keys, "counts") & F.array_contains(keys, "size"), "valid_rle")
        .when(is_object, "invalid_rle")
        .when(raw.isNull() | outer.isNull() | (F.size(outer) < 1), "missing_or_empty")
        .when(shape, "invalid_polygon_shape")
        .when(coordinate, "invalid_polygon_coordinate")
        .otherwise("valid_polygon")
    )
