"""Overlapping boxes by a grid against all pairs; matching of dense images against loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoforge.operators import matching as M
from annoforge.operators import overlap as O

BOX = "struct<x1:double,y1:double,x2:double,y2:double>"


def boxes(rng, n, sides):
    out = []
    for _ in range(n):
        x, y, w, h = rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice(sides) * rng.random(), rng.choice(sides) * rng.random()
        if rng.random() < 0.3:
            x, y, w, h = round(x), round(y), round(w), round(h)  # borders that touch, and empty boxes
        out.append((x, y, x + w, y + h))
    return out


@pytest.mark.parametrize("sides", [[4], [1, 30], [0.01, 1, 200], [1e-9, 1e6]])
def test_pairs_are_those_of_all_pairs(sides):
    rng = random.Random(len(sides))
    a, b = np.array(boxes(rng, 150, sides)), np.array(boxes(rng, 160, sides))
    a[3], b[5, 2], a[7] = np.nan, np.inf, (0, 0, -1, -1)
    i, j = O.pairs(a, b)
    want = {(x, y) for x in range(len(a)) for y in range(len(b)) if np.isfinite(a[x]).all() and np.isfinite(b[y]).all() and min(a[x, 2], b[y, 2]) > max(a[x, 0], b[y, 0]) and min(a[x, 3], b[y, 3]) > max(a[x, 1], b[y, 1])}
    assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want
    assert all(len(x) == 0 for x in O.pairs(a[:0], b))


def test_a_dense_image_is_matched_in_bounded_memory(spark):
    n = 20_000
    place = lambda i, salt: F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(1 << 20)) / (1 << 20) * 5000
    made = lambda name, salt: spark.range(n).select(F.lit("i").alias("image_id"), F.format_string(f"{name}%05d", "id").alias(f"{name}_id"), F.lit(0).alias("class_id"), place(F.col("id"), salt).alias("x"), place(F.col("id"), salt + 1).alias("y"), (F.col("id") % 97 / 97.0).alias("confidence"))
    boxed = lambda df, shift: df.withColumn("box", F.struct((F.col("x") + shift).alias("x1"), F.col("y").alias("y1"), (F.col("x") + 20 + shift).alias("x2"), (F.col("y") + 20).alias("y2"))).drop("x", "y")
    preds = boxed(made("prediction", 1), 1.0)
    truth = boxed(made("gt", 1), 0.0).drop("confidence")
    [row] = M.sweep(preds, truth, [0.5]).collect()
    p = sorted(((r["confidence"], r["prediction_id"]) for r in preds.collect()), key=lambda r: (-r[0], r[1]))
    active = sum(c >= 0.5 for c, _ in p)
    assert row["predictions_count"] == active and row["ground_truth_count"] == n and row["tp"] > 0.9 * active
    assert 0.8 < M.max_overlap(preds, truth).first()["max_iou"] <= 1.0


def test_nulls_overlap_with_nothing(spark):
    p = [("i", "1", 0, 0.9, (0.0, 0.0, 10.0, 10.0)), ("i", "2", None, 0.9, (0.0, 0.0, 10.0, 10.0)), ("i", "3", 0, None, (0.0, 0.0, 10.0, 9.0)), ("i", "4", 0, float("nan"), (0.0, 0.0, 10.0, 10.0)), ("i", "5", 0, 0.8, None), ("j", "6", 1, 0.7, (0.0, 0.0, 1.0, 1.0))]
    g = [("i", "10", 0, (0.0, 0.0, 10.0, 10.0)), ("i", "11", None, (0.0, 0.0, 10.0, 10.0)), ("k", "12", 0, None)]
    preds = spark.createDataFrame(p, f"image_id string, prediction_id string, class_id int, confidence double, box {BOX}")
    truth = spark.createDataFrame(g, f"image_id string, gt_id string, class_id int, box {BOX}")
    got = {r["prediction_id"]: (r["error_type"], r["matched_gt_id"]) for r in M.match(preds, truth, [0.5]).collect()}
    assert got == {"1": ("true_positive", "10"), "2": ("background_false_positive", ""), "5": ("background_false_positive", ""), "6": ("background_false_positive", "")}
    left = {r["gt_id"]: r["error_type"] for r in M.misses(preds, truth, [0.5]).collect()}
    assert left == {"10": "true_positive", "11": "no_detection", "12": "no_detection"}
