"""The driver's tables as the inputs of the operators, and the same bindings as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoforge.functions.hashes import sign_hash

THRESHOLDS = [t / 10 for t in range(11)]
CANVAS = 60.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows as boxes: the image is the order, coordinates and confidence come from its numbers."""
    li = table(spark, sf_dir, "lineitem")
    x, y = (F.col("l_partkey") % 40).cast("double"), (F.col("l_suppkey") % 40).cast("double")
    size = (F.col("l_quantity").cast("bigint") % 20 + 10).cast("double")
    return li.select(
        F.col("l_orderkey").alias("image_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("object_id"),
        F.col("l_linenumber").alias("n"),
        F.lit(0).alias("class_id"),
        (F.round(F.col("l_discount") * 100) / 10).alias("confidence"),
        F.struct(x.alias("x1"), y.alias("y1"), (x + size).alias("x2"), (y + size).alias("y2")).alias("box"),
    )


def detections(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Predictions (odd line numbers) and ground truth (even ones)."""
    rows = boxes(spark, sf_dir)
    predictions = rows.where("n % 2 = 1").select("image_id", F.col("object_id").alias("prediction_id"), "class_id", "confidence", "box")
    return predictions, rows.where("n % 2 = 0").select("image_id", F.col("object_id").alias("gt_id"), "class_id", "box")


def hash_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as hash records: signs of the components, scope by parity."""
    e = table(spark, sf_dir, "embeddings")
    scope = F.when(F.col("vec_id") % 2 == 0, "internal").otherwise("external")
    aspect = F.lit(1.0) + (F.col("vec_id") % 5).cast("double") / 100
    return e.select(F.format_string("r%08d", "vec_id").alias("record_id"), scope.alias("source_scope"), sign_hash(F.col("embedding")).alias("phash"), aspect.alias("aspect_ratio"))


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as file records with a digest of their text."""
    d = table(spark, sf_dir, "documents")
    scope = F.when(F.col("doc_id") % 2 == 0, "internal").otherwise("external")
    return d.select(F.col("doc_id").alias("record_id"), scope.alias("source_scope"), "source", F.sha2(F.encode("text", "UTF-8"), 256).alias("sha256"))


BOX_SQL = """
box AS (SELECT l_orderkey AS image_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS object_id, l_linenumber AS n,
  round(l_discount * 100) / 10 AS confidence, (l_partkey % 40)::DOUBLE AS x1, (l_suppkey % 40)::DOUBLE AS y1,
  (l_partkey % 40 + 10 + l_quantity::BIGINT % 20)::DOUBLE AS x2, (l_suppkey % 40 + 10 + l_quantity::BIGINT % 20)::DOUBLE AS y2 FROM lineitem),
pred AS (SELECT image_id, object_id AS prediction_id, confidence, x1, y1, x2, y2 FROM box WHERE n % 2 = 1),
gt AS (SELECT image_id, object_id AS gt_id, x1, y1, x2, y2 FROM box WHERE n % 2 = 0),
pair AS (SELECT p.image_id, prediction_id, gt_id, confidence,
  greatest(0, least(p.x2, g.x2) - greatest(p.x1, g.x1)) * greatest(0, least(p.y2, g.y2) - greatest(p.y1, g.y1)) AS inter,
  (p.x2 - p.x1) * (p.y2 - p.y1) + (g.x2 - g.x1) * (g.y2 - g.y1) AS area FROM pred p JOIN gt g ON p.image_id = g.image_id),
iou AS (SELECT image_id, prediction_id, gt_id, confidence, inter / (area - inter) AS iou FROM pair)"""


def match_sql(thresholds: list[float]) -> str:
    """CTEs lv, pm (outcomes of predictions) and gm (outcomes of boxes) after BOX_SQL; needs WITH RECURSIVE."""
    levels = ", ".join(f"({t}::DOUBLE)" for t in thresholds)
    return f"""{BOX_SQL},
lv(threshold) AS (VALUES {levels}),
best AS (SELECT image_id, prediction_id, max(iou) AS best_iou, arg_min(gt_id, struct_pack(n := -iou, g := gt_id)) AS best_gt FROM iou GROUP BY ALL),
hits AS (SELECT image_id, prediction_id, list(struct_pack(n := -iou, g := gt_id) ORDER BY -iou, gt_id) AS h FROM iou WHERE iou >= 0.5 GROUP BY ALL),
rival AS (SELECT threshold, p.image_id, p.prediction_id, h, row_number() OVER (PARTITION BY threshold, p.image_id ORDER BY p.confidence DESC, p.prediction_id) AS rn
  FROM pred p JOIN hits USING (image_id, prediction_id) JOIN lv ON p.confidence >= threshold),
fold(threshold, image_id, rn, used, pid, got) AS (
  SELECT DISTINCT threshold, image_id, 0::BIGINT, []::VARCHAR[], ''::VARCHAR, NULL::STRUCT(n DOUBLE, g VARCHAR) FROM rival
  UNION ALL
  SELECT threshold, image_id, rn, CASE WHEN got IS NULL THEN used ELSE list_append(used, got.g) END, pid, got
  FROM (SELECT r.threshold, r.image_id, r.rn, f.used, r.prediction_id AS pid, list_filter(r.h, lambda x: NOT list_contains(f.used, x.g))[1] AS got
        FROM fold f JOIN rival r ON r.threshold = f.threshold AND r.image_id = f.image_id AND r.rn = f.rn + 1)),
won AS (SELECT threshold, image_id, pid AS prediction_id, got.g AS gt_id, -got.n AS iou FROM fold WHERE got IS NOT NULL),
pm AS (SELECT threshold, p.image_id, p.prediction_id, 0 AS class_id, p.confidence, coalesce(w.gt_id, '') AS matched_gt_id, coalesce(w.gt_id, b.best_gt, '') AS best_gt_id,
  coalesce(w.iou, b.best_iou, 0) AS best_iou, CASE WHEN w.gt_id IS NULL THEN 'unmatched' ELSE 'matched' END AS match_status,
  CASE WHEN w.gt_id IS NOT NULL THEN 'true_positive' WHEN coalesce(b.best_iou, 0) >= 0.5 THEN 'duplicate_prediction'
       WHEN coalesce(b.best_iou, 0) >= 0.1 THEN 'localization_error' ELSE 'background_false_positive' END AS error_type
  FROM pred p JOIN lv ON p.confidence >= threshold LEFT JOIN best b USING (image_id, prediction_id) LEFT JOIN won w USING (threshold, image_id, prediction_id)),
raw AS (SELECT image_id, gt_id, arg_min(struct_pack(p := prediction_id, i := iou, c := confidence), struct_pack(n := -iou, c := -confidence, p := prediction_id)) AS r FROM iou GROUP BY ALL),
gm AS (SELECT threshold, g.image_id, g.gt_id, 0 AS class_id, coalesce(m.prediction_id, '') AS matched_prediction_id, coalesce(m.prediction_id, r.p, '') AS best_raw_prediction_id,
  coalesce(m.best_iou, r.i, 0) AS best_iou, coalesce(m.confidence, r.c) AS best_raw_confidence, CASE WHEN m.prediction_id IS NULL THEN 'unmatched' ELSE 'matched' END AS match_status,
  CASE WHEN m.prediction_id IS NOT NULL THEN 'true_positive' WHEN coalesce(r.i, 0) >= 0.5 AND (r.c IS NULL OR r.c < threshold) THEN 'low_confidence_miss'
       WHEN coalesce(r.i, 0) >= 0.1 THEN 'localization_miss' ELSE 'no_detection' END AS error_type
  FROM gt g CROSS JOIN lv LEFT JOIN raw USING (image_id, gt_id)
  LEFT JOIN (SELECT threshold, image_id, matched_gt_id AS gt_id, prediction_id, best_iou, confidence FROM pm WHERE match_status = 'matched') m USING (threshold, image_id, gt_id))"""


HASH_SQL = """
rec AS (SELECT printf('r%08d', vec_id) AS record_id, CASE WHEN vec_id % 2 = 0 THEN 'internal' ELSE 'external' END AS source_scope,
  (SELECT string_agg(CASE WHEN embedding[64 - i] > 0 THEN '1' ELSE '0' END, '' ORDER BY i) FROM range(64) t(i))::BIT AS phash,
  1.0::DOUBLE + (vec_id % 5)::DOUBLE / 100 AS aspect_ratio FROM embeddings)"""

CONTENT_SQL = "file AS (SELECT doc_id AS record_id, CASE WHEN doc_id % 2 = 0 THEN 'internal' ELSE 'external' END AS source_scope, source, sha256(text) AS sha256 FROM documents)"
