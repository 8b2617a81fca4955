"""Queries of detector error analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from annoforge.functions import boxes as B
from annoforge.operators import matching as M
from annoforge.plans.bindings import BOX_SQL, CANVAS, THRESHOLDS, boxes, detections, match_sql, table

AT = 0.5
_AT = [AT]


def match_boxes(spark, sf):
    return M.match(*detections(spark, sf), _AT)


def gt_misses(spark, sf):
    return M.misses(*detections(spark, sf), _AT)


def match_summary(spark, sf):
    return M.sweep(*detections(spark, sf), _AT)


def threshold_sweep(spark, sf):
    return M.sweep(*detections(spark, sf), THRESHOLDS)


def operating_points(spark, sf):
    return M.operating_points(M.sweep(*detections(spark, sf), THRESHOLDS))


def max_pairwise_iou(spark, sf):
    return M.max_overlap(*detections(spark, sf))


def _cases(spark, sf):
    return M.error_cases(*detections(spark, sf), _AT)


def error_cases(spark, sf):
    return _cases(spark, sf)


def error_summary(spark, sf):
    return M.summary(_cases(spark, sf), "source_type", "error_type")


def error_by_size(spark, sf):
    b = F.col("box")
    ratio = (b["x2"] - b["x1"]) * (b["y2"] - b["y1"]) / (CANVAS * CANVAS)
    sizes = boxes(spark, sf).select("image_id", "object_id", B.size_bucket(ratio, 0.05, 0.15).alias("bbox_size"))
    return M.summary(_cases(spark, sf).join(sizes, ["image_id", "object_id"]), "source_type", "error_type", "bbox_size")


def improvement_priorities(spark, sf):
    return M.priorities(_cases(spark, sf))


def case_assembly(spark, sf):
    predictions, truth = detections(spark, sf)
    worklist = _cases(spark, sf).select("image_id")
    return M.case_assembly(worklist, predictions, truth, AT)


def error_worklist(spark, sf):
    """Errors of an image in one row: the primary type by precedence, all types, counts by side."""
    order = F.when(F.col("error_type") == "no_detection", 1).when(F.col("error_type") == "low_confidence_miss", 2).when(F.contains("error_type", F.lit("localization")), 3).otherwise(4)
    rows = _cases(spark, sf).withColumn("o", order)
    return rows.groupBy("image_id").agg(
        F.min(F.struct("o", "error_type"))["error_type"].alias("primary_error"),
        F.array_join(F.array_sort(F.collect_set("error_type")), "|").alias("error_types"),
        F.count_if(F.col("source_type") == "prediction").alias("prediction_errors"),
        F.count_if(F.col("source_type") == "ground_truth").alias("gt_errors"),
    )


def _coco(spark, sf):
    """Boxes with origin and size, shifted so that some start before the canvas and some reach beyond it."""
    b = F.col("box")
    size = b["x2"] - b["x1"]
    w = F.when(F.col("n") % 7 == 0, F.lit(0.0)).otherwise(size)
    return boxes(spark, sf).select("image_id", "object_id", (b["x1"] - 3).alias("x"), b["y1"].alias("y"), w.alias("w"), size.alias("h"))


_COCO_SQL = f"{BOX_SQL}, coco AS (SELECT image_id, object_id, x1 - 3 AS x, y1 AS y, CASE WHEN n % 7 = 0 THEN 0 ELSE x2 - x1 END AS w, x2 - x1 AS h FROM box)"


def bbox_reasons(spark, sf):
    rows = _coco(spark, sf)
    box = F.array("x", "y", "w", "h")
    return rows.select("object_id", F.array_join(B.invalid_reasons(box, F.lit(CANVAS), F.lit(CANVAS)), "|").alias("reasons"), B.first_status(box, F.lit(CANVAS), F.lit(CANVAS), F.lit(True)).alias("status"))


def bbox_clip(spark, sf):
    rows = _coco(spark, sf)
    return rows.select("object_id", "x", "y", B.clipped(F.col("x"), F.col("w"), F.lit(CANVAS)).alias("new_width"), B.clipped(F.col("y"), F.col("h"), F.lit(CANVAS)).alias("new_height"))


def bbox_ratios(spark, sf):
    return _coco(spark, sf).select("object_id", (F.col("w") * F.col("h") / (CANVAS * CANVAS)).alias("area_ratio"), (F.col("w") / CANVAS).alias("width_ratio"), (F.col("h") / CANVAS).alias("height_ratio"))


def bbox_records(spark, sf):
    """Ordinal records of the confident boxes of each image, in one text."""
    from pyspark.sql.window import Window

    rows = boxes(spark, sf).where("confidence >= 0.3").withColumn("k", F.row_number().over(Window.partitionBy("image_id").orderBy("object_id")))
    one = F.concat_ws(":", F.format_string("gt_%03d", "k"), *[F.col(f"box.{c}").cast("bigint") for c in ("x1", "y1", "x2", "y2")])
    lists = rows.select("image_id", "k", one.alias("r")).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("k", "r"))).alias("rs"))
    return lists.select("image_id", F.size("rs").cast("bigint").alias("n_records"), F.array_join("rs.r", ";").alias("records"))


def topk_extremes(spark, sf, k: int = 200):
    """The k smallest and the k largest boxes, ties by id."""
    b = F.col("box")
    rows = boxes(spark, sf).select("object_id", ((b["x2"] - b["x1"]) * (b["y2"] - b["y1"]) / (CANVAS * CANVAS)).alias("area_ratio"))
    low = rows.orderBy("area_ratio", "object_id").limit(k).withColumn("side", F.lit("smallest"))
    return low.unionByName(rows.orderBy(F.desc("area_ratio"), "object_id").limit(k).withColumn("side", F.lit("largest")))


def category_counts(spark, sf):
    """Rows and distinct brands of the approved aliases, zero where an alias does not occur."""
    aliases = ["STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO", "ABSENT"]
    names = spark.createDataFrame([(a,) for a in aliases], "alias string")
    p = table(spark, sf, "part").select(F.element_at(F.split("p_type", " "), 1).alias("alias"), "p_brand")
    n = p.groupBy("alias").agg(F.count("*").alias("n_rows"), F.count_distinct("p_brand").alias("n_brands"))
    return names.join(n, "alias", "left").na.fill(0, ["n_rows", "n_brands"])


def canonical_categories(spark, sf):
    """All types as one category; a digest shows that the other columns are as before."""
    p = table(spark, sf, "part")
    rest = F.concat_ws("|", "p_partkey", "p_name", "p_brand", "p_size")
    return p.select("p_partkey", F.lit(0).cast("bigint").alias("category_id"), F.sha1(F.encode(rest, "UTF-8")).alias("rest_sha1"))


_M = "WITH RECURSIVE " + match_sql(_AT)
_SWEEP = "WITH RECURSIVE " + match_sql(THRESHOLDS)
_SCORE = """
, c AS (SELECT lv.threshold, count(pm.prediction_id) AS predictions_count, count(*) FILTER (error_type = 'true_positive') AS tp,
   count(DISTINCT image_id) FILTER (error_type <> 'true_positive') AS images_with_fp FROM lv LEFT JOIN pm ON pm.threshold = lv.threshold GROUP BY lv.threshold),
g AS (SELECT threshold, count(*) AS ground_truth_count, count(*) FILTER (error_type <> 'true_positive') AS fn,
   count(DISTINCT image_id) FILTER (error_type <> 'true_positive') AS images_with_fn FROM gm GROUP BY threshold),
s AS (SELECT *, predictions_count - tp AS fp FROM c JOIN g USING (threshold)),
q AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS recall FROM s),
sweep AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2.0 * precision * recall / (precision + recall) END AS f1 FROM q)
"""
_CASES = """, cases AS (
  SELECT threshold, 'prediction' AS source_type, image_id, prediction_id AS object_id, error_type, best_iou FROM pm WHERE error_type <> 'true_positive'
  UNION ALL SELECT threshold, 'ground_truth', image_id, gt_id, error_type, best_iou FROM gm WHERE error_type <> 'true_positive')
"""


def _values(rows):
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


QUERIES = {f.__name__: f for f in (match_boxes, gt_misses, match_summary, threshold_sweep, operating_points, max_pairwise_iou, error_cases, error_summary, error_by_size, improvement_priorities, case_assembly, error_worklist, bbox_reasons, bbox_clip, bbox_ratios, bbox_records, topk_extremes, category_counts, canonical_categories)}

ORACLES = {
    "match_boxes": f"{_M} SELECT * FROM pm",
    "gt_misses": f"{_M} SELECT * FROM gm",
    "match_summary": f"{_M} {_SCORE} SELECT * FROM sweep",
    "threshold_sweep": f"{_SWEEP} {_SCORE} SELECT * FROM sweep",
    "operating_points": f"""{_SWEEP} {_SCORE}
, r AS (SELECT *, row_number() OVER (ORDER BY recall >= 0.95 * (SELECT max(recall) FROM sweep) DESC, precision DESC, recall DESC, threshold DESC) AS a,
   row_number() OVER (ORDER BY f1 DESC, precision DESC, recall DESC, threshold DESC) AS b,
   row_number() OVER (ORDER BY precision >= 0.95 * (SELECT max(precision) FROM sweep) DESC, recall DESC, precision DESC, threshold DESC) AS c FROM sweep)
SELECT o.operating_point, 'VALIDATION_THRESHOLD_CANDIDATE' AS status, r.* EXCLUDE (a, b, c)
FROM r JOIN (VALUES ('high_recall', 'a'), ('balanced', 'b'), ('high_precision', 'c')) o(operating_point, k)
  ON (k = 'a' AND a = 1) OR (k = 'b' AND b = 1) OR (k = 'c' AND c = 1)""",
    "max_pairwise_iou": f"WITH {BOX_SQL} SELECT image_id, coalesce(max(iou), 0) AS max_iou FROM (SELECT DISTINCT image_id FROM box) LEFT JOIN iou USING (image_id) GROUP BY image_id",
    "error_cases": f"{_M} {_CASES} SELECT * FROM cases",
    "error_summary": f"{_M} {_CASES} SELECT source_type, error_type, count(*) AS case_count, count(DISTINCT image_id) AS image_count FROM cases GROUP BY ALL",
    "error_by_size": f"""{_M} {_CASES}, sizes AS (SELECT image_id, object_id, CASE WHEN r <= 0.05 THEN 'small' WHEN r <= 0.15 THEN 'medium' ELSE 'large' END AS bbox_size
  FROM (SELECT *, (x2 - x1) * (y2 - y1) / {CANVAS * CANVAS}::DOUBLE AS r FROM box))
SELECT source_type, error_type, bbox_size, count(*) AS case_count, count(DISTINCT image_id) AS image_count FROM cases JOIN sizes USING (image_id, object_id) GROUP BY ALL""",
    "improvement_priorities": f"""{_M} {_CASES}, rules(issue_category, priority_band, recommended_action, expected_benefit, implementation_effort) AS (VALUES {_values(M.PRIORITIES)}),
n AS (SELECT error_type AS issue_category, count(*) AS affected_case_count, count(DISTINCT image_id) AS affected_image_count FROM cases GROUP BY ALL)
SELECT row_number() OVER (ORDER BY coalesce(priority_band, 'P3'), affected_case_count DESC, issue_category) AS priority_rank, coalesce(priority_band, 'P3') AS priority_band,
  issue_category, affected_case_count, affected_image_count, affected_case_count::DOUBLE / (sum(affected_case_count) OVER ())::DOUBLE AS estimated_error_share,
  coalesce(recommended_action, '{M.OTHER_PRIORITY[1]}') AS recommended_action, coalesce(expected_benefit, 'unknown') AS expected_benefit,
  coalesce(implementation_effort, 'unknown') AS implementation_effort,
  CASE WHEN priority_band = 'P0' THEN 'high' WHEN contains(issue_category, 'localization') THEN 'medium' ELSE 'low' END AS annotation_risk, 'validation_error_cases' AS evidence_source
FROM n LEFT JOIN rules USING (issue_category)""",
    "case_assembly": f"""{_M} {_CASES}, w AS (SELECT DISTINCT image_id FROM cases),
a AS (SELECT w.image_id, (SELECT count(*) FROM gt WHERE gt.image_id = w.image_id) AS gt_count, (SELECT count(*) FROM pred p WHERE p.image_id = w.image_id AND confidence >= {AT}) AS prediction_count,
  coalesce((SELECT max(confidence) FROM pred p WHERE p.image_id = w.image_id), 0) AS max_confidence, coalesce((SELECT max(iou) FROM iou i WHERE i.image_id = w.image_id AND confidence >= {AT}), 0) AS max_iou FROM w),
t AS (SELECT *, concat_ws(chr(31), image_id, gt_count, prediction_count, printf('%.6f', max_confidence), printf('%.6f', max_iou), 'pending') AS shown FROM a),
u AS (SELECT *, 'l_' || substr(sha256(image_id::VARCHAR || upper(sha256(shown))), 1, 16) AS review_case_id FROM t)
SELECT image_id, gt_count, prediction_count, max_confidence, max_iou, review_case_id, upper(sha256(review_case_id || chr(31) || shown)) AS source_fingerprint FROM u""",
    "error_worklist": f"""{_M} {_CASES}, o AS (SELECT *, CASE WHEN error_type = 'no_detection' THEN 1 WHEN error_type = 'low_confidence_miss' THEN 2 WHEN contains(error_type, 'localization') THEN 3 ELSE 4 END AS o FROM cases)
SELECT image_id, arg_min(error_type, struct_pack(o := o, e := error_type)) AS primary_error, array_to_string(list_sort(list(DISTINCT error_type)), '|') AS error_types,
  count(*) FILTER (source_type = 'prediction') AS prediction_errors, count(*) FILTER (source_type = 'ground_truth') AS gt_errors FROM o GROUP BY image_id""",
    "bbox_reasons": f"""WITH {_COCO_SQL} SELECT object_id, array_to_string(list_filter([CASE WHEN y + h > {CANVAS} + 1e-6 THEN 'exceeds_image_height' END, CASE WHEN x + w > {CANVAS} + 1e-6 THEN 'exceeds_image_width' END,
  CASE WHEN x < 0 THEN 'negative_x' END, CASE WHEN y < 0 THEN 'negative_y' END, CASE WHEN h <= 0 THEN 'nonpositive_height' END, CASE WHEN w <= 0 THEN 'nonpositive_width' END], lambda r: r IS NOT NULL), '|') AS reasons,
  CASE WHEN w <= 0 OR h <= 0 THEN 'non_positive_bbox' WHEN x < 0 OR y < 0 THEN 'negative_bbox_origin' WHEN x + w > {CANVAS} + 1e-6 OR y + h > {CANVAS} + 1e-6 THEN 'bbox_out_of_bounds' ELSE 'valid' END AS status FROM coco""",
    "bbox_clip": f"WITH {_COCO_SQL} SELECT object_id, x, y, least(x + w, {CANVAS}::DOUBLE) - x AS new_width, least(y + h, {CANVAS}::DOUBLE) - y AS new_height FROM coco",
    "bbox_ratios": f"WITH {_COCO_SQL} SELECT object_id, w * h / {CANVAS * CANVAS}::DOUBLE AS area_ratio, w / {CANVAS}::DOUBLE AS width_ratio, h / {CANVAS}::DOUBLE AS height_ratio FROM coco",
    "bbox_records": f"""WITH {BOX_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY object_id) AS k FROM box WHERE confidence >= 0.3)
SELECT image_id, count(*) AS n_records, string_agg(concat_ws(':', printf('gt_%03d', k), x1::BIGINT, y1::BIGINT, x2::BIGINT, y2::BIGINT), ';' ORDER BY k) AS records FROM k GROUP BY image_id""",
    "topk_extremes": f"""WITH {BOX_SQL}, a AS (SELECT object_id, (x2 - x1) * (y2 - y1) / {CANVAS * CANVAS}::DOUBLE AS area_ratio FROM box)
(SELECT *, 'smallest' AS side FROM a ORDER BY area_ratio, object_id LIMIT 200) UNION ALL (SELECT *, 'largest' FROM a ORDER BY area_ratio DESC, object_id LIMIT 200)""",
    "category_counts": """SELECT alias, count(p_brand) AS n_rows, count(DISTINCT p_brand) AS n_brands FROM (VALUES ('STANDARD'), ('SMALL'), ('MEDIUM'), ('LARGE'), ('ECONOMY'), ('PROMO'), ('ABSENT')) v(alias)
LEFT JOIN part ON split_part(p_type, ' ', 1) = alias GROUP BY alias""",
    "canonical_categories": "SELECT p_partkey, 0::BIGINT AS category_id, sha1(concat_ws('|', p_partkey, p_name, p_brand, p_size)) AS rest_sha1 FROM part",
}
