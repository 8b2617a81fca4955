"""Queries of review decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from annoforge.operators import checks as C
from annoforge.operators import decisions as D
from annoforge.plans.bindings import BOX_SQL, boxes, table


def _pick(values, k):
    return F.get(F.array(*[F.lit(v) for v in values]), (k % len(values)).cast("int"))


def _case(values, k):
    return f"[{', '.join(repr(v) for v in values)}][({k}) % {len(values)} + 1]"


CATEGORIES = [c for c, _ in D.START_OUTCOMES] + ["something_else"]
GROUPS = ["IN_SCOPE_LIGHT_MODERATE", "OUT_OF_SCOPE_HEAVY", "OUT_OF_SCOPE_CATASTROPHIC"]
REASONS = ["light_surface_damage", "structural_damage", "catastrophic_collision", "insufficient_visual_evidence", "other"]
OPERABLE = ["drivable_or_likely_drivable", "uncertain"]
STATUSES = ["reviewed", "pending", "needs_adjudication"]
DECISIONS = ["CONFIRM_GT_CORRECTION_REQUIRED", "REJECT_CORRECTION_KEEP_CURRENT_GT", "NEEDS_ADJUDICATION"]
OPERATIONS = ["RESIZE_OR_REDRAW_BBOX", "REMOVE_DUPLICATE_BBOX", "ADD_MISSING_BBOX", "OTHER", "NOT_APPLICABLE"]
ALIASES = [("general_fleet", "01_general_fleet"), ("claimable", "02_claimable_damage"), ("minor", "03_minor_damage")]
PATHS = ["X\\General_Fleet\\a", "raw/claimable/minor", " Minor ", "elsewhere"]


def outcome_defaults(spark, sf):
    p = table(spark, sf, "part")
    return D.start_selection(p.select("p_partkey", _pick(CATEGORIES, F.col("p_partkey")).alias("error_type")))


def suggested_operations(spark, sf):
    p = table(spark, sf, "part")
    defect = _pick(["wrong_damage_scope", "extra_bbox", "none"], F.col("p_partkey"))
    return p.select("p_partkey", D.suggested_operation(defect).alias("operation"))


def scope_decisions(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select("o_orderkey", _pick(GROUPS, k).alias("g"), _pick(REASONS, k).alias("r"), _pick(OPERABLE, k).alias("o"), _pick(["high", "low"], F.floor(k / 2)).alias("c"), F.when(k % 7 < 4, "why").otherwise(" ").alias("n"), _pick(STATUSES, F.floor(k / 3)).alias("s"))
    return rows.select("o_orderkey", D.scope_code(*[F.col(c) for c in "grocns"]).alias("code"))


def _corrections(spark, sf):
    k = F.col("o_orderkey")
    box = F.struct(*[v.cast("double").alias(n) for n, v in (("x1", k % 50), ("y1", k % 40), ("x2", k % 50 + 20), ("y2", k % 40 + k % 30))])
    targets = F.when(k % 4 == 0, F.array(F.lit("gt_001"))).when(k % 4 == 1, F.array(F.lit("gt_001"), F.lit("gt_002"))).when(k % 29 == 5, F.array(F.lit("gt_009"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf, "orders").select(
        "o_orderkey", _pick(STATUSES, F.floor(k / 2)).alias("status"), _pick(DECISIONS, F.floor(k / 3)).alias("decision"), _pick(OPERATIONS, k).alias("operation"), targets.alias("targets"), F.when(k % 3 != 0, box).alias("box"),
        F.when(k % 11 == 0, "").otherwise("why").alias("reason"), F.array(F.lit("gt_001"), F.lit("gt_002")).alias("known"),
    )


def _code():
    return D.correction_code(*[F.col(c) for c in ("status", "decision", "operation", "targets", "box", "reason", "known")], F.lit(60.0), F.lit(60.0))


def correction_decisions(spark, sf):
    return _corrections(spark, sf).select("o_orderkey", _code().alias("code"))


def corrected_boxes(spark, sf):
    """Boxes after the valid corrections, one row per box."""
    start = F.array(*[F.struct(F.lit(i).alias("bbox_id"), *[F.lit(v).alias(n) for n, v in (("x1", 0.0), ("y1", 0.0), ("x2", s), ("y2", s))]) for i, s in (("gt_001", 5.0), ("gt_002", 6.0))])
    rows = _corrections(spark, sf).where((_code() == "") & (F.col("decision") == DECISIONS[0]) & (F.col("status") == "reviewed"))
    return rows.select("o_orderkey", F.inline(D.corrected(start, F.col("decision"), F.col("operation"), F.col("targets"), F.col("box"))))


def review_semantics(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        (k + 2).alias("row_number"), F.when(k % 9 == 0, "pending").otherwise("reviewed").alias("review_status"), _pick(["correct", "defect_suspected"], k).alias("annotation_quality"), _pick(["none", "missing_bbox", ""], k).alias("annotation_defect_type"),
        _pick(["no", "yes"], F.floor(k / 2)).alias("correction_proposal_required"), _pick(["create_annotation_correction_proposal", "no_action"], F.floor(k / 4)).alias("recommended_action"), _pick(["high", "low"], F.floor(k / 8)).alias("retraining_priority"),
        _pick(["note", ""], F.floor(k / 16)).alias("review_notes"), _pick(["ann", "", "bob"], k).alias("reviewer"), _pick(["2026-01-02T03:04:05Z", "2026-01-02T03:04:05", "2026-01-02T03:04:05+00:00"], F.floor(k / 3)).alias("reviewed_at_utc"),
    )
    return C.rule_errors(rows, D.semantic_rules()).select("row_number", "column", "code")


def prelabel_rules(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select("p_partkey", _pick(["exterior", "interior"], k).alias("photo"), ((k % 10).cast("double") / 10).alias("photo_conf"), F.lit("front").alias("angle"), F.lit(0.3).alias("angle_conf"), F.lit("1").alias("damage"), ((k % 7).cast("double") / 10).alias("damage_conf"), _pick(["ready", " BAD", "unreadable"], k).alias("quality_status"))
    return D.prelabel(rows).drop("quality_status")


def source_aliases(spark, sf):
    return table(spark, sf, "part").select("p_partkey", D.source_alias(_pick(PATHS, F.col("p_partkey")), ALIASES).alias("bucket"))


def damage_comparison(spark, sf):
    """Extension: lines of even number are the earlier image, the others the later one."""
    rows = boxes(spark, sf)
    return D.compare_damage(rows.where("n % 2 = 0"), rows.where("n % 2 = 1"), "image_id")


QUERIES = {f.__name__: f for f in (outcome_defaults, suggested_operations, scope_decisions, correction_decisions, corrected_boxes, review_semantics, prelabel_rules, source_aliases, damage_comparison)}

_DEFAULTS = ", ".join(str(r) for r in D.OUTCOME_DEFAULTS)
_STARTS = ", ".join(str(r) for r in D.START_OUTCOMES)
_CORRECTION = f"""
c AS (SELECT o_orderkey AS k, {_case(STATUSES, "o_orderkey // 2")} AS status, {_case(DECISIONS, "o_orderkey // 3")} AS decision, {_case(OPERATIONS, "o_orderkey")} AS op,
  CASE WHEN o_orderkey % 4 = 0 THEN ['gt_001'] WHEN o_orderkey % 4 = 1 THEN ['gt_001', 'gt_002'] WHEN o_orderkey % 29 = 5 THEN ['gt_009'] ELSE []::VARCHAR[] END AS t,
  o_orderkey % 3 <> 0 AS box, (o_orderkey % 50)::DOUBLE AS x1, (o_orderkey % 40)::DOUBLE AS y1, (o_orderkey % 50 + 20)::DOUBLE AS x2, (o_orderkey % 40 + o_orderkey % 30)::DOUBLE AS y2, o_orderkey % 11 = 0 AS blank FROM orders),
d AS (SELECT *, len(t) > 0 AS hit, box AND NOT (y2 > y1 AND x2 <= 60 AND y2 <= 60) AS badbox FROM c),
e AS (SELECT *, CASE WHEN list_contains(t, 'gt_009') THEN 'unknown_target'
  WHEN status = 'pending' THEN CASE WHEN decision <> 'NEEDS_ADJUDICATION' OR op <> 'NOT_APPLICABLE' THEN 'pending_decided' WHEN hit OR box OR NOT blank THEN 'pending_with_content' ELSE '' END
  WHEN blank THEN 'reason_required'
  WHEN decision = 'NEEDS_ADJUDICATION' THEN CASE WHEN status <> 'needs_adjudication' THEN 'adjudication_status' WHEN op <> 'NOT_APPLICABLE' OR hit OR box THEN 'adjudication_with_content' ELSE '' END
  WHEN status <> 'reviewed' THEN 'final_needs_reviewed'
  WHEN decision = 'REJECT_CORRECTION_KEEP_CURRENT_GT' THEN CASE WHEN op <> 'NOT_APPLICABLE' THEN 'reject_with_operation' WHEN hit OR box THEN 'reject_with_content' ELSE '' END
  WHEN op = 'NOT_APPLICABLE' THEN 'confirm_needs_operation'
  WHEN op = 'REMOVE_DUPLICATE_BBOX' THEN CASE WHEN NOT hit THEN 'remove_needs_target' WHEN box THEN 'remove_with_box' ELSE '' END
  WHEN op = 'RESIZE_OR_REDRAW_BBOX' AND len(t) <> 1 THEN 'redraw_needs_one_target' WHEN op = 'ADD_MISSING_BBOX' AND hit THEN 'add_with_target'
  WHEN op <> 'OTHER' AND NOT box THEN 'box_required' WHEN badbox THEN 'box_out_of_bounds' ELSE '' END AS code FROM d)"""

ORACLES = {
    "outcome_defaults": f"""WITH p AS (SELECT p_partkey, {_case(CATEGORIES, "p_partkey")} AS error_type FROM part), s(error_type, outcome) AS (VALUES {_STARTS}),
x(outcome, error_disposition, primary_root_cause, recommended_action, annotation_quality, retraining_priority) AS (VALUES {_DEFAULTS})
SELECT p_partkey, error_type, x.* FROM p LEFT JOIN s USING (error_type) JOIN x ON x.outcome = coalesce(s.outcome, 'model_miss')""",
    "suggested_operations": "SELECT p_partkey, ['RESIZE_OR_REDRAW_BBOX', 'REMOVE_DUPLICATE_BBOX', 'NOT_APPLICABLE'][p_partkey % 3 + 1] AS operation FROM part",
    "scope_decisions": f"""WITH s AS (SELECT o_orderkey, {_case(GROUPS, "o_orderkey")} AS g, {_case(REASONS, "o_orderkey")} AS r, {_case(OPERABLE, "o_orderkey")} AS o, {_case(["high", "low"], "o_orderkey // 2")} AS c, o_orderkey % 7 >= 4 AS blank, {_case(STATUSES, "o_orderkey // 3")} AS s FROM orders)
SELECT o_orderkey, CASE WHEN blank AND (s = 'needs_adjudication' OR c = 'low' OR r IN ('other', 'insufficient_visual_evidence') OR (g = 'OUT_OF_SCOPE_CATASTROPHIC' AND o = 'drivable_or_likely_drivable')) THEN 'notes_required'
  WHEN g = 'OUT_OF_SCOPE_CATASTROPHIC' AND r NOT IN ('structural_damage', 'catastrophic_collision') THEN 'catastrophic_reason_required' WHEN g = 'IN_SCOPE_LIGHT_MODERATE' AND r = 'catastrophic_collision' THEN 'reason_out_of_scope'
  WHEN r = 'insufficient_visual_evidence' AND c <> 'low' THEN 'low_confidence_required' ELSE '' END AS code FROM s""",
    "correction_decisions": f"WITH {_CORRECTION} SELECT k AS o_orderkey, code FROM e",
    "corrected_boxes": f"""WITH {_CORRECTION}, g(bbox_id, s) AS (VALUES ('gt_001', 5.0::DOUBLE), ('gt_002', 6.0::DOUBLE)), v AS (SELECT * FROM e WHERE code = '' AND status = 'reviewed' AND decision = 'CONFIRM_GT_CORRECTION_REQUIRED')
SELECT k AS o_orderkey, bbox_id, CASE WHEN n THEN x1 ELSE 0 END AS x1, CASE WHEN n THEN y1 ELSE 0 END AS y1, CASE WHEN n THEN x2 ELSE s END AS x2, CASE WHEN n THEN y2 ELSE s END AS y2
FROM (SELECT v.*, g.*, op = 'RESIZE_OR_REDRAW_BBOX' AND list_contains(t, bbox_id) AS n FROM v CROSS JOIN g) WHERE NOT (op = 'REMOVE_DUPLICATE_BBOX' AND list_contains(t, bbox_id))
UNION ALL SELECT k, 'proposed_001', x1, y1, x2, y2 FROM v WHERE op IN ('ADD_MISSING_BBOX', 'OTHER') AND box""",
    "review_semantics": f"""WITH r AS (SELECT o_orderkey + 2 AS n, o_orderkey % 9 <> 0 AS done, o_orderkey % 2 = 1 AS defect, o_orderkey % 3 <> 1 AS untyped, (o_orderkey // 2) % 2 = 1 AS yes, (o_orderkey // 4) % 2 = 0 AS prop, (o_orderkey // 8) % 2 = 0 AS high, (o_orderkey // 16) % 2 = 1 AS nonote,
  o_orderkey % 3 = 1 AS nobody, (o_orderkey // 3) % 3 = 1 AS badtime FROM orders)
SELECT n AS row_number, u.c AS "column", u.k AS code FROM r, unnest([{{'c': 'review_status', 'k': 'INCOMPLETE_REVIEW', 'w': NOT done}}, {{'c': 'reviewer', 'k': 'MISSING_REVIEW_FIELD', 'w': done AND nobody}}, {{'c': 'reviewed_at_utc', 'k': 'INVALID_REVIEW_TIMESTAMP', 'w': done AND badtime}},
  {{'c': 'correction_proposal_required', 'k': 'CORRECTION_PROPOSAL_REQUIRED', 'w': defect AND NOT yes}}, {{'c': 'recommended_action', 'k': 'CORRECTION_ACTION_REQUIRED', 'w': defect AND NOT prop}}, {{'c': 'annotation_defect_type', 'k': 'CORRECTION_EVIDENCE_REQUIRED', 'w': defect AND (untyped OR nonote)}},
  {{'c': 'correction_proposal_required', 'k': 'CONTRADICTORY_CORRECTION', 'w': NOT defect AND yes}}, {{'c': 'recommended_action', 'k': 'CONTRADICTORY_CORRECTION_ACTION', 'w': NOT defect AND prop}}, {{'c': 'annotation_defect_type', 'k': 'CONTRADICTORY_DEFECT_TYPE', 'w': NOT defect AND NOT untyped}},
  {{'c': 'review_notes', 'k': 'HIGH_PRIORITY_NOTES_REQUIRED', 'w': high AND nonote}}]) AS x(u) WHERE u.w""",
    "prelabel_rules": """WITH p AS (SELECT p_partkey, p_partkey % 3 <> 0 AS bad, p_partkey % 2 = 0 AS ext, (p_partkey % 10)::DOUBLE / 10 AS pc, (p_partkey % 7)::DOUBLE / 10 AS dc FROM part)
SELECT p_partkey, CASE WHEN bad THEN 'low_quality' WHEN ext THEN 'exterior' ELSE 'interior' END AS photo, CASE WHEN bad THEN 1.0::DOUBLE ELSE pc END AS photo_conf, CASE WHEN ext AND NOT bad THEN 'front' ELSE 'unknown' END AS angle, CASE WHEN ext AND NOT bad THEN 0.3::DOUBLE ELSE 1.0 END AS angle_conf,
  CASE WHEN ext AND NOT bad THEN '1' ELSE '0' END AS damage, CASE WHEN ext AND NOT bad THEN dc ELSE greatest(CASE WHEN bad THEN 0 ELSE dc END, 0.5::DOUBLE) END AS damage_conf FROM p""",
    "source_aliases": "SELECT p_partkey, ['01_general_fleet', '02_claimable_damage', '03_minor_damage', 'elsewhere'][p_partkey % 4 + 1] AS bucket FROM part",
    "damage_comparison": f"""WITH {BOX_SQL} SELECT p.image_id, prediction_id AS object_id, coalesce(max(iou), 0) AS best_iou, CASE WHEN coalesce(max(iou), 0) >= 0.2 THEN 'existing_damage' WHEN p.confidence >= 0.4 THEN 'suspected_new_damage' ELSE 'review_required' END AS status
FROM pred p LEFT JOIN iou USING (image_id, prediction_id) GROUP BY p.image_id, prediction_id, p.confidence""",
}
