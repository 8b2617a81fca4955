"""Review decisions: defaults of outcomes, scope and correction rules, semantic checks, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoforge.functions import boxes as B
from annoforge.functions import text as T
from annoforge.operators.checks import error

#: Outcome, error disposition, root cause, action, annotation quality, retraining priority.
OUTCOME_DEFAULTS = [
    ("model_miss", "confirmed_model_error", "missed_small_damage", "add_positive_sample", "correct", "medium"),
    ("model_false_positive", "confirmed_model_error", "background_false_positive", "add_hard_negative", "correct", "medium"),
    ("localization_error", "confirmed_model_error", "localization_error", "adjust_model_strategy", "correct", "medium"),
    ("duplicate_prediction", "confirmed_model_error", "duplicate_prediction", "adjust_model_strategy", "correct", "medium"),
    ("annotation_issue", "annotation_issue", "annotation_missing", "create_annotation_correction_proposal", "defect_suspected", "not_applicable"),
    ("threshold_tradeoff", "expected_threshold_tradeoff", "weak_visual_signal", "threshold_analysis_only", "correct", "low"),
    ("invalid_image", "invalid_review_case", "invalid_or_low_quality_image", "exclude_invalid_image_proposal", "not_applicable", "not_applicable"),
    ("ambiguous", "ambiguous_case", "ambiguous_visual_evidence", "investigate_image_quality", "questionable", "not_applicable"),
]
#: Automatic categories and the outcome that a review starts from; any other starts from model_miss.
START_OUTCOMES = [
    ("false_negative", "model_miss"),
    ("missed_prediction", "model_miss"),
    ("ground_truth_error", "model_miss"),
    ("false_positive", "model_false_positive"),
    ("background_false_positive", "model_false_positive"),
    ("prediction_error", "model_false_positive"),
    ("localization_error", "localization_error"),
    ("duplicate_prediction", "duplicate_prediction"),
    ("annotation_issue", "annotation_issue"),
]
#: Scope reasons that an out-of-scope decision may have.
CATASTROPHIC = ["structural_damage", "catastrophic_collision", "extensive_multi_panel_damage", "vehicle_integrity_compromised"]
#: Correction operations suggested by defect type.
SUGGESTED_OPERATIONS = [("wrong_damage_scope", "RESIZE_OR_REDRAW_BBOX"), ("extra_bbox", "REMOVE_DUPLICATE_BBOX")]


def start_selection(cases: DataFrame, category: str = "error_type") -> DataFrame:
    """Cases with the outcome their category starts from and that outcome's defaults."""
    spark = cases.sparkSession
    starts = spark.createDataFrame(START_OUTCOMES, f"{category} string, outcome string")
    defaults = spark.createDataFrame(OUTCOME_DEFAULTS, "outcome string, error_disposition string, primary_root_cause string, recommended_action string, annotation_quality string, retraining_priority string")
    out = cases.join(F.broadcast(starts), category, "left").withColumn("outcome", F.coalesce("outcome", F.lit("model_miss")))
    return out.join(F.broadcast(defaults), "outcome")


#: Notes and defect type that a draft of these outcomes starts with; others start with no note and none.
START_NOTES = {"ambiguous": "需要進一步人工判斷。", "annotation_issue": "明確懷疑原始標註有缺陷，僅提出修正建議。"}
START_DEFECTS = {"annotation_issue": "missing_bbox"}


def start_note(outcome: Column) -> Column:
    out = F.lit("")
    for name, note in START_NOTES.items():
        out = F.when(outcome == name, note).otherwise(out)
    return out


def start_defect(outcome: Column) -> Column:
    out = F.lit("none")
    for name, defect in START_DEFECTS.items():
        out = F.when(outcome == name, defect).otherwise(out)
    return out


def correction_fields(code: Column, status: Column, decision: Column, operation: Column, targets: Column, replacement: Column, reason: Column, reviewer: Column, at: Column) -> Column:
    """Canonical fields of a valid correction (code of correction_code is empty) by a named reviewer at an instant
    with offset, targets as sorted JSON and the box as JSON or a blank; null for any other."""
    good = (code == "") & (T.stripped(reviewer) != "") & T.instant(at, "required").isNotNull()
    box = F.when(replacement.isNull(), "").otherwise(T.canonical_json(**{c: replacement[c] for c in ("x1", "y1", "x2", "y2")}))
    fields = F.struct(
        T.stripped(status).alias("correction_review_status"), T.stripped(decision).alias("correction_decision"), T.stripped(operation).alias("correction_operation"),
        F.to_json(F.array_sort(targets)).alias("target_gt_bbox_ids_json"), box.alias("replacement_bbox_coordinates_json"), T.stripped(reason).alias("correction_reason"),
        T.stripped(reviewer).alias("correction_reviewer"), at.alias("correction_reviewed_at_utc"),
    )
    return F.when(good, fields)


def suggested_operation(defect: Column) -> Column:
    out = F.lit("NOT_APPLICABLE")
    for kind, operation in SUGGESTED_OPERATIONS:
        out = F.when(defect == kind, operation).otherwise(out)
    return out


def scope_code(group: Column, reason: Column, operability: Column, confidence: Column, notes: Column, status: Column) -> Column:
    """Code of the first scope rule that a decision breaks; empty if it is valid."""
    out_of = group == "OUT_OF_SCOPE_CATASTROPHIC"
    needs = (status == "needs_adjudication") | (confidence == "low") | reason.isin("other", "insufficient_visual_evidence") | (out_of & (operability == "drivable_or_likely_drivable"))
    return (
        F.when(needs & (T.stripped(notes) == ""), "notes_required")
        .when(out_of & ~reason.isin(*CATASTROPHIC), "catastrophic_reason_required")
        .when((group == "IN_SCOPE_LIGHT_MODERATE") & reason.isin("catastrophic_collision", "vehicle_integrity_compromised"), "reason_out_of_scope")
        .when((reason == "insufficient_visual_evidence") & (confidence != "low"), "low_confidence_required")
        .otherwise("")
    )


def correction_code(status: Column, decision: Column, operation: Column, targets: Column, replacement: Column, reason: Column, known: Column, width: Column, height: Column) -> Column:
    """Code of the first correction rule that a decision breaks; targets and known are arrays of box ids."""
    some, none, box = F.size(targets) > 0, F.size(targets) == 0, replacement.isNotNull()
    blank = T.stripped(reason) == ""
    good = (replacement["x1"] >= 0) & (replacement["y1"] >= 0) & (replacement["x2"] > replacement["x1"]) & (replacement["y2"] > replacement["y1"]) & (replacement["x2"] <= width) & (replacement["y2"] <= height)
    bad_box = box & ~good
    remove = operation.isin("REMOVE_DUPLICATE_BBOX", "REMOVE_INVALID_BBOX")
    return (
        F.when(F.size(F.array_except(targets, known)) > 0, "unknown_target")
        .when((status == "pending") & ((decision != "NEEDS_ADJUDICATION") | (operation != "NOT_APPLICABLE")), "pending_decided")
        .when((status == "pending") & (some | box | ~blank), "pending_with_content")
        .when(status == "pending", "")
        .when(blank, "reason_required")
        .when((decision == "NEEDS_ADJUDICATION") & (status != "needs_adjudication"), "adjudication_status")
        .when((decision == "NEEDS_ADJUDICATION") & ((operation != "NOT_APPLICABLE") | some | box), "adjudication_with_content")
        .when(decision == "NEEDS_ADJUDICATION", "")
        .when(status != "reviewed", "final_needs_reviewed")
        .when((decision == "REJECT_CORRECTION_KEEP_CURRENT_GT") & (operation != "NOT_APPLICABLE"), "reject_with_operation")
        .when((decision == "REJECT_CORRECTION_KEEP_CURRENT_GT") & (some | box), "reject_with_content")
        .when(decision == "REJECT_CORRECTION_KEEP_CURRENT_GT", "")
        .when(operation == "NOT_APPLICABLE", "confirm_needs_operation")
        .when(remove & none, "remove_needs_target")
        .when(remove & box, "remove_with_box")
        .when((operation == "RESIZE_OR_REDRAW_BBOX") & (F.size(targets) != 1), "redraw_needs_one_target")
        .when((operation == "ADD_MISSING_BBOX") & some, "add_with_target")
        .when(operation.isin("RESIZE_OR_REDRAW_BBOX", "ADD_MISSING_BBOX") & ~box, "box_required")
        .when(~remove & bad_box, "box_out_of_bounds")
        .otherwise("")
    )


def corrected(boxes: Column, decision: Column, operation: Column, targets: Column, replacement: Column) -> Column:
    """An array of boxes (bbox_id, x1, y1, x2, y2) after a valid decision."""

    def renewed(b: Column) -> Column:
        return F.struct(b["bbox_id"].alias("bbox_id"), *[replacement[c].alias(c) for c in ("x1", "y1", "x2", "y2")])

    def added(name: Column) -> Column:
        return F.array_append(boxes, F.struct(name.alias("bbox_id"), *[replacement[c].alias(c) for c in ("x1", "y1", "x2", "y2")]))

    proposed = F.size(F.filter(boxes, lambda b: b["bbox_id"].startswith("proposed_")))
    return (
        F.when(decision != "CONFIRM_GT_CORRECTION_REQUIRED", boxes)
        .when(operation.isin("REMOVE_DUPLICATE_BBOX", "REMOVE_INVALID_BBOX"), F.filter(boxes, lambda b: ~F.array_contains(targets, b["bbox_id"])))
        .when(operation == "RESIZE_OR_REDRAW_BBOX", F.transform(boxes, lambda b: F.when(F.array_contains(targets, b["bbox_id"]), renewed(b)).otherwise(b)))
        .when(operation == "ADD_MISSING_BBOX", added(F.format_string("proposed_%03d", proposed + 1)))
        .when((operation == "OTHER") & replacement.isNotNull(), added(F.lit("proposed_001")))
        .otherwise(boxes)
    )


def semantic_rules() -> list[tuple[Column, Column]]:
    """Rules of completed error reviews, for checks.rule_errors."""
    c = {n: F.coalesce(F.col(n), F.lit("")) for n in ("review_status", "annotation_quality", "annotation_defect_type", "correction_proposal_required", "recommended_action", "retraining_priority", "review_notes", "reviewer", "reviewed_at_utc")}
    defect, proposal = c["annotation_quality"] == "defect_suspected", c["recommended_action"] == "create_annotation_correction_proposal"
    untyped = c["annotation_defect_type"].isin("", "none")
    rules = [
        (c["review_status"] != "reviewed", "review_status", "INCOMPLETE_REVIEW"),
        ((c["review_status"] == "reviewed") & (c["reviewer"] == ""), "reviewer", "MISSING_REVIEW_FIELD"),
        ((c["review_status"] == "reviewed") & (c["reviewed_at_utc"] != "") & T.instant(c["reviewed_at_utc"], "required").isNull(), "reviewed_at_utc", "INVALID_REVIEW_TIMESTAMP"),
        (defect & (c["correction_proposal_required"] != "yes"), "correction_proposal_required", "CORRECTION_PROPOSAL_REQUIRED"),
        (defect & ~proposal, "recommended_action", "CORRECTION_ACTION_REQUIRED"),
        (defect & (untyped | (c["review_notes"] == "")), "annotation_defect_type", "CORRECTION_EVIDENCE_REQUIRED"),
        (~defect & (c["correction_proposal_required"] == "yes"), "correction_proposal_required", "CONTRADICTORY_CORRECTION"),
        (~defect & proposal, "recommended_action", "CONTRADICTORY_CORRECTION_ACTION"),
        (~defect & ~untyped, "annotation_defect_type", "CONTRADICTORY_DEFECT_TYPE"),
        ((c["retraining_priority"] == "high") & (c["review_notes"] == ""), "review_notes", "HIGH_PRIORITY_NOTES_REQUIRED"),
    ]
    return [(broken, error(column, c[column], code, code.lower().replace("_", " "))) for broken, column, code in rules]  # codes are fixed values


def prelabel(predictions: DataFrame) -> DataFrame:
    """Zero-shot labels after the overrides of bad images and of anything but exteriors."""
    bad = T.lowered(F.col("quality_status")).isin("low_quality", "unreadable", "bad")
    rows = predictions.withColumns({"photo": F.when(bad, "low_quality").otherwise(F.col("photo")), "photo_conf": F.when(bad, 1.0).otherwise(F.col("photo_conf")), "damage_conf": F.when(bad, 0.0).otherwise(F.col("damage_conf"))})
    other = F.col("photo") != "exterior"
    return rows.withColumns(
        {
            "angle": F.when(other, "unknown").otherwise(F.col("angle")),
            "angle_conf": F.when(other, 1.0).otherwise(F.col("angle_conf")),
            "damage": F.when(other, "0").otherwise(F.col("damage")),
            "damage_conf": F.when(other, F.greatest(F.col("damage_conf"), F.lit(0.5))).otherwise(F.col("damage_conf")),
        }
    )


def source_alias(text: Column, aliases: list[tuple[str, str]]) -> Column:
    """Name of the first alias, in the given order, that a normalised text holds; else the text."""
    low = F.translate(T.lowered(text), "\\", "/")
    out = low
    for part, name in reversed(aliases):
        out = F.when(F.contains(low, F.lit(part)), name).otherwise(out)
    return out


def compare_damage(before: DataFrame, after: DataFrame, key: str, match_iou: float = 0.2, confidence: float = 0.4) -> DataFrame:
    """Extension, described without code: what each later image shows against the earlier one of its key."""
    pairs = after.join(before.select(key, F.col("box").alias("_old")), key, "left")
    best = pairs.groupBy(key, "object_id", "confidence").agg(F.max(F.coalesce(B.iou("box", "_old"), F.lit(0.0))).alias("best_iou"))
    kind = F.when(F.col("best_iou") >= match_iou, "existing_damage").when(F.col("confidence") >= confidence, "suspected_new_damage").otherwise("review_required")
    return best.select(key, "object_id", "best_iou", kind.alias("status"))
