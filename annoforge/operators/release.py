"""Gates and the filled table of completed-review exports, and checks of what a release is built from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoforge.functions import text as T
from annoforge.operators.checks import error, rule_errors
from annoforge.operators.decisions import CATASTROPHIC

#: Columns and options of a scope review.
SCOPE_OPTIONS = {
    "scope_review_status": ["pending", "reviewed", "needs_adjudication"],
    "scope_group": ["", "IN_SCOPE_LIGHT_MODERATE", "OUT_OF_SCOPE_HEAVY", "OUT_OF_SCOPE_CATASTROPHIC"],
    "scope_reason": ["", "light_surface_damage", "insufficient_visual_evidence", "other", *CATASTROPHIC],
    "operability": ["", "drivable_or_likely_drivable", "uncertain", "not_drivable"],
    "scope_confidence": ["", "high", "medium", "low"],
}
#: Columns that a reviewed row must fill.
SCOPE_REQUIRED = ["scope_group", "scope_reason", "operability", "scope_confidence", "scope_reviewer", "scope_reviewed_at_utc"]


def completeness(rows: DataFrame, status: str = "review_status") -> DataFrame:
    """One row: how many are reviewed, pending and to be adjudicated, and whether all are reviewed."""
    s = F.coalesce(F.col(status), F.lit(""))
    counts = {n: F.count_if(s == n).alias(n) for n in ("reviewed", "pending", "needs_adjudication")}
    out = rows.agg(F.count("*").alias("total"), *counts.values())
    return out.withColumn("complete", (F.col("reviewed") == F.col("total")) & (F.col("pending") == 0) & (F.col("needs_adjudication") == 0))


def filled(source: DataFrame, stored: DataFrame, key: str, human: list[str]) -> DataFrame:
    """source with its human columns taken from the stored reviews; all other columns as they are.

    Keys of the reviews must not repeat: export_errors is the gate before it."""
    new = stored.select(key, F.struct(*human).alias("_stored"))
    rows = source.join(new, key, "left")
    return rows.select(*[F.col(f"_stored.{c}").alias(c) if c in human else F.col(c) for c in source.columns])


def export_errors(source: DataFrame, stored: DataFrame, key: str, status: str = "review_status") -> DataFrame:
    """(code, n) of all that forbids an export: blank or repeated keys of the source, repeated keys of the reviews, keys of
    one side only, reviews not final."""
    k = T.stripped(F.col(key))
    blank = source.agg(F.count_if(k == "").alias("n")).select(F.lit("blank_key").alias("code"), "n")
    twice = source.where(k != "").groupBy(key).count().where("count > 1").agg(F.count("*").alias("n")).select(F.lit("duplicate_key").alias("code"), "n")
    again = stored.groupBy(key).count().where("count > 1").agg(F.count("*").alias("n")).select(F.lit("duplicate_review").alias("code"), "n")
    missing = source.where(k != "").select(key).distinct().join(stored, key, "left_anti").agg(F.count("*").alias("n")).select(F.lit("review_missing").alias("code"), "n")
    unknown = stored.select(key).distinct().join(source, key, "left_anti").agg(F.count("*").alias("n")).select(F.lit("case_unknown").alias("code"), "n")
    open_ = stored.agg(F.count_if(F.coalesce(F.col(status), F.lit("")) != "reviewed").alias("n")).select(F.lit("not_reviewed").alias("code"), "n")
    return reduce(DataFrame.unionByName, [blank, twice, again, missing, unknown, open_]).where("n > 0")


def pin_errors(found: DataFrame, pins: DataFrame, key: str = "path", digest: str = "sha256") -> DataFrame:
    """(key, state) of pinned files that are missing or whose digest is another one; digests compare in any case."""
    both = pins.select(key, F.upper(digest).alias("_pin")).join(found.select(key, F.upper(digest).alias("_own"), F.lit(True).alias("_hit")), key, "left")
    state = F.when(F.col("_hit").isNull(), "missing").when(~F.col("_own").eqNullSafe(F.col("_pin")), "changed")
    return both.select(key, state.alias("state")).where("state is not null")


def identity_errors(stored: DataFrame, expected: DataFrame) -> DataFrame:
    """(key, stored, expected) where two key-value identities differ; a key of one side only has a null on the other."""
    both = stored.select("key", F.col("value").alias("stored")).join(expected.select("key", F.col("value").alias("expected")), "key", "full")
    return both.where(~F.col("stored").eqNullSafe(F.col("expected")))


def case_list_errors(stored: DataFrame, expected: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, state) of cases that only one side has, or whose place or source differ: missing, unknown, changed."""
    a = stored.select(key, F.struct(*columns).alias("_stored"))
    b = expected.select(key, F.struct(*columns).alias("_expected"))
    both = a.join(b, key, "full")
    state = F.when(F.col("_stored").isNull(), "missing").when(F.col("_expected").isNull(), "unknown").when(~F.col("_stored").eqNullSafe(F.col("_expected")), "changed")
    return both.select(key, state.alias("state")).where("state is not null")


def scope_rules() -> list[tuple[Column, Column]]:
    """Rules of completed scope reviews, for checks.rule_errors."""
    names = [*SCOPE_OPTIONS, "scope_reviewer", "scope_reviewed_at_utc", "scope_reviewer_notes"]
    c = {n: T.stripped(F.col(n)) for n in names}
    done, notes = c["scope_review_status"] == "reviewed", c["scope_reviewer_notes"]
    group, reason, low = c["scope_group"], c["scope_reason"], c["scope_confidence"] == "low"
    out_of = group == "OUT_OF_SCOPE_CATASTROPHIC"
    rules = [(~c[n].isin(*options), n, "INVALID_SCOPE_CONTROLLED_VALUE", "value is not approved") for n, options in SCOPE_OPTIONS.items()]
    rules.append((~done, "scope_review_status", "INCOMPLETE_SCOPE_REVIEW", "review is not complete"))
    rules += [(done & (c[n] == ""), n, "MISSING_SCOPE_FIELD", "value is required") for n in SCOPE_REQUIRED]
    at = c["scope_reviewed_at_utc"]
    rules += [
        (done & (at != "") & T.instant(at, "required").isNull(), "scope_reviewed_at_utc", "INVALID_SCOPE_TIMESTAMP", "an ISO 8601 instant with offset is required"),
        (low & (notes == ""), "scope_reviewer_notes", "LOW_SCOPE_CONFIDENCE_NOTES_REQUIRED", "low confidence requires notes"),
        ((reason == "other") & (notes == ""), "scope_reviewer_notes", "OTHER_SCOPE_REASON_NOTES_REQUIRED", "other reason requires notes"),
        (out_of & ~reason.isin(*CATASTROPHIC), "scope_reason", "CATASTROPHIC_REASON_REQUIRED", "an approved catastrophic reason is required"),
        (out_of & (c["operability"] == "drivable_or_likely_drivable") & (notes == ""), "scope_reviewer_notes", "CATASTROPHIC_DRIVABLE_NOTES_REQUIRED", "catastrophic and drivable requires notes"),
        ((group == "IN_SCOPE_LIGHT_MODERATE") & reason.isin("catastrophic_collision", "vehicle_integrity_compromised"), "scope_reason", "IN_SCOPE_CATASTROPHIC_REASON_FORBIDDEN", "in-scope rows cannot use catastrophic reasons"),
        ((reason == "insufficient_visual_evidence") & (~low | (notes == "")), "scope_reason", "INSUFFICIENT_EVIDENCE_CONTRACT_VIOLATION", "insufficient evidence requires low confidence and notes"),
    ]
    return [(broken, error(column, c[column], code, message)) for broken, column, code, message in rules]


def scope_errors(rows: DataFrame, source: DataFrame, key: str, columns: list[str], expected: int, number: str = "row_number") -> DataFrame:
    """All faults of a scope review against its source: rules by row, fields changed by place, keys, order and counts."""
    found = rule_errors(rows, scope_rules(), number)
    pairs = rows.select(number, F.struct(key, *columns).alias("_new")).join(source.select(number, F.struct(key, *columns).alias("_old")), number)
    fields = [F.when(~F.col(f"_new.{c}").eqNullSafe(F.col(f"_old.{c}")), error(c, F.col(f"_new.{c}"), "SCOPE_SOURCE_FIELD_CHANGED", "immutable source field changed")) for c in columns]
    changed = pairs.select(F.col(number).cast("bigint").alias("row_number"), F.explode(F.array_compact(F.array(*fields))).alias("e")).select("row_number", "e.*")
    ids = rows.agg(F.count("*").alias("n"), F.count_distinct(key).alias("d"), F.count_if(T.stripped(F.col(key)) == "").alias("b"))
    moved = rows.select(number, key).join(source.select(number, F.col(key).alias("_key")), number, "full").agg(F.count_if(~F.col(key).eqNullSafe(F.col("_key"))).alias("m"))
    facts = ids.crossJoin(moved).crossJoin(source.agg(F.count("*").alias("s")))
    whole = [
        (F.col("n") != expected, error("", F.col("n"), "SCOPE_ROW_COUNT_MISMATCH", "row count is not the expected one")),
        (F.col("s") != expected, error("", F.col("s"), "SCOPE_SOURCE_ROW_COUNT_MISMATCH", "source row count changed")),
        ((F.col("b") > 0) | (F.col("d") != F.col("n")), error(key, F.col("d"), "SCOPE_IDENTITY_INVALID", "keys must be unique and not blank")),
        (F.col("m") > 0, error(key, F.col("m"), "SCOPE_ROW_ORDER_CHANGED", "order of keys changed")),
    ]
    return found.unionByName(changed).unionByName(rule_errors(facts.withColumn("_row", F.lit(0)), whole, "_row"))


#: Annotation qualities and priorities that an outcome allows; others allow the last entry's.
QUALITY_OPTIONS = {"annotation_issue": ["defect_suspected"], "invalid_image": ["not_applicable"], "ambiguous": ["questionable", "not_applicable"], "": ["correct", "questionable", "not_applicable"]}
PRIORITY_OPTIONS = {"annotation_issue": ["not_applicable"], "invalid_image": ["not_applicable"], "ambiguous": ["not_applicable"], "threshold_tradeoff": ["low", "not_applicable"], "": ["low", "medium", "high"]}


def options(outcome: Column, table: dict[str, list[str]]) -> Column:
    """What an outcome allows, as an array."""
    out = F.array(*map(F.lit, table[""]))
    for name, values in table.items():
        if name:
            out = F.when(outcome == name, F.array(*map(F.lit, values))).otherwise(out)
    return out


def shown_fields(outcome: Column, reason: Column, quality: Column, action: Column, priority: Column) -> Column:
    """The fields that a draft must show, sorted."""
    always = [F.lit(c) for c in ("annotation_quality", "reason", "recommended_action", "retraining_priority")]
    defect = F.when((outcome == "annotation_issue") | (quality == "defect_suspected"), "annotation_defect_type")
    notes = F.when(outcome.isin("annotation_issue", "ambiguous") | (priority == "high") | (reason == "other") | (action == "other"), "review_notes")
    return F.array_sort(F.array_compact(F.array(*always, defect, notes)))


#: Columns of a pilot worklist after those of its seed.
SEED = ["photo_type_review", "angle_review", "is_exterior_review", "has_visible_damage_review", "severity_review", "review_status", "reviewer", "review_notes"]
CARRIED = ["review_id", "image_id", "source_bucket", "original_path", "filename", "suggested_photo_type_review", "photo_type_confidence", "suggested_angle_review", "angle_confidence", "auto_review_notes"]


def pilot_worklist(rows: DataFrame, prefill: bool = False, status: str = "pending", seed_reviewer: bool = False) -> DataFrame:
    """27 text columns of a pilot review: what is carried, the seed's fields, and fields for people, blank or prefilled."""
    out = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in CARRIED], *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"seed_{c}") for c in SEED])
    blank = F.lit("")
    human = {f"human_{c}": F.col(f"seed_{c}") if prefill else blank for c in SEED[:5]}
    human |= {"human_review_status": F.lit(status), "human_reviewer": F.col("seed_reviewer") if seed_reviewer else blank, "human_reviewed_at": blank, "human_review_notes": blank}
    return out.select("*", *[c.alias(n) for n, c in human.items()])


def worklist_errors(rows: DataFrame, expected: int, keys: list[str]) -> DataFrame:
    """(code, column, n) of what a worklist breaks: its row count, blank and repeated keys."""
    parts = [rows.agg(F.count("*").alias("n")).where(F.col("n") != expected).select(F.lit("row_count").alias("code"), F.lit("").alias("column"), "n")]
    for k in keys:
        parts.append(rows.agg(F.count_if(T.stripped(F.col(k)) == "").alias("n")).where("n > 0").select(F.lit("blank").alias("code"), F.lit(k).alias("column"), "n"))
        parts.append(rows.groupBy(k).count().agg(F.sum(F.col("count") - 1).alias("n")).where("n > 0").select(F.lit("duplicate").alias("code"), F.lit(k).alias("column"), "n"))
    return reduce(DataFrame.unionByName, parts)


def manifest_errors(rows: DataFrame, key: str, required: list[str], name: str, extensions: list[str]) -> DataFrame:
    """(code, value, n) of an image manifest: blank cells by column, extensions beyond the list, repeated keys."""
    parts = [rows.agg(F.count_if(T.stripped(F.col(c)) == "").alias("n")).where("n > 0").select(F.lit("blank").alias("code"), F.lit(c).alias("value"), "n") for c in required]
    parts.append(rows.groupBy(T.suffix(F.col(name)).alias("value")).agg(F.count("*").alias("n")).where(~F.col("value").isin(*extensions)).select(F.lit("extension").alias("code"), "value", "n"))
    parts.append(rows.groupBy(key).count().agg(F.sum(F.col("count") - 1).alias("n")).where("n > 0").select(F.lit("duplicate").alias("code"), F.lit(key).alias("value"), "n"))
    return reduce(DataFrame.unionByName, parts)


def distinct_equal(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    """One row: whether the column's distinct values are exactly these, and how many are unexpected or missing."""
    expected = rows.sparkSession.createDataFrame([(v,) for v in sorted(set(values))], f"{column} string").withColumn("_e", F.lit(1))
    found = rows.groupBy(F.col(column).cast("string").alias(column)).agg(F.lit(1).alias("_f"))
    both = found.join(F.broadcast(expected), found[column].eqNullSafe(expected[column]), "full")
    return both.agg(F.count_if(F.col("_e").isNull()).alias("unexpected"), F.count_if(F.col("_f").isNull()).alias("missing")).withColumn("equal", (F.col("unexpected") == 0) & (F.col("missing") == 0))


def merge_summary(source: DataFrame, assignments: DataFrame, merged: DataFrame, errors: DataFrame, reviewer: str = "reviewer_id", status: str = "review_status") -> DataFrame:
    """(metric, n): rows of each step, by reviewer and by status; merged rows are 0 where anything is wrong."""

    def metric(name: str, rows: DataFrame, count: Column | None = None) -> DataFrame:
        return rows.agg((F.count("*") if count is None else count).alias("n")).select(F.lit(name).alias("metric"), "n")

    wrong = errors.agg(F.count("*").alias("e"))
    parts = [
        metric("source_rows", source),
        metric("assigned_rows", assignments),
        assignments.groupBy(F.concat(F.col(reviewer), F.lit("_rows")).alias("metric")).agg(F.count("*").alias("n")),
        merged.agg(F.count("*").alias("m")).crossJoin(wrong).select(F.lit("merged_rows").alias("metric"), F.when(F.col("e") == 0, F.col("m")).otherwise(0).alias("n")),
        *[metric(f"{s}_rows", merged, F.count_if(F.col(status) == s)) for s in ("pending", "reviewed", "needs_followup", "skipped")],
        wrong.select(F.lit("validation_error_count").alias("metric"), F.col("e").alias("n")),
    ]
    return reduce(DataFrame.unionByName, parts)


def manifest_differences(found: dict, expected: dict, tolerance: float = 1e-12) -> list[str]:
    """Keys of an expected manifest whose value is missing or another one; numbers may differ by the tolerance."""
    out = []
    for key, want in expected.items():
        have = found.get(key)
        number = isinstance(want, float) and isinstance(have, (int, float)) and not isinstance(have, bool)
        if key not in found or (abs(have - want) > tolerance if number else have != want):
            out.append(key)
    return sorted(out)


#: Columns that name a label, and those that people fill with their canonical names.
LABEL_IDENTITY = ["review_id", "image_id", "source_bucket", "original_path", "filename"]
HUMAN_NAMES = {f"human_{c}": c for c in ("photo_type_review", "angle_review", "is_exterior_review", "has_visible_damage_review", "severity_review", "review_status", "reviewer", "reviewed_at", "review_notes")}


def promoted(rows: DataFrame) -> DataFrame:
    """What people filled in under canonical names, in their order, all as texts; a missing column is an error."""
    missing = [c for c in [*LABEL_IDENTITY, *HUMAN_NAMES] if c not in rows.columns]
    if missing:
        raise ValueError("missing required columns: " + ", ".join(missing))
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(HUMAN_NAMES.get(c, c)) for c in [*LABEL_IDENTITY, *HUMAN_NAMES]])


#: Options of completed error reviews; a blank is no value yet.
REVIEW_OPTIONS = {
    "review_status": ["pending", "reviewed", "needs_adjudication"],
    "annotation_quality": ["correct", "questionable", "defect_suspected", "not_applicable"],
    "retraining_priority": ["low", "medium", "high", "not_applicable"],
    "correction_proposal_required": ["yes", "no"],
}
#: What a reviewed row must hold.
REVIEW_REQUIRED = ["error_disposition", "primary_root_cause", "annotation_quality", "recommended_action", "retraining_priority", "correction_proposal_required", "reviewer", "reviewed_at_utc"]


def review_rules(fingerprint: Column, paths: list[str]) -> list[tuple[Column, Column]]:
    """Rules of error reviews besides decisions.semantic_rules: fields of the source, paths, options, what must be filled."""
    from annoforge.functions.text import safe_path

    own = F.coalesce(F.upper("source_case_fingerprint"), F.lit(""))
    rules = [(own != fingerprint, "source_case_fingerprint", "SOURCE_FINGERPRINT_MISMATCH", "immutable source fields were changed")]
    rules += [(~safe_path(F.col(p)), p, "FORBIDDEN_PATH", "path must be relative and of the validation split") for p in paths]
    value = {c: T.stripped(F.col(c)) for c in {*REVIEW_OPTIONS, *REVIEW_REQUIRED}}
    rules += [((value[c] != "") & ~value[c].isin(*o), c, "INVALID_CONTROLLED_VALUE", "value is not approved") for c, o in REVIEW_OPTIONS.items()]
    rules += [((value["review_status"] == "reviewed") & (value[c] == ""), c, "MISSING_REVIEW_FIELD", "value is required for reviewed rows") for c in REVIEW_REQUIRED]
    return [(F.coalesce(broken, F.lit(True)), error(c, F.col(c), code, message)) for broken, c, code, message in rules]


def batch_errors(rows: DataFrame, expected: int, keys: list[str], constants: dict[str, str], batch: str) -> DataFrame:
    """(code, column) of faults of a whole batch: its row count, blank or repeated keys, columns that are not one given value, batches."""
    facts = rows.agg(
        F.count("*").alias("n"),
        *[F.count_if(T.stripped(F.col(k)) == "").alias(f"b_{k}") for k in keys], *[F.count_distinct(F.coalesce(F.col(k), F.lit(""))).alias(f"d_{k}") for k in keys],
        *[F.count_if(~F.col(c).eqNullSafe(F.lit(v))).alias(f"c_{c}") for c, v in constants.items()],
        F.count_distinct(F.coalesce(F.col(batch), F.lit(""))).alias("batches"), F.count_if(T.stripped(F.col(batch)) == "").alias("unnamed"),
    )
    rules = [(F.col("n") != expected, "ROW_COUNT_MISMATCH", "")]
    for k in keys:
        rules += [(F.col(f"b_{k}") > 0, "BLANK_IDENTITY", k), (F.col(f"d_{k}") != F.col("n"), "DUPLICATE_IDENTITY", k)]
    rules += [((F.col(f"c_{c}") > 0) | (F.col("n") == 0), f"{c.upper()}_MISMATCH", c) for c in constants]
    rules.append(((F.col("batches") != 1) | (F.col("unnamed") > 0), "BATCH_ID_MISMATCH", batch))
    found = F.array_compact(F.array(*[F.when(broken, F.struct(F.lit(code).alias("code"), F.lit(c).alias("column"))) for broken, code, c in rules]))
    return facts.select(F.explode(found).alias("e")).select("e.code", "e.column")


def scoped_errors(rows: DataFrame, key: str, outcome: Column, values: dict[str, tuple[Column, dict[str, list[str]]]]) -> DataFrame:
    """(key, field, value) of values that their row's outcome does not allow; values: field to (column, options table)."""
    found = [F.when(~F.array_contains(options(outcome, table), F.coalesce(c, F.lit(""))), F.struct(F.lit(n).alias("field"), c.alias("value"))) for n, (c, table) in values.items()]
    return rows.select(key, F.explode(F.array_compact(F.array(*found))).alias("e")).select(key, "e.field", "e.value")


def target_errors(worklist: DataFrame, inventory: DataFrame, key: str, path: str) -> DataFrame:
    """(key, code) of worklist rows whose file is not there, or whose name in the package another row has too."""
    name = F.concat(F.col(key).cast("string"), T.suffix(F.col(path)))
    rows = worklist.select(key, path, name.alias("_target")).join(inventory.select(F.col("path").alias(path)).distinct().withColumn("_hit", F.lit(True)), path, "left")
    lost = rows.where("_hit is null").select(key, F.lit("image_not_found").alias("code"))
    twice = rows.groupBy("_target").count().where("count > 1").select("_target")
    return lost.unionByName(rows.join(twice, "_target", "left_semi").select(key, F.lit("duplicate_target").alias("code")))


#: What a finished deduplication recommends.
RECOMMENDATIONS = {"sha256_dedup_recommendation": "complete", "perceptual_hash_recommendation": "completed_candidates_pending_review", "internal_cross_dedup_recommendation": "completed_candidates_pending_review", "training_acceptance": "NOT_YET_APPROVED"}


def deduplication_report(dataset: str, records: DataFrame, groups: DataFrame, pairs: DataFrame, external: bool = True, cross: bool = True) -> DataFrame:
    """The sixteen published fields of a deduplication; groups: external_count, member_count, cross_source; pairs: similar
    pairs, or their counts by scope with n_pairs; scopes not looked at are 0.
    Records may tell by `hash_status` which of them are hashed; without it all are."""

    def both(side: str) -> Column:
        return (F.col("left_source_scope") == side) & (F.col("right_source_scope") == side)

    r = records.agg(F.count_if(F.col("source_scope") == "internal").alias("internal_image_count"), F.count_if(F.col("source_scope") == "external").alias("external_image_count"), F.count("*").alias("total_image_count"))
    failed = F.count_if(F.coalesce(F.col("hash_status") != "hashed", F.lit(True))) if "hash_status" in records.columns else F.lit(0).cast("bigint")
    r = r.crossJoin(records.agg(failed.alias("hash_error_count")))
    r = r.select(F.lit(dataset).alias("dataset_id"), *[c for c in r.columns if c != "hash_error_count"], (F.col("total_image_count") - F.col("hash_error_count")).alias("hash_success_count"), "hash_error_count")
    own, mixed = F.lit(external) & (F.col("external_count") >= 2), F.lit(cross) & F.col("cross_source")
    g = groups.agg(
        F.count_if(own).alias("external_external_exact_group_count"), F.coalesce(F.sum(F.when(own, F.col("external_count"))), F.lit(0)).alias("external_external_exact_image_count"),
        F.count_if(mixed).alias("internal_external_exact_group_count"), F.coalesce(F.sum(F.when(mixed, F.col("member_count"))), F.lit(0)).alias("internal_external_exact_image_count"),
    )
    n = F.col("n_pairs") if "n_pairs" in pairs.columns else F.lit(1)
    total = lambda asked, name: F.coalesce(F.sum(F.when(asked, n)), F.lit(0)).cast("bigint").alias(name)
    p = pairs.agg(total(both("external"), "external_external_perceptual_candidate_count"), total(F.col("left_source_scope") != F.col("right_source_scope"), "internal_external_perceptual_candidate_count"))
    return r.crossJoin(g).crossJoin(p).select("*", *[F.lit(v).alias(n) for n, v in RECOMMENDATIONS.items()])
