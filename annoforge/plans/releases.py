"""Queries of the review store, release gates and dataset intake."""

from __future__ import annotations

from pyspark.sql import functions as F

from annoforge.functions import hashes as H
from annoforge.functions import text as T
from annoforge.operators import intake as I
from annoforge.operators import release as L
from annoforge.operators import similarity as S
from annoforge.operators import store as P
from annoforge.plans.bindings import CONTENT_SQL, HASH_SQL, hash_records, table
from annoforge.plans.curation import _bands6 as BANDS_SQL
from annoforge.plans.decisions import _CORRECTION, _case, _pick
from annoforge.sources.tables import Reviews, scratch

REVIEWER, CAP = "ann", 3
FIELDS = ["review_status", "priority"]

# --- review store


def _cases(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.lit("pending").alias("review_status"), F.col("c_mktsegment").alias("priority"), (F.col("c_custkey") % 3).alias("revision"))


def _saves(spark, sf):
    """orders as saves: some of unknown cases, by another reviewer, still pending, or without a good instant."""
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "reviewed").when(F.col("o_orderstatus") == "O", "needs_adjudication").otherwise("pending")
    at = F.when(k % 17 == 0, "soon").when(k % 19 == 0, "2024-01-02T03:04:05").otherwise(F.concat(F.lit("2024-01-02T03:04:"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit("+00:00")))
    return table(spark, sf, "orders").select(
        k.alias("seq"), F.when(k % 31 == 0, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey")).alias("c_custkey"), status.alias("review_status"),
        F.col("o_orderpriority").alias("priority"), F.when(k % 13 == 0, "bob").otherwise(REVIEWER).alias("reviewer"), at.alias("reviewed_at_utc"),
    )


_SAVES = f"""cases AS (SELECT c_custkey, 'pending' AS review_status, c_mktsegment AS priority, c_custkey % 3 AS revision FROM customer),
saves AS (SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 31 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS c_custkey,
  CASE o_orderstatus WHEN 'F' THEN 'reviewed' WHEN 'O' THEN 'needs_adjudication' ELSE 'pending' END AS review_status, o_orderpriority AS priority,
  CASE WHEN o_orderkey % 13 = 0 THEN 'bob' ELSE '{REVIEWER}' END AS reviewer,
  CASE WHEN o_orderkey % 17 = 0 THEN 'soon' WHEN o_orderkey % 19 = 0 THEN '2024-01-02T03:04:05' ELSE printf('2024-01-02T03:04:%02d+00:00', o_orderkey % 60) END AS reviewed_at_utc FROM orders),
coded AS (SELECT s.*, CASE WHEN review_status = 'pending' THEN 'status_not_saved' WHEN reviewer <> '{REVIEWER}' THEN 'reviewer_mismatch' WHEN reviewed_at_utc = 'soon' THEN 'invalid_timestamp'
  WHEN reviewed_at_utc NOT LIKE '%+00:00' THEN 'no_offset' WHEN c_custkey NOT IN (SELECT c_custkey FROM customer) THEN 'unknown_case' END AS code FROM saves s),
good AS (SELECT * FROM coded WHERE code IS NULL)"""


def review_store_state(spark, sf):
    return P.save(_cases(spark, sf), _saves(spark, sf), "c_custkey", FIELDS, REVIEWER)[0]


def review_store_audit(spark, sf):
    return P.save(_cases(spark, sf), _saves(spark, sf), "c_custkey", FIELDS, REVIEWER)[1]


def review_store_refused(spark, sf):
    return P.save(_cases(spark, sf), _saves(spark, sf), "c_custkey", FIELDS, REVIEWER)[2]


def _stored(spark, sf):
    """A stored review table: customers are opened as cases, orders of even number are saved, then the others."""
    store = Reviews(spark, scratch(spark, "reviews"), "c_custkey", FIELDS, buckets=16)
    store.open(_cases(spark, sf), {"reviewer": REVIEWER})
    for odd in (0, 1):
        store.save(_saves(spark, sf).where(F.col("seq") % 2 == odd))
    return store


def stored_state(spark, sf):
    """The stored cases at the version after the first save."""
    return _stored(spark, sf).state(2)


def stored_events(spark, sf):
    return _stored(spark, sf).events().drop("event_type")


def stored_log(spark, sf):
    return _stored(spark, sf).tables.log().drop("parts")


def payload_errors(spark, sf):
    return P.payload_errors(_saves(spark, sf), REVIEWER)


def state_upsert(spark, sf):
    """The last order of each customer; orders of unknown customers add rows."""
    current = table(spark, sf, "customer").select("c_custkey", F.lit("none").alias("last_priority"))
    changes = _saves(spark, sf).select("c_custkey", F.col("priority").alias("last_priority"), "seq")
    return P.upsert(current, changes, "c_custkey", "seq")


def export_history(spark, sf):
    """Exports named by day: those of even orders are history, all are asked for again under a name of their own."""
    o = table(spark, sf, "orders").select(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"), F.col("o_custkey") % 50).alias("output_path"))
    return P.history_errors(table(spark, sf, "customer").select(F.concat(F.lit("1997-01-15-"), F.col("c_custkey") % 50).alias("output_path")), o)


def latest_artifact(spark, sf):
    o = table(spark, sf, "orders").select(F.format_string("run_%09d", "o_orderkey").alias("name"), "o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("outcome"))
    return P.latest_valid(o, "name", F.col("outcome") == "F")


# --- release


def _reviews(spark, sf):
    d, l = table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels")
    status = F.when(F.col("quality") == 1, "reviewed").when(F.col("quality") == 0, "needs_adjudication").otherwise("pending")
    return d.join(l, "doc_id", "left").select("doc_id", "lang", status.alias("review_status"))


def completeness_gate(spark, sf):
    return L.completeness(_reviews(spark, sf))


def _export(spark, sf):
    source = table(spark, sf, "documents").select("doc_id", "lang", F.lit("").alias("review_status"), F.lit("").alias("reviewer"))
    stored = table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "reviewed").otherwise("needs_adjudication").alias("review_status"), F.when(F.col("toxic") == 1, "bob").otherwise("ann").alias("reviewer"))
    return source, stored


def completed_export(spark, sf):
    return L.filled(*_export(spark, sf), "doc_id", ["review_status", "reviewer"])


def export_errors(spark, sf):
    return L.export_errors(*_export(spark, sf), "doc_id")


def hash_pins(spark, sf):
    """Digests of all texts against pins, of which some have another path or another digest."""
    d = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    k, path = F.col("doc_id"), F.concat(F.lit("/d/"), F.col("doc_id").cast("string"))
    found = d.select(path.alias("path"), F.sha2(F.encode("text", "UTF-8"), 256).alias("sha256"))
    pins = d.select(F.when(k % 41 == 0, F.concat(path, F.lit("x"))).otherwise(path).alias("path"), F.sha2(F.encode(F.when(k % 43 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), "UTF-8"), 256).alias("sha256"))
    return L.pin_errors(found, pins)


def identity_pins(spark, sf):
    n = table(spark, sf, "nation")
    stored = n.select(F.col("n_name").alias("key"), F.col("n_regionkey").cast("string").alias("value"))
    expected = n.select(F.when(F.col("n_nationkey") % 7 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("key"), F.when(F.col("n_nationkey") % 5 == 0, "9").otherwise(F.col("n_regionkey").cast("string")).alias("value"))
    return L.identity_errors(stored, expected)


def case_list_pins(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("case_index"), F.col("c_name").alias("case_id"), "c_mktsegment")
    k = F.col("case_index")
    other = c.select(F.when(k % 23 == 0, k + 1).otherwise(k).alias("case_index"), F.when(k % 29 == 0, F.concat("case_id", F.lit("x"))).otherwise(F.col("case_id")).alias("case_id"), "c_mktsegment")
    return L.case_list_errors(c, other, "case_id", ["case_index", "c_mktsegment"])


GROUPS = ["IN_SCOPE_LIGHT_MODERATE", "OUT_OF_SCOPE_HEAVY", "OUT_OF_SCOPE_CATASTROPHIC", "", "ELSEWHERE"]
REASONS = ["light_surface_damage", "structural_damage", "catastrophic_collision", "insufficient_visual_evidence", "other", ""]


def _scope(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        k.alias("row_number"), F.concat(F.lit("c"), k.cast("string")).alias("review_case_id"), F.col("o_orderpriority").alias("image_id"),
        _pick(["reviewed", "reviewed", "reviewed", "pending"], F.floor(k / 2)).alias("scope_review_status"), _pick(GROUPS, k).alias("scope_group"), _pick(REASONS, F.floor(k / 3)).alias("scope_reason"),
        _pick(["drivable_or_likely_drivable", "uncertain"], F.floor(k / 5)).alias("operability"), _pick(["high", "medium", "low"], F.floor(k / 7)).alias("scope_confidence"),
        F.lit("ann").alias("scope_reviewer"), F.when(k % 11 == 0, "2024-01-02").when(k % 11 == 1, "").otherwise("2024-01-02T03:04:05Z").alias("scope_reviewed_at_utc"), F.when(k % 3 == 0, "why").otherwise(" ").alias("scope_reviewer_notes"),
    )
    n = F.col("row_number")
    source = rows.select("row_number", F.when(n % 103 == 0, "other").otherwise(F.col("review_case_id")).alias("review_case_id"), F.when(n % 101 == 0, "changed").otherwise(F.col("image_id")).alias("image_id"))
    return rows, source


def scope_errors(spark, sf):
    return L.scope_errors(*_scope(spark, sf), "review_case_id", ["image_id"], 5).select("row_number", "column", "value", "code")


def dependent_options(spark, sf):
    k = F.col("p_partkey")
    outcome = _pick(OUTCOMES, k)
    quality, priority = _pick(["correct", "defect_suspected"], F.floor(k / 2)), _pick(["low", "high"], F.floor(k / 3))
    reason, action = _pick(["small", "other"], F.floor(k / 5)), _pick(["none", "other"], F.floor(k / 7))
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(L.options(outcome, L.QUALITY_OPTIONS), "|").alias("qualities"), F.array_join(L.options(outcome, L.PRIORITY_OPTIONS), "|").alias("priorities"),
        F.array_join(L.shown_fields(outcome, reason, quality, action, priority), "|").alias("fields"),
    )


OUTCOMES = ["annotation_issue", "invalid_image", "ambiguous", "threshold_tradeoff", "model_miss"]


def pilot_worklist(spark, sf):
    o = table(spark, sf, "orders")
    given = {"review_id": "o_orderkey", "image_id": "o_custkey", "source_bucket": "o_orderpriority", "seed": "o_orderstatus"}
    rows = o.select(
        *[F.col(given.get(c, "o_orderstatus")).cast("string").alias(c) for c in L.CARRIED],
        *[F.when(F.col("o_orderkey") % 5 == i % 5, None).otherwise(F.col("o_orderstatus")).alias(c) for i, c in enumerate(L.SEED)],
    )
    return L.pilot_worklist(rows, prefill=True, seed_reviewer=True)


def worklist_errors(spark, sf):
    c = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 40 == 0, " ").otherwise(F.col("c_name")).alias("review_id"), (F.col("c_custkey") % 100).cast("string").alias("image_id"))
    return L.worklist_errors(c, 5, ["review_id", "image_id"])


def manifest_errors(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select((k % 150).cast("string").alias("image_id"), F.when(k % 30 == 0, "").otherwise(F.col("p_name")).alias("original_path"), F.concat(k.cast("string"), _pick([".jpg", ".PNG", ".gif", ".webp"], k)).alias("filename"))
    return L.manifest_errors(rows, "image_id", ["image_id", "original_path", "filename"], "filename", [".jpg", ".png"])


def distinct_equal(spark, sf):
    return L.distinct_equal(table(spark, sf, "orders"), "o_orderstatus", ["F", "O", "ABSENT"])


def merge_summary(spark, sf):
    o = table(spark, sf, "orders")
    status = _pick(["pending", "reviewed", "needs_followup", "skipped", "reviewed"], F.col("o_orderkey")).alias("review_status")
    assigned = o.select("o_orderkey", _pick(["r1", "r2"], F.col("o_orderkey")).alias("reviewer_id"))
    return L.merge_summary(o, assigned, o.select("o_orderkey", status), payload_errors(spark, sf))


def promoted_labels(spark, sf):
    """The worklist's human fields under canonical names."""
    return L.promoted(pilot_worklist(spark, sf))


def _error_reviews(spark, sf):
    k = F.col("o_orderkey")
    source = T.row_fingerprint(k, F.col("o_orderpriority"))
    rows = table(spark, sf, "orders").select(
        (k + 2).alias("row_number"), (k % 400).cast("string").alias("image_id"), F.when(k % 300 == 0, "").otherwise(k.cast("string")).alias("review_case_id"), source.alias("_source"),
        F.when(k % 21 == 0, "0").when(k % 2 == 0, F.lower(source)).otherwise(source).alias("source_case_fingerprint"), _pick(["img/a.jpg", "test/b.jpg", "../c.jpg", "img/d.jpg", None], k).alias("original_image_relpath"),
        _pick(["reviewed", "pending", "done"], k).alias("review_status"), _pick(["correct", "", "wrong"], F.floor(k / 2)).alias("annotation_quality"), _pick(["low", "high", "urgent", ""], F.floor(k / 3)).alias("retraining_priority"),
        _pick(["yes", "no", "maybe"], F.floor(k / 5)).alias("correction_proposal_required"), _pick(["confirmed", ""], F.floor(k / 7)).alias("error_disposition"), F.lit("cause").alias("primary_root_cause"), F.lit("act").alias("recommended_action"),
        _pick(["ann", " "], F.floor(k / 11)).alias("reviewer"), F.lit("2024-01-02T03:04:05Z").alias("reviewed_at_utc"), F.when(k % 50 == 0, "0.30").otherwise("0.20").alias("threshold_candidate"), F.lit("v1").alias("schema_version"), F.lit("b1").alias("review_batch_id"),
    )
    return rows


def review_field_errors(spark, sf):
    from annoforge.operators.checks import rule_errors

    return rule_errors(_error_reviews(spark, sf), L.review_rules(F.col("_source"), ["original_image_relpath"])).select("row_number", "column", "code")


def batch_errors(spark, sf):
    return L.batch_errors(_error_reviews(spark, sf), 5, ["review_case_id", "image_id"], {"threshold_candidate": "0.20", "schema_version": "v1"}, "review_batch_id")


def scoped_values(spark, sf):
    k = F.col("p_partkey")
    values = {"annotation_quality": (_pick(["correct", "defect_suspected", "not_applicable"], F.floor(k / 2)), L.QUALITY_OPTIONS), "retraining_priority": (_pick(["low", "not_applicable"], F.floor(k / 3)), L.PRIORITY_OPTIONS)}
    return L.scoped_errors(table(spark, sf, "part"), "p_partkey", _pick(OUTCOMES, k), values)


def package_targets(spark, sf):
    k = F.col("c_custkey")
    work = table(spark, sf, "customer").select((k % 140).alias("image_id"), F.concat(F.lit("/i/"), F.when(k % 17 == 0, F.lit("x")).otherwise(F.lit("")), k.cast("string"), F.lit(".JPG")).alias("original_path"))
    return L.target_errors(work, table(spark, sf, "customer").select(F.concat(F.lit("/i/"), k.cast("string"), F.lit(".JPG")).alias("path")), "image_id", "original_path")


def outcome_notes(spark, sf):
    from annoforge.operators import decisions as D

    outcome = _pick(OUTCOMES, F.col("p_partkey"))
    return table(spark, sf, "part").select("p_partkey", D.start_note(outcome).alias("review_notes"), D.start_defect(outcome).alias("annotation_defect_type"))


def correction_fields(spark, sf):
    from annoforge.operators import decisions as D
    from annoforge.plans.decisions import _code, _corrections

    k = F.col("o_orderkey")
    at = _pick(["2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05"], F.floor(k / 2))
    rows = _corrections(spark, sf).withColumn("c", _code())
    made = D.correction_fields(F.col("c"), *[F.col(c) for c in ("status", "decision", "operation", "targets", "box", "reason")], F.when(k % 5 == 0, " ").otherwise(" ann "), at)
    return rows.select("o_orderkey", made.alias("f")).where("f is not null").select("o_orderkey", "f.*")


def deduplication_report(spark, sf):
    from annoforge.plans.bindings import content
    from annoforge.plans.curation import CROSS

    files = content(spark, sf)
    groups = files.groupBy("sha256").agg(F.count("*").alias("member_count"), F.count_if(F.col("source_scope") == "external").alias("external_count")).where("member_count > 1")
    groups = groups.withColumn("cross_source", (F.col("external_count") > 0) & (F.col("external_count") < F.col("member_count")))
    return L.deduplication_report("d", files, groups, S.pair_counts(hash_records(spark, sf), 18, 0.10, scopes=CROSS | {("external", "external")}))


# --- intake


def _registry(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.concat(F.lit(" D"), F.floor(k * 9 / 10).cast("string")).alias("dataset_id"), F.col("s_name").alias("name"), _pick(["yes", " TRUE", "1", "no"], k).alias("license_verified"),
        _pick(["approved_for_download", "Approved_For_Download ", "rejected"], F.floor(k / 4)).alias("usage_status"), F.lit("").alias("notes"),
    )


_REGISTRY = f"""registry AS (SELECT ' D' || (s_suppkey * 9 // 10) AS dataset_id, s_name AS name, {_case(["yes", " TRUE", "1", "no"], "s_suppkey")} AS license_verified,
  {_case(["approved_for_download", "Approved_For_Download ", "rejected"], "s_suppkey // 4")} AS usage_status, '' AS notes FROM supplier)"""


def _wanted(spark, sf):
    return table(spark, sf, "supplier").select(F.concat(F.lit("D"), F.col("s_suppkey").cast("string")).alias("dataset_id"))


def registry_errors(spark, sf):
    return I.registry_errors(_registry(spark, sf), _wanted(spark, sf))


def registry_rows(spark, sf):
    return I.registry_rows(_registry(spark, sf), _wanted(spark, sf))


def intake_summary(spark, sf):
    k, p = F.col("doc_id"), F.col("p_partkey")
    images = table(spark, sf, "documents").select(F.col("source").alias("split"), F.sha2(F.encode("text", "UTF-8"), 256).alias("sha256"), (k % 50 != 0).alias("file_exists"))
    boxes = table(spark, sf, "part").select(F.col("p_brand").alias("class_name"), _pick(["valid", "valid", "non_positive_bbox"], p).alias("bbox_status"), _pick(["valid_polygon", "valid_rle", "missing", "valid_polygon"], p).alias("segmentation_status"))
    return I.intake_summary(images, boxes, ["Brand#11"])


_INTAKE = f"""image AS (SELECT source AS split, sha256(text) AS sha256, doc_id % 50 <> 0 AS file_exists FROM documents),
ann AS (SELECT p_brand AS class_name, {_case(["valid", "valid", "non_positive_bbox"], "p_partkey")} AS bbox_status, {_case(["valid_polygon", "valid_rle", "missing", "valid_polygon"], "p_partkey")} AS segmentation_status FROM part),
summary AS (SELECT * FROM (SELECT count(*) AS image_record_count, count(*) FILTER (file_exists) AS image_file_count, count(*) FILTER (NOT file_exists) AS missing_image_count FROM image),
 (SELECT count(*) AS annotation_count, count(*) FILTER (bbox_status = 'valid') AS valid_bbox_count, count(*) FILTER (bbox_status <> 'valid') AS invalid_bbox_count,
   count(*) FILTER (NOT starts_with(segmentation_status, 'valid_')) AS invalid_segmentation_count, string_agg(DISTINCT class_name, '|' ORDER BY class_name) AS class_names FROM ann),
 (SELECT count(*) AS exact_duplicate_group_count, coalesce(sum(n), 0)::BIGINT AS exact_duplicate_image_count FROM (SELECT count(*) AS n FROM image WHERE sha256 IS NOT NULL GROUP BY sha256 HAVING count(*) > 1)),
 (SELECT string_agg(x, '|' ORDER BY x) AS split_counts FROM (SELECT coalesce(split, '') || '=' || count(*) AS x FROM image GROUP BY split)))"""


def registry_proposal(spark, sf):
    """What an intake proposes for every registry row that may be taken in."""
    return I.proposal(registry_rows(spark, sf), intake_summary(spark, sf), "2024-01-02T03:04:05+00:00", "data/raw", "pending QA")


def proposal_errors(spark, sf):
    k = F.col("s_suppkey")
    base = table(spark, sf, "supplier")
    ids = F.concat(F.lit("D"), k.cast("string")).alias("dataset_id")
    registry = base.select(F.concat(F.lit("D"), F.floor(k * 9 / 10).cast("string")).alias("dataset_id"), F.lit("x").alias("name"), _pick(["NOT_YET_APPROVED", "NOT_YET_APPROVED", "APPROVED"], k).alias("training_acceptance"))
    proposed = base.select(ids, _pick(["x", "x", "x", "y"], k).alias("name"), _pick(["data\\raw", "data/raw", "", "elsewhere"], F.floor(k / 2)).alias("local_raw_path"))
    return I.proposal_errors(registry, proposed, base.select(ids), ["name"], {"training_acceptance": "NOT_YET_APPROVED"}, "data/raw")


def mapping_errors(spark, sf):
    r = table(spark, sf, "region")
    return I.mapping_errors(r.select(_pick(["d", "e"], F.col("r_regionkey")).alias("dataset_id"), F.lit(" car ").alias("mapped_class"), F.lit("No").alias("yolo_label_created")), "d", "car")


# --- values and hashes


def cell_values(spark, sf):
    k = F.col("p_partkey")
    raw = F.concat(_pick(["=", "+", "-", "@", "", " "], k), F.col("p_name"))
    number = _pick(["12", " 7.5 ", "-3", "NaN", "x1", "0", "1e3", ""], k)
    n, w = T.strict_number(number, positive=True), T.strict_number(number, integer=True)
    return table(spark, sf, "part").select(
        "p_partkey", T.literal(raw).alias("cell"), T.scalar(F.when(k % 3 == 0, raw)).alias("scalar"), T.scalar(F.timestamp_seconds(k * 1000), "timestamp").alias("at"),
        n["value"].alias("number"), n["code"].alias("number_code"), w["value"].alias("whole"), w["code"].alias("whole_code"), T.json_checksum(b=F.col("p_size"), a=F.col("p_brand")).alias("checksum"),
    )


def candidate_overflow(spark, sf):
    return S.overflow(hash_records(spark, sf), 6, CAP)


def difference_hashes(spark, sf):
    """dHash of nine columns by eight rows of luma taken in turn from the components."""
    luma = F.transform(F.sequence(F.lit(0), F.lit(71)), lambda i: F.get("embedding", (i * 5) % 64))
    return table(spark, sf, "embeddings").select("vec_id", H.dhash(luma).alias("dhash"))


QUERIES = {f.__name__: f for f in (stored_state, stored_events, stored_log, review_store_state, review_store_audit, review_store_refused, payload_errors, state_upsert, export_history, latest_artifact, completeness_gate, completed_export, export_errors, hash_pins, identity_pins, case_list_pins, scope_errors, dependent_options, pilot_worklist, worklist_errors, manifest_errors, distinct_equal, merge_summary, registry_errors, registry_rows, intake_summary, registry_proposal, proposal_errors, mapping_errors, cell_values, candidate_overflow, difference_hashes, promoted_labels, review_field_errors, batch_errors, scoped_values, package_targets, outcome_notes, correction_fields, deduplication_report)}


def _rules(source, rules):
    return " UNION ALL ".join(f"SELECT row_number, '{column}' AS \"column\", {column or value}::VARCHAR AS value, '{code}' AS code FROM {source} WHERE {broken}" for column, code, broken, value in [(*r, "")[:4] for r in rules])


_SCOPE_RULES = [
    ("scope_group", "INVALID_SCOPE_CONTROLLED_VALUE", "scope_group = 'ELSEWHERE'"),
    ("scope_review_status", "INCOMPLETE_SCOPE_REVIEW", "NOT done"),
    *[(c, "MISSING_SCOPE_FIELD", f"done AND {c} = ''") for c in ("scope_group", "scope_reason", "scope_reviewed_at_utc")],
    ("scope_reviewed_at_utc", "INVALID_SCOPE_TIMESTAMP", "done AND scope_reviewed_at_utc = '2024-01-02'"),
    ("scope_reviewer_notes", "LOW_SCOPE_CONFIDENCE_NOTES_REQUIRED", "scope_confidence = 'low' AND scope_reviewer_notes = ''"),
    ("scope_reviewer_notes", "OTHER_SCOPE_REASON_NOTES_REQUIRED", "scope_reason = 'other' AND scope_reviewer_notes = ''"),
    ("scope_reason", "CATASTROPHIC_REASON_REQUIRED", "scope_group = 'OUT_OF_SCOPE_CATASTROPHIC' AND scope_reason NOT IN ('structural_damage', 'catastrophic_collision')"),
    ("scope_reviewer_notes", "CATASTROPHIC_DRIVABLE_NOTES_REQUIRED", "scope_group = 'OUT_OF_SCOPE_CATASTROPHIC' AND operability <> 'uncertain' AND scope_reviewer_notes = ''"),
    ("scope_reason", "IN_SCOPE_CATASTROPHIC_REASON_FORBIDDEN", "scope_group = 'IN_SCOPE_LIGHT_MODERATE' AND scope_reason = 'catastrophic_collision'"),
    ("scope_reason", "INSUFFICIENT_EVIDENCE_CONTRACT_VIOLATION", "scope_reason = 'insufficient_visual_evidence' AND (scope_confidence <> 'low' OR scope_reviewer_notes = '')"),
    ("image_id", "SCOPE_SOURCE_FIELD_CHANGED", "row_number % 101 = 0"),
]
_STRIPPED = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"

ORACLES = {
    "stored_state": f"""WITH {_SAVES}, last AS (SELECT c_custkey, count(*) AS n, arg_max(review_status, seq) AS s, arg_max(priority, seq) AS p, arg_max(reviewed_at_utc, seq) AS a FROM good WHERE seq % 2 = 0 GROUP BY c_custkey)
SELECT c_custkey, coalesce(s, review_status) AS review_status, coalesce(p, priority) AS priority, revision + coalesce(n, 0) AS revision, a AS saved_at FROM cases LEFT JOIN last USING (c_custkey)""",
    "stored_events": f"""WITH {_SAVES} SELECT row_number() OVER (ORDER BY seq % 2, seq) AS event_id, c_custkey, c_custkey % 3 + row_number() OVER (PARTITION BY c_custkey ORDER BY seq % 2, seq) AS revision, seq, review_status, priority FROM good""",
    "stored_log": f"""WITH {_SAVES}, n AS (SELECT (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM good WHERE seq % 2 = 0) AS g, (SELECT count(*) FROM good) AS gg, (SELECT count(*) FROM coded WHERE code IS NOT NULL AND seq % 2 = 0) AS r, (SELECT count(*) FROM coded WHERE code IS NOT NULL) AS rr)
SELECT unnest([1, 1, 2, 2, 2, 2, 3, 3, 3, 3]) AS version, unnest(['open', 'open', 'save', 'save', 'save', 'save', 'save', 'save', 'save', 'save']) AS operation, unnest(['cases', 'source', 'cases', 'events', 'refused', 'source', 'cases', 'events', 'refused', 'source']) AS table_name,
  unnest([c, c, c, g, r, c, c, gg, rr, c]) AS n_rows FROM n""",
    "review_store_state": f"""WITH {_SAVES}, last AS (SELECT c_custkey, count(*) AS n, arg_max(review_status, seq) AS s, arg_max(priority, seq) AS p, arg_max(reviewed_at_utc, seq) AS a FROM good GROUP BY c_custkey)
SELECT c_custkey, coalesce(s, review_status) AS review_status, coalesce(p, priority) AS priority, revision + coalesce(n, 0) AS revision, a AS saved_at FROM cases LEFT JOIN last USING (c_custkey)""",
    "review_store_audit": f"""WITH {_SAVES} SELECT seq, 'review_saved' AS event_type, c_custkey, c_custkey % 3 + row_number() OVER (PARTITION BY c_custkey ORDER BY seq) AS revision,
  row_number() OVER (ORDER BY seq) AS successful_save_count, review_status, priority FROM good""",
    "review_store_refused": f"WITH {_SAVES} SELECT seq, code FROM coded WHERE code IS NOT NULL",
    "payload_errors": f"""WITH {_SAVES}
SELECT seq AS row_number, 'review_status' AS "column", review_status AS value, 'status_not_saved' AS code, 'saved review status must be reviewed or needs_adjudication' AS message FROM saves WHERE review_status = 'pending'
UNION ALL SELECT seq, 'reviewer', reviewer, 'reviewer_mismatch', 'reviewer does not match workspace identity' FROM saves WHERE reviewer <> '{REVIEWER}'
UNION ALL SELECT seq, 'reviewed_at_utc', reviewed_at_utc, 'invalid_timestamp', 'reviewed_at_utc must be valid ISO 8601' FROM saves WHERE reviewed_at_utc = 'soon'
UNION ALL SELECT seq, 'reviewed_at_utc', reviewed_at_utc, 'no_offset', 'reviewed_at_utc must include a timezone offset' FROM saves WHERE reviewed_at_utc = '2024-01-02T03:04:05'""",
    "state_upsert": f"""WITH {_SAVES}, last AS (SELECT c_custkey, arg_max(priority, seq) AS p FROM saves GROUP BY c_custkey)
SELECT coalesce(c.c_custkey, l.c_custkey) AS c_custkey, coalesce(l.p, 'none') AS last_priority FROM customer c FULL JOIN last l ON c.c_custkey = l.c_custkey""",
    "export_history": """WITH a AS (SELECT '1997-01-15-' || (c_custkey % 50) AS output_path, 0 AS new FROM customer UNION ALL SELECT strftime(o_orderdate, '%Y-%m-%d') || '-' || (o_custkey % 50), 1 FROM orders)
SELECT output_path, count(*) AS n FROM a GROUP BY output_path HAVING count(*) > 1 AND max(new) = 1""",
    "latest_artifact": """SELECT printf('run_%09d', o_orderkey) AS name, o_orderstatus, o_orderstatus AS outcome FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus = 'F' ORDER BY name DESC LIMIT 1""",
    "completeness_gate": """SELECT count(*) AS total, count(*) FILTER (quality = 1) AS reviewed, count(*) FILTER (quality IS NULL) AS pending, count(*) FILTER (quality = 0) AS needs_adjudication,
  count(*) FILTER (quality = 1) = count(*) AS complete FROM documents LEFT JOIN labels USING (doc_id)""",
    "completed_export": """SELECT d.doc_id, lang, CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN quality = 1 THEN 'reviewed' ELSE 'needs_adjudication' END END AS review_status,
  CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN toxic = 1 THEN 'bob' ELSE 'ann' END END AS reviewer FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "export_errors": """SELECT * FROM (SELECT 'duplicate_key' AS code, (SELECT count(*) FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1)) AS n
UNION ALL SELECT 'duplicate_review', (SELECT count(*) FROM (SELECT doc_id FROM labels GROUP BY doc_id HAVING count(*) > 1))
UNION ALL SELECT 'review_missing', (SELECT count(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
UNION ALL SELECT 'case_unknown', (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
UNION ALL SELECT 'not_reviewed', (SELECT count(*) FROM labels WHERE quality IS DISTINCT FROM 1)) WHERE n > 0""",
    "hash_pins": """SELECT '/d/' || doc_id || CASE WHEN doc_id % 41 = 0 THEN 'x' ELSE '' END AS path, CASE WHEN doc_id % 41 = 0 THEN 'missing' ELSE 'changed' END AS state FROM documents WHERE doc_id % 41 = 0 OR doc_id % 43 = 0""",
    "identity_pins": """WITH a AS (SELECT n_name AS key, n_regionkey::VARCHAR AS stored FROM nation),
b AS (SELECT CASE WHEN n_nationkey % 7 = 0 THEN lower(n_name) ELSE n_name END AS key, CASE WHEN n_nationkey % 5 = 0 THEN '9' ELSE n_regionkey::VARCHAR END AS expected FROM nation)
SELECT coalesce(a.key, b.key) AS key, stored, expected FROM a FULL JOIN b ON a.key = b.key WHERE stored IS DISTINCT FROM expected""",
    "case_list_pins": """WITH b AS (SELECT CASE WHEN c_custkey % 23 = 0 THEN c_custkey + 1 ELSE c_custkey END AS i, CASE WHEN c_custkey % 29 = 0 THEN c_name || 'x' ELSE c_name END AS case_id FROM customer)
SELECT coalesce(c.c_name, b.case_id) AS case_id, CASE WHEN c.c_name IS NULL THEN 'missing' WHEN b.case_id IS NULL THEN 'unknown' ELSE 'changed' END AS state
FROM customer c FULL JOIN b ON c.c_name = b.case_id WHERE c.c_name IS NULL OR b.case_id IS NULL OR b.i <> c.c_custkey""",
    "scope_errors": f"""WITH r AS (SELECT o_orderkey AS row_number, o_orderpriority AS image_id, {_case(["reviewed", "reviewed", "reviewed", "pending"], "o_orderkey // 2")} AS scope_review_status,
  {_case(GROUPS, "o_orderkey")} AS scope_group, {_case(REASONS, "o_orderkey // 3")} AS scope_reason, {_case(["drivable_or_likely_drivable", "uncertain"], "o_orderkey // 5")} AS operability,
  {_case(["high", "medium", "low"], "o_orderkey // 7")} AS scope_confidence, CASE o_orderkey % 11 WHEN 0 THEN '2024-01-02' WHEN 1 THEN '' ELSE '2024-01-02T03:04:05Z' END AS scope_reviewed_at_utc,
  CASE WHEN o_orderkey % 3 = 0 THEN 'why' ELSE '' END AS scope_reviewer_notes, scope_review_status = 'reviewed' AS done FROM orders)
SELECT * FROM ({_rules("r", _SCOPE_RULES)})
UNION ALL SELECT 0, '', count(*)::VARCHAR, 'SCOPE_ROW_COUNT_MISMATCH' FROM orders UNION ALL SELECT 0, '', count(*)::VARCHAR, 'SCOPE_SOURCE_ROW_COUNT_MISMATCH' FROM orders
UNION ALL SELECT 0, 'review_case_id', count(*)::VARCHAR, 'SCOPE_ROW_ORDER_CHANGED' FROM orders WHERE o_orderkey % 103 = 0""",
    "dependent_options": f"""SELECT p_partkey, CASE o WHEN 'annotation_issue' THEN 'defect_suspected' WHEN 'invalid_image' THEN 'not_applicable' WHEN 'ambiguous' THEN 'questionable|not_applicable' ELSE 'correct|questionable|not_applicable' END AS qualities,
  CASE WHEN o IN ('annotation_issue', 'invalid_image', 'ambiguous') THEN 'not_applicable' WHEN o = 'threshold_tradeoff' THEN 'low|not_applicable' ELSE 'low|medium|high' END AS priorities,
  array_to_string(list_sort(list_filter(['annotation_quality', 'reason', 'recommended_action', 'retraining_priority', CASE WHEN o = 'annotation_issue' OR p_partkey // 2 % 2 = 1 THEN 'annotation_defect_type' END,
    CASE WHEN o IN ('annotation_issue', 'ambiguous') OR p_partkey // 3 % 2 = 1 OR p_partkey // 5 % 2 = 1 OR p_partkey // 7 % 2 = 1 THEN 'review_notes' END], lambda x: x IS NOT NULL)), '|') AS fields
FROM (SELECT p_partkey, {_case(OUTCOMES, "p_partkey")} AS o FROM part)""",
    "pilot_worklist": "SELECT o_orderkey::VARCHAR AS review_id, o_custkey::VARCHAR AS image_id, o_orderpriority AS source_bucket, " + ", ".join(f"o_orderstatus AS {c}" for c in L.CARRIED[3:]) + ", "
    + ", ".join(f"CASE WHEN o_orderkey % 5 = {i % 5} THEN '' ELSE o_orderstatus END AS seed_{c}" for i, c in enumerate(L.SEED)) + ", "
    + ", ".join(f"CASE WHEN o_orderkey % 5 = {i} THEN '' ELSE o_orderstatus END AS human_{c}" for i, c in enumerate(L.SEED[:5]))
    + ", 'pending' AS human_review_status, CASE WHEN o_orderkey % 5 = 1 THEN '' ELSE o_orderstatus END AS human_reviewer, '' AS human_reviewed_at, '' AS human_review_notes FROM orders",
    "worklist_errors": """WITH c AS (SELECT CASE WHEN c_custkey % 40 = 0 THEN ' ' ELSE c_name END AS review_id, (c_custkey % 100)::VARCHAR AS image_id FROM customer)
SELECT * FROM (SELECT 'row_count' AS code, '' AS "column", count(*) AS n FROM c UNION ALL SELECT 'blank', 'review_id', count(*) FROM c WHERE review_id = ' '
UNION ALL SELECT 'duplicate', 'review_id', count(*) - count(DISTINCT review_id) FROM c UNION ALL SELECT 'duplicate', 'image_id', count(*) - count(DISTINCT image_id) FROM c) WHERE n > 0 AND (code <> 'row_count' OR n <> 5)""",
    "manifest_errors": f"""WITH r AS (SELECT p_partkey % 150 AS image_id, lower({_case([".jpg", ".PNG", ".gif", ".webp"], "p_partkey")}) AS e, p_partkey FROM part)
SELECT * FROM (SELECT 'blank' AS code, 'original_path' AS value, count(*) AS n FROM r WHERE p_partkey % 30 = 0 UNION ALL SELECT 'extension', e, count(*) FROM r WHERE e NOT IN ('.jpg', '.png') GROUP BY e
UNION ALL SELECT 'duplicate', 'image_id', count(*) - count(DISTINCT image_id) FROM r) WHERE n > 0""",
    "distinct_equal": """WITH d AS (SELECT DISTINCT o_orderstatus AS s FROM orders), u AS (SELECT count(*) AS unexpected FROM d WHERE s NOT IN ('F', 'O', 'ABSENT')),
m AS (SELECT count(*) AS missing FROM (VALUES ('F'), ('O'), ('ABSENT')) v(s) WHERE s NOT IN (SELECT s FROM d)) SELECT unexpected, missing, unexpected = 0 AND missing = 0 AS equal FROM u, m""",
    "merge_summary": f"""WITH {_SAVES}, o AS (SELECT {_case(["pending", "reviewed", "needs_followup", "skipped", "reviewed"], "o_orderkey")} AS s, {_case(["r1", "r2"], "o_orderkey")} AS r FROM orders),
e AS (SELECT (count(*) FILTER (review_status = 'pending') + count(*) FILTER (reviewer <> '{REVIEWER}') + count(*) FILTER (reviewed_at_utc NOT LIKE '%+00:00')) AS e FROM saves)
SELECT 'source_rows' AS metric, count(*) AS n FROM o UNION ALL SELECT 'assigned_rows', count(*) FROM o UNION ALL SELECT r || '_rows', count(*) FROM o GROUP BY r
UNION ALL SELECT 'merged_rows', CASE WHEN e = 0 THEN (SELECT count(*) FROM o) ELSE 0 END FROM e UNION ALL SELECT s || '_rows', count(*) FROM o GROUP BY s UNION ALL SELECT 'validation_error_count', e FROM e""",
    "registry_errors": f"""WITH {_REGISTRY}, one AS (SELECT trim(dataset_id) AS dataset_id, count(*) AS n, max(lower(trim(license_verified))) AS l, max(lower(trim(usage_status))) AS u FROM registry GROUP BY ALL)
SELECT * FROM (SELECT 'D' || s_suppkey AS dataset_id, CASE WHEN coalesce(n, 0) <> 1 THEN 'not_one_row' WHEN l NOT IN ('yes', 'true', '1') THEN 'license_not_verified' WHEN u <> 'approved_for_download' THEN 'not_approved' END AS code
FROM supplier LEFT JOIN one ON dataset_id = 'D' || s_suppkey) WHERE code IS NOT NULL""",
    "registry_rows": f"""WITH {_REGISTRY}, t AS (SELECT trim(dataset_id) AS dataset_id, trim(name) AS name, trim(license_verified) AS license_verified, trim(usage_status) AS usage_status, notes, count(*) OVER (PARTITION BY trim(dataset_id)) AS n FROM registry)
SELECT * EXCLUDE (n) FROM t WHERE n = 1 AND lower(license_verified) <> 'no' AND lower(usage_status) = 'approved_for_download'""",
    "intake_summary": f"WITH {_INTAKE} SELECT *, class_names = 'Brand#11' AS classes_match FROM summary",
    "registry_proposal": f"""WITH {_REGISTRY}, {_INTAKE}, t AS (SELECT trim(dataset_id) AS dataset_id, trim(name) AS name, trim(license_verified) AS license_verified, lower(trim(usage_status)) AS u, count(*) OVER (PARTITION BY trim(dataset_id)) AS n FROM registry)
SELECT dataset_id, name, license_verified, 'downloaded' AS usage_status, 'pending QA' AS notes, '2024-01-02' AS download_date, image_record_count::VARCHAR AS image_count_downloaded, annotation_count::VARCHAR AS bbox_count_reported,
  valid_bbox_count::VARCHAR AS bbox_count_valid, (image_record_count - missing_image_count)::VARCHAR AS accepted_image_count, missing_image_count::VARCHAR AS rejected_image_count,
  CASE WHEN invalid_bbox_count = 0 AND invalid_segmentation_count = 0 THEN 'downloaded_structural_qa_pass' ELSE 'downloaded_structural_qa_failed' END AS bbox_quality_status,
  'external_exact_hash_inventory_complete' AS sha256_dedup_status, 'pending' AS perceptual_hash_status, 'pending' AS internal_cross_dedup_status, 'data/raw' AS local_raw_path
FROM t, summary WHERE n = 1 AND lower(license_verified) <> 'no' AND u = 'approved_for_download'""",
    "proposal_errors": f"""WITH r AS (SELECT 'D' || (s_suppkey * 9 // 10) AS d, count(*) AS n, arg_min({_case(["NOT_YET_APPROVED", "NOT_YET_APPROVED", "APPROVED"], "s_suppkey")}, s_suppkey) AS a FROM supplier GROUP BY ALL),
p AS (SELECT s_suppkey AS k, 'D' || s_suppkey AS d, {_case(["x", "x", "x", "y"], "s_suppkey")} AS name, {_case(["data/raw", "data/raw", "", "elsewhere"], "s_suppkey // 2")} AS path FROM supplier),
j AS (SELECT p.*, a, coalesce(n, 0) = 1 AS one FROM p LEFT JOIN r USING (d))
SELECT d AS dataset_id, 'registry_not_one_row' AS code, 'dataset_id' AS "column" FROM j WHERE NOT one UNION ALL SELECT d, 'identity_mismatch', 'name' FROM j WHERE one AND name <> 'x'
UNION ALL SELECT d, 'protected_mismatch', 'training_acceptance' FROM j WHERE one AND a <> 'NOT_YET_APPROVED' UNION ALL SELECT d, 'path_empty', 'local_raw_path' FROM j WHERE one AND path = ''
UNION ALL SELECT d, 'path_mismatch', 'local_raw_path' FROM j WHERE one AND path = 'elsewhere'""",
    "mapping_errors": """SELECT 'not_one_row' AS code FROM region HAVING count(*) <> 1 UNION ALL SELECT 'dataset_mismatch' FROM region HAVING count(*) FILTER (r_regionkey % 2 = 1) > 0""",
    "cell_values": f"""WITH r AS (SELECT p_partkey, p_size, p_brand, {_case(["=", "+", "-", "@", "", " "], "p_partkey")} || p_name AS raw, trim({_case(["12", " 7.5 ", "-3", "NaN", "x1", "0", "1e3", ""], "p_partkey")}) AS num FROM part)
SELECT p_partkey, CASE WHEN raw[1] IN ('=', '+', '-', '@') THEN '''' || raw ELSE raw END AS cell, CASE WHEN p_partkey % 3 = 0 THEN trim(raw) ELSE '' END AS scalar,
  strftime(to_timestamp(p_partkey * 1000) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S+00:00') AS at,
  CASE WHEN num IN ('12', '7.5', '1e3') THEN num::DOUBLE END AS number, CASE WHEN num IN ('12', '7.5', '1e3') THEN '' WHEN num = 'NaN' THEN 'not_finite' WHEN num IN ('-3', '0') THEN 'not_positive' ELSE 'not_numeric' END AS number_code,
  CASE WHEN num IN ('12', '-3', '0') THEN num::BIGINT END AS whole, CASE WHEN num IN ('12', '-3', '0') THEN '' ELSE 'not_numeric' END AS whole_code,
  sha256('{{"a":"' || p_brand || '","b":' || p_size || '}}') AS checksum FROM r""",
    "candidate_overflow": f"""WITH {HASH_SQL}, p AS (SELECT a.record_id AS a, b.record_id AS b FROM rec a JOIN rec b ON a.record_id < b.record_id WHERE {BANDS_SQL})
SELECT record_id FROM (SELECT a AS record_id FROM p UNION ALL SELECT b FROM p) GROUP BY record_id HAVING count(*) > {CAP}""",
    "difference_hashes": """SELECT vec_id, string_agg(printf('%X', 8 * a + 4 * b + 2 * c + d), '' ORDER BY h) AS dhash FROM (
  SELECT vec_id, i // 4 AS h, max(bit) FILTER (i % 4 = 0) AS a, max(bit) FILTER (i % 4 = 1) AS b, max(bit) FILTER (i % 4 = 2) AS c, max(bit) FILTER (i % 4 = 3) AS d FROM (
    SELECT vec_id, i, (embedding[((i // 8 * 9 + i % 8) * 5) % 64 + 1] > embedding[((i // 8 * 9 + i % 8 + 1) * 5) % 64 + 1])::INT AS bit FROM embeddings, range(64) t(i)) GROUP BY ALL) GROUP BY vec_id""",
    "promoted_labels": "SELECT o_orderkey::VARCHAR AS review_id, o_custkey::VARCHAR AS image_id, o_orderpriority AS source_bucket, o_orderstatus AS original_path, o_orderstatus AS filename, "
    + ", ".join(f"CASE WHEN o_orderkey % 5 = {i} THEN '' ELSE o_orderstatus END AS {c}" for i, c in enumerate(L.SEED[:5]))
    + ", 'pending' AS review_status, CASE WHEN o_orderkey % 5 = 1 THEN '' ELSE o_orderstatus END AS reviewer, '' AS reviewed_at, '' AS review_notes FROM orders",
    "review_field_errors": f"""WITH r AS (SELECT o_orderkey AS k, o_orderkey + 2 AS row_number, {_case(["reviewed", "pending", "done"], "o_orderkey")} AS s, {_case(["correct", "", "wrong"], "o_orderkey // 2")} AS q,
  {_case(["low", "high", "urgent", ""], "o_orderkey // 3")} AS p, {_case(["yes", "no", "maybe"], "o_orderkey // 5")} AS c, {_case(["confirmed", ""], "o_orderkey // 7")} AS d, {_case(["ann", ""], "o_orderkey // 11")} AS w FROM orders)
SELECT row_number, 'source_case_fingerprint' AS "column", 'SOURCE_FINGERPRINT_MISMATCH' AS code FROM r WHERE k % 21 = 0
UNION ALL SELECT row_number, 'original_image_relpath', 'FORBIDDEN_PATH' FROM r WHERE k % 5 IN (1, 2, 4)
UNION ALL SELECT row_number, 'review_status', 'INVALID_CONTROLLED_VALUE' FROM r WHERE s = 'done' UNION ALL SELECT row_number, 'annotation_quality', 'INVALID_CONTROLLED_VALUE' FROM r WHERE q = 'wrong'
UNION ALL SELECT row_number, 'retraining_priority', 'INVALID_CONTROLLED_VALUE' FROM r WHERE p = 'urgent' UNION ALL SELECT row_number, 'correction_proposal_required', 'INVALID_CONTROLLED_VALUE' FROM r WHERE c = 'maybe'
UNION ALL SELECT row_number, 'annotation_quality', 'MISSING_REVIEW_FIELD' FROM r WHERE s = 'reviewed' AND q = '' UNION ALL SELECT row_number, 'retraining_priority', 'MISSING_REVIEW_FIELD' FROM r WHERE s = 'reviewed' AND p = ''
UNION ALL SELECT row_number, 'error_disposition', 'MISSING_REVIEW_FIELD' FROM r WHERE s = 'reviewed' AND d = '' UNION ALL SELECT row_number, 'reviewer', 'MISSING_REVIEW_FIELD' FROM r WHERE s = 'reviewed' AND w = ''""",
    "batch_errors": """SELECT code, "column" FROM (VALUES ('ROW_COUNT_MISMATCH', '', (SELECT count(*) <> 5 FROM orders)), ('BLANK_IDENTITY', 'review_case_id', (SELECT count(*) > 0 FROM orders WHERE o_orderkey % 300 = 0)),
  ('DUPLICATE_IDENTITY', 'review_case_id', (SELECT count(*) > 1 FROM orders WHERE o_orderkey % 300 = 0)), ('DUPLICATE_IDENTITY', 'image_id', (SELECT count(DISTINCT o_orderkey % 400) <> count(*) FROM orders)),
  ('THRESHOLD_CANDIDATE_MISMATCH', 'threshold_candidate', (SELECT count(*) > 0 FROM orders WHERE o_orderkey % 50 = 0))) v(code, "column", broken) WHERE broken""",
    "scoped_values": f"""WITH r AS (SELECT p_partkey, {_case(OUTCOMES, "p_partkey")} AS o, {_case(["correct", "defect_suspected", "not_applicable"], "p_partkey // 2")} AS q, {_case(["low", "not_applicable"], "p_partkey // 3")} AS p FROM part)
SELECT p_partkey, 'annotation_quality' AS field, q AS value FROM r WHERE CASE o WHEN 'annotation_issue' THEN q <> 'defect_suspected' WHEN 'invalid_image' THEN q <> 'not_applicable' WHEN 'ambiguous' THEN q <> 'not_applicable' ELSE q = 'defect_suspected' END
UNION ALL SELECT p_partkey, 'retraining_priority', p FROM r WHERE CASE WHEN o IN ('annotation_issue', 'invalid_image', 'ambiguous') THEN p = 'low' WHEN o = 'model_miss' THEN p <> 'low' ELSE false END""",
    "package_targets": """SELECT c_custkey % 140 AS image_id, 'image_not_found' AS code FROM customer WHERE c_custkey % 17 = 0
UNION ALL SELECT c_custkey % 140, 'duplicate_target' FROM customer WHERE c_custkey % 140 IN (SELECT c_custkey % 140 FROM customer GROUP BY 1 HAVING count(*) > 1)""",
    "outcome_notes": f"""SELECT p_partkey, CASE o WHEN 'ambiguous' THEN '需要進一步人工判斷。' WHEN 'annotation_issue' THEN '明確懷疑原始標註有缺陷，僅提出修正建議。' ELSE '' END AS review_notes,
  CASE o WHEN 'annotation_issue' THEN 'missing_bbox' ELSE 'none' END AS annotation_defect_type FROM (SELECT p_partkey, {_case(OUTCOMES, "p_partkey")} AS o FROM part)""",
    "correction_fields": f"""WITH {_CORRECTION} SELECT k AS o_orderkey, status AS correction_review_status, decision AS correction_decision, op AS correction_operation,
  CASE WHEN len(t) = 0 THEN '[]' ELSE '["' || array_to_string(t, '","') || '"]' END AS target_gt_bbox_ids_json,
  CASE WHEN box THEN printf('{{"x1":%.1f,"x2":%.1f,"y1":%.1f,"y2":%.1f}}', x1, x2, y1, y2) ELSE '' END AS replacement_bbox_coordinates_json, CASE WHEN blank THEN '' ELSE 'why' END AS correction_reason,
  'ann' AS correction_reviewer, '2024-01-02T03:04:05+00:00' AS correction_reviewed_at_utc FROM e WHERE code = '' AND k % 5 <> 0 AND k // 2 % 2 = 0""",
    "deduplication_report": f"""WITH {CONTENT_SQL}, {HASH_SQL}, g AS (SELECT count(*) AS n, count(*) FILTER (source_scope = 'external') AS x FROM file GROUP BY sha256 HAVING count(*) > 1),
p AS (SELECT a.source_scope AS a, b.source_scope AS b FROM rec a JOIN rec b ON a.record_id < b.record_id WHERE bit_count(xor(a.phash, b.phash)) <= 18 AND abs(a.aspect_ratio - b.aspect_ratio) / greatest(a.aspect_ratio, b.aspect_ratio) <= 0.10)
SELECT 'd' AS dataset_id, count(*) FILTER (source_scope = 'internal') AS internal_image_count, count(*) FILTER (source_scope = 'external') AS external_image_count, count(*) AS total_image_count, count(*) AS hash_success_count, 0::BIGINT AS hash_error_count,
  (SELECT count(*) FROM g WHERE x >= 2) AS external_external_exact_group_count, (SELECT coalesce(sum(x), 0)::BIGINT FROM g WHERE x >= 2) AS external_external_exact_image_count,
  (SELECT count(*) FROM g WHERE x > 0 AND x < n) AS internal_external_exact_group_count, (SELECT coalesce(sum(n), 0)::BIGINT FROM g WHERE x > 0 AND x < n) AS internal_external_exact_image_count,
  (SELECT count(*) FROM p WHERE a = 'external' AND b = 'external') AS external_external_perceptual_candidate_count, (SELECT count(*) FROM p WHERE a <> b) AS internal_external_perceptual_candidate_count,
  'complete' AS sha256_dedup_recommendation, 'completed_candidates_pending_review' AS perceptual_hash_recommendation, 'completed_candidates_pending_review' AS internal_cross_dedup_recommendation, 'NOT_YET_APPROVED' AS training_acceptance FROM file""",
}
