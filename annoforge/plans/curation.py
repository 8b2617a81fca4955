"""Queries of deduplication, review, split reports and findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from annoforge.functions import text as T
from annoforge.operators import checks as C
from annoforge.operators import digests as D
from annoforge.operators import events as E
from annoforge.operators import findings as A
from annoforge.operators import review as R
from annoforge.operators import schemas as V
from annoforge.operators import similarity as S
from annoforge.plans.bindings import CONTENT_SQL, HASH_SQL, content, hash_records, table

NEAR, WIDE = 6, 18
CROSS = {("internal", "external")}
PRIORITY = {"1-URGENT": 10, "2-HIGH": 20, "3-MEDIUM": 30}
SEED = 42

# --- duplicates


def exact_dup_groups(spark, sf):
    return S.exact_groups(content(spark, sf), CROSS)


def exact_dup_members(spark, sf):
    return S.exact_members(content(spark, sf), CROSS)


def _pairs(spark, sf, distance):
    columns = ["candidate_id", "left_record_id", "right_record_id", "left_source_scope", "right_source_scope", "phash_distance", "aspect_difference"]
    return S.similar_pairs(hash_records(spark, sf), distance, 0.10).select(*columns)


def similar_pairs(spark, sf):
    return _pairs(spark, sf, WIDE)


def similar_pairs_near(spark, sf):
    return _pairs(spark, sf, NEAR)


def similar_pairs_cross(spark, sf):
    return S.similar_pairs(hash_records(spark, sf), WIDE, 0.10, scopes=CROSS).select("left_record_id", "right_record_id", "phash_distance")


def similar_classes(spark, sf):
    return S.class_pairs(hash_records(spark, sf), WIDE, 0.10, scopes=CROSS)


def similar_links(spark, sf):
    return S.similar_links(hash_records(spark, sf), WIDE, 0.10)


def candidate_counts(spark, sf):
    return S.candidate_counts(hash_records(spark, sf), NEAR)


def dedup_summary(spark, sf):
    return S.dedup_summary(content(spark, sf), S.pair_counts(hash_records(spark, sf), WIDE, 0.10))


# --- review


def _metadata(spark, sf):
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    return o.select(
        T.sha1_id(F.col("o_orderpriority"), key).alias("image_id"), F.col("o_orderpriority").alias("source_bucket"), F.concat(F.lit("/in/"), F.col("o_orderpriority"), F.lit("/"), key).alias("original_path"),
        F.concat(key, F.lit(".jpg")).alias("filename"), F.when(F.col("o_orderstatus") == "F", "False").otherwise(" TRUE ").alias("is_readable"),
    )


def _queue(spark, sf):
    return R.review_queue(_metadata(spark, sf), PRIORITY)


def review_queue(spark, sf):
    return R.in_order(_queue(spark, sf), 500).select("review_id", "image_id", "source_bucket", "filename", "quality_status", "priority", "priority_reason", "photo_type_review", "review_status")


def queue_summary(spark, sf):
    return R.counts_by(_queue(spark, sf), "source_bucket", "quality_status")


def _labelled(spark, sf):
    """documents with their labels as reviews: no label is pending; the source gives the photo type."""
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = d.select("doc_id", "lang", "source").join(l, "doc_id", "left")
    kind = F.when(F.col("lang") == "en", " Exterior").when(F.col("lang") == "de", "interior").when(F.col("lang") == "fr", "low_quality").otherwise("irrelevant")
    severity = F.when(F.col("toxic") == 1, F.when(F.col("quality") == 1, "minor").otherwise("severe")).when(F.col("toxic") == 0, "none").otherwise("unknown")
    return rows.select(
        "doc_id", F.col("doc_id").cast("string").alias("image_id"), T.sha1_id(F.col("doc_id"), F.col("lang")).alias("review_id"), F.concat(F.lit("/d/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("original_path"),
        "lang", "source", kind.alias("photo_type_review"), F.when(F.col("quality") == 1, "1").otherwise("0").alias("is_exterior_review"), F.coalesce(F.col("toxic").cast("string"), F.lit("unknown")).alias("has_visible_damage_review"),
        severity.alias("severity_review"), F.when(F.col("quality").isNull(), "pending").otherwise("reviewed").alias("review_status"), F.when(F.col("doc_id") % 3 == 0, "").otherwise("ann").alias("reviewer"),
    )


def route_reviewed(spark, sf):
    parts = [r.select(F.lit(name).alias("route"), "image_id", "severity_review") for name, r in R.routes(R.eligible(_labelled(spark, sf))).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reviewed_summary(spark, sf):
    s = T.lowered(F.col("review_status"))
    return _labelled(spark, sf).agg(F.count("*").alias("total_rows"), F.count_if(s == "reviewed").alias("reviewed_rows"), F.count_if(s == "pending").alias("pending_rows"), F.count_if(T.lowered(F.col("photo_type_review")) == "exterior").alias("exterior_rows"), F.count_if(F.col("has_visible_damage_review") == "1").alias("damage_rows"))


def task_manifest(spark, sf):
    return R.annotation_tasks(_labelled(spark, sf), {"severe": 10, "minor": 30, "none": 80})


def hash_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("name"))
    return R.hash_split(o, F.col("o_orderkey"), "name", SEED, (0.7, 0.2, 0.1)).select("o_orderkey", "position", "split")


def round_robin(spark, sf):
    return R.round_robin(table(spark, sf, "customer").select("c_custkey", "c_name"), ["r1", "r2", "r3"], "c_name", "c_custkey").select("c_custkey", "assignment_order", "reviewer_id")


def stratified_sample(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return R.stratified(o, "o_orderpriority", ["1-URGENT", "2-HIGH"], 400, SEED, "o_orderkey")


def first_seen_dups(spark, sf):
    return C.first_seen(content(spark, sf), "sha256", "record_id")


def duplicate_counts(spark, sf):
    return C.duplicate_counts(content(spark, sf), "sha256")


def keep_last(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return R.keep_last(e, "user_id", "event_id")


def latest_revision(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select("user_id", "event_type", F.col("event_id").alias("revision"), "value")
    return R.latest(rows.withColumn("k", F.concat_ws("|", "user_id", "event_type")), "k", "revision").drop("k")


def contiguity_gaps(spark, sf):
    """Order keys moved on by one after every ten."""
    moved = F.col("o_orderkey") + F.floor(F.col("o_orderkey") / 10)
    return C.gaps(table(spark, sf, "orders").withColumn("o_orderkey", moved), "o_orderkey")


def time_reversals(spark, sf):
    e = table(spark, sf, "events").withColumn("position", F.expr("event_id + 1 - 2 * (event_id % 2)"))
    return E.time_reversals(e, "user_id", "position", "ts").select("user_id", "position")


def later_references(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, F.get_json_object("props", "$.k").cast("bigint") * 7).alias("refers_to"))
    return C.later_references(e.withColumn("position", F.col("event_id")), "event_id", "position", "refers_to")


def suggestion_merge(spark, sf):
    base = _labelled(spark, sf)
    labels = base.select("image_id", F.when(F.col("doc_id") % 2 == 0, " unknown").otherwise(F.col("photo_type_review")).alias("photo_type_review"), F.lit("").alias("angle_review"), "is_exterior_review", "review_status", "reviewer", F.when(F.col("doc_id") % 5 == 0, "seen").otherwise("").alias("review_notes"))
    s = table(spark, sf, "documents")  # a quarter of the suggestions are for images that are not there
    c = (F.col("n_chars") % 100).cast("double") / 100
    suggestions = s.select(
        F.when(F.col("doc_id") % 4 == 1, F.concat(F.lit("x"), F.col("doc_id").cast("string"))).otherwise(F.col("doc_id").cast("string")).alias("image_id"), F.col("doc_id").alias("position"), F.when(F.col("lang") == "en", "Exterior").when(F.col("lang") == "de", "low-quality").otherwise("banana").alias("suggested_photo_type_review"),
        F.format_string("%.2f", c).alias("photo_type_confidence"), F.lit("front left").alias("suggested_angle_review"), F.when(F.col("doc_id") % 6 == 0, "1.0").otherwise("x").alias("angle_confidence"), F.when(F.col("doc_id") % 8 == 0, " seen ").otherwise("").alias("auto_review_notes"),
    )
    return R.merge_suggestions(labels, suggestions)


def suggestion_join_errors(spark, sf):
    d, l = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id", "quality")
    return R.join_suggestions(d, l, "doc_id")[1]


def semi_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return o.join(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")


def anti_join(spark, sf):
    return C.orphans(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


def full_diff(spark, sf):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(F.when(k % 11 == 0, -1 - k).otherwise(k).alias("k"))
    return R.id_differences(o, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


def keys_equal(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return R.same_keys(o, table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), "k")


def concatenated_overlaps(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    return R.concatenate([c, c.withColumn("c_custkey", F.when(k % 3 == 0, k).otherwise(-1 - k))], "c_custkey")[1]


def fill_by_key(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.lit("old").alias("verdict"))
    l = table(spark, sf, "labels").groupBy("doc_id").agg(F.max(F.concat(F.lit("q"), F.col("quality").cast("string"))).alias("verdict"))
    return R.fill_by_key(d, l, "doc_id", ["verdict"])


def positional_diff(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    k = F.col("o_orderkey")
    changed = o.select(F.when(k % 13 == 0, -1 - k).otherwise(k).alias("o_orderkey"), F.when(k % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "o_orderpriority")
    return C.positional_differences(o, changed, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


def case_view(spark, sf):
    l = table(spark, sf, "labels").select("doc_id", F.lit("reviewed").alias("review_status"), F.col("quality").cast("bigint").alias("revision"))
    return R.case_view(table(spark, sf, "documents").select("doc_id", "lang"), l, "doc_id", {"review_status": "pending", "revision": 0})


def named_views(spark, sf):
    rows = case_view(spark, sf).withColumns({"retraining_priority": F.when(F.col("revision") == 1, "high").otherwise("low"), "annotation_quality": F.when(F.col("lang") == "de", "defect_suspected").otherwise("ok")})
    parts = [R.view(rows, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("view"), "n") for n in R.VIEWS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def adjacent_cases(spark, sf):
    return E.neighbours(table(spark, sf, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


def record_search(spark, sf):
    return R.search(table(spark, sf, "part").select("p_partkey", "p_name", "p_type"), "Cold Wid", ["p_name", "p_type"])


def canonical_review(spark, sf):
    """Selections made of part attributes, with the code of the first rule that each breaks."""
    p = table(spark, sf, "part")
    outcomes = F.array(*[F.lit(o[0]) for o in R.OUTCOMES], F.lit("bogus"))
    k = F.col("p_partkey")
    rows = p.select(
        "p_partkey", F.get(outcomes, (k % 9).cast("int")).alias("outcome"), F.when(k % 5 == 0, "other").otherwise("weak").alias("reason"), F.when(k % 4 == 0, "defect_suspected").otherwise("ok").alias("annotation_quality"),
        F.when(k % 4 == 0, F.when(k % 3 == 0, "none").otherwise("missing_bbox")).otherwise("none").alias("annotation_defect_type"), F.when(k % 8 == 0, "create_annotation_correction_proposal").otherwise("adjust").alias("recommended_action"),
        F.when(k % 6 == 0, "high").otherwise("low").alias("retraining_priority"), F.when(k % 7 == 0, " ").otherwise("bob").alias("reviewer"), F.when(k % 2 == 0, "note").otherwise(" ").alias("review_notes"),
    )
    return R.canonical_fields(rows).select("p_partkey", "outcome", "error_disposition", "review_status", "correction_proposal_required", "error_code")


def schema_evolution(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    out = R.evolve(s.withColumn("id", F.col("s_suppkey").cast("string")), "id", {"status": "draft", "reviewer": ""}, "7", {"status": "approved"}).drop("id")
    return R.promote(out, {"s_name": "name"}, ["s_suppkey", "name", "status", "reviewer"])


def row_overlay(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    proposal = s.where("s_suppkey = 3").withColumn("s_name", F.lit("renamed"))
    return R.overlay(s, proposal, "s_suppkey", ["s_name"])


def applied_state(spark, sf):
    s = row_overlay(spark, sf)
    return C.applied_state(s, F.col("s_suppkey") == 3, [F.col("s_name") == "renamed", F.col("s_nationkey") == -1])


# --- splits and findings


def _families(spark, sf, by):
    o = table(spark, sf, "orders")
    h = F.substring(F.sha1(F.encode(F.col(by).cast("string"), "UTF-8")), 1, 1)
    split = F.when(h < "a", "train").when(h < "d", "valid").otherwise("test")
    n = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_boxes"))
    rows = o.join(n, "o_orderkey", "left").na.fill(0, ["n_boxes"])
    return rows.select("o_orderkey", F.col("o_custkey").alias("family"), split.alias("split"), (F.col("o_orderstatus") != "P").alias("included"), "n_boxes")


def family_leakage(spark, sf):
    return A.leaking_groups(_families(spark, sf, "o_orderkey"), "family", "split")


def family_leakage_safe(spark, sf):
    return A.leaking_groups(_families(spark, sf, "o_custkey"), "family", "split").agg(F.count("*").alias("leaking_families"))


def split_summary(spark, sf):
    images = _families(spark, sf, "o_custkey")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_quantity") / 80).alias("area_ratio"))
    return A.split_summary(images, li.join(images.where("included").select("o_orderkey", "split"), "o_orderkey"))


def inconsistent_families(spark, sf):
    return A.inconsistent_groups(_families(spark, sf, "o_custkey"), "family", "n_boxes")


def plan_resolution(spark, sf):
    """Plan rows matched to sources by split and base name, and those that are not."""
    o = table(spark, sf, "orders")
    plan = o.select("o_orderkey", F.concat(F.lit("a/b/"), F.col("o_orderkey").cast("string"), F.lit(".JPG")).alias("path"), F.col("o_orderstatus").alias("split"))
    have = table(spark, sf, "lineitem").select(F.concat(F.col("l_orderkey").cast("string"), F.lit(".JPG")).alias("name")).distinct()
    joined = plan.withColumn("name", T.base_name(F.col("path"))).join(have.withColumn("found", F.lit(True)), "name", "left")
    return joined.select("o_orderkey", "split", "name", T.suffix(F.col("path")).alias("suffix"), T.stem(F.col("path")).alias("stem"), F.coalesce("found", F.lit(False)).alias("resolved"))


def split_rollup(spark, sf):
    li = table(spark, sf, "lineitem")
    return A.with_total(li, "l_returnflag", F.count("*").alias("n_rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"), F.count_if(F.col("l_linenumber") == 1).alias("firsts"))


def distribution(spark, sf):
    return A.distribution(table(spark, sf, "events"), "event_type").withColumn("percentage", F.round("percentage", 4))


def _pairs_seen(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")


def cross_tab(spark, sf):
    rows = _pairs_seen(spark, sf).withColumn("quality_toxic", F.concat(F.lit("q"), F.col("quality"), F.lit("t"), F.col("toxic")))
    return A.cross_tab(rows, "lang", "quality_toxic", ["q0t0", "q0t1", "q1t0", "q1t1"])


def tvd(spark, sf):
    return A.total_variation(_pairs_seen(spark, sf), "lang", F.col("quality") == 0).select(F.round("tvd", 9).alias("tvd"))


def _decisions(spark, sf):
    return _pairs_seen(spark, sf).select(
        F.when(F.col("doc_id") % 10 == 0, "low").otherwise("high").alias("scope_confidence"), F.when(F.lit(False), "defect_suspected").otherwise("ok").alias("annotation_quality"),
        F.when(F.col("quality") == 1, "IN_SCOPE").otherwise("HEAVY").alias("scope_group"), F.when(F.col("toxic") == 1, "high").when(F.col("lang") == "de", "medium").otherwise("low").alias("retraining_priority"),
        F.when(F.col("doc_id") % 2 == 0, "confirmed_model_error").otherwise("expected_threshold_tradeoff").alias("error_disposition"),
    )


def recommendation(spark, sf):
    out = A.recommendation(_decisions(spark, sf))
    return out.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in out.dtypes])


def action_ranking(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select(F.when(F.col("event_type") == "view", "no_action").otherwise(F.col("event_type")).alias("recommended_action"), F.get(F.array(F.lit("high"), F.lit("medium"), F.lit("low"), F.lit("not_applicable")), (F.col("user_id") % 4).cast("int")).alias("retraining_priority"))
    return A.action_ranking(rows)


def two_key_counts(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


def progress_and_gate(spark, sf):
    o = table(spark, sf, "orders").select((F.col("o_orderkey") % 5).alias("weight"), (F.col("o_orderkey") % 101).alias("progress"), F.when(F.col("o_orderstatus") == "P", "caution").otherwise("clear").alias("state"))
    return A.weighted_progress(o, "weight", "progress").select(F.round("progress", 9).alias("progress")).crossJoin(A.gate_summary(o, "state"))


# --- validation


def _numbered(spark, sf):
    return _labelled(spark, sf).withColumn("row_number", F.col("doc_id") + 2)


DOMAINS = {"photo_type_review": ["exterior", "interior", "low_quality", "irrelevant", "unknown"], "severity_review": ["none", "minor", "moderate", "unknown"]}


def validate_domain(spark, sf):
    rows = _numbered(spark, sf)
    return C.rule_errors(rows, [*C.identity_rules(["reviewer"]), *C.domain_rules(DOMAINS)])


def validate_domain_normalised(spark, sf):
    return C.rule_errors(_numbered(spark, sf), C.domain_rules(DOMAINS, normalised=True))


def validate_rules(spark, sf):
    rows = _numbered(spark, sf).withColumn("photo_type_review", T.lowered(F.col("photo_type_review")))
    return C.rule_errors(rows, C.label_rules())


def _pilot(spark, sf):
    rows = _numbered(spark, sf)
    k = F.col("doc_id")
    named = rows.withColumnsRenamed({c: f"human_{c}" for c in ("photo_type_review", "is_exterior_review", "has_visible_damage_review", "severity_review", "reviewer", "review_status")})
    status = F.when(k % 9 == 0, "skipped").otherwise(F.col("human_review_status"))
    return named.withColumns({"human_review_status": status, "human_reviewed_at": F.when(k % 4 == 0, "").when(k % 4 == 1, "yesterday").otherwise("2026-01-02T03:04:05Z"), "human_angle_review": F.when(k % 2 == 0, "").otherwise("front"), "human_review_notes": F.when(k % 5 == 0, "").otherwise("n")})


def validate_pilot(spark, sf):
    return C.rule_errors(_pilot(spark, sf), [*C.pilot_rules(), *C.status_rules()]).select("row_number", "column", "code")


def validation_summary(spark, sf):
    rows = _numbered(spark, sf)
    return C.invalid_row_count(rows, C.rule_errors(rows, C.domain_rules(DOMAINS, normalised=True)))


def expected_counts(spark, sf):
    return C.expected_counts(table(spark, sf, "region").join(table(spark, sf, "nation"), F.col("r_regionkey") == F.col("n_regionkey")), "r_name", {"AFRICA": 5, "ASIA": 4, "ATLANTIS": 1})


def row_fingerprint(spark, sf):
    n = table(spark, sf, "nation")
    return n.select("n_nationkey", T.row_fingerprint(F.col("n_nationkey"), F.col("n_name"), F.col("n_regionkey")).alias("fingerprint"))


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def _placed_orders(spark, sf):
    return R.positions(table(spark, sf, "orders").select(*_ORDER_COLUMNS), "o_orderkey")


def frame_fingerprint(spark, sf):
    """Digests of ranges of orders, by order key."""
    return D.range_digests(_placed_orders(spark, sf), "position", _ORDER_COLUMNS)


def frame_total(spark, sf):
    """Digest of orders as a whole, in order and not in order."""
    o = _placed_orders(spark, sf)
    return D.frame_digest(o, "position", _ORDER_COLUMNS).select(F.lit("ordered").alias("kind"), "*").unionByName(D.frame_digest(o, None, _ORDER_COLUMNS).select(F.lit("as a set").alias("kind"), "*"))


def first_difference(spark, sf):
    """The first of the orders that another frame has with another status."""
    o = _placed_orders(spark, sf)
    other = o.withColumn("o_orderstatus", F.when(F.col("position") % 700 == 0, "?").otherwise(F.col("o_orderstatus")))
    return D.first_difference(o, other, "position").select("position", F.col("left_row.o_orderkey").alias("o_orderkey"), F.col("left_row.o_orderstatus").alias("before"), F.col("right_row.o_orderstatus").alias("after"))


#: What properties of events may be.
_PROPS = {"type": "object", "required": ["k"], "additionalProperties": False, "properties": {"k": {"type": "integer", "minimum": 5, "exclusiveMaximum": 95, "not": {"const": 50}}}}


def schema_violations(spark, sf):
    """Properties of events that break their schema."""
    return V.violations(table(spark, sf, "events"), "props", _PROPS, "event_id")


def evidence_phrases(spark, sf):
    return C.phrase_errors(table(spark, sf, "pages"), "page_id", "html", ["<HTML", "cookie", "licence"])


def path_rules(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    path = F.when(k % 5 == 0, "/abs/x.png").when(k % 5 == 1, "a/../b.png").when(k % 5 == 2, "a/TEST/b.PNG").when(k % 5 == 3, "c:\\x\\y.tar.gz").otherwise("ok/é.jpeg")
    rows = o.select("o_orderkey", path.alias("path"))
    return rows.select("o_orderkey", T.safe_path(F.col("path")).alias("safe"), T.base_name(F.col("path")).alias("base"), T.suffix(F.col("path")).alias("suffix"), T.due(k, 25).alias("due"))


def normalised_text(spark, sf):
    c = table(spark, sf, "customer")
    raw = F.concat(F.lit(" \t"), F.col("c_mktsegment"), F.lit(" -X\n"))
    flag = F.get(F.array(*[F.lit(x) for x in (" Yes", "Y", "true ", "no", "", "0")]), (F.col("c_custkey") % 6).cast("int"))
    return c.select("c_custkey", T.lowered(raw).alias("lowered"), T.underscored(raw).alias("underscored"), T.truthy(flag).alias("queue_true"), T.truthy(flag, "audit").alias("audit_true"), T.tri_state(flag).alias("tri"), T.formula_like(F.col("c_name")).alias("formula"), T.hex_digest(F.col("c_name")).alias("hex"))


# --- events


def gap_sessions(spark, sf):
    return E.gap_sessions(table(spark, sf, "events"), "user_id", "ts", 600, "event_id")


def gap_sessions_long(spark, sf):
    return E.gap_sessions(table(spark, sf, "events"), "user_id", "ts", 43200, "event_id", split_days=True)


def before_after_pairs(spark, sf):
    """Extension: the source describes it without code."""
    return E.pair_before_after(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_orderkey", 30 * 86400)


def event_mirror(spark, sf):
    return E.mirror_after(table(spark, sf, "events").select("event_id", "user_id", "event_type"), "event_id", 600)


_names = [n for n, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not n.startswith("_")]
QUERIES = {n: globals()[n] for n in _names}

_LABELLED = """
lab AS (SELECT d.doc_id, d.doc_id::VARCHAR AS image_id, substr(sha1(concat_ws('|', d.doc_id, lang)), 1, 16) AS review_id, concat('/d/', source, '/', d.doc_id) AS original_path, lang, source,
  CASE lang WHEN 'en' THEN ' Exterior' WHEN 'de' THEN 'interior' WHEN 'fr' THEN 'low_quality' ELSE 'irrelevant' END AS photo_type_review,
  CASE WHEN quality = 1 THEN '1' ELSE '0' END AS is_exterior_review, coalesce(toxic::VARCHAR, 'unknown') AS has_visible_damage_review,
  CASE WHEN toxic = 1 THEN CASE WHEN quality = 1 THEN 'minor' ELSE 'severe' END WHEN toxic = 0 THEN 'none' ELSE 'unknown' END AS severity_review,
  CASE WHEN quality IS NULL THEN 'pending' ELSE 'reviewed' END AS review_status, CASE WHEN d.doc_id % 3 = 0 THEN '' ELSE 'ann' END AS reviewer
  FROM documents d LEFT JOIN labels USING (doc_id))"""
_META = """
meta AS (SELECT substr(sha1(concat_ws('|', o_orderpriority, o_orderkey)), 1, 16) AS image_id, o_orderpriority AS source_bucket, concat('/in/', o_orderpriority, '/', o_orderkey) AS original_path,
  concat(o_orderkey, '.jpg') AS filename, o_orderstatus <> 'F' AS ok FROM orders),
q AS (SELECT substr(sha1(concat_ws('|', image_id, source_bucket, original_path)), 1, 16) AS review_id, image_id, source_bucket, filename, CASE WHEN ok THEN 'ready' ELSE 'unreadable' END AS quality_status,
  (CASE source_bucket WHEN '1-URGENT' THEN 10 WHEN '2-HIGH' THEN 20 WHEN '3-MEDIUM' THEN 30 ELSE 90 END + CASE WHEN ok THEN 0 ELSE 100 END)::INT AS priority,
  concat('source_bucket=', source_bucket, CASE WHEN ok THEN '' ELSE '; unreadable' END) AS priority_reason, 'unknown' AS photo_type_review, 'pending' AS review_status FROM meta)"""


_HASHED = """w AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS p, concat_ws(chr(31), o_orderkey, o_custkey, o_orderstatus, o_orderpriority) AS w FROM orders), h AS (SELECT p, w, md5(p || chr(31) || w) AS h FROM w)"""
_DIGEST = "md5(count(*) || ':' || sum(('0x' || substr(h, 1, 16))::UBIGINT::HUGEINT) || ':' || sum(('0x' || substr(h, 17, 16))::UBIGINT::HUGEINT))"


def _near(distance, more="", columns="*"):
    return f"""WITH {HASH_SQL}, p AS (SELECT 'perceptual-' || substr(sha256(a.record_id || chr(10) || b.record_id), 1, 16) AS candidate_id, a.record_id AS left_record_id, b.record_id AS right_record_id,
  a.source_scope AS left_source_scope, b.source_scope AS right_source_scope, bit_count(xor(a.phash, b.phash))::INT AS phash_distance,
  abs(a.aspect_ratio - b.aspect_ratio) / greatest(a.aspect_ratio, b.aspect_ratio) AS aspect_difference FROM rec a JOIN rec b ON a.record_id < b.record_id
  WHERE bit_count(xor(a.phash, b.phash)) <= {distance} {more}) SELECT {columns} FROM p WHERE aspect_difference <= 0.10"""


_bands6 = " OR ".join(f"substr(a.phash::VARCHAR, {1 + sum(w for w in ws[:i])}, {ws[i]}) = substr(b.phash::VARCHAR, {1 + sum(w for w in ws[:i])}, {ws[i]})" for ws in [[10, 9, 9, 9, 9, 9, 9]] for i in range(7))
_FAMILY = """
fam_{by} AS (SELECT o.o_orderkey, o_custkey AS family, CASE WHEN h < 'a' THEN 'train' WHEN h < 'd' THEN 'valid' ELSE 'test' END AS split, o_orderstatus <> 'P' AS included, coalesce(n, 0) AS n_boxes
  FROM (SELECT *, substr(sha1({by}::VARCHAR), 1, 1) AS h FROM orders) o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey)"""
_BY_ORDER, _BY_CUST = _FAMILY.format(by="o_orderkey"), _FAMILY.format(by="o_custkey")
_GROUPS = f"""WITH {CONTENT_SQL}, g AS (SELECT 'exact-' || lower(substr(sha256, 1, 16)) AS exact_group_id, sha256, count(*) AS member_count, count(*) FILTER (source_scope = 'internal') AS internal_count,
  count(*) FILTER (source_scope = 'external') AS external_count, true AS cross_source, 'requires_review' AS review_status FROM file GROUP BY sha256 HAVING count(DISTINCT source_scope) = 2)"""


def _union_rules(source, rules):
    return f"WITH {source} " + " UNION ALL ".join(f"SELECT doc_id + 2 AS row_number, '{c}' AS \"column\", {v} AS value, '{k}' AS code, {m} AS message FROM r WHERE {w}" for c, v, k, m, w in rules)


def _domain(c, v):
    values = DOMAINS[c]
    listed = ", ".join(f"'{x}'" for x in values)
    return (c, v, "invalid_value", f"'value must be one of: {', '.join(values)}'", f"{v} NOT IN ({listed})")


_RAW = _LABELLED + ", r AS (SELECT * FROM lab)"
_LOW = _LABELLED + ", r AS (SELECT * REPLACE (lower(trim(photo_type_review)) AS photo_type_review) FROM lab)"
_COND = [
    ("reviewer", "reviewer", "'review_status=reviewed requires reviewer'", "review_status = 'reviewed' AND reviewer = ''"),
    ("is_exterior_review", "is_exterior_review", "'photo_type_review=exterior requires is_exterior_review=1'", "photo_type_review = 'exterior' AND is_exterior_review <> '1'"),
    ("is_exterior_review", "is_exterior_review", "'photo_type_review=' || photo_type_review || ' requires is_exterior_review=0'", "photo_type_review IN ('interior', 'low_quality', 'irrelevant') AND is_exterior_review <> '0'"),
    ("severity_review", "severity_review", "'has_visible_damage_review=0 requires severity_review=none or unknown'", "has_visible_damage_review = '0' AND severity_review NOT IN ('none', 'unknown')"),
    ("severity_review", "severity_review", "'has_visible_damage_review=1 cannot use severity_review=none'", "has_visible_damage_review = '1' AND severity_review = 'none'"),
    ("has_visible_damage_review", "has_visible_damage_review", "'severity_review=none requires has_visible_damage_review=0'", "severity_review = 'none' AND has_visible_damage_review <> '0'"),
    ("has_visible_damage_review", "has_visible_damage_review", "'severity_review=minor/moderate/severe requires has_visible_damage_review=1'", "severity_review IN ('minor', 'moderate', 'severe') AND has_visible_damage_review <> '1'"),
]
_PILOT = _LABELLED + """, r AS (SELECT doc_id, lower(trim(photo_type_review)) AS t, is_exterior_review AS e, has_visible_damage_review AS d, severity_review AS s, reviewer AS who,
  CASE WHEN doc_id % 9 = 0 THEN 'skipped' ELSE review_status END AS st, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'yesterday' ELSE '2026-01-02T03:04:05Z' END AS done,
  CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'front' END AS angle, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'n' END AS notes FROM lab)"""
_PILOT_RULES = [
    ("human_is_exterior_review", "inconsistent_exterior_flag", "t = 'exterior' AND e <> '1'"),
    ("human_is_exterior_review", "inconsistent_exterior_flag", "t <> 'exterior' AND e <> '0'"),
    ("human_severity_review", "inconsistent_damage_severity", "d = '0' AND s <> 'none'"),
    ("human_severity_review", "inconsistent_damage_severity", "d = '1' AND s = 'none'"),
    ("human_severity_review", "inconsistent_damage_severity", "d = 'unknown' AND s <> 'unknown'"),
    ("human_reviewer", "reviewed_required_value", "st = 'reviewed' AND who = ''"),
    ("human_reviewed_at", "reviewed_required_value", "st = 'reviewed' AND done = ''"),
    ("human_angle_review", "reviewed_required_value", "st = 'reviewed' AND t = 'exterior' AND angle = ''"),
    ("human_reviewed_at", "invalid_datetime", "st = 'reviewed' AND done = 'yesterday'"),
    ("human_reviewed_at", "pending_reviewed_at_filled", "st = 'pending' AND done <> ''"),
    ("human_reviewer", "status_required_reviewer", "st = 'skipped' AND who = ''"),
    ("human_review_notes", "status_required_notes", "st = 'skipped' AND notes = ''"),
]


def _sessions(gap, extra=""):
    return f"""WITH m AS (SELECT user_id, ts, event_id, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL {gap} SECOND {extra} THEN 1 ELSE 0 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM m)
SELECT user_id, session::BIGINT AS session, count(*) AS n_events, min(ts) AS started, max(ts) AS ended FROM s GROUP BY user_id, session"""


ORACLES = {
    "exact_dup_groups": f"{_GROUPS} SELECT * FROM g",
    "exact_dup_members": f"{_GROUPS} SELECT exact_group_id, record_id, source_scope, source FROM g JOIN file USING (sha256)",
    "similar_pairs": _near(WIDE),
    "similar_pairs_near": _near(NEAR),
    "similar_pairs_cross": _near(WIDE, "AND a.source_scope <> b.source_scope", "left_record_id, right_record_id, phash_distance"),
    "similar_classes": f"""WITH {HASH_SQL}, c AS (SELECT *, min(record_id) OVER (PARTITION BY phash, aspect_ratio) AS c FROM rec), p AS (SELECT least(a.c, b.c) AS left_class, greatest(a.c, b.c) AS right_class,
  bit_count(xor(a.phash, b.phash))::INT AS phash_distance, abs(a.aspect_ratio - b.aspect_ratio) / greatest(a.aspect_ratio, b.aspect_ratio) AS aspect_difference FROM c a JOIN c b ON a.record_id < b.record_id AND a.source_scope <> b.source_scope)
SELECT left_class, right_class, phash_distance, aspect_difference, count(*) AS n_pairs FROM p WHERE phash_distance <= {WIDE} AND aspect_difference <= 0.10 GROUP BY ALL""",
    "similar_links": f"""WITH {HASH_SQL}, p AS (SELECT a.record_id AS a, b.record_id AS b FROM rec a JOIN rec b ON a.record_id <> b.record_id
  WHERE bit_count(xor(a.phash, b.phash)) <= {WIDE} AND abs(a.aspect_ratio - b.aspect_ratio) / greatest(a.aspect_ratio, b.aspect_ratio) <= 0.10), n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT record_id, min(record_id) OVER (PARTITION BY phash, aspect_ratio) AS class_id, coalesce(n, 0)::BIGINT AS n_links FROM rec LEFT JOIN n ON a = record_id""",
    "candidate_counts": f"""WITH {HASH_SQL}, p AS (SELECT a.record_id AS a, b.record_id AS b FROM rec a JOIN rec b ON a.record_id < b.record_id WHERE {_bands6})
SELECT record_id, count(*) AS raw_pairs FROM (SELECT a AS record_id FROM p UNION ALL SELECT b FROM p) GROUP BY record_id""",
    "dedup_summary": f"""WITH {CONTENT_SQL}, {HASH_SQL}, g AS (SELECT count(*) AS n, count(DISTINCT source_scope) AS s FROM file GROUP BY sha256 HAVING count(*) > 1),
p AS (SELECT a.source_scope <> b.source_scope AS x FROM rec a JOIN rec b ON a.record_id < b.record_id WHERE bit_count(xor(a.phash, b.phash)) <= {WIDE} AND abs(a.aspect_ratio - b.aspect_ratio) / greatest(a.aspect_ratio, b.aspect_ratio) <= 0.10)
SELECT count(*) AS records, count(*) FILTER (source_scope = 'internal') AS internal_records, count(*) FILTER (source_scope = 'external') AS external_records, count(DISTINCT sha256) AS distinct_files,
  (SELECT count(*) FROM g) AS exact_groups, (SELECT coalesce(sum(n), 0)::BIGINT FROM g) AS exact_members, (SELECT count(*) FROM g WHERE s = 2) AS cross_source_groups,
  (SELECT count(*) FROM p) AS similar_pairs, (SELECT count(*) FROM p WHERE x) AS cross_scope_pairs FROM file""",
    "review_queue": f"WITH {_META} SELECT * FROM q ORDER BY priority, source_bucket, filename, image_id LIMIT 500",
    "queue_summary": f"WITH {_META} SELECT 'total_rows' AS metric, count(*) AS value FROM q UNION ALL SELECT 'source_bucket:' || source_bucket, count(*) FROM q GROUP BY 1 UNION ALL SELECT 'quality_status:' || quality_status, count(*) FROM q GROUP BY 1",
    "route_reviewed": f"""WITH {_LOW}, v AS (SELECT * FROM r WHERE review_status = 'reviewed')
SELECT photo_type_review AS route, image_id, severity_review FROM v WHERE photo_type_review IN ('exterior', 'low_quality', 'irrelevant')
UNION ALL SELECT 'annotation_candidates', image_id, severity_review FROM v WHERE photo_type_review = 'exterior' AND has_visible_damage_review = '1'""",
    "reviewed_summary": f"""WITH {_LOW} SELECT count(*) AS total_rows, count(*) FILTER (review_status = 'reviewed') AS reviewed_rows, count(*) FILTER (review_status = 'pending') AS pending_rows,
  count(*) FILTER (photo_type_review = 'exterior') AS exterior_rows, count(*) FILTER (has_visible_damage_review = '1') AS damage_rows FROM r""",
    "task_manifest": f"""WITH {_RAW} SELECT 'task_' || substr(sha1(concat_ws('|', review_id, image_id, original_path)), 1, 16) AS task_id, review_id, image_id, original_path, 'bbox' AS annotation_type, 'pending' AS task_status,
  CASE severity_review WHEN 'severe' THEN 10 WHEN 'minor' THEN 30 WHEN 'none' THEN 80 ELSE 90 END AS priority FROM r WHERE review_status = 'reviewed'""",
    "hash_split": f"""WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY sha1('{SEED}|' || o_orderkey), o_orderkey::VARCHAR) AS position, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, position, CASE WHEN position <= floor(n * 0.7) THEN 'train' WHEN position <= floor(n * 0.7) + floor(n * 0.2) THEN 'val' ELSE 'test' END AS split FROM p""",
    "round_robin": "WITH p AS (SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS k FROM customer) SELECT c_custkey, k AS assignment_order, 'r' || ((k - 1) % 3 + 1) AS reviewer_id FROM p",
    "stratified_sample": f"SELECT o_orderkey, o_orderpriority FROM orders ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END, sha1('{SEED}|' || o_orderkey), o_orderkey LIMIT 400",
    "first_seen_dups": f"""WITH {CONTENT_SQL}, f AS (SELECT *, min(record_id) OVER (PARTITION BY sha256) AS f FROM file)
SELECT record_id AS row_number, 'sha256' AS "column", sha256 AS value, 'duplicate_value' AS code, 'duplicate sha256; first seen on row ' || f AS message FROM f WHERE record_id > f""",
    "duplicate_counts": f"WITH {CONTENT_SQL}, g AS (SELECT count(*) AS n FROM file GROUP BY sha256 HAVING count(*) > 1) SELECT coalesce(sum(n), 0)::BIGINT AS rows_in_groups, coalesce(sum(n - 1), 0)::BIGINT AS rows_beyond_first FROM g",
    "keep_last": "SELECT event_id, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
    "latest_revision": "SELECT user_id, event_type, event_id AS revision, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1",
    "contiguity_gaps": """WITH o AS (SELECT o_orderkey + o_orderkey // 10 AS id, count(*) AS occurrences FROM orders GROUP BY 1), l AS (SELECT *, lag(id) OVER (ORDER BY id) AS p FROM o)
SELECT id, occurrences FROM l WHERE occurrences > 1 OR (id <> 1 AND (p IS NULL OR p <> id - 1))""",
    "time_reversals": """SELECT user_id, position FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY position) AS p FROM (SELECT *, event_id + 1 - 2 * (event_id % 2) AS position FROM events)) WHERE ts < p""",
    "later_references": """WITH e AS (SELECT event_id, event_id AS position, CASE WHEN event_id % 5 = 0 THEN (props::JSON->>'$.k')::BIGINT * 7 END AS refers_to FROM events)
SELECT event_id, position, refers_to FROM e WHERE refers_to IS NOT NULL AND NOT EXISTS (SELECT 1 FROM e x WHERE x.event_id = e.refers_to AND x.position < e.position)""",
    "suggestion_merge": f"""WITH {_LABELLED}, l AS (SELECT doc_id, image_id, CASE WHEN doc_id % 2 = 0 THEN ' unknown' ELSE photo_type_review END AS pt, is_exterior_review AS ex, review_status AS st, reviewer AS who, CASE WHEN doc_id % 5 = 0 THEN 'seen' ELSE '' END AS notes FROM lab),
s AS (SELECT CASE WHEN doc_id % 4 = 1 THEN -1 - doc_id ELSE doc_id END AS doc_id, CASE lang WHEN 'en' THEN 'exterior' WHEN 'de' THEN 'low_quality' ELSE '' END AS t, printf('%.2f', (n_chars % 100)::DOUBLE / 100)::DOUBLE AS c, CASE WHEN doc_id % 6 = 0 THEN 1.0 ELSE 0.0 END AS ac, CASE WHEN doc_id % 8 = 0 THEN 'seen' ELSE '' END AS note FROM documents),
j AS (SELECT l.*, t, c, ac, note, s.doc_id IS NOT NULL AND st <> 'reviewed' AS matched FROM l LEFT JOIN s USING (doc_id)),
k AS (SELECT *, matched AND t <> '' AND lower(trim(pt)) IN ('', 'unknown') AND c >= 0.75 AS tk, matched AND ac >= 1.0 AS ak FROM j),
p AS (SELECT *, list_filter([CASE WHEN tk THEN 'auto_photo_type=' || t || ':' || printf('%.3f', c) END, CASE WHEN ak THEN 'auto_angle=front_left:' || printf('%.3f', ac) END, CASE WHEN matched AND note <> '' THEN note END], lambda x: x IS NOT NULL) AS parts FROM k),
n AS (SELECT *, array_to_string(parts, '; ') AS add FROM p)
SELECT image_id, CASE WHEN tk THEN t ELSE pt END AS photo_type_review, CASE WHEN ak THEN 'front_left' ELSE '' END AS angle_review, CASE WHEN tk THEN CASE WHEN t = 'exterior' THEN '1' ELSE '0' END ELSE ex END AS is_exterior_review,
  st AS review_status, CASE WHEN (tk OR ak) AND who = '' THEN 'auto' ELSE who END AS reviewer, CASE WHEN len(parts) = 0 THEN notes WHEN notes = '' THEN add WHEN contains(notes, add) THEN notes ELSE notes || ' | ' || add END AS review_notes, matched FROM n""",
    "suggestion_join_errors": """SELECT 'duplicate_pilot' AS code, doc_id::VARCHAR AS value FROM documents GROUP BY doc_id HAVING count(*) > 1 UNION ALL SELECT 'duplicate_suggestions', doc_id::VARCHAR FROM labels GROUP BY doc_id HAVING count(*) > 1
UNION ALL SELECT 'missing_suggestion', doc_id::VARCHAR FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "semi_join": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)",
    "anti_join": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "full_diff": """WITH a AS (SELECT DISTINCT CASE WHEN o_orderkey % 11 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS k FROM orders), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT 'missing' AS side, k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'unknown', k FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""",
    "keys_equal": "SELECT (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer)) + (SELECT count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)) = 0 AS equal",
    "concatenated_overlaps": "SELECT c_custkey, 2::BIGINT AS n FROM customer WHERE c_custkey % 3 = 0",
    "fill_by_key": "SELECT doc_id, coalesce('q' || max(quality), '') AS verdict FROM documents LEFT JOIN labels USING (doc_id) GROUP BY doc_id",
    "positional_diff": """WITH j AS (SELECT o_orderkey, o_orderstatus AS s, o_orderpriority AS p, o_orderkey % 13 = 0 AS gone, CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS t FROM orders)
SELECT o_orderkey, 'o_orderstatus' AS "column", s AS "before", t AS "after" FROM j WHERE s IS DISTINCT FROM t UNION ALL SELECT o_orderkey, 'o_orderpriority', p, NULL FROM j WHERE gone
UNION ALL SELECT -1 - o_orderkey, 'o_orderstatus', NULL, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE s END FROM j WHERE gone UNION ALL SELECT -1 - o_orderkey, 'o_orderpriority', NULL, p FROM j WHERE gone""",
    "case_view": "SELECT doc_id, lang, CASE WHEN quality IS NULL THEN 'pending' ELSE 'reviewed' END AS review_status, coalesce(quality, 0)::BIGINT AS revision FROM documents LEFT JOIN labels USING (doc_id)",
    "named_views": """WITH c AS (SELECT lang, quality FROM documents LEFT JOIN labels USING (doc_id)) SELECT 'all' AS view, count(*) AS n FROM c UNION ALL SELECT 'pending', count(*) FROM c WHERE quality IS NULL UNION ALL SELECT 'reviewed', count(*) FROM c WHERE quality IS NOT NULL
UNION ALL SELECT 'needs_adjudication', 0 UNION ALL SELECT 'high_priority', count(*) FROM c WHERE quality = 1 UNION ALL SELECT 'annotation_issues', count(*) FROM c WHERE lang = 'de'""",
    "adjacent_cases": """WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_custkey, o_orderkey, i AS case_index, greatest(i - 1, 1) AS previous_index, least(i + 1, n) AS next_index FROM r""",
    "record_search": "SELECT p_partkey, p_name, p_type FROM part WHERE contains(lower(p_name || ' ' || p_type), 'cold wid')",
    "canonical_review": """WITH r AS (SELECT p_partkey AS k, ['model_miss','model_false_positive','localization_error','duplicate_prediction','annotation_issue','threshold_tradeoff','invalid_image','ambiguous','bogus'][p_partkey % 9 + 1] AS outcome FROM part),
s AS (SELECT *, k % 5 = 0 AS other, k % 4 = 0 AS defect, CASE WHEN k % 4 = 0 AND k % 3 <> 0 THEN 'missing_bbox' ELSE 'none' END AS dt, k % 8 = 0 AS prop, k % 6 = 0 AS hi, k % 2 = 1 AS nonote, outcome = 'annotation_issue' AS issue FROM r)
SELECT k AS p_partkey, outcome, CASE WHEN outcome IN ('model_miss','model_false_positive','localization_error','duplicate_prediction') THEN 'confirmed_model_error' WHEN outcome = 'threshold_tradeoff' THEN 'expected_threshold_tradeoff' WHEN outcome = 'invalid_image' THEN 'invalid_review_case' WHEN outcome = 'ambiguous' THEN 'ambiguous_case' WHEN outcome <> 'bogus' THEN outcome END AS error_disposition,
  CASE WHEN outcome = 'ambiguous' THEN 'needs_adjudication' WHEN outcome <> 'bogus' THEN 'reviewed' END AS review_status, CASE WHEN defect THEN 'yes' ELSE 'no' END AS correction_proposal_required,
  CASE WHEN outcome = 'bogus' THEN 'unknown_outcome' WHEN k % 7 = 0 THEN 'blank_reviewer' WHEN hi AND nonote THEN 'high_priority_needs_notes' WHEN outcome = 'ambiguous' AND nonote THEN 'ambiguous_needs_notes' WHEN issue AND NOT defect THEN 'issue_needs_defect'
    WHEN defect AND NOT issue THEN 'defect_needs_issue' WHEN defect AND dt = 'none' THEN 'defect_needs_type' WHEN defect AND nonote THEN 'defect_needs_notes' WHEN defect AND NOT prop THEN 'defect_needs_proposal' WHEN NOT defect AND dt <> 'none' THEN 'type_without_defect'
    WHEN NOT defect AND prop THEN 'proposal_without_defect' WHEN other AND nonote THEN 'other_needs_notes' ELSE '' END AS error_code FROM s""",
    "schema_evolution": "SELECT s_suppkey, s_name AS name, CASE WHEN s_suppkey = 7 THEN 'approved' ELSE 'draft' END AS status, '' AS reviewer FROM supplier",
    "row_overlay": "SELECT s_suppkey, CASE WHEN s_suppkey = 3 THEN 'renamed' ELSE s_name END AS s_name, s_nationkey FROM supplier",
    "applied_state": "SELECT count(*) AS targets, CASE WHEN count(*) <> 1 THEN 'drift' ELSE 'partial' END AS state FROM supplier WHERE s_suppkey = 3",
    "family_leakage": f"WITH {_BY_ORDER} SELECT family, count(DISTINCT split) AS n_splits, count(*) AS n_rows FROM fam_o_orderkey GROUP BY family HAVING count(DISTINCT split) <> 1",
    "family_leakage_safe": f"WITH {_BY_CUST} SELECT count(*) AS leaking_families FROM (SELECT family FROM fam_o_custkey GROUP BY family HAVING count(DISTINCT split) <> 1)",
    "split_summary": f"""WITH {_BY_CUST}, b AS (SELECT split, l_quantity / 80 AS a FROM lineitem JOIN fam_o_custkey ON o_orderkey = l_orderkey WHERE included),
i AS (SELECT split, count(DISTINCT family) AS source_family_count, count(*) AS source_image_count, count(*) FILTER (included) AS model_included_image_count, count(*) FILTER (NOT included) AS excluded_variant_count,
  count(*) FILTER (included AND n_boxes > 0) AS positive_image_count, count(*) FILTER (included AND n_boxes = 0) AS negative_image_count, sum(n_boxes) FILTER (included) AS nb FROM fam_o_custkey GROUP BY split),
q AS (SELECT split, count(*) AS bbox_count, quantile_cont(a, 0.05) AS bbox_area_ratio_p05, quantile_cont(a, 0.5) AS bbox_area_ratio_p50, quantile_cont(a, 0.95) AS bbox_area_ratio_p95, count(*) FILTER (a < 0.01) AS small_bbox_count, count(*) FILTER (a > 0.5) AS large_bbox_count FROM b GROUP BY split)
SELECT i.* EXCLUDE (nb), q.* EXCLUDE (split), 100.0 * (positive_image_count::DOUBLE / model_included_image_count) AS positive_image_percent, nb::DOUBLE / model_included_image_count AS bbox_per_included_image_mean, bbox_count::DOUBLE / positive_image_count AS bbox_per_positive_image_mean FROM i JOIN q USING (split)""",
    "inconsistent_families": f"""WITH {_BY_CUST} SELECT family, count(*) AS variant_count, min(n_boxes) AS count_min, max(n_boxes) AS count_max, array_to_string(list_sort(list(DISTINCT n_boxes)), '|') AS unique_values FROM fam_o_custkey GROUP BY family HAVING count(DISTINCT n_boxes) > 1""",
    "plan_resolution": "SELECT o_orderkey, o_orderstatus AS split, o_orderkey || '.JPG' AS name, '.jpg' AS suffix, o_orderkey::VARCHAR AS stem, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS resolved FROM orders",
    "split_rollup": "SELECT coalesce(l_returnflag, 'total') AS l_returnflag, count(*) AS n_rows, sum(l_quantity::BIGINT)::BIGINT AS quantity, count(*) FILTER (l_linenumber = 1) AS firsts FROM lineitem GROUP BY ROLLUP (l_returnflag)",
    "distribution": "SELECT event_type AS value, count(*) AS count, round(100.0 * count(*)::DOUBLE / (SELECT count(*) FROM events), 4) AS percentage FROM events GROUP BY event_type",
    "cross_tab": """SELECT lang, count(*) FILTER (quality = 0 AND toxic = 0) AS q0t0, count(*) FILTER (quality = 0 AND toxic = 1) AS q0t1, count(*) FILTER (quality = 1 AND toxic = 0) AS q1t0, count(*) FILTER (quality = 1 AND toxic = 1) AS q1t1
FROM documents JOIN labels USING (doc_id) GROUP BY lang""",
    "tvd": """WITH j AS (SELECT lang, quality FROM documents JOIN labels USING (doc_id)), n AS (SELECT lang, count(*) AS a, count(*) FILTER (quality = 0) AS b FROM j GROUP BY lang)
SELECT round(0.5 * sum(abs(a::DOUBLE / (SELECT sum(a) FROM n)::DOUBLE - b::DOUBLE / (SELECT sum(b) FROM n)::DOUBLE)), 9) AS tvd FROM n""",
    "recommendation": """WITH j AS (SELECT CASE WHEN doc_id % 10 = 0 THEN 1.0 ELSE 0 END AS low, quality = 1 AS inside, CASE WHEN toxic = 1 THEN 'high' WHEN lang = 'de' THEN 'medium' ELSE 'low' END AS p, doc_id % 2 = 0 AS conf FROM documents JOIN labels USING (doc_id)),
n AS (SELECT p, count(*) AS a, count(*) FILTER (inside) AS b FROM j GROUP BY p),
f AS (SELECT round(avg(low), 9) AS low_confidence_share, 0::BIGINT AS defect_count, round(avg(CASE WHEN inside THEN 0.0 ELSE 1 END), 9) AS non_scope_share, count(*) FILTER (inside) AS in_scope_rows,
  round(avg(CASE WHEN p <> 'low' THEN 1.0 ELSE 0 END) FILTER (inside), 9) AS in_scope_priority_share, round(avg(CASE WHEN conf THEN 1.0 ELSE 0 END) FILTER (inside), 9) AS in_scope_confirmed_share,
  (SELECT round(0.5 * sum(abs(a::DOUBLE / (SELECT sum(a) FROM n)::DOUBLE - b::DOUBLE / (SELECT sum(b) FROM n)::DOUBLE)), 9) FROM n) AS tvd FROM j)
SELECT *, CASE WHEN low_confidence_share > 0.2 THEN 'ADDITIONAL_REVIEW_REQUIRED' WHEN defect_count > 0 THEN 'DATA_CORRECTION_REQUIRED_BEFORE_RETRAINING' WHEN non_scope_share >= 0.3 OR tvd >= 0.15 THEN 'SCOPE_REBALANCING_REQUIRED_BEFORE_RETRAINING'
  WHEN in_scope_rows > 0 AND in_scope_priority_share >= 0.4 AND in_scope_confirmed_share >= 0.4 THEN 'RETRAINING_PROPOSAL_JUSTIFIED' ELSE 'NO_RETRAINING_RECOMMENDED' END AS recommendation FROM f""",
    "action_ranking": """SELECT event_type AS recommended_action, count(*) AS case_count, count(*) FILTER (user_id % 4 = 0) AS high_count, count(*) FILTER (user_id % 4 = 1) AS medium_count, count(*) FILTER (user_id % 4 = 2) AS low_count,
  count(*) FILTER (user_id % 4 = 0) * 3 + count(*) FILTER (user_id % 4 = 1) * 2 + count(*) FILTER (user_id % 4 = 2) AS priority_score FROM events WHERE event_type <> 'view' GROUP BY event_type""",
    "two_key_counts": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL",
    "progress_and_gate": "SELECT round(sum((o_orderkey % 5) * (o_orderkey % 101))::DOUBLE / sum(o_orderkey % 5)::DOUBLE, 9) AS progress, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'caution' ELSE 'clear' END AS gate FROM orders",
    "validate_domain": _union_rules(_RAW, [("reviewer", "reviewer", "empty_required_value", "'identity value must not be empty'", "reviewer = ''"), *[_domain(c, c) for c in DOMAINS]]),
    "validate_domain_normalised": _union_rules(_LOW, [_domain(c, c) for c in DOMAINS]),
    "validate_rules": _union_rules(_LOW, [(c, v, "conditional_rule", m, w) for c, v, m, w in _COND]),
    "validate_pilot": f"WITH {_PILOT} " + " UNION ALL ".join(f"SELECT doc_id + 2 AS row_number, '{c}' AS \"column\", '{k}' AS code FROM r WHERE {w}" for c, k, w in _PILOT_RULES),
    "validation_summary": f"WITH e AS ({_union_rules(_LOW, [_domain(c, c) for c in DOMAINS])}) SELECT (SELECT count(*) FROM documents) AS total_rows, count(*) AS error_count, count(DISTINCT row_number) AS invalid_rows FROM e",
    "expected_counts": """WITH n AS (SELECT r_name AS k, count(*) AS actual FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY 1)
SELECT coalesce(w.k, n.k) AS k, coalesce(expected, 0)::BIGINT AS expected, coalesce(actual, 0)::BIGINT AS actual FROM (VALUES ('AFRICA', 5), ('ASIA', 4), ('ATLANTIS', 1)) w(k, expected) FULL JOIN n ON n.k = w.k WHERE coalesce(expected, 0) <> coalesce(actual, 0)""",
    "row_fingerprint": "SELECT n_nationkey, upper(sha256(concat_ws(chr(31), n_nationkey, n_name, n_regionkey))) AS fingerprint FROM nation",
    "frame_fingerprint": f"""WITH {_HASHED} SELECT (p - 1) // 1024 AS "range", count(*) AS n_rows, {_DIGEST} AS digest FROM h GROUP BY 1""",
    "frame_total": f"""WITH {_HASHED} SELECT 'ordered' AS kind, count(*) AS n_rows, {_DIGEST} AS digest FROM h
UNION ALL SELECT 'as a set', count(*), {_DIGEST} FROM (SELECT md5(chr(31) || w) AS h FROM h)""",
    "first_difference": "SELECT p AS position, o_orderkey, o_orderstatus AS before, '?' AS after FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS p FROM orders) WHERE p % 700 = 0 AND o_orderstatus <> '?' ORDER BY p LIMIT 1",
    "schema_violations": """WITH e AS (SELECT event_id, (props->>'k')::INT AS k FROM events) SELECT event_id, '$.k' AS path, 'minimum' AS rule FROM e WHERE k < 5
UNION ALL SELECT event_id, '$.k', 'exclusiveMaximum' FROM e WHERE k >= 95 UNION ALL SELECT event_id, '$.k', 'not' FROM e WHERE k = 50""",
    "evidence_phrases": "SELECT page_id, p AS missing_phrase FROM pages CROSS JOIN (VALUES ('<HTML'), ('cookie'), ('licence')) v(p) WHERE NOT contains(lower(coalesce(html, '')), lower(p))",
    "path_rules": """SELECT o_orderkey, o_orderkey % 5 = 4 AS safe, CASE o_orderkey % 5 WHEN 0 THEN 'x.png' WHEN 1 THEN 'b.png' WHEN 2 THEN 'b.PNG' WHEN 3 THEN 'y.tar.gz' ELSE 'é.jpeg' END AS base,
  CASE o_orderkey % 5 WHEN 3 THEN '.gz' WHEN 4 THEN '.jpeg' ELSE '.png' END AS suffix, o_orderkey > 0 AND o_orderkey % 25 = 0 AS due FROM orders""",
    "normalised_text": """SELECT c_custkey, lower(c_mktsegment) || ' -x' AS lowered, replace(lower(c_mktsegment), ' ', '_') || '__x' AS underscored, c_custkey % 6 <= 2 AS queue_true, c_custkey % 6 IN (0, 2) AS audit_true,
  CASE WHEN c_custkey % 6 <= 2 THEN '1' WHEN c_custkey % 6 IN (3, 5) THEN '0' ELSE '' END AS tri, starts_with(c_name, '=') AS formula, false AS hex FROM customer""",
    "gap_sessions": _sessions(600),
    "gap_sessions_long": _sessions(43200, "OR ts::DATE <> (lag(ts) OVER w)::DATE"),
    "before_after_pairs": """SELECT a.o_custkey AS key, a.o_orderkey AS before_id, b.o_orderkey AS after_id, (epoch(b.o_orderdate)::BIGINT - epoch(a.o_orderdate)::BIGINT) AS elapsed_seconds
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey WHERE b.o_orderdate > a.o_orderdate AND epoch(b.o_orderdate)::BIGINT - epoch(a.o_orderdate)::BIGINT <= 2592000""",
    "event_mirror": "SELECT event_id, user_id, event_type FROM events WHERE event_id > 600",
}
