"""Operators on small frames: published scenarios, brute force, and inputs in another order."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from annoforge.functions import boxes as B
from annoforge.functions import hashes as H
from annoforge.functions import text as T
from annoforge.operators import checks as C
from annoforge.operators import digests as D
from annoforge.operators import findings as A
from annoforge.operators import matching as M
from annoforge.operators import review as R
from annoforge.operators import similarity as S

BOX = "struct<x1:double,y1:double,x2:double,y2:double>"


def predictions(spark, rows):
    return spark.createDataFrame([(i, p, k, c, b) for i, p, k, c, b in rows], f"image_id string, prediction_id string, class_id int, confidence double, box {BOX}")


def truth(spark, rows):
    return spark.createDataFrame(rows, f"image_id string, gt_id string, class_id int, box {BOX}")


def one(spark, preds, boxes, threshold, **more):
    p, g = predictions(spark, preds), truth(spark, boxes)
    summary = M.sweep(p, g, [threshold], **more).first()
    left = {r["prediction_id"]: r["error_type"] for r in M.match(p, g, [threshold], **more).collect()}
    right = {r["gt_id"]: (r["error_type"], r["best_raw_confidence"]) for r in M.misses(p, g, [threshold], **more).collect()}
    return summary, left, right


def test_one_to_one_and_duplicate(spark):
    s, left, _ = one(spark, [("i", "p1", 0, 0.9, (0.0, 0.0, 10.0, 10.0)), ("i", "p2", 0, 0.8, (1.0, 1.0, 9.0, 9.0))], [("i", "g1", 0, (0.0, 0.0, 10.0, 10.0))], 0.5)
    assert (s["tp"], s["fp"], s["fn"], s["precision"], s["recall"]) == (1, 1, 0, 0.5, 1.0)
    assert left == {"p1": "true_positive", "p2": "duplicate_prediction"}


def test_localisation(spark):
    s, left, right = one(spark, [("i", "p1", 0, 0.7, (0.0, 0.0, 5.0, 10.0))], [("i", "g1", 0, (0.0, 0.0, 10.0, 10.0))], 0.5, match_iou=0.6, local_iou=0.1)
    assert (s["tp"], s["fp"], s["fn"]) == (0, 1, 1)
    assert left == {"p1": "localization_error"} and right == {"g1": ("localization_miss", 0.7)}


def test_low_confidence_miss(spark):
    s, left, right = one(spark, [("i", "p1", 0, 0.2, (0.0, 0.0, 10.0, 10.0))], [("i", "g1", 0, (0.0, 0.0, 10.0, 10.0))], 0.5)
    assert (s["predictions_count"], s["fn"]) == (0, 1) and left == {} and right == {"g1": ("low_confidence_miss", 0.2)}


def test_empty_sides(spark):
    s, _, _ = one(spark, [], [("i", "g", 0, (0.0, 0.0, 1.0, 1.0))], 0.5)
    assert (s["tp"], s["fp"], s["fn"], s["precision"], s["recall"], s["f1"]) == (0, 0, 1, 0.0, 0.0, 0.0)


def greedy(preds, boxes, t):
    """The matching by loops."""

    def iou(a, b):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        inter = max(0, w) * max(0, h)
        return inter / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter)

    out = {}
    for image in {p[0] for p in preds}:
        used = set()
        for _, pid, k, c, b in sorted((p for p in preds if p[0] == image and p[3] >= t), key=lambda p: (-p[3], p[1])):
            near = sorted((-iou(b, g[3]), g[1]) for g in boxes if g[0] == image and g[2] == k)
            free = [x for x in near if x[1] not in used]
            if free and -free[0][0] >= 0.5:
                used.add(free[0][1])
                out[image, pid] = ("true_positive", free[0][1])
            else:
                best = -near[0][0] if near else 0
                out[image, pid] = ("duplicate_prediction" if best >= 0.5 else "localization_error" if best >= 0.1 else "background_false_positive", "")
    return out


def test_matching_equals_loops_in_any_order(spark):
    rng = random.Random(1)

    def box():
        x, y = rng.randint(0, 12), rng.randint(0, 12)
        return (float(x), float(y), float(x + rng.randint(4, 9)), float(y + rng.randint(4, 9)))

    preds = [(f"i{n % 12}", f"p{n}", rng.randint(0, 1), rng.randint(1, 5) / 5, box()) for n in range(150)]
    boxes = [(f"i{n % 12}", f"g{n}", rng.randint(0, 1), box()) for n in range(110)]
    p, g = predictions(spark, preds), truth(spark, boxes)
    for q in (p, p.repartition(7).orderBy(F.rand(3))):
        got = {(r["image_id"], r["prediction_id"]): (r["error_type"], r["matched_gt_id"]) for r in M.match(q, g, [0.4]).collect()}
        assert got == greedy(preds, boxes, 0.4)


def test_operating_points(spark):
    rows = spark.createDataFrame([(0.10, 0.40, 0.80, 0.5333), (0.20, 0.50, 0.75, 0.6), (0.30, 0.60, 0.60, 0.6), (0.40, 0.75, 0.40, 0.5217)], "threshold double, precision double, recall double, f1 double")
    got = {r["operating_point"]: r["threshold"] for r in M.operating_points(rows).collect()}
    assert got == {"high_recall": 0.10, "balanced": 0.30, "high_precision": 0.40}
    with pytest.raises(ValueError, match="share"):
        M.operating_points(rows, recall_share=0)


def test_size_bounds(spark):
    got = [r[0] for r in spark.createDataFrame([(0.005,), (0.01,), (0.03,), (0.2,)], "a double").select(B.size_bucket(F.col("a"), 0.01, 0.05)).collect()]
    assert got == ["small", "small", "medium", "large"]


def test_priorities_start_with_annotation_issues(spark):
    rows = spark.createDataFrame([("no_detection", "i1", "o1"), ("suspected_annotation_issue", "i1", "o2"), ("odd", "i2", "o3")], "error_type string, image_id string, object_id string")
    got = [(r["priority_rank"], r["issue_category"], r["priority_band"], r["annotation_risk"]) for r in M.priorities(rows).orderBy("priority_rank").collect()]
    assert got == [(1, "suspected_annotation_issue", "P0", "high"), (2, "no_detection", "P1", "low"), (3, "odd", "P3", "low")]


def test_box_faults(spark):
    rows = spark.createDataFrame([([10.0, 10.0, 20.0, 15.0],), ([90.0, 10.0, 20.0, 15.0],), ([90.0, 90.0, 20.0, 20.0],), ([1.0, 2.0],), ([None, 1.0, 1.0, 1.0],), ([float("nan"), 1.0, 1.0, 1.0],), ([-1.0, 0.0, 0.0, 1.0],)], "b array<double>")
    hundred = F.lit(100.0)
    got = [list(r[0]) for r in rows.select(B.invalid_reasons(F.col("b"), hundred, hundred)).collect()]
    assert got == [[], ["exceeds_image_width"], ["exceeds_image_height", "exceeds_image_width"], ["malformed_bbox"], ["non_numeric_bbox"], ["non_finite_bbox"], ["negative_x", "nonpositive_width"]]
    x, w = F.get("b", F.lit(0)), F.get("b", F.lit(2))
    assert rows.where(x == 90).select(B.clipped(x, w, hundred)).first()[0] == 10.0


def test_band_completeness(spark):
    assert H.band_plan(6) == [(54, 10), (45, 9), (36, 9), (27, 9), (18, 9), (9, 9), (0, 9)]
    rows = spark.createDataFrame([("a", "internal", "0000000000000000", 1.0, "x"), ("b", "external", "000000000000003F", 1.0, "y"), ("c", "external", "FFFFFFFFFFFFFFFF", 1.0, "z")], "record_id string, source_scope string, h string, aspect_ratio double, sha256 string")
    records = rows.withColumn("phash", H.from_hex(F.col("h"))).drop("h")
    assert [(r["left_record_id"], r["right_record_id"], r["phash_distance"]) for r in S.similar_pairs(records, 6, 0.1).collect()] == [("a", "b", 6)]
    assert S.similar_pairs(records, 6, 0.1, scopes={("internal", "internal")}).count() == 0
    same = records.withColumn("phash", F.lit(7).cast("bigint"))
    assert S.similar_pairs(same, 6, 0.1).count() == 3
    assert {r["raw_pairs"] for r in S.candidate_counts(same, 6).collect()} == {2}


def test_similar_pairs_equal_brute_force(spark):
    rng = random.Random(2)
    values = [rng.getrandbits(63) for _ in range(40)]
    values += [v ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for v in values]
    rows = [(f"r{i:03d}", "internal" if i % 2 else "external", v, 1.0) for i, v in enumerate(values)]
    records = spark.createDataFrame(rows, "record_id string, source_scope string, phash bigint, aspect_ratio double")
    got = {(r["left_record_id"], r["right_record_id"]) for r in S.similar_pairs(records, 4, 0.1).collect()}
    assert got == {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and (a[2] ^ b[2]).bit_count() <= 4}


def test_queue_order(spark):
    rows = spark.createDataFrame([("general-1", "01_general_fleet", "general.png", "True"), ("claim-1", "02_claimable_damage", "claim.jpg", "True"), ("minor-1", "03_minor_damage", "minor.jpg", "True"), ("broken-1", "02_claimable_damage", "broken.jpg", "False")], "image_id string, source_bucket string, filename string, is_readable string")
    queue = R.in_order(R.review_queue(rows.withColumn("original_path", F.col("filename")), {"02_claimable_damage": 10, "03_minor_damage": 20, "01_general_fleet": 30})).collect()
    assert [(r["image_id"], r["priority"]) for r in queue] == [("claim-1", 10), ("minor-1", 20), ("general-1", 30), ("broken-1", 110)]
    assert queue[-1]["priority_reason"] == "source_bucket=02_claimable_damage; unreadable"


def test_split_by_position(spark):
    rows = spark.range(10).select(F.col("id").cast("string").alias("k"))
    got = R.hash_split(rows, F.col("k"), "k", 1, (0.75, 0.15, 0.1)).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 7, "val": 1, "test": 2}
    assert [r["split"] for r in R.hash_split(rows.limit(1), F.col("k"), "k", 1, (0.5, 0.25, 0.25)).collect()] == ["train"]
    with pytest.raises(ValueError, match="ratios"):
        R.hash_split(rows, F.col("k"), "k", 1, (0.5, 0.5, 0.5))


def test_positions_are_whole_and_in_order(spark):
    rows = spark.range(500).select(((F.col("id") * 37) % 500).alias("k"))
    for range_rows in (1000, 30, 3):  # one task, several ranges, blocks of ranges
        got = R.positions(rows, "k", range_rows=range_rows).orderBy("position").collect()
        assert [(r["position"], r["k"]) for r in got] == [(i + 1, i) for i in range(500)]
    pairs = rows.select((F.col("k") % 7).cast("string").alias("a"), F.when(F.col("k") % 5 > 0, F.col("k")).alias("b"), "k")
    got = R.positions(pairs, "a", "b", "k", range_rows=20).orderBy("position").collect()
    want = sorted(((str(i % 7), i if i % 5 else -1, i) for i in range(500)))
    assert [r["k"] for r in got] == [k for _, _, k in want] and [r["position"] for r in got] == list(range(1, 501))
    assert R.positions(rows.limit(0), "k").count() == 0


def test_total_variation(spark):
    rows = spark.createDataFrame([("a", 1)] * 70 + [("b", 1)] * 30, "v string, x int")
    # all rows 70/30, the part 90/10
    part = rows.withColumn("n", F.monotonically_increasing_id())
    rows = spark.createDataFrame([("a", i < 45) for i in range(70)] + [("b", i < 5) for i in range(30)], "v string, part boolean")
    assert A.total_variation(rows, "v", F.col("part")).first()["tvd"] == pytest.approx(0.20)
    assert A.total_variation(rows.limit(0), "v", F.col("part")).first()["tvd"] == 0 and part.count() == 100


def test_action_ranking(spark):
    rows = spark.createDataFrame([("add_positive_sample", "high"), ("add_positive_sample", "medium"), ("threshold_analysis_only", "low"), ("no_action", "high")], "recommended_action string, retraining_priority string")
    got = A.action_ranking(rows).collect()
    assert [(r["recommended_action"], r["priority_score"]) for r in got] == [("add_positive_sample", 5), ("threshold_analysis_only", 1)]


def test_pilot_and_label_rules_differ_on_unknown_severity(spark):
    rows = spark.createDataFrame([(2, "interior", "0", "0", "unknown", "reviewed", "ann")], "row_number int, photo_type_review string, is_exterior_review string, has_visible_damage_review string, severity_review string, review_status string, reviewer string")
    assert C.rule_errors(rows, C.label_rules()).count() == 0
    human = rows.toDF("row_number", *[f"human_{c}" for c in rows.columns[1:]])
    assert [r["code"] for r in C.rule_errors(human, C.pilot_rules()).collect()] == ["inconsistent_damage_severity"]
    with pytest.raises(C.GateError, match="row 2"):
        C.gate(C.rule_errors(human, C.pilot_rules()), "pilot")


def test_domains_with_and_without_normalising(spark):
    rows = spark.createDataFrame([(2, " None")], "row_number int, severity string")
    assert C.rule_errors(rows, C.domain_rules({"severity": ["none"]})).count() == 1
    assert C.rule_errors(rows, C.domain_rules({"severity": ["none"]}, normalised=True)).count() == 0


def test_frames_and_positions_compare(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert D.frame_equal(a, a.repartition(3)) and not D.frame_equal(a, b)
    assert [tuple(r) for r in C.positional_differences(a, b, "k", ["v"]).collect()] == [(2, "v", None, "y")]


def test_gaps_and_references(spark):
    ids = spark.createDataFrame([(1,), (2,), (4,), (4,), (5,)], "id int")
    assert {tuple(r) for r in C.gaps(ids, "id").collect()} == {(4, 2)}
    rows = spark.createDataFrame([(1, 1, None), (2, 2, 1), (3, 3, 9), (4, 4, 4)], "id int, pos int, ref int")
    assert {r["id"] for r in C.later_references(rows, "id", "pos", "ref").collect()} == {3, 4}


def test_text_functions(spark):
    row = spark.range(1).select(
        T.with_note(F.lit("a"), "b").alias("n1"), T.with_note(F.lit("a | b"), "b").alias("n2"), T.with_note(F.lit(" "), "b").alias("n3"), T.fixed(F.lit("nan")).alias("f1"), T.fixed(F.lit("2.5"), 2).alias("f2"),
        T.utc_seconds(F.lit(0.9)).alias("t"), T.instant(F.lit("2026-01-02T03:04:05"), "required").alias("i1"), T.instant(F.lit("2026-01-02T03:04:05Z"), "required").isNotNull().alias("i2"), T.id_list(F.lit('["b","a"]')).alias("l1"), T.id_list(F.lit('["a","a"]')).alias("l2"),
        T.box_record(F.lit('{"x1":1,"y1":2,"x2":3,"y2":4}')).isNotNull().alias("b1"), T.box_record(F.lit('{"x1":1,"y1":2,"x2":3}')).alias("b2"), T.canonical_json(b=F.lit(1), a=F.lit(None).cast("string")).alias("j"), T.percent(F.lit(1), F.lit(0)).alias("p"),
    ).first()
    assert row.asDict() == {"n1": "a | b", "n2": "a | b", "n3": "b", "f1": "0.000000", "f2": "2.50", "t": "1970-01-01T00:00:00+00:00", "i1": None, "i2": True, "l1": ["a", "b"], "l2": None, "b1": True, "b2": None, "j": '{"a":null,"b":1}', "p": 0.0}


def test_cosine_softmax(spark):
    row = spark.createDataFrame([([1.0, 0.0],)], "v array<double>").select(T.cosine_softmax(F.col("v"), [[2.0, 0.0], [0.0, 1.0]], 1.0).alias("p")).first()
    assert row["p"] == pytest.approx([2.718281828 / 3.718281828, 1 / 3.718281828])


def hash_frame(spark, seed, n=120):
    """Records of few and of near hashes, in two scopes, with files that repeat."""
    rng = random.Random(seed)
    base = [rng.getrandbits(64) - (1 << 63) for _ in range(6)]
    rows = []
    for i in range(n):
        h = rng.choice(base)
        for _ in range(rng.choice([0, 0, 0, 1, 3, 5, 8])):
            bit = rng.randrange(64)
            h ^= (1 << bit) if bit < 63 else -(1 << 63)
        rows.append((f"r{i:03d}", rng.choice(["internal", "external"]), h, rng.choice([1.0, 1.0, 1.05, 2.0, None]), f"{h}-{rng.randrange(3)}"))
    return rows, spark.createDataFrame(rows, "record_id string, source_scope string, phash bigint, aspect_ratio double, sha256 string")


def similar(a, b, distance, scopes):
    return a[0] != b[0] and a[3] is not None and b[3] is not None and abs(a[3] - b[3]) / max(a[3], b[3]) <= 0.1 and ((a[2] ^ b[2]) & (1 << 64) - 1).bit_count() <= distance and a[4] != b[4] and {(a[1], b[1]), (b[1], a[1])} & scopes


@pytest.mark.parametrize(("distance", "crowded", "scopes"), [(6, 2, S.ALL_SCOPES), (3, 1, {("internal", "external")}), (18, 2, S.ALL_SCOPES), (0, 1, {("external", "external")})])
def test_crowded_bands_are_refined_to_the_same_pairs(spark, distance, crowded, scopes):
    rows, records = hash_frame(spark, distance)
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and similar(a, b, distance, scopes)}
    got = [(r["left_record_id"], r["right_record_id"]) for r in S.similar_pairs(records, distance, 0.1, scopes=scopes, crowded=crowded).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    links = {r["record_id"]: r["n_links"] for r in S.similar_links(records, distance, 0.1, scopes=scopes, crowded=crowded).collect()}
    assert links == {a[0]: sum(bool(similar(a, b, distance, scopes)) for b in rows) for a in rows}
    assert sum(r["n_pairs"] for r in S.class_pairs(records, distance, 0.1, scopes=scopes, crowded=crowded).collect()) == len(want)


def test_equal_hashes_are_one_class_and_caps_come_before_pairs(spark):
    many = spark.range(1_000_000).select(F.format_string("r%07d", "id").alias("record_id"), F.lit("external").alias("source_scope"), F.lit(7).cast("bigint").alias("phash"), F.lit(1.0).alias("aspect_ratio"))
    n = 1_000_000
    assert [tuple(r) for r in S.class_pairs(many, 6, 0.1).collect()] == [("r0000000", "r0000000", 0, 0.0, n * (n - 1) // 2)]
    assert S.similar_links(many, 6, 0.1).where(F.col("n_links") == n - 1).count() == n
    with pytest.raises(C.GateError, match="more than 500"):
        S.similar_pairs(many, 6, 0.1, cap=500)
    near = spark.range(20_000).select(F.format_string("r%07d", "id").alias("record_id"), F.lit("internal").alias("source_scope"), F.xxhash64("id").bitwiseAND(F.lit((1 << 54) - 1)).alias("phash"), F.lit(1.0).alias("aspect_ratio"))
    assert S.hash_pairs(near.select("phash"), 6).count() == 0  # the first band of all is equal, all else at random


@pytest.mark.parametrize(("distance", "crowded"), [(18, 1 << 14), (6, 1 << 14), (6, 40)])
def test_large_buckets_are_compared_block_by_block(spark, monkeypatch, distance, crowded):
    monkeypatch.setattr(S, "BLOCK", 16)
    monkeypatch.setattr(S, "AT_ONCE", 64)
    rows, records = hash_frame(spark, 100 + distance, 300)
    hashes = sorted({r[2] for r in rows})
    want = {(a, b, d) for a in hashes for b in hashes if a < b and (d := ((a ^ b) & (1 << 64) - 1).bit_count()) <= distance}
    got = [tuple(r) for r in S.hash_pairs(records.select("phash").distinct(), distance, crowded).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    blocks = S.compared(records.select(F.array().cast("array<bigint>").alias("path"), F.col("phash").alias("h")).distinct(), distance)
    assert {tuple(r) for r in blocks.collect()} == want


def test_pairs_are_counted_by_scope_without_making_them(spark):
    rows, records = hash_frame(spark, 5)
    counts = {(r[0], r[1]): r[2] for r in S.pair_counts(records, 18, 0.1).collect()}
    found = Counter(tuple(sorted((a[1], b[1]))) for a in rows for b in rows if a[0] < b[0] and similar(a, b, 18, S.ALL_SCOPES))
    assert {tuple(sorted(k)): n for k, n in counts.items()} == {k: found[k] for k in (("internal", "internal"), ("external", "internal"), ("external", "external"))}
    files = records.select("record_id", "source_scope", "sha256")
    assert S.dedup_summary(files, S.pair_counts(records, 18, 0.1)).collect() == S.dedup_summary(files, S.similar_pairs(records, 18, 0.1)).collect()


def test_fixed_digits_round_the_exact_value(spark):
    rng = random.Random(3)
    values = [0.0015625, 0.0203125, 0.0765625, 0.0078125, 0.5, 1.5, 2.5, 0.0, 1e-7, 1e300, 0.9999995, 1.0000005, 123456.0000005, 7.9999999, 4e9 + 0.125]
    values += [k / 640 for k in range(1, 2000, 2)] + [k / 2_000_000 for k in range(1, 400, 2)] + [rng.random() * 10 ** rng.randrange(-6, 7) for _ in range(2000)]
    values += [-v for v in values if v > 1e-3]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", *[T.fixed(F.col("v"), d).alias(f"f{d}") for d in (0, 3, 6)]).collect()
    wrong = [(r["v"], r[f"f{d}"]) for r in rows for d in (0, 3, 6) if abs(r["v"]) < 1e9 and r[f"f{d}"] != f"{r['v']:.{d}f}"]
    assert not wrong and len(rows) == len(values)


def test_differences_of_ids_are_grouped_and_not_joined(spark):
    left, right = (spark.createDataFrame([(v,) for v in vs], "id int") for vs in ([1, 1, 2, None, 5], [2, 2, 3, None, None, 3]))
    found = R.id_differences(left, right, "id")
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("missing", 1), ("missing", 5), ("missing", None), ("unknown", 3), ("unknown", None)], key=str)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_pixel_hashes_compute_their_luma_once(spark):
    for made, size in ((H.dhash, 72), (H.phash, 1024)):
        luma = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.pmod(i * 7919 + F.col("id"), F.lit(251)))
        rows = spark.range(3).select(made(luma).alias("h"))
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("7919") == 1
