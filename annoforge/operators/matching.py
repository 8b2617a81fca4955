"""Detections against ground truth: one-to-one matching, threshold sweeps, error summaries.

Predictions: image_id, prediction_id, class_id, confidence, box. Ground truth: image_id, gt_id, class_id,
box. Boxes are structs of corners.

Both sides meet in one shuffle by image, and in an image by a grid (see overlap). Predictions go by falling confidence, and a box once taken stays
taken, so that the outcome of a prediction does not depend on those after it: one fold at the least threshold
gives the outcomes at all thresholds, which come in afterwards, and a sweep is sums over those outcomes. A
prediction whose confidence is null or not a number is active at no threshold.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annoforge.operators import overlap

MATCH_IOU, LOCAL_IOU = 0.5, 0.1
#: What an operating point and a priority are taken from.
POINT_STATUS, EVIDENCE = "VALIDATION_THRESHOLD_CANDIDATE", "validation_error_cases"


def gathered(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """(image_id, ps, gs): predictions and boxes of every image that has either, in one shuffle."""
    p = predictions.select("image_id", F.struct("prediction_id", "class_id", "confidence", "box").alias("p"))
    g = truth.select("image_id", F.struct("gt_id", "class_id", "box").alias("g"))
    rows = p.unionByName(g, allowMissingColumns=True)
    return rows.groupBy("image_id").agg(F.collect_list("p").alias("ps"), F.collect_list("g").alias("gs"))


def folded(predictions: DataFrame, truth: DataFrame, least: float, match_iou: float = MATCH_IOU) -> DataFrame:
    """(image_id, ps, gs) with outcomes.

    ps: predictions with `best` (overlap n, box g) and, if active at `least`, `got` (n, g) of the box they take.
    gs: boxes with `raw` (n, c, p: best prediction of any confidence) and `hit` (n, c, p: that which takes it)."""

    rows = gathered(predictions, truth)
    key, pid, kind, gid = (f.dataType.simpleString() for f in (rows.schema["image_id"], predictions.schema["prediction_id"], predictions.schema["class_id"], truth.schema["gt_id"]))
    near, hit = f"struct<n:double,g:{gid}>", f"struct<n:double,c:double,p:{pid}>"
    schema = f"image_id {key}, ps array<struct<prediction_id:{pid},class_id:{kind},confidence:double,best:{near},got:{near}>>, gs array<struct<gt_id:{gid},class_id:{kind},raw:{hit},hit:{hit}>>"

    matched = overlap.matched
    return overlap.each_batch(rows, schema, lambda ps, gs: list(matched(ps, gs, least, match_iou)))


def levels(df: DataFrame, thresholds: list[float]) -> DataFrame:
    return F.broadcast(df.sparkSession.createDataFrame([(float(t),) for t in sorted(set(thresholds))], "threshold double"))


def prediction_outcome(p: Column, match_iou: float, local_iou: float) -> dict[str, Column]:
    got, best = p["got"], F.coalesce(-p["best"]["n"], F.lit(0.0))
    matched = got.isNotNull()
    kind = F.when(matched, "true_positive").when(best >= match_iou, "duplicate_prediction").when(best >= local_iou, "localization_error").otherwise("background_false_positive")
    return {
        "prediction_id": p["prediction_id"],
        "class_id": p["class_id"],
        "confidence": p["confidence"],
        "matched_gt_id": F.coalesce(got["g"], F.lit("")),
        "best_gt_id": F.coalesce(got["g"], p["best"]["g"], F.lit("")),
        "best_iou": F.when(matched, -got["n"]).otherwise(best),
        "match_status": F.when(matched, "matched").otherwise("unmatched"),
        "error_type": kind,
    }


def box_outcome(g: Column, threshold: Column, match_iou: float, local_iou: float) -> dict[str, Column]:
    raw, hit = g["raw"], g["hit"]
    found = F.coalesce(hit["c"] >= threshold, F.lit(False))
    raw_iou, raw_confidence = F.coalesce(-raw["n"], F.lit(0.0)), -raw["c"]
    low = raw_confidence.isNull() | F.isnan(raw_confidence) | (raw_confidence < threshold)
    kind = F.when(found, "true_positive").when((raw_iou >= match_iou) & low, "low_confidence_miss").when(raw_iou >= local_iou, "localization_miss").otherwise("no_detection")
    return {
        "gt_id": g["gt_id"],
        "class_id": g["class_id"],
        "matched_prediction_id": F.when(found, hit["p"]).otherwise(F.lit("")),
        "best_raw_prediction_id": F.when(found, hit["p"]).otherwise(F.coalesce(raw["p"], F.lit(""))),
        "best_iou": F.when(found, -hit["n"]).otherwise(raw_iou),
        "best_raw_confidence": F.when(found, hit["c"]).otherwise(raw_confidence),
        "match_status": F.when(found, "matched").otherwise("unmatched"),
        "error_type": kind,
    }


def match(predictions: DataFrame, truth: DataFrame, thresholds: list[float], match_iou: float = MATCH_IOU, local_iou: float = LOCAL_IOU) -> DataFrame:
    """Outcome of every active prediction at every threshold.

    Predictions go by falling confidence, then id; each takes the free box of highest overlap."""
    rows = folded(predictions, truth, min(thresholds), match_iou).select("image_id", F.explode("ps").alias("p"))
    active = rows.join(levels(predictions, thresholds), (F.col("p.confidence") >= F.col("threshold")) & ~F.isnan("p.confidence"))
    return active.select("threshold", "image_id", *[c.alias(n) for n, c in prediction_outcome(F.col("p"), match_iou, local_iou).items()])


def misses(predictions: DataFrame, truth: DataFrame, thresholds: list[float], match_iou: float = MATCH_IOU, local_iou: float = LOCAL_IOU) -> DataFrame:
    """Outcome of every ground-truth box at every threshold."""
    rows = folded(predictions, truth, min(thresholds), match_iou).select("image_id", F.explode("gs").alias("g")).crossJoin(levels(predictions, thresholds))
    return rows.select("threshold", "image_id", *[c.alias(n) for n, c in box_outcome(F.col("g"), F.col("threshold"), match_iou, local_iou).items()])


def sweep(predictions: DataFrame, truth: DataFrame, thresholds: list[float], match_iou: float = MATCH_IOU, local_iou: float = LOCAL_IOU) -> DataFrame:
    """Counts, precision, recall and F1 at every threshold.

    An image gives how many predictions and matches lie at each level (the thresholds that they reach), its
    highest level with a false one, and the highest level up to which all its boxes are found; sums of these
    over images are the counts, so that nothing is repeated by threshold."""
    cut = sorted({float(t) for t in thresholds})
    steps = F.array(*map(F.lit, cut))
    rows = folded(predictions, truth, cut[0], match_iou)

    def level(c: Column) -> Column:
        return F.when(c.isNull() | F.isnan(c), 0).otherwise(F.size(F.filter(steps, lambda t: t <= c)))

    def entry(kind: str, at: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), at.alias("level"))

    reached = F.transform("ps", lambda p: F.struct(level(p["confidence"]).alias("level"), p["got"].isNotNull().alias("hit")))
    rows = rows.select(F.filter(reached, lambda p: p["level"] > 0).alias("active"), F.size("gs").alias("boxes")).withColumnRenamed("active", "ps")
    hits, rest = F.filter("ps", lambda p: p["hit"]), F.filter("ps", lambda p: ~p["hit"])
    rows = rows.select("boxes", F.transform("ps", lambda p: p["level"]).alias("every"), F.transform(hits, lambda p: p["level"]).alias("hits"), F.transform(rest, lambda p: p["level"]).alias("rest"))
    complete = F.when(F.size("hits") == F.col("boxes"), F.coalesce(F.array_min("hits"), F.lit(0))).otherwise(0)
    one = F.concat(
        F.transform("every", lambda x: entry("predictions", x)),
        F.transform("hits", lambda x: entry("tp", x)),
        F.array(entry("image_fp", F.coalesce(F.array_max("rest"), F.lit(0)))),
        F.when(F.col("boxes") > 0, F.concat(F.array(entry("image_gt", F.lit(len(cut))), entry("image_whole", complete)), F.transform(F.sequence(F.lit(1), F.col("boxes")), lambda _: entry("gt", F.lit(len(cut)))))).otherwise(F.array().cast("array<struct<kind:string,level:int>>")),
    )
    counts = rows.select(F.explode(one).alias("e")).groupBy("e.kind", "e.level").agg(F.count("*").alias("n"))
    at = F.broadcast(predictions.sparkSession.createDataFrame([(i + 1, t) for i, t in enumerate(cut)], "at int, threshold double"))
    # every kind counts at the thresholds up to its level

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when((F.col("kind") == kind) & (F.col("level") >= F.col("at")), F.col("n"))), F.lit(0))

    sums = at.join(counts, F.lit(True), "left").groupBy("threshold").agg(*[total(k).alias(k) for k in ("predictions", "tp", "image_fp", "gt", "image_gt", "image_whole")])
    return scores(
        sums.select(
            "threshold",
            F.col("predictions").alias("predictions_count"),
            "tp",
            F.col("image_fp").alias("images_with_fp"),
            F.col("gt").alias("ground_truth_count"),
            (F.col("gt") - F.col("tp")).alias("fn"),
            (F.col("image_gt") - F.col("image_whole")).alias("images_with_fn"),
            (F.col("predictions") - F.col("tp")).alias("fp"),
        )
    )


def scores(counts: DataFrame) -> DataFrame:
    """Adds precision, recall and f1 to tp, fp, fn; 0 where a denominator is 0."""

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    out = counts.withColumn("precision", share(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", share(F.col("tp"), F.col("tp") + F.col("fn")))
    return out.withColumn("f1", share(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def operating_points(swept: DataFrame, recall_share: float = 0.95, precision_share: float = 0.95) -> DataFrame:
    """The high-recall, balanced and high-precision rows of a sweep."""
    for share in (recall_share, precision_share):
        if not 0 < share <= 1:
            raise ValueError("a share of the maximum must be in (0, 1]")
    columns = F.struct(*swept.columns)
    rows = swept.agg(F.max("recall").alias("r"), F.max("precision").alias("p"), F.collect_list(columns).alias("rows"))  # a row per threshold
    picks = [
        ("high_recall", lambda x: x["recall"] >= F.col("r") * recall_share, ["precision", "recall", "threshold"]),
        ("balanced", lambda x: F.lit(True), ["f1", "precision", "recall", "threshold"]),
        ("high_precision", lambda x: x["precision"] >= F.col("p") * precision_share, ["recall", "precision", "threshold"]),
    ]

    def best(keep, order):
        return F.array_max(F.transform(F.filter("rows", keep), lambda x: F.struct(*[x[c].alias(f"o{i}") for i, c in enumerate(order)], x.alias("row"))))["row"]

    named = F.array(*[F.struct(F.lit(name).alias("operating_point"), best(keep, order).alias("row")) for name, keep, order in picks])
    out = rows.select(F.explode(named).alias("o")).where(F.col("o.row").isNotNull())
    return out.select("o.operating_point", F.lit(POINT_STATUS).alias("status"), "o.row.*")


def cases(matched: DataFrame, missed: DataFrame) -> DataFrame:
    """Both sides' errors in one table, keyed by side and object."""
    p = matched.where("error_type <> 'true_positive'").select("threshold", F.lit("prediction").alias("source_type"), "image_id", F.col("prediction_id").alias("object_id"), "error_type", "best_iou")
    g = missed.where("error_type <> 'true_positive'").select("threshold", F.lit("ground_truth").alias("source_type"), "image_id", F.col("gt_id").alias("object_id"), "error_type", "best_iou")
    return p.unionByName(g)


def error_cases(predictions: DataFrame, truth: DataFrame, thresholds: list[float], match_iou: float = MATCH_IOU, local_iou: float = LOCAL_IOU) -> DataFrame:
    """cases() of match() and misses(), from one fold."""
    rows = folded(predictions, truth, min(thresholds), match_iou).crossJoin(levels(predictions, thresholds))

    def row(side: str, key: str, o: dict[str, Column]) -> Column:
        return F.struct(F.lit(side).alias("source_type"), o[key].alias("object_id"), o["error_type"].alias("error_type"), o["best_iou"].alias("best_iou"))

    active = F.filter("ps", lambda p: (p["confidence"] >= F.col("threshold")) & ~F.isnan(p["confidence"]))
    p = F.transform(active, lambda p: row("prediction", "prediction_id", prediction_outcome(p, match_iou, local_iou)))
    g = F.transform("gs", lambda g: row("ground_truth", "gt_id", box_outcome(g, F.col("threshold"), match_iou, local_iou)))
    return rows.select("threshold", "image_id", F.explode(F.filter(F.concat(p, g), lambda x: x["error_type"] != "true_positive")).alias("c")).select("threshold", "c.source_type", "image_id", "c.object_id", "c.error_type", "c.best_iou")


def summary(rows: DataFrame, *by: str) -> DataFrame:
    """Cases and distinct images by the given columns."""
    return rows.groupBy(*by).agg(F.count("*").alias("case_count"), F.count_distinct("image_id").alias("image_count"))


#: Error type, priority band, recommended action, expected benefit, effort.
PRIORITIES = [
    ("suspected_annotation_issue", "P0", "Audit annotation correctness before changing model behavior.", "high", "medium"),
    ("low_confidence_miss", "P1", "Add representative positive examples and review confidence calibration.", "high", "medium"),
    ("no_detection", "P1", "Collect or curate similar missed damages, prioritizing small and low-contrast cases.", "high", "high"),
    ("localization_miss", "P1", "Review bbox consistency and add targeted localization examples.", "high", "medium"),
    ("localization_error", "P1", "Review bbox consistency and add targeted localization examples.", "high", "medium"),
    ("background_false_positive", "P2", "Add hard negatives representing the recurring visual pattern.", "medium", "medium"),
    ("duplicate_prediction", "P2", "Inspect adjacent-damage annotation policy and later evaluate NMS settings on validation only.", "medium", "low"),
]
#: Band, action, benefit and effort of any other error type.
OTHER_PRIORITY = ("P3", "Retain as a model or augmentation hypothesis for a later approved experiment.", "unknown", "unknown")


def priorities(rows: DataFrame) -> DataFrame:
    """Error types ranked by band, count and name; shares are of all cases."""
    spark = rows.sparkSession
    names = ["priority_band", "recommended_action", "expected_benefit", "implementation_effort"]
    rules = spark.createDataFrame(PRIORITIES, ["issue_category", *names])
    counts = rows.groupBy(F.col("error_type").alias("issue_category")).agg(F.count("*").alias("affected_case_count"), F.count_distinct("image_id").alias("affected_image_count"))
    out = counts.join(F.broadcast(rules), "issue_category", "left").withColumns({n: F.coalesce(n, F.lit(v)) for n, v in zip(names, OTHER_PRIORITY, strict=True)})
    risk = F.when(F.col("priority_band") == "P0", "high").when(F.contains("issue_category", F.lit("localization")), "medium").otherwise("low")
    total = F.sum("affected_case_count").over(Window.partitionBy())
    rank = F.row_number().over(Window.orderBy("priority_band", F.desc("affected_case_count"), "issue_category"))
    return out.select(
        rank.cast("bigint").alias("priority_rank"), "priority_band", "issue_category", "affected_case_count", "affected_image_count",
        (F.col("affected_case_count").cast("double") / total).alias("estimated_error_share"), "recommended_action", "expected_benefit", "implementation_effort",
        risk.alias("annotation_risk"), F.lit(EVIDENCE).alias("evidence_source"),
    )


def largest(rows: DataFrame, least: float | None = None) -> DataFrame:
    """(image_id, max_iou) of gathered rows: the largest overlap of any prediction, of the least confidence on if one is
    given, with any box, whatever their classes; 0 where one side is empty."""
    schema = f"image_id {rows.schema['image_id'].dataType.simpleString()}, max_iou double"

    found = overlap.largest
    return overlap.each_batch(rows, schema, lambda ps, gs: [pa.array(found(ps, gs, least))])


def max_overlap(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Largest overlap of any prediction and box in each image; 0 where one side is empty."""
    return largest(gathered(predictions, truth))


def case_assembly(worklist: DataFrame, predictions: DataFrame, truth: DataFrame, threshold: float) -> DataFrame:
    """Per worklist image: boxes, active predictions, top confidence of all and best overlap of active ones, ids."""
    from annoforge.functions.text import fixed, row_payload, sha256_hex

    active = F.filter("ps", lambda p: p["confidence"] >= threshold)
    every = gathered(predictions, truth)
    facts = every.select(
        "image_id",
        F.size("gs").cast("bigint").alias("gt_count"),
        F.size(active).cast("bigint").alias("prediction_count"),
        F.array_max(F.transform("ps", lambda p: p["confidence"])).alias("max_confidence"),
    ).join(largest(every, threshold), "image_id")
    rows = worklist.select("image_id").distinct().join(facts, "image_id", "left")
    rows = rows.na.fill(0, ["gt_count", "prediction_count"]).na.fill(0.0, ["max_confidence", "max_iou"])
    shown = [F.col("image_id"), F.col("gt_count"), F.col("prediction_count"), fixed(F.col("max_confidence")), fixed(F.col("max_iou")), F.lit("pending")]
    provisional = sha256_hex(row_payload(*shown))
    rows = rows.withColumn("review_case_id", F.concat(F.lit("l_"), F.substring(F.sha2(F.encode(F.concat(F.col("image_id").cast("string"), provisional), "UTF-8"), 256), 1, 16)))
    return rows.withColumn("source_fingerprint", sha256_hex(row_payload(F.col("review_case_id"), *shown)))
