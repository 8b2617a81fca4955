"""Controlled intake of external datasets: registry rows, structural summaries, proposals and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.functions import text as T

#: What a registry row must say before its dataset is taken in.
LICENSED, APPROVED = ("yes", "true", "1"), "approved_for_download"
#: Fields that a proposal sets, besides counts, path and day.
PROPOSED = {"sha256_dedup_status": "external_exact_hash_inventory_complete", "perceptual_hash_status": "pending", "internal_cross_dedup_status": "pending", "usage_status": "downloaded"}
QA_PASS, QA_FAIL = "downloaded_structural_qa_pass", "downloaded_structural_qa_failed"


def registry_errors(registry: DataFrame, wanted: DataFrame, key: str = "dataset_id") -> DataFrame:
    """(key, code) of wanted datasets that may not be taken in: not exactly one row, no verified license, not approved."""
    rows = registry.withColumn(key, T.stripped(F.col(key)))
    one = rows.groupBy(key).agg(F.count("*").alias("_n"), F.max(T.lowered(F.col("license_verified"))).alias("_l"), F.max(T.lowered(F.col("usage_status"))).alias("_u"))
    code = F.when(F.coalesce("_n", F.lit(0)) != 1, "not_one_row").when(~F.col("_l").isin(*LICENSED), "license_not_verified").when(F.col("_u") != APPROVED, "not_approved")
    return wanted.select(key).join(one, key, "left").select(key, code.alias("code")).where("code is not null")


def registry_rows(registry: DataFrame, wanted: DataFrame, key: str = "dataset_id") -> DataFrame:
    """The rows of wanted datasets that may be taken in, all values stripped."""
    good = wanted.select(key).distinct().join(registry_errors(registry, wanted, key), key, "left_anti")
    return registry.select(*[T.stripped(F.col(c)).alias(c) for c in registry.columns]).join(good, key, "left_semi")


def intake_summary(images: DataFrame, annotations: DataFrame, classes: list[str]) -> DataFrame:
    """One row: counts of images, files, boxes and copies, images by split, and whether the classes are the expected ones.

    images: split, sha256, file_exists; annotations: class_name, bbox_status, segmentation_status."""
    exists = F.coalesce(F.col("file_exists"), F.lit(False))
    i = images.agg(F.count("*").alias("image_record_count"), F.count_if(exists).alias("image_file_count"), F.count_if(~exists).alias("missing_image_count"))
    bad_segmentation = ~F.coalesce(F.col("segmentation_status").startswith("valid_"), F.lit(False))
    a = annotations.agg(
        F.count("*").alias("annotation_count"), F.count_if(F.col("bbox_status") == "valid").alias("valid_bbox_count"), F.count_if(~F.col("bbox_status").eqNullSafe("valid")).alias("invalid_bbox_count"),
        F.count_if(bad_segmentation).alias("invalid_segmentation_count"), F.array_sort(F.collect_set("class_name")).alias("_classes"),
    )
    groups = images.where(F.coalesce(F.col("sha256"), F.lit("")) != "").groupBy("sha256").agg(F.count("*").alias("n")).where("n > 1")
    d = groups.agg(F.count("*").alias("exact_duplicate_group_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("exact_duplicate_image_count"))
    by_split = images.groupBy(F.coalesce("split", F.lit("")).alias("s")).agg(F.count("*").alias("n"))
    s = by_split.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "s", "n"))), "|").alias("split_counts"))
    out = i.crossJoin(a).crossJoin(d).crossJoin(s)
    expected = F.array(*map(F.lit, sorted(set(classes))))
    return out.select("*", F.array_join("_classes", "|").alias("class_names"), (F.col("_classes") == expected).alias("classes_match")).drop("_classes")


def proposal(row: DataFrame, summary: DataFrame, day: str, raw_path: str, notes: str = "") -> DataFrame:
    """A registry row with the fields that an intake derives; not applied to any registry."""
    both = row.crossJoin(summary.select(*[F.col(c).alias(f"_{c}") for c in ("image_record_count", "annotation_count", "valid_bbox_count", "missing_image_count", "invalid_bbox_count", "invalid_segmentation_count")]))
    clean = (F.col("_invalid_bbox_count") == 0) & (F.col("_invalid_segmentation_count") == 0)
    new = {
        "download_date": F.lit(day[:10]),
        "image_count_downloaded": F.col("_image_record_count").cast("string"),
        "bbox_count_reported": F.col("_annotation_count").cast("string"),
        "bbox_count_valid": F.col("_valid_bbox_count").cast("string"),
        "accepted_image_count": (F.col("_image_record_count") - F.col("_missing_image_count")).cast("string"),
        "rejected_image_count": F.col("_missing_image_count").cast("string"),
        "bbox_quality_status": F.when(clean, QA_PASS).otherwise(QA_FAIL),
        **{c: F.lit(v) for c, v in PROPOSED.items()},
        "local_raw_path": F.lit(raw_path),
        "notes": F.lit(notes),
    }
    return both.withColumns(new).select(*row.columns, *[c for c in new if c not in row.columns])


def proposal_errors(registry: DataFrame, proposed: DataFrame, targets: DataFrame, identity: list[str], protected: dict[str, str], raw_path: str, key: str = "dataset_id") -> DataFrame:
    """(key, code, column) of targets whose proposal may not be applied.

    Both sides must have the target exactly once, agree on the identity columns, hold the protected values in
    the registry, and the proposal the expected path."""

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(key).agg(F.count("*").alias(f"_n_{name}"), F.first(F.struct(*[c for c in rows.columns if c != key])).alias(name))

    both = targets.select(key).distinct().join(side(registry, "r"), key, "left").join(side(proposed, "p"), key, "left")
    once = (F.coalesce("_n_r", F.lit(0)) == 1) & (F.coalesce("_n_p", F.lit(0)) == 1)

    def found(broken, code: str, column: str):
        return F.when(broken, F.struct(F.lit(code).alias("code"), F.lit(column).alias("column")))

    parts = [found(F.coalesce("_n_r", F.lit(0)) != 1, "registry_not_one_row", key), found(F.coalesce("_n_p", F.lit(0)) != 1, "proposal_not_one_row", key)]
    parts += [found(once & ~F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")), "identity_mismatch", c) for c in identity]
    parts += [found(once & ~F.col(f"r.{c}").eqNullSafe(F.lit(v)), "protected_mismatch", c) for c, v in protected.items()]
    path = F.translate(F.coalesce(F.col("p.local_raw_path"), F.lit("")), "\\", "/")
    parts += [found(once & (path == ""), "path_empty", "local_raw_path"), found(once & (path != "") & (path != raw_path), "path_mismatch", "local_raw_path")]
    return both.select(key, F.explode(F.array_compact(F.array(*parts))).alias("e")).select(key, "e.*")


def mapping_errors(mapping: DataFrame, dataset: str, name: str) -> DataFrame:
    """(code) of what a class mapping breaks: one row, of this dataset, to this class, no labels made yet."""
    facts = mapping.agg(
        F.count("*").alias("n"), F.count_if(T.stripped(F.col("dataset_id")) != dataset).alias("d"),
        F.count_if(T.stripped(F.col("mapped_class")) != name).alias("c"), F.count_if(T.lowered(F.col("yolo_label_created")) != "no").alias("y"),
    )
    rules = [(F.col("n") != 1, "not_one_row"), (F.col("d") > 0, "dataset_mismatch"), (F.col("c") > 0, "class_mismatch"), (F.col("y") > 0, "labels_already_created")]
    return facts.select(F.explode(F.array_compact(F.array(*[F.when(broken, code) for broken, code in rules]))).alias("code"))
