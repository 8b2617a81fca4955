"""Stored tables by image: types, gates, references, and matching without a shuffle."""

import pytest
from pyspark.sql import functions as F

from annoforge.operators import matching as M
from annoforge.sources import warehouse as W
from annoforge.sources.readers import SourceError


@pytest.fixture(scope="module")
def database(spark):
    spark.sql("create database images")
    rows = spark.range(600).select((F.col("id") % 50).cast("string").alias("image_id"), F.format_string("p%04d", "id").alias("prediction_id"), (F.col("id") % 40).cast("double").alias("x1"), F.col("id").alias("n"))
    box = rows.withColumns({"y1": F.lit(0.0), "x2": F.col("x1") + 10, "y2": F.lit(10.0), "class_name": F.lit("dent"), "confidence": (F.col("n") % 10) / 10.0})
    for model in ("m1", "truth"):
        part = box.where("n % 2 = 0" if model == "m1" else "n % 3 = 0").withColumn("prediction_id", F.concat(F.lit(model), "prediction_id"))
        made = part.drop("n").withColumns({"model_version": F.lit(model), "raw_output": F.to_json(F.struct("confidence"))})
        both = made if model == "m1" else both.unionByName(made)
    W.store(both, "damage_predictions", "images", 8)
    W.store(rows.select("image_id").distinct().withColumn("file_path", F.concat(F.lit("/i/"), "image_id")), "image_assets", "images", 8)
    W.store(spark.createDataFrame([("m1", "one", "detect", '["dent"]')], "model_version string, model_name string, task string, class_names string"), "model_versions", "images")
    W.store(rows.select("image_id").distinct().where("image_id <> '7'").withColumn("is_readable", F.lit(True)), "image_quality_metrics", "images", 8)
    return "images"


def sides(spark):
    truth = W.detections(spark, "truth", "images").withColumnRenamed("prediction_id", "gt_id").drop("confidence")
    return W.detections(spark, "m1", "images"), truth


def test_matching_of_stored_tables_needs_no_shuffle(spark, database):
    preds, truth = sides(spark)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = M.folded(preds, truth, 0.5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert "Exchange" not in plan and "Bucketed: true" in plan, plan
    flat = lambda df: df.sparkSession.createDataFrame(df.collect(), df.schema)
    got, want = M.match(preds, truth, [0.5]), M.match(flat(preds), flat(truth), [0.5])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 100


def test_types_defaults_and_payloads(spark, database):
    assets = spark.table("images.image_assets")
    assert [(f.name, f.dataType.simpleString()) for f in assets.schema] == W.fields("image_assets")
    assert assets.select("photo_type").distinct().first()[0] == "unknown" and assets.where("created_at is null").count() == 0
    p = spark.table("images.damage_predictions")
    assert p.where(F.variant_get("raw_output", "$.confidence", "double") != F.col("confidence")).count() == 0


def test_references_are_checked(spark, database):
    got = {(r["table_name"], r["column"], r["value"]) for r in W.missing_references(spark, "images").collect()}
    assert got == {("damage_predictions", "model_version", "truth")}


def test_bad_rows_are_refused(spark, database):
    one = lambda *v: spark.createDataFrame([v], "image_id string, file_path string")
    with pytest.raises(SourceError, match="missing_image_id"):
        W.store(one(None, "/x"), "image_assets", "images", 8, "append")
    with pytest.raises(SourceError, match="missing_file_path"):
        W.store(one("a", None), "image_assets", "images", 8, "append")
    with pytest.raises(SourceError, match="repeated_image_id"):
        W.store(one("a", "/x").unionByName(one("a", "/y")), "image_assets", "images", 8, "append")
    with pytest.raises(SourceError, match="no column colour"):
        W.store(one("a", "/x").withColumn("colour", F.lit(1)), "image_assets", "images", 8)
    with pytest.raises(Exception, match="already exists"):
        W.store(one("a", "/x"), "image_assets", "images", 8)
