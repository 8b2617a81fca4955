"""The five tables of the image warehouse, stored by image: typed columns, VARIANT payloads, buckets sorted by image.

Tables that are asked for by image share one number of buckets, so that predictions, truth and metrics of an image meet
without a shuffle. Keys that a database would number are left to the writer; foreign keys are checked, not enforced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoforge.operators.checks import orphans
from annoforge.sources.readers import SourceError

BUCKETS = 64
#: Tables and columns; the key of each table first.
TABLES = {
    "model_versions": "model_version string, model_name string, task string, class_names variant, created_at timestamp, notes string",
    "image_assets": "image_id string, source_group string, file_path string, filename string, image_width int, image_height int, aspect_ratio double, file_size_bytes bigint, photo_type string, angle string, has_visible_damage string, severity_label string, created_at timestamp",
    "image_quality_metrics": "image_id string, is_readable boolean, blur_score double, brightness double, quality_label string, created_at timestamp",
    "damage_predictions": "prediction_id string, image_id string, model_version string, class_name string, confidence double, x1 double, y1 double, x2 double, y2 double, raw_output variant, created_at timestamp",
    "damage_comparison_results": "comparison_id string, rental_id string, vehicle_id string, angle string, pickup_image_id string, return_image_id string, result string, new_damage_count int, max_confidence double, review_required boolean, reason string, created_at timestamp",
}
#: What stands where a writer gives nothing.
DEFAULTS = {
    "image_assets": dict.fromkeys(["photo_type", "angle", "has_visible_damage", "severity_label"], "unknown"),
    "image_quality_metrics": {"quality_label": "unknown"},
    "damage_comparison_results": {"new_damage_count": 0, "review_required": False},
}
#: Columns that must have a value besides the key.
REQUIRED = {"model_versions": ["model_name", "task"], "image_assets": ["file_path"]}
REFERENCES = [("image_quality_metrics", "image_id", "image_assets"), ("damage_predictions", "image_id", "image_assets"), ("damage_predictions", "model_version", "model_versions")]
#: The column that a table's buckets go by; the others have none.
BY = {"image_assets": "image_id", "image_quality_metrics": "image_id", "damage_predictions": "image_id", "damage_comparison_results": "vehicle_id"}


def fields(table: str) -> list[tuple[str, str]]:
    return [tuple(f.split(" ")) for f in TABLES[table].split(", ")]


def conformed(rows: DataFrame, table: str) -> DataFrame:
    """Rows with a table's columns in order: missing ones null or their default, texts parsed where a VARIANT is due."""
    unknown = set(rows.columns) - {n for n, _ in fields(table)}
    if unknown:
        raise SourceError(f"{table} has no column " + ", ".join(sorted(unknown)))
    out = []
    for name, kind in fields(table):
        default = DEFAULTS.get(table, {}).get(name)
        if name not in rows.columns:
            c = F.current_timestamp() if name == "created_at" else F.parse_json(F.lit(None).cast("string")) if kind == "variant" else F.lit(default).cast(kind)
        elif kind == "variant" and rows.schema[name].dataType.simpleString() == "string":
            c = F.parse_json(name)
        else:
            c = F.col(name).cast(kind)
            c = c if default is None else F.coalesce(c, F.lit(default))
        out.append(c.alias(name))
    return rows.select(*out)


def row_errors(rows: DataFrame, table: str) -> DataFrame:
    """(code, n): rows without a key or a required value, and keys that repeat."""
    key = fields(table)[0][0]
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in [key, *REQUIRED.get(table, [])]])
    missing = counts.select(F.explode(F.array(*[F.struct(F.lit(f"missing_{c}").alias("code"), F.col(c).alias("n")) for c in counts.columns])).alias("e")).select("e.*")
    twice = rows.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").agg(F.count("*").alias("n")).select(F.lit(f"repeated_{key}").alias("code"), "n")
    return missing.unionByName(twice).where("n > 0")


def store(rows: DataFrame, table: str, database: str = "default", buckets: int = BUCKETS, mode: str = "errorifexists") -> DataFrame:
    """Rows as a stored table, by buckets of its column; refused if a key is missing or repeats."""
    held = conformed(rows, table)
    bad = row_errors(held, table).collect()
    if bad:
        raise SourceError(f"{table}: " + ", ".join(f"{r['code']} ({r['n']})" for r in bad))
    name = f"{database}.{table}"
    if table in BY:
        by = BY[table]
        # one file a bucket
        held.repartition(buckets, by).write.mode(mode).bucketBy(buckets, by).sortBy(by).saveAsTable(name)
    else:
        held.write.mode(mode).saveAsTable(name)
    return rows.sparkSession.table(name)


def missing_references(spark: SparkSession, database: str = "default") -> DataFrame:
    """(table_name, column, value) of stored rows that refer to nothing; a null refers to nothing and is fine."""
    out = None
    for table, column, parent in REFERENCES:
        key = fields(parent)[0][0]
        children = spark.table(f"{database}.{table}").where(F.col(column).isNotNull()).select(column)
        lost = orphans(children, spark.table(f"{database}.{parent}").select(key), column, key).distinct()
        lost = lost.select(F.lit(table).alias("table_name"), F.lit(column).alias("column"), F.col(column).alias("value"))
        out = lost if out is None else out.unionByName(lost)
    return out


def detections(spark: SparkSession, model_version: str, database: str = "default") -> DataFrame:
    """Stored predictions of a model as matching takes them; the class is its name."""
    rows = spark.table(f"{database}.damage_predictions").where(F.col("model_version") == model_version)
    return rows.select("image_id", "prediction_id", F.col("class_name").alias("class_id"), "confidence", F.struct("x1", "y1", "x2", "y2").alias("box"))
