"""Analytics of review decisions, split reports and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annoforge.functions.text import percent
from annoforge.operators.quantiles import quantiles


def distribution(rows: DataFrame, column: str) -> DataFrame:
    """value, count and percentage of a column; blanks are a value."""
    n = rows.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("value")).agg(F.count("*").alias("count"))
    return n.withColumn("percentage", percent(F.col("count"), F.sum("count").over(Window.partitionBy())))


def cross_tab(rows: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts by row value and column value, zeros filled."""
    return rows.groupBy(row).pivot(column, values).count().na.fill(0)


def total_variation(rows: DataFrame, column: str, part: Column) -> DataFrame:
    """Half the sum of differences between the shares of a column in all rows and in a part of them."""
    n = rows.groupBy(column).agg(F.count("*").alias("a"), F.count_if(part).alias("b"))
    whole = n.select("*", F.sum("a").over(Window.partitionBy()).alias("na"), F.sum("b").over(Window.partitionBy()).alias("nb"))
    p, q = (F.coalesce(F.try_divide(F.col(x).cast("double"), F.col(f"n{x}").cast("double")), F.lit(0.0)) for x in "ab")
    return whole.agg((F.lit(0.5) * F.coalesce(F.sum(F.abs(p - q)), F.lit(0.0))).alias("tvd"))


def share(mask: Column) -> Column:
    return F.coalesce(F.avg(mask.cast("double")), F.lit(0.0))


def action_ranking(rows: DataFrame, action: str = "recommended_action", priority: str = "retraining_priority") -> DataFrame:
    """Actions by the weights of their priorities (high 3, medium 2, low 1); no_action is left out."""
    high, medium, low = (F.count_if(F.col(priority) == p) for p in ("high", "medium", "low"))
    g = rows.where(F.col(action) != "no_action").groupBy(action).agg(F.count("*").alias("case_count"), high.alias("high_count"), medium.alias("medium_count"), low.alias("low_count"))
    return g.withColumn("priority_score", F.col("high_count") * 3 + F.col("medium_count") * 2 + F.col("low_count")).orderBy(F.desc("priority_score"), F.desc("case_count"), action)


#: Limits of the recommendation rules.
RULES = {"low_confidence": 0.2, "non_scope": 0.3, "tvd": 0.15, "in_scope_priority": 0.4, "in_scope_confirmed": 0.4}
#: Recommendations in the order in which they are looked at.
RECOMMENDATIONS = ["ADDITIONAL_REVIEW_REQUIRED", "DATA_CORRECTION_REQUIRED_BEFORE_RETRAINING", "SCOPE_REBALANCING_REQUIRED_BEFORE_RETRAINING", "RETRAINING_PROPOSAL_JUSTIFIED", "NO_RETRAINING_RECOMMENDED"]


def cascade(flags: list[Column], names: list[str] = RECOMMENDATIONS) -> Column:
    """Name of the first flag that holds, else the last name."""
    out = F.lit(names[-1])
    for flag, name in reversed(list(zip(flags, names, strict=False))):
        out = F.when(flag, name).otherwise(out)
    return out


def recommendation(rows: DataFrame, rules: dict[str, float] = RULES) -> DataFrame:
    """One row: the shares that the rules look at and the recommendation."""
    inside = F.col("scope_group") == "IN_SCOPE"
    facts = rows.agg(
        share(F.col("scope_confidence") == "low").alias("low_confidence_share"),
        F.count_if(F.col("annotation_quality") == "defect_suspected").alias("defect_count"),
        share(~inside).alias("non_scope_share"),
        F.count_if(inside).alias("in_scope_rows"),
        share(F.when(inside, F.col("retraining_priority").isin("medium", "high"))).alias("in_scope_priority_share"),
        share(F.when(inside, F.col("error_disposition") == "confirmed_model_error")).alias("in_scope_confirmed_share"),
    )
    facts = facts.crossJoin(total_variation(rows, "retraining_priority", inside))
    flags = [
        F.col("low_confidence_share") > rules["low_confidence"],
        F.col("defect_count") > 0,
        (F.col("non_scope_share") >= rules["non_scope"]) | (F.col("tvd") >= rules["tvd"]),
        (F.col("in_scope_rows") > 0) & (F.col("in_scope_priority_share") >= rules["in_scope_priority"]) & (F.col("in_scope_confirmed_share") >= rules["in_scope_confirmed"]),
    ]
    return facts.withColumn("recommendation", cascade(flags))


def weighted_progress(rows: DataFrame, weight: str, progress: str) -> DataFrame:
    w = F.sum(weight)
    mean = F.try_divide(F.sum(F.col(weight) * F.col(progress)).cast("double"), w.cast("double"))
    return rows.agg(F.when(w > 0, F.coalesce(mean, F.lit(0.0))).otherwise(F.lit(0.0)).alias("progress"))


def gate_summary(rows: DataFrame, state: str) -> DataFrame:
    """blocked before caution before clear."""
    return rows.agg(F.when(F.bool_or(F.col(state) == "blocked"), "blocked").when(F.bool_or(F.col(state) == "caution"), "caution").otherwise("clear").alias("gate"))


def leaking_groups(rows: DataFrame, group: str, split: str) -> DataFrame:
    """Groups whose rows are in several splits."""
    g = rows.groupBy(group).agg(F.count_distinct(split).alias("n_splits"), F.count("*").alias("n_rows"))
    return g.where("n_splits <> 1")


def inconsistent_groups(rows: DataFrame, group: str, count: str) -> DataFrame:
    """Groups whose members differ in a count: the extremes and the distinct counts, widest first."""
    g = rows.groupBy(group).agg(F.count("*").alias("variant_count"), F.min(count).alias("count_min"), F.max(count).alias("count_max"), F.array_sort(F.collect_set(count)).alias("v"))
    g = g.where(F.size("v") > 1).withColumn("unique_values", F.array_join(F.col("v").cast("array<string>"), "|")).drop("v")
    return g.orderBy(F.desc(F.col("count_max") - F.col("count_min")), group)


def split_summary(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Per split: families, images, boxes, means and quantiles of box areas.

    images: family, split, included, n_boxes; boxes: split, area_ratio (of included images)."""
    keep = F.col("included")
    families = images.where(F.col("family").isNotNull()).groupBy("split", "family").agg(F.lit(1).alias("_")).groupBy("split").agg(F.count("*").alias("source_family_count"))
    i = images.groupBy("split").agg(
        F.count("*").alias("source_image_count"), F.count_if(keep).alias("model_included_image_count"),
        F.count_if(~keep).alias("excluded_variant_count"), F.count_if(keep & (F.col("n_boxes") > 0)).alias("positive_image_count"), F.count_if(keep & (F.col("n_boxes") == 0)).alias("negative_image_count"),
        F.sum(F.when(keep, F.col("n_boxes"))).alias("_boxes"),
    )
    areas = quantiles(boxes, "split", "area_ratio", {f"bbox_area_ratio_p{int(p * 100):02d}": p for p in (0.05, 0.5, 0.95)})
    b = boxes.groupBy("split").agg(F.count("*").alias("bbox_count"), F.count_if(F.col("area_ratio") < 0.01).alias("small_bbox_count"), F.count_if(F.col("area_ratio") > 0.5).alias("large_bbox_count"))
    order = ["split", "source_family_count", *[c for c in i.columns if c != "split"], "bbox_count", *[c for c in areas.columns if c != "split"], "small_bbox_count", "large_bbox_count"]
    out = i.join(families, "split", "left").join(b, "split", "left").join(areas, "split", "left").na.fill(0).select(*order)

    def ratio(part: str, whole: str, name: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0)).alias(name)

    percent_positive = (F.lit(100.0) * F.coalesce(F.try_divide(F.col("positive_image_count").cast("double"), F.col("model_included_image_count").cast("double")), F.lit(0.0))).alias("positive_image_percent")
    return out.select(*[c for c in out.columns if c != "_boxes"], percent_positive, ratio("_boxes", "model_included_image_count", "bbox_per_included_image_mean"), ratio("bbox_count", "positive_image_count", "bbox_per_positive_image_mean"))


def with_total(rows: DataFrame, group: str, *sums: Column) -> DataFrame:
    """Sums by group and a total row."""
    return rows.rollup(group).agg(*sums, F.grouping(group).alias("_g")).withColumn(group, F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.col(group))).drop("_g")
