"""Review queues, routing, worklists, suggestions, assignments and revisions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annoforge.functions import text as T

#: Review columns that a queue starts with.
QUEUE_DEFAULTS = {"brightness": "", "blur_score": "", "photo_type_review": "unknown", "angle_review": "unknown", "is_exterior_review": "unknown", "has_visible_damage_review": "unknown", "severity_review": "unknown", "review_status": "pending", "reviewer": "", "review_notes": ""}


def lookup(c: Column, table: dict[str, int | str], default) -> Column:
    """Value of a small fixed table, else the default."""
    out = F.lit(default)
    for key, value in reversed(list(table.items())):
        out = F.when(c == key, F.lit(value)).otherwise(out)
    return out


def review_queue(metadata: DataFrame, priorities: dict[str, int], default: int = 90, unreadable: int = 100) -> DataFrame:
    """Metadata rows with ids, priority, its reason, and the review columns at their start values.

    The id is of the path as given."""
    ok = T.truthy(F.col("is_readable"))
    base = lookup(F.col("source_bucket"), priorities, default)
    reason = F.concat(F.lit("source_bucket="), F.col("source_bucket"))
    return metadata.withColumns(
        {
            "review_id": T.sha1_id(F.col("image_id"), F.col("source_bucket"), F.col("original_path")),
            "quality_status": F.when(ok, "ready").otherwise("unreadable"),
            "priority": F.when(ok, base).otherwise(base + unreadable).cast("int"),
            "priority_reason": F.when(ok, reason).otherwise(F.concat(reason, F.lit("; unreadable"))),
            **{k: F.lit(v) for k, v in QUEUE_DEFAULTS.items()},
        }
    )


def in_order(queue: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows by priority, bucket, file name and id, at most `limit` of them."""
    out = queue.orderBy("priority", "source_bucket", "filename", "image_id")
    return out.limit(limit) if limit is not None else out


def counts_by(rows: DataFrame, *columns: str) -> DataFrame:
    """metric, value: the total, then a row for each value of each column; one pass over the rows."""
    named = F.explode(F.array(F.lit("total_rows"), *[F.concat(F.lit(f"{c}:"), F.col(c).cast("string")) for c in columns]))
    return rows.select(named.alias("metric")).groupBy("metric").agg(F.count("*").alias("value"))


def eligible(rows: DataFrame, status: str | None = "reviewed") -> DataFrame:
    """Rows whose normalised status is the wanted one; all rows where none is wanted."""
    return rows if status is None else rows.where(T.lowered(F.col("review_status")) == status.strip().lower())


def routes(rows: DataFrame) -> dict[str, DataFrame]:
    """Reviewed rows by use. Annotation candidates are a part of the exterior ones."""
    kind, damage = T.lowered(F.col("photo_type_review")), T.lowered(F.col("has_visible_damage_review"))
    return {
        "exterior": rows.where(kind == "exterior"),
        "low_quality": rows.where(kind == "low_quality"),
        "irrelevant": rows.where(kind == "irrelevant"),
        "annotation_candidates": rows.where((kind == "exterior") & (damage == "1")),
    }


def annotation_tasks(rows: DataFrame, priorities: dict[str, int], default: int = 90, status: str = "reviewed") -> DataFrame:
    """Tasks of the eligible rows; here status and severity are compared as they stand."""
    task = T.sha1_id(F.col("review_id"), F.col("image_id"), F.col("original_path"), prefix="task_")
    return rows.where(F.col("review_status") == status).select(
        task.alias("task_id"), "review_id", "image_id", "original_path", F.lit("bbox").alias("annotation_type"), F.lit("pending").alias("task_status"),
        lookup(F.col("severity_review"), priorities, default).cast("int").alias("priority"),
    )


def promote(rows: DataFrame, renamed: dict[str, str], order: list[str]) -> DataFrame:
    """Columns under their final names, in the given order."""
    return rows.withColumnsRenamed(renamed).select(*order)


def evolve(rows: DataFrame, id_col: str, added: dict[str, str], target: str, values: dict[str, str]) -> DataFrame:
    """New columns with constants, and other values in the target row."""
    return rows.withColumns({c: F.when(F.col(id_col) == target, F.lit(values.get(c, v))).otherwise(F.lit(v)) for c, v in added.items()})


def overlay(rows: DataFrame, proposal: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns replaced where the proposal has the key."""
    new = proposal.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    out = rows.join(new, key, "left").withColumns({c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns})
    return out.select(*rows.columns)


def keep_last(rows: DataFrame, key: str, position: str) -> DataFrame:
    """The last row of each key by position."""
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), position).alias("r"))
    return last.select("r.*")


def latest(rows: DataFrame, key: str, revision: str) -> DataFrame:
    """The row of the highest revision of each key."""
    return keep_last(rows, key, revision)


#: Choices of the suggestion columns.
PHOTO_TYPES = ["exterior", "interior", "low_quality", "irrelevant"]
ANGLES = ["front", "rear", "left", "right", "front_left", "front_right", "rear_left", "rear_right"]
PRODUCTION_FLOORS = {"photo_type": 0.75, "angle": 1.0}


def merge_suggestions(labels: DataFrame, suggestions: DataFrame, floors: dict[str, float] = PRODUCTION_FLOORS, auto_reviewer: str = "auto") -> DataFrame:
    """Labels with confident suggestions filled into blank or unknown fields of rows not yet reviewed.

    `matched` marks rows with a suggestion, whether anything of it was accepted or not."""
    s = suggestions.select(
        "image_id", "position",
        T.allowed(F.col("suggested_photo_type_review"), PHOTO_TYPES).alias("_type"), T.number_or_zero(F.col("photo_type_confidence")).alias("_type_c"),
        T.allowed(F.col("suggested_angle_review"), ANGLES).alias("_angle"), T.number_or_zero(F.col("angle_confidence")).alias("_angle_c"), T.stripped(F.col("auto_review_notes")).alias("_note"),
    )
    rows = labels.join(keep_last(s, "image_id", "position").drop("position").withColumn("_hit", F.lit(True)), "image_id", "left")
    open_ = F.coalesce("_hit", F.lit(False)) & (T.lowered(F.col("review_status")) != "reviewed")

    def blank(c: str) -> Column:
        return T.lowered(F.col(c)).isin("", "unknown")

    take_type = open_ & (F.col("_type") != "") & blank("photo_type_review") & (F.col("_type_c") >= floors["photo_type"])
    take_angle = open_ & (F.col("_angle") != "") & blank("angle_review") & (F.col("_angle_c") >= floors["angle"])
    exterior = F.when(F.col("_type") == "exterior", "1").otherwise("0")
    parts = F.array_compact(
        F.array(
            F.when(take_type, F.concat(F.lit("auto_photo_type="), "_type", F.lit(":"), T.fixed(F.col("_type_c"), 3))),
            F.when(take_angle, F.concat(F.lit("auto_angle="), "_angle", F.lit(":"), T.fixed(F.col("_angle_c"), 3))),
            F.when(open_ & (F.col("_note") != ""), F.col("_note")),
        )
    )
    rows = rows.select("*", take_type.alias("_t"), take_angle.alias("_a"), open_.alias("matched"), parts.alias("_parts"))
    any_ = F.col("_t") | F.col("_a")
    return rows.withColumns(
        {
            "photo_type_review": F.when(F.col("_t"), F.col("_type")).otherwise(F.col("photo_type_review")),
            "angle_review": F.when(F.col("_a"), F.col("_angle")).otherwise(F.col("angle_review")),
            "is_exterior_review": F.when(F.col("_t"), exterior).otherwise(F.col("is_exterior_review")),
            "review_status": F.when(F.col("matched") & (T.lowered(F.col("review_status")) == ""), "pending").otherwise(F.col("review_status")),
            "reviewer": F.when(any_ & (T.stripped(F.col("reviewer")) == ""), auto_reviewer).otherwise(F.col("reviewer")),
            "review_notes": F.when(F.size("_parts") > 0, T.with_note(F.col("review_notes"), F.array_join("_parts", "; "))).otherwise(F.col("review_notes")),
        }
    ).select(*labels.columns, "matched")


def join_suggestions(pilot: DataFrame, suggestions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Pilot rows with their suggestion, and errors: keys that repeat on a side or have no suggestion."""
    errors = None
    for name, side in (("pilot", pilot), ("suggestions", suggestions)):
        twice = side.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(f"duplicate_{name}").alias("code"), F.col(key).cast("string").alias("value"))
        errors = twice if errors is None else errors.unionByName(twice)
    lost = pilot.join(suggestions, key, "left_anti").select(F.lit("missing_suggestion").alias("code"), F.col(key).cast("string").alias("value"))
    return pilot.join(suggestions, key, "left"), errors.unionByName(lost)


def fill_by_key(rows: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns overwritten by key; a row without a match gets empty texts."""
    new = values.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = rows.join(new, key, "left").withColumns({c: F.coalesce(f"_new_{c}", F.lit("")) for c in columns})
    return out.drop(*[f"_new_{c}" for c in columns])


def id_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of one side only: missing (left only) and unknown (right only). A null is the key of no row of the other side.

    Both sides are read once and each key is grouped once, before and after one shuffle; no rows are sorted and joined."""
    both = left.select(key, F.lit(1).alias("_side")).unionByName(right.select(key, F.lit(2).alias("_side")))
    sides = both.groupBy(key).agg(F.bit_or("_side").alias("_sides"))
    alone = F.when((F.col("_sides") == 1) | F.col(key).isNull(), F.col("_sides").bitwiseAND(F.lit(1)) == 1), F.when((F.col("_sides") == 2) | F.col(key).isNull(), F.col("_sides").bitwiseAND(F.lit(2)) == 2)
    names = F.array_compact(F.array(F.when(alone[0], "missing"), F.when(alone[1], "unknown")))
    return sides.where((F.col("_sides") != 3) | F.col(key).isNull()).select(F.explode(names).alias("side"), key)


def same_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: whether both sides have the same keys."""
    return id_differences(left, right, key).agg((F.count("*") == 0).alias("equal"))


def concatenate(parts: list[DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """All parts as one table, and keys that occur in several rows."""
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole, whole.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


#: Rows numbered in one task, tasks at most, and sampled rows for each of their bounds.
RANGE_ROWS, RANGES, PER_BOUND = 500_000, 4096, 40


def ranged(rows: DataFrame, *order: str, range_rows: int = RANGE_ROWS, name: str = "_part") -> DataFrame:
    """Rows with the number of their range by the order of columns: ranges of about `range_rows` rows, RANGES at most.

    Bounds are constants, taken from a sample of bounded size, so that a task that runs again finds the same ranges."""
    n = rows.count()
    side = math.ceil(math.sqrt(min(RANGES, math.ceil(n / range_rows))))
    if side <= 1:
        return rows.withColumn(name, F.lit(0))
    key = F.struct(*order)
    sample = sorted(tuple(r) for r in rows.dropna(subset=list(order)).select(*order).sample(min(1.0, PER_BOUND * side * side / n), 7).limit(2 * PER_BOUND * side * side).collect())
    cuts = [sample[len(sample) * i // (side * side)] for i in range(1, side * side)] if sample else []
    kinds = [rows.schema[c].dataType for c in order]

    def constant(values: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(k).alias(c) for c, v, k in zip(order, values, kinds, strict=True)])

    def below(bounds: list[tuple]) -> Column:
        return F.size(F.filter(F.array(*map(constant, bounds)), lambda b: b <= key)) if bounds else F.lit(0)

    # first the block of ranges, then the range in it
    block = below(cuts[side - 1 :: side])
    inner = F.lit(0)
    for i in range(side):
        inner = F.when(F.col("_block") == i, below(cuts[i * side : i * side + side - 1])).otherwise(inner)
    return rows.withColumn("_block", block).withColumn(name, F.col("_block") * side + inner).drop("_block")


def positions(rows: DataFrame, *order: str, name: str = "position", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows numbered from 1 over the whole table by a total order of columns, without gathering it in one task: ranges
    of the order are numbered in parallel and shifted by the counts of the ranges before."""
    ranges = ranged(rows, *order, range_rows=range_rows)
    sizes = ranges.groupBy("_part").agg(F.count("*").alias("_m"))
    shift = sizes.select("_part", F.coalesce(F.sum("_m").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    local = ranges.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return local.join(F.broadcast(shift), "_part").withColumn(name, (F.col("_n") + F.col("_before")).cast("bigint")).drop("_part", "_n", "_before")


def hash_split(rows: DataFrame, key: Column, name: str, seed: int, ratios: tuple[float, float, float]) -> DataFrame:
    """Splits by place in the order of a seeded hash: floor(n * train) rows, floor(n * val), the rest test."""
    if min(ratios) < 0 or abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("ratios must not be negative and must sum to 1")
    n = rows.count()
    train = int(n * ratios[0])
    val = int(n * ratios[1])
    if n and not train and ratios[0] > 0:
        train = 1
    val = max(0, n - train) if train + val > n else val
    hashed = rows.withColumn("split_hash", F.sha1(F.encode(F.concat(F.lit(f"{seed}|"), key.cast("string")), "UTF-8")))
    ranked = positions(hashed, "split_hash", name)
    return ranked.withColumn("split", F.when(F.col("position") <= train, "train").when(F.col("position") <= train + val, "val").otherwise("test"))


def round_robin(rows: DataFrame, reviewers: list[str], *order) -> DataFrame:
    """Rows dealt to reviewers in turn."""
    dealt = positions(rows, *order, name="assignment_order")
    names = F.array(*[F.lit(r) for r in reviewers])
    return dealt.withColumn("reviewer_id", F.get(names, ((F.col("assignment_order") - 1) % len(reviewers)).cast("int")))


def stratified(rows: DataFrame, stratum: str, order: list[str], total: int, seed: int, key: str) -> DataFrame:
    """At most `total` rows: strata in the given order, inside one by a seeded hash."""
    place = lookup(F.col(stratum), {s: i for i, s in enumerate(order)}, len(order))
    hashed = F.sha1(F.encode(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")), "UTF-8"))
    return rows.orderBy(place, hashed, key).limit(total)


def case_view(cases: DataFrame, decisions: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Cases with their stored decision, or the defaults of none."""
    return cases.join(decisions, key, "left").withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


#: Named views over stored decisions.
VIEWS = {
    "all": "true",
    "pending": "review_status = 'pending'",
    "reviewed": "review_status = 'reviewed'",
    "needs_adjudication": "review_status = 'needs_adjudication'",
    "high_priority": "retraining_priority = 'high'",
    "annotation_issues": "annotation_quality = 'defect_suspected'",
}


def view(rows: DataFrame, name: str) -> DataFrame:
    return rows.where(VIEWS[name])


def search(rows: DataFrame, query: str, columns: list[str]) -> DataFrame:
    """Rows that hold the text in any of the columns, whatever its case."""
    return rows.where(F.contains(F.lower(F.concat_ws(" ", *columns)), F.lit(query.lower())))


#: Outcome, error disposition, status.
OUTCOMES = [
    ("model_miss", "confirmed_model_error", "reviewed"),
    ("model_false_positive", "confirmed_model_error", "reviewed"),
    ("localization_error", "confirmed_model_error", "reviewed"),
    ("duplicate_prediction", "confirmed_model_error", "reviewed"),
    ("annotation_issue", "annotation_issue", "reviewed"),
    ("threshold_tradeoff", "expected_threshold_tradeoff", "reviewed"),
    ("invalid_image", "invalid_review_case", "reviewed"),
    ("ambiguous", "ambiguous_case", "needs_adjudication"),
]


def canonical_fields(selections: DataFrame) -> DataFrame:
    """Stored fields of valid selections, and an error code for others (empty: valid)."""
    outcomes = selections.sparkSession.createDataFrame(OUTCOMES, "outcome string, error_disposition string, derived_status string")
    defect = F.col("annotation_quality") == "defect_suspected"
    notes = T.stripped(F.col("review_notes"))
    issue = F.col("outcome") == "annotation_issue"
    proposal = F.col("recommended_action") == "create_annotation_correction_proposal"
    other = F.col("reason").eqNullSafe("other") | F.col("annotation_defect_type").eqNullSafe("other") | F.col("recommended_action").eqNullSafe("other")
    code = (
        F.when(F.col("error_disposition").isNull(), "unknown_outcome")
        .when(T.stripped(F.col("reviewer")) == "", "blank_reviewer")
        .when((F.col("retraining_priority") == "high") & (notes == ""), "high_priority_needs_notes")
        .when((F.col("outcome") == "ambiguous") & (notes == ""), "ambiguous_needs_notes")
        .when(issue & ~defect, "issue_needs_defect")
        .when(defect & ~issue, "defect_needs_issue")
        .when(defect & (F.col("annotation_defect_type") == "none"), "defect_needs_type")
        .when(defect & (notes == ""), "defect_needs_notes")
        .when(defect & ~proposal, "defect_needs_proposal")
        .when(~defect & (F.col("annotation_defect_type") != "none"), "type_without_defect")
        .when(~defect & proposal, "proposal_without_defect")
        .when(other & (notes == ""), "other_needs_notes")
        .otherwise("")
    )
    out = selections.join(F.broadcast(outcomes), "outcome", "left").withColumn("error_code", code)
    return out.withColumn("correction_proposal_required", F.when(defect, "yes").otherwise("no")).withColumnRenamed("derived_status", "review_status")
