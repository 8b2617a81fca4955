"""Validation as error tables. A check returns rows (row_number, column, value, code, message); callers act on them.

Nothing is asserted inside a projection, where the optimizer could prune the check away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoforge.functions.text import instant, lowered, stripped

ERROR = "row_number bigint, column string, value string, code string, message string"


class GateError(ValueError):
    """A check found errors; the first of them are in the message."""


def gate(errors: DataFrame, what: str, shown: int = 5) -> None:
    """Raise if there is any error; reads at most `shown` of them."""
    first = errors.orderBy("row_number", "column", "code").limit(shown).collect()
    if first:
        raise GateError(f"{what}: " + "; ".join(f"row {r['row_number']} {r['column']}: {r['message']}" for r in first))


def missing_columns(rows: DataFrame, required: list[str], exact: bool = False) -> list[str]:
    """Required columns that are not there; with exact, everything that breaks the order."""
    if exact:
        return [] if rows.columns == required else [f"expected {required}, found {rows.columns}"]
    return [c for c in required if c not in rows.columns]


def error(column: str, value: Column, code: str, message: str | Column) -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    return F.struct(F.lit(column).alias("column"), value.cast("string").alias("value"), F.lit(code).alias("code"), message.alias("message"))


def rule_errors(rows: DataFrame, rules: list[tuple[Column, Column]], number: str = "row_number") -> DataFrame:
    """Errors of all rules in one pass: (when it is broken, the error struct)."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), what) for broken, what in rules]))
    return rows.select(F.col(number).cast("bigint").alias("row_number"), F.explode(found).alias("e")).select("row_number", "e.column", "e.value", "e.code", "e.message")


def domain_rules(domains: dict[str, list[str]], normalised: bool = False) -> list[tuple[Column, Column]]:
    """Values outside their domain, as they stand or after trimming and lowering."""
    out = []
    for column, values in domains.items():
        value = lowered(F.col(column)) if normalised else F.coalesce(F.col(column), F.lit(""))
        out.append((~value.isin(*values), error(column, value, "invalid_value", "value must be one of: " + ", ".join(values))))
    return out


def identity_rules(columns: list[str]) -> list[tuple[Column, Column]]:
    return [(stripped(F.col(c)) == "", error(c, F.coalesce(F.col(c), F.lit("")), "empty_required_value", "identity value must not be empty")) for c in columns]


def label_rules(p: str = "") -> list[tuple[Column, Column]]:
    """Cross-field rules of review labels; damage 0 goes with severity none or unknown."""
    kind, ext, damage, severity, status, who = (F.col(p + c) for c in ("photo_type_review", "is_exterior_review", "has_visible_damage_review", "severity_review", "review_status", "reviewer"))
    rule = "conditional_rule"
    return [
        ((status == "reviewed") & (stripped(who) == ""), error("reviewer", who, rule, "review_status=reviewed requires reviewer")),
        ((kind == "exterior") & (ext != "1"), error("is_exterior_review", ext, rule, "photo_type_review=exterior requires is_exterior_review=1")),
        (kind.isin("interior", "low_quality", "irrelevant") & (ext != "0"), error("is_exterior_review", ext, rule, F.concat(F.lit("photo_type_review="), kind, F.lit(" requires is_exterior_review=0")))),
        ((damage == "0") & ~severity.isin("none", "unknown"), error("severity_review", severity, rule, "has_visible_damage_review=0 requires severity_review=none or unknown")),
        ((damage == "1") & (severity == "none"), error("severity_review", severity, rule, "has_visible_damage_review=1 cannot use severity_review=none")),
        ((severity == "none") & (damage != "0"), error("has_visible_damage_review", damage, rule, "severity_review=none requires has_visible_damage_review=0")),
        (severity.isin("minor", "moderate", "severe") & (damage != "1"), error("has_visible_damage_review", damage, rule, "severity_review=minor/moderate/severe requires has_visible_damage_review=1")),
    ]


def pilot_rules(p: str = "human_") -> list[tuple[Column, Column]]:
    """Consistency rules of pilot reviews, on normalised values; damage 0 goes with severity none only."""
    names = {c: p + c for c in ("photo_type_review", "is_exterior_review", "has_visible_damage_review", "severity_review")}
    kind, ext, damage, severity = (lowered(F.col(n)) for n in names.values())
    e, s = names["is_exterior_review"], names["severity_review"]
    flag, pair = "inconsistent_exterior_flag", "inconsistent_damage_severity"
    return [
        ((kind == "exterior") & (ext != "1"), error(e, ext, flag, "exterior requires an exterior flag of 1")),
        (kind.isin("interior", "low_quality", "irrelevant") & (ext != "0"), error(e, ext, flag, "other photo types require an exterior flag of 0")),
        ((damage == "0") & (severity != "none"), error(s, severity, pair, "no damage requires severity none")),
        ((damage == "1") & (severity == "none"), error(s, severity, pair, "damage cannot have severity none")),
        ((damage == "unknown") & (severity != "unknown"), error(s, severity, pair, "unknown damage requires severity unknown")),
    ]


def status_rules(p: str = "human_") -> list[tuple[Column, Column]]:
    """What each review status requires."""
    status, at = lowered(F.col(p + "review_status")), stripped(F.col(p + "reviewed_at"))
    needed = ["reviewer", "reviewed_at", "photo_type_review", "is_exterior_review", "has_visible_damage_review", "severity_review"]
    out = [((status == "reviewed") & (stripped(F.col(p + c)) == ""), error(p + c, F.col(p + c), "reviewed_required_value", f"{p}{c} is required when reviewed")) for c in needed]
    angle = p + "angle_review"
    out.append(((status == "reviewed") & (lowered(F.col(p + "photo_type_review")) == "exterior") & (stripped(F.col(angle)) == ""), error(angle, F.col(angle), "reviewed_required_value", f"{angle} is required when reviewed")))
    out.append(((status == "reviewed") & (at != "") & instant(at).isNull(), error(p + "reviewed_at", at, "invalid_datetime", "must be an ISO 8601 datetime")))
    out.append(((status == "pending") & (at != ""), error(p + "reviewed_at", at, "pending_reviewed_at_filled", "must be blank when pending")))
    for c, code in (("reviewer", "status_required_reviewer"), ("review_notes", "status_required_notes")):
        out.append((status.isin("needs_followup", "skipped") & (stripped(F.col(p + c)) == ""), error(p + c, F.col(p + c), code, f"{p}{c} is required for this status")))
    return out


def first_seen(rows: DataFrame, column: str, number: str = "row_number", trimmed: bool = False) -> DataFrame:
    """An error for every later row of a value, naming the first. Blanks are left out.

    First rows come from a partial aggregation and a join, not from a window over a value's rows."""
    value = stripped(F.col(column)) if trimmed else F.coalesce(F.col(column).cast("string"), F.lit(""))
    named = rows.select(F.col(number).cast("bigint").alias("row_number"), value.alias("value")).where("value <> ''")
    first = named.groupBy("value").agg(F.min("row_number").alias("f"), F.count("*").alias("n")).where("n > 1")
    late = named.join(first, "value").where("row_number > f")
    return late.select("row_number", F.lit(column).alias("column"), "value", F.lit("duplicate_value").alias("code"), F.concat(F.lit(f"duplicate {column}; first seen on row "), F.col("f").cast("string")).alias("message"))


def duplicate_counts(rows: DataFrame, column: str) -> DataFrame:
    """One row: rows in repeated groups, and rows beyond the first of each."""
    g = rows.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_beyond_first"))


def invalid_row_count(rows: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: rows, errors, rows with an error (all of them where an error names row 1, the header)."""
    e = errors.agg(F.count("*").alias("error_count"), F.count_distinct(F.when(F.col("row_number") >= 2, F.col("row_number"))).alias("bad"), F.count_if(F.col("row_number") == 1).alias("header"))
    both = rows.agg(F.count("*").alias("total_rows")).crossJoin(e)
    return both.select("total_rows", "error_count", F.when(F.col("header") > 0, F.col("total_rows")).otherwise(F.col("bad")).alias("invalid_rows"))


def expected_counts(rows: DataFrame, group: str, expected: dict[str, int]) -> DataFrame:
    """Groups whose count is not the expected one; absent groups count 0."""
    want = rows.sparkSession.createDataFrame(sorted(expected.items()), "k string, expected bigint")
    have = rows.groupBy(F.col(group).cast("string").alias("k")).agg(F.count("*").alias("actual"))
    return want.join(have, "k", "full").na.fill(0, ["expected", "actual"]).where("expected <> actual")


def positional_differences(before: DataFrame, after: DataFrame, position: str, columns: list[str]) -> DataFrame:
    """Cells that differ between rows of one position, and rows without a partner."""
    a = before.select(position, F.struct(*columns).alias("a"))
    b = after.select(position, F.struct(*columns).alias("b"))
    both = a.join(b, position, "full")
    cells = [F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.struct(F.lit(c).alias("column"), F.col(f"a.{c}").cast("string").alias("before"), F.col(f"b.{c}").cast("string").alias("after"))) for c in columns]
    return both.select(position, F.explode(F.array_compact(F.array(*cells))).alias("d")).select(position, "d.column", "d.before", "d.after")


def gaps(events: DataFrame, id_col: str) -> DataFrame:
    """Ids that are not the one before plus 1, the first not 1; repeats too. No window over all rows.

    An id is in place if id - 1 occurs, or it is 1, and it occurs once."""
    ids = events.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("n"))
    before = ids.select((F.col("id") + 1).alias("id"), F.lit(True).alias("ok"))
    return ids.join(before, "id", "left").where((F.col("n") > 1) | (F.col("ok").isNull() & (F.col("id") != 1))).select("id", F.col("n").alias("occurrences"))


def later_references(events: DataFrame, id_col: str, order: str, refers: str) -> DataFrame:
    """Rows that refer to an id that does not occur earlier."""
    known = events.groupBy(F.col(id_col).alias(refers)).agg(F.min(order).alias("_first"))
    rows = events.where(F.col(refers).isNotNull()).join(known, refers, "left")
    return rows.where(F.col("_first").isNull() | (F.col("_first") >= F.col(order))).select(id_col, order, refers)


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return children.join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def phrase_errors(rows: DataFrame, id_col: str, text_col: str, phrases: list[str]) -> DataFrame:
    """Required phrases that a text lacks, whatever their case."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    lack = F.array_compact(F.array(*[F.when(~F.contains(low, F.lit(p.lower())), F.lit(p)) for p in phrases]))
    return rows.select(id_col, F.explode(lack).alias("missing_phrase"))


def applied_state(rows: DataFrame, target: Column, done: list[Column]) -> DataFrame:
    """One row: whether a change to the target row is not applied, partial, applied, or its target is not unique."""
    hits = sum((F.when(F.coalesce(d, F.lit(False)), 1).otherwise(0) for d in done), F.lit(0))
    g = rows.where(target).agg(F.count("*").alias("targets"), F.max(hits).alias("hits"))
    return g.select("targets", F.when(F.col("targets") != 1, "drift").when(F.col("hits") == 0, "not_applied").when(F.col("hits") == len(done), "applied").otherwise("partial").alias("state"))
