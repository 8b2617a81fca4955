"""A review store as append-only tables: saves become revisions, an audit trail and current state.

A store's base rows are never updated: saves are appended, and state is the last of them by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoforge.functions import text as T
from annoforge.operators.checks import error, rule_errors
from annoforge.operators.review import positions
from annoforge.operators.scans import Ranges

#: Statuses that a saved review may have.
SAVED = ("reviewed", "needs_adjudication")
#: Type of the audit events of saves.
SAVE_EVENT = "review_saved"


def payload_rules(reviewer: Column) -> list[tuple[Column, Column]]:
    """Rules of a saved review: its status, its reviewer against the workspace's, an instant with offset."""
    status, who, at = (F.coalesce(F.col(c), F.lit("")) for c in ("review_status", "reviewer", "reviewed_at_utc"))
    return [
        (~status.isin(*SAVED), error("review_status", status, "status_not_saved", "saved review status must be " + " or ".join(SAVED))),
        (who != reviewer, error("reviewer", who, "reviewer_mismatch", "reviewer does not match workspace identity")),
        (T.instant(at).isNull(), error("reviewed_at_utc", at, "invalid_timestamp", "reviewed_at_utc must be valid ISO 8601")),
        (T.instant(at).isNotNull() & T.instant(at, "required").isNull(), error("reviewed_at_utc", at, "no_offset", "reviewed_at_utc must include a timezone offset")),
    ]


def payload_errors(saves: DataFrame, reviewer: str, number: str = "seq") -> DataFrame:
    return rule_errors(saves, payload_rules(F.lit(reviewer)), number)


def judged(cases: DataFrame, saves: DataFrame, key: str, reviewer: str) -> DataFrame:
    """saves with _code, their first fault (null: accepted), and _base, their case's revision, by one join.

    The cases are sorted and merged: broadcast, they would all go through the driver for as long as they are few enough."""
    code = F.coalesce(*[F.when(F.coalesce(broken, F.lit(False)), what["code"]) for broken, what in payload_rules(F.lit(reviewer))])
    known = cases.groupBy(key).agg(F.max(F.struct(F.col("revision") if "revision" in cases.columns else F.lit(None).cast("bigint").alias("revision"))).alias("_known"))
    rows = saves.join(known.hint("merge"), key, "left").withColumns({"_code": F.coalesce(code, F.when(F.col("_known").isNull(), "unknown_case")), "_base": F.col("_known.revision")})
    return rows.drop("_known")


def accepted(cases: DataFrame, saves: DataFrame, key: str, reviewer: str) -> tuple[DataFrame, DataFrame]:
    """Saves of known cases that keep the payload rules, and (seq, code) of the others, by their first fault."""
    rows = judged(cases, saves, key, reviewer)
    return rows.where("_code is null").drop("_code", "_base"), refusals(rows)


def refusals(rows: DataFrame) -> DataFrame:
    return rows.where("_code is not null").select("seq", F.col("_code").alias("code"))


def save(cases: DataFrame, saves: DataFrame, key: str, fields: list[str], reviewer: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Current state, audit events and refused saves.

    cases: key, revision and the fields, and saved_at where there were saves before; saves: seq, key, the fields and
    what payload_rules read. Every accepted save raises its case's revision and the store's count of saves by one."""
    return applied(cases, judged(cases, saves, key, reviewer), key, fields)


def applied(cases: DataFrame, rows: DataFrame, key: str, fields: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """save() from saves that are judged already."""
    good = rows.where("_code is null")
    per_case = good.groupBy(key).agg(F.count("*").alias("_n"), F.max_by(F.struct(*fields, F.col("reviewed_at_utc").alias("saved_at")), "seq").alias("_last"))
    held = cases.join(per_case.hint("merge"), key, "left")
    before = [F.col("saved_at")] if "saved_at" in cases.columns else []
    state = held.select(
        key,
        *[F.when(F.col("_n").isNotNull(), F.col(f"_last.{c}")).otherwise(F.col(c)).alias(c) for c in fields],
        (F.col("revision") + F.coalesce("_n", F.lit(0))).alias("revision"),
        F.coalesce("_last.saved_at", *before).alias("saved_at"),
    )
    counted = positions(good, "seq", name="successful_save_count")
    counted = Ranges(counted, key, "seq").running(_nth=F.lit(1)).done()
    audit = counted.select("seq", F.lit(SAVE_EVENT).alias("event_type"), key, (F.col("_base") + F.col("_nth")).alias("revision"), "successful_save_count", *fields)
    return state, audit, refusals(rows)


def upsert(current: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """current with the last change of each key in the order, new keys added; changes: the columns of current and the order."""
    columns = [c for c in current.columns if c != key]
    last = changes.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_new"))
    rows = current.join(last, key, "full")
    return rows.select(key, *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns])


def history_errors(history: DataFrame, added: DataFrame, path: str = "output_path") -> DataFrame:
    """(path, n) of exports that would share a path with another one, old or new."""
    both = history.select(path, F.lit(0).alias("_new")).unionByName(added.select(path, F.lit(1).alias("_new")))
    return both.groupBy(path).agg(F.count("*").alias("n"), F.max("_new").alias("_new")).where("n > 1 and _new = 1").drop("_new")


def latest_valid(artifacts: DataFrame, name: str, valid: Column) -> DataFrame:
    """The newest artifact by name of those that pass; unreadable ones are passed over."""
    return artifacts.where(F.coalesce(valid, F.lit(False))).orderBy(F.desc(name)).limit(1)
