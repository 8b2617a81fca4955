"""Tables with a commit log on the shared file system: versions, snapshots, conflicts, and a review store on top.

A set of tables lives in a folder: data files under data/, and one numbered manifest a version under log/. A manifest
names every file folder of every table at its version, so that a snapshot is one small read and old versions stay
readable. Writers put their files first and then the next manifest, which only succeeds if that number is not there:
of two writers from the same version one wins and the other gets a Conflict. A writer that dies leaves files that no
manifest names; readers never see them and vacuum() removes them.

Where rows go by a key they are kept in hash buckets, and a change rewrites the buckets that it touches, no others.
"""

from __future__ import annotations

import atexit
import json
import os
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from annoforge.operators import store as P
from annoforge.operators.review import view
from annoforge.sources.sinks import Store

BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer has put the version first."""


class Damaged(RuntimeError):
    """Files do not hold what their manifest says."""


_scratch: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; without it only a local session may go on."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if re.match(r"local(\[|$)", spark.sparkContext.master) is None:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"/tmp/checkpoints/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name in the shared folder; its files go with the driver."""
    path = f"{shared_folder(spark)}/annoforge/{what}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


@atexit.register
def _clear() -> None:
    for spark, path in _scratch:
        try:
            Store(spark).delete(path)
        except Exception:  # the session's JVM may have gone first
            return


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file whole, or not at all where there is one of its name: whether it was written.

    On a local file system a link of a finished file does it; elsewhere a rename that does not overwrite, which
    file systems that tables may live on do as one step."""
    store = Store(spark)
    fs, where = store._at(path)
    staged = f"{path}.{uuid.uuid4().hex}.tmp"
    store.write_text(staged, text)
    try:
        if fs.getScheme() == "file":
            try:
                os.link(store._at(staged)[1].toUri().getPath(), where.toUri().getPath())
            except FileExistsError:
                return False
            return True
        jvm = spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
        try:
            context.rename(store._at(staged)[1], where, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception:
            if store.exists(path):
                return False
            raise
        return True
    finally:
        if store.exists(staged):
            store.delete(staged)


class Tables:
    """A versioned set of tables in a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Store(spark)

    # --- versions

    def _file(self, version: int) -> str:
        return f"{self.root}/log/{version:020d}.json"

    def versions(self) -> list[int]:
        if not self.store.exists(f"{self.root}/log"):
            return []
        fs, where = self.store._at(f"{self.root}/log")
        names = (s.getPath().getName() for s in fs.listStatus(where))
        return sorted(int(n[:20]) for n in names if re.fullmatch(r"\d{20}\.json", n))

    def latest(self) -> int:
        """The newest version; 0 before the first commit."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.latest() if version is None else version
        if version == 0:
            return {"version": 0, "tables": {}, "values": {}}
        if not self.store.exists(self._file(version)):
            raise LookupError(f"no version {version}")
        return json.loads(self.store.read_text(self._file(version)))

    # --- reading

    def read(self, table: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """A table as it was at a version; buckets: these only."""
        held = self.manifest(version)["tables"].get(table)
        if held is None:
            raise LookupError(f"no table {table}")
        schema = StructType.fromJson(held["schema"])
        parts = [p["path"] for p in held["parts"] if buckets is None or p["bucket"] in buckets]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{p}" for p in parts])

    def log(self) -> DataFrame:
        """(version, operation, table_name, parts, n_rows) of every version that is still there."""
        rows = []
        for v in self.versions():
            m = self.manifest(v)
            rows += [(v, m["operation"], name, len(t["parts"]), sum(p["rows"] for p in t["parts"])) for name, t in sorted(m["tables"].items())]
        return self.spark.createDataFrame(rows, "version bigint, operation string, table_name string, parts bigint, n_rows bigint")

    # --- writing

    def _write(self, table: str, rows: DataFrame, key: str | None, buckets: int) -> list[dict]:
        """Write rows as new parts, read back and counted."""
        folder = f"{table}/{uuid.uuid4().hex}"
        where = f"{self.root}/data/{folder}"
        if key is None:
            rows.write.parquet(where)
            n = self.spark.read.schema(rows.schema).parquet(where).count()
            return [{"path": folder, "bucket": None, "rows": n}] if n else []
        bucketed = rows.withColumn(BUCKET, bucket_of(key, buckets))
        bucketed.repartition(BUCKET).sortWithinPartitions(BUCKET, key).write.partitionBy(BUCKET).parquet(where)
        counted = self.spark.read.schema(bucketed.schema).parquet(where).groupBy(BUCKET).count().collect()
        return [{"path": f"{folder}/{BUCKET}={r[0]}", "bucket": r[0], "rows": r[1]} for r in sorted(counted)]

    def commit(self, base: dict, operation: str, appended: dict[str, DataFrame] | None = None, replaced: dict[str, tuple[DataFrame, str | None, int, list[int] | None]] | None = None, values: dict | None = None) -> int:
        """Put the version after `base` (a manifest) with rows appended to tables, tables or buckets of them replaced
        (rows, key, number of buckets, buckets: all if None), and values set. Conflict if that version is there."""
        tables = {name: dict(t, parts=list(t["parts"])) for name, t in base["tables"].items()}
        for name, rows in (appended or {}).items():
            held = tables.setdefault(name, {"schema": rows.schema.jsonValue(), "parts": []})
            expect_schema(name, held, rows)
            held["parts"] += self._write(name, rows, None, 0)
        for name, (rows, key, buckets, touched) in (replaced or {}).items():
            held = tables.setdefault(name, {"schema": rows.schema.jsonValue(), "parts": [], "key": key, "buckets": buckets})
            expect_schema(name, held, rows)
            held["parts"] = [p for p in held["parts"] if touched is not None and p["bucket"] not in touched] + self._write(name, rows, key, buckets)
        version = base["version"] + 1
        new = {"version": version, "operation": operation, "at": time.time(), "tables": tables, "values": base["values"] | (values or {})}
        if not put_new(self.spark, self._file(version), json.dumps(new, sort_keys=True)):
            raise Conflict(f"version {version} is there already: {operation} started from {base['version']}")
        return version

    def transact(self, change: Callable[[dict], int], attempts: int = 5) -> int:
        """Run a change from the newest version; after a Conflict again, from what the other writer left."""
        for left in range(attempts - 1, -1, -1):
            try:
                return change(self.manifest())
            except Conflict:
                if not left:
                    raise
        raise ValueError("attempts must be at least 1")

    # --- upkeep

    def check(self, version: int | None = None) -> None:
        """Every part of a version is there with the rows that its manifest counts."""
        for name, t in self.manifest(version)["tables"].items():
            for p in t["parts"]:
                where = f"{self.root}/data/{p['path']}"
                if not self.store.exists(where):
                    raise Damaged(f"{name}: {p['path']} is missing")
            if t["parts"]:
                n = self.read(name, version).count()
                if n != sum(p["rows"] for p in t["parts"]):
                    raise Damaged(f"{name}: {n} rows in place of {sum(p['rows'] for p in t['parts'])}")

    def compact(self, table: str) -> int:
        """A table of appended parts as one part, as a version of its own."""
        return self.transact(lambda base: self.commit(base, "compact", replaced={table: (self.read(table, base["version"]), None, 0, None)}))

    def vacuum(self, keep: int, grace_seconds: float = 3600) -> int:
        """Drop all but the newest `keep` versions, and files that none of these names and that are older than the
        grace, so that a writer's files stay until its commit. Returns the folders deleted."""
        if keep < 1:
            raise ValueError("at least one version stays")
        versions = self.versions()
        wanted = {p["path"].split("/")[1] for v in versions[-keep:] for t in self.manifest(v)["tables"].values() for p in t["parts"]}
        for v in versions[:-keep]:
            self.store.delete(self._file(v))
        fs, data = self.store._at(f"{self.root}/data")
        gone, now = 0, time.time()
        for kind in fs.listStatus(data) if fs.exists(data) else []:
            for s in fs.listStatus(kind.getPath()):
                if s.getPath().getName() not in wanted and now - s.getModificationTime() / 1000 >= grace_seconds:
                    fs.delete(s.getPath(), True)
                    gone += 1
        return gone


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def expect_schema(name: str, held: dict, rows: DataFrame) -> None:
    want = [(f["name"], f["type"]) for f in held["schema"]["fields"]]
    have = [(f["name"], f["type"]) for f in rows.schema.jsonValue()["fields"]]
    if want != have:
        raise ValueError(f"{name}: columns {have} in place of {want}")


class Reviews:
    """A review store on versioned tables: cases by key in buckets, audit events, exports, and a few values.

    Every save is one commit of state, events and counters: readers see all of it or nothing."""

    def __init__(self, spark: SparkSession, root: str, key: str, fields: list[str], buckets: int = 64):
        self.tables, self.key, self.fields, self.buckets = Tables(spark, root), key, fields, buckets

    def open(self, cases: DataFrame, identity: dict[str, str]) -> int:
        """Begin with cases (key, fields, revision), or go on with a store of the same identity and cases."""
        wanted = cases.select(self.key, F.xxhash64(*sorted(set(cases.columns) - {self.key})).alias("print"))
        base = self.tables.manifest()
        if base["version"]:
            if base["values"]["identity"] != identity:
                raise ValueError("the store belongs to another workspace identity")
            begun = self.tables.read("source")
            if not wanted.exceptAll(begun).isEmpty() or not begun.exceptAll(wanted).isEmpty():
                raise ValueError("the source cases are not those of the store")
            return base["version"]
        state = cases.select(self.key, *self.fields, F.col("revision").cast("bigint").alias("revision"), F.lit(None).cast("string").alias("saved_at"))
        return self.tables.commit(base, "open", appended={"source": wanted}, replaced={"cases": (state, self.key, self.buckets, None)}, values={"identity": identity, "saves": 0})

    def save(self, saves: DataFrame, attempts: int = 5) -> int:
        """Commit all accepted saves of a batch, in the order of `seq`; the others go to the table `refused`.

        saves: seq, key, the fields, and what the payload rules read. Only buckets with saved cases are rewritten."""
        return self.tables.transact(lambda base: self.save_from(base, saves), attempts)

    def save_from(self, base: dict, saves: DataFrame) -> int:
        """save() from a version that the caller has read; Conflict if it is not the newest any more."""
        touched = [r[0] for r in saves.select(bucket_of(self.key, self.buckets)).distinct().collect()]
        cases = self.tables.read("cases", base["version"], touched)
        spark = self.tables.spark
        # judged once: state, events, refusals and their counts all start from here
        kept = scratch(spark, "saves")
        P.judged(cases, saves, self.key, base["values"]["identity"]["reviewer"]).write.parquet(kept)
        rows = spark.read.parquet(kept)
        state, audit, refused = P.applied(cases, rows, self.key, self.fields)
        state = state.withColumn("revision", F.col("revision").cast("bigint"))
        done = base["values"]["saves"]
        nth = F.col("successful_save_count") + done
        events = audit.select(nth.cast("bigint").alias("event_id"), "event_type", self.key, F.col("revision").cast("bigint").alias("revision"), "seq", *self.fields)
        saved = rows.where("_code is null").count()
        return self.tables.commit(base, "save", appended={"events": events, "refused": refused}, replaced={"cases": (state, self.key, self.buckets, touched)}, values={"saves": done + saved})

    def state(self, version: int | None = None, name: str = "all") -> DataFrame:
        """Cases at a version, all or those of a named view."""
        return view(self.tables.read("cases", version), name)

    def events(self, version: int | None = None) -> DataFrame:
        return self.tables.read("events", version)

    def set_last_viewed(self, value) -> int:
        """Remember the case viewed last; an unknown one is refused."""

        def change(base: dict) -> int:
            kind = self.tables.read("cases", base["version"]).schema[self.key].dataType
            asked = self.tables.spark.createDataFrame([(value,)], StructType().add(self.key, kind))
            [bucket] = [r[0] for r in asked.select(bucket_of(self.key, self.buckets)).collect()]
            if self.tables.read("cases", base["version"], [bucket]).join(asked, self.key, "left_semi").isEmpty():
                raise LookupError(f"unknown case: {value}")
            return self.tables.commit(base, "view", values={"last_viewed": value})

        return self.tables.transact(change)

    def value(self, name: str, version: int | None = None):
        return self.tables.manifest(version)["values"].get(name)

    def export(self, path: str, digest: str, attempts: int = 5) -> int:
        """Record an export; a path that was exported to before is refused."""

        def change(base: dict) -> int:
            row = self.tables.spark.createDataFrame([(path, digest)], "output_path string, sha256 string")
            if "exports" in base["tables"] and not P.history_errors(self.tables.read("exports", base["version"]), row).isEmpty():
                raise ValueError(f"already exported to {path}")
            return self.tables.commit(base, "export", appended={"exports": row})

        return self.tables.transact(change, attempts)
