"""Verified packages: pinned copies, archives with side hashes, roots, artifacts and completed exports.

These steps look at a bounded number of files each; what they hash or copy, executors read, except for single
archives, which are built in the driver."""

from __future__ import annotations

import hashlib
import io
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoforge.operators import release as L
from annoforge.operators.checks import GateError
from annoforge.operators.digests import frame_equal, in_file_order, in_order, written_in_order
from annoforge.operators.store import history_errors
from annoforge.sources.readers import SourceError, against_ledger, files, ledger, text_table
from annoforge.sources.sinks import Store, as_json, write_csv, written_and_equal
from annoforge.sources.zips import unsafe_member

#: Suffix of the file that holds an archive's digest.
SIDECAR = ".sha256"
#: Fixed value: the time that all members of an archive bear, so that equal content gives equal bytes.
EPOCH = (1980, 1, 1, 0, 0, 0)


def _relative(spark: SparkSession, path: str) -> str:
    """The path as the file system spells it, without a slash at its end."""
    fs, where = Store(spark)._at(path)
    return fs.makeQualified(where).toString().rstrip("/")


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size_bytes, sha256) of the files below a folder, paths relative to it."""
    head = _relative(spark, folder).split(":", 1)[-1].lstrip("/")
    inside = F.regexp_replace(F.regexp_replace("path", r"^[a-z]+:/*", ""), F.lit("^\\Q" + head + "\\E/+"), F.lit(""))
    return files(spark, folder).select(inside.alias("path"), "size_bytes", "sha256")


def refuse(errors: DataFrame, what: str, shown: int = 5) -> None:
    """Raise if a table of faults has rows; reads at most `shown` of them."""
    first = errors.limit(shown).collect()
    if first:
        raise GateError(f"{what}: " + "; ".join(" ".join(str(v) for v in r) for r in first))


def verify_pins(spark: SparkSession, folder: str, pins: dict[str, str]) -> None:
    """Every pinned file is there with its digest."""
    wanted = spark.createDataFrame(sorted(pins.items()), "path string, sha256 string")
    refuse(L.pin_errors(inventory(spark, folder), wanted), "pinned files")


def verified_package(spark: SparkSession, folder: str, ledger_name: str, manifest: dict, expected: dict) -> DataFrame:
    """Files of a package after its ledger and manifest are found right; the ledger itself is not listed in it."""
    different = L.manifest_differences(manifest, expected)
    if different:
        raise SourceError("manifest differs in: " + ", ".join(different))
    found = inventory(spark, folder).where(F.col("path") != ledger_name)
    refuse(against_ledger(found, ledger(spark, f"{folder}/{ledger_name}")), "package and ledger")
    return found


def verified_gate(gate: dict, outcome: str, classification: str, checksums: dict[str, str], found: dict[str, str]) -> None:
    """A predecessor's gate passed with this classification, and what it recorded is what is there."""
    if (gate.get("outcome"), gate.get("classification")) != (outcome, classification):
        raise GateError(f"predecessor gate is {gate.get('outcome')} {gate.get('classification')}")
    wrong = sorted(k for k, v in checksums.items() if found.get(k, "").upper() != v.upper())
    if wrong:
        raise GateError("predecessor evidence differs: " + ", ".join(wrong))


def snapshot(spark: SparkSession, sources: list[str], workspace: str) -> DataFrame:
    """Copies files into a new workspace and returns their (path, size_bytes, sha256), found equal to the sources."""
    store = Store(spark)
    if store.exists(workspace):
        raise FileExistsError(workspace)
    util, conf = spark._jvm.org.apache.hadoop.fs.FileUtil, spark._jsc.hadoopConfiguration()
    for source in sources:
        fs, at = store._at(source)
        to_fs, to = store._at(f"{workspace}/{source.rstrip('/').split('/')[-1]}")
        to_fs.mkdirs(to.getParent())
        if not util.copy(fs, at, to_fs, to, False, conf):
            raise OSError(f"cannot copy {source}")
    name = F.element_at(F.split("path", "/"), -1)
    before = None
    for source in sources:
        one = files(spark, source).select(name.alias("path"), "size_bytes", "sha256")
        before = one if before is None else before.unionByName(one)
    after = files(spark, workspace).select(name.alias("path"), "size_bytes", "sha256")
    if not frame_equal(before, after):
        store.delete(workspace)
        raise SourceError("a file changed while it was copied")
    return after


def two_sources(spark: SparkSession, extracted: list[str], archive: str, pin: str) -> str:
    """'extracted' if all extracted files are there, 'archive' if none is and the archive has its pinned digest."""
    there = [Store(spark).exists(p) for p in extracted]
    if all(there):
        return "extracted"
    if any(there):
        raise SourceError("only some of the extracted files are there")
    row = files(spark, archive).select("sha256").first() if Store(spark).exists(archive) else None
    if row is None or row[0].upper() != pin.upper():
        raise SourceError("the archive is missing or not the pinned one")
    return "archive"


def asset_root(found: DataFrame, samples: list[str]) -> str:
    """The one folder of an inventory (path) below which all sample paths are."""
    wanted = found.sparkSession.createDataFrame([(s,) for s in sorted(set(samples))], "sample string")
    hits = found.join(F.broadcast(wanted), F.col("path").endswith(F.concat(F.lit("/"), F.col("sample"))))
    roots = hits.select(F.expr("substring(path, 1, length(path) - length(sample) - 1)").alias("root"), "sample").distinct()
    whole = roots.groupBy("root").count().where(F.col("count") == len(set(samples))).limit(2).collect()
    if len(whole) != 1:
        raise SourceError(f"expected one asset root, found {len(whole)}")
    return whole[0]["root"]


def zipped(members: dict[str, bytes]) -> bytes:
    """A ZIP of the members by name, names with forward slashes, the same bytes for the same content."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(members, key=lambda n: n.replace("\\", "/")):
            clean = name.replace("\\", "/")
            if unsafe_member(clean, 0):
                raise SourceError(f"unsafe member name {name}")
            z.writestr(zipfile.ZipInfo(clean, EPOCH), members[name], zipfile.ZIP_DEFLATED)
    return out.getvalue()


def write_bytes(spark: SparkSession, path: str, raw: bytes) -> None:
    fs, where = Store(spark)._at(path)
    out = fs.create(where, False)
    out.write(raw)
    out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def write_evidence(spark: SparkSession, path: str, members: dict[str, bytes]) -> str:
    """A ZIP and beside it its digest, both or neither; the ZIP is read back and its checksums tested first."""
    store = Store(spark)
    if store.exists(path) or store.exists(path + SIDECAR):
        raise FileExistsError(path)
    raw, staged = zipped(members), f"{path}.staging-{uuid.uuid4().hex}"
    digest = hashlib.sha256(raw).hexdigest().upper()
    try:
        write_bytes(spark, staged, raw)
        back = read_bytes(spark, staged)
        with zipfile.ZipFile(io.BytesIO(back)) as z:
            broken = z.testzip()
        if broken or back != raw:
            raise SourceError(f"archive changed on its way to the store: {broken}")
        store.rename(staged, path)
        try:
            store.write_text(path + SIDECAR, f"{digest}  {path.split('/')[-1]}\n")
        except Exception:
            store.delete(path)
            raise
    finally:
        if store.exists(staged):
            store.delete(staged)
    return digest


def replace_file(spark: SparkSession, path: str, raw: bytes, before: bytes | None = None) -> None:
    """A file's new bytes, read back before they take its place; with `before`, only if the old ones are these."""
    store, staged, old = Store(spark), f"{path}.staging-{uuid.uuid4().hex}", f"{path}.backup-{uuid.uuid4().hex}"
    there = store.exists(path)
    if before is not None and (not there or read_bytes(spark, path) != before):
        raise SourceError("the file is not the expected one")
    try:
        write_bytes(spark, staged, raw)
        if read_bytes(spark, staged) != raw:
            raise SourceError("the file changed on its way to the store")
        if there:
            store.rename(path, old)
        try:
            store.rename(staged, path)
        except Exception:
            if there:
                store.rename(old, path)
            raise
        if there:
            store.delete(old)
    finally:
        if store.exists(staged):
            store.delete(staged)


def checked_csv(rows: DataFrame, path: str, columns: list[str], bom: bool = False, order: list[str] | None = None) -> DataFrame:
    """CSV of texts that is read back and found equal, or deleted; returns what was read. Rows are written by the order
    columns (all columns, if none are given), and the order of the rows read back is checked too."""
    spark = rows.sparkSession
    texts = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    numbered = in_order(texts, order or columns)
    written_in_order(numbered, "position", lambda df: write_csv(df, path, columns, bom))
    back = text_table(spark, path, columns, exact=True)
    if not frame_equal(numbered, in_file_order(back), "position"):
        Store(spark).delete(path)
        raise SourceError("rows changed on their way through CSV")
    return back


def registry_template(spark: SparkSession, path: str, columns: list[str], folders: list[str] = ()) -> bool:
    """A registry of a header only, and the folders it goes with; whatever is there stays. Whether it was written."""
    store = Store(spark)
    for folder in folders:
        fs, where = store._at(folder)
        fs.mkdirs(where)
    if store.exists(path):
        return False
    store.write_text(path, ",".join(columns) + "\n")
    return True


def scaffold(spark: SparkSession, root: str, required: list[str], wanted: list[str] = ()) -> DataFrame:
    """(path, state): PASS where a path of a project is there, FAIL where a required one is not, WARN for others."""
    store = Store(spark)
    rows = [(p, "PASS" if store.exists(f"{root}/{p}") else "FAIL" if p in required else "WARN") for p in [*required, *wanted]]
    return spark.createDataFrame(rows, "path string, state string")


def export_completed(
    spark: SparkSession, source: DataFrame, stored: DataFrame, key: str, human: list[str], target: str, pins: dict[str, str] | None = None, pinned: str = "",
    history: DataFrame | None = None, check: Callable[[DataFrame], DataFrame] | None = None, order: list[str] | None = None,
) -> DataFrame:
    """Write the completed reviews of a source once, and return them as read back. Rows go by the order columns (the
    key, if none are given).

    Gates: pinned files unchanged, before and after; the path new, in the store and in the history; keys of both
    sides the same; every review final; no fault by `check`; all other columns, and the rows read back, equal."""
    store = Store(spark)
    if pins:
        verify_pins(spark, pinned, pins)
    if store.exists(target):
        raise FileExistsError(target)
    if history is not None:
        refuse(history_errors(history, spark.createDataFrame([(target,)], "output_path string")), "export history")
    refuse(L.export_errors(source, stored, key), "completed export")
    out = L.filled(source, stored, key, human)
    rest = [c for c in source.columns if c not in human]
    if not frame_equal(source.select(*rest), out.select(*rest)):
        raise SourceError("a source column changed")
    if check:
        refuse(check(out), "completed reviews")
    staged = f"{target}.staging-{uuid.uuid4().hex}"
    try:
        if not written_and_equal(out, staged, order or [key]):
            raise SourceError("reviews changed on their way to the store")
        if pins:
            verify_pins(spark, pinned, pins)
        store.rename(staged, target)
    except Exception as bad:
        store.write_text(f"{target}.failure.json", as_json({"error": type(bad).__name__, "message": str(bad)[:500]}))
        raise
    finally:
        if store.exists(staged):
            store.delete(staged)
    return spark.read.schema(out.schema).parquet(target)


def backup(spark: SparkSession, table: str, folder: str, name: str, keep: int) -> DataFrame:
    """A checked copy of a table, its rows in their order, as folder/name, of which the newest `keep` by name stay;
    returns the copy."""
    store = Store(spark)
    rows = spark.read.parquet(table)
    staged = f"{folder}/.staging-{uuid.uuid4().hex}"
    numbered = in_file_order(rows)
    written_in_order(numbered, "position", lambda df: df.write.parquet(staged))
    if not frame_equal(numbered, in_file_order(spark.read.schema(rows.schema).parquet(staged)), "position"):
        store.delete(staged)
        raise SourceError("the copy differs from the table")
    store.rename(staged, f"{folder}/{name}")
    fs, where = store._at(folder)
    names = sorted((s.getPath().getName() for s in fs.listStatus(where) if not s.getPath().getName().startswith(".")), reverse=True)
    for old in names[keep:]:
        store.delete(f"{folder}/{old}")
    return spark.read.parquet(f"{folder}/{name}")
