"""Writers with commit protocols: staged folders renamed into place, checked after writing, and manifests.

Paths go through the Hadoop file system of the session, so that any store that Spark writes will do."""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoforge.operators.digests import frame_equal, in_file_order, in_order, written_in_order
from annoforge.sources.readers import Registry, SourceError, files


class Store:
    """Rename, exists and delete on whatever file system a path is on."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def rename(self, source: str, target: str) -> None:
        fs, where = self._at(source)
        to = self._at(target)[1]
        fs.mkdirs(to.getParent())
        if not fs.rename(where, to):
            raise OSError(f"cannot rename {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        fs, where = self._at(path)
        out = fs.create(where, True)
        out.write(text.encode())
        out.close()

    def read_text(self, path: str) -> str:
        return self.spark.read.text(path, wholetext=True).first()[0]


def write_csv(rows: DataFrame, path: str, columns: list[str], bom: bool = False, single: bool = False) -> None:
    """CSV of the columns in order, with a header even without rows. single: one file, for small tables."""
    out = rows.select(*columns)
    if bom:
        out = out.withColumnRenamed(columns[0], "﻿" + columns[0])
    (out.coalesce(1) if single else out).write.mode("errorifexists").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def as_json(value: object) -> str:
    """JSON with sorted keys and an indent of two."""
    return json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False) + "\n"


def protect(path: str, roots: list[str]) -> None:
    """Refuse an output at or below a protected root."""
    clean = path.rstrip("/")
    for root in roots:
        if clean == root.rstrip("/") or clean.startswith(root.rstrip("/") + "/"):
            raise SourceError(f"output {path} is under protected {root}")


def promote(spark: SparkSession, staged: str, target: str, replace: bool = False, verify: Callable[[str], None] | None = None) -> None:
    """Rename a staged folder into place and look at it there; if either fails, what was there before comes back."""
    store, backup = Store(spark), None
    if store.exists(target):
        if not replace:
            raise FileExistsError(target)
        backup = f"{target}.backup-{uuid.uuid4().hex}"
        store.rename(target, backup)
    try:
        store.rename(staged, target)
        if verify:
            verify(target)
    except Exception:
        if store.exists(target):
            store.delete(target)
        if backup:
            store.rename(backup, target)
        raise
    if backup:
        store.delete(backup)


def written_and_equal(rows: DataFrame, path: str, order: list[str] | None) -> bool:
    """Write rows as Parquet, in order if one is given, and tell whether what is read back is the same."""
    if order is None:
        rows.write.parquet(path)
    else:
        written_in_order(in_order(rows, order), "position", lambda df: df.write.parquet(path))
    return stored_equal(rows, path, order)


def stored_equal(rows: DataFrame, path: str, order: list[str] | None) -> bool:
    """Whether stored rows are these, in order if one is given."""
    back = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return frame_equal(rows, back) if order is None else frame_equal(in_order(rows, order), in_file_order(back), "position")


def commit(spark: SparkSession, target: str, tables: dict[str, DataFrame], texts: dict[str, str] | None = None, check: Callable[[str], None] | None = None, replace: bool = False, order: dict[str, list[str]] | None = None, after: Callable[[str], None] | None = None) -> None:
    """Write tables and texts to a staging folder, read them back, then rename the folder: all of it or nothing.

    order: by table the columns that its rows are written in the order of; the order is checked as well. check looks at
    the staging folder. After the rename tables and texts are read again, and `after` looks at them: if something is
    wrong, what was there before comes back.

    On failure the error goes to a row beside the target and the staging folder is removed."""
    store = Store(spark)
    staged = f"{target}.staging-{uuid.uuid4().hex}"
    try:
        if store.exists(target) and not replace:
            raise FileExistsError(target)
        for name, rows in tables.items():
            if not written_and_equal(rows, f"{staged}/{name}", (order or {}).get(name)):
                raise SourceError(f"{name} changed on its way to the store")
        for name, text in (texts or {}).items():
            store.write_text(f"{staged}/{name}", text)
        if check:
            check(staged)

        def verify(where: str) -> None:
            for name, rows in tables.items():
                if not stored_equal(rows, f"{where}/{name}", (order or {}).get(name)):
                    raise SourceError(f"{name} changed after it was put in place")
            for name, text in (texts or {}).items():
                if store.read_text(f"{where}/{name}") != text:
                    raise SourceError(f"{name} changed after it was put in place")
            if after:
                after(where)

        promote(spark, staged, target, replace, verify)
    except Exception as bad:
        store.delete(staged)
        evidence = f"{target}.failure.json"
        if not store.exists(evidence):  # the first failure stays
            store.write_text(evidence, as_json({"error": type(bad).__name__, "message": str(bad)[:500]}))
        raise


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Relative path, size and digest of every file of an output."""
    found = files(spark, folder)
    return found.select(F.regexp_replace("path", f"^.*{folder.rstrip('/').split('/')[-1]}/", "").alias("path"), "size_bytes", "sha256")


def write_if_valid(spark: SparkSession, target: str, rows: DataFrame, errors: DataFrame, summary: DataFrame) -> bool:
    """Errors and summary always, rows only without errors."""
    valid = errors.isEmpty()
    commit(spark, target, {"errors": errors, "summary": summary} | ({"rows": rows} if valid else {}))
    return valid


def retained(versions: DataFrame, name: str, keep: int) -> DataFrame:
    """Versions to delete: all but the newest `keep` by name."""
    return versions.join(versions.orderBy(F.desc(name)).limit(keep).select(name), name, "left_anti")


def registry_bytes(doc: Registry, rows: list[tuple[str, ...]] | None = None) -> bytes:
    """A registry as bytes in its own style."""
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=doc.newline)
    writer.writerow(doc.columns)
    writer.writerows(doc.rows if rows is None else rows)
    text = out.getvalue()
    if not doc.ends_with_newline:
        text = text.removesuffix(doc.newline)
    return (b"\xef\xbb\xbf" if doc.bom else b"") + text.encode()


def split_layout(rows: DataFrame, target: str, split: str = "split") -> None:
    """Manifest rows in a folder per split."""
    rows.write.mode("errorifexists").partitionBy(split).parquet(target)


def dataset_descriptor(root: str, names: list[str]) -> str:
    """YAML that describes a detector dataset."""
    import yaml

    return yaml.safe_dump({"path": root, "train": "images/train", "val": "images/val", "test": "images/test", "names": dict(enumerate(names))}, sort_keys=False)


def markdown(title: str, tables: dict[str, DataFrame], limit: int = 50) -> str:
    """A report of small tables; a table beyond the limit says so."""
    out = [f"# {title}", ""]
    for name, rows in tables.items():
        first = rows.limit(limit + 1).collect()
        out += [f"## {name}", "", "| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
        out += ["| " + " | ".join(str(v) for v in r) + " |" for r in first[:limit]]
        out += [f"More than {limit} rows.", ""] if len(first) > limit else [""]
    return "\n".join(out)
