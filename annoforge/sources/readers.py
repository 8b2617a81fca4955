"""Readers: text tables, COCO and YOLO annotations, files, archives, ledgers, configurations.

All but small, single registry files and configurations are read by executors."""

from __future__ import annotations

import csv
import hashlib
import io
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annoforge.functions.text import base_name

COCO = T.StructType(
    [
        T.StructField("images", T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("file_name", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))),
        T.StructField("categories", T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("supercategory", T.StringType())]))),
        T.StructField(
            "annotations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.LongType()), T.StructField("image_id", T.LongType()), T.StructField("category_id", T.LongType()), T.StructField("bbox", T.ArrayType(T.DoubleType())),
                        T.StructField("area", T.DoubleType()), T.StructField("segmentation", T.StringType()), T.StructField("iscrowd", T.IntegerType()),
                    ]
                )
            ),
        ),
    ]
)


class SourceError(ValueError):
    """An input that breaks its contract."""


def text_table(spark: SparkSession, path: str, required: list[str] = (), exact: bool = False) -> DataFrame:
    """CSV with a header as texts; a missing value is empty, a byte-order mark before the header goes."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    out = raw.toDF(*[c.removeprefix("﻿") for c in raw.columns])
    check_columns(out.columns, list(required), exact)
    return out.na.fill("")


def check_columns(columns: list[str], required: list[str], exact: bool = False) -> None:
    missing = [c for c in required if c not in columns]
    if missing:
        raise SourceError("missing required column(s): " + ", ".join(missing))
    if exact and columns != required:
        raise SourceError(f"columns must be exactly {required}")


def typed_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with explicit types; a row that does not fit fails the read."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def coco(spark: SparkSession, path: str) -> DataFrame:
    """COCO documents among JSON files; what lacks one of the three collections is left out."""
    docs = spark.read.schema(COCO).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return docs.where("images is not null and annotations is not null and categories is not null").withColumn("document", F.input_file_name())


def coco_relations(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """images, categories and annotations of COCO documents as tables."""
    return tuple(docs.select("document", F.inline(c)) for c in ("images", "categories", "annotations"))


def strict_coco(spark: SparkSession, paths: dict[str, str], pins: dict[str, str] | None = None) -> DataFrame:
    """COCO documents of given splits, one file each: digests as pinned, all three collections, ids once, known references."""
    out = None
    for split, path in paths.items():
        own = files(spark, path).select("sha256").limit(2).collect()
        if len(own) != 1:
            raise SourceError(f"{split}: expected one file at {path}")
        if pins and own[0][0].upper() != pins[split].upper():
            raise SourceError(f"{split}: the file is not the pinned one")
        doc = coco(spark, path).withColumn("split", F.lit(split))
        if doc.count() != 1:
            raise SourceError(f"{split}: a collection is missing")
        out = doc if out is None else out.unionByName(doc)
    images, categories, annotations = (out.select("split", F.inline(c)) for c in ("images", "categories", "annotations"))
    for name, rows in (("images", images), ("categories", categories), ("annotations", annotations)):
        if not rows.where("id is null").isEmpty() or not rows.groupBy("split", "id").count().where("count > 1").isEmpty():
            raise SourceError(f"{name}: ids must be there and occur once")
    box = F.col("bbox")
    if not annotations.where(F.coalesce(F.size(box) != 4, F.lit(True)) | F.exists(box, lambda v: v.isNull())).isEmpty():
        raise SourceError("annotations: a box must be four numbers")
    for name, rows, key in (("image_id", images, "image_id"), ("category_id", categories, "category_id")):
        if not annotations.join(rows.select("split", F.col("id").alias(key)), ["split", key], "left_anti").isEmpty():
            raise SourceError(f"annotations: unknown {name}")
    return out


def yolo(spark: SparkSession, path: str) -> DataFrame:
    """Label lines: document, line_number (blank lines do not count), class_id, box and what is wrong."""
    lines = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).text(path, wholetext=True)
    kept = F.filter(F.transform(F.split("value", r"\r\n|\n|\r"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    rows = lines.select(base_name(F.input_file_name()).alias("document"), F.posexplode(kept).alias("i", "line"))
    parts = F.split("line", " ")
    number = r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"
    value = [F.get(parts, F.lit(k)) for k in range(5)]
    numeric = F.forall(F.slice(parts, 2, 4), lambda x: x.rlike(number))
    five, whole = F.size(parts) == 5, value[0].rlike(r"^[-+]?[0-9]+$")
    at = F.concat("document", F.lit(":"), (F.col("i") + 1).cast("string"))
    rows = rows.select("document", (F.col("i") + 1).alias("line_number"), at.alias("at"), F.size(parts).alias("n"), five.alias("five"), whole.alias("whole"), numeric.alias("numeric"), value[0].alias("raw_class"), *[v.try_cast("double").alias(n) for v, n in zip(value[1:], ("x", "y", "w", "h"), strict=True)])
    good = F.col("five") & F.col("whole")
    box = good & F.col("numeric")
    class_id = F.col("raw_class").try_cast("int")
    checks = [
        (~F.col("five"), F.concat("at", F.lit(" expected 5 columns, got "), F.col("n").cast("string"))),
        (F.col("five") & ~F.col("whole"), F.concat("at", F.lit(" class id is not an integer: "), "raw_class")),
        (good & ~class_id.eqNullSafe(0), F.concat("at", F.lit(" unsupported class id "), "raw_class", F.lit("; expected 0 for damage"))),
        (good & ~F.col("numeric"), F.concat("at", F.lit(" bbox values must be numeric"))),
        (box & ~F.col("x").between(0, 1), F.concat("at", F.lit(" x_center must be in [0, 1]"))),
        (box & ~F.col("y").between(0, 1), F.concat("at", F.lit(" y_center must be in [0, 1]"))),
        (box & ~((F.col("w") > 0) & (F.col("w") <= 1)), F.concat("at", F.lit(" width must be in (0, 1]"))),
        (box & ~((F.col("h") > 0) & (F.col("h") <= 1)), F.concat("at", F.lit(" height must be in (0, 1]"))),
    ]
    errors = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), what) for bad, what in checks]))
    return rows.select("document", "line_number", class_id.alias("class_id"), F.when(F.col("numeric"), F.struct("x", "y", "w", "h")).alias("box"), errors.alias("errors"))


def files(spark: SparkSession, path: str, suffixes: list[str] | None = None, content: bool = False) -> DataFrame:
    """(path, size_bytes, sha256, modified) of all files below a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    if suffixes:
        found = found.where(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(*[s.lower() if s.startswith(".") else f".{s.lower()}" for s in suffixes]))
    digest = F.upper(F.sha2("content", 256))
    return found.select("path", F.col("length").alias("size_bytes"), digest.alias("sha256"), F.col("modificationTime").alias("modified"), *(["content"] if content else []))


#: First bytes of image formats.
MAGIC = {"png": "89504E47", "jpeg": "FFD8FF", "gif": "474946", "bmp": "424D"}


def images(spark: SparkSession, path: str, suffixes: list[str]) -> DataFrame:
    """Images with size, aspect and readability; an unreadable file is a row with a note why, never a failure."""
    head = F.hex(F.substring("content", 1, 4))
    kind = F.lit(None)
    for name, mark in MAGIC.items():
        kind = F.when(head.startswith(mark), name).otherwise(kind)
    why = F.when(F.col("size_bytes") == 0, "empty file").when(kind.isNotNull(), F.concat(F.lit("damaged "), kind)).otherwise("unknown format")
    found = files(spark, path, suffixes, content=True).select("path", "size_bytes", why.alias("_why"))
    seen = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(path).select("image.origin", "image.width", "image.height")
    # the two readers spell a local path with one and with three slashes
    spelled = lambda c: F.regexp_replace(c, "^([a-z]+):/+", "$1:/")
    rows = found.join(seen.withColumn("_at", spelled("origin")), spelled("path") == F.col("_at"), "left")
    ok = F.coalesce(F.col("width") > 0, F.lit(False))
    return rows.select("path", "size_bytes", F.when(ok, F.col("width")).alias("width"), F.when(ok, F.col("height")).alias("height"), F.when(ok, F.bround(F.col("width") / F.col("height"), 6)).alias("aspect_ratio"), ok.alias("is_readable"), F.when(ok, "").otherwise(F.concat(F.lit("unreadable: "), "_why")).alias("notes"))


#: Other names of the source buckets.
BUCKET_NAMES = {"general_fleet": "01_general_fleet", "claimable_damage": "02_claimable_damage", "minor_damage": "03_minor_damage"}


def bucket_name(name: str, folder: str) -> str:
    """A bucket's own name: an alias, a numbered name, or that of its folder."""
    if name in BUCKET_NAMES:
        return BUCKET_NAMES[name]
    if name[:3] in ("01_", "02_", "03_"):
        return name
    parts = [p for p in folder.replace("\\", "/").split("/") if p]
    parent = parts[-2] if len(parts) > 1 and parts[-1] == "images" else parts[-1] if parts else ""
    return BUCKET_NAMES.get(parent, parent)


def archive_member(members: DataFrame, suffix: str, sha256: str | None = None) -> DataFrame:
    """The one member that ends with the suffix, with a pin of its content's digest if given.

    Checksums inside the archive are tested where its content is read: a wrong one fails the read."""
    found = members.where(F.col("safe") & F.col("member").endswith(suffix))
    if found.limit(2).count() != 1:
        raise SourceError(f"expected exactly one member ending in {suffix}")
    if sha256 is not None and found.where(F.upper(F.sha2("content", 256)) == sha256.upper()).isEmpty():
        raise SourceError(f"the member ending in {suffix} is not the pinned one")
    return found


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, path) of a checksum ledger; a repeated path fails."""
    rows = spark.read.text(path).where(F.trim("value") != "")
    parts = F.split(F.trim("value"), r"\s+", 2)
    out = rows.select(F.upper(F.get(parts, F.lit(0))).alias("sha256"), F.regexp_replace(F.get(parts, F.lit(1)), r"^\*", "").alias("path"))
    twice = out.groupBy("path").count().where("count > 1").limit(1).collect()
    if twice:
        raise SourceError(f"path repeats in the ledger: {twice[0]['path']}")
    return out


def against_ledger(found: DataFrame, listed: DataFrame) -> DataFrame:
    """What a ledger and files do not agree on: missing, unlisted or changed."""
    both = listed.select("path", F.col("sha256").alias("listed")).join(found.select("path", F.col("sha256").alias("found")), "path", "full")
    state = F.when(F.col("found").isNull(), "missing").when(F.col("listed").isNull(), "unlisted").when(F.upper("found") != F.upper("listed"), "changed")
    return both.select("path", state.alias("state")).where("state is not null")


def resolve(references: DataFrame, inventory: DataFrame, reference: str = "file_name", folder: str = "folder", marker: str | None = None) -> DataFrame:
    """Path of each reference: as it stands, from a marker folder on, beside its document, below the root, or by a base name that occurs once."""
    name = base_name(F.col("path"))
    paths = inventory.select("path")
    direct = paths.select(F.col("path").alias("_direct"), F.col("path").alias("_a"))
    rooted = paths.select(F.col("path").alias("_root"), F.col("path").alias("_b"))
    once = paths.groupBy(name.alias("_name")).agg(F.count("*").alias("n"), F.first("path").alias("_c")).where("n = 1").drop("n")
    rows = references.withColumn("_direct", F.concat_ws("/", F.when(F.col(folder) != "", F.col(folder)), reference)).withColumn("_root", F.col(reference)).withColumn("_name", base_name(F.col(reference)))
    rows = rows.join(direct, "_direct", "left").join(rooted, "_root", "left").join(once, "_name", "left")
    clean = F.translate(F.col(reference), "\\", "/")
    rows = rows.withColumn("_root", clean).join(paths.select(F.col("path").alias("_root"), F.col("path").alias("_d")), "_root", "left")
    after = F.concat(F.lit(f"{marker}/"), F.element_at(F.split(clean, f"(^|/){re.escape(marker)}/"), -1)) if marker else F.lit(None).cast("string")
    rows = rows.withColumn("_root", after).join(paths.select(F.col("path").alias("_root"), F.col("path").alias("_e")), "_root", "left")
    return rows.withColumn("resolved_path", F.coalesce("_d", "_e", "_a", "_b", "_c")).drop("_direct", "_root", "_name", "_a", "_b", "_c", "_d", "_e")


@dataclass(frozen=True)
class Registry:
    """A small CSV whose bytes count: rows as read, and all it takes to write them back unchanged."""

    columns: tuple[str, ...]
    rows: tuple[tuple[str, ...], ...]
    sha256: str
    bom: bool = False
    newline: str = "\n"
    ends_with_newline: bool = True
    by_name: dict[str, int] = field(default_factory=dict, compare=False)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, *r) for i, r in enumerate(self.rows, 2)], "row_number bigint, " + ", ".join(f"`{c}` string" for c in self.columns))


def registry(raw: bytes) -> Registry:
    """Parse registry bytes; ragged rows, repeated headers and mixed line ends are refused."""
    bom = raw.startswith(b"\xef\xbb\xbf")
    try:
        body = raw.decode("utf-8-sig")
    except UnicodeDecodeError as bad:
        raise SourceError("registry must be UTF-8") from bad
    bare = body.replace("\r\n", "")
    if "\r" in bare or ("\r\n" in body and "\n" in bare):
        raise SourceError("registry has bare or mixed line ends")
    parsed = list(csv.reader(io.StringIO(body, newline=""), strict=True))
    if not parsed or not parsed[0]:
        raise SourceError("registry is empty")
    header = tuple(parsed[0])
    if len(set(header)) != len(header):
        raise SourceError("registry has repeated header names")
    for number, row in enumerate(parsed[1:], 2):
        if len(row) != len(header):
            raise SourceError(f"registry row {number} has {len(row)} values; expected {len(header)}")
    return Registry(header, tuple(map(tuple, parsed[1:])), hashlib.sha256(raw).hexdigest().upper(), bom, "\r\n" if "\r\n" in body else "\n", body.endswith("\n"))


def settings(text: str, allowed: dict[str, tuple[type, ...]], required: tuple[str, ...] = (), ranges: dict[str, tuple[float, float]] | None = None) -> dict:
    """A YAML mapping of known keys and types, numbers within their ranges, ends included; a boolean is no number."""
    import yaml

    found = yaml.safe_load(text)
    if not isinstance(found, dict):
        raise SourceError("settings must be a mapping")
    unknown = sorted(set(found) - set(allowed))
    lacking = sorted(set(required) - set(found))
    if unknown or lacking:
        raise SourceError(f"unknown settings {unknown}, missing settings {lacking}")
    for key, value in found.items():
        kinds = allowed[key]
        if not isinstance(value, kinds) or (isinstance(value, bool) and bool not in kinds):
            raise SourceError(f"setting {key} has the wrong type")
    for key, (lo, hi) in (ranges or {}).items():
        if key in found and not lo <= found[key] <= hi:
            raise SourceError(f"setting {key} must be from {lo} to {hi}")
    return found
