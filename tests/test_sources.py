import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from annoforge.functions import boxes as B
from annoforge.sources import readers as R
from annoforge.sources import zips as Z
from annoforge.sources import sinks as K


def test_text_table_keeps_blanks_and_drops_the_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id,name\n1,\n2,\"x, \"\"y\"\"\"\n".encode())
    t = R.text_table(spark, str(tmp_path / "a.csv"), ["id", "name"], exact=True)
    assert [tuple(r) for r in t.orderBy("id").collect()] == [("1", ""), ("2", 'x, "y"')]
    with pytest.raises(R.SourceError, match="missing required"):
        R.text_table(spark, str(tmp_path / "a.csv"), ["other"])


def test_typed_table_fails_on_a_bad_row(spark, tmp_path):
    (tmp_path / "p.csv").write_text("image_id,confidence\na,0.5\nb,oops\n")
    with pytest.raises(Exception, match="(?i)malformed|bad record"):
        R.typed_table(spark, str(tmp_path / "p.csv"), "image_id string, confidence double").collect()


def test_coco_documents_become_relations(spark, tmp_path):
    doc = {"images": [{"id": 1, "file_name": "a.jpg", "width": 100, "height": 100}], "categories": [{"id": 0, "name": "x"}], "annotations": [{"id": 5, "image_id": 1, "category_id": 0, "bbox": [90, 10, 20, 15], "segmentation": [[1, 2, 3, 4, 5, 6]]}, {"id": 6, "image_id": 9, "category_id": 0, "bbox": [1, 1, 2], "segmentation": {"counts": "x", "size": [1, 1]}}]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    (tmp_path / "b.json").write_text('{"images": []}')
    images, _, annotations = R.coco_relations(R.coco(spark, str(tmp_path)))
    rows = annotations.join(images.select(F.col("id").alias("image_id"), "width", "height"), "image_id", "left")
    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    got = rows.select("id", B.first_status(F.col("bbox"), w, h, w.isNotNull()), B.segmentation_status(F.col("segmentation"))).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(5, "bbox_out_of_bounds", "valid_polygon"), (6, "missing_image_reference", "valid_rle")]


def test_yolo_lines_report_what_is_wrong(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0 0.5 0.5 0.2 0.2\n\n1 0.5 0.5 0 0.2\n0 a b c d\n0 1 2\nx 1 1 1 1\n")
    got = R.yolo(spark, str(tmp_path)).orderBy("line_number").collect()
    assert [r["errors"] for r in got] == [
        [],
        ["a.txt:2 unsupported class id 1; expected 0 for damage", "a.txt:2 width must be in (0, 1]"],
        ["a.txt:3 bbox values must be numeric"],
        ["a.txt:4 expected 5 columns, got 3"],
        ["a.txt:5 class id is not an integer: x"],
    ]


def test_archives_mark_unsafe_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("ok/a.txt", "x")
        z.writestr("../up.txt", "x")
        z.writestr("/abs.txt", "x")
    got = Z.archives(spark, str(tmp_path), content=True)
    assert {r["member"]: r["safe"] for r in got.collect()} == {"ok/a.txt": True, "../up.txt": False, "/abs.txt": False}
    assert bytes(R.archive_member(got, "a.txt").first()["content"]) == b"x"
    with pytest.raises(R.SourceError):
        R.archive_member(got, "none")


def test_large_archives_are_read_in_runs_of_members(spark, tmp_path):
    rng = random.Random(1)
    want = {}
    for name, kind in (("a.zip", zipfile.ZIP_DEFLATED), ("sub/b.ZIP", zipfile.ZIP_STORED)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        with zipfile.ZipFile(tmp_path / name, "w", kind) as z:
            z.comment = b"a comment after the directory"
            z.mkdir("folder")
            for i in range(40):
                raw = rng.randbytes(rng.choice([0, 10, 5000])) * rng.choice([1, 3])
                with z.open(f"folder/\u00e9{i}.bin", "w", force_zip64=i % 2 == 0) as f:
                    f.write(raw)
                want[name, f"folder/\u00e9{i}.bin"] = raw
    got = Z.archives(spark, str(tmp_path), content=True, run_bytes=20_000)
    assert got.rdd.getNumPartitions() > 8
    assert {(r["archive"].removeprefix(f"{tmp_path}/"), r["member"]): bytes(r["content"]) for r in got.collect()} == want
    assert Z.archives(spark, str(tmp_path / "a.zip")).where("content is null").count() == 40
    (tmp_path / "none").mkdir()
    assert Z.archives(spark, str(tmp_path / "none")).count() == 0


def test_damaged_members_fail_the_read(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.txt", "hello there")
    raw = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "a.zip").write_bytes(raw.replace(b"hello", b"jello"))
    assert Z.archives(spark, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="bad checksum"):
        Z.archives(spark, str(tmp_path), content=True).collect()
    (tmp_path / "b.zip").write_bytes(b"not an archive")
    with pytest.raises(Exception, match="not a zip file"):
        Z.archives(spark, str(tmp_path)).collect()


def test_ledger_and_files_are_compared(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    (data / "a").write_text("1")
    (data / "b").write_text("2")
    found = K.manifest(spark, str(data))
    rows = {r["path"]: r["sha256"] for r in found.collect()}
    (tmp_path / "ledger.txt").write_text(f"{rows['a'].lower()}  a\n{'0' * 64}  b\n{'1' * 64}  c\n")
    bad = R.against_ledger(found, R.ledger(spark, str(tmp_path / "ledger.txt")))
    assert {tuple(r) for r in bad.collect()} == {("b", "changed"), ("c", "missing")}


def test_resolution_goes_by_tiers(spark):
    inventory = spark.createDataFrame([("d/a.jpg",), ("b.jpg",), ("x/c.jpg",), ("y/e.jpg",), ("z/e.jpg",)], "path string")
    refs = spark.createDataFrame([("a.jpg", "d"), ("b.jpg", "d"), ("q/c.jpg", "d"), ("e.jpg", "d")], "file_name string, folder string")
    got = {r["file_name"]: r["resolved_path"] for r in R.resolve(refs, inventory).collect()}
    assert got == {"a.jpg": "d/a.jpg", "b.jpg": "b.jpg", "q/c.jpg": "x/c.jpg", "e.jpg": None}


def test_registry_round_trip_is_byte_exact(spark):
    for raw in (b"a,b\n1,2\n", b"\xef\xbb\xbfa,b\r\n1,\"x,y\"\r\n", b"a,b\n1,2"):
        doc = R.registry(raw)
        assert K.registry_bytes(doc) == raw
    assert R.registry(b"a,b\n1,2\n").frame(spark).first()["row_number"] == 2
    for raw in (b"a,a\n1,2\n", b"a,b\n1\n", b"a,b\r\n1,2\n", b""):
        with pytest.raises(R.SourceError):
            R.registry(raw)


def test_settings_are_closed():
    allowed = {"n": (int,), "name": (str,)}
    assert R.settings("n: 3", allowed, ("n",)) == {"n": 3}
    for text in ("n: true", "other: 1", "name: x", "[]"):
        with pytest.raises(R.SourceError):
            R.settings(text, allowed, ("n",))


def test_bucket_names():
    assert R.bucket_name("minor_damage", "x") == "03_minor_damage"
    assert R.bucket_name("02_other", "x") == "02_other"
    assert R.bucket_name("zzz", "/data/general_fleet/images") == "01_general_fleet"


def test_commit_is_all_or_nothing(spark, tmp_path):
    rows = spark.range(3).toDF("id")
    target = str(tmp_path / "out")
    K.commit(spark, target, {"rows": rows}, {"a.json": K.as_json({"b": 1, "a": 2})})
    assert spark.read.parquet(f"{target}/rows").count() == 3
    assert json.loads((tmp_path / "out" / "a.json").read_text()) == {"a": 2, "b": 1}
    with pytest.raises(FileExistsError):
        K.commit(spark, target, {"rows": rows})
    K.commit(spark, target, {"rows": rows.limit(1)}, replace=True)
    assert spark.read.parquet(f"{target}/rows").count() == 1

    def fails(_):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        K.commit(spark, str(tmp_path / "other"), {"rows": rows}, check=fails)
    assert not (tmp_path / "other").exists() and "RuntimeError" in (tmp_path / "other.failure.json").read_text()
    assert not [p for p in tmp_path.iterdir() if "staging" in p.name]


def test_a_commit_found_wrong_in_place_is_undone(spark, tmp_path):
    target = str(tmp_path / "out")
    K.commit(spark, target, {"rows": spark.range(3)}, {"a.txt": "one"})

    def spoils(where):
        (tmp_path / "out" / "a.txt").write_text("spoilt")
        raise RuntimeError("wrong in place")

    with pytest.raises(RuntimeError, match="in place"):
        K.commit(spark, target, {"rows": spark.range(5)}, {"a.txt": "two"}, replace=True, after=spoils)
    assert spark.read.parquet(f"{target}/rows").count() == 3 and (tmp_path / "out" / "a.txt").read_text() == "one"
    with pytest.raises(RuntimeError, match="in place"):
        K.commit(spark, str(tmp_path / "new"), {"rows": spark.range(5)}, after=lambda _: (_ for _ in ()).throw(RuntimeError("wrong in place")))
    assert not (tmp_path / "new").exists() and not [p for p in tmp_path.iterdir() if "backup" in p.name or "staging" in p.name]
    K.commit(spark, target, {"rows": spark.range(5)}, replace=True, order={"rows": ["id"]})
    assert spark.read.parquet(f"{target}/rows").count() == 5


def test_split_layout_has_a_folder_per_split(spark, tmp_path):
    rows = spark.createDataFrame([("a.png", "train"), ("b.png", "val"), ("c.png", "train")], "path string, split string")
    K.split_layout(rows, str(tmp_path / "layout"))
    assert {p.name for p in (tmp_path / "layout").iterdir() if p.is_dir()} == {"split=train", "split=val"}
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "layout")).select("path", "split").collect())) == [("a.png", "train"), ("b.png", "val"), ("c.png", "train")]
    with pytest.raises(Exception, match="already exists"):
        K.split_layout(rows, str(tmp_path / "layout"))


def test_write_only_if_valid(spark, tmp_path):
    rows, errors = spark.range(2).toDF("id"), spark.createDataFrame([(2, "x")], "row_number bigint, code string")
    assert not K.write_if_valid(spark, str(tmp_path / "a"), rows, errors, rows)
    assert K.write_if_valid(spark, str(tmp_path / "b"), rows, errors.limit(0), rows)
    assert not (tmp_path / "a" / "rows").exists() and (tmp_path / "b" / "rows").exists()


def test_protected_roots_and_csv(spark, tmp_path):
    with pytest.raises(R.SourceError):
        K.protect("/data/raw/x", ["/data/raw"])
    K.protect("/data/rawer", ["/data/raw"])
    K.write_csv(spark.createDataFrame([("1", "")], "a string, b string"), str(tmp_path / "c"), ["b", "a"], bom=True, single=True)
    text = next(p for p in (tmp_path / "c").iterdir() if p.suffix == ".csv").read_text(encoding="utf-8")
    assert text.startswith("﻿b,a")


def test_report_and_retention(spark):
    rows = spark.createDataFrame([("v1",), ("v2",), ("v3",)], "name string")
    assert [r[0] for r in K.retained(rows, "name", 2).collect()] == ["v1"]
    assert "More than 2 rows." in K.markdown("t", {"x": rows}, limit=2)
    assert "train: images/train" in K.dataset_descriptor("/d", ["damage"])


def test_broken_images_are_rows_with_a_note(spark, tmp_path):
    import struct
    import zlib

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    pixel = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")
    (tmp_path / "a.png").write_bytes(pixel)
    (tmp_path / "b.png").write_bytes(b"no image")
    got = {r["path"].split("/")[-1]: r for r in R.images(spark, str(tmp_path), [".png"]).collect()}
    assert (got["a.png"]["width"], got["a.png"]["height"], got["a.png"]["aspect_ratio"], got["a.png"]["notes"]) == (1, 1, 1.0, "")
    assert not got["b.png"]["is_readable"] and got["b.png"]["width"] is None and got["b.png"]["notes"] == "unreadable: unknown format"
