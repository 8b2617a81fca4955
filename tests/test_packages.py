import hashlib
import io
import math
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoforge.functions import boxes as B
from annoforge.functions import hashes as H
from annoforge.functions import text as T
from annoforge.operators import checks as C
from annoforge.operators import matching as M
from annoforge.operators import release as L
from annoforge.operators import similarity as S
from annoforge.operators import store as P
from annoforge.sources import packages as K
from annoforge.sources import readers as R


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_pins_and_ledgers(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes(b"one")
    (tmp_path / "sub" / "b.txt").write_bytes(b"two")
    pins = {"a.txt": sha(b"one"), "sub/b.txt": sha(b"two").upper()}
    K.verify_pins(spark, str(tmp_path), pins)
    with pytest.raises(C.GateError, match="a.txt changed"):
        K.verify_pins(spark, str(tmp_path), pins | {"a.txt": sha(b"other")})
    with pytest.raises(C.GateError, match="c.txt missing"):
        K.verify_pins(spark, str(tmp_path), pins | {"c.txt": sha(b"")})
    (tmp_path / "sums").write_text("".join(f"{d}  {p}\n" for p, d in pins.items()))
    assert K.verified_package(spark, str(tmp_path), "sums", {"n": 1, "t": 0.5 + 1e-14}, {"n": 1, "t": 0.5}).count() == 2
    with pytest.raises(R.SourceError, match="manifest differs in: n"):
        K.verified_package(spark, str(tmp_path), "sums", {"n": 2}, {"n": 1})
    (tmp_path / "late.txt").write_bytes(b"x")
    with pytest.raises(C.GateError, match="unlisted"):
        K.verified_package(spark, str(tmp_path), "sums", {}, {})


def test_predecessor_gate():
    K.verified_gate({"outcome": "PASS", "classification": "c"}, "PASS", "c", {"a": "AB"}, {"a": "ab"})
    for gate, found in (({"outcome": "FAIL", "classification": "c"}, {"a": "AB"}), ({"outcome": "PASS", "classification": "c"}, {"a": "x"})):
        with pytest.raises(C.GateError):
            K.verified_gate(gate, "PASS", "c", {"a": "AB"}, found)


def test_snapshot_and_two_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x")
    (tmp_path / "b.csv").write_bytes(b"yy")
    got = K.snapshot(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], str(tmp_path / "work"))
    assert {(r["path"], r["size_bytes"]) for r in got.collect()} == {("a.csv", 1), ("b.csv", 2)}
    with pytest.raises(FileExistsError):
        K.snapshot(spark, [str(tmp_path / "a.csv")], str(tmp_path / "work"))
    both = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    assert K.two_sources(spark, both, "", "") == "extracted"
    with pytest.raises(R.SourceError, match="only some"):
        K.two_sources(spark, [both[0], str(tmp_path / "no")], "", "")
    assert K.two_sources(spark, [str(tmp_path / "no")], both[0], sha(b"x")) == "archive"
    with pytest.raises(R.SourceError, match="pinned"):
        K.two_sources(spark, [str(tmp_path / "no")], both[0], sha(b"y"))


def test_asset_root(spark):
    found = spark.createDataFrame([("/r/a/i/1.jpg",), ("/r/a/i/2.jpg",), ("/r/b/i/1.jpg",)], "path string")
    assert K.asset_root(found, ["i/1.jpg", "i/2.jpg"]) == "/r/a"
    for samples in (["i/1.jpg"], ["i/3.jpg"]):
        with pytest.raises(R.SourceError):
            K.asset_root(found, samples)


def test_archives_are_the_same_bytes_and_go_with_their_digest(spark, tmp_path):
    assert K.zipped({"b\\x": b"2", "a": b"1"}) == K.zipped({"a": b"1", "b/x": b"2"})
    with pytest.raises(R.SourceError):
        K.zipped({"../x": b""})
    path = str(tmp_path / "e.zip")
    digest = K.write_evidence(spark, path, {"a": b"1"})
    raw = (tmp_path / "e.zip").read_bytes()
    assert digest == sha(raw).upper() and (tmp_path / "e.zip.sha256").read_text() == f"{digest}  e.zip\n"
    assert zipfile.ZipFile(io.BytesIO(raw)).namelist() == ["a"]
    with pytest.raises(FileExistsError):
        K.write_evidence(spark, path, {"a": b"1"})
    assert not [p for p in tmp_path.iterdir() if "staging" in p.name]


def test_template_and_scaffold(spark, tmp_path):
    path = str(tmp_path / "reg" / "r.csv")
    assert K.registry_template(spark, path, ["a", "b"], [str(tmp_path / "raw")]) and not K.registry_template(spark, path, ["c"])
    assert (tmp_path / "reg" / "r.csv").read_text() == "a,b\n" and (tmp_path / "raw").is_dir()
    got = {r["path"]: r["state"] for r in K.scaffold(spark, str(tmp_path), ["raw", "src"], ["docs"]).collect()}
    assert got == {"raw": "PASS", "src": "FAIL", "docs": "WARN"}


def reviews(spark, status="reviewed"):
    source = spark.createDataFrame([("c1", "i1", ""), ("c2", "i2", "")], "case string, image string, review_status string")
    return source, spark.createDataFrame([("c1", "reviewed"), ("c2", status)], "case string, review_status string")


def test_completed_export(spark, tmp_path):
    source, stored = reviews(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "w").write_bytes(b"w")
    target, pins = str(tmp_path / "out"), {"w": sha(b"w")}
    with pytest.raises(C.GateError, match="not_reviewed"):
        K.export_completed(spark, *reviews(spark, "pending"), "case", ["review_status"], target)
    with pytest.raises(C.GateError, match="review_missing"):
        K.export_completed(spark, source, stored.limit(1), "case", ["review_status"], target)
    with pytest.raises(C.GateError, match="changed"):
        K.export_completed(spark, source, stored, "case", ["review_status"], target, {"w": sha(b"x")}, str(tmp_path / "in"))
    with pytest.raises(C.GateError, match="export history"):
        K.export_completed(spark, source, stored, "case", ["review_status"], target, history=spark.createDataFrame([(target,)], "output_path string"))
    with pytest.raises(C.GateError, match="completed reviews"):
        K.export_completed(spark, source, stored, "case", ["review_status"], target, check=lambda rows: rows.limit(1))
    out = K.export_completed(spark, source, stored, "case", ["review_status"], target, pins, str(tmp_path / "in"))
    assert {tuple(r) for r in out.collect()} == {("c1", "i1", "reviewed"), ("c2", "i2", "reviewed")}
    with pytest.raises(FileExistsError):
        K.export_completed(spark, source, stored, "case", ["review_status"], target)


def test_backups_keep_the_newest(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    for name in ("v1", "v2", "v3"):
        assert K.backup(spark, str(tmp_path / "t"), str(tmp_path / "backups"), name, 2).count() == 3
    assert sorted(p.name for p in (tmp_path / "backups").iterdir() if not p.name.startswith(".")) == ["v2", "v3"]


def test_store_refuses_unknown_cases_and_counts_saves(spark):
    cases = spark.createDataFrame([("a", "pending", 0), ("b", "pending", 4)], "case string, review_status string, revision long")
    at = "2024-01-01T00:00:00Z"
    saves = spark.createDataFrame([(1, "a", "reviewed", "x", at), (2, "z", "reviewed", "x", at), (3, "a", "needs_adjudication", "x", at), (4, "b", "reviewed", "y", at), (5, "b", "reviewed", "x", at)], "seq long, case string, review_status string, reviewer string, reviewed_at_utc string")
    state, audit, refused = P.save(cases, saves, "case", ["review_status"], "x")
    assert {(r["case"], r["review_status"], r["revision"]) for r in state.collect()} == {("a", "needs_adjudication", 2), ("b", "reviewed", 5)}
    assert [(r["seq"], r["revision"], r["successful_save_count"]) for r in audit.orderBy("seq").collect()] == [(1, 1, 1), (3, 2, 2), (5, 5, 3)]
    assert {tuple(r) for r in refused.collect()} == {(2, "unknown_case"), (4, "reviewer_mismatch")}


def test_overflow_equals_counting_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(f"r{i:03d}", "internal" if i % 2 else "external", int(h), 1.0, f"s{i % 40}") for i, h in enumerate(np.concatenate([np.full(30, 77), rng.integers(0, 2**62, 60)]))]
    records = spark.createDataFrame(rows, "record_id string, source_scope string, phash long, aspect_ratio double, sha256 string")
    for scopes in (S.ALL_SCOPES, {("internal", "external")}):
        for cap in (0, 5, 14, 40):
            want = {r["record_id"] for r in S.candidate_counts(records, 6, scopes).where(F.col("raw_pairs") > cap).collect()}
            assert {r["record_id"] for r in S.overflow(records, 6, cap, scopes).collect()} == want
    with pytest.raises(C.GateError):
        S.refuse_overflow(records, 6, 5)


def test_hashes_of_luma_equal_numpy(spark):
    rng = np.random.default_rng(4)
    d, p = rng.integers(0, 256, (5, 8, 9)), rng.integers(0, 256, (5, 32, 32))
    n = np.arange(32)
    wave = np.sqrt(2 / 32) * np.cos(np.pi * (2 * n[None, :] + 1) * n[:, None] / 64)
    wave[0] = math.sqrt(1 / 32)
    df = spark.createDataFrame([(i, a.ravel().tolist(), b.ravel().tolist()) for i, (a, b) in enumerate(zip(d, p))], "i int, d array<int>, p array<int>")
    for r in df.select("i", H.dhash(F.col("d")).alias("d"), H.phash(F.col("p")).alias("p")).collect():
        a, b = d[r["i"]], p[r["i"]].astype(float)
        low = (wave @ b @ wave.T)[:8, :8].ravel()
        for got, bits in ((r["d"], (a[:, :-1] > a[:, 1:]).ravel()), (r["p"], low >= np.median(low[1:]))):
            assert got == f"{int(''.join(str(int(x)) for x in bits), 2):016X}"


def test_columns_boxes_and_confidences_that_are_no_numbers(spark):
    assert C.missing_columns(spark.range(1), ["id", "x"]) == ["x"] and C.missing_columns(spark.range(1), ["id"], exact=True) == []
    assert T.first_column(["b", "c"], ["a", "c", "b"]) == "c" and T.first_column([], ["a"]) is None
    box = spark.range(1).select(B.centred(F.lit(0.5), F.lit(0.5), F.lit(0.2), F.lit(0.4), F.lit(100.0), F.lit(50.0)).alias("b")).first()["b"]
    assert [round(v, 9) for v in box] == [40.0, 15.0, 60.0, 35.0]
    assert L.manifest_differences({"a": 1, "b": 0.1}, {"a": 1, "b": 0.1 + 1e-13, "c": 2}) == ["c"]
    kind = "struct<x1:double,y1:double,x2:double,y2:double>"
    ps = spark.createDataFrame([("i", f"p{k}", 0, c, (0.0, 0.0, 1.0, 1.0)) for k, c in enumerate([float("nan"), None, 0.4])], f"image_id string, prediction_id string, class_id int, confidence double, box {kind}")
    gs = spark.createDataFrame([("i", "g", 0, (0.0, 0.0, 1.0, 1.0))], f"image_id string, gt_id string, class_id int, box {kind}")
    got = {r["threshold"]: (r["predictions_count"], r["tp"], r["fn"], r["images_with_fn"]) for r in M.sweep(ps, gs, [0.1, 0.5]).collect()}
    assert got == {0.1: (1, 1, 0, 0), 0.5: (0, 0, 1, 1)}
    assert {r["prediction_id"] for r in M.match(ps, gs, [0.1]).collect()} == {"p2"}


def test_commands(spark, sf_dir, tmp_path, capsys):
    from annoforge.__main__ import main

    assert main(["list"]) == 0 and "match_boxes" in capsys.readouterr().out.split()
    assert main(["sql", "distribution"]) == 0 and "SELECT" in capsys.readouterr().out
    assert main(["run", "no_such", sf_dir, str(tmp_path / "x")]) == 2
    assert main(["run", "keys_equal", sf_dir, str(tmp_path / "x"), "--format", "csv"]) == 0
    assert main(["run", "keys_equal", sf_dir, str(tmp_path / "x")]) == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "x")).columns == ["equal"]


def test_strict_documents(spark, tmp_path):
    import json

    doc = {"images": [{"id": 1, "file_name": "a.jpg", "width": 9, "height": 9}], "categories": [{"id": 0, "name": "x"}], "annotations": [{"id": 5, "image_id": 1, "category_id": 0, "bbox": [1, 1, 2, 2]}]}
    path = tmp_path / "a.json"
    path.write_text(json.dumps(doc))
    assert R.strict_coco(spark, {"train": str(path)}, {"train": sha(path.read_bytes())}).count() == 1
    with pytest.raises(R.SourceError, match="pinned"):
        R.strict_coco(spark, {"train": str(path)}, {"train": sha(b"")})
    for change, what in (({"images": doc["images"] * 2}, "occur once"), ({"categories": []}, "unknown category_id"), ({"annotations": [{"id": 5, "image_id": 1, "category_id": 0, "bbox": [1]}]}, "four numbers")):
        path.write_text(json.dumps(doc | change))
        with pytest.raises(R.SourceError, match=what):
            R.strict_coco(spark, {"train": str(path)})


def test_files_are_replaced_after_a_look_and_csv_comes_back_equal(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    K.replace_file(spark, path, b"one")
    K.replace_file(spark, path, b"two", before=b"one")
    with pytest.raises(R.SourceError, match="expected"):
        K.replace_file(spark, path, b"three", before=b"one")
    assert (tmp_path / "r.csv").read_bytes() == b"two" and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["r.csv"]
    rows = spark.createDataFrame([(1, 'x, "y"', None), (2, "", "é\nz")], "a int, b string, c string")
    assert {tuple(r) for r in K.checked_csv(rows, str(tmp_path / "c"), ["b", "a", "c"], bom=True).collect()} == {('x, "y"', "1", ""), ("", "2", "é\nz")}


def test_references_by_marker_and_as_they_stand(spark):
    inventory = spark.createDataFrame([("images/a.jpg",), ("/abs/b.jpg",)], "path string")
    rows = spark.createDataFrame([("C:\\x\\images\\a.jpg", ""), ("/abs/b.jpg", ""), ("zzz.jpg", "")], "file_name string, folder string")
    got = {r["file_name"]: r["resolved_path"] for r in R.resolve(rows, inventory, marker="images").collect()}
    assert got == {"C:\\x\\images\\a.jpg": "images/a.jpg", "/abs/b.jpg": "/abs/b.jpg", "zzz.jpg": None}
    assert R.settings("t: 0.5", {"t": (float,)}, ranges={"t": (0, 1)}) == {"t": 0.5}
    with pytest.raises(R.SourceError, match="from 0 to 1"):
        R.settings("t: 2.5", {"t": (float,)}, ranges={"t": (0, 1)})
