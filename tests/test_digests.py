"""Digests of frames: order, repeats, nulls, any split; the first difference; exports that keep their order."""

import random

import pytest
from pyspark.sql import functions as F

from annoforge.operators import digests as D
from annoforge.operators import release as L
from annoforge.sources import packages as P
from annoforge.sources import sinks as K

ROWS = [(i, i % 7, None if i % 5 == 0 else f"v{i % 11}", [1.5, None] if i % 3 else None) for i in range(3000)]
SCHEMA = "position bigint, k bigint, v string, a array<double>"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i + 1, *r[1:]) for i, r in enumerate(ROWS)], SCHEMA).cache()


def test_digests_are_the_same_over_any_split(rows):
    want = D.frame_digest(rows, "position").first()
    for n in (1, 3, 17):
        mixed = rows.repartition(n, "v").orderBy(F.rand(n))
        assert D.frame_digest(mixed, "position").first() == want
        assert sorted(map(tuple, D.range_digests(mixed, "position", range_rows=100).collect())) == sorted(map(tuple, D.range_digests(rows, "position", range_rows=100).collect()))
    assert want["n_rows"] == 3000


def test_order_repeats_and_nulls_count(spark, rows):
    turned = rows.withColumn("position", 3001 - F.col("position"))
    assert D.frame_equal(rows.drop("position"), turned.drop("position")) and not D.frame_equal(rows, turned, "position")
    twice = rows.limit(10).unionByName(rows.limit(1))
    assert not D.frame_equal(rows.limit(10), twice) and D.frame_equal(twice, twice.repartition(4))
    one = lambda *v: spark.createDataFrame([v], "a string, b string")
    assert not D.frame_equal(one("", None), one(None, "")) and not D.frame_equal(one("\x00", "y"), one(None, "y"))
    assert not D.frame_equal(one("x\x1f", "y"), one("x", "\x1fy")) and not D.frame_equal(one("x\x1e1", "y"), one("x\x1f", "y"))
    assert not D.frame_equal(rows, rows.withColumn("k", F.col("k").cast("int")), "position")
    assert not D.frame_equal(rows, rows.select("position", "v", "k", "a"), "position")
    empty = rows.limit(0)
    assert D.frame_equal(empty, empty, "position") and D.frame_digest(empty).first()["n_rows"] == 0


@pytest.mark.parametrize("changed", [[1], [1500], [3000], [1023, 1024, 1025], [2, 2999]])
def test_the_first_difference_is_found(rows, changed):
    other = rows.withColumn("v", F.when(F.col("position").isin(*changed), "new").otherwise(F.col("v")))
    [r] = D.first_difference(rows, other, "position", range_rows=64).collect()
    assert r["position"] == min(changed) and r["right_row"]["v"] == "new" and r["left_row"]["v"] != "new"


def test_missing_and_added_rows_differ(rows):
    assert D.first_difference(rows, rows.repartition(5), "position").count() == 0
    [r] = D.first_difference(rows, rows.where("position < 2900"), "position").collect()
    assert r["position"] == 2900 and r["right_row"] is None


def test_files_keep_their_order(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    D.written_in_order(rows, "position", lambda df: df.write.parquet(path))
    assert D.frame_equal(rows, D.in_file_order(spark.read.parquet(path)).select(*rows.columns), "position")
    assert K.written_and_equal(rows.drop("position"), str(tmp_path / "u"), ["k", "v"])
    assert K.written_and_equal(rows.drop("position"), str(tmp_path / "w"), None)


def test_a_writer_that_changes_the_order_is_found(spark, rows, tmp_path, monkeypatch):
    def turned(df, position, write):
        write(df.orderBy(F.desc(position)).coalesce(1).drop(position))

    monkeypatch.setattr(K, "written_in_order", turned)
    assert not K.written_and_equal(rows.drop("position"), str(tmp_path / "t"), ["k", "v"])
    texts = rows.select("k", "v")
    assert sorted(map(tuple, P.checked_csv(texts, str(tmp_path / "c"), ["k", "v"], order=["k"]).collect())) == sorted((str(r[1]), r[2] or "") for r in ROWS)
    monkeypatch.setattr(P, "written_in_order", turned)
    with pytest.raises(Exception, match="changed on their way"):
        P.checked_csv(texts, str(tmp_path / "d"), ["k", "v"], order=["k"])


def test_repeated_reviews_are_refused_before_an_export(spark, tmp_path):
    source = spark.createDataFrame([("a", "", "x"), ("b", "", "y")], "id string, review_status string, text string")
    stored = spark.createDataFrame([("a", "reviewed"), ("a", "reviewed"), ("b", "reviewed")], "id string, review_status string")
    assert {tuple(r) for r in L.export_errors(source, stored, "id").collect()} == {("duplicate_review", 1)}
    with pytest.raises(Exception, match="duplicate_review"):
        P.export_completed(spark, source, stored, "id", ["review_status"], str(tmp_path / "out"))
    done = P.export_completed(spark, source, stored.distinct(), "id", ["review_status"], str(tmp_path / "out"))
    assert [r["id"] for r in D.in_file_order(done).orderBy("position").collect()] == ["a", "b"]


def test_random_changes_change_the_digest(spark):
    rng = random.Random(4)
    base = [(i + 1, rng.randrange(3), rng.choice(["", None, "a"])) for i in range(40)]
    schema = "position bigint, k int, v string"
    want = D.frame_digest(spark.createDataFrame(base, schema), "position").first()["digest"]
    for _ in range(6):
        i, j = rng.sample(range(40), 2)
        other = [list(r) for r in base]
        other[i][1:], other[j][1:] = other[j][1:], other[i][1:]
        got = D.frame_digest(spark.createDataFrame(other, schema), "position").first()["digest"]
        assert (got == want) == (base[i][1:] == base[j][1:])
