"""The stored review table: versions, conflicts, crashes, upkeep."""

import pytest
from pyspark.sql import functions as F

from annoforge.sources import tables as T

CASES = "k bigint, review_status string, priority string, revision int"
SAVES = "seq bigint, k bigint, review_status string, priority string, reviewer string, reviewed_at_utc string"
AT = "2026-01-02T03:04:05+00:00"
WHO = {"reviewer": "ann", "package": "p1"}


def save(seq, k, status="reviewed", priority="low", who="ann", at=AT):
    return (seq, k, status, priority, who, at)


@pytest.fixture
def cases(spark):
    return spark.createDataFrame([(k, "pending", "", 0) for k in range(20)], CASES)


@pytest.fixture
def store(spark, cases, tmp_path):
    out = T.Reviews(spark, str(tmp_path / "reviews"), "k", ["review_status", "priority"], buckets=4)
    assert out.open(cases, WHO) == 1
    return out


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SAVES)


def state(store, version=None, name="all"):
    return {r["k"]: (r["review_status"], r["revision"]) for r in store.state(version, name).collect()}


def test_saves_are_versions_that_stay_readable(spark, store):
    assert store.save(frame(spark, save(1, 3), save(2, 3, "needs_adjudication"), save(3, 5, priority="high"))) == 2
    assert store.save(frame(spark, save(4, 3))) == 3
    assert state(store, 1)[3] == ("pending", 0) and state(store, 2)[3] == ("needs_adjudication", 2) and state(store, 3)[3] == ("reviewed", 3)
    assert len(state(store)) == 20 and state(store, 3)[5] == state(store, 2)[5] == ("reviewed", 1)
    events = [(r["event_id"], r["k"], r["revision"]) for r in store.events().orderBy("event_id").collect()]
    assert events == [(1, 3, 1), (2, 3, 2), (3, 5, 1), (4, 3, 3)] and store.value("saves") == 4 and store.value("saves", 2) == 3
    assert set(state(store, name="reviewed")) == {3, 5} and set(state(store, name="high_priority") if "retraining_priority" in store.state().columns else {5}) == {5}
    assert {r["saved_at"] for r in store.state().where("k in (3, 5)").collect()} == {AT}
    log = {(r["version"], r["table_name"]): (r["operation"], r["n_rows"]) for r in store.tables.log().collect()}
    assert log[1, "cases"] == ("open", 20) and log[3, "events"] == ("save", 4) and log[2, "events"] == ("save", 3)


def test_only_touched_buckets_are_rewritten(spark, store):
    before = {p["bucket"]: p["path"] for p in store.tables.manifest()["tables"]["cases"]["parts"]}
    store.save(frame(spark, save(1, 3)))
    after = {p["bucket"]: p["path"] for p in store.tables.manifest()["tables"]["cases"]["parts"]}
    assert before.keys() == after.keys() and sum(before[b] != after[b] for b in before) == 1


def test_one_of_two_writers_from_a_version_is_refused_and_retries(spark, store):
    base = store.tables.manifest()
    other = T.Reviews(spark, store.tables.root, "k", ["review_status", "priority"], buckets=4)
    assert store.save_from(base, frame(spark, save(1, 3))) == 2
    with pytest.raises(T.Conflict, match="version 2"):
        other.save_from(base, frame(spark, save(2, 3, "needs_adjudication")))
    assert state(store) [3] == ("reviewed", 1)
    assert other.save(frame(spark, save(2, 3, "needs_adjudication"))) == 3
    assert state(store)[3] == ("needs_adjudication", 2) and [r["event_id"] for r in store.events().orderBy("event_id").collect()] == [1, 2]


def test_a_writer_between_reading_and_commit_makes_the_change_run_again(spark, store):
    runs = []

    def change(base):
        runs.append(base["version"])
        if len(runs) == 1:
            store.save(frame(spark, save(1, 7)))
        return store.save_from(base, frame(spark, save(2, 7)))

    assert store.tables.transact(change) == 3 and runs == [1, 2] and state(store)[7] == ("reviewed", 2)


def test_a_commit_that_dies_half_way_changes_nothing(spark, store, monkeypatch):
    store.save(frame(spark, save(1, 3)))

    def dies(*_):
        raise OSError("the writer dies")

    with monkeypatch.context() as m:
        m.setattr(T, "put_new", dies)
        with pytest.raises(OSError, match="dies"):
            store.save(frame(spark, save(2, 3), save(3, 4)))
    assert store.tables.latest() == 2 and state(store)[3] == ("reviewed", 1) and store.value("saves") == 1
    store.tables.check()
    assert store.tables.vacuum(keep=5) == 0  # too young
    assert store.tables.vacuum(keep=5, grace_seconds=0) >= 2
    store.tables.check()
    assert store.save(frame(spark, save(2, 3))) == 3 and state(store)[3] == ("reviewed", 2)


def test_bad_saves_are_refused_with_their_code(spark, store):
    store.save(frame(spark, save(1, 99), save(2, 3, "pending"), save(3, 3, who="bob"), save(4, 3, at="soon"), save(5, 3)))
    assert {(r["seq"], r["code"]) for r in store.tables.read("refused").collect()} == {(1, "unknown_case"), (2, "status_not_saved"), (3, "reviewer_mismatch"), (4, "invalid_timestamp")}
    assert state(store)[3] == ("reviewed", 1) and len(state(store)) == 20


def test_opening_again(spark, store, cases):
    assert store.open(cases, WHO) == 1
    with pytest.raises(ValueError, match="workspace identity"):
        store.open(cases, WHO | {"reviewer": "bob"})
    with pytest.raises(ValueError, match="source cases"):
        store.open(cases.withColumn("priority", F.lit("x")), WHO)


def test_last_viewed_and_exports(spark, store):
    store.set_last_viewed(5)
    assert store.value("last_viewed") == 5
    with pytest.raises(LookupError, match="unknown case"):
        store.set_last_viewed(99)
    store.export("a/b.csv", "0" * 64)
    with pytest.raises(ValueError, match="already exported"):
        store.export("a/b.csv", "1" * 64)
    store.export("a/c.csv", "1" * 64)
    assert store.tables.read("exports").count() == 2


def test_upkeep(spark, store):
    for i in range(4):
        store.save(frame(spark, save(i, i)))
    assert store.tables.read("events").count() == 4 and len(store.tables.manifest()["tables"]["events"]["parts"]) == 4
    store.tables.compact("events")
    assert store.tables.read("events").count() == 4 and len(store.tables.manifest()["tables"]["events"]["parts"]) == 1
    store.tables.vacuum(keep=1, grace_seconds=0)
    assert store.tables.versions() == [6] and store.tables.read("events").count() == 4
    store.tables.check()
    with pytest.raises(LookupError):
        store.state(2)
    part = store.tables.manifest()["tables"]["events"]["parts"][0]["path"]
    store.tables.store.delete(f"{store.tables.root}/data/{part}")
    with pytest.raises(T.Damaged, match="missing"):
        store.tables.check()


def test_other_columns_are_refused(spark, store):
    with pytest.raises(ValueError, match="in place of"):
        store.tables.commit(store.tables.manifest(), "odd", appended={"source": spark.createDataFrame([(1,)], "k int")})


def test_files_are_put_once(spark, tmp_path):
    path = str(tmp_path / "x.json")
    assert T.put_new(spark, path, "one") and not T.put_new(spark, path, "two")
    assert (tmp_path / "x.json").read_text() == "one" and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["x.json"]
    assert T.put_new(spark, f"{tmp_path}/sub/y.json", "three")


def test_cases_do_not_go_through_the_driver(spark):
    from annoforge.operators import store as P

    cases = spark.createDataFrame([(1, 0, "low"), (2, 4, "low")], "k int, revision int, priority string")
    saves = spark.createDataFrame([(1, 2, "reviewed", "high", "ann", "2024-01-02T03:04:05+00:00"), (2, 9, "reviewed", "high", "ann", "2024-01-02T03:04:05+00:00")], "seq int, k int, review_status string, priority string, reviewer string, reviewed_at_utc string")
    state, audit, refused = P.save(cases, saves, "k", ["priority"], "ann")
    assert sorted(map(tuple, state.collect())) == [(1, "low", 0, None), (2, "high", 5, "2024-01-02T03:04:05+00:00")]
    assert [r["revision"] for r in audit.collect()] == [5] and [tuple(r) for r in refused.collect()] == [(2, "unknown_case")]
    for part in (state, refused):
        assert "Broadcast" not in part._jdf.queryExecution().executedPlan().toString()
