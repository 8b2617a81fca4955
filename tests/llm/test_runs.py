"""Periodic runs against all periods tried one by one; the arrays of one order against comparing suffixes."""

import hashlib
import random
import re
import zlib
from array import array

import pytest

from annoforge.llm import registry, runs, shared


def brute(t, least=24, periods=3):
    """All runs: for each period, stretches that keep it; the smallest period of a stretch counts."""
    out, seen = [], set()
    for p in range(1, len(t) // periods + 1):
        i = 0
        while i + p < len(t):
            s = i
            while i + p < len(t) and t[i] == t[i + p]:
                i += 1
            length = i - s + p
            if length >= 2 * p and (s, length) not in seen:
                seen.add((s, length))
                if length >= max(least, periods * p):
                    out.append((s, length, p))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts(seed, n):
    """Random, nested and repeated texts over few words."""
    rng = random.Random(seed)
    for _ in range(n):
        k = rng.choice([1, 2, 2, 3, 4])
        t = [rng.randrange(k) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 5)):
            more = [rng.randrange(k) for _ in range(rng.randint(0, 4))]
            t = rng.choice([t * rng.randint(2, 4), t + more, more + t, t + t[: rng.randint(0, len(t))]])[:250]
        yield t


@pytest.mark.parametrize(("least", "periods"), [(3, 3), (24, 3), (6, 4)])
def test_runs_equal_all_periods_tried(least, periods):
    for t in texts(least, 3000):
        assert runs.runs(array("i", t), least, periods) == brute(t, least, periods), t


def test_next_smaller_suffixes_and_common_parts():
    for t in texts(1, 1500):
        below, common, compared = runs.edges(array("i", t))
        assert compared <= 3 * len(t)
        for i in range(len(t)):
            j = next((j for j in range(i + 1, len(t)) if t[j:] < t[i:]), len(t))
            c = next((c for c in range(len(t) - j) if t[i + c] != t[j + c]), len(t) - j)
            assert (below[i], common[i]) == (j, c), (t, i)


class Counted(array):
    """An array that counts how often its words are read."""

    read = 0

    def __getitem__(self, i):
        Counted.read += 1
        return super().__getitem__(i)


def test_words_are_read_a_bounded_number_of_times():
    fibonacci, other = [0], [0, 1]
    while len(other) < 40_000:
        fibonacci, other = other, other + fibonacci
    cubes, x = [0], 0
    while len(cubes) < 40_000:
        x += 1
        cubes = cubes * 3 + [x]
    for t in (other, cubes, [0] * 40_000, [i % 37 for i in range(40_000)], list(range(40_000))):
        words, Counted.read = Counted("i", t), 0
        below, common, _ = runs.edges(words)
        assert Counted.read <= 10 * len(t)
        roots = [(i, below[i] - i) for i in range(len(t)) if common[i] > below[i] - i and not (2 * i >= below[i] and below[2 * i - below[i]] == i and common[2 * i - below[i]] >= below[i] - i)]
        Counted.read = 0
        list(runs.left_ends(words, roots))
        assert Counted.read <= 4 * len(t) + 4 * len(roots)


def plain(text):
    """(runs, collapsed) of a text."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    codes = {}
    found = brute([codes.setdefault(w, len(codes)) for w in words])
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return found, " ".join(w for i, w in enumerate(words) if i not in gone)


ODD = [None, "", " \n\t", "a " * 30, "a b\t" * 12, "x y z\n" * 30 + "end of it " + "q r " * 40, "é è " * 24, "� \U0001f600 " * 13, "ab" * 5000, "one two " * 11 + "one", "one two " * 12]


def test_odd_texts_repeated_rows_and_other_columns(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[5]), (None, ODD[3]), (None, None)]
    docs = spark.createDataFrame([(*r, "r", "c", "s") for r in rows], "doc_id bigint, text string, runs string, Collapsed string, start string")
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(docs).collect()]
    assert sorted(got, key=repr) == sorted([(d, *plain(t)) for d, t in rows], key=repr)
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="three"):
        runs.periodic_runs(docs, periods=2)


def test_long_texts_in_slices_equal_whole_ones(spark, monkeypatch):
    rng = random.Random(9)
    text = " ".join(rng.choices("abcdefgh", k=4000)) + " \n " + "stone river hill " * 900 + " ".join(rng.choices("abcdefgh", k=3000))
    docs = spark.createDataFrame([(1, text), (2, "a " * 40), (3, text[:9000])], "doc_id bigint, text string")
    want = {1: plain(text), 2: plain("a " * 40), 3: plain(text[:9000])}
    for size in (64, 1000, 1 << 20):
        monkeypatch.setattr(runs, "SLICE_BYTES", size)
        import pyarrow as pa

        column = pa.array([r["text"] for r in docs.orderBy("doc_id").collect()])
        n, rows, bounds, out = runs.found_in(column, 24, 3)
        for i in range(3):
            assert ([tuple(r) for r in rows[bounds[i] : bounds[i + 1]]], out[i].as_py()) == want[i + 1]
        assert n[0] == len(text.split())


def repeated(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return " ".join(words)


def test_query_over_the_smallest_tables(spark, sf_dir):
    got = {r["doc_id"]: r for r in registry.QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    docs = {r["doc_id"]: r["text"] for r in shared.table(spark, sf_dir, "documents").collect()}
    assert got.keys() == docs.keys()
    hits = 0
    for i, text in docs.items():
        found, left = plain(repeated(i, text))
        r = got[i]
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best), i
        assert r["exponent_milli"] == (best[1] * 1000 // best[2] if found else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(left.encode()).hexdigest()
        hits += bool(found)
    assert hits > 10
