"""License notices against every block of every text, tried one by one."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from annoforge.llm import licenses as L
from annoforge.llm import registry, shared

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, templates=L.TEMPLATES, phrases=L.PHRASES, threshold=L.THRESHOLD):
    """(words, places of phrases, base labels, labels, score) of a text."""
    w = split(text)
    starts = [(i, label) for p, label in phrases for i in range(len(w)) if w[i : i + len(split(p))] == split(p)]
    hits = []
    for label, notice in templates:
        own, s = set(split(notice)), 8
        while s < len(split(notice)):
            s *= 2
        for b in range(0, len(w), s):
            n = len(own & set(w[b : b + 2 * s]))
            if 100 * n >= threshold * len(own):
                hits.append((own, label, b, b + 2 * s, n / len(own)))
    stand = [h for h in hits if not any(h[0] < o[0] and o[2] < h[3] and h[2] < o[3] for o in hits)]
    base = {x for _, x in starts}
    at = [i for i, _ in starts]
    score = 1.0 if starts else max((h[4] for h in stand), default=0.0)
    return len(w), len(starts), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | {h[1] for h in stand})), score


def rows_of(df):
    return Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) for r in df.collect())


def made(seed, n):
    """Texts of notices, whole, cut, with words left out or put in, among other words."""
    rng = random.Random(seed)
    noise = "river stone the of and to this is free software under license licensed version 4 0 2 by cc work é ü".split()
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choices(noise, k=rng.randint(0, 25))
            w = rng.choice(L.TEMPLATES)[1].split()
            w = [x for x in w if rng.random() > rng.choice([0, 0, 0.04, 0.12])]
            for _ in range(rng.randint(0, 3)):
                w.insert(rng.randint(0, len(w)), rng.choice(noise))
            parts += [x.upper() if rng.random() < 0.1 else x for x in w]
        yield i, rng.choice([" ", "\n", " - ", ", "]).join(parts)


ODD = [(900, None), (901, ""), (902, " \n.,"), (903, "MIT License mit-license\nApache license GENERAL public license"), (903, "MIT License"), (None, "Licensed under CC BY-NC 4.0."), (904, "mit licenses; mitlicense"), (905, "x" * 3000 + " mit license"), (906, "éapache license apache licenseé")]


def test_notices_equal_every_block_tried(spark):
    rows = [*made(3, 250), *ODD]
    docs = spark.createDataFrame([(*r, "k", "b") for r in rows], "doc_id bigint, text string, key string, Blocks string")
    assert rows_of(L.scan_licenses(docs)) == Counter((d, *plain(t)) for d, t in rows)
    assert L.scan_licenses(docs.limit(0)).count() == 0


@pytest.mark.parametrize("threshold", [40, 70, 100])
def test_other_templates_and_thresholds(spark, threshold):
    rng = random.Random(threshold)
    templates = [(f"t{i % 5}", " ".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 30)))) for i in range(14)]
    rows = [(i, " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", [9] * 10 + [1] * 16, k=rng.randint(0, 120)))) for i in range(80)]
    phrases = [("a b", "p"), ("c", "q"), ("d d d", "r")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = L.scan_licenses(docs, templates, phrases, threshold)
    assert rows_of(got) == Counter((d, *plain(t, templates, phrases, threshold)) for d, t in rows)
    for r in got.collect():
        assert all(0 <= h["from"] < h["to"] <= r["n_words"] and h["containment"] * 100 >= threshold for h in r["notices"])


def test_joins_that_shuffle_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(list(made(4, 60)), "doc_id bigint, text string")
    want = rows_of(L.scan_licenses(docs))
    monkeypatch.setattr(shared, "BROADCAST_BYTES", -1)
    assert rows_of(L.scan_licenses(docs)) == want


def test_slices_of_long_texts(monkeypatch):
    texts = [t for _, t in made(6, 40)]
    reader = L.Reader(L.Library(L.TEMPLATES, L.PHRASES, 90))
    want, bounds = reader.codes(pa.array(texts))
    monkeypatch.setattr(L, "SLICE_BYTES", 50)
    got, bounds2 = reader.codes(pa.array(texts))
    assert got.tolist() == want.tolist() and bounds.tolist() == bounds2.tolist()


def test_templates_without_words_are_refused():
    with pytest.raises(ValueError, match="no word"):
        L.Library([("x", "...")], [], 90)
    with pytest.raises(ValueError, match="threshold"):
        L.Library(L.TEMPLATES, [], 0)


def test_query_over_the_smallest_tables(spark, sf_dir):
    docs = shared.table(spark, sf_dir, "documents").collect()
    got = rows_of(registry.QUERIES["op13_licenses"](spark, sf_dir))
    assert got == Counter((r["doc_id"], *plain(r["text"])) for r in docs)
    assert sum(bool(k[6]) for k in got) > sum(bool(k[5]) for k in got) > 0
