"""The text operators in Spark on small tables with nulls, repeats, extra columns and long texts, against brute force."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from annoforge.llm import byte_bpe, embedding_dup, language, line_dedup, mixing, near_dup, pii, quality, registry, shared, token_counts, toxicity
from annoforge.llm.vocabularies import vocabulary

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, node string, lines string, v string"


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, columns with names that operators use."""
    base = [(1, "a b c d e f g", "en", "s"), (1, "a b c d e f g", "en", "s"), (None, "x", None, None), (2, None, "de", "s"), (3, "", None, "s"), (4, " \n\t", "en", None), (5, "word " * 30_000, "en", "s"), (6, "é" * 50_000, "fr", "t")]
    return frame(spark, [(d, t, g, s, None, "i", "n", "l", "v") for d, t, g, s in base], SCHEMA)


def empty(df):
    return df.limit(0)


def test_every_operator_takes_odd_rows_and_empty_tables(spark, odd):
    model = language.learn(odd, 100)
    labels = frame(spark, [(1, 1), (2, 0), (None, 1), (3, None)], "doc_id bigint, toxic int")
    field = toxicity.learn(odd, labels)
    runs = {
        "bpe": lambda d: byte_bpe.encode_documents(d, vocabulary("byte_bpe_multi_50k.tiktoken")),
        "counts": lambda d: token_counts.count_tokens(d, vocabulary("word_bpe_49k.json")),
        "pii": pii.find_pii,
        "language": lambda d: language.identify(d, model),
        "toxicity": lambda d: toxicity.tag(d, field),
        "quality": quality.quality,
        "near": near_dup.near_duplicates,
        "lines": lambda d: line_dedup.dedup_lines(d, drop_emptied=False),
        "mix": lambda d: mixing.mix(d, entropy=0.0),  # shares as they are: every row once
        "reject": lambda d: toxicity.reject_toxic(d, labels, threshold=1.1),
    }
    for name, run in runs.items():
        assert run(odd).count() == odd.count(), name
        assert run(empty(odd)).count() == 0, name


#: Names that operators use inside or add, in any case, and names that need quoting.
CLASHING = ["lines", "line_id", "line_all", "n_words", "kept", "distance", "base_failed", "x0", "k0", "own", "mix_source", "mix_epoch", "mix_copies", "h", "t", "node", "Node2", "score", "spans", "n_tokens", "ids", "a.b", "with space"]


@pytest.fixture(scope="module")
def clashing(spark):
    """String ids, some repeated with the same and with another text, nulls, ties, and a text of 1 MB."""
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rng = random.Random(21)
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(12)]
    base = [(f"d{i}", t, "en", "s") for i, t in enumerate(texts)]
    base += [base[0], ("d1", texts[2] + "\nanother line here", "en", None), (None, texts[3], None, "s"), ("e", None, "en", "t"), ("f", "", None, None), ("g", "word " * 200_000, "de", "t"), ("h", "0" * 6000 + ".1.1.1", "de", "t")]
    schema = "doc_id string, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return frame(spark, [(*r, *CLASHING) for r in base], schema)


def test_operators_keep_columns_of_any_name_and_ids_of_any_type(spark, clashing, sf_dir):
    n = clashing.count()
    labels = frame(spark, [("d1", 1), ("d2", 0), ("g", 0), ("zz", 1)], "doc_id string, toxic int")
    keeping = {
        "lines": lambda d: line_dedup.dedup_lines(d, drop_emptied=False, count="n_removed"),
        "mix": lambda d: mixing.mix(d, entropy=0.0),
        "reject": lambda d: toxicity.reject_toxic(d, labels, threshold=1.1),
        "quality": quality.quality,
    }
    for name, run in keeping.items():
        out = run(clashing)
        assert set(clashing.columns) - {"text"} <= set(out.columns), name
        rows = out.collect()
        assert len(rows) == n and all(r[c] == c for r in rows for c in CLASHING), name
        assert run(empty(clashing)).count() == 0, name
    field = toxicity.learn(clashing, labels)
    by_id = {
        "near": near_dup.near_duplicates,
        "pii": pii.find_pii,
        "toxicity": lambda d: toxicity.tag(d, field),
        "language": lambda d: language.identify(d, language.learn(clashing, 100)),
        "bpe": lambda d: byte_bpe.encode_documents(d, vocabulary("byte_bpe_multi_50k.tiktoken")),
        "counts": lambda d: token_counts.count_tokens(d, vocabulary("word_bpe_49k.json")),
    }
    for name, run in by_id.items():
        assert Counter(r["doc_id"] for r in run(clashing).collect()) == Counter(r["doc_id"] for r in clashing.collect()), name
    assert {c for c in near_dup.keep_one(clashing).columns} == set(clashing.columns)


def test_rows_of_one_id_do_not_lose_each_others_lines(spark):
    docs = [(1, "shared"), (2, "shared"), (2, "only here"), (2, "only here")]
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(frame(spark, docs), drop_emptied=False).collect())
    assert got == {(1, "shared"): 1, (2, ""): 1, (2, "only here"): 2}


def test_sources_without_a_token_get_one_pass(spark):
    docs = frame(spark, [(1, "a b", "s"), (2, "", "z"), (3, None, "z"), (4, "", "s")], "doc_id bigint, text string, source string")
    assert Counter(r["doc_id"] for r in mixing.mix(docs).collect()) == {1: 1, 2: 1, 3: 1, 4: 1}


def test_the_window_of_learning_can_be_lifted(spark):
    rng = random.Random(30)
    rows = [(i, " ".join(rng.choices(["calm", "river", "stone", "hill"], k=3000) + (["vile", "rotten", "filth"] if i % 2 else ["green", "field", "early"])), i % 2) for i in range(60)]
    docs, labels = frame(spark, [r[:2] for r in rows]), frame(spark, [(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    ends = [(1, "stone vile rotten"), (2, "stone green field")]
    whole = {r["doc_id"]: r["score"] for r in toxicity.tag(frame(spark, ends), toxicity.learn(docs, labels, window=None)).collect()}
    cut = {r["doc_id"]: r["score"] for r in toxicity.tag(frame(spark, ends), toxicity.learn(docs, labels, window=200)).collect()}
    assert whole[1] - whole[2] > 0.3 > abs(cut[1] - cut[2])


def test_the_end_of_growing_edits_can_be_lifted(spark):
    rng = random.Random(31)
    base = ["".join(rng.choices("abcdefghij klmnop", k=n)) for n in (300, 420, 500, 700)]
    docs = [(i, line) for i, line in enumerate(base)]
    for i, (line, edits) in enumerate([(base[0], 12), (base[1], 8), (base[1], 19), (base[2], 20), (base[2], 24), (base[3], 25), (base[3], 5)], 10):
        chars = list(line)
        for at in rng.sample(range(0, len(chars), 7), edits):
            chars[at] = "X"
        docs.append((i, "".join(chars)))
    for most in (6, 20):
        edits = line_dedup.growing(most)
        got = {r["doc_id"] for r in line_dedup.dedup_lines(frame(spark, docs), max_edits=edits).collect()}
        kept = []
        for d, t in docs:
            if not any(sum(a != b for a, b in zip(t, u)) <= edits(len(t)) for _, u in docs[: docs.index((d, t))] if len(u) == len(t)):
                kept.append(d)
        assert got == set(kept)
    with pytest.raises(ValueError, match="30"):
        line_dedup.growing(31)


def test_neighbouring_toxic_tokens_are_one_span(spark):
    rng = random.Random(22)
    calm = ["calm", "river", "stone", "green", "field", "early"]
    rows = [(i, " ".join(rng.choices(calm, k=20) + (["vile", "rotten", "filth"] if i % 2 else []) + rng.choices(calm, k=20)), i % 2) for i in range(200)]
    docs = frame(spark, [r[:2] for r in rows])
    field = toxicity.learn(docs, frame(spark, [(r[0], r[2]) for r in rows], "doc_id bigint, toxic int"))
    text = "calm river vile rotten filth, stone vile"
    got = toxicity.tag(frame(spark, [(1, text), (2, "calm stone")]), field).orderBy("doc_id").collect()
    assert [text[s["start"] : s["end"]] for s in got[0]["spans"]] == ["vile rotten filth", "vile"] and not got[1]["spans"]
    assert got[0]["score"] > 0.5 > got[1]["score"]


def test_personal_data_in_long_texts_takes_linear_time():
    import time

    n = 300_000
    for text in ("a" * n + " point x", " " * n + "[at]", "dot " * (n // 4), "x at at dot " * (n // 12), "1 dot " * (n // 6), "[ " * (n // 2), "+1" + "(" * n, "x at " + "a." * (n // 2), "0" * n + ".1.1.1"):
        began = time.perf_counter()
        plain = pii.detect(text)
        pii.disguised(text, plain)
        assert time.perf_counter() - began < 5, text[:20]


def test_disguised_parts_alone_are_enough():
    def found(text):
        plain = pii.detect(text)
        return [(pii.KINDS[k], text[a:b]) for a, k, b in pii.disguised(text, plain)]

    assert found("write to jane.doe at example.com now") == [("email", "jane.doe at example.com")]
    assert found("jane at example\ndot\ncom") == [("email", "jane at example\ndot\ncom")]
    assert found("call +44 20 seven 946 0958") == [("phone", "+44 20 seven 946 0958")]
    assert found("call plus 44 20 7946 0958 now") == [("phone", "plus 44 20 7946 0958")]
    assert found("card 4111 1111 1111 111 one") == [("card", "4111 1111 1111 111 one")]
    assert found("jane at mail dot it.") == [("email", "jane at mail dot it")]
    assert found("jane arrobase mail point xyz") == [] and found("jane arobase mail point xyz") == [("email", "jane arobase mail point xyz")]
    assert found("look at one point in time") == found("we arrive at some point the end") == []


def test_language_learns_nothing_from_an_empty_table(spark, odd):
    out = language.identify(odd, language.learn(empty(odd))).collect()
    assert {(r["lang_pred"], r["score"]) for r in out} == {("und", 0.0)}


def test_digests_of_bpe(spark):
    import tiktoken

    import public_tokenizers as P

    with open(vocabulary("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(f.read()), special_tokens={})
    docs = frame(spark, [(1, "Hello  world's café"), (2, None)])
    got = {r["doc_id"]: r for r in byte_bpe.encode_documents(docs, vocabulary("byte_bpe_multi_50k.tiktoken")).collect()}
    assert got[1]["ids"] == library.encode_ordinary("Hello  world's café") and bytes(got[1]["decoded"]).decode() == "Hello  world's café"
    assert got[2]["ids"] == [] and got[2]["n_tokens"] == 0


def shingles(text):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def smallest_linked(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def made_documents(seed):
    """Families of edited copies, a passage that a third of the documents share, and short texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = rng.choices(words, k=60)
    out = []
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(6, 300))
        for _ in range(rng.choice([1, 1, 2, 6, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(copy)
    for _ in range(60):
        out.append(rng.choices(words, k=rng.randint(5, 120)) + passage)
    out += [["a", "b"], ["A", "b"], ["a"], [], ["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e"]]
    rng.shuffle(out)
    return [(i, " ".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize("seed", [1])
def test_near_duplicates_equal_brute_force(spark, seed):
    docs = made_documents(seed)
    sets = {i: shingles(t) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = smallest_linked(sets, links)
    got = near_dup.near_duplicates(frame(spark, docs)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert {r["doc_id"] for r in near_dup.keep_one(frame(spark, docs)).collect()} == {i for i in want if want[i] == i}


def test_long_documents_near_the_threshold_are_found(spark):
    """Sets above 256 shingles, which only sketches represent: pairs a little above 0.75 and as many a little below."""
    rng = random.Random(31)
    docs, links = [], []
    for i in range(300):
        base = [f"w{rng.randrange(10**9)}" for _ in range(rng.randint(330, 900))]
        n, percent = len(base) - 4, rng.uniform(0.755, 0.80) if i % 2 else rng.uniform(0.70, 0.745)
        lost = round(n * (1 - percent) / (1 + percent))  # shingles of either that the other has not
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:-lost] + [f"v{rng.randrange(10**9)}" for _ in range(lost)]))]
        a, b = shingles(docs[-2][1]), shingles(docs[-1][1])
        if 100 * len(a & b) >= 75 * len(a | b):
            links.append((2 * i, 2 * i + 1))
    assert len(links) >= 140
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(frame(spark, docs)).collect()}
    found = {(a, b) for a, b in links if got[a] == got[b]}
    assert len(found) >= 0.99 * len(links)
    assert sum(got[i] != i for i in got) == len(found)


def test_components_of_long_paths(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in shared.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def asked(lines, text):
    """Keys of a line's substrings, and which of them are of its own segments."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    _, keys = lines.keys(points, np.array([[0], [len(points)]]))
    return {k >> 1: k & 1 for k in sorted(keys.tolist())}


def edited(rng, text, letters, most):
    out = list(text)
    for _ in range(rng.randint(0, most)):
        i = rng.randint(0, len(out))
        out[i : i + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters)])
    return "".join(out)


def alike(a, b, k):
    return bool(line_dedup.similar([(line_dedup.points_of(a), line_dedup.points_of(b))], [k])[0])


def test_many_distances_at_once_equal_single_ones():
    rng = random.Random(17)
    pairs = []
    for _ in range(3000):
        a = "".join(rng.choices("abcé", k=rng.randint(0, 90)))
        pairs.append((a, edited(rng, a, "abcé", 9) if rng.random() < 0.8 else a[rng.randint(0, 5) :], rng.randint(1, 6)))
    got = line_dedup.similar([(line_dedup.points_of(a), line_dedup.points_of(b)) for a, b, _ in pairs], [k for _, _, k in pairs])
    assert got.tolist() == [line_dedup.within(a, b, k) for a, b, k in pairs] and 500 < got.sum() < 2800


@pytest.mark.parametrize(("chars", "cells"), [(1 << 15, 1 << 18), (1 << 15, 1), (40, 3000), (-1, 1)])
def test_distances_by_table_and_by_columns_equal_single_ones(monkeypatch, chars, cells):
    monkeypatch.setattr(line_dedup, "TABLE_CHARS", chars)
    monkeypatch.setattr(line_dedup, "TABLE_CELLS", cells)
    rng, pairs = random.Random(23), []
    for _ in range(1500):
        a, k = "".join(rng.choices(rng.choice(["ab", "abcé😀 "]), k=rng.randint(0, rng.choice([5, 90])))), rng.choice([0, 1, 2, 3, 6, 13, 30])
        pairs.append((a, edited(rng, a, "abé", k + 3) if rng.random() < 0.8 else "".join(rng.choices("ab", k=rng.randint(0, 90))), k))
    got = line_dedup.similar([(line_dedup.points_of(a), line_dedup.points_of(b)) for a, b, _ in pairs], [k for _, _, k in pairs])
    assert got.tolist() == [line_dedup.within(a, b, k) for a, b, k in pairs] and 300 < got.sum() < 1400


def test_steps_of_distances_do_not_grow_with_the_longest_line():
    rng, pairs = random.Random(29), []
    for n in [*range(30, 500, 2), 1500, 3000]:
        a = "".join(rng.choices("abcdefghij ", k=n))
        b = "z" + a[1 : n // 3] + "other words" + a[n // 3 : -1] + "z"
        pairs.append((line_dedup.points_of(a), line_dedup.points_of(b[:n])))

    def seconds(run):
        best = 1e9
        for _ in range(3):
            began = time.process_time()
            run()
            best = min(best, time.process_time() - began)
        return best

    columns = seconds(lambda: line_dedup.bands(*map(list, zip(*pairs)), 6))
    assert seconds(lambda: line_dedup.similar(pairs, [6] * len(pairs))) < 0.5 * columns


def test_banded_distance_and_segments():
    rng = random.Random(3)
    readers = {k: line_dedup.Lines(k, 1) for k in range(1, 5)}
    for n in range(4000):
        k, letters = rng.randint(1, 4), "ab" if n % 2 else "abcdef"
        a = "".join(rng.choices(letters, k=rng.randint(0, 14)))
        b = edited(rng, a, letters, k + 2)
        near = distance(a, b) <= k
        assert line_dedup.within(a, b, k) == alike(a, b, k) == near
        if near and a != b and min(len(a), len(b)) > k:
            x, y = asked(readers[k], a), asked(readers[k], b)
            assert any(x[key] or y[key] for key in x.keys() & y.keys())


def test_similar_long_lines_share_a_substring_and_nearly_their_kinds():
    rng, reader = random.Random(13), line_dedup.Lines(None, 1)
    for n in range(1500):
        letters = "ab é" if n % 3 == 0 else "abcdefghijklmnopqrstuvwxyz  é日"
        a = "".join(rng.choices(letters, k=rng.randint(24, 260)))
        b = edited(rng, a, letters, 8)
        k = reader.edits(min(len(a), len(b)))
        assert alike(a, b, k) == line_dedup.within(a, b, k)
        if a == b or not line_dedup.within(a, b, k):
            continue
        x, y = asked(reader, a), asked(reader, b)
        assert any(x[key] or y[key] for key in x.keys() & y.keys()), (a, b)
        points = np.frombuffer((a + "\n" + b).encode("utf-32-le"), np.uint32)
        kinds = reader.kinds(points, np.array([[0, len(a) + 1], [len(a), len(points)]]))
        bits = [((int(u) ^ int(v)) & (1 << 64) - 1).bit_count() for u, v in zip(*kinds)]
        assert bits[0] <= 2 * k and bits[1] + bits[2] <= 4 * k


@pytest.mark.parametrize(("edits", "crowded"), [(1, False), (2, False), (2, True)])
def test_line_dedup_equals_brute_force(spark, monkeypatch, edits, crowded):
    if crowded:  # all ranges, lists and slices over their bounds
        for name, value in (("SLICE_BYTES", 64), ("PACK", 50), ("RANGE_MOST", 40), ("FREQUENT", 3), ("LIST_BLOCK", 3), ("LIST_BYTES", 100)):
            monkeypatch.setattr(line_dedup, name, value)
        monkeypatch.setattr(shared, "BROADCAST_BYTES", 0)
    rng = random.Random(4)
    pool = ["".join(rng.choices("abcd ", k=rng.randint(6, 40))) for _ in range(30)]
    common = "this line is common to all of them"
    docs = []
    for i in range(40):
        lines = [common]
        for _ in range(rng.randint(0, 8)):
            line = rng.choice(pool)
            if rng.random() < 0.5:
                k = rng.randrange(len(line))
                line = line[:k] + rng.choice(["", "z", line[k] + "y"]) + line[k + 1 :]
            lines.append(line)
        docs.append((i, "\n".join(lines)))
    docs += [(50, None), (51, ""), (52, common)]
    seen, want = [], {}
    for i, text in docs:
        kept = []
        for line in (text or "").split("\n"):
            if len(line) >= 10:
                late = any(distance(line, s) <= edits for s in seen if abs(len(s) - len(line)) <= edits)
                seen.append(line)
                if late:
                    continue
            kept.append(line)
        want[i] = None if text is None else "\n".join(kept)
    got = line_dedup.dedup_lines(frame(spark, docs), edits, 10, drop_emptied=False)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want
    assert 52 not in {r["doc_id"] for r in line_dedup.dedup_lines(frame(spark, docs), edits, 10).collect()}


def test_copies_of_short_lines_go_and_similar_short_lines_stay(spark):
    docs = [(1, "Home\n\n--\nPage 1\nAll rights reserved."), (2, "Home\n\n--\nPage 2\nAll rights reserved."), (3, "über uns\nHome")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(frame(spark, docs)).collect()}
    assert got == {1: docs[0][1], 2: "\n--\nPage 2", 3: "über uns"}


def test_longer_lines_may_differ_by_more_edits(spark):
    long = " ".join(f"{w}{i}" for i, w in enumerate(["harbour", "letter", "garden", "window", "marble", "candle"] * 4))
    near, far = long.replace("garden8", "gxxxen8"), long.replace("garden8", "meadows of 99")
    short = "the ferry leaves at ten sharp"
    docs = [(1, long), (2, near), (3, far), (4, short), (5, short.replace("ten", "six")), (6, short.replace("ten", "tin"))]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(frame(spark, docs)).collect()}
    assert got == {1: long, 3: far, 4: short, 5: docs[4][1]}


def made_vectors(seed, n=150, dim=24):
    rng = np.random.default_rng(seed)
    out = list(rng.normal(size=(n, dim)))
    centre = rng.normal(size=dim)
    out += [centre + rng.normal(size=dim) * 0.08 * np.linalg.norm(centre) / dim**0.5 for _ in range(60)]
    out += [out[0]] * 3
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(out)]
    return rows + [(900, None), (901, [0.0] * dim), (902, [float("nan")] * dim), (903, [1.0]), (904, [None, 1.0]), (905, []), (906, [1e30, 1e30]), (907, [1e30, 1e30])]


def test_embeddings_equal_brute_force(spark):
    rows = made_vectors(5)
    good = {i: np.array(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and (good[a] / np.linalg.norm(good[a])) @ (good[b] / np.linalg.norm(good[b])) >= 0.9]
    want, n = smallest_linked([i for i, _ in rows], links), Counter(x for pair in links for x in pair)
    got = embedding_dup.similar(frame(spark, rows, "vec_id bigint, embedding array<double>"), block=16).collect()
    assert {r["vec_id"]: (r["component_id"], r["n_links"]) for r in got} == {i: (want[i], n[i]) for i, _ in rows}


@pytest.mark.parametrize(("dim", "n"), [(64, 2000), (384, 400), (768, 300)])
def test_hashing_recall_at_the_threshold(dim, n):
    rng = np.random.default_rng(6)
    a = rng.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (b * a).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.9 * a + (1 - 0.81) ** 0.5 * b
    x, y = embedding_dup.buckets(a), embedding_dup.buckets(b)
    assert x.max() < 1 << 32 and embedding_dup.code_type(dim, None) == np.uint32
    assert embedding_dup._meet(x, y).any(1).mean() >= 0.99


def test_statistics_equal_brute_force(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices(["a ", "b ", "c\n", "#", " x&", "é ", "\t", "a b c d e ", "\n\n"], k=rng.randint(0, 60))) for _ in range(200)] + [None, ""]

    def brute(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {p for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)

    out = quality.statistics(frame(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out} == {i: brute(t) for i, t in enumerate(texts)}


def test_robust_scatter_ignores_outliers_and_quality_rejects_them(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        words = [rng.choice("abcdefgh") * rng.randint(3, 7) + str(rng.randint(0, 999)) for _ in range(rng.randint(60, 140))]
        if i % 10 == 0:
            words = [w + "#%&*$|" for w in words]
        rows.append((i, " ".join(words), "en", "s"))
    rows.append((999, "few words", "en", "s"))
    got = quality.quality(frame(spark, rows, "doc_id bigint, text string, lang string, source string")).collect()
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert kept == {i for i in range(300) if i % 10}
    assert {r["doc_id"] for r in got if r["base_failed"]} == {999}


def test_one_odd_statistic_is_enough_to_be_rejected(spark):
    rng = random.Random(18)

    def line(n):
        return " ".join(rng.choice("abcdefgh") * rng.randint(3, 7) + str(rng.randint(0, 9999)) for _ in range(n))

    rows = [(i, "\n".join(line(10) for _ in range(rng.randint(6, 12))), "en", "s") for i in range(300)]
    twice = line(4)
    rows += [
        (1000, line(80).replace(" ", " | "), "en", "s"),
        (1001, "\n".join(x for _ in range(4) for x in (twice, line(16))), "en", "s"),
        (1002, "\n".join([line(20) + " " + (again := line(8)), line(30) + " " + again, *[line(10) for _ in range(3)]]), "en", "s"),
    ]
    got = quality.quality(frame(spark, rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert not any(r["base_failed"] for r in got)
    assert {r["doc_id"] for r in got if not r["kept"]} == {1000, 1001, 1002}
    assert abs(quality.consistency(0.75) - 1.4124) < 1e-3 and abs(quality.chi2_below(quality.CUTOFF, quality.DIMS) - 0.999) < 1e-7


def concentrated(x, centre, cov, share):
    """Exact concentration steps to the end: centre, consistent covariance with floors, its determinant."""
    floor = np.array([(f * quality.SCALE) ** 2 for f in quality.FLOORS])

    def floored(c):
        low, d = np.eye(len(c)), np.zeros(len(c))
        for i in range(len(c)):
            for j in range(i):
                low[i, j] = (c[i, j] - (low[i, :j] * low[j, :j] * d[:j]).sum()) / d[j]
            d[i] = max(c[i, i] - (low[i, :i] ** 2 * d[:i]).sum(), floor[i])
        return low @ np.diag(d) @ low.T

    least = np.inf
    for _ in range(100):
        gap = x - centre
        d2 = (gap @ np.linalg.inv(cov) * gap).sum(1)
        near = x[np.argsort(d2, kind="stable")[: int(np.ceil(share * len(x)))]]
        new_centre, new_cov = near.mean(0), floored(quality.consistency(share) * np.cov(near.T, bias=True))
        now = np.linalg.slogdet(new_cov)[1]
        if now >= least - 1e-9:
            break
        least, centre, cov = now, new_centre, new_cov
    return centre, cov, least


def test_scatter_reaches_the_least_determinant_of_many_exact_searches(spark):
    rng = np.random.default_rng(9)
    a = np.concatenate([rng.normal(0, 3000, (400, 5)) @ (np.eye(5) + 0.4), rng.normal(40_000, 500, (100, 5))]).round().astype(int)
    b = np.concatenate([rng.normal([9000, 2000, 500, 0, 0], [2000, 800, 400, 600, 300], (90, 5)), rng.normal(5000, 4000, (20, 5))]).round().astype(int)
    rows = spark.createDataFrame([(g, *map(int, r)) for g, x in (("a", a), ("b", b)) for r in x], "k string, " + ", ".join(f"x{i} bigint" for i in range(5)))
    fitted, n = quality.robust_scatter(rows, ["k"])
    got = {r["k"]: r for r in fitted.collect()}
    assert n == 2
    for g, x in (("a", a), ("b", b)):
        best = None
        for _ in range(60):
            own = x[rng.choice(len(x), 30, replace=False)]
            found = concentrated(x, own.mean(0), np.cov(own.T) + np.eye(5), quality.SHARE)
            best = found if best is None or found[2] < best[2] else best
        centre = np.array([got[g][f"m{i}"] for i in range(5)])
        factor = np.array([[got[g][f"l{i}{j}"] if j <= i else 0 for j in range(5)] for i in range(5)])
        assert abs(2 * np.log(np.diag(factor)).sum() - best[2]) < 0.2  # bins let some more rows in
        exact, own = (((x - c) @ np.linalg.inv(v) * (x - c)).sum(1) > quality.CUTOFF for c, v in ((best[0], best[1]), (centre, factor @ factor.T)))
        assert (exact != own).mean() <= 0.02 and (g == "b" or own[400:].all())


def test_mixture_equals_windows_over_whole_sources(spark):
    rng = random.Random(10)
    rows = [(i, "w " * rng.randint(0, 30), "big" if i % 3 else f"s{i % 7}") for i in range(400)] + [(None, "a b", None), (401, None, "none")]
    docs = frame(spark, rows, "doc_id bigint, text string, source string")
    totals = Counter()
    for _, t, s in rows:
        totals["null" if s is None else "=" + s] += len((t or "").split())
    plan = mixing.plan(dict(totals))
    whole = sum(totals.values())
    assert all(e * totals[s] + r <= mixing.MAX_EPOCHS * totals[s] + 1 for s, (e, r) in plan.items() if totals[s])
    assert abs(sum(e * totals[s] + r for s, (e, r) in plan.items()) - whole) <= len(totals)
    want = Counter()
    for s, (passes, rest) in plan.items():
        own = [(hashlib.md5(f"{mixing.SEED}:{passes}:{'null' if d is None else d}".encode()).hexdigest(), len((t or "").split()), d) for d, t, c in rows if ("null" if c is None else "=" + c) == s]
        spent = 0
        for _, n, d in sorted(own, key=lambda x: x[0]):
            spent += n
            want[d] += passes + (spent <= rest and rest > 0)
    assert Counter(r["doc_id"] for r in mixing.mix(docs).collect()) == +want


def test_many_sources_are_mixed_by_their_totals(spark, monkeypatch):
    """More sources than any table that is broadcast here; sources of one total get the same passes."""
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 20_000).cast("string")).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 5).cast("int")).alias("text"))
    totals = Counter({f"={r[0]}": r[1] for r in docs.groupBy("source").agg(F.sum(F.size(F.array_remove(F.split("text", " "), "")))).collect()})
    plan = mixing.plan(dict(totals))
    monkeypatch.setattr(shared, "BROADCAST_BYTES", 1 << 10)
    got = Counter({f"={r[0]}": r[1] for r in mixing.mix(docs).groupBy("source").agg(F.sum(F.size(F.array_remove(F.split("text", " "), "")))).collect()})
    for s, (passes, rest) in plan.items():
        assert passes * totals[s] <= got[s] <= passes * totals[s] + max(rest, 0)


def test_exponent_meets_the_entropy_and_the_limit():
    totals = {"a": 900, "b": 50, "c": 50}
    alpha = mixing.exponent(totals, 1000, entropy=0.9, max_epochs=100)
    h = -sum(w * np.log(w) for w in mixing.weights(totals, alpha).values())
    assert 0 < alpha < 1 and abs(h - 0.9 * np.log(3)) < 1e-9
    alpha = mixing.exponent(totals, 1000, entropy=1.0, max_epochs=2)
    assert max(1000 * w / totals[s] for s, w in mixing.weights(totals, alpha).items()) == pytest.approx(2)


def test_held_out_accuracy(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = shared.table(spark, sf, "documents"), shared.table(spark, sf, "labels")
    lang = registry.QUERIES["op8_language"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert lang.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98
    toxic = registry.QUERIES["op3_toxicity"](spark, sf).join(labels, "doc_id").where("held_out")
    hit = toxic.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).first()[0]
    assert hit > 0.93


def test_pipeline_stages(spark, sf_dir):
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = shared.cut(stage(spark, docs, sf_dir), "test-stage")
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count() + (docs.count() if name == "mixing" else 0), name
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(last) == docs.count() and all(r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest() for r in last)


@pytest.mark.parametrize("bits", [4, 63])
def test_sets_and_vectors_that_share_half_a_digest_stay_apart(spark, bits):
    """Names of four bits make nearly all names shared: the other half tells them apart."""
    rng = random.Random(bits)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(40)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[i] + " more") for i in range(10)] + [(200 + i, texts[i]) for i in range(5)] + [(300, " ".join(rng.choices(words, k=900)))]
    docs.append((301, docs[-1][1] + " and more"))
    want = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(frame(spark, docs)).collect()}
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(frame(spark, docs), bits=bits).collect()}
    assert got == want and want[300] == want[301] == 300 and all(want[200 + i] == want[100 + i] == i for i in range(5)) and len(set(want.values())) == 41
    vecs = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(60)]
    vecs += [(100 + i, vecs[i][1]) for i in range(10)] + [(200 + i, [2 * x for x in vecs[i][1]]) for i in range(10)]
    links = {r["vec_id"]: (r["component_id"], r["n_links"]) for r in embedding_dup.similar(frame(spark, vecs, "vec_id bigint, embedding array<double>"), bits=bits).collect()}
    assert all(links[200 + i][0] == links[100 + i][0] == i and links[i][1] == 2 for i in range(10)) and len({c for c, _ in links.values()}) == 60


@pytest.mark.parametrize("hub", [2, 1024])
def test_components_with_hubs(spark, monkeypatch, hub):
    monkeypatch.setattr(shared, "HUB", hub)
    rng = random.Random(hub)
    edges = [(0, i) for i in range(1, 60)] + [(70, i) for i in range(71, 120, 2)] + [(i, i + 1) for i in range(200, 240)] + [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(30)] + [(59, 240), (5, 5)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            up[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["node"]: r["component"] for r in shared.components(frame(spark, edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in list(up)}


def test_smaller_batches_of_a_session_stay(spark):
    before = spark.conf.get(shared.BATCH_SETTING, None)
    try:
        for given, kept in ((None, shared.BATCH_BYTES), ("1024", 1024), ("64m", shared.BATCH_BYTES), (str(1 << 30), shared.BATCH_BYTES)):
            spark.conf.unset(shared.BATCH_SETTING)
            if given:
                spark.conf.set(shared.BATCH_SETTING, given)
            shared.bounded_batches(spark)
            assert int(spark.conf.get(shared.BATCH_SETTING)) == kept
    finally:
        spark.conf.set(shared.BATCH_SETTING, before or str(shared.BATCH_BYTES))
