"""The queries over whole small tables, and every stage of the pipeline, against plain versions."""

import hashlib
import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
import public_tokenizers as P
from annoforge.llm import byte_bpe, language, line_dedup, mixing, registry, shared, toxicity
from annoforge.llm.vocabularies import vocabulary
from tests.llm.test_spark import shingles, smallest_linked
from tests.llm.test_units import plain


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in shared.table(spark, sf_dir, "documents").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def bpe():
    import tiktoken

    with open(vocabulary("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(f.read()), special_tokens={})


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_token_counts_of_documents(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = {r["doc_id"]: r for r in registry.QUERIES["op1_token_counts"](spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((t or "").encode()), n > 2048)


def test_byte_level_ids_of_documents(spark, sf_dir, texts, bpe):
    got = {r["doc_id"]: r for r in registry.QUERIES["op9_byte_bpe"](spark, sf_dir).collect()}
    for i, t in texts.items():
        ids = bpe.encode_ordinary(t or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode()))


def test_plain_personal_data_of_documents(spark, sf_dir, texts):
    kinds = ("email", "ip", "card", "phone")
    got = {r["doc_id"]: r for r in registry.QUERIES["op7_pii"](spark, sf_dir).collect()}
    for i, t in texts.items():
        spans = sorted(plain(t or ""))
        assert got[i]["base_sha256"] == sha(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode())
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert {f"{kinds[k]}:{a}:{b}" for a, k, b in spans} <= set(got[i]["spans"].split(","))


def test_statistics_of_documents(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in registry.QUERIES["op10_quality"](spark, sf_dir).collect()}
    for i, t in texts.items():
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        again = {p for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(again) > 20 * len(w)) and not (r["base_failed"] and r["kept"])


def letters(text):
    return [w.lower() for w in re.findall(rb"[A-Za-z\x80-\xff]+", (text or "").encode())]


def passes(field, words):
    """Marginals by forward and backward sums, one position after the other."""
    if not words:
        return []
    buckets = toxicity.features(pa.array(words, pa.large_binary()))
    emit = np.clip(field.weights[buckets].sum(1) + field.bias, -30, 30)
    t, n = np.exp(field.trans), len(words)
    forward, backward = np.zeros((n, 2)), np.ones((n, 2))
    for k in range(n):
        before = np.array([1, math.exp(field.begin)]) if not k else forward[k - 1] @ t
        forward[k] = before * [1, math.exp(emit[k])]
        forward[k] /= forward[k].sum()
    for k in range(n - 2, -1, -1):
        backward[k] = t @ (backward[k + 1] * [1, math.exp(emit[k + 1])])
        backward[k] /= backward[k].sum()
    both = forward * backward
    return (both[:, 1] / both.sum(1)).tolist()


def toxic_score(field, text):
    p = passes(field, letters(text))
    x = [1, math.log(1e-4 + sum(p)), max(p, default=0.0), math.log1p(len(p)) / 10]
    return 1 / (1 + math.exp(-min(30, max(-30, float(np.dot(x, field.logistic))))))


@pytest.fixture(scope="module")
def field(spark, sf_dir):
    return toxicity.learn(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels").where(~toxicity.held_out()))


def test_toxicity_equals_sequential_passes(spark, sf_dir, texts, field):
    got = {r["doc_id"]: r for r in toxicity.tag(shared.table(spark, sf_dir, "documents"), field).collect()}
    for i, t in texts.items():
        assert got[i]["score"] == pytest.approx(toxic_score(field, t), abs=1e-6)


def word_likelihoods(logp, text):
    """Likelihoods of a text's words under each language, by rows, up to a factor a word."""
    scores = []
    for w in letters(text):
        own = b"\x01" + w + b"\x01"
        codes = [own[k] | own[k + 1] << 8 | own[k + 2] << 16 for k in range(len(own) - 2)]
        scores.append(sum(logp[((c * 2654435761) % (1 << 32) >> 17) % language.BUCKETS] for c in codes))
    scores = np.array(scores)
    return np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60))


def penalised(like, shares, penalty=1.0):
    return np.log(np.maximum(like @ shares, 1e-30)).sum() - penalty * (shares > 0).sum() * math.log(len(like) + 1)


def best_set(like):
    """The best penalised likelihood of any set of languages, each set's own proportions maximised by many rounds from
    even ones, and those proportions."""
    n, found = like.shape[1], []
    for size in range(1, n + 1):
        for langs in itertools.combinations(range(n), size):
            shares = np.zeros(n)
            shares[list(langs)] = 1 / size
            for _ in range(3000 if size > 1 else 0):
                part = like * shares
                shares = (part / np.maximum(part.sum(axis=1, keepdims=True), 1e-300)).mean(axis=0)
            shares[shares < 1e-12] = 0
            found.append((penalised(like, shares), shares))
    return max(found, key=lambda x: x[0])


def test_language_sets_have_the_best_penalised_likelihood_of_all_sets(spark, sf_dir, texts):
    docs = shared.table(spark, sf_dir, "documents")
    langs, logp = language.learn(docs.where(~language.held_out()))
    own = [(i, texts[i]) for i in sorted(texts)[:60] if letters(texts[i]) and len(texts[i]) < 20_000]
    parts = {g: " ".join((r["text"] or "")[:600] for r in docs.where(docs.lang == g).limit(3).collect()) for g in langs}
    mixed = [(1000 + k, " ".join(p[: int(600 * x)] for p, x in zip(parts.values(), shares))) for k, shares in enumerate([(1, 1, 0, 0), (1, 0.2, 0, 0), (0, 1, 0.5, 1), (1, 1, 1, 1), (0.05, 1, 0, 0), (0, 0, 0.03, 1)])]
    given = own + mixed
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(given, "doc_id bigint, text string"), (langs, logp)).collect()}
    several = 0
    for i, text in given:
        like, row = word_likelihoods(logp, text), got[i]
        want, shares = best_set(like)
        have = np.array([row["proportions"].get(g, 0.0) for g in langs])
        assert penalised(like, have) >= want - 2e-3 * len(like), i
        first, second = sorted(shares)[-1:-3:-1]
        assert first - second < 0.05 or (row["lang_pred"] == langs[int(shares.argmax())] and row["score"] == pytest.approx(first, abs=0.03)), i
        several += (have > 0).sum() > 1
    assert several >= 4


def test_a_set_counts_with_its_own_proportions():
    """The first two of three languages explain all words, once their proportions are estimated without the third."""
    like = np.array([[1, 1e-9, 0.9]] * 30 + [[1e-9, 1, 0.9]] * 30 + [[1, 1e-9, 1e-9]] * 2)
    shares = language.mixtures(np.log(like), np.array([0, len(like)]), 1.0)[0]
    assert penalised(like, shares) >= best_set(like)[0] - 1e-2


def test_learned_languages_are_bounded_by_a_parameter(spark):
    rows = [(i, f"word{i} other", f"l{i}") for i in range(40)] + [(100 + i, "the river", "en") for i in range(5)] + [(200 + i, "der fluss", "de") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert language.learn(docs, most=2)[0] == ["de", "en"] and language.learn(docs, most=3)[0] == ["de", "en", "l0"]


def kept_lines(docs):
    """Texts without lines that have an equal or similar one earlier, by all pairs of lines whose characters nearly agree."""
    edits, seen, counts, out = line_dedup.allowed(), [], np.zeros((0, 64), np.int16), {}
    exact = set()
    for i in sorted(docs):
        if docs[i] is None:
            out[i] = None
            continue
        kept, lost = [], False
        for line in docs[i].split("\n"):
            if not line or (len(line) < line_dedup.CHARS_PER_EDIT and not re.search(r"\w", line)):
                kept.append(line)
                continue
            late, k = line in exact, edits(len(line))
            if not late and k:
                own = np.bincount([ord(c) & 63 for c in line], minlength=64).astype(np.int16)
                near = np.flatnonzero(np.abs(counts - own).sum(1) <= 2 * k)
                pairs = [(line_dedup.points_of(line), line_dedup.points_of(seen[j])) for j in near]
                late = line_dedup.similar(pairs, [edits(min(len(line), len(seen[j]))) for j in near]).any() if pairs else False
                seen.append(line)
                counts = np.concatenate([counts, own[None]])
            exact.add(line)
            lost |= bool(late)
            if not late:
                kept.append(line)
        out[i] = "\n".join(kept)
        if lost and not out[i].strip():
            del out[i]
    return out


def test_pipeline_equals_plain_stages(spark, sf_dir, texts, field, bpe):
    sources = {r["doc_id"]: r["source"] for r in shared.table(spark, sf_dir, "documents").select("doc_id", "source").collect()}
    docs = {i: t for i, t in texts.items() if toxic_score(field, t) < 0.3}
    assert 0 < len(docs) < len(texts)
    docs = kept_lines(docs)
    sets = {i: shingles(t) for i, t in docs.items()}
    of, links = {}, []
    for i in sorted(sets):
        for g in sets[i]:
            of.setdefault(g, []).append(i)
    shared_ = Counter((a, b) for own in of.values() for x, a in enumerate(own) for b in own[x + 1 :])
    links = [(a, b) for (a, b), n in shared_.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    low = smallest_linked(sorted(sets), links)
    docs = {i: t for i, t in docs.items() if low[i] == i}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs.items()}
    key = {i: "null" if sources[i] is None else "=" + sources[i] for i in docs}
    totals = Counter()
    for i in docs:
        totals[key[i]] += size[i]
    copies = Counter()
    for s, (whole, rest) in mixing.plan(dict(totals)).items():
        spent = 0
        for i in sorted((i for i in docs if key[i] == s), key=lambda i: hashlib.md5(f"{mixing.SEED}:{whole}:{i}".encode()).hexdigest()):
            spent += size[i]
            copies[i] += whole + (spent <= rest and rest > 0)
    want = Counter()
    for i, n in copies.items():
        ids = bpe.encode_ordinary(docs[i] or "")
        want[(i, len(ids), tuple(ids), sha((docs[i] or "").encode()))] += n
    got = Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"]), r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == +want
