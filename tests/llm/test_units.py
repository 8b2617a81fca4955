"""The text operators' parts against libraries and brute force on generated texts."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest

from annoforge.llm import language, pii, toxicity
from annoforge.llm.byte_bpe import ByteBpe, RankQueue, read_ranks
from annoforge.llm.token_counts import Counter as TokenCounter

PARTS = [*"ab  '\n\t  stredlmvSé9²Ω漢!?-.<|>x", "'s", "'re", "  ", "aaaa", "\x1c", "́", "İ", "Σ"]


def texts(n=4000, seed=1):
    rng = random.Random(seed)
    made = ["".join(rng.choices(PARTS, k=rng.randint(0, 60))) for _ in range(n)]
    return [*made, "", None, "a" * 5000, "ab" * 3000, " " * 500 + "x", "<|endoftext|> hi <|startoftext|>"]


@pytest.fixture(scope="module")
def ranks():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return f.read()


def test_queue_pops_ranks_in_order():
    queue, rng = RankQueue(50_000), random.Random(3)
    pushed = [(rng.randrange(50_000), i) for i in range(3000)]
    for rank, i in pushed:
        queue.push(rank, i)
    out = []
    while queue.top:
        rank, positions = queue.pop()
        out += [(rank, i) for i in positions]
    assert out == sorted(pushed)


def test_byte_bpe_equals_library_and_decodes(ranks):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(ranks), special_tokens={})
    bpe, made = ByteBpe(ranks, cache_pieces=500), texts()
    ids = bpe.encode(pa.array(made))
    assert ids.to_pylist() == [library.encode_ordinary(t or "") for t in made]
    assert bpe.decode(ids).to_pylist() == [(t or "").encode() for t in made]


def test_token_counts_equal_library():
    from tokenizers import Tokenizer

    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        raw = f.read()
    made = texts(seed=4)
    first = TokenCounter(raw, {})
    frequent = {p: n for _, _, _, distinct, _ in first.split(pa.array(made[::3])) for p, n in zip(distinct.to_pylist(), first.encode(distinct.to_pylist()))}
    counter = TokenCounter(raw, frequent, cache_pieces=500)
    n_bytes, n_tokens = counter.count(pa.array(made))
    want = Tokenizer.from_str(raw).encode_batch([t or "" for t in made], add_special_tokens=False)
    assert n_tokens.tolist() == [len(e.ids) for e in want]
    assert n_bytes.tolist() == [len((t or "").encode()) for t in made]


def plain(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_plain_spans_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choices("aab@@..-_+ 0123456789()\né", k=rng.randint(0, 45)))
        assert pii.detect(text) == plain(text)
    assert pii.detect("a" * 200_000 + "1" * 200_000) == []


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail bob at example dot com now", "email", "bob at example dot com"),
        ("bob [at] mail (dot) example [dot] org.", "email", "bob [at] mail (dot) example [dot] org"),
        ("x аlice@exаmple.com y", "email", "аlice@exаmple.com"),
        ("call plus four four two zero seven nine four six zero nine", "phone", "plus four four two zero seven nine four six zero nine"),
        ("ip one nine two dot one six eight dot one dot one ok", "ip", "one nine two dot one six eight dot one dot one"),
        ("card ４１１１ 1111 1111 1111.", "card", "４１１１ 1111 1111 1111"),
    ],
)
def test_disguised_spans_map_back(text, kind, span):
    assert [(pii.KINDS[k], text[a:b]) for a, k, b in pii.disguised(text, pii.detect(text))] == [(kind, span)]


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("write to jane.doe at example.com", "email", "jane.doe at example.com"),
        ("jane at example\ndot\ncom", "email", "jane at example\ndot\ncom"),
        ("call +44 20 seven 946 0958", "phone", "+44 20 seven 946 0958"),
        ("call plus 44 20 7946 0958", "phone", "plus 44 20 7946 0958"),
        ("card 4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"),
        ("ip 192 dot 168 dot 1 dot 1", "ip", "192 dot 168 dot 1 dot 1"),
    ],
)
def test_one_disguised_part_is_enough(text, kind, span):
    assert (kind, span) in [(pii.KINDS[k], text[a:b]) for a, k, b in pii.disguised(text, pii.detect(text))]


def test_clean_text_has_no_disguised_span():
    for text in ["look at the dot on the wall, two three four five", "at one point, meet us at noon", "nineteen men at work", "Die Punkt zwei drei vier fünf sechs sieben acht neun"]:
        assert pii.disguised(text, []) == []


def test_field_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    emit, trans, begin = np.exp(rng.normal(size=9)), rng.normal(size=(2, 2)), 0.4
    bounds = np.array([0, 4, 4, 9])
    first = np.zeros(9, bool)
    first[[0, 4]] = True
    u, v = toxicity.odds_passes(emit, first, np.append(first[1:], True), trans, begin)
    got = u * v / (1 + u * v)
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        total, one = 0.0, np.zeros(hi - lo)
        for code in range(2 ** (hi - lo)):
            y = [code >> i & 1 for i in range(hi - lo)]
            w = np.prod([emit[lo + i] for i in range(hi - lo) if y[i]]) * np.exp(sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)) + begin * (y[0] if y else 0))
            total += w
            one += w * np.array(y)
        assert np.allclose(got[lo:hi], one / total)


def test_field_learns_toxic_words():
    rng = random.Random(6)
    made, toxic = [], []
    for i in range(300):
        words = rng.choices(["calm", "river", "stone", "light", "under", "green", "walks"], k=40)
        if i % 5 == 0:
            words[rng.randrange(40)] = words[rng.randrange(40)] = rng.choice(["vilenorm", "vilexact"])
        made.append(" ".join(words))
        toxic.append(int(i % 5 == 0))
    field = toxicity.fit_field(made, np.array(toxic), 0.2)
    codes, distinct, bounds, _, _ = toxicity._tokens(pa.array(["green river walks", "a vilething under stone", "", None], pa.large_string()))
    p = field.marginals(toxicity.features(distinct), codes, bounds)[0]
    scores = field.scores(p, bounds)
    assert scores[0] < 0.3 < scores[1] and scores[2] < 0.3 and scores[3] < 0.3
    assert (p > 0.5).sum() == 1


def test_field_without_both_classes_scores_the_share():
    field = toxicity.fit_field(["a b"], np.array([0]), 0.0)
    assert field.scores(np.zeros(0), np.array([0, 0]))[0] < 0.01


def test_mixture_finds_two_languages():
    en, de = "the river that walks with them ", "der schnelle bach und die schwarze nacht "
    langs, counts = ["de", "en"], np.full((language.BUCKETS, 2), 0.5)
    for j, t in enumerate((de, en)):
        codes, distinct, _ = language._words(pa.array([t], pa.large_string()))
        buckets, _ = language.trigrams(*language.pieces.bytes_of(distinct))
        np.add.at(counts[:, j], buckets, 5)
    model = np.log(counts / counts.sum(axis=0))
    codes, distinct, bounds = language._words(pa.array([en * 3, de * 3, en * 3 + de, ""], pa.large_string()))
    shares = language.mixtures(language.likelihoods(distinct, model)[codes], bounds, 1.0)
    assert shares[0].tolist() == [0, 1] and shares[1].tolist() == [1, 0]
    assert 0.2 < shares[2][0] < 0.4 and len(langs) == shares.shape[1]


def test_letter_runs_count_words():
    codes, distinct, bounds = language._words(pa.array(["Ab ab, x9y é", None, "--"], pa.large_string()))
    assert Counter(distinct.take(pa.array(codes)).to_pylist()) == Counter([b"ab", b"ab", b"x", b"y", "é".encode()])
    assert np.diff(bounds).tolist() == [5, 0, 0]
