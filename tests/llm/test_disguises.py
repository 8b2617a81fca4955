"""Disguised addresses: recall and precision over generated sentences, with and without an address."""

import random

import pytest

from annoforge.llm import pii

NAMES = "jane john maria peter li anna karl sofia omar nina".split()
LASTS = "doe smith garcia huber rossi dubois kim novak".split()
HOSTS = "example mail acme fastpost northwind contoso uni-ulm lab blue orange".split()
TLDS = "com org net de fr es io edu it nl ch uk se pl ca".split()
LEADS = ["you can reach {}", "mail {}", "please write to {}", "contact: {}", "send it to {}", "my address is {}", "ask {} about it", "it was {} who said so", "{}", "then {} and others"]
TAILS = [" today", ".", ", thanks", "", " or call", " if you can", "\n", " (work)"]
INNOCENT = [
    "we met at paris.fr last year", "meet at noon dot we go on", "let us meet at six dot be there", "look at it dot it moves", "she works at home.So do I", "the dot on the map is at the end of it",
    "they arrived at midnight.We left", "he laughed at us dot no one else did", "stay at work dot so it goes", "at one dot in the plane", "prices start at ten.In may they rise", "we are at risk.It is late",
    "the point at which we stop dot or go on", "good at maths.No doubt", "the best at all.So be it", "open at nine dot am i late", "the punkt at the end", "two at a time dot no more", "once at school.At last", "we aim at first place.Us too",
    "meeting at lunch dot to be sure", "three four five at most dot we count", "sit at dinner dot on time", "the ship at sea.So far away",
]


def address(rng):
    """(text, must it be found): an address with at and dot spelled or in brackets."""
    local = rng.choice([rng.choice(NAMES), f"{rng.choice(NAMES)}.{rng.choice(LASTS)}", f"{rng.choice(NAMES)}{rng.randrange(10, 99)}", f"{rng.choice(NAMES)} dot {rng.choice(LASTS)}", f"{rng.choice(NAMES)}_{rng.choice(LASTS)}"])
    host, last = rng.choice(HOSTS), rng.choice(TLDS)
    style = rng.choice(["at dot", "[at] [dot]", "(at) .", "at .", "arroba punto", "[at] dot", "AT DOT"])
    at, dot = style.split(" ")
    at = f" {at} "
    dot = "." if dot == "." else f" {dot} "
    sub = f"{rng.choice(HOSTS)}{dot}" if rng.random() < 0.2 else ""
    return local + at + sub + host + dot + last, style, local


def measure(pii, n, seed=5):
    """(found, missed, found where there is nothing or more than there is, clean sentences left alone)."""
    rng, hit, miss, extra, clean = random.Random(seed), 0, 0, 0, 0
    for _ in range(n):
        text, style, local = address(rng)
        lead = rng.choice(LEADS)
        if style == "at ." and not (any(c in "._" or c.isdigit() for c in local) or " dot " in local) and lead in ("it was {} who said so", "{}", "then {} and others"):
            lead = "mail {}"  # a bare at before a plain domain says nothing by itself
        before, after = lead.split("{}")
        whole = f"{before}{text}{rng.choice(TAILS)}{after}"
        spans = [(whole[a:b], k) for a, k, b in pii.disguised(whole, pii.detect(whole)) if pii.KINDS[k] == "email"]
        hit += (text, pii.KINDS.index("email")) in spans
        miss += (text, pii.KINDS.index("email")) not in spans
        extra += sum(s != text for s, _ in spans)
    for text in INNOCENT:
        for lead in ("", "so ", "I think that ", "we heard. "):
            found = pii.disguised(lead + text, pii.detect(lead + text))
            extra += len(found)
            clean += not found
    return hit, miss, extra, clean


# --- tests


def test_recall_and_precision_of_disguised_addresses():
    hit, miss, extra, clean = measure(pii, 3000)
    assert hit / (hit + miss) >= 0.97 and hit / (hit + extra) >= 0.97 and clean >= 0.97 * 4 * len(INNOCENT)


@pytest.mark.parametrize("text", INNOCENT)
def test_common_phrases_hold_no_address(text):
    assert pii.disguised(text, pii.detect(text)) == []


@pytest.mark.parametrize(
    ("text", "span"),
    [
        ("jane at mail dot it today", "jane at mail dot it"), ("jane dot doe at example dot com", "jane dot doe at example dot com"), ("write jane at paris.fr", "jane at paris.fr"),
        ("x jane.doe at lab.uni-ulm.de y", "jane.doe at lab.uni-ulm.de"), ("a dot b dot c at x dot org", "a dot b dot c at x dot org"),
    ],
)
def test_evidence_decides_on_bare_words(text, span):
    assert [text[a:b] for a, k, b in pii.disguised(text, pii.detect(text)) if pii.KINDS[k] == "email"] == [span]
