"""Personal data in texts, plain and disguised, with offsets in the source.

Plain spans come from the source text. For disguised ones, transducers rewrite the text while each written
character keeps the source range it stands for: look-alike characters to ASCII, spelled digits to digits,
spelled or bracketed at and dot to @ and full stop. The same detectors read the rewritten text; a span that
holds a rewritten character maps back to the source and is added if it overlaps no plain span of its kind.

Every step takes time linear in the text: words that may stand for at, dot or a digit are found first, and what
stands beside them is read outwards from there, each gap once.

Results: null and empty texts have no span. Offsets are code points, ends exclusive; spans go by start, then
kind in the order of KINDS. Ids may be null or repeat: one output row per input row.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.llm.shared import bounded_batches, named, table

KINDS = ("email", "ip", "card", "phone")

# The patterns that define plain spans.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TWICE = {str(d): (2 * d - 9 if d > 4 else 2 * d) for d in range(10)}


def luhn(digits: str) -> bool:
    return (sum(map(int, digits[-1::-2])) + sum(_TWICE[d] for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the mail pattern: at each @, the longest local part before and domain after.

    A local part that is not followed by @ and a domain fails from each of its characters, so that only
    the places of @ need a look and the time is linear in the text."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := DOMAIN.match(text, at + 1)):
            out.append((begin, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every plain span, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text) is None:
        return out
    for m in IP.finditer(text):
        if all(len(q := p.lstrip("0")) <= 3 and int(q or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


DIGIT = re.compile(r"[0-9]")

# Characters that look like ASCII ones, and the ASCII ones in the same order.
LOOK_ALIKES = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТХІЈЅαονρυικΑΒΕΗΙΚΜΝΟΡΤΧΥΖ․﹒。．＠﹫＋﹢‐‑‒–−－", "aeopcyxijshdqwABEKMHOPCTXIJSaovpuikABEHIKMNOPTXYZ....@@++------", strict=True))
LOOK_ALIKES |= {chr(0xFF10 + d): str(d) for d in range(10)}
LOOK_ALIKES |= {chr(first + d): str(d) for first in (0x0660, 0x06F0, 0x0966) for d in range(10)}
LOOK_ALIKES |= {chr(0xFF21 + i): chr(65 + i) for i in range(26)} | {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
LOOK_ALIKES |= {chr(0x1D7CE + d): str(d % 10) for d in range(50)}
#: Characters without width, left out of the rewritten text.
NO_WIDTH = "­​‌‍⁠﻿"
LOOK = re.compile("[" + "".join(map(re.escape, [*LOOK_ALIKES, *NO_WIDTH])) + "]")

# Words for the digits 0 to 9 in four languages, and for at, dot and plus.
DIGIT_WORDS = {
    w: str(d)
    for d, ws in enumerate(
        ["zero oh null cero zéro", "one eins uno un une", "two zwei zwo dos deux", "three drei tres trois", "four vier cuatro quatre", "five fünf cinco cinq", "six sechs seis", "seven sieben siete sept", "eight acht ocho huit", "nine neun nueve neuf"]
    )
    for w in ws.split()
}
AT_WORDS, DOT_WORDS, PLUS_WORDS = "at arroba arobase ät", "dot punkt punto point", "plus más mas"
#: Last labels that speak for an address. Any other of two letters does as well.
LAST_LABELS = "com org net edu gov io info biz co uk us de fr es eu ch at test example"
#: Words around an address, words that stand before a common `at`, and words that stand after it.
CUES = "mail email e-mail mails emails address contact contacts reach write ask ping send sent user account me via"
BEFORE_AT = "meet met meeting look looks looked looking arrive arrived stay stayed work works worked live lives lived be been is was were are am us it up here there start starts started end ends ended begin began open opens opened close closes closed eat ate sit sat stand stood laugh laughed aim aimed good bad best not or and"
AFTER_AT = "noon midnight night home work least most once all first last the a an this that these those any one two three four five six seven eight nine ten our my your his her their its school lunch dinner present large random times sea war ease risk hand"
#: What an address with a bare `at` must score.
ENOUGH = 3
#: Fixed value: a domain name has at most so many labels.
MOST_LABELS = 127

_words = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_at, _dot, _plus = ("|".join(x.split()) for x in (AT_WORDS, DOT_WORDS, PLUS_WORDS))
LAST, CUE, BEFORE, AFTER, DOTS = (frozenset(x.split()) for x in (LAST_LABELS, CUES, BEFORE_AT, AFTER_AT, DOT_WORDS))
BRACKETED = re.compile(rf"[\[({{<]\s*(?:(?P<at>{_at}|@)|(?P<dot>{_dot}|\.)|(?P<dash>dash|minus))\s*[\])}}>]", re.I)
#: Digits, spelled or not, and the words that may stand before or between them.
DIGIT_TOKEN = re.compile(rf"\b(?:(?P<word>{_words})|(?P<dot>{_dot})|(?P<plus>{_plus}))\b|(?P<digits>[0-9]+)|(?P<sign>\+)", re.I)
SPELLED_WORD = re.compile(rf"\b(?:{_words}|{_dot}|{_plus})\b", re.I)
#: What may stand between the digits of a number besides dot words.
BETWEEN = re.compile(r"[\s(),.-]*")
#: A bare word or a sign between the two parts of an address.
AT_TOKEN = re.compile(rf"(?<=\s)(?P<word>{_at})(?=\s)|@", re.I)
LABEL = re.compile(r"[\w-]+")
NEXT_LABEL = re.compile(rf"(?P<word>\s+(?:{_dot})\s+)(?P<a>[\w-]+)|\s*\.\s*(?P<b>[\w-]+)", re.I)
_LOCAL_END = re.compile(r"[\w.%+-]")


class Rewritten:
    """A text under rewriting; lo and hi give the source range of each character, new marks written ones."""

    def __init__(self, text: str):
        self.text, self.new = text, bytearray(len(text))
        self.lo, self.hi = array("i", range(len(text))), array("i", range(1, len(text) + 1))

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Each (start, end, text), in order and apart, becomes the text; it stands for the whole range."""
        if not edits:
            return
        text, lo, hi, new, done = [], array("i"), array("i"), bytearray(), 0
        for a, b, to in edits:
            text += (self.text[done:a], to)
            lo += self.lo[done:a]
            hi += self.hi[done:a]
            lo.extend([self.lo[a]] * len(to))
            hi.extend([self.hi[b - 1]] * len(to))
            new += self.new[done:a] + b"\x01" * len(to)
            done = b
        self.text = "".join(text) + self.text[done:]
        lo += self.lo[done:]
        hi += self.hi[done:]
        self.lo, self.hi, self.new = lo, hi, new + self.new[done:]


def look_alikes(r: Rewritten) -> None:
    r.replace([(m.start(), m.end(), LOOK_ALIKES.get(m[0], "")) for m in LOOK.finditer(r.text)])


def around(text: str, a: int, b: int, least: int) -> tuple[int, int]:
    """The range with the white space on both sides, from `least` on."""
    while a > least and text[a - 1].isspace():
        a -= 1
    while b < len(text) and text[b].isspace():
        b += 1
    return a, b


def bracketed(r: Rewritten) -> None:
    edits, done = [], 0
    for m in BRACKETED.finditer(r.text):
        a, done = around(r.text, m.start(), m.end(), done)
        edits.append((a, done, "@" if m["at"] else "." if m["dot"] else "-"))
    r.replace(edits)


def number_runs(text: str) -> Iterator[list[re.Match]]:
    """Runs of at least four digits, with what may stand between and a plus before, of which something is a word."""
    run: list[re.Match] = []
    for m in DIGIT_TOKEN.finditer(text):
        joined = bool(run) and BETWEEN.fullmatch(text, run[-1].end(), m.start()) is not None
        if joined and (run[-1]["plus"] or run[-1]["sign"]):
            joined = text[run[-1].end() : m.start()].strip() == "" and not m["dot"]
        if not joined or m["plus"] or m["sign"]:
            yield from spelled(run)
            run = []
        if run or not m["dot"]:
            run.append(m)
    yield from spelled(run)


def spelled(run: list[re.Match]) -> Iterator[list[re.Match]]:
    while run and run[-1]["dot"]:
        run.pop()
    if any(m["word"] or m["plus"] or m["dot"] for m in run) and sum(1 if m["word"] else len(m["digits"] or "") for m in run) >= 4:
        yield run


def spelled_digits(r: Rewritten) -> bool:
    """Whether a number was spelled."""
    edits, done = [], 0
    for run in number_runs(r.text):
        for m in run:
            if m["digits"] or m["sign"]:
                done = m.end()
                continue
            if m["word"]:
                a, b, to = m.start(), m.end(), DIGIT_WORDS[m["word"].lower()]
            elif m["dot"]:
                (a, b), to = around(r.text, m.start(), m.end(), done), "."
            else:
                a, b, to = m.start(), around(r.text, m.start(), m.end(), m.start())[1], "+"
            edits.append((a, b, to))
            done = b
    r.replace(edits)
    # digits that were words go together where only one blank stands between two of them
    if edits:
        r.replace([(m.start(), m.end(), "") for m in re.finditer(r"(?<=[0-9]) (?=[0-9])", r.text) if r.new[m.start() - 1] and r.new[m.end()]])
    return bool(edits)


def token_before(text: str, at: int, least: int) -> int:
    """Where the run of characters of a local part that ends at `at` begins, from `least` on."""
    while at > least and _LOCAL_END.match(text[at - 1]):
        at -= 1
    return at


def local_part(text: str, at: int, least: int) -> tuple[int, list[tuple[int, int, str]]]:
    """Where the local part that ends at `at` begins, spelled dots in it included, and the edits that write those."""
    edits, begin = [], token_before(text, at, least)
    while True:
        gap = begin
        while gap > least and text[gap - 1].isspace():
            gap -= 1
        dot = token_before(text, gap, least)
        end = dot
        while end > least and text[end - 1].isspace():
            end -= 1
        first = token_before(text, end, least)
        if not (gap < begin and end < dot and first < end and text[dot:gap].lower() in DOTS):
            return begin, edits[::-1]
        edits.append((end, begin, "."))
        begin = first


def evidence(text: str, begin: int, at: int, least: int, first_label: str, dotted: bool) -> int:
    """What speaks for an address whose sign is the bare word `at`; besides, a spelled dot in its domain counts 2, and a
    last label that speaks for it 1."""
    local, score = text[begin:at].lower(), 0
    if dotted or any(c in "._+-" or c.isdigit() for c in local):
        score += 2
    where, words = begin, []
    for _ in range(3):
        while where > least and not _LOCAL_END.match(text[where - 1]) and text[where - 1] != "\n":
            where -= 1
        start = token_before(text, where, least)
        words.append(text[start:where].lower())
        where = start
    score += 2 * any(w in CUE for w in words)
    return score - 2 * (local in BEFORE) - 2 * (first_label in AFTER)


def address(text: str, m: re.Match, least: int, written: bool = False) -> list[tuple[int, int, str]]:
    """The edits that make an address of what stands around an at word or sign; none if it is no address. written: the
    sign is one that an earlier step wrote."""
    a, b = around(text, m.start(), m.end(), least)
    if not a or not _LOCAL_END.match(text[a - 1]) or not (label := LABEL.match(text, b)):
        return []
    bare = bool(m["word"]) and m["word"].lower() == "at"  # other words for it have no other use
    begin, before = local_part(text, a, least) if m["word"] or written else (token_before(text, a, least), [])
    edits = [*before, *([(a, b, "@")] if (a, b) != (m.start(), m.end()) or m["word"] else [])]
    at, good, spelled_dot, score = label.end(), None, False, None
    for _ in range(MOST_LABELS):
        if not (more := NEXT_LABEL.match(text, at)):
            break
        at, name = more.end(), (more["a"] or more["b"]).lower()
        if more["word"]:
            edits.append((*more.span("word"), "."))
            spelled_dot = True
        if bare:
            if name in LAST or (len(name) == 2 and name.isalpha()):
                score = evidence(text, begin, a, least, label[0].lower(), bool(before)) if score is None else score
                good = len(edits) if score + 1 + 2 * spelled_dot >= ENOUGH else good
        elif name in LAST or (len(name) > 1 and name.isalpha()):
            good = len(edits)
    return edits[:good] if good is not None else []


def spelled_mail(r: Rewritten) -> None:
    edits, done = [], 0
    for m in AT_TOKEN.finditer(r.text):
        if m.start() >= done and (own := address(r.text, m, done, bool(r.new[m.start()]))):
            edits += own
            done = own[-1][1]
    r.replace(edits)


def disguised(text: str, plain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that appear only after rewriting, in source offsets."""
    odd = not text.isascii() and LOOK.search(text) is not None
    r = None
    if odd:
        look_alikes(r := Rewritten(text))
    now = r.text if r else text
    # each step may write what the next one reads
    if BRACKETED.search(now):
        bracketed(r := r or Rewritten(text))
        now = r.text
    if SPELLED_WORD.search(now) and next(number_runs(now), None):
        spelled_digits(r := r or Rewritten(text))
        now = r.text
    if any(address(now, m, 0, bool(r and r.new[m.start()])) for m in AT_TOKEN.finditer(now)):
        spelled_mail(r := r or Rewritten(text))
    if r is None:
        return []
    out, of_kind = [], [[(x, y) for x, k, y in plain if k == kind] for kind in range(len(KINDS))]
    for a, kind, b in detect(r.text):
        if 1 in r.new[a:b] or r.hi[b - 1] - r.lo[a] != b - a:
            lo, hi = r.lo[a], r.hi[b - 1]
            while lo < hi and text[lo].isspace():
                lo += 1
            while hi > lo and text[hi - 1].isspace():
                hi -= 1
            own = of_kind[kind]  # in order and apart: only the last that starts before hi can overlap
            i = bisect_left(own, (hi,)) - 1
            if i < 0 or own[i][1] <= lo:
                out.append((lo, kind, hi))
    return out


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id, spans (kind, start, end, plain), sorted."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kind_ = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                plain = detect(text) if text else []
                more = disguised(text, plain) if text else []
                both = sorted([(*s, True) for s in plain] + [(*s, False) for s in more])
                found.append([{"kind": KINDS[k], "start": a, "end": b, "plain": p} for a, k, b, p in both])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, span)], [id_col, "spans"])

    return docs.select(named(id_col), named(text_col)).mapInArrow(run, f"`{id_col}` {kind_}, spans array<struct<kind:string,start:bigint,end:bigint,plain:boolean>>")


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every text of documents; the counts and the digest are of plain spans."""
    found = find_pii(table(spark, sf_dir, "documents"))
    plain = F.filter("spans", lambda s: s["plain"])

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["plain"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(F.encode(shown(plain), "UTF-8"), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(plain)).cast("long").alias("n_disguised"),
    )
