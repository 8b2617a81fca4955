"""Conversation repair against a plain search over all edits, on odd rows and on conversations of many blocks."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from annoforge.llm import conversations as C
from annoforge.llm import registry, shared

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, letters, repaired lines) of rows (role, text, fault), least cost and then least letters, by recursion
    over all edits."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))

        def add(letter, cost, lines, rest):
            found.append((rest[0] + cost, letter + rest[1], lines + rest[2]))

        if inserts < 3:
            nxt = follow[state]
            add("I", 2, (f"{names[nxt]}:",), best(i, nxt, inserts + 1))
        if i < len(rows):
            role, text, fault = rows[i]
            add("D", 3, (), best(i + 1, state, 0))
            if fault not in ("blank", "duplicate"):
                more, nxt = fault == "truncated", follow[state]
                add("R", 2 + more, (f"{names[nxt]}:{text}",), best(i + 1, nxt, 0))
                if role[:1] == nxt or (role[:1], state) == ("s", ""):
                    add("K", more, (f"{role}:{text}",), best(i + 1, role[0], 0))
        return min(found, default=(1 << 30, "", ()))

    return best(0, "", 0)


def plain(rows):
    """Report of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, marked = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANK)
        marked.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""))
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    cost, letters, lines = cheapest(tuple(marked))
    faults = [m[2] for m in marked]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
        "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False)), "cost": cost, "audit": letters, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def same(report, rows):
    by_id = {}
    for c, *rest in rows:
        by_id.setdefault(c, []).append(tuple(rest))
    got = {r["conv_id"]: r.asDict() for r in report.collect()}
    assert got == {c: {"conv_id": c} | plain(x) for c, x in by_id.items()}


def odd_rows(seed, n, conversations):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "student"], ["Yes.", "No!", "Why?", "cut", "", " \t", None, "a.\n", "x. ", "éè."]
    return [(rng.choice(conversations), rng.choice([None, *range(6)]), rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], rng.choice(texts) if rng.random() < 0.5 else f"t{rng.randrange(30)}.") for _ in range(n)]


def test_reports_equal_a_plain_search(spark):
    rows = odd_rows(1, 400, [None, *range(60)])
    report, edited = C.repair(spark.createDataFrame([(*r, "k", "p") for r in rows], SCHEMA + ", key string, position string"))
    same(report, rows)
    assert edited.where("edit <> 'I'").count() == len(rows)


@pytest.mark.parametrize(("bits", "ranges"), [(1, 7), (2, 40)])
def test_long_conversations_are_cut_in_blocks(spark, monkeypatch, bits, ranges):
    monkeypatch.setattr(C, "BITS", bits)
    monkeypatch.setattr(C, "RANGE_ROWS", ranges)
    rows = odd_rows(2 + bits, 90, [1, 1, 1, 2, 3]) + [(9, 1, "user", "again.")] * 20
    same(C.repair(spark.createDataFrame(rows, SCHEMA))[0], rows)


def test_no_rows(spark):
    report, edited = C.repair(spark.createDataFrame([], SCHEMA))
    assert report.count() == 0 and edited.count() == 0


def test_repaired_roles_have_the_pattern(spark):
    rows = odd_rows(5, 300, list(range(40)))
    _, edited = C.repair(spark.createDataFrame(rows, SCHEMA))
    by_key = {}
    for r in edited.where("edit <> 'D'").orderBy("key", "block", "place").collect():
        by_key[r["key"]] = by_key.get(r["key"], "") + r["role"][0]
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in by_key.values()) and by_key


def test_query_over_the_smallest_tables(spark, sf_dir):
    rows = []
    everyone = set()
    for r in shared.table(spark, sf_dir, "conversations").collect():
        everyone.add(r["conv_id"])
        kind = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        role, text = "user" if kind == 4 else r["role"], "" if kind == 1 else re.sub("[.!?]", "", r["text"]) if kind == 2 else r["text"]
        rows += [(r["conv_id"], r["turn"], role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = registry.QUERIES["op11_conversation_repair"](spark, sf_dir)
    left = {r[0] for r in rows}
    same(got.where(got.conv_id.isin(*left)), rows)
    assert {r["conv_id"] for r in got.collect()} == everyone
    assert all(r["audit"] == "" and r["cost"] == 0 for r in got.collect() if r["conv_id"] not in left)
