"""Conversation structure repair over a bidirectional tight-arc DAG.

A conversation is well formed if the first letters of its roles read `(s?(ua)+)?`. Its rows are kept (K, 0),
given another role (R, 2) or deleted (D, 3; required for blank and repeated rows), and turns without text are
inserted (I, 2); a truncated row that stays adds 1. A node is (rows used, state of the pattern); forward least
costs from the start and backward least costs to the end tell which arcs lie on a cheapest repair, and a walk over
them takes the least letter from its frontier set of nodes at each step, so that of all cheapest repairs the one
whose letters are least comes out.

At scale: rows are numbered over ranges of (conversation, turn, role, text digest), so that a conversation of any
length is spread over tasks, and cut in blocks of BLOCK rows. A block is a min-plus matrix from states to states.
Where a conversation has several blocks, a tree of matrix products carries forward and backward costs to each block
(and, the same way, the state that the walk enters with); every task holds at most BLOCK rows, matrices or states.
Only the digest of a whole conversation goes over its blocks in order, streamed in one pass.

Results: null roles and texts are one space; rows without a conversation id form one conversation; rows of equal
turn go by role and digest of text, so that repeated rows are neighbours; null turns come first; other columns are
left out whatever their names. An empty table gives empty tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from annoforge.llm.shared import bounded_batches, cut, named, scope, table
from annoforge.operators.review import positions

#: Rows of a block and children of a tree's node, as a power of two; rows numbered in one task.
BITS, RANGE_ROWS = 10, 2048
INF = 1 << 40
#: States of the pattern: nothing yet, after system, after user, after assistant. Ends are the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The turn that may follow each state, a leading system turn aside.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Faults of a row.
SOUND, CUT_OFF, GONE = 0, 1, 2


def row_arcs(initial: str, fault: int) -> list[tuple[str, int, int, int]]:
    """(letter, from, to, cost) of what can be done with a row."""
    arcs = [("D", s, s, DELETE) for s in range(4)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT_OFF else 0
        arcs += [("R", s, t, REROLE + more) for s, t in NEXT.items()]
        arcs += [("K", s, t, more) for s, t in NEXT.items() if initial == ROLES[t][0]]
        if initial == "s":
            arcs.append(("K", START, SYSTEM, more))
    return arcs


INSERTS = [("I", s, t, INSERT) for s, t in NEXT.items()]


def inserted(costs: list[int], back: bool = False) -> list[int]:
    """Costs of a layer's nodes with turns inserted in it: forward from costs, or backward to them."""
    out = list(costs)
    for _ in range(3):
        for _, s, t, c in INSERTS:
            if back:
                out[s] = min(out[s], out[t] + c)
            else:
                out[t] = min(out[t], out[s] + c)
    return out


def stepped(costs: list[int], arcs: list, back: bool = False) -> list[int]:
    """Costs over one row, forward or backward."""
    out = [INF] * 4
    for _, s, t, c in arcs:
        if back:
            out[s] = min(out[s], costs[t] + c)
        else:
            out[t] = min(out[t], costs[s] + c)
    return out


def begin() -> list[int]:
    return [0 if s == START else INF for s in range(4)]


def end() -> list[int]:
    return inserted([0 if s in ENDS else INF for s in range(4)], back=True)


def matrix(rows: list[tuple[str, int]]) -> list[int]:
    """Least cost from each state before a block to each state after its last row, by rows of four."""
    out = []
    for s in range(4):
        costs = [0 if t == s else INF for t in range(4)]
        for r in rows:
            costs = stepped(inserted(costs), row_arcs(*r))
        out += costs
    return out


def product(parts: list[list[int]]) -> list[int]:
    out = parts[0]
    for m in parts[1:]:
        out = [min(min(out[4 * s + k] + m[4 * k + t] for k in range(4)), INF) for s in range(4) for t in range(4)]
    return out


def costs_around(around: list[int], parts: list[list[int]]) -> list[list[int]]:
    """Forward costs before each part and backward costs after it (and whether a part is the last: 1), from those
    around all of them."""
    before, after = [around[:4]], [around[4:8]]
    for m in parts[:-1]:
        before.append([min(min(before[-1][s] + m[4 * s + t] for s in range(4)), INF) for t in range(4)])
    for m in parts[:0:-1]:
        after.append([min(min(m[4 * s + t] + after[-1][t] for t in range(4)), INF) for s in range(4)])
    n = len(parts)
    return [f + b + [around[8] if i == n - 1 else 0] for i, (f, b) in enumerate(zip(before, reversed(after), strict=True))]


def walk(rows: list[tuple[str, int]], around: list[int], entry: int) -> tuple[list[tuple[str, int, int]], int]:
    """(letter, row or -1, state after it) of the least letters on tight arcs through a block from a state, and the
    state it ends in; (nothing, -1) if no cheapest repair enters there."""
    forward, layers = around[:4], []
    for r in rows:
        layers.append(inserted(forward))
        forward = stepped(layers[-1], row_arcs(*r))
    layers.append(inserted(forward))
    back = [around[4:8]]
    for r in reversed(rows):
        back.append(inserted(stepped(back[-1], row_arcs(*r), back=True), back=True))
    back.reverse()
    least = min(f + b for f, b in zip(layers[0], back[0], strict=True))
    if layers[0][entry] + back[0][entry] != least or around[entry] >= INF:
        return [], -1
    frontier, i, out = {entry}, 0, []
    while True:
        if i == len(rows) and (not around[8] or any(s in ENDS and back[i][s] == 0 for s in frontier)):
            return out, min(frontier)
        arcs = [(letter, s, t, c, i) for letter, s, t, c in INSERTS]
        if i < len(rows):
            arcs += [(letter, s, t, c, i + 1) for letter, s, t, c in row_arcs(*rows[i])]
        tight = [a for a in arcs if a[1] in frontier and layers[i][a[1]] + a[3] + back[a[4]][a[2]] == least]
        letter = min(a[0] for a in tight)
        frontier = {a[2] for a in tight if a[0] == letter}
        out.append((letter, i if letter != "I" else -1, min(frontier)))
        i += letter != "I"


def over(df: DataFrame, run: Callable[[dict], dict], schema: str) -> DataFrame:
    """One row of `schema` from each row of df, in batches."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist(list(map(run, batch.to_pylist())), kinds)

    return df.mapInArrow(go, schema)


def gathered(df: DataFrame, *more: str) -> DataFrame:
    """Blocks below their parent: (key, parent, parts in order)."""
    up = df.withColumn("parent", F.shiftright("block", BITS))
    return up.groupBy("key", "parent").agg(F.array_sort(F.collect_list(F.struct("block", "value", *more))).alias("parts"))


def carried(blocks: DataFrame, join: Callable, spread: Callable, around: list[int]) -> DataFrame:
    """(key, block, around) from (key, block, value): what a block finds on entering and leaving.

    `join` makes one value of the values of neighbours; `spread` takes what is around them all to each of them. Values
    go up a tree of 2 ** BITS children a node until each key has one, and what is around goes down again."""
    levels = [blocks]
    while not levels[-1].groupBy("key").count().where("count > 1").isEmpty():
        up = over(gathered(levels[-1]), lambda r: {"key": r["key"], "block": r["parent"], "value": join([p["value"] for p in r["parts"]])}, "key string, block bigint, value array<bigint>")
        levels.append(cut(up, "talk-up"))
    now = levels[-1].select("key", "block", F.array(*[F.lit(x).cast("bigint") for x in around]).alias("around"))
    for below in reversed(levels[:-1]):
        held = gathered(below).join(now.withColumnRenamed("block", "parent"), ["key", "parent"])
        each = over(held, lambda r: {"key": r["key"], "found": [{"block": p["block"], "around": a} for p, a in zip(r["parts"], spread(r["around"], [p["value"] for p in r["parts"]]), strict=True)]}, "key string, found array<struct<block:bigint,around:array<bigint>>>")
        now = cut(each.select("key", F.inline("found")), "talk-down")
    return now


def states_around(entry: list[int], parts: list[list[int]]) -> list[list[int]]:
    """The state that the walk enters each part with; a part is the state it leaves with, by state entered."""
    out = [entry]
    for m in parts[:-1]:
        out.append([m[out[-1][0]]])
    return out


def numbered(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(key, id, turn, role, text, digest, initial, blank, cut_off, position): rows in order over the whole table."""
    turn = named(turn_col).cast("bigint")
    text = F.coalesce(named(text_col), F.lit(" "))
    flat = rows.select(
        F.coalesce(F.concat(F.lit("v"), named(id_col).cast("string")), F.lit("n")).alias("key"),
        named(id_col).alias("id"), turn.alias("turn"), turn.isNotNull().cast("int").alias("with_turn"), F.coalesce(turn, F.lit(0)).alias("turn_or_0"),
        F.coalesce(named(role_col), F.lit(" ")).alias("role"), text.alias("text"), F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut_off"), F.monotonically_increasing_id().alias("at"),
    )
    held = cut(flat.withColumn("initial", F.substring("role", 1, 1)), "talk-rows")
    return cut(positions(held, "key", "with_turn", "turn_or_0", "role", "digest", "at", range_rows=RANGE_ROWS).drop("with_turn", "turn_or_0", "at"), "talk-numbered")


class Repair:
    """Rows of conversations with their faults and their cheapest repair.

    blocks: (key, block, rows, illegal pairs inside, first and last initial, cost, edits); rows: every row as numbered;
    report() and edited() are what comes of it."""

    def __init__(self, rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"):
        bounded_batches(rows.sparkSession)
        self.id_col = id_col
        self.rows = numbered(rows, id_col, turn_col, role_col, text_col)
        self.per_key = cut(
            self.rows.groupBy("key").agg(
                F.first("id").alias("id"), F.min("position").alias("from"), F.count("*").alias("n"),
                F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
            ), "talk-keys")
        first = self.rows.groupBy("key", "role", "digest").agg(F.min("position").alias("position")).select("position", F.lit(True).alias("first"))
        fault = F.when(F.col("blank") | F.col("first").isNull(), GONE).when(F.col("cut_off"), CUT_OFF).otherwise(SOUND)
        kinds = self.rows.select("key", "position", "initial", "blank", "cut_off").join(first, "position", "left").join(self.per_key.select("key", "from", "n"), "key")
        kinds = kinds.select("key", "position", "initial", "blank", fault.alias("fault"), F.shiftright(F.col("position") - F.col("from"), BITS).alias("block"), (F.col("n") <= 1 << BITS).alias("alone"))
        grouped = kinds.groupBy("key", "block", "alone").agg(
            F.array_sort(F.collect_list(F.struct("position", "initial", "fault"))).alias("rows"), F.count_if("blank").alias("blank"),
            F.count_if((F.col("fault") == GONE) & ~F.col("blank")).alias("duplicate"), F.count_if(F.col("fault") == CUT_OFF).alias("truncated"),
        )
        self.blocks = self.walked(cut(grouped, "talk-blocks"))

    def walked(self, blocks: DataFrame) -> DataFrame:
        whole = begin() + end() + [1]
        several = blocks.where(~F.col("alone"))
        around = walks = None
        if not several.isEmpty():
            values = cut(over(several.select("key", "block", "rows"), lambda r: {"key": r["key"], "block": r["block"], "value": matrix(pairs(r["rows"]))}, "key string, block bigint, value array<bigint>"), "talk-matrices")
            around = carried(values, product, costs_around, whole)
            leaving = over(several.select("key", "block", "rows").join(around, ["key", "block"]), lambda r: {"key": r["key"], "block": r["block"], "value": [walk(pairs(r["rows"]), r["around"], s)[1] for s in range(4)]}, "key string, block bigint, value array<bigint>")
            walks = carried(cut(leaving, "talk-states"), lambda parts: [follow(parts, s) for s in range(4)], states_around, [START])
            blocks = blocks.join(around, ["key", "block"], "left").join(walks.select("key", "block", F.col("around").alias("entry")), ["key", "block"], "left")
        else:
            blocks = blocks.withColumns({"around": F.lit(None).cast("array<bigint>"), "entry": F.lit(None).cast("array<bigint>")})

        def run(r: dict) -> dict:
            rows = pairs(r["rows"])
            done, _ = walk(rows, r["around"] or whole, r["entry"][0] if r["entry"] else START)
            edits = [{"edit": e, "position": r["rows"][i]["position"] if i >= 0 else None, "role": ROLES[s] if e in "IR" else None} for e, i, s in done]
            cost = sum({"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[e] + (TRUNCATED if e in "KR" and rows[i][1] == CUT_OFF else 0) for e, i, _ in done)
            initials = [x for x, _ in rows]
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
            return {k: r[k] for k in ("key", "block", "blank", "duplicate", "truncated")} | {"illegal": illegal, "first": initials[0], "last": initials[-1], "cost": cost, "edits": edits}

        schema = "key string, block bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, cost bigint, edits array<struct<edit:string,position:bigint,role:string>>"
        return cut(over(blocks, run, schema), "talk-edits")

    def edited(self) -> DataFrame:
        """Every edit in order: (key, block, place, edit, role, text), role and text as they are after it; a deleted
        row has those it had."""
        each = self.blocks.select("key", "block", F.posexplode("edits").alias("place", "e")).select("key", "block", "place", "e.*")
        used = each.where("position is not null").withColumnRenamed("role", "given").join(self.rows.select("position", "role", "text"), "position")
        used = used.select("key", "block", "place", "edit", F.coalesce("given", "role").alias("role"), "text")
        return used.unionByName(each.where("position is null").select("key", "block", "place", "edit", "role", F.lit("").alias("text")))

    def report(self) -> DataFrame:
        """One row per conversation: the id, gaps, faults, cost, audit and the digest of the repaired rows."""
        line = F.concat("role", F.lit(":"), "text")
        parts = self.edited().groupBy("key", "block").agg(F.array_sort(F.collect_list(F.struct("place", F.when(F.col("edit") != "D", line).alias("line")))).alias("lines"))
        kept = F.filter(F.transform("lines", lambda x: x["line"]), lambda x: x.isNotNull())
        parts = parts.select("key", "block", F.size(kept).alias("n_lines"), F.array_join(kept, "\n").alias("lines"))
        counted = [c for c in self.blocks.columns if c not in ("key", "block", "edits")]
        rows = self.blocks.select("key", "block", *counted, F.array_join("edits.edit", "").alias("audit")).join(parts, ["key", "block"], "left")
        ordered = rows.repartition("key").sortWithinPartitions("key", "block")
        sums = ["blank", "duplicate", "truncated", "illegal", "cost"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, had, audit, last, digest, lines = None, [0] * 5, [], None, None, 0

            def told() -> dict:
                return {"key": key} | dict(zip(sums, had, strict=True)) | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

            for batch in batches:
                out = []
                for r in batch.to_pylist():
                    if r["key"] != key:
                        if key is not None:
                            out.append(told())
                        key, had, audit, last, digest, lines = r["key"], [0] * 5, [], None, hashlib.sha256(), 0
                    had = [x + r[c] for x, c in zip(had, sums, strict=True)]
                    had[3] += last is not None and last + r["first"] not in LEGAL
                    last = r["last"]
                    audit.append(r["audit"])
                    if r["n_lines"]:
                        digest.update((("\n" if lines else "") + r["lines"]).encode())
                        lines += r["n_lines"]
                if out:
                    yield pa.RecordBatch.from_pylist(out)
            if key is not None:
                yield pa.RecordBatch.from_pylist([told()])

        told = ordered.mapInArrow(run, "key string, " + ", ".join(f"{c} bigint" for c in sums) + ", audit string, repaired_sha256 string")
        return self.per_key.select("key", F.col("id").alias(self.id_col), "gaps").join(told, "key").drop("key")


#: Pairs of neighbouring initials that are in order.
LEGAL = ("su", "ua", "au")


def pairs(rows: list[dict]) -> list[tuple[str, int]]:
    return [(r["initial"], r["fault"]) for r in rows]


def follow(parts: list[list[int]], state: int) -> int:
    """The state that the walk leaves the last part with, -1 where it cannot pass."""
    for m in parts:
        state = m[state] if state >= 0 else -1
    return state


def repair(rows: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(report, edited) of conversations, as Repair has them."""
    with scope() as held:
        done = Repair(rows, **columns)
        for df in (done.rows, done.per_key, done.blocks):
            held.keep(df)
    return done.report(), done.edited()


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with the faults that the query plants by the checksum of id and turn."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(text("conv_id"), F.lit(":"), text("turn")), "UTF-8")) % 20
    out = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(text("role")).alias("role"), F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text")).alias("text"), kind.alias("kind"))
    return out.where("kind <> 0").withColumn("_", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_", "kind")


def absent(c: str) -> Column:
    """Value of a conversation none of whose rows is left."""
    return F.lit(hashlib.sha256().hexdigest()) if c == "repaired_sha256" else F.lit("") if c == "audit" else F.lit(0).cast("bigint")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after the planted damage."""
    rows = table(spark, sf_dir, "conversations")
    report, _ = repair(damaged(rows))
    ids = rows.select("conv_id").distinct()
    found = report.withColumnRenamed("conv_id", "_id")
    out = ids.join(found, ids.conv_id.eqNullSafe(found["_id"]), "left").drop("_id")
    return out.select("conv_id", *[F.coalesce(c, absent(c)).alias(c) for c in out.columns if c != "conv_id"])


#: The same by plain recursion over rows: of each state the least (cost, letters), with the text repaired so far.
OP11_SQL = r"""
WITH RECURSIVE bits AS (SELECT i, 0 AS k, i::UINTEGER AS c FROM range(256) t(i) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UINTEGER) ELSE c >> 1 END FROM bits WHERE k < 8),
crcs AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (SELECT n.*, xor(list_reduce(list_prepend(4294967295::UINTEGER, list_transform(string_split(k, ''), lambda x: ascii(x)::UINTEGER)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::UINTEGER) % 20 AS kind FROM named n, crcs),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM kinds, range(2) r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS p, left(role, 1) AS i FROM hurt),
looked AS (SELECT *, lag(i) OVER w AS before, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS short FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
rows_ AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, blank OR again AS gone, CASE WHEN short THEN 1 ELSE 0 END AS more FROM looked),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate, count(*) FILTER (WHERE short AND NOT blank AND NOT again) AS truncated,
  count(*) FILTER (WHERE p > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv_id),
arcs AS (SELECT * FROM (VALUES ('0', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')) a(s, t)),
layer(conv_id, p, ins, s, c, w, x) AS (
  SELECT DISTINCT conv_id, 0, 0, '0', 0, '', NULL::VARCHAR FROM rows_
  UNION ALL
  SELECT conv_id, p, ins, s, m.c, m.w, m.x FROM (
    SELECT conv_id, p, ins, s, min({'c': c, 'w': w, 'x': x}) AS m FROM (
      SELECT l.conv_id, l.p, l.ins + 1 AS ins, a.t AS s, l.c + 2 AS c, l.w || 'I' AS w, concat_ws(chr(10), l.x, CASE a.t WHEN 'u' THEN 'user:' ELSE 'assistant:' END) AS x FROM layer l JOIN arcs a ON a.s = l.s WHERE l.ins < 3
      UNION ALL SELECT conv_id, p, ins + 1, s, c, w, x FROM layer WHERE ins < 3
      UNION ALL SELECT l.conv_id, l.p + 1, 0, l.s, l.c + 3, l.w || 'D', l.x FROM layer l JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.p = l.p + 1 WHERE l.ins = 3
      UNION ALL SELECT l.conv_id, l.p + 1, 0, a.t, l.c + 2 + r.more, l.w || 'R', concat_ws(chr(10), l.x, CASE a.t WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text) FROM layer l JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.p = l.p + 1 JOIN arcs a ON a.s = l.s WHERE l.ins = 3 AND NOT r.gone
      UNION ALL SELECT l.conv_id, l.p + 1, 0, r.i, l.c + r.more, l.w || 'K', concat_ws(chr(10), l.x, r.role || ':' || r.text) FROM layer l JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.p = l.p + 1 WHERE l.ins = 3 AND NOT r.gone AND ((l.s = '0' AND r.i = 's') OR EXISTS (SELECT 1 FROM arcs a WHERE a.s = l.s AND a.t = r.i))
    ) GROUP BY conv_id, p, ins, s)),
best AS (SELECT l.conv_id, min({'c': l.c, 'w': l.w, 'x': l.x}) AS m FROM layer l JOIN (SELECT conv_id, max(n) AS n FROM rows_ GROUP BY conv_id) e ON e.conv_id IS NOT DISTINCT FROM l.conv_id AND e.n = l.p WHERE l.ins = 3 AND l.s IN ('0', 'a') GROUP BY l.conv_id)
SELECT o.conv_id, coalesce(t.gaps, 0)::BIGINT AS gaps, coalesce(t.blank, 0)::BIGINT AS blank, coalesce(t.duplicate, 0)::BIGINT AS duplicate, coalesce(t.truncated, 0)::BIGINT AS truncated, coalesce(t.illegal, 0)::BIGINT AS illegal,
  coalesce(b.m.c, 0)::BIGINT AS cost, coalesce(b.m.w, '') AS audit, sha256(coalesce(b.m.x, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""
