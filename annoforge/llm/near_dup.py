"""Near-duplicate documents by bottom-k sketches, inverted lists, union-sketch estimates and exact Jaccard.

A document's set is its distinct five-word shingles, each hashed once to 63 bits. What is retained are the
least hashes: all of a set of at most FULL, else the least K. Documents of equal sets share a digest and go on
as one node. Inverted lists hold retained values, of short documents (sets of at most FULL) and of long ones
(sets above FULL * 3/4) apart, so that every similar pair is short, or long, or both:

* Two similar short sets share at least 3/4 of either; two similar long ones share at least OVERLAP of their
  K least hashes (all but about 1e-7 of pairs do). With a document's values ordered by rarity, the last
  overlap - 1 of them need no list, and values of one document only need none either. A passage that many
  documents hold makes no list where it is less than that part of a document.
* First round: each node meets the least node of its lists, the one that most of them propose.
* Star round: in lists whose nodes lie in several groups so far, nodes outside the largest group meet one
  node of it. Nodes of one component need no link between them, so that a group of n copies costs about n
  comparisons, not n * n.
* Last round: what is left meets every node of other components in its lists, each pair in the first of the
  lists that it shares, and only if what stands behind that value in both documents, and the lists that they
  share, are enough for a link.

A pair of short documents is decided on its retained values, which are the full sets. Any other pair is
estimated by the K least hashes of the union of both sketches, and what is not far below the threshold is
confirmed on the full sets, made again from the texts.

Results: a null or empty text, and one without a word, has no shingle and links with nothing; with fewer
than five words the whole sequence is one shingle. Rows of one id count each by its own text; component_id
is the least id over all rows of linked texts, kept is doc_id = component_id. A null id never is a
component's id; such rows are kept only if nothing else is in their component. Ties of ids cannot occur among
linked texts: rows of one id are one id. Other columns, whatever their names, are left alone; an empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.llm import pieces
from annoforge.llm.shared import bounded_batches, components, cut, forget, named, scope, small, table, tidy

K, OVERLAP, FULL = 64, 30, 256
#: Estimates below this are taken as no link: the threshold less five standard deviations at K = 64.
LEAST_ESTIMATE = 0.48
_SHORT = 0x5851F42D4C957F2D


def _lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (63 bits) of each text."""
    data, offsets = pieces.utf8(column)
    kept, at, bounds = pieces.words(_lower(data), offsets)
    if not len(at):
        yield from (np.zeros(0, np.int64) for _ in range(len(column)))
        return
    codes, distinct = pieces.distinct_pieces(kept, at, pa.large_binary())
    table_ = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), np.uint64, len(distinct))
    words = table_[codes]
    with np.errstate(over="ignore"):
        mixed = words[: max(0, len(words) - size + 1)].copy()
        for k in range(1, size):
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(mixed)]
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed = ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= size:
            yield np.unique(mixed[lo : hi - size + 1])
        elif hi > lo:
            yield np.array([xxhash.xxh3_64_intdigest(words[lo:hi].tobytes(), seed=_SHORT) >> 1], np.int64)
        else:
            yield np.zeros(0, np.int64)


def _nodes(sets: list[np.ndarray], bits: int) -> list[pa.Array]:
    """Two halves of each set's 128-bit digest as whole numbers of `bits` and 63 bits; null for an empty set."""
    digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
    halves = ([None if d is None else int.from_bytes(d[at : at + 8], "little") >> 64 - b for d in digests] for at, b in ((0, bits), (8, 63)))
    return [pa.array(h, pa.int64()) for h in halves]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def sketches(docs: DataFrame, k: int, full: int, size: int, id_col: str, text_col: str, bits: int = 63) -> DataFrame:
    """(id, n, node, other, sketch) of every row; node and other are the halves of its set's digest, null without one."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, halves, least = [], [], []
            for own in shingle_sets(batch.column(1), size):
                n.append(len(own))
                halves.append(_nodes([own], bits))
                least.append(own if len(own) <= full else own[:k])
            nodes = [pa.concat_arrays([h[i] for h in halves]) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *nodes, _lists(least)], ["id", "n", "node", "other", "sketch"])
            del least
            tidy()

    return docs.select(named(id_col), named(text_col)).mapInArrow(run, f"id {kind}, n bigint, node bigint, other bigint, sketch array<bigint>")


def full_sets(docs: DataFrame, nodes: DataFrame, reps: DataFrame, size: int, id_col: str, text_col: str, bits: int = 63) -> DataFrame:
    """(node, set) of the wanted nodes, from the text of the row that stands for each."""
    wanted = cut(reps.join(nodes, "node").select("id", "node"), "dup-wanted")
    rows = docs.select(named(id_col).alias("id"), named(text_col).alias("text"))
    rows = rows.join(small(wanted.select("id").distinct(), id_bytes("id")), "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = list(shingle_sets(batch.column(1), size))
            yield pa.RecordBatch.from_arrays([batch.column(0), *_nodes(own, bits), _lists(own)], ["id", "half", "other", "set"])
            del own
            tidy()

    kind = docs.schema[id_col].dataType.simpleString()
    made = rows.select("id", "text").mapInArrow(run, f"id {kind}, half bigint, other bigint, set array<bigint>")
    # a node is the first half of the digest, or the second where first halves were equal
    return made.join(wanted, "id").where("node = half or node = other").select("node", "set")


def id_bytes(name: str):
    """Bytes that a row of ids takes, whatever their type."""
    return F.lit(16) + F.octet_length(named(name).cast("string"))


class Linker:
    """The rounds over one set of nodes; reps: (node, id, n, sketch), one row per node."""

    def __init__(self, docs: DataFrame, reps: DataFrame, percent: int, k: int, overlap: int, full: int, size: int, id_col: str, text_col: str, bits: int = 63):
        self.docs, self.reps, self.percent, self.k, self.overlap, self.full, self.size, self.id_col, self.text_col, self.bits = docs, reps, percent, k, overlap, full, size, id_col, text_col, bits
        self.links: list[DataFrame] = []
        self.tested: list[DataFrame] = []
        # lists of long documents are told from those of short ones by the sign of the value
        short = F.when(F.col("n") <= full, F.col("sketch")).otherwise(F.array().cast("array<bigint>"))
        long = F.when(F.col("n") * 100 > full * percent, F.transform(F.slice("sketch", 1, k), lambda v: -1 - v)).otherwise(F.array().cast("array<bigint>"))
        values = reps.select("node", F.explode(F.concat(short, long)).alias("v"))
        counts = values.groupBy("v").agg(F.count("*").alias("f")).where("f > 1")
        shared = values.join(counts, "v").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("s"))
        need = {1: F.ceil(F.col("n") * percent / 100).cast("int"), -1: F.lit(overlap)}

        def prefix(sign: int):
            """The values that need a list, with their place among all m shared values of the document's, and each other."""
            own = F.filter("s", lambda x: (x["v"] >= 0) if sign > 0 else (x["v"] < 0))
            kept = F.slice(own, 1, F.greatest(F.lit(0), F.size(own) - need[sign] + 1))
            return F.transform(kept, lambda x, i: F.struct(x["v"].alias("v"), i.alias("i"), F.size(own).alias("m")))

        listed = shared.join(reps.select("node", "n"), "node").select("node", "n", prefix(1).alias("short"), prefix(-1).alias("long"))
        parts = [listed.select("node", "n", F.col(f"{c}.v").alias("p"), F.inline(c)) for c in ("short", "long")]
        self.index = cut(parts[0].unionByName(parts[1]), "dup-index")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (a, b) whose full sets are similar enough."""
        own = self.reps.select("node", "n", "sketch")
        left = own.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        right = own.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        both = pairs.join(left, "a").join(right, "b").where(F.lit(100) * F.least("na", "nb") >= F.lit(self.percent) * F.greatest("na", "nb"))
        whole = (F.col("na") <= self.full) & (F.col("nb") <= self.full)
        both = both.withColumn("whole", whole).withColumn("c", F.array_intersect("sa", "sb"))
        union = F.slice(F.array_sort(F.array_union(F.slice("sa", 1, self.k), F.slice("sb", 1, self.k))), 1, self.k)
        both = both.select("a", "b", "na", "nb", "whole", F.size("c").cast("long").alias("i"), F.when(~F.col("whole"), F.col("c")).alias("c"), F.when(~F.col("whole"), union).alias("u"))
        maybe = F.size(F.array_intersect("u", "c")) >= F.lit(LEAST_ESTIMATE * self.percent / 75) * F.size("u")
        similar = F.lit(100) * F.col("i") >= F.lit(self.percent) * (F.col("na") + F.col("nb") - F.col("i"))
        likely = cut(both.where(F.when(F.col("whole"), similar).otherwise(maybe)).select("a", "b", "na", "nb", "whole"), "dup-likely")
        open_ = likely.where("not whole")
        sets = cut(full_sets(self.docs, open_.select(F.explode(F.array("a", "b")).alias("node")).distinct(), self.reps, self.size, self.id_col, self.text_col, self.bits), "dup-sets")
        met = open_.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
        met = met.select("a", "b", "na", "nb", F.size(F.array_intersect("x", "y")).cast("long").alias("i")).where(similar)
        out = cut(met.select("a", "b").unionByName(likely.where("whole").select("a", "b")).distinct(), "dup-links")
        forget(sets)
        forget(likely)
        return out

    def test(self, pairs: DataFrame, name: str) -> int:
        """Confirm the pairs that were not tested before; how many linked."""
        fresh = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tested:
            done = self.tested[0]
            for more in self.tested[1:]:
                done = done.unionByName(more)
            fresh = fresh.join(done, ["a", "b"], "left_anti")
        fresh = cut(fresh, name)
        if fresh.isEmpty():
            return 0
        self.tested.append(fresh)
        self.links.append(self.confirm(fresh))
        return self.links[-1].count()

    def first_round(self) -> int:
        least = self.index.groupBy("v").agg(F.min("node").alias("p"))
        votes = self.index.select("node", "v").join(least, "v").where("node != p").groupBy("node", "p").agg(F.count("*").alias("c"))
        best = votes.groupBy("node").agg(F.max_by("p", F.struct("c", "p")).alias("p"))
        return self.test(best.select(F.col("p").alias("a"), F.col("node").alias("b")), "dup-first")

    def quick_groups(self) -> DataFrame:
        """(node, c): the least node of the one or two links that lead on from a node; not yet whole components."""
        up = self.links[0].groupBy(F.col("b").alias("node")).agg(F.min("a").alias("c"))
        upper = up.select(F.col("node").alias("c"), F.col("c").alias("cc"))
        low = up.join(upper, "c", "left").select("node", F.coalesce("cc", "c").alias("c"))
        return low.unionByName(low.select(F.col("c").alias("node"), "c")).groupBy("node").agg(F.min("c").alias("c"))

    def groups(self) -> DataFrame:
        """(node, c): components by the links so far, of nodes with a link."""
        links = self.links[0]
        for more in self.links[1:]:
            links = links.unionByName(more)
        return components(links).select("node", F.col("component").alias("c"))

    def merged(self, known: DataFrame) -> DataFrame:
        """Components after the last links, from those before: only the groups that they join are looked at."""
        last = self.links[-1].join(known.select(F.col("node").alias("a"), F.col("c").alias("ca")), "a", "left").join(known.select(F.col("node").alias("b"), F.col("c").alias("cb")), "b", "left")
        ends = cut(last.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")), "dup-ends")
        joined = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(F.col("node").alias("c"), F.col("component").alias("d"))
        every = known.unionByName(ends.select(F.col("a").alias("node"), F.col("ca").alias("c"))).unionByName(ends.select(F.col("b").alias("node"), F.col("cb").alias("c"))).distinct()
        return every.join(joined, "c", "left").select("node", F.coalesce("d", "c").alias("c"))

    def mixed(self, known: DataFrame) -> DataFrame:
        """Rows (v, node, n, p, i, m, c, top, star) of lists over several groups: top is the largest, star a node of it."""
        rows = self.index.join(known, "node", "left").withColumn("c", F.coalesce("c", "node"))
        parts = rows.groupBy("v", "c").agg(F.count("*").alias("m_"), F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("s"))
        lists = parts.groupBy("v").agg(F.count("*").alias("parts"), F.max(F.struct("m_", "c", "s")).alias("t")).where("parts > 1")
        return cut(rows.join(lists.select("v", F.col("t.c").alias("top"), F.col("t.s.node").alias("star")), "v"), "dup-mixed")

    def star_round(self) -> int:
        rows = self.mixed(self.quick_groups())
        near = rows.where("c != top").select(F.col("star").alias("a"), F.col("node").alias("b")).distinct()
        linked = self.test(near, "dup-star")
        forget(rows)
        return linked

    def last_round(self, known: DataFrame) -> int:
        rows = self.mixed(known)
        x = rows.where("c != top").select(*[F.col(c).alias(f"{c}a") for c in ("v", "node", "n", "p", "i", "m", "c")])
        y = rows.select(*[F.col(c).alias(f"{c}b") for c in ("v", "node", "n", "p", "i", "m", "c")], (F.col("c") != F.col("top")).alias("minor"))
        size = F.lit(100) * F.least("na", "nb") >= F.lit(self.percent) * F.greatest("na", "nb")
        # all that the two can share stands at or behind their first common value
        room = F.least(F.col("ma") - F.col("ia"), F.col("mb") - F.col("ib")).cast("long")
        shared = F.ceil(F.lit(self.percent) * (F.col("na") + F.col("nb")) / F.lit(100 + self.percent))
        # of short documents' common values, fewer than either one's overlap have no list in it
        listed = F.size(F.array_intersect("pa", "pb")) > shared - F.ceil(F.greatest("na", "nb") * self.percent / 100)
        enough = F.when(F.col("va") >= 0, (room >= shared) & listed).otherwise(room >= self.overlap)
        once = F.get(F.array_intersect("pa", "pb"), F.lit(0)) == F.col("va")
        meet = (F.col("va") == F.col("vb")) & (F.col("ca") != F.col("cb")) & (~F.col("minor") | (F.col("nodea") < F.col("nodeb"))) & size & enough & once
        linked = self.test(x.join(y, meet).select(F.col("nodea").alias("a"), F.col("nodeb").alias("b")), "dup-last")
        forget(rows)
        return linked


def near_duplicates(docs: DataFrame, percent: int = 75, k: int = K, overlap: int = OVERLAP, full: int = FULL, size: int = 5, id_col: str = "doc_id", text_col: str = "text", bits: int = 63) -> DataFrame:
    """One row per row of docs: the id, n_shingles, component_id, kept. Sets are told apart by 128 bits, of which the
    first `bits` name them; where two sets share those, the other half names them."""
    bounded_batches(docs.sparkSession)
    with scope() as held:
        rows, named_ = _components(docs, percent, k, overlap, full, size, id_col, text_col, bits)
        held.keep(rows)
        held.keep(named_)
    out = rows.join(named_, "node", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def one_per_node(made: DataFrame) -> DataFrame:
    """The row of least id of each node, and the ends of the other halves of its digests."""
    held = made.where("node is not null and id is not null").groupBy("node")
    return cut(held.agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("other").alias("least"), F.max("other").alias("most")), "dup-reps")


def _components(docs: DataFrame, percent: int, k: int, overlap: int, full: int, size: int, id_col: str, text_col: str, bits: int) -> tuple[DataFrame, DataFrame]:
    """(id, n, node) of every row, and (node, component_id)."""
    made = first = cut(sketches(docs, k, full, size, id_col, text_col, bits), "dup-sketches")
    reps = one_per_node(made)
    shared = reps.where("least < most").select("node")
    if not shared.isEmpty():
        made = made.join(small(shared.withColumn("shared", F.lit(True)), F.lit(16)), "node", "left").withColumn("node", F.when(F.col("shared"), F.col("other")).otherwise(F.col("node")))
        reps = one_per_node(made)
    rows = cut(made.select("id", "n", "node"), "dup-rows")
    forget(first)
    linker = Linker(docs, reps.drop("least", "most"), percent, k, overlap, full, size, id_col, text_col, bits)
    linker.first_round()
    if linker.links:
        linker.star_round()
        joined = cut(linker.groups(), "dup-groups")
        if linker.last_round(joined):
            joined = cut(linker.merged(joined), "dup-groups")
        least = joined.join(reps.select("node", "id"), "node").groupBy("c").agg(F.min("id").alias("low"))
        found = joined.join(least, "c").select("node", "low")
        found = reps.select("node", "id").join(found, "node", "left").select("node", F.coalesce("low", "id").alias("component_id"))
    else:
        found = reps.select("node", F.col("id").alias("component_id"))
    return rows, cut(found, "dup-components")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The rows of docs, all columns, whose id is that of their component; repeated rows of an id stay."""
    with scope() as held:
        gone = held.keep(cut(near_duplicates(docs, id_col=id_col, text_col=text_col, **more).where(~F.col("kept")).select(named(id_col)).distinct(), "dup-gone"))
    return docs.join(small(gone, id_bytes(id_col)), id_col, "left_anti")


def op2_near_dup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


#: The same components by brute force: shared shingles counted by joining on the shingle.
OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(d, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.d, e.b FROM r JOIN e ON e.a = r.c),
c AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id, w.doc_id = c.c AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN c ON c.d = w.doc_id
"""
