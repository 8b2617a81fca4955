"""Near-duplicate embeddings by cross-polytope hashing with multiprobe buckets.

A vector is padded to a power of two, rotated by three rounds of random signs and the fast Hadamard
transform, and hashed to the axis it is nearest to, with its sign. A table joins the hashes of two rotations
to a bucket, of three for vectors of at most 128 dimensions. A vector stands in its bucket of every table and also probes the PROBES next buckets,
in the order of what they lose; two vectors meet where one stands and the other stands or probes.

Only buckets that several vectors share are looked at. A copy of a vector goes to each, as it was given, with
its buckets of the tables up to that one. Buckets of any size are cut into blocks, and pairs of blocks are compared as matrices in double precision. A
pair that meets in several tables or buckets counts in the first only. Each pair of blocks returns a count
per vector and its components, a row per vector, never the pairs themselves. Vectors that are equal go on as
one with a weight.

Results: vectors that are null, zero, empty, or hold null or non-finite components link with nothing: 0
links, a component of their own, kept. Vectors of different lengths never link. Each row is one output row;
rows of one id count as vectors of their own. component_id is the least id reachable, and kept is vec_id =
component_id (true for a null id in a component of null ids only).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.llm.shared import bounded_batches, components, cut, named, small, scope, table

#: Production parameters; tests measure their recall at the threshold itself, at 64, 384 and 768 dimensions.
TABLES, PROBES, BLOCK, CELL = 12, 6, 4096, 512
SEED = 20


def hash_count(dim: int) -> int:
    """Rotations whose hashes make a bucket: more would leave too few pairs of long vectors together."""
    return 3 if dim <= 128 else 2


@cache
def signs(dim: int, count: int, seed: int) -> np.ndarray:
    """Random signs of `count` rotations of three rounds each."""
    return np.random.default_rng([seed, dim]).integers(0, 2, size=(count, 3, dim)) * 2.0 - 1.0


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, dim = x.shape
    h = 1
    while h < dim:
        x = x.reshape(n, dim // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, dim)
        h *= 2
    return x / np.sqrt(dim)


def buckets(x: np.ndarray, tables: int = TABLES, hashes: int | None = None, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """Buckets of unit vectors: (vectors, tables, 1 + probes), the own one first."""
    n, dim = x.shape
    hashes = hashes or hash_count(dim)
    wide = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, wide))
    padded[:, :dim] = x
    turn = signs(wide, tables * hashes, seed)
    out = np.empty((n, tables, 1 + probes), np.int64)
    depth = min(2 * wide, probes + 1)
    for t in range(tables):
        order, loss = [], []
        for h in range(hashes):
            y = padded
            for s in turn[t * hashes + h]:
                y = hadamard(y * s)
            both = np.concatenate([y, -y], axis=1)
            best = np.argpartition(-both, depth - 1, axis=1)[:, :depth]
            value = np.take_along_axis(both, best, axis=1)
            rank = np.lexsort((best, -value), axis=1)
            order.append(np.take_along_axis(best, rank, axis=1))
            value = np.take_along_axis(value, rank, axis=1)
            loss.append((value[:, :1] - value) ** 2)
        code, cost = order[0].astype(np.int64), loss[0]
        for h in range(1, hashes):
            code = (code[:, :, None] * (2 * wide) + order[h][:, None, :]).reshape(n, -1)
            cost = (cost[:, :, None] + loss[h][:, None, :]).reshape(n, -1)
            least = np.argsort(cost, axis=1, kind="stable")[:, : probes + 1]
            code, cost = np.take_along_axis(code, least, axis=1), np.take_along_axis(cost, least, axis=1)
        if code.shape[1] < probes + 1:
            code = np.concatenate([code, np.repeat(code[:, :1], probes + 1 - code.shape[1], axis=1)], axis=1)
        out[:, t] = code[:, : probes + 1]
    return out


def vectors(column: pa.Array) -> list[np.ndarray | None]:
    """The vectors as doubles; None for those that link with nothing."""
    out = []
    for v in column.to_pylist():
        if not v or any(c is None for c in v):
            out.append(None)
            continue
        a = np.array(v, np.float64)
        out.append(a if np.isfinite(a).all() and a.any() else None)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def code_type(dim: int, hashes: int | None) -> np.dtype:
    """The narrowest type that holds every bucket."""
    wide = 2 << max(1, (int(dim) - 1).bit_length())
    return np.dtype(np.uint32 if wide ** (hashes or hash_count(dim)) <= 1 << 32 else np.int64)


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether vectors with buckets a and b (..., 1 + probes) meet in a table: one's own bucket is among the other's."""
    return (a[..., :1] == b).any(-1) | (b[..., :1] == a).any(-1)


def compare(t: int, bucket: int, x_a, c_a, x_b, c_b, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks that link and count here; c: buckets (vectors, tables, 1 + probes)."""
    i, j = np.nonzero(x_a @ x_b.T >= least)
    if same:
        up = i < j
        i, j = i[up], j[up]
    if not len(i):
        return i, j
    stands = (c_a[i, t, 0] == bucket) | (c_b[j, t, 0] == bucket)
    a, b = c_a[i, t].astype(np.int64), c_b[j, t].astype(np.int64)
    # of the buckets of this table where the pair meets, the lesser: own ones where the other is too
    far = np.iinfo(np.int64).max
    here = np.minimum(np.where((a[:, :1] == b).any(1), a[:, 0], far), np.where((b[:, :1] == a).any(1), b[:, 0], far))
    counts = stands & (here == bucket)
    i, j = i[counts], j[counts]
    if t and len(i):
        before = np.zeros(len(i), bool)
        for lo in range(0, len(i), 65536):
            s = slice(lo, lo + 65536)
            before[s] = _meet(c_a[i[s], :t], c_b[j[s], :t]).any(1)
        i, j = i[~before], j[~before]
    return i, j


def stars(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the components that the pairs make of n items: every item but the least, and its component's least."""
    low = np.arange(n)
    while len(i):
        least = np.minimum(low[i], low[j])
        moved = (low[i] != least) | (low[j] != least)
        if not moved.any():
            break
        np.minimum.at(low, low[i], least)
        np.minimum.at(low, low[j], least)
        while (low[low] != low).any():
            low = low[low]
    rest = np.flatnonzero(low != np.arange(n))
    return rest, low[rest]


def similar(embeddings: DataFrame, least: float = 0.9, tables: int = TABLES, hashes: int | None = None, probes: int = PROBES, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = 63) -> DataFrame:
    """One row per row of embeddings: the id, n_links, component_id, kept. Vectors are told apart by 128 bits, of which
    the first `bits` name them; where two vectors share those, the other half names them."""
    spark = embeddings.sparkSession
    bounded_batches(spark)
    kind = embeddings.schema[id_col].dataType.simpleString()
    single = embeddings.schema[vector_col].dataType.elementType.simpleString() == "float"
    given = np.dtype(np.float32 if single else np.float64)
    with scope() as tables_:
        return _similar(tables_, embeddings.select(named(id_col), named(vector_col)), kind, given, least, tables, hashes, probes, block, bits).withColumnsRenamed({"id": id_col})


def _similar(tables_, embeddings: DataFrame, kind: str, given: np.dtype, least: float, tables: int, hashes: int | None, probes: int, block: int, bits: int) -> DataFrame:
    def valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            raw = [None if v is None else (v + 0.0).astype(given).tobytes() for v in vectors(batch.column(1))]
            digests = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            halves = [pa.array([None if d is None else int.from_bytes(d[at : at + 8], "little") >> 64 - b for d in digests], pa.int64()) for at, b in ((0, bits), (8, 63))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *halves, pa.array(raw, pa.binary())], ["id", "node", "other", "v"])

    def one_per_node(rows: DataFrame) -> DataFrame:
        ends = F.min("other").alias("first"), F.max("other").alias("last")
        return cut(rows.where("node is not null").groupBy("node").agg(F.count("*").alias("m"), F.min("id").alias("low"), F.first("v").alias("v"), *ends), "vec-reps")

    rows = cut(embeddings.mapInArrow(valid, f"id {kind}, node bigint, other bigint, v binary"), "vec-rows")
    reps = one_per_node(rows)
    shared = reps.where("first < last").select("node")
    if not shared.isEmpty():
        named_ = rows.join(small(shared.withColumn("shared", F.lit(True)), F.lit(16)), "node", "left")
        rows = cut(named_.withColumn("node", F.when(F.col("shared"), F.col("other")).otherwise(F.col("node"))), "vec-rows")
        reps = one_per_node(rows)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).to_pylist()
            sizes = np.array([len(r) // given.itemsize for r in raw])
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                for lo in range(0, len(at), 2048):
                    own = at[lo : lo + 2048]
                    codes = buckets(unit(np.stack([np.frombuffer(raw[k], given) for k in own]).astype(np.float64)), tables, hashes, probes)
                    part, wide = batch.take(pa.array(own)), code_type(dim, hashes)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array([c.astype(wide).tobytes() for c in codes], pa.binary()), pa.array(codes.reshape(len(own), -1).tolist(), pa.list_(pa.int64())), pa.array([dim] * len(own), pa.int32())], ["node", "m", "x", "codes", "flat", "dim"])

    coded = cut(reps.select("node", "m", "v").mapInArrow(hashed, "node bigint, m bigint, x binary, codes binary, flat array<bigint>, dim int"), "vec-codes")
    spots = coded.select("node", "dim", F.posexplode("flat").alias("p", "bucket")).select("node", "dim", F.floor(F.col("p") / (probes + 1)).cast("int").alias("t"), "bucket", (F.col("p") % (probes + 1) == 0).alias("own"))
    spots = spots.groupBy("node", "dim", "t", "bucket").agg(F.max("own").alias("own"))
    sizes = spots.groupBy("dim", "t", "bucket").agg(F.count("*").alias("n"), F.max("own").alias("some")).where("n > 1 and some").withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
    placed = spots.join(sizes.select("dim", "t", "bucket", "parts"), ["dim", "t", "bucket"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # a block meets itself and every other block of its bucket once: rows go to (least, greatest)
    sent = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sent = sent.select("node", "dim", "t", "bucket", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), (F.col("part") <= F.col("other")).alias("first"))
    # no pair of table t looks at the buckets of later tables
    known = F.expr(f"substring(codes, 1, cast(octet_length(codes) / {tables} * (t + 1) as int))")
    held = sent.join(coded.select("node", "m", "x", "codes"), "node").withColumn("codes", known)
    keys = ["dim", "t", "bucket", "p", "q"]
    parted = held.select(*keys, "first", "node", "m", "x", "codes").repartition(*keys).sortWithinPartitions(*keys)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            rest = None
            for batch in batches:
                table_ = pa.Table.from_batches([batch])
                rest = table_ if rest is None else pa.concat_tables([rest, table_])
                if rest.num_rows:
                    names = np.stack([rest.column(k).to_numpy().astype(np.int64) for k in keys])
                    ends = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(0)) + 1
                    for lo, hi in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True) if len(ends) else ():
                        yield names[:, lo], rest.slice(lo, hi - lo)
                    if len(ends):
                        rest = rest.slice(ends[-1]).combine_chunks()
            if rest is not None and rest.num_rows:
                yield np.array([rest.column(k)[0].as_py() for k in keys]), rest

        counts: dict[int, int] = {}
        pairs: list[tuple[int, int]] = []

        def flush():
            out = [(n, n, c) for n, c in counts.items()] + [(a, b, 0) for a, b in pairs]
            counts.clear()
            pairs.clear()
            cols = list(zip(*out, strict=True)) if out else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "n"])

        for (dim, t, bucket, p, q), group in groups():
            if group.num_rows < 2:
                continue
            first = group.column("first").to_numpy()
            node, m = group.column("node").to_numpy(), group.column("m").to_numpy()
            x = unit(np.frombuffer(b"".join(group.column("x").to_pylist()), given).reshape(-1, dim).astype(np.float64))
            codes = np.frombuffer(b"".join(group.column("codes").to_pylist()), code_type(dim, hashes)).reshape(-1, t + 1, probes + 1)
            a = np.arange(len(node)) if p == q else np.flatnonzero(first)
            b = a if p == q else np.flatnonzero(~first)
            mine, up, down = np.zeros(len(node)), [], []
            for lo in range(0, len(a), CELL):
                for hi in range(lo if p == q else 0, len(b), CELL):
                    c, d = a[lo : lo + CELL], b[hi : hi + CELL]
                    i, j = compare(int(t), int(bucket), x[c], codes[c], x[d], codes[d], least, p == q and lo == hi)
                    if len(i):
                        i, j = c[i], d[j]
                        mine += np.bincount(i, weights=m[j], minlength=len(node)) + np.bincount(j, weights=m[i], minlength=len(node))
                        some, low = stars(len(node), i, j)
                        up.append(some)
                        down.append(low)
            if not up:
                continue
            for k in np.flatnonzero(mine).tolist():
                counts[int(node[k])] = counts.get(int(node[k]), 0) + int(mine[k])
            some, low = stars(len(node), np.concatenate(up), np.concatenate(down))
            pairs += zip(node[some].tolist(), node[low].tolist(), strict=True)
            if len(counts) + len(pairs) > 100_000:
                yield flush()
        yield flush()

    found = cut(parted.mapInArrow(link, "a bigint, b bigint, n bigint"), "vec-links")
    counts = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("more"))
    joined = components(found.where("a != b")).select("node", "component")
    named_ = reps.select("node", "m", "low").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lows = named_.groupBy("component").agg(F.min("low").alias("component_id"))
    named_ = cut(named_.join(lows, "component").join(counts, "node", "left").select("node", "component_id", (F.col("m") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")), "vec-named")
    out = tables_.keep(rows).select("id", "node").join(tables_.keep(named_), "node", "left")
    component = F.coalesce(F.col("component_id"), F.col("id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))


def op6_embedding_dup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of embeddings."""
    return similar(table(spark, sf_dir, "embeddings"))


#: The same components from all pairs, in double precision.
OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r(d, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.d, l.b FROM r JOIN l ON l.a = r.c),
c AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT x.vec_id, (SELECT count(*) FROM l WHERE l.a = x.vec_id)::BIGINT AS n_links, c.c AS component_id, x.vec_id = c.c AS kept
FROM embeddings x JOIN c ON c.d = x.vec_id
"""
