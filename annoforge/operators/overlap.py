"""Pairs of overlapping boxes of one image by a grid, and the greedy matching over them, for images of any density.

Boxes go to cells of a power of two that is no smaller than they are, so that each touches four cells at most; boxes of
two sizes meet in cells of the larger one's size, and a pair counts in the cell that holds the first corner of what
they share. Only pairs that overlap are ever held, in place of all predictions times all boxes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from annoforge.functions.workers import reachable

#: Sizes that a grid tells apart; smaller boxes go with the smallest.
LEVELS = 24


#: Products of boxes up to which all pairs of an image are looked at.
FEW = 1 << 12


def pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all pairs of boxes of a and b that share an area, each once."""
    with np.errstate(invalid="ignore"):
        ia, ib = (np.flatnonzero((x[:, 2] > x[:, 0]) & (x[:, 3] > x[:, 1]) & np.isfinite(x).all(axis=1)) for x in (a, b))
    if not len(ia) or not len(ib):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(ia) * len(ib) <= FEW:
        i, j = np.repeat(ia, len(ib)), np.tile(ib, len(ia))
        return keep_sharing(a, b, i, j)
    sizes = [np.maximum(x[:, 2] - x[:, 0], x[:, 3] - x[:, 1]) for x in (a[ia], b[ib])]
    la, lb = (np.ceil(np.log2(s)).astype(np.int64) for s in sizes)
    floor = max(la.max(), lb.max()) - LEVELS
    la, lb = np.maximum(la, floor), np.maximum(lb, floor)
    found = []
    for level in np.unique(np.concatenate([la, lb])):
        side = 2.0 ** float(level)
        for own, other in ((la == level, lb <= level), (la < level, lb == level)):
            if own.any() and other.any():
                found.append(meet(a, b, ia[own], ib[other], side))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    return i, j


def cells(x: np.ndarray, index: np.ndarray, side: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(box, column, row) of the cells that boxes touch; a box is no larger than a cell."""
    lo, hi = np.floor(x[index, :2] / side), np.floor(x[index, 2:] / side)
    out = []
    for dx in (0, 1):
        for dy in (0, 1):
            there = ((dx == 0) | (hi[:, 0] > lo[:, 0])) & ((dy == 0) | (hi[:, 1] > lo[:, 1]))
            out.append((index[there], lo[there, 0] + dx, lo[there, 1] + dy))
    return tuple(np.concatenate(p) for p in zip(*out, strict=True))


def meet(a: np.ndarray, b: np.ndarray, ia: np.ndarray, ib: np.ndarray, side: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of boxes that share a cell of this side, in the cell where what they share begins."""
    i, cx, cy = cells(a, ia, side)
    j, dx, dy = cells(b, ib, side)
    columns, code = np.unique(np.stack([np.concatenate([cx, dx]), np.concatenate([cy, dy])]), axis=1, return_inverse=True)
    code = code.ravel()
    ca, cb = code[: len(i)], code[len(i) :]
    order = np.argsort(cb, kind="stable")
    first, last = np.searchsorted(cb[order], ca), np.searchsorted(cb[order], ca, side="right")
    n = last - first
    left = np.repeat(np.arange(len(i)), n)
    right = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
    p, q = i[left], j[right]
    begins = np.floor(np.maximum(a[p, :2], b[q, :2]) / side)
    here = (begins[:, 0] == cx[left]) & (begins[:, 1] == cy[left])
    return keep_sharing(a, b, p[here], q[here])


def shared(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    width = np.minimum(a[i, 2], b[j, 2]) - np.maximum(a[i, 0], b[j, 0])
    height = np.minimum(a[i, 3], b[j, 3]) - np.maximum(a[i, 1], b[j, 1])
    return np.maximum(width, 0.0) * np.maximum(height, 0.0)


def keep_sharing(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some = shared(a, b, i, j) > 0
    return i[some], j[some]


def iou(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    inner = shared(a, b, i, j)
    area = [(x[k, 2] - x[k, 0]) * (x[k, 3] - x[k, 1]) for x, k in ((a, i), (b, j))]
    return inner / (area[0] + area[1] - inner)


class Side:
    """The boxes of one side of a batch of images: corners, the image of each, where each image's begin."""

    def __init__(self, column: pa.ListArray):
        self.rows = column.flatten()
        self.at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        self.image = np.repeat(np.arange(len(column)), np.diff(self.at))
        values = [self.get("box", c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("x1", "y1", "x2", "y2")]
        self.box = np.stack(values, axis=1) if len(self.rows) else np.zeros((0, 4))  # a missing corner is not a number

    def get(self, *path: str) -> pa.Array:
        return pc.struct_field(self.rows, list(path))

    def ranks(self, name: str) -> np.ndarray:
        """Places of a column's values in their order, equal for equal ones."""
        coded = self.get(name).dictionary_encode()
        place = np.zeros(len(coded.dictionary) + 1, np.int64)
        place[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(coded.dictionary))
        return place[pc.fill_null(coded.indices, len(coded.dictionary)).to_numpy(zero_copy_only=False)]


def batch_pairs(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all overlapping boxes of the same image: all pairs of images with few, by the grid for others."""
    n, m = np.diff(a.at), np.diff(b.at)
    few = np.flatnonzero((n > 0) & (m > 0) & (n * m <= FEW))
    own = (n * m)[few]
    place = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
    width = np.repeat(m[few], own)
    found = [keep_sharing_valid(a.box, b.box, np.repeat(a.at[few], own) + place // np.maximum(width, 1), np.repeat(b.at[few], own) + place % np.maximum(width, 1))]
    for k in np.flatnonzero(n * m > FEW).tolist():
        i, j = pairs(a.box[a.at[k] : a.at[k + 1]], b.box[b.at[k] : b.at[k + 1]])
        found.append((i + a.at[k], j + b.at[k]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    return i, j


def keep_sharing_valid(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """keep_sharing() of pairs of which some may be no boxes."""
    with np.errstate(invalid="ignore"):
        good = [(x[:, 2] > x[:, 0]) & (x[:, 3] > x[:, 1]) & np.isfinite(x).all(axis=1) for x in (a, b)]
    both = good[0][i] & good[1][j]
    return keep_sharing(a, b, i[both], j[both])


def first_of(groups: np.ndarray, n: int, *order: np.ndarray) -> np.ndarray:
    """For each of n groups the index of its first row by the order keys (the most important last), -1 without rows."""
    by = np.lexsort((*order, groups))
    out = np.full(n, -1, np.int64)
    sorted_ = groups[by]
    head = np.ones(len(by), bool)
    head[1:] = sorted_[1:] != sorted_[:-1]
    out[sorted_[head]] = by[head]
    return out


def picked(values: pa.Array, index: np.ndarray) -> pa.Array:
    """Values at the indexes, null where one is -1."""
    return values.take(pa.array(np.maximum(index, 0), mask=index < 0)) if len(values) else pa.nulls(len(index), values.type)


def struct_of(parts: dict[str, pa.Array], there: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays(list(parts.values()), list(parts), mask=pa.array(~there))


def matched(ps: pa.ListArray, gs: pa.ListArray, least: float, match_iou: float) -> tuple[pa.Array, pa.Array]:
    """Outcomes of the predictions and boxes of a batch of images; see matching.folded. Only pairs of one class that
    reach match_iou are looked at one by one."""
    a, b = Side(ps), Side(gs)
    confidence = a.get("confidence").cast(pa.float64())
    c = confidence.to_numpy(zero_copy_only=False) if len(a.rows) else np.zeros(0)
    null = confidence.is_null().to_numpy(zero_copy_only=False)
    kind, fall = np.where(null, 0, np.where(np.isnan(c), 2, 1)), np.where(np.isnan(c), 0.0, -c)  # null first, not a number last
    rank_p, rank_g = a.ranks("prediction_id"), b.ranks("gt_id")
    classes = pa.concat_arrays([a.get("class_id"), b.get("class_id")]).dictionary_encode()
    code = pc.fill_null(classes.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    ca, cb = code[: len(a.rows)], code[len(a.rows) :]
    i, j = batch_pairs(a, b)
    same = (ca[i] == cb[j]) & (ca[i] >= 0)
    i, j = i[same], j[same]
    n = -iou(a.box, b.box, i, j)
    # the first box and prediction of each image and class stand where nothing overlaps
    width = len(classes.dictionary) + 1
    ga, gb = a.image * width + ca + 1, b.image * width + cb + 1
    kinds, inverse = np.unique(np.concatenate([ga, gb]), return_inverse=True)
    ia, ib = inverse[: len(ga)], inverse[len(ga) :]
    lone_g, lone_p = first_of(ib, len(kinds), rank_g), first_of(ia, len(kinds), rank_p, fall, kind)
    best, raw = first_of(i, len(a.rows), rank_g[j], n), first_of(j, len(b.rows), rank_p[i], fall[i], kind[i], n)
    best_g = np.where(best >= 0, j[best] if len(j) else -1, np.where(ca >= 0, lone_g[ia] if len(kinds) else -1, -1))
    raw_p = np.where(raw >= 0, i[raw] if len(i) else -1, np.where(cb >= 0, lone_p[ib] if len(kinds) else -1, -1))
    best_n, raw_n = (np.where(x >= 0, n[x] if len(n) else 0.0, -0.0) for x in (best, raw))
    # predictions by falling confidence take the free box of highest overlap
    order = np.lexsort((rank_p, fall, kind, a.image))
    turn = np.empty(len(order), np.int64)
    turn[order] = np.arange(len(order))
    hits = np.flatnonzero((n <= -match_iou) & (kind[i] == 1) & (c[i] >= least))
    hits = hits[np.lexsort((rank_g[j[hits]], n[hits], turn[i[hits]]))]
    got, owner = np.full(len(a.rows), -1, np.int64), {}
    key = b.image * (int(rank_g.max(initial=0)) + 1) + rank_g
    for h, p, k in zip(hits.tolist(), i[hits].tolist(), key[j[hits]].tolist(), strict=True):
        if got[p] < 0 and k not in owner:
            got[p], owner[k] = h, h
    hit = np.array([owner.get(k, -1) for k in key.tolist()], np.int64)
    got_g, got_n = np.where(got >= 0, j[got] if len(j) else -1, -1), np.where(got >= 0, n[got] if len(n) else 0.0, 0.0)
    hit_p, hit_n = np.where(hit >= 0, i[hit] if len(i) else -1, -1), np.where(hit >= 0, n[hit] if len(n) else 0.0, 0.0)
    gt, pid, lowered = b.get("gt_id"), a.get("prediction_id"), pc.negate(confidence)
    done = pa.StructArray.from_arrays(
        [
            pid.take(pa.array(order)), a.get("class_id").take(pa.array(order)), confidence.take(pa.array(order)),
            struct_of({"n": pa.array(best_n[order]), "g": picked(gt, best_g[order])}, best_g[order] >= 0),
            struct_of({"n": pa.array(got_n[order]), "g": picked(gt, got_g[order])}, got[order] >= 0),
        ],
        ["prediction_id", "class_id", "confidence", "best", "got"],
    )
    boxes = pa.StructArray.from_arrays(
        [
            gt, b.get("class_id"),
            struct_of({"n": pa.array(raw_n), "c": picked(lowered, raw_p), "p": picked(pid, raw_p)}, raw_p >= 0),
            struct_of({"n": pa.array(hit_n), "c": picked(confidence, hit_p), "p": picked(pid, hit_p)}, hit >= 0),
        ],
        ["gt_id", "class_id", "raw", "hit"],
    )
    return pa.ListArray.from_arrays(pa.array(a.at, pa.int32()), done), pa.ListArray.from_arrays(pa.array(b.at, pa.int32()), boxes)


def largest(ps: pa.ListArray, gs: pa.ListArray, least: float | None = None) -> np.ndarray:
    """By image the largest overlap of any prediction, of the least confidence on if one is given, with any box, whatever
    their classes; a confidence that is not a number is above all."""
    a, b = Side(ps), Side(gs)
    if least is not None and len(a.rows):
        confidence = a.get("confidence").cast(pa.float64())
        c = confidence.to_numpy(zero_copy_only=False)
        a.box[confidence.is_null().to_numpy(zero_copy_only=False) | (c < least)] = np.nan
    i, j = batch_pairs(a, b)
    out = np.zeros(len(ps))
    np.maximum.at(out, a.image[i], iou(a.box, b.box, i, j))
    return out


def each_batch(rows: DataFrame, schema: str, run: Callable[[pa.ListArray, pa.ListArray], list[pa.Array]]) -> DataFrame:
    """(image_id, ...) of the schema from rows (image_id, ps, gs): run gives the other columns of a batch."""
    reachable(rows.sparkSession)
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = run(batch.column(1), batch.column(2))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([batch.column(0), *found], kinds, strict=True)], schema=kinds)

    return rows.select("image_id", "ps", "gs").mapInArrow(go, schema)
