"""Removal of repeated lines: exact copies, and lines within a few edits, by a segment-partition join.

A line takes part if it has at least `min_chars` code points and holds a word (or is long). An occurrence goes
if an equal or similar line occurs earlier, in the order of document id, hash of the text and line number.
Similar: the edit distance is at most what the shorter line's length allows, one for each CHARS_PER_EDIT code
points up to MOST_EDITS, or what `max_edits` says: a number for all lengths, or growing() with another end. The first occurrence of each text stands for the text.
Lines that allow no edit take part by their hash alone. Texts of lines are told apart by 128-bit hashes.

The join: lines of one class of lengths (CHARS_PER_EDIT wide) that allow k edits have k + 1 segments, so that a
similar line that is as long or longer holds one of them unchanged, at a place that the lengths and the
segment's number bound. From each segment, and from each stretch of the longer line that may be one, comes
one substring: that which starts where a short hash is least among the first STARTS places. An unchanged
segment gives the same substring, and neighbouring stretches mostly share theirs, so that a line asks for some
twenty substrings rather than for well over a hundred. Equal (class, segment, substring) give candidates;
counts of characters by 32 kinds and of neighbouring pairs by 64 kinds (modulo 4, as Gray code, so that an edit
changes at most two and four bits of them) reject nearly all that are not similar, and a banded bit-parallel
edit distance, run for many pairs at once, verifies the rest on whole texts.

Substrings travel as hashes, packed by range of hashes; a task sorts a range at a time and keeps what several
lines have. A range that one substring fills beyond RANGE_MOST entries is passed on as it comes.

Frequent substrings: as a text only needs one earlier similar text, every list first proposes its earliest
text to all others. Only texts that this leaves, as later ones, meet the rest of their lists, in blocks of at
most LIST_BLOCK texts or LIST_BYTES a side, so that no task gets a whole long list; a block gives the texts that
have an earlier similar one, never the pairs.

Results: null texts have no line and stay null. Documents that lose every line go; documents that had
nothing to lose stay as they are, empty ones too. Rows of one id and one text are one document: what goes from
one goes from all, and they do not make each other's lines go; rows of one id with different texts are
different documents. Null ids take no part and stay. All columns stay, whatever their names. An empty
table gives an empty one. Ties cannot occur: two places of one document differ in line number.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoforge.llm import pieces
from annoforge.llm.shared import bounded_batches, cut, fresh, named, scope, small, table, tidy

#: Production parameters.
MOST_EDITS, CHARS_PER_EDIT, MIN_CHARS = 6, 24, 1
#: Places that a substring may start at in a long enough segment, and letters of the hash that picks one.
STARTS, GRAM, LONG_SEGMENT = 5, 4, 16
WORD = re.compile(r"\w")
#: Text bytes looked at together; entries that a task packs at a time; bytes of a range; entries held of one range.
SLICE_BYTES, PACK, RANGE_BYTES, RANGE_MOST, LIST_BLOCK, LIST_BYTES = 512 << 10, 1 << 19, 24 << 20, 1 << 22, 2048, 4 << 20
#: Lines that make a substring of a crowded range frequent: its entries pass on as they come.
FREQUENT = 4096
#: Characters of a pair up to which its distance is found by a table, and cells of a table for many pairs.
TABLE_CHARS, TABLE_CELLS = 1 << 15, 1 << 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def growing(most: int = MOST_EDITS) -> Callable[[int], int]:
    """One edit for each CHARS_PER_EDIT code points, up to `most`: what fits in the words of bits is 30."""
    if not 0 <= most <= 30:
        raise ValueError("most edits must be from 0 to 30")
    return lambda n: min(most, n // CHARS_PER_EDIT)


def allowed(max_edits: int | Callable[[int], int] | None = None) -> Callable[[int], int]:
    """The edits that a length allows; a text has more characters than edits, so that no segment is empty."""
    if max_edits is None:
        return growing()
    if callable(max_edits):
        return max_edits
    return lambda n: max_edits if n > max_edits else 0


def base(length: int) -> int:
    """The least length of a length's class; short lengths are classes of their own."""
    return length if length < CHARS_PER_EDIT else length - length % CHARS_PER_EDIT


def spots(n: int, edits: Callable[[int], int]) -> list[tuple[int, int, int, int, int, int]]:
    """(class, segment, start, segment's size, starts to choose from, own start or -1) of what a line of n characters asks for.

    With d the difference in length, segment i of k + 1 of the partner can start in the line only where at most
    i edits come before it and at most k - i after it."""
    spread: dict[int, list[int]] = {}
    for partner in range(max(1, n - edits(n)), n + 1):
        if n - partner <= edits(partner):
            spread.setdefault(base(partner), []).append(n - partner)
    out = []
    for b, ds in spread.items():
        k = edits(b)
        size = b // (k + 1)
        starts = STARTS if k > 2 and size >= LONG_SEGMENT else 1
        for i in range(k + 1 if k else 0):
            lo, hi = max(-i, min(ds) - (k - i)), min(i, max(ds) + (k - i))
            own = i * size if b == base(n) else -1
            out += [(b, i, at, size, starts, own) for at in range(max(0, i * size + lo), min(n - size, i * size + hi) + 1)]
    return out


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance of a and b is at most k.

    Vertical differences in a band of 2k + 1 cells around the diagonal are bits of two words that slide
    along with it, so that a column costs a few word operations whatever the length."""
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if n - m > k:
        return False
    if a == b:
        return True
    if not m:
        return n <= k
    width = 2 * k + 1
    full = (1 << width) - 1
    # bit r of a word is row j - k + r of column j (rows of a count from 1); rows outside a never match
    up, down = full ^ ((1 << (k + 1)) - 1), 0  # going down column 0 adds 1 below row 0
    score = k  # of the band's lowest cell in column 0: row k
    top = 1 << (width - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    for j in range(1, n + 1):
        # rows j - k .. j + k, row r matching where a[r - 1] == b[j - 1]
        bits = where.get(b[j - 1], 0)
        shift = j - k - 1
        match = (bits >> shift if shift >= 0 else bits << -shift) & full
        # move the band one row down: differences keep their rows, the new lowest row starts as plus one
        up, down = (up >> 1) | top, down >> 1
        zero = ((((match & up) + up) ^ up) | match | down) & full
        plus = down | (~(zero | up) & full)
        minus = up & zero
        # the lowest cell moves diagonally
        score += 0 if zero & top else 1
        horizontal = (plus << 1) & full
        down_new = horizontal & zero
        up = ((minus << 1) & full) | (~(zero | horizontal) & full)
        down = down_new
    # the lowest cell is row n + k of column n; climb to row m
    for r in range(n + k, m, -1):
        bit = 1 << (r - (n - k))
        score -= 1 if up & bit else 0
        score += 1 if down & bit else 0
    return score <= k


def gray(cells: np.ndarray, n: int, kinds: int) -> np.ndarray:
    """Counts by row and kind of cells row * kinds + kind, modulo 4: two bits each of which neighbouring counts share one; longs by row.

    Cells beyond the n rows do not count."""
    counts = np.bincount(cells, minlength=kinds * n)[: kinds * n].astype(np.uint8) & 3
    high = counts >> 1
    bits = np.stack([high, high ^ (counts & 1)], axis=1)
    return np.packbits(bits.reshape(n, 2 * kinds), axis=1).view(np.int64)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def similar(pairs: list[tuple[np.ndarray, np.ndarray]], edits: list[int]) -> np.ndarray:
    """Whether each pair of code points is within its number of edits: within(), for many pairs at once."""
    out = np.zeros(len(pairs), bool)
    todo: dict[int, list] = {}
    for i, ((x, y), k) in enumerate(zip(pairs, edits, strict=True)):
        if len(x) > len(y):
            x, y = y, x
        m, n = len(x), len(y)
        if n - m > k:
            continue
        # what is equal at both ends goes
        differ = np.flatnonzero(x != y[:m])
        if not len(differ):
            out[i] = True
            continue
        lo = int(differ[0])
        tail = np.flatnonzero(x[::-1] != y[::-1][:m])
        same = min(m - lo, int(tail[0]) if len(tail) else m)
        todo.setdefault(k, []).append((n - same - lo, i, x[lo : m - same], y[lo : n - same]))
    for k, rows in todo.items():
        rows.sort(key=lambda r: r[0])
        lo = 0
        while lo < len(rows):
            hi, size = lo + 1, rows[lo][0]  # about as many cells at a time, whatever the lengths
            if size > TABLE_CHARS:
                while hi < len(rows) and hi - lo < 2048 and (hi - lo) * rows[hi][0] < 1 << 20:
                    hi += 1
            else:
                while hi < len(rows) and rows[hi][0] <= TABLE_CHARS and (size + rows[hi][0]) * (2 * k + 1) < TABLE_CELLS:
                    size += rows[hi][0]
                    hi += 1
            part = rows[lo:hi]
            out[[r[1] for r in part]] = (bands if rows[lo][0] > TABLE_CHARS else reaches)([r[2] for r in part], [r[3] for r in part], k)
            lo = hi
    return out


def reaches(xs: list[np.ndarray], ys: list[np.ndarray], k: int) -> np.ndarray:
    """within() by the furthest place of x that each diagonal has with 0, 1, ... k edits; xs are no longer than ys.

    A table says for every place and diagonal where the next unequal characters are, so that the steps are as many
    as the edits, whatever the lengths. It holds 2k + 1 numbers for a character."""
    m, n = (np.array([len(v) for v in side]) for side in (xs, ys))
    room = n + k + 1
    begin = k + np.cumsum(room) - room
    size = k + int(room.sum()) + k
    # what fills the room between texts is unequal to all
    a, b = np.zeros(size, np.uint32), np.ones(size, np.uint32)
    for side, length, to in ((xs, m, a), (ys, n, b)):
        to[np.arange(length.sum()) + np.repeat(begin - (np.cumsum(length) - length), length)] = np.concatenate(side) + np.uint32(2)
    places = np.arange(size, dtype=np.int32)
    unequal = np.full((2 * k + 1, size), size, np.int32)
    for d in range(-k, k + 1):
        own = unequal[d + k]
        np.copyto(own[k : size - k], places[k : size - k], where=a[k : size - k] != b[k + d : size - k + d])
        np.minimum.accumulate(own[::-1], out=own[::-1])
    diagonal = np.arange(-k, k + 1)
    last = np.minimum(m[:, None], n[:, None] - diagonal)
    at, end = begin[:, None], (np.arange(len(m)), n - m + k + 1)
    reach = np.full((len(m), 2 * k + 3), -size, np.int64)
    reach[:, k + 1] = unequal[k][begin] - begin
    out = reach[end] >= m
    for _ in range(k):
        # x's character replaced, x's character left out, a character of y put in
        now = np.minimum(np.maximum(np.maximum(reach[:, 1:-1], reach[:, 2:]) + 1, reach[:, :-2]), last)
        reach[:, 1:-1] = np.where(now < 0, -size, unequal[diagonal + k, at + np.maximum(now, 0)] - at)
        out |= reach[end] >= m
    return out


def bands(xs: list[np.ndarray], ys: list[np.ndarray], k: int) -> np.ndarray:
    """The columns of within(), a word for each pair; xs are no longer than ys."""
    m, n = (np.array([len(v) for v in side]) for side in (xs, ys))
    width, widest = 2 * k + 1, int(n.max())
    a, b = np.zeros((len(xs), widest + width), np.uint32), np.ones((len(ys), widest), np.uint32)
    for i, (x, y) in enumerate(zip(xs, ys, strict=True)):
        a[i, k : k + len(x)], b[i, : len(y)] = x + np.uint32(2), y + np.uint32(2)
    full, top = (1 << width) - 1, 1 << (width - 1)
    weights = (1 << np.arange(width)).astype(np.int64)
    up, down, score = (np.full(len(xs), v, np.int64) for v in (full ^ ((1 << (k + 1)) - 1), 0, k))
    for j in range(1, widest + 1):
        match = (a[:, j - 1 : j - 1 + width] == b[:, j - 1 : j]) @ weights
        up_, down_ = (up >> 1) | top, down >> 1
        zero = ((((match & up_) + up_) ^ up_) | match | down_) & full
        plus, minus = down_ | (~(zero | up_) & full), up_ & zero
        going = j <= n
        across = (plus << 1) & full
        score = np.where(going & ((zero & top) == 0), score + 1, score)
        up = np.where(going, ((minus << 1) & full) | (~(zero | across) & full), up)
        down = np.where(going, across & zero, down)
    for bit in range(width - 1, -1, -1):  # climb from the lowest cell to the row of the shorter one's end
        beyond = bit + n - k > m
        score += np.where(beyond, (down >> bit & 1) - (up >> bit & 1), 0)
    return score <= k


class Lines:
    """The lines of an Arrow column of texts that take part, a slice of bytes at a time."""

    def __init__(self, max_edits: int | Callable[[int], int] | None, min_chars: int):
        self.edits, self.min_chars = allowed(max_edits), min_chars
        self.tables: dict[int, np.ndarray] = {}
        self.powers = np.zeros((2, 0), np.uint64)

    def slices(self, column: pa.Array) -> Iterator[tuple]:
        """(texts' numbers, line numbers, bytes, byte bounds (2, n)) of the lines, by slices of whole lines."""
        nulls = column.is_null().to_numpy(zero_copy_only=False)
        data, offsets = pieces.utf8(column)
        breaks = np.flatnonzero(data == 10)
        of = np.searchsorted(offsets, breaks, side="right") - 1
        text = np.concatenate([np.flatnonzero(~nulls), of])
        start = np.concatenate([offsets[:-1][~nulls], breaks + 1])
        order = np.lexsort((start, text))
        text, start = text[order], start[order]
        last = np.ones(len(text), bool)
        last[:-1] = text[1:] != text[:-1]
        stop = np.empty(len(text), np.int64)
        stop[:-1] = start[1:] - 1
        stop[last] = offsets[text[last] + 1]
        first = np.flatnonzero(np.concatenate([[True], last[:-1]])) if len(text) else np.zeros(0, np.int64)
        number = np.arange(len(text)) - np.repeat(first, np.diff(np.concatenate([first, [len(text)]])))
        lo = 0
        while lo < len(text):
            hi = max(lo + 1, int(np.searchsorted(stop, start[lo] + SLICE_BYTES, side="right")))
            begin = int(start[lo])
            yield text[lo:hi], number[lo:hi], data[begin : int(stop[hi - 1])], np.stack([start[lo:hi], stop[lo:hi]]) - begin
            lo = hi

    def read(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points, their bounds (2, n) by line, edits by line, and which lines take part."""
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        if len(points) != len(data):
            at_ = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
        else:
            at_ = at
        n = at_[1] - at_[0]
        sizes, back = np.unique(n, return_inverse=True)
        k = np.array([self.edits(x) for x in sizes.tolist()], np.int32)[back] if len(n) else np.zeros(0, np.int32)
        good = n >= self.min_chars
        for i in np.flatnonzero(good & (n < CHARS_PER_EDIT)).tolist():
            good[i] = WORD.search(data[at[0, i] : at[1, i]].tobytes().decode()) is not None
        return points, at_, k, good

    def kinds(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        """By line, three words of bits: counts of characters by 32 kinds, of pairs of neighbours by 64, in Gray code."""
        n, sizes = at.shape[1], at[1] - at[0]
        line = np.repeat(np.arange(0, n * 64, 64), sizes)
        own = points[points != 10]
        pair = line[:-1] + ((own[:-1] * np.uint32(0x85EBCA77) ^ own[1:]) * np.uint32(0xC2B2AE3D) >> np.uint32(26))
        ends = np.cumsum(sizes) - 1
        pair[ends[(ends >= 0) & (ends < len(pair))]] = n * 64  # the next character is another line's
        line >>= 1
        line += own & 31
        return np.concatenate([gray(line, n, 32), gray(pair, n, 64)], axis=1)

    def keys(self, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Line and key (lowest bit: own segment) of every substring that the lines have or ask for."""
        size = len(points) + 1
        if self.powers.shape[1] < size:
            ones = np.full((2, size), _FACTOR, np.uint64)
            ones[1], ones[:, 0] = _INVERSE, 1
            self.powers = np.cumprod(ones, axis=1)
        with np.errstate(over="ignore"):
            total = np.zeros(size, np.uint64)
            np.multiply(points + np.uint32(0x1F3), self.powers[0, : size - 1], out=total[1:])
            np.cumsum(total, out=total)
            # the place of the least hash among STARTS places from each on
            wide = np.zeros(len(points) + GRAM + STARTS, np.uint32)
            wide[: len(points)] = points
            least = wide[: len(points) + STARTS].copy()
            for g in range(1, GRAM):
                least = (least ^ (least >> np.uint32(15))) * np.uint32(0x85EBCA77) + wide[g : g + len(least)]
            least = (least ^ (least >> np.uint32(13))) * np.uint32(0xC2B2AE3D)
            ahead, value = np.zeros(len(points), np.uint8), least[: len(points)].copy()
            for d in range(1, STARTS):
                lower = least[d : d + len(points)] < value
                np.maximum(ahead, lower.view(np.uint8) * np.uint8(d), out=ahead)
                np.minimum(value, least[d : d + len(points)], out=value)
            sizes, back = np.unique(at[1] - at[0], return_inverse=True)
            if len(self.tables) > 4096:
                self.tables.clear()
            for n in sizes.tolist():
                if n not in self.tables:
                    self.tables[n] = np.array(spots(n, self.edits), np.int64).reshape(-1, 6)
            rows = [self.tables[n] for n in sizes.tolist()]
            count = np.array([len(r) for r in rows], np.int64)
            begin = np.concatenate([[0], np.cumsum(count)[:-1]]) if len(rows) else np.zeros(0, np.int64)
            own = count[back]
            line = np.repeat(np.arange(at.shape[1]), own)
            spot = np.arange(len(line)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(begin[back], own)
            every = np.concatenate(rows) if rows else np.zeros((0, 6), np.int64)
            b, i, start, size_, starts, mine = every[spot].T
            first = at[0][line]
            chosen = starts > 1
            place = first + start
            place += ahead[np.minimum(place, len(points) - 1)] * chosen
            own_place = first + np.maximum(mine, 0)
            is_own = (mine >= 0) & (place == own_place + ahead[np.minimum(own_place, len(points) - 1)] * chosen)
            new = np.ones(len(line), bool)
            new[1:] = (place[1:] != place[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1]) | (line[1:] != line[:-1])
            line, place, b, i, is_own, end = line[new], place[new], b[new], i[new], is_own[new], (place + size_ - starts + 1)[new]
            key = (total[end] - total[place]) * self.powers[1][place]
            key ^= (b * 64 + i).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            key = (key ^ (key >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            key = (key ^ (key >> np.uint64(32))) & ~np.uint64(1) | is_own.astype(np.uint64)
        return line, key


def hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """128-bit hashes of the lines' bytes, as two longs by row."""
    view = memoryview(np.ascontiguousarray(data))
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(at[0].tolist(), at[1].tolist(), strict=True)]), np.int64).reshape(-1, 2)


def occurrences(docs: DataFrame, max_edits: int | Callable[[int], int] | None, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(h, g, id, t, line, n, k, sig, s1, s2) of every line that takes part: its hash, place, length, edits, counts of kinds."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = Lines(max_edits, min_chars)
        for batch in batches:
            for text, number, data, at in lines.slices(batch.column(1)):
                points, bounds, k, good = lines.read(data, at)
                if good.any():
                    sig = lines.kinds(points, bounds)[good]
                    h = hashes(data, at[:, good])
                    of = pa.array(text[good])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column(0).take(of), batch.column(2).take(of), pa.array(number[good].astype(np.int32)), pa.array((bounds[1] - bounds[0])[good].astype(np.int32)), pa.array(k[good]), *[pa.array(np.ascontiguousarray(sig[:, i])) for i in range(3)]],
                        ["h", "g", "id", "t", "line", "n", "k", "sig", "s1", "s2"],
                    )
            tidy()

    rows = documents(docs, id_col, text_col).where("id is not null and text is not null").select("id", "text", "t")
    return rows.mapInArrow(run, f"h bigint, g bigint, id {kind}, t bigint, line int, n int, k int, sig bigint, s1 bigint, s2 bigint")


def documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, t): what tells a document."""
    return docs.select(named(id_col).alias("id"), named(text_col).alias("text"), F.xxhash64(named(text_col)).alias("t"))


def shared_keys(docs: DataFrame, max_edits: int | Callable[[int], int] | None, min_chars: int, lines: int, id_col: str, text_col: str) -> DataFrame:
    """(key, h, own) of substrings that several lines have, one of them as its own segment."""
    bits = max(4, int(np.ceil(np.log2(max(1, lines * 20 * 16 / RANGE_BYTES)))))
    shift = np.uint64(64 - bits)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, size, seen = Lines(max_edits, min_chars), [], 0, set()

        def packed():
            every = np.concatenate(held)
            held.clear()
            part = (every[:, 0] >> shift).astype(np.uint32)
            order = np.argsort(part, kind="stable")
            every, part = every[order], part[order]
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            for lo in range(0, len(cuts) - 1, 64):
                own = cuts[lo : lo + 65]
                yield pa.RecordBatch.from_arrays([pa.array(part[own[:-1]].astype(np.int64)), pa.array([every[a:b].tobytes() for a, b in zip(own, own[1:])], pa.binary())], ["part", "entries"])

        for batch in batches:
            for _, _, data, at in reader.slices(batch.column(0)):
                points, bounds, k, good = reader.read(data, at)
                use = np.flatnonzero(good & (k > 0))
                h = hashes(data, at[:, use])[:, 0]
                if len(seen) > 200_000:
                    seen.clear()
                fresh_ = [i for i, x in enumerate(h.tolist()) if not (x in seen or seen.add(x))]  # copies ask for the same
                if fresh_:
                    line, key = reader.keys(points, bounds[:, use[fresh_]])
                    held.append(np.stack([key, h[fresh_].view(np.uint64)[line]], axis=1))
                    size += len(key)
                if size > PACK:
                    yield from packed()
                    size = 0
            tidy()
        if held:
            yield from packed()

    def several(entries: np.ndarray) -> np.ndarray:
        """Entries (key, h) of keys that two lines have, one as its own; each line once."""
        key = entries[:, 0] >> np.uint64(1)
        order = np.argsort(key)
        key = key[order]
        twice = np.zeros(len(key), bool)
        twice[1:] = key[1:] == key[:-1]
        twice[:-1] |= twice[1:]
        rows = entries[order[twice]]
        rows = rows[np.lexsort((~rows[:, 0], rows[:, 1], rows[:, 0] >> np.uint64(1)))]
        key = rows[:, 0] >> np.uint64(1)
        new = np.ones(len(rows), bool)
        new[1:] = (key[1:] != key[:-1]) | (rows[1:, 1] != rows[:-1, 1])
        rows, key = rows[new], key[new]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        sizes = np.diff(np.concatenate([begin, [len(key)]]))
        some = np.add.reduceat((rows[:, 0] & np.uint64(1)).astype(np.int64), begin) > 0 if len(begin) else np.zeros(0, bool)
        return rows[np.repeat((sizes > 1) & some, sizes)]

    def out(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array((rows[:, 0] >> np.uint64(1)).astype(np.int64)), pa.array(rows[:, 1].view(np.int64)), pa.array((rows[:, 0] & np.uint64(1)).astype(bool))], ["key", "h", "own"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size, most, frequent = None, [], 0, RANGE_MOST, np.zeros(0, np.uint64)
        for batch in batches:
            for now, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if now != part:
                    if held:
                        yield out(several(np.concatenate(held)))
                    part, held, size, most, frequent = now, [], 0, RANGE_MOST, np.zeros(0, np.uint64)
                rows = np.frombuffer(raw.as_buffer(), np.uint64).reshape(-1, 2)
                if len(frequent):  # these pass on as they come
                    known = np.isin(rows[:, 0] >> np.uint64(1), frequent)
                    if known.any():
                        yield out(rows[known])
                        rows = rows[~known]
                held.append(np.array(rows))
                size += len(rows)
                if size > most:
                    rows = np.unique(np.concatenate(held), axis=0)
                    found, where, sizes = np.unique(rows[:, 0] >> np.uint64(1), return_inverse=True, return_counts=True)
                    many = (sizes > FREQUENT)[where]
                    if many.any():
                        frequent = np.union1d(frequent, found[sizes > FREQUENT])
                        yield out(rows[many])
                        rows = rows[~many]
                    held, size = [rows], len(rows)
                    most = max(RANGE_MOST, 2 * size)
        if held:
            yield out(several(np.concatenate(held)))

    texts = documents(docs, id_col, text_col).where("id is not null and text is not null").select("text")
    parts = texts.mapInArrow(pack, "part bigint, entries binary").repartition(min(1 << bits, 4096), "part").sortWithinPartitions("part")
    return parts.mapInArrow(unpack, "key bigint, h bigint, own boolean")


def texts_of(lines: DataFrame, firsts: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(x, text) of the lines (x: struct h, g), from the documents that they first occur in."""
    wanted = lines.select("x.h", "x.g")
    places = cut(firsts.join(wanted, ["h", "g"]).groupBy("id", "t").agg(F.collect_set("line").alias("lines")), "line-wanted")
    rows = documents(docs, id_col, text_col).join(small(places, F.lit(24) + 4 * F.size("lines")), ["id", "t"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = text.split("\n")
                texts += [own[line] for line in numbers if line < len(own)]
            h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t.encode()) for t in texts), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(texts, pa.string())], ["h", "g", "text"])

    found = rows.select("text", "lines").mapInArrow(read, "h bigint, g bigint, text string").join(wanted, ["h", "g"], "left_semi")
    return cut(found.groupBy("h", "g").agg(F.first("text").alias("text")).select(F.struct("h", "g").alias("x"), "text"), "line-texts")


def verified(pairs: DataFrame, texts: DataFrame, max_edits: int | Callable[[int], int] | None) -> DataFrame:
    """(x) of those pairs of lines (x, y: structs h, g) whose texts are within the edits they allow."""
    # a text that many others are held against is one row of the smaller side
    heads = cut(pairs.select("y").distinct().join(texts.select(F.col("x").alias("y"), F.col("text").alias("b")), "y"), "line-heads")
    both = pairs.join(texts.withColumnRenamed("text", "a"), "x").join(small(heads, F.lit(24) + F.octet_length("b")), "y")
    edits = allowed(max_edits)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [(points_of(a), points_of(b)) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield batch.select(["x"]).filter(pa.array(similar(own, [edits(min(len(a), len(b))) for a, b in own]), pa.bool_()))

    return both.select("x", "a", "b").mapInArrow(check, "x struct<h:bigint,g:bigint>")


def whole_blocks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole blocks, which are the rows of one value of the keys, and each row's block, from sorted batches."""
    held: list[pa.Table] = []

    def numbered(table_: pa.Table) -> np.ndarray:
        names = np.stack([table_.column(k).to_numpy() for k in keys])
        return np.concatenate([[0], np.cumsum((names[:, 1:] != names[:, :-1]).any(0))])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        now = pa.concat_tables(held).combine_chunks()
        block = numbered(now)
        cut_ = int(np.searchsorted(block, block[-1]))  # the last block may go on
        if cut_:
            yield now.slice(0, cut_).combine_chunks(), block[:cut_]
        held = [now.slice(cut_).combine_chunks()]
    if held:
        rest = pa.concat_tables(held).combine_chunks()
        yield rest, numbered(rest)


def blocks_found(rows: pa.Table, block: np.ndarray, edits: Callable[[int], int]) -> np.ndarray:
    """Places of `late` rows with an earlier similar row that is not late in their block; blocks are sorted by first occurrence."""
    late, own, n, k, sig, s1, s2, h, g, seen = (rows.column(c).to_numpy() for c in ("late", "own", "n", "k", "sig", "s1", "s2", "h", "g", "seen"))
    sig, s1, s2 = sig.view(np.uint64), s1.view(np.uint64), s2.view(np.uint64)
    texts = rows.column("text")
    left, other = np.flatnonzero(late), np.flatnonzero(~late)
    # every late row meets the rows before it among the others of its block
    first = np.searchsorted(block[other], block[left])
    count = np.maximum(np.searchsorted(other, left) - first, 0)
    done = np.concatenate([[0], np.cumsum(count)])
    found, lo = [], 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + (1 << 20), side="right")) - 1)
        size = count[lo:hi]
        i = np.repeat(left[lo:hi], size)
        j = other[np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[lo:hi], size)]
        lo = hi
        most = np.minimum(k[i], k[j])
        apart = np.bitwise_count(sig[i] ^ sig[j])
        good = (apart <= 2 * most) & (own[i] | own[j]) & (np.abs(n[i] - n[j]) <= most) & (h[j] != seen[i]) & ((h[i] != h[j]) | (g[i] != g[j]))
        good[good] &= np.bitwise_count(s1[i[good]] ^ s1[j[good]]).astype(np.int32) + np.bitwise_count(s2[i[good]] ^ s2[j[good]]) <= 4 * most[good]
        i, j, apart = i[good], j[good], apart[good]
        order = np.lexsort((apart, i))  # the closest first: one is enough
        i, j = i[order], j[order]
        points: dict[int, np.ndarray] = {}
        while len(i):
            now = np.arange(len(i)) - np.searchsorted(i, i) < 8
            for x in np.union1d(i[now], j[now]).tolist():
                if x not in points:
                    points[x] = points_of(texts[x].as_py())
            pairs = [(points[a], points[b]) for a, b in zip(i[now].tolist(), j[now].tolist(), strict=True)]
            hit = np.unique(i[now][similar(pairs, [edits(min(len(a), len(b))) for a, b in pairs])])
            found.append(hit)
            more = ~now & ~np.isin(i, hit)
            i, j = i[more], j[more]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def similar_earlier(firsts: DataFrame, docs: DataFrame, max_edits: int | Callable[[int], int] | None, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(h, g) of lines with a similar line that first occurs earlier."""
    lines = firsts.where("k > 0").count()
    keys = cut(shared_keys(docs, max_edits, min_chars, lines, id_col, text_col), "line-keys")
    row = F.struct(F.struct("id", "t", "line").alias("at"), F.struct("h", "g").alias("x"), "sig", "s1", "s2", "k", "n")
    facts = firsts.where("k > 0").select("h", row.alias("r"))
    live = cut(keys.groupBy("key", "h").agg(F.max("own").alias("own")).join(facts, "h").select("key", "own", "r"), "line-lists")

    def like(a, b):
        k = F.least(a["k"], b["k"])
        pairs_ = F.bit_count(a["s1"].bitwiseXOR(b["s1"])) + F.bit_count(a["s2"].bitwiseXOR(b["s2"]))
        return (F.abs(a["n"] - b["n"]) <= k) & (F.bit_count(a["sig"].bitwiseXOR(b["sig"])) <= 2 * k) & (pairs_ <= 4 * k)

    # own segments meet the earliest line of a list, other substrings the earliest own one
    heads = live.groupBy("key").agg(F.count("*").alias("size"), F.sum(F.col("r.n").cast("long")).alias("chars"), F.min("r").alias("first"), F.min(F.when(F.col("own"), F.col("r"))).alias("first_own"))
    heads = cut(heads.where("size > 1 and first_own is not null"), "line-heads")
    led = cut(live.join(heads, "key").withColumn("y", F.when(F.col("own"), F.col("first")).otherwise(F.col("first_own"))).drop("first", "first_own"), "line-led")
    star = cut(led.where((F.col("y.at") < F.col("r.at")) & like(F.col("r"), F.col("y"))).select(F.col("r.x").alias("x"), F.col("y.x").alias("y")).distinct(), "line-star")
    texts = texts_of(cut(led.where((F.col("size") > 2) | like(F.col("r"), F.col("y"))).select(F.col("r.x").alias("x")).distinct(), "line-met"), firsts, docs, id_col, text_col)
    found = cut(verified(star, texts, max_edits).distinct(), "line-found")
    # texts that are left as later ones, and all the texts of the lists that hold such
    parts = F.greatest(F.ceil(F.col("size") / LIST_BLOCK), F.ceil(F.col("chars") / LIST_BYTES)).cast("int")
    known = found.withColumn("done", F.lit(True))
    long = led.where("size > 2").withColumn("x", F.col("r.x")).withColumn("parts", parts).join(known, "x", "left").withColumn("late", F.col("done").isNull() & (F.col("y.x") != F.col("x"))).drop("done")
    open_ = long.where("late").select("key").distinct()
    long = long.join(open_, "key", "left_semi").withColumn("part", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    as_late = long.where("late").select("key", F.col("part").alias("p"), every.alias("q"), "r", "own", F.col("y.x.h").alias("seen"), F.lit(True).alias("late"))
    as_other = long.select("key", every.alias("p"), F.col("part").alias("q"), "r", "own", F.lit(0).cast("long").alias("seen"), F.lit(False).alias("late"))
    rows = as_late.unionByName(as_other).withColumn("x", F.col("r.x")).join(texts, "x")
    rows = rows.select("key", "p", "q", F.col("r.at").alias("at"), "x.h", "x.g", "late", "own", "seen", *[f"r.{c}" for c in ("n", "k", "sig", "s1", "s2")], "text")
    rows = rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "at").drop("at")
    edits = allowed(max_edits)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, block in whole_blocks(batches, ["key", "p", "q"]):
            at = np.unique(blocks_found(rows_, block, edits))
            if len(at):
                yield from rows_.select(["h", "g"]).take(pa.array(at)).combine_chunks().to_batches()

    more = rows.mapInArrow(rest, "h bigint, g bigint")
    return cut(found.select("x.h", "x.g").unionByName(more).distinct(), "line-late")


def removals(docs: DataFrame, max_edits: int | Callable[[int], int] | None = None, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, lines): numbers of the lines that go from each document that loses any; t: xxhash64 of its text."""
    bounded_batches(docs.sparkSession)
    with scope() as held:
        places = cut(occurrences(docs, max_edits, min_chars, id_col, text_col), "line-places")
        at = F.struct("id", "t", "line", "n", "k", "sig", "s1", "s2")
        firsts = cut(places.groupBy("h", "g").agg(F.count("*").alias("copies"), F.min(at).alias("f")).select("h", "g", "copies", "f.*"), "line-firsts")
        late = similar_earlier(firsts, docs, max_edits, min_chars, id_col, text_col)
        again = firsts.where("copies > 1").select("h", "g", F.struct("id", "t", "line").alias("first"))
        copies = places.join(again, ["h", "g"]).where(F.struct("id", "t", "line") != F.col("first")).select("id", "t", "line")
        similar = firsts.join(late, ["h", "g"], "left_semi").select("id", "t", "line")
        return held.keep(cut(copies.unionByName(similar).groupBy("id", "t").agg(F.sort_array(F.collect_set("line")).alias("lines")), "line-removals"))


def dedup_lines(docs: DataFrame, max_edits: int | Callable[[int], int] | None = None, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text", drop_emptied: bool = True, count: str | None = None) -> DataFrame:
    """docs with all their columns, texts without the lines that go; `count` names a column for how many went."""
    gone = removals(docs, max_edits, min_chars, id_col, text_col)
    key, text_hash, numbers, every = fresh(docs.columns, "line_id", "line_text", "line_numbers", "line_all")
    gone = small(gone, F.lit(24) + 4 * F.size("lines")).select(F.col("id").alias(key), F.col("t").alias(text_hash), F.col("lines").alias(numbers))
    rows = docs.join(gone, (named(id_col) == F.col(key)) & (F.xxhash64(named(text_col)) == F.col(text_hash)), "left")
    rows = rows.withColumn(every, F.when(F.col(numbers).isNotNull(), F.split(named(text_col), "\n", -1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(numbers))
    text = F.when(F.col(numbers).isNull(), named(text_col)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(every, i)), "\n"))
    rows = rows.withColumn(text_col, text)
    if drop_emptied:
        rows = rows.where(F.col(numbers).isNull() | named(text_col).rlike(r"\S"))
    if count:
        rows = rows.withColumn(count, F.coalesce(F.size(numbers), F.lit(0)).cast("long"))
    return rows.select(*map(named, docs.columns), *([count] if count and count not in docs.columns else []))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's lines removed, and a digest of what is left; emptied documents stay, as empty ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs, drop_emptied=False, count="n_removed")
    return out.select("doc_id", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
