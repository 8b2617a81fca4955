"""Vectorised splitting of a batch of texts into pre-tokens or words, without a Python loop over them.

A batch is one array of code points (or UTF-8 bytes) with the offsets of its texts. Boundaries come from
a class per code point, pieces become one Arrow array over the same bytes, and `dictionary_encode` leaves
each distinct piece once, so that Python touches distinct pieces only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Code points of the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def classes() -> np.ndarray:
    """Class of every code point: letter and number by Unicode category, white space by property."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    for block in range(0, 0x110000, 0x1000):  # a block at a time: the whole range as one text takes over 100 MB
        if 0xD800 <= block < 0xE000:
            continue
        every = "".join(map(chr, range(block, block + 0x1000)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, every):
                out[block + m.start() : block + m.end()] = kind
    out[0xD800:0xE000] = OTHER
    out[WHITE_SPACE] = SPACE
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, and the n + 1 offsets; a null text is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, offsets - offsets[0]


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the bytes, and the offsets counted in code points."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    if len(points) == len(data):
        return points, offsets
    begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, begun[offsets]


def text_starts(n: int, offsets: np.ndarray) -> np.ndarray:
    """Marks the first position of every text that is not empty."""
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    return first[:n]


def contractions(points: np.ndarray, first: np.ndarray, start: np.ndarray) -> None:
    """Cut 's 't 're 've 'm 'll 'd where a piece starts at the apostrophe; changes start in place."""
    at = np.flatnonzero((points == 39) & start)
    if not len(at):
        return
    wide = np.concatenate([points, [0, 0, 0]])
    stop = np.concatenate([first, [True, True, True]])
    c1 = np.where(stop[at + 1], 0, wide[at + 1])
    c2 = np.where(stop[at + 1] | stop[at + 2], 0, wide[at + 2])
    one = np.isin(c1, [ord(c) for c in "stmd"])
    two = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l")))
    start[at[one | two] + 1] = False
    start[at[two] + 2] = False
    after = np.concatenate([at[one] + 2, at[two] + 3])
    start[after[after < len(start)]] = True


def slices(data: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first text, bytes from, offsets within) of slices of about `most` bytes: whole texts, and parts of longer ones.

    A long text is cut before a blank that follows a byte other than white space, where every pre-token
    pattern ends a piece; only a text without such a place stays whole beyond `most`."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        begin, end = int(offsets[lo]), int(offsets[hi])
        if hi > lo + 1 or end - begin <= most:
            yield lo, begin, offsets[lo : hi + 1] - begin
        else:
            while begin < end:
                stop = min(end, begin + most)
                while stop < end:  # the next such blank at or after `stop`
                    part = data[stop - 1 : min(end, stop + (1 << 16))]
                    at = np.flatnonzero((part[1:] == 32) & ~_blank_bytes()[part[:-1]])
                    if len(at):
                        stop += int(at[0])
                        break
                    stop = min(end, stop + (1 << 16))
                yield lo, begin, np.array([0, stop - begin])
                begin = stop
        lo = hi


@cache
def _blank_bytes() -> np.ndarray:
    """Bytes that may end white space: ASCII white space, and all beyond ASCII to be safe."""
    out = np.zeros(256, bool)
    out[[*WORD_ENDS, *range(0x1C, 0x20), *range(0x80, 256)]] = True
    return out


def byte_level_starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marks where the matches of the byte-level pattern start; together they cover every code point."""
    n = len(points)
    first, kind = text_starts(n, offsets), classes()[points]
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    joins = np.zeros(n, bool)  # the last white space before something else in the same text
    joins[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:]
    start |= joins
    start[np.flatnonzero(joins & (points == 32)) + 1] = False
    contractions(points, first, start)
    return start


def word_end_starts(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the pattern that drops white space and cuts every number character: starts, and what is kept."""
    first, kind = text_starts(len(points), offsets), classes()[points]
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    start |= kind == NUMBER
    contractions(points, first, start)
    return start, kind != SPACE


def widths(points: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of each code point."""
    return 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800) + (points >= 0x10000)


def distinct_pieces(data: np.ndarray, at: np.ndarray, kind=None) -> tuple[np.ndarray, pa.Array]:
    """Pieces of data starting at byte positions `at` (the last ends with data): code of each, distinct ones."""
    offsets = np.concatenate([at, [len(data)]]).astype(np.int64)
    pieces = pa.Array.from_buffers(kind or pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    coded = pieces.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


#: The bytes that end a word.
WORD_ENDS = [0x20, *range(0x09, 0x0E)]


@cache
def _word_bytes() -> np.ndarray:
    out = np.ones(256, bool)
    out[WORD_ENDS] = False
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between white-space bytes: the bytes kept, each word's start in them, each text's first word."""
    inside = _word_bytes()[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | text_starts(len(data), offsets)[1:]
    kept = data[inside]
    at = np.flatnonzero(start[inside])
    counted = np.concatenate([[0], np.cumsum(start)])
    return kept, at, counted[offsets]


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values between the bounds of each text; empty texts give 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


@cache
def _letter_bytes() -> np.ndarray:
    """ASCII letters by their lower case, bytes beyond ASCII by themselves, all else by 0."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        out[b] = ord(c.lower()) if c.isascii() and c.isalpha() else b if b >= 0x80 else 0
    return out


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters: lower-cased bytes kept, each run's start in them, each text's first run, start in data."""
    low = _letter_bytes()[data]
    inside = low > 0
    start = inside.copy()
    start[1:] &= ~inside[:-1] | text_starts(len(data), offsets)[1:]
    counted = np.concatenate([[0], np.cumsum(start)])
    return low[inside], np.flatnonzero(start[inside]), counted[offsets], np.flatnonzero(start)


def bytes_of(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow array of distinct pieces of 64-bit offsets."""
    _, where, data = distinct.buffers()
    offsets = np.frombuffer(where, np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]
