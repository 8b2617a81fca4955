"""Hashes of written images against plain loops over the published formulas."""

import math
import random
import struct
import zlib

import numpy as np
import pytest

from annoforge.sources import pixels as X


def png(path, rows, channels):
    """An image file of 8 bits a channel, by hand."""
    height, width = len(rows), len(rows[0])
    raw = b"".join(b"\x00" + bytes(v for px in row for v in (px if channels > 1 else [px])) for row in rows)

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def line(values, wanted):
    """One line resampled, value by value."""
    n, out = len(values), []
    scale = n / wanted
    stretch = max(1.0, scale)

    def f(x):
        if x == 0:
            return 1.0
        if abs(x) >= 3:
            return 0.0
        return 3 * math.sin(math.pi * x) * math.sin(math.pi * x / 3) / (math.pi * x) ** 2

    for i in range(wanted):
        centre = (i + 0.5) * scale
        lo, hi = max(0, int(centre - 3 * stretch + 0.5)), min(n, int(centre + 3 * stretch + 0.5))
        w = [f((k - centre + 0.5) / stretch) for k in range(lo, hi)]
        fixed = [int(x / sum(w) * 4194304 + (0.5 if x >= 0 else -0.5)) for x in w]
        out.append(min(255, max(0, (sum(a * b for a, b in zip(fixed, values[lo:hi])) + 2097152) >> 22)))
    return out


def shrunk(grey, width, height):
    rows = [line(r, width) for r in grey] if len(grey[0]) != width else grey
    return rows if len(rows) == height else [list(r) for r in zip(*[line(list(c), height) for c in zip(*rows)])]


def bits(flags):
    return "".join(f"{sum(b << (3 - k) for k, b in enumerate(flags[i : i + 4])):X}" for i in range(0, len(flags), 4))


def plain(grey):
    d = shrunk(grey, 9, 8)
    s = shrunk(grey, 32, 32)
    low = [sum(math.sqrt((2 if u else 1) / 32) * math.sqrt((2 if v else 1) / 32) * s[y][x] * math.cos(math.pi * (2 * y + 1) * u / 64) * math.cos(math.pi * (2 * x + 1) * v / 64) for y in range(32) for x in range(32)) for u in range(8) for v in range(8)]
    mid = sorted(low[1:])[31]
    return bits([int(a > b) for r in d for a, b in zip(r, r[1:])]), bits([int(v >= mid) for v in low]), low, mid


@pytest.mark.parametrize(("width", "height", "channels"), [(9, 8, 1), (40, 33, 1), (64, 64, 3), (7, 5, 3), (120, 31, 4)])
def test_hashes_equal_plain_loops(spark, tmp_path, width, height, channels):
    rng = random.Random(width)
    wave = lambda x, y, k: int(127 + 100 * math.sin(x / (3 + k) + y / 5) + rng.randint(-20, 20))
    rows = [[wave(x, y, 0) if channels == 1 else [wave(x, y, k) if k < 3 else 255 for k in range(channels)] for x in range(width)] for y in range(height)]
    png(tmp_path / "a.png", rows, channels)
    (tmp_path / "b.png").write_bytes(b"no image")
    got = {r["path"].rsplit("/", 1)[1]: r for r in X.image_hashes(spark, str(tmp_path)).collect()}
    assert got["b.png"]["phash"] is None and got["b.png"]["width"] is None
    grey = rows if channels == 1 else [[(p[0] * 19595 + p[1] * 38470 + p[2] * 7471 + 32768) >> 16 for p in r] for r in rows]
    d, p, low, mid = plain(grey)
    assert (got["a.png"]["width"], got["a.png"]["height"], got["a.png"]["dhash"]) == (width, height, d)
    clear = [i for i, v in enumerate(low) if abs(v - mid) > 1e-6]  # a sum in another order may decide the rest
    mine, want = (f"{int(x, 16):064b}" for x in (got["a.png"]["phash"], p))
    assert len(clear) >= 60 and all(mine[i] == want[i] for i in clear)


def test_lines_of_the_same_size_are_kept_and_flat_ones_stay_flat():
    flat = np.full((30, 50), 77, np.uint8)
    assert (X.small(flat, 9, 8) == 77).all() and X.difference_hash(flat) == "0" * 16
    ramp = np.tile(np.arange(90, dtype=np.uint8), (40, 1))
    assert X.difference_hash(ramp) == "0" * 16 and X.difference_hash(ramp[:, ::-1]) == "F" * 16
    assert X.small(ramp[:8, :9], 9, 8) is not None and (X.small(ramp[:8, :9], 9, 8) == ramp[:8, :9]).all()
