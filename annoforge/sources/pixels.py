"""Perceptual hashes from the pixels of images that Spark's image source has read.

An image becomes luma, is resampled with a windowed sinc to a few values, and gives a difference hash (9 by 8) and a
perceptual hash (32 by 32, low frequencies of its cosine transform). The resampling is separable: rows first, then
columns, each as sparse weight rows in fixed point, rounded to bytes in between, as the published method has it.
Images come in Arrow batches; a batch holds whole images, and nothing else is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoforge.functions.workers import reachable

#: Half width of the window, fraction bits of a weight, and luma of red, green and blue in 1/65536.
LOBES, BITS, RED, GREEN, BLUE = 3, 22, 19595, 38470, 7471
SIDE = 8


def luma(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Luma bytes of an image of 1 channel, or 3 or 4 that begin with blue, green, red."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return pixels[:, :, 0]
    blue, green, red = (pixels[:, :, k].astype(np.uint32) for k in range(3))
    return ((red * RED + green * GREEN + blue * BLUE + 0x8000) >> 16).astype(np.uint8)


def sinc(x: np.ndarray) -> np.ndarray:
    """The sinc function under its own wide lobe; 0 outside of it."""
    return np.where(np.abs(x) < LOBES, np.sinc(x) * np.sinc(x / LOBES), 0.0)


@lru_cache(maxsize=256)
def weights(size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, weights): what each of `wanted` values takes from a line of `size`, in fixed point, by rows padded with 0."""
    scale = size / wanted
    stretch = max(scale, 1.0)
    centre = (np.arange(wanted) + 0.5) * scale
    first = np.maximum((centre - LOBES * stretch + 0.5).astype(np.int64), 0)
    last = np.minimum((centre + LOBES * stretch + 0.5).astype(np.int64), size)
    at = np.arange(int((last - first).max()))
    w = sinc((at[None, :] + first[:, None] - centre[:, None] + 0.5) / stretch) * (at[None, :] < (last - first)[:, None])
    w = w / w.sum(axis=1, keepdims=True) * (1 << BITS)
    return first, np.trunc(w + np.where(w < 0, -0.5, 0.5)).astype(np.int64)


def resampled(lines: np.ndarray, wanted: int) -> np.ndarray:
    """Every line of bytes brought to `wanted` bytes."""
    first, w = weights(lines.shape[1], wanted)
    padded = np.pad(lines, ((0, 0), (0, w.shape[1]))).astype(np.int64)
    out = np.stack([padded[:, f : f + w.shape[1]] @ row for f, row in zip(first, w, strict=True)], axis=1)
    return np.clip((out + (1 << (BITS - 1))) >> BITS, 0, 255).astype(np.uint8)


def small(grey: np.ndarray, width: int, height: int) -> np.ndarray:
    """An image of width by height; a direction that has its size already is left as it is."""
    if grey.shape[1] != width:
        grey = resampled(grey, width)
    return grey if grey.shape[0] == height else resampled(grey.T, height).T


def hex_of(bits: np.ndarray) -> str:
    return np.packbits(bits.ravel().astype(np.uint8)).tobytes().hex().upper()


def difference_hash(grey: np.ndarray, side: int = SIDE) -> str:
    """Each value against the next in its row."""
    low = small(grey, side + 1, side)
    return hex_of(low[:, :-1] > low[:, 1:])


@lru_cache(maxsize=4)
def waves(side: int, n: int) -> np.ndarray:
    u, x = np.arange(side)[:, None], np.arange(n)[None, :]
    return np.sqrt(np.where(u == 0, 1, 2) / n) * np.cos(np.pi * (2 * x + 1) * u / (2 * n))


def perceptual_hash(grey: np.ndarray, side: int = SIDE) -> str:
    """Low frequencies against their median, the constant one left out of that."""
    n = 4 * side
    w = waves(side, n)
    low = w @ small(grey, n, n).astype(np.float64) @ w.T
    return hex_of(low >= np.median(low.ravel()[1:]))


def image_hashes(spark: SparkSession, path: str, side: int = SIDE) -> DataFrame:
    """(path, width, height, dhash, phash) of all images below a folder; hashes are null where a file is no image."""
    reachable(spark)
    read = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(path)
    rows = read.select("image.origin", "image.width", "image.height", "image.nChannels", "image.data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                origin, width, height, channels, data = (batch.column(k)[i].as_py() for k in range(5))
                good = bool(width and width > 0 and height > 0 and channels in (1, 3, 4) and data is not None and len(data) == width * height * channels)
                grey = luma(data, height, width, channels) if good else None
                out.append((origin, width if good else None, height if good else None, difference_hash(grey, side) if good else None, perceptual_hash(grey, side) if good else None))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["path", "width", "height", "dhash", "phash"])

    found = rows.mapInArrow(run, "path string, width int, height int, dhash string, phash string")
    return found.withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
