"""Helpers that several operators of this package share."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolatlas.session import clear_durable as clear_store  # noqa: F401
from schoolatlas.session import durable as store  # noqa: F401

#: A word is a longest run of code points outside space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are handed to numpy in slices of about so many bytes.
SLICE_BYTES = 1 << 20
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
RADIX = 0x9E3779B97F4A7C15
UNRADIX = pow(RADIX, -1, 1 << 64)


def ship(name: str) -> None:
    """Send a module's functions to the executors by value: they need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(30))
    h *= _MIX_A
    h ^= h >> np.uint64(27)
    h *= _MIX_B
    h ^= h >> np.uint64(31)
    return h


def slices(lengths: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes each; a longer row stands alone."""
    start, total = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if total and total + length > limit:
            yield start, row
            start, total = row, 0
        total += length
    if start < len(lengths):
        yield start, len(lengths)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, and the offsets of the rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1) modulo 2 ** 64; kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if len(have) <= 4 * SLICE_BYTES:
            _POWERS[base] = have
    return have[:n]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of the first word of every row (and their end)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IS_WORD[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    starts[cuts] = inside[cuts]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = inside[:-1] & ~inside[1:]
    ends[cuts] |= inside[cuts - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    return first, last, np.searchsorted(first, offsets)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * radix ** position before every position, modulo 2 ** 64."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(RADIX, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span, from ``prefix_sums``; equal bytes have equal hashes."""
    values = (sums[last] - sums[first]) * _powers(UNRADIX, len(sums))[first]
    return mix(values ^ (last - first).astype(np.uint64) * _MIX_B)


def every_span(sums: np.ndarray, length: int) -> np.ndarray:
    """``span_hashes`` of the ``length`` bytes from every place on."""
    values = sums[length:] - sums[:-length]
    values *= _powers(UNRADIX, len(sums))[: len(values)]
    values ^= np.uint64(length * int(_MIX_B) & 0xFFFFFFFFFFFFFFFF)
    return mix(values)


def sequence_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of values[first:last] for every pair of places; equal sequences have equal hashes."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values | np.uint64(1)) * _powers(RADIX, len(values)), out=sums[1:])
    return mix((sums[last] - sums[first]) * _powers(UNRADIX, len(sums))[first] ^ (last - first).astype(np.uint64) * _MIX_B)


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that together stand for a text; 0 and 0 for null."""
    return [
        F.coalesce(F.xxhash64(F.lit(seed), text), F.lit(0)).alias(name) for seed, name in ((1, "text_1"), (2, "text_2"))
    ]


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k words from each word on (the last k - 1 words have none)."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(RADIX) + words[i : i + n]
    return mix(out)
