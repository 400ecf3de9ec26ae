"""Shared helpers of the training-data operators.

Spark partitions and shuffles the work; inside a task numpy works on whole
Arrow batches. Nothing here sends data through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmine.session import ensure_checkpoint_dir

# Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 2 << 20

# White space between words: U+0020 and U+0009 to U+000D (fixed values).
SPACES = " \t\n\x0b\x0c\r"

U64 = np.uint64


# ------------------------------------------------------------------ storage

def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table under the shared ``spark.checkpoint.dir`` and
    read it back: later readers survive lost executors and share one result."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def buckets(spark: SparkSession) -> int:
    """Buckets of a packed shuffle: as many as the session's shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------ column helpers

def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (null: empty)."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(flat, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (a one-element transform)."""
    return F.transform(F.array(value), body)[0]


# ----------------------------------------------------------------- numpy hash

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int, cache={}) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    got = cache.get(base)
    if got is None or len(got) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        got = np.full(size, base, U64)
        got[0] = 1
        got = np.cumprod(got, dtype=U64)
        if size <= 1 << 22:
            cache[base] = got
    return got[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, lower: bool):
    """Words of texts laid end to end in ``data`` (bytes); ``starts`` has each
    text's first byte plus the end. Returns (64-bit hash of each word, number of
    words of each text, first byte of each word, byte after each word)."""
    solid = ~_IS_SPACE[data]
    n_docs = len(starts) - 1
    if not len(data) or not solid.any():
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), np.zeros(n_docs, np.int64), none, none
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = starts[:-1][starts[:-1] < len(data)]
    first[edges] = solid[edges]
    begin = np.flatnonzero(first)
    at = np.flatnonzero(solid)
    slot = np.searchsorted(at, begin)
    length = np.diff(np.append(slot, len(at)))
    place = np.arange(len(at)) - np.repeat(slot, length)
    value = (_LOWER if lower else _TABLE)[data[at]] * _powers(_BASE, int(length.max()))[place]
    hashes = mix(np.add.reduceat(value, slot) + length.astype(U64))
    counts = np.diff(np.searchsorted(begin, starts))
    return hashes, counts, begin, begin + length


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words of one text (empty if fewer)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    if k <= 8:
        out = np.zeros(n, U64)
        for j in range(k):
            out = out * U64(_BASE) + hashes[j:j + n]
        return mix(out)
    total = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * _powers(_BASE, len(hashes)), out=total[1:])
    return mix((total[k:] - total[:-k]) * _powers(_INVERSE, n))


def digest(data: bytes) -> int:
    """64-bit digest of a text's bytes."""
    import xxhash

    return xxhash.xxh3_64_intdigest(data)


def text_steps(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string column into steps of about ``STEP_BYTES``: (first row,
    row after the last, bytes, first byte of each text plus the end). A null
    is an empty text. Whole texts, never parts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + column.offset)[column.offset:]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + STEP_BYTES, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


# -------------------------------------------------------------- packed shuffle

def packed(bucket: np.ndarray, n: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch | None:
    """One row per bucket with its part of each column as bytes, so that a
    shuffle moves few large rows instead of one row per element."""
    if not len(bucket):
        return None
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n + 1))
    full = np.flatnonzero(np.diff(cuts))
    arrays = [pa.array(full.astype(np.int32))]
    for values in columns.values():
        raw = values[order]
        arrays.append(pa.array([raw[cuts[b]:cuts[b + 1]].tobytes() for b in full], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["bucket", *columns])


def unpacked(rows, name: str, kind) -> np.ndarray:
    """The elements of column ``name`` of packed rows (a pandas frame)."""
    return np.frombuffer(b"".join(rows[name]), kind)
