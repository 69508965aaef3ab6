"""Shared helpers: table readers, Arrow text buffers, a vectorised tokenizer and run helpers.

Python code here runs inside Spark tasks on Arrow batches. Every helper works
on a bounded block of whole texts (``text_blocks``): memory follows the block
size and the longest single text, never the partition.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import ensure_checkpoint_dir, shared_scratch_path

# bytes of text that one numpy pass works on; a longer text is a block of its own
BLOCK_BYTES = 1 << 21


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session."""
    ensure_checkpoint_dir(spark)
    return shared_scratch_path(spark, f"llm-{name}")


#: rows of a file, at least about, where the number of rows is known
ROWS_A_FILE = 1 << 14


def stored(df: DataFrame, name: str, rows: int | None = None, each: int = ROWS_A_FILE) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts the lineage).

    ``rows``: the most that ``df`` can have, about. Partitions that would then hold less than ``each`` are written together; that
    leaves large tables as they are. Without its native library Hadoop's local file system starts some seven processes a file, and
    whoever looks on at that moment sees the memory of an executor's JVM twice.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    if rows is not None:
        df = df.coalesce(max(-(-rows // each), 1))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_column(name: str = "text"):
    """The text as a string, NULL read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def as_binary(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one uint8 buffer and n + 1 int64 offsets; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def text_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together hold about ``limit`` bytes (at least one row each)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def segment_ids(counts: np.ndarray) -> np.ndarray:
    """0,0,..,1,1,..: the row number of each element when row i has counts[i] elements."""
    return np.repeat(np.arange(len(counts)), counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of arange(starts[i], starts[i] + counts[i])."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BITS = 11
_STEP = 1 << _BITS


def _cumulated(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n."""
    table = np.full(n, base, np.uint64)
    table[0] = 1
    return np.cumprod(table)


_LOW, _LOW_INV = _cumulated(_BASE, _STEP), _cumulated(_BASE_INV, _STEP)


def _high(base: int, n: int) -> np.ndarray:
    """base**(i * _STEP) modulo 2**64 for all i * _STEP < n: with the powers below _STEP it gives every one, and no worker keeps them all."""
    return _cumulated(pow(base, _STEP, 1 << 64), max(-(-n // _STEP), 1))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] = sum over j < i of (data[j] + 1) * base**j, modulo 2**64."""
    power = (_high(_BASE, len(data))[:, None] * _LOW).ravel()[: len(data)]
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.add(data, np.uint64(1), out=out[1:], dtype=np.uint64)
    np.multiply(out[1:], power, out=power)
    np.cumsum(power, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span [start, end): equal strings give equal values wherever they stand."""
    high = _high(_BASE_INV, len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * (high[starts >> _BITS] * _LOW_INV[starts & (_STEP - 1)]))


# byte classes: 0 white space, 1 letter, digit or any byte of a non-ASCII character, 2 other
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
for _c in range(128):
    if chr(_c).isalnum():
        _CLASS[_c] = 1
_CLASS[128:] = 1


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case, byte by byte (lengths stay)."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    if len(data) > 1 and (data == 0xC3).any():
        second = out[1:]
        second[(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)] += 32
    return out


class Tokens:
    """Tokens of a block of texts: ``start``/``end`` byte positions, ``count`` per text and ``hash``."""

    __slots__ = ("start", "end", "count", "hash", "lower")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, punctuation: bool = False):
        """Words are runs of letters and digits; with ``punctuation`` its runs are tokens as well."""
        lower = lower_bytes(data)
        kind = _CLASS[data]
        if not punctuation:
            kind = (kind == 1).astype(np.uint8)
        n = len(data)
        edge = np.empty(n + 1, bool)
        edge[0] = edge[n] = True
        if n:
            np.not_equal(kind[1:], kind[:-1], out=edge[1:n])
        edge[offsets] = True
        cut = np.flatnonzero(edge)
        start, end = cut[:-1], cut[1:]
        keep = kind[start] != 0 if n else np.zeros(0, bool)
        self.start, self.end = start[keep], end[keep]
        self.count = np.diff(np.searchsorted(self.start, offsets))
        prefix = prefix_hash(lower)
        self.hash = span_hash(prefix, self.start, self.end)
        self.lower = lower


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` tokens within each text, and their number per text.

    A text with fewer tokens than ``size`` (but at least one) gives one shingle of all its tokens.
    """
    n = np.maximum(counts - size + 1, np.minimum(counts, 1))
    first = np.cumsum(counts) - counts
    at = ranges(first, n)
    length = np.repeat(np.minimum(counts, size), n)
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        more = k < length
        if more.all():
            out = mix64(out * np.uint64(_BASE) + hashes[at + k])
        else:
            out[more] = mix64(out[more] * np.uint64(_BASE) + hashes[at[more] + k])
    return out, n


def release_memory() -> None:
    """Give back what the allocators of this Python worker hold but no longer use: it lives on, idle, beside the stages that follow."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def _libc() -> ctypes.CDLL | None:
    """The C library where it can return free memory to the system (glibc)."""
    try:
        libc = ctypes.CDLL(None)
        return libc if hasattr(libc, "malloc_trim") else None
    except OSError:
        return None


_LIBC = _libc()
