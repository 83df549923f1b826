"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BATCH_BYTES = 1 << 23

_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  Texts are long, and a batch of them is there several times on its way to a Python worker and
    back, so from here on batches of the session end at BATCH_BYTES, however few rows that are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the folder that the cluster shares; a local one in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/tablescout-llm/{name}-{uuid4()}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back, so that lost executors cost one step, not all."""
    spark = frame.sparkSession
    path = scratch(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fold(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def text_bytes(column: Column) -> Column:
    """UTF-8 bytes of a text; none for null."""
    return F.coalesce(column.cast("string").cast("binary"), F.lit(b""))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def pieces(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of about `most` units at most; a longer row is a range of its own."""
    ends = np.cumsum(lengths)
    first, before = 0, 0
    while first < len(lengths):
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield first, last
        before, first = int(ends[last - 1]), last


def flat_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as one array, and the offsets of its rows.  Null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII lower case; other bytes stay."""
    return _ASCII_LOWER[data]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BASE = 0x100000001B3


@functools.lru_cache(maxsize=4)
def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _first_powers(base: int, count: int) -> np.ndarray:
    return _powers(base, max(1 << 20, 1 << (count - 1).bit_length()))[:count]


def word_hashes(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all rows, and each row's offsets among them.

    `separators` marks, for each byte value, what parts words.  The hash is a polynomial of the word's bytes,
    from differences of one running sum, so equal words get equal hashes wherever they stand.
    """
    inside = ~separators[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    row_start = offsets[:-1][offsets[:-1] < len(data)]
    before[row_start] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[row_start[row_start > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _first_powers(_BASE, len(data) + 1)[:-1], out=sums[1:])
    value = (sums[ends] - sums[starts]) * _first_powers(pow(_BASE, -1, 1 << 64), len(data) + 1)[starts]
    hashes = mixed(value ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))
    return hashes, np.searchsorted(starts, offsets)


def separators(spaces: bytes = SPACES) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(spaces, np.uint8)] = True
    return out


def gathered(values: np.ndarray, first: np.ndarray, lengths: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of values that are wanted, one after another, and their bounds."""
    sizes = lengths[wanted]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(ends[-1]) + np.repeat(first[wanted] - ends[:-1], sizes)
    return values[at], ends
