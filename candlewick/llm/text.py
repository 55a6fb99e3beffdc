"""Whole Arrow batches of texts as numpy arrays: words, hashes, sampled suffixes.

Texts stay one UTF-8 buffer with offsets, and every step works on all texts of
a piece at once, so Python runs per piece and not per word.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from candlewick.session import stage

PIECE_BYTES = 1 << 20
#: Bytes of the rows that go to a Python worker at a time; 10,000 rows of long texts would be more.
BATCH_BYTES = 4 << 20

_RNG = np.random.default_rng(20240229)
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)


def _table(chars) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


#: Bytes of a word: anything but space and tab to carriage return.
PLAIN = ~_table([0x20, *range(0x09, 0x0E)])
#: Bytes of a word that is cut at ASCII punctuation too.
ALNUM = _table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
#: Powers that a worker keeps: enough for pieces of up to 2 MB, 32 MB in all. Longer texts make their own.
KEPT_POWERS = 1 << 21


def _power_table(size: int) -> dict[str, np.ndarray]:
    table = {}
    for name, base in (("up", _BASE), ("down", _INVERSE)):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        table[name] = np.cumprod(steps, dtype=np.uint64)
    return table


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2^64."""
    table = _powers
    if len(table["up"]) < n:
        table = _power_table(min(1 << (n - 1).bit_length(), KEPT_POWERS) if n <= KEPT_POWERS else n)
        if n <= KEPT_POWERS:
            _powers.update(table)
    return table["up"][:n], table["down"][:n]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)  # glibc alone has it


def given_back(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task, after which unused memory of Arrow and of the C heap, where numpy's arrays lie, goes back to the system: the worker goes on to other tasks."""
    try:
        yield from rows
    finally:
        pa.default_memory_pool().release_unused()
        _trim(0)


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python workers in batches of ``BATCH_BYTES``, which executor and worker hold several times."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offs


def pieces(data: np.ndarray, offs: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``most`` bytes: first, end, bytes, offsets from 0."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes as they are."""
    return np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)


def words(data: np.ndarray, offs: np.ndarray, table: np.ndarray = PLAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and each text's range of words."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offs[:-1]] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before &= ~edge[:-1]
    edge[:] = False
    edge[offs[1:]] = True
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after &= ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    up, _ = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums


def spans(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the values from lo to hi, the same wherever they stand."""
    _, down = powers(len(sums))
    return mixed((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return spans(prefix_sums(BYTE_VALUES[data]), starts, ends)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(hashes)
    _, down = powers(len(sums))
    return mixed((sums[k:] - sums[:-k]) * down[:n] + np.uint64(k))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def across(offs: np.ndarray, n: int, total: int) -> np.ndarray:
    """For each of ``total`` windows of n values: does it lie in one text?"""
    inside = np.ones(total, dtype=bool)
    for edge in offs[1:-1].tolist():
        inside[max(0, edge - n + 1) : edge] = False
    return inside


def released(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Store a table in the shared folder and free what made it."""
    spark = df.sparkSession
    out = stage(df, name)
    released(spark)
    return out


def done_with(*tables: DataFrame) -> None:
    """Delete staged tables once all that was made of them is staged itself. They cannot be read afterwards."""
    for table in tables:
        spark = table.sparkSession
        for file in table.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder.getParent(), True)


def totals(values: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Sum of the values of each range."""
    sums = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[ranges])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    return np.isin(keys, twice) if len(twice) else np.zeros(len(keys), dtype=bool)


def owners(ranges: np.ndarray) -> np.ndarray:
    """The text of each value."""
    return np.repeat(np.arange(len(ranges) - 1), np.diff(ranges))


def own_keys(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts."""
    return mixed(hashes + (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def repeated_words(hashes: np.ndarray, ranges: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in a window of n words that occurs twice or more in its text."""
    total = len(hashes) - n + 1
    inside = np.zeros(len(hashes), dtype=bool)
    if total <= 0:
        return inside
    at = np.flatnonzero(across(ranges, n, total))
    text = np.searchsorted(ranges, at, "right") - 1
    twice = at[repeated(own_keys(grams(hashes, n)[at], text))]
    if len(twice):
        step = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.add.at(step, twice, 1)
        np.add.at(step, twice + n, -1)
        inside = np.cumsum(step[:-1]) > 0
    return inside


def repeated_lines(data: np.ndarray, offs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text, its lines with a word, and those of them that equal an earlier line."""
    breaks = np.flatnonzero(data == 0x0A)
    begins = np.union1d(offs[:-1], breaks + 1)
    begins = begins[begins < len(data)]
    text_end = offs[np.searchsorted(offs, begins, "right")]
    ends = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, begins)], text_end)
    first = np.searchsorted(starts, begins)
    with_word = (first < len(starts)) & (starts[np.minimum(first, max(0, len(starts) - 1))] < ends) if len(starts) else np.zeros(len(begins), dtype=bool)
    begins, ends = begins[with_word], ends[with_word]
    text = np.searchsorted(offs, begins, "right") - 1
    lines = np.bincount(text, minlength=len(offs) - 1)
    keys = own_keys(spans(prefix_sums(BYTE_VALUES[data]), begins, ends), text)
    again = repeated(keys)
    dup = np.zeros(len(offs) - 1, dtype=np.int64)
    if again.any():
        some, where = np.unique(keys[again], return_index=True)
        dup = np.bincount(text[again], minlength=len(dup)) - np.bincount(text[again][where], minlength=len(dup))
    return lines, dup
