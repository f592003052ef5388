"""Words, lines, windows and hashes of Arrow text columns, computed for many documents at once.

All functions work on UTF-8 bytes. A word is a run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return; lower-casing changes A-Z only. NULL is treated as an empty text.
Hashes are 64 bits, equal on every machine and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_STEP = U64(0xD1342543DE82EF95)
_BYTE = np.random.default_rng(20240).integers(1, 2**64, 256, dtype=U64)
BASES = (_BASE, _STEP)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
BLOCK = 1 << 18  # values hashed at a time


def fold(column: Column | str, divisor: int) -> Column:
    """CRC-32 of the id as text, modulo ``divisor``; a NULL id counts as an empty text."""
    value = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary")) % divisor


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each value begins, with the end of the last one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole documents of about ``limit`` bytes, at least one document each."""
    _, at = bytes_of(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + (upper * np.uint8(32)).astype(np.uint8)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose outputs look random."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _power(base: U64) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i within a block."""
    if int(base) not in _powers:
        rows = []
        for b in (int(base), pow(int(base), -1, 2**64)):
            row = np.full(BLOCK, b, U64)
            row[0] = 1
            rows.append(np.multiply.accumulate(row))
        _powers[int(base)] = rows[0], rows[1]
    return _powers[int(base)]


def span_hashes(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: U64 = _BASE, table: np.ndarray | None = None
) -> np.ndarray:
    """A hash of each run ``values[start:end]`` of 64-bit values, equal for equal runs wherever they stand.

    With ``table``, values are places in it. Works in blocks: beside the prefix sums, memory is that of one block.
    """
    up, down = _power(base)
    sums = np.zeros(len(values) + 1, U64)
    carry, shift, step = 0, 1, pow(int(base), BLOCK, 2**64)
    for at in range(0, len(values), BLOCK):
        block = values[at : at + BLOCK]
        block = (table[block] if table is not None else block) * up[: len(block)]
        sums[at + 1 : at + 1 + len(block)] = np.cumsum(block) * np.array(shift, U64) + np.array(carry, U64)
        carry, shift = int(sums[at + len(block)]), shift * step % 2**64
    back = np.full(len(values) // BLOCK + 1, pow(step, -1, 2**64), U64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    starts, ends = np.asarray(starts), np.asarray(ends)
    unshift = back[starts // BLOCK] * down[starts % BLOCK]
    return mixed((sums[ends] - sums[starts]) * unshift + (ends - starts).astype(U64) * _STEP)


def byte_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: U64 = _BASE) -> np.ndarray:
    return span_hashes(data, starts, ends, base, _BYTE)


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of its document."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    begins[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(at, starts, side="right") - 1


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word in order, and the position of the first word of each document (plus the end)."""
    data, at = bytes_of(column)
    data = lowered(data)
    starts, ends, doc = word_spans(data, at)
    return byte_spans(data, starts, ends), np.searchsorted(doc, np.arange(len(at)))


def shingles(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words; a document with fewer words has its whole sequence as one.

    Returns the hashes in document order, repeats included, and the position of each document's first.
    """
    hashes, first = words(column)
    count = np.diff(first)
    runs = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    starts = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], runs)
    ends = starts + np.repeat(np.minimum(count, size), runs)
    return span_hashes(hashes, starts, ends, _STEP), begin


def distinct_runs(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each run, sorted, and the new begins."""
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[keep], np.searchsorted(doc[keep], np.arange(len(begin)))


def lists(values: np.ndarray, begin: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from values and begins."""
    if kind == pa.int64():
        values = values.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(values, kind))


def blobs(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """An Arrow binary column from values and begins."""
    width = values.dtype.itemsize
    places = pa.py_buffer(np.ascontiguousarray(np.asarray(begin, np.int64) * width).tobytes())
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, places, data]).cast(pa.binary())
