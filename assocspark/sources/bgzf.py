"""Block-gzip (``.bgz``) text, split at block boundaries.

A block-gzip file is a row of small gzip members, each with its compressed size in the
header, so a task can start at any block. Spark does not know the suffix and would see plain
gzip, which cannot be split. Spark plans the byte ranges as rows and each task reads its own.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Gzip member start with an extra field, and the size subfield of a block.
MEMBER = b"\x1f\x8b\x08\x04"
_MAX_BLOCK = 1 << 16
SPLIT_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20


def file_system(uri: str):
    """File system and path of a URI as Spark writes it, which may be ``file:/x`` or a bare path."""
    from pyarrow import fs

    if uri.startswith("file:") or "://" not in uri:
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def opened(uri: str):
    """A readable file of a URI as Spark writes it."""
    system, path = file_system(uri)
    return system.open_input_file(path)


def _block_size(header: bytes) -> int | None:
    """Size of the block whose header this is, None if it is not one."""
    if len(header) < 18 or header[:4] != MEMBER:
        return None
    (extra,) = struct.unpack("<H", header[10:12])
    at, end = 12, min(12 + extra, len(header) - 5)
    while at < end:
        length = struct.unpack("<H", header[at + 2 : at + 4])[0]
        if header[at : at + 2] == b"BC" and length == 2:
            return struct.unpack("<H", header[at + 4 : at + 6])[0] + 1
        at += 4 + length
    return None


def _first_block(source, start: int, size: int) -> int:
    """Offset of the first block at or after ``start``; a match must lead to another block."""
    if start == 0:
        return 0
    source.seek(start)
    window = source.read(2 * _MAX_BLOCK + 64)
    at = window.find(MEMBER)
    while at >= 0:
        length = _block_size(window[at : at + 64])
        if length:
            following = start + at + length
            if following == size or _block_size(window[at + length : at + length + 64]):
                return start + at
        at = window.find(MEMBER, at + 1)
    return size


def block_texts(source, start: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of the blocks from the first one at or after ``start`` on."""
    source.seek(0)
    if _block_size(source.read(64)) is None:
        raise ValueError("not a block-gzip file; read plain gzip with block_gzip=False")
    return _texts(source, _first_block(source, start, size), size)


def _texts(source, offset: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset of the block, text of the block), to the end of the file."""
    while offset < size:
        source.seek(offset)
        block = source.read(_MAX_BLOCK)
        length = _block_size(block[:64])
        if not length:
            raise ValueError(f"no block-gzip header at offset {offset}")
        yield offset, zlib.decompress(block[:length], wbits=31)
        offset += length


def _chunks(source, start: int, end: int, size: int) -> Iterator[bytes]:
    """Runs of whole lines that begin in blocks whose offset lies in [start, end)."""
    # The split before owns the line that runs into this one, so the first piece is its own.
    rest, skipping, kept, held = b"", start > 0, [], 0
    for offset, text in block_texts(source, start, size):
        if offset >= end:
            if skipping:
                return
            head, newline, _ = text.partition(b"\n")
            rest += head
            if newline:
                yield b"\n".join([*kept, rest])
                return
            continue
        if skipping:
            _, newline, text = text.partition(b"\n")
            if not newline:
                continue
            skipping = False
        whole, newline, tail = text.rpartition(b"\n")
        if newline:
            kept.append(rest + whole)
            rest, held = tail, held + len(whole)
        else:
            rest += tail
        if held >= CHUNK_BYTES:
            yield b"\n".join(kept)
            kept, held = [], 0
    if rest and not skipping:
        kept.append(rest)
    if kept:
        yield b"\n".join(kept)


def _read_ranges(opened: Callable):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                with opened(row.path) as source:
                    first = row.start == 0
                    for chunk in _chunks(source, row.start, row.end, row.length):
                        place = {"path": [row.path], "length": [row.length], "start": [row.start], "end": [row.end]}
                        yield pd.DataFrame(place | {"chunk": [chunk.decode("utf-8")], "first": [first]})
                        first = False

    return read


def byte_ranges(spark: SparkSession, paths: str | list[str], split_bytes: int) -> tuple[DataFrame, int]:
    """Ranges (path, length, start, end) of the files, and how many tasks they are worth."""
    paths = [paths] if isinstance(paths, str) else paths
    # Only path and length are selected, so the listing reads no file content.
    listed = spark.read.format("binaryFile").load(paths)
    files = listed.select("path", "length").filter("length > 0")
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes).cast("bigint"))
    ranges = files.withColumn("start", F.explode(starts)).withColumn(
        "end", F.least(F.col("start") + split_bytes, F.col("length"))
    )
    # A range is a tiny row for a lot of work: without a number of its own, adaptive execution would merge all of
    # them into one task. The planner knows the size of the files from listing them.
    size = int(listed._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = size // split_bytes + len(listed.inputFiles()) + 1
    return ranges, tasks


def read_bgzf_lines(
    spark: SparkSession,
    paths: str | list[str],
    skip_leading_rows: int = 1,
    split_bytes: int = SPLIT_BYTES,
    opened: Callable = opened,
) -> DataFrame:
    """Lines of block-gzip files as a ``value`` column, about one task per ``split_bytes`` of input.

    The first ``skip_leading_rows`` lines of each file are dropped; they must lie in its first few megabytes. Fields
    cannot hold newlines here; ``quoted.read_records`` allows them. Python only unpacks blocks, Spark splits lines.
    ``opened`` turns a path, as Spark spells it, into a readable file; give one for file systems that
    pyarrow does not know by scheme, or that need credentials.
    """
    return range_lines(spark, paths, skip_leading_rows, split_bytes, opened).select("value")


def range_lines(
    spark: SparkSession, paths: str | list[str], skip_leading_rows: int, split_bytes: int, opened: Callable, ranges_a_task: int = 1
) -> DataFrame:
    """The lines of all ranges, each with its range."""
    ranges, tasks = byte_ranges(spark, paths, split_bytes)
    return lines_of(ranges.repartition(-(-tasks // ranges_a_task), "path", "start"), skip_leading_rows, opened)


def lines_of(ranges: DataFrame, skip_leading_rows: int, opened: Callable) -> DataFrame:
    """path, length, start, end and ``value``: the lines that begin in the given ranges."""
    schema = "path string, length long, start long, end long, chunk string, first boolean"
    chunks = ranges.select("path", "length", "start", "end").mapInPandas(_read_ranges(opened), schema)
    lines = F.split("chunk", "\n")
    kept = F.when(F.col("first"), F.slice(lines, skip_leading_rows + 1, F.greatest(F.size(lines) - skip_leading_rows, F.lit(0)))).otherwise(lines)
    each = chunks.select("path", "length", "start", "end", F.explode(kept).alias("value"))
    return each.withColumn("value", F.regexp_replace("value", "\r$", ""))
