"""Text records with line ends inside quotes, read in parallel.

Where a byte range begins, a reader cannot tell whether it is inside a quoted field: that depends on all quotes before it. So
each range first counts its quotes, modulo 2; the counts are combined per file by a running sum, one small row
for each range; then each range is read again with its state known. Line ends outside quotes end records. A range owns the
records that begin after such a line end within it, and reads on past its end to finish the last one. A record
may span any number of ranges.

Quotes must be balanced within a record (a quote in a field is doubled), as in any quoted text. Plain files are cut by bytes,
block-gzip files at their blocks; other compressed files cannot be cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assocspark.sources import bgzf

SPLIT_BYTES = 64 << 20
_CHUNK = 4 << 20
_BEYOND = 64 << 10
_QUOTE, _END = 34, 10
CODECS = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")


def plain_pieces(source, start: int, end: int, size: int) -> Iterator[tuple[bool, bytes]]:
    """(inside the range, bytes), in order, to the end of the file."""
    source.seek(start)
    at = start
    while at < size:
        piece = source.read(min(_CHUNK, end - at) if at < end else _BEYOND)
        if not piece:
            return
        yield at < end, piece
        at += len(piece)


def block_pieces(source, start: int, end: int, size: int) -> Iterator[tuple[bool, bytes]]:
    """The same of a block-gzip file: unpacked blocks, inside if they begin in the range."""
    for offset, text in bgzf.block_texts(source, start, size):
        yield offset < end, text


def records(pieces: Iterator[tuple[bool, bytes]], first: bool, quoted: bool) -> Iterator[list[bytes]]:
    """The records a range owns; ``quoted`` tells whether it begins inside quotes."""
    rest, owned = b"", first
    for inside, piece in pieces:
        if not inside and not owned:
            return
        data = np.frombuffer(piece, np.uint8)
        ends = np.flatnonzero(data == _END)
        quotes = np.flatnonzero(data == _QUOTE)
        if len(quotes) or quoted:
            ends = ends[(np.searchsorted(quotes, ends) + quoted) % 2 == 0]
        quoted = bool((quoted + len(quotes)) % 2)
        if not inside:
            ends = ends[:1]
        if not len(ends):
            rest += piece if owned else b""
            continue
        cuts = [0, *(ends + 1).tolist()]
        found = [piece[a : b - 1] for a, b in zip(cuts, cuts[1:], strict=False)]
        found[0] = rest + found[0]
        yield found if owned else found[1:]
        if not inside:
            return
        rest, owned = piece[cuts[-1] :], True
    if rest and owned:
        yield [rest]


def _count(pieces: Callable, opened: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odd = []
            for row in batch.to_pylist():
                quotes = 0
                with opened(row["path"]) as source:
                    for inside, piece in pieces(source, row["start"], row["end"], row["length"]):
                        if not inside:
                            break
                        quotes += piece.count(b'"')
                odd.append(quotes % 2)
            yield batch.append_column("odd", pa.array(odd, pa.int32()))

    return run


def _read(pieces: Callable, opened: Callable, skip: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            left = skip if row["start"] == 0 else 0
            with opened(row["path"]) as source:
                found = pieces(source, row["start"], row["end"], row["length"])
                for group in records(found, row["start"] == 0, row["quoted"]):
                    kept, left = group[left:], max(left - len(group), 0)
                    shown = [r.decode("utf-8").removesuffix("\r") for r in kept]
                    yield pa.RecordBatch.from_arrays([pa.array([r for r in shown if r], pa.string())], names=["value"])

    return run


def read_records(
    spark: SparkSession,
    paths: str | list[str],
    skip_leading_rows: int = 1,
    block_gzip: bool = False,
    split_bytes: int = SPLIT_BYTES,
    opened: Callable = bgzf.opened,
) -> DataFrame:
    """Records as a ``value`` column, about one task per ``split_bytes`` of input; empty ones are left out.

    The first ``skip_leading_rows`` records of each file are dropped; they must begin in its first range. ``opened`` as for block-gzip files.
    """
    ranges, tasks = bgzf.byte_ranges(spark, paths, split_bytes)
    pieces = block_pieces if block_gzip else plain_pieces
    counted = ranges.repartition(tasks, "path", "start").mapInArrow(
        _count(pieces, opened), "path string, length long, start long, end long, odd int"
    )
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = counted.withColumn("quoted", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    return states.repartition(tasks, "path", "start").mapInArrow(_read(pieces, opened, skip_leading_rows), "value string")
