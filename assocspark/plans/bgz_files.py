"""Block-gzip files for the round-trip queries; Spark itself writes plain gzip only."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocspark.sources.bgzf import MEMBER, file_system


def _block(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    head = MEMBER + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def write_bgzf(df: DataFrame, path: str, sep: str = "\t") -> int:
    """Text columns as block-gzip files with a header line, one file per partition.

    Tasks stream their rows, so none holds a partition. A file gets its final name when it is
    complete, and that name depends on the partition only: a repeated task replaces it.
    """
    header = sep.join(df.columns)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        system, base = file_system(path)
        system.create_dir(base, recursive=True)
        final = f"{base}/part-{context.partitionId():05d}.bgz"
        draft = f"{final}.{context.taskAttemptId()}.tmp"
        rows, pending = 0, (header + "\n").encode()
        with system.open_output_stream(draft, compression=None) as out:
            for batch in batches:
                rows += len(batch)
                lines = batch.iloc[:, 0]
                for column in batch.columns[1:]:
                    lines = lines + sep + batch[column]
                pending += ("\n".join(lines) + "\n").encode() if len(batch) else b""
                while len(pending) >= 60_000:
                    out.write(_block(pending[:60_000]))
                    pending = pending[60_000:]
            if pending:
                out.write(_block(pending))
            out.write(_block(b""))
        try:
            system.move(draft, final)
        except OSError:  # another attempt was first
            system.delete_file(draft)
        yield pd.DataFrame({"rows": [rows]})

    counts = df.mapInPandas(write, "rows bigint").agg(F.sum("rows").alias("rows")).first()
    return counts["rows"] or 0
