"""Best-fit packing of tokenised documents into sequences of bounded length.

Documents are tokenised in full, only longer ones are cut, and the pieces are placed by best-fit decreasing:
longest first, each into the open sequence with the least room that still holds it. That sequence is found in
a segment tree over remaining capacities.

Pieces of one length are interchangeable, and so are sequences with the same room. So the packing is decided
on the histogram of lengths, which has at most ``capacity`` entries whatever the corpus size: all pieces of a
length are placed in steps, each step filling as many equal sequences as there are, which gives the same
sequences as placing them one at a time. The steps, a few thousand rows, are then joined with the pieces by
length and rank. Ranks are made without gathering a length in one task: a piece counts its place within its
task, and tasks are offset by the counts of those before them.

Defined cases: a NULL text is empty, and an empty text has the end token alone. Repeated ids and rows are
packed as rows of their own; NULL ids are packed too. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assocspark.llm import text
from assocspark.llm.store import stored

CAPACITY = 2048
END = 0
_CACHED_PARTS = 300_000
_tokenizers: dict[int, WordTokenizer] = {}


class _Parts(dict):
    """Part -> its ids as bytes, made when first asked for."""

    def __init__(self, model, shown_bytes: dict[int, str]):
        self.model, self.shown_bytes = model, shown_bytes

    def __missing__(self, part: str) -> bytes:
        shown = part if part.isascii() and part.isalpha() else part.translate(self.shown_bytes)
        ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        self[part] = ids
        return ids


class WordTokenizer:
    """Token ids of texts, made part by part and remembered for parts that come again.

    The vocabulary drops white space and never joins across it, nor across the parts that its split pattern
    names. For Latin-1 text these parts are found here, and each new one is given to the tokenizer's model.
    Other texts are cut at blanks and line ends, and runs with other characters are given to the tokenizer
    whole, as are texts that may name one of its special tokens.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_str(definition)
        letters, numbers, blanks = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
        # the split pattern of the vocabulary, for lower-cased Latin-1
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{blanks}{letters}{numbers}]+")
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        shown_bytes = {c: shown.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100)}
        shown_bytes |= {c: shown.pre_tokenize_str(chr(c))[0][0] for c in range(0x80) if c not in range(0x21, 0x7F)}
        self.parts = _Parts(self.whole.model, shown_bytes)

    def _latin(self, value: str) -> bytes:
        if len(self.parts) > _CACHED_PARTS:
            self.parts.clear()
        return b"".join(map(self.parts.__getitem__, self.split.findall(value.lower())))

    def _any(self, value: str) -> bytes:
        return array("I", self.whole.encode(value, add_special_tokens=False).ids).tobytes()

    def encode(self, value: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if "<|" in value:
            return self._any(value)
        try:
            value.encode("latin-1")
        except UnicodeEncodeError:
            out = []
            for latin, run in itertools.groupby(value.replace("\n", " ").split(" "), lambda w: max(w, default="") <= "\xff"):
                out.append((self._latin if latin else self._any)(" ".join(run)))
            return b"".join(out)
        return self._latin(value)


class Definition:
    """The text of a tokenizer file, read by the driver and broadcast: tasks open no file. Some megabytes, whatever the corpus."""

    def __init__(self, spark: SparkSession, path: str):
        value = Path(path).read_text(encoding="utf-8")
        self.size = WordTokenizer(value).whole.get_vocab_size()
        self.key, self.sent = zlib.crc32(value.encode()), spark.sparkContext.broadcast(value)

    def tokenizer(self) -> WordTokenizer:
        if self.key not in _tokenizers:
            _tokenizers[self.key] = WordTokenizer(self.sent.value)
        return _tokenizers[self.key]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of documents: doc_id, piece, start, length, ids_crc32, and the task and its count of that length so far."""
    definition = Definition(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = definition.tokenizer(), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in text.slices(batch, "text"):
                out = []
                for doc, value in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    ids = tokenizer.encode(value.as_py() or "") + END.to_bytes(4, "little")
                    for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + capacity)]
                        length = len(own) // 4
                        out.append((doc, piece, start, length, zlib.crc32(own), task, int(seen[length])))
                        seen[length] += 1
                yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, row, strict=True)) for row in out], schema=kinds)

    kinds = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
        + [("ids_crc32", pa.int64()), ("task", pa.int32()), ("place", pa.int64())]
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Room:
    """Open sequences by remaining room, with a segment tree to find the least room that is enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = np.zeros(2 * self.size, np.int64)  # sequences below each node
        self.runs: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, how many)

    def add(self, room: int, first: int, count: int) -> None:
        self.runs.setdefault(room, []).append((first, count))
        node = room + self.size
        while node:
            self.tree[node] += count
            node //= 2

    def tightest(self, need: int) -> int | None:
        """The least room of at least ``need`` that an open sequence has."""
        node = need + self.size
        if self.tree[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None

    def take(self, room: int, most: int) -> tuple[int, int]:
        first, count = self.runs[room].pop()
        if count > most:
            self.runs[room].append((first + most, count - most))
            count = most
        node = room + self.size
        while node:
            self.tree[node] -= count
            node //= 2
        return first, count


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths.

    Steps (length, first rank, last rank, first sequence, offset): the pieces of that length with these ranks
    go to consecutive sequences, one each, at that offset.
    """
    room, steps, opened = Room(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        rank, total = 0, histogram[length]
        while rank < total:
            space = room.tightest(length)
            # a sequence just given a piece is the tightest one until it is too full for another
            fits = (space or capacity) // length
            want = -(-(total - rank) // fits)
            if space is None:
                space, first, count = capacity, opened, want
                opened += want
            else:
                first, count = room.take(space, want)
            full = min(count, (total - rank) // fits)
            for k in range(fits):
                if full:
                    steps.append((length, rank, rank + full - 1, first, capacity - space + k * length))
                    rank += full
            if full and space > fits * length:
                room.add(space - fits * length, first, full)
            if full < count:  # the last sequence, not filled up
                for k in range(total - rank):
                    steps.append((length, rank + k, rank + k, first + full, capacity - space + k * length))
                if space > (total - rank) * length:
                    room.add(space - (total - rank) * length, first + full, 1)
                rank = total
    return steps


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece."""
    rows = stored(pieces(docs, path, capacity), "pieces")
    counts = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    found = rows.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most one row for each length
    steps = plan({r["length"]: r["n"] for r in found}, capacity)
    schema = "step_length long, low long, high long, first long, offset long"
    chosen = rows.sparkSession.createDataFrame(steps, schema)
    ranked = rows.join(base, ["task", "length"]).withColumn("rank", F.col("base") + F.col("place"))
    # the steps are bounded by the capacity, not by the corpus
    fits = (F.col("length") == F.col("step_length")) & F.col("rank").between(F.col("low"), F.col("high"))
    placed = ranked.join(F.broadcast(chosen), fits)
    sequence = (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence, "offset")
