"""Packing of tokenised documents into full sequences of about equal cost.

The cost of a piece of l tokens is estimated as ``6 * width * l + l * l``: matrix products grow with the tokens, attention within the
piece with their square, in the proportions of a transformer of that model width. A sequence costs what its pieces
cost. Pieces are placed longest first, each into the sequence of the lowest cost that has room for all of it; if none
has, the lowest-cost sequence with any room takes what fits, and the rest is placed in its turn. A segment tree over remaining room,
with a heap of sequences for each room, finds both in logarithmic time.

There is no padding. T tokens get T div capacity sequences, which all come out full, and the last T mod capacity tokens go to
sequences whose lengths are the powers of two of that number, as such lengths need no padding. These are filled last, with the shortest
pieces. Documents longer than a sequence are first cut at multiples of the capacity.

At scale: token ids, two bytes each for vocabularies up to 65,536, are shuffled once by a number drawn from task and place, so that every
partition sees the same mix of lengths whatever the order and the size of sources, and no key is hot. Each partition packs
windows of ``WINDOW`` tokens (1,024 sequences) on its own, in an order that does not depend on how blocks arrive; memory is
that of a window. No counts go through the driver. A partition ends with at most log2(capacity) short sequences.

Defined cases: a NULL text is empty, and an empty text has the end token alone. Repeated ids and rows are packed as rows of their own;
NULL ids are packed too. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocspark.llm import packing, text

CAPACITY = 4096
END = 2
WIDTH = 1024  # model width of the cost estimate
WINDOW = 1024 * CAPACITY  # tokens packed at a time


def cost(length: int, width: int = WIDTH) -> int:
    return 6 * width * length + length * length


class Room:
    """Open sequences by remaining room; the lowest-cost one with at least some room."""

    def __init__(self, sequences: int, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.heaps[capacity] = [(0, s) for s in range(sequences)]
        self.none = (1 << 62, -1)
        self.tree = [self.none] * (2 * self.size)
        self._mend(capacity)

    def _mend(self, room: int) -> None:
        node, tree = room + self.size, self.tree
        tree[node] = self.heaps[room][0] if self.heaps[room] else self.none
        node //= 2
        while node:
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
            node //= 2

    def lowest(self, need: int) -> int | None:
        """The room of the lowest-cost sequence with at least ``need`` left."""
        low, high, tree, best, found = need + self.size, 2 * self.size, self.tree, self.none, 0
        while low < high:
            if low & 1:
                if tree[low] < best:
                    best, found = tree[low], low
                low += 1
            low, high = low // 2, high // 2
        if not found:
            return None
        while found < self.size:
            found = 2 * found if tree[2 * found] == best else 2 * found + 1
        return found - self.size

    def place(self, room: int, length: int, more: int) -> int:
        """Give the lowest-cost sequence of this room a piece; returns the sequence."""
        spent, sequence = heapq.heappop(self.heaps[room])
        self._mend(room)
        if room > length:
            heapq.heappush(self.heaps[room - length], (spent + more, sequence))
            self._mend(room - length)
        return sequence


def assign(lengths: list[int], capacity: int = CAPACITY, width: int = WIDTH) -> list[tuple[int, int, int, int, int]]:
    """Steps (item, start, length, sequence, offset) that place items of at most ``capacity`` tokens."""
    total = sum(lengths)
    room, steps = Room(total // capacity, capacity), []
    waiting: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    for item, length in enumerate(lengths):
        waiting[length].append((item, 0))
    last = []  # pieces for the short sequences, longest first
    for length in range(capacity, 0, -1):
        for item, start in waiting[length]:
            space = room.lowest(length)
            if space is None:
                space = room.lowest(1)
            if space is None:
                last.append((item, start, length))
                continue
            taken = min(space, length)
            sequence = room.place(space, taken, cost(taken, width))
            steps.append((item, start, taken, sequence, capacity - space))
            if taken < length:
                waiting[length - taken].append((item, start + taken))
    short = [(1 << bit) for bit in range(capacity.bit_length(), -1, -1) if total % capacity >> bit & 1]
    sequence, offset = total // capacity, 0
    for item, start, length in last:
        while length:
            taken = min(length, short[0] - offset)
            steps.append((item, start, taken, sequence, offset))
            start, length, offset = start + taken, length - taken, offset + taken
            if offset == short[0]:
                short, sequence, offset = short[1:], sequence + 1, 0
    return steps


def _tokens(docs: DataFrame, definition: packing.Definition, capacity: int, kind: str) -> DataFrame:
    """Token ids of parts of at most ``capacity`` tokens, with a number that deals them to partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = definition.tokenizer(), END.to_bytes(4, "little")
        made = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in text.slices(batch, "text"):
                columns: list[list] = [[], [], [], []]
                for doc, value in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    ids = np.frombuffer(tokenizer.encode(value.as_py() or "") + end, "<u4").astype(kind)
                    for start in range(0, len(ids), capacity):
                        for column, v in zip(columns, (doc, start, len(ids), ids[start : start + capacity].tobytes()), strict=True):
                            column.append(v)
                numbers = text.mixed(np.arange(made, made + len(columns[0]), dtype=np.uint64)).view(np.int64)
                made += len(columns[0])
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(numbers)], names=["doc_id", "start", "doc_tokens", "ids", "deal"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, start long, doc_tokens long, ids binary, deal long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, width: int = WIDTH, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece, and the cost of its sequence."""
    definition = packing.Definition(docs.sparkSession, path)
    kind = "<u2" if definition.size <= 1 << 16 else "<u4"
    # numbers are distinct, so the order within a partition is the same in every run
    dealt = _tokens(docs, definition, capacity, kind).repartition("deal").sortWithinPartitions("deal")

    def packed(rows: list[tuple], first: int) -> tuple[pa.RecordBatch, int]:
        steps = assign([len(r[3]) for r in rows], capacity, width)
        spent = np.zeros(max((s[3] for s in steps), default=-1) + 1, np.int64)
        np.add.at(spent, [s[3] for s in steps], [cost(s[2], width) for s in steps])
        out = []
        for item, start, length, sequence, offset in steps:
            doc, base, total, ids = rows[item]
            crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
            out.append((doc, base + start, length, crc, total, first + sequence, offset, int(spent[sequence])))
        arrays = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names), first + len(spent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, first = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens")), batch.column("ids"), strict=True)
            for doc, start, total, ids in places:
                rows.append((doc, start, total, np.frombuffer(ids.as_py(), kind)))
                held += len(rows[-1][3])
                if held >= window:
                    out, first = packed(rows, first)
                    yield out
                    rows, held = [], 0
        if rows:
            yield packed(rows, first)[0]

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_cost"]
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in names))
