"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared after folding: A-Z in lower case, each run of other marks and blanks as one space. A
benchmark item is cut into overlapping pieces of PIECE characters (a shorter item is one piece). A piece of
m characters occurs in a document if some stretch of it is at most e = RATE * m edits away. Such a
stretch shares at least m + 1 - q * (e + 1) q-grams with the piece, within e + 1 neighbouring diagonals.

Shared q-grams are counted in overlapping diagonal bands, bands that meet the bound are kept, and the piece is
aligned to the text around the band by banded dynamic programming, which gives the number of edits.
Documents are read once for each block of benchmark items; a block is bounded by BLOCK bytes, and only
blocks are sent to the tasks. Documents are not shuffled.

Defined cases: NULL and empty texts hold nothing; items with fewer than SHORTEST folded bytes are too short to
tell a copy from chance and match nothing; items with equal texts are found separately; repeated
document rows give rows each; NULL ids stay NULL. Characters beyond ASCII count as their UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocspark.llm import text

GRAM = 10
PIECE = 100
STRIDE = 50
RATE = 0.08
SHORTEST = 40
BLOCK = 1 << 20
_BAND = 16
_BITS = 22
_KEPT = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])

SLICE = 1 << 19  # bytes of texts searched at a time
SCHEMA = "item_id long, n_pieces long, n_found long, edits long, start long, end long"


def folded(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, the place of each in ``data``, and where each text begins."""
    data = text.lowered(data)
    kept = _KEPT[data]
    follows = np.empty(len(kept), bool)
    follows[1:] = ~kept[:-1]
    follows[at[:-1][at[:-1] < len(data)]] = True  # no space at the start of a text
    origin = np.flatnonzero(kept | ~follows)
    out = np.where(kept[origin], data[origin], np.uint8(32))
    return out, origin, np.searchsorted(origin, at)


def edits_of(m: int) -> int:
    """The edit budget of a piece of m bytes; short pieces get no more than their q-grams can prove."""
    return max(0, min(int(RATE * m), (m + 1 - GRAM) // GRAM - 1))


class Index:
    """The q-grams of the pieces of a block of items, sorted by hash."""

    def __init__(self, items: list[tuple[int, str]]):
        column = pa.array([t for _, t in items], pa.string())
        data, _, begin = folded(*text.bytes_of(column))
        self.items = np.array([i for i, _ in items], np.int64)
        pieces, owner = [], []
        for k in range(len(items)):
            own = data[begin[k] : begin[k + 1]]
            if len(own) and own[-1] == 32:
                own = own[:-1]
            if len(own) >= SHORTEST:
                starts = {*range(0, max(len(own) - PIECE, 0) + 1, STRIDE), max(len(own) - PIECE, 0)}
                for s in sorted(starts):
                    pieces.append(own[s : s + PIECE])
                    owner.append(k)
        self.pieces, self.owner = pieces, np.array(owner, np.int64)
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.budget = np.array([edits_of(m) for m in self.sizes], np.int64)
        self.need = self.sizes + 1 - GRAM * (self.budget + 1)
        self.total = np.bincount(self.owner, minlength=len(items))
        flat = np.concatenate([*pieces, np.zeros(0, np.uint8)])
        first = np.cumsum(self.sizes) - self.sizes
        per = self.sizes - GRAM + 1
        piece = np.repeat(np.arange(len(pieces)), per)
        place = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        starts = first[piece] + place if len(pieces) else place
        hashes = text.byte_spans(flat, starts, starts + GRAM)
        order = np.argsort(hashes, kind="stable")
        self.piece, self.place = piece[order], place[order]
        self.keys, self.start = np.unique(hashes[order], return_index=True)
        self.start = np.append(self.start, len(order))
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[self.keys >> np.uint64(64 - _BITS)] = True

    def bands(self, data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, piece and first diagonal of each band with enough shared q-grams.

        A diagonal is the place in all texts less the place in the piece.
        """
        none = np.zeros(0, np.int64)
        if len(data) < GRAM or not len(self.keys):
            return none, none, none
        starts = np.arange(len(data) - GRAM + 1)
        hashes = text.byte_spans(data, starts, starts + GRAM)
        at = np.flatnonzero(self.bits[hashes >> np.uint64(64 - _BITS)])
        found = np.searchsorted(self.keys, hashes[at])
        found[found == len(self.keys)] = 0
        doc = np.searchsorted(begin, at, side="right") - 1
        good = (self.keys[found] == hashes[at]) & (at + GRAM <= begin[doc + 1])
        at, found, doc = at[good], found[good], doc[good]
        count = self.start[found + 1] - self.start[found]
        entry = np.repeat(self.start[found] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        piece = self.piece[entry]
        diagonal = np.repeat(at, count) - self.place[entry] + PIECE
        doc = np.repeat(doc, count)
        near = diagonal % _BAND < self.budget[piece]  # also in the band before, which reaches that far
        band = np.concatenate([diagonal // _BAND, diagonal[near] // _BAND - 1])
        piece, doc = np.concatenate([piece, piece[near]]), np.concatenate([doc, doc[near]])
        width = len(data) // _BAND + PIECE
        keys, n = np.unique((doc * len(self.pieces) + piece) * width + band + 1, return_counts=True)
        piece = keys // width % len(self.pieces)
        keep = n >= self.need[piece]
        keys, piece = keys[keep], piece[keep]
        return keys // width // len(self.pieces), piece, (keys % width - 1) * _BAND - PIECE

    def align(self, data: np.ndarray, begin: np.ndarray, doc: np.ndarray, piece: np.ndarray, diagonal: np.ndarray):
        """Edits of each piece to the best stretch around its band, and the end of that stretch (not included)."""
        edits, ends = np.full(len(doc), PIECE, np.int64), np.zeros(len(doc), np.int64)
        for size in np.unique(self.sizes[piece]):
            for some in np.array_split(rows := np.flatnonzero(self.sizes[piece] == size), len(rows) // 4096 + 1):
                budget = edits_of(size)
                width = _BAND + 3 * budget + 1
                # column j of row i is the text place diagonal - budget + i + j
                low = diagonal[some] - budget
                first, last = begin[doc[some]], begin[doc[some] + 1]
                wanted = np.stack([self.pieces[p] for p in piece[some]])
                columns = np.arange(width)
                cost = np.where((low[:, None] + columns >= first[:, None]) & (low[:, None] + columns <= last[:, None]), 0, PIECE)
                for i in range(size):
                    place = low[:, None] + i + columns
                    inside = (place >= first[:, None]) & (place < last[:, None])
                    same = inside & (data[np.clip(place, 0, len(data) - 1)] == wanted[:, i : i + 1])
                    # a row further down, the same text place is one column to the left
                    step = np.where(inside, cost + ~same, PIECE)  # piece byte i against text byte
                    skip = np.full_like(cost, PIECE)
                    skip[:, :-1] = cost[:, 1:] + 1  # piece byte i missing in the text
                    cost = np.minimum(step, skip)
                    at = place + 1  # text bytes that are too many
                    cost = np.where((at >= first[:, None]) & (at <= last[:, None]), cost, PIECE)
                    cost = np.minimum.accumulate(cost - columns, axis=1) + columns
                    cost = np.minimum(cost, PIECE)
                best = cost.argmin(1)
                edits[some] = cost[np.arange(len(some)), best]
                ends[some] = np.clip(low + size + best, first, last)
        return edits, ends

    def find(self, column: pa.Array) -> tuple[np.ndarray, ...]:
        """Text number, item, pieces found, least edits, first and last byte (folded origin) for each text and item."""
        raw, at = text.bytes_of(column)
        data, origin, begin = folded(raw, at)
        doc, piece, diagonal = self.bands(data, begin)
        edits, ends = self.align(data, begin, doc, piece, diagonal)
        good = edits <= self.budget[piece]
        doc, piece, edits, ends = doc[good], piece[good], edits[good], ends[good]
        starts = np.maximum(ends - self.sizes[piece], begin[doc])
        item = self.owner[piece]
        order = np.lexsort((piece, item, doc))
        doc, item, piece, edits, starts, ends = (x[order] for x in (doc, item, piece, edits, starts, ends))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
        group = np.flatnonzero(new)
        fresh = np.ones(len(doc), bool)
        fresh[1:] = new[1:] | (piece[1:] != piece[:-1])
        if not len(group):
            return (group,) * 6
        points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters before each byte
        start = np.minimum.reduceat(starts, group)
        end = np.maximum.reduceat(ends, group)
        doc = doc[group]
        base = points[at[doc]]
        found = np.add.reduceat(fresh.astype(np.int64), group)
        last = points[origin[end - 1] + 1] - base
        return doc, item[group], found, np.minimum.reduceat(edits, group), points[origin[start]] - base, last


def _blocks(items: DataFrame) -> Iterator[Index]:
    """Indexes of the items, a bounded block at a time. The driver holds one block while it is made."""
    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text", F.octet_length("text").alias("size"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    blocks = -(-total // BLOCK)
    for k in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else rows
        yield Index(sorted((r["item_id"], r["text"]) for r in own.select("item_id", "text").collect()))


def contaminated(docs: DataFrame, items: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row for each document and item of which pieces occur in it.

    n_pieces: pieces of the item; n_found: how many occur; edits: the least of any; start, end: the characters
    of the document from the first to the last of them.
    """
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    source = docs.select(*keep, *([] if "text" in keep else ["text"]))

    def scan(index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text.slices(batch, "text", SLICE):
                    doc, item, found, edits, start, end = index.find(part.column("text"))
                    columns = [part.column(c).take(pa.array(doc)) for c in keep]
                    numbers = (index.items[item] if len(item) else item, index.total[item], found, edits, start, end)
                    columns += [pa.array(x, pa.int64()) for x in numbers]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keep, *(f.split()[0] for f in SCHEMA.split(", "))])

        return source.mapInArrow(run, f"{fields}, {SCHEMA}")

    parts = [scan(index) for index in _blocks(items)]
    if not parts:
        return docs.sparkSession.createDataFrame([], f"{fields}, {SCHEMA}")
    return reduce(DataFrame.unionByName, parts)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no piece of any item occurs, all columns."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def scan(source: DataFrame, index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text.slices(batch, "text", SLICE):
                    fine = np.ones(part.num_rows, bool)
                    fine[index.find(part.column("text"))[0]] = False
                    yield part.filter(pa.array(fine))

        return source.mapInArrow(run, fields)

    return reduce(scan, _blocks(items), docs)
