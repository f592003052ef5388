"""Removal of repeated runs of lines, found by winnowing over line hashes.

A run of consecutive lines with at least ``MIN_WORDS`` words is repeated if an earlier document, or an earlier
place of the same document that it does not overlap, has the same lines. Every line of a later
repeated run goes; the first occurrence (least id, then place) stays whole.

Any such run is covered by its shortest windows of at least MIN_WORDS words, one starting and one ending at
each line. Of each window the gram (shortest run of at least GRAM_WORDS words) with the least hash is selected
as its fingerprint, so equal windows have equal fingerprints at equal places, and every repeated run has at least
one. A position is a place that some window selected, with the line hashes as far as those windows reach.

Positions are joined by fingerprint with the first position that has it. From there each match is extended line by line
both ways as far as the position reaches; beyond it, the next fingerprint goes on. The windows inside a match have their
first occurrence at that first position, so the lines of the match go. Windows that differ from those at the first
position are left; equal ones among them are all left, and are joined once more, with the first that is equal
as a whole. So each position meets two others, however many share its fingerprint. Lines and windows are compared
by 128 bits.

Counts and first places are reduced before they are shuffled; the positions of a fingerprint that holds a large share
of all are dealt over several tasks, and no group is collected.

Defined cases: a NULL text stays NULL and has no lines; an empty text has one empty line. A run
needs words: blank lines go only inside a repeated run. Rows with equal id and text are one document. NULL ids
come last in order. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocspark.llm import text
from assocspark.llm.store import stored

MIN_WORDS = 50
GRAM_WORDS = 20
HOT = 1_000  # a key is hot with more than this part of all rows, so fewer keys than this are
PARTS = 64  # tasks that the rows of a hot key are dealt over


def _lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each line, words before each line (and in all), and the first line of each document (and the end)."""
    data, at = text.bytes_of(column)
    starts, ends, doc = text.word_spans(data, at)
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(at, breaks, side="right") - 1
    per = np.bincount(owner, minlength=len(at) - 1) + 1
    first = np.concatenate([[0], np.cumsum(per)])
    # line k of a document starts at its begin or after its k-th break
    begin = np.empty(first[-1], np.int64)
    close = np.empty(first[-1], np.int64)
    begin[first[:-1]] = at[:-1]
    close[first[1:] - 1] = at[1:]
    inner = np.arange(len(breaks)) + owner
    begin[inner + 1] = breaks + 1
    close[inner] = breaks
    before = np.searchsorted(starts, np.append(begin, len(data) + 1))
    return np.stack([text.byte_spans(data, begin, close, base) for base in text.BASES], 1), before, first


def _first_least(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The place of the first least value in each run start..stop-1, in n log n steps however much the runs overlap."""
    place = np.empty(len(start), np.int64)
    level = np.frexp((stop - start).astype(np.float64))[1] - 1  # two blocks of 2**level values cover a run
    best = np.arange(len(values))
    for k in range(int(level.max()) + 1):
        own = np.flatnonzero(level == k)
        a, b = best[start[own]], best[stop[own] - (1 << k)]
        place[own] = np.where(values[a] <= values[b], a, b)
        left, right = best[: -(1 << k)], best[1 << k :]
        best = np.where(values[left] <= values[right], left, right)
    return place


def windows(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Document number, first line, line after the last, fingerprint and its place, of each window in order.

    Lines are numbered over the whole column; their hashes, and the first line of each document, come last.
    """
    hashes, before, first = _lines(column)
    n = len(hashes)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    lines = np.arange(n)
    ahead = np.searchsorted(before, before[:-1] + MIN_WORDS, side="left")
    good = ahead <= first[doc + 1]
    back = np.searchsorted(before, before[1:] - MIN_WORDS, side="right") - 1
    fine = (before[1:] >= MIN_WORDS) & (back >= first[doc])
    pairs = np.unique(np.concatenate([lines[good] * (n + 1) + ahead[good], back[fine] * (n + 1) + lines[fine] + 1]))
    start, end = pairs // (n + 1), pairs % (n + 1)
    if not len(start):
        return start, start, end, np.zeros(0, np.uint64), start, hashes, first
    gram_end = np.searchsorted(before, before[:-1] + GRAM_WORDS, side="left")
    gram = text.span_hashes(np.ascontiguousarray(hashes[:, 0]), lines, np.minimum(gram_end, n), text.BASES[1])
    last = np.searchsorted(gram_end, end, side="right")  # grams start .. last-1 lie inside
    place = _first_least(gram, start, last)
    return doc[start], start, end, gram[place], place, hashes, first


def positions(column: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """Document number of each selected place, and fingerprint, place, low, lines, spans.

    ``lines`` are the line hashes from line ``low`` of the document on, as far as the windows that selected the place
    reach; ``spans`` are those windows, from ``low``. Starts, ends and places of the windows never decrease, so the
    windows of a place are neighbours.
    """
    owner, start, stop, least, place, hashes, first = windows(column)
    _, begin = np.unique(place, return_index=True)
    edge = np.append(begin, len(place))
    low, high = start[begin], stop[edge[1:] - 1]
    at = np.concatenate([[0], np.cumsum(high - low)])
    inside = np.arange(at[-1]) + np.repeat(low - at[:-1], high - low)
    spans = (np.stack([start, stop], 1) - np.repeat(low, np.diff(edge))[:, None]).astype(np.int32)
    owner = owner[begin]
    return owner, [
        pa.array(least[begin].view(np.int64)),
        pa.array(place[begin] - first[owner], pa.int32()),
        pa.array(low - first[owner], pa.int32()),
        text.blobs(hashes[inside].ravel(), at * 2),
        text.blobs(spans.ravel(), edge * 2),
    ]


_POSITIONS = "doc_id long, row long, fingerprint long, place int, low int, lines binary, spans binary"
_FOUND = "doc_id long, row long, start int, stop int, window long, twin long"


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a key of id and text, so that rows which share an id stay apart."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))


def _position_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text"):
                owner, columns = positions(part.column("text"))
                take = pa.array(owner)
                own = [part.column("doc_id").cast(pa.int64()).take(take), part.column("row").take(take)]
                yield pa.RecordBatch.from_arrays(own + columns, names=["doc_id", "row", "fingerprint", "place", "low", "lines", "spans"])

    return _keyed(docs).where("text IS NOT NULL").mapInArrow(run, _POSITIONS)


def _with_first(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The stored rows whose key occurs more than once, with ``first``, the least row of the key, and ``part`` of ``parts``.

    The rows of a hot key are dealt over PARTS parts. The hot keys that are broadcast are fewer than HOT.
    """
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", *order)
    firsts = stored(rows.groupBy(*keys).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    hot = F.col("n") > rows.count() // HOT + PARTS
    firsts = firsts.select(*keys, "first", F.when(hot, PARTS).otherwise(1).alias("parts"))
    dealt = rows.join(F.broadcast(firsts.where("parts > 1").select(*keys, "parts")), keys, "left")
    part = F.pmod(F.xxhash64("row", order[0]), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = dealt.withColumn("part", part).drop("parts")
    return dealt.join(_copied(firsts), [*keys, "part"])


def _copied(firsts: DataFrame) -> DataFrame:
    return firsts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))


def agreeing(own: np.ndarray, other: np.ndarray, at: int, other_at: int) -> tuple[int, int]:
    """First line, and line after the last, of the match of ``own`` around line ``at`` with ``other`` around ``other_at``."""

    def length(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = np.flatnonzero((a[:n] != b[:n]).any(axis=1))
        return int(differ[0]) if len(differ) else n

    back = length(own[:at][::-1], other[:other_at][::-1])
    return at - back, at + length(own[at:], other[other_at:])


def _extended(pairs: DataFrame) -> DataFrame:
    """Matches (without ``window``), and windows that differ from the first position's (with their two hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("row", "place", "low", "first_row", "first_place", "first_low")
            numbers = zip(*(batch.column(c).to_pylist() for c in names), strict=True)
            blobs = zip(*(batch.column(c) for c in ("lines", "spans", "first_lines")), strict=True)
            cuts, left, lines, before = [], [np.zeros((0, 5), np.int64)], [np.zeros((0, 2), np.uint64)], 0
            for k, ((row, place, low, first_row, first_place, first_low), (own, spans, other)) in enumerate(zip(numbers, blobs, strict=True)):
                own, other = (np.frombuffer(x.as_buffer(), np.uint64).reshape(-1, 2) for x in (own, other))
                spans = np.frombuffer(spans.as_buffer(), np.int32).reshape(-1, 2).astype(np.int64)
                start, stop = agreeing(own, other, place - low, first_place - first_low)
                inside = (spans[:, 0] >= start) & (spans[:, 1] <= stop)
                # in one document, a window that overlaps its first occurrence is no repeat
                cut = spans[inside & ((row != first_row) | (place - first_place >= spans[:, 1] - spans[:, 0]))]
                if len(cut):
                    cuts.append((k, low + cut[0, 0], low + cut[-1, 1]))
                rest = spans[~inside]
                if len(rest):
                    left.append(np.column_stack([np.full(len(rest), k), rest + low, rest + before]))
                    lines.append(own)
                    before += len(own)
            cuts, left, lines = np.array(cuts, np.int64).reshape(-1, 3), np.concatenate(left), np.concatenate(lines)
            take = pa.array(np.concatenate([cuts[:, 0], left[:, 0]]))
            hashes = [text.span_hashes(np.ascontiguousarray(lines[:, i]), left[:, 3], left[:, 4], text.BASES[i]).view(np.int64) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("row").take(take)]
                + [pa.array(np.concatenate([cuts[:, i], left[:, i]]), pa.int32()) for i in (1, 2)]
                + [pa.concat_arrays([pa.nulls(len(cuts), pa.int64()), pa.array(h)]) for h in hashes],
                names=["doc_id", "row", "start", "stop", "window", "twin"],
            )

    return pairs.mapInArrow(run, _FOUND)


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, row, start, stop of runs of lines that repeat earlier ones; together they cover all that do."""
    rows = stored(_position_rows(docs), "positions")
    some = stored(_with_first(rows, ["fingerprint"], "place"), "candidates")
    at_first = some.where((F.col("row") == F.col("first.row")) & (F.col("place") == F.col("first.place")))
    firsts = at_first.dropDuplicates(["fingerprint"])
    firsts = firsts.select("fingerprint", "parts", *(F.col(c).alias(f"first_{c}") for c in ("row", "place", "low", "lines")))
    pairs = some.drop("first", "parts").join(_copied(firsts), ["fingerprint", "part"])
    found = stored(_extended(pairs), "matches")
    whole = _with_first(stored(found.where("window IS NOT NULL"), "differing"), ["window", "twin"], "start", "stop")
    later = (F.col("row") != F.col("first.row")) | (F.col("start") >= F.col("first.stop"))
    columns = ["doc_id", "row", "start", "stop"]
    return found.where("window IS NULL").select(columns).unionByName(whole.where(later).select(columns))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without their repeated runs of lines: all columns, text replaced, and n_lines, n_removed, removed.

    ``removed`` lists runs as first:last line from 0, comma-joined. Columns of these names in the input are replaced.
    """
    cuts = repeated(docs).groupBy("row").agg(F.collect_set(F.struct("start", "stop")).alias("cuts"))  # of one document
    added = ["n_lines", "n_removed", "removed"]
    kept = [c for c in docs.columns if c not in added]
    source = docs.select(*kept).withColumn("line_key", F.xxhash64("doc_id", "text"))
    source = source.join(cuts.withColumnRenamed("row", "line_key"), "line_key", "left")
    flat = F.transform("cuts", lambda c: c["start"]), F.transform("cuts", lambda c: c["stop"])
    source = source.select(*kept, flat[0].alias("cut_start"), flat[1].alias("cut_stop"))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for value, start, stop in zip(*(batch.column(c).to_pylist() for c in ("text", "cut_start", "cut_stop")), strict=True):
                lines = [] if value is None else value.split("\n")
                gone = np.zeros(len(lines) + 1, np.int64)
                if start:
                    np.add.at(gone, start, 1)
                    np.add.at(gone, stop, -1)
                    gone = (np.cumsum(gone) > 0).astype(np.int64)
                    value = "\n".join(line for line, x in zip(lines, gone, strict=False) if not x)
                turns = np.flatnonzero(np.diff(gone, prepend=0, append=0))
                runs = ",".join(f"{a}:{b - 1}" for a, b in turns.reshape(-1, 2).tolist())
                for column, x in zip(out, (value, len(lines), int(gone.sum()), runs), strict=True):
                    column.append(x)
            changed = pa.array(out[0], pa.string())
            columns = [changed if c == "text" else batch.column(c) for c in kept]
            columns += [pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    return source.mapInArrow(run, f"{fields}, n_lines long, n_removed long, removed string")
