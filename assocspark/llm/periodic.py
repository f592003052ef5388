"""Runs of repeated words: all maximal periodic stretches of each text, and the text without the repeats.

A run is a stretch of words in which words ``period`` apart are equal, at least ``max(LEAST, 2 * period)`` long, that
no neighbouring word extends; ``period`` is its smallest period. Runs are found by internal pattern matching:

* The word sequences of a slice of documents get one suffix array, by prefix doubling. Words count as equal within one document
  only, so groups stay small and no comparison crosses documents. At depth b = 2, 4, 8, ... the groups of the doubling
  are the suffix array ranges of all stretches of b words.
* A run of period q holds a stretch of b words that starts at a multiple of b, where 2b - 1 <= q <= 4b - 2, and the
  same stretch q words later. So each such dyadic block asks for its occurrences in the next 4b - 2 words: a range successor
  query (least position above x in a range of the suffix array), answered by a wavelet matrix over the suffix array.
* Occurrences closer than b / 2 form a progression, whose difference is the period of the block. It is walked in one step
  with common extensions, which are read from the ranks of the doubling. A progression in the run that the block itself
  lies in has its difference as candidate period; one in a later run has the shifts that bring both starts or both ends of the two runs
  together, and all its distances where the two runs meet, as each is then the period of a run of its own; a lone occurrence has its
  distance. So the candidates of a text are in proportion to its words, whatever the text.
* Candidates are extended both ways; those long enough are runs, the least period for each stretch.

Everything is exact: words are compared through a dictionary, not through hashes. Time and memory for a text of n words are in the order
of n log n. A document is never cut, so a task needs memory in proportion to its longest text (some hundred bytes a word); other documents go
in slices of a bounded size. No shuffle is needed.

Defined cases: a NULL or empty text has no words, no runs, and an empty collapsed text. Repeated ids and rows are documents of their own,
a NULL id is kept. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocspark.llm import text

LEAST = 12  # words
_SLICE = 512 << 10
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_BLANKS = r"[\x20\x09-\x0D]+"


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a slice, their numbers in a dictionary of it, and where each document's words begin."""
    data, at = text.bytes_of(column)
    starts, ends, doc = text.word_spans(data, at)
    places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    packed = data[~((data == 32) | ((data >= 9) & (data <= 13)))]
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(packed)])
    codes = words.dictionary_encode().indices.to_numpy()
    return words, codes.astype(np.int64), np.searchsorted(doc, np.arange(len(at)))


class Suffixes:
    """Suffix array of symbols whose last one occurs once, with the ranks at each depth 1, 2, 4, ...

    ``blocks`` holds, for each depth above 1, the positions that are multiples of it and whose stretch occurs again, with their range of
    the suffix array.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.order = np.argsort(symbols, kind="stable")
        slots, key = np.arange(n), symbols[self.order]
        rank, depth = np.zeros(n, np.int64), 1
        self.ranks: list[np.ndarray] = []
        self.blocks: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.repeated = np.zeros(n, bool)  # slots whose first two symbols occur again
        while True:
            lead = np.ones(len(slots), bool)
            lead[1:] = key[1:] != key[:-1]
            firsts = np.flatnonzero(lead)
            sizes = np.diff(np.append(firsts, len(slots)))
            rank[self.order[slots]] = np.repeat(slots[firsts], sizes)
            self.ranks.append(rank.astype(np.int32))
            shared = np.repeat(sizes, sizes)
            slots, shared = slots[shared > 1], shared[shared > 1]
            if depth > 1:
                if depth == 2:
                    self.repeated[slots] = True
                here = self.order[slots]
                aligned = here % depth == 0
                low = rank[here[aligned]]
                self.blocks.append((depth, here[aligned], low, low + shared[aligned]))
            if not len(slots):
                return
            here = self.order[slots]
            key = rank[here] * n + rank[here + depth]  # a stretch that occurs twice ends before the last symbol
            turn = np.argsort(key, kind="stable")
            self.order[slots], key = here[turn], key[turn]
            depth *= 2

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` and from ``b`` on are equal; a < b."""
        same = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[level]
            same += (rank[a + same] == rank[b + same]).astype(np.int64) << level
        return same

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before ``a`` and before ``b`` are equal; a < b."""
        same = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank, back = self.ranks[level], same + (1 << level)
            equal = (rank[np.maximum(a - back, 0)] == rank[np.maximum(b - back, 0)]) & (a >= back)
            same += equal.astype(np.int64) << level
        return same


class Wavelet:
    """A wavelet matrix over whole numbers below ``bound``: range successor in the order of log(bound) steps."""

    def __init__(self, values: np.ndarray, bound: int):
        self.levels = []
        for bit in range(max(int(bound).bit_length(), 1) - 1, -1, -1):
            one = (values >> bit) & 1 == 1
            zeros = np.concatenate([[0], np.cumsum(~one)])
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values in [low, high) are less than x."""
        count = np.zeros(len(x), np.int64)
        for bit, zeros, total in self.levels:
            a, b, one = zeros[low], zeros[high], (x >> bit) & 1 == 1
            count += np.where(one, b - a, 0)
            low, high = np.where(one, total + low - a, a), np.where(one, total + high - b, b)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value with k smaller ones in [low, high)."""
        value = np.zeros(len(k), np.int64)
        for bit, zeros, total in self.levels:
            a, b = zeros[low], zeros[high]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            value += one.astype(np.int64) << bit
            low, high = np.where(one, total + low - a, a), np.where(one, total + high - b, b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray, none: int) -> np.ndarray:
        """The least value of at least x in [low, high), or ``none``."""
        k = self.below(low, high, x)
        out, found = np.full(len(x), none, np.int64), k < high - low
        out[found] = self.smallest(low[found], high[found], k[found])
        return out


def _candidates(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position, period): every run holds such a position, and the one a period later."""
    n = len(suffixes.order)
    wavelet = Wavelet(suffixes.order[suffixes.repeated], n)
    before = np.concatenate([[0], np.cumsum(suffixes.repeated)])
    size = np.concatenate([np.full(len(at), depth) for depth, at, _, _ in suffixes.blocks])
    at, low, high = (np.concatenate([level[i] for level in suffixes.blocks]) for i in (1, 2, 3))
    low, high, end = before[low], before[high], at + 4 * size - 2
    x, places, periods = at + 1, [], []
    while len(at):
        found = wavelet.successor(low, high, x, n)
        near = found <= np.minimum(end, n - 1)
        at, low, high, end, size, found = (v[near] for v in (at, low, high, end, size, found))
        after = wavelet.successor(low, high, found + 1, n)
        step, x = after - found, found + 1
        lone = 2 * step > size
        places.append(at[lone])
        periods.append((found - at)[lone])
        many = np.flatnonzero(~lone)
        if len(many):
            s, o, d, b = at[many], found[many], step[many], size[many]
            own = s - suffixes.behind(s, s + d), s + d + suffixes.ahead(s, s + d)
            other = o - suffixes.behind(o, o + d), o + d + suffixes.ahead(o, o + d)
            last = o + (other[1] - b - o) // d * d
            x[many] = last + 1
            one_run = own[0] == other[0]
            for take, q in ((one_run, d), (~one_run, other[0] - own[0]), (~one_run, other[1] - own[1])):
                places.append(s[take])
                periods.append(q[take])
            meet = np.flatnonzero(~one_run & (own[1] >= other[0]))
            terms = (np.minimum(last, end[many])[meet] - o[meet]) // d[meet] + 1
            term = np.arange(terms.sum()) - np.repeat(np.cumsum(terms) - terms, terms)
            meet = np.repeat(meet, terms)
            places.append(s[meet])
            periods.append(o[meet] + term * d[meet] - s[meet])
    place, period = np.concatenate([*places, at]), np.concatenate([*periods, at])
    fits = (period > 0) & (place + period < n)
    return place[fits], period[fits]


def find_runs(symbols: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of symbols whose last one occurs once, by start and period."""
    suffixes = Suffixes(symbols)
    if not suffixes.repeated.any():
        return np.zeros((0, 3), np.int64)
    place, period = _candidates(suffixes)
    start = place - suffixes.behind(place, place + period)
    length = place + period + suffixes.ahead(place, place + period) - start
    runs = np.stack([start, length, period], 1)[length >= np.maximum(least, 2 * period)]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)  # of one stretch, the least period
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _slice_runs(column: pa.Array, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """For each text: its number of words, its runs, and its words without the repeats."""
    words, codes, first = words_of(column)
    docs = len(first) - 1
    doc = np.repeat(np.arange(docs), np.diff(first))
    at = np.arange(len(codes)) + doc  # each document is followed by a symbol of its own
    symbols = np.full(len(codes) + docs, -1, np.int64)
    symbols[at] = doc * (len(codes) + 1) + codes
    symbols[symbols < 0] = -1 - np.arange(docs)
    runs = find_runs(symbols, least)
    owner = np.searchsorted(first[1:] + np.arange(docs), runs[:, 0], side="left")
    gone = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(gone)[at] == 0)
    begin = np.searchsorted(doc[kept], np.arange(docs + 1))
    lists = pa.LargeListArray.from_arrays(pa.array(begin, pa.int64()), words.take(pa.array(kept)))
    collapsed = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
    own = runs[:, 0] - first[owner] - owner
    values = pa.StructArray.from_arrays([pa.array(own), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(_RUN))
    places = pa.array(np.searchsorted(owner, np.arange(docs + 1)), pa.int32())
    return pa.array(np.diff(first), pa.int64()), pa.ListArray.from_arrays(places, values), collapsed


def collapse(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text of each document.

    A word goes if any run holds it after that run's first period. What stays is joined by one blank.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text", _SLICE):
                found = _slice_runs(part.column("text"), least)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *found], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def repeated_tail(value: Column, hashed: Column) -> Column:
    """The text whose words from a place on repeat a few words; place and period follow from a hash.

    With n words and g = hashed div 10, word i >= a = g mod n becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    """
    words = F.filter(F.split(value, _BLANKS), lambda w: w != "")
    # a list of one struct, so that the words are split once
    once = F.array(F.struct(words.alias("words"), F.floor(hashed / 10).cast("long").alias("g")))
    return F.get(F.transform(once, lambda s: F.array_join(_tail_repeated(s["words"], s["g"]), " ")), F.lit(0))


def _tail_repeated(words: Column, g: Column) -> Column:
    n = F.size(words).cast("long")
    a = F.try_mod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
    return F.when(n > 0, F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n.cast("int"))).otherwise(words)
