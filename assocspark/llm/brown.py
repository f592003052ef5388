"""Language-model scores from a Brown class-based bigram model, with a unigram baseline.

The probability of a token is P(class | class before) * P(token | class). Frequent words (at least FREQUENT of all
training tokens, so at most 1 / FREQUENT of them) get classes by exchange clustering: each word in turn is moved to the class
that raises the likelihood of the class bigrams most. The counts a sweep needs, of each word with the classes
before and after it, are made in Spark from the table of word bigrams; only these sums, whose size is bounded by
words times classes, reach the driver. A rare word is put where most of its occurrences fit best between
their neighbours' classes; rare words have classes of their own beside those of the frequent ones. Transitions are smoothed with class
frequencies. An unknown word is one further token type, whose probability is the share of words seen once.

The vocabulary is never held whole: texts are cut into chunks of documents of a bounded size, each chunk's
distinct rare words are joined with their counts, and the result returns to the chunk. Counts cover all training documents.

Defined cases: NULL and empty texts have the end token alone. Without training documents every token is unknown and has
probability 1. Repeated rows are documents of their own; a NULL id is scored too. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assocspark.llm import text
from assocspark.llm.store import stored

FREQUENT = 5e-5
LEAST = 3  # a frequent word is seen so often at least
CLASSES = 48
SWEEPS = 10
PRIOR = 5.0  # weight of the class frequencies in a transition
END, OTHER = 0, CLASSES + 1  # classes 1 .. CLASSES hold frequent words, RARE + those rare ones
RARE = CLASSES
KINDS = 2 * CLASSES + 1
UNSEEN = 255
_CHUNK = 3 << 20


@dataclass
class Words:
    """Frequent words by sorted hash, their counts and classes."""

    hashes: np.ndarray
    classes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word from 1, or one more than there are for rare words."""
        if not len(self.hashes):
            return np.ones(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at + 1, len(self.hashes) + 1)


def _emit(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "n"])


def _summed(rows: DataFrame, run) -> DataFrame:
    return rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _frequent(train: DataFrame) -> tuple[Words, int]:
    """Frequent words and the number of training tokens (words and ends).

    A word that makes up a share of all tokens does so in one chunk at least, so chunks report only such words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text", _CHUNK):
                hashes, first = text.words(part.column("text"))
                found, n = np.unique(hashes, return_counts=True)
                keep = n >= FREQUENT * len(hashes)
                yield _emit(found[keep].view(np.int64), n[keep])
                yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([len(hashes) + part.num_rows])], names=["key", "n"])

    rows = stored(_summed(train.select("text"), run), "frequent")
    total = (rows.where("key IS NULL").first() or {"n": 0})["n"]
    chosen = rows.where(F.col("key").isNotNull() & (F.col("n") >= max(FREQUENT * total, LEAST))).toArrow()
    return Words(np.sort(chosen.column("key").to_numpy().view(np.uint64))), total


def _sequences(numbers: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """The numbers of all documents with an end before the first and after each."""
    out = np.insert(numbers, first[1:], end)
    return np.concatenate([[end], out])


def _bigrams(train: DataFrame, words: Words) -> DataFrame:
    """key = before * (words + 2) + after, n: bigrams of numbers, 0 for ends and the last for rare words."""
    width = len(words.hashes) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text", _CHUNK):
                hashes, first = text.words(part.column("text"))
                seq = _sequences(words.find(hashes), first, 0)
                yield _emit(*np.unique(seq[:-1] * width + seq[1:], return_counts=True))

    return stored(_summed(train.select("text"), run), "bigrams")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def _neighbours(bigrams: DataFrame, width: int, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each number follows, and precedes, each class."""
    kinds = OTHER + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n = batch.column("key").to_numpy(), batch.column("n").to_numpy()
            a, b = key // width, key % width
            cells = np.concatenate([b * kinds + classes[a], (width + a) * kinds + classes[b]])
            found, at = np.unique(cells, return_inverse=True)
            yield _emit(found, np.bincount(at, np.concatenate([n, n]), minlength=len(found)))

    sums = _summed(bigrams, run).toArrow()  # at most 2 * numbers * classes rows
    out = np.zeros(2 * width * kinds)
    out[sums.column("key").to_numpy()] = sums.column("n").to_numpy()
    left, right = out.reshape(2, width, kinds)
    return left, right


def _exchange(left: np.ndarray, right: np.ndarray, classes: np.ndarray, turn: int) -> int:
    """One sweep over every other word, most frequent first; changes ``classes``, returns the number of moves."""
    kinds = OTHER + 1
    table = np.zeros((kinds, kinds))
    np.add.at(table, classes, right)
    moves = 0
    for w in np.argsort(-right.sum(1), kind="stable"):
        old, l, r = classes[w], left[w], right[w]  # noqa: E741
        if w in (0, len(classes) - 1) or w % 2 != turn % 2:
            continue
        table[:, old] -= l
        table[old] -= r
        np.maximum(table, 0.0, out=table)
        rows, columns, n = table.sum(1), table.sum(0), r.sum()
        gain = (_xlogx(table + l[:, None]) - _xlogx(table)).sum(0) + (_xlogx(table + r) - _xlogx(table)).sum(1)
        gain -= _xlogx(rows + n) - _xlogx(rows) + _xlogx(columns + n) - _xlogx(columns)
        new = 1 + int(np.argmax(gain[1 : CLASSES + 1]))
        if gain[new] <= gain[old] + 1e-9:
            new = old
        table[:, new] += l
        table[new] += r
        moves += new != old
        classes[w] = new
    return moves


def cluster(train: DataFrame) -> tuple[Words, np.ndarray, int, int]:
    """Frequent words with classes, class bigrams (rare words as one class), training tokens and documents."""
    words, total = _frequent(train)
    bigrams, width = _bigrams(train, words), len(words.hashes) + 2
    classes = np.zeros(width, np.int64)
    classes[-1] = OTHER
    left, right = _neighbours(bigrams, width, classes)
    order = np.argsort(-right[1:-1].sum(1), kind="stable") + 1
    classes[order] = 1 + np.arange(len(order)) % CLASSES
    for turn in range(2 * SWEEPS):
        left, right = _neighbours(bigrams, width, classes)
        if not _exchange(left, right, classes, turn) and turn > 1:
            break
    left, right = _neighbours(bigrams, width, classes)
    table = np.zeros((OTHER + 1, OTHER + 1))
    np.add.at(table, classes, right)
    words.classes, words.counts = classes[1:-1], right[1:-1].sum(1).astype(np.int64)
    return words, table, total, int(right[0].sum())


def _fit_between(table: np.ndarray) -> np.ndarray:
    """The class 1 .. CLASSES that fits best between two classes; OTHER on both sides says nothing (0)."""
    share = (table + 0.5) / (table + 0.5).sum(1, keepdims=True)
    into, out = np.log(share[:, 1 : CLASSES + 1]), np.log(share[1 : CLASSES + 1]).T
    into[OTHER], out[OTHER] = 0.0, 0.0
    best = 1 + (into[:, None, :] + out[None, :, :]).argmax(2)
    best[OTHER, OTHER] = 0
    return best


_ENTRY = np.dtype([("word", "<i8"), ("place", "<i4"), ("n", "<i4"), ("vote", "<i4"), ("votes", "<i4")])


def _chunks(docs: DataFrame, held_out: Column, words: Words, table: np.ndarray) -> DataFrame:
    """Documents as class sequences with gaps for rare words, a bounded chunk of documents in each row.

    entries: the chunk's distinct rare words, their training count and how often each class fitted there.
    """
    best = _fit_between(table)
    totals = np.bincount(words.classes, words.counts, minlength=CLASSES + 1) if len(words.counts) else np.ones(CLASSES + 1)
    own = np.log10(words.counts / totals[words.classes]) if len(words.counts) else np.zeros(0)
    # one more value, for rare words
    classes, counts = np.append(words.classes, OTHER), np.append(words.counts, 0)
    emission, base = np.append(own, 0.0), np.append(np.log10(words.counts + 0.1), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in text.slices(batch, "text", _CHUNK):
                hashes, first = text.words(part.column("text"))
                number = words.find(hashes) - 1
                kind = classes[number]
                rare = np.flatnonzero(kind == OTHER)
                found, place = np.unique(hashes[rare], return_inverse=True)
                doc = np.repeat(np.arange(part.num_rows), np.diff(first))
                held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                seen = ~held[doc[rare]]
                n = np.bincount(place, seen, minlength=len(found)).astype(np.int64)
                seq = _sequences(kind, first, END)
                at = rare + doc[rare] + 1  # where the rare words are in seq
                vote = best[seq[at - 1], seq[at + 1]]
                cells, votes = np.unique(place[seen] * (CLASSES + 1) + vote[seen], return_counts=True)
                cells = np.concatenate([cells, np.flatnonzero(n == 0) * (CLASSES + 1)])
                entry = np.zeros(len(cells), _ENTRY)
                entry["place"], entry["vote"] = cells // (CLASSES + 1), cells % (CLASSES + 1)
                entry["votes"][: len(votes)] = votes
                entry["votes"][entry["vote"] == 0] = 0
                entry["word"] = found.view(np.int64)[entry["place"]]
                entry = entry[np.argsort(entry["place"], kind="stable")]
                lead = np.ones(len(entry), bool)
                lead[1:] = entry["place"][1:] != entry["place"][:-1]
                entry["n"] = np.where(lead, n[entry["place"]], -1)  # -1: a further vote on the word before
                known = counts[number]
                # of no words, bincount gives integers even with weights
                sums = [np.bincount(doc, x, minlength=part.num_rows).astype(np.float64) for x in (known > 0, base[number], emission[number])]
                rows = {
                    "doc_id": part.column("doc_id").cast(pa.int64()), "held_out": pa.array(held), "words": pa.array(np.diff(first), pa.int64()),
                    "known": pa.array(sums[0].astype(np.int64)), "base": pa.array(sums[1]), "emission": pa.array(sums[2]),
                }
                whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                blob = lambda x: pa.array([x.tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 32) + made], pa.int64()), *(whole(x) for x in rows.values())]
                    + [blob(kind.astype(np.uint8)), blob(place.astype("<i4")), blob(entry)],
                    names=["chunk", *rows, "kinds", "places", "entries"],
                )
                made += 1

    schema = "chunk long, doc_id array<long>, held_out array<boolean>, words array<long>, known array<long>, base array<double>, "
    schema += "emission array<double>, kinds binary, places binary, entries binary"
    source = docs.select("doc_id", "text", held_out.alias("held_out"))
    return stored(source.mapInArrow(run, schema), "chunks")


def _dictionary(chunks: DataFrame) -> DataFrame:
    """chunk, place, n, kind, lead for the rare words of each chunk: training count and class; lead once for each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("entries"), strict=True):
                entry = np.frombuffer(blob.as_buffer(), _ENTRY)
                columns = [pa.array(np.full(len(entry), chunk))] + [pa.array(np.ascontiguousarray(entry[c])) for c in _ENTRY.names]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", *_ENTRY.names])

    rows = chunks.select("chunk", "entries").mapInArrow(run, "chunk long, word long, place int, n int, vote int, votes int")
    rows = rows.repartition("word")  # serves both windows; a rare word has few rows in each chunk
    word, each = Window.partitionBy("word"), Window.partitionBy("word", "vote")
    rows = rows.withColumn("total", F.sum("votes").over(each))
    rows = rows.withColumn("best", F.max(F.struct("total", "vote")).over(word)["vote"])
    rows = rows.withColumn("count", F.sum(F.greatest("n", F.lit(0))).over(word))
    first = F.row_number().over(word.orderBy("chunk", "place", F.desc("n"))) == 1
    rows = rows.withColumn("lead", first).where("n >= 0")
    kind = F.when(F.col("count") == 0, UNSEEN).otherwise(F.greatest("best", F.lit(1)) + RARE)
    return stored(rows.select("chunk", "place", F.col("count").alias("n"), kind.cast("int").alias("kind"), "lead"), "dictionary")


def _classed(chunks: DataFrame, dictionary: DataFrame, totals: np.ndarray) -> DataFrame:
    """Each document with sums over its known words and the classes of all its words."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0].as_py() for c in left.column_names}
        kinds = np.frombuffer(row["kinds"], np.uint8).copy()
        places = np.frombuffer(row["places"], "<i4")
        order = right.column("place").to_numpy()
        n, kind = (np.zeros(len(order), np.int64) for _ in range(2))
        n[order], kind[order] = right.column("n").to_numpy(), right.column("kind").to_numpy()
        rare = np.flatnonzero(kinds == OTHER)
        kinds[rare] = kind[places]
        begin = np.concatenate([[0], np.cumsum(row["words"])]).astype(np.int64)
        doc = np.searchsorted(begin, rare, side="right") - 1
        count, size = n[places], len(row["words"])
        own = np.where(count > 0, np.log10(np.maximum(count, 1) / totals[kinds[rare]]), 0.0)
        sums = [np.bincount(doc, x, minlength=size).astype(np.float64) for x in (count > 0, np.log10(count + 0.1), own)]
        return pa.table(
            {
                "doc_id": pa.array(row["doc_id"], pa.int64()),
                "held_out": pa.array(row["held_out"], pa.bool_()),
                "words": pa.array(row["words"], pa.int64()),
                "known": pa.array(np.array(row["known"], np.int64) + sums[0].astype(np.int64)),
                "base": pa.array(np.array(row["base"]) + sums[1]),
                "emission": pa.array(np.array(row["emission"]) + sums[2]),
                "kinds": text.blobs(kinds, begin),
            }
        )

    schema = "doc_id long, held_out boolean, words long, known long, base double, emission double, kinds binary"
    right = dictionary.select("chunk", "place", "n", "kind").groupBy("chunk")
    return stored(chunks.drop("entries").groupBy("chunk").cogroup(right).applyInArrow(run, schema), "classed")


def _transitions(classed: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(KINDS * KINDS, np.int64)
        for batch in batches:
            for value in batch.column("kinds"):
                seq = np.frombuffer(value.as_buffer(), np.uint8).astype(np.int64)
                seq = np.concatenate([[END], seq, [END]])
                table += np.bincount(seq[:-1] * KINDS + seq[1:], minlength=len(table))
        at = np.flatnonzero(table)
        yield _emit(at, table[at])

    sums = _summed(classed.where("NOT held_out").select("kinds"), run).toArrow()  # classes squared
    out = np.zeros(KINDS * KINDS)
    out[sums.column("key").to_numpy()] = sums.column("n").to_numpy()
    out = out.reshape(KINDS, KINDS)
    share = out.sum(0) / max(out.sum(), 1.0)
    with np.errstate(divide="ignore"):
        return np.log10((out + PRIOR * share) / (out.sum(1, keepdims=True) + PRIOR))


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learn from the documents that are not held out, score all.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities), perplexity.
    """
    train = docs.where(~held_out)
    words, table, total, ends = cluster(train)
    chunks = _chunks(docs, held_out, words, table)
    dictionary = _dictionary(chunks)
    rare = dictionary.where("lead AND n > 0").groupBy("kind")
    rare = rare.agg(F.sum("n").alias("n"), F.count("*").alias("size"), F.sum((F.col("n") == 1).cast("long")).alias("once")).collect()
    totals = np.ones(256)
    for r in rare:  # one row for each class
        totals[r["kind"]] = r["n"]
    distinct = len(words.hashes) + sum(r["size"] for r in rare) + (ends > 0)
    unknown = min(max(sum(r["once"] for r in rare), 1) / total, 0.5) if total else 1.0
    classed = _classed(chunks, dictionary, totals)
    log = _transitions(classed)
    ends_base = float(np.log10(ends + 0.1))
    below = float(np.log10(total + 0.1 * (distinct + 1)))
    known_share, unknown_share = (float(np.log10(x)) if x > 0 else 0.0 for x in (1 - unknown, unknown))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for value in batch.column("kinds"):
                seq = np.frombuffer(value.as_buffer(), np.uint8).astype(np.int64)
                known = seq[seq != UNSEEN]  # after an unknown word, the last known class still counts
                path = np.concatenate([[END], known, [END]])
                part = log[path[:-1], path[1:]].sum() + len(path[1:]) * known_share if ends else 0.0
                sums.append(float(part + (len(seq) - len(known)) * unknown_share))
            columns = [batch.column(c) for c in ("doc_id", "held_out", "words", "known", "base", "emission")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums)], names=["doc_id", "held_out", "words", "known", "base", "emission", "path"])

    found = classed.mapInArrow(run, "doc_id long, held_out boolean, words long, known long, base double, emission double, path double")
    tokens = F.col("words") + 1
    value = F.col("emission") + F.col("path")
    return found.select(
        "doc_id",
        "held_out",
        tokens.alias("n_tokens"),
        (F.col("known") + (1 if ends else 0)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(ends_base) - tokens * F.lit(below)).alias("base_score"),
        value.alias("score"),
        F.pow(F.lit(10.0), -value / tokens).alias("perplexity"),
    )
