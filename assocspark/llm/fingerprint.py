"""Document fingerprints: threshold-scaled sketches of five-word shingles.

A fingerprint holds every shingle hash below a fixed share of the hash range, as sorted numbers of eight hex
digits. The share is the same for all documents, so the fingerprint of a union is the union of fingerprints, and the
containment of one text in another can be estimated however different their lengths are. A text of which no hash is below
the share keeps its least one, so short texts differ; the least of a union is the least of the parts, so merging stays exact.

Defined cases: a NULL text is empty; the fingerprint of a text without words is empty, that of any other is not. A text with
fewer than five words has one shingle. Equal fingerprints have likeness 1, an empty and a filled one 0. In
the order of documents repeated ids follow each other by a hash of their texts, and NULL ids come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assocspark.llm import text

WORDS = 5
SHARE = 4  # one in so many hashes is kept


def sketches(column: pa.Array) -> list[np.ndarray]:
    """The sorted kept hashes of each text."""
    values, begin = text.shingles(column, WORDS)
    keep = values < np.uint64(2**64 // SHARE)
    runs = np.diff(begin)
    if len(values):
        keep |= values == np.repeat(np.minimum.reduceat(values, begin[:-1][runs > 0]), runs[runs > 0])
    values, begin = values[keep] >> np.uint64(32), np.concatenate([[0], np.cumsum(keep)])[begin]
    values, begin = text.distinct_runs(values, begin)
    values = values.astype(np.uint32)
    return [values[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]


def shown(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated containment of the smaller text in the other one."""
    if np.array_equal(a, b):
        return 1.0
    least = min(len(a), len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / least if least else 0.0


def merged(a: str, b: str) -> str:
    """The fingerprint of two texts taken together, from theirs."""
    split = lambda s: {s[i : i + 8] for i in range(0, len(s), 8)}
    every = sorted(split(a) | split(b))
    below = [h for h in every if int(h, 16) < 2**32 // SHARE]
    return "".join(below or every[:1])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text"):
                column = part.column("text")
                out = [part.column("doc_id").cast(pa.int64()), pa.array([len(t or "") for t in column.to_pylist()], pa.int64())]
                out.append(pa.array([shown(s) for s in sketches(column)], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_chars", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _above(value: Column, cuts: list[int]) -> Column:
    """How many of the descending ``cuts`` are not below the value: first over every w-th of them, then inside one stretch of w."""
    width = max(int(len(cuts) ** 0.5), 1)
    count = lambda some, start: F.aggregate(some, start, lambda n, c: n + (value <= c).cast("int"))
    known = lambda some: F.array(*[F.lit(c).cast("long") for c in some])
    coarse = count(known(cuts[width - 1 :: width]), F.lit(0)) * width
    return count(F.slice(known(cuts), coarse + 1, F.lit(width)), coarse)


def followed(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """The documents by descending id in ranges, each range sorted and closed by a copy of the row that follows it.

    Columns: part, doc_id, text, extra (the closing copy). The row after the last is the first. Texts are
    shuffled once; the driver holds a few numbers for each range.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = [k / ranges for k in range(1, ranges)]
    cuts = docs.select(F.percentile_approx("doc_id", marks, 10_000)).first()[0] if marks else []
    cuts = sorted(set(cuts or []), reverse=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # part 0 has the ids above the highest mark; NULL ids are in the last part
    place = _above(F.col("doc_id"), cuts) if cuts else F.lit(0)
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(place))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    key = lambda: F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", (-F.col("tie").cast("decimal(20,0)")).alias("t"))
    firsts = {r["part"]: r["head"] for r in rows.groupBy("part").agg(F.max(key()).alias("head")).collect()}  # one row a range
    filled = sorted(firsts)
    lead = [(firsts[p]["doc_id"], int(-firsts[p]["t"]), filled[k - 1] if k else filled[-1]) for k, p in enumerate(filled)]
    heads = spark.createDataFrame(lead, "head_id long, head_tie long, into int")
    copies = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")))
    copies = copies.select("doc_id", "text", F.col("into").alias("part"), "tie").withColumn("extra", F.lit(True))
    # of rows that are the same in all, any one will do
    one = Window.partitionBy("part").orderBy("doc_id")
    copies = copies.withColumn("n", F.row_number().over(one)).where("n = 1").drop("n")
    every = rows.withColumn("extra", F.lit(False)).select("doc_id", "text", "part", "tie", "extra").unionByName(copies)
    dealt = every.repartitionById(ranges, "part")  # each range is a task of its own
    order = ["part", "extra", F.col("doc_id").desc_nulls_last(), "tie"]
    return dealt.sortWithinPartitions(*order).select("part", "doc_id", "text", "extra")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness to each other and to the next document.

    The edited text has the last third of the characters replaced by as many from the start of the next document, or
    all of it. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the row whose next one is still to come
        for batch in batches:
            for part in text.slices(batch, "text", 2 << 20):
                rows = held + list(zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "extra")), strict=True))
                own = [r[1] or "" for r in rows]
                made = sketches(pa.array(own, pa.large_string()))
                use = [k for k in range(len(rows) - 1) if not rows[k][2]]
                edited = []
                for k in use:
                    third = len(own[k]) // 3
                    edited.append(own[k][: len(own[k]) - third] + own[k + 1][:third])
                after = sketches(pa.array(edited, pa.large_string()))
                columns = {
                    "doc_id": pa.array([rows[k][0] for k in use], pa.int64()),
                    "n_chars": pa.array([len(own[k]) for k in use], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                    "fingerprint": pa.array([shown(made[k]) for k in use], pa.string()),
                    "edited_fingerprint": pa.array([shown(s) for s in after], pa.string()),
                    "near_edited": pa.array([likeness(made[k], s) for k, s in zip(use, after, strict=True)], pa.float64()),
                    "near_next": pa.array([likeness(made[k], made[k + 1]) for k in use], pa.float64()),
                }
                yield pa.RecordBatch.from_pydict(columns)
                held = rows[-1:]

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return followed(docs).select("doc_id", "text", "extra").mapInArrow(run, schema)
