"""Near-duplicate detection with SetSketch registers.

Each document is the set of its distinct five-word shingles. A register holds the minimum of one
exponentially distributed hash over the set, on an exponentially spaced scale and truncated, so registers
of a union are register maxima and equal registers become likelier with similarity. Bands of registers
propose pairs, the joint likelihood of two register rows estimates their similarity, and pairs that may be
similar enough are verified on their full sets. The chance that a pair at the threshold shares no band is
below one in 50,000, and falls steeply above it.

Hot groups: documents with equal sets are one class, found by a digest. In a band bucket every class is
first compared with one member only, so a bucket of n classes gives n-1 pairs. Classes that still share a
bucket with another component are compared again, across components only and only if they share one of the
rare shingles that similar sets must share. Pairs inside one component cannot change the result, so no link
between different components is lost and no group is expanded into all pairs.

Defined cases: NULL, empty and blank texts have no shingles, stand alone and are kept. Rows that repeat an
id are classed by their own texts. A NULL id never names a component while another id can; alone, it is
kept. Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocspark.llm import text
from assocspark.llm.store import stored

WORDS = 5
REGISTERS = 128
BANDS = 32
ROWS = REGISTERS // BANDS
BASE = 1.01  # spacing of the register scale
TOP = 4_000  # registers are truncated to 0 .. TOP + 1
RATE = 20.0
FILTER_BITS = 24
CELLS = 1 << 18
SLICE = 1 << 19  # bytes of texts hashed at a time
SLACK = 0.17  # estimates this far below the threshold are still verified: over four standard errors

_SKETCH = "doc_id long, n_shingles long, class long, digest binary, registers binary"


def _registers(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Register rows (documents x REGISTERS) of runs of distinct shingle hashes; empty runs give zeros."""
    rng = np.random.default_rng(7)
    odd = rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 2**64, REGISTERS, dtype=np.uint64)
    full = np.flatnonzero(np.diff(begin))
    out = np.zeros((len(begin) - 1, REGISTERS), np.uint16)
    if len(full):
        at = begin[:-1][full]
        for k in range(REGISTERS):
            low = np.minimum.reduceat(values * odd[k] + shift[k], at)
            unit = (low.astype(np.float64) + 1.0) / 2.0**64
            least = -np.log1p(-np.minimum(unit, 1 - 2**-53)) / RATE  # the minimum of exponential values
            out[full, k] = np.clip(np.floor(1.0 - np.log(least) / np.log(BASE)), 0, TOP + 1)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """Set size, class and digest of the set, and registers of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text", SLICE):
                values, begin = text.distinct_runs(*text.shingles(part.column("text"), WORDS))
                n = part.num_rows
                twin = np.stack([text.span_hashes(values, begin[:-1], begin[1:], b) for b in text.BASES], 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(np.diff(begin), pa.int64()),
                        pa.array(twin[:, 0].view(np.int64)),
                        text.blobs(twin.ravel(), np.arange(n + 1) * 2),
                        text.blobs(_registers(values, begin).ravel(), np.arange(n + 1) * REGISTERS),
                    ],
                    names=["doc_id", "n_shingles", "class", "digest", "registers"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, _SKETCH)


def _rows_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _buckets(classes: DataFrame) -> DataFrame:
    """Band buckets that hold two classes or more: bucket, class, and how many classes the bucket holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regs = _rows_of(batch.column("registers")).astype(np.uint64)
            cells = (regs + np.uint64(1)).ravel() + np.tile(np.arange(REGISTERS, dtype=np.uint64) << np.uint64(20), len(regs))
            edge = np.arange(len(regs) * BANDS + 1) * ROWS
            keys = text.span_hashes(cells, edge[:-1], edge[1:]).view(np.int64)
            kept = np.repeat(batch.column("class").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(kept)], names=["bucket", "class"])

    rows = classes.select("class", "registers").mapInArrow(run, "bucket long, class long")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    return rows.join(sizes, "bucket")


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood estimate of the Jaccard similarity from register rows and set sizes.

    With u and v the shares of the union-normalised sizes and J the similarity, one register of A exceeds
    that of B with probability p(u - v J), where p(x) = -log_b(1 - x (b - 1) / b). The log-likelihood of
    the counts of larger, smaller and equal registers is concave in J; its maximum is bisected.
    """
    m = a.shape[1]
    more = (a > b).sum(1) / m
    less = (a < b).sum(1) / m
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
    top = np.minimum(u / v, v / u)
    log_b, c = np.log(BASE), (BASE - 1) / BASE

    def slope(j):
        x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        p, q = -np.log1p(-x * c) / log_b, -np.log1p(-y * c) / log_b
        dp, dq = -v * c / (1 - x * c) / log_b, -u * c / (1 - y * c) / log_b
        return more * dp / p + less * dq / q - (1 - more - less) * (dp + dq) / np.maximum(1 - p - q, 1e-12)

    low, high = np.zeros(len(u)), top * 1.0
    for _ in range(40):
        mid = (low + high) / 2
        up = slope(mid) > 0
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return (low + high) / 2


def _promising(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Candidate pairs whose estimated similarity is not clearly below the threshold."""
    side = lambda x: classes.select(
        F.col("class").alias(x), F.col("registers").alias(f"registers_{x}"), F.col("n_shingles").alias(f"size_{x}")
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(100 * F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 20_000):
                part = batch.slice(k, 20_000)
                rows = (_rows_of(part.column(c)) for c in ("registers_a", "registers_b"))
                j = estimate(*rows, *(part.column(c).to_numpy().astype(float) for c in ("size_a", "size_b")))
                keep = pa.array(j >= threshold / 100 - SLACK)
                yield pa.RecordBatch.from_arrays([part.column(c).filter(keep) for c in "ab"], names=["a", "b"])

    return both.select("a", "b", "registers_a", "registers_b", "size_a", "size_b").mapInArrow(run, "a long, b long")


def _filter_words(wanted: DataFrame) -> np.ndarray:
    """A filter over classes: bit ``class % 2**FILTER_BITS`` is set for each wanted class. Its size is fixed."""
    places = wanted.select(F.col("class").bitwiseAND((1 << FILTER_BITS) - 1).alias("place"))
    bits = F.expr("bit_or(shiftleft(1L, cast(place & 63 AS int)))").alias("bits")
    words = places.groupBy(F.expr("shiftright(place, 6)").alias("word")).agg(bits).toArrow()
    found = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    found[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return found.view(np.uint64)


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """class, shingles (sorted hashes) of the wanted classes, from one scan of the texts."""
    words = _filter_words(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text", SLICE):
                values, begin = text.distinct_runs(*text.shingles(part.column("text"), WORDS))
                own = text.span_hashes(values, begin[:-1], begin[1:])
                place = own & np.uint64((1 << FILTER_BITS) - 1)
                hit = pa.array((words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1)
                out = [part.column("doc_id").cast(pa.int64()), pa.array(own.view(np.int64)), text.blobs(values, begin)]
                yield pa.RecordBatch.from_arrays([c.filter(hit) for c in out], names=["id", "class", "shingles"])

    found = docs.select("doc_id", "text").mapInArrow(run, "id long, class long, shingles binary")
    named = classes.join(wanted.select("class"), "class", "left_semi").select("class", "doc_id")
    same = F.col("id").eqNullSafe(F.col("doc_id"))  # one document of each class, others are exact copies
    found = found.join(named, "class").where(same).select("class", "shingles")
    return stored(found.dropDuplicates(["class"]), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    side = lambda x: sets.select(F.col("class").alias(x), F.col("shingles").alias(f"shingles_{x}"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= threshold * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in "ab"], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(check, "a long, b long")


def _prefixes(sets: DataFrame, threshold: int) -> DataFrame:
    """bucket, class, n, place: the shingles of each set that a similar set must share one of, and their places.

    Under any common order of shingles, two sets with the threshold's similarity share one among the first
    n - ceil(threshold * n) + 1 of each. The order here is by frequency, rarest first, counted in hash cells.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            for value in batch.column("shingles"):
                cells += np.bincount((np.frombuffer(value.as_buffer(), np.uint64) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(cells[at])], names=["cell", "n"])

    counted = sets.select("shingles").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(CELLS, np.int64)  # one number for each cell, whatever the input
    often[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, full = [np.zeros(0, np.uint64)], [], []
            for value in batch.column("shingles"):
                own = np.frombuffer(value.as_buffer(), np.uint64)
                size = len(own) - (threshold * len(own) + 99) // 100 + 1
                keys.append(own[np.lexsort((own, often[(own % np.uint64(CELLS)).astype(np.int64)]))[:size]])
                sizes.append(size)
                full.append(len(own))
            sizes, full = np.array(sizes, np.int64), np.array(full, np.int64)
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            columns = (np.concatenate(keys).view(np.int64), np.repeat(batch.column("class").to_numpy(), sizes), np.repeat(full, sizes), place)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "class", "n", "place"])

    return sets.mapInArrow(run, "bucket long, class long, n long, place long")


def _stars(buckets: DataFrame) -> DataFrame:
    """Each class paired with one member of each of its buckets: the one that meets most others in its buckets."""
    mass = buckets.groupBy("class").agg(F.sum("members").alias("mass"))
    ranked = buckets.join(mass, "class")
    centre = ranked.groupBy("bucket").agg(F.max(F.struct("mass", "class")).alias("top"))
    pairs = buckets.select("bucket", "class").join(centre.select("bucket", F.col("top.class").alias("centre")), "bucket")
    return _ordered(pairs.where("class != centre"), "class", "centre")


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _placed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component, with the component of their class."""
    placed = buckets.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(mixed.where("low != high").select("bucket"), "bucket")


def _crossing(placed: DataFrame, threshold: int) -> DataFrame:
    """Pairs of classes of different components that share a prefix shingle and may be similar.

    If a shingle at places i and j of sets of n and m shingles is the first one they share, they share at
    most min(n - i, m - j), and need (n + m) * threshold / (100 + threshold). ``reach`` is what that leaves for
    the other set's size; a component is first tried as a whole by its greatest reach and least size.
    """
    reach = 100 * F.col("n") - (100 + threshold) * F.col("place")
    placed = placed.select("bucket", "class", "component", "n", reach.alias("reach"))
    others = placed.groupBy("bucket", F.col("component").alias("other")).agg(F.max("reach").alias("far"), F.min("n").alias("least"))
    fits = (F.col("component") < F.col("other")) & (F.col("far") >= threshold * F.col("n")) & (F.col("reach") >= threshold * F.col("least"))
    left = placed.join(others, "bucket").where(fits)
    left = left.select("bucket", "other", F.col("class").alias("x"), F.col("n").alias("n_x"), F.col("reach").alias("reach_x"))
    right = placed.select("bucket", F.col("component").alias("other"), F.col("class").alias("y"), "n", "reach")
    fits = (F.col("reach") >= threshold * F.col("n_x")) & (F.col("reach_x") >= threshold * F.col("n"))
    fits &= 100 * F.least("n", "n_x") >= threshold * F.greatest("n", "n_x")
    return _ordered(left.join(right, ["bucket", "other"]).where(fits), "x", "y")


def components(edges: DataFrame) -> DataFrame:
    """class, component of each end of an edge; the component is its smallest class.

    Large-star and small-star steps alternate until every class points to its component's smallest one;
    the number of steps grows with the logarithm of the longest path. Each step is written out.
    """
    edges = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        large = stored(large.where("u != v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    tips = edges.select(F.col("u").alias("class"), F.col("v").alias("component"))
    return tips.unionByName(tips.select(F.col("component").alias("class"), "component").distinct())


def links(docs: DataFrame, rows: DataFrame, threshold: int = 75) -> tuple[DataFrame, DataFrame]:
    """Verified links between classes of equal sets, and the component of each linked class.

    ``rows`` are the stored ``sketches(docs)``. Links inside a component that is already joined by others
    are not all listed.
    """
    some = rows.where("n_shingles > 0")
    classes = some.groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("registers").alias("registers")
    )
    classes = stored(classes, "classes")
    buckets = stored(_buckets(classes), "buckets")
    tried = stored(_promising(_stars(buckets), classes, threshold), "stars")
    ends = tried.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    found = stored(_verified(tried, _sets(docs, classes, ends), threshold), "links")
    labels = stored(components(found), "labels")
    left = stored(_placed(buckets.select("bucket", "class"), labels).select("class").distinct(), "left")
    prefixes = stored(_prefixes(_sets(docs, classes, left), threshold), "prefixes")
    placed = stored(_placed(prefixes, labels), "placed")
    rest = _crossing(placed, threshold).join(tried, ["a", "b"], "left_anti")
    rest = stored(_promising(rest, classes, threshold), "crossing")
    ends = stored(rest.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "ends")
    if not ends.isEmpty():
        found = stored(found.unionByName(_verified(rest, _sets(docs, classes, ends), threshold)), "all_links")
        labels = components(found)
    return found, labels


def near_duplicates(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept, class, n_links of the class.

    Two documents are linked if 100 * |A and B| >= threshold * |A or B| for their shingle sets.
    """
    rows = stored(sketches(docs), "sketches")
    found, labels = links(docs, rows, threshold)
    placed = rows.select("doc_id", "n_shingles", "class").join(labels, "class", "left")
    placed = placed.withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "class")))
    least = placed.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    ends = found.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("n_links"))
    out = placed.join(least, "component", "left").join(ends, "class", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.col("class").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
