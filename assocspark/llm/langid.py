"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, all that is not a letter becomes one kind of gap, and runs of one to three
characters are counted in hash buckets. Document frequencies are counted over all training documents. The
weights are fitted by follow-the-regularised-leader with L1 and L2 penalties on a bounded sample of
``per_language`` labelled documents for each language (lowest hashes of the id, so the same rows
every time); a quarter of the sample is kept apart to fit the temperature of the probabilities.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0; so is every text if nothing
could be learned (no labelled rows). Rows without language or id teach nothing. Repeated rows get equal
results. Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assocspark.llm import text
from assocspark.llm.store import stored

BUCKETS = 1 << 16
ORDERS = 3
PER_LANGUAGE = 400
SLICE = 1 << 18  # bytes of texts counted at a time; the arrays of a slice take about 50 times as much
UNKNOWN = "und"
_GAP, _EDGE = 32, 0
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(1 << 16)]))
    return _letters[0]


def _characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, non-letters as gaps, an edge after each text; where each begins."""
    texts = [(t or "").lower() for t in column.to_pylist()]
    points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le"), np.uint32).copy()
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    letter = _letter_table()[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    letter[high] = [chr(c).isalpha() for c in points[high].tolist()]
    points[~letter] = _GAP
    points[begin[1:] - 1] = _EDGE
    return points, begin


def counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its n-gram buckets, sorted, and how often each occurs."""
    points, begin = _characters(column)
    n = len(points)
    wide = points.astype(np.uint64)
    edge, gap = points == _EDGE, points == _GAP
    keys, rows, hash_ = [], [], np.zeros(n, np.uint64)
    barred, last = np.zeros(n, bool), np.ones(n, bool)
    for order in range(ORDERS):
        size = max(n - order, 0)
        hash_ = hash_[:size] * np.uint64(0x100000001B3) + wide[order:] + np.uint64(1)
        barred = barred[:size] | edge[order:]
        last = last[:size] & gap[order:]
        at = np.flatnonzero(~(barred | last))
        keys.append((text.mixed(hash_[at]) >> np.uint64(48)).astype(np.int64))
        rows.append(np.searchsorted(at, begin))
    for k in range(len(begin) - 1):
        own = np.concatenate([key[row[k] : row[k + 1]] for key, row in zip(keys, rows, strict=True)])
        count = np.bincount(own, minlength=BUCKETS) if len(own) else np.zeros(BUCKETS, np.int64)
        found = np.flatnonzero(count)
        yield found, count[found]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages
    idf: np.ndarray
    temperature: float

    def features(self, found: np.ndarray, count: np.ndarray) -> np.ndarray:
        value = (1.0 + np.log(count)) * self.idf[found]
        return value / np.sqrt((value * value).sum())

    def probabilities(self, found: np.ndarray, count: np.ndarray) -> np.ndarray:
        z = self.features(found, count) @ self.weights[found] / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()


def _idf(docs: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for part in text.slices(batch, "text", SLICE):
                for found, _ in counts(part.column("text")):
                    seen[found] += 1
                    n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(seen[at], n))], names=["bucket", "n"]
        )

    rows = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r["bucket"]: r["n"] for r in rows.collect()}  # one row for each bucket at most
    total = found.pop(-1, 0)
    seen = np.zeros(BUCKETS)
    seen[list(found)] = list(found.values())
    return np.log((1.0 + total) / (1.0 + seen)) + 1.0


def _sample(docs: DataFrame, per_language: int) -> list:
    """Language, whether to calibrate, buckets and counts of the sampled training documents.

    Of each language, the ids of the lowest hashes. The share of hashes that can be among them follows from the number of
    ids of the language, so a task ranks a few times ``per_language`` ids, however many partitions there are. An id that
    repeats within a language counts once, with its least text.
    """
    ids = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang").distinct()
    ids = stored(ids.withColumn("place", F.xxhash64("doc_id")), "ids")
    sizes = ids.groupBy("lang").agg(F.count("*").alias("n"))  # one row for each language, as in the model
    limit = F.least(F.lit(1.0), 4.0 * per_language / F.col("n")) * 2.0**64 - 2.0**63
    near = ids.join(F.broadcast(sizes), "lang").where(F.col("place").cast("double") <= limit)
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
    chosen = [(r["doc_id"], r["lang"], r["rank"] % 4 == 0) for r in ranked.collect()]  # per_language for each language at most
    if not chosen:
        return []
    picked = docs.sparkSession.createDataFrame(chosen, "doc_id long, lang string, calibrate boolean")
    rows = docs.where("text IS NOT NULL").join(F.broadcast(picked), ["doc_id", "lang"])
    rows = rows.groupBy("doc_id", "lang", "calibrate").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text", SLICE):
                pairs = list(counts(part.column("text")))
                begin = np.concatenate([[0], np.cumsum([len(f) for f, _ in pairs])]).astype(int)
                flat = [np.concatenate([p[k] for p in pairs]).astype(np.int32) for k in (0, 1)]
                own = [part.column(c) for c in ("doc_id", "lang", "calibrate")]
                yield pa.RecordBatch.from_arrays(
                    [*own, *(text.blobs(x, begin) for x in flat)], names=["doc_id", "lang", "calibrate", "found", "n"]
                )

    got = rows.mapInArrow(run, "doc_id long, lang string, calibrate boolean, found binary, n binary").collect()
    read = lambda b: np.frombuffer(bytes(b), np.int32)
    got = sorted(((r["lang"], r["calibrate"], read(r["found"]), read(r["n"]), r["doc_id"]) for r in got), key=lambda r: (r[4], r[0]))
    return [r[:4] for r in got if len(r[2])]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, epochs: int = 5, alpha: float = 1.0, l1: float = 0.01, l2: float = 0.01) -> Model | None:
    """Fit on the rows of ``docs`` (doc_id, text, lang) that have a language; None if there are none."""
    labelled = docs.where("lang IS NOT NULL").select("doc_id", "text", "lang")
    sample = _sample(labelled, per_language)
    if not sample:
        return None
    names = sorted({lang for lang, *_ in sample})
    model = Model(names, np.zeros((BUCKETS, len(names))), _idf(labelled.where("text IS NOT NULL")), 1.0)
    fit = [(names.index(lang), f, model.features(f, n)) for lang, held, f, n in sample if not held]
    z, squares = np.zeros_like(model.weights), np.zeros_like(model.weights)

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0.0)
        return -shrunk / ((1.0 + np.sqrt(squares[at])) / alpha + l2)

    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for k in rng.permutation(len(fit)):
            label, at, value = fit[k]
            w = weights(at)
            score = value @ w
            p = np.exp(score - score.max())
            p /= p.sum()
            p[label] -= 1.0
            slope = value[:, None] * p
            step = (np.sqrt(squares[at] + slope * slope) - np.sqrt(squares[at])) / alpha
            z[at] += slope - step * w
            squares[at] += slope * slope
    model.weights[:] = weights(slice(None))
    held = [(names.index(lang), model.features(f, n) @ model.weights[f]) for lang, held, f, n in sample if held]

    def loss(t):
        return sum(np.log(np.exp((s - s.max()) / t).sum()) - (s[y] - s.max()) / t for y, s in held)

    best = min(np.exp(np.linspace(-2.5, 2.5, 101)), key=loss) if held else 1.0
    return Model(names, model.weights.astype(np.float32), model.idf.astype(np.float32), float(best))


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of the documents, with lang_pred and score."""
    kept = docs.select(*keep, *([] if "text" in keep else ["text"]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text", SLICE):
                names, scores = [], []
                for found, count in counts(part.column("text")):
                    p = model.probabilities(found, count) if model and len(found) else None
                    names.append(UNKNOWN if p is None else model.languages[int(p.argmax())])
                    scores.append(0.0 if p is None else float(p.max()))
                columns = [*(part.column(c) for c in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, keep: list[str], fold: tuple[int, int] = (3, 1)) -> DataFrame:
    """Train on the documents outside one fold of the ids, predict all."""
    return predict(docs, train(docs.where(text.fold("doc_id", fold[0]) != fold[1])), keep)
