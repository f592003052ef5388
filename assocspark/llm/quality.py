"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Every passage is encoded: its surface (word shapes, kinds of
characters, repetition) goes through a hidden layer. Gated attention weighs the passages, and the weighted sum of
their codes is scored. Only the label of the whole document is learned from, by gradient descent (Adam) on a
bounded sample of SAMPLE labelled documents, chosen by a hash of the id so that it is the same every time.

Defined cases: a NULL, empty or blank text is one passage without words and is scored. Labels that are NULL or not
0 or 1, or without an id, teach nothing; of labels that repeat an id the greatest holds. Without any usable label every score
is 0.5. Repeated rows get equal scores. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocspark.llm import text

PASSAGE = 64
SHAPES = 64
SAMPLE = 5_000
HIDDEN = 32
GATE = 16
_LOWER, _UPPER, _DIGIT, _BLANK = 1, 2, 3, 4
_KIND = np.array(
    [_LOWER if 97 <= b <= 122 or b >= 128 else _UPPER if 65 <= b <= 90 else _DIGIT if 48 <= b <= 57 else _BLANK if b <= 32 else b for b in range(256)],
    np.uint64,
)
WIDTH = SHAPES + 9


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Surface of each passage (rows of WIDTH numbers), and the first passage of each document (and the end)."""
    data, at = text.bytes_of(column)
    starts, ends, doc = text.word_spans(data, at)
    first_word = np.searchsorted(doc, np.arange(len(at)))
    count = np.diff(first_word)
    per = np.maximum(-(-count // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(per)])
    own = first[doc] + (np.arange(len(doc)) - first_word[doc]) // PASSAGE
    out = np.zeros((first[-1], WIDTH))
    if not len(starts):
        return out, first
    kind = _KIND[data]
    turn = np.ones(len(data), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[starts] = True
    before = np.concatenate([[0], np.cumsum(turn)])
    shape = text.span_hashes(kind[turn], before[starts], before[ends], text.BASES[1]) >> np.uint64(58)
    words = np.bincount(own, minlength=len(out)).astype(float)
    some = np.maximum(words, 1.0)
    cells = np.bincount(own * SHAPES + shape.astype(np.int64), minlength=len(out) * SHAPES)
    out[:, :SHAPES] = np.sqrt(cells.reshape(-1, SHAPES) / some[:, None])
    length = ends - starts
    chars = np.maximum(np.bincount(own, length, minlength=len(out)), 1.0)

    def share(which):
        sums = np.concatenate([[0], np.cumsum(which)])
        return np.bincount(own, sums[ends] - sums[starts], minlength=len(out)) / chars

    out[:, SHAPES] = share(kind == _UPPER)
    out[:, SHAPES + 1] = share(kind == _DIGIT)
    out[:, SHAPES + 2] = share(kind > 32)
    out[:, SHAPES + 3] = np.log1p(words) / 4
    out[:, SHAPES + 4] = np.log1p(chars / some) / 2
    hashes = text.byte_spans(text.lowered(data), starts, ends)
    again = np.zeros(len(own), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
    out[:, SHAPES + 5] = np.bincount(own, again, minlength=len(out)) / some
    order = np.lexsort((hashes, own))
    new = np.ones(len(own), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (own[order][1:] != own[order][:-1])
    out[:, SHAPES + 6] = np.bincount(own[order][new], minlength=len(out)) / some
    runs = np.diff(np.append(np.flatnonzero(new), len(own)))
    most = np.zeros(len(out))
    np.maximum.at(most, own[order][new], runs)
    out[:, SHAPES + 7] = most / some
    out[:, SHAPES + 8] = words == 0
    return out, first


def _sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first[:-1], axis=0)


@dataclass
class Model:
    """Encoder (w, b), gates (v, u, g), and the score of a weighted code (c, d)."""

    parts: dict[str, np.ndarray]
    mean: np.ndarray
    spread: np.ndarray

    def run(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, x = self.parts, (x - self.mean) / self.spread
        h = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-h @ p["u"]))
        e = (t * s) @ p["g"]
        per = np.diff(first)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first[:-1]), per))
        a = e / np.repeat(_sum(e, first), per)
        z = _sum(a[:, None] * h, first)
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "y": 1 / (1 + np.exp(-(z @ p["c"] + p["d"])))}

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.run(x, first)["y"]

    def slopes(self, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss."""
        p, f, per = self.parts, self.run(x, first), np.diff(first)
        dy = (f["y"] - label) / len(label)
        dz = np.repeat(dy[:, None] * p["c"], per, axis=0)
        da = (dz * f["h"]).sum(1)
        de = f["a"] * (da - np.repeat(_sum(f["a"] * da, first), per))
        dts = de[:, None] * p["g"]
        dt, ds = dts * f["s"] * (1 - f["t"] ** 2), dts * f["t"] * f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dz + dt @ p["v"].T + ds @ p["u"].T) * (1 - f["h"] ** 2)
        return {
            "w": f["x"].T @ dh, "b": dh.sum(0), "v": f["h"].T @ dt, "u": f["h"].T @ ds,
            "g": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ dy, "d": dy.sum(),
        }


def fit(bags: list[np.ndarray], label: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.004, decay: float = 1e-4) -> Model:
    rng = np.random.default_rng(3)
    every = np.concatenate(bags)
    scale = lambda *shape: rng.normal(size=shape) / np.sqrt(shape[0])
    parts = {"w": scale(WIDTH, HIDDEN), "b": np.zeros(HIDDEN), "v": scale(HIDDEN, GATE), "u": scale(HIDDEN, GATE)}
    parts |= {"g": scale(GATE), "c": scale(HIDDEN), "d": np.array(np.log((label.sum() + 1) / (len(label) - label.sum() + 1)))}
    model = Model(parts, every.mean(0), every.std(0) + 0.05)
    first, second = ({k: np.zeros_like(v) for k, v in parts.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for k in range(0, len(order), batch):
            own = order[k : k + batch]
            edge = np.concatenate([[0], np.cumsum([len(bags[i]) for i in own])])
            slope = model.slopes(np.concatenate([bags[i] for i in own]), edge, label[own])
            step += 1
            now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for name, g in slope.items():
                g = g + decay * parts[name]
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                parts[name] = parts[name] - now * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on a bounded sample of the labels (doc_id, quality) and their documents; None without usable labels."""
    usable = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # the sample is bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text", 2 << 20):
                x, first = passages(part.column("text"))
                columns = [part.column("doc_id"), part.column("quality").cast(pa.int32())]
                columns.append(text.blobs(x.astype(np.float32).ravel(), first * WIDTH))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "bag"])

    got = rows.mapInArrow(run, "doc_id long, quality int, bag binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["doc_id"], bytes(r["bag"])))
    bags = [np.frombuffer(bytes(r["bag"]), np.float32).reshape(-1, WIDTH).astype(float) for r in got]
    return fit(bags, np.array([float(r["quality"]) for r in got]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text", 2 << 20):
                found = np.full(part.num_rows, 0.5) if model is None else model.scores(*passages(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
