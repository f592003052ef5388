"""Personal data spans: pattern matches, and further spans chosen by boosted trees.

Base spans are the leftmost, non-overlapping matches of four patterns with their checks; they always stay. High-recall
generators propose more spans, which may overlap: numbers with any separators, also without a leading plus, and
addresses that are written out ("name (at) host (dot) org"). Boosted trees judge a proposal by its format and its
context. They learn from base spans, from the same spans written in other ways (positive), and from proposals in the
corpus and altered numbers that are refuted (negative: failed Luhn sums, parts above 255, dates, bare numbers and groups of no
phone number without a word that names one), on a bounded sample of SAMPLE documents. A proposal that is neither a
base span nor refuted teaches nothing. A calibration part of the sample gives each kind its threshold: the least one at
which PRECISION holds. Of overlapping spans that pass, the likeliest stays, and none that overlaps a base span.

Defined cases: NULL and empty texts have no spans; repeated rows give equal rows; NULL ids stay NULL; where
nothing can be learned only base spans are returned. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocspark.llm import text, trees
from assocspark.llm.store import sampled

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 3_000
PRECISION = 0.98
# fixed values: the base patterns
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")  # the same matches in linear time
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# generators
_AT = r"(?: ?[(\[{] ?at ?[)\]}] ?| at |@)"
_DOT = r"(?: ?[(\[{] ?dot ?[)\]}] ?| dot |\.)"
_WRITTEN = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++", re.I)
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[ ().\-/]{0,2}[0-9])*+(?![0-9A-Za-z])")
_ANY = re.compile(r"[0-9@]|[(\[{] ?at ?[)\]}]| at ", re.I)
_CUES = {
    "email": ("mail", "email", "e-mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "address", "ping", "addr"),
    "card": ("card", "visa", "credit", "mastercard", "payment", "pay"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "cell"),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(value: str) -> list[tuple[str, int, int]]:
    """kind, start, end of the base matches, by start and then kind."""
    found, done, at = [], 0, value.find("@")
    while at >= 0:  # the mark is in no local part, so a match starts where the run before its mark does
        start = at
        while start > done and _LOCAL.match(value, start - 1):
            start -= 1
        match = _DOMAIN.match(value, at) if start < at else None
        if match:
            found.append(("email", start, match.end()))
            done = match.end()
        at = value.find("@", max(at + 1, done))
    for m in _IP.finditer(value):
        if all(map(_small, m[0].split("."))):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(value):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(value):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def proposals(value: str) -> list[tuple[str, int, int]]:
    """Spans that may be personal data, overlapping; base spans are among them or not."""
    found = [("email", m.start(), m.end()) for m in _WRITTEN.finditer(value)]
    for m in _NUMBER.finditer(value):
        n = len(_digits(m[0]))
        if 7 <= n <= 15:
            found.append(("phone", m.start(), m.end()))
        if 12 <= n <= 19:
            found.append(("card", m.start(), m.end()))
        if m[0].count(".") == 3 and n <= 12:
            found.append(("ip", m.start(), m.end()))
    return found


def features(kind: str, span: str, before: str, after: str) -> list[float]:
    """Format of a span and its context of up to 40 characters on each side."""
    digits = _digits(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    letters = sum(c.isalpha() for c in span)
    words = re.findall(r"[A-Za-z-]+", before.lower())[-4:]
    low = span.lower()
    return [
        *(float(kind == k) for k in KINDS),
        len(span), len(digits), letters, len(groups), groups[0], groups[-1], max(groups), min(groups), len(set(digits)),
        span.count("."), span.count("-"), span.count(" "), span.count("("), span.count("/"), float("@" in span), float(" at " in low),
        float("(at)" in low or "[at]" in low), low.count("dot"), float(luhn(digits) and len(digits) >= 12),
        float(all(_small(g) for g in re.findall(r"[0-9]+", span))), len(low.rsplit(".", 1)[-1]) if "." in low else 0,
        float(len(groups) >= 3 and groups[-3:] == [3, 3, 4]), float(groups == [4, 4, 4, 4]), float(len(groups) == 3 and groups[0] == 4 and groups[1] <= 2),
        float(before[-1:].isspace() or not before), float(after[:1].isspace() or not after), float(before[-1:].isalpha()), float(after[:1].isalpha()),
        float(any(w in _CUES[kind] for w in words)), sum(c.isdigit() for c in before[-20:]), sum(c.isdigit() for c in after[:20]),
    ]


def _altered(kind: str, span: str, seed: int) -> list[tuple[str, float]]:
    """Other ways to write a base span, and spans like it that are none, with their labels."""
    rng, digits = np.random.default_rng(seed), _digits(span)
    out = [(span, 1.0)]
    if kind == "email":
        out += [(span.replace("@", a).replace(".", d), 1.0) for a, d in ((" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "))]
        out += [(span.replace("@", " at ").split(".")[0] + ".", 0.0)]
    elif kind == "phone":
        local = digits[-10:]
        out += [(f"({local[:3]}) {local[3:6]}-{local[6:]}", 1.0), (f"{local[:3]}-{local[3:6]}-{local[6:]}", 1.0), (f"{local[:3]}.{local[3:6]}.{local[6:]}", 1.0)]
        out += [(digits, 0.0), (f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", 0.0), (f"{digits[:5]}.{digits[5:]}", 0.0), (digits[:7], 0.0)]
        out += [(f"{digits[:2]}/{digits[2:4]}/{digits[4:8]}", 0.0)]
    elif kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + int(rng.integers(8))) % 10)
        out += [(" ".join(digits[i : i + 4] for i in range(0, len(digits), 4)), 1.0)]
        out += [(wrong, 0.0), (" ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), 0.0), (digits[:12], 0.0)]
    else:
        out += [(span.replace(".", ".9", 1).replace(".9", ".999", 1), 0.0), (".".join(digits[:4]), 0.0)]
    return [(s, y if kind != "card" or y == 0 or luhn(_digits(s)) else 0.0) for s, y in out]


@dataclass
class Model:
    judge: trees.Boosted
    thresholds: dict[str, float]


def _meets(spans: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether any of the spans, sorted by start, overlaps a..b; each kind of span is disjoint, so few need a look."""
    k = bisect_left(spans, (b,))
    return any(e > a for _, e in spans[max(k - len(KINDS), 0) : k])


def _refuted(kind: str, span: str, before: str) -> bool:
    """Whether a proposal cannot be what it was proposed as, or nothing speaks for it."""
    digits, groups = _digits(span), [len(g) for g in re.findall("[0-9]+", span)]
    if kind == "card":
        return not luhn(digits) or not 14 <= len(digits) <= 19
    if kind == "ip":
        return not all(map(_small, span.split(".")))
    if kind == "email":
        return False
    if groups in ([4, 2, 2], [2, 2, 4]):
        return True
    cue = any(w in _CUES[kind] for w in re.findall("[A-Za-z-]+", before.lower())[-4:])
    shaped = len(groups) >= 3 and all(2 <= g <= 4 for g in groups[1:]) and 10 <= len(digits) <= 13
    return not cue and not shaped


def _examples(value: str) -> tuple[list[list[float]], list[float]]:
    base = base_spans(value)
    x, y = [], []
    for k, (kind, a, b) in enumerate(base):
        for span, label in _altered(kind, value[a:b], len(value) * 31 + k):
            x.append(features(kind, span, value[max(a - 40, 0) : a], value[b : b + 40]))
            y.append(label)
    starts = sorted((s, e) for _, s, e in base)
    for kind, a, b in proposals(value):
        if not _meets(starts, a, b) and _refuted(kind, value[a:b], value[max(a - 40, 0) : a]):
            x.append(features(kind, value[a:b], value[max(a - 40, 0) : a], value[b : b + 40]))
            y.append(0.0)
    return x, y


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on a bounded sample of the documents that have digits or address marks; None if they show too little."""
    rows = sampled(docs, sample, "[0-9@]")
    rows = rows.select("text", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("held"))  # for calibration

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("held", pa.bool_()), ("x", pa.list_(pa.float64())), ("y", pa.float64())])
        for batch in batches:
            out = []
            for value, held in zip(batch.column("text").to_pylist(), batch.column("held").to_pylist(), strict=True):
                x, y = _examples(value)
                out += [{"held": held, "x": a, "y": b} for a, b in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    got = rows.mapInArrow(run, "held boolean, x array<double>, y double").toArrow()
    y = got.column("y").to_numpy()
    if len(y) < 40 or y.min() == y.max():
        return None
    x, held = np.array(got.column("x").to_pylist()), got.column("held").to_numpy()
    order = np.lexsort((y, *x.T[::-1]))
    x, y, held = x[order], y[order], held[order]
    if not 0 < y[~held].sum() < len(y[~held]):
        return None
    judge = trees.boost(x[~held], y[~held])
    score, thresholds = judge.probability(x[held]), {}
    for k, kind in enumerate(KINDS):
        own = x[held][:, k] == 1
        s, label = score[own], y[held][own]
        for cut in (0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99):
            if label[s >= cut].sum() >= 5 and label[s >= cut].mean() >= PRECISION:
                thresholds[kind] = cut
                break
    return Model(judge, thresholds)


def added(value: str, base: list[tuple[str, int, int]], model: Model | None) -> list[tuple[str, int, int]]:
    """The spans that the trees add to the base spans."""
    if model is None:
        return []
    starts = sorted((s, e) for _, s, e in base)
    spans = [p for p in proposals(value) if p[0] in model.thresholds and not _meets(starts, p[1], p[2])]
    if not spans:
        return []
    x = [features(k, value[a:b], value[max(a - 40, 0) : a], value[b : b + 40]) for k, a, b in spans]
    score = model.judge.probability(np.array(x))
    out: list[tuple[int, int, str]] = []  # sorted and apart
    for i in np.argsort(-score, kind="stable"):
        kind, a, b = spans[i]
        k = bisect_left(out, (b,))
        if score[i] >= model.thresholds[kind] and (not k or out[k - 1][1] <= a):
            out.insert(k, (a, b, kind))
    return [(kind, a, b) for a, b, kind in out]


def shown(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def redacted(value: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if a >= at:
            out += [value[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + value[at:]


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, base counts by kind, base_sha256, spans (base and added), n_added and the redacted text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch, "text"):
                out: dict[str, list] = {c: [] for c in (*KINDS, "base_sha256", "spans", "n_added", "redacted")}
                for value in part.column("text").to_pylist():
                    base = base_spans(value) if value and _ANY.search(value) else []
                    more = added(value, base, model) if value and _ANY.search(value) else []
                    for kind in KINDS:
                        out[kind].append(sum(s[0] == kind for s in base))
                    out["base_sha256"].append(hashlib.sha256(shown(base).encode()).hexdigest())
                    out["spans"].append(shown(base + more))
                    out["n_added"].append(len(more))
                    out["redacted"].append(value and redacted(value, base + more))
                columns = [pa.array(v, pa.int64() if k in KINDS or k == "n_added" else pa.string()) for k, v in out.items()]
                names = [f"n_{k}" if k in KINDS else k for k in out]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long, redacted string")
