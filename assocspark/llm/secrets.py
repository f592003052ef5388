"""Secret scans: pattern findings, of which a random forest removes the false ones.

Patterns find values assigned to secret-like names, values of known forms, and long mixed strings on their own. The forest judges
a finding by its length, its character transitions (changes of kind, and how likely its letters follow each other in
the words of the corpus), how much of it dictionary words cover, whether it looks like a path, and the words around
it; the pattern that found it is no feature. It is trained from labelled findings. Where no labels are given they are made by
``labelled`` from a bounded sample of documents. True are keys of known form, long values with letters and digits
that are assigned to a secret-like name, and random keys with and without such a name. False are digests and ids named as such, and paths,
identifiers and placeholders, also where they are assigned to a secret-like name. All other findings teach nothing. A long
hexadecimal value assigned to a secret-like name counts as a key, after ``commit`` or ``sha1`` as a digest.
The dictionary is the DICTIONARY commonest words of all documents, the letter pairs are those of all their words.

Defined cases: NULL and empty texts have no findings; repeated rows give equal findings; NULL ids stay NULL. Without two
kinds of labels nothing is removed (score 1). Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocspark.llm import text, trees
from assocspark.llm.store import sampled

SAMPLE = 2_000
DICTIONARY = 2_000
HELD = 200_000  # words that a task counts before it passes them on
KEEP = 0.5
# fixed values: names that secrets are assigned to, forms of known keys, and words near strings that are none
NAMES = "token|secret|passwd|password|pwd|api_?key|apikey|access_?key|private_?key|auth|credential"
RULES = {
    "assigned": re.compile(rf"(?i)(?<![A-Za-z])(?:{NAMES})[\"']? ?(?:=|:|=>) ?[\"']?(?P<value>[A-Za-z0-9+/_.~-]{{8,}}+)"),
    "known_form": re.compile(r"(?<![A-Za-z0-9])(?P<value>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{10,}+|sk-[A-Za-z0-9]{20,}+|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_.-]{10,}+)"),
    "mixed": re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])(?P<value>[A-Za-z0-9+/_-]{20,}+)"),
}
_HINT = re.compile(rf"(?i)[A-Za-z0-9+/_-]{{20}}|{NAMES}|akia|gh[pousr]_|xox|sk-|eyj")
_HARMLESS = ("sha", "sha1", "sha256", "md5", "hash", "digest", "commit", "checksum", "uuid", "id", "example", "file", "path", "url", "version")
_NAMED = re.compile(r"(?i)(?:sha-?[0-9]*|md5|commit|checksum|digest|hash|uuid|revision|etag)[\"']? ?[:=]? ?[\"']?$")
_UUID = re.compile("[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_PATH = re.compile(r"\.{0,2}/?(?:[A-Za-z][A-Za-z0-9_.-]*/){2,}[A-Za-z][A-Za-z0-9_.-]*")
_IDENTIFIER = re.compile(r"[A-Za-z][a-z]++(?:[._]?[A-Z]?[a-z]++)*+")
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_SECRET = re.compile(rf"(?i)(?:{NAMES})")


def findings(value: str) -> list[tuple[str, int, int]]:
    """rule, start, end of the values found; one finding for a place, by the first rule that has it."""
    found: list[tuple[int, int, str]] = []  # sorted and apart, as are the matches of one rule
    if _HINT.search(value):
        for rule, pattern in RULES.items():
            spans = [m.span("value") for m in pattern.finditer(value)]
            places = [bisect_left(found, (b,)) for _, b in spans]
            free = [s for s, k in zip(spans, places, strict=True) if not k or found[k - 1][1] <= s[0]]
            found = sorted(found + [(a, b, rule) for a, b in free])
    return sorted((rule, a, b) for a, b, rule in found)


def _counted(words: Counter, pairs: np.ndarray) -> pa.RecordBatch:
    """Rows of the words and their counts; their letter pairs are added to ``pairs``."""
    listed = list(words)
    n = np.fromiter((words[w] for w in listed), np.int64, len(listed))
    letters = np.frombuffer(" ".join(["", *listed, ""]).encode(), np.uint8).astype(np.int64) % 32  # a-z: 1 to 26, between words 0
    first, second = letters[:-1], letters[1:]
    owner = np.minimum(np.cumsum(first == 0) - 1, len(n) - 1)
    if len(n):
        pairs += np.bincount(first * 27 + second, weights=n[owner], minlength=27 * 27).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array([False] * len(n), pa.bool_()), pa.array(listed, pa.string()), pa.array(n)], names=["pair", "word", "n"])


@dataclass
class Lexicon:
    words: frozenset
    letters: np.ndarray  # log probabilities of letter pairs

    @staticmethod
    def of(docs: DataFrame) -> Lexicon:
        """Words of three or more letters a-z, after lower-casing, counted over all documents."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pairs = np.zeros(27 * 27, np.int64)
            words: Counter = Counter()
            for batch in batches:
                for value in batch.column("text").to_pylist():
                    words.update(re.findall("[a-z]{3,}", value.lower()))
                if len(words) > HELD:
                    yield _counted(words, pairs)
                    words.clear()
            yield _counted(words, pairs)
            shown = [f"{k // 27} {k % 27}" for k in range(len(pairs))]
            yield pa.RecordBatch.from_arrays([pa.array([True] * len(pairs)), pa.array(shown), pa.array(pairs)], names=["pair", "word", "n"])

        counts = docs.where("text IS NOT NULL").select("text").mapInArrow(run, "pair boolean, word string, n long")
        counts = counts.groupBy("pair", "word").agg(F.sum("n").alias("n"))
        first = counts.orderBy(F.desc("pair"), F.desc("n"), "word").limit(27 * 27 + DICTIONARY).collect()
        table = np.ones((27, 27))
        for r in first:
            if r["pair"]:
                table[tuple(map(int, r["word"].split()))] += r["n"]
        chosen = frozenset(r["word"] for r in first if not r["pair"])
        return Lexicon(chosen, np.log(table / table.sum(1, keepdims=True)))

    def coverage(self, value: str) -> float:
        """Share of the characters that dictionary words cover, longest words first from the left."""
        low, at, hit = value.lower(), 0, 0
        while at < len(low):
            size = next((n for n in range(min(12, len(low) - at), 2, -1) if low[at : at + n] in self.words), 0)
            hit += size
            at += size or 1
        return hit / max(len(low), 1)

    def fluency(self, value: str) -> float:
        path = [0, *(ord(c) - 96 if "a" <= c <= "z" else 0 for c in value.lower()), 0]
        return float(self.letters[path[:-1], path[1:]].mean())


def _kind(c: str) -> int:
    return 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3


def features(value: str, before: str, after: str, lexicon: Lexicon) -> list[float]:
    kinds = [_kind(c) for c in value]
    turns = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    counts = np.array(list(Counter(value).values())) / len(value)
    near = re.findall(r"[a-z0-9]+", before.lower())[-4:] + re.findall(r"[a-z0-9]+", after.lower())[:2]
    tail = before.rstrip(" \"'")
    return [
        len(value), turns / len(value), float(-(counts * np.log2(counts)).sum()),
        *(kinds.count(k) / len(value) for k in range(4)), float(all(c in "0123456789abcdefABCDEF" for c in value)),
        lexicon.coverage(value), lexicon.fluency(value), value.count("/"), value.count("-"), value.count("."), float("/" in before[-2:] or "/" in after[:2]),
        float(tail.endswith(("=", ":", ">"))), float(any(_SECRET.fullmatch(w) for w in near)), float(any(w in _HARMLESS for w in near)),
        float(before[-1:] in "\"'" and before != ""), float(len(value) in (32, 40, 64)), float("@" in before[-1:] + after[:1]),
    ]


def _around(value: str, a: int, b: int) -> tuple[str, str]:
    return value[max(a - 40, 0) : a], value[b : b + 24]


def _decided(rule: str, found: str, before: str) -> float | None:
    """1 for a secret, 0 for none, None where the finding does not tell."""
    if rule == "known_form":
        return 1.0
    if _NAMED.search(before) or _PATH.fullmatch(found) or _IDENTIFIER.fullmatch(found) or len(set(found)) < 4:
        return 0.0
    if rule == "mixed":
        return 0.0 if _UUID.fullmatch(found) else None
    digits = sum(c.isdigit() for c in found)
    return 1.0 if len(found) >= 16 and 2 < digits < len(found) and not _UUID.fullmatch(found) else None


def _random_key(seed: bytes) -> str:
    """A key of 20 to 51 letters and digits that follows from the seed."""
    raw = hashlib.sha512(seed).digest()
    return "".join(_ALPHABET[c % 62] for c in raw[: 20 + raw[-1] % 32])


def labelled(value: str) -> list[tuple[str, str, str, float]]:
    """Labelled findings of one text: value, text before, text after, and 1 for a secret."""
    out = []
    for rule, a, b in findings(value):
        found, (before, after) = value[a:b], _around(value, a, b)
        true = _decided(rule, found, before)
        if true is not None:
            out.append((found, before, after, true))
        if not true:
            continue
        # the same place with things that are no secrets, and secrets in plain words
        digest = hashlib.sha1(found.encode()).hexdigest()
        plain = value[max(a - 120, 0) : max(a - 80, 0)] + " "
        named = plain + NAMES.replace("?", "").split("|")[int(digest[0], 16) % 10] + (" = ", ": ", '="', "=")[int(digest[1], 16) % 4]
        out += [(found, named, after, 1.0), (_random_key(digest.encode()), named, after, 1.0)]
        out += [(_random_key(digest[:k].encode()), plain, " " + after, 1.0) for k in (9, 17)]
        uuid = "-".join((digest[:8], digest[8:12], digest[12:16], digest[16:20], digest[20:32]))
        label = ("commit ", "sha1: ", "checksum ", "sha256:")[int(digest[2], 16) % 4]
        out += [(digest, plain + label, after, 0.0), (hashlib.sha256(found.encode()).hexdigest(), plain + label, after, 0.0), (uuid, plain + "id ", after, 0.0)]
        words = [w.lower() for w in re.findall("[A-Za-z]{3,}", value)][-9:]
        if len(words) == 9:
            path, name = "/".join(words[:3]) + f"/{words[3]}{digest[:2]}", "".join([words[4], *(w.title() for w in words[5:7])])
            fill = ("your_" + words[7] + "_here", "x" * (8 + int(digest[3], 16)), "_".join(words[6:]))[int(digest[4], 16) % 3]
            for context in (plain, named):
                out += [("/" + path, context, after, 0.0), (path + ".json", context, after, 0.0), (name, context, after, 0.0), (fill, context, after, 0.0)]
    return out


@dataclass
class Model:
    forest: trees.Forest | None
    lexicon: Lexicon


def train(docs: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE) -> Model:
    """Fit on labelled findings (value, before, after, label), of which 20 * sample with the lowest hashes at most, or on those
    made from the texts of ``sample`` documents at most."""
    lexicon = Lexicon.of(docs)
    fields = ("value", "before", "after", "label")
    if labels is not None:
        own = labels.select(*fields).dropna().orderBy(F.xxhash64(*fields), *fields).limit(20 * sample).toArrow().to_pylist()
    else:
        # tried at "=", ":" and the starts of words only
        pattern = rf"[=:](?<=(?i:{NAMES})[\"']? ?[=:])|(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{30}}"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = pa.schema([(c, pa.string()) for c in fields[:3]] + [("label", pa.float64())])
            for batch in batches:
                out = [dict(zip(fields, x, strict=True)) for value in batch.column("text").to_pylist() for x in labelled(value)]
                yield pa.RecordBatch.from_pylist(out, schema=kinds)

        some = sampled(docs, sample, pattern).select("text")
        own = some.mapInArrow(run, "value string, before string, after string, label double").toArrow().to_pylist()
    own.sort(key=lambda r: tuple(r[c] for c in fields))
    y = np.array([r["label"] for r in own])
    if not len(y) or y.min() == y.max():
        return Model(None, lexicon)
    x = np.array([features(r["value"], r["before"], r["after"], lexicon) for r in own])
    return Model(trees.forest(x, y), lexicon)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, rule, start, end (characters), score, kept, and the SHA-256 of the value, for each finding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "rule", "start", "end", "score", "kept", "value_sha256"]
        for batch in batches:
            for part in text.slices(batch, "text"):
                out: list[tuple] = []
                x: list[list[float]] = []
                for k, value in enumerate(part.column("text").to_pylist()):
                    for rule, a, b in findings(value or ""):
                        out.append((k, rule, a, b, hashlib.sha256(value[a:b].encode()).hexdigest()))
                        x.append(features(value[a:b], *_around(value, a, b), model.lexicon))
                score = model.forest.probability(np.array(x)) if x and model.forest else np.ones(len(x))
                row, rule, start, end, digest = zip(*out, strict=True) if out else ((),) * 5
                columns = [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(rule, pa.string())]
                columns += [pa.array(c, pa.int64()) for c in (start, end)]
                columns += [pa.array(score, pa.float64()), pa.array(score >= KEEP, pa.bool_()), pa.array(digest, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, rule string, start long, end long, score double, kept boolean, value_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
