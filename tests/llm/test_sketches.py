"""Line windows on degenerate texts, and fingerprints of short texts, against brute force."""

import random
import re
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from assocspark.llm import fingerprint, langid, linededup, store, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_first_least_of_overlapping_runs():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 6, 400).astype(np.uint64)
    start = rng.integers(0, 400, 900)
    stop = np.minimum(start + rng.integers(1, 300, 900), 400)
    found = linededup._first_least(values, start, stop)
    assert found.tolist() == [a + int(values[a:b].argmin()) for a, b in zip(start, stop, strict=True)]


def test_a_million_blank_lines_take_seconds():
    body = "\n" * 1_000_000 + " ".join(f"w{k}" for k in range(60))
    begin = time.monotonic()
    owner, start, stop, *_ = linededup.windows(pa.array([body, "a " * 60, None, ""]))
    assert time.monotonic() - begin < 30
    assert (owner == 0).sum() == 1_000_001 and set(stop[owner == 0]) == {1_000_001} and (owner == 1).sum() == 1


def brute_runs(texts):
    """Lines that go, from every run of lines with 50 words compared with every earlier place."""
    seen, gone = {}, {}
    for key in sorted(texts):
        lines = texts[key].split("\n")
        words = [len(WORD.findall(x)) for x in lines]
        out = set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(words[a:b]) < 50:
                    continue
                first = seen.setdefault(tuple(lines[a:b]), (key, a, b))
                if first[0] != key or a >= first[2]:
                    out.update(range(a, b))
        gone[key] = out
    return gone


def test_repeated_runs_by_brute_force(spark):
    rng = random.Random(5)
    pool = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 30))) for _ in range(9)] + ["", "", " "]
    texts = {k: "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14))) for k in range(60)}
    block = "\n".join(["", *pool[:8], "", ""])
    texts |= {k: f"own {k}\n{block}\ntail {k}" for k in range(60, 75)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r for r in linededup.dedup_lines(docs).collect()}
    for key, gone in brute_runs(texts).items():
        lines = texts[key].split("\n")
        left = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        assert (found[key]["n_lines"], found[key]["n_removed"], found[key]["text"]) == (len(lines), len(gone), left)


def lines_of(*bodies):
    return "\n".join(bodies)


def sentence(rng, n=25):
    return " ".join(f"t{rng.randrange(10**6)}" for _ in range(n))


def test_runs_whose_first_position_differs_are_joined_once_more(spark):
    rng = random.Random(8)
    texts, expected = {}, {}
    for k in range(0, 90, 3):
        x, shared, y = (sentence(rng) for _ in range(3))
        texts |= {k: lines_of(sentence(rng), shared, sentence(rng)), k + 1: lines_of("head", x, shared, y), k + 2: lines_of(x, shared, y, "tail")}
        expected |= {k: 0, k + 1: 0, k + 2: 3}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["n_removed"] for r in linededup.dedup_lines(docs).collect()} == expected


def test_matches_are_extended_from_few_positions():
    rng = random.Random(2)
    body = lines_of(*(sentence(rng, 10) for _ in range(400)))
    n_windows = len(linededup.windows(pa.array([body]))[0])
    owner, (_, place, low, lines, spans) = linededup.positions(pa.array([body]))
    assert len(owner) < n_windows / 1.5
    covered = set()
    for p, a, h, s in zip(place.to_pylist(), low.to_pylist(), lines, spans, strict=True):
        s = np.frombuffer(s.as_buffer(), np.int32).reshape(-1, 2)
        assert s[0, 0] == 0 and len(h.as_buffer()) == 16 * s[-1, 1] and (s[:, 0] <= p - a).all() and (p - a < s[:, 1]).all()
        covered |= {(a + x, a + y) for x, y in s.tolist()}
    assert len(covered) == n_windows


def test_extension_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(500):
        own, other = (rng.integers(0, 2, (int(rng.integers(1, 12)), 2)).astype(np.uint64) for _ in "ab")
        i, j = int(rng.integers(len(own))), int(rng.integers(len(other)))
        same = lambda d: 0 <= i + d < len(own) and 0 <= j + d < len(other) and (own[i + d] == other[j + d]).all()  # noqa: B023, E731
        start, stop = i, i
        while same(start - 1 - i):
            start -= 1
        while same(stop - i):
            stop += 1
        assert linededup.agreeing(own, other, i, j) == (start, stop)


def test_a_hot_fingerprint_is_dealt_over_tasks(spark):
    rng = random.Random(6)
    shared = lines_of(*(sentence(rng) for _ in range(3)))
    texts = [(k, lines_of(f"own {k}", shared, f"end {k}")) for k in range(900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    rows = store.stored(linededup._position_rows(docs), "positions")
    some = linededup._with_first(rows, ["fingerprint"], "place").groupBy("fingerprint").agg(F.countDistinct("part").alias("n"), F.count("*").alias("rows"))
    assert all(r["n"] > linededup.PARTS / 2 and r["rows"] == 900 for r in some.collect())
    assert {r["n_removed"] for r in linededup.dedup_lines(docs).where("doc_id > 0").collect()} == {3}


def shingle_set(value):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(value)]
    return {" ".join(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()


def hashed(shingle):
    return int(text.shingles(pa.array([shingle]), 5)[0][0])


def kept(value):
    """All hashes below the share, or else the least one."""
    every = sorted({hashed(s) for s in shingle_set(value)})
    return "".join(f"{h >> 32:08x}" for h in [h for h in every if h < 2**64 // fingerprint.SHARE] or every[:1])


TEXTS = ["", " \n", "one two three", "Four five six", "seven", "a b c d e f", "a b c d e f g h i", "x " * 50, " ".join(f"v{k}" for k in range(400))]


def test_short_texts_have_fingerprints_of_their_own():
    shown = [fingerprint.shown(s) for s in fingerprint.sketches(pa.array(TEXTS))]
    assert shown == [kept(t) for t in TEXTS]
    assert shown[:2] == ["", ""] and all(shown[2:]) and len(set(shown[2:])) == len(TEXTS) - 2
    many = [f"p{k} q{k} r{k}" for k in range(1000)]
    made = fingerprint.sketches(pa.array(many))
    assert all(len(s) == 1 for s in made) and len({s.tobytes() for s in made}) > 990
    assert fingerprint.likeness(made[0], made[1]) == 0


def test_fingerprints_merge_to_that_of_the_union():
    rng = random.Random(11)
    for _ in range(200):
        a, b = (" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 12))) for _ in range(2))
        every = sorted({hashed(s) for s in shingle_set(a) | shingle_set(b)})
        union = "".join(f"{h >> 32:08x}" for h in [h for h in every if h < 2**64 // fingerprint.SHARE] or every[:1])
        assert fingerprint.merged(kept(a), kept(b)) == union


def test_each_document_is_followed_by_the_next_lower_id(spark):
    ids = [*range(-30, 90, 3), 2**62, -(2**62)]
    docs = spark.createDataFrame([(i, f"text of {i}") for i in ids], "doc_id long, text string").repartition(5)
    for ranges in (1, 2, 7, 40):
        rows = {r["doc_id"]: r["fingerprint"] for r in fingerprint.edited_pairs(docs).collect()}
        assert len(rows) == len(ids)
        parts = fingerprint.followed(docs, ranges).withColumn("task", F.spark_partition_id()).collect()
        order, tasks = sorted(ids, reverse=True), {}
        for r in parts:
            tasks.setdefault(r["task"], []).append(r)
        assert all(len({r["part"] for r in rows}) == 1 for rows in tasks.values())
        pairs = {a["doc_id"]: b["doc_id"] for rows in tasks.values() for a, b in zip(rows, rows[1:], strict=False)}
        assert pairs == dict(zip(order, [*order[1:], order[0]], strict=True))


def test_language_sample_is_the_lowest_hashes_of_each_language(spark):
    rows = [(k, f"word{k} more", "la" if k % 10 else "lb") for k in range(4_000)]
    rows += [(11, "another text", "la")] * 50 + [(None, "no id", "la"), (5_000, None, "la")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(16)
    place = {r["doc_id"]: r["p"] for r in docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("doc_id").alias("p")).collect()}
    expected = {}
    for lang in ("la", "lb"):
        own = sorted({k for k, value, x in rows if x == lang and k is not None and value is not None}, key=lambda k: (place[k], k))
        expected[lang] = len(own[:30])
    found = langid._sample(docs, 30)
    assert {lang: sum(r[0] == lang for r in found) for lang in expected} == expected
    every = langid._sample(docs.where("doc_id = 11"), 30)
    assert len(every) == 1
