"""The corpus operators against brute-force versions, held-out accuracy and odd inputs."""

import hashlib
import re
import zlib
from itertools import combinations

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from assocspark.llm import brown, decontaminate, fingerprint, langid, linededup, minhash, packing, pii, quality, secrets, store, text
from compare import database
from conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 97} x{i}" for i in range(20_000))
TWIN = " ".join(f"word{i}" for i in range(60))
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, TWIN), (6, TWIN + " more"), (7, TWIN), (7, TWIN), (None, "a text without id"),
    (None, None), (8, "12345 67 +1 (555) 123-4567 a@b.co 10.0.0.1 4111 1111 1111 1111"), (9, "one two"), (10, "one two"), (11, "é\U0001f600 中文"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, class long, word string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    store.ship(spark)


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    full = [(i, t, "en", "s", None if t is None else len(t), 0.5, 1, 2, "z") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def small(table):
    return duckdb.sql(f"SELECT * FROM '{SMALL}/{table}.parquet'").fetchall()


@pytest.fixture(scope="module")
def documents():
    return {d[0]: d[1] or "" for d in small("documents")}


def run(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, SMALL).collect()]


def lowered(value):
    return re.sub("[A-Z]", lambda m: m[0].lower(), value)


def shingles(value):
    w = WORD.findall(lowered(value or ""))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def linked(docs):
    """Smallest id reachable from each document over all similar pairs."""
    sets, parent = {i: shingles(t) for i, t in docs.items()}, {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(docs, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in docs}


def test_near_duplicates_by_brute_force(spark, documents):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, "op7_minhash_near_dedup")}
    assert found == linked(documents)


def test_near_duplicates_of_chains_and_large_groups(spark):
    words = [f"u{i}" for i in range(200)]
    docs = {k: " ".join(words[:100] + [f"v{k}"] + words[100:]) for k in range(60)}  # each one word from the next
    docs |= {100 + k: " ".join(words[4 * k : 4 * k + 60]) for k in range(30)}  # a chain
    docs |= {200 + k: TWIN for k in range(80)}
    rows = minhash.near_duplicates(frame(spark, list(docs.items()))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == linked(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_line_dedup_by_sql(spark):
    from assocspark.llm.line_sql import SQL

    names = ("doc_id", "n_lines", "n_removed", "removed", "text_sha256")
    expected = {r[0]: r[1:] for r in database(SMALL).execute(f"SELECT {', '.join(names)} FROM ({SQL})").fetchall()}
    assert {r["doc_id"]: tuple(r[c] for c in names[1:]) for r in run(spark, "op10_line_dedup")} == expected


def test_packing_is_whole_gapless_and_tight(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = run(spark, "op6_best_fit_packing")
    pieces = {(r["doc_id"], r["piece"]): r for r in rows}
    assert len(pieces) == len(rows)
    for doc_id, value in documents.items():
        ids = [*tokenizer.encode(value, add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            r = pieces.pop((doc_id, k))
            assert (r["start"], r["length"]) == (start, len(part))
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
    assert not pieces
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    rooms = []  # plain best-fit decreasing
    for length in sorted((r["length"] for r in rows), reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(2048 - length)
    assert len(sequences) == len(rooms)


def test_fingerprints_by_brute_force(spark, documents):
    order = sorted(documents, reverse=True)
    found = {r["doc_id"]: r for r in run(spark, "op9_fingerprints")}
    for k, doc_id in enumerate(order):
        value, after = documents[doc_id], documents[order[(k + 1) % len(order)]]
        cut = len(value) // 3
        edited = value[: len(value) - cut] + after[:cut]
        r = found[doc_id]
        assert r["n_chars"] == len(value) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        if len(value) > 600:
            assert r["near_edited"] > 0.2
    shown = {}
    for doc_id, value in documents.items():
        assert shown.setdefault(value, found[doc_id]["fingerprint"]) == found[doc_id]["fingerprint"]


def test_decontamination_finds_planted_items_and_no_clean_text(spark):
    items = [(i, t) for i, t in small("benchmark") if t and len(t) > 120][:5]
    planted = [(k, f"{TWIN} {t} {TWIN}") for k, (_, t) in enumerate(items)]
    planted += [(100 + k, f"{TWIN} {t[:40]}X{t[41:]} {TWIN}") for k, (_, t) in enumerate(items)]
    docs = frame(spark, planted + [(1000, TWIN), (1001, None), (1002, ""), (None, LONG)])
    rows = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in planted}
    assert {(k, i) for k, (i, _) in enumerate(items)} <= {(r["doc_id"], r["item_id"]) for r in rows}
    kept = decontaminate.clean(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == docs.columns and kept.count() == 4


def test_base_spans_of_personal_data(spark, documents):
    kinds = ("email", "ip", "card", "phone")
    rules = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        r"[0-9](?:[\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )

    def holds(kind, span):
        digits = [int(c) for c in span if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in span.split("."))
        if kind == "card":
            doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    for r in run(spark, "op8_pii"):
        value = documents[r["doc_id"]]
        base = [(m.start(), k, m.end()) for k, rule in enumerate(rules) for m in re.finditer(rule, value) if holds(kinds[k], m[0])]
        names = [f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(base)]
        assert r["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(r["spans"].split(",")) | {""}
        assert [r[f"n_{k}"] for k in kinds] == [sum(n.startswith(k + ":") for n in names) for k in kinds]


def test_language_model_counts_and_gain(spark, documents):
    import math
    from collections import Counter

    train, tokens = Counter(), {i: [*WORD.findall(lowered(t)), None] for i, t in documents.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in documents}
    for i, t in tokens.items():
        if not held[i]:
            train.update(t)
    total, below = sum(train.values()), math.log10(sum(train.values()) + 0.1 * (len(train) + 1))
    rows = run(spark, "op4_lm_scoring")
    for r in rows:
        t = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(t), total)
        assert r["n_known"] == sum(w in train for w in t)
        assert r["base_score"] == pytest.approx(sum(math.log10(train[w] + 0.1) - below for w in t), rel=1e-9)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in tested) > sum(r["base_score"] for r in tested)


def test_language_of_held_out_documents(spark):
    truth = {d[0]: d[2] for d in small("documents")}
    rows = [r for r in run(spark, "op5_language_id") if r["held_out"] and truth[r["doc_id"]]]
    assert all((r["doc_id"] is not None) and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) > 0.7 * len(rows)


def test_quality_and_secrets_contracts(spark, documents):
    rows = run(spark, "op3_quality")
    assert {r["doc_id"] for r in rows} == set(documents) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    for r in run(spark, "op2_secret_scan"):
        assert hashlib.sha256(documents[r["doc_id"]][r["start"] : r["end"]].encode()).hexdigest() == r["value_sha256"]


def test_pipeline_by_brute_force(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        before, docs = docs, store.stored(stage(spark, docs, SMALL), name)
        assert docs.columns == pipeline.COLUMNS
        if name == "near_duplicates":
            groups = linked({r["doc_id"]: r["text"] for r in before.collect()})
            assert {r["doc_id"] for r in docs.collect()} == {i for i, (_, low) in groups.items() if i == low}
    packed = pipeline.run(spark, SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def operators(spark):
    items = spark.createDataFrame([(1, TWIN[:200]), (2, None), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(5, 1), (9, 0), (None, None)], "doc_id long, quality int")
    path = public_tokenizers.path("word_bpe_49k.json")
    return {
        "decontaminate": lambda d: decontaminate.clean(d, items),
        "secrets": lambda d: secrets.scan(d, secrets.train(d)),
        "quality": lambda d: quality.score(d, quality.train(d, labels)),
        "brown": lambda d: brown.score(d, text.fold("doc_id", 10) == 0),
        "langid": lambda d: langid.identify(d, ["doc_id"]),
        "packing": lambda d: packing.pack(d, path),
        "minhash": minhash.near_duplicates,
        "pii": lambda d: pii.find(d, pii.train(d)),
        "fingerprint": fingerprint.edited_pairs,
        "linededup": linededup.dedup_lines,
    }


ONE_EACH = ("quality", "brown", "langid", "minhash", "pii", "fingerprint", "linededup")


@pytest.mark.parametrize("name", ["decontaminate", "secrets", "packing", *ONE_EACH])
def test_odd_and_empty_tables(spark, name):
    operator = operators(spark)[name]
    rows = operator(frame(spark, ODD)).collect()
    if name in ONE_EACH:
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in ODD)
    assert operator(frame(spark, ODD).where(F.lit(False))).collect() == []
    assert len(operator(frame(spark, [(1, None)])).collect()) == (name not in ("secrets",))
