"""Periodic runs, conversation repair and cost-balanced packing against brute-force versions."""

import functools
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from assocspark.llm import balanced, conversations, packing, periodic, store
from conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = "word_bpe_49k.json"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    store.ship(spark)


def small(table):
    return duckdb.sql(f"SELECT * FROM '{SMALL}/{table}.parquet'").fetchall()


def run(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, SMALL).collect()]


def sha(value):
    return hashlib.sha256(value.encode()).hexdigest()


# Periodic runs


def plain_runs(items):
    """Every stretch of equal words q apart, by trying all q; of one stretch, the least q."""
    numbers = {}
    codes, found = np.array([numbers.setdefault(w, len(numbers)) for w in items], int), {}
    for q in range(1, len(items) // 2 + 1):
        equal = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a + q >= max(12, 2 * q):
                found.setdefault((a, b - a + q), q)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(items, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(items) if i not in gone)


def sequences():
    """Words over little alphabets, with powers, Fibonacci and Thue-Morse words, and runs that meet."""
    rng = random.Random(11)
    for _ in range(1500):
        letters, n, kind = rng.choice([1, 2, 2, 3, 8]), rng.randrange(90), rng.randrange(4)
        if kind == 0:
            yield [rng.randrange(letters) for _ in range(n)]
        elif kind == 1:
            parts = [[rng.randrange(letters) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 7) for _ in range(6)]
            yield sum(parts, [])
        elif kind == 2:
            a, b = [0], [0, 1]
            for _ in range(rng.randrange(2, 9)):
                a, b = b, b + a
            yield b[:120] + [rng.randrange(3)]
        else:
            half = [bin(i).count("1") & 1 for i in range(n)]
            yield half + 2 * half[rng.randrange(n + 1) :]
    yield [0, 1] * 7 + [1, 0] * 7


def test_all_runs_of_random_words():
    for items in sequences():
        symbols = np.array([x + 1 for x in items] + [0], np.int64)
        assert [tuple(r) for r in periodic.find_runs(symbols).tolist()] == plain_runs(items)


def test_range_successor():
    rng = np.random.default_rng(5)
    values = rng.permutation(300)[:170]
    tree = periodic.Wavelet(values, 300)
    low = rng.integers(0, 171, 4000)
    high, x = np.minimum(low + rng.integers(0, 60, 4000), 170), rng.integers(0, 300, 4000)
    found = tree.successor(low, high, x, 999)
    assert all(f == min([v for v in values[a:b] if v >= k], default=999) for f, a, b, k in zip(found, low, high, x, strict=True))


def test_periodic_query_by_brute_force(spark):
    found = {r["doc_id"]: r for r in run(spark, "op11_periodic_runs")}
    docs, damaged = small("documents"), 0
    assert len(found) == len(docs)
    for doc_id, value, *_ in docs:
        items, h = WORD.findall(value or ""), zlib.crc32(str(doc_id).encode())
        n, g = len(items), h // 10
        if h % 10 == 0 and n:
            a, p, damaged = g % n, 1 + (n - g % n) // (3 + g % 8), damaged + 1
            items = [items[i] if i < a else items[a + (i - a) % p] for i in range(n)]
        runs, r = plain_runs(items), found[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{a},{b},{c}\n" for a, b, c in runs))
        assert r["collapsed_sha256"] == sha(plain_collapsed(items, runs))
    assert damaged > 5


def test_periodic_odd_texts(spark):
    phrase = " ".join(f"w{i}" for i in range(50))
    texts = [None, "", " \t\n", "a " * 40_000, "é\x0b中 " * 9, f"{phrase} {phrase}", "one two", f"x\n{phrase}\t{phrase} {phrase} y", "a b c a b c a b c a b C"]
    rows = [(i, t, "n", 1) for i, t in enumerate(texts)] + [(None, "a b " * 8, "n", 1), (6, "one two", "n", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")
    for parts in (1, 4):
        found = periodic.collapse(docs.repartition(parts)).collect()
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
        for r in found:
            items = WORD.findall(next(t for i, t, *_ in rows if i == r["doc_id"]) or "")
            shown = [tuple(x) for x in r["runs"]]
            assert r["n_words"] == len(items) and r["collapsed"] == plain_collapsed(items, shown)
            assert shown == (plain_runs(items) if len(items) < 1000 else [(0, 40_000, 1)])
    assert periodic.collapse(docs.where(F.lit(False))).collect() == []


# Conversation repair


def cheapest(rows):
    """Least (cost, initials) by trying all edits; rows are (role, must go, truncated)."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    keeps = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    @functools.lru_cache(None)
    def rest(i, state, inserted):
        found = [(0, "")] if i == len(rows) and state in (0, 3) else []
        if inserted < 4:
            found.append((2 + rest(i, after[state], inserted + 1)[0], "I" + rest(i, after[state], inserted + 1)[1]))
        if i < len(rows):
            role, must_go, truncated = rows[i]
            ways = [("D", state, 3)]
            if not must_go:
                ways.append(("R", after[state], 2 + truncated))
                if state in keeps.get(role[:1], {}):
                    ways.append(("K", keeps[role[:1]][state], truncated))
            found += [(cost + rest(i + 1, to, 0)[0], edit + rest(i + 1, to, 0)[1]) for edit, to, cost in ways]
        return min(found) if found else (10**9, "")

    return rest(0, 0, 0)


def applied(audit, rows):
    """The repaired (role, text) list from initials and (role, text) rows."""
    state, out, at = 0, [], 0
    for edit in audit:
        name = "assistant" if state == 2 else "user"
        if edit == "I":
            out.append((name, ""))
        else:
            role, value = rows[at]
            at += 1
            if edit == "D":
                continue
            out.append((role if edit == "K" else name, value))
        state = {"s": 1, "u": 2, "a": 3}[out[-1][0][0]]
    assert at == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
    return out


def test_cheapest_edits_of_random_conversations():
    rng = random.Random(12)
    for _ in range(6000):
        names = ["system", "user", "assistant", "user", "assistant", "tool", ""]
        rows = tuple((rng.choice(names), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(13)))
        search, edits = conversations.Viterbi(), []
        for k, row in enumerate(rows):
            edits += search.step(row[0], f"t{k}", *row[1:])
        more, cost = search.close()
        audit = "".join(e[0] for e in edits + more)
        assert (cost, audit) == cheapest(rows)
        plain = applied(audit, [(r[0], f"t{k}") for k, r in enumerate(rows)])
        assert [e[1:] for e in edits + more if e[0] != "D"] == plain


@pytest.mark.parametrize("kind", ["regular", "blank", "system first", "mixed"])
def test_memory_is_bounded_by_unresolved_edits(kind):
    rng, search, settled = random.Random(4), conversations.Viterbi(), 0
    for k in range(20_000):
        role = "user" if k % 2 == 0 else "assistant"
        if kind == "mixed":
            role = rng.choice(["user", "assistant", "system"])
        if kind == "system first" and k == 0:
            role = "system"
        gone = kind == "blank" or (kind == "system first" and k > 0) or (kind == "mixed" and rng.random() < 0.1)
        settled += len(search.step(role, "x", gone, False))
        held, seen = 0, set()
        for _, _, branch in search.survivors.values():
            while branch is not None and id(branch) not in seen:
                seen.add(id(branch))
                held, branch = held + len(branch.edits), branch.parent
        assert held <= 100 and len(seen) <= 7
    edits, cost = search.close()
    assert sum(e[0] != "I" for e in edits) + settled >= 20_000
    assert cost == {"regular": 0, "blank": 60_000}.get(kind, cost)


def plain_conversation(rows):
    """The contract's columns for one conversation, rows in turn order after damage."""
    seen, faults, marked = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
    for _, role, value in rows:
        words = WORD.findall(value)
        fault = "blank" if not words else "duplicate" if (role, value) in seen else "truncated" if words[-1][-1] not in ".!?" else None
        seen.add((role, value))
        if fault:
            faults[fault] += 1
        marked.append((role, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit = cheapest(tuple(marked))
    shown = "\n".join(f"{role}:{value}" for role, value in applied(audit, [r[1:] for r in rows]))
    return {"gaps": gaps, **faults, "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": sha(shown)}


def plain_repair(messages):
    out = {}
    for conv_id, turn, role, value in messages:
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        code = zlib.crc32(key.encode()) % 20
        role, value = (" " if v is None else v for v in (role, value))
        value = "" if code == 1 else re.sub("[.!?]", "", value) if code == 2 else value
        rows = out.setdefault(conv_id, [])
        rows += [(turn, "user" if code == 4 else role, value)] * (0 if code == 0 else 2 if code == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {conv_id: {"conv_id": conv_id, **plain_conversation(sorted(rows, key=order))} for conv_id, rows in out.items()}


def test_conversation_query_by_brute_force(spark):
    found = run(spark, "op12_conversation_repair")
    assert len(found) == len({r["conv_id"] for r in found})
    assert {r["conv_id"]: r for r in found} == plain_repair(small("conversations"))


def test_odd_conversations(spark):
    rng = random.Random(9)
    names, texts = [None, "", "system", "user", "assistant", "tool"], [None, "", " \n", "Yes.", "no", "Why? \t", "é中.\n", "Yes.", "x" * 50_000]
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, *range(6)]), rng.choice(names), rng.choice(texts)) for _ in range(150)]
    rows += [(77, 5, "user", "Twice."), (77, 5, "user", "Twice."), (78, None, None, None)]
    full = [(*r, True, "z", 3) for r in rows]
    messages = spark.createDataFrame(full, "conv_id long, turn long, role string, text string, same boolean, edit string, cost int")
    operator = lambda m: conversations.digest(conversations.repair(conversations.damaged(m)))
    found = operator(messages.repartition(5)).collect()
    assert {r["conv_id"]: r.asDict() for r in found} == plain_repair(rows) and len(found) == len({r[0] for r in rows})
    assert operator(messages.where(F.lit(False))).collect() == []
    # the repaired messages themselves
    one = [(5, 0, "user", "Hi."), (5, 1, "user", "Hi."), (5, 2, "assistant", "Yes.")]
    edits = conversations.repair(spark.createDataFrame(one, "conv_id long, turn long, role string, text string")).collect()
    assert [(e["edit"], e["role"], e["text"]) for e in edits[:-1]] == [("K", "user", "Hi."), ("D", None, None), ("K", "assistant", "Yes.")]
    assert edits[-1]["edit"] is None and edits[-1]["cost"] == 3 and edits[-1]["duplicate"] == 1


def test_long_conversation_spans_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"message {k}.") for k in range(1000)] + [(2, 0, "user", "x.")]
        messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        edits = conversations.repair(messages)
        found = {r["conv_id"]: r for r in conversations.digest(edits).collect()}
        assert found[1]["audit"] == "K" * 1000 and found[1]["repaired_sha256"] == sha("\n".join(f"{r}:{t}" for _, _, r, t in rows[:-1]))
        assert found[2]["audit"] == "KI"
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# Cost-balanced packing


def check_packing(rows, documents, capacity=4096):
    """Pieces are whole, gapless and unpadded; documents are (doc_id, ids with end)."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == {d for d, _ in documents}
    for doc_id, ids in documents:
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == at and r["length"] == len(part) > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
        assert {r["sequence_cost"] for r in parts} == {sum(balanced.cost(r["length"]) for r in parts)}
    return sequences


def test_balanced_packing_of_all_documents(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    documents = [(d[0], [*tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 2]) for d in small("documents")]
    sequences = check_packing(run(spark, "op13_cost_balanced_packing"), documents)
    assert sum(r["length"] for parts in sequences.values() for r in parts) == sum(len(ids) for _, ids in documents)


def spread(costs):
    return float(np.std(costs) / np.mean(costs))


def test_costs_are_balanced_and_few_documents_cut():
    rng = np.random.default_rng(13)
    lengths = np.clip(rng.lognormal(5.5, 1.2, 5000).astype(int), 1, 4096).tolist()
    steps = balanced.assign(lengths)
    full, pieces = sum(lengths) // 4096, [[] for _ in lengths]
    costs = [0] * full
    for item, _, length, sequence, _ in steps:
        pieces[item].append(length)
        if sequence < full:
            costs[sequence] += balanced.cost(length)
    assert [sum(p) for p in pieces] == lengths
    rooms = []  # best-fit decreasing: [room, cost]
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r[0] >= length]
        if not fits:
            rooms.append([4096, 0])
        best = min(fits) if fits else rooms[-1]
        best[0], best[1] = best[0] - length, best[1] + balanced.cost(length)
    tightest = [cost for _, cost in rooms]
    assert spread(costs) < spread(tightest) and min(costs) > min(tightest) and full < len(rooms)
    assert sum(len(p) > 1 for p in pieces) < 0.2 * full


def test_lowest_cost_with_room_by_brute_force():
    rng = random.Random(6)
    room, plain = balanced.Room(40, 64), {s: (64, 0) for s in range(40)}
    for _ in range(400):
        need, length = rng.randrange(1, 40), rng.randrange(1, 20)
        space = room.lowest(need)
        best = min(((cost, s) for s, (left, cost) in plain.items() if left >= need), default=None)
        if best is None:
            assert space is None
            continue
        left, cost = plain[best[1]]
        assert space == left
        taken = min(left, length)
        assert room.place(space, taken, taken * taken) == best[1]
        plain[best[1]] = (left - taken, cost + taken * taken)


def test_balanced_packing_of_odd_texts(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    rng = random.Random(2)
    letters = "abc XYZ 019 .,!?'s \n\té中 \U0001f600<|endoftext|>-_"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(400))), "x", 1) for i in range(300)]
    rows += [(1000, None, "x", 1), (1001, "", "x", 1), (1002, "word " * 20_000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, start int").repartition(4)
    documents = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, *_ in rows]
    path = public_tokenizers.path(TOKENIZER)
    check_packing([r.asDict() for r in balanced.pack(docs, path, window=5000).collect()], documents)
    assert [packing.Definition(spark, path).tokenizer().encode(t or "") for _, t, *_ in rows] == [np.array(i[:-1], "<u4").tobytes() for _, i in documents]
    assert balanced.pack(docs.where(F.lit(False)), path).collect() == []
    same = spark.createDataFrame([(7, "a b c"), (7, "a b c"), (None, None), (None, "a")], "doc_id long, text string")
    assert sum(r["length"] for r in balanced.pack(same, path).collect()) == 4 + 4 + 1 + 2
