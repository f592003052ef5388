"""What the secret scan and the personal-data spans learn from their labels, on planted texts."""

import hashlib
import random

import pytest

from assocspark.llm import pii, secrets, store


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    store.ship(spark)


WORDS = "river stone paper light garden window market silver forest letter bridge summer winter castle candle".split()


def prose(rng, n=30):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def key(rng, n):
    return "".join(rng.choice(secrets._ALPHABET) for _ in range(n - 1)) + "7"


@pytest.fixture(scope="module")
def scanned(spark):
    rng = random.Random(2)
    rows, truth = [], {}
    for k in range(300):
        digest = hashlib.sha1(str(k).encode()).hexdigest()
        planted, true = [
            (f'token = "{digest}"', True),
            (f"api_key: {key(rng, 40)}", True),
            (key(rng, 32), True),
            (f"commit {digest}", False),
            (f"token = {'/'.join(rng.sample(WORDS, 4))}.json", False),
            (f"password = {rng.choice(WORDS)}{rng.choice(WORDS).title()}{rng.choice(WORDS).title()}", False),
        ][k % 6]
        rows.append((k, f"{prose(rng)} {planted} {prose(rng)}"))
        truth[k] = true
    docs = spark.createDataFrame([*rows, (None, None), (900, ""), (901, prose(rng))], "doc_id long, text string").repartition(4)
    model = secrets.train(docs)
    return truth, dict(rows), secrets.scan(docs, model).collect(), model


def test_forest_keeps_secrets_and_drops_false_findings(scanned):
    truth, texts, found, model = scanned
    kept = {r["doc_id"] for r in found if r["kept"]}
    by_kind = [[(k in kept) == true for k, true in truth.items() if k % 6 == kind] for kind in range(6)]
    assert model.forest is not None
    assert all(sum(kind) >= 0.9 * len(kind) for kind in by_kind), [sum(k) / len(k) for k in by_kind]
    assert {r["doc_id"] for r in found} == set(truth)  # the patterns propose the false ones as well
    for r in found:
        assert hashlib.sha256(texts[r["doc_id"]][r["start"] : r["end"]].encode()).hexdigest() == r["value_sha256"]


def test_dictionary_counts_all_documents(scanned):
    assert set(WORDS) <= scanned[3].lexicon.words


@pytest.mark.parametrize("n", [30, 240, 5_000])
def test_values_of_any_length_are_whole(n):
    value = key(random.Random(n), n)
    jwt = f"eyJ{value}.{value}.{value}"
    assert secrets.findings(f"at {value} end") == [("mixed", 3, 3 + n)]
    assert secrets.findings(f"token={value} end") == [("assigned", 6, 6 + n)]
    assert secrets.findings(f"x {jwt} end") == [("known_form", 2, 2 + len(jwt))]
    assert secrets.findings(f"x sk-{value} end") == [("known_form", 2, 5 + n)]


def test_findings_do_not_overlap_and_first_rules_win():
    rng = random.Random(4)
    for _ in range(100):
        value = " ".join(rng.choice(["token=", "secret: ", "", "sk-", "/"]) + key(rng, rng.randrange(5, 40)) for _ in range(12))
        spans = sorted((a, b) for _, a, b in secrets.findings(value))
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
        taken = []
        for rule, pattern in secrets.RULES.items():
            taken += [(*m.span("value"), rule) for m in pattern.finditer(value) if not any(m.start("value") < b and a < m.end("value") for a, b, _ in taken)]
        assert sorted((r, a, b) for a, b, r in taken) == secrets.findings(value)


def card(rng):
    body = [rng.randrange(10) for _ in range(15)]
    last = next(d for d in range(10) if pii.luhn("".join(map(str, [*body, d]))))
    return "".join(map(str, [*body, last]))


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(6)
    rows, planted = [], {}
    for k in range(360):
        n = "".join(str(rng.randrange(2, 10)) for _ in range(10))
        name, host = rng.choice(WORDS), rng.choice(WORDS)
        kinds = [
            f"call +1 {n[:3]} {n[3:6]} {n[6:]} now", f"mail {name}.{k}@{host}.com now", f"card {card(rng)} now",
            f"({n[:3]}) {n[3:6]}-{n[6:]}", f"{name}{k} (at) {host} (dot) org", f"on 2024-0{1 + k % 9}-1{k % 10} we met",
        ]
        before = prose(rng, 8)
        rows.append((k, f"{before} {kinds[k % 6]} {prose(rng, 8)}"))
        planted[k] = (len(before) + 1, len(before) + 1 + len(kinds[k % 6]))
    docs = spark.createDataFrame([*rows, (None, None), (900, "")], "doc_id long, text string").repartition(4)
    model = pii.train(docs)
    return planted, {r["doc_id"]: r for r in pii.find(docs, model).collect()}, dict(rows)


def test_added_spans_are_found_and_dates_are_not(people):
    planted, found, texts = people
    phones = [f"phone:{planted[k][0]}:{planted[k][1]}" in found[k]["spans"].split(",") for k in planted if k % 6 == 3]
    mails = [f"email:{planted[k][0]}:{planted[k][1]}" in found[k]["spans"].split(",") for k in planted if k % 6 == 4]
    assert sum(phones) >= 0.9 * len(phones) and sum(mails) >= 0.9 * len(mails)
    assert all(found[k]["spans"] == "" and found[k]["redacted"] == texts[k] for k in planted if k % 6 == 5)
    assert found[900]["spans"] == "" and found[None]["redacted"] is None


def test_long_written_addresses_are_proposed_whole():
    value = "x" * 200 + " (at) " + ".".join("part" for _ in range(20)) + " (dot) org"
    assert ("email", 0, len(value)) in pii.proposals(value)


def test_unclear_proposals_teach_nothing():
    assert pii._refuted("card", "4111 1111 1111 1112", "card ") and not pii._refuted("card", "4111 1111 1111 1111", "")
    assert pii._refuted("phone", "2024-05-17", "tel ") and pii._refuted("phone", "12345678", "year ")
    assert not pii._refuted("phone", "(555) 123-4567", "") and not pii._refuted("email", "a (at) b (dot) org", "")
