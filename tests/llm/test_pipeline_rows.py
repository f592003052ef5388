"""The near-duplicate stage on rows that share an id, have none, or repeat."""

import corpus_pipeline
from assocspark.llm import store

LONG = " ".join(f"word{k}" for k in range(80))
OTHER = " ".join(f"other{k}" for k in range(80))


def test_rows_are_judged_one_by_one(spark):
    rows = [
        (1, LONG), (2, LONG), (2, OTHER),  # the second row of id 2 is no copy
        (3, "same row " * 10), (3, "same row " * 10), (None, LONG + " more"), (None, "no id and no copy"), (None, "no id and no copy"),
        (4, None), (4, None), (5, ""),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    store.ship(spark)
    kept = corpus_pipeline.near_duplicate_stage(spark, docs.repartition(4), "")
    assert kept.columns == corpus_pipeline.COLUMNS
    left = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert left == sorted([(1, LONG), (2, OTHER), (3, "same row " * 10), (None, "no id and no copy"), (4, None), (4, None), (5, "")], key=str)
    assert corpus_pipeline.near_duplicate_stage(spark, docs.limit(0), "").collect() == []


def test_slices_keep_the_working_set_of_a_worker_small():
    """Texts of 8 MB come in one Arrow batch; language counts of slices of 2 MB took near 100 MB beside it in each worker."""
    import tracemalloc

    import pyarrow as pa

    from assocspark.llm import langid, minhash, text

    words = " ".join(f"wort{i % 977} und {i}" for i in range(600_000))
    batch = pa.RecordBatch.from_arrays([pa.array([words[k : k + 2_000] for k in range(0, 8 << 20, 2_000)])], names=["text"])
    counted = {langid: lambda c: [None for _ in langid.counts(c)], minhash: lambda c: text.distinct_runs(*text.shingles(c))}
    for module, work in counted.items():
        seen = 0
        for part in list(text.slices(batch, "text", module.SLICE))[:2]:
            tracemalloc.start()
            work(part.column("text"))
            seen = max(seen, tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
        assert 0 < seen < 32 << 20
