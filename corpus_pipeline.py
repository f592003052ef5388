"""A corpus pipeline over ``documents``: each stage works on all that the one before it kept.

Columns stay those of ``documents``; a stage that changes the text also changes ``n_chars``. The last stage
returns packed pieces instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assocspark.llm import decontaminate, langid, linededup, minhash, packing, text
from assocspark.llm.store import ship, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or of no clear language (calibrated probability below LEAST_SCORE)."""
    ship(spark)
    model = langid.train(docs.where(text.fold("doc_id", 3) != 1))
    found = langid.predict(docs.select(COLUMNS), model, COLUMNS)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later repeats of runs of lines; a document that is nothing but repeats goes."""
    ship(spark)
    found = linededup.dedup_lines(docs.select(COLUMNS))
    found = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("long")
    return found.withColumn("n_chars", chars).select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row of least id of each group of near duplicates (NULL ids last; of equal ids any one row).

    Rows are told apart by a number of their own, written with them, so rows that share an id or have none are judged one by one.
    """
    ship(spark)
    rows = stored(docs.select(COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    kept = found.groupBy("component_id").agg(F.min(rank)["row"].alias("row")).select("row")
    gone = found.select("row").join(kept, "row", "left_anti")  # few, so the texts need no shuffle where Spark can broadcast it
    return rows.join(gone, "row", "left_anti").select(COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of ``benchmark``, exactly or nearly."""
    ship(spark)
    return decontaminate.clean(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens."""
    import public_tokenizers  # only this stage needs it

    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("best_fit_packing", packing_stage),
]

# The trained model, the registers and the tokenizer have no SQL form; tests/llm checks run() by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
