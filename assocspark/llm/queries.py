"""The registered queries of this subpackage. Each reads its whole tables; check SQL only where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assocspark.llm import balanced, brown, conversations, decontaminate, fingerprint, langid, line_sql, linededup
from assocspark.llm import minhash, packing, periodic, pii, quality, secrets, text
from assocspark.llm.store import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def tokenizer() -> str:
    import public_tokenizers  # only the packing queries need it

    return public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def add(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return build

    return add


@query("op7_minhash_near_dedup")
def near_dedup(table) -> DataFrame:
    return minhash.near_duplicates(table("documents"))


@query("op5_language_id")
def language_id(table) -> DataFrame:
    found = langid.identify(table("documents"), ["doc_id"])
    held_out = (text.fold("doc_id", 3) == 1).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


@query("op6_best_fit_packing")
def best_fit_packing(table) -> DataFrame:
    return packing.pack(table("documents"), tokenizer())


@query("op10_line_dedup", line_sql.SQL)
def line_dedup(table) -> DataFrame:
    found = linededup.dedup_lines(table("documents"))
    return found.select("doc_id", "n_lines", "n_removed", "removed", F.sha2("text", 256).alias("text_sha256"))


@query("op1_decontamination")
def decontamination(table) -> DataFrame:
    return decontaminate.contaminated(table("documents"), table("benchmark"))


@query("op9_fingerprints")
def document_fingerprints(table) -> DataFrame:
    return fingerprint.edited_pairs(table("documents"))


@query("op3_quality")
def quality_scores(table) -> DataFrame:
    docs, held_out = table("documents"), text.fold("doc_id", 5) == 0
    found = quality.score(docs, quality.train(docs, table("labels").where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op4_lm_scoring")
def language_model_scores(table) -> DataFrame:
    return brown.score(table("documents"), text.fold("doc_id", 10) == 0)


@query("op8_pii")
def personal_data(table) -> DataFrame:
    docs = table("documents")
    return pii.find(docs, pii.train(docs)).drop("redacted")


@query("op2_secret_scan")
def secret_scan(table) -> DataFrame:
    docs = table("documents")
    return secrets.scan(docs, secrets.train(docs))


@query("op11_periodic_runs")
def periodic_runs(table) -> DataFrame:
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    tail = F.when(hashed % 10 == 0, periodic.repeated_tail(F.col("text"), hashed)).otherwise(F.col("text"))
    found = periodic.collapse(table("documents").select("doc_id", tail.alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    shown = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    found = found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best")["col2"]).alias("start"), F.col("best")["l"].alias("length"),
        (-F.col("best")["col3"]).alias("period"), F.sha2(shown, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return found.withColumn("exponent_milli", F.expr("1000 * length div period"))


@query("op12_conversation_repair")
def conversation_repair(table) -> DataFrame:
    return conversations.digest(conversations.repair(conversations.damaged(table("conversations"))))


@query("op13_cost_balanced_packing")
def cost_balanced_packing(table) -> DataFrame:
    return balanced.pack(table("documents"), tokenizer())
