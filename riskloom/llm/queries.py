"""The registered queries opN_<name> and their SQL, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import embeddings, linededup, mixing, packing, pii, quality, secrets, simhash, substrings, warc
from riskloom.llm.common import remove, saved, scratch
from riskloom.llm.sql import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.archive(_table(spark, sf_dir, "pages"), path)
    captures, _ = saved(warc.assemble(warc.read(spark, path, payloads=False)), "captures")
    remove(spark, path)
    return warc.payload_facts(captures)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.ledger(_table(spark, sf_dir, "documents"))
    return docs.select(
        "doc_id",
        *[f"ledger.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        quality.rejected(F.col("ledger.mask"), "base").alias("base_failed"),
        (~quality.rejected(F.col("ledger.mask"))).alias("kept"),
        F.col("ledger.mask").cast("long").alias("failure_mask"),
    )


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.in_order(mixing.mix(_table(spark, sf_dir, "documents"), narrow=True))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.transform("positions", lambda c: c["position"]).alias("positions"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}
    return own | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
