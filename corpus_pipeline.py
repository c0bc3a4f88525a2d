"""The corpus pipeline: quality rules, line dedup, near-dedup by word shingles, source mixing, packing.

Every stage works on all that the one before kept and writes its rows to the shared folder for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import linededup, mixing, packing, quality, shingles
from riskloom.llm.common import saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy keeps."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has; n_chars follows the text."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    done = linededup.dedup_lines(docs.select("doc_id", "text", F.struct(F.lit(0), *[f"`{c}`" for c in rest]).alias("rest")))
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    done = done.select("doc_id", text.alias("text"), *[F.col(f"rest.`{c}`").alias(c) for c in rest])
    return _counted(done, docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 5-word shingles, Jaccard 0.8 or more."""
    return shingles.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a row per taken copy, the last copy of a source cut to its share."""
    return _counted(mixing.curriculum(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their sequence and place in it."""
    return packing.pack_documents(docs)


def _counted(df: DataFrame, own: list[str]) -> DataFrame:
    if "n_chars" in own:
        df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select(*[f"`{c}`" for c in own])


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Tokenisation has no SQL; tests/llm/test_pipeline.py holds run() against a plain Python version of all five stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
