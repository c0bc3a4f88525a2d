"""Table, SQL-file and CSV sources; table, CSV and report sinks."""

from __future__ import annotations

import re
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"[A-Za-z_][\w$]*(\.[A-Za-z_][\w$]*){0,2}")


def load_table(spark: SparkSession, table: str, sample_rows: int | None = None, seed: int = 42) -> DataFrame:
    """SRC1, SRC2: a table (or a Parquet path), or a seeded random sample of exactly ``sample_rows`` rows.

    The sample is a top-k by a random key, so no task sorts or holds more than k rows.
    """
    if "/" in table or ":" in table:
        df = spark.read.parquet(table)
    elif _NAME.fullmatch(table):
        df = spark.table(table)
    else:
        raise ValueError(f"not a table name: {table!r}")
    return df.orderBy(F.rand(seed)).limit(sample_rows) if sample_rows else df


def load_query(folder: str | Path, name: str) -> str:
    """SRC3: the text of a SQL file."""
    path = Path(folder) / name
    if not path.is_file():
        raise FileNotFoundError(path)
    return path.read_text()


def run_query(spark: SparkSession, sql: str) -> tuple[list[Row], list[str]]:
    """SRC4: rows and column names of a small result."""
    df = spark.sql(sql)
    return df.collect(), df.columns


def load_query_file(spark: SparkSession, folder: str | Path, name: str) -> DataFrame:
    """SRC3: the result of a SQL file."""
    return spark.sql(load_query(folder, name))


def timezone_lookup(df: DataFrame) -> DataFrame:
    """SRC6: ISO2 and TIMEZONE as country and local_timezone."""
    return df.withColumnsRenamed({"ISO2": "country", "TIMEZONE": "local_timezone"})


def city_lookup(df: DataFrame) -> DataFrame:
    """SRC6: CLEANED_CITY and COUNTRY_CODE as city and expected_country_from_city."""
    return df.withColumnsRenamed({"CLEANED_CITY": "city", "COUNTRY_CODE": "expected_country_from_city"})


def country_lookup(df: DataFrame) -> DataFrame:
    """SRC6: lower-cased names."""
    return df.toDF(*[c.lower() for c in df.columns])


def load_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """SRC7: a CSV checkpoint with header and inferred types."""
    try:
        return spark.read.csv(path, header=True, inferSchema=True)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise


def save_checkpoint(df: DataFrame, folder: str, name: str, with_timestamp: bool = False) -> str:
    """SNK1: a CSV checkpoint; returns its path."""
    path = f"{folder}/{name}" + (datetime.now().strftime("_%Y%m%d_%H%M%S") if with_timestamp else "") + ".csv"
    df.write.mode("overwrite").csv(path, header=True)
    return path


def nullify_markers(df: DataFrame) -> DataFrame:
    """SNK2: the literal strings "nan" and "None" as nulls."""
    return df.select(*[F.when(~F.col(f"`{c}`").isin("nan", "None"), F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def table_name(project: str, run_id: str, when: datetime | None = None) -> str:
    """SNK2: PROJECT_YYYY_MM_DD_HH_MM_RUN, upper-cased."""
    return f"{project}_{(when or datetime.now()).strftime('%Y_%m_%d_%H_%M')}_{run_id}".upper()


def save_table(df: DataFrame, project: str, run_id: str, schema: str | None = None, when: datetime | None = None) -> str:
    """SNK2: write a run's rows to a warehouse table; returns its name."""
    name = table_name(project, run_id, when)
    full = f"{schema}.{name}" if schema else name
    if not _NAME.fullmatch(full):
        raise ValueError(f"not a table name: {full!r}")
    nullify_markers(df).write.mode("overwrite").saveAsTable(full)
    return full


def save_csv(df: DataFrame, path: str) -> str:
    """SNK3-SNK5: a report or score file as CSV."""
    df.write.mode("overwrite").csv(path, header=True)
    return path


def score_export(df: DataFrame) -> DataFrame:
    """SNK3: app_id, fraud_score, fraud_risk_tier, cluster and contribution columns."""
    more = [c for c in df.columns if c.endswith(("_cluster", "_risk_contrib"))]
    return df.select("app_id", "fraud_score", "fraud_risk_tier", *more)


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """SNK6: counts of a column in equal bins between its extremes, the data of a histogram plot."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, n long")
    width = (high - low) / bins or 1.0
    at = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return df.where(F.col(column).isNotNull()).groupBy(at.alias("bin")).agg(F.count("*").alias("n")).select("bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"), "n")
