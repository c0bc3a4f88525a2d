"""Safe casts, scaling, rounding and local time."""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _finite(c: Column) -> Column:
    x = c.try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def safe_float(c: Column, default: float = 0.0) -> Column:
    """PRJ7: a double; what is no finite number gives the default."""
    return F.coalesce(_finite(c), F.lit(default))


def safe_int(c: Column, default: int = 0) -> Column:
    """PRJ7: the same as a truncated long."""
    return F.coalesce(_finite(c).cast("long"), F.lit(default).cast("long"))


def parse_timestamp(c: Column) -> Column:
    """DT1, VAL4: strict dd/MM/yyyy HH:mm:ss; anything else is 1970-01-01."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("dd/MM/yyyy HH:mm:ss")), F.lit("1970-01-01 00:00:00").cast("timestamp"))


def epoch_seconds(c: Column) -> Column:
    """DT2."""
    return F.unix_seconds(c.cast("timestamp"))


def with_local_hour(df: DataFrame, ts: str, zone: str, out: str = "local_hour") -> DataFrame:
    """DT3: hour in each row's zone; null where the zone is null or unknown.

    Known zones are a short literal list, so an unknown one cannot fail the query.
    """
    known = F.col(zone).isin(sorted(zoneinfo.available_timezones()))
    return df.withColumn(out, F.when(known, F.hour(F.from_utc_timestamp(F.col(ts), F.when(known, F.col(zone)).otherwise(F.lit("UTC"))))))


def min_max(c: Column, low: Column, high: Column) -> Column:
    """MTH2: (c - low) / (high - low); a constant column stays as it is."""
    return F.when(high == low, c.cast("double")).otherwise((c - low) / (high - low))


def z_score(c: Column, mean: Column, sd: Column) -> Column:
    """MTH3: by the population's deviation; 0 where it is 0."""
    return F.when(sd == 0, 0.0).otherwise((c - mean) / sd)


def clip01(c: Column) -> Column:
    """MTH4: null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def round3(c: Column) -> Column:
    """MTH5: half-even, three places."""
    return F.bround(c, 3)


def normalise(df: DataFrame, column: str, how: str = "min-max") -> DataFrame:
    """MTH6: min-max or sample z-score of a column over the table."""
    stats = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"), F.avg(column).alias("_mu"), F.stddev_samp(column).alias("_sd"))
    c = F.col(column)
    if how == "min-max":
        value = min_max(c, F.col("_lo"), F.col("_hi"))
    elif how == "z-score":
        value = (c - F.col("_mu")) / F.col("_sd")
    else:
        raise ValueError(f"unknown method {how!r}")
    return df.join(F.broadcast(stats)).withColumn(column, value).drop("_lo", "_hi", "_mu", "_sd")
