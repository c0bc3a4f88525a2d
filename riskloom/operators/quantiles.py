"""Exact quantiles of many columns and row numbers of whole tables, without one task that holds all values."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.sources.scratch import materialise

#: Cells of a histogram, and values of an interval that are told apart at once.
CELLS, FEW = 1_024, 1_000
#: Values of a column up to which a partition counts them; columns of more stay rows.
COUNTED = 30_000


def _between(x: float, y: float, at: float) -> float:
    """The value at the fractional rank ``at`` between the values of the ranks around it."""
    low, high = math.floor(at), math.ceil(at)
    return x if low == high or x == y else (high - at) * x + (at - low) * y


def counted_values(df: DataFrame, columns: list[str], most: int = COUNTED) -> DataFrame:
    """(i, x, w): the non-null values of every column as doubles, ``w`` times each.

    Columns of which no partition has over ``most`` values are counted in one pass, and what passes over the
    result read is as small as that. Values of others are rows, of weight 1.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {i: (np.empty(0), np.empty(0, dtype=np.int64)) for i in range(len(columns))}
        for batch in batches:
            for i in [i for i, f in found.items() if f is not None]:
                x, n = np.unique(batch.column(i).drop_null().to_numpy(zero_copy_only=False) + 0.0, return_counts=True)
                both, at = np.unique(np.concatenate([found[i][0], x]), return_inverse=True)
                found[i] = None if len(both) > most else (both, np.bincount(at, np.concatenate([found[i][1], n]), len(both)).astype(np.int64))
        for i, f in found.items():
            x, n = ([0.0], [-1]) if f is None else f
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), i, dtype=np.int32)), pa.array(x, pa.float64()), pa.array(n, pa.int64())], names=["i", "x", "w"])

    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(str(i)) for i, c in enumerate(columns)])
    parts = materialise(wide.mapInArrow(count, "i int, x double, w long"), "values")
    many = sorted(r["i"] for r in parts.where("w < 0").select("i").distinct().collect())
    tall = materialise(parts.where(~F.col("i").isin(many)).groupBy("i", "x").agg(F.sum("w").alias("w")), "counts")
    if many:
        rows = wide.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(str(i)).alias("x"), F.lit(1).cast("long").alias("w")) for i in many])).alias("v")).select("v.*")
        tall = tall.unionByName(rows.where("x IS NOT NULL"))
    return tall


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float], cells: int = CELLS, few: int = FEW) -> dict[str, tuple[int, list[float]]]:
    """(distinct values, but 3 for more; interpolated quantiles, none if there is no value) per column.

    Each wanted rank lies in an interval of which the count of values below and inside is known; at first
    that is the column's range. A pass counts the cells of all intervals, with each cell's extremes, and the cell
    that holds the rank is its next interval, until it is one value. So a pass sends columns x ranks x
    cells rows at most, whatever the input, and each but for wildly uneven values shrinks intervals a
    thousandfold. Nulls are left out; infinities and NaN (the largest) count as values.
    """
    if not columns:
        return {}
    tall = counted_values(df, columns)
    times = lambda when: F.sum(F.when(when, F.col("w")).otherwise(0))
    finite = ~F.isnan("x") & (F.abs("x") < math.inf)
    ends = {}
    for r in tall.groupBy("i").agg(
        times(F.col("x") == -math.inf).alias("least"), times(finite).alias("n"), times(F.col("x") == math.inf).alias("most"), times(F.isnan("x")).alias("nan"),
        F.min(F.when(finite, F.col("x"))).alias("low"), F.max(F.when(finite, F.col("x"))).alias("high"),
    ).collect():
        ends[r["i"]] = r
    ranks: dict[int, set[int]] = defaultdict(set)
    for i, r in ends.items():
        last = r["least"] + r["n"] + r["most"] + r["nan"] - 1
        ranks[i] = {k - r["least"] for q in shares for k in (math.floor(q * last), math.ceil(q * last)) if 0 <= k - r["least"] < r["n"]}
    found: dict[tuple[int, int], float] = {}
    kinds = {i: min(1, r["n"]) for i, r in ends.items()}
    # (column, low, high, values below, values inside) -> wanted ranks
    open_ = {(i, r["low"], r["high"], 0, r["n"]): ranks[i] for i, r in ends.items() if r["n"]}
    first = True
    while open_:
        for (i, low, high, *_), wanted in open_.items():
            if low == high:
                found |= {(i, k): low for k in wanted}
        at = [key for key, wanted in open_.items() if key[1] < key[2] and (wanted or first)]
        if not at:
            break
        groups = defaultdict(list)
        for r in _cells(tall, at, cells, few).collect():
            groups[r["id"]].append((r["low"], r["high"], r["n"]))
        narrower: dict[tuple, set[int]] = defaultdict(set)
        for n, key in enumerate(at):
            below, parts = key[3], sorted(groups[n])
            if first:
                kinds[key[0]] = 2 if len(parts) == 2 and all(a == b for a, b, _ in parts) else 3
            for low, high, inside in parts:
                wanted = {k for k in open_[key] if below <= k < below + inside}
                if wanted:
                    narrower[key[0], low, high, below, inside] |= wanted
                below += inside
        open_, first = narrower, False
    out = {}
    for i, c in enumerate(columns):
        if i not in ends:
            out[c] = (0, [])
            continue
        r = ends[i]

        def value(k: int, i: int = i, r=r) -> float:
            k -= r["least"]
            return -math.inf if k < 0 else found[i, k] if k < r["n"] else math.inf if k < r["n"] + r["most"] else math.nan

        last = r["least"] + r["n"] + r["most"] + r["nan"] - 1
        distinct = kinds[i] + sum(1 for k in ("least", "most", "nan") if r[k])
        out[c] = (min(3, distinct), [_between(value(math.floor(q * last)), value(math.ceil(q * last)), q * last) for q in shares])
    return out


def _cells(tall: DataFrame, at: list[tuple], cells: int, few: int) -> DataFrame:
    """(id, low, high, n): extremes and count of every cell of the intervals; of small ones, of every value."""
    # halves, so that the span of any two numbers is finite
    side = [(n, i, low, high, inside <= few, (high / 2 - low / 2) or None) for n, (i, low, high, _, inside) in enumerate(at)]
    table = tall.sparkSession.createDataFrame(side, "id int, _i int, _low double, _high double, _few boolean, _span double")
    met = tall.join(F.broadcast(table), (F.col("i") == F.col("_i")) & (F.col("x") >= F.col("_low")) & (F.col("x") <= F.col("_high")))
    cell = F.least(F.floor((F.col("x") / 2 - F.col("_low") / 2) / F.col("_span") * cells).cast("double"), F.lit(float(cells - 1)))
    place = F.when(F.col("_few"), F.col("x")).when(F.col("_span").isNull(), (F.col("x") > F.col("_low")).cast("double")).otherwise(cell)
    return met.groupBy("id", place.alias("cell")).agg(F.min("x").alias("low"), F.max("x").alias("high"), F.sum("w").alias("n"))


def numbered(df: DataFrame, out: str, *order: Column | str, start: int = 1) -> DataFrame:
    """Add ``out``: the row's number by ``order`` (which should be unique), from ``start``.

    Rows are range-sorted and written; the number is the place in the partition plus the rows of those before,
    one count a partition.
    """
    parted = materialise(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33).cast("int")
    sizes = sorted(tuple(r) for r in parted.groupBy(part).agg(F.count("*")).collect())
    bases, total = [], start
    for p, n in sizes:
        bases.append((p, total))
        total += n
    side = df.sparkSession.createDataFrame(bases, "_part int, _base long")
    rows = parted.join(F.broadcast(side), part == F.col("_part"))
    return rows.withColumn(out, F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_base", "_at")
