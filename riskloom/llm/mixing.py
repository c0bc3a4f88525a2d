"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight schedule over training time [0, 1]: linear, from 1 to ``tilt`` times its weight. Its
integral is the source's cumulative token demand; targets stop at ``max_repeat`` times the source's size
and the excess is reshared by weight. A source's documents form a cyclic stream in a fixed pseudo-random
order; a copy that starts at cumulative token c is trained at the time t where the source's demand reaches c
(the closed-form inverse of the integrated schedule), and taken as far as the demand at the ``horizon``
goes. Range-sorting by t interleaves the sources. Built-in expressions only.

Scale: per-source streams are cut into hash buckets (``common.running``), so a source with a third of all
rows is many windows; only per-bucket sums meet by source. Targets are worked out on one row per source.

Defined results: null or blank texts have size 0, are never taken and have no position; a null source is a
source of its own, last in order; repeated rows are documents of their own; empty tables give empty results;
result columns take the place of columns of the same name, all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import BLANK, bases, bucket_of, buckets_for, n_words_of, on_bases, remove, saved, spread

WEIGHTS, BUDGET, MAX_REPEAT = (5, 2, 1), 1.5, 2
#: End weight over start weight by place in the cycle of weights: later sources are phased in, the first out.
TILTS = (0.5, 1.0, 2.0)


def targets(sizes: DataFrame, source: str = "source", size: str = "source_size", weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source with ``weight``, ``rank`` (by code point, null last) and ``target``.

    Water filling: sources in order of cap/weight saturate one after another; the level is that of the
    first unsaturated prefix. Windows over the table of sources only.
    """
    ranked = sizes.withColumn("rank", (F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("rank") % len(weights) + 1)
    one = ranked.withColumn("weight", weight).withColumn("cap", F.col(size) * F.lit(float(max_repeat)))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    filled = (
        one.withColumn("_caps", F.coalesce(F.sum("cap").over(by_fill), F.lit(0.0)))
        .withColumn("_rest", F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(by_fill), F.lit(0.0)))
        .withColumn("_total", F.sum(size).over(everywhere) * F.lit(float(budget)))
        .withColumn("_level", (F.col("_total") - F.col("_caps")) / F.col("_rest"))
    )
    # The level falls on as long as a source's own cap is below the level that it would get.
    level = F.min(F.when(F.col("_level") * F.col("weight") <= F.col("cap"), F.struct(F.col("_caps"), F.col("_level"))))
    level = F.coalesce(level.over(everywhere)["_level"], F.lit(float("inf")))
    return filled.withColumn("_at", level).withColumn("target", F.least(F.col("cap"), F.col("_at") * F.col("weight"))).select(source, size, "rank", "weight", "target")


def demand(time: Column, tilt: Column) -> Column:
    """The share of a source's tokens used by ``time``, if its weight runs linearly from 1 to ``tilt``."""
    return (time + (tilt - 1) * time * time / 2) / ((1 + tilt) / 2)


def position(share: Column, tilt: Column) -> Column:
    """The time at which a source has used ``share`` of its tokens: the inverse of ``demand``."""
    bend = tilt - 1
    curved = (F.sqrt(1 + bend * (1 + tilt) * share) - 1) / bend
    return F.when(F.abs(bend) < 1e-9, share).otherwise(curved)


#: What ``mix`` adds.
RESULTS = ("size", "source_size", "target", "taken", "positions")


def mix(df: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text", weights: tuple[int, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT, horizon: float = 1.0, seed: int = 7, narrow: bool = False) -> DataFrame:
    """Add ``size, source_size, target, taken`` and ``positions``: time and words of each of a document's copies.

    A source takes its stream as often as its demand until ``horizon`` asks; the document at the cut is taken
    in part, so that every source's taken words are its demand rounded to a word.
    ``narrow``: keep the id and the source only.
    """
    key, tie = spread(F.lit(seed), F.col(f"`{doc_id}`")), F.xxhash64(F.lit(seed), F.col(f"`{text}`"))
    sized = df.select(F.struct(*[f"`{c}`" for c in df.columns]).alias("row"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("src"), n_words_of(F.col(f"`{text}`")).alias("size"), key.alias("key"), tie.alias("tie"))
    # sizes are worked out once for all sums, and for the rows themselves if no text is wanted
    few, _ = saved(sized.drop("row"), "sizes")
    n_buckets = buckets_for(max(1, few.count()))
    few = few.withColumn("_bucket", bucket_of(F.col("key"), n_buckets))
    starts, starts_path = saved(bases(few, ["src"], "size"), "starts")
    plan = targets(starts.groupBy("src").agg(F.sum("_sum").alias("source_size")), "src", "source_size", weights, budget, max_repeat)
    plan = plan.select(F.col("src").alias("_source"), "source_size", "target", F.element_at(F.array(*[F.lit(t) for t in tilts]), F.col("rank") % len(tilts) + 1).alias("tilt"))
    starts, _ = saved(starts.join(plan, F.col("src").eqNullSafe(F.col("_source"))).drop("_source"), "plan")
    remove(df.sparkSession, starts_path)
    rows = few if narrow else sized.withColumn("_bucket", bucket_of(F.col("key"), n_buckets))
    both = on_bases(rows, starts, ["src"], ["key", "id", "tie"], "size", "from")
    until = F.round(F.col("target") * demand(F.lit(float(horizon)), F.col("tilt"))).cast("long")

    def copy(i: Column) -> Column:
        start = F.col("from") + i * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), until - start))
        return F.struct(position(start / F.col("target"), F.col("tilt")).alias("position"), words.cast("long").alias("words"))

    passes = F.sequence(F.lit(0), F.lit(max_repeat))
    copies = F.when(F.col("size") > 0, F.filter(F.transform(passes, copy), lambda c: c["words"] > 0)).otherwise(F.array().cast("array<struct<position:double,words:bigint>>"))
    out = both.withColumn("positions", copies).withColumn("taken", F.aggregate("positions", F.lit(0).cast("long"), lambda a, c: a + c["words"]))
    own = {doc_id: F.col("id"), source: F.col("src")} if narrow else {c: F.col(f"row.`{c}`") for c in df.columns}
    return out.select(*[v.alias(c) for c, v in own.items() if c.lower() not in RESULTS], *RESULTS)


def in_order(mixed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents range-sorted by the time of their first copy; those not taken come first, by id."""
    order = [F.get("positions", F.lit(0))["position"], F.col(f"`{doc_id}`")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space kept."""
    parts = F.split(text, rf"(?<=[^{BLANK}])(?=[{BLANK}])")
    return F.array_join(F.slice(parts, 1, n.cast("int")), "")


def curriculum(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """One row per taken copy in training order (range-sorted by position), with the columns of ``df``; partial
    copies are cut to their words."""
    packed = df.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("src"), F.col(f"`{text}`").alias("body"), F.struct(*[f"`{c}`" for c in df.columns if c != text]).alias("rest"))
    rows = mix(packed, "src", "id", "body", **how).select("body", "rest", "size", F.explode("positions").alias("c"))
    body = F.when(F.col("c.words") < F.col("size"), first_words(F.col("body"), F.col("c.words"))).otherwise(F.col("body"))
    rows = rows.select(F.col("c.position").alias("at"), body.alias("body"), "rest").repartitionByRange("at").sortWithinPartitions("at")
    return rows.select(*[F.col("body").alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in df.columns])
