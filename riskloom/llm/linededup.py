"""Line deduplication over levelled sorted runs.

Documents come in batches of ascending ``doc_id``. The store keeps, for every line key seen, the smallest
document that holds it, as runs of (key hashes, doc_id): tables bucketed and sorted by the hashes, so a run
is never shuffled again. A batch aggregates its own keys once and is merge-joined with the runs bucket by
bucket. Keys that no run has are added as a run of level 0; keys that a run has, or that two documents of the
batch share, go to the list of repeated keys with their first document. When a level holds ``fanout`` runs
they are merged, bucket by bucket, into one of the next level, so a key takes part in O(log batches) rewrites and
a lookup meets O(fanout x levels) runs. Only repeated keys meet the lines again. Built-in expressions only.

A key is the line without ASCII white space at its ends, A-Z lower-cased. Keys shorter than
``min_chars`` are never dropped. Two independent 64-bit hashes stand for a key.

Defined results: null and empty texts are one empty line; repeated rows of one doc_id count as one
document; a null doc_id is a document smaller than any other; an empty table gives an empty result; result columns
take the place of columns of the same name, all others pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import let, remove, saved, scratch, stripped

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, FANOUT = 10, 4
#: Documents to a batch, about; at least LEAST_BATCHES and at most MOST_BATCHES of them.
PER_BATCH, LEAST_BATCHES, MOST_BATCHES = 5_000_000, 6, 64


def line_key(line: Column) -> Column:
    """The key of a line."""
    return F.translate(stripped(line), UPPER, LOWER)


def line_hashes(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """For each line of a text: struct(h1, h2), or null where the key is too short."""

    def of(key: Column) -> Column:
        return F.when(F.length(key) >= min_chars, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))

    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.transform(F.transform(lines, line_key), of)


class LineRuns:
    """The store: levels of runs (h1, h2, first_doc), bucketed and sorted by the hashes, in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, n_buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.n_buckets = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []
        self.merges = 0

    @property
    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def add(self, keys: DataFrame) -> tuple[DataFrame, str]:
        """Join a batch's (h1, h2, first_doc, more) with all runs and add what is new as a run.

        Returns the repeated keys (h1, h2, first_doc), and their path: those that a run has, and new ones that
        have ``more`` documents.
        """
        judged, found = keys, F.lit(None)
        for i, run in enumerate(self.runs):
            run = run.select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), F.struct("first_doc").alias(f"run{i}"))
            judged = judged.join(run, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")), "left").drop("r1", "r2")
            found = F.coalesce(found, F.col(f"run{i}")) if i else F.col("run0")
        known = found.isNotNull()
        first = F.when(known, found["first_doc"]).otherwise(F.col("first_doc")) if self.levels else F.col("first_doc")
        judged, path = saved(judged.select("h1", "h2", first.alias("first_doc"), known.alias("known"), "more"), "batch")
        self._put(0, judged.where("NOT known").select("h1", "h2", "first_doc"))
        return judged.where("known OR more").select("h1", "h2", "first_doc"), path

    def _put(self, level: int, df: DataFrame) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        name, path = f"riskloom_run_{uuid.uuid4().hex}", scratch(self.spark, f"run{level}")
        df.repartition(self.n_buckets, "h1", "h2").write.bucketBy(self.n_buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).saveAsTable(name)
        self.levels[level].append((name, path))
        if len(self.levels[level]) >= self.fanout:
            old, merged = self.levels[level], None
            for run, _ in old:
                merged = self.spark.table(run) if merged is None else merged.unionByName(self.spark.table(run))
            self.levels[level] = []
            self._put(level + 1, merged)
            self.merges += 1
            self._drop(old)

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(self.spark, path)

    def close(self) -> None:
        for level in self.levels:
            self._drop(level)
        self.levels = []


def batches_for(n_docs: int, per_batch: int = PER_BATCH) -> int:
    return min(MOST_BATCHES, max(LEAST_BATCHES, -(-n_docs // per_batch)))


def batch_bounds(docs: DataFrame, doc_id: str, batches: int) -> list[int]:
    """Upper bounds that cut the ids into batches of about equal size (all but the last)."""
    if batches < 2:
        return []
    cuts = docs.select(F.percentile_approx(doc_id, [i / batches for i in range(1, batches)])).first()[0] or []
    return sorted(set(cuts))


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, batches: int | None = None, fanout: int = FANOUT, out: str = "kept_text") -> DataFrame:
    """Add ``out`` (the text without the lines to drop), ``n_lines`` and ``n_dropped`` to every row.

    ``batches``: how many; by default as many as the number of documents asks for.
    """
    spark = df.sparkSession
    passing = [c for c in df.columns if c.lower() not in (out.lower(), "n_lines", "n_dropped")]
    ident = F.col(f"`{doc_id}`")
    lines, lines_path = saved(df.select(ident.alias("d"), line_hashes(F.col(f"`{text}`"), min_chars).alias("hs")), "lines")
    store = LineRuns(spark, fanout)
    bounds = batch_bounds(lines, "d", batches or batches_for(lines.count()))
    repeated, paths = None, []
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        batch = lines
        if low is not None:
            batch = batch.where(F.col("d") > low)
        if high is not None:
            batch = batch.where(F.col("d") <= high if low is not None else F.col("d").isNull() | (F.col("d") <= high))
        keys = batch.select("d", F.explode(F.array_distinct(F.array_compact("hs"))).alias("h")).select("h.h1", "h.h2", F.struct(F.col("d").isNotNull().alias("some"), F.col("d").alias("d")).alias("d"))
        keys = keys.groupBy("h1", "h2").agg(F.min("d").alias("a"), F.max("d").alias("b"))
        more, path = store.add(keys.select("h1", "h2", F.col("a.d").alias("first_doc"), (F.col("a") != F.col("b")).alias("more")))
        repeated = more if repeated is None else repeated.unionByName(more)
        paths.append(path)
    store.close()
    # a key's first document is the same in every batch that lists it; written, so that the join can split hot keys
    repeated, path = saved(repeated.groupBy(F.col("h1").alias("r1"), F.col("h2").alias("r2")).agg(F.first("first_doc").alias("first_doc")), "repeated")
    paths.append(path)
    found = lines.select("d", F.posexplode("hs").alias("pos", "h")).where("h IS NOT NULL").select("d", "pos", "h.h1", "h.h2")
    drops = found.join(repeated, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2"))).where(~F.col("d").eqNullSafe(F.col("first_doc")))
    drops, _ = saved(drops.groupBy("d").agg(F.array_sort(F.collect_set("pos")).alias("drops")), "drops")
    remove(spark, lines_path, *paths)
    # a merge join at every size: what is dropped grows with the corpus, and its files are far smaller than its rows
    joined = df.select(F.struct(*[f"`{c}`" for c in df.columns]).alias("row")).join(drops.hint("merge"), F.col(f"row.`{doc_id}`") == F.col("d"), "left")

    def kept(all_lines: Column) -> Column:
        ends = F.concat(F.array(F.lit(-1)), F.coalesce(F.col("drops"), F.array().cast("array<int>")), F.array(F.size(all_lines)))
        pieces = let(ends, lambda e: F.transform(F.sequence(F.lit(1), F.size(e) - 1), lambda j: F.slice(all_lines, F.get(e, j - 1) + 2, F.get(e, j) - F.get(e, j - 1) - 1)))
        return F.struct(F.array_join(F.flatten(pieces), "\n").alias("kept"), F.size(all_lines).cast("long").alias("n"))

    body = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    fast = F.struct(body.alias("kept"), (F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n"))
    slow = let(F.split(body, "\n", -1), kept)
    done = joined.withColumn("_kept", F.when(F.col("drops").isNull(), fast).otherwise(slow))
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in passing], F.col("_kept.kept").alias(out), F.col("_kept.n").alias("n_lines"), F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"))
