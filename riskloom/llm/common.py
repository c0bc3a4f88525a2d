"""What the operators share: the shared scratch folder, expression helpers, distributed ranks and components."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from bisect import bisect_left, insort
from itertools import accumulate
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it: space and 0x09-0x0D.
BLANK = r"\x20\x09-\x0D"
BLANKS = "\x20\t\n\x0b\x0c\r"
WORD = rf"[^{BLANK}]+"

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a session whose tasks run in this process gets a temporary folder; on a cluster
    nothing local is shared, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.partition("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="riskloom-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return f"file://{_OWN[app]}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the session's part of the shared folder, which goes when the driver ends."""
    own = f"{shared_dir(spark)}/riskloom/{spark.sparkContext.applicationId}"
    if own not in _OWN:
        _OWN[own] = own
        atexit.register(_forget, spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        remove(spark, path)


def saved(df: DataFrame, name: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    """Cut the lineage: write to the shared folder and read again, with the path to remove later.

    Unlike cached or locally checkpointed blocks these files outlive any executor.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders through the file system that holds them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once even where ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words (maximal runs without ASCII white space) of a text; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), rf"[{BLANK}]+"), lambda w: w != "")


def n_words_of(text: Column) -> Column:
    """Number of words, without building them as rows; null gives 0. Linear in the text."""
    body = F.coalesce(text, F.lit(""))
    blank = lambda c: F.contains(F.lit(BLANKS), c).cast("int")
    outside = blank(F.left(body, F.lit(1))) + blank(F.right(body, F.lit(1)))
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, rf"[{BLANK}]+", -1)) - outside).cast("long")


def stripped(text: Column) -> Column:
    """The text without ASCII white space at its ends. Linear in the text, unlike a pattern that ends in ``+$``."""
    return F.btrim(text, F.lit(BLANKS))


def buckets_for(rows: int, per_bucket: int = 20_000) -> int:
    """A number of hash buckets that keeps each near ``per_bucket`` rows, whatever the input size."""
    return max(64, -(-rows // per_bucket))


def bucket_of(key: Column, n_buckets: int) -> Column:
    """The range of [0, 2^62) that a ``spread`` hash falls into."""
    return F.floor(key / F.lit((1 << 62) // n_buckets + 1)).cast("int")


def bases(cut: DataFrame, group: list[str], value: str) -> DataFrame:
    """Per group and ``_bucket``: ``_base``, the sum of ``value`` over the group's earlier buckets."""
    sums = cut.groupBy(*group, "_bucket").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))


def on_bases(cut: DataFrame, base: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out`` (see ``running``) and the further columns of ``base`` to rows with ``_bucket``."""
    base = base.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_bucket").alias("_b"), *[c for c in base.columns if c not in (*group, "_bucket", "_sum")])
    on = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col("_bucket") == F.col("_b")]
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = cut.join(base, on, "left")
    return joined.withColumn(out, (F.col("_base") + F.col("_in")).cast("long")).drop("_bucket", "_in", "_base", "_b", *[f"_g_{g}" for g in group])


def running(df: DataFrame, group: list[str], order: list[str], value: str, n_buckets: int, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same group that come before this one.

    ``order`` starts with a well-spread non-negative long (a hash); groups are cut into ``n_buckets`` ranges
    of it, so that a group with a third of all rows is many windows instead of one task. Only the
    per-bucket sums (groups x buckets rows) meet by group.
    """
    cut = df.withColumn("_bucket", bucket_of(F.col(order[0]), n_buckets))
    return on_bases(cut, bases(cut, group, value), group, order, value, out)


def spread(*cols: Column | str) -> Column:
    """A hash in [0, 2^62) to order or deal rows by, the same in every run."""
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 62) - 1))


def components(edges: DataFrame, a: str, b: str, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges``: rows (node, component), component the smallest node.

    Alternating large-star and small-star steps: each round hangs neighbours onto the smallest neighbour
    by a partially aggregated minimum and a join (which AQE can split where a node is hot), so that the
    number of edges never grows and O(log n) rounds suffice in practice. Each round is written to the
    shared folder. Nodes without edges are not returned.
    """
    spark = edges.sparkSession
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now, path = saved(now, f"{name}-edges")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())

    last = mark(now)

    def star(df: DataFrame) -> DataFrame:
        """df: directed (x, y); hang every y on the smallest of x and its ys."""
        least = df.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("k"), F.least("x", "m").alias("m"))
        return df.join(least, df["x"] == least["k"])

    for _ in range(max_rounds):
        both = now.selectExpr("u AS x", "v AS y").unionAll(now.selectExpr("v AS x", "u AS y"))
        large = star(both).where("y > x AND y <> m").selectExpr("y AS x", "m AS y").distinct()
        small = star(large).selectExpr("IF(y = m, x, y) AS u", "m AS v").where("u <> v").distinct()
        new, new_path = saved(small, f"{name}-edges")
        remove(spark, path)
        now, path, before, last = new, new_path, last, mark(new)
        if last == before:
            break
    else:
        raise RuntimeError("components did not settle")
    tops = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


class Covered:
    """Spans to test others against, in logarithmic time; those given at first may overlap, those added do not."""

    def __init__(self, spans: list[tuple[int, int]] = ()) -> None:
        given = sorted(spans)
        self._starts = [s for s, _ in given]
        self._ends = list(accumulate((e for _, e in given), max))
        self._added: list[tuple[int, int]] = []

    def meets(self, start: int, end: int) -> bool:
        """Whether [start, end) shares a place with one of the spans."""
        i, j = bisect_left(self._starts, end), bisect_left(self._added, (end,))
        return (i > 0 and self._ends[i - 1] > start) or (j > 0 and self._added[j - 1][1] > start)

    def add(self, start: int, end: int) -> None:
        """Add a span that meets none so far."""
        insort(self._added, (start, end))
