import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskloom.operators import clustering, pruning
from riskloom.operators.quantiles import counted_values, exact_quantiles, numbered

SHARES = [0.0, 0.1, 0.5, 0.75, 1.0]


@pytest.mark.parametrize(("cells", "few"), [(1_024, 1_000), (64, 2)])
def test_quantiles(spark, cells, few):
    """Against Spark's own percentile: ties, nulls, huge spans, numbers of all magnitudes, special values, no values."""
    r = random.Random(3)
    rows = []
    for i in range(700):
        wild = r.choice([-1, 1]) * 10.0 ** r.uniform(-9, 9)
        rows.append((r.randint(0, 4), r.gauss(0, 1), None if i % 3 else r.randint(-10, 10), wild, r.choice([1.7e308, -1.7e308, 5e-324, 0.0]), 7, None, [math.inf, -math.inf, math.nan, 1.0][i % 4], i % 2))
    names = ["ties", "plain", "some", "wild", "wide", "one", "none", "odd", "two"]
    df = spark.createDataFrame(rows, "ties int, plain double, some long, wild double, wide double, one int, none double, odd double, two int")
    got = exact_quantiles(df, names, SHARES, cells, few)
    want = df.agg(*[F.percentile(c, F.array(*map(F.lit, SHARES))).alias(c) for c in names if c != "odd"], *[F.countDistinct(c).alias(f"n_{c}") for c in names]).first()
    for c in names:
        assert got[c][0] == min(3, want[f"n_{c}"]), c
        if c != "odd":
            assert got[c][1] == pytest.approx(want[c] or [], rel=1e-12), c
    odd = exact_quantiles(df, ["odd"], [0.0, 0.3, 0.6, 1.0], cells, few)["odd"][1]
    assert odd[:3] == [-math.inf, 1.0, math.inf] and math.isnan(odd[3])
    assert exact_quantiles(df.limit(0), names, SHARES) == {c: (0, []) for c in names} and exact_quantiles(df, [], SHARES) == {}


def test_numbered(spark):
    df = spark.range(1_000).select(((F.col("id") * 37) % 1_000).alias("k"), (F.col("id") % 5).alias("g")).repartition(7)
    got = sorted((r["g"], -r["k"], r["n"]) for r in numbered(df, "n", "g", F.desc("k"), start=3).collect())
    assert [n for *_, n in got] == list(range(3, 1_003))
    assert numbered(df.limit(0), "n", "k").count() == 0


def test_distinct_values(spark):
    rows = [(i, "a" if i else "b", -0.0 if i % 2 else 0.0, 5, None, i % 6, [1], i % 2 == 0) for i in range(100)]
    df = spark.createDataFrame(rows, "key int, mostly string, zero double, one int, none int, six int, list array<int>, flag boolean")
    assert pruning.distinct_counts(df) == {"key": 100, "mostly": 2, "zero": 1, "one": 1, "none": 0, "six": 6, "list": 1, "flag": 2}
    assert pruning.drop_unique(df, ()).columns == ["key", "mostly", "none", "six", "flag"]
    assert pruning.imbalanced(df.drop("list"), protected=()) == ["mostly", "zero", "one"]
    assert clustering.group_features(spark.createDataFrame([(0, 1, None), (1, 1, 1), (None, 0, 1)], "a int, b int, c int")) == (["c"], ["a", "b"])


def test_labels_of_many_values(spark):
    """Columns with more labels than a driver table may hold are ranked by join."""
    df = spark.createDataFrame([(float((i * 7) % 50), i, i % 3) for i in range(50)], "v double, many long, few long")
    got = clustering.relabel_all(df, [("v", "many"), ("v", "few")], most=10).collect()
    assert all(r["many"] == int(r["v"]) for r in got) and {r["few"] for r in got} == {0, 1, 2}


def test_counted_values(spark):
    """Columns of few values come as counts, others as rows; both give the same multiset and quantiles."""
    df = spark.range(0, 3_000, 1, 3).selectExpr("id % 7 AS few", "IF(id % 5 = 0, NULL, CAST(id AS DOUBLE)) AS many", "CAST(NULL AS INT) AS none", "IF(id % 2 = 0, DOUBLE('NaN'), -0.0D) AS odd")
    rows = counted_values(df, df.columns, most=50).collect()
    got = Counter()
    for r in rows:
        got[r["i"], str(r["x"] + 0.0)] += r["w"]
    want = Counter((i, str(float(v) + 0.0)) for r in df.collect() for i, v in enumerate(r) if v is not None)
    assert got == want and sum(r["i"] == 0 for r in rows) == 7 and sum(r["i"] == 1 for r in rows) == 2_400


def test_label_means(spark):
    """Means by label with nulls in either against an aggregate; a label without values has none."""
    df = spark.range(0, 500, 1, 3).selectExpr("IF(id % 11 = 0, NULL, CAST(id % 4 AS BIGINT)) AS a", "IF(id % 4 = 3 OR id % 13 = 0, NULL, id * 0.5D) AS x", "CAST(id % 2 AS INT) AS b")
    got = {(r["i"], r["l"]): r["m"] for r in clustering.label_means(df, [("x", "a"), ("b", "a"), ("x", "b")]).collect()}
    want = {(i, r["l"]): r["m"] for i, (f, g) in enumerate([("x", "a"), ("b", "a"), ("x", "b")]) for r in df.where(f"{g} IS NOT NULL").groupBy(df[g].alias("l")).agg({f: "avg"}).toDF("l", "m").collect()}
    assert got.keys() == want.keys() and got[0, 3] is None
    assert all(m == want[k] or abs(m - want[k]) < 1e-9 for k, m in got.items())
