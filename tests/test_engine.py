import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import plain_kernels
from riskloom import queries as own
from riskloom.cli import respond
from riskloom.functions import numeric, text
from riskloom.operators import clustering, prepare, pruning, scoring, similarity
from riskloom.sources import tables

SF = "/root/testdata/sf0.001"
NAMES = ["str4_agg3_email_features", "agg1_2_identity", "win1_rapid_submission", "cl1_quantile_clusters", "sc1_3_scores", "fe2_correlated_pairs", "arr1_3_languages", "dt3_unusual_local_time"]


def one(spark, f, *values):
    df = spark.createDataFrame([values], [f"c{i}" for i in range(len(values))])
    return df.select(f(*[F.col(c) for c in df.columns]).alias("x")).first()["x"]


def keyed(rows):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_against_sql(spark, name):
    got = own.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "part", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({own.oracle_sql()[name]})").fetchall()
    assert keyed(map(tuple, got.select(*cols).collect())) == keyed(want)


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (text.clean_names, "José Ángel", "jose angel"),
        (text.clean_names, "O'Brien-Smith", "obriensmith"),
        (text.clean_names, "Straße Ø", "strae "),
        (text.clean_city, "Paris 75", "paris "),
        (text.clean_city, "München", "mnchen"),
        (text.clean_city, "  New   York ", "new york"),
        (text.clean_browser_language, "en-us,fr-fr", "en-US,fr-FR"),
        (text.clean_browser_language, "fr", "unknown"),
        (text.count_numeric_sequences, "12ab34cd", 3),
        (text.count_numeric_sequences, "123", 1),
        (text.sep_norm, "John..Doe-1990", "john_doe_1990"),
        (text.canonical_label, "John..Doe-1990", "john_doe_0"),
        (text.deleet_norm, "J0hn$7!", "johnsti"),
        (text.shape, "john.doe99", "asad"),
        (text.count_unique_chars, "", 0),
        (text.kolmogorov, "john.doe", 2.0),
    ],
)
def test_text(spark, f, given, want):
    assert one(spark, f, given) == pytest.approx(want) if isinstance(want, float) else one(spark, f, given) == want


def test_entropy_and_email(spark):
    assert one(spark, text.text_entropy, "aab") == pytest.approx(0.2121713894)
    assert tuple(one(spark, text.email_parts, "a@b@c.d")) == ("a", "b@c.d", "d")
    assert tuple(one(spark, text.email_parts, "bad")) == ("0", "0", "0")
    assert tuple(one(spark, text.email_parts, "a@host")) == ("a", "host", "0")


def test_kernels():
    assert plain_kernels.damerau("ca", "abc") == 2
    assert plain_kernels.damerau_similarity("john.doe", "john_doe") == 0.875
    assert plain_kernels.jaro_winkler("maria99", "maria88") == pytest.approx(0.885714, abs=1e-6)
    assert plain_kernels.token_set_ratio("a b", "b a") == 1.0
    assert [similarity.lsh_parameters(t) for t in (0.55, 0.60, 0.65, 0.85)] == [(21, 6), (18, 7), (16, 8), (8, 16)]
    assert text._fuzzy("maria", "mar1a", 0.8) and not text._fuzzy("john", "jhon99", 0.8)


def test_components_and_summary(spark):
    pairs = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.8), ("d", "e", 0.95)], "user_1 string, user_2 string, similarity double").withColumn("jaccard_raw_view", F.lit(0.5))
    users = spark.createDataFrame([(x,) for x in "abcdef"], "user string")
    clusters, summary = similarity.extract_clusters(pairs, users)
    assert {r[0]: r[1] for r in clusters.collect()} == {"a": 1, "b": 1, "c": 1, "d": 2, "e": 2, "f": -1}
    top = {r["cluster_id"]: r for r in summary.collect()}
    assert (top[1]["medoid_username"], round(top[1]["centroid_sum_similarity"], 6), top[-1]["size"]) == ("b", 1.7, 1)
    features = similarity.user_features(similarity.annotate_pairs(pairs, clusters))
    assert {r["email_username"]: r["similarity_neighbors_count"] for r in features.collect()}["b"] == 2


def test_scoring_and_clusters(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 0.3, 0.6, 0.8, 1.0)], "s double")
    assert [r[0] for r in df.select(scoring.risk_tier(F.col("s"))).collect()] == ["Low", "Low", "Moderate", "High", "Critical"]
    q = spark.createDataFrame([(float(x),) for x in (1, 2, 2, 3, 10, 20, 30, 40, 50, 100)], "x_scaled double")
    assert [r["x_cluster"] for r in clustering.quantile_clusters(q).orderBy("x_scaled").collect()] == [1, 1, 1, 2, 3, 3, 4, 4, 5, 5]
    two = spark.createDataFrame([(0.5,), (0.25,), (None,)], "x_scaled double")
    assert sorted(r["x_cluster"] for r in clustering.quantile_clusters(two).collect()) == [1, 2, 2]
    assert one(spark, numeric.round3, 0.0025) == 0.002
    scaled = pruning.min_max_scale(spark.createDataFrame([(1,), (2,), (3,)], "v int"))
    assert [r["v_scaled"] for r in scaled.orderBy("v").collect()] == [0.0, 0.5, 1.0]


def test_prepare_and_dates(spark):
    df = spark.createDataFrame([("01/02/2024 03:04:05",), ("01/02/2024",), (None,)], "app_date string")
    assert [str(r[0]) for r in prepare.impute_dates(df).collect()] == ["2024-02-01 03:04:05", "1970-01-01 00:00:00", "1970-01-01 00:00:00"]
    left = spark.createDataFrame([(None, 1)], "country string, k int")
    assert prepare.lookup_join(left, spark.createDataFrame([(None, "z")], "country string, zone string"), "country").first()["zone"] == "z"


def test_sources(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.load_table(spark, "t; drop")
    with pytest.raises(FileNotFoundError):
        tables.load_query(tmp_path, "x.sql")
    path = tables.save_checkpoint(spark.range(3).toDF("n"), str(tmp_path), "c")
    assert tables.load_checkpoint(spark, path).count() == 3
    assert respond({})[0] == 400


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["app_id", "fraud_score", "fraud_risk_tier"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
