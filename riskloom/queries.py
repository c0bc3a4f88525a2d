"""Registered queries of the risk engine, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions import numeric, text
from riskloom.operators import clustering, features, prepare, pruning, scoring, similarity
from riskloom.sources import applications as app
from riskloom.sources import tables
from riskloom.sources.scratch import materialise, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
APPS = f"WITH apps AS ({app.duckdb_sql()}) "
#: What DuckDB needs for the e-mail parts of the adapter's addresses.
MAIL = f"""WITH apps AS ({app.duckdb_sql()}), mail AS (
  SELECT *, split_part(email, '@', 1) AS u, substr(email, strpos(email, '@') + 1) AS d, list_last(string_split(email, '.')) AS t FROM apps) """


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.load_table(spark, f"{sf_dir}/{name}.parquet")


def _apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app.applications(spark, sf_dir)


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _apps(spark, sf_dir).select("app_id", text.email_parts(F.col("email"))["user"].alias("email_username"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def src1_full_scan(s, d):
    return _table(s, d, "nation").select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT CAST(least(1000, count(*)) AS BIGINT) AS n_rows, CAST(least(1000, count(DISTINCT o_orderkey)) AS BIGINT) AS n_keys FROM orders")
def src2_row_sample(s, d):
    return tables.load_table(s, f"{d}/orders.parquet", 1000).agg(F.count("*").alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys"))


@query("SELECT r_name, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def src3_sql_text(s, d):
    return s.sql("SELECT r_name, count(*) AS n FROM {region} JOIN {nation} ON n_regionkey = r_regionkey GROUP BY r_name", region=_table(s, d, "region"), nation=_table(s, d, "nation"))


@query("SELECT n_name AS country, 'Europe/Paris' AS local_timezone FROM nation")
def src6_lookup_renames(s, d):
    return tables.timezone_lookup(_table(s, d, "nation").select(F.col("n_name").alias("ISO2"), F.lit("Europe/Paris").alias("TIMEZONE")))


@query("SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def snk2_null_markers(s, d):
    marked = _table(s, d, "orders").withColumn("o_orderpriority", F.when(F.col("o_orderpriority") == "1-URGENT", "nan").otherwise(F.col("o_orderpriority")))
    return tables.nullify_markers(marked).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT least(CAST(floor((o_totalprice - lo) / ((hi - lo) / 20)) AS INT), 19) AS bin, count(*) AS n FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) GROUP BY 1")
def snk6_score_histogram(s, d):
    return tables.histogram(_table(s, d, "orders"), "o_totalprice", 20).select("bin", "n")


@query("SELECT o_custkey, o_orderkey AS app_id FROM orders")
def prj1_3_project_rename(s, d):
    raw = _table(s, d, "orders").withColumnRenamed("o_orderkey", "Order Number ")
    df = prepare.normalize_columns(raw.select(*[f"`{c}`" for c in raw.columns]))
    return prepare.subset(prepare.rename(df, {"ORDER NUMBER": "app_id"}), ["o_custkey", "app_id", "absent"])


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1")
def prj4_dedupe_first(s, d):
    return prepare.drop_duplicates(_table(s, d, "orders"), ["o_custkey"], "first", "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n = 1")
def prj4_dedupe_none(s, d):
    return prepare.drop_duplicates(_table(s, d, "orders"), ["o_custkey"], False, "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT event_id, CAST(coalesce(trunc(try_cast(event_type AS DOUBLE)), 7) AS BIGINT) AS as_int, coalesce(try_cast(CAST(value AS VARCHAR) AS DOUBLE), 0) AS as_float FROM events")
def prj7_safe_casts(s, d):
    e = _table(s, d, "events")
    return e.select("event_id", numeric.safe_int(F.col("event_type"), 7).alias("as_int"), numeric.safe_float(F.col("value")).alias("as_float"))


@query(APPS + "SELECT app_id, CASE cleansed WHEN 'CLEANSED' THEN '1' ELSE '0' END AS cleansed, CASE WHEN lower(ueclf_24_app) = 'yes' THEN '1' ELSE '0' END AS ueclf_24_app, CASE WHEN lower(uelf_25_app) = 'yes' THEN '1' ELSE '0' END AS uelf_25_app, CASE WHEN browser IS NOT DISTINCT FROM '1-URGENT' THEN '1' ELSE '0' END AS urgent FROM apps")
def val1_3_value_maps(s, d):
    return _apps(s, d).select("app_id", prepare.mapped("cleansed", prepare.VALUE_MAPS["cleansed"]).alias("cleansed"), prepare.yes_flag("ueclf_24_app").alias("ueclf_24_app"), prepare.yes_flag("uelf_25_app").alias("uelf_25_app"), prepare.exact_flag("browser", "1-URGENT").alias("urgent"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN epoch(date_trunc('second', o_orderdate))::BIGINT ELSE 0 END AS seconds FROM orders")
def val4_impute_dates(s, d):
    o = _table(s, d, "orders").withColumn("app_date", F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise("0"))
    return prepare.impute_dates(o).select("o_orderkey", numeric.epoch_seconds(F.col("app_date")).alias("seconds"))


@query(APPS + ", z AS (SELECT n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'Europe/Paris' END AS zone FROM nation WHERE n_nationkey < 20) SELECT app_id, zone, z.n_name AS country_name, CASE WHEN z.n_name IS NOT NULL THEN substr(z.n_name, 1, 2) END AS isocode FROM apps LEFT JOIN z ON z.n_name = apps.country")
def jn1_3_enrich_lookups(s, d):
    n = _table(s, d, "nation").where("n_nationkey < 20")
    zones = n.select(F.col("n_name").alias("country"), F.when(F.col("n_nationkey") % 2 == 0, "Europe/Paris").alias("zone"))
    countries = n.select(F.col("n_name").alias("country_name"), F.substring("n_name", 1, 2).alias("isocode"))
    return prepare.enrich(_apps(s, d), zones, None, countries).select("app_id", "zone", "country_name", "isocode")


@query(APPS + "SELECT app_id, lower(regexp_replace(first_name, '[^a-zA-Z\\s]', '', 'g')) AS first_name, lower(regexp_replace(full_name, '[^a-zA-Z\\s]', '', 'g')) AS full_name FROM apps")
def str1_clean_names(s, d):
    return _apps(s, d).select("app_id", text.clean_names(F.col("first_name")).alias("first_name"), text.clean_names(F.col("full_name")).alias("full_name"))


@query(APPS + "SELECT app_id, regexp_replace(regexp_replace(trim(lower(city)), '[^a-z\\s]', '', 'g'), '\\s+', ' ', 'g') AS city FROM apps")
def str2_clean_city(s, d):
    return _apps(s, d).select("app_id", text.clean_city(F.col("city")).alias("city"))


@query(APPS + "SELECT app_id, CASE browser_language WHEN 'en-us,fr-fr' THEN 'en-US,fr-FR' WHEN 'DE-de, en-gb' THEN 'de-DE,en-GB' ELSE 'unknown' END AS browser_language FROM apps")
def str3_clean_language(s, d):
    return _apps(s, d).select("app_id", text.clean_browser_language(F.col("browser_language")).alias("browser_language"))


@query(MAIL + "SELECT app_id, u AS email_username, d AS email_domain, t AS email_tld, count(*) OVER (PARTITION BY d) AS domain_freq, count(*) OVER (PARTITION BY t) AS tld_freq FROM mail")
def str4_agg3_email_features(s, d):
    return features.email_features(_apps(s, d)).select("app_id", "email_username", "email_domain", "email_tld", "domain_freq", "tld_freq")


@query(MAIL + "SELECT app_id, regexp_extract(email, '([^@]+)@([^.]+)\\.(.+)', 2) AS domain, regexp_extract(email, '([^@]+)@([^.]+)\\.(.+)', 3) AS tld FROM mail")
def str4b_email_first_label(s, d):
    p = text.email_parts_first_label(F.col("email"))
    return _apps(s, d).select("app_id", p["domain"].alias("domain"), p["tld"].alias("tld"))


@query(MAIL + """SELECT app_id, length(u) AS username_length, len(regexp_extract_all(u, '[0-9]')) AS username_digit_count, len(regexp_extract_all(u, '[^a-zA-Z0-9]')) AS username_special_count,
  len(list_distinct(string_split(u, ''))) AS username_unique_chars, round(len(regexp_extract_all(u, '[0-9]')) / length(u), 9) AS username_digit_ratio,
  len(regexp_extract_all(regexp_replace(u, '[0-9]+$', ''), '[0-9]+')) + CASE WHEN regexp_matches(u, '^[0-9]') THEN 1 ELSE 0 END AS username_numeric_seq_count FROM mail""")
def str5_12_username_chars(s, d):
    f = features.username_features(_users(s, d))
    return f.select("app_id", "username_length", "username_digit_count", "username_special_count", "username_unique_chars", F.round("username_digit_ratio", 9).alias("username_digit_ratio"), "username_numeric_seq_count")


@query(MAIL + """, c AS (SELECT DISTINCT u FROM mail), x AS (SELECT u, ch, count(*) AS n FROM c, unnest(string_split(u, '')) AS t(ch) GROUP BY u, ch),
  e AS (SELECT u, round(-sum(n / length(u) * ln(n / length(u))) / length(any_value(u)), 9) AS username_entropy FROM x GROUP BY u) SELECT app_id, username_entropy FROM mail JOIN e USING (u)""")
def str10_entropy(s, d):
    return _users(s, d).select("app_id", F.round(text.text_entropy(F.col("email_username")), 9).alias("username_entropy"))


@query()
def str11_kolmogorov(s, d):
    return _users(s, d).select("email_username").distinct().select("email_username", text.kolmogorov(F.col("email_username")).alias("complexity"))


@query(MAIL + """, k AS (SELECT *, regexp_replace(lower(first_name), '[^a-z]', '', 'g') AS f, regexp_replace(lower(last_name), '[^a-z]', '', 'g') AS l, regexp_replace(lower(u), '[^a-z]', '', 'g') AS n FROM mail),
  g AS (SELECT *, list_transform(range(1, greatest(length(n) - 1, 1)), lambda i: substr(n, i, 3)) AS gn, list_transform(range(1, greatest(length(f) - 1, 1)), lambda i: substr(f, i, 3)) AS gf, list_transform(range(1, greatest(length(l) - 1, 1)), lambda i: substr(l, i, 3)) AS gl FROM k)
  SELECT app_id, contains(lower(u), lower(first_name)) AS exact_first_match, list_has_any(gf, gn) AS ngram_first_match, contains(lower(u), lower(last_name)) AS exact_last_match, list_has_any(gl, gn) AS ngram_last_match FROM g""")
def str13_15_name_matches(s, d):
    a = _apps(s, d).withColumn("email_username", text.email_parts(F.col("email"))["user"])
    return features.name_matches(a).select("app_id", "exact_first_match", "ngram_first_match", "exact_last_match", "ngram_last_match")


@query()
def str14_16_semantic_score(s, d):
    a = _apps(s, d).withColumn("email_username", text.email_parts(F.col("email"))["user"])
    return features.name_matches(a).select("app_id", "fuzzy_first_match", "fuzzy_last_match", "inv_semantic_score")


@query(MAIL + """SELECT app_id, lower(u) AS norm, trim(regexp_replace(lower(u), '[^a-z0-9]+', '_', 'g'), '_') AS sep, translate(lower(u), '0134578@$!', 'oieastbasi') AS deleet,
  regexp_replace(regexp_replace(regexp_replace(lower(u), '[a-z]+', 'a', 'g'), '[0-9]+', 'd', 'g'), '[^ad]+', 's', 'g') AS shape, regexp_replace(lower(u), '[^a-z]', '', 'g') AS letters,
  trim(regexp_replace(lower(u), '[^a-z0-9]+', ' ', 'g')) AS tokens, regexp_replace(trim(regexp_replace(lower(u), '[^a-z0-9]+', '_', 'g'), '_'), '[0-9]+', '0', 'g') AS label FROM mail""")
def str17_23_views(s, d):
    u = F.col("email_username")
    return _users(s, d).select("app_id", text.norm(u).alias("norm"), text.sep_norm(u).alias("sep"), text.deleet_norm(u).alias("deleet"), text.shape(u).alias("shape"), text.letters_only(u).alias("letters"), text.tokens_for_ratio(u).alias("tokens"), text.canonical_label(u).alias("label"))


@query(MAIL + """, x AS (SELECT DISTINCT u FROM mail) SELECT u AS email_username, len(list_distinct(flatten([list_transform(range(1, length(u) - n + 2), lambda i: substr(u, i, n)) FOR n IN [2, 3, 4]]))) AS n_shingles FROM x""".replace("[list_transform(range(1, length(u) - n + 2), lambda i: substr(u, i, n)) FOR n IN [2, 3, 4]]", "[" + ", ".join(f"list_transform(range(1, length(u) - {n} + 2), lambda i: substr(u, i, {n}))" for n in (2, 3, 4)) + "]"))
def str24_shingles(s, d):
    return _users(s, d).select("email_username").distinct().select("email_username", F.size(text.shingles(F.col("email_username"), (2, 3, 4))).alias("n_shingles"))


@query(APPS + """, g AS (SELECT passport_id, count(*) AS passport_id_counts, count(DISTINCT email) AS unique_emails_per_passport, count(DISTINCT full_name) AS names FROM apps GROUP BY passport_id)
  SELECT app_id, passport_id_counts, unique_emails_per_passport, CAST(names > 1 AS INT) AS name_variation_flag, count(*) OVER (PARTITION BY contact_number) AS phone_counts FROM apps JOIN g USING (passport_id)""")
def agg1_2_identity(s, d):
    return features.identity_features(_apps(s, d)).select("app_id", "passport_id_counts", "unique_emails_per_passport", "name_variation_flag", "phone_counts")


@query(APPS + """SELECT app_id, CAST(coalesce(epoch(date_trunc('second', app_date)) - lag(epoch(date_trunc('second', app_date))) OVER (PARTITION BY passport_id ORDER BY app_id) < 3600, false) AS BIGINT) AS rapid_submission_flag,
  count(*) OVER (PARTITION BY ip_short) AS app_count_per_ip FROM apps""")
def win1_rapid_submission(s, d):
    return features.behaviour_features(_apps(s, d)).select("app_id", "rapid_submission_flag", "app_count_per_ip")


@query("SELECT event_id, CAST(coalesce(epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 3600, false) AS BIGINT) AS rapid_submission_flag FROM (SELECT event_id, user_id, date_trunc('second', ts) AS ts FROM events)")
def win1_event_gaps(s, d):
    e = _table(s, d, "events").withColumn("ts", F.date_trunc("second", F.col("ts").cast("timestamp"))).withColumn("o", F.struct("ts", "event_id"))
    return features.rapid_submission(e, "user_id", "ts", "o").select("event_id", "rapid_submission_flag")


@query(APPS + "SELECT app_id, (CASE WHEN lower(ueclf_24_app) = 'yes' THEN 1 ELSE 0 END) + (CASE WHEN lower(uelf_25_app) = 'yes' THEN 1 ELSE 0 END) AS total_apps FROM apps")
def agg7_total_apps(s, d):
    return features.total_apps(prepare.clean_values(_apps(s, d))).select("app_id", "total_apps")


@query(APPS + ", g AS (SELECT postcode, count(DISTINCT city) AS n FROM apps GROUP BY postcode) SELECT app_id, CAST(country IS DISTINCT FROM provider_country AS INT) AS country_mismatch, CAST(n > 1 AS INT) AS postcode_multiple_cities FROM apps JOIN g USING (postcode)")
def geo_agg4_location(s, d):
    return features.postcode_multiple_cities(features.country_mismatch(_apps(s, d))).select("app_id", "country_mismatch", "postcode_multiple_cities")


@query(APPS + """, i AS (SELECT ip_short, count(DISTINCT passport_id) AS n FROM apps GROUP BY 1), b AS (SELECT browser, count(DISTINCT passport_id) AS n FROM apps GROUP BY 1)
  SELECT app_id, CAST(i.n > 2 AS INT) AS ip_suspicious, CAST(b.n > 10 AS INT) AS browser_suspicious FROM apps JOIN i USING (ip_short) JOIN b USING (browser)""")
def agg5_fingerprint(s, d):
    return features.fingerprint_features(_apps(s, d)).select("app_id", "ip_suspicious", "browser_suspicious")


@query(APPS + """, l AS (SELECT app_id, substr(country, 1, 2) AS c, substr(provider_country, 1, 2) AS p, list_distinct(list_transform(regexp_extract_all(coalesce(browser_language, ''), '-([A-Za-z]{2})', 1), lambda x: upper(x))) AS r FROM apps)
  SELECT app_id, CAST(NOT (list_contains(r, p) OR list_contains(r, c)) AS INT) AS country_language_mismatch, CAST(NOT list_contains(r, p) AS INT) AS uncommon_browser_language FROM l""")
def arr1_3_languages(s, d):
    a = _apps(s, d).withColumns({"country": F.substring("country", 1, 2), "provider_country": F.substring("provider_country", 1, 2)})
    return features.language_features(a).select("app_id", "country_language_mismatch", "uncommon_browser_language")


@query(APPS + ", h AS (SELECT app_id, hour((app_date AT TIME ZONE 'UTC') AT TIME ZONE coalesce(local_timezone, 'UTC')) AS h, local_timezone AS z FROM apps) SELECT app_id, CASE WHEN z IS NOT NULL AND (h <= 5 OR h = 23) THEN 1 ELSE 0 END AS unusual_local_time FROM h")
def dt3_unusual_local_time(s, d):
    return features.unusual_local_time(_apps(s, d)).select("app_id", "unusual_local_time")


@query(APPS + ", e AS (SELECT *, CASE WHEN app_id % 4 = 0 THEN country WHEN app_id % 4 = 1 THEN 'FRANCE' END AS x FROM apps) SELECT app_id, CAST(x IS NOT NULL AND x IS DISTINCT FROM country AND x IS DISTINCT FROM provider_country AS INT) AS city_country_mismatch FROM e")
def geo2_city_country(s, d):
    a = _apps(s, d).withColumn("expected_country_from_city", F.when(F.col("app_id") % 4 == 0, F.col("country")).when(F.col("app_id") % 4 == 1, "FRANCE"))
    return features.city_country_mismatch(a).select("app_id", "city_country_mismatch")


@query("SELECT c_custkey, (c_acctbal - lo) / (hi - lo) AS min_max, (c_acctbal - mu) / sd AS z FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, avg(c_acctbal) AS mu, stddev_samp(c_acctbal) AS sd FROM customer)")
def mth6_normalise(s, d):
    c = _table(s, d, "customer").select("c_custkey", "c_acctbal", F.col("c_acctbal").alias("z"))
    return numeric.normalise(numeric.normalise(c, "c_acctbal"), "z", "z-score").select("c_custkey", F.col("c_acctbal").alias("min_max"), "z")


@query("SELECT p_partkey, ln(1 + p_retailprice) AS log, sqrt(p_retailprice) AS root, least(greatest((p_size - 10) / 30.0::DOUBLE, 0), 1) AS clipped, CASE WHEN sd = 0 THEN 0 ELSE (p_retailprice - mu) / sd END AS z FROM part, (SELECT avg(p_retailprice) AS mu, stddev_pop(p_retailprice) AS sd FROM part)")
def mth1_4_math(s, d):
    p = _table(s, d, "part")
    stats = p.agg(F.avg("p_retailprice").alias("mu"), F.stddev_pop("p_retailprice").alias("sd"))
    c = F.col("p_retailprice")
    return p.join(stats).select("p_partkey", F.log1p(c).alias("log"), F.sqrt(c).alias("root"), numeric.clip01((F.col("p_size") - 10) / F.lit(30.0)).alias("clipped"), numeric.z_score(c, F.col("mu"), F.col("sd")).alias("z"))


def _short_users(s, d):
    return similarity.usernames(_users(s, d))


_PAIRS = MAIL + """, x AS (SELECT DISTINCT lower(u) AS u FROM mail), sh AS (SELECT DISTINCT u, substr(u, i, k) AS s FROM x, unnest([2, 3, 4]) AS a(k), unnest(range(1, length(u) - k + 2)) AS b(i)),
  n AS (SELECT u, count(*) AS n FROM sh GROUP BY u), p AS (SELECT a.u AS user_1, b.u AS user_2, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.u < b.u GROUP BY 1, 2),
  j AS (SELECT user_1, user_2, c / (m.n + o.n - c) AS jaccard FROM p JOIN n m ON m.u = user_1 JOIN n o ON o.u = user_2 WHERE c / (m.n + o.n - c) >= 0.65) """


@query()
def sim1_4_lsh_candidates(s, d):
    """Every candidate of the four views as classes: members (kind 'user') and pairs of classes that meet (kind 'pair')."""
    out, users = None, materialise(_short_users(s, d), "usernames")
    for view in similarity.VIEWS:
        members, met = similarity.candidate_classes(users, view)
        part = members.select(F.lit(view).alias("view"), F.lit("user").alias("kind"), F.col("rep").alias("left"), F.col("user").alias("right"))
        part = part.unionByName(met.select(F.lit(view).alias("view"), F.lit("pair").alias("kind"), F.col("rep_1").alias("left"), F.col("rep_2").alias("right")))
        out = part if out is None else out.unionByName(part)
    return out


@query()
def sim5_6_refined_pairs(s, d):
    """All refined pairs, reported by their first user: how many, their mean, and the nearest."""
    pairs = similarity.similar_pairs(_short_users(s, d))
    best = F.max(F.struct("similarity", F.col("user_2").alias("user")))
    return pairs.groupBy("user_1").agg(F.count("*").alias("n"), F.round(F.avg("similarity"), 9).alias("mean"), best["user"].alias("nearest"))


_STAGES: dict[tuple[str, str], similarity.Similarity] = {}


def _stage(s, d):
    """The stage's frames; its pairs are written once per session and input."""
    key = (s.sparkContext.applicationId, d)
    if key not in _STAGES:
        _STAGES[key] = similarity.username_similarity(_users(s, d))
    return _STAGES[key]


@query()
def sim7_8_cluster_summary(s, d):
    return similarity.sorted_summary(_stage(s, d).cluster_summary)


@query()
def sim13_14_username_similarity(s, d):
    """The whole stage: its columns for every application."""
    return _stage(s, d).rows


@query()
def sim10_cluster_links(s, d):
    return _stage(s, d).cluster_links


@query(_PAIRS + "SELECT user_1, user_2, round(jaccard, 9) AS jaccard FROM j")
def sim4_exact_candidates(s, d):
    return similarity.exact_candidates(_short_users(s, d)).withColumn("jaccard", F.round("jaccard", 9))


@query(_PAIRS + """, k AS (SELECT user_1, user_2, regexp_replace(regexp_replace(user_1, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS s1, regexp_replace(regexp_replace(user_2, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS s2 FROM j)
  SELECT user_1, user_2, round(1 - damerau_levenshtein(user_1, user_2) / greatest(length(user_1), length(user_2)), 9) AS damerau, round(1 - damerau_levenshtein(s1, s2) / greatest(length(s1), length(s2)), 9) AS damerau_sep,
  round(jaro_winkler_similarity(user_1, user_2), 9) AS jaro_winkler FROM k""")
def sim5_kernels(s, d):
    p = similarity.exact_candidates(_short_users(s, d))
    one, two = F.col("user_1"), F.col("user_2")
    return p.select(one, two, F.round(similarity.damerau_column(one, two), 9).alias("damerau"), F.round(similarity.damerau_column(text.sep_norm(one), text.sep_norm(two)), 9).alias("damerau_sep"), F.round(similarity.jaro_winkler_column(one, two), 9).alias("jaro_winkler"))


#: Links of suppliers to their nations, weighted by account balance: components are known without recursion.
_STAR = """WITH b AS (SELECT lower(s_name) AS s, lower(n_name) AS n, (s_acctbal - lo) / (hi - lo) AS w FROM supplier JOIN nation ON s_nationkey = n_nationkey, (SELECT min(s_acctbal) AS lo, max(s_acctbal) AS hi FROM supplier)),
  p AS (SELECT least(s, n) AS user_1, greatest(s, n) AS user_2, n AS hub, w AS similarity FROM b), u AS (SELECT lower(s_name) AS u FROM supplier UNION SELECT lower(n_name) FROM nation),
  e AS (SELECT * FROM p WHERE similarity >= 0.7), x AS (SELECT user_1 AS u, hub, similarity AS w FROM e UNION ALL SELECT user_2, hub, similarity FROM e),
  f AS (SELECT u, hub, sum(w) AS sum, avg(w) AS mean, count(*) AS n FROM x GROUP BY u, hub),
  c AS (SELECT hub, row_number() OVER (ORDER BY size DESC, round(avg_similarity, 9) DESC, root) AS cluster_id, size, avg_similarity FROM (SELECT hub, count(*) AS size, min(u) AS root, sum(sum) / sum(n) AS avg_similarity FROM f GROUP BY hub)),
  m AS (SELECT u.u, coalesce(c.cluster_id, -1) AS cluster_id FROM u LEFT JOIN f ON f.u = u.u LEFT JOIN c ON c.hub = f.hub),
  g AS (SELECT *, row_number() OVER (PARTITION BY hub ORDER BY round(sum, 9) DESC, u) AS r FROM f) """


def _star(s, d):
    b = numeric.normalise(_table(s, d, "supplier"), "s_acctbal").join(_table(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    one, two = F.lower("s_name"), F.lower("n_name")
    pairs = b.select(F.least(one, two).alias("user_1"), F.greatest(one, two).alias("user_2"), F.lit(0.0).alias("jaccard_raw_view"), F.col("s_acctbal").alias("similarity"))
    users = _table(s, d, "supplier").select(F.col("s_name").alias("email_username")).unionByName(_table(s, d, "nation").select(F.col("n_name").alias("email_username")))
    clusters, summary = similarity.extract_clusters(pairs, similarity.usernames(users))
    return pairs, clusters, summary


@query(_STAR + """SELECT c.cluster_id, c.size, g.u AS medoid_username, regexp_replace(regexp_replace(regexp_replace(g.u, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '[0-9]+', '0', 'g') AS canonical_label, round(avg_similarity, 9) AS avg_similarity,
  round(g.sum, 9) AS centroid_sum_similarity, round(g.mean, 9) AS centroid_mean_similarity, g.n AS centroid_neighbor_count FROM c JOIN g ON g.hub = c.hub AND g.r = 1
  UNION ALL SELECT -1, count(*), '', '__isolates__', 0, 0, 0, 0 FROM m WHERE cluster_id = -1 HAVING count(*) > 0""")
def sim8_star_summary(s, d):
    summary = _star(s, d)[2]
    return summary.withColumns({c: F.round(c, 9) for c in ("avg_similarity", "centroid_sum_similarity", "centroid_mean_similarity")})


@query(_STAR + "SELECT u AS email_username, cluster_id FROM m")
def jn10_user_clusters(s, d):
    return _star(s, d)[1]


@query(_STAR + """SELECT user_1, user_2, a.cluster_id AS cluster_id_1, b.cluster_id AS cluster_id_2, CAST(a.cluster_id = b.cluster_id AND a.cluster_id <> -1 AS INT) AS same_cluster,
  CASE WHEN a.cluster_id = b.cluster_id THEN a.cluster_id ELSE -1 END AS pair_cluster_id, 0.0::DOUBLE AS jaccard_raw_view, similarity FROM p JOIN m a ON a.u = user_1 JOIN m b ON b.u = user_2""")
def sim12_annotated_pairs(s, d):
    pairs, clusters, _ = _star(s, d)
    return similarity.annotate_pairs(pairs, clusters)


@query(_STAR + "SELECT u AS email_username, round(sum, 9) AS username_similarity_score, round(mean, 9) AS username_similarity_mean_score, n AS similarity_neighbors_count, CAST(n > 2 AS INT) AS too_many_similar_usernames_flag FROM f")
def sim11_user_features(s, d):
    pairs, clusters, _ = _star(s, d)
    found = similarity.user_features(similarity.annotate_pairs(pairs, clusters))
    return found.withColumns({c: F.round(c, 9) for c in ("username_similarity_score", "username_similarity_mean_score")})


@query(_STAR + "SELECT u AS email_username, round(sum, 9) AS username_similarity_score, n AS similarity_neighbors_count FROM f ORDER BY sum DESC, n DESC, u LIMIT 20")
def srt4_display_sorted(s, d):
    pairs, clusters, _ = _star(s, d)
    found = similarity.display_sorted(similarity.user_features(similarity.annotate_pairs(pairs, clusters)))
    return found.select("email_username", F.round("username_similarity_score", 9).alias("username_similarity_score"), "similarity_neighbors_count")


@query(_STAR + "SELECT user_1, user_2, similarity FROM p WHERE similarity >= 0.5")
def flt4_strong_pairs(s, d):
    return similarity.strong_pairs(_star(s, d)[0]).select("user_1", "user_2", "similarity")


_LEGACY = """WITH u AS (SELECT lower(n_name) AS u FROM nation UNION SELECT lower(r_name) FROM region), p AS (SELECT a.u AS user_1, b.u AS user_2, 1 - damerau_levenshtein(a.u, b.u) / greatest(length(a.u), length(b.u)) AS similarity FROM u a, u b),
  q AS (SELECT * FROM p WHERE similarity BETWEEN 0.1 AND 0.9), t AS (SELECT user_1 AS u, sum(similarity) AS total FROM q GROUP BY 1) """


def _names(s, d):
    names = _table(s, d, "nation").select(F.col("n_name").alias("email_username"))
    return names.unionByName(_table(s, d, "region").select(F.col("r_name").alias("email_username")))


@query(_LEGACY + "SELECT user_1, user_2, round(similarity, 9) AS similarity FROM q")
def sim16_legacy_pairs(s, d):
    return similarity.legacy_matrix(_names(s, d))[1].withColumn("similarity", F.round("similarity", 9))


@query(_LEGACY + "SELECT upper(u.u) AS email_username, round(total, 9) AS username_similarity_score FROM u LEFT JOIN t ON t.u = u.u")
def agg11_legacy_sums(s, d):
    return similarity.legacy_matrix(_names(s, d))[0].withColumn("username_similarity_score", F.round("username_similarity_score", 9))


@query(_LEGACY + "SELECT upper(u.u) AS email_username, round((total - min(total) OVER ()) / (max(total) OVER () - min(total) OVER ()), 9) AS username_similarity_score FROM u LEFT JOIN t ON t.u = u.u")
def sim17_scaled_sums(s, d):
    return similarity.legacy_matrix(_names(s, d), scaled=True)[0].withColumn("username_similarity_score", F.round("username_similarity_score", 9))


@query("""WITH x AS (SELECT c_nationkey, 'a' || CAST(c_custkey AS VARCHAR) AS node FROM customer), n AS (SELECT c_nationkey, min(node) AS root, count(*) AS n FROM x GROUP BY 1) SELECT node, root FROM x JOIN n USING (c_nationkey) WHERE n > 1""")
def sim7_components(s, d):
    """Customers of a nation as one chain in order of their keys."""
    name = F.concat(F.lit("a"), F.col("c_custkey").cast("string"))
    before = F.lag(name).over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    e = _table(s, d, "customer").select(before.alias("a"), name.alias("b")).where("a IS NOT NULL")
    return similarity.components(e, "a", "b")


@query("SELECT o_custkey AS user_1, o_orderkey AS user_2, o_totalprice AS similarity FROM orders ORDER BY o_totalprice DESC, o_custkey, o_orderkey LIMIT 20")
def srt1_top_pairs(s, d):
    o = _table(s, d, "orders").select(F.col("o_custkey").alias("user_1"), F.col("o_orderkey").alias("user_2"), F.col("o_totalprice").alias("similarity"))
    return similarity.top_pairs(o)


def _wide(s, d):
    df = _table(s, d, "lineitem").withColumn("l_net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return df.select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_net")


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS name, count(DISTINCT {c}) AS n FROM lineitem" for c in ("l_returnflag", "l_linestatus", "l_discount", "l_shipdate")) + ")")
def agg17_distinct_profile(s, d):
    found = pruning.distinct_counts(_table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_discount", "l_shipdate"))
    return s.createDataFrame(list(found.items()), "name string, n long")


def _corr_sql() -> str:
    cols = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_net")
    parts = [f"SELECT '{a}' AS c1, '{b}' AS c2, round(corr({a}, {b}), 6) AS r FROM (SELECT *, l_extendedprice * (1 - l_discount) AS l_net FROM lineitem)" for i, a in enumerate(cols) for b in cols[i + 1 :]]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE abs(r) > 0.5"


@query(_corr_sql())
def fe2_correlated_pairs(s, d):
    return s.createDataFrame(pruning.correlated(_wide(s, d), 0.5), "c1 string, c2 string, r double").withColumn("r", F.round("r", 6))


@query("SELECT CASE WHEN var_samp(l_extendedprice) < var_samp(n) THEN 'l_extendedprice' ELSE 'l_net' END AS dropped FROM (SELECT *, l_extendedprice * (1 - l_discount) AS n FROM lineitem)")
def fe3_dropped_columns(s, d):
    df = _wide(s, d)
    return s.createDataFrame([(c,) for c in pruning.least_informative(df, pruning.correlated(df, 0.5), ())], "dropped string")


@query("SELECT 'flag' AS name WHERE (SELECT max(n) / sum(n) > 0.9 FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey % 100 = 0))")
def fe4_imbalanced(s, d):
    df = _table(s, d, "lineitem").select((F.col("l_orderkey") % 100 == 0).alias("flag"), "l_returnflag")
    return s.createDataFrame([(c,) for c in pruning.imbalanced(df)], "name string")


@query("SELECT 'keep' AS name UNION ALL SELECT 'empty'")
def fe1_drop_unique(s, d):
    df = _table(s, d, "region").select(F.col("r_regionkey").alias("keep"), F.lit(1).alias("one"), F.lit(None).cast("string").alias("empty"))
    return s.createDataFrame([(c,) for c in pruning.drop_unique(df).columns], "name string")


_SKEW_SRC = "(SELECT o_orderkey AS k, o_totalprice * o_totalprice * o_totalprice * o_totalprice * o_totalprice * o_totalprice / 1e30 AS a, o_orderkey % 7 AS b FROM orders)"


@query(f"SELECT k, CASE WHEN s > 0.8 THEN ln(1 + a) ELSE a END AS a, CAST(b AS DOUBLE) AS b FROM {_SKEW_SRC}, (SELECT abs((avg(a) - median(a)) / stddev_samp(a)) AS s FROM {_SKEW_SRC})")
def fe6_reduce_skew(s, d):
    p = F.col("o_totalprice")
    df = _table(s, d, "orders").select(F.col("o_orderkey").alias("k"), (p * p * p * p * p * p / F.lit(1e30)).alias("a"), (F.col("o_orderkey") % 7).alias("b"))
    return pruning.reduce_skew(df, exclude=("k", "b")).select("k", "a", F.col("b").cast("double").alias("b"))


@query("SELECT c_custkey AS app_id, (c_acctbal - lo) / (hi - lo) AS c_acctbal_scaled, CAST(7 AS DOUBLE) AS seven_scaled FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)")
def fe7_min_max_scale(s, d):
    c = _table(s, d, "customer").select(F.col("c_custkey").alias("app_id"), "c_acctbal", F.lit(7).alias("seven"))
    return pruning.min_max_scale(c).select("app_id", "c_acctbal_scaled", "seven_scaled")


@query("""WITH q AS (SELECT quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8]) AS e FROM customer)
  SELECT c_custkey, CASE WHEN c_acctbal <= e[1] THEN 1 WHEN c_acctbal <= e[2] THEN 2 WHEN c_acctbal <= e[3] THEN 3 WHEN c_acctbal <= e[4] THEN 4 ELSE 5 END AS bal_cluster, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS two_cluster, 1 AS one_cluster FROM customer, q""")
def cl1_quantile_clusters(s, d):
    c = _table(s, d, "customer").select("c_custkey", F.col("c_acctbal").alias("bal_scaled"), (F.col("c_custkey") % 2).alias("two_scaled"), F.lit(3).alias("one_scaled"))
    return clustering.quantile_clusters(c).select("c_custkey", "bal_cluster", "two_cluster", "one_cluster")


@query("""WITH m AS (SELECT c_mktsegment AS l, row_number() OVER (ORDER BY avg(c_acctbal)) - 1 AS r FROM customer GROUP BY 1) SELECT c_custkey, CAST(r AS BIGINT) AS label FROM customer JOIN m ON m.l = c_mktsegment""")
def cl2_relabel_by_mean(s, d):
    c = _table(s, d, "customer").select("c_custkey", "c_acctbal", F.col("c_mktsegment").alias("label"))
    return clustering.relabel_by_mean(c, "c_acctbal", "label").select("c_custkey", "label")


@query("SELECT 'binary' AS kind, 'flag' AS name UNION ALL SELECT 'numerical', 'c_acctbal' UNION ALL SELECT 'numerical', 'c_custkey' UNION ALL SELECT 'numerical', 'one'")
def cl3_group_features(s, d):
    c = _table(s, d, "customer").select("c_custkey", "c_acctbal", (F.col("c_custkey") % 2).cast("int").alias("flag"), F.lit(1).alias("one"))
    numerical, binary = clustering.group_features(c)
    return s.createDataFrame([("numerical", x) for x in numerical] + [("binary", x) for x in binary], "kind string, name string")


def _modal(s, d):
    o = _table(s, d, "orders")
    return o.select("o_orderkey", F.sqrt(F.col("o_totalprice")).alias("uni"), (F.col("o_totalprice") / 100_000 + F.when(F.col("o_orderkey") % 3 == 0, 40.0).when(F.col("o_orderkey") % 3 == 1, 20.0).otherwise(0.0)).alias("multi"))


#: Peaks: runs of equal bins higher than both neighbours, of at least 0.8 of the mean bin.
_MODAL_SQL = """WITH x AS (SELECT o_orderkey, sqrt(o_totalprice) AS uni, o_totalprice / 100000 + CASE o_orderkey % 3 WHEN 0 THEN 40.0 WHEN 1 THEN 20.0 ELSE 0.0 END AS multi FROM orders),
  t AS (SELECT 'uni' AS f, CAST(uni AS DOUBLE) AS v FROM x UNION ALL SELECT 'multi', CAST(multi AS DOUBLE) FROM x), e AS (SELECT f, min(v) AS lo, max(v) AS hi, count(v) AS n FROM t GROUP BY f),
  h AS (SELECT f, CAST(least(floor((v - lo) / ((hi - lo) / 30)), 29) AS INT) AS b, count(*) AS c FROM t JOIN e USING (f) WHERE v IS NOT NULL GROUP BY ALL),
  g AS (SELECT e.f, i AS b, coalesce(h.c, 0) AS c FROM e CROSS JOIN range(30) AS s(i) LEFT JOIN h ON h.f = e.f AND h.b = i), r AS (SELECT f, b, c FROM g QUALIFY c IS DISTINCT FROM lag(c) OVER (PARTITION BY f ORDER BY b)),
  p AS (SELECT f, c, lag(c) OVER w AS before, lead(c) OVER w AS after FROM r WINDOW w AS (PARTITION BY f ORDER BY b)), k AS (SELECT f, count(*) AS peaks FROM p JOIN e USING (f) WHERE before < c AND after < c AND c >= 0.8 * n / 30 GROUP BY f)
  SELECT f AS feature, CASE WHEN n < 10 THEN 'insufficient_data' WHEN peaks >= 2 THEN 'multimodal' ELSE 'unimodal' END AS modality FROM e LEFT JOIN k USING (f)"""


@query(_MODAL_SQL)
def cl4_5_modality(s, d):
    return s.createDataFrame(list(clustering.modality(_modal(s, d), ["uni", "multi"]).items()), "feature string, modality string")


@query("SELECT c_custkey, CAST(CASE WHEN z <= 0 THEN 0 WHEN z <= 1 THEN 1 WHEN z <= 2 THEN 2 ELSE 3 END AS BIGINT) AS label FROM (SELECT c_custkey, (c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER () AS z FROM customer)")
def cl6_z_labels(s, d):
    c = _table(s, d, "customer")
    mu, sd = c.agg(F.avg("c_acctbal"), F.stddev_pop("c_acctbal")).first()
    return c.select("c_custkey", clustering.z_labels(F.col("c_acctbal"), mu, sd).alias("label"))


@query("SELECT o_orderkey, CAST(CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS BIGINT) AS multi_cluster FROM orders")
def cl7_8_mixture_clusters(s, d):
    df = _modal(s, d)
    return clustering.by_modality(df, ["multi"], {"multi": "multimodal"}).select("o_orderkey", "multi_cluster")


@query()
def cl10_11_graph_clusters(s, d):
    a = features.fingerprint_features(features.country_mismatch(_apps(s, d)))
    a = a.withColumn("odd", (F.col("app_id") % 2).cast("int"))
    return clustering.graph_clusters(a.select("app_id", "country_mismatch", "ip_suspicious", "odd"), ["country_mismatch", "ip_suspicious", "odd"], order="app_id").select("app_id", "graph_cluster")


#: A small scoring input: labels derived from keys.
_LABELS = "SELECT o_orderkey AS app_id, o_orderkey % 4 AS username_digit_count_cluster, o_orderkey % 3 AS username_special_count_cluster, o_custkey % 4 AS username_entropy_cluster, o_custkey % 5 AS inv_semantic_score_cluster, o_orderkey % 5 AS domain_freq_cluster, o_custkey % 2 AS browser_suspicious_cluster FROM {orders}"
_SCORED = f"""WITH l AS ({_LABELS.format(orders="orders")}), b AS (SELECT *, 0.1::DOUBLE * username_digit_count_cluster / 3 AS c1, 0.1::DOUBLE * username_special_count_cluster / 2 AS c2, 0.15::DOUBLE * username_entropy_cluster / 3 AS c3,
  0.25::DOUBLE * inv_semantic_score_cluster / 4 AS c4, 0.2::DOUBLE * (1 - domain_freq_cluster / 4) AS c5, 0.2::DOUBLE * browser_suspicious_cluster AS c6 FROM l),
  s AS (SELECT *, least(1, c1 + c2 + c3 + c4 + c5 + c6 + CASE WHEN browser_suspicious_cluster = 1 THEN 0.3 ELSE 0 END::DOUBLE + CASE WHEN inv_semantic_score_cluster >= 3 THEN 0.2 ELSE 0 END::DOUBLE) AS score FROM b),
  t AS (SELECT *, CASE WHEN score <= 0.3 + 1e-12 THEN 'Low' WHEN score <= 0.6 + 1e-12 THEN 'Moderate' WHEN score <= 0.8 + 1e-12 THEN 'High' ELSE 'Critical' END AS tier FROM s) """


def _scored(s, d):
    return scoring.score(s.sql(_LABELS, orders=_table(s, d, "orders")))


@query(_SCORED + "SELECT app_id, round(round(score, 9) * 20) AS fraud_score_20 FROM t")
def sc1_3_scores(s, d):
    df, base = scoring.base_score(s.sql(_LABELS, orders=_table(s, d, "orders")))
    return df.select("app_id", F.round(F.round(scoring.boosted(df, base), 9) * 20).alias("fraud_score_20"))


@query("SELECT o_orderkey AS app_id, CASE WHEN x <= 0.3 THEN 'Low' WHEN x <= 0.6 THEN 'Moderate' WHEN x <= 0.8 THEN 'High' WHEN x <= 1 THEN 'Critical' END AS tier FROM (SELECT o_orderkey, (o_totalprice - lo) / (hi - lo) AS x FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders))")
def sc4_risk_tiers(s, d):
    o = numeric.normalise(_table(s, d, "orders"), "o_totalprice")
    return o.select(F.col("o_orderkey").alias("app_id"), scoring.risk_tier(F.col("o_totalprice")).alias("tier"))


@query("SELECT t.tier, count(x.k) AS count FROM (VALUES ('Low'), ('Moderate'), ('High'), ('Critical')) t(tier) LEFT JOIN (SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'High' ELSE 'Critical' END AS tier FROM orders) x USING (tier) GROUP BY 1")
def agg13_tier_summary(s, d):
    k = F.col("o_orderkey") % 3
    return scoring.tier_summary(_table(s, d, "orders").select(F.when(k == 0, "Low").when(k == 1, "High").otherwise("Critical").alias("fraud_risk_tier")))


@query(_SCORED + "SELECT app_id, " + ", ".join(f"round(c{i} / {w}, 3) AS {f}_risk_contrib" for i, (f, w) in enumerate(scoring.WEIGHTS.items(), 1)) + " FROM b")
def sc2_contributions(s, d):
    df, _ = scoring.base_score(s.sql(_LABELS, orders=_table(s, d, "orders")))
    return df.select("app_id", *[f"{f}_risk_contrib" for f in scoring.WEIGHTS])


@query(_SCORED + "SELECT feature, weight, round(avg(c), 3) AS avg_contribution, round(avg(c) * weight, 3) AS weighted_importance FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, {w}::DOUBLE AS weight, round(c{i} / {w}, 3) AS c FROM b" for i, (f, w) in enumerate(scoring.WEIGHTS.items(), 1)) + ") GROUP BY 1, 2")
def agg14_feature_importance(s, d):
    return scoring.feature_importance(_scored(s, d))


@query("SELECT 'x' AS feature, c_custkey % 4 AS cluster_label, count(c_acctbal) AS count, round(avg(c_acctbal), 3) AS mean, round(stddev_samp(c_acctbal), 3) AS std FROM customer GROUP BY 2")
def agg12_cluster_report(s, d):
    c = _table(s, d, "customer").select(F.col("c_acctbal").alias("x"), (F.col("c_custkey") % 4).alias("x_cluster"))
    return scoring.cluster_report(c)


@query("SELECT c_custkey % 3 AS graph_cluster, count(*) AS size, round(avg(CAST(c_custkey % 2 AS DOUBLE)) * 100, 2) AS odd FROM customer GROUP BY 1")
def agg15_binary_summary(s, d):
    c = _table(s, d, "customer").select((F.col("c_custkey") % 3).alias("graph_cluster"), (F.col("c_custkey") % 2).cast("int").alias("odd"))
    return scoring.binary_summary(c, ["odd"]).drop("tags")


@query("SELECT c_mktsegment AS label, avg(c_acctbal) AS mean FROM customer GROUP BY 1")
def agg16_cluster_means(s, d):
    return scoring.cluster_means(_table(s, d, "customer").withColumnRenamed("c_mktsegment", "label"), "c_acctbal", "label")


@query(_STAR + "SELECT u AS email_username FROM m WHERE cluster_id = -1")
def jn11_isolates(s, d):
    return _star(s, d)[1].where("cluster_id = -1").select("email_username")


@query("SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, nullif(o_orderpriority, '1-URGENT') AS o_orderpriority FROM orders")
def snk2_saved_table(s, d):
    """A run's rows written to a warehouse table and read back."""
    o = _table(s, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), F.when(F.col("o_orderpriority") == "1-URGENT", "None").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    return s.table(tables.save_table(o, "riskloom", uuid.uuid4().hex[:8]))


@query(_SCORED + "SELECT app_id, round(c5 / 0.2, 3) AS domain_freq_risk_contrib, round(c2 / 0.1, 3) AS username_special_count_risk_contrib, domain_freq_cluster FROM t")
def snk3_score_file(s, d):
    """The score file written as CSV and read back."""
    path = tables.save_csv(tables.score_export(_scored(s, d)), scratch_path(s, "scores"))
    return tables.load_checkpoint(s, path).select(F.col("app_id").cast("long").alias("app_id"), "domain_freq_risk_contrib", "username_special_count_risk_contrib", F.col("domain_freq_cluster").cast("long").alias("domain_freq_cluster"))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def snk1_checkpoint(s, d):
    """SNK1, SRC7: a CSV checkpoint written and read back with inferred types."""
    path = tables.save_checkpoint(_table(s, d, "customer").select("c_custkey", "c_name", "c_nationkey"), scratch_path(s, "checkpoints"), "customers")
    return tables.load_checkpoint(s, path).select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"))


@query("SELECT r_name, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def src4_run_query(s, d):
    _table(s, d, "region").createOrReplaceTempView("riskloom_region")
    _table(s, d, "nation").createOrReplaceTempView("riskloom_nation")
    rows, columns = tables.run_query(s, "SELECT r_name, count(*) AS n FROM riskloom_region JOIN riskloom_nation ON n_regionkey = r_regionkey GROUP BY r_name")
    return s.createDataFrame(rows, columns)


@query("SELECT n_nationkey, n_name FROM nation")
def prj5_prune(s, d):
    n = _table(s, d, "nation").select("n_nationkey", "n_name", F.lit("x").alias("isocode"), F.lit("y").alias("email_tld"))
    return prepare.optimize_dtypes(prepare.prune(n))


@query("SELECT o_orderkey, o_custkey FROM orders")
def fe5_drop_columns(s, d):
    return pruning.drop_columns(_table(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_totalprice", "absent"])


@query()
def sc5_pipeline_scores(s, d):
    return flagship(s, d)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over the applications: scores and tiers."""
    from riskloom.plans.pipeline import run_pipeline

    a = _apps(spark, sf_dir).withColumn("app_id", F.col("app_id").cast("string"))
    run = run_pipeline(a, scores_only=True)
    return run.scored.select("app_id", "fraud_score", "fraud_risk_tier")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
