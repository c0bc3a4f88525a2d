import random
import re
import unicodedata
from collections import defaultdict
from itertools import combinations

import numpy as np
import plain_kernels as plain
import pytest
from pyspark.sql import functions as F

from riskloom import queries as own
from riskloom.functions import text
from riskloom.operators import kernels, similarity

SF = "/root/testdata/sf0.001"


def brute(users, views):
    """All pairs that share a bucket of a view, over plain rows."""
    out = set()
    for view in views:
        buckets = defaultdict(set)
        for r in similarity.view_index(users, view).collect():
            buckets[r["band"], r["hash"]].add(r["user"])
        for found in buckets.values():
            out |= set(combinations(sorted(found), 2))
    return out


def as_pairs(df):
    rows = [(r["user_1"], r["user_2"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("max_bucket", [3, 1_000])
def test_hot_buckets(spark, max_bucket):
    """Buckets of any size are joined whole, also users of other lengths and first letters."""
    names = [f"{a}maria.lopez{n}" for a in ("", "x", "qu") for n in ("", 1, 22, 333)] + ["maria_lopez", "m4ria.l0pez", "a", "ab"]
    users = spark.createDataFrame([(n,) for n in names], "user string")
    got = as_pairs(similarity.candidates(users, max_bucket=max_bucket))
    assert got == brute(users, tuple(similarity.VIEWS))
    assert ("maria.lopez1", "maria.lopez22") in got and ("maria.lopez22", "xmaria.lopez22") in got


@pytest.mark.parametrize("tile", [3, 512])
def test_similar_pairs(spark, tmp_path, tile):
    """All four views, classes compared in tiles: the pairs, similarities and Jaccard estimates of a plain version."""
    for t in ("orders", "customer", "nation", "part"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        (df.orderBy("o_orderkey").limit(60) if t == "orders" else df).write.parquet(f"{tmp_path}/{t}.parquet")
    odd = spark.createDataFrame([("",), ("...",), ("---",), ("a",), ("m4ria lopez maria",), ("maria  lopez",)], "user string")
    users = own._short_users(spark, str(tmp_path)).unionByName(odd)
    facts = {r["user"]: r for r in similarity.raw_signatures(users).select("user", text.sep_norm(F.col("user")).alias("s"), text.deleet_norm(F.col("user")).alias("d"), text.letters_only(F.col("user")).alias("l"), text.tokens_for_ratio(F.col("user")).alias("t"), F.col("signature").alias("g")).collect()}
    want = {}
    for a, b in brute(users.where("user <> ''"), tuple(similarity.VIEWS)):
        x, y = facts[a], facts[b]
        best = max(plain.damerau_similarity(a, b), plain.damerau_similarity(x["s"], y["s"]), plain.damerau_similarity(x["d"], y["d"]), plain.jaro_winkler(a, b), plain.token_set_ratio(x["t"], y["t"]))
        best = min(1.0, best + 0.05 * bool(x["l"] and y["l"] and plain.damerau_similarity(x["l"], y["l"]) >= 0.90))
        if best >= 0.7:
            want[a, b] = (round(best, 9), sum(p == q for p, q in zip(x["g"], y["g"], strict=True)) / 128)
    found = similarity.similar_pairs(users, tile=tile).collect()
    assert {(r["user_1"], r["user_2"]): (round(r["similarity"], 9), r["jaccard_raw_view"]) for r in found} == want and len(found) == len(want) > 50
    rows = own.queries()["sim1_4_lsh_candidates"](spark, str(tmp_path)).collect()
    known = own._short_users(spark, str(tmp_path))
    member = {(r["view"], r["right"]): r["left"] for r in rows if r["kind"] == "user"}
    met = {(r["view"], r["left"], r["right"]) for r in rows if r["kind"] == "pair"}
    names = sorted({u for _, u in member})
    proposed = {(a, b) for a, b in combinations(names, 2) for v in similarity.VIEWS if (v, *sorted((member[v, a], member[v, b]))) in met}
    assert proposed == brute(known, tuple(similarity.VIEWS))


def test_kernels_on_random_strings():
    r = random.Random(3)
    words = ["".join(r.choice("abc1_ ") for _ in range(r.randint(0, 9))) + r.choice(["", " abc", "xy" * 40]) for _ in range(150)]
    i, j = (np.array([r.randrange(150) for _ in range(3000)]) for _ in range(2))
    coded = kernels.Coded(words)
    for f, g in ((kernels.damerau, plain.damerau_similarity), (kernels.jaro_winkler, plain.jaro_winkler), (kernels.indel, plain._indel)):
        assert np.allclose(f(coded, i, j), [g(words[a], words[b]) for a, b in zip(i, j, strict=True)], atol=1e-12)
    assert np.allclose(kernels.token_set(words, i, j), [plain.token_set_ratio(words[a], words[b]) for a, b in zip(i, j, strict=True)], atol=1e-12)
    assert (kernels.common_bound(coded, i, j) >= kernels.damerau(coded, i, j) - 1e-12).all()


def test_cleaned_names(spark):
    """All code points against the plain definition."""
    names = [f"A{chr(c)}b {chr(c)}" for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c > 0xF900)]
    want = {n: re.sub(r"[^a-z\s]", "", unicodedata.normalize("NFKD", n.lower()).encode("ascii", "ignore").decode()) for n in names if not unicodedata.name(n[1], "").startswith("<")}
    got = spark.createDataFrame([(n,) for n in want], "n string").select("n", text.clean_names(F.col("n")).alias("c")).collect()
    assert [r for r in got if r["c"] != want[r["n"]] and r["n"][1].lower() == r["n"][1]] == []


def test_long_chain_and_hot_node(spark):
    """A chain of 300 nodes and a star of 500 against a union-find."""
    edges = [(f"c{i:04}", f"c{i + 1:04}") for i in range(300)] + [("m", f"s{i}") for i in range(500)]
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = similarity.components(spark.createDataFrame(edges, "user_1 string, user_2 string"))
    assert {r["node"]: r["root"] for r in got.collect()} == {x: root(x) for x in list(parent)}


def test_scores_by_distinct_proposals(spark, monkeypatch):
    """What blocks of shapes compare is compared nowhere else: no pair of one shape is scored row by row."""
    names = [f"{a}{b}{n}" for a in ("anna", "bert") for b in (".", "_") for n in range(40)]
    users, met = spark.createDataFrame([(n,) for n in names], "user string"), []
    whole = similarity.refine
    monkeypatch.setattr(similarity, "refine", lambda pairs, least: whole(met.append(pairs.collect()) or pairs, least))
    found = as_pairs(similarity.similar_pairs(users))
    assert met == [[]] and ("anna.1", "anna_12") in found and ("anna.1", "bert.1") not in found


def test_combined_above_least():
    """Scores at or above ``least`` are those without it, others stay below; bit masks give way beyond 64 characters."""
    r = random.Random(4)
    words = ["".join(r.choice("abc1_. ") for _ in range(r.randint(0, 9))) + r.choice(["", "", " abc", "xy" * 40]) for _ in range(120)] + ["", "  "]
    sep = [re.sub("^_+|_+$", "", re.sub("[^a-z0-9]+", "_", w)) for w in words]
    views = {"norm": words, "sep": sep, "deleet": [w.replace("1", "i") for w in words], "letters": [re.sub("[^a-z]", "", w) for w in words], "tokens": [w.replace("_", " ") for w in sep]}
    i, j = np.triu_indices(len(words), 1)
    full, cut = kernels.combined(views, i, j), kernels.combined(views, i, j, 0.7)
    assert (np.where(full >= 0.7, full, -1) == np.where(cut >= 0.7, cut, -1)).all() and 0.01 < (full >= 0.7).mean() < 0.5
    best = [max(*[plain.damerau_similarity(views[v][a], views[v][b]) for v in ("norm", "sep", "deleet")], plain.jaro_winkler(words[a], words[b]), plain.token_set_ratio(views["tokens"][a], views["tokens"][b])) for a, b in zip(i, j, strict=True)]
    lift = [bool(x and y and plain.damerau_similarity(x, y) >= 0.9) for x, y in ((views["letters"][a], views["letters"][b]) for a, b in zip(i, j, strict=True))]
    assert np.allclose(full, [min(1.0, b + 0.05 * u) for b, u in zip(best, lift, strict=True)], atol=1e-12)


def test_spanning(spark, monkeypatch):
    """Per partition fewer edges than nodes, also where forests are dropped, and the same components."""
    edges = spark.range(0, 2_000, 1, 2).selectExpr("CAST(id % 40 AS STRING) AS u", "CAST(id * 7 % 40 + 40 AS STRING) AS v")
    kept = similarity.spanning(edges)
    assert 0 < kept.count() <= 2 * 79
    parts = lambda df: {(r["node"], r["root"]) for r in similarity.components(df, "u", "v").collect()}
    want = parts(edges)
    monkeypatch.setattr(similarity, "FOREST", 3)
    assert parts(kept) == want == parts(edges)
