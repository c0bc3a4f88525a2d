"""Near-duplicate usernames: four views, MinHash banding, exact refinement, components and features.

Candidates come from band hashes of MinHash signatures, as rows (view, band, hash) joined on equality. A
band bucket that many usernames share (short shapes collapse to a handful of strings) is joined whole: users with
equal strings in a view are one class, and buckets of many classes are joined tile by tile. Kernels that Spark lacks (Damerau,
Jaro-Winkler, token sets) run once per distinct candidate pair, in one Arrow UDF.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import numeric, text
from riskloom.operators import kernels
from riskloom.operators.quantiles import numbered
from riskloom.sources.scratch import materialise

NUM_PERM = 128
#: Pairs of users that two classes make at most to be compared row by row.
SINGLY = 64
#: View thresholds, with bands and rows that minimise the mean of both error areas at 128 permutations.
VIEWS = {"raw": (0.65, (2, 3, 4)), "sep": (0.60, (2, 3, 4)), "shape": (0.85, (3,)), "deleet": (0.65, (2, 3, 4))}
TRANSFORMS = {"raw": text.norm, "sep": text.sep_norm, "shape": text.shape, "deleet": text.deleet_norm}


def lsh_parameters(threshold: float, num_perm: int = NUM_PERM) -> tuple[int, int]:
    """SIM2: (bands, rows) with the least sum of false-positive and false-negative area, by the midpoint rule."""
    best, out = float("inf"), (1, num_perm)
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            xs = [(i + 0.5) / 200 for i in range(200)]
            wrong = sum((1 - (1 - x**r) ** b) if x < threshold else (1 - x**r) ** b for x in xs)
            if wrong < best:
                best, out = wrong, (b, r)
    return out


def with_signature(df: DataFrame, shingles: Column, num_perm: int = NUM_PERM, out: str = "signature") -> DataFrame:
    """SIM1: add the least permuted hash of the shingles per permutation; no shingles: all-max, equal to one another."""
    rng = np.random.default_rng(1)
    odd = rng.integers(0, 1 << 63, num_perm, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    more = rng.integers(0, 1 << 63, num_perm, dtype=np.uint64) * np.uint64(2)

    def least(hashes: list[int]) -> np.ndarray:
        if not hashes:
            return np.full(num_perm, (1 << 63) - 1)
        return ((np.array(hashes, dtype=np.int64).view(np.uint64)[:, None] * odd + more).min(axis=0) >> np.uint64(1)).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [least(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            flat = pa.array(np.concatenate(found) if found else np.empty(0, dtype=np.int64))
            signs = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * num_perm), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], signs], names=[*batch.schema.names[:-1], out])

    hashed = df.select("*", F.transform(shingles, lambda s: F.xxhash64(s)).alias(out))
    return hashed.mapInArrow(run, hashed.schema)


def jaccard_estimate(a: Column, b: Column) -> Column:
    """SIM4: share of equal signature slots."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def exact_jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two shingle sets; two empty ones are 1."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both, F.size(F.array_union(a, b))), F.lit(1.0))


def usernames(df: DataFrame, column: str = "email_username") -> DataFrame:
    """SET7: distinct normalised usernames; the empty one stays, but has no candidates."""
    return df.select(text.norm(F.col(column)).alias("user")).distinct()


def view_index(users: DataFrame, view: str, num_perm: int = NUM_PERM, threshold: float | None = None) -> DataFrame:
    """SIM2, SIM3: (user, view, band, hash)."""
    default, sizes = VIEWS[view]
    bands, rows = lsh_parameters(threshold or default, num_perm)
    signed = with_signature(users, text.shingles(TRANSFORMS[view](F.col("user")), sizes), num_perm, "_s")
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(F.slice("_s", b * rows + 1, rows)))
    return signed.select("user", F.lit(view).alias("view"), F.posexplode(keys).alias("band", "hash"))


def exact_candidates(users: DataFrame, view: str = "raw", threshold: float | None = None) -> DataFrame:
    """Pairs u < v whose exact shingle Jaccard in a view reaches the threshold, by an inverted index of prefixes.

    Of two sets that are so similar, each has one of the other's shingles among its n - ceil(t n) + 1 rarest, so only those are
    joined, and what meets is verified on whole sets.
    """
    default, sizes = VIEWS[view]
    t = threshold or default
    each = users.select("user", F.explode(text.shingles(TRANSFORMS[view](F.col("user")), sizes)).alias("s"))
    rarity = each.groupBy(F.col("s").alias("_s")).agg(F.count("*").alias("df"))
    order = F.array_sort(F.collect_list(F.struct("df", "s")))
    sets = each.join(rarity, F.col("s") == F.col("_s")).groupBy("user").agg(F.transform(order, lambda x: x["s"]).alias("sh"))
    sets = materialise(sets.withColumn("n", F.size("sh")), "shingles")
    prefix = F.slice("sh", F.lit(1), (F.col("n") - F.ceil(F.col("n") * F.lit(t) - F.lit(1e-9)) + 1).cast("int"))
    rare = sets.select("user", "n", F.explode(prefix).alias("s"))
    a, b = rare.alias("a"), rare.alias("b")
    sizes_fit = (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * F.lit(t) - F.lit(1e-9)) & (F.col("a.user") < F.col("b.user"))
    met = a.join(b, (F.col("a.s") == F.col("b.s")) & sizes_fit).select(F.col("a.user").alias("user_1"), F.col("b.user").alias("user_2")).distinct()
    one, two = (sets.select(F.col("user").alias(f"user_{k}"), F.col("sh").alias(f"sh_{k}")) for k in (1, 2))
    both = met.join(one, "user_1").join(two, "user_2")
    return both.select("user_1", "user_2", exact_jaccard(F.col("sh_1"), F.col("sh_2")).alias("jaccard")).where(F.col("jaccard") >= t)


def candidate_classes(users: DataFrame, view: str, num_perm: int = NUM_PERM, max_bucket: int = 1_000) -> tuple[DataFrame, DataFrame]:
    """JN13: a view's classes as (rep, user), users with one string in the view, and the pairs (rep_1, rep_2) of
    classes that share a band bucket, each class with itself among them.

    That is every candidate pair of the view, without listing them. Buckets with over ``max_bucket`` classes are cut
    into tiles, and all pairs of tiles are joined. Empty usernames have no candidates.
    """
    named = users.where("user <> ''").select("user", TRANSFORMS[view](F.col("user")).alias("_v"))
    tops = materialise(named.groupBy("_v").agg(F.min("user").alias("rep")), "classes")
    met = _meetings(materialise(view_index(tops.select(F.col("rep").alias("user")), view, num_perm), "bands"), max_bucket)
    met = met.unionByName(tops.select(F.col("rep").alias("rep_1"), F.col("rep").alias("rep_2")))
    return named.join(tops, "_v").select("rep", "user"), met


def candidates(users: DataFrame, views: tuple[str, ...] = tuple(VIEWS), num_perm: int = NUM_PERM, max_bucket: int = 1_000) -> DataFrame:
    """SIM4, SET4: (user_1, user_2, jaccard_raw_view), every pair that shares a band bucket in one of the views."""
    pairs = None
    for view in views:
        members, met = candidate_classes(users, view, num_perm, max_bucket)
        one = members.select(F.col("rep").alias("rep_1"), F.col("user").alias("_x"))
        two = members.select(F.col("rep").alias("rep_2"), F.col("user").alias("_y"))
        part = met.join(one, "rep_1").join(two, "rep_2").where("rep_1 <> rep_2 OR _x < _y").select(F.least("_x", "_y").alias("user_1"), F.greatest("_x", "_y").alias("user_2"))
        pairs = part if pairs is None else pairs.unionByName(part)
    signed = raw_signatures(users.select("user"), num_perm).withColumnRenamed("signature", "_s")
    left = signed.select(F.col("user").alias("user_1"), F.col("_s").alias("_a"))
    right = signed.select(F.col("user").alias("user_2"), F.col("_s").alias("_c"))
    return pairs.distinct().join(left, "user_1").join(right, "user_2").select("user_1", "user_2", jaccard_estimate(F.col("_a"), F.col("_c")).alias("jaccard_raw_view"))


def raw_signatures(users: DataFrame, num_perm: int = NUM_PERM) -> DataFrame:
    return with_signature(users, text.shingles(F.col("user"), VIEWS["raw"][1]), num_perm)


def similar_pairs(users: DataFrame, min_sim: float = 0.70, views: tuple[str, ...] = tuple(VIEWS), num_perm: int = NUM_PERM, max_bucket: int = 1_000, tile: int = 512) -> DataFrame:
    """SIM3-SIM6, FLT1: (user_1, user_2, jaccard_raw_view, similarity), every candidate of a view at ``min_sim`` or more.

    Large classes are compared in tiles of users: what moves are users with their views, and pairs come out only
    where they are similar. Pairs of small classes go row by row, once for all views. A pair counts once.
    """
    strings = {"norm": text.norm, "sep": text.sep_norm, "deleet": text.deleet_norm, "letters": text.letters_only, "tokens": text.tokens_for_ratio}
    facts = materialise(raw_signatures(users.where("user <> ''").select("user", *[f(F.col("user")).alias(k) for k, f in strings.items()]), num_perm), "users")

    def run(table: pa.Table) -> pa.Table:
        side, users = table.column("side").to_numpy(), table.column("user").combine_chunks()
        x = np.flatnonzero(side == 0)
        i, j = (x[k] for k in np.triu_indices(len(x), 1)) if (side == 0).all() and table.column("whole")[0].as_py() else (k.ravel() for k in np.meshgrid(x, np.flatnonzero(side == 1), indexing="ij"))
        score = kernels.combined({k: table.column(k).to_pylist() for k in strings}, i, j, min_sim)
        near = np.flatnonzero(score >= min_sim)
        i, j, score = i[near], j[near], score[near]
        signs = table.column("signature").combine_chunks().flatten().to_numpy().reshape(len(users), -1)
        jaccard = [(signs[i[at : at + kernels.CHUNK]] == signs[j[at : at + kernels.CHUNK]]).mean(axis=1) for at in range(0, len(i), kernels.CHUNK)]
        place = np.argsort(np.argsort(np.array(users.to_pylist(), dtype=object), kind="stable"))
        turned = place[i] > place[j]
        one, two = users.take(pa.array(np.where(turned, j, i))), users.take(pa.array(np.where(turned, i, j)))
        return pa.table({"user_1": one, "user_2": two, "jaccard_raw_view": np.concatenate([np.empty(0), *jaccard]), "similarity": score})

    rows, blocks, users, covered = None, None, facts.select("user"), None
    for view in views:
        members, met = candidate_classes(users, view, num_perm, max_bucket)
        members, met = materialise(members, "members"), materialise(met, "classes")
        sizes = members.groupBy("rep").agg(F.count("*").alias("n"))
        met = met.join(sizes.withColumnsRenamed({"rep": "rep_1", "n": "n_1"}), "rep_1").join(sizes.withColumnsRenamed({"rep": "rep_2", "n": "n_2"}), "rep_2")
        one, two = (members.withColumnsRenamed({"rep": f"rep_{k}", "user": f"_{k}"}) for k in (1, 2))
        few = F.col("n_1") * F.col("n_2") <= SINGLY
        if view == "shape":
            covered = members, met.where(~few).select(F.least("rep_1", "rep_2").alias("_a"), F.greatest("rep_1", "rep_2").alias("_b"))
        part = met.where(few).join(one, "rep_1").join(two, "rep_2").where("rep_1 <> rep_2 OR _1 < _2").select(F.least("_1", "_2").alias("user_1"), F.greatest("_1", "_2").alias("user_2"))
        rows = part if rows is None else rows.unionByName(part)
        tiles = lambda n: F.ceil(F.col(n) / tile).cast("int")
        same = F.col("rep_1") == F.col("rep_2")
        cut = met.where(~few).select("rep_1", "rep_2", "n_2", F.explode(F.sequence(F.lit(0), tiles("n_1") - 1)).alias("a"))
        cut = cut.select("rep_1", "rep_2", "a", F.explode(F.sequence(F.when(same, F.col("a")).otherwise(0), tiles("n_2") - 1)).alias("b")).withColumn("whole", same & (F.col("a") == F.col("b")))
        dealt = members.join(sizes, "rep").select("rep", F.pmod(F.xxhash64("user"), tiles("n")).cast("int").alias("tile"), "user")
        sides = [(cut, "rep_1", "a", 0), (cut.where("NOT whole"), "rep_2", "b", 1)]
        for which, rep, place, side in sides:
            part = which.join(dealt.withColumnsRenamed({"rep": rep, "tile": place}), [rep, place]).select(F.lit(view).alias("view"), "rep_1", "rep_2", "a", "b", "whole", F.lit(side).alias("side"), "user")
            blocks = part if blocks is None else blocks.unionByName(part)
    schema = "user_1 string, user_2 string, jaccard_raw_view double, similarity double"
    # by number, as what a task reads is small but its work is not, and tasks would be joined by size
    keys, slots = ["view", "rep_1", "rep_2", "a", "b"], 8 * users.sparkSession.sparkContext.defaultParallelism
    many = blocks.join(facts, "user").repartition(slots, *keys).groupBy(*keys).applyInArrow(run, schema)
    signed = facts.select("user", "signature")
    rows = rows.distinct()
    if covered:  # the blocks of shapes compare these anyway, and other views propose many of them
        members, large = covered
        for k, c in ((1, "_p"), (2, "_q")):
            rows = rows.join(members.select(F.col("user").alias(f"user_{k}"), F.col("rep").alias(c)), f"user_{k}")
        seen = (F.least("_p", "_q") == F.col("_a")) & (F.greatest("_p", "_q") == F.col("_b"))
        rows = rows.join(large, seen, "left_anti").select("user_1", "user_2")
    # written, or the filter by similarity would be pushed below the distinct, to every proposal of every view
    found = refine(materialise(rows, "proposed").repartition(slots), min_sim)
    found = found.join(signed.select(F.col("user").alias("user_1"), F.col("signature").alias("_a")), "user_1").join(signed.select(F.col("user").alias("user_2"), F.col("signature").alias("_c")), "user_2")
    found = found.select("user_1", "user_2", jaccard_estimate(F.col("_a"), F.col("_c")).alias("jaccard_raw_view"), "similarity")
    return found.unionByName(many).groupBy("user_1", "user_2").agg(F.first("jaccard_raw_view").alias("jaccard_raw_view"), F.first("similarity").alias("similarity"))


def _meetings(index: DataFrame, tile: int) -> DataFrame:
    """(rep_1, rep_2): distinct pairs of one view's ``index`` that share a bucket."""
    key = ["band", "hash"]
    sizes = index.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").select(*key, F.ceil(F.col("_n") / tile).cast("int").alias("_tiles"))
    sized = index.join(sizes, key).withColumn("_t", F.pmod(F.xxhash64("user"), "_tiles").cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    a = sized.select(*key, F.col("_t").alias("_i"), others.alias("_j"), F.col("user").alias("rep_1"))
    b = sized.select(*key, others.alias("_i"), F.col("_t").alias("_j"), F.col("user").alias("rep_2"))
    return a.join(b, [*key, "_i", "_j"]).where("rep_1 < rep_2").select("rep_1", "rep_2").distinct()


@F.pandas_udf(T.DoubleType())
def _combined(u: pd.Series, v: pd.Series, su: pd.Series, sv: pd.Series, du: pd.Series, dv: pd.Series, lu: pd.Series, lv: pd.Series, tu: pd.Series, tv: pd.Series) -> pd.Series:
    n = np.arange(len(u))
    views = {k: [*x, *y] for k, x, y in (("norm", u, v), ("sep", su, sv), ("deleet", du, dv), ("letters", lu, lv), ("tokens", tu, tv))}
    return pd.Series(kernels.combined(views, n, n + len(u)))


def combined_similarity(a: Column, b: Column) -> Column:
    """SIM5: best of the kernels over the views, with the letters-only boost; views are built natively."""
    views = (text.norm, text.sep_norm, text.deleet_norm, text.letters_only, text.tokens_for_ratio)
    return _combined(*[f(c) for f in views for c in (a, b)])


def refine(pairs: DataFrame, min_sim: float = 0.70) -> DataFrame:
    """SIM6, FLT1."""
    return pairs.withColumn("similarity", combined_similarity(F.col("user_1"), F.col("user_2"))).where(F.col("similarity") >= min_sim)


#: Nodes that a partition's forest keeps at once; a full one is dropped for a new one.
FOREST = 1_000_000


def spanning(edges: DataFrame) -> DataFrame:
    """(u, v): edges that connect what an edge connects, a forest for each partition: as many as its nodes at most."""
    u, v = edges.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}
        for batch in batches:
            kept = []
            for at, (x, y) in enumerate(zip(*[c.to_pylist() for c in batch.columns], strict=True)):
                roots = []
                for node in (x, y):
                    root = node
                    while (up := above.setdefault(root, root)) != root:
                        above[root] = root = above[up]
                    roots.append(root)
                if roots[0] != roots[1]:
                    above[roots[0]] = roots[1]
                    kept.append(at)
            if kept:
                yield batch.take(pa.array(kept, pa.int32()))
            if len(above) > FOREST:
                above = {}

    return edges.select(u, v).mapInArrow(run, edges.select(u, v).schema)


def components(edges: DataFrame, a: str = "user_1", b: str = "user_2", rounds: int = 50) -> DataFrame:
    """Connected components of an undirected edge table: (node, root), root the smallest node.

    Large-star and small-star contraction; every round is written to the shared folder.
    """

    def cut(df: DataFrame) -> DataFrame:
        return materialise(df, "edges")

    def star(df: DataFrame) -> DataFrame:
        low = df.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("k"), F.least("x", "m").alias("m"))
        return df.join(low, df["x"] == low["k"])

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    now = cut(spanning(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")).distinct())
    last = mark(now)
    for _ in range(rounds):
        both = now.selectExpr("u AS x", "v AS y").unionAll(now.selectExpr("v AS x", "u AS y"))
        large = star(both).where("y > x").selectExpr("y AS x", "m AS y").distinct()
        now = cut(star(large).selectExpr("IF(y = m, x, y) AS u", "m AS v").where("u <> v").distinct())
        new = mark(now)
        if new == last:
            break
        last = new
    return now.selectExpr("u AS node", "v AS root").unionByName(now.selectExpr("v AS node", "v AS root").distinct())


@dataclass
class Similarity:
    """What the stage gives: rows with features, pairs, clusters of users, their summary and links."""

    rows: DataFrame
    pairs: DataFrame
    user_clusters: DataFrame
    cluster_summary: DataFrame
    cluster_links: DataFrame


def extract_clusters(pairs: DataFrame, users: DataFrame, min_sim: float = 0.70, isolates: bool = True) -> tuple[DataFrame, DataFrame]:
    """SIM7, SIM8, AGG9, AGG10, JN6, JN10, JN11: (user clusters, cluster summary).

    Ids run from 1 by size, mean edge similarity and smallest member; users without a qualifying edge are -1.
    """
    edges = pairs.where(F.col("similarity") >= min_sim).select("user_1", "user_2", "similarity")
    roots = components(edges)
    both = edges.select(F.col("user_1").alias("node"), F.col("similarity").alias("w")).unionByName(edges.select(F.col("user_2").alias("node"), F.col("similarity").alias("w")))
    weight = both.groupBy("node").agg(F.sum("w").alias("sum"), F.avg("w").alias("mean"), F.count("*").alias("n"))
    nodes = roots.join(weight, "node")
    order = Window.partitionBy("root").orderBy(F.round("sum", 9).desc(), "node")
    medoid = nodes.withColumn("_r", F.row_number().over(order)).where("_r = 1").select("root", F.col("node").alias("medoid_username"), F.col("sum").alias("centroid_sum_similarity"), F.col("mean").alias("centroid_mean_similarity"), F.col("n").alias("centroid_neighbor_count"))
    stats = nodes.groupBy("root").agg(F.count("*").alias("size"), (F.sum("sum") / F.sum("n")).alias("avg_similarity"))
    ranked = numbered(stats, "cluster_id", F.desc("size"), F.round("avg_similarity", 9).desc(), F.col("root"))
    named = users.select(F.col("user").alias("email_username")).join(roots.join(ranked, "root").select("node", "cluster_id"), F.col("email_username") == F.col("node"), "left")
    clusters = named.select("email_username", F.coalesce("cluster_id", F.lit(-1).cast("long")).alias("cluster_id"))
    summary = ranked.join(medoid, "root").select("cluster_id", "size", "medoid_username", text.canonical_label(F.col("medoid_username")).alias("canonical_label"), "avg_similarity", "centroid_sum_similarity", "centroid_mean_similarity", "centroid_neighbor_count")
    if isolates:
        zero = F.lit(0.0)
        alone = clusters.where("cluster_id = -1").agg(F.count("*").alias("size")).where("size > 0").select(F.lit(-1).cast("long").alias("cluster_id"), "size", F.lit("").alias("medoid_username"), F.lit("__isolates__").alias("canonical_label"), zero.alias("avg_similarity"), zero.alias("centroid_sum_similarity"), zero.alias("centroid_mean_similarity"), F.lit(0).cast("long").alias("centroid_neighbor_count"))
        summary = summary.unionByName(alone)
    return clusters, summary


def sorted_summary(summary: DataFrame) -> DataFrame:
    """SRT2."""
    return summary.orderBy((F.col("cluster_id") == -1).asc(), F.desc("size"), F.desc("avg_similarity"), "medoid_username")


def annotate_pairs(pairs: DataFrame, clusters: DataFrame) -> DataFrame:
    """JN8, SIM12."""
    one = clusters.select(F.col("email_username").alias("user_1"), F.col("cluster_id").alias("cluster_id_1"))
    two = clusters.select(F.col("email_username").alias("user_2"), F.col("cluster_id").alias("cluster_id_2"))
    same = (F.col("cluster_id_1") == F.col("cluster_id_2")) & (F.col("cluster_id_1") != -1)
    return pairs.join(one, "user_1").join(two, "user_2").select("user_1", "user_2", "cluster_id_1", "cluster_id_2", same.cast("int").alias("same_cluster"), F.when(same, F.col("cluster_id_1")).otherwise(-1).cast("long").alias("pair_cluster_id"), "jaccard_raw_view", "similarity")


def user_features(pairs: DataFrame, min_sim: float = 0.70, neighbours: int = 2) -> DataFrame:
    """AGG8, SIM11, SET1, FLT3: sum, mean and number of a user's edges within its cluster, and the flag above ``neighbours``."""
    inside = pairs.where((F.col("same_cluster") == 1) & (F.col("similarity") >= min_sim))
    both = inside.select(F.col("user_1").alias("email_username"), "similarity").unionByName(inside.select(F.col("user_2").alias("email_username"), "similarity"))
    out = both.groupBy("email_username").agg(F.sum("similarity").alias("username_similarity_score"), F.avg("similarity").alias("username_similarity_mean_score"), F.count("*").alias("similarity_neighbors_count"))
    return out.withColumn("too_many_similar_usernames_flag", (F.col("similarity_neighbors_count") > neighbours).cast("int"))


def cluster_links(clusters: DataFrame, summary: DataFrame, threshold: float = 0.55, min_sim: float = 0.65, num_perm: int = NUM_PERM) -> DataFrame:
    """SIM9, SIM10, JN14, SET5: links between clusters by shingles of their members or their labels."""
    named = clusters.where("cluster_id <> -1")
    sizes = (2, 3, 4)
    each = named.select("cluster_id", F.explode(F.array_union(text.shingles(text.sep_norm(F.col("email_username")), sizes), text.shingles(text.deleet_norm(F.col("email_username")), sizes))).alias("s"))
    salt = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(num_perm - 1)), lambda i: F.xxhash64(i, F.col("s")))).alias("slot", "h")
    slots = each.distinct().select("cluster_id", salt).groupBy("cluster_id", "slot").agg(F.min("h").alias("h"))
    signed = slots.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("slot", "h"))).alias("_s")).withColumn("_s", F.transform("_s", lambda x: x["h"]))
    bands, rows = lsh_parameters(threshold, num_perm)
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(F.slice("_s", b * rows + 1, rows)))
    index = signed.select("cluster_id", F.posexplode(keys).alias("band", "hash"))
    a, b = index.alias("a"), index.alias("b")
    pairs = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.hash") == F.col("b.hash")) & (F.col("a.cluster_id") < F.col("b.cluster_id"))).select(F.col("a.cluster_id").alias("cluster_id_1"), F.col("b.cluster_id").alias("cluster_id_2")).distinct()
    facts = signed.join(summary.select("cluster_id", "canonical_label"), "cluster_id")
    left = facts.select(F.col("cluster_id").alias("cluster_id_1"), F.col("_s").alias("_a"), F.col("canonical_label").alias("_l"))
    right = facts.select(F.col("cluster_id").alias("cluster_id_2"), F.col("_s").alias("_c"), F.col("canonical_label").alias("_m"))
    sim = F.greatest(jaccard_estimate(F.col("_a"), F.col("_c")), combined_similarity(F.col("_l"), F.col("_m")))
    return pairs.join(left, "cluster_id_1").join(right, "cluster_id_2").select("cluster_id_1", "cluster_id_2", sim.alias("cluster_similarity")).where(F.col("cluster_similarity") >= min_sim)


def top_pairs(pairs: DataFrame, k: int = 20) -> DataFrame:
    """SRT1, SNK4."""
    return pairs.orderBy(F.desc("similarity"), "user_1", "user_2").limit(k)


def username_similarity(df: DataFrame, column: str = "email_username", min_sim: float = 0.70, neighbours: int = 2, views: tuple[str, ...] = tuple(VIEWS), num_perm: int = NUM_PERM, max_bucket: int = 1_000) -> Similarity:
    """SIM13, SIM14, JN7: the whole stage; rows get cluster id, score, mean score, neighbours and flag."""
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    users = materialise(usernames(df, column), "usernames")
    pairs = materialise(similar_pairs(users, min_sim, views, num_perm, max_bucket), "pairs")
    clusters, summary = extract_clusters(pairs, users, min_sim)
    annotated = annotate_pairs(pairs, clusters)
    features = user_features(annotated, min_sim, neighbours)
    facts = clusters.join(features, "email_username", "left").select(F.col("email_username").alias("_u"), F.col("cluster_id").alias("username_similarity_cluster"), *[F.coalesce(c, F.lit(0)).cast(t).alias(c) for c, t in (("username_similarity_score", "double"), ("username_similarity_mean_score", "double"), ("similarity_neighbors_count", "long"), ("too_many_similar_usernames_flag", "int"))])
    rows = df.join(facts, text.norm(F.col(column)) == F.col("_u"), "left").drop("_u")
    return Similarity(rows, annotated, clusters, summary, cluster_links(clusters, summary, num_perm=num_perm))


def similarity_model(users: DataFrame, **settings) -> Similarity:
    """SIM15: the stage over a one-column table of usernames."""
    return username_similarity(users.toDF("email_username"), **settings)


@F.pandas_udf(T.DoubleType())
def _damerau(a: pd.Series, b: pd.Series) -> pd.Series:
    n = np.arange(len(a))
    return pd.Series(kernels.damerau(kernels.Coded([*a, *b]), n, n + len(a)))


def damerau_column(a: Column, b: Column) -> Column:
    """1 less the Damerau-Levenshtein distance over the longer length."""
    return _damerau(a, b)


@F.pandas_udf(T.DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    n = np.arange(len(a))
    return pd.Series(kernels.jaro_winkler(kernels.Coded([*a, *b]), n, n + len(a)))


def jaro_winkler_column(a: Column, b: Column) -> Column:
    return _jaro_winkler(a, b)


#: Most usernames for the exhaustive comparison.
LEGACY_MOST = 2_000


def legacy_matrix(df: DataFrame, column: str = "email_username", low: float = 0.1, high: float = 0.9, most: int = LEGACY_MOST, scaled: bool = False) -> tuple[DataFrame, DataFrame]:
    """SIM16, JN9, JN12, FLT2, AGG11: all ordered pairs of distinct usernames within the band, and the sum per user.

    Quadratic by definition, so over ``most`` usernames it refuses. ``scaled`` (SIM17): the sum min-max scaled.
    """
    if column not in df.columns:
        return df, df.sparkSession.createDataFrame([], "user_1 string, user_2 string, similarity double")
    users = usernames(df, column)
    if users.count() > most:
        raise ValueError(f"more than {most} usernames; use username_similarity")
    pairs = users.select(F.col("user").alias("user_1")).crossJoin(users.select(F.col("user").alias("user_2"))).withColumn("similarity", _damerau("user_1", "user_2"))
    pairs = pairs.where(F.col("similarity").between(low, high))
    sums = pairs.groupBy(F.col("user_1").alias("_u")).agg(F.sum("similarity").alias("username_similarity_score"))
    out = df.join(sums, text.norm(F.col(column)) == F.col("_u"), "left").drop("_u")
    return numeric.normalise(out, "username_similarity_score") if scaled else out, pairs


def strong_pairs(pairs: DataFrame, least: float = 0.5) -> DataFrame:
    """FLT4."""
    return pairs.where(F.col("similarity") >= least)


def display_sorted(rows: DataFrame, k: int = 20) -> DataFrame:
    """SRT4: a top-k report by score, neighbours and name."""
    return rows.orderBy(F.desc("username_similarity_score"), F.desc("similarity_neighbors_count"), "email_username").limit(k)
