import random
import re

import numpy as np
import pytest

import corpus_pipeline
from riskloom.llm import shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_set(text, size=5):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_tops(texts, least=0.8):
    """The smallest id of each text's component, over all pairs."""
    found, parent = [brute_set(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for j in range(len(texts)):
        for i in range(j):
            a, b = found[i], found[j]
            if a == b or (a and b and len(a & b) >= least * len(a | b)):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(texts))]


def planted(seed=3, groups=60):
    """Random texts, each with a copy that shares 80 to 95 % of its shingles, and one that shares somewhat less."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    texts = ["", None, " \n", "One two", "one TWO"]
    near = 0
    for _ in range(groups):
        n = r.choice([60, 200, 500])
        base = [word() for _ in range(n)]
        for j in (r.uniform(0.80, 0.95), r.uniform(0.6, 0.79)):
            copy = list(base)
            # a change of one word removes up to 5 shingles and adds as many
            changes = max(1, int((1 - j) / (1 + j) * (n - 4) / 5))
            for k in r.sample(range(n // 6), changes) if changes < n // 6 else range(changes):
                copy[min(n - 1, 6 * k + 2)] = word()
            texts.append(" ".join(copy))
            a, b = brute_set(texts[-1]), brute_set(" ".join(base))
            near += 0.8 <= len(a & b) / len(a | b) < 1
        texts.append(" ".join(base).upper())
    assert near >= groups
    return texts


@pytest.mark.parametrize("tile", [1_024, 3])
def test_near_copies(spark, tile):
    texts = planted()
    texts += [" ".join(["hot"] * 3 + [f"w{k}" for k in range(60 + i % 7)]) for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(df, tile=tile).collect()}
    assert [got[i] for i in range(len(texts))] == brute_tops(texts)


def test_stage(spark):
    texts = planted(seed=4, groups=25)
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], SCHEMA)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect())
    assert kept == sorted(set(brute_tops(texts)))
    assert corpus_pipeline.near_dedup(spark, df.limit(0), "").count() == 0
    odd = spark.createDataFrame([(None, "same text"), (None, "same text"), (4, "same text"), (9, "Same  text")], "doc_id long, text string")
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in shingles.drop_near_duplicates(odd).collect()) == [(False, 4), (True, 0), (True, 0)]


def plain_roots(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("per_piece", [1_000_000, 100])
def test_half_balls_meet(per_piece):
    r = random.Random(5)
    keys, checks = [], []
    for _ in range(60):
        key, check = r.getrandbits(shingles.BALL), r.getrandbits(128)
        for flips in (0, 1, 2, 3):
            keys.append(key ^ sum(1 << b for b in r.sample(range(shingles.BALL), flips)))
            checks.append(check ^ sum(1 << b for b in r.sample(range(128), r.choice([0, 20, 30]))))
    keys += [keys[0]] * 40
    checks += [r.getrandbits(128) for _ in range(20)] + [checks[0]] * 20
    n = len(keys)
    near = [(i, j) for i in range(n) for j in range(i) if (keys[i] ^ keys[j]).bit_count() <= 2 and (checks[i] ^ checks[j]).bit_count() <= shingles.CHECK_RADIUS]
    halves = np.array([[c & (1 << 64) - 1, c >> 64] for c in checks], dtype=np.uint64)
    got = shingles.candidates(np.array(keys, dtype=np.uint32), halves, per_piece=per_piece)
    assert plain_roots(n, got) == plain_roots(n, near) and n - len(got) == len(set(plain_roots(n, near)))


def test_prints_are_majorities():
    r, full = np.random.default_rng(2), (1 << 64) - 1
    for n in (1, 2, 4, 255, 600):
        hashes, want = r.integers(0, 1 << 63, n, dtype=np.uint64), ""
        for mul in shingles._MUL.tolist():
            mixed = []
            for h in hashes.tolist():
                x = h * mul & full
                x = (x ^ x >> 32) * int(shingles._MIX) & full
                mixed.append(x ^ x >> 29)
            least = min(mixed, key=lambda x: x * int(shingles._MUL[0]) & full)
            for at in [8 * byte + 7 - k for byte in range(8) for k in range(8)]:
                ones = sum(x >> at & 1 for x in mixed)
                want += str(least >> at & 1) if 2 * ones == n else str(int(2 * ones > n))
        assert "".join(f"{b:08b}" for b in shingles.simhash_print(hashes)) == want


def test_fingerprints_propose_pairs_at_08(spark):
    """Sets at Jaccard 0.8 to 0.95 meet in a half ball, those without common shingles do not."""
    r = np.random.default_rng(4)
    rows = []
    for both, a, b in [(4, 1, 0), (12, 2, 1), (160, 20, 20), (300, 75, 0), (380, 10, 10)] * 60:
        hashes = r.integers(0, 1 << 63, both + a + b, dtype=np.uint64)
        for own in (hashes[: both + a], np.concatenate([hashes[:both], hashes[both + a :]])):
            rows.append((len(rows), len(own), bytearray(shingles.simhash_print(own))))
    edges = shingles.proposed(spark.createDataFrame(rows, "node long, n long, print binary")).collect()
    assert plain_roots(len(rows), [(e["a"], e["b"]) for e in edges]) == [i // 2 * 2 for i in range(len(rows))]


def near_group(n, words=400, seed=6):
    """Copies of one text, each with a few words of its own."""
    r = random.Random(seed)
    base, out = [f"w{r.getrandbits(40)}" for _ in range(words)], []
    for _ in range(n):
        copy = list(base)
        for k in r.sample(range(words), r.randint(1, 4)):
            copy[k] = f"x{r.getrandbits(40)}"
        out.append(" ".join(copy))
    return out


def test_group_of_near_copies_is_few_edges(spark):
    """Every fingerprint connects the group, but its edges are a few a node; whatever the order of the rows."""
    n = 400
    df = spark.createDataFrame(list(enumerate(near_group(n))), "node long, text string").repartition(7)
    prints = shingles.sets(df, "node").withColumnRenamed("doc_id", "node").select("node", "n", "print")
    edges = {tuple(sorted((e["a"], e["b"]))) for e in shingles.proposed(prints).collect()}
    assert set(plain_roots(n, edges)) == {0}
    assert len(edges) <= 8 * n


def test_tiles_of_near_copies_are_few_edges(spark):
    """A group of n in m tiles: the tiles' stars, and one edge for two tiles that both are connected."""
    n, tile = 200, 10
    rows = spark.createDataFrame([(i, 0, 400, t) for i, t in enumerate(near_group(n))], "node long, component long, n long, text string")
    edges = [(e["a"], e["b"]) for e in shingles.links(rows, tile=tile).collect()]
    m = n // tile
    assert set(plain_roots(n, edges)) == {0} and len(edges) <= n + m * (m - 1) // 2


def test_known_connections_are_not_proposed_again():
    keys = np.array([5, 5, 5, 7, 9_000, 9_000, 70_000], dtype=np.uint32)
    checks = np.zeros((7, 2), dtype=np.uint64)
    assert shingles.candidates(keys, checks) == [(1, 0), (2, 0), (3, 0), (5, 4)]
    known = np.array([0, 1, 1, 3, 0, 5, 6])  # 2 belongs to 1, 4 to 0
    assert shingles.candidates(keys, checks, known=known) == [(1, 0), (3, 0), (5, 0)]
    found = [np.arange(10, dtype=np.uint64) for _ in range(4)] + [np.arange(90, 99, dtype=np.uint64)]
    assert shingles.compare(found, np.array([0, 1]), np.array([2, 3, 4]), known=np.array([0, 1, 2, 2, 4])) == [(1, 0), (2, 0)]
    assert shingles.compare(found, np.array([0, 1]), np.array([2, 3, 4]), known=np.array([0, 0, 0, 0, 4])) == []


def test_ids_of_text(spark):
    texts = near_group(12) + ["other words"] * 2
    df = spark.createDataFrame([(f"d{i:02}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    got = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(df, tile=5).collect()}
    assert [got[f"d{i:02}"] for i in range(14)] == ["d00"] * 12 + ["d12"] * 2
