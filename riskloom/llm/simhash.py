"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits have a common variant within half the radius of each, so every
distinct fingerprint emits all variants in its half ball and collisions on a variant are links. For 64
bits and radius 4 that is 2,081 variants; they are not shuffled one by one. A variant belongs to the
slice that its ``k`` routing bits name, and a fingerprint goes once to each slice that its half ball meets
(22 copies for k = 6, 79 for 12): the task of a slice makes the variants in it, sorts them and links
equal neighbours, verified by their true distance. ``k`` follows from the number of distinct
fingerprints, so a slice stays of bounded size as data grow.

Equal fingerprints are collapsed first (partial aggregation), all members of a variant's bucket are within
the radius of each other (triangle inequality), and a slice returns only a spanning forest of its links:
a group of n copies never becomes n^2 pairs. Components are joined by ``common.components``.

Defined results: null, empty and blank texts have fingerprint zero and link like any other; equal doc_ids
are one document, and where it stays all its rows do; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import components, saved

BITS, SHINGLE, RADIUS, SEED = 64, 4, 4, 42
#: Fingerprint copies that a slice should have, about; each makes 2081 / 2^k x copies variants.
PER_SLICE = 20_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of the text's word shingles; no words: 0."""
    import xxhash

    body = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    words = _WORD.findall(body)
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= size:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        join = b" ".join
        hashes = [digest(join(s), SEED) for s in zip(*[words[i:] for i in range(size)], strict=False)]
    ones = np.zeros(BITS, dtype=np.int64)
    raw = np.frombuffer(b"".join(hashes), dtype=np.uint8).reshape(-1, 8)
    for at in range(0, len(raw), 1 << 16):
        ones += np.unpackbits(raw[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    kind = dict(df.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")).mapInArrow(run, f"doc_id {kind}, fp long")


def half_ball(bits: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` of ``bits`` bits, as uint64."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in itertools.combinations(range(bits), r)]
    return np.array(masks, dtype=np.uint64)


def routing_bits(n: int, per_slice: int = PER_SLICE) -> int:
    """The fewest routing bits k with n x (slices met) / 2^k at most ``per_slice``; 0 to 24."""
    for k in range(0, 25):
        if n * (1 + k + k * (k - 1) // 2) <= per_slice << k:
            return k
    return 24


def _forest(rows: np.ndarray, fps: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the pairs in ``rows`` (indices), verified by distance, by a small union-find."""
    parent = list(range(len(fps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in rows.tolist():
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[rb] = ra
            out.append((a, b))
    return out


def slice_links(prefix: int, fps: np.ndarray, k: int, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (index pairs) among fingerprints that share a variant in this slice.

    The variant's top k bits are the prefix; its other bits may differ from the fingerprint's in as many
    bits as the half radius leaves over.
    """
    half = radius // 2
    low = np.uint64((1 << (BITS - k)) - 1) if k else np.uint64(0xFFFFFFFFFFFFFFFF)
    top = (fps >> np.uint64(BITS - k)) if k else np.zeros(len(fps), dtype=np.uint64)
    spent = np.bitwise_count(top ^ np.uint64(prefix)).astype(np.int64)
    keys, owners = [], []
    for used in range(half + 1):
        own = np.flatnonzero(spent == used)
        if len(own):
            masks = half_ball(BITS - k, half - used)
            keys.append(((fps[own] & low)[:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(own, len(masks)))
    if not keys:
        return []
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key)
    key, owner = key[order], owner[order]
    same = np.flatnonzero(key[1:] == key[:-1])
    pairs = np.unique(np.stack([owner[same], owner[same + 1]], axis=1), axis=0) if len(same) else np.empty((0, 2), dtype=np.int64)
    near = np.bitwise_count(fps[pairs[:, 0]] ^ fps[pairs[:, 1]]) <= radius
    return _forest(pairs[near], fps)


def links(distinct: DataFrame, n: int, radius: int = RADIUS, per_slice: int = PER_SLICE) -> DataFrame:
    """Edges (a, b) that connect what the links connect. ``distinct``: (fp, node), one row a fingerprint."""
    k, half = routing_bits(n, per_slice), radius // 2
    masks = [sum(1 << b for b in c) for r in range(half + 1) for c in itertools.combinations(range(k), r)]
    prefix = F.shiftrightunsigned("fp", BITS - k) if k else F.lit(0).cast("long")
    routed = distinct.select("fp", "node", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("m"))
    routed = routed.select(prefix.bitwiseXOR(F.col("m")).alias("slice"), "fp", "node")
    kind = dict(distinct.dtypes)["node"]

    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        nodes = table.column("node")
        found = slice_links(int(table.column("slice")[0].as_py()), fps, k, radius)
        a = nodes.take(pa.array([x for x, _ in found], pa.int64()))
        b = nodes.take(pa.array([y for _, y in found], pa.int64()))
        return pa.table({"a": a, "b": b})

    return routed.groupBy("slice").applyInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    fps, _ = saved(fingerprints(df, doc_id, text, size), "fps")
    distinct, path = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node IS NOT NULL"), "distinct")
    found = components(links(distinct, max(1, distinct.count()), radius), "a", "b", "simhash")
    tops = distinct.join(found, "node", "left").select(F.col("fp").alias("_fp"), F.coalesce("component", "node").alias("component_id"))
    return fps.join(tops, F.col("fp") == F.col("_fp"), "left").drop("_fp")


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows whose doc_id is the smallest of its component, one of each; rows without an id stay."""
    marks = near_duplicates(df, doc_id, text, size, radius)
    gone = marks.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return df.join(gone, df[doc_id] == gone["_gone"], "left_anti")
