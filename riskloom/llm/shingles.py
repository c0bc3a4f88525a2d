"""Near-duplicates by word shingles: Jaccard similarity of 5-word shingle sets, candidates by meet-in-the-middle ball hashing of SimHash fingerprints.

A text's set is the XXH64 hashes of its word shingles (words and lower case as in ``simhash``). Its print has
1,024 SimHash bits: a bit is 1 if set in over half of the set's hashes, each hash mixed anew for every 64 bits; where it
is set in half of them, the least of these 64 bits' hashes decides, so that sets of even size have as many ones as others. At Jaccard
0.8 a bit differs with probability 0.15 for large sets and 0.161 at most, but for sets of 4 and 5 shingles (0.1875): far
more bits than one ball of a 64-bit fingerprint reaches. So 112 fingerprints of 26 bits are picked from the print (224 for
sets of at most 5 shingles). Two texts are candidates if in one of these the 4 routing bits agree, the 22
others differ in at most 2, and 128 further bits of the print in at most 42. The 22 bits are met in the middle: each
fingerprint emits all 23 variants within one bit, and two within 2 bits share one. A pair at 0.8 is missed with
probability 1e-7 for large sets and 5e-6 at most, one above it more rarely; texts that share nothing meet with 3e-8.

Fingerprints are shuffled in blocks, one for a fingerprint's number, route and batch of texts; variants are made, sorted and
matched within a route, in pieces of bounded size, and never shuffled. All pairs that share a variant are looked at, but
for those connected already, and what the candidates connect is returned as stars, each node with the smallest that it is
connected to: near copies have the same star under most fingerprints, where spanning trees would differ under each. The first
fingerprints' stars give each node a label, and the others return only what connects different labels, so a group of n near copies
is a few n edges and not one for each fingerprint. Connected components of these edges hold every candidate pair. Within a
component all sets are compared exactly, so what links is what is similar and not what shares a variant.

Components are cut into tiles by number of sets and of shingles, and compared tile by tile: no task holds
more than two tiles and none is capped. Each tile is compared with itself first; its stars are the labels by which two tiles
then leave out what is connected already, so a group of n near copies in m tiles is about n + m^2 / 2 edges and
never n^2. A component of m tiles ships each set m times.

Defined results: equal sets are one class first (partial aggregation), null, empty and blank texts among them;
texts of fewer words than a shingle are one shingle; equal doc_ids are one document, and where it stays all its
rows do; rows without an id stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import components, n_words_of, saved
from riskloom.llm.simhash import _LOWER, _WORD, SEED, half_ball

SHINGLE, JACCARD = 5, 0.8
#: Bits of a print; those of a fingerprint that route it and that are met in the middle, and how many of the latter may differ.
POOL, ROUTE, BALL, RADIUS = 1_024, 4, 22, 2
#: Further bits that a fingerprint is checked by, and how many of them may differ.
CHECK, CHECK_RADIUS = 128, 42
#: Fingerprints of every set, and of those of at most SMALL shingles.
PRINTS, SMALL_PRINTS, SMALL = 112, 224, 5
#: Fingerprints whose stars are the others' labels.
FIRST = 8
#: Variants that are sorted at once, about, and prints that are dealt at once.
PER_PIECE, PER_BLOCK = 2_000_000, 4_096
#: Sets and shingles that a tile should have, about.
TILE, TILE_SHINGLES = 1_024, 2_000_000
_RNG = np.random.default_rng(SEED)
_MUL = _RNG.integers(0, 1 << 63, POOL // 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ENTRY = np.dtype([("key", "<u4"), ("check", "<u8", CHECK // 64)])


def _check_at(number: int) -> int:
    """The first byte of the print's bits that check a fingerprint."""
    return number * (CHECK // 8) % (POOL // 8)


#: The print's bits in each fingerprint, none of those that check it.
_PICKS = [_RNG.choice(np.setdiff1d(np.arange(POOL), np.arange(8 * _check_at(t), 8 * _check_at(t) + CHECK)), ROUTE + BALL, replace=False) for t in range(SMALL_PRINTS)]


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; no words: none."""
    import xxhash

    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return np.empty(0, dtype=np.uint64)
    digest, join = xxhash.xxh64_digest, b" ".join
    shingles = zip(*[words[i:] for i in range(size)], strict=False) if len(words) > size else [words]
    return np.unique(np.frombuffer(b"".join([digest(join(s), SEED) for s in shingles]), dtype=np.uint64))


def simhash_print(hashes: np.ndarray) -> bytes:
    """The set's SimHash bits: those set in over half of the mixed hashes, or in half of them and in the least of their word."""
    words = np.arange(len(_MUL))
    counts, tie, least = np.zeros(POOL, dtype=np.int64), np.zeros(len(words), dtype=np.uint64), np.full(len(words), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 255):  # counts of a block fit a byte
        mixed = hashes[at : at + 255, None] * _MUL
        mixed ^= mixed >> np.uint64(32)
        mixed *= _MIX
        mixed ^= mixed >> np.uint64(29)
        counts += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
        if len(hashes) % 2 == 0:
            order = mixed * _MUL[0]
            own = order.argmin(axis=0)
            tie = np.where(order[own, words] < least, mixed[own, words], tie)
            least = np.minimum(order[own, words], least)
    return np.packbits(2 * counts + np.unpackbits(tie.view(np.uint8)) > len(hashes)).tobytes()


def sets(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, k1, k2, n, print): two hashes that stand for the row's set, its size and its SimHash bits."""
    kind = dict(df.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for whole in batches:
            for at in range(0, whole.num_rows, 1_024):
                batch, keys, n, prints = whole.slice(at, 1_024), [], [], []
                for value in batch.column(1):
                    found = shingle_set(value.as_py(), size)
                    raw = found.tobytes()
                    keys.append([xxhash.xxh64_intdigest(raw, seed) for seed in (0, 1)])
                    n.append(len(found))
                    prints.append(simhash_print(found))
                k1, k2 = np.array(keys, dtype=np.uint64).view(np.int64).T.copy()
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(k1), pa.array(k2), pa.array(n, pa.int64()), pa.array(prints, pa.binary())], names=["doc_id", "k1", "k2", "n", "print"])

    return df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")).mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, n long, print binary")


def blocks(classes: DataFrame, numbers: range) -> DataFrame:
    """(number, route, nodes, entries): those fingerprints of a batch of (node, n, print), without their routing bits."""
    kind = dict(classes.dtypes)["node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PER_BLOCK):
                batch = whole.slice(at, PER_BLOCK)
                prints = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint8).reshape(-1, POOL // 8)
                bits, small = np.unpackbits(prints, axis=1), np.flatnonzero(batch.column(1).to_numpy() <= SMALL)
                for number in numbers:
                    picks, own = _PICKS[number], np.arange(len(prints)) if number < PRINTS else small
                    if not len(own):
                        break
                    value = bits[own[:, None], picks[None, :]] @ (1 << np.arange(ROUTE + BALL))
                    route = value >> BALL
                    order = np.argsort(route, kind="stable")
                    own, value, route = own[order], value[order], route[order]
                    entries = np.empty(len(own), dtype=_ENTRY)
                    entries["key"] = value & ((1 << BALL) - 1)
                    first = _check_at(number)
                    entries["check"] = np.ascontiguousarray(prints[own, first : first + CHECK // 8]).view("<u8")
                    starts = np.flatnonzero(np.diff(route, prepend=-1))
                    ends = np.append(starts, len(own)).astype(np.int32)
                    nodes = pa.ListArray.from_arrays(pa.array(ends), batch.column(0).take(pa.array(own)))
                    held = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends * np.int32(_ENTRY.itemsize)), pa.py_buffer(entries.tobytes())])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), number, dtype=np.int32)), pa.array(route[starts].astype(np.int32)), nodes, held], names=["number", "route", "nodes", "entries"])

    return classes.select("node", "n", "print").mapInArrow(run, f"number int, route int, nodes array<{kind}>, entries binary")


def variants(keys: np.ndarray, bits: int = BALL, radius: int = RADIUS, per_piece: int = PER_PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (variant, index of its key) within half the radius of each key, sorted, in pieces by the variants' leading bits."""
    half, keys, top = radius // 2, keys.astype(np.uint64), 0
    while top < bits - half and len(keys) * len(half_ball(bits, half)) > per_piece << top:
        top += 1
    low = np.uint64(bits - top)
    masks = [half_ball(bits - top, half - used) for used in range(half + 1)]
    for piece in range(1 << top):
        spent, parts = np.bitwise_count((keys >> low) ^ np.uint64(piece)), []
        for used in range(half + 1):
            own = np.flatnonzero(spent == used).astype(np.uint64)
            rest = keys[own] & np.uint64((1 << int(low)) - 1)
            parts.append((((rest[:, None] ^ masks[used]) << np.uint64(32)) | own[:, None]).ravel())
        both = np.concatenate(parts)
        both.sort()
        yield both >> np.uint64(32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _joined(pairs: list[list[int]]) -> dict[int, int]:
    """The least index that the pairs connect each with, of those that have a lesser one."""
    up = {}

    def root(x: int) -> int:
        path = []
        while x in up:
            path.append(x)
            x = up[x]
        up.update(dict.fromkeys(path, x))
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(up)}


def _known(labels: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the labels, and in this order the first place of each."""
    found = labels.combine_chunks()
    order = pc.array_sort_indices(found).to_numpy()
    return order, pc.rank(found, tiebreaker="min").to_numpy().astype(np.int64)[order] - 1


def _stars(known: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs that lead from what was known to be connected to what is now; labels are least indices."""
    at = np.flatnonzero((known == np.arange(len(known))) & (label != known))
    return list(zip(at.tolist(), label[at].tolist(), strict=True))


def candidates(keys: np.ndarray, checks: np.ndarray, bits: int = BALL, radius: int = RADIUS, check_radius: int = CHECK_RADIUS, per_piece: int = PER_PIECE, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Stars (index pairs, the second the least) of the pairs that share a variant and are near by their further bits.

    ``known``: the least index that each is connected with before.
    """
    known = np.arange(len(keys)) if known is None else known
    parent = known.copy()
    for variant, owner in variants(keys, bits, radius, per_piece):
        at, ahead = np.flatnonzero(variant[1:] == variant[:-1]), 1
        while len(at):
            a, b = owner[at], owner[at + ahead]
            apart = parent[a] != parent[b]
            a, b = a[apart], b[apart]
            near = np.bitwise_count(checks[a] ^ checks[b]).sum(axis=1) <= check_radius
            if near.any():
                ends = np.sort(np.stack([parent[a[near]], parent[b[near]]]), axis=0)
                moved = _joined(np.unique(ends, axis=1).T.tolist())
                parent[list(moved)] = list(moved.values())
                parent = parent[parent]
            ahead += 1
            at = at[at + ahead < len(variant)]
            at = at[variant[at + ahead] == variant[at]]
    return _stars(known, parent)


def proposed(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all candidates. ``classes``: (node, n, print)."""
    kind = dict(classes.dtypes)["node"]

    def run(table: pa.Table) -> pa.Table:
        nodes = pa.chunked_array([c.flatten() for c in table.column("nodes").chunks])
        order, known = _known(nodes)
        entries = np.frombuffer(b"".join(table.column("entries").to_pylist()), dtype=_ENTRY)[order]
        found = np.array(candidates(entries["key"], entries["check"], known=known), dtype=np.int64).reshape(-1, 2)
        return pa.table({c: nodes.take(pa.array(order[found[:, k]])) for k, c in enumerate("ab")})

    def stars(own: DataFrame, numbers: range) -> DataFrame:
        return blocks(own, numbers).groupBy("number", "route").applyInArrow(run, f"a {kind}, b {kind}")

    first, _ = saved(stars(classes, range(FIRST)), "stars")
    rest = stars(_labelled(classes, first).select(F.col("label").alias("node"), "n", "print"), range(FIRST, SMALL_PRINTS))
    return first.unionAll(rest)


def _labelled(rows: DataFrame, stars: DataFrame) -> DataFrame:
    """Add ``label``: the smallest node that the stars (a, b) connect the row's with, or itself."""
    labels = stars.groupBy(F.col("a").alias("_node")).agg(F.min("b").alias("_label"))
    return rows.join(labels, F.col("node") == F.col("_node"), "left").withColumn("label", F.coalesce("_label", "node")).drop("_node", "_label")


def compare(found: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, least: float = JACCARD, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Stars (index pairs, the second the least) that connect what is similar among ``left``, or between it and ``right``; ``known`` as in ``candidates``."""
    sizes = np.array([len(s) for s in found], dtype=np.int64)
    ids = np.unique(np.concatenate(found), return_inverse=True)[1] if len(found) else np.empty(0, dtype=np.int64)
    ends = np.cumsum(sizes)
    known = np.arange(len(found)) if known is None else known
    label = known.copy()
    has = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=bool)
    for at, i in enumerate(left.tolist()):
        others = left[at + 1 :] if right is None else right
        n = sizes[i]
        small, large = np.minimum(sizes[others], n), np.maximum(sizes[others], n)
        others = others[(label[others] != label[i]) & (small >= least * large) & (small > 0)]
        if not len(others):
            continue
        own = ids[ends[i] - n : ends[i]]
        has[own] = True
        lengths = sizes[others]
        first = np.cumsum(lengths) - lengths
        places = np.arange(int(lengths.sum())) + np.repeat(ends[others] - lengths - first, lengths)
        both = np.add.reduceat(has[ids[places]], first, dtype=np.int64)
        has[own] = False
        for j in others[both >= least * (lengths + n - both)].tolist():
            if label[j] != label[i]:
                low, high = sorted((label[i], label[j]))
                label[label == high] = low
    return _stars(known, label)


def links(rows: DataFrame, tile: int = TILE, tile_shingles: int = TILE_SHINGLES, size: int = SHINGLE, least: float = JACCARD) -> DataFrame:
    """Edges (a, b) that connect what the links connect. ``rows``: (node, component, n, text)."""
    whole = rows.groupBy("component").agg(F.count("*").alias("_m"), F.sum("n").alias("_n")).where("_m > 1")
    tiles = F.greatest(F.ceil(F.col("_m") / tile), F.ceil(F.col("_n") / tile_shingles)).cast("int")
    whole = whole.select(F.col("component").alias("_component"), tiles.alias("_tiles"))
    both = rows.join(whole, F.col("component") == F.col("_component")).withColumn("tile", F.pmod(F.xxhash64("node"), "_tiles").cast("int"))
    kind = dict(rows.dtypes)["node"]

    def run(table: pa.Table) -> pa.Table:
        order, known = _known(table.column("label"))
        table = table.take(pa.array(order))
        found = [shingle_set(t, size) for t in table.column("text").to_pylist()]
        where = table.column("tile").to_numpy()
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        edges = compare(found, np.flatnonzero(where == a), None if a == b else np.flatnonzero(where == b), least, known)
        labels = table.column("label")
        return pa.table({c: labels.take(pa.array([e[k] for e in edges], pa.int64())) for k, c in enumerate("ab")})

    def stars(tiled: DataFrame, a: str, b: str) -> DataFrame:
        return tiled.select("component", F.col(a).alias("a"), F.col(b).alias("b"), "tile", "label", "text").groupBy("component", "a", "b").applyInArrow(run, f"a {kind}, b {kind}")

    own, _ = saved(stars(both.withColumn("label", F.col("node")), "tile", "tile"), "tiles")
    others = F.filter(F.sequence(F.lit(0), F.col("_tiles") - 1), lambda o: o != F.col("tile"))
    each = F.explode(F.transform(others, lambda o: F.struct(F.least("tile", o).alias("a"), F.greatest("tile", o).alias("b"))))
    return own.unionAll(stars(_labelled(both.where("_tiles > 1"), own).withColumn("_at", each), "_at.a", "_at.b"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, least: float = JACCARD, tile: int = TILE) -> DataFrame:
    """(doc_id, component_id) of every row."""
    own, _ = saved(sets(df, doc_id, text, size), "sets")
    classes = own.where("doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("print").alias("print"))
    classes, _ = saved(classes, "classes")
    edges = proposed(classes.where("n > 0"))
    near, _ = saved(components(edges, "a", "b", "prints"), "candidates")
    # a document's rows may be several classes: each that has the id is compared
    texts = df.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows, _ = saved(texts.join(near, F.col("_id") == F.col("node")).select("node", "component", n_words_of(F.col("text")).alias("n"), "text"), "compared")
    edges = links(rows, tile, size=size, least=least)
    found = components(edges, "a", "b", "shingles")
    marks = classes.join(found, "node", "left").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.coalesce("component", "node").alias("component_id"))
    return own.join(marks, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left").select("doc_id", "component_id")


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, least: float = JACCARD) -> DataFrame:
    """The rows whose doc_id is the smallest of its component, one of each; rows without an id stay."""
    gone = near_duplicates(df, doc_id, text, size, least).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return df.join(gone, df[doc_id] == gone["_gone"], "left_anti")
