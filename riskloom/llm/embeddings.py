"""Near-duplicate embeddings by cross-polytope hashing with fast Hadamard rotations.

A hash rotates the unit vector by three rounds of random signs and a fast Walsh-Hadamard transform and takes
the signed axis it is nearest to; a table's bucket is two such hashes. Each vector lies in its own bucket
in every table and also probes the buckets of its next-best axes (multiprobe). Vectors that meet are compared
exactly, by cosine in double precision, in blocks.

Equal vectors of a label are one class first (partial aggregation), so copies cost nothing. A pair that
meets more than once counts in its first meeting only, which both vectors' codes tell, so link counts
are sums that need no list of pairs; for components a block returns a spanning forest. Buckets with over
``TILE`` classes are cut into tiles and compared tile by tile, so no task holds a whole hot bucket and none
is capped.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and rows without a
label, link with nothing and are kept; vectors of different lengths never link; repeated rows count as
vectors of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import components, saved

COSINE, TABLES, PROBES, TILE, SEED = 0.98, 4, 2, 4_096, 5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length a power of two), orthonormal."""
    n = x.shape[1]
    y, h = x, 1
    while h < n:
        y = y.reshape(len(x), n // (2 * h), 2, h)
        y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2)
        h *= 2
    return y.reshape(len(x), n) / np.sqrt(n)


def codes(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """Buckets by vector, table and probe (the first is the vector's own): int64, n x tables x (1 + probes)."""
    n, dim = unit.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    rng = np.random.default_rng(seed)
    out = np.empty((n, tables, 1 + probes), dtype=np.int64)
    for t in range(tables):
        best, loss = [], []
        for _ in range(2):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width))
            size = np.abs(y)
            top = np.argsort(-size, axis=1, kind="stable")[:, : min(3, width)]
            value = np.take_along_axis(y, top, axis=1)
            best.append(2 * top + (value < 0))
            loss.append(np.abs(value[:, :1]) - np.abs(value))
        a, b = best
        pairs = [(i, j) for i in range(a.shape[1]) for j in range(b.shape[1])]
        cost = np.stack([loss[0][:, i] + loss[1][:, j] for i, j in pairs], axis=1)
        code = np.stack([a[:, i] * (2 * width) + b[:, j] for i, j in pairs], axis=1)
        order = np.argsort(cost, axis=1, kind="stable")[:, : 1 + probes]
        out[:, t] = np.take_along_axis(code, order, axis=1)
    return out


def classes(df: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(label, v, node, n): distinct usable vectors of a label, the smallest id of each and its count."""
    own = df.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return own.where("label IS NOT NULL AND v IS NOT NULL AND id IS NOT NULL").where(sound).groupBy("label", "v").agg(F.min("id").alias("node"), F.count("*").alias("n"))


def units(x: np.ndarray) -> np.ndarray:
    """The rows, scaled to length one."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def packed(x: np.ndarray) -> list[bytes]:
    """Each row's bytes, in single precision where that loses nothing (as with vectors stored so)."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return [(s if same else v).tobytes() for s, v, same in zip(short, x, (short == x).all(axis=1), strict=True)]


def unpacked(values: list[bytes], dim: int) -> np.ndarray:
    """The rows that ``packed`` made, in double precision."""
    if len({len(v) for v in values}) == 1:
        return np.frombuffer(b"".join(values), dtype=f"f{len(values[0]) // dim}").reshape(-1, dim).astype(np.float64)
    return np.array([np.frombuffer(v, dtype=f"f{len(v) // dim}") for v in values], dtype=np.float64)


def buckets(found: DataFrame, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """A row for each bucket that a class lies in or probes: key, own, node, n, v (packed), codes."""
    label = found.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                vectors = batch.column("v").to_pylist()
                sizes = np.array([len(v) for v in vectors])
                for dim in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == dim)
                    x = np.array([vectors[i] for i in rows])
                    c = codes(units(x), tables, probes)
                    n, per = len(rows), tables * (1 + probes)
                    pick = pa.array(np.repeat(rows, per))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("label").take(pick),
                            pa.array(np.full(n * per, dim), pa.int32()),
                            pa.array(np.tile(np.repeat(np.arange(tables), 1 + probes), n), pa.int32()),
                            pa.array(c.ravel()),
                            pa.array(np.tile(np.arange(1 + probes) == 0, n * tables)),
                            batch.column("node").take(pick),
                            batch.column("n").take(pick),
                            pa.array(packed(x), pa.binary()).take(pa.array(np.repeat(np.arange(n), per))),
                            pa.array([k.astype(np.int32).tobytes() for k in c], pa.binary()).take(pa.array(np.repeat(np.arange(n), per))),
                        ],
                        names=["label", "dim", "t", "bucket", "own", "node", "n", "v", "codes"],
                    )

    return found.mapInArrow(run, f"label {label}, dim int, t int, bucket long, own boolean, node long, n long, v binary, codes binary")


def compare(t: int, bucket: int, left: tuple, right: tuple | None, least: float, shape: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """Index pairs of linked classes whose first meeting is this bucket, within one block or across two.

    A side is (units, codes, own flags). At least one of a pair must lie in the bucket itself.
    """
    ux, cx, ox = left
    uy, cy, oy = right or left
    out_i, out_j = [], []
    for at in range(0, len(ux), 1024):
        sims = ux[at : at + 1024] @ uy.T >= least
        sims &= ox[at : at + 1024, None] | oy[None, :]
        i, j = np.nonzero(sims)
        i = i + at
        if right is None:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 16):
            a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            first = np.ones(len(a), dtype=bool)
            for s in range(t + 1):
                p, q = cx[a, s], cy[b, s]
                at_p, at_q = (q == p[:, :1]).any(axis=1), (p == q[:, :1]).any(axis=1)
                if s < t:
                    first &= ~(at_p | at_q)
                else:
                    here = np.where(at_p, p[:, 0], np.iinfo(np.int32).max)
                    there = np.where(at_q, q[:, 0], np.iinfo(np.int32).max)
                    first &= np.minimum(here, there) == bucket
            out_i.append(a[first])
            out_j.append(b[first])
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.empty(0, dtype=np.int64),) * 2


def _forest(i: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, int]]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[y] = x
            yield a, b


def block_links(rows: pa.Table, least: float, shape: tuple[int, int]) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Forest edges and link counts by class of one block: rows of one bucket and pair of tiles."""
    node, n = rows.column("node").to_numpy(), rows.column("n").to_numpy()
    dim = rows.column("dim")[0].as_py()
    unit = units(unpacked(rows.column("v").to_pylist(), dim))
    code = np.frombuffer(b"".join(rows.column("codes").to_pylist()), dtype=np.int32).reshape(len(node), *shape)
    own, tile = rows.column("own").to_numpy(), rows.column("tile").to_numpy()
    t, bucket, a, b = (rows.column(c)[0].as_py() for c in ("t", "bucket", "a", "b"))
    x, y = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
    left, right = (unit[x], code[x], own[x]), (unit[y], code[y], own[y])
    i, j = compare(t, bucket, left, None if a == b else right, least, shape)
    i, j = x[i], y[j]
    counts = np.bincount(i, n[j], len(node)) + np.bincount(j, n[i], len(node))
    return [(int(node[p]), int(node[q])) for p, q in _forest(i, j)], {int(node[k]): int(counts[k]) for k in np.flatnonzero(counts)}


def links(found: DataFrame, least: float = COSINE, tables: int = TABLES, probes: int = PROBES, tile: int = TILE) -> DataFrame:
    """(a, b, n): forest edges (n null) and link counts of classes (b null)."""
    rows = buckets(found, tables, probes)
    key = ["label", "dim", "t", "bucket"]
    big = rows.groupBy(*key).agg(F.count("*").alias("_size")).where(F.col("_size") > tile)
    big = big.select(*[F.col(k).alias(f"_{k}") for k in key], F.ceil(F.col("_size") / tile).cast("int").alias("_tiles"))
    # written first: its measured size tells Catalyst whether the rows must be shuffled for the join
    big, _ = saved(big, "big")
    both = rows.join(big, [F.col(k) == F.col(f"_{k}") for k in key], "left").drop(*[f"_{k}" for k in key])
    both = both.withColumn("_tiles", F.coalesce("_tiles", F.lit(1))).withColumn("tile", F.pmod(F.xxhash64("node"), "_tiles").cast("int"))
    each = F.explode(F.transform(F.sequence(F.lit(0), F.col("_tiles") - 1), lambda o: F.struct(F.least("tile", o).alias("a"), F.greatest("tile", o).alias("b"))))
    both = both.withColumn("_at", each).select(*key, F.col("_at.a").alias("a"), F.col("_at.b").alias("b"), "tile", "own", "node", "n", "v", "codes")
    key = [*key, "a", "b"]
    shape = (tables, 1 + probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in grouped(batches, key):
            # of a pair, one at least lies in the bucket itself
            if block.num_rows < 2 or not pc.any(block.column("own")).as_py():
                continue
            edges, counts = block_links(block, least, shape)
            if edges or counts:
                a = [e[0] for e in edges] + list(counts)
                b = [e[1] for e in edges] + [None] * len(counts)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([None] * len(edges) + list(counts.values()), pa.int64())], names=["a", "b", "n"])

    return both.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long, n long")


def grouped(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The groups of rows sorted by ``key``, whole even where they span batches."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in key:
            column = batch.column(k)
            change[1:] |= np.asarray(column.slice(1).to_numpy(zero_copy_only=False) != column.slice(0, len(column) - 1).to_numpy(zero_copy_only=False))
        first = tuple(batch.column(k)[0].as_py() for k in key)
        if held and first != last:
            yield pa.concat_tables(held)
            held = []
        bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, end in zip(bounds[:-2], bounds[1:-1], strict=True):
            held.append(table.slice(start, end - start))
            yield pa.concat_tables(held)
            held = []
        held.append(table.slice(bounds[-2], bounds[-1] - bounds[-2]))
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in key)
    if held:
        yield pa.concat_tables(held)


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", least: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    found, _ = saved(classes(df, vec_id, label, vector), "vectors")
    out, _ = saved(links(found, least), "links")
    tops = components(out.where("b IS NOT NULL"), "a", "b", "vectors")
    counts = out.where("b IS NULL").groupBy(F.col("a").alias("_a")).agg(F.sum("n").alias("_more"))
    known = found.join(tops, found["node"] == tops["node"], "left").drop(tops["node"]).join(counts, F.col("node") == F.col("_a"), "left")
    known = known.select(F.col("label").alias("_label"), F.col("v").alias("_v"), (F.col("n") - 1 + F.coalesce("_more", F.lit(0))).alias("_links"), F.coalesce("component", "node").alias("_component"))
    own = df.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("_l"), F.col(f"`{vector}`").cast("array<double>").alias("_w"))
    joined = own.join(known, (F.col("_l") == F.col("_label")) & (F.col("_w") == F.col("_v")), "left")
    component = F.coalesce("_component", "vec_id")
    return joined.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
