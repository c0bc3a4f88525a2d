"""Removal of repeated byte strings by a hash-compared suffix sort.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere in the corpus goes. A window of
LENGTH bytes has one anchor: its leftmost smallest ``GRAM``-byte gram by hash. Equal windows have equal
anchors at equal places, so only windows whose anchors' hashes are equal can be equal, and anchors are
few: about one in 75 bytes. An anchor's *context* is all bytes of the windows that it anchors.

1. Documents give narrow anchor rows; counts by (anchor, context hash) aggregate partially. Contexts that
   occur twice or more are repeats as a whole.
2. One join of documents with the anchors that ask: repeated contexts are verified by the SHA-256 of their bytes
   (a collision does all anew with other hashes), and one of each kind gives its bytes where an anchor has
   several kinds.
3. Their windows are suffixes to sort. Suffixes are compared through prefix polynomial hashes: binary search
   finds the common extension in log2(LENGTH) steps, the next byte decides. A bottom-up mergesort over
   whole arrays brings equal windows together; neighbours with a common extension of LENGTH bytes are
   verified byte by byte. A task sorts groups of at most ``GROUP`` contexts; the windows of anchors with
   more are first split into such groups by cells of offsets and their cores (``split_groups``).
4. Intervals meet their documents again, which lose the union.

Defined results: null texts are empty; texts under LENGTH bytes lose nothing; matches never cross documents;
strings are judged on the input; repeated rows are documents of their own and so repeat each other (a row
is known by a 64-bit hash of id and text, checked by a second, so ids may repeat or be null); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import remove, saved
from riskloom.llm.embeddings import grouped

LENGTH, GRAM = 200, 48
#: Contexts that one task sorts together, at most: about 150 windows each.
GROUP = 2_048
#: Widths of the cells of window offsets by which larger groups are split, each a divisor of the one before.
CELLS = (32, 8, 2, 1)
#: Odd multipliers of the polynomial hashes (mod 2^64) and of the mixer.
BASE, BASE2, MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


class Powers:
    """Powers of an odd base and of its inverse mod 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, step in (("up", self.base), ("down", self.inverse)):
                out = np.full(size, step, dtype=np.uint64)
                out[0] = 1
                setattr(self, name, np.multiply.accumulate(out))
        return self.up[:n], self.down[:n]


_POWERS: dict[int, Powers] = {}


def powers(base: int) -> Powers:
    if base not in _POWERS:
        _POWERS[base] = Powers(base)
    return _POWERS[base]


def prefix_hashes(data: np.ndarray, base: int = BASE) -> np.ndarray:
    """P[i] = sum of (byte + 1) x base^j over j < i, mod 2^64."""
    up, _ = powers(base).to(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    """The hash of bytes [start, end), the same wherever they stand."""
    _, down = powers(base).to(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(BASE)
    return h ^ (h >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, by prefix and suffix minima of blocks."""
    n = len(values)
    pad = -n % width
    full = np.concatenate([values, np.full(pad, _MASK, dtype=np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM, base: int = BASE2) -> tuple[np.ndarray, ...]:
    """(hash, context hash, place, first window, last window) of each anchor of a text of at least ``length`` bytes."""
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - gram + 1)
    h = mixed(range_hash(prefix, at, at + gram))
    key = (h >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    owner = (sliding_min(key, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(owner) - 1]])
    place = owner[first]
    second = prefix_hashes(data, base)
    end = last + length
    context = mixed(range_hash(prefix, first, end) ^ mixed(range_hash(second, first, end, base)) ^ mixed(((place - first).astype(np.uint64) << np.uint64(32)) | (end - first).astype(np.uint64)))
    return h[place], context, place, first, last


def anchor_rows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bits: int = 64, base: int = BASE2) -> DataFrame:
    """(row, h, c, place, first, last) for the anchors of ``docs`` (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            n = 0
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = np.frombuffer(value.as_buffer() or b"", dtype=np.uint8) if value.is_valid else np.empty(0, dtype=np.uint8)
                if len(data) >= length:
                    h, context, *rest = anchors(data, length, gram, base)
                    parts.append((np.full(len(h), row), h, context >> np.uint64(64 - bits), *rest))
                    n += len(h)
                if n >= 200_000:
                    yield _anchor_batch(parts)
                    parts, n = [], 0
            if parts:
                yield _anchor_batch(parts)

    return docs.select("row", "text").mapInArrow(run, "row long, h long, c long, place int, first int, last int")


def _anchor_batch(parts: list[tuple]) -> pa.RecordBatch:
    row, h, c, place, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
    arrays = [pa.array(row, pa.int64()), pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), *[pa.array(x.astype(np.int32)) for x in (place, first, last)]]
    return pa.RecordBatch.from_arrays(arrays, names=["row", "h", "c", "place", "first", "last"])


class Suffixes:
    """Suffixes of joined contexts, compared by hashes of their bytes up to ``length``."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.prefix = data, length, prefix_hashes(data)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of suffixes a and b, at most ``length``, by binary search over hash equality."""
        low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), self.length, dtype=np.int64)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = range_hash(self.prefix, a, a + mid) == range_hash(self.prefix, b, b + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """a < b by their first ``length`` bytes; equal ones count as ``ties`` says."""
        ext = self.extension(a, b)
        out = ties.copy()
        open_ = ext < self.length
        out[open_] = self.data[a[open_] + ext[open_]] < self.data[b[open_] + ext[open_]]
        return out

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Byte-by-byte verification."""
        out = np.empty(len(a), dtype=bool)
        span = np.arange(self.length)
        for at in range(0, len(a), 8192):
            s = slice(at, at + 8192)
            out[s] = (self.data[a[s, None] + span] == self.data[b[s, None] + span]).all(axis=1)
        return out

    def head(self, at: np.ndarray) -> np.ndarray:
        """The first eight bytes as a big-endian number."""
        out = np.zeros(len(at), dtype=np.uint64)
        for k in range(8):
            out = (out << np.uint64(8)) | self.data[at + k].astype(np.uint64)
        return out


def sort_suffixes(s: Suffixes, block: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order of suffixes ``at`` within their blocks: by head, then bottom-up mergesort of those with equal heads.

    All merges of a level run at once: each element finds its rank in the partner run by binary search.
    """
    head = s.head(at)
    order = np.lexsort((head, block))
    new = np.concatenate([[True], (block[order][1:] != block[order][:-1]) | (head[order][1:] != head[order][:-1])])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(order)))
    tied = np.repeat(size > 1, size)
    if not tied.any():
        return order
    places = np.flatnonzero(tied)
    begin, length = np.repeat(start, size)[places], np.repeat(size, size)[places]
    width, most = 1, int(size.max())
    while width < most:
        now = at[order]
        live = length > width
        p, b, n = places[live], begin[live], length[live]
        inside = p - b
        run = inside // width
        partner = run ^ 1
        low0 = b + np.minimum(partner * width, n)
        high = b + np.minimum((partner + 1) * width, n)
        low, left = low0.copy(), run % 2 == 0
        while (todo := np.flatnonzero(low < high)).size:
            mid = (low[todo] + high[todo]) // 2
            # a left element goes before equal right ones, a right element after equal left ones
            before = s.less(now[mid], now[p[todo]], ~left[todo])
            low[todo] = np.where(before, mid + 1, low[todo])
            high[todo] = np.where(before, high[todo], mid)
        pair = b + (run // 2) * 2 * width
        target = pair + (inside % width) + (low - low0)
        moved = order.copy()
        moved[target] = order[p]
        order = moved
        width *= 2
    return order


def repeated_windows(contexts: list[bytes], block: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which windows equal another of the same block and anchor offset: (context, window, repeated).

    A context of n bytes has n - length + 1 windows; ``offsets`` is its anchor's place in it.
    """
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    per = sizes - length + 1
    owner = np.repeat(np.arange(len(contexts)), per)
    window = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    at = starts[owner] + window
    key = block[owner] * np.int64(1 << 16) + (offsets[owner] - window)
    s = Suffixes(data, length)
    order = sort_suffixes(s, key, at)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(key[a] == key[b])
    near = near[s.extension(at[a[near]], at[b[near]]) >= length]
    near = near[s.equal(at[a[near]], at[b[near]])]
    out = np.zeros(len(at), dtype=bool)
    out[a[near]] = out[b[near]] = True
    return owner, window, out


def _runs(owner: np.ndarray, window: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, ...]:
    """(context, first, last) of the runs of consecutive repeated windows."""
    k = np.flatnonzero(hit)
    if not len(k):
        return (np.empty(0, dtype=np.int64),) * 3
    cut = np.concatenate([[True], (owner[k][1:] != owner[k][:-1]) | (window[k][1:] != window[k][:-1] + 1)])
    end = np.concatenate([cut[1:], [True]])
    return owner[k][cut], window[k][cut], window[k][end]


def _intervals(tables: list[pa.Table], length: int) -> pa.RecordBatch | None:
    """Intervals to remove, from groups of contexts that share an anchor."""
    table = pa.concat_tables(tables)
    block = np.repeat(np.arange(len(tables)), [t.num_rows for t in tables])
    first, place = table.column("first").to_numpy(), table.column("place").to_numpy()
    contexts = table.column("bytes").to_pylist()
    sizes = np.array([len(c) for c in contexts])
    owner, start, end = _runs(*repeated_windows(contexts, block, (place - first).astype(np.int64), sizes, length))
    keep = ~table.column("whole").to_numpy(zero_copy_only=False)[owner]
    owner, start, end = owner[keep], start[keep], end[keep]
    if not len(owner):
        return None
    return pa.RecordBatch.from_arrays([pa.array(table.column("row").to_numpy()[owner]), pa.array((first[owner] + start).astype(np.int32)), pa.array((first[owner] + end + length).astype(np.int32))], names=["row", "start", "end"])


def cell_keys(width: int, length: int):
    """For mapInArrow: the hashes by which a context's cell of window offsets is looked up.

    The offset of a window is its anchor's place in it; a cell holds ``width`` offsets. Its core is what all
    windows of the cell share, its hull their union (null where the context lacks one of the windows).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core, hull, part = [], [], []
            first, place, cell = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("first", "place", "cell"))
            for i, value in enumerate(batch.column(batch.schema.get_field_index("bytes")).to_pylist()):
                prefix = prefix_hashes(np.frombuffer(value, dtype=np.uint8))
                most = place[i] - first[i]
                low, high = cell[i] * width, (cell[i] + 1) * width - 1
                start, end = np.array([most - low, most - high]), np.array([most - high + length, most - low + length])
                whole = most - (len(value) - length) <= low and high <= most
                known = mixed(range_hash(prefix, start[: 1 + whole], end[: 1 + whole])).view(np.int64).tolist()
                core.append(known[0])
                hull.append(known[1] if whole else None)
                part.append(value[start[1] : end[1]] if whole else None)
            arrays = [pa.array(core, pa.int64()), pa.array(hull, pa.int64()), pa.array(part, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, "core", "hull", "part"])

    return run


def split_groups(contexts: DataFrame, scratch: list[str], length: int = LENGTH, group: int = GROUP, cells: tuple[int, ...] = CELLS) -> tuple[DataFrame, DataFrame]:
    """Groups that one task can sort, (h, k) of at most ``group`` contexts, and intervals found on the way.

    The windows of an anchor with more contexts than that are cut into cells of offsets: windows can be equal
    only within a cell and between contexts that share the cell's core, so a cell and a core make a group of
    their own. In one that is still too large, contexts with the same hull, byte for byte, repeat each other
    as a whole and one of them goes on for the rest; then cells get narrower, down to single windows, where
    core and hull are one. Cells only split the work: every group that is left is sorted like any other.
    """
    spark = contexts.sparkSession
    intervals = spark.createDataFrame([], "row long, start int, end int")
    groups = contexts.where(F.col("kinds") <= group).select("row", "h", F.lit(0).cast("long").alias("k"), "first", "place", "whole", "bytes")
    state = contexts.where(F.col("kinds") > group).select("row", "h", "first", "place", "whole", "bytes", F.lit(0).alias("cell"))
    parent = 0
    for width in cells:
        if state.isEmpty():
            break
        most = F.col("place") - F.col("first")
        low = F.floor((most - (F.length("bytes") - length)) / width).cast("int")
        high = F.floor(most / width).cast("int")
        if parent:
            low, high = F.greatest(low, F.col("cell") * (parent // width)), F.least(high, (F.col("cell") + 1) * (parent // width) - 1)
        cut = state.select("row", "h", "first", "place", "whole", "bytes", F.explode(F.sequence(low, high)).alias("cell"))
        keys, path = saved(cut.mapInArrow(cell_keys(width, length), "row long, h long, first int, place int, whole boolean, bytes binary, cell int, core long, hull long, part binary"), "cells")
        shared = keys.where("hull IS NOT NULL").groupBy(*[F.col(c).alias(f"{c}_") for c in ("h", "cell", "hull", "part")]).agg(F.count("*").alias("n"), F.min(F.struct("row", "first")).alias("one")).where("n > 1")
        # the bytes are no key of the join, so that it shuffles anew and AQE can split a string that very many share
        same = [F.col(c) == F.col(f"{c}_") for c in ("h", "cell", "hull")] + [F.col("part").between(F.col("part_"), F.col("part_"))]
        judged = keys.join(shared, same, "left").select(*keys.columns, F.col("n").isNotNull().alias("again"), (F.struct("row", "first") == F.col("one")).alias("leads"))
        judged, judged_path = saved(judged, "judged")
        scratch += [path, judged_path]
        bottom = F.col("place") - F.col("cell") * width
        intervals = intervals.unionByName(judged.where("again AND NOT whole").select("row", (bottom - (width - 1)).alias("start"), (bottom + length).alias("end")))
        if width == cells[-1]:
            break
        left = judged.where("NOT again OR leads").withColumn("whole", F.col("whole") | F.col("again"))
        sizes = left.groupBy(*[F.col(c).alias(f"{c}_") for c in ("h", "cell", "core")]).agg(F.count("*").alias("n")).where("n > 1")
        # written, so that the join shuffles anew and can split a core that very many share
        sizes, path = saved(sizes, "sizes")
        scratch.append(path)
        left = left.join(sizes, [F.col(c) == F.col(f"{c}_") for c in ("h", "cell", "core")]).select(*judged.columns, "n")
        left, path = saved(left, "left")
        scratch.append(path)
        # of a context, the part with the cell's windows
        skip = F.greatest(F.lit(0), most - ((F.col("cell") + 1) * width - 1))
        size = F.least(F.length("bytes"), most - F.col("cell") * width + length) - skip
        part = F.substring(F.col("bytes"), skip + 1, size)
        ready = left.where(F.col("n") <= group)
        groups = groups.unionByName(ready.select("row", "h", F.xxhash64(F.lit(width), "cell", "core").alias("k"), (F.col("first") + skip).alias("first"), "place", "whole", part.alias("bytes")))
        state, parent = left.where(F.col("n") > group), width
    return groups, intervals


def find_contexts(docs: DataFrame, length: int, gram: int, bits: int, base: int) -> tuple[DataFrame, str, bool]:
    """Contexts that are repeated (``whole``) or to be sorted (with their bytes), one of each kind; and whether all
    contexts that count as copies are so by their SHA-256 and all rows of one hash by a second hash.

    Repeated rows of a document ask once and are met once; their copies are in the counts.
    """
    spark = docs.sparkSession
    rows, rows_path = saved(anchor_rows(docs, length, gram, bits, base), "anchors")
    kinds = rows.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("row", "first")).alias("one"))
    kinds = kinds.groupBy("h").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).where("n > 1").join(kinds.withColumnRenamed("n", "m").withColumnRenamed("h", "h_"), F.col("h") == F.col("h_"))
    kinds, kinds_path = saved(kinds.where("m > 1 OR kinds > 1").select("h", "c", "kinds", "m", "one"), "kinds")
    marked = rows.join(kinds.withColumnsRenamed({"h": "h_", "c": "c_"}), (F.col("h") == F.col("h_")) & (F.col("c") == F.col("c_")))
    ask = F.struct("h", "c", "place", "first", "last", (F.col("m") > 1).alias("whole"), "kinds", ((F.col("kinds") > 1) & (F.struct("row", "first") == F.col("one"))).alias("sort"))
    asked = marked.groupBy(F.col("row").alias("row_")).agg(F.collect_set(ask).alias("asked"))
    met = docs.join(asked, F.col("row") == F.col("row_")).groupBy("row").agg(F.first("text").cast("binary").alias("data"), F.first("asked").alias("asked"), (F.min("check") == F.max("check")).alias("same"))

    def cut(a: Column) -> Column:
        body = F.substring(F.col("data"), a["first"] + 1, a["last"] - a["first"] + length)
        digest = F.when(a["whole"], F.substring(F.unhex(F.sha2(body, 256)), 1, 16))
        sorted_only = [F.when(a["sort"], a[c]).alias(c) for c in ("place", "kinds")]
        return F.struct(*[a[c].alias(c) for c in ("h", "c", "first", "last", "whole", "sort")], *sorted_only, digest.alias("digest"), F.when(a["sort"], body).alias("bytes"))

    met, path = saved(met.select("row", "same", F.inline(F.transform("asked", cut))), "contexts", "zstd")
    sound = met.where("whole").groupBy("h", "c").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").isEmpty() and met.where("NOT same").isEmpty()
    remove(spark, rows_path, kinds_path)
    return met, path, sound


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP, bits: int = 64, with_text: bool = False, row_bits: int = 64) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept (binary)].

    ``bits``, ``row_bits``: of the hashes of contexts and rows; where two collide, all is done anew with other
    hashes of 64.
    """
    spark, kind = df.sparkSession, dict(df.dtypes)[doc_id]
    docs = df.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    attempt, sound, plain = 0, False, docs
    while not sound:
        row = F.shiftrightunsigned(F.xxhash64(F.lit(attempt), "doc", "text"), 64 - row_bits if row_bits < 64 and not attempt else 0)
        docs = plain.withColumn("row", row).withColumn("check", F.xxhash64(F.lit(-1 - attempt), "doc", "text"))
        contexts, path, sound = find_contexts(docs, length, gram, 64 if attempt else bits, BASE2 + attempt * 0x2468ACE2)
        attempt += 1
        if not sound:
            remove(spark, path)
    whole = contexts.where("whole").select("row", F.col("first").alias("start"), (F.col("last") + length).alias("end"))

    def sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for one in grouped(batches, ["h", "k"]):
            if one.num_rows > 1:
                held.append(one)
                n += one.num_rows
            if n >= group:
                if (out := _intervals(held, length)) is not None:
                    yield out
                held, n = [], 0
        if held and (out := _intervals(held, length)) is not None:
            yield out

    paths = [path]
    groups, hulls = split_groups(contexts.where("sort"), paths, length, group)
    sorted_ = groups.repartition("h", "k").sortWithinPartitions("h", "k").mapInArrow(sort_groups, "row long, start int, end int")
    spans = whole.unionByName(sorted_).unionByName(hulls).groupBy(F.col("row").alias("row_")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    spans, _ = saved(spans, "spans")
    remove(spark, *paths)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for value, found in zip(batch.column(1), batch.column(2), strict=True):
                body = value.as_buffer().to_pybytes() if value.is_valid else b""
                done, pieces, n, removed = 0, [], 0, 0
                reach = -1
                for s, e in ((x["start"], x["end"]) for x in found.as_py() or []):
                    if s > reach:
                        n += 1
                        pieces.append(body[done:s])
                        removed += e - s
                    elif e > reach:
                        removed += e - reach
                    reach = max(reach, e)
                    done = reach
                kept = b"".join([*pieces, body[done:]])
                for c, v in zip(cols, (len(body), removed, n, hashlib.sha256(kept).hexdigest(), kept if with_text else None), strict=True):
                    c.append(v)
            arrays = [batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array(cols[4], pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    done = docs.join(spans, F.col("row") == F.col("row_"), "left").select("doc", "text", "spans")
    return done.mapInArrow(strip, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
