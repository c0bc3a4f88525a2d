"""Best-fit packing planned on the length histogram.

Documents are tokenised once; what travels afterwards are narrow rows (document, piece, start, length,
checksum). The driver sees only the histogram of lengths, at most ``capacity`` rows at any corpus size. It
runs best-fit decreasing over counts: all pieces of a length are placed at once into groups of sequences
with the same free space, so the plan has few entries however many documents there are. Documents take
their planned slots by a join on (length, rank within length).

Ranks within a length come from hash buckets (``common.running``), so a very common length is many
windows. The plan is broadcast; its size depends on ``capacity`` alone and is checked (``MAX_PLAN``),
beyond which the join shuffles.

Defined results: a null text is an empty one; each row is packed, repeated rows each on their own; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import contextlib
import ctypes
import gc
import os
import re
import threading
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import buckets_for, running, saved, spread

CAPACITY, END_ID, MAX_PLAN = 2048, 0, 200_000
#: Entries of a worker's cache of letter runs; about 200 bytes each. Chunks get a third of that.
CACHE = 600_000
#: Seconds without a task after which a worker forgets its tokenizer and caches.
IDLE = 2.0


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The tokenizer's own split of normalised text, for code points below U+0250.
_LETTER = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_NUMBER = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\x20\x09-\x0D\x85\xa0{_LETTER}{_NUMBER}]+")
_LATIN = re.compile("[\x00-\u012f\u0131-\u024f]*")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level BPE vocabularies, as a translation of Latin-1."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Ids of texts, by white-space delimited chunk.

    The tokenizer drops white space and never merges across it, so the ids of a text are those of its chunks
    in a row; and those of a chunk are those of its letter runs, digits and symbol runs. A batch of texts is
    split and dictionary-encoded by Arrow, so Python meets each distinct chunk of a batch once; new runs
    go to the tokenizer many at a time, and chunks with other scripts or special tokens on their own.
    Both caches are bounded and start anew when full.
    """

    def __init__(self, path: str, limit: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.chunks: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _learn_runs(self, runs: list[str]) -> None:
        """Runs joined by blanks stay runs of their own; word_ids tells whose each id is."""
        for at in range(0, len(runs), 2000):
            part = runs[at : at + 2000]
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(got.ids, dtype="<u4").tobytes()
            ends = np.cumsum(np.bincount(np.array(got.word_ids, dtype=np.int64), minlength=len(part))).tolist()
            if len(ends) != len(part):  # a run is not one word to the tokenizer: each on its own
                self.runs.update((run, self._encode(run)) for run in part)
                continue
            start = 0
            for run, end in zip(part, ends, strict=True):
                self.runs[run] = ids[4 * start : 4 * end]
                start = end

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def of_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks."""
        if len(self.chunks) > self.limit // 3:
            self.chunks.clear()
        if len(self.runs) > self.limit:
            self.runs.clear()
        found = list(map(self.chunks.get, chunks))
        new = [(i, chunks[i]) for i, x in enumerate(found) if x is None]
        split: list[tuple[int, list[str]]] = []
        for i, chunk in new:
            low = (chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)).lower()
            # some capitals below U+0250 have their small letters above it
            if "<|" in chunk or not (chunk.isascii() or _LATIN.fullmatch(chunk) and _LATIN.fullmatch(low)):
                found[i] = self._encode(chunk)
            else:
                split.append((i, _SPLIT.findall(low)))
        missing = {run for _, own in split for run in own}.difference(self.runs)
        self._learn_runs(list(missing))
        runs = self.runs
        for i, own in split:
            found[i] = b"".join([runs[run] for run in own])
        for i, chunk in new:
            if len(chunk) <= 48:
                self.chunks[chunk] = found[i]
        return found

    def of_texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text."""
        clean = pc.replace_substring_regex(pc.fill_null(texts, ""), "[\\n\\t\\r]", " ")
        lists = pc.split_pattern(clean.cast(pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        gc.disable()  # nothing here is cyclic, and the collector would walk the caches again and again
        try:
            made = self.of_chunks(coded.dictionary.to_pylist())
        finally:
            gc.enable()
        ids = np.frombuffer(b"".join(made), dtype="<u4")
        sizes = np.fromiter(map(len, made), dtype=np.int64, count=len(made)) // 4
        starts = np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy(zero_copy_only=False)
        per = sizes[index]
        ends = np.concatenate([[0], np.cumsum(per)])
        gather = np.repeat(starts[index] - ends[:-1], per) + np.arange(ends[-1])
        flat = ids[gather]
        bounds = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield flat[a:b].tobytes()


_WORDS: dict[str, WordIds] = {}


def _words(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS.clear()
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


_TIMERS: list[threading.Timer] = []


def _busy() -> None:
    """A task begins: caches stay."""
    while _TIMERS:
        _TIMERS.pop().cancel()


def _idle() -> None:
    """A task has ended. Spark keeps its worker, also for other stages, whose memory the caches would take."""
    _busy()
    _TIMERS.append(threading.Timer(IDLE, _forget))
    _TIMERS[-1].daemon = True
    _TIMERS[-1].start()


def _forget() -> None:
    """Give the memory back to the system; a task that begins meanwhile keeps what it holds."""
    _WORDS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def _ids(words: WordIds, texts: pa.Array, most: int = 8 << 20) -> Iterator[bytes]:
    """The ids of each text, worked out for about ``most`` bytes of text at a time."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield from words.of_texts(texts.slice(start, end - start))
        start = end


def pieces(df: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Per piece of a document: (doc_id, piece, start, length, ids_crc32[, ids])."""
    path = path or tokenizer_path()
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = dict(df.dtypes)[doc_id]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            docs, texts = batch.column(0).to_pylist(), batch.column(1)
            for doc, body in zip(docs, _ids(words, texts), strict=True):
                ids = body + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (doc, k, at // 4, len(cut) // 4, zlib.crc32(cut), cut), strict=True):
                        column.append(value)
            fields = [pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int32()), *[pa.array(c, pa.int64()) for c in out[2:5]]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                fields, names = [*fields, pa.array(out[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(fields, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _busy()
        try:
            yield from tokenised(batches)
        finally:
            _idle()

    return df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first_rank, count, first_sequence, offset) entries.

    Groups are runs of consecutive sequences filled alike. A length goes to the group with the least
    sufficient free space first; what is left opens new sequences, as many to a sequence as fit.
    """
    groups: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []
    entries, n_sequences = [], 0

    def put(space: int, group: tuple[int, int]) -> None:
        if not space:
            return
        if space not in groups:
            groups[space] = []
            bisect.insort(spaces, space)
        groups[space].append(group)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                per = capacity // length
                whole, rest = divmod(left, per)
                for sequences, stacked in ((whole, per), (1 if rest else 0, rest)):
                    if not sequences:
                        continue
                    for k in range(stacked):
                        entries.append((length, rank, sequences, n_sequences, k * length))
                        rank += sequences
                    put(capacity - stacked * length, (n_sequences, sequences))
                    n_sequences += sequences
                left = 0
                break
            space = spaces[at]
            first, n = groups[space].pop()
            if not groups[space]:
                del groups[space]
                spaces.pop(at)
            used = min(n, left)
            entries.append((length, rank, used, first, capacity - space))
            rank, left = rank + used, left - used
            put(space - length, (first, used))
            if used < n:
                put(space, (first + used, n - used))
    return entries


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with doc_id, piece, start, length and ids_crc32."""
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 0 < x <= capacity for x in counts):
        raise ValueError("a length is outside 1..capacity")
    entries = plan(counts, capacity)
    table = pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("_length", "_rank", "_count", "_sequence", "_offset"), zip(*entries, strict=True) if entries else [[]] * 5, strict=True)})
    slots = spark.createDataFrame(table)
    slots = F.broadcast(slots) if len(entries) <= MAX_PLAN else slots
    keyed = parts.withColumn("_key", spread("doc_id", "piece")).withColumn("_one", F.lit(1))
    ranked = running(keyed, ["length"], ["_key", "doc_id", "piece", "ids_crc32"], "_one", buckets_for(sum(counts.values())), "_nth")
    on = (F.col("length") == F.col("_length")) & (F.col("_nth") >= F.col("_rank")) & (F.col("_nth") < F.col("_rank") + F.col("_count"))
    placed = ranked.join(slots, on)
    return placed.select(*parts.columns, (F.col("_sequence") + F.col("_nth") - F.col("_rank")).alias("sequence_id"), F.col("_offset").alias("offset"))


def pack_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack; the pieces are written once to the shared folder, as both passes read them."""
    parts, _ = saved(pieces(df, doc_id, text, capacity, path, with_ids=with_ids), "pieces")
    return pack(parts, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and its token ids as little-endian unsigned 32-bit bytes.

    Needs ``with_ids``. A sequence has at most ``capacity`` pieces, so a group is bounded.
    """
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return rows.select("sequence_id", _joined(F.col("p")).alias("ids"), F.size("p").alias("n_pieces"))


def _joined(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
