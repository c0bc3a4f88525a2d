"""run() of the corpus pipeline against a plain version of its five stages, which shares no code with them."""

import re
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from test_shingles import brute_tops, planted
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm import packing

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_quality(rows):
    kept = []
    for row in rows:
        text = row[1] or ""
        words = WORD.findall(text)
        n, windows = len(words), [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        seen = Counter(windows)
        again = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        chars = sum(map(len, words))
        bad = n < 10 or 100 * len(again) > 20 * n or 10 * len(re.findall("[#*$%&|<>]", text)) > 3 * n
        bad = bad or 10 * (len(lines) - len(set(lines))) > 3 * len(lines) or chars < 2 * n or chars > 20 * n
        if not (bad or 2 * len(re.findall("[!?]{2,}", text)) > n):
            kept.append(row)
    return kept


def plain_lines(rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text, *rest in rows:
        keep = [x for x in (text or "").split("\n") if len(key(x)) < 10 or min(holders[key(x)]) == doc]
        out.append((doc, "\n".join(keep), *rest))
    return out


def plain_near(rows):
    rows = sorted(rows)
    tops = brute_tops([r[1] for r in rows])
    return [r for i, r in enumerate(rows) if tops[i] == i]


def plain_mix(rows):
    def key(doc):
        return xxhash.xxh64_intdigest(struct.pack("<q", doc), xxhash.xxh64_intdigest(struct.pack("<i", 7), 42)) & ((1 << 62) - 1)

    sizes = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    own = {s: sorted((r for r in rows if r[3] == s), key=lambda r: key(r[0])) for s in sources}
    total = {s: sum(sizes[r[0]] for r in own[s]) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    left, open_, target = 1.5 * sum(total.values()), set(sources), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * total[s]}
        for s in full or open_:
            target[s] = 2 * total[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    out = []
    for s in sources:
        rest = int(target[s] + 0.5)
        for row in [r for _ in range(3) for r in own[s] if sizes[r[0]]]:
            if rest <= 0:
                break
            n = min(rest, sizes[row[0]])
            text = row[1] if n == sizes[row[0]] else re.match(f"(?:[ \t-\r]*[^ \t-\r]+){{{n}}}", row[1])[0]
            out.append((row[0], text))
            rest -= n
    return out


def plain_pieces(rows):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    out = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            out.append((doc, k // 2048, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return out


def plain_best_fit(lengths, capacity=2048):
    """The number of sequences of best-fit decreasing over single pieces."""
    spaces = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, s in enumerate(spaces) if s >= n]
        if fits:
            spaces[min(fits, key=lambda i: spaces[i])] -= n
        else:
            spaces.append(capacity - n)
    return len(spaces)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """The small table with near copies at 60 to 95 %, exact copies, shared lines, odd texts and a null source."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    top = max(r[0] for r in rows)
    new = [*planted(seed=8, groups=20), None, "", " \n ", *[r[1] for r in rows[:15]], *[f"{r[1]}\nOne line that many documents share, in any case" for r in rows[40:60]]]
    rows += [(top + 1 + i, t, "en", [None, "a", rows[0][3]][i % 3], len(t or "")) for i, t in enumerate(new)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_run(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "pack_sequences"]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    sizes = [len(rows)]
    for stage in (plain_quality, plain_lines, plain_near):
        rows = stage(rows)
        sizes.append(len(rows))
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] + 20
    want = plain_pieces(plain_mix(rows))
    got = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert Counter(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == Counter(want)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 2048
    assert got.sequence_id.nunique() <= plain_best_fit(x[3] for x in want)


def test_plan_is_best_fit():
    import random

    r = random.Random(9)
    for _ in range(60):
        capacity = r.choice([50, 97, 2048])
        lengths = [min(capacity, max(1, int(r.expovariate(r.choice([3, 8]) / capacity)))) for _ in range(r.randint(1, 400))]
        entries = packing.plan(Counter(lengths), capacity)
        load = Counter()
        for length, _, count, sequence, offset in entries:
            for k in range(count):
                load[sequence + k] = max(load[sequence + k], offset + length)
        assert sum(e[0] * e[2] for e in entries) == sum(lengths) == sum(load.values())
        assert len(load) == plain_best_fit(lengths, capacity)


def test_idle_workers_forget_the_tokenizer(spark):
    """Workers that other stages take over hold nothing of packing any more."""
    import time

    def held(batches):
        import os

        import pyarrow as pa

        from riskloom.llm import packing

        for b in batches:
            time.sleep(0.5)  # so that each worker takes part
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()] * b.num_rows, pa.int64()), pa.array([len(packing._WORDS)] * b.num_rows, pa.int64())], names=["pid", "n"])

    def probe():
        return {r["pid"]: r["n"] for r in spark.range(0, 4, 1, 4).mapInArrow(held, "pid long, n long").collect()}

    df = spark.range(0, 400, 1, 4).selectExpr("id AS doc_id", "concat('some words ', id) AS text")
    assert packing.pieces(df).count() == 400
    before = probe()
    assert any(before.values())
    time.sleep(packing.IDLE + 2)
    after = probe()
    assert set(before) & set(after) and not any(after.values())
