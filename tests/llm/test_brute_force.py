"""Operators that SQL cannot express against plain versions, on the test tables and on odd texts."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from riskloom.llm import embeddings, packing, pii, secrets, simhash

SF = "/root/testdata/sf0.001"
ODD = [None, "", "a@b@c.d.e x@y.z@q.r", "1.2.3.4.5.6.7.8 256.1.1.1 01.02.03.004", "4111 1111-1111 1111 1 4111111111111111 4111  1111", "+1 (743) 555-3824+49 30.1234567 +1-2", "٤111111111111111 ４１１１", "ſecret=abcdefgh PASSWORD : 'xyz123' api_key=\"a/b+c=d\" apikey:short", "AKIA" * 9 + " AKIAabc", "0123456789abcdef" * 3 + "G" + "deadbeef" * 2, "token token=token=token1 secret:=x", "x" * 5000 + "@", "1" * 5000, "+" + "1 " * 3000, "émail aé@b.c"]


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    r = random.Random(6)
    made = ["".join(r.choice(["@", ".", "+", "-", " ", "(", "1", "23", "4111111111111111", "a", "AKIA", "token=", "secret: '", "0a1b", "\n", "é"]) for _ in range(r.randint(1, 60))) for _ in range(300)]
    return [d["text"] for d in docs] + ODD + made


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(s):
    return re.sub("[^0-9]", "", s)


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits_of(m[0])) <= 19 and luhn(digits_of(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits_of(m[0])) <= 15),
)
SECRETS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
)


@pytest.mark.parametrize(("find", "kinds"), [(pii.find, PII), (secrets.find, SECRETS)])
def test_base_spans(docs, texts, find, kinds):
    for r in find(docs).collect():
        text, spans = texts[r["doc_id"]] or "", []
        for rank, (kind, pattern, good) in enumerate(kinds):
            if kind != "email" or len(text) < 4000:
                own = [m for m in re.finditer(pattern, text, re.ASCII) if good(m)]
                assert r[f"n_{kind}"] == len(own), (kind, text[:80])
                spans += [(m.start(), rank, m.end(), kind) for m in own]
        if len(text) < 4000:
            base = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
            assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), text[:80]
            assert set(base.split(",")) <= set(r["spans"].split(","))


def test_fingerprints(docs, texts):
    for r in simhash.fingerprints(docs).collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]] or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert r["fp"] % (1 << 64) == want


def test_ids_of_all_letters(texts):
    """The fast path against the tokenizer: every code point below U+3000 among letters, digits and quotes, and real texts."""
    words = packing.WordIds(packing.tokenizer_path())
    cases = [f"x{chr(c)}Y 5-{chr(c)} {chr(c)}'s A{chr(c)}{chr(c)} {chr(c)}1" for c in range(0x3000)]
    cases += [f"{chr(c)}{x} {x}{chr(c)}" for c in range(0x250) for x in ("5-", "İ", "́", "'ll", "<", "\x85")]
    cases += ["Əli HƏYAT HEYDƏR ƏLİYEV 5-Ə 1Ɓ's", *[t or "" for t in texts]]
    got = words.of_texts(pa.array(cases))
    assert [c for c, g, e in zip(cases, got, words.tokenizer.encode_batch(cases, add_special_tokens=False), strict=True) if g != np.array(e.ids, dtype="<u4").tobytes()] == []


@pytest.mark.parametrize("dim", [64, 384])
def test_embedding_recall(spark, dim):
    """Pairs at a cosine just above the threshold: at least 0.9 are found."""
    rng = np.random.default_rng(dim)
    a = rng.normal(size=(400, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(400, dim))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.981 * a + np.sqrt(1 - 0.981**2) * b
    rows = [(2 * i + k, v.tolist(), 1) for i in range(400) for k, v in enumerate((a[i], near[i]))] + [(9000, [0.0] * dim, 1), (9001, None, 1)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).toPandas().set_index("vec_id")
    found = sum(got.loc[2 * i + 1, "component_id"] == 2 * i for i in range(400))
    assert found >= 0.9 * 400 and got.n_links.sum() == 2 * found
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert embeddings.near_duplicates(empty).count() == 0


def test_packed_vectors():
    """Vectors travel in single precision only where that is exact."""
    x = np.array([[0.5, -2.0, 3.25], [0.1, 1.0, 1.0], [1e300, 1.0, 0.0], [5e-324, 0.0, 1.0]])
    values = embeddings.packed(x)
    assert [len(v) for v in values] == [12, 24, 24, 24] and (embeddings.unpacked(values, 3) == x).all() and (embeddings.unpacked(values[:1], 3) == x[:1]).all()
