"""Secret scans: rule spans plus strings that pass a battery of randomness tests.

Candidates are runs of encoding characters; each gets the smallest encoding that holds it (hex, base32,
lower-case alphanumeric, base64) and three tests. Chi-squared uniformity over the alphabet and a runs test on
character classes give p-values under "ordinary identifier" (whose statistics are noncentral by an amount
that grows with length, so short strings need not look significant); Fisher's method combines them.
Strings that true randomness would hardly make, by uniformity or by lag-1 serial correlation, are vetoed.
Benjamini-Hochberg then controls the false-discovery rate over all candidates of all documents, within
length classes: p-values are counted in a bounded histogram (at most classes x bins rows reach the
driver) and a threshold per class comes back. Spans that the base rules find always stay.

Defined results: null and empty texts have no spans; each row is scanned on its own; offsets are code points,
ends exclusive; a table without candidates has the base spans only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Covered, let, saved

KINDS = ("assign", "access", "hex", "random")
RATE, BINS, LEAST = 0.001, 400, 20
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}")
_HINTS = ("passw", "secret", "token", "api")

#: Alphabets by encoding: (name, pattern, symbols, folds). Divergence: chi-squared per character of ordinary
#: identifiers against a uniform draw from the alphabet; switch: their chance of a class change per step.
ENCODINGS = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 16, 1.2, 0.15),
    ("base32", re.compile(r"[A-Z2-7]+=*"), 32, 1.0, 0.08),
    ("alnum", re.compile(r"[a-z0-9]+"), 36, 1.3, 0.08),
    ("base64", re.compile(r"[A-Za-z0-9+/_-]+=*"), 64, 2.6, 0.15),
)
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The spans that the base rules find, by start and kind."""
    out: list[Span] = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m.group()) >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def normal_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def battery(token: str) -> float:
    """p-value of a token under "ordinary identifier"; 1 if true randomness is rejected."""
    body = token.rstrip("=")
    n = len(body)
    if n < LEAST or body.isdigit():
        return 1.0
    _, _, k, divergence, switch = next(e for e in ENCODINGS if e[1].fullmatch(token))
    _, counts = np.unique(np.frombuffer(body.encode("ascii"), dtype=np.uint8), return_counts=True)
    chi = float((counts.astype(float) ** 2).sum() * k / n - n)
    spread = math.sqrt(2 * (k - 1))
    if (chi - (k - 1)) / spread > 3.5:
        return 1.0
    away = n * divergence
    uniform = normal_cdf((chi - (k - 1) - away) / math.sqrt(2 * (k - 1) + 4 * away))
    codes = np.frombuffer(body.encode("ascii"), dtype=np.uint8).astype(float)
    codes -= codes.mean()
    power = float((codes**2).sum())
    serial = float((codes[1:] * codes[:-1]).sum()) / power if power else 1.0
    if abs(serial) * math.sqrt(n) > 3.5:
        return 1.0
    classes = [_class(c) for c in body]
    changes = sum(a != b for a, b in zip(classes, classes[1:], strict=False))
    mean, sd = (n - 1) * switch, math.sqrt((n - 1) * switch * (1 - switch))
    runs = normal_cdf(-(changes - 0.5 - mean) / sd)
    x = -2 * (math.log(max(uniform, 1e-300)) + math.log(max(runs, 1e-300)))
    return min(1.0, math.exp(-x / 2) * (1 + x / 2))  # chi-squared tail with 4 degrees of freedom


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, float]]:
    """(start, end, p) of encoding runs that meet no base span."""
    out, covered = [], Covered([(s, e) for _, s, e in base])
    for m in _TOKEN.finditer(text):
        if not covered.meets(m.start(), m.end()):
            out.append((m.start(), m.end(), battery(m.group())))
    return out


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, base spans and candidates with p-values, and how many candidates were tested."""
    kind = dict(df.dtypes)[doc_id]
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    tested = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, proposed = [], []
            for value in batch.column(1):
                body = value.as_py() or ""
                base = base_spans(body)
                spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in base])
                proposed.append([dict(zip(("start", "end", "p"), c, strict=True)) for c in candidates(body, base)])
            columns = [batch.column(0), pa.array(spans, pa.list_(span)), pa.array(proposed, pa.list_(tested))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "base", "candidates"])

    schema = f"doc_id {kind}, base array<struct<kind:string,start:int,end:int>>, candidates array<struct<start:int,end:int,p:double>>"
    return df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)


def length_class(length: Column) -> Column:
    """Length classes double: 20-39, 40-79, 80-159, and longer."""
    return F.least(F.floor(F.log2(length / LEAST)), F.lit(3)).cast("int")


def thresholds(scanned: DataFrame, rate: float = RATE) -> dict[int, float]:
    """Per length class the largest p that Benjamini-Hochberg accepts, to the resolution of the histogram."""
    each = scanned.select(F.explode("candidates").alias("c")).select(length_class(F.col("c.end") - F.col("c.start")).alias("k"), F.least(F.floor(-F.log10(F.greatest("c.p", F.lit(1e-99))) * 4), F.lit(BINS - 1)).cast("int").alias("bin"))
    counts: dict[int, dict[int, int]] = {}
    for k, b, n in each.groupBy("k", "bin").agg(F.count("*").alias("n")).collect():
        counts.setdefault(k, {})[b] = n
    out = {}
    for k, bins in counts.items():
        total, below = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            below += bins[b]
            if 10 ** (-b / 4) * total / below <= rate:
                out[k] = 10 ** (-b / 4)
    return out


def select(scanned: DataFrame, limits: dict[int, float]) -> DataFrame:
    """doc_id, counts of base spans, base_sha256 and all spans."""
    def passes(c: Column) -> Column:
        k = length_class(c["end"] - c["start"])
        test = F.lit(False)
        for cls, p in limits.items():
            test = test | ((k == cls) & (c["p"] <= p))
        return test

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    rank = {k: i for i, k in enumerate(KINDS)}

    def keyed(spans: Column) -> Column:
        order = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))

    added = F.transform(F.filter("candidates", passes), lambda c: F.struct(F.lit("random").alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    both = let(F.array_sort(keyed(F.concat("base", added))), text)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS[:3]]
    return scanned.select("doc_id", *counts, F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256"), both.alias("spans"))


def find(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """Scan once, set thresholds over the whole corpus, select.

    Only the two named columns are read; others are left out, whatever their names.
    """
    scanned, _ = saved(scan(df, doc_id, text), "secrets")
    return select(scanned, thresholds(scanned, rate))
