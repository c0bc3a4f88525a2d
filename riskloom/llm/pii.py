"""Personal data: rule spans plus candidates judged by gradient boosting.

High-recall generators propose overlapping candidate spans (digit groups of any layout, spelled-out e-mail
addresses, dotted numbers). Boosted trees score them on format and context features; per-kind thresholds,
calibrated on held-out examples to a target precision, select the ones to redact. Spans that the base
rules find always stay; a selected candidate that overlaps a base span or a better candidate is left out.

The model is trained here, on ``TRAINING_ROWS`` labelled examples drawn from format grammars (a bounded,
documented parameter; no corpus rows). It has a few kilobytes and travels with the tasks. One scan, no
shuffle; all scanners run in time linear in the text.

Defined results: null and empty texts have no spans; each row is judged on its own; offsets are code
points, ends exclusive.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.boosting import BoostedTrees, threshold_for
from riskloom.llm.common import Covered

KINDS = ("email", "ip", "card", "phone")
TRAINING_ROWS, PRECISION = 6_000, 0.99
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping addresses, found from their @ so that long runs cost linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append(("email", start, done))
        at = text.find("@", max(at + 1, done))
    return out


def ips(text: str) -> list[Span]:
    """Four dotted numbers at a time along each chain of them."""
    out = []
    for chain in _DOTTED.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append(("ip", at, end))
            at = end + 1
    return out


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    return out


def phones(text: str) -> list[Span]:
    return [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def base_spans(text: str) -> list[Span]:
    """The spans that the base rules find, by start and kind."""
    out = emails(text) if "@" in text else []
    if _DIGIT.search(text):
        out += ips(text) + cards(text)
        if "+" in text:
            out += phones(text)
    return ordered(out)


_GROUPS = re.compile(r"\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,18}")
_SPELLED = re.compile(r"\b[A-Za-z0-9._%+-]{1,40}\x20?[(\[]\x20?at\x20?[)\]]\x20?[A-Za-z0-9-]{1,40}(?:\x20?(?:\.|[(\[]\x20?dot\x20?[)\]])\x20?[A-Za-z0-9-]{1,40}){1,4}")
_QUADS = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\x20?\[?\.\]?\x20?[0-9]{1,3}){3}(?![0-9])")
#: Words before a candidate that speak for a kind, or against all.
CONTEXT = {
    "phone": re.compile(r"(?:phone|tel|call|fax|mobil|cell|whatsapp|llam|appel|anruf)[a-zé]*\W{0,3}(?:\w{0,10}\W{1,2})?$", re.I),
    "card": re.compile(r"(?:card|visa|mastercard|amex|carte|karte|tarjeta|credit)[a-z]*\W{0,3}(?:\w{0,10}\W{1,2})?$", re.I),
    "email": re.compile(r"(?:mail|contact|write|reach|schreib|correo|courriel)[a-z]*\W{0,3}(?:\w{0,10}\W{1,2})?$", re.I),
    "ip": re.compile(r"(?:\bip|address|host|server|login|adresse)[a-z]*\W{0,3}(?:\w{0,10}\W{1,2})?$", re.I),
    "against": re.compile(r"(?:order|invoice|isbn|issn|version|v|no|nr|ref|page|chapter|date|total|sum|id|build|[$€£])\W{0,3}$", re.I),
}
_DATE = re.compile(r"^(?:[0-3]?[0-9][./-][01]?[0-9][./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}[./-][01]?[0-9][./-][0-3]?[0-9])")
_LAYOUT = re.compile(r"^\(?[0-9]{2,5}\)?[\x20./-]{1,2}[0-9]{3,4}[\x20.-]?[0-9]{2,5}$")


def candidates(text: str) -> list[Span]:
    """Overlapping proposals: every digit group may be a phone or a card number, and so on."""
    out = []
    if _DIGIT.search(text):
        for m in _GROUPS.finditer(text):
            n = len(_DIGIT.findall(m.group()))
            out += [("phone", m.start(), m.end())] * (7 <= n <= 15) + [("card", m.start(), m.end())] * (12 <= n <= 19)
        if "." in text:
            out += [("ip", m.start(), m.end()) for m in _QUADS.finditer(text)]
    if "at" in text and ("(" in text or "[" in text):
        out += [("email", m.start(), m.end()) for m in _SPELLED.finditer(text)]
    return out


def features(text: str, span: Span) -> list[float]:
    """Format of the span and context around it."""
    kind, start, end = span
    own, before, after = text[start:end], text[max(0, start - 30) : start], text[end : end + 12]
    digits = "".join(_DIGIT.findall(own))
    groups = re.findall(r"[0-9]+", own) or [""]
    hints = {k: float(bool(p.search(before))) for k, p in CONTEXT.items()}
    return [
        *[float(kind == k) for k in KINDS],
        float(len(own)), float(len(digits)), len(digits) / len(own), float(len(groups)), float(max(map(len, groups))), float(min(map(len, groups))),
        float(len(set(digits))), float(luhn(digits)) if 12 <= len(digits) <= 19 else 0.0, float("(" in own), float("." in own), float("-" in own), float("/" in own), float(digits[:1] == "0"),
        float(bool(_DATE.match(own))), float(bool(_LAYOUT.match(own))), float(all(int(g or 0) <= 255 for g in groups if len(g) < 5)),
        hints.get(kind, 0.0), hints["against"], max(hints[k] for k in KINDS if k != kind),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(after[:1] in "%€$"), float("[" in own or "(at" in own or "( at" in own),
    ]


def training_rows(n: int = TRAINING_ROWS, seed: int = 11) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Labelled candidates from format grammars: (features, labels, kinds)."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    w = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 8)))

    def card(good: bool) -> str:
        body = r.choice("45") + d(14)
        last = next(c for c in "0123456789" if luhn(body + c))
        number = body + (last if good else str((int(last) + r.randint(1, 9)) % 10))
        return r.choice([number, " ".join(number[i : i + 4] for i in range(0, 16, 4)), ".".join(number[i : i + 4] for i in range(0, 16, 4))])

    good = [
        ("phone", lambda: r.choice(["phone: ", "call ", "tel. ", "Fax: ", "mobile no ", "appelez "]) + r.choice([f"({d(3)}) {d(3)}-{d(4)}", f"0{d(3)} {d(7)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(3)}/{d(6)}", f"{d(3)}.{d(3)}.{d(4)}"])),
        ("card", lambda: r.choice(["card ", "visa: ", "credit card no ", "Karte: "]) + card(True)),
        ("email", lambda: r.choice(["mail ", "", "contact: "]) + f"{w()}{r.choice([' (at) ', '[at]', ' [at] '])}{w()}{r.choice(['.', ' [dot] ', '(dot)'])}{r.choice(['com', 'org', 'net'])}"),
        ("ip", lambda: r.choice(["ip ", "host: ", "server at "]) + r.choice(["[.]", " . "]).join(str(r.randint(1, 255)) for _ in range(4))),
    ]
    bad = [
        lambda: r.choice(["order ", "invoice no ", "ref: ", "id ", "", w() + " "]) + r.choice([d(r.randint(7, 16)), f"{d(4)}-{d(6)}", f"{d(8)}-{d(4)}"]),
        lambda: r.choice(["ISBN ", ""]) + f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}",
        lambda: r.choice(["on ", "date: ", ""]) + r.choice([f"{r.randint(1, 28)}.{r.randint(1, 12)}.20{d(2)} {d(2)}", f"20{d(2)}-0{d(1)}-1{d(1)} 1{d(1)}"]),
        lambda: f"{w()} {d(1)} {d(3)} {d(3)} {d(3)}",
        lambda: r.choice(["card ", "visa: ", ""]) + card(False),
        lambda: r.choice(["version ", "v", "build "]) + ".".join(str(r.randint(0, 400)) for _ in range(4)),
        lambda: f"{w()} {d(3)} {d(3)} {d(4)}",
        lambda: f"{w()} (at) {w()}. {w()}",
    ]
    rows, labels, kinds = [], [], []
    while len(rows) < n:
        kind, make = r.choice(good)
        good_one = r.random() < 0.45
        text = f"{w()} {w()} {make() if good_one else r.choice(bad)()} {w()} {w()}"
        for span in candidates(text):
            rows.append(features(text, span))
            labels.append(float(good_one and span[0] == kind))
            kinds.append(span[0])
    return np.array(rows), np.array(labels), kinds


@functools.cache
def trained(n: int = TRAINING_ROWS, precision: float = PRECISION) -> tuple[BoostedTrees, dict[str, float]]:
    """The model and its threshold per kind: fit on three fifths, calibrated on one, thresholds from the last."""
    x, y, kinds = training_rows(n)
    a, b = len(x) * 3 // 5, len(x) * 4 // 5
    model = BoostedTrees().fit(x[:a], y[:a]).calibrate(x[a:b], y[a:b])
    p, k = model.predict(x[b:]), np.array(kinds[b:])
    return model, {kind: max(0.9, threshold_for(p[k == kind], y[b:][k == kind], precision)) for kind in KINDS}


def added_spans(text: str, base: list[Span], model: BoostedTrees, limits: dict[str, float]) -> list[Span]:
    """Selected candidates, best first, none overlapping a base span or a better one."""
    covered = Covered([(s, e) for _, s, e in base])
    proposed = [c for c in candidates(text) if not covered.meets(c[1], c[2])]
    if not proposed:
        return []
    p = model.predict(np.array([features(text, c) for c in proposed]))
    taken: list[Span] = []
    for i in np.argsort(-p, kind="stable").tolist():
        c = proposed[i]
        if p[i] >= limits[c[0]] and not covered.meets(c[1], c[2]):
            covered.add(c[1], c[2])
            taken.append(c)
    return taken


def render(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for kind, start, end in ordered(spans):
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def find(df: DataFrame, doc_id: str = "doc_id", text: str = "text", redacted: bool = False) -> DataFrame:
    """Per row: doc_id, base counts by kind, base_sha256, all spans, and the redacted text if asked for.

    Only the two named columns are read; others are left out, whatever their names.
    """
    model, limits = trained()
    kind = dict(df.dtypes)[doc_id]
    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string" + ", redacted string" * redacted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            shas, found, texts = [], [], []
            for value in batch.column(1):
                body = value.as_py() or ""
                base = base_spans(body)
                both = ordered(base + added_spans(body, base, model, limits))
                for column, k in zip(counts, KINDS, strict=True):
                    column.append(sum(s[0] == k for s in base))
                shas.append(hashlib.sha256(render(base).encode()).hexdigest())
                found.append(render(both))
                texts.append(redact(body, both) if redacted else None)
            columns = [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(shas, pa.string()), pa.array(found, pa.string())]
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
            if redacted:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "redacted"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)
