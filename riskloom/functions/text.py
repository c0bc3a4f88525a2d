"""String functions: cleaning, e-mail parts, username shape and complexity. Built-in expressions but for three."""

from __future__ import annotations

import difflib
import functools
import unicodedata
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The de-leet substitutions.
LEET_FROM, LEET_TO = "0134578@$!", "oieastbasi"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once even where lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


@functools.cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """What is left of a character's compatibility decomposition as a-z or blank: one-to-one as a translation, the
    rest as replacements. All code points, by rule."""
    one, many = {}, {}
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp < 0xE000 or not unicodedata.decomposition(c := chr(cp)) or c != c.lower():
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if "a" <= x <= "z" or x in _BLANK)
        if plain:
            (one if len(plain) == 1 else many)[c] = plain
    return "".join(one), "".join(one.values()), many


_BLANK = " \t\n\r\f\v\x1c\x1d\x1e\x1f"


def strip(c: Column) -> Column:
    """S-3: Unicode-aware strip."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def clean_names(c: Column) -> Column:
    """STR1: lower, accents folded to ASCII, only a-z and white space kept; no trim; null or blank gives ""."""
    one_from, one_to, many = _fold_tables()
    low, out = F.lower(c), F.lower(c)
    for a, b in many.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    out = F.when(low.rlike("[" + "".join(many) + "]"), out).otherwise(low)
    return F.when(blank(c), "").otherwise(F.regexp_replace(F.translate(out, one_from, one_to), r"[^a-z\s\x1c-\x1f]", ""))


def clean_city(c: Column) -> Column:
    """STR2: lower, stripped, only a-z and white space kept, runs of it collapsed, not stripped again."""
    body = F.regexp_replace(strip(F.lower(c)), r"(?U)[^a-z\s]", "")
    return F.when(blank(c), "unknown").otherwise(F.regexp_replace(body, r"(?U)\s+", " "))


def clean_browser_language(c: Column) -> Column:
    """STR3: xx-YY codes joined by commas; anything else is dropped; none gives "unknown"."""
    tokens = F.filter(F.transform(F.split(F.lower(c), ","), strip), lambda t: t.rlike("^[a-z]{2}-[a-z]{2}$"))
    codes = F.transform(tokens, lambda t: F.concat(F.substring(t, 1, 3), F.upper(F.substring(t, 4, 2))))
    return F.when(blank(c) | (F.size(codes) == 0), "unknown").otherwise(F.array_join(codes, ","))


def email_parts(c: Column) -> Column:
    """STR4: struct(user, domain, tld): split at the first @; no @ gives "0" for all."""
    at = F.instr(c, "@")
    domain = F.substr(c, at + 1)
    tld = F.when(F.contains(domain, F.lit(".")), F.substring_index(domain, ".", -1)).otherwise("0")
    zero = F.lit("0")
    bad = c.isNull() | (at == 0)
    return F.struct(F.when(bad, zero).otherwise(F.substr(c, F.lit(1), at - 1)).alias("user"), F.when(bad, zero).otherwise(domain).alias("domain"), F.when(bad, zero).otherwise(tld).alias("tld"))


def email_parts_first_label(c: Column) -> Column:
    """STR4b: struct(user, domain, tld) by ([^@]+)@([^.]+)\\.(.+), nulls where it does not match."""
    pattern = r"([^@]+)@([^.]+)\.(.+)"
    return F.struct(*[F.when(c.rlike(pattern), F.regexp_extract(c, pattern, i)).alias(n) for i, n in ((1, "user"), (2, "domain"), (3, "tld"))])


def count_digits(c: Column) -> Column:
    """STR6."""
    return F.regexp_count(c, F.lit(r"\d"))


def count_specials(c: Column) -> Column:
    """STR7: characters other than ASCII letters and digits."""
    return F.regexp_count(c, F.lit("[^a-zA-Z0-9]"))


def count_unique_chars(c: Column) -> Column:
    """STR8."""
    return F.when(c == "", 0).otherwise(F.size(F.array_distinct(F.split(c, ""))))


def ratio(n: Column, c: Column) -> Column:
    """STR9: n over the length, 0 for the empty string."""
    return F.coalesce(F.try_divide(n, F.length(c)), F.lit(0.0))


def text_entropy(c: Column) -> Column:
    """STR10: natural-log Shannon entropy of characters over the length."""

    def of(chars: Column) -> Column:
        n = F.size(chars)
        terms = F.transform(F.array_distinct(chars), lambda x: let(F.size(F.filter(chars, lambda y: y == x)) / n, lambda p: -p * F.log(p)))
        return F.aggregate(F.array_sort(terms), F.lit(0.0), lambda a, x: a + x) / n

    return F.when(F.coalesce(c, F.lit("")) == "", 0.0).otherwise(let(F.split(c, ""), of))


@F.pandas_udf(T.DoubleType())
def kolmogorov(c: pd.Series) -> pd.Series:
    """STR11: deflated bytes over characters, 0 for null and empty."""
    return c.map(lambda t: len(zlib.compress(t.encode("utf-8"))) / len(t) if t else 0.0)


def count_numeric_sequences(c: Column) -> Column:
    """STR12: 1 for leading digits, plus the digit runs left after trailing digits are cut."""
    return c.rlike(r"^\d").cast("int") + F.regexp_count(F.regexp_replace(c, r"\d+$", ""), F.lit(r"\d+"))


def ngrams(c: Column, n: int = 3) -> Column:
    """STR13: distinct n-grams of the lower-cased letters."""
    return let(letters_only(c), lambda s: F.when(F.length(s) < n, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.substr(s, i, F.lit(n))))))


def _fuzzy(name: str, user: str, threshold: float) -> bool:
    if not name or not user:
        return False
    size = len(name)
    windows = {user[i : i + size] for i in range(max(1, len(user) - size + 1))}
    return any(difflib.SequenceMatcher(None, name, w).ratio() >= threshold for w in windows)


@F.pandas_udf(T.BooleanType())
def fuzzy_match(name: pd.Series, user: pd.Series) -> pd.Series:
    """STR14: whether a window of the username is at least 0.8 like the name (Ratcliff-Obershelp)."""
    return pd.Series([_fuzzy(n or "", u or "", 0.8) for n, u in zip(name, user, strict=True)])


def name_flags(first: Column, last: Column, user: Column) -> Column:
    """STR15: the exact, n-gram and fuzzy matches of first and last name; null counts as empty."""
    out = []
    u = F.lower(F.coalesce(user, F.lit("")))
    for name, c in (("first", first), ("last", last)):
        n = F.lower(F.coalesce(c, F.lit("")))
        out += [F.contains(u, n).alias(f"exact_{name}_match"), F.arrays_overlap(ngrams(n), ngrams(u)).alias(f"ngram_{name}_match"), fuzzy_match(n, u).alias(f"fuzzy_{name}_match")]
    return F.struct(*out)


FLAGS = tuple(f"{kind}_{name}_match" for name in ("first", "last") for kind in ("exact", "ngram", "fuzzy"))


def inverse_semantic_score(flags: Column) -> Column:
    """STR16: six less the number of matches."""
    score = F.lit(6)
    for f in FLAGS:
        score = score - flags[f].cast("int")
    return score


def norm(c: Column) -> Column:
    """STR17."""
    return F.lower(strip(F.coalesce(c, F.lit(""))))


def sep_norm(c: Column) -> Column:
    """STR18: other characters as single underscores, none at the ends."""
    return F.regexp_replace(F.regexp_replace(norm(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def deleet_norm(c: Column) -> Column:
    """STR19."""
    return F.translate(norm(c), LEET_FROM, LEET_TO)


def shape(c: Column) -> Column:
    """STR20: letters a, digits d, others s, runs collapsed; in this order, as later ones would match a and d."""
    out = F.regexp_replace(norm(c), r"\p{L}+", "a")
    return F.regexp_replace(F.regexp_replace(out, r"\p{Nd}+", "d"), "[^ad]+", "s")


def letters_only(c: Column) -> Column:
    """STR21."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]", "")


def tokens_for_ratio(c: Column) -> Column:
    """STR22."""
    return F.trim(F.regexp_replace(norm(c), "[^a-z0-9]+", " "))


def canonical_label(c: Column) -> Column:
    """STR23."""
    return F.regexp_replace(sep_norm(c), r"\d+", "0")


def shingles(c: Column, sizes: tuple[int, ...]) -> Column:
    """STR24: distinct n-grams of each size; a shorter, non-empty string is a shingle itself."""

    def of(s: Column) -> Column:
        grams = [F.when(F.length(s) < n, F.array(s)).otherwise(F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), _gram(s, n))) for n in sizes]
        return F.array_distinct(F.filter(F.flatten(F.array(*grams)), lambda g: g != ""))

    return let(c, of)


def _gram(s: Column, n: int) -> Callable[[Column], Column]:
    return lambda i: F.substr(s, i, F.lit(n))
