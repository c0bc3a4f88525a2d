"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps its measurements and one failure bit per rule.
Policies (versioned sets of rules) are then bitwise tests on the ledger, and ablations are bitwise
aggregates over it: neither touches a text again. Built-in expressions only, one scan, no shuffle.

Defined results: a null text counts as an empty one (0 words, so the word-count rule fails); measurements of
documents without words are 0; repeated rows are judged alike, each on its own; other columns pass through
(``ledger`` puts its results in one struct column, which takes the place of one of the same name). Equality of word windows is equality of their 64-bit XXH64 hashes within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import BLANK, let, words_of

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"


def n_repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Words that lie in windows of ``size`` words found twice or more, first occurrences included.

    Sort-based, so n log n in the length of the text: hash the windows, sort (hash, start), keep those that
    equal a neighbour, and measure the union of the intervals that start there.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            last = F.size(p) - 1
            same = F.filter(p, lambda x, i: ((i > 0) & (F.get(p, i - 1)["h"] == x["h"])) | ((i < last) & (F.get(p, i + 1)["h"] == x["h"])))
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        def union(s: Column) -> Column:
            return F.aggregate(s, F.struct(F.lit(-size).alias("at"), F.lit(0).alias("n")), lambda a, x: F.struct(x.alias("at"), (a["n"] + F.least(F.lit(size), x - a["at"])).alias("n")), lambda a: a["n"])

        return let(let(pairs, starts), union)

    def of(w: Column) -> Column:
        hashed = F.transform(w, lambda x: F.xxhash64(x))
        windows = let(hashed, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)])))
        found = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
        return F.when(F.size(w) < size, F.lit(0)).otherwise(found)

    return let(words, of)


def measurements(text: Column) -> Column:
    """A struct of everything that the rules look at; the word array is built once for all of them."""
    return let(words_of(text), lambda words: F.struct(*[c.alias(k) for k, c in _measured(F.coalesce(text, F.lit("")), words).items()]))


def _measured(body: Column, words: Column) -> dict[str, Column]:
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(rf"[^{BLANK}]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": n_repeat_words(words).cast("long"),
        "n_shouted": F.regexp_count(body, F.lit("[!?]{2,}")).cast("long"),
    }


@dataclass(frozen=True)
class Rule:
    """A test on the measurements; ``fails`` is a SQL predicate over their names."""

    name: str
    bit: int
    fails: str


#: Bits are fixed for good: a rule keeps its bit in all versions of the ledger.
RULES = (
    Rule("too_few_words", 0, "n_words < 10"),
    Rule("repeats_itself", 1, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", 3, "10 * n_dup_lines > 3 * n_lines"),
    Rule("word_length", 4, "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
    Rule("shouting", 5, "2 * n_shouted > n_words"),
)

#: Policies by version: the mask of the rules that reject a document.
POLICIES = {"base": 0b000011, "v1": 0b001111, "v2": 0b111111}
PRODUCTION = "v2"


def ledger(df: DataFrame, text: str = "text", out: str = "ledger", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the struct column ``out``: all measurements and ``mask``, the failure bits of all ``rules``.

    It takes the place of a column of that name.
    """
    taken = {c.lower() for c in df.columns}
    tmp = "_" + out
    while tmp.lower() in taken:
        tmp = "_" + tmp
    got = df.withColumn(tmp, measurements(F.col(f"`{text}`")))
    fields = [f.name for f in got.schema[tmp].dataType]

    def judged(m: Column) -> Column:
        bits = F.lit(0)
        for r in rules:
            bits = bits.bitwiseOR(F.when(_predicate(r.fails, m, fields), F.lit(1 << r.bit)).otherwise(F.lit(0)))
        return F.struct(*[m[k].alias(k) for k in fields], bits.alias("mask"))

    return got.withColumn(out, let(F.col(tmp), judged)).drop(tmp)


def _predicate(sql: str, m: Column, fields: list[str]) -> Column:
    """A rule's SQL over the fields of ``m``: tokens that name a field become field accesses."""
    names = {k: m[k] for k in fields}
    return _Parser(sql, names).parse()


class _Parser:
    """Integer arithmetic, comparisons, AND, OR and parentheses; enough for rules, and no Python at run time."""

    def __init__(self, sql: str, names: dict[str, Column]):
        import re

        self.tokens, self.names, self.at = re.findall(r"\w+|<=|>=|<>|[-+*/()<>=]", sql), names, 0

    def peek(self) -> str:
        return self.tokens[self.at].upper() if self.at < len(self.tokens) else ""

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1]

    def parse(self) -> Column:
        left = self.conjunction()
        while self.peek() == "OR":
            self.take()
            left = left | self.conjunction()
        return left

    def conjunction(self) -> Column:
        left = self.comparison()
        while self.peek() == "AND":
            self.take()
            left = left & self.comparison()
        return left

    def comparison(self) -> Column:
        left = self.product()
        if self.peek() in ("<", ">", "<=", ">=", "=", "<>"):
            op, right = self.take(), self.product()
            return {"<": left < right, ">": left > right, "<=": left <= right, ">=": left >= right, "=": left == right, "<>": left != right}[op]
        return left

    def product(self) -> Column:
        left = self.atom()
        while self.peek() in ("*", "+", "-"):
            op, right = self.take(), self.atom()
            left = {"*": left * right, "+": left + right, "-": left - right}[op]
        return left

    def atom(self) -> Column:
        token = self.take()
        if token == "(":
            inner = self.parse()
            self.take()
            return inner
        return F.lit(int(token)).cast("long") if token.isdigit() else self.names[token]


def rejected(mask: Column, policy: str | int = PRODUCTION) -> Column:
    """Whether a policy (its version, or a mask) rejects a document."""
    bits = POLICIES[policy] if isinstance(policy, str) else policy
    return mask.bitwiseAND(F.lit(bits)) != 0


def failed_rules(mask: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a mask says failed."""
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(F.lit(1 << r.bit)) != 0, F.lit(r.name)) for r in rules]))


def ablation(ledgers: DataFrame, policy: str | int = PRODUCTION, mask: str = "mask", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, those only it rejects, and those kept without it.

    One pass over masks: they are counted by value (at most 2^rules groups), the rest is bitwise on counts.
    """
    bits = POLICIES[policy] if isinstance(policy, str) else policy
    masks = ledgers.groupBy(F.col(mask).bitwiseAND(F.lit(bits)).alias("m")).agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).alias("b")) for r in rules if bits >> r.bit & 1]))
    per = masks.select("m", "n", each.alias("r")).select("m", "n", "r.rule", "r.b")
    return per.groupBy("rule").agg(
        F.sum(F.when(F.col("m").bitwiseAND(F.col("b")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("m") == F.col("b"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when((F.col("m") == 0) | (F.col("m") == F.col("b")), F.col("n")).otherwise(0)).alias("n_kept_without"),
    )


def keep(df: DataFrame, policy: str | int = PRODUCTION, text: str = "text") -> DataFrame:
    """The rows that a policy keeps, with the columns they came with."""
    name = "ledger"
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return ledger(df, text, name).where(~rejected(F.col(f"{name}.mask"), policy)).select(*[f"`{c}`" for c in df.columns])
