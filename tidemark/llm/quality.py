"""Quality rules as a short-circuit cascade.

Each rule's cost (time) and selectivity (share rejected) are measured on a sample, and the rules are ordered by
rejection per cost. A row leaves the cascade at the first rule that rejects it: the rules are branches of one CASE, of
which Spark evaluates no more than it needs. The order changes what is computed, never the verdict: a row is kept when
no rule rejects it.

Defined results: a null or empty text has no words and fails the base rule; repeated rows are judged each; an empty
table gives an empty result; the operator only adds its own columns to the given ones and replaces any of those names.
DataFrame functions only.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, once, stage

_BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_BLANK))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def repeated_words(ws: Column) -> Column:
    """Words in windows of eight that occur at least twice in the array. Windows are told apart by two 64-bit hashes."""

    def covered(n: Column) -> Column:
        starts = F.sequence(F.lit(1), n)
        one = F.transform(starts, lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))

        def exact(h: Column) -> Column:
            # Only windows whose first hash occurs again can repeat: sort (hash, second hash, place), compare neighbours.
            pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("a"), F.xxhash64(F.lit(7), F.slice(ws, i + 1, WINDOW)).alias("b"), i.alias("i"))))

            def places(s: Column) -> Column:
                def same(i: Column, j: Column) -> Column:
                    return (F.get(s, i)["a"] == F.get(s, j)["a"]) & (F.get(s, i)["b"] == F.get(s, j)["b"])

                again = F.filter(s, lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
                return F.array_sort(F.transform(again, lambda x: x["i"]))

            start = F.struct(F.lit(-WINDOW).alias("p"), F.lit(0).alias("n"))
            step = lambda acc, p: F.struct(p.alias("p"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["p"])).alias("n"))
            return F.aggregate(let(pairs, places), start, step, lambda acc: acc["n"])

        return let(one, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(exact(h)))

    return F.when(F.size(ws) <= WINDOW, F.lit(0)).otherwise(covered(F.size(ws) - (WINDOW - 1)))


def base_columns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts and ``base_failed``; the words stay in ``_words`` for the rules."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != "")
    rows = docs.drop(*ADDED).withColumn("_words", once(words(text)))
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.size(F.split(text, SYMBOLS, -1)) - 1).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")).cast("long"),
        }
    )
    return rows.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


@dataclass(frozen=True)
class Rule:
    """``rejects(text)`` is true for rows to drop; it may use the base counts and ``_words``."""

    name: str
    rejects: Callable[[Column], Column]


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


RULES = (
    Rule("symbols", lambda t: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("word_length", lambda t: (2 * F.col("word_chars") < 5 * F.col("n_words")) | (F.col("word_chars") > 14 * F.col("n_words"))),
    Rule("duplicate_lines", lambda t: 100 * F.col("n_dup_lines") > 40 * _count(t, r"(?m)^.*[^\x20\x09-\x0D]")),
    Rule("shouting", lambda t: 100 * _count(t, r"\p{Lu}") > 40 * F.col("word_chars")),
    Rule("exclamations", lambda t: 2 * _count(t, "!") > F.col("n_words")),
    Rule("digits", lambda t: 100 * _count(t, "[0-9]") > 40 * F.col("word_chars")),
    Rule("vocabulary", lambda t: F.pow(F.size(F.array_distinct("_words")), F.lit(2)) < F.col("n_words")),
)


def order_rules(rows: DataFrame, rules: tuple[Rule, ...], text_col: str, sample_rows: int) -> list[tuple[Rule, float, float]]:
    """(rule, cost in seconds, share rejected) by rejection per cost, measured on about ``sample_rows`` rows that pass the base rule."""
    n = rows.count()
    part = rows.sample(min(1.0, sample_rows / max(n, 1)), seed=5)
    sample = stage(base_columns(part, text_col).where("not base_failed").select(text_col, "_words", *ADDED[:-2]), "rule_sample")

    def run(test: Column) -> tuple[float, float]:
        began = time.perf_counter()
        share = sample.agg(F.avg(test.cast("int")).alias("x")).first()["x"]
        return time.perf_counter() - began, share or 0.0

    run(F.lit(False))
    idle, _ = run(F.lit(False))
    measured = []
    for rule in rules:
        cost, share = run(rule.rejects(F.col(text_col)))
        measured.append((rule, max(cost - idle, 1e-3), share))
    return sorted(measured, key=lambda m: (-m[2] / m[1], m[0].name))


def judge(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """``docs`` with the base columns and ``kept``."""
    cascade = F.when(F.col("base_failed"), F.lit(False))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    for rule, _, _ in order_rules(docs.select(F.col(text_col)), rules, text_col, sample_rows):
        cascade = cascade.when(rule.rejects(text), F.lit(False))
    return base_columns(docs, text_col).withColumn("kept", cascade.otherwise(F.lit(True))).drop("_words")


def passing(docs: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only."""
    # The operator's columns take names that ``docs`` may use itself: it works on a renamed copy.
    own = {c: f"_own_{i}" for i, c in enumerate(docs.columns)}
    judged = judge(docs.withColumnsRenamed(own), own[text_col], **params).where("kept")
    return judged.select([F.col(o).alias(c) for c, o in own.items()])
