"""Toxicity by class-conditional Kneser-Ney models.

The expressions are pairs of words and words, whole, signs inside them included (``sh1t``, ``f*ck``). Each class (toxic,
ordinary) has its own counts, discounted absolutely. The mass taken goes to the counts that both classes share, of pairs
from there to shared words, of words to shared continuation counts (after how many words a word stands). So an expression
that one class had thrice or less is as likely under it as the shared counts say, and rare expressions can't tip the
balance. A text counts a pair once: one that repeats itself weighs no more than others. Where neither class keeps a count
of a pair, both back off to the word alike. A word that neither class has is read letter by letter: its beginnings, as
far as two known words share them or a class keeps a count, have counts of the same kind.

A text's evidence is the difference of its two log-likelihoods per word, over the whole text, in its strongest window and
at its strongest word; a logistic fit on labelled rows that gave no counts turns them into a score.

Counts come from at most ``sample`` labelled rows of each class, in hash order, so the model is bounded; every row is
scored. No count is left out. Expressions are known by 64-bit hashes. Defined results: null texts and texts without
words have no evidence and get the score of none; rows without a label (or with a null one) teach nothing, rows without
an id neither (the query's ``held_out`` is null for them); of several labels of a row, one that says toxic counts;
without labelled rows every score is 0; repeated rows are scored each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Of counts that both classes share, and of letters.
_DISCOUNT = 0.75
#: Of a class's own counts: one, two and three lose all, larger ones three.
CLASS_DISCOUNT = 3
CLASSES = ("toxic", "plain")
_WORD = re.compile(r"[\w*@$](?:[\w*@$!'’-]*[\w*@$])?")
#: What stands before the first word.
_START = "^"


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_key(word: str) -> int:
    """As the session's ``xxhash64`` of the word."""
    return xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 42)


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return before * np.uint64(0x9E3779B97F4A7C15) + word


def _ratio(shared: Column, own: tuple, follow: tuple, back: tuple) -> Column:
    """log P(. | toxic) - log P(. | ordinary): each class's own count, all counts of its context and what those lost."""
    lost = [F.least(n, F.lit(CLASS_DISCOUNT)) for n in own]
    toxic, plain = (F.when(f > 0, (n - less + m * shared) / f).otherwise(shared) for n, less, f, m in zip(own, lost, follow, back))
    return F.log(toxic / plain).cast("float").alias("evidence")


def _sums() -> list[Column]:
    """Of each class: counts, and what they lose."""
    return [F.coalesce(F.sum(x), F.lit(0)).alias(f"{name}_{c}") for c in CLASSES for name, x in (("all", F.col(c)), ("lost", F.least(c, F.lit(CLASS_DISCOUNT))))]


def _table(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and evidence; of two key columns the pair's key."""
    table = found.toArrow()
    *parts, values = (table.column(i).to_numpy() for i in range(table.num_columns))
    parts = [p.astype(np.int64).view(np.uint64) for p in parts]
    keys = pair_keys(*parts) if len(parts) == 2 else parts[0]
    order = np.argsort(keys)
    return keys[order], values.astype(np.float32)[order]


def word_evidence(pairs: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Tables of all words, then of the pairs that keep a count in a class, from (before, word, toxic, plain)."""
    words = pairs.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"), F.count("*").alias("company"))
    all_of = words.agg(*_sums(), F.count("*").alias("words"), F.sum("company").alias("pairs")).first()
    tokens, spread = max(all_of["all_toxic"] + all_of["all_plain"], 1), all_of["words"] / max(all_of["pairs"] or 0, 1)
    shared = (F.col("toxic") + F.col("plain") - _DISCOUNT + _DISCOUNT * spread * F.col("company")) / tokens
    own = tuple(F.col(c) for c in CLASSES)
    of_words = words.select(F.xxhash64("word"), _ratio(shared, own, *(tuple(F.lit(all_of[f"{k}_{c}"]) for c in CLASSES) for k in ("all", "lost"))))

    befores = pairs.groupBy("before").agg(*_sums(), F.count("*").alias("kinds"))
    kept = pairs.where(F.greatest(*own) > CLASS_DISCOUNT).join(befores, "before").join(words.select("word", shared.alias("shared")), "word")
    shared_pair = (F.col("toxic") + F.col("plain") - _DISCOUNT + _DISCOUNT * F.col("kinds") * F.col("shared")) / (F.col("all_toxic") + F.col("all_plain"))
    of_pairs = kept.select(F.xxhash64("before"), F.xxhash64("word"), _ratio(shared_pair, own, *(tuple(F.col(f"{k}_{c}") for c in CLASSES) for k in ("all", "lost"))))
    return _table(of_words), _table(of_pairs)


def letter_evidence(pairs: DataFrame, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Table of what the last letter of a word's beginning says, for words that neither class has."""
    words = pairs.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    words = words.withColumn("marked", F.concat(F.lit("^"), F.substring("word", 1, depth), F.lit("$")))
    begins = words.select(F.explode(F.transform(F.sequence(F.lit(2), F.least(F.length("marked"), F.lit(depth))), lambda n: F.substring("marked", F.lit(1), n))).alias("begin"), "toxic", "plain")
    begins = begins.groupBy("begin").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"), F.count("*").alias("words"))
    begins = begins.where((F.col("words") > 1) | (F.greatest("toxic", "plain") > CLASS_DISCOUNT)).drop("words")
    last = F.substring("begin", F.length("begin") - 1, F.lit(2))
    begins = stage(begins.withColumns({"parent": F.substring("begin", F.lit(1), F.length("begin") - 1), "last": last, "prior": F.substring(last, 1, 1)}), "beginnings")
    letters = max(2, begins.agg(F.count_distinct(F.substring("last", 2, 1))).first()[0])
    lasts = begins.groupBy("last", "prior").agg(F.count("*").alias("n_last"))
    priors = begins.groupBy(F.col("prior")).agg(F.count("*").alias("n_prior"))
    low = lasts.join(priors, "prior").select("last", ((F.col("n_last") + 1 / letters) / (F.col("n_prior") + 1)).alias("low"))
    parents = begins.groupBy("parent").agg(*_sums(), F.count("*").alias("kinds"))
    rows = begins.join(parents, "parent").join(low, "last")
    shared = (F.col("toxic") + F.col("plain") - _DISCOUNT + _DISCOUNT * F.col("kinds") * F.col("low")) / (F.col("all_toxic") + F.col("all_plain"))
    return _table(rows.select(F.xxhash64("begin"), _ratio(shared, tuple(F.col(c) for c in CLASSES), *(tuple(F.col(f"{k}_{c}") for c in CLASSES) for k in ("all", "lost")))))


def look_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, value) of each key."""
    held, values = table
    if not len(held):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
    found = held[at] == keys
    return found, np.where(found, values[at], 0.0)


class Evidence:
    """Evidence of each word of a text, from the tables of words, pairs and beginnings."""

    def __init__(self, tables, depth: int, most: int = 300_000):
        self.words, self.pairs, self.beginnings = tables
        self.depth, self.most = depth, most
        self.start = np.uint64(word_key(_START))
        self.known: dict[str, tuple[int, float]] = {}

    def _by_letters(self, word: str) -> float:
        marked = f"^{word}$"
        keys = [word_key(marked[:end]) for end in range(2, min(len(marked), self.depth) + 1)]
        found, steps = look_up(self.beginnings, np.array(keys, np.uint64))
        return float(steps[: len(found) if found.all() else int(found.argmin())].sum())

    def _learn(self, new: list[str]) -> None:
        if len(self.known) > self.most:
            self.known.clear()
        keys = [word_key(w) for w in new]
        found, values = look_up(self.words, np.array(keys, np.uint64))
        for word, key, ok, value in zip(new, keys, found.tolist(), values.tolist()):
            self.known[word] = key, value if ok else self._by_letters(word)

    def of(self, ws: list[str]) -> np.ndarray:
        self._learn(list({w for w in ws if w not in self.known}))
        if not all(map(self.known.__contains__, ws)):  # the memory was emptied in between
            self._learn(list({w for w in ws if w not in self.known}))
        pairs = list(map(self.known.__getitem__, ws))
        keys = np.fromiter((p[0] for p in pairs), np.uint64, len(ws))
        alone = np.fromiter((p[1] for p in pairs), float, len(ws))
        found, values = look_up(self.pairs, pair_keys(np.concatenate([[self.start], keys[:-1]]), keys))
        return np.where(found, values, alone)


FEATURES = ("mean", "peak", "top")


def _pairs(batches):
    """(before, word, toxic, plain): in how many texts of each class, summed by batch."""
    for batch in batches:
        counts: dict[tuple[str, str], list[int]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ws = words(text)
            for pair in dict.fromkeys(zip([_START, *ws], ws)):
                counts.setdefault(pair, [0, 0])[0 if toxic == 1 else 1] += 1
        columns = [pa.array([k[i] for k in counts], pa.string()) for i in (0, 1)]
        columns += [pa.array([n[i] for n in counts.values()], pa.int64()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, names=["before", "word", "toxic", "plain"])


def _evidence(tables, depth: int, window: int):
    """The columns before the text stay; ``mean``, ``peak`` and ``top`` are the evidence per word of the text, of its strongest window and word."""

    def run(batches):
        known = _model(tables, depth)
        for batch in batches:
            means, peaks, tops = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                ws = words(text)
                if not ws:
                    for column in (means, peaks, tops):
                        column.append(0.0)
                    continue
                each = known.of(ws)
                sums = np.concatenate([[0.0], np.cumsum(each)])
                tops.append(float(each.max()))
                means.append(float(sums[-1] / len(ws)))
                peaks.append(float((sums[window:] - sums[:-window]).max() / window) if len(ws) > window else float(sums[-1] / window))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(c, pa.float64()) for c in (means, peaks, tops))], names=[*batch.schema.names[:-1], *FEATURES])

    return run


_MODELS: dict[int, Evidence] = {}


def _model(tables, depth: int) -> Evidence:
    """One model a worker process, whatever the number of its tasks."""
    if tables.id not in _MODELS:
        _MODELS.clear()
        _MODELS[tables.id] = Evidence(tables.value, depth)
    return _MODELS[tables.id]


class _Broadcast:
    """A broadcast value with an identity that is the same in every task."""

    def __init__(self, held):
        self.held, self.id = held, held._jbroadcast.id()

    @property
    def value(self):
        return self.held.value

    def __reduce__(self):
        return _rebuild, (self.held, self.id)


def _rebuild(held, key):
    out = _Broadcast.__new__(_Broadcast)
    out.held, out.id = held, key
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Logistic weights (last: constant) by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = 10_000,
    fit_share: int = 5,
    depth: int = 24,
    window: int = 6,
) -> DataFrame:
    """(doc_id, score), one row per row of ``docs``.

    ``may_learn``: which rows of ``labels``, by its id column, may be learned from. One in ``fit_share`` of them fits the
    scores, the others give counts. Of words that neither class has, the first ``depth`` letters are looked at.
    """
    spark = docs.sparkSession
    known = labels.where(may_learn & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("_toxic"))
    known = known.withColumn("_h", F.xxhash64(id_col))
    picked = [known.where(cond).orderBy("_h").limit(sample) for cond in (F.col("_toxic") == 1, F.col("_toxic") != 1)]
    picked = stage(picked[0].union(picked[1]).select(F.col(id_col).cast("long").alias("_id"), "_toxic", (F.pmod(F.xxhash64("_h"), F.lit(fit_share)) == 0).alias("_fit")), "labelled")
    own = F.col("_own")
    rows = docs.select(F.col(id_col).cast("long").alias("_own"), F.col(text_col).alias("text"))
    # At most 2 * sample rows of 17 bytes are broadcast.
    learned = rows.join(F.broadcast(picked), own == F.col("_id"))
    pairs = learned.where("not _fit").select("text", "_toxic").mapInArrow(_pairs, "before string, word string, toxic long, plain long")
    pairs = stage(pairs.groupBy("before", "word").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain")), "pair_counts")
    # Bounded by the sample: 12 bytes each of its words, pairs of at least four texts, and beginnings.
    held = _Broadcast(spark.sparkContext.broadcast((*word_evidence(pairs), letter_evidence(pairs, depth))))

    measure = _evidence(held, depth, window)
    fitted = learned.where("_fit").select("_toxic", "text").mapInArrow(measure, "_toxic int, mean double, peak double, top double").toPandas()  # sample / fit_share rows
    scored = rows.mapInArrow(measure, "_own long, mean double, peak double, top double").withColumnRenamed("_own", "doc_id")
    if fitted.empty or not (fitted["_toxic"] == 1).any():
        return scored.select("doc_id", F.lit(0.0).alias("score"))
    w = fit(fitted[[*FEATURES]].to_numpy(float), (fitted["_toxic"] == 1).to_numpy(float))
    z = sum((F.lit(float(a)) * F.col(c) for a, c in zip(w, FEATURES)), F.lit(float(w[-1])))
    return scored.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))
