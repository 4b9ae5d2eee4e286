"""Hard negatives by exact integer products, several candidates packed into one integer.

Components become whole numbers, floor(scale * x). To score a block of candidates against anchors, components are biased
to be at least 0 and those of several candidates are laid side by side, one packed integer for each component:
W_i = sum over j of (b_ji + B) * 2^(w j). The fields are wide enough for a whole sum, w bits >= dimension * (largest
biased anchor component) * (largest biased candidate component), so the sum over i of (a_i + A) * W_i holds, unmixed,
the biased product of every candidate; one multiplication an anchor component serves all of them. Unpacking takes the
fields apart and the biases off: exact scores, whatever the order of summation.

Two carriers hold packed integers. Where a field fits 53 bits, whole numbers in doubles do (exact below 2^53), so the
sums are a matrix product. Where components are larger, Python's integers of any width take ``WIDE`` candidates each.

*First pass*, over tiles: the products of equal labels; each anchor keeps its best rows, the positives. *Second pass*: each
positive's score opens a window, ``low`` <= 100 * score / positive's <= ``high``; each tile returns the best rows of other
labels in each window. What tiles return is merged by anchor (and positive).

Defined results: rows with a null label, a null or empty vector or a null or non-finite component take no part; rows of
another dimension than the anchor's aren't compared with it; rows that repeat an id are rows of their own; ties go to the
smaller id, null last; anchors without positives, and positives without rows in the window, give no rows; scores are long,
or decimal(38,0) where the components are so large that they may not fit; an empty table gives an empty result; columns
other than those named are ignored, whatever their names.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import stage
from .vectors import as_reals, by_tiles, matrices, pack, unpack

WORD = 53  # bits of whole numbers that doubles hold exactly
WIDE = 64  # candidates in one of Python's integers
SLICE = 2048  # candidates, and anchors, of which a matrix of scores is held


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): int64, or Python integers where some don't fit 53 bits."""
    x = x.astype(np.float64)
    with np.errstate(over="ignore"):
        y = np.floor(scale * x)
    if np.abs(y).max(initial=0) < 2**WORD:
        return y.astype(np.int64)
    exact = [[int(b) if abs(b) < 2**WORD else math.floor(Fraction(a) * scale) for a, b in zip(r, s)] for r, s in zip(x.tolist(), y.tolist())]
    return np.array(exact, dtype=object).reshape(x.shape)


def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two matrices of whole numbers, exact."""
    (n, dim), m = anchors.shape, len(candidates)
    if not n or not m:
        return np.zeros((n, m), np.int64)
    up_a, up_b = -int(anchors.min()), -int(candidates.min())
    a, b = anchors + up_a, candidates + up_b
    width = max((dim * int(a.max()) * int(b.max())).bit_length(), 1)
    if width <= WORD:
        fields = WORD // width
        b = np.concatenate([b, np.zeros((-m % fields, dim), b.dtype)]).astype(np.float64)
        packed = sum(b[j::fields] * 2.0 ** (width * j) for j in range(fields))
        sums = (a.astype(np.float64) @ packed.T).astype(np.int64)
        mask = (1 << width) - 1
        out = np.empty((n, len(b)), np.int64)
        for j in range(fields):
            out[:, j::fields] = (sums >> (width * j)) & mask
        out = out[:, :m]
    else:
        a, b, out = a.astype(object), b.astype(object), np.empty((n, m), object)
        mask = (1 << width) - 1
        rows_a, rows_b = a.tolist(), b.tolist()
        for at in range(0, m, WIDE):
            some = rows_b[at : at + WIDE]
            packed = [sum(int(r[i]) << (width * j) for j, r in enumerate(some)) for i in range(dim)]
            for k, row in enumerate(rows_a):
                held = sum(int(x) * w for x, w in zip(row, packed))
                for j in range(len(some)):
                    out[k, at + j] = (held >> (width * j)) & mask
    # sum a b = sum (a + A)(b + B) - B sum (a + A) - A sum (b + B) + dim A B
    sum_a, sum_b = a.sum(axis=1), b[:m].sum(axis=1).astype(out.dtype)
    return out - up_b * sum_a[:, None] - up_a * sum_b[None, :] + dim * up_a * up_b


def _ranks(scores: np.ndarray) -> np.ndarray:
    """``scores``, or their ranks if they are too large to be put together with a position."""
    if scores.dtype != object and scores.size and int(np.abs(scores).max()) < 2**40:
        return scores
    return np.unique(scores, return_inverse=True)[1].reshape(scores.shape) if scores.size else scores.astype(np.int64)


def top(scores: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` largest of each row's fitting scores, in no order; ties go to the first column."""
    n, m = scores.shape
    if not n or not m:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key = _ranks(scores) * m + np.arange(m - 1, -1, -1)
    key = np.where(fits, key, np.iinfo(np.int64).min)
    best = np.argpartition(key, m - k, axis=1)[:, m - k :] if k < m else np.broadcast_to(np.arange(m), (n, m))
    rows = np.repeat(np.arange(n), best.shape[1])
    cols = best.ravel()
    good = fits[rows, cols]
    return rows[good], cols[good]


def _best(group: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    by = np.lexsort((place, -_ranks(score), group))
    first = np.flatnonzero(np.diff(group[by], prepend=-1))
    order = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
    return by[order < k]


class _Tile:
    """Candidates of a tile in the order of their ids, and its anchors."""

    def __init__(self, candidates: pa.Table, queries: pa.Table, kind: str, scale: int):
        self.empty = not len(candidates) or not len(queries)
        if self.empty:
            return
        dim = queries["dim"][0].as_py()
        none = np.iinfo(np.int64).max
        by = np.lexsort((candidates["rid"].to_numpy(), candidates["id"].fill_null(none).to_numpy()))
        self.candidates, self.queries = candidates.take(pa.array(by)), queries
        self.c, self.a = whole(unpack(self.candidates["vector"], kind, dim), scale), whole(unpack(queries["vector"], kind, dim), scale)
        self.c_label, self.a_label = self.candidates["label"].to_numpy(), queries["label"].to_numpy()
        self.c_rid, self.a_rid = self.candidates["rid"].to_numpy(), queries["rid"].to_numpy()

    def positives(self, k: int):
        """(anchor, candidate, score) of the best ``k`` candidates of the anchor's label."""
        held = _Held(k)
        for label in np.intersect1d(self.a_label, self.c_label):
            mine, theirs = np.flatnonzero(self.a_label == label), np.flatnonzero(self.c_label == label)
            for at in range(0, len(theirs), SLICE):
                for low in range(0, len(mine), SLICE):
                    a, c = mine[low : low + SLICE], theirs[at : at + SLICE]
                    scores = products(self.a[a], self.c[c])
                    r, s = top(scores, self.a_rid[a][:, None] != self.c_rid[c], k)
                    held.add(a[r], c[s], scores[r, s])
        return held.result()

    def negatives(self, windows: list[list[tuple[int, int, int]]], k: int):
        """(anchor's positive, candidate, score) of the best ``k`` in each window; ``windows``: by anchor (number, from, to)."""
        held = _Held(k)
        for low in range(0, len(self.a), SLICE):
            some = windows[low : low + SLICE]
            for at in range(0, len(self.c), SLICE):
                scores = products(self.a[low : low + SLICE], self.c[at : at + SLICE])
                other = self.a_label[low : low + SLICE, None] != self.c_label[at : at + SLICE]
                for slot in range(max(map(len, some), default=0)):
                    rows = np.array([i for i, w in enumerate(some) if len(w) > slot and w[slot][1] <= w[slot][2]], np.int64)
                    if not len(rows):
                        continue
                    kind = scores.dtype
                    number = np.array([some[i][slot][0] for i in rows], np.int64)
                    lo, hi = (np.array([some[i][slot][e] for i in rows], dtype=kind)[:, None] for e in (1, 2))
                    part = scores[rows]
                    r, s = top(part, (other[rows] & (part >= lo) & (part <= hi)).astype(bool), k)
                    held.add(number[r], at + s, part[r, s])
        return held.result()


class _Held:
    """The best ``k`` entries of each group so far; positions of candidates break ties."""

    def __init__(self, k: int):
        self.k, self.parts, self.n = k, [], 0

    def add(self, group: np.ndarray, place: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((group, place, score))
        self.n += len(group)
        if self.n > 1_000_000:
            self.parts, self.n = [self.result()], 0

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        group, place, score = (np.concatenate(x) for x in zip(*self.parts))
        keep = _best(group, score, place, self.k)
        return group[keep], place[keep], score[keep]


def _rows(kind: str):
    def run(batches):
        from pyspark import TaskContext

        rid = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at, x in matrices(batch.column(3)):
                take = pa.array(at)
                columns = [pa.array(rid + at), *(batch.column(i).take(take) for i in range(3)), pa.array(np.full(len(at), x.shape[1])), pack(x), pa.array(np.abs(x).max(axis=1).astype(np.float64))]
                yield pa.RecordBatch.from_arrays(columns, names=["rid", "id", "label", "ask", "dim", "vector", "most"])
            rid += batch.num_rows

    return run


def _scores(score: np.ndarray, wide: int) -> list[pa.Array]:
    """Scores as text and as a key that sorts like them; both the number itself unless they are wide."""
    if not wide:
        return [pa.array(score.astype(np.int64))] * 2
    texts = [str(int(s)) for s in score.tolist()]
    return [pa.array([str(int(s) + 10**wide).zfill(wide + 1) for s in score.tolist()], pa.string()), pa.array(texts, pa.string())]


def mine(
    rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block: int = 32_768,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each row that ``is_anchor``."""
    source = as_reals(rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), is_anchor.alias("ask"), F.col(vector_col).alias("v")), "v")
    kind = "f4" if source.schema["v"].dataType.elementType.simpleString() == "float" else "f8"
    names = "rid long, id long, label long, ask boolean, dim long, vector binary, most double"
    staged = stage(source.where("label is not null").mapInArrow(_rows(kind), names), "vectors")
    most, dim = staged.agg(F.coalesce(F.max("most"), F.lit(0.0)), F.coalesce(F.max("dim"), F.lit(1))).first()
    bound = dim * (scale * (int(most) + 1)) ** 2  # of a score's size
    wide = 0 if bound < 2**62 else len(str(bound))
    numbers = "s string, score string" if wide else "s long, score long"
    staged = staged.drop("most")
    plain, anchors = staged.drop("ask"), staged.where("ask").drop("ask")

    def first(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        t = _Tile(candidates, queries, kind, scale)
        a, c, score = (np.empty(0, np.int64),) * 3 if t.empty else t.positives(positives)
        of = candidates if t.empty else t.candidates
        columns = [queries["rid"].take(pa.array(a)), of["rid"].take(pa.array(c)), of["id"].take(pa.array(c)), *_scores(score, wide)]
        return pa.table(columns, names=["anchor", "row", "id", "s", "score"])

    found = by_tiles(plain, anchors, first, f"anchor long, row long, id long, {numbers}", block)
    order = [F.desc("s"), F.asc_nulls_last("id"), "row"]
    best = found.withColumn("place", F.row_number().over(W.partitionBy("anchor").orderBy(*order))).where(F.col("place") <= positives)
    best = stage(best.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # At most ``positives`` entries each.
    wanted = best.groupBy(F.col("anchor").alias("rid")).agg(F.collect_list(F.struct("place", "positive_score")).alias("wanted"))
    asks = stage(anchors.join(wanted, "rid"), "anchors")
    plain = plain.withColumn("wanted", F.lit(None).cast(asks.schema["wanted"].dataType))

    def second(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        t = _Tile(candidates, queries, kind, scale)
        if t.empty:
            group, c, score, of = *(np.empty(0, np.int64),) * 3, candidates
        else:
            # A window's number: the anchor's in the tile, then the positive's. 50 p <= 100 n <= 95 p, in whole numbers.
            wins = [[(i * (positives + 1) + w["place"], -(-low * int(w["positive_score"]) // 100), high * int(w["positive_score"]) // 100) for w in ws] for i, ws in enumerate(queries["wanted"].to_pylist())]
            (group, c, score), of = t.negatives(wins, negatives), t.candidates
        a, place = group // (positives + 1), group % (positives + 1)
        columns = [queries["rid"].take(pa.array(a)), queries["id"].take(pa.array(a)), pa.array(place), of["rid"].take(pa.array(c)), of["id"].take(pa.array(c)), *_scores(score, wide)]
        return pa.table(columns, names=["anchor", "anchor_id", "place", "row", "id", "s", "score"])

    found = by_tiles(plain, asks, second, f"anchor long, anchor_id long, place long, row long, id long, {numbers}", block)
    found = found.withColumn("rank", F.row_number().over(W.partitionBy("anchor", "place").orderBy(*order))).where(F.col("rank") <= negatives)
    found = found.select("anchor", "anchor_id", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = found.join(best.withColumn("place", F.col("place").cast("long")), ["anchor", "place"])
    kept = "decimal(38,0)" if wide else "long"
    scores = [F.expr(f"try_cast({c} as {kept})").alias(c) for c in ("positive_score", "negative_score")]
    return out.select("anchor_id", "positive_id", "rank", "negative_id", *scores)
