"""Nearest neighbours and hard negatives against brute force."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, hard_negatives
from tidemark.llm.vectors import dots, pack, unpack

def ask():
    return F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False))


def relabelled():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Ties, repeated rows, nulls everywhere, zero, empty and non-finite vectors, other dimensions, clashing names."""
    r = np.random.default_rng(5)
    rows = [(i, r.standard_normal(4).tolist(), int(i % 3)) for i in range(40)]
    rows += [(100 + i, [0.5, 0.25, -1.0, 2.0], i % 2) for i in range(30)]  # one vector many times
    rows += [(50, [0.5, 0.25, -1.0, 2.0], 1), (50, [0.5, 0.25, -1.0, 2.0], 1), (50, [1.0, 0.0, 0.0, 0.0], 0), (None, [0.5, 0.25, -1.0, 1.9], 0)]
    rows += [(200, None, 1), (250, [], 1), (300, [0.0] * 4, 1), (350, [1.0, None, 0.0, 0.0], 1), (400, [1.0, math.nan, 0.0, 0.0], 1)]
    rows += [(450, [1.0, math.inf, 0.0, 0.0], 1), (500, [1.0, 2.0], 1), (501, [2.0, 1.0], 1), (502, [-1.0, 3.0], 2), (550, [1.0, 1.0, 1.0, 1.0], None)]
    rows += [(600, [1.0, 2.0, 3.0], 5)]  # nothing of its dimension
    names = "rid long, id string, dim int, code string, _q int, s string, rank string"
    return spark.createDataFrame([(*x, 1, "x", 2, "x", 3, "x", "x") for x in rows], f"vec_id long, embedding array<double>, label int, {names}")


def usable(v):
    return v and all(c is not None and math.isfinite(c) for c in v)


def plain_nearest(rows, k):
    rows = [(i, v) for i, v, _ in rows if usable(v) and any(v)]
    out = []
    for at, (q, a) in enumerate(rows):
        if q is not None and q % 50 == 0:
            some = []
            for to, (c, b) in enumerate(rows):
                if to != at and len(a) == len(b):
                    x, y = np.array([a]), np.array([b])
                    some.append((-float(dots(x, y)[0] / np.sqrt(dots(x, x)[0] * dots(y, y)[0])), c is None, c or 0, c))
            out += [(q, n, c, -s) for n, (s, _, _, c) in enumerate(sorted(some)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("params", [{}, {"block": 16}, {"k": 2, "bits": 64}, {"k": 90}])
def test_nearest(spark, odd_vectors, params):
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    for df in (given, odd_vectors):
        rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
        found = ann.nearest(df, ask(), **params).collect()
        assert sorted(((r["query_id"], r["rank"], r["id"], r["score"]) for r in found), key=str) == plain_nearest(rows, params.get("k", 5))
    assert ann.nearest(odd_vectors.where("false"), ask()).collect() == []
    assert ann.nearest(odd_vectors.where("vec_id = 50").limit(1), ask()).collect() == []


def test_very_large_components(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [1e-200, 1.1e-200]), (3, [-5.0, 5.0])]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ask()).orderBy("rank").collect()
    assert [r["id"] for r in found] == [2, 1, 3] and found[1]["score"] == pytest.approx(math.sqrt(0.5)) and abs(found[2]["score"]) < 1e-12


def test_error_bound_and_reranking():
    """Estimates stay within their bound, and few candidates are reranked."""
    import pyarrow as pa

    r = np.random.default_rng(3)
    x, _ = ann.unit(r.standard_normal((6000, 64)) + r.standard_normal((30, 64))[r.integers(0, 30, 6000)] * 0.9 + 0.3)
    centre, turn = x.mean(axis=0), ann.rotation(64, 256, 7)
    assert np.allclose(turn.T @ turn, np.eye(64))
    codes, fit, length, along = ann.encode(x, centre, turn)
    signs = np.unpackbits(codes, axis=1) * 2.0 - 1
    q = x[:50] - centre
    guess = (q @ turn.T) @ signs.T / 16 / fit * length + along + (x[:50] @ centre - centre @ centre)[:, None]
    error = np.abs(guess - x[:50] @ x.T)
    bound = 4 * np.sqrt((1 - fit**2) / fit**2 / 255) * length * np.sqrt((q * q).sum(axis=1))[:, None]
    np.fill_diagonal(error, 0)
    assert (error > bound).mean() < 2e-4 and bound.mean() < 0.25  # four standard deviations
    ids = np.arange(len(x))
    names = ["rid", "id", "vector", "code", "fit", "length", "along"]
    table = pa.table([pa.array(ids), pa.array(ids), pack(x), pack(codes), pa.array(fit), pa.array(length), pa.array(along)], names=names)
    hit_q, hit_c, score, reranked = ann.search(table, table.slice(0, 50), 64, "f8", 256, 7, centre, 5, 4.0)
    exact = x[:50] @ x.T
    exact[np.arange(50), np.arange(50)] = -1
    best = np.argsort(-exact, axis=1)[:, :5]
    assert hit_c.tolist() == best.ravel().tolist() and reranked < 0.2 * exact.size


def floor(x, scale):
    return math.floor(Fraction(x) * scale)


def plain_mine(rows, positives, negatives, scale=256):
    rows = [(i, [floor(c, scale) for c in v], (lab + 1) % 10 if i is not None and i % 7 == 0 else lab) for i, v, lab in rows if lab is not None and usable(v)]
    out = []

    def best(found, k):
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]

    for at, (a, v, lab) in enumerate(rows):
        if a is None or a % 50:
            continue
        some = [(sum(x * y for x, y in zip(v, w)), i, other) for to, (i, w, other) in enumerate(rows) if to != at and len(w) == len(v)]
        for p, i, _ in best([s for s in some if s[2] == lab], positives):
            fits = [s for s in some if s[2] != lab and 50 * p <= 100 * s[0] <= 95 * p]
            out += [(a, i, n, j, p, s) for n, (s, j, _) in enumerate(best(fits, negatives), 1)]
    return sorted(out, key=str)


def mined(df, **params):
    found = hard_negatives.mine(df, ask(), relabelled(), **params).collect()
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(None if r[c] is None else int(r[c]) for c in names) for r in found), key=str)


@pytest.mark.parametrize("params", [{}, {"block": 16}, {"positives": 9, "negatives": 40}])
def test_mine(spark, odd_vectors, params):
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    n = (params.get("positives", 5), params.get("negatives", 3))
    for df in (given, odd_vectors):
        plain = plain_mine([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()], *n)
        assert plain and mined(df, **params) == plain
    assert mined(odd_vectors.where("false")) == [] and mined(odd_vectors.where("vec_id = 50").limit(1)) == []


def test_mine_very_large_components(spark):
    """Integers of any width: scores beyond 2^63."""
    r = np.random.default_rng(9)
    rows = [(i, (r.random(3) * 10.0 ** int(r.integers(0, 15))).tolist(), int(i % 3)) for i in range(0, 150, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert mined(df) == plain_mine(rows, 5, 3) and any(abs(x[4]) > 2**63 for x in mined(df))


@pytest.mark.parametrize("high", [1, 300, 2**20, 2**40, 2**70])
def test_products(high):
    r = np.random.default_rng(1)
    draw = lambda n: np.array([[int(x) * high // 1000 for x in row] for row in r.integers(-1000, 1000, (n, 7))], dtype=object if high > 2**50 else np.int64)
    a, b = draw(5), draw(131)
    assert hard_negatives.products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]


def test_whole():
    values = [0.1, -0.1, 1e-320, -1e-320, 2.0**60 + 2**10, -1.7e308, 3.999999999, 1e16]
    assert [int(x) for x in hard_negatives.whole(np.array([values]), 256)[0]] == [floor(x, 256) for x in values]


def test_pack_round_trip():
    x = np.arange(12, dtype=np.float32).reshape(3, 4)
    assert (unpack(pack(x), "f4", 4) == x).all()
