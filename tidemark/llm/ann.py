"""Nearest neighbours by cosine with randomly rotated one-bit codes.

*Index.* Every vector, scaled to length 1 and taken relative to the centre of all of them, is rotated at random into
``bits`` dimensions, of which only the signs are kept, packed. With the code come three numbers: how well it fits (inner
product of the code's direction with the rotated vector's), how long the centred vector is, and its inner product with
the centre.

*Search.* Queries aren't reduced. The inner product of a query with a code, divided by the code's fit, is an unbiased
estimate of that with the vector; its error is at most ``sigmas`` * sqrt((1 - fit^2) / fit^2 / (bits - 1)) times both
centred lengths but for a chance that falls as exp(-sigmas^2 / 2). A tile takes its candidates in slices: where estimate
plus error reaches the k-th best exact cosine so far, the candidate is reranked by the exact cosine of the original
vectors, in doubles. Each tile returns its k best a query, the best of these are the result. More bits than dimensions
make the error smaller, hence fewer vectors to rerank; neither changes which vectors come out, but for that chance.

All rows are indexed and all codes are compared, in blocks, with the queries; only what a tile returns is moved on.

Defined results: vectors that are null, empty or zero or hold null or non-finite components take no part; neither do
candidates of another dimension than the query's; rows that repeat an id are candidates of each other and queries of
their own; ties go to the smaller id, null last; an empty table gives an empty result; columns other than the id and the
vector are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import stage
from .vectors import as_reals, by_tiles, dots, matrices, pack, unpack

SLICE = 4096  # candidates that are estimated at once
GATHER = 32_768  # pairs that are reranked at once


def width(dim: int, bits: int) -> int:
    return max(bits, -(-dim // 64) * 64)


@lru_cache(8)
def rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    """``dim`` orthonormal columns of length ``bits``, drawn at random; the same in every task."""
    return np.linalg.qr(np.random.default_rng((seed, dim, bits)).standard_normal((bits, dim)))[0]


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of non-zero length scaled to 1, and which ones these are."""
    x = x.astype(np.float64)
    top = np.abs(x).max(axis=1)
    some = top > 0
    x = x[some] / top[some, None]  # so that squares of very large or small numbers don't overflow
    return x / np.sqrt((x * x).sum(axis=1))[:, None], some


def tame(x: np.ndarray) -> np.ndarray:
    """Rows whose squares may leave the range of doubles, multiplied by powers of two: cosines stay the same."""
    top = np.abs(x).max(axis=1, initial=0)
    if x.dtype == np.float64 and len(x) and (top.max() > 1e150 or top.min() < 1e-140):
        return np.ldexp(x, -np.where((top > 1e150) | (top < 1e-140), np.frexp(top)[1], 0)[:, None])
    return x


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes of unit vectors, their fit, centred length and inner product with the centre."""
    apart = x - centre
    length = np.sqrt((apart * apart).sum(axis=1))
    turned = (apart / np.where(length > 0, length, 1)[:, None]) @ turn.T
    fit = np.where(length > 0, np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[0]), 1)
    return np.packbits(turned > 0, axis=1), fit, length, x @ centre


def _sums(batches):
    """Component sums of the unit vectors of each batch."""
    for batch in batches:
        for _, x in matrices(batch.column(0)):
            x, _ = unit(x)
            n = x.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, n)), pa.array(np.arange(n)), pa.array(x.sum(axis=0)), pa.array(np.full(n, len(x)))], names=["dim", "at", "s", "n"])


def centres(vectors: DataFrame, most: int = 8) -> dict[int, np.ndarray]:
    """Mean unit vector of the ``most`` dimensions with the most vectors; others have their centre at 0."""
    sums = vectors.mapInArrow(_sums, "dim long, at long, s double, n long").groupBy("dim", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    sums = stage(sums, "sums")
    top = sums.where("at = 0").orderBy(F.desc("n"), "dim").limit(most).select("dim", "n").collect()
    found = {}
    for r in top:
        parts = sums.where(F.col("dim") == r["dim"]).orderBy("at").collect()
        found[r["dim"]] = np.array([p["s"] / max(r["n"], 1) for p in parts])
    return found


def _index(middle: dict[int, np.ndarray], bits: int, seed: int):
    def run(batches):
        from pyspark import TaskContext

        rid = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at, original in matrices(batch.column(1)):
                x, some = unit(original)
                at, original, dim = at[some], tame(original[some]), original.shape[1]
                b = width(dim, bits)
                codes, fit, length, along = encode(x, middle.get(dim, np.zeros(dim)), rotation(dim, b, seed))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid + at), batch.column(0).take(pa.array(at)), batch.column(2).take(pa.array(at)), pa.array(np.full(len(at), dim)),
                     pack(original), pack(codes), pa.array(fit), pa.array(length), pa.array(along)],
                    names=["rid", "id", "ask", "dim", "vector", "code", "fit", "length", "along"],
                )
            rid += batch.num_rows

    return run


def best_of(query: np.ndarray, score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best scores of each query, best first, ties by ``order``."""
    by = np.lexsort((order, -score, query))
    first = np.flatnonzero(np.diff(query[by], prepend=-1))
    place = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
    return by[place < k]


def search(candidates: pa.Table, queries: pa.Table, dim: int, kind: str, bits: int, seed: int, centre: np.ndarray, k: int, sigmas: float):
    """(query, candidate, score) places of the ``k`` best candidates of each query of a tile, and the number reranked."""
    b = width(dim, bits)
    turn = rotation(dim, b, seed)
    vectors, asked = unpack(candidates["vector"], kind, dim), unpack(queries["vector"], kind, dim)
    codes = unpack(candidates["code"], "u1", b // 8)
    fit, length, along = (candidates[c].to_numpy() for c in ("fit", "length", "along"))
    rid, own = candidates["rid"].to_numpy(), queries["rid"].to_numpy()
    none = np.iinfo(np.int64).max
    order = candidates["id"].fill_null(none).to_numpy()
    norm, ask_norm = dots(vectors, vectors), dots(asked, asked)
    q, _ = unit(asked)
    apart = q - centre
    far = np.sqrt((apart * apart).sum(axis=1))
    turned = (apart @ turn.T).astype(np.float32)
    shift = (q @ centre - centre @ centre).astype(np.float32)
    err = length * sigmas * np.sqrt(np.maximum(1 - fit * fit, 0) / (fit * fit) / max(b - 1, 1)) + 1e-5
    gain = length / (fit * np.sqrt(b))

    floor = np.full(len(q), -np.inf)
    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    reranked = 0
    for at in range(0, len(vectors), SLICE):
        part = slice(at, at + SLICE)
        signs = np.unpackbits(codes[part], axis=1).astype(np.float32) * 2 - 1
        for low in range(0, len(q), SLICE):
            some = slice(low, low + SLICE)
            guess = turned[some] @ signs.T
            guess *= gain[part].astype(np.float32)
            guess += along[part].astype(np.float32) + shift[some, None]
            guess[rid[part] == own[some, None]] = -np.inf
            if at == 0:  # a first k-th best: the exact cosines of the candidates that look best
                likely = np.argpartition(-guess, min(k, guess.shape[1]) - 1, axis=1)[:, :k]
                rows = np.repeat(np.arange(len(guess)), likely.shape[1])
                likely = likely.ravel()
                seen = dots(asked[some][rows], vectors[part][likely]) / np.sqrt(ask_norm[some][rows] * norm[part][likely])
                seen = np.where(np.isneginf(guess[rows, likely]), -np.inf, seen).reshape(len(guess), -1)
                if seen.shape[1] == k:
                    floor[some] = seen.min(axis=1)
            guess += err[part].astype(np.float32) * far[some, None].astype(np.float32)
            hit_q, hit_c = np.nonzero((guess >= floor[some, None] - 1e-5) & ~np.isneginf(guess))
            reranked += len(hit_q)
            hit_q, hit_c = hit_q + low, hit_c + at
            for cut in range(0, len(hit_q), GATHER):
                a, c = hit_q[cut : cut + GATHER], hit_c[cut : cut + GATHER]
                cosine = dots(asked[a], vectors[c]) / np.sqrt(ask_norm[a] * norm[c])
                good = cosine >= floor[a]
                held = [np.concatenate([x, y]) for x, y in zip(held, (a[good], c[good], cosine[good]))]
                if len(held[0]) > 4 * GATHER + k * len(q):
                    keep = best_of(held[0], held[2], order[held[1]], k)
                    held = [x[keep] for x in held]
        keep = best_of(held[0], held[2], order[held[1]], k)
        held = [x[keep] for x in held]
        full, kth = np.unique(held[0], return_counts=True)
        last = np.cumsum(kth) - 1
        floor[full[kth == k]] = held[2][last[kth == k]]
    return *held, reranked


def nearest(
    rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
    bits: int = 256, sigmas: float = 4.0, block: int = 65_536, seed: int = 7,
) -> DataFrame:
    """(query_id, rank, id, score, query_row): the ``k`` nearest rows of each row for which ``is_query`` holds."""
    source = as_reals(rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), is_query.alias("ask")), "v")
    kind = "f4" if source.schema["v"].dataType.elementType.simpleString() == "float" else "f8"
    middle = centres(source.select("v"))
    names = "rid long, id long, ask boolean, dim long, vector binary, code binary, fit double, length double, along double"
    index = stage(source.mapInArrow(_index(middle, bits, seed), names), "codes")

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        q, c, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        if len(candidates) and len(queries):
            dim = queries["dim"][0].as_py()
            q, c, score, _ = search(candidates, queries, dim, kind, bits, seed, middle.get(dim, np.zeros(dim)), k, sigmas)
        q, c = pa.array(q), pa.array(c)
        columns = [queries["rid"].take(q), queries["id"].take(q), candidates["rid"].take(c), candidates["id"].take(c), pa.array(score)]
        return pa.table(columns, names=["query_row", "query_id", "row", "id", "score"])

    columns = index.drop("ask").columns
    found = by_tiles(index.select(columns), index.where("ask").select(columns), run, "query_row long, query_id long, row long, id long, score double", block)
    order = W.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "id", "score", "query_row")
