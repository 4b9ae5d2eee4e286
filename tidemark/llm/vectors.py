"""Shared by the operators on vectors: reading list columns as matrices, and dealing all rows against a set of queries.

A tile is a block of candidates against a block of queries of the same dimension. Blocks come from hashes of row
numbers, so no value of a column makes one large; the number of blocks follows the number of rows, so that a tile holds
a bounded number of vectors. Each vector is sent once to each block of the other side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def as_reals(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the list column ``name`` as floats if that is what it holds, else as doubles."""
    kind = df.schema[name].dataType.elementType.simpleString()
    return df if kind in ("float", "double") else df.withColumn(name, F.col(name).cast("array<double>"))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each dimension the rows of a list column (their numbers, a matrix); no null, empty or non-finite vectors."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    values = column.flatten()
    values = values.to_numpy(zero_copy_only=False)  # null components become nan
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    good = lengths > 0
    if good.any():
        good[good] = np.logical_and.reduceat(np.isfinite(values), starts[good])
    for dim in np.unique(lengths[good]).tolist():
        at = np.flatnonzero(good & (lengths == dim))
        yield at, values[starts[at][:, None] + np.arange(dim)]


def pack(matrix: np.ndarray) -> pa.Array:
    """A binary for each row of a matrix."""
    matrix = np.ascontiguousarray(matrix)
    width = matrix.shape[1] * matrix.itemsize
    return pa.Array.from_buffers(pa.binary(width), len(matrix), [None, pa.py_buffer(matrix)]).cast(pa.binary())


def unpack(column: pa.Array | pa.ChunkedArray, kind: str, dim: int) -> np.ndarray:
    """The matrix of a binary column of rows of equal width."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), dim)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner product of each row of ``a`` with that of ``b``, summed in order in doubles: equal vectors give equal sums."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j].astype(np.float64) * b[:, j].astype(np.float64)
    return out


def by_tiles(rows: DataFrame, asks: DataFrame, run: Callable, schema: str, block: int) -> DataFrame:
    """The staged rows that ``run(candidates, queries)`` returns for each tile.

    ``rows`` and ``asks`` have the same columns, ``rid`` and ``dim`` among them; ``run`` takes and returns Arrow tables,
    of at most about ``block`` rows each.
    """
    spark = rows.sparkSession
    # Smaller tiles where there are few of them, to use every core; results don't depend on it.
    blocks = lambda n, least: max(-(-n // block), min(n // least, spark.sparkContext.defaultParallelism), 1)
    over, across = blocks(rows.count(), 2048), -(-asks.count() // block) or 1
    hashed = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    there = rows.withColumns({"_ask": F.lit(False), "_c": hashed(over)}).withColumn("_q", every(across))
    here = asks.withColumns({"_ask": F.lit(True), "_q": hashed(across)}).withColumn("_c", every(over))
    dealt = there.unionByName(here)

    def tile(table: pa.Table) -> pa.Table:
        ask = table.column("_ask").combine_chunks()
        table = table.drop_columns(["_ask", "_c", "_q"])
        return run(table.filter(pc.invert(ask)), table.filter(ask))

    return stage(dealt.groupBy("dim", "_c", "_q").applyInArrow(tile, schema), "tiles")
