"""Primary-key merge semantics as DataFrame algebra.

``upsert`` is the pure relational form; ``sources.store.TableStore.merge`` applies it per hash bucket
so only buckets touched by the delta are rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, ArrayType, DataType
from pyspark.sql.window import Window


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _orderable(t: DataType) -> bool:
    if isinstance(t, MapType):
        return False
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    return True


def dedupe_by_pk(df: DataFrame, pk: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """One row per primary key: greatest ``prefer`` tuple, then greatest full row (fully deterministic).

    A first-row window: Spark keeps one row of a key in each map task before the shuffle (window group limit), so
    duplicate-heavy keys are reduced there, and rows are carried once.
    """
    rest = [c for c in df.columns if c not in pk]
    if not rest:
        return df.dropDuplicates(list(pk))
    tie = [_c(c) for c in rest if _orderable(df.schema[c].dataType)]
    order = [c.desc() for c in (*prefer, *tie)] or [F.lit(0)]
    first = F.row_number().over(Window.partitionBy(*[_c(k) for k in pk]).orderBy(*order))
    return df.withColumn("__nth", first).where("__nth = 1").select(*[_c(k) for k in pk], *[_c(c) for c in rest])


def upsert(target: DataFrame, source: DataFrame, pk: Sequence[str], dedupe: bool = True,
           prefer: Sequence[Column] = ()) -> DataFrame:
    """Full-row replace on PK match; unmatched target rows kept; unmatched source rows inserted."""
    src = dedupe_by_pk(source, pk, prefer) if dedupe else source
    src = src.select(*[_c(c) for c in target.columns])
    kept = target.join(src.select(*[_c(k) for k in pk]), list(pk), "left_anti")
    return kept.unionByName(src)


def merge_counts(target: DataFrame, source: DataFrame, pk: Sequence[str]) -> DataFrame:
    """E4 counters of an upsert: rows_in, distinct keys, inserted, updated (one aggregation pass)."""
    keys = source.select(*[_c(k) for k in pk]).withColumn("__n", F.lit(1)) \
        .groupBy(*[_c(k) for k in pk]).agg(F.count("__n").alias("__dups"))
    tk = target.select(*[_c(k) for k in pk]).withColumn("__hit", F.lit(True))
    j = keys.join(tk, list(pk), "left")
    return j.agg(
        F.sum("__dups").cast("bigint").alias("rows_in"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        F.count_if(F.col("__hit").isNull()).cast("bigint").alias("inserted"),
        F.count_if(F.col("__hit")).cast("bigint").alias("updated"),
    )
