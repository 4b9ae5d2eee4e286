"""Data-quality reports: FK orphans (D5), freshness (E5), high-water marks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Freshness limits in minutes per resource (declared operating targets).
FRESHNESS_LIMIT_MINUTES = {
    "orders": 60,
    "customers": 360,
    "products": 720,
    "collections": 720,
    "shop": 1440,
}


def _c(name: str) -> Column:
    return F.col(f"`{name}`")



def orphan_summary(relations: Sequence[tuple[str, DataFrame, DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """``(relation, n_children, n_orphans)`` for each ``(name, child, parent, fk, pk)``.

    Children are first counted per FK value (partial aggregation, so a hot FK value is combined map-side),
    then the per-value counts -- one row per distinct FK -- are joined to the distinct parent keys. No task
    ever receives all children of one parent.
    """
    parts = []
    for name, child, parent, fk, pk in relations:
        p = parent.select(*[_c(k).alias(f"__p{i}") for i, k in enumerate(pk)]).distinct() \
            .withColumn("__hit", F.lit(True))
        per_key = child.groupBy(*[_c(k) for k in fk]).agg(F.count(F.lit(1)).alias("__n"))
        cond = None
        for i, k in enumerate(fk):
            e = _c(k) == F.col(f"__p{i}")
            cond = e if cond is None else cond & e
        j = per_key.join(p, cond, "left")
        parts.append(j.agg(
            F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("n_children"),
            F.coalesce(F.sum(F.when(F.col("__hit").isNull(), F.col("__n"))), F.lit(0)).cast("bigint").alias("n_orphans"),
        ).select(F.lit(name).alias("relation"), "n_children", "n_orphans"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def high_watermark(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """Next cursor = greatest timestamp seen (per group)."""
    agg = F.max(_c(ts)).alias("high_watermark")
    return df.groupBy(*[_c(b) for b in by]).agg(agg) if by else df.agg(agg)


def freshness_report(df: DataFrame, group: str, ts: str, now: datetime,
                     limits: Mapping[str, int], group_to_resource: Mapping[str, str] | None = None) -> DataFrame:
    """E5: per group the latest timestamp, lag in whole minutes at ``now`` and the stale flag.

    ``limits`` maps resource -> minutes; ``group_to_resource`` maps group values onto resources
    (identity when omitted). The mapping is a small literal map in the plan.
    """
    mapping = group_to_resource or {k: k for k in limits}
    res = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    lim = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(int(v)))])
    now_lit = F.lit(now.replace(tzinfo=None).isoformat(sep=" ")).cast(df.schema[ts].dataType.simpleString())
    last = df.groupBy(_c(group)).agg(F.max(_c(ts)).alias("last_updated"))
    lag = F.floor((F.unix_micros(now_lit.cast("timestamp")) - F.unix_micros(F.col("last_updated").cast("timestamp")))
                  / F.lit(60_000_000)).cast("bigint")
    return last.select(
        _c(group),
        res[_c(group)].alias("resource"),
        F.col("last_updated"),
        lag.alias("lag_minutes"),
        lim[res[_c(group)]].cast("bigint").alias("limit_minutes"),
        (lag > lim[res[_c(group)]]).alias("is_stale"),
    )
