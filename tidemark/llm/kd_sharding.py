"""Sharding by a k-d tree over metadata, split at distributed weighted medians.

A node is cut along its widest metadata dimension where the bytes below reach the share of its left leaves; the halves
are cut again until a leaf holds the target bytes. A median is found by counting, not sorting: bytes are summed in a
fixed number of bins, the bin that holds the median is binned again, until it holds a single value; rows of that one
value are told apart the same way by a hash. Every sum is combined on the map side; the driver sees one row a node.
Whole numbers are coordinates as they are; values of any other type (strings, fractions, times) by their exact rank among
the distinct values, which are counted on the map side and sorted in ranges.
Equal texts take the place of their first row, so they land in one leaf, unless their group alone weighs more than a
``split_share`` of a leaf: such groups are dealt row by row.

Defined results: a null text has no bytes and the checksum of the empty text; null metadata sorts first; repeated rows
are sharded each; an empty table gives an empty result; columns that aren't named as text, id or dimension are ignored,
whatever their names. DataFrame functions only.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import stage


def _nodes(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A broadcast table of whole numbers, one row a node, made without a Python worker: one literal, however many nodes."""
    columns = [n.strip() for n in names.split(",")]
    text = json.dumps([{n: int(v) for n, v in zip(columns, r)} for r in rows])
    kind = "array<struct<" + ", ".join(f"{n}: bigint" for n in columns) + ">>"
    return F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(text), kind))))


def _ranks(docs: DataFrame, name: str, value: str, code: str) -> DataFrame:
    """(value, code): the distinct values of a column that aren't null, numbered from 0 in their order.

    No task sees all values: each range of the sort is numbered alone and starts where those before it end.
    """
    values = docs.select(F.col(name).alias(value)).where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    ranged = values.select(value).orderBy(value).select(value, F.monotonically_increasing_id().alias("at"))
    ranged = stage(ranged.select(value, F.shiftright("at", 33).alias("range"), F.expr("at & 8589934591").alias("nth")), "shard_values")
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"))  # one row a range
    start = F.coalesce(F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("range", start.alias("start")))
    return ranged.join(starts, "range").select(value, (F.col("start") + F.col("nth")).cast("long").alias(code))


def _coordinates(docs: DataFrame, dims: tuple[str, ...], broadcast_bytes: int) -> tuple[list[Column], list[tuple[str, str, DataFrame, bool]]]:
    """For each dimension a column that sorts as it does, null first, and the rank tables that it needs."""
    longs = [d for d in dims if isinstance(docs.schema[d].dataType, T.LongType)]
    found = docs.agg(*[f(d).alias(f"{n}{i}") for i, d in enumerate(longs) for n, f in (("lo", F.min), ("hi", F.max))]).first() if longs else None
    columns, tables = [], []
    for i, d in enumerate(dims):
        least = None
        if isinstance(docs.schema[d].dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            least = -(1 << 31)
        elif d in longs:
            lo, hi = (found[f"{n}{longs.index(d)}"] or 0 for n in ("lo", "hi"))
            least = lo if -(1 << 61) < lo and hi < 1 << 61 else None  # differences of wider ones are no longs
        if least is not None:
            columns.append(F.coalesce(F.col(d).cast("long"), F.lit(least - 1).cast("long")))
            continue
        ranks = stage(_ranks(docs, d, f"v{i}", f"r{i}"), "shard_ranks")
        size = ranks.agg(F.sum(F.octet_length(F.col(f"v{i}").cast("string").cast("binary")) + 16)).first()[0] or 0
        tables.append((d, f"v{i}", ranks, size <= broadcast_bytes))
        columns.append(F.coalesce(F.col(f"r{i}"), F.lit(-1).cast("long")))
    return columns, tables


def _key(n_dims: int) -> Column:
    return F.element_at(F.array(*[F.col(f"c{i}") for i in range(n_dims)]), (F.col("dim") + 1).cast("int"))


def _refine(rows: DataFrame, key: str, state: list[tuple], bins: int) -> dict[int, tuple]:
    """For each node the key value at which the running weight reaches the goal: node -> (value, weight below, its weight)."""
    spark, done, open_ = rows.sparkSession, {}, list(state)
    while open_:
        s = _nodes(spark, open_, "node, lo, hi, base, goal")
        width = F.expr("(hi - lo) div %d + 1" % bins)
        inside = rows.join(s, "node").where(f"{key} between lo and hi").withColumn("width", width).withColumn("bin", F.expr(f"({key} - lo) div width"))
        binned = inside.groupBy("node", "base", "goal", "bin").agg(F.sum("w").alias("w"), F.min(key).alias("low"), F.max(key).alias("high"))
        order = W.partitionBy("node").orderBy("bin")  # at most ``bins`` + 1 rows of a node
        run = binned.withColumn("upto", F.col("base") + F.sum("w").over(order)).withColumn("n", F.max("bin").over(W.partitionBy("node")))
        hit = run.where("upto - w < goal and (upto >= goal or bin = n)").select("node", "low", "high", "upto", "w", "goal").collect()
        open_ = []
        for r in hit:
            if r["low"] == r["high"]:
                done[r["node"]] = (r["low"], r["upto"] - r["w"], r["w"])
            else:
                open_.append((r["node"], r["low"], r["high"], r["upto"] - r["w"], r["goal"]))
    return done


def _split(rows: DataFrame, leaves: dict[int, int], n_dims: int, extent: list[tuple], bins: int) -> DataFrame:
    """One level: every node with more than one leaf becomes nodes 2n and 2n + 1. Rows gain nothing but the new node."""
    spark = rows.sparkSession
    aggs = [f(f"c{i}").alias(f"{n}{i}") for i in range(n_dims) for n, f in (("lo", F.min), ("hi", F.max))]
    stats = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("w").alias("w"), *aggs).collect()}
    state = []
    for node, n in leaves.items():
        if n > 1 and node in stats:
            r = stats[node]
            spread = [(r[f"hi{i}"] - r[f"lo{i}"]) / max(extent[i][1] - extent[i][0], 1) for i in range(n_dims)]
            dim = max(range(n_dims), key=lambda i: (spread[i], -i))
            goal = max(1, round(r["w"] * (n // 2) / n))
            state.append((node, dim, r[f"lo{dim}"], r[f"hi{dim}"], goal))
    chosen = _nodes(spark, [s[:2] for s in state], "node, dim")
    keyed = rows.join(chosen, "node").withColumn("key", _key(n_dims))
    found = _refine(keyed, "key", [(n, lo, hi, 0, goal) for n, _, lo, hi, goal in state], bins)
    # Rows that share the value at the cut: the same search over their tie hash.
    at = _nodes(spark, [(n, v[0]) for n, v in found.items()], "node, at")
    ties = keyed.join(at, "node").where("key = at")
    span = {r["node"]: r for r in ties.groupBy("node").agg(F.min("tie").alias("lo"), F.max("tie").alias("hi")).collect()}
    goals = {s[0]: s for s in state}
    tie_at = _refine(ties.select("node", "tie", "w"), "tie", [(n, span[n]["lo"], span[n]["hi"], v[1], goals[n][4]) for n, v in found.items()], bins)
    cuts = []
    for node, (value, _, _) in found.items():
        tie, below, weight = tie_at[node]
        goal = goals[node][4]
        cuts.append((node, goals[node][1], value, tie, int(abs(below + weight - goal) <= abs(below - goal))))
    cut = _nodes(spark, cuts, "node, dim, at, tie_at, keep")
    left = (F.col("key") < F.col("at")) | ((F.col("key") == F.col("at")) & ((F.col("tie") < F.col("tie_at")) | ((F.col("tie") == F.col("tie_at")) & (F.col("keep") == 1))))
    moved = rows.join(cut, "node", "left").withColumn("key", _key(n_dims))
    child = F.when(F.col("at").isNull(), F.col("node") * 2).otherwise(F.col("node") * 2 + F.when(left, 0).otherwise(1))
    return moved.withColumn("node", child).select(rows.columns)


def kd_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    dims: tuple[str, ...] = ("lang", "source", "n_chars"),
    shards: int | None = None,
    target_bytes: int | None = None,
    bins: int = 1024,
    split_share: float = 1 / 64,
    broadcast_bytes: int = 8 << 20,
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot); shards are leaves from left to right, slots gapless from 0.

    Give ``shards``, or ``target_bytes`` of a leaf. The tree's nodes, at most as many as leaves, pass through the driver.
    ``broadcast_bytes``: distinct values of a dimension up to this size are broadcast with their ranks, more are joined by
    a shuffle.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    coords, tables = _coordinates(docs, dims, broadcast_bytes)
    own = [F.col(f"d{i}") for i in range(len(dims))]
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("w"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("h"),
        *[F.col(d).alias(v) for d, v, _, _ in tables],
        *[c.alias(f"d{i}") for i, c in enumerate(coords) if f"v{i}" not in {v for _, v, _, _ in tables}],
    )
    for _, value, ranks, small in tables:
        base = base.join(F.broadcast(ranks) if small else ranks, value, "left")
    ranked = {f"v{i}": c.alias(f"d{i}") for i, c in enumerate(coords)}
    kept = ["doc_id", "w", "crc", "h", *[c for c in base.columns if c[0] == "d" and c[1:].isdigit()]]
    base = base.select(*kept, *[ranked[v] for _, v, _, _ in tables])
    base = stage(base, "shard_rows")
    total = base.agg(F.sum("w").alias("w"), F.count("*").alias("n"), *[f(f"d{i}").alias(f"{n}{i}") for i in range(len(dims)) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    weight = total["w"] or 0
    if not shards and not target_bytes:
        raise ValueError("give shards or target_bytes")
    leaves = {1: shards or max(1, math.ceil(weight / target_bytes))}
    heavy = F.lit(weight / leaves[1] * split_share)

    # Groups of equal texts: the coordinates of their first row, one hash for all.
    first = F.min(F.struct("doc_id", *own)).alias("f")
    groups = stage(base.groupBy("h").agg(F.sum("w").alias("gw"), F.count("*").alias("gn"), first).where((F.col("gn") > 1) & (F.col("gw") <= heavy)).select("h", "f"), "shard_groups")
    rows = base.join(groups, "h", "left")
    alone = F.col("f").isNull()
    tie = F.shiftrightunsigned(F.when(alone, F.xxhash64("h", "doc_id")).otherwise(F.xxhash64("h")), 2)
    coords = [F.when(alone, F.col(f"d{i}")).otherwise(F.col(f"f.d{i}")).alias(f"c{i}") for i in range(len(dims))]
    rows = stage(rows.select("doc_id", "w", "crc", tie.alias("tie"), F.lit(1).cast("long").alias("node"), *coords), "shard_nodes")

    extent = [(total[f"lo{i}"] or 0, total[f"hi{i}"] or 0) for i in range(len(dims))]
    while weight and max(leaves.values()) > 1:
        rows = stage(_split(rows, leaves, len(dims), extent, bins), "shard_nodes")
        leaves = {c: k for node, n in leaves.items() for c, k in ((2 * node, n // 2 if n > 1 else 1), (2 * node + 1, n - n // 2 if n > 1 else 0)) if k}
    number = _nodes(docs.sparkSession, [(node, i) for i, node in enumerate(sorted(leaves))], "node, number")
    rows = rows.join(number, "node").withColumn("shard", F.col("number").cast("int"))

    # Slots without a task that sees a whole shard: numbered in small buckets, whose sizes add up to the starts.
    buckets = max(1, math.isqrt(total["n"]))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    start = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = stage(counts.select("shard", "bucket", start.alias("start")), "shard_starts")
    nth = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "tie"))
    placed = rows.withColumn("nth", nth).join(starts, ["shard", "bucket"])
    return placed.select("doc_id", F.col("w").alias("size"), F.col("crc").alias("text_crc32"), "shard", (F.col("start") + F.col("nth") - 1).cast("long").alias("slot"))
