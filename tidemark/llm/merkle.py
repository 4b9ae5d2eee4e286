"""Merkle manifest of a dataset, by nested-interval labels.

Rows are leaves. Within a group (a source) they ascend by an order column; runs of ``fan`` consecutive nodes become
their parent until one is left, the group's subroot; the subroots, ordered by group, make a tree of their own, whose
last node is the root. Every node carries the interval of the leaf ranks that it covers, and nothing else says where it
stands: a node is an ancestor of another if its interval contains the other's, and a child of a parent is a sibling of
the child on the way if their intervals don't meet.

* Ranks: rows are dealt by ranges of (group, order, digest) and sorted; places before a range come from counts by range,
  so that no group is sorted in one task, however many of the rows it holds.
* Nodes: one aggregation a level, each a ``fan``-th of the one before.
* Ancestors: a containment join in buckets of the level, (tree, level, where the level's interval begins). Joined at once to the leaves,
  the upper nodes would meet all of them. So levels go in bands from the top: only the nodes at the foot of a band meet
  the band's nodes, and those at the foot of the next one carry what the foot above has found. No key meets more than
  fan^band rows.
* Siblings: of each ancestor's children those left of the node (interval ends before) and right of it (begins after).

A proof is the list of steps from a leaf to the root, each with the digests left and right; ``fold`` hashes a leaf with
them. Parents and proofs depend on digests and order only.

Defined results: a null field counts as ``-``; null groups and null orders come first; rows of equal group and order
follow their digests, and repeated rows are leaves of their own; a lone leaf is its subroot, a lone subroot the root;
an empty table gives an empty result; columns that aren't named are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import maybe_broadcast, stage

_BELOW = 33  # bits of monotonically_increasing_id that count rows of a partition
_STEP = "struct<l:binary,r:binary>"
_KIDS = "array<struct<lo:bigint,hi:bigint,digest:binary>>"


def _glue(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda held, d: F.concat(held, d))


def node_hash(*digests: Column) -> Column:
    """Digest (32 bytes) of digests that are hashed as lower-case hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(F.concat(*digests))), 256))


def leaf_hash(fields: list[Column]) -> Column:
    """Digest of a row: ``-`` for a null, else the length in bytes, a colon and the value."""

    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, fields)), 256))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(steps, leaf, lambda held, s: node_hash(s["l"], held, s["r"]))


def proof_digests(steps: Column) -> Column:
    """The digests of a proof in order, as one binary."""
    return _glue(F.transform(steps, lambda s: F.concat(s["l"], s["r"])))


def _powers(fan: int) -> list[int]:
    out = [1]
    while out[-1] < 2**62 // fan:
        out.append(out[-1] * fan)
    return out


def _height(n: Column, fan: int) -> Column:
    """Levels above the leaves: the number of powers of ``fan`` below ``n``."""
    return F.size(F.filter(F.array(*map(F.lit, _powers(fan))), lambda p: p < n))


def ranked(df: DataFrame, cols: list[str]) -> DataFrame:
    """The staged rows of ``df`` with ``place``, their position (from 0) in the order of ``cols`` over all rows."""
    spark = df.sparkSession
    # The last key splits rows that are equal in all others.
    keyed = df.withColumn("_tie", F.monotonically_increasing_id())
    cut = keyed.repartitionByRange(*cols, "_tie").sortWithinPartitions(*cols, "_tie").drop("_tie")
    rows = stage(cut.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", _BELOW)
    before, starts = 0, []
    for r in sorted(rows.groupBy(part.alias("part")).count().collect()):  # a row a range
        starts.append((r["part"], before))
        before += r["count"]
    starts = F.broadcast(spark.createDataFrame(starts, "_part long, _start long"))
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << _BELOW) - 1)
    return rows.withColumn("_part", part).join(starts, "_part").withColumn("place", place).drop("_part", "_start", "_at")


def _climb(leaves: DataFrame, height: int, fan: int) -> list[DataFrame]:
    """Nodes by level, from 1: (tree, n, h, lo, hi, digest, kids), kids being the nodes that the digest is made of."""
    levels, below = [], leaves.select("tree", "n", "h", F.col("k").alias("lo"), (F.col("k") + 1).alias("hi"), "digest")
    for level, width in enumerate(_powers(fan)[1 : height + 1], 1):
        run = below.where(F.col("h") >= level).groupBy("tree", "n", "h", F.expr(f"lo div {width}L").alias("run"))
        kids = run.agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        kids = kids.withColumns({"lo": F.col("kids")[0]["lo"], "hi": F.element_at("kids", -1)["hi"]})
        nodes = kids.select("tree", "n", "h", "lo", "hi", node_hash(_glue(F.col("kids.digest"))).alias("digest"), "kids")
        levels.append(stage(nodes, "nodes"))
        below = levels[-1].drop("kids")
    return levels


def _step(kids: Column, lo: Column, hi: Column) -> Column:
    """The children left and right of the interval: those whose own intervals don't meet it."""
    left = _glue(F.transform(F.filter(kids, lambda k: k["hi"] <= lo), lambda k: k["digest"]))
    right = _glue(F.transform(F.filter(kids, lambda k: k["lo"] >= hi), lambda k: k["digest"]))
    return F.struct(left.alias("l"), right.alias("r"))


def _attach(levels: list[DataFrame], tops: DataFrame, band: int, fan: int) -> DataFrame:
    """(tree, lo, kids, steps, subroot) of each node of level 1 and of each lone leaf: the steps above it.

    ``tops``: (tree, n, h, steps, subroot), what lies above each tree, taken as its level h + 1.
    """
    no_steps = F.lit(None).cast(f"array<{_STEP}>")
    width = lambda level: F.element_at(F.array(*map(F.lit, _powers(fan))), level + 1)
    found = tops.select("tree", (F.col("h") + 1).alias("level"), F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"), "steps", "subroot", F.lit(None).cast("int").alias("foot"))
    for foot in reversed(range(1, len(levels) + 1, band) or [1]):
        last = F.least(F.lit(foot + band), F.col("h") + 1)
        feet = [df.select("tree", "h", "lo", "hi", "kids") for df in levels[foot - 1 : foot]]
        if foot == 1:
            feet.append(tops.where("h = 0").select("tree", "h", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"), F.lit(None).cast(_KIDS).alias("kids")))
        feet = reduce(DataFrame.union, feet).withColumn("first", F.least(F.lit(foot + 1), F.col("h") + 1))
        feet = feet.withColumn("level", F.explode(F.sequence("first", last)))
        begins = F.col("lo") - F.pmod("lo", width(F.col("level")))  # of the level's interval that holds ``lo``
        feet = feet.withColumns({"bucket": begins, "kids": F.when(F.col("level") == F.col("first"), F.col("kids"))})
        # Nodes of the band, then what the feet of the band above, or the tops, have found.
        nodes = [
            df.select("tree", F.lit(level).alias("level"), "lo", "hi", F.col("kids").alias("fam"), no_steps.alias("steps"), F.lit(None).cast("binary").alias("subroot"))
            for level, df in enumerate(levels, 1)
            if foot < level <= foot + band
        ]
        above = found.where(F.col("foot").isNull() | (F.col("foot") == foot + band)).select("tree", "level", "lo", "hi", F.lit(None).cast(_KIDS).alias("fam"), "steps", "subroot")
        above = reduce(DataFrame.union, [*nodes, above]).select("tree", "level", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "fam", "steps", "subroot")
        inside = (F.col("a.tree") == F.col("b.tree")) & (F.col("a.level") == F.col("b.level")) & (F.col("a.bucket") == F.col("b._lo")) & (F.col("a.hi") <= F.col("b._hi"))
        met = feet.alias("a").join(above.alias("b"), inside)
        mine = F.when(F.col("fam").isNotNull(), F.array(_step(F.col("fam"), F.col("lo"), F.col("hi")))).otherwise(F.col("b.steps"))
        met = met.select("a.tree", "lo", "hi", "kids", "subroot", F.struct(F.col("a.level").alias("level"), F.col("fam").isNull().alias("upper"), mine.alias("steps")).alias("x"))
        grouped = met.groupBy("tree", "lo", "hi").agg(F.sort_array(F.collect_list("x")).alias("x"), F.first("kids", True).alias("kids"), F.max("subroot").alias("subroot"))
        steps = F.flatten(F.col("x.steps")).alias("steps")
        grouped = stage(grouped.select("tree", F.lit(foot).alias("level"), "lo", "hi", steps, "subroot", F.lit(foot).alias("foot"), "kids"), "paths")
        found = found.where("foot is null").union(grouped.drop("kids"))
    return grouped


def _prove(leaves: DataFrame, tops: DataFrame, levels: list[DataFrame], band: int, fan: int) -> DataFrame:
    """``leaves`` with ``steps`` and ``subroot``."""
    paths = _attach(levels, tops, band, fan).select(F.col("tree").alias("_tree"), F.col("lo").alias("_lo"), "kids", F.col("steps").alias("_steps"), "subroot")
    joined = leaves.join(paths, (F.col("tree") == F.col("_tree")) & (F.col("k") - F.pmod("k", F.lit(fan)) == F.col("_lo")))
    own = F.when(F.col("h") > 0, F.array(_step(F.col("kids"), F.col("k"), F.col("k") + 1))).otherwise(F.array().cast(f"array<{_STEP}>"))
    return joined.withColumn("steps", F.concat(own, F.col("_steps"))).drop("_tree", "_lo", "kids", "_steps")


def manifest(rows: DataFrame, band: int = 4, fan: int = 3, broadcast_rows: int = 500_000) -> DataFrame:
    """``rows`` with ``steps`` (the proof), ``subroot`` and ``root``, 32-byte digests.

    ``rows``: ``grp`` and ``ord`` (any types that sort), ``digest`` (binary, not null) and columns to carry along.
    ``band``: levels of a band; ``broadcast_rows``: of the table of groups, joined by a shuffle beyond.
    """
    spark = rows.sparkSession
    placed = ranked(rows, ["grp", "ord", "digest"])
    groups = placed.groupBy("grp").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    groups = ranked(stage(groups, "groups"), ["grp"])
    trees = stage(groups.select("grp", "first", "n", _height(F.col("n"), fan).alias("h"), F.col("place").alias("tree")), "trees")
    few = maybe_broadcast(trees.withColumnRenamed("grp", "_grp"), broadcast_rows)
    leaves = placed.join(few, F.col("grp").eqNullSafe(F.col("_grp"))).withColumn("k", F.col("place") - F.col("first"))
    leaves = stage(leaves.drop("_grp", "first", "place"), "leaves")
    total, height = trees.agg(F.count("*"), F.coalesce(F.max("h"), F.lit(0))).first()
    if not total:
        none = F.lit(None).cast("binary")
        return leaves.drop("n", "h", "tree", "k").withColumns({"steps": F.lit(None).cast(f"array<{_STEP}>"), "subroot": none, "root": none})

    levels = _climb(leaves, height, fan)
    ends = [leaves.where("h = 0").select("tree", "n", "h", "digest")]
    ends += [df.where(F.col("h") == level).select("tree", "n", "h", "digest") for level, df in enumerate(levels, 1)]
    ends = stage(reduce(DataFrame.union, ends), "subroots")

    # The tree of the subroots.
    top_height = sum(p < total for p in _powers(fan))
    size = {"tree": F.lit(0).cast("long"), "n": F.lit(total).cast("long"), "h": F.lit(top_height)}
    tops = ends.select(F.col("tree").alias("k"), "digest", F.struct("tree", "n", "h").alias("of")).withColumns(size)
    upper = _climb(tops, top_height, fan)
    root = (upper[-1] if upper else tops).first()["digest"]
    nothing = spark.range(1).select(*(v.alias(c) for c, v in size.items()), F.array().cast(f"array<{_STEP}>").alias("steps"), F.lit(None).cast("binary").alias("subroot"))
    tops = _prove(tops, nothing, upper, band, fan).select("of.tree", "of.n", "of.h", "steps", F.col("digest").alias("subroot"))
    proved = _prove(leaves, stage(tops, "tops"), levels, band, fan)
    return proved.drop("n", "h", "tree", "k").withColumn("root", F.lit(bytes(root)))
