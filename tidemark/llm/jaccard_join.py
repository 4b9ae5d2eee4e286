"""N-gram Jaccard join in the metric space of shingle sets, exact, with connected components.

Jaccard distance obeys the triangle inequality, but almost all pairs of documents are at distance 1 from each other and
from any document taken as a pivot, so document pivots alone would replicate everything everywhere. Pivots are therefore
of two kinds, sets of few shingles and documents, and regions are cut by them in turn until they are leaves.

*Shingle pivots.* A document's nearest pivots are its own shingles, ties going to the rarest. It is replicated to the
regions of as many of them as the window of the threshold asks for: n - ceil(t n) + 1 of n, and as the smaller partner of
a pair only n - ceil(2t/(1+t) n) + 1. Two linked documents meet in the region of their rarest common shingle. Regions
where no pair can be near enough, by the places that the shingle has in the documents' orders and by their sizes, are
dropped. A large region of strangers is cut by pivots of one shingle more: linked documents also share their k-th rarest
common shingle, within windows longer by k - 1, so rows go on to the regions of the k-sets that they hold.

*Document pivots.* Before that, a large region is cut by ``pivots`` of its documents, the same in all regions where they
are. Rows within 1 - t of a pivot are its cell and linked to it, hence connected. Rows in no cell go on; of a cell only the boundary goes
with them: rows whose distance to the pivot is at least the smallest distance beyond the cell, less 1 - t (triangle
inequality). Regions of which all rows are connected already are done. In regions of near copies the rows outside the
largest connected part then meet some other documents of that part, many more each round; those still outside in the end,
or in a region of strangers few, are compared with all of their region, by tiles.

How common a shingle is only orders the pivots; a sketch of bounded size (counts by a part of the hash, over all
documents) is enough for that, and results don't depend on it. Pairs are first held against counts of shingles by
``1/8 n`` parts of the hash space: the sum of the smaller counts is at least the intersection, so what it excludes is
never a link. Only sets of documents in pairs that pass are made and moved. Documents with equal sets are one class
throughout.

Defined results: null and empty texts and texts without words have no shingles and link with nothing; repeated rows are
copies of each other; a null doc_id never names a component unless all its ids are null; an empty table gives an empty
result; columns other than the id and text columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import components, drop, maybe_broadcast, recorded, stage, text_sha

_U = np.uint64
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], dtype=_U)
_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
#: A random number for each byte, the same for both cases of A-Z.
_BYTE = np.random.default_rng(20240301).integers(1, 2**64 - 1, 256, dtype=_U, endpoint=True)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0xD6E8FEB86659FD93
_SEGMENT = 1 << 20
_SPACE_BYTE = re.compile(rb"[\x20\x09-\x0D]")
_POWERS = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(n, base, _U)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _ODD[5]
    return h ^ (h >> _U(29))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes start, and their hashes: polynomials, read off the running sum over all bytes."""
    raw = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff((~_BLANK[raw]).astype(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(_BYTE[raw] * power[: len(raw)], out=sums[1:])
    return starts, _mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U) * _ODD[4])


def _segments(text: bytes):
    """A long text in segments that end at white space."""
    at = 0
    while len(text) - at > _SEGMENT:
        cut = _SPACE_BYTE.search(text, at + _SEGMENT)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _set(w: np.ndarray, width: int) -> np.ndarray:
    if len(w) < width:
        if not len(w):
            return np.empty(0, np.int64)
        whole = _U(len(w))
        for x in w:  # fewer words than a shingle has
            whole = (whole * _ODD[1] + x) ^ (whole >> _U(31))
        return _mix(np.array([whole], _U)).view(np.int64)
    n = len(w) - width + 1
    h = w[:n] * _ODD[0]
    for k in range(1, width):
        h = (h ^ (h >> _U(29))) * _ODD[k % 5] + w[k : k + n]
    h = np.sort(_mix(h).view(np.int64))
    new = np.ones(n, bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h[new]


def shingle_sets(texts: list[bytes | None], width: int = 5):
    """For each text the sorted 64-bit hashes of its distinct shingles; a text of fewer words is one shingle."""
    with np.errstate(over="ignore"):
        held, size = [], 0
        for text in [*texts, None]:
            text = text or b""
            if len(text) > _SEGMENT or size + len(text) > _SEGMENT:
                yield from _sets_of(held, width)
                held, size = [], 0
            if len(text) > _SEGMENT:
                yield _set(np.concatenate([_word_hashes(s)[1] for s in _segments(text)]), width)
            else:
                held.append(text)
                size += len(text) + 1
        yield from _sets_of(held[:-1], width)


def _sets_of(texts: list[bytes], width: int):
    if texts:
        starts, words = _word_hashes(b"\n".join(texts))
        edges = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield _set(words[a:b], width)


def shingles(text: bytes | None, width: int = 5) -> np.ndarray:
    return next(iter(shingle_sets([text], width)))


_NEVER = 2**62
#: Counters of a sketch that move together.
_PIECE = 1 << 14


def _sketch(width: int, bits: int):
    """Counts of shingles by the first ``bits`` of their hash, in pieces, for the rows of a task."""

    def run(batches):
        from pyspark import TaskContext

        counts, held, size = np.zeros(1 << bits, np.int64), [], 0
        for batch in batches:
            for h in shingle_sets(batch.column(0).to_pylist(), width):
                held.append(h)
                size += len(h)
                if size >= len(counts):
                    counts += _tally(held, bits)
                    held, size = [], 0
        if held:
            counts += _tally(held, bits)
        some = [(k, counts[k * _PIECE : (k + 1) * _PIECE]) for k in range(-(-len(counts) // _PIECE))]
        some = [(k, x) for k, x in some if x.any()]
        names = ["piece", "part", "counts"]
        part = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.int32()), pa.array([part] * len(some), pa.int32()), pa.array([_squeeze(x) for _, x in some], pa.binary())], names=names)

    return run


def _tally(sets: list[np.ndarray], bits: int) -> np.ndarray:
    return np.bincount((np.concatenate(sets).view(_U) >> _U(64 - bits)).astype(np.int64), minlength=1 << bits)


def _squeeze(counts: np.ndarray) -> bytes:
    kind = "u1" if counts.max(initial=0) < 256 else "u8"
    return kind.encode() + pa.compress(counts.astype(kind).tobytes(), codec="zstd", asbytes=True)


def _spread(data: bytes, size: int) -> np.ndarray:
    kind = data[:2].decode()
    return np.frombuffer(pa.decompress(data[2:], size * int(kind[1]), codec="zstd"), kind).astype(np.uint64)


def _add_up(table: pa.Table) -> pa.Table:
    total = sum(_spread(x.as_py(), _PIECE) for x in table["counts"])
    return pa.table([table["piece"].slice(0, 1), table["part"].slice(0, 1), pa.array([_squeeze(total)], pa.binary())], names=["piece", "part", "counts"])


def _order(texts: DataFrame, width: int, bits: int) -> np.ndarray:
    """How common the shingles of each part of the hash space are: 2**bits small numbers."""
    kinds = "piece int, part int, counts binary"
    counts = texts.select("text").mapInArrow(_sketch(width, bits), kinds)
    # Twice, so that no group holds a row of every task.
    counts = counts.groupBy("piece", "part").applyInArrow(_add_up, kinds).groupBy("piece").applyInArrow(_add_up, kinds)
    table = np.zeros(max(1 << bits, _PIECE), np.uint64)
    for r in counts.collect():  # the sketch, whose size is fixed
        table[r["piece"] * _PIECE : (r["piece"] + 1) * _PIECE] = _spread(bytes(r["counts"]), _PIECE)
    table = table[: 1 << bits]
    shift = max(int(table.mean()).bit_length() - 10, 0)  # the mean within 10 bits
    return np.minimum(table >> _U(shift), 65535).astype(np.uint16)


def _histogram(h: np.ndarray) -> bytes:
    """Counts of a set's shingles by about n/8 equal parts of the hash space; empty if one doesn't fit a byte."""
    bits = max(3, (len(h) >> 3).bit_length())
    counts = np.bincount((h.view(_U) >> _U(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def most_shared(a: bytes, b: bytes, n: int) -> int:
    """A bound on the size of the intersection of two sets, from their histograms; ``n`` if one is missing."""
    if not a or not b:
        return n
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) > len(y):
        x, y = y, x
    if len(x) < len(y):
        y = y.reshape(len(x), -1).sum(axis=1)
    return int(np.minimum(x, y).sum())


def _bounds(percent: int):
    """Pairs that may be linked, and lower bounds of the distance of the others."""

    def run(batches):
        for batch in batches:
            a, b, na, nb, ha, hb = (batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "ha", "hb"))
            most = [most_shared(x, y, min(n, m)) for x, y, n, m in zip(ha, hb, na, nb)]
            may = [(100 + percent) * i >= percent * (n + m) for i, n, m in zip(most, na, nb)]
            low = [1 - i / (n + m - i) for i, n, m in zip(most, na, nb)]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(may, pa.bool_()), pa.array(low, pa.float64())], names=["a", "b", "may", "low"])

    return run


def _prefixes(width: int, common: np.ndarray, percent: int, deeper: int):
    """Set digests, histograms and the rarest shingles of each document, in order."""
    shift = _U(64 - (len(common) - 1).bit_length())

    def run(batches):
        from pyspark import TaskContext

        rid = TaskContext.get().partitionId() << 36
        for batch in batches:
            rids, ns, digests, prefixes, counts = [], [], [], [], []
            for h in shingle_sets(batch.column("text").to_pylist(), width):
                n = len(h)
                p = min(n - (percent * n + 99) // 100 + 1 + deeper, n)
                # The rarest first, then by the hash: the same order everywhere.
                key = (common[(h.view(_U) >> shift).astype(np.int64)].astype(_U) << _U(48)) | (h.view(_U) >> _U(16))
                first = np.argpartition(key, p - 1)[:p] if p < n else np.arange(n)
                first = first[np.lexsort((first, key[first]))]
                rids.append(rid)
                ns.append(n)
                digests.append(xxhash.xxh3_128_digest(h.tobytes()))
                prefixes.append(h[first])
                counts.append(_histogram(h) if n else b"")
                rid += 1
            arrays = [pa.array(rids, pa.int64()), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(counts, pa.binary())]
            names = ["rid", "n", "digest", "prefix", "counts"]
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*arrays, *(batch.column(c) for c in rest)], names=[*names, *rest])

    return run


def _full(width: int):
    """The set of each text that has the expected digest."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rids, sets = [], []
                for rid, digest, h in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), shingle_sets(part.column(2).to_pylist(), width)):
                    if xxhash.xxh3_128_digest(h.tobytes()) == digest:
                        rids.append(rid)
                        sets.append(h)
                yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["rid", "set"])

    return run


class _Sets:
    """Whole sets of the documents that pairs name, made when they are first needed."""

    def __init__(self, texts: DataFrame, classes: DataFrame, width: int, broadcast_rows: int):
        self.texts, self.classes, self.width, self.broadcast_rows = texts, classes, width, broadcast_rows
        self.frames: list[DataFrame] = []

    def _add(self, pairs: DataFrame) -> None:
        named = pairs.select(F.col("a").alias("rid")).union(pairs.select(F.col("b").alias("rid"))).distinct()
        for have in self.frames:
            named = named.join(have.select("rid"), "rid", "left_anti")
        members = stage(named.join(self.classes.select("rid", "digest", "first"), "rid").select("rid", "digest", "first.doc_id", "first.mark"), "members")
        if members.isEmpty():
            return
        few = maybe_broadcast(members.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"}), self.broadcast_rows // 4)
        # By id and a hash of the text: neither null nor repeated ids bring other texts along.
        mine = self.texts.select("doc_id", "text", "mark").join(few, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")))
        made = stage(mine.select("rid", "digest", "text").mapInArrow(_full(self.width), "rid long, set array<long>"), "sets", compression="none")
        if made.count() > members.count():  # rows that repeat an id and its text
            made = stage(made.groupBy("rid").agg(F.first("set").alias("set")), "sets", compression="none")
        self.frames.append(made)

    def measure(self, pairs: DataFrame, percent: int) -> DataFrame:
        """(a, b, linked, d) of each of the staged pairs.

        Pairs (16 bytes each) are broadcast to the sets up to a number, joined by a shuffle beyond.
        """
        self._add(pairs)
        if not self.frames:
            return stage(pairs.select("a", "b", F.lit(False).alias("linked"), F.lit(1.0).alias("d")), "distances")
        sets = _union(self.frames)
        few = F.broadcast if pairs.count() <= self.broadcast_rows else (lambda df: df)
        one = sets.select(F.col("rid").alias("a"), F.col("set").alias("sa")).join(few(pairs.select("a", "b")), "a")
        other = sets.select(F.col("rid").alias("b"), F.col("set").alias("sb")).join(few(pairs.select("b").distinct()), "b", "left_semi")
        both = one.join(other, "b").select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"), (F.size("sa") + F.size("sb")).alias("t"))
        linked = ((100 + percent) * F.col("i") >= percent * F.col("t")).alias("linked")
        return stage(both.select("a", "b", linked, (1 - F.col("i") / (F.col("t") - F.col("i"))).alias("d")), "distances")


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _pairs_of(region: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs a < b that meet in a region, aren't connected yet, fit in size and place, and of which the smaller one is small there."""
    l, r = region.alias("l"), region.alias("r")
    smaller = F.when(F.col("l.n") < F.col("r.n"), F.col("l.small")).when(F.col("l.n") > F.col("r.n"), F.col("r.small")).otherwise(F.col("l.small") | F.col("r.small"))
    shared = F.col("l.k") - 1 + F.least(F.col("l.n") - F.col("l.pos"), F.col("r.n") - F.col("r.pos"))
    fit = (F.col("l.rid") < F.col("r.rid")) & (F.col("l.component") != F.col("r.component")) & smaller
    fit = fit & ((100 + percent) * shared >= percent * (F.col("l.n") + F.col("r.n"))) & _sizes_fit("l.n", "r.n", percent)
    return l.join(r, fit & (F.col("l.key") == F.col("r.key"))).select(F.col("l.rid").alias("a"), F.col("r.rid").alias("b"), F.col("l.n").alias("na"), F.col("r.n").alias("nb")).distinct()


def _plausible(pairs: DataFrame, counts: DataFrame, percent: int, broadcast_rows: int) -> DataFrame:
    """(a, b, may, low) of the pairs (a, b, na, nb): may they be linked, and a lower bound of their distance."""
    pairs = stage(pairs, "met")
    few = F.broadcast if pairs.count() <= broadcast_rows else (lambda df: df)
    one = counts.select(F.col("rid").alias("a"), F.col("counts").alias("ha")).join(few(pairs), "a")
    other = counts.select(F.col("rid").alias("b"), F.col("counts").alias("hb")).join(few(pairs.select("b").distinct()), "b", "left_semi")
    held = one.join(other, "b").select("a", "b", "na", "nb", "ha", "hb")
    out = stage(held.mapInArrow(_bounds(percent), "a long, b long, may boolean, low double"), "bounds")
    drop(pairs)
    return out


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    leaf: int = 32,
    pivots: int = 4,
    scouts: int = 128,
    deeper: int = 6,
    sketch_bits: int = 22,
    broadcast_rows: int = 1_000_000,
    digests: bool = False,
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``; a link is 100 * intersection >= percent * union.

    With ``digests`` also ``sha``, of the row's text, and ``component``, a number that rows without an id have too (null
    for rows without shingles).
    ``leaf``: rows of a region that is compared pair by pair; ``pivots``: documents that cut a larger one at once, at most
    ``scouts``, the documents that look for what is outside a connected part;
    ``deeper``: how many more shingles a pivot may have (rows of regions that are large then are compared in tiles);
    ``sketch_bits``: 2**sketch_bits counters order the shingles. None changes the result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))
    own = {"doc_id": "long", "mark": "long"} | ({"sha": "binary"} if digests else {})
    read = texts.withColumn("sha", text_sha("text")) if digests else texts
    common = _order(texts, width, sketch_bits)
    kinds = "rid long, n long, digest binary, prefix array<long>, counts binary, " + ", ".join(f"{c} {t}" for c, t in own.items())
    rows = stage(read.select("text", *own).mapInArrow(_prefixes(width, common, percent, deeper), kinds), "shingle_sets")

    # One class for equal sets, named by its smallest rid.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    classes = rows.where("n > 0").groupBy("digest").agg(F.min("rid").alias("rid"), first, F.count("*").alias("copies"))
    classes = stage(classes, "classes")
    copies = rows.where("n > 0").select("rid", "digest").join(classes.where("copies > 1").select("digest", F.col("rid").alias("of")), "digest")
    copies = maybe_broadcast(stage(copies.where("rid <> of").select("rid"), "copies"), broadcast_rows)
    reps = rows.where("n > 0").join(copies, "rid", "left_anti")
    counts = reps.select("rid", "counts")

    ceil = lambda num, den: F.expr(f"({num} * n + {den} - 1) div {den}")
    reach = F.col("n") - ceil(percent, 100)  # the last place of the window
    reach_small = F.col("n") - ceil(2 * percent, 100 + percent)

    def live(region: DataFrame) -> DataFrame:
        """Regions of two rows or more, one of them small there, with the number of rows."""
        sizes = region.groupBy("key").agg(F.count("*").alias("c"), F.count_if("small").alias("s")).where("c > 1 and s > 0")
        sizes = maybe_broadcast(stage(sizes.select("key", "c"), "region_sizes"), broadcast_rows)
        out = stage(region.join(sizes, "key"), "region")
        drop(sizes)
        return out

    posted = reps.select("rid", "n", reach.alias("r"), reach_small.alias("rs"), F.posexplode("prefix").alias("pos", "key")).where("pos <= r")
    posted = posted.select("key", "rid", "n", "pos", (F.col("pos") <= F.col("rs")).alias("small"))
    least = F.min(F.when(F.col("small"), F.col("n"))).alias("least")
    some = posted.groupBy("key").agg(F.count("*").alias("c"), least).where("c > 1 and least is not null").select("key", "least")
    some = stage(some, "regions")
    # The partner of a larger row has at most (1 + t) / t * (n - pos) - n shingles.
    near = F.expr(f"{100 + percent} * (n - pos) - {percent} * n >= {percent} * least")
    first_level = posted.join(maybe_broadcast(some, broadcast_rows), "key").where(F.col("small") | near).drop("least")
    start = stage(first_level.withColumns({"k": F.lit(1), "component": F.col("rid"), "most": F.lit(-1).cast("long"), "before": F.lit(_NEVER)}), "region")
    region = live(start)
    drop(some, start)

    sets = _Sets(texts, classes, width, broadcast_rows)
    links: list[DataFrame] = []
    asked = scouts
    tiles: DataFrame | None = None
    while True:
        small, big = region.where(F.col("c") <= leaf), region.where(F.col("c") > leaf)
        met, direct = _pairs_of(small, percent), tiles
        cut = not big.isEmpty()
        if cut:
            # Document pivots: the same wherever their documents are, so that pairs repeat and are measured once.
            # Where a large part is connected: scouts from it, others each round, to meet the rows outside.
            fresh = F.col("before") == _NEVER
            order = W.partitionBy("key").orderBy(F.xxhash64("rid", F.lit(len(links))), "rid")
            centre = big.where(fresh | (F.col("component") == F.col("most"))).withColumn("nth", F.row_number().over(order))
            centre = centre.where(F.col("nth") <= F.when(fresh, pivots).otherwise(asked))
            centre = stage(centre.select("key", F.col("rid").alias("p"), F.col("n").alias("pn")), "pivots")
            cells = big.where(fresh | (F.col("component") != F.col("most"))).join(maybe_broadcast(centre, broadcast_rows), "key")
            cells = stage(cells.where("rid <> p"), "cells")
            asked *= 16 if links else 1  # the first round has pivots only
            to = [F.least("rid", "p").alias("a"), F.greatest("rid", "p").alias("b")]
            sizes = [F.when(F.col("rid") < F.col("p"), F.col(x)).otherwise(F.col(y)) for x, y in (("n", "pn"), ("pn", "n"))]
            near = cells.where(_sizes_fit("n", "pn", percent)).select(*to, sizes[0].alias("na"), sizes[1].alias("nb"), fresh.alias("fresh"))
            met = met.union(near.where("fresh").drop("fresh"))
            scouted = near.where("not fresh").select("a", "b")
            direct = scouted if direct is None else direct.union(scouted)
        bounds = _plausible(met.distinct(), counts, percent, broadcast_rows)
        # Among near copies nearly every pair may be linked: these go without the histograms.
        pairs = bounds.where("may").select("a", "b")
        pairs = pairs if direct is None else pairs.union(direct).distinct()
        measured = sets.measure(stage(pairs, "pairs"), percent)
        links.append(stage(measured.where("linked").select("a", "b"), "links"))
        if not cut:
            break

        # Cells: what a pivot has within reach is connected to it.
        exact = measured.select("a", "b", "d", "linked").withColumnsRenamed({"a": "_a", "b": "_b"})
        known = bounds.join(exact, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left")
        known = stage(known.select("a", "b", "may", F.coalesce("d", "low").alias("d"), F.coalesce("linked", F.lit(False)).alias("linked")), "known")
        at = cells.where(fresh).withColumns({"a": F.least("rid", "p"), "b": F.greatest("rid", "p")}).join(known, ["a", "b"], "left")
        # Sizes alone give a lower bound of the distance where they don't fit.
        at = at.withColumns({"d": F.coalesce("d", 1 - F.least("n", "pn") / F.greatest("n", "pn")), "linked": F.coalesce("linked", F.lit(False))})
        row = ["key", "rid", "n", "pos", "small", "k", "before"]
        at = at.join(maybe_broadcast(centre.select("key", F.col("p").alias("rid")), broadcast_rows), ["key", "rid"], "left_anti")
        at = stage(at.select(*row, "p", "d", "linked", "may"), "distances")
        beyond = at.where("not linked").groupBy("key", "p").agg(F.min("d").alias("near"))
        beyond = maybe_broadcast(stage(beyond, "beyond"), broadcast_rows)
        inside = F.col("linked") & (F.col("near").isNull() | (F.col("d") < F.col("near") - (1 - percent / 100) - 1e-9))
        rest = at.join(beyond, ["key", "p"], "left").groupBy(*row).agg(F.max(inside).alias("inside")).where("not inside").drop("inside")
        rest = stage(rest.union(big.where(~fresh).select(row)), "rest")
        dense = stage(at.groupBy("key").agg((F.avg(F.col("may").cast("int")) >= 0.5).alias("dense")), "dense")
        drop(cells, at, bounds, known)
        if rest.isEmpty():
            break

        # Regions that are connected throughout are done; of the others the rows outside their largest part count.
        group = components(rest.select(F.col("rid").alias("id")).distinct(), _union(links)).withColumnRenamed("id", "rid")
        rest = stage(rest.join(stage(group, "group"), "rid"), "rest")
        parts = rest.groupBy("key", "component").agg(F.count("*").alias("m")).groupBy("key").agg(F.sum("m").alias("c"), F.max(F.struct("m", "component")).alias("top"))
        parts = parts.select("key", "c", F.col("top.component").alias("most"), (F.col("c") - F.col("top.m")).alias("outside")).where("outside > 0")
        parts = stage(parts.join(dense, "key", "left"), "parts")
        rest = rest.join(maybe_broadcast(parts, broadcast_rows), "key").withColumn("dense", F.coalesce("dense", ~fresh))
        # Near copies: scouts, many more each round, while these are few of the region. Strangers: one shingle more. Few
        # rows outside, or near copies that scouts haven't connected: against all of their region.
        few = ~F.col("dense") & ((F.col("outside") <= leaf) | (F.col("k") > deeper))
        last = few | (F.col("dense") & (4 * asked >= F.col("c")))
        tiles = _tiles(rest.where(last), percent)
        again = rest.where(~last & F.col("dense")).withColumn("before", F.col("outside"))
        going = rest.where(~last & ~F.col("dense")).join(reps.select("rid", "prefix"), "rid")
        more = going.withColumns({"r": reach + F.col("k"), "rs": reach_small + F.col("k"), "from": F.col("pos")}).drop("pos")
        more = more.select("*", F.posexplode("prefix").alias("pos", "s")).where("pos > from and pos <= r")
        more = more.withColumns({"key": F.xxhash64("key", "s"), "small": F.col("pos") <= F.col("rs"), "k": F.col("k") + 1, "before": F.lit(_NEVER)})
        columns = ["key", "rid", "n", "pos", "small", "k", "component", "most", "before"]
        region = live(stage(more.select(columns).unionByName(again.select(columns)), "deeper"))

    found = stage(_union(links), "links")
    drop(*sets.frames)
    linked_ids = found.select(F.col("a").alias("id")).union(found.select(F.col("b").alias("id"))).distinct()
    group = components(linked_ids, found).withColumnRenamed("id", "rid")
    named = classes.withColumn("low", F.col("first.doc_id")).join(group, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    more = ["component"] if digests else []
    named = stage(named.select("digest", "component").join(lowest, "component").select("digest", "component_id", *more), "named")
    more += ["sha"] if digests else []
    return rows.select("doc_id", "n", "digest", *more[1:]).join(named.withColumnRenamed("digest", "_d"), (F.col("n") > 0) & (F.col("digest") == F.col("_d")), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *more
    )


def _tiles(rest: DataFrame, percent: int, side: int = 256) -> DataFrame:
    """Pairs of rows of which one is outside the largest part of their region, by tiles; of regions with equal rows one is taken."""
    rows = rest.groupBy("key").agg(F.sum(F.xxhash64("rid").cast("decimal(38,0)")).alias("h"), F.count("*").alias("m"))
    same = stage(rows.groupBy("h", "m").agg(F.min("key").alias("key")).select("key"), "one_of_equal")
    rest = rest.join(same, "key", "left_semi")
    left = rest.where("component <> most").withColumn("tile", F.pmod(F.xxhash64("rid"), F.expr(f"c div {side} + 1")))
    right = rest.withColumn("tile", F.explode(F.expr(f"sequence(0L, c div {side})")))
    l, r = left.alias("l"), right.alias("r")
    fit = (F.col("l.key") == F.col("r.key")) & (F.col("l.tile") == F.col("r.tile")) & (F.col("l.component") != F.col("r.component")) & _sizes_fit("l.n", "r.n", percent)
    return l.join(r, fit).select(F.least("l.rid", "r.rid").alias("a"), F.greatest("l.rid", "r.rid").alias("b"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, null the last, then the smallest digest.

    A document is an id, null included, with a text: its repeated rows stay or go together, and texts that share an id
    are documents of their own. Texts without words link with nothing and stay.
    """
    with recorded() as made:
        found = jaccard_components(docs, id_col, text_col, digests=True, **params)
    found = stage(found.where("component is not null").select("component", "doc_id", "sha"), "documents")
    drop(*made)
    mine = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha")
    best = found.groupBy("component").agg(F.min(mine).alias("best"), F.max(mine).alias("last")).where("best <> last")
    best = best.select("component", F.col("best.doc_id").alias("best_id"), F.col("best.sha").alias("best_sha"))
    gone = ~(F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("sha") == F.col("best_sha")))
    dropped = stage(found.join(best, "component").where(gone).select(F.col("doc_id").alias("_drop"), F.col("sha").alias("_sha")).distinct(), "dropped")
    return docs.join(dropped, docs[id_col].eqNullSafe(F.col("_drop")) & (text_sha(docs[text_col].cast("binary")) == F.col("_sha")), "left_anti")
