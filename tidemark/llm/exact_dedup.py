"""Exact deduplication by content-defined chunk recipes.

Every text is normalised (ASCII white space deleted) and cut where a rolling hash of the last sixteen bytes says so;
equal passages thus give equal chunks wherever they stand. Chunk bodies are written once. Fingerprints that occur
more than once have their bodies compared, byte by byte, and a fingerprint with several bodies gets an ordinal for
each: (fingerprint, ordinal) is the verified identifier of a chunk. From then on only identifiers move: texts are
equal when their ordered identifier lists are.

Defined results: a null text counts as empty, and all empty texts are equal; a null doc_id is an ordinary, smallest
id; of repeated rows (same doc_id and text) exactly one is kept; an empty table gives an empty result; columns other
than the id and text columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import drop, maybe_broadcast, recorded, stage

_BLANK = b" \t\n\x0b\x0c\r"
_WINDOW = 16
_GEAR = np.random.default_rng(20240229).integers(0, 2**32, 256, dtype=np.uint32)

CHUNKS = "rid long, doc_id long, n_chars long, sha string, ord int, fp long, body binary"


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the sixteen bytes that end at each position, by doubling the window four times."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8):
        shifted = np.zeros_like(h)
        shifted[k:] = h[:-k] << np.uint32(k)
        h = h + shifted
    return h


def cut_points(body: bytes, bits: int) -> list[int]:
    """Ends of the chunks of one text: 2**bits bytes on average, a quarter of that at least, eight times at most."""
    n, low, high = len(body), max(_WINDOW, 1 << max(bits - 2, 0)), 8 << bits
    if n <= low:
        return [n]
    marks = np.flatnonzero((rolling(np.frombuffer(body, np.uint8)) >> np.uint32(32 - bits)) == 0) + 1
    ends, start = [], 0
    for m in marks.tolist():
        while m - start > high:
            start += high
            ends.append(start)
        if m - start >= low and m < n:
            ends.append(m)
            start = m
    while n - start > high:
        start += high
        ends.append(start)
    return [*ends, n]


def _chunker(bits: int, fp_bits: int):
    shift = 64 - fp_bits

    def run(batches):
        from pyspark import TaskContext

        rid = TaskContext.get().partitionId() << 36
        for batch in batches:
            out = [[] for _ in range(7)]
            for doc_id, text, n_chars in zip(*(batch.column(i).to_pylist() for i in range(3))):
                body = (text or b"").translate(None, _BLANK)
                sha, start = hashlib.sha256(body).hexdigest(), 0
                for k, end in enumerate(cut_points(body, bits)):
                    piece = body[start:end]
                    start = end
                    fp = (xxhash.xxh3_64_intdigest(piece) >> shift) - (0 if shift else 1 << 63)
                    for column, value in zip(out, (rid, doc_id, n_chars, sha, k, fp, piece)):
                        column.append(value)
                rid += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=[c.split()[0] for c in CHUNKS.split(", ")])

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bits: int = 11, fp_bits: int = 64, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(rid, doc_id, n_chars, text_sha256, keep_id, group_size, kept), one row per row of ``docs``.

    Of equal texts the row with the most code points in its original text, then the smallest id, is kept.
    ``chunk_bits``: 2**chunk_bits bytes a chunk on average; ``fp_bits``: bits of a fingerprint (tests lower it to force
    collisions; results don't depend on it); ``broadcast_rows``: repeated fingerprints (8 bytes each) that are broadcast;
    more are joined by a shuffle.
    """
    narrow = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"), F.coalesce(F.length(text_col), F.lit(0)).cast("long"))
    chunks = stage(narrow.mapInArrow(_chunker(chunk_bits, fp_bits), CHUNKS), "chunks")

    # Only bodies whose fingerprint occurs again move, and each once a task.
    seen = stage(chunks.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "seen")
    seen = maybe_broadcast(seen, broadcast_rows)
    bodies = stage(chunks.select("fp", "body").join(seen, "fp", "left_semi").groupBy("fp", "body").agg(F.count("*").alias("n")), "bodies")
    clash = bodies.groupBy("fp").agg(F.count("*").alias("k")).where("k > 1").select("fp")
    # Several bodies under one fingerprint: a body's ordinal is the number of smaller bodies.
    other = bodies.join(clash, "fp", "left_semi").select("fp", "body")
    smaller = other.alias("x").join(other.alias("y"), (F.col("x.fp") == F.col("y.fp")) & (F.col("y.body") < F.col("x.body")))
    ordinals = smaller.groupBy(F.col("x.fp").alias("fp"), F.col("x.body").alias("body")).agg(F.count("*").cast("int").alias("nth"))
    ordinals = maybe_broadcast(stage(ordinals, "clashes"), broadcast_rows // 1000)
    exceptions = stage(chunks.join(ordinals, ["fp", "body"]).select("rid", "ord", "nth"), "ordinals")

    ids = chunks.drop("body").join(exceptions, ["rid", "ord"], "left").withColumn("nth", F.coalesce("nth", F.lit(0)))
    recipes = stage(
        ids.groupBy("rid", "doc_id", "n_chars", "sha")
        .agg(F.sort_array(F.collect_list(F.struct("ord", "fp", "nth"))).alias("r"))
        .withColumn("r", F.transform("r", lambda x: F.struct(x["fp"].alias("fp"), x["nth"].alias("nth")))),
        "recipes",
    )
    groups = stage(
        recipes.groupBy("r")
        .agg(F.count("*").alias("group_size"), F.min(F.struct((-F.col("n_chars")).alias("c"), "doc_id", "rid")).alias("best"))
        .where("group_size > 1")
        .select("r", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid")),
        "groups",
    )
    return recipes.join(groups, "r", "left").select(
        "rid",
        "doc_id",
        "n_chars",
        F.col("sha").alias("text_sha256"),
        F.when(F.col("keep_rid").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.coalesce("keep_rid", "rid") == F.col("rid")).alias("kept"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept. Only ids of dropped rows are joined."""
    with recorded() as made:
        result = exact_dedup(docs, id_col, text_col).select("doc_id", "n_chars", "text_sha256", "kept")
    result = stage(result, "kept")
    drop(*made)
    repeated = stage(result.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_rep")), "repeated")
    dropped = result.where("not kept").select(F.col("doc_id").alias("_drop"))
    own = docs[id_col]
    plain = docs.join(dropped, own.eqNullSafe(F.col("_drop")), "left_anti")
    if repeated.isEmpty():
        return plain
    # An id on several rows doesn't say which of them stays: those rows are told apart by text and length.
    plain = plain.join(repeated, own.eqNullSafe(F.col("_rep")), "left_anti")
    best = result.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_s"), F.col("n_chars").alias("_c")).distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.join(repeated, own.eqNullSafe(F.col("_rep")), "left_semi")
    rows = rows.withColumn("_sha", F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]", ""), 256)).withColumn("_len", F.length(text).cast("long"))
    rows = rows.join(best, rows[id_col].eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_s")) & (F.col("_len") == F.col("_c")), "left_semi")
    first = F.row_number().over(W.partitionBy(id_col, "_sha", "_len").orderBy(F.lit(0)))
    return plain.unionByName(rows.withColumn("_nth", first).where("_nth = 1").drop("_sha", "_len", "_nth"))
