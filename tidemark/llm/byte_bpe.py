"""Byte-level BPE encoding and decoding over overlapping chunks.

Texts of up to ``chunk_chars`` code points are encoded where they lie. Longer ones are cut into chunks that overlap,
dealt over all tasks and pre-tokenised in parallel. Two neighbours resynchronise at the first place in their overlap
where both put a pre-token boundary between a visible character and a space or line feed: no pre-token of the pattern
spans such a place and what follows it doesn't depend on what came before. The pieces between these places are encoded
in parallel and their ids joined in order. Where an overlap holds no such place, the neighbours stay in one piece.
Decoding joins the raw bytes of the ids; single ids needn't be valid UTF-8.

Defined results: null and empty texts have no ids; repeated rows are encoded each; an empty table gives an empty
result; columns other than the id and text columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import stage

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Code points after a match that can decide where it ends.
_LOOKAHEAD = 3


def vocabulary_path(name: str) -> str:
    """A path as it is, or the place of a public vocabulary file of that name."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoding(ranks: str):
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(ranks), pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=1)
def _pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def id_bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def _encoder(ranks: str, n_keys: int, decoded: bool, rows: int = 500):
    """Appends the ids of the text in the last column, and what they decode to; the text goes, the first ``n_keys``
    columns stay."""

    def run(batches):
        enc = encoding(ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids, raw = [], []
                for text in part.column(n_keys).to_pylist():
                    own = enc.encode_ordinary(text) if text else []
                    ids.append(id_bytes(own))
                    if decoded:
                        raw.append(enc.decode_bytes(own))
                columns, names = [pa.array(ids, pa.binary())], ["ids"]
                if decoded:
                    columns, names = [*columns, pa.array(raw, pa.binary())], [*names, "decoded"]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_keys], *columns], names=[*batch.schema.names[:n_keys], *names])

    return run


def _cutter(chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            for rid, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                starts = range(0, len(text), chunk)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([rid] * len(starts), pa.int64()),
                        pa.array([doc_id] * len(starts), pa.int64()),
                        pa.array(range(len(starts)), pa.int32()),
                        pa.array([text[s : s + chunk + overlap] for s in starts], pa.string()),
                    ],
                    names=["rid", "doc_id", "idx", "chunk"],
                )

    return run


def boundaries(text: str, low: int, high: int) -> list[int]:
    """Places in [low, high) where a pre-token of ``text`` ends in a visible character and a space or line feed follows."""
    ends = (m.end() for m in _pattern().finditer(text))
    return [e for e in ends if low <= e < min(high, len(text) - _LOOKAHEAD) and text[e] in " \n" and not text[e - 1].isspace()]


def _boundary_finder(chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(3).to_pylist()
            heads = [boundaries(t, 0, overlap) for t in texts]
            tails = [[e - chunk for e in boundaries(t, chunk, chunk + overlap)] for t in texts]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, kind), pa.array(tails, kind)], names=[*batch.schema.names, "heads", "tails"])

    return run


def _long(docs: DataFrame, ranks: str, chunk: int, overlap: int, decoded: bool) -> DataFrame:
    cut = docs.mapInArrow(_cutter(chunk, overlap), "rid long, doc_id long, idx int, chunk string").repartition("rid", "idx")
    cut = stage(cut.mapInArrow(_boundary_finder(chunk, overlap), "rid long, doc_id long, idx int, chunk string, heads array<int>, tails array<int>"), "bpe_chunks")

    order = W.partitionBy("rid").orderBy("idx")
    sync = cut.drop("chunk").withColumn("sync", F.array_min(F.array_intersect("tails", F.lead("heads").over(order))))
    sync = sync.withColumn("prev", F.lag("sync").over(order)).withColumn("last", F.lead("idx").over(order).isNull())
    piece = F.count("prev").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    sync = sync.select("rid", "idx", "last", F.coalesce("prev", F.lit(0)).alias("low"), F.coalesce("sync", F.lit(0)).alias("over"), piece.alias("piece"))

    # A chunk gives its own code points from the place where it took over to the place where the next one does.
    part = F.when(F.col("last"), F.expr("substring(chunk, low + 1)")).otherwise(F.expr(f"substring(chunk, low + 1, {chunk} + over - low)"))
    parts = cut.select("rid", "doc_id", "idx", "chunk").join(sync, ["rid", "idx"]).select("rid", "doc_id", "piece", "idx", part.alias("part"))
    pieces = parts.groupBy("rid", "doc_id", "piece").agg(F.sort_array(F.collect_list(F.struct("idx", "part"))).alias("p"))
    pieces = pieces.select("rid", "doc_id", "piece", F.array_join(F.col("p.part"), "").alias("text"))
    names = ["ids", "decoded"] if decoded else ["ids"]
    encoded = pieces.mapInArrow(_encoder(ranks, 3, decoded), "rid long, doc_id long, piece long, " + ", ".join(f"{n} binary" for n in names))
    joined = encoded.groupBy("rid", "doc_id").agg(F.sort_array(F.collect_list(F.struct("piece", *[F.hex(n).alias(n) for n in names]))).alias("p"))
    return joined.select("doc_id", *[F.unhex(F.array_join(F.col(f"p.{n}"), "")).alias(n) for n in names])


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, chunk_chars: int = 32768, overlap: int = 512, decoded: bool = False) -> DataFrame:
    """(doc_id, ids): the ids of each text as little-endian unsigned 32-bit integers; with ``decoded`` also the raw bytes
    that they decode to, piece by piece in the worker that has them."""
    if overlap > chunk_chars:
        raise ValueError("the overlap can't be longer than a chunk")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = F.coalesce(F.length("text"), F.lit(0))
    schema = "doc_id long, ids binary, decoded binary" if decoded else "doc_id long, ids binary"
    short = rows.where(size <= chunk_chars).mapInArrow(_encoder(ranks, 1, decoded), schema)
    long = rows.where(size > chunk_chars).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    return short.unionByName(_long(long, ranks, chunk_chars, overlap, decoded))


def decode(encoded: DataFrame, ids_col: str = "ids", ranks: str = RANKS) -> DataFrame:
    """``encoded`` and ``decoded``: the joined raw bytes of the ids, for ids that come from elsewhere."""

    def run(batches):
        enc = encoding(ranks)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            raw = [None if i is None else enc.decode_bytes(np.frombuffer(i, "<u4").tolist()) for i in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, "decoded"])

    schema = T.StructType([*encoded.schema, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(run, schema)
