"""Mixture-controlled packing: deficit round-robin over source queues, in closed form.

Each source is a queue of tokens. A round of the round-robin is one window: every queue is granted its target share of
the window's tokens, serves whole tokens and carries the fraction (its deficit) on, so after k windows a queue has
served floor(k * share * window) tokens whatever task asks. A drained queue's share goes to the others in proportion. All
windows together are one stream, cut into sequences of ``length`` tokens: only the very last is padded. A task needs
nothing but the totals of the queues and the place where its own rows start in their queue, so deficits carry across
windows and partitions without any task seeing the whole stream.

Defined results: a null text is an empty document, one closing id; a null source is the queue of the empty name; repeated
rows are packed each; without rows there are no pieces; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .byte_bpe import vocabulary_path
from .common import stage

VOCABULARY = "byte_bpe_50k.json"
STAGED = "part int, doc_id long, source string, q_start long, n_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long"
#: A place before which a text can't be cut without looking at more of it: a space before white space or the end.
_UNSAFE = re.compile(r" (?!\S)")


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class _Known(dict):
    """Piece without its space -> packed ids with it."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, piece: str) -> bytes:
        self[piece] = ids = self.learn(" " + piece)
        return ids


class PieceEncoder:
    """Ids of a byte-level vocabulary of the tokenizers library, with a memory for the pieces between spaces.

    The byte-level pattern always starts a pre-token at a space that a visible character follows, so the pieces of a
    text cut before such spaces are encoded apart. Texts with any other space are encoded whole. Where the vocabulary's
    ids follow its merges, as they do when it is trained, its merges are ids by rank, and new pieces go to the faster
    tiktoken with these ranks; any other vocabulary stays with its own library.
    """

    def __init__(self, vocabulary: str, most: int = 600_000):
        from tokenizers import Tokenizer

        path = vocabulary_path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4"
        self.ranked = self._ranked(path)
        self.known = _Known(self._learn)
        self.most = most

    @staticmethod
    def _ranked(path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            written = json.load(file)
        model, letters = written["model"], _byte_letters()
        pre = written.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or written.get("normalizer"):
            return None
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        places = [model["vocab"].get(m, -1) for m in merged]
        if model.get("ignore_merges") or any(a >= b for a, b in zip(places, places[1:])) or not set(letters) <= set(model["vocab"]):
            return None
        table = {bytes(letters[c] for c in t): model["vocab"][t] for t in [*letters, *merged]}
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def _learn(self, text: str) -> bytes:
        if self.ranked:
            return array(self.code, self.ranked.encode_ordinary(text)).tobytes()
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    @property
    def code(self) -> str:
        return "H" if self.kind == "<u2" else "I"

    def batch(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.most:
            self.known.clear()
        out, get = [], self.known.__getitem__
        for text in texts:
            if _UNSAFE.search(text):
                out.append(self._learn(text))
            else:
                first, *pieces = text.split(" ")
                out.append(self._learn(first) + b"".join(map(get, pieces)))
        return out


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> PieceEncoder:
    return PieceEncoder(vocabulary)


def _tokenise(vocabulary: str, close: int):
    def run(batches):
        from pyspark import TaskContext

        part, served = TaskContext.get().partitionId(), {}
        enc = encoder(vocabulary)
        end = np.array([close], dtype=enc.kind).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                ids = [i + end for i in enc.batch([t or "" for t in rows.column(2).to_pylist()])]
                sources, counts, starts = rows.column(1).to_pylist(), [len(i) // len(end) for i in ids], []
                for s, n in zip(sources, counts):
                    starts.append(served.get(s, 0))
                    served[s] = starts[-1] + n
                arrays = [pa.array([part] * len(ids), pa.int32()), rows.column(0), rows.column(1), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in STAGED.split(", ")])

    return run


class Schedule:
    """What each queue has served after k windows, for given queue totals and target weights."""

    def __init__(self, totals: list[int], weights: list[float], window: int):
        self.totals, self.window = np.array(totals, dtype=np.int64), window
        self.windows = -(-int(self.totals.sum()) // window)
        left, w = self.totals.astype(float), np.array(weights, dtype=float)
        done, self.phases = np.zeros(len(left)), []  # phases: (tokens before, served before, share of each queue)
        if len(left) and np.allclose(w * left.sum(), left * w.sum(), rtol=1e-12):
            self.phases.append((0.0, done.copy(), left / max(left.sum(), 1)))
            left = left * 0
        while (left > 0).any():
            live = (left > 0) & (w > 0) if ((left > 0) & (w > 0)).any() else left > 0
            share = np.where(live, w if w[live].sum() > 0 else left, 0.0)
            share = share / share.sum()
            self.phases.append((float(done.sum()), done.copy(), share))
            step = (left[live] / share[live]).min()
            served = np.minimum(left, share * step)
            served[live & (left - served < 0.5)] = left[live & (left - served < 0.5)]
            done, left = done + served, left - served
        self._at = lru_cache(maxsize=4096)(self._served)

    def _served(self, k: int) -> np.ndarray:
        if k >= self.windows:
            return self.totals
        x = float(k) * self.window
        before, done, share = self.phases[bisect_right(self.phases, x, key=lambda p: p[0]) - 1]
        return np.minimum(self.totals, np.floor(done + share * (x - before)).astype(np.int64))

    def served(self, k: int) -> np.ndarray:
        return self._at(k)

    def pieces(self, queue: int, start: int, n: int):
        """(window, start in the document, length, place in the stream) of n tokens that stand at ``start`` in a queue."""
        low, high = 0, self.windows
        while high - low > 1:  # the window that serves the token at ``start``
            mid = (low + high) // 2
            low, high = (mid, high) if self.served(mid)[queue] <= start else (low, mid)
        k, at = low, 0
        while at < n:
            now, then = self.served(k), self.served(k + 1)
            take = min(n - at, int(then[queue]) - start - at)
            if take > 0:
                place = int(now.sum()) + int((then[:queue] - now[:queue]).sum()) + start + at - int(now[queue])
                yield k, at, take, place
                at += take
            k += 1


def _packer(totals: list[int], weights: list[float], window: int, length: int, kind: str):
    def run(batches):
        plan = Schedule(totals, weights, window)
        names = [c.split()[0] for c in PIECES.split(", ")]
        for batch in batches:
            out = [[] for _ in names]
            for doc_id, queue, start, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                whole = np.frombuffer(ids, kind).astype("<u4")
                raw, n = memoryview(whole.tobytes()), len(whole)
                for k, at, take, place in plan.pieces(queue, start, n):
                    while take:
                        step = min(take, length - place % length)
                        row = (doc_id, at, step, zlib.crc32(raw[4 * at : 4 * (at + step)]), n, place // length, place % length, k)
                        for column, value in zip(out, row):
                            column.append(value)
                        at, place, take = at + step, place + step, take - step
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    mixture: dict[str, float] | None = None,
    temper: float = 1.0,
    length: int = 1024,
    window_sequences: int = 256,
    vocabulary: str = VOCABULARY,
    close: int = 0,
    max_queues: int = 4096,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window.

    ``mixture``: target weight of each source; sources that it doesn't name are served after the named ones. Without it a
    source's weight is its number of tokens to the power of ``temper``: below 1 small sources are served earlier than
    their share, and large ones go on alone when those are drained. Up to ``max_queues`` sources have a queue each; beyond,
    named sources and the largest keep theirs, and the others share queues by their hash, with the sum of their weights.
    Totals of queues go to the driver; starts by task and source are broadcast up to ``broadcast_rows`` rows and joined by
    a shuffle beyond.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(text_col).alias("text"))
    tokens = stage(rows.mapInArrow(_tokenise(vocabulary, close), STAGED), "tokens")
    spans = stage(tokens.groupBy("part", "source").agg(F.sum("n_tokens").alias("n")), "spans")
    sources = _weighed(spans.groupBy("source").agg(F.sum("n").alias("n")), mixture, temper, max_queues)
    spans = spans.join(sources.select("source", "own", "queue"), "source")
    queues = sources.groupBy("own", "queue").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).orderBy("own", "queue").collect()
    numbered = spark.createDataFrame([(r["own"], r["queue"], i) for i, r in enumerate(queues)], "own boolean, queue string, q int")

    before = W.partitionBy("own", "queue").orderBy("part", "source").rowsBetween(W.unboundedPreceding, -1)
    starts = spans.select("part", "source", "own", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    starts = stage(starts.join(F.broadcast(numbered), ["own", "queue"]).select("part", "source", "base", "q"), "starts")
    if starts.count() <= broadcast_rows:
        starts = F.broadcast(starts)
    placed = tokens.join(starts, ["part", "source"]).select("doc_id", "q", (F.col("base") + F.col("q_start")).alias("start"), "ids")
    totals, weights = [r["n"] for r in queues], [float(r["weight"]) for r in queues]
    return placed.mapInArrow(_packer(totals, weights, window_sequences * length, length, encoder(vocabulary).kind), PIECES)


def _weighed(sources: DataFrame, mixture: dict[str, float] | None, temper: float, max_queues: int) -> DataFrame:
    """(source, n, weight, own, queue) of each source; ``queue`` is its name if it has its ``own``, else a bucket."""
    if mixture is None:
        sources = sources.withColumns({"weight": F.pow(F.col("n").cast("double"), F.lit(temper)), "named": F.lit(False)})
    else:
        targets = sources.sparkSession.createDataFrame([(k, float(v)) for k, v in mixture.items()], "source string, weight double")
        sources = sources.join(F.broadcast(targets), "source", "left").withColumn("named", F.col("weight").isNotNull()).fillna(0.0, ["weight"])
    sources = stage(sources, "sources")
    if sources.count() <= max_queues:
        return sources.withColumns({"own": F.lit(True), "queue": F.col("source")}).drop("named")
    shared = max(1, max_queues // 2)
    largest = sources.where("not named").orderBy(F.desc("n"), "source").limit(max_queues - shared).select("source", F.lit(True).alias("large"))
    own = F.col("named") | F.coalesce("large", F.lit(False))
    bucket = F.pmod(F.xxhash64("source"), F.lit(shared)).cast("string")
    sources = sources.join(F.broadcast(largest), "source", "left").withColumn("own", own)
    return stage(sources.withColumn("queue", F.when(F.col("own"), F.col("source")).otherwise(bucket)).drop("named", "large"), "queues")
