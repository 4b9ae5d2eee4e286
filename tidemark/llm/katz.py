"""Katz backoff language model: Good-Turing discounted bigrams over unigrams, exactly normalised.

Tokens are lower-cased words and one end per text; an unknown word is one more entry of the vocabulary. A seen pair has its
discounted relative frequency. For a pair that was never seen the model recurses to the unigram, times the backoff
weight of the history: what the discounts left, over what the unigrams of the words not seen after it add up to. A closed
history, all of whose followers are too frequent to be discounted, gives up ``reserve`` of a count instead, in equal
proportion from all its pairs. Sums over all words, the unknown one included, are 1 for every history.

Documents are read in blocks of about ``block`` tokens. A block sends each distinct word, and later each distinct pair,
once, with its number; words are dealt by hash, pairs by history. A frequent history is dealt in as many parts as its
count asks for, so no task holds all that follows a common word. The tasks add up, store the counts (tables ``words`` and
``pairs``, by part) and answer each block with the totals of its own entries, in its own order. Blocks then score their
texts. What moves is counts, never texts, and nothing but counts of counts and the sums of the split histories (at most
about a million) is seen by the driver.

Defined results: null and empty texts are one end token; repeated rows are scored, and learned from, each; a null doc_id is
neither held out nor learned from; an empty table gives an empty result; without training tokens every token has the
probability of the unknown word, 1; columns other than the id and text columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

_END = b" "  # no word holds a space
K = 5  # counts above this are not discounted
ROWS = "kind string, block long, part int, a binary, b binary, c binary, d binary, stats array<long>"
_NAMES = [c.split()[0] for c in ROWS.split(", ")]
_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29))


def _pack(values: np.ndarray) -> bytes:
    """A compressed array, in the smallest unsigned kind that holds it (floats stay)."""
    if values.dtype != np.float64:
        top = int(values.max()) if len(values) else 0
        values = values.astype(next(t for t in ("u1", "u2", "u4", "u8") if top < 256 ** int(t[1])))
    return values.dtype.str[1:].encode() + zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    values = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[2:]), data[:2].decode())
    return values if values.dtype == np.float64 else values.astype(np.int64)


def _rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * _MIX[0]
    x = (x ^ (x >> _MIX[2])) * _MIX[1]
    return x ^ (x >> _MIX[2])


def _read_blocks(parts: int, block: int):
    """Blocks of texts as numbers of their own words, and the words of each part with their training counts."""

    class Numbers(dict):
        def __missing__(self, word):
            self[word] = n = len(self)
            return n

    def close(number: int, ids: list, flags: list, held: list):
        numbers, lengths, chunks = Numbers(), [], []
        for words in held:
            lengths.append(len(words) + 1)
            words.append(_END)
            chunks.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        tokens = np.concatenate(chunks)
        vocabulary = list(numbers)
        part = np.fromiter((xxhash.xxh3_64_intdigest(w) % parts for w in vocabulary), np.int64, len(vocabulary))
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        train = np.repeat(np.array(flags, bool), lengths)
        counts = np.bincount(tokens[train], minlength=len(vocabulary))[order]
        # Signed ids and flags travel as they are; the tokens refer to words in the order of parts.
        out = [("block", number, 0, _pack(place[tokens]), _pack(np.array(lengths)), np.array(ids, "<i8").tobytes(), np.array(flags, "u1").tobytes(), None)]
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        for p in np.unique(part).tolist():
            low, high = edges[p], edges[p + 1]
            text = b"\n".join(vocabulary[i] for i in order[low:high].tolist())
            out.append(("word", number, p, zstandard.ZstdCompressor(level=1).compress(text), _pack(counts[low:high]), None, None, None))
        return _rows(out).to_batches()

    def run(batches):
        from pyspark import TaskContext

        number, ids, flags, held, size = TaskContext.get().partitionId() << 32, [], [], [], 0
        for batch in batches:
            for doc_id, text, flag in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = (text or b"").lower().split()
                ids.append(-(1 << 63) if doc_id is None else doc_id)
                flags.append(bool(flag))
                held.append(words)
                size += len(words) + 1
                if size >= block:
                    yield from close(number, ids, flags, held)
                    number, ids, flags, held, size = number + 1, [], [], [], 0
        if held:
            yield from close(number, ids, flags, held)

    return run


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return [int(counts.sum()), int((counts > 0).sum()), *(int((counts == r).sum()) for r in range(1, K + 2))]


def _add_words(parts: int):
    """One part: totals of its words; ids by falling count; the answer to each block."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        lists, totals = [], {}
        for r in rows:
            words, counts = zstandard.ZstdDecompressor().decompress(r["a"]).split(b"\n"), _unpack(r["b"]).tolist()
            lists.append(words)
            for w, c in zip(words, counts):
                totals[w] = totals.get(w, 0) + c
        part = rows[0]["part"]
        ranked = sorted(totals, key=lambda w: (-totals[w], w))
        ids = {w: i * parts + part + 1 for i, w in enumerate(ranked)}  # 0 is the start of a text
        counts = np.array([totals[w] for w in ranked], np.int64)
        out = [("words", -1, part, zstandard.ZstdCompressor().compress(b"\n".join(ranked)), _pack(counts), None, None, _count_of_counts(counts))]
        for r, words in zip(rows, lists):
            out.append(("ids", r["block"], part, _pack(np.array([ids[w] for w in words], np.int64)), _pack(np.array([totals[w] for w in words], np.int64)), None, None, None))
        return _rows(out)

    return run


class Block:
    """A block with the ids and counts of its words: its distinct pairs in order, and where its tokens use them."""

    def __init__(self, rows: list[dict], parts: int, split: int):
        own = next(r for r in rows if r["kind"] == "block")
        answers = sorted((r for r in rows if r["kind"] == "ids"), key=lambda r: r["part"])
        ids, counts = (np.concatenate([_unpack(r[c]) for r in answers]) for c in "ab")
        self.number, tokens, self.lengths = own["block"], _unpack(own["a"]), _unpack(own["b"])
        self.doc_ids, self.flags = np.frombuffer(own["c"], "<i8"), np.frombuffer(own["d"], "u1").astype(bool)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        word, self.count = ids[tokens], counts[tokens]
        before, before_count = np.concatenate([[0], word[:-1]]), np.concatenate([[0], self.count[:-1]])
        before[self.starts], before_count[self.starts] = 0, 0
        if len(word) and int(word.max()) >= 1 << 32:
            raise OverflowError("more than 2**32 words")
        # By part, then history, then word. The start of a text is split like the most frequent histories.
        salts = np.where(before == 0, parts, 1 + before_count // split).astype(np.uint64)
        part = (_mix(before.astype(np.uint64) * np.uint64(parts) + _mix(word) % salts) % np.uint64(parts)).astype(np.int64)
        key = (before.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)
        order = np.lexsort((key, part))
        new = np.ones(len(order), bool)
        new[1:] = key[order][1:] != key[order][:-1]
        at = np.cumsum(new) - 1
        self.use = np.empty(len(order), np.int64)
        self.use[order] = at
        first = order[new]
        self.part, self.history, self.word = part[first], before[first], word[first]
        self.word_count, self.history_count, self.whole = self.count[first], before_count[first], salts[first] == 1
        train = np.repeat(self.flags, self.lengths)
        self.trained = np.bincount(self.use[train], minlength=len(first))

    def slices(self):
        edges = np.flatnonzero(np.concatenate([[True], self.part[1:] != self.part[:-1], [True]]))
        return [(int(self.part[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])]


def _send_pairs(parts: int, split: int):
    def run(table: pa.Table) -> pa.Table:
        block = Block(table.to_pylist(), parts, split)
        out = []
        for p, a, b in block.slices():
            step = np.diff(block.history[a:b], prepend=0)
            whole = np.packbits(block.whole[a:b])
            out.append(("pair", block.number, p, _pack(step), _pack(block.word[a:b]), _pack(block.trained[a:b]), _pack(block.word_count[a:b]) + b"|" + whole.tobytes(), [len(whole)]))
        return _rows(out)

    return run


def _sums(history: np.ndarray, count: np.ndarray, p1: np.ndarray):
    """By history: how many words follow once, ... K times; the count of the others; the unigram mass of all that follow."""
    edges = np.flatnonzero(np.concatenate([[True], history[1:] != history[:-1]])) if len(history) else np.empty(0, np.int64)
    each = [np.where(count == r, 1, 0) for r in range(1, K + 1)] + [np.where(count > K, count, 0)]
    return history[edges], [np.add.reduceat(x, edges) if len(edges) else x for x in each], np.add.reduceat(np.where(count > 0, p1, 0.0), edges) if len(edges) else p1


def _closed(sums: list[np.ndarray]) -> np.ndarray:
    """Histories that are followed by something, but by no word whose count is discounted."""
    return (sum(sums[:K]) == 0) & (sums[K] > 0)


def _add_pairs(unigram: tuple, reserve: float):
    """One part: totals of its pairs, the sums of its histories, and the answer to each block."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        part, sizes = rows[0]["part"], []
        history, word, count, word_count, whole = [], [], [], [], []
        for r in rows:
            words, bits = r["d"][: len(r["d"]) - r["stats"][0] - 1], r["d"][len(r["d"]) - r["stats"][0] :]
            history.append(np.cumsum(_unpack(r["a"])))
            word.append(_unpack(r["b"]))
            count.append(_unpack(r["c"]))
            word_count.append(_unpack(words))
            sizes.append(len(word[-1]))
            whole.append(np.unpackbits(np.frombuffer(bits, "u1"), count=sizes[-1]).astype(bool))
        history, word, count, word_count, whole = map(np.concatenate, (history, word, count, word_count, whole))
        order = np.lexsort((word, history))
        new = np.ones(len(order), bool)
        new[1:] = (history[order][1:] != history[order][:-1]) | (word[order][1:] != word[order][:-1])
        first, at = order[new], np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        total = np.bincount(at, weights=count, minlength=len(first)).astype(np.int64)
        h, one = history[first], whole[first]
        names, sums, mass = _sums(h, total, unigram_probability(word_count[first], unigram))
        where = np.searchsorted(names, h)
        split = ~one[np.searchsorted(h, names)]
        closed = _closed(sums)
        out = [("pairs", -1, part, _pack(np.diff(h[total > 0], prepend=0)), _pack(word[first][total > 0]), _pack(total[total > 0]), None, _count_of_counts(total))]
        if split.any():
            out.append(("split", -1, part, _pack(names[split]), _pack(np.concatenate([s[split] for s in sums])), _pack(mass[split]), None, None))
        low = 0
        for r, n in zip(rows, sizes):
            mine = at[low : low + n]
            low += n
            # Histories of pairs that were never seen: their sums go along, in the order of the pairs.
            unseen = mine[(total[mine] == 0) & one[mine]]
            of = where[unseen]
            # Only an undiscounted pair can have a closed history.
            bits = _pack(np.packbits(closed[where[mine[(total[mine] > K) & one[mine]]]])) if reserve else None
            out.append(("totals", r["block"], part, _pack(total[mine]), _pack(np.concatenate([s[of] for s in sums])), _pack(mass[of]), bits, None))
        return _rows(out)

    return run


def discounts(counts: list[int]) -> np.ndarray:
    """Katz's factors for counts 1 to K from [total, types, n1, ...]; a count whose estimate isn't a discount keeps
    half a unit less instead."""
    n = counts[2:]
    out = []
    common = (K + 1) * n[K] / n[0] if n[0] else 1.0
    for r in range(1, K + 1):
        d = 0.0
        if n[r - 1] and n[r] and common < 1:
            d = ((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common)
        out.append(d if 0 < d < 1 else 1 - 0.5 / r)
    return np.array(out)


def unigram_model(counts: list[int]) -> tuple:
    """(tokens that known words and the unknown one share, discounts of known words, mass of the unknown one)."""
    if not counts[0]:
        return 1, np.ones(K), 1.0
    d = discounts(counts)
    left = sum((1 - d[r - 1]) * r * counts[1 + r] for r in range(1, K + 1))
    total = counts[0] if left > 0 else counts[0] + 1
    return total, d, (left if left > 0 else 1.0) / total


def _discounted(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    return count * np.where(count > K, 1.0, np.concatenate([[1.0], d])[np.clip(count, 0, K)])


def unigram_probability(count: np.ndarray, model: tuple) -> np.ndarray:
    total, d, unknown = model
    return np.where(count > 0, _discounted(count, d) / total, unknown)


def backoff(sums: list[np.ndarray], mass: np.ndarray, d: np.ndarray, reserve: float = 0.0) -> np.ndarray:
    """Backoff weights; 1 for a history that nothing followed."""
    total = sum(r * s for r, s in enumerate(sums[:K], 1)) + sums[K]
    left = sum((1 - d[r - 1]) * r * s for r, s in enumerate(sums[:K], 1))
    left = np.where(_closed(sums), reserve, left) / np.maximum(total, 1)
    return np.where(total > 0, left / np.maximum(1 - mass, 1e-300), 1.0)


def _score(parts: int, split: int, unigram: tuple, bigram_d: np.ndarray, counts: list[int], reserve: float, shared):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        block = Block(rows, parts, split)
        answers = sorted((r for r in rows if r["kind"] == "totals"), key=lambda r: r["part"])
        total = np.concatenate([_unpack(r["a"]) for r in answers])
        weight = np.ones(len(total))
        unseen = (total == 0) & block.whole
        sums = [_unpack(r["b"]).reshape(K + 1, -1) for r in answers]
        mass = np.concatenate([_unpack(r["c"]) for r in answers])
        weight[unseen] = backoff(list(np.concatenate(sums, axis=1)), mass, bigram_d, reserve)
        names, weights, split_closed = shared.value
        often = (total == 0) & ~block.whole
        if often.any() and len(names):
            at = np.minimum(np.searchsorted(names, block.history[often]), len(names) - 1)
            weight[often] = np.where(names[at] == block.history[often], weights[at], 1.0)
        p1 = unigram_probability(block.word_count, unigram)
        # The start's own count is the number of training texts.
        history_count = np.where(block.history == 0, max(counts[-1], 1), block.history_count)
        kept = np.ones(len(total))
        if reserve:
            closed, edges = total > K, np.cumsum([0, *(len(_unpack(r["a"])) for r in answers)])
            for r, a, b in zip(answers, edges[:-1], edges[1:]):
                mine = a + np.flatnonzero(closed[a:b] & block.whole[a:b])
                closed[mine] = np.unpackbits(_unpack(r["d"]).astype("u1"), count=len(mine)).astype(bool)
            mine = np.flatnonzero(closed & ~block.whole)
            at = np.searchsorted(names, block.history[mine])  # a split history that is followed by something has a name
            closed[mine] = split_closed[at]
            kept[closed] -= reserve / history_count[closed]
        p = np.where(total > 0, kept * _discounted(total, bigram_d) / np.maximum(history_count, 1), weight * p1)
        per_token = np.log10(p)[block.use]
        base = np.log10((block.count + 0.1) / (counts[0] + 0.1 * (counts[1] + 1)))
        missing = block.doc_ids == -(1 << 63)
        return pa.Table.from_arrays(
            [
                pa.array(block.doc_ids, pa.int64(), mask=missing),
                pa.array(block.lengths, pa.int64()),
                pa.array(np.add.reduceat((block.count > 0).astype(np.int64), block.starts)),
                pa.array(np.add.reduceat(base, block.starts)),
                pa.array(np.add.reduceat(per_token, block.starts)),
            ],
            names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
        )

    return run


def katz_scores(docs: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text", block: int = 1_500_000, part_bytes: int = 6_000_000, split: int = 200_000, reserve: float = 0.0) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    ``learns`` says from which rows to learn. ``part_bytes``: text for each part of the tables; ``split``: tokens after
    which a history is dealt in one more part (more where there would be over a million such parts). ``reserve``: share of
    a count that a closed history keeps for words that never followed it; at 0, Katz's own definition, these get the score
    -inf.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(8, size // part_bytes + 1)
    split = max(split, size // 5_000_000)
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"), F.coalesce(learns, F.lit(False)).alias("learns"))
    read = stage(rows.mapInArrow(_read_blocks(parts, block), ROWS), "katz_blocks", "kind", "snappy").select(_NAMES)

    words = read.where("kind = 'word'").groupBy("part").applyInArrow(_add_words(parts), ROWS)
    words = stage(words, "katz_words", "kind", "snappy").select(_NAMES)

    def constants(table: DataFrame, kind: str) -> list[int]:
        sums = [F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)).alias(f"s{i}") for i in range(K + 3)]
        return list(table.where(F.col("kind") == kind).agg(*sums).first())

    counts = constants(words, "words")
    unigram = unigram_model(counts)
    blocks = read.where("kind = 'block'").union(words.where("kind = 'ids'"))
    sent = blocks.groupBy("block").applyInArrow(_send_pairs(parts, split), ROWS)
    pairs = stage(sent.groupBy("part").applyInArrow(_add_pairs(unigram, reserve), ROWS), "katz_pairs", "kind", "snappy").select(_NAMES)
    bigram_d = discounts(constants(pairs, "pairs"))

    # The split histories: their parts' sums, added up.
    names, sums, mass = [], [], []
    for r in pairs.where("kind = 'split'").select("a", "b", "c").toLocalIterator():
        names.append(_unpack(r["a"]))
        sums.append(_unpack(r["b"]).reshape(K + 1, -1))
        mass.append(_unpack(r["c"]))
    found, starts = (np.empty(0, np.int64), np.empty(0), np.empty(0, bool)), 0
    if names:
        held, at = np.unique(np.concatenate(names), return_inverse=True)
        added = [np.bincount(at, weights=x).astype(np.int64) for x in np.concatenate(sums, axis=1)]
        found = held, backoff(added, np.bincount(at, weights=np.concatenate(mass)), bigram_d, reserve), _closed(added)
        if held[0] == 0:
            starts = int(sum(r * s[0] for r, s in enumerate(added[:K], 1)) + added[K][0])
    shared = spark.sparkContext.broadcast(found)
    answered = blocks.union(pairs.where("kind = 'totals'"))
    scored = answered.groupBy("block").applyInArrow(
        _score(parts, split, unigram, bigram_d, [counts[0], counts[1], starts], reserve, shared), "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(counts[0]).cast("long"))
