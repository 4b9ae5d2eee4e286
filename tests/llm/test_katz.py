"""The Katz model against a plain model of the same definition, and its normalisation."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import katz, queries


def plain(docs, learns):
    """Scores by dictionaries over all texts at once."""
    split = lambda t: (t or "").encode().lower().split() + [b" "]
    uni, pairs, follow, starts = Counter(), Counter(), defaultdict(set), 0
    for _, text in (d for d in docs if learns(d[0])):
        words = split(text)
        uni.update(words)
        starts += 1
        for a, b in zip([b"\n", *words], words):
            pairs[a, b] += 1
            follow[a].add(b)
    counts = lambda c: [sum(c.values()), len(c), *(sum(v == r for v in c.values()) for r in range(1, katz.K + 2))]
    n, model, d2 = sum(uni.values()), katz.unigram_model(counts(uni)), katz.discounts(counts(pairs))
    cut = lambda c, d: c * (1.0 if c > katz.K else d[c - 1])
    p1 = lambda w: cut(uni[w], model[1]) / model[0] if uni[w] else model[2]
    history = lambda h: starts if h == b"\n" else uni[h]

    def p2(h, w):
        if pairs[h, w]:
            return cut(pairs[h, w], d2) / history(h)
        if not history(h):
            return p1(w)
        seen = [cut(pairs[h, x], d2) / history(h) for x in follow[h]]
        return (1 - math.fsum(seen)) / (1 - math.fsum(p1(x) for x in follow[h])) * p1(w)

    out = {}
    for doc_id, text in docs:
        words = split(text)
        score = sum(math.log10(p2(a, b)) for a, b in zip([b"\n", *words], words))
        base = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (len(uni) + 1))) for w in words)
        out[doc_id] = (len(words), sum(uni[w] > 0 for w in words), base, score)
    return out, n, p2, uni


def learns(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 10 != 0


@pytest.mark.parametrize("split, block", [(200_000, 1_500_000), (50, 2_000)])
def test_scores(spark, split, block):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rule = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) != 0
    found = katz.katz_scores(docs, rule, split=split, block=block, part_bytes=50_000).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, n, p2, uni = plain(rows, learns)
    assert len(found) == len(rows) and {r["train_tokens"] for r in found} == {n}
    for r in found:
        tokens, known, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"]) == (tokens, known)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-9)
    held = [r for r in found if not learns(r["doc_id"])]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    for h in (b"\n", b"the", uni.most_common()[-1][0]):
        assert math.fsum(p2(h, w) for w in [*uni, b"never seen"]) == pytest.approx(1, abs=1e-9)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "a b a", None), (3, "A b \x0b a " * 50, "z"), (3, "A b \x0b a " * 50, "z"), (4, "new", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string")
    found = katz.katz_scores(docs, F.col("doc_id") < 4).collect()
    assert len(found) == 6 and all(np.isfinite(r["score"]) for r in found)
    assert sorted((r["n_tokens"], r["n_known"]) for r in found) == [(1, 1), (1, 1), (2, 1), (4, 4), (151, 151), (151, 151)]
    assert katz.katz_scores(docs.where("false"), F.lit(True)).count() == 0
    assert {r["score"] for r in katz.katz_scores(docs, F.lit(False)).collect()} == {0.0}


@pytest.mark.parametrize("split", [200_000, 3])
def test_closed_histories(spark, split):
    """Ten copies, and a held-out copy with one word replaced: followers seen more than K times leave mass to the others."""
    words = [f"w{i}" for i in range(30)]
    edited = [*words[:10], "w25", *words[11:20], "never", *words[21:]]
    rows = [(i, " ".join(words)) for i in range(10)] + [(20, " ".join(edited)), (21, "other words")]
    docs = spark.createDataFrame([*rows, (30, "some rare words")], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in katz.katz_scores(docs, ~F.col("doc_id").isin(20, 21), split=split, part_bytes=50, reserve=0.5).collect()}
    assert all(np.isfinite(s) for s in found.values())

    train = [[*w, " "] for w in [words] * 10 + ["some rare words".split()]]
    uni, pairs = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["^", *t], t))
    of = {**uni, "^": len(train)}
    counts = lambda c: [sum(c.values()), len(c), *(sum(v == r for v in c.values()) for r in range(1, katz.K + 2))]
    total, d1, unknown = katz.unigram_model(counts(uni))
    d2 = katz.discounts(counts(pairs))
    p1 = lambda w: uni[w] * (1.0 if uni[w] > katz.K else d1[uni[w] - 1]) / total if uni[w] else unknown

    def seen(h, w):
        closed = all(c > katz.K for (a, _), c in pairs.items() if a == h)
        c = pairs[h, w]
        return (c * (1 - 0.5 / of[h]) if closed else c * (1.0 if c > katz.K else d2[c - 1])) / of[h]

    def p2(h, w):
        if pairs[h, w] or not of.get(h):
            return seen(h, w) if of.get(h) else p1(w)
        after = [b for a, b in pairs if a == h]
        return (1 - math.fsum(seen(h, b) for b in after)) / (1 - math.fsum(map(p1, after))) * p1(w)

    for h in ("^", "w3", "some", "words"):
        assert math.fsum(p2(h, w) for w in [*uni, "never"]) == pytest.approx(1, abs=1e-9)
    for i, text in [*rows, (30, "some rare words")]:
        t = [*text.split(), " "]
        assert found[i] == pytest.approx(sum(math.log10(p2(a, b)) for a, b in zip(["^", *t], t)), rel=1e-9)


def test_query_is_finite(spark, tmp_path):
    held = next(i for i in range(100, 200) if not learns(i))
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, text) for i in range(40) if learns(i)] + [(held, text.replace("w10 ", "w25 "))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert all(np.isfinite(r["score"]) for r in queries.op1_katz_backoff(spark, str(tmp_path)).collect())
