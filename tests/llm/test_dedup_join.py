"""Exact dedup, the Jaccard join and sharding against brute force and on odd rows."""

import re
import zlib
from collections import Counter, defaultdict
from datetime import datetime

import pytest

from tidemark.llm.common import components
from tidemark.llm.exact_dedup import cut_points, exact_dedup, keep_first
from tidemark.llm.jaccard_join import jaccard_components, keep_one, shingles
from tidemark.llm.kd_sharding import _nodes, kd_shards

BLANK = re.compile(r"[\x20\x09-\x0D]")


def plain_dedup(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[BLANK.sub("", text or "")].append((-len(text or ""), doc_id is not None, doc_id or 0, doc_id))
    return {(d[3], len(g), min(g)[3]) for g in groups.values() for d in g}


@pytest.mark.parametrize("params", [{}, {"chunk_bits": 6, "fp_bits": 3}, {"broadcast_rows": 0}])
def test_exact_dedup(documents, odd, params):
    for df in (documents, odd):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        found = exact_dedup(df, **params).collect()
        assert len(found) == len(rows)
        assert {(r["doc_id"], r["group_size"], r["keep_id"]) for r in found} == plain_dedup(rows)
        assert sum(r["kept"] for r in found) == len({BLANK.sub("", t or "") for _, t in rows})


def test_keep_first(odd):
    kept = keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 4, 5, 6, 8, 9]
    assert keep_first(odd.where("false")).count() == 0


def test_cuts_depend_on_content():
    body = bytes(range(256)) * 80
    first, second = cut_points(body, 8), cut_points(b"prefix" * 40 + body, 8)
    assert first[-1] == len(body) and max(b - a for a, b in zip([0, *first], first)) <= 2048
    shifted = {e - 240 for e in second}
    assert len(shifted & set(first)) > len(first) / 2


def plain_components(rows, percent=80):
    sets = []
    for doc_id, text in rows:
        words = [w.translate({i: i + 32 for i in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else []))
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in where[g] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    low = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)].append(doc_id)
    return sorted(((d, len(s), min(low[find(i)], default=None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("params", [{}, {"leaf": 1, "pivots": 1, "sketch_bits": 14, "broadcast_rows": 0}, {"leaf": 2, "pivots": 2, "deeper": 2}])
def test_jaccard(documents, odd, params):
    for df in (documents, odd):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        found = jaccard_components(df, **params).collect()
        assert sorted(map(tuple, found), key=str) == plain_components(rows)


def test_jaccard_chains(spark):
    """Families of near copies whose members link in chains and stars, and a passage that strangers share."""
    rows, words = [], [f"v{i}" for i in range(400)]
    for family in range(4):
        own = [f"f{family}w{i}" for i in range(60)]
        for k in range(12):
            rows.append((100 * family + k, " ".join(own[:20] + own[20 + k : 60] + [f"x{family}y{i}" for i in range(k)])))
    rows += [(1000 + k, " ".join(words[:60] + [f"s{k}t{i}" for i in range(6 + k)])) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for params in ({}, {"leaf": 2, "pivots": 1, "deeper": 1}, {"leaf": 2, "pivots": 2, "scouts": 2}):
        assert sorted(map(tuple, jaccard_components(docs, **params).collect()), key=str) == plain_components(rows)


def test_keep_one(odd):
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 5, 8, 9, 10]
    assert keep_one(odd.where("false")).count() == 0


def test_keep_one_by_row(spark):
    """Near copies without ids leave one, and a text of its own stays though its id has a near copy."""
    words = [f"w{i}" for i in range(60)]
    near = [" ".join([*words[:-1], f"end{k}"]) for k in range(6)]
    own = ["one text of its own with words that no other has", "another text that shares the id of a near copy"]
    other = [" ".join([*words[::-1], f"last{k}"]) for k in range(3)]
    rows = [(1, near[0]), (2, near[1]), (2, own[0]), (None, near[2]), (None, own[1]), (1, near[3]), *((None, t) for t in other)]
    kept = [tuple(r) for r in keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert {(2, own[0]), (None, own[1])} <= set(kept) and len(kept) == 4
    assert sum(r in [(1, near[0]), (1, near[3])] for r in kept) == 1 and sum(t in other for _, t in kept) == 1


def test_shingles():
    assert len(shingles(b"")) == len(shingles(None)) == 0
    assert shingles(b"A b")[0] == shingles(b" a\tB ")[0] != shingles(b"ab")[0]
    assert len(shingles(b"a a a a a a a a")) == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), *range(100, 130), 500]], "id long")
    found = dict(map(tuple, components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 130)) and found[500] == 500


@pytest.mark.parametrize("params", [{"shards": 8}, {"shards": 5, "bins": 7}, {"target_bytes": 60_000}, {"shards": 1}])
def test_kd_shards(documents, texts, params):
    found = kd_shards(documents, **params).collect()
    assert len(found) == len(texts)
    by = defaultdict(list)
    for r in found:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        by[r["shard"]].append(r)
    n = params.get("shards") or -(-sum(r["size"] for r in found) // params["target_bytes"])
    assert sorted(by) == list(range(n))
    sizes = [sum(r["size"] for r in rows) for rows in by.values()]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in found)
    assert all(sorted(r["slot"] for r in rows) == list(range(len(rows))) for rows in by.values())


def test_kd_shards_groups(spark, odd):
    rows = [(i, f"text {i // 3} " + "word " * (i // 3 % 50), "en", f"s{i % 4}", i) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    of = defaultdict(set)
    found = kd_shards(docs, shards=8).collect()
    for r in found:
        of[r["doc_id"] // 3].add(r["shard"])
    assert all(len(s) == 1 for s in of.values())
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) < 1.03 * min(sizes.values())
    hot = spark.createDataFrame([(i, "same" if i % 3 == 0 else f"other {i}", "en", "s", 1) for i in range(3000)], docs.schema)
    assert max((c := Counter(r["shard"] for r in kd_shards(hot, shards=8).collect())).values()) < 1.2 * min(c.values())
    assert kd_shards(odd, shards=8).count() == odd.count()
    assert kd_shards(odd.where("false"), shards=8).count() == 0


def test_kd_shards_dimensions(spark):
    """Strings that differ late, fractions, wide and negative numbers split the tree by their order; nulls come first."""
    names = [None, "crawl-2023-a", "crawl-2023-b", "crawl-2024-07"]
    kinds = [
        ("string", names),
        ("double", [None, -0.5, 0.25, 0.75]),
        ("long", [None, -(1 << 62), 5, 1 << 62]),
        ("int", [None, -7, -2, 3]),
        ("timestamp", [None, *(datetime(2024, 1, 1, 0, 0, k) for k in range(3))]),
    ]
    for kind, values in kinds:
        rows = [(4 * i + k, f"text {4 * i + k:04d}", v) for i in range(50) for k, v in enumerate(values)]
        docs = spark.createDataFrame(rows, f"doc_id long, text string, at {kind}")
        for limit in (8 << 20, 0) if kind == "string" else (8 << 20,):
            found = {r["doc_id"]: r["shard"] for r in kd_shards(docs, dims=("at",), shards=4, broadcast_bytes=limit).collect()}
            assert len(found) == 200 and all(shard == i % 4 for i, shard in found.items()), kind
    assert _nodes(spark, [(i, -i) for i in range(100_000)], "node, at").agg({"at": "min"}).first()[0] == -99_999
