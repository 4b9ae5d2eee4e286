"""The Merkle manifest against a plain tree, and its proofs against changed rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.queries import QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def climb(nodes, fan=3):
    """The last node, and for each node the digests left and right at each level."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for proof, i in zip(proofs, range(len(proofs))):
            run = at[i] // fan * fan
            proof.append((level[run : at[i]], level[at[i] + 1 : run + fan]))
            at[i] //= fan
        level = [sha("".join(level[i : i + fan])) for i in range(0, len(level), fan)]
    return level[0], proofs


def plain_manifest(rows, fan=3):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs, found = [], []
    for name in names:
        leaves = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)), r["doc_id"]) for r in groups[name])
        sub, proofs = climb([key[2] for key, _ in leaves], fan)
        subs.append(sub)
        found += [(i, key[2], sub, proof, len(subs) - 1) for (key, i), proof in zip(leaves, proofs)]
    root, top = climb(subs, fan)
    return root, [(i, leaf, sub, proof + top[at]) for i, leaf, sub, proof, at in found]


def run(docs, **params):
    rows = docs.select(F.col("source").alias("grp"), F.col("doc_id").alias("ord"), merkle.leaf_hash([docs[c] for c in FIELDS]).alias("digest"))
    found = merkle.manifest(rows, **params).withColumn("folded", merkle.fold(F.col("digest"), F.col("steps")))
    return [r.asDict() for r in found.collect()]


@pytest.mark.parametrize("params", [{}, {"band": 1, "broadcast_rows": 0}, {"band": 2, "fan": 2}])
def test_tree(documents, odd, params):
    for df in (documents.union(documents.limit(2)), odd, odd.where("doc_id = 5"), odd.where("doc_id = 9")):
        root, plain = plain_manifest([r.asDict() for r in df.select(*FIELDS).collect()], params.get("fan", 3))
        found = run(df, **params)
        assert all(r["root"].hex() == root and r["folded"] == r["root"] for r in found)

        def joined(sides):
            return "".join(sides)

        mine = [(r["ord"], r["digest"].hex(), r["subroot"].hex(), [(s["l"].hex(), s["r"].hex()) for s in r["steps"]]) for r in found]
        assert sorted(mine, key=str) == sorted(((i, leaf, sub, [(joined(a), joined(b)) for a, b in p]) for i, leaf, sub, p in plain), key=str)


def test_empty(odd):
    assert run(odd.where("false")) == []


def test_query_finds_each_changed_row(spark, documents, tmp_path):
    path = tmp_path / "d"
    fixed = documents.withColumn("text", F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("text")))
    fixed.write.parquet(str(path / "documents.parquet"))
    rows = {r["doc_id"]: r.asDict() for r in fixed.collect()}
    _, plain = plain_manifest(list(rows.values()))
    proofs = {i: sha("".join("".join(a) + "".join(b) for a, b in p)) for i, _, _, p in plain}
    found = QUERIES["op11_merkle_manifest"](spark, str(path)).collect()
    assert len(found) == len(rows)
    changed = {i for i, r in rows.items() if zlib.crc32(str(i).encode()) % 2 == 0 and "\n" in (r["text"] or "")}
    assert changed and {r["doc_id"] for r in found if not r["verified"]} == changed
    for r in found:
        assert r["proof_sha256"] == proofs[r["doc_id"]] and (r["folded_root"] == r["root"]) == r["verified"]


def test_places_are_exact(spark):
    """More rows of one group than a range holds, all of equal order: each gets a place of its own."""
    rows = spark.range(3000).select(F.lit("hot").alias("grp"), F.lit(1).alias("ord"), (F.col("id") % 7).alias("x"))
    found = merkle.ranked(rows, ["grp", "ord"]).select("place").collect()
    assert sorted(r["place"] for r in found) == list(range(3000))
