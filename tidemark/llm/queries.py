"""Queries ``opN_<name>``: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, byte_bpe, hard_negatives, html_extract, katz, merkle, packing, quality, secret_scan, toxicity
from .common import read
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_components
from .kd_sharding import kd_shards


def _remainder(column: str, n: int) -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.katz_scores(read(spark, sf_dir, "documents"), _remainder("doc_id", 10) != 0, reserve=0.5)
    held_out = (_remainder("doc_id", 10) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents")).select("doc_id", *quality.ADDED)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_random")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = byte_bpe.encode(read(spark, sf_dir, "documents"), decoded=True)
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return both.select("doc_id", n_tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), _remainder("doc_id", 4) != 2)
    return found.select("doc_id", (_remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: Targets of op7: proportions of the sources' tokens to this power, evened out.
TEMPER = 0.7


def op7_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), temper=TEMPER)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(read(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fields = [docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    forged = [*fields[:-1], F.translate("text", "\n", "")]
    tampered = F.coalesce(_remainder("doc_id", 2) == 0, F.lit(False))
    rows = docs.select(
        F.col("source").alias("grp"), F.col("doc_id").alias("ord"), merkle.leaf_hash(fields).alias("digest"),
        F.when(tampered & F.contains("text", F.lit("\n")), merkle.leaf_hash(forged)).alias("forged"),
    )
    found = merkle.manifest(rows).withColumn("folded", merkle.fold(F.coalesce("forged", "digest"), F.col("steps")))
    text = lambda c: F.lower(F.hex(c))
    return found.select(
        F.col("ord").alias("doc_id"), text("digest").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        F.sha2(text(merkle.proof_digests(F.col("steps"))), 256).alias("proof_sha256"), text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op12_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.nearest(read(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op13_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)), label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_katz_backoff": op1_katz_backoff,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_quality_cascade": op3_quality_cascade,
    "op4_secret_scan": op4_secret_scan,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_mixture_packing": op7_mixture_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_kd_sharding": op9_kd_sharding,
    "op10_site_style_tree": op10_site_style_tree,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_one_bit_neighbours": op12_one_bit_neighbours,
    "op13_kronecker_negatives": op13_kronecker_negatives,
}

SQL: dict[str, str] = {
    "op3_quality_cascade": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        wr AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
        win AS (SELECT doc_id, i, string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS k,
                       count(*) OVER (PARTITION BY doc_id) AS n FROM wr),
        twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win WHERE i <= n - 7),
        rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(8) AS r(j) WHERE c > 1 GROUP BY doc_id),
        ln AS (SELECT doc_id, [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM d),
        b AS (SELECT d.doc_id, t, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                     len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines,
                     len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
              FROM d JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
        f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 10 * n_symbols > n_words OR 2 * word_chars < 5 * n_words OR word_chars > 14 * n_words
                    OR 100 * n_dup_lines > 40 * n_lines OR 100 * len(regexp_extract_all(t, '\p{Lu}')) > 40 * word_chars
                    OR 2 * len(regexp_extract_all(t, '!')) > n_words OR 100 * len(regexp_extract_all(t, '[0-9]')) > 40 * word_chars
                    OR len(list_distinct(w)) ** 2 < n_words) AS kept
        FROM f""",
    "op8_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
                   FROM documents)
        SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept, text_sha256
        FROM d""",
    "op11_merkle_manifest": r"""
        WITH RECURSIVE d AS (
            SELECT *, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                             coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
                   list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]),
                       lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS crc,
                   replace(text, chr(10), '') AS forged
            FROM documents),
        l AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                     CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(head || coalesce(strlen(forged) || ':' || forged, '-')) END AS forged_leaf
              FROM d),
        r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k,
                     count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM l),
        up AS (SELECT tree, n, 0 AS level, k, leaf AS digest FROM r
               UNION ALL
               SELECT tree, (n + 2) // 3, level + 1, k // 3, sha256(string_agg(digest, '' ORDER BY k)) FROM up WHERE n > 1 GROUP BY tree, n, level, k // 3),
        top AS (SELECT 0 AS level, tree AS k, digest, count(*) OVER () AS n FROM up WHERE n = 1
                UNION ALL
                SELECT level + 1, k // 3, sha256(string_agg(digest, '' ORDER BY k)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY n, level, k // 3),
        nodes AS (SELECT *, max(level) OVER (PARTITION BY tree) AS h FROM up UNION ALL SELECT -1, n, level, k, digest, max(level) OVER () FROM top),
        kids AS (SELECT tree, h, level, k // 3 AS run, list(digest ORDER BY k) AS kids FROM nodes WHERE level < h GROUP BY tree, h, level, k // 3),
        fold AS (SELECT doc_id, leaf, tree, tree AS t, 0 AS level, k, coalesce(forged_leaf, leaf) AS folded, '' AS proof, row_number() OVER () AS id,
                        (SELECT max(h) FROM nodes WHERE nodes.tree = r.tree) AS h, (SELECT max(h) FROM nodes WHERE tree = -1) AS top_h FROM r
                 UNION ALL
                 SELECT doc_id, leaf, f.tree, CASE WHEN f.level = f.h AND t >= 0 THEN -1 ELSE t END,
                        CASE WHEN f.level = f.h AND t >= 0 THEN 0 ELSE f.level + 1 END, CASE WHEN f.level = f.h AND t >= 0 THEN f.tree ELSE f.k // 3 END,
                        CASE WHEN f.level = f.h AND t >= 0 THEN folded
                             ELSE sha256(array_to_string(kids[:f.k % 3], '') || folded || array_to_string(kids[f.k % 3 + 2:], '')) END,
                        CASE WHEN f.level = f.h AND t >= 0 THEN proof
                             ELSE proof || array_to_string(kids[:f.k % 3], '') || array_to_string(kids[f.k % 3 + 2:], '') END,
                        id, CASE WHEN f.level = f.h AND t >= 0 THEN top_h ELSE f.h END, top_h
                 FROM fold f LEFT JOIN kids ON kids.tree = f.t AND kids.level = f.level AND kids.run = f.k // 3
                 WHERE t >= 0 OR f.level < f.h)
        SELECT doc_id, leaf, s.digest AS subroot, w.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = w.digest AS verified
        FROM fold f JOIN (SELECT tree, digest FROM nodes WHERE level = h AND tree >= 0) s ON s.tree = f.tree
        CROSS JOIN (SELECT digest FROM nodes WHERE level = h AND tree = -1) w
        WHERE f.t = -1 AND f.level = f.h""",
    "op12_one_bit_neighbours": r"""
        WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
                   WHERE len(embedding) = len([c FOR c IN embedding IF c IS NOT NULL AND isfinite(c)]) AND len([c FOR c IN embedding IF c <> 0]) > 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.x, c.x) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""",
    "op13_kronecker_negatives": r"""
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          [floor(256 * c::DOUBLE) FOR c IN embedding] AS x
                   FROM embeddings
                   WHERE label IS NOT NULL AND len(embedding) = len([c FOR c IN embedding IF c IS NOT NULL AND isfinite(c)])),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.x, c.x)::BIGINT AS score
              FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.x) = len(c.x) WHERE a.vec_id % 50 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3""",
}
