"""Registered queries of the operators, and their SQL where SQL can say the same.

Each query applies its operator with production settings to its whole table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaprecon.llm import decontaminate, exact_dedup, lm_score, merkle, packing, quality, secret_scan, simhash, suffix_dedup, token_rollup, topk, toxicity, whitening
from snaprecon.llm._common import cut, read_table
from snaprecon.session import fresh_path


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no URLs: its source is the host, the language a path of it."""
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(read_table(spark, sf_dir, "documents"), 400)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(read_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(read_table(spark, sf_dir, "documents"), words=4, max_bits=4)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), 1024)


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The life of all documents in four batches, one of them committed twice.

    0 inserts every document under the first tokenizer with an estimate (a
    token for four bytes), 1 revises all estimates to true counts, 2 moves
    every document to the second tokenizer's version (delete and insert), 3
    takes the documents labelled toxic down.
    """
    files = {"byte_bpe_50k": "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}
    old, new = files
    count = {v: token_rollup.token_counter(public_tokenizers.path(f)) for v, f in files.items()}
    text = F.coalesce("text", F.lit(""))
    docs = cut(read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.ceil(F.octet_length(text) / 4).alias("guess"), count[old](text).alias(old), count[new](text).alias(new)))
    toxic = read_table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()

    def changes(op: str, version: str, tokens: str, before=None, rows: DataFrame = docs) -> DataFrame:
        return rows.select(F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("version"), F.col(tokens).alias("tokens"), (F.col(before) if before else F.lit(None)).cast("long").alias("before"))

    ledger = token_rollup.Ledger(spark, fresh_path(spark, "token-ledger"))
    ledger.commit(0, changes("insert", old, "guess"))
    ledger.commit(1, changes("revise", old, old, "guess"))
    ledger.commit(2, changes("delete", old, old).unionByName(changes("insert", new, new)))
    ledger.commit(3, changes("delete", new, new, rows=docs.join(toxic, "doc_id", "left_semi")))
    ledger.commit(1, changes("revise", old, old, "guess"))
    return ledger.totals()


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(read_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), 16)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof against the root, and the root that its copy (every other one without line breaks) comes to."""
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    docs = read_table(spark, sf_dir, "documents").select(*columns)
    values = [F.col(c) for c in columns]
    stripped = F.replace("text", F.lit("\n"), F.lit(""))
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    leaves = docs.select("doc_id", "source", merkle.leaf(*values).alias("leaf"), F.when(tampered, merkle.leaf(*values[:-1], stripped)).alias("tampered"))
    proofs = merkle.manifest(leaves, "source", ["doc_id", "leaf"], ["doc_id", "leaf", "tampered"])
    folded = proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


QUERIES = {f.__name__: f for f in (op1_quality, op2_suffix_dedup, op3_lm_score, op4_simhash, op5_packing, op6_token_rollup, op7_secret_scan, op8_decontaminate, op9_toxicity, op10_exact_dedup, op11_whitening, op12_merkle_manifest, op13_topk)}

ORACLES = {
    "op10_exact_dedup": """
        WITH marked AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
        FROM marked WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op12_merkle_manifest": """
        WITH RECURSIVE fields AS (
            SELECT doc_id, source, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
            FROM documents
        ),
        sums AS (  -- crc32 of the decimal doc_id, bit by bit
            SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, flatten([[ord(c)::BIGINT + 256, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')])),
                   lambda r, b: CASE WHEN b >= 0 THEN xor(r, b - 256) WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) AS crc
            FROM (SELECT DISTINCT doc_id FROM documents)
        ),
        leaves AS (
            SELECT f.doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS tampered
            FROM fields f LEFT JOIN sums s ON f.doc_id IS NOT DISTINCT FROM s.doc_id
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER () AS row_id, count(*) OVER (PARTITION BY source) AS n FROM leaves
        ),
        tree AS (
            SELECT source, 0 AS depth, pos, n, leaf AS h FROM placed
            UNION ALL
            SELECT source, any_value(depth) + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY source, pos // 3
        ),
        subroots AS (
            SELECT source, depth, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
        ),
        top AS (
            SELECT 0 AS depth, pos, n, subroot AS h FROM subroots
            UNION ALL
            SELECT any_value(depth) + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY pos // 3
        ),
        ways AS (  -- of each row, level by level, what stands left and right of its node
            SELECT p.row_id, t.depth, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < p.pos // (3 ** t.depth)::BIGINT), '') AS l,
                   coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > p.pos // (3 ** t.depth)::BIGINT), '') AS r
            FROM placed p JOIN tree t ON t.source IS NOT DISTINCT FROM p.source AND t.n > 1 AND t.pos // 3 = p.pos // (3 ** (t.depth + 1))::BIGINT
            GROUP BY p.row_id, t.depth
            UNION ALL
            SELECT p.row_id, s.depth + t.depth, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < s.pos // (3 ** t.depth)::BIGINT), ''),
                   coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > s.pos // (3 ** t.depth)::BIGINT), '')
            FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN top t ON t.n > 1 AND t.pos // 3 = s.pos // (3 ** (t.depth + 1))::BIGINT
            GROUP BY p.row_id, s.depth, t.depth
        ),
        folds AS (
            SELECT row_id, 0 AS depth, coalesce(tampered, leaf) AS h FROM placed
            UNION ALL
            SELECT f.row_id, f.depth + 1, sha256(l || h || r) FROM folds f JOIN ways w ON w.row_id = f.row_id AND w.depth = f.depth
        ),
        proofs AS (SELECT row_id, sha256(string_agg(l || r, '' ORDER BY depth)) AS proof_sha256 FROM ways GROUP BY row_id),
        ends AS (SELECT row_id, max_by(h, depth) AS folded_root FROM folds GROUP BY row_id)
        SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
               folded_root = (SELECT h FROM top WHERE n = 1) AS verified
        FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN ends e ON e.row_id = p.row_id LEFT JOIN proofs q ON q.row_id = p.row_id
    """,
    "op13_topk": """
        WITH whole AS (
            SELECT row_number() OVER () AS row_id, vec_id, [floor(256 * c::DOUBLE) FOR c IN embedding] AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ),
        pairs AS (
            SELECT q.row_id, q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
            FROM whole q JOIN whole c ON c.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score
        FROM pairs QUALIFY rank <= 5
    """,
}
