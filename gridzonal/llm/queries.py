"""One registered query per operator, with production parameters over its whole table, and the SQL for them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzonal.llm.exact_dedup import exact_groups
from gridzonal.llm.jaccard import near_components
from gridzonal.llm.kdtree import top_k
from gridzonal.llm.lm import lm_scores
from gridzonal.llm.merkle import merkle_proofs
from gridzonal.llm.mixing import EPOCHS, SEED, TEMPERATURE, mix
from gridzonal.llm.packing import pack
from gridzonal.llm.quality import classify
from gridzonal.llm.sharding import read_shards, row_bytes, shard_tree, write_shards
from gridzonal.llm.shipping import ship_package
from gridzonal.llm.suffixes import repeated_passages
from gridzonal.llm.token_orc import token_digests, write_token_orc
from gridzonal.llm.warc import SHORTEST_REVISIT, page_archive
from gridzonal.llm.whitening import whiten
from gridzonal.storage import fresh_path

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-orc")
    write_token_orc(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), end_id=1)
    return token_digests(spark, path)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(_table(spark, sf_dir, "documents"))


def op3_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=0, capacity=CAPACITY)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op7_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op8_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_trie_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_archive(_table(spark, sf_dir, "pages"))


def op11_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    path = fresh_path(spark, "shards")
    write_shards(docs, shard_tree(docs, shards=SHARDS), path)
    text = F.col("document.text")
    return read_shards(spark, path, docs.schema).select(
        "document.doc_id",
        row_bytes("document.text").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_gkl_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_veb_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_proofs(_table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_orc": op1_token_orc,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_kdtree_topk": op3_kdtree_topk,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_poisson_mixing": op7_poisson_mixing,
    "op8_ftrl_quality": op8_ftrl_quality,
    "op9_trie_lm": op9_trie_lm,
    "op10_warc": op10_warc,
    "op11_kd_sharding": op11_kd_sharding,
    "op12_gkl_whitening": op12_gkl_whitening,
    "op13_veb_merkle": op13_veb_merkle,
}

ORACLE: dict[str, str] = {
    "op3_kdtree_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ),
        r AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op4_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY ALL)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
    "op7_poisson_mixing": f"""
        WITH sized AS (
            SELECT source, sum(greatest(coalesce(length(text), 0), 1))::DOUBLE AS size FROM documents GROUP BY source
        ),
        rated AS (
            SELECT source, ((size ^ {TEMPERATURE}::DOUBLE) / sum(size ^ {TEMPERATURE}::DOUBLE) OVER ())
                * ({EPOCHS}::DOUBLE * sum(size) OVER () / size) AS rate
            FROM sized
        ),
        terms AS (
            SELECT source, k, CASE WHEN k = 0 THEN exp(-rate) ELSE exp(-rate + k * ln(rate) - lgamma(k + 1)) END AS p
            FROM rated, LATERAL (SELECT unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS k)
        ),
        steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS upto FROM terms),
        drawn AS (
            SELECT *, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
                / 4503599627370496.0::DOUBLE AS u
            FROM documents
        ),
        counted AS (
            SELECT drawn.*, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM drawn.source AND s.upto <= u)
                AS n
            FROM drawn
        ),
        copies AS (SELECT *, unnest(range(0, n))::INTEGER AS copy FROM counted)
        SELECT doc_id, text, lang, source, n_chars, copy,
            ('0x' || substr(md5('{SEED}:order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 13))::BIGINT
                / 4503599627370496.0::DOUBLE AS shuffle_key
        FROM copies
    """,
    "op10_warc": f"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
        r AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id,
                payload_bytes >= {SHORTEST_REVISIT} AND page_id <> min(page_id) OVER (PARTITION BY payload_digest) AS again
            FROM d
        )
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN again THEN first_id END AS refers_to
        FROM r
    """,
}
