"""The queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import importable


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    stored = shard_documents(_read(spark, sf_dir, "documents"))
    return stored.select("doc_id", "lang", "source", "n_chars", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import dedup_simhash

    return dedup_simhash(_read(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_rules

    return quality_rules(_read(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .classifier import classify

    return classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    return round_trip(_read(spark, sf_dir, "pages"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(_read(spark, sf_dir, "embeddings"), equal_rows=True)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .sentencepiece import round_trip

    return round_trip(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import dedup_suffixes

    return dedup_suffixes(_read(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import score_documents

    return score_documents(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op7_packing": op7_packing, "op8_simhash": op8_simhash, "op3_quality_rules": op3_quality_rules, "op9_quality_classifier": op9_quality_classifier, "op5_warc": op5_warc, "op6_exact_topk": op6_exact_topk, "op2_sentencepiece": op2_sentencepiece, "op10_suffix_dedup": op10_suffix_dedup, "op4_lm_scoring": op4_lm_scoring, "op1_sharding": op1_sharding}

ORACLE_SQL: dict[str, str] = {
    "op1_sharding": "SELECT doc_id, lang, source, n_chars, sha256(coalesce(text, '')) AS text_sha256 FROM documents",
    "op5_warc": """
        WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        sized AS (SELECT page_id, payload, strlen(payload) AS payload_bytes, max(page_id) OVER (PARTITION BY payload) AS first FROM payloads)
        SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
        FROM sized""",
    "op6_exact_topk": """
        WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    # every window of 400 bytes by its MD5; windows that occur twice, their runs, and what lies between
    "op10_suffix_dedup": """
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
        starts AS (SELECT rid, unnest(range(0, greatest(octet_length(b) - 399, 0))) AS i, b FROM docs),
        windows AS (SELECT rid, i, md5(b[i + 1:i + 400]) AS w FROM starts),
        repeated AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
        marked AS (SELECT rid, i, (i > coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i) + 400, -1))::INTEGER AS new FROM repeated),
        spans AS (SELECT rid, min(i) AS a, max(i) + 400 AS z FROM (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS g FROM marked) GROUP BY rid, g),
        kept AS (SELECT rid, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) AS begin_, a AS end_, z FROM spans),
        sums AS (SELECT rid, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS last FROM spans GROUP BY rid),
        pieces AS (SELECT k.rid, string_agg(hex(b[begin_ + 1:end_]), '' ORDER BY begin_) AS h FROM kept k JOIN docs USING (rid) GROUP BY k.rid)
        SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(h, '') || hex(b[coalesce(last, 0) + 1:octet_length(b)]))) AS kept_sha256
        FROM docs LEFT JOIN sums USING (rid) LEFT JOIN pieces USING (rid)""",
}
