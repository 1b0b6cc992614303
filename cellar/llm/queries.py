"""Registered queries of the training-data operators and their oracle SQL (where SQL can express them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellar.llm import (exact_dedup, filter_audit, licenses, mixing, near_dedup, pieces, quality, secrets, simhash,
                        syncmers, toxicity, vector_codes, warc)
from cellar.llm._common import prepare, read_table
from cellar.session import shared_path

QueryFn = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """The public 32k model; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = shared_path(spark, "llm", spark.sparkContext.applicationId, "archive", unique=True)
    warc.write_archive(read_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                 "refers_to")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.notices(read_table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports the operators of this subpackage

    prepare(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, QueryFn] = {
    "pipeline": pipeline,
    "op1_warc": op1_warc,
    "op2_mixing": op2_mixing,
    "op3_syncmers": op3_syncmers,
    "op4_toxicity": op4_toxicity,
    "op5_licenses": op5_licenses,
    "op6_secrets": op6_secrets,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_near_dedup": op8_near_dedup,
    "op9_quality": op9_quality,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_simhash": op11_simhash,
    "op12_filter_audit": op12_filter_audit,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        k AS (SELECT h, max(page_id) AS last_page FROM p GROUP BY h),
        r AS (SELECT p.page_id, p.h, octet_length(encode(p.h)) AS n, k.last_page,
                     octet_length(encode(p.h)) >= 1000 AND p.page_id <> k.last_page AS again
              FROM p JOIN k ON p.h = k.h)
        SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN last_page END AS refers_to
        FROM r""",
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t""",
    # each order applied to each mask of failed filters, counted
    "op12_filter_audit": r"""
        WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
                     min(doc_id) OVER (PARTITION BY t) AS first_id FROM t),
        d AS (SELECT doc_id, part,
                     CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
                     || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
                     || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END
                     || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                     || CASE WHEN first_id < coalesce(doc_id, 9223372036854775807) THEN 'E' ELSE '' END AS fails
              FROM w),
        c AS (SELECT part, fails, count(*) AS n,
                     count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL)) AS good,
                     count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)) AS toxic
              FROM d GROUP BY part, fails),
        o(filter_order) AS (
            SELECT '' UNION ALL
            SELECT filter_order || f FROM o, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(f)
            WHERE length(filter_order) < 5 AND NOT contains(filter_order, f)),
        s AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS f, filter_order[1:step - 1] AS before
              FROM o, range(1, 6) AS r(step) WHERE length(filter_order) = 5),
        x AS (SELECT part, filter_order, step, f,
                     coalesce(sum(n) FILTER (translate(fails, before || f, '') = fails), 0)::BIGINT AS kept,
                     coalesce(sum(n) FILTER (translate(fails, before, '') = fails AND contains(fails, f)), 0)::BIGINT AS removed,
                     coalesce(sum(n) FILTER (translate(fails, before, '') <> fails AND contains(fails, f)), 0)::BIGINT AS redundant,
                     coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
                     coalesce(sum(good) FILTER (translate(fails, before, '') = fails AND contains(fails, f)), 0)::BIGINT AS good_lost,
                     coalesce(sum(toxic) FILTER (translate(fails, before, '') = fails AND contains(fails, f)), 0)::BIGINT AS toxic_lost
              FROM c, s GROUP BY part, filter_order, step, f)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
        FROM x""",
}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
