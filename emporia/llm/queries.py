"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import (
    embedding_dedup, exact_dedup, language_id, licenses, minhash_dedup, packing, periodic_runs, piece_codec,
    quality, token_alignment, token_counts, warc, word_bpe,
)
from emporia.llm.common import crc_of_id, table
from emporia.session import scratch_path


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id() % 4 == 2
    model = language_id.fit_languages(docs.where(~held_out))
    return language_id.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_embeddings(table(spark, sf_dir, "embeddings"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives when called; the result reads them."""
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    warc.register_warc(spark)

    def page(col: str):
        return F.regexp_extract(col, "urn:page:([^>]*)>", 1).try_cast("long")

    full = warc.read_responses(spark, path).select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"))
    again = warc.read_revisits(spark, path).select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.replace("payload_digest", F.lit("sha256:"), F.lit("")).alias("payload_digest"), "record_type",
        page("refers_to").alias("refers_to"))
    return full.unionByName(again)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "segment", "loss_tokens")


def op7_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = word_bpe.encode_and_decode(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of_id() % 3 == 1
    model = quality.fit_quality(docs, labels.where(~held_out))
    return quality.score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("matches")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document, by hash, gets a loop planted."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"),
                                        loop=F.when(h % 10 == 0, F.floor(h / 10).cast("long")))
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))
    return aligned.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("").alias("groups_sha256"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piece_codec.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                               decoded=True)
    return coded.select("doc_id", "n_tokens",
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_warc": op5_warc,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_bpe_roundtrip": op7_bpe_roundtrip,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_license_scan": op10_license_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_alignment": op12_token_alignment,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLE_WARC = """
WITH t AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM t WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT t.page_id, t.payload_bytes, t.payload_digest,
       CASE WHEN f.first <> t.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> t.page_id THEN f.first END AS refers_to
FROM t LEFT JOIN f USING (payload_digest)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.ORACLE_EXACT,
    "op5_warc": ORACLE_WARC,
    "op10_license_scan": licenses.oracle_sql(),
}
