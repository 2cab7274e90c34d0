"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covey.llm import bpe, decontamination, fmindex, forest, huffman, langid, ngrams, spelling, suffixes, tokencounts, toxicity, warc, whitening

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op1_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.with_digests(bpe.encode_decode(docs, BYTE_BPE, public_tokenizers.PATTERN)).drop("ids")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.section_tokens(_table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(_table(spark, sf_dir, "pages"), warc.folder(spark))
    return warc.read(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs.select("doc_id", "text"), langid.fit(docs)).select(
        "doc_id", _held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.jaccard_classes(_table(spark, sf_dir, "documents"))


def op8_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return huffman.read(huffman.write(docs, WORD_BPE, huffman.folder(spark)), with_ids=False)


def op9_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return whitening.transform(vectors, whitening.fit(vectors)).withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_spelling_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scorer = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), scorer).select(
        "doc_id", _held_out().alias("held_out"), F.col("toxicity").alias("score"), F.col("toxic_pred").alias("predicted")
    )


QUERIES = [
    op1_rp_forest,
    op2_byte_bpe,
    op3_token_counts,
    op4_warc_zip,
    op5_language_id,
    op6_suffix_dedup,
    op7_ngram_jaccard,
    op8_huffman_ids,
    op9_fm_index,
    op10_decontamination,
    op11_cholesky_whitening,
    op12_spelling_tiles,
    op13_toxicity_gru,
]
ORACLES: dict[str, str] = {
    "op4_warc_zip": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(encode(coalesce(html, ''))) AS payload_digest
  FROM pages
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) AS largest FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
FROM k
""",
}
