"""The corpus pipeline: stages over ``documents``, each written and read again.

1. language ID: documents whose language can't be told go;
2. n-gram Jaccard join: of each class of near copies the document of smallest doc_id stays;
3. substring dedup: words in windows that repeat anywhere go from the texts, which become the
   words that are left, joined by one space; a document left without any word stays, empty;
4. benchmark decontamination: documents into which a benchmark item leaks go;
5. byte-level BPE: the ids of each text, with digests of the ids and of the text decoded again.

All but the last return the columns of ``documents``, and keep all other documents as they are.
Columns beyond ``doc_id``, ``text``, ``lang`` and ``n_chars`` may have any name: while a stage works they
have names of their own. A null text has no language, so its document goes in the first stage; rows
with a null or repeated ``doc_id`` are documents of their own, but where copies and leaks are told by id,
rows that share one stay or go together. Empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covey.llm import bpe, decontamination, fmindex, langid, ngrams
from covey.sources.shared import fresh_path, materialise, remove, scratch

#: A document is rejected if no language has this much of its windows' probability.
LEAST_SCORE = 0.4

_BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


_OWN = ("doc_id", "text", "lang", "n_chars")


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with names of their own for all but the columns that stages use."""
    return docs.toDF(*[c if c in _OWN else f"other_{i}" for i, c in enumerate(docs.columns)])


def _back(done: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, by their names in ``docs``."""
    return done.select(*_apart(docs).columns).toDF(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    told = langid.predict(_apart(docs), langid.fit(docs))
    sure = (F.col("lang_pred") != langid.UNDECIDED) & (F.col("lang_score") >= LEAST_SCORE)
    return _back(told.filter(sure), docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without doc_id stay; rows that share a doc_id are one document."""
    classes = ngrams.jaccard_classes(docs.select("doc_id", "text"))
    copies = classes.filter("component_id <> doc_id").select("doc_id").distinct()
    return _back(_apart(docs).join(copies, "doc_id", "left_anti"), docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of which nothing is removed stay as they are, with their white space."""
    known = _identified(_apart(docs))
    done = fmindex.remove_repeats(known.select(F.col("_num").alias("doc_id"), "text")).filter("n_removed > 0")
    changed = done.select(F.col("doc_id").alias("_num"), F.col("kept").cast("string").alias("_kept"))
    joined = known.join(changed, "_num", "left")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        joined = joined.withColumn("n_chars", F.coalesce(F.length("_kept").cast(kind), "n_chars"))
    return _back(joined.withColumn("text", F.coalesce("_kept", "text")), docs)


def _identified(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for every row, in ``_num``."""
    odd = docs.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1").limit(1)
    if odd.isEmpty():
        return docs.withColumn("_num", F.col("doc_id"))
    # Written down, so that the numbers are the same whenever they are read.
    return materialise(docs.withColumn("_num", F.monotonically_increasing_id()), "identified")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _back(decontamination.clean(_apart(docs), benchmark), docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(docs, _BYTE_BPE, public_tokenizers.PATTERN)
    return bpe.with_digests(coded)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_bpe),
]

#: Learned models and graph components have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage wrote for its own use goes with it, and its result with the next."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES):
        path = fresh_path(spark, f"pipeline-{i}")
        with scratch(spark):
            done = stage(spark, docs, sf_dir)
            done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
