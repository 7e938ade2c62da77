"""Corpus pipeline: language, near duplicates, benchmark leaks, personal data,
token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet under the shared checkpoint folder and reads again as the
next stage's documents. All stages but the last return the columns of the
documents; rows pass through whole, whatever other columns they carry. Null
and empty texts, which have no language, go in the first stage. A stage that
hands rows to Python limits the session's batches, as it runs when its result
is written; ``run`` puts the limit back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.llm import bpe, decontaminate, langid, ngram_join, pii
from martline.llm.common import batch_rows, documents, materialise, narrow_batches
from martline.session import ensure_checkpoint_dir, table_path

#: Key of the registered pipeline; a deployment passes its own secret.
PII_KEY = "registered-query"
#: Near duplicates: shingles of so many words, Jaccard of so many percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80
RANKS = "byte_bpe_50k.tiktoken"
#: Rows pass whole to Python and back, so many at a time.
BATCH_ROWS = 1000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: no text or letters, or no language with three
    tenths of the words, and a document goes."""
    narrow_batches(spark, BATCH_ROWS)
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.accepted(docs, model) if model.languages else docs


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group of linked ones: 5-word shingles,
    Jaccard 0.8 or more (op3's query has 4 words and 0.85)."""
    return ngram_join.representatives(docs, percent=NEAR_PERCENT, words=NEAR_WORDS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    narrow_batches(spark, BATCH_ROWS)
    return decontaminate.clean(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by format-preserving pseudonyms."""
    return pii.pseudonymise(docs, PII_KEY, found="_found").drop("_found")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns without the text, plus ``ids`` and ``n_tokens``."""
    narrow_batches(spark, BATCH_ROWS)
    path = public_tokenizers.path(RANKS)
    return bpe.encode(docs, path, public_tokenizers.PATTERN).withColumn(
        "n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("pseudonyms", pseudonyms),
    ("token_ids", token_ids),
]

# The language model, the shuffle-based join and the tokenizer are beyond SQL;
# tests/llm hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = documents(spark, sf_dir)
    with batch_rows(spark, BATCH_ROWS):  # of the stages' settings none stays
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
