"""The corpus pipeline: quality, exact and near copies, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on
all that the stage before it kept. All but the last return the columns of
``documents``; the last returns the documents as tokens.

Defined results: null texts count as empty. The quality stage has no votes
against documents without words and scores them by the scorer's intercept;
exact copies keep the row with the largest key, near copies the one with the
least; a null key ranks last. An empty table stays empty. Extra columns of
any name pass through all stages but the last, which keeps those that its
outputs do not replace.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skein import session
from skein.llm import bpe, decontaminate, exact_dedup, ngram_join, quality
from skein.llm.frames import col, field, packed, table


def _rows_where(docs: DataFrame, judge, verdict: str, wanted: bool) -> DataFrame:
    """The rows of ``docs`` whose verdict is as wanted, columns untouched."""
    row = docs.select(packed(docs), col("text").alias("text"))
    return judge(row).filter(verdict if wanted else f"NOT {verdict}").select(*[field(c).alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label quality model keeps."""
    model = quality.fit(docs)
    return _rows_where(docs, lambda row: quality.score(row, model), "keep", True)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicated(docs, keep="largest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return ngram_join.deduplicated(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _rows_where(docs, lambda row: decontaminate.scan(row, benchmark), "contaminated", False)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, with hashes of the ids and of what they
    decode to, in place of the text."""
    from skein.llm.queries import tokenizer_file
    return bpe.encode(docs, tokenizer_file(), outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256")).drop("text")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("n-gram jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("bpe encoding and decoding", tokens),
]

#: The classifier is trained, so SQL cannot state its rows; tests/llm/test_pipeline.py holds each stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared
    folder and read again as the next one's input."""
    shared = session.ensure_checkpoint_dir(spark).rstrip("/")
    session.ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        path = f"{shared}/pipeline-{uuid.uuid4().hex}/{at}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
