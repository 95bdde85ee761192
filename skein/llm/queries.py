"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein import session
from skein.functions.tokens import let
from skein.llm import bpe
from skein.llm import decontaminate
from skein.llm import exact_dedup as ed
from skein.llm import divergence, mixing, ngram_join, ppm, quality, repeats, runs, sharding, toxicity, warc
from skein.llm.frames import table


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            session.ensure_checkpoint_dir(spark)
            session.ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return deco


NORM_SQL = f"translate(coalesce(text, ''), '{ed.UPPER}', '{ed.LOWER}')"


@register("op2_warc_derivatives", warc.sql())
def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.derivatives(warc.responses_of(pages)).withColumnRenamed("key", "page_id")


@register("op6_differencing_shards")
def op6_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, 8, carry=["doc_id"])


@register("op7_exact_dedup", f"""
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           row_number() OVER (PARTITION BY {NORM_SQL} ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
           sha256({NORM_SQL}) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY {NORM_SQL})""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ed.exact_dedup(docs, keep="largest").select("doc_id", *ed.OUTPUTS)


@register("op9_bpe_lexicon")
def op9_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, tokenizer_file(), outputs=("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


@register("op5_toxicity_cnn")
def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    held_out = F.coalesce(fold == 2, F.lit(False))
    return toxicity.classify(docs, table(spark, sf_dir, "labels"), fold != 2).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "flagged", "threshold")


@register("op10_weak_label_quality")
def op10_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs).select("doc_id", *quality.OUTPUTS)


@register("op3_qgram_decontaminate")
def op3_qgram_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.scan(docs, table(spark, sf_dir, "benchmark")).select("doc_id", *decontaminate.OUTPUTS)


@register("op4_repeated_passages")
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs, unit="sentence", least_words=10, stays=True)


@register("op1_ngram_jaccard_join")
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op8_ppm_scores")
def op8_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    return ppm.score(docs, ~held_out).select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                                             "base_score", "score")


def _with_tail_repeated(docs: DataFrame) -> DataFrame:
    """Every tenth document by crc32(doc_id): its words from one on are those of a cycle."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))

    def cycled(row):
        a = row["g"] % row["n"]
        p = F.lit(1) + F.floor((row["n"] - a) / (F.lit(3) + row["g"] % 8))
        place = F.transform(F.sequence(F.lit(0).cast("long"), row["n"] - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(place, lambda i: F.element_at(row["w"], (i + 1).cast("int"))), " ")

    changed = F.when((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"),
                     let(cycled, w=words, n=F.size(words).cast("long"), g=F.floor(h / 10)))
    return docs.withColumn("text", F.coalesce(changed, F.col("text")))


@register("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_tail_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return runs.find_runs(docs, carry=["doc_id"]).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register("op12_source_divergence", divergence.sql())
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@register("op13_threshold_mix", mixing.sql())
def op13_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, carry=["doc_id"]).drop("copies")


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
