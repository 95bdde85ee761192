"""The driver's test tables and the derived fixtures built from them.

Every fixture is a lazy Spark plan over the given parquet tables, so its work
grows with them; the same definitions are written in SQL for the oracle.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# Row key of each text table: scans that come out narrower than the cluster
# are hash-partitioned on it, which also co-locates each document's rows for
# the per-document aggregates that follow.
KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "embeddings": "vec_id",
        "labels": "doc_id", "benchmark": "item_id"}


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-partition a scan that has fewer partitions than the session's
    default parallelism (e.g. a single large row group); wide scans - the
    normal case for many files - are returned untouched, with no shuffle."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df, KEYS.get(name)) if name in KEYS else df


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and raw web pages as one text table (kind, id, text)."""
    docs = table(spark, sf_dir, "documents").select(F.lit("doc").alias("kind"),
                                                     F.col("doc_id").alias("id"), "text")
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"),
                                                 F.col("page_id").alias("id"), F.col("html").alias("text"))
    return docs.unionByName(pages)


def first_line(c):
    return F.substring_index(c, "\n", 1)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """document = text, summary = its first line."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", "source", F.col("text").alias("document"),
                    first_line(F.col("text")).alias("summary"))


def pairs3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pairs + predicted_summary = first two lines joined by a space (lead-2)."""
    p = pairs(spark, sf_dir)
    lead2 = F.array_join(F.slice(F.split(F.col("document"), "\n"), 1, 2), " ")
    return p.withColumn("predicted_summary", lead2)


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn t joined to the assistant turn t+1 of the same conversation.
    Equi-join on the unique (conv_id, turn) key: no hot key can form."""
    c = table(spark, sf_dir, "conversations")
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("document"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("summary"))
    return u.join(a, ["conv_id", "turn"], "inner")


def embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    a = e.select(F.col("vec_id"), F.col("embedding").alias("a"))
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return a.join(b, "vec_id", "inner")


def nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with the text of document 0 set to null and of document 1 to ''."""
    d = table(spark, sf_dir, "documents")
    t = (F.when(F.col("doc_id") == 0, F.lit(None).cast("string"))
         .when(F.col("doc_id") == 1, F.lit("")).otherwise(F.col("text")))
    return d.withColumn("text", t)


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment lexicon derived from the corpus vocabulary (token, valence,
    kind): invented words carry no real polarity, so the valence is a hash of
    the token; tokens whose md5 starts with 00 are boosters, 01 negations."""
    d = table(spark, sf_dir, "documents")
    toks = (d.select(F.explode_outer(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), 0)).alias("token"))
            .filter(F.col("token").isNotNull()).distinct())
    h = F.md5(F.col("token"))
    hx = F.conv(F.substring(h, 1, 2), 16, 10).cast("int")
    kind = (F.when(F.substring(h, 1, 2) == "00", "booster")
            .when(F.substring(h, 1, 2) == "01", "negation").otherwise("word"))
    return toks.select("token", F.when(kind == "word", (hx % 9 - 4).cast("double")).alias("valence"),
                       kind.alias("kind"))


def topic_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, topic) with topic = doc_id mod 10: lets enrichment be checked
    without a fitted model."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", (F.col("doc_id") % 10).cast("int").alias("topic"))


SQL = {
    "corpus": ("SELECT 'doc' AS kind, doc_id AS id, text FROM documents "
               "UNION ALL SELECT 'page' AS kind, page_id AS id, html AS text FROM pages"),
    "pairs": ("SELECT doc_id, lang, source, text AS document, split_part(text, chr(10), 1) AS summary "
              "FROM documents"),
    "pairs3": ("SELECT doc_id, lang, source, text AS document, split_part(text, chr(10), 1) AS summary, "
               "array_to_string(string_split(text, chr(10))[1:2], ' ') AS predicted_summary FROM documents"),
    "turn_pairs": ("SELECT u.conv_id, u.turn, u.text AS document, a.text AS summary FROM conversations u "
                   "JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 "
                   "WHERE u.role = 'user' AND a.role = 'assistant'"),
    "embedding_pairs": ("SELECT a.vec_id, a.embedding AS a, b.embedding AS b FROM embeddings a "
                        "JOIN embeddings b ON b.vec_id = a.vec_id + 1"),
    "nulls": ("SELECT doc_id, CASE WHEN doc_id = 0 THEN NULL WHEN doc_id = 1 THEN '' ELSE text END AS text, "
              "lang, source, n_chars FROM documents"),
    "lexicon": ("SELECT token, CASE WHEN k = 'word' THEN CAST(hx % 9 - 4 AS DOUBLE) END AS valence, k AS kind "
                "FROM (SELECT token, CAST(concat('0x', substr(md5(token), 1, 2)) AS INTEGER) AS hx, "
                "CASE substr(md5(token), 1, 2) WHEN '00' THEN 'booster' WHEN '01' THEN 'negation' "
                "ELSE 'word' END AS k FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), "
                "'[\\p{L}\\p{N}_]+')) AS token FROM documents))"),
    "topic_assignment": "SELECT doc_id, CAST(doc_id % 10 AS INTEGER) AS topic FROM documents",
}
