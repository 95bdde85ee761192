"""Queries that read every line of a text, and its extractive summary."""
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from skein.functions import tokens as tk
from skein.plans import catalog
from skein.plans.catalog import REGISTRY
from test_oracle import canon


@pytest.mark.parametrize("name", ["key_phrases_text", "hashtags_text", "hashtag_counts_text"])
def test_whole_texts_match_oracle(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMOKE}/documents.parquet')")
    df, res = REGISTRY[name].run(spark, SMOKE), con.sql(REGISTRY[name].sql)
    assert canon(df.columns, df.collect()) == canon(res.columns, res.fetchall())


def test_phrases_come_from_all_lines(spark):
    head = {r.doc_id: r.at for r in REGISTRY["key_phrases"].run(spark, SMOKE).groupBy("doc_id").agg(F.max("first_pos").alias("at")).collect()}
    whole = {r.doc_id: r.at for r in REGISTRY["key_phrases_text"].run(spark, SMOKE).groupBy("doc_id").agg(F.max("first_pos").alias("at")).collect()}
    later = sum(whole[k] > at for k, at in head.items())
    assert later > len(head) / 2


def test_metrics_of_whole_texts_by_plain_counts(spark):
    pairs = catalog._summaries(spark, SMOKE)
    rows = pairs.select("doc_id", tk.rouge_tokens(F.col("document")).alias("r"), tk.rouge_tokens(F.col("text")).alias("h"),
                        "document").collect()
    got = {r.doc_id: r for r in REGISTRY["pair_metrics_text"].run(spark, SMOKE).collect()}
    assert len(got) == len(rows) == spark.read.parquet(f"{SMOKE}/documents.parquet").count()
    for r in rows:
        for n, name in ((1, "rouge1"), (2, "rouge2")):
            a, b = (Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1)) for t in (r.r, r.h))
            both = sum((a & b).values())
            p, q = both / max(sum(b.values()), 1), both / max(sum(a.values()), 1)
            assert got[r.doc_id][name] == pytest.approx(2 * p * q / (p + q) if both else 0.0, abs=2e-6)
    assert sum(r.document.count("\n") > 1 for r in rows) > len(rows) / 2
    tags = {r.doc_id: r.hashtag_line for r in REGISTRY["hashtags_summary"].run(spark, SMOKE).collect()}
    assert set(tags) == set(got)
    e = REGISTRY["evaluate_rollup_text"].run(spark, SMOKE).filter("lang is null and source is null").collect()
    assert e[0].n == len(rows) and e[0].rouge1 == pytest.approx(sum(g.rouge1 for g in got.values()) / len(got), abs=2e-6)
