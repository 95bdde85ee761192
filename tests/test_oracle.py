"""A sample of registered queries against their DuckDB oracle at sf0.001."""
import math

import duckdb
import pytest

from conftest import SMOKE
from skein.plans.catalog import REGISTRY
from skein.sources.fixtures import TABLES

SAMPLE = ["clean_text", "normalise", "slang_stats", "dedupe", "split_exact", "doc_top_terms", "vocabulary",
          "jaccard", "pair_metrics", "cosine_tfidf", "semantic_distance", "sentiment_score", "sentence_scores",
          "histogram", "hashtags", "enrich_with_topics", "assemble_threads", "flagship"]


def norm(v):
    if isinstance(v, float):
        r = round(v, 6)
        return f"{0.0 if r == 0 else r:.6f}"
    return "∅" if v is None else str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    q = REGISTRY[name]
    df = q.run(spark, SMOKE)
    res = con.sql(q.sql)
    assert sorted(df.columns) == sorted(res.columns)
    assert canon(df.columns, df.collect()) == canon(res.columns, res.fetchall())
    assert not math.isnan(len(df.columns))


WIDE_SCAN = ["pair_metrics", "evaluate_rollup", "sentence_scores", "cosine_tfidf", "key_phrases", "doc_top_terms"]


@pytest.mark.parametrize("name", WIDE_SCAN)
def test_wide_scan_plan_matches_oracle(spark, con, name, monkeypatch):
    """The plan a cluster runs: scans wide enough that ``spread`` leaves them
    alone, so the operators' own exchanges by key do the co-location."""
    from skein.sources import fixtures as fx
    monkeypatch.setattr(fx, "spread", lambda df, key=None: df)
    q = REGISTRY[name]
    df = q.run(spark, SMOKE)
    res = con.sql(q.sql)
    assert canon(df.columns, df.collect()) == canon(res.columns, res.fetchall())
