import hashlib

import pytest
from pyspark.sql import functions as F
from test_decontaminate import least_edits
from test_exact_dedup import lowered
from test_ngram_join import brute

import corpus_pipeline
from skein.llm import quality
from skein.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before each stage, and at last the tokens."""
    docs = spark.read.parquet(SF + "/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF)
        rows = kept.collect()
        out.append(rows)
        docs = spark.createDataFrame(rows, kept.schema)
    return out


def test_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_classifier", "exact_copies", "near_copies", "benchmark_leaks", "tokens"]


def test_columns_stay(stages):
    assert all(r.__fields__ == COLUMNS for rows in stages[1:5] for r in rows)


def test_quality_stage_follows_its_scores(spark, stages):
    docs = spark.read.parquet(SF + "/documents.parquet")
    want = {r.doc_id for r in quality.classify(docs).filter(F.col("score") >= quality.KEEP).collect()}
    assert {r.doc_id for r in stages[1]} == want and len(want) < len(stages[0])


def test_exact_stage(stages):
    best = {}
    for r in stages[1]:
        best[lowered(r.text)] = max(best.get(lowered(r.text), -1), r.doc_id)
    assert sorted(r.doc_id for r in stages[2]) == sorted(best.values())


def test_near_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages[2]]
    assert sorted(r.doc_id for r in stages[3]) == sorted({c[1] for c in brute(rows)})


def test_benchmark_stage(spark, stages):
    items = [r.text for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
    left = {r.doc_id for r in stages[4]}
    for r in stages[3]:
        near = [t for t in items if any(t[i:i + 12].lower() in r.text.lower() for i in range(0, len(t), 12))]
        assert (r.doc_id in left) == (not any(least_edits(t, r.text) <= len(t) // 10 for t in near))


def test_token_stage(stages):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_file())
    texts = {r.doc_id: r.text for r in stages[4]}
    assert {r.doc_id for r in stages[5]} == set(texts)
    for r in stages[5]:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages(spark, stages):
    got = QUERIES["pipeline"](spark, SF).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in got) == sorted((r.doc_id, r.ids_sha256) for r in stages[5])


def test_odd_inputs(spark):
    rows = [(1, None, "en", None, None, "a", 1), (1, None, "en", None, None, "a", 1), (None, "", None, None, None, "b", 2),
            (2, "word " * 60_000, "en", "s", 5, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, row int")
    for odd in (docs, docs.limit(0)):
        n = odd.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, odd, SF)
            kept = out.collect()
            assert len(kept) <= n
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
