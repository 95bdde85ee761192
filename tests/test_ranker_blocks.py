"""The ranker's parts: ROUGE of many sentences at once, what a loaded ranker needs."""
import sys
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from skein import session
from skein.operators import quality as qa
from skein.operators import ranker as rk
from skein.operators import summarise as su


def test_a_loaded_ranker_needs_no_reference(spark, scratch, monkeypatch):
    d = spark.createDataFrame([(i, f"First line {i}. Second one has more words. Third.", f"second one {i}") for i in range(20)], "k int, t string, y string")
    idf = su.document_idf(d, "t")
    rk.save_ranker(rk.fit_on(d, "k", "t", "y", idf), idf, scratch + "/r")
    with_reference = rk.sentence_features(d, "k", "t", "y", idf).drop("rouge1", "label")

    def none(*_):
        raise AssertionError("ROUGE of no reference")
    monkeypatch.setattr(rk, "rouge1_each", none)
    without = rk.sentence_features(d, "k", "t", None, idf)
    assert sorted(without.drop("rouge1", "label").collect()) == sorted(with_reference.collect())
    assert without.filter("rouge1 IS NOT NULL OR label IS NOT NULL").count() == 0
    assert rk.load_ranker(spark, scratch + "/r", 2)(d, "k", "t").count() == 20


def test_overlaps_of_many_rows_at_once():
    rows = [(["a", "b", "a"], [["a", "a", "a"], [], ["b", "x"]]), ([], [["a"]]), (["x"], None), (["q", "a"], []), (["b"], [["b"], ["a", "b"]])] * 60
    got = qa._unigram_overlaps.func(pa.array([r for r, _ in rows], pa.list_(pa.string())),
                                    pa.array([h for _, h in rows], pa.list_(pa.list_(pa.string())))).to_pylist()
    assert got == [None if h is None else [sum((Counter(r) & Counter(x)).values()) for x in h] for r, h in rows]


def test_the_idf_of_a_saved_ranker_is_made_once(spark, monkeypatch):
    from conftest import SMOKE
    from skein.plans import catalog
    made = []
    monkeypatch.setattr(rk, "save_ranker", lambda model, idf, path: made.append(idf.inputFiles()) or sys.exit())
    try:
        catalog.evaluate_loaded(spark, SMOKE)
    except SystemExit:
        pass
    assert made[0] and all("skein-idf-" in f for f in made[0])   # a written table, for the fit and the folder


def test_features_leave_their_partition_once(spark):
    d = spark.createDataFrame([(k, f"Word{k} the cat. The other dog.", "the cat") for k in range(30)], "k int, t string, y string")
    df = rk.sentence_features(d, "k", "t", "y", spark.createDataFrame([("cat", 2.0)], "term string, idf double"))
    assert df.count() == 60
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in plan and plan.count("ReusedExchange") == 1
