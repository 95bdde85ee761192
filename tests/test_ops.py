"""Operators: sampling and splits, dedupe, profile, histogram, sentiment rules."""
import math

from pyspark.sql import functions as F

from conftest import SMOKE
from skein import fixed
from skein.operators import dist, prep, sentiment
from skein.sources import fixtures as fx
from skein.sources import io


def test_sample_n_exact_and_stable(spark):
    d = fx.table(spark, SMOKE, "documents")
    a = [r[0] for r in prep.sample_n(d, 50, "doc_id").select("doc_id").collect()]
    b = [r[0] for r in prep.sample_n(d, 50, "doc_id").select("doc_id").collect()]
    assert len(a) == 50 and sorted(a) == sorted(b)
    assert prep.sample_n(d, 10 ** 6, "doc_id").count() == d.count()


def test_split_exact_disjoint_complete(spark):
    d = fx.table(spark, SMOKE, "documents").select("doc_id")
    n = d.count()
    train, test = prep.split_exact(d, "doc_id", 0.2, 42)
    tr = {r[0] for r in train.collect()}
    te = {r[0] for r in test.collect()}
    assert len(te) == math.ceil(0.2 * n) and not tr & te and len(tr | te) == n


def test_split_exact_radix_path(spark, monkeypatch):
    monkeypatch.setattr(prep, "_SELECT_FINAL", 3)
    d = spark.range(0, 500).withColumnRenamed("id", "k")
    train, test = prep.split_exact(d, "k", 0.3, 7)
    ref = sorted(range(500), key=lambda k: (__import__("hashlib").md5(f"{k}:7".encode()).hexdigest(), k))[:150]
    assert sorted(r[0] for r in test.collect()) == sorted(ref)
    assert train.count() == 350


def test_metric_quantiles_exact_ranks(spark):
    vals = [((i * 37) % 101) / 7.0 for i in range(301)]
    df = spark.createDataFrame([(v, -v) for v in vals], "x double, y double")
    got = {r["series"]: list(r["q"]) for r in dist.metric_quantiles(df, ["x", "y"], [0.1, 0.5, 0.9]).collect()}
    for name, col in (("x", vals), ("y", [-v for v in vals])):
        s = sorted(col)
        assert got[name] == [s[math.ceil(p * len(s)) - 1] for p in (0.1, 0.5, 0.9)]


def test_split_approx_partitions_rows(spark):
    d = fx.table(spark, SMOKE, "documents").select("doc_id")
    train, test = prep.split_approx(d, "doc_id", 0.2)
    assert train.count() + test.count() == d.count()
    assert not {r[0] for r in train.collect()} & {r[0] for r in test.collect()}


def test_dedupe_keeps_smallest_key(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y")], "id int, text string")
    assert sorted(io.dedupe(df, ["text"], "id").select("text", "id").collect()) == [("x", 1), ("y", 2)]


def test_profile_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "id int, t string")
    rows = {r["column"]: (r["type"], r["non_null"], r["nulls"]) for r in io.profile(df).collect()}
    assert rows == {"id": ("int", 2, 0), "t": ("string", 1, 1)}


def test_histogram_sums_to_n(spark):
    df = spark.range(0, 97).select((F.col("id") / 7.0).alias("x"), (F.col("id") % 5).alias("y"))
    h = dist.histogram(df, ["x", "y"], bins=10)
    totals = {r[0]: r[1] for r in h.groupBy("series").agg(F.sum("n")).collect()}
    assert totals == {"x": 97, "y": 97}
    assert h.filter("series = 'x'").count() == 10


def test_density_integrates_to_about_one(spark):
    df = spark.range(0, 400).select(((F.col("id") % 41) / 20.0 - 1.0).alias("s"))
    d = dist.density(df, ["s"], -3.0, 3.0, 301).collect()
    step = 6.0 / 300
    assert abs(sum(r["y"] for r in d) * step - 1.0) < 0.02


def _lex(spark):
    rows = [("good", 2.0, "word"), ("bad", -2.0, "word"), ("very", None, "booster"), ("not", None, "negation")]
    return spark.createDataFrame(rows, "token string, valence double, kind string")


def _compound(s, amp=0.0):
    if s > 0:
        s += amp
    elif s < 0:
        s -= amp
    return round(s / math.sqrt(s * s + fixed.SENT_ALPHA), 4)


def test_sentiment_rules(spark):
    texts = {1: "good", 2: "very good", 3: "not good", 4: "good but bad", 5: "GOOD day", 6: "good!!",
             7: "nothing here", 8: None, 9: "very nice good"}
    df = spark.createDataFrame(list(texts.items()), "k int, t string")
    got = {r["k"]: r["score"] for r in sentiment.sentiment_long(df, "k", ["t"], _lex(spark)).collect()}
    assert got[1] == _compound(2.0)
    assert got[2] == _compound(2.0 + 0.293)
    assert got[3] == _compound(2.0 * -0.74)
    assert got[4] == _compound(2.0 * 0.5 + -2.0 * 1.5)
    assert got[5] == _compound(2.0 + 0.733)
    assert got[6] == _compound(2.0, 2 * 0.292)
    assert got[7] == 0.0 and got[8] is None
    assert got[9] == _compound(2.0 + 0.293 * 0.95)
