"""Rows and values that must not be lost: null and repeated keys, NaN, untouched model input."""
import math

from pyspark.sql import functions as F

from skein.operators import dist, prep
from skein.operators.sentiment import sentiment_long
from skein.operators.summarise import summarise_with
from skein.operators.terms import batched, word_pieces


def test_exact_split_of_one_repeated_key(spark):
    df = spark.createDataFrame([(1, "same")] * 10, "k long, x string")
    train, test = prep.split_exact(df, "k", 0.2)
    assert (train.count(), test.count()) == (8, 2)


def test_splits_keep_null_keys(spark):
    df = spark.createDataFrame([(i if i % 5 else None, i) for i in range(20)], "k long, x int")
    for exact in (True, False):
        train, test = (prep.split_exact if exact else prep.split_approx)(df, "k", 0.2)
        assert sorted(r.x for r in train.union(test).collect()) == list(range(20))
        if exact:
            assert test.count() == math.ceil(0.2 * 20)
        marked = prep.split_column(df, "k", 0.2, exact=exact).collect()
        assert {r.x for r in marked if r.split == "test"} == {r.x for r in test.collect()}


def test_row_ids_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert len({r.row_id for r in prep.with_row_id(df, ["a", "b"]).collect()}) == 2


def test_histogram_leaves_nan_out(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3)] + [(float("nan"),)], "x double")
    rows = dist.histogram(df, ["x"], 4).collect()
    assert sum(r.n for r in rows) == 4 and len(rows) == 4 and max(r.hi for r in rows) == 3


def test_quantiles_are_exact(spark):
    values = [float(i * i % 977) for i in range(3000)]
    df = spark.createDataFrame([(v, -v) for v in values], "a double, b double")
    got = {r.series: r.q for r in dist.metric_quantiles(df, ["a", "b"], (0.25, 0.5, 0.9)).collect()}
    for name, xs in (("a", sorted(values)), ("b", sorted(-v for v in values))):
        assert got[name] == [xs[math.ceil(p * len(xs)) - 1] for p in (0.25, 0.5, 0.9)]


def test_supplied_model_sees_the_text_itself(spark):
    df = spark.createDataFrame([(1, "line one\nline  two. x"), (2, None)], "k long, t string")
    same = {r.k: r.summary for r in summarise_with(df, "k", "t", lambda: lambda t: t).collect()}
    assert same == {1: "line one\nline  two. x", 2: None}
    cut = {r.k: r.summary for r in summarise_with(df, "k", "t", lambda: lambda t: t, max_in=3).collect()}
    assert cut == {1: "line one\nline", 2: None}


def test_batches_have_their_size(spark):
    out = batched(spark.range(95).repartition(3), 10).groupBy("partition", "batch").agg(F.count("*").alias("n")).collect()
    assert sum(r.n for r in out) == 95
    for p in {r.partition for r in out}:
        sizes = [r.n for r in sorted(out, key=lambda r: r.batch) if r.partition == p]
        assert all(s == 10 for s in sizes[:-1]) and 0 < sizes[-1] <= 10


def test_long_words_keep_their_text():
    pieces = word_pieces(["ab" * 300], {"a", "##a", "##b", "##ab"})
    assert "".join(p.removeprefix("##") for p in pieces) == "ab" * 300


def test_sentiment_on_real_text(spark):
    lexicon = spark.createDataFrame([("good", 2.0, "word"), ("don't", None, "negation"), (":)", 1.5, "word"), ("very", None, "booster"),
                                     ("slightly", None, "dampener")], "token string, valence double, kind string")
    texts = ["I don't like good", "fine :)", "(good)!", "very good", "slightly good", "VERY good", "so good"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = {r.k: r.score for r in sentiment_long(df, "k", ["t"], lexicon).collect()}
    compound = lambda s: round(s / math.sqrt(s * s + 15), 4)
    want = [2 * -0.74, 1.5, 2 + 0.292, 2 + 0.293, 2 - 0.293, 2 + 0.293 + 0.733, 2]
    assert got == {k: compound(s) for k, s in enumerate(want)}
