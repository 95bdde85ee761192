"""Pair metrics are row functions: repeated rows and null keys stay apart; all
pairs in one scan, the ranker and supplied summarisers against plain versions."""
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from skein.functions import tokens as tk
from skein.operators import quality as qa
from skein.operators import ranker as rk
from skein.plans.catalog import REGISTRY
from skein.sources import fixtures as fx


def grams(t, n):
    return Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1))


def plain(rr, rh, br, bh):
    """rouge1, rouge2 and bleu of token lists."""
    out = []
    for n in (1, 2):
        a, b = grams(rr, n), grams(rh, n)
        both = sum((a & b).values())
        p, r = both / max(sum(b.values()), 1), both / max(sum(a.values()), 1)
        out.append(2 * p * r / (p + r) if both else 0.0)
    ps = [sum((grams(br, n) & grams(bh, n)).values()) / max(len(bh) - n + 1, 1) for n in (1, 2, 3, 4)]
    bp = 1.0 if len(bh) > len(br) else math.exp(1 - len(br) / max(len(bh), 1))
    return [*out, bp * math.exp(sum(map(math.log, ps)) / 4) if all(ps) and bh else 0.0]


def test_equal_rows_and_null_keys_stay(spark):
    rows = [(1, "a b c d e", "a b c d")] * 3 + [(1, "x", "y"), (None, "a b", "a b"), (None, None, "a"), (2, "", None)]
    df = spark.createDataFrame(rows, "k int, ref string, hyp string").repartition(3)
    s = qa.score_pairs(df, "k", "ref", "hyp", rouge_l=True)
    got = sorted((str(r.k), round(r.rouge1, 4), round(r.bleu, 4)) for r in s.collect())
    assert len(got) == len(rows) and got.count(("1", round(8 / 9, 4), round(math.exp(-0.25), 4))) == 3
    e = qa.evaluate(s).first()
    assert e.n == len(rows) and e.rouge1 == pytest.approx((3 * 8 / 9 + 1) / len(rows))
    assert qa.score_pairs(df.limit(0), "k", "ref", "hyp").count() == 0


def test_no_shuffle_in_row_metrics(spark):
    df = spark.createDataFrame([(1, "a", "b")], "k int, ref string, hyp string")
    plan = qa.score_pairs(df, "k", "ref", "hyp", rouge_l=True, stem=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_overlap_counts_both_orders():
    a, b = "x y x y z x y".split(), "x y x x y q".split()
    for n in (1, 2, 3, 4, 9):
        assert qa.overlap(a, b, n) == qa.overlap(b, a, n) == sum((grams(a, n) & grams(b, n)).values())


def test_all_pairs_by_plain_counts(spark):
    p = fx.pairs3(spark, SMOKE)
    texts = {r.doc_id: r for r in p.select("doc_id", *[f(F.col(c)).alias(f"{k}_{c}") for k, f in (("r", tk.rouge_tokens), ("b", tk.symbol_tokens))
                                                       for c in ("document", "summary", "predicted_summary")]).collect()}
    got = REGISTRY["pair_metrics_all"].run(spark, SMOKE).collect()
    assert len(got) == 3 * len(texts)
    sides = {"doc_summary": ("document", "summary"), "summary_predicted": ("summary", "predicted_summary"),
             "doc_predicted": ("document", "predicted_summary")}
    for r in got:
        t, (a, b) = texts[r.doc_id], sides[r.pair]
        want = plain(t[f"r_{a}"], t[f"r_{b}"], t[f"b_{a}"], t[f"b_{b}"])
        assert [r.rouge1, r.rouge2, r.bleu] == pytest.approx(want, abs=2e-6)


def test_ranking_evaluation(spark):
    rows = [(1, 0, 0.9, 1.0, 0.2), (1, 1, 0.1, 0.0, 0.8), (2, 0, 0.3, 0.0, 0.5), (2, 1, 0.4, 1.0, 0.5), (3, 0, 0.5, 1.0, 0.1)]
    e = rk.ranking_evaluation(spark.createDataFrame(rows, "k int, spos int, rouge1 double, label double, p double"), "k").first()
    # Document 2: equal scores go to the first sentence.
    assert (e.n, e.accuracy_at_1) == (3, pytest.approx(1 / 3))
    assert e.rouge1_top == pytest.approx((0.1 + 0.3 + 0.5) / 3) and e.rouge1_lead1 == pytest.approx((0.9 + 0.3 + 0.5) / 3)
    assert e.rouge1_best == pytest.approx((0.9 + 0.4 + 0.5) / 3)


def test_ranker_learns(spark):
    """On held-out documents the ranker's pick is better than a sentence at random."""
    e = REGISTRY["ranker_evaluation"].run(spark, SMOKE).first()
    by_doc = REGISTRY["sentence_features"].run(spark, SMOKE).groupBy("doc_id").agg(F.avg("rouge1").alias("r"), F.avg("label").alias("a"))
    chance = by_doc.agg(F.avg("r").alias("r"), F.avg("a").alias("a")).first()
    assert e.n == 40 and e.accuracy_at_1 > 1.5 * chance.a and e.rouge1_best >= e.rouge1_top > 1.5 * chance.r


def test_supplied_summarisers(spark):
    def make():
        def first_word(t):
            if "bad" in t:
                raise ValueError("no")
            return t.split()[0]
        return first_word

    rows = [(1, "one two", "one", "x"), (1, "one two", "one", "x"), (2, "bad day", "bad", "y"), (None, None, "one", "y")]
    df = spark.createDataFrame(rows, "k int, text string, ref string, lang string")
    e = qa.evaluate_model(df, "k", "text", "ref", make).first()
    assert (e.n, e.n_failed) == (4, 1) and e.rouge1 == pytest.approx(0.5)
    by = {r.lang: r for r in qa.evaluate_model(df, "k", "text", "ref", make, by=["lang"]).collect()}
    assert (by["x"].n, by["x"].rouge1, by["y"].n_failed) == (2, 1.0, 1)
    two = REGISTRY["evaluate_summarisers"].run(spark, SMOKE).collect()
    assert {r.summariser for r in two} == {"lead_3", "frequent_3"} and all(r.n == 40 and r.n_failed == 0 for r in two)


def test_pieces_f1_by_plain_counts(spark):
    got = {r.doc_id: r.token_f1 for r in REGISTRY["token_f1_pieces"].run(spark, SMOKE).collect()}
    assert len(got) == 200 and all(0 <= x <= 1 for x in got.values())
    df = spark.createDataFrame([(["a", "##b", "a"], ["a", "c"]), ([], ["a"])], "r array<string>, h array<string>")
    assert [r[0] for r in df.select(tk.list_f1(F.col("r"), F.col("h"))).collect()] == [pytest.approx(0.4), 0.0]
