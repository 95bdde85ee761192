"""Summarisers behind one interface, a saved ranker, and mergeable hashtag states."""
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import quality as qa
from skein.operators import ranker as rk
from skein.operators import summarise as su
from skein.operators import tags as tg
from skein.sources import fixtures as fx

SMOKE = "/root/testdata/sf0.001"


def test_saved_ranker_picks_as_the_fitted_one(spark, scratch):
    p = fx.pairs(spark, SMOKE)
    idf = su.document_idf(p, "document")
    model = rk.fit_on(p, "doc_id", "document", "summary", idf)
    rk.save_ranker(model, idf, scratch + "/ranker")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "One here. Two there.")], "doc_id long, document string")
    docs = p.select("doc_id", "document").unionByName(odd)
    got = {r.doc_id: r.summary for r in rk.load_ranker(spark, scratch + "/ranker", 2)(docs, "doc_id", "document").collect()}
    assert len(got) == docs.count() and got[-1] == got[-2] == ""
    scored = model.transform(rk.sentence_features(p, "doc_id", "document", "summary", idf)).collect()
    texts = {(r.doc_id, r.i): r.s for r in p.select("doc_id", F.posexplode(rk.sentences(F.col("document"))).alias("i", "s")).collect()}
    best = {}
    for r in scored:
        best.setdefault(r.doc_id, []).append((-r.probability[1], r.spos))
    for key, found in best.items():
        assert got[key] == " ".join(texts[key, i] for i in sorted(s for _, s in sorted(found)[:2]))


def test_one_interface(spark):
    df = spark.createDataFrame([(1, "A b c. D e f.", "A b c."), (2, None, "x y"), (3, "", "z")], "k int, t string, ref string")

    def first():
        def run(t):
            if not t:
                raise ValueError("empty")
            return t.split(".")[0] + "."
        return run

    e = qa.evaluate_summariser(df, "k", "t", "ref", su.supplied(first)).first()
    assert e.n == 3 and e.rouge1 == pytest.approx(1 / 3)
    by = qa.evaluate_summariser(df, "k", "t", "ref", su.supplied(first), by=["ref"])
    assert by.count() == 3
    assert qa.evaluate_summariser(df, "k", "t", "ref", su.extractive("pipeline")).first().n == 3
    assert qa.evaluate_summariser(df.limit(0), "k", "t", "ref", su.extractive("pipeline")).first().n == 0


def test_states_roll_up_within_their_bound(spark, scratch):
    rng = np.random.default_rng(5)
    rows = [(f"g{int(g)}", f"s{int(s)}", [f"#{int(x)}" for x in rng.zipf(1.3, 3) % 5000])
            for g, s in zip(rng.integers(0, 2, 6000), rng.integers(0, 4, 6000))]
    rows += [("g0", None, []), ("g1", "s0", None), (None, "s1", ["#1"]), ("g0", "s0", [None])]
    df = spark.createDataFrame(rows, "g string, s string, hashtags array<string>")
    exact = {}
    for g, _, tags in rows:
        exact.setdefault(g, Counter()).update(t for t in tags or [] if t is not None)
    for tracked, right in ((64, False), (10_000, True)):
        path = f"{scratch}/{tracked}"
        tg.tag_states(df, ["g", "s"], tracked).write.parquet(path)
        got = tg.trending(spark.read.parquet(path), ["g"], 10, tracked).collect()
        for g, counts in exact.items():
            own = sorted((r for r in got if r.g == g), key=lambda r: r["rank"])
            assert len(own) == min(10, len(counts)) and [r["rank"] for r in own] == list(range(1, len(own) + 1))
            assert all(counts[r.tag] <= r.n <= counts[r.tag] + (0 if right else r.n_over) for r in own)
            listed = {r.tag for r in own}
            assert all(n <= own[-1].n + (0 if right else own[-1].n_over) for t, n in counts.items() if t not in listed)
    assert tg.trending(tg.tag_states(df.limit(0), ["g", "s"]), ["g"]).count() == 0
