import random

import numpy as np
from pyspark.sql import functions as F

from skein.llm import quality

SCHEMA = "doc_id long, text string, score string, votes string"


def prose(rnd, n=60):
    w = [a + b for a in ("ri", "val", "sto", "brid", "peo", "wal", "tal", "un", "lo") for b in ("ver", "ley", "ne", "ge", "ple", "k", "der", "s", "ng")]
    return " ".join(rnd.choice(w) for _ in range(n)).capitalize() + "."


def junk(rnd):
    t = prose(rnd)
    return rnd.choice([
        " ".join(x.upper() + "!!" for x in t.split()), " | ".join(t.split()), " ".join(x + "%%%" for x in t.split()),
        " ".join([t.split()[0]] * 60)])


def test_estimate_finds_accuracies():
    # Two good labellers, three for faults; the sixth votes junk at random.
    rnd = np.random.default_rng(0)
    counts = {}
    for _ in range(4000):
        good = rnd.random() < 0.8
        row = ["-"] * len(quality.LABELLERS)
        for l, name in enumerate(quality.LABELLERS):
            says_good = quality.GOOD[l]
            if l == 5:
                row[l] = "0" if rnd.random() < 0.3 else "-"
            elif rnd.random() < (0.9 if says_good == good else 0.05):
                row[l] = "1" if says_good else "0"
        key = "".join(row)
        counts[key] = counts.get(key, 0) + 1
    posterior, accuracy = quality.estimate(counts)
    assert accuracy[5] < 0.7 and min(accuracy[quality.GOOD]) > 0.9
    assert posterior["-" * 9 + "11"] > 0.99
    assert max(v for k, v in posterior.items() if k.count("0") >= 4 and "1" not in k) < 0.01


def plain_estimate(counts, rounds=200):
    """Expectation-maximisation one pattern and one vote at a time."""
    accuracy, prior = [0.9] * len(quality.LABELLERS), 0.5
    for _ in range(rounds):
        post = {}
        for p in counts:
            good, bad = prior, 1 - prior
            for a, c in zip(accuracy, p):
                good *= {"1": a, "0": 1 - a, "-": 1}[c]
                bad *= {"1": 1 - a, "0": a, "-": 1}[c]
            post[p] = good / (good + bad)
        for l in range(len(accuracy)):
            right = sum(n * (post[p] if p[l] == "1" else 1 - post[p]) for p, n in counts.items() if p[l] != "-")
            cast = sum(n for p, n in counts.items() if p[l] != "-")
            accuracy[l] = min(max((right + 9) / (cast + 10), 0.55), 0.99)
        prior = min(max((sum(post[p] * n for p, n in counts.items()) + 1) / (sum(counts.values()) + 2), 0.05), 0.95)
    return post, accuracy


def test_estimate_against_plain_rounds():
    rnd = random.Random(8)
    counts = {"".join(rnd.choices("01-", [2, 3, 5], k=len(quality.LABELLERS))): rnd.randint(1, 50) for _ in range(60)}
    posterior, accuracy = quality.estimate(counts)
    post, acc = plain_estimate(counts)
    assert np.allclose(accuracy, acc, atol=1e-9) and all(abs(posterior[p] - post[p]) < 1e-9 for p in counts)


def test_scores_against_a_plain_scorer(spark):
    rnd = random.Random(9)
    rows = [(i, prose(rnd) if i % 4 else junk(rnd)) for i in range(200)] + [(500, ""), (501, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(df)
    text = dict(rows)
    for r in quality.score(df, model).collect():
        ids, _ = quality.Features([text[r.doc_id] or ""]).ids()
        z = model["intercept"] + (sum(model["weights"][i] for word in ids for i in word) / (3 * len(ids)) if len(ids) else 0.0)
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9 and r.keep == (r.score >= quality.KEEP)
        assert r.posterior == model["posterior"][r.votes]


def test_rejects_junk_and_keeps_prose(spark):
    rnd = random.Random(1)
    rows = [(i, prose(rnd), "x", None) for i in range(400)] + [(1000 + i, junk(rnd), "x", None) for i in range(80)]
    rows += [(None, None, None, None), (2000, "", None, None), (2001, "Short one.", None, None), (2002, prose(rnd, 30_000), None, None),
             (5, rows[5][1], "x", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = quality.classify(df)
    assert out.columns == ["doc_id", "text", "score", "keep", "posterior", "votes"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.keep == (r.score >= quality.KEEP)
        if r.doc_id is not None and 1000 <= r.doc_id < 2000:
            assert not r.keep, r.text[:80]
        elif r.doc_id is not None and (r.doc_id < 1000 or r.doc_id == 2002):
            assert r.keep, r.text[:80]
    assert {r.votes for r in got if not r.text} == {"-" * len(quality.LABELLERS)}
    assert quality.classify(df.limit(0)).collect() == []


def test_against_labels(spark):
    base = "/root/testdata/sf0.01/"
    docs, labels = spark.read.parquet(base + "documents.parquet"), spark.read.parquet(base + "labels.parquet")
    got = quality.classify(docs.select("doc_id", "text")).join(labels, "doc_id").select("quality", "keep").collect()
    bad, good = [r.keep for r in got if r.quality == 0], [r.keep for r in got if r.quality == 1]
    assert np.mean(bad) < 0.05 and np.mean(good) > 0.98


def test_sample_is_bounded_in_bytes_and_repeats_do_not_count(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, prose(rnd) if i % 3 else junk(rnd), None, "x") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = quality.fit(df)
    # One row a thousand times over changes the votes that EM counts, not the rows that train.
    seen = []
    train = quality._train
    monkeypatch.setattr(quality, "_train", lambda ids, shares, target: seen.append(len(ids)) or train(ids, shares, target))
    copies = df.unionByName(spark.range(1000).select(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(rows[0], df.dtypes)]))
    quality.fit(copies)
    quality.fit(df)
    assert seen == [300, 300]
    # A text that is too long alone is left out, the others stay.
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 1 << 20)
    long = spark.createDataFrame([(-1, prose(rnd, 300_000), None, "x")], SCHEMA)
    model = quality.fit(df.unionByName(long))
    assert seen[-1] == 300 and set(model["posterior"]) >= set(plain["posterior"])
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 4000)
    quality.fit(df)
    assert 0 < seen[-1] < 30
