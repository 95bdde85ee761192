import zlib

import numpy as np
from pyspark.sql import functions as F

from skein.llm import toxicity
from skein.llm.queries import QUERIES


def test_gradients_are_right():
    rnd = np.random.default_rng(0)
    m = toxicity.Model()
    m.trained, m.out = True, rnd.normal(0, 1, len(m.out)).astype(np.float32)
    m.table = rnd.normal(0, 0.5, m.table.shape).astype(np.float32)
    docs = [rnd.integers(0, 50, (n, 3)).astype(np.int32) for n in (9, 1, 5, 0)]
    y = np.array([1, 0, 1, 0], dtype=np.float32)

    def loss():
        first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        z = m.pooled(np.concatenate(docs), first).astype(float) @ m.out + m.bias
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    grads, db = m._gradients(docs, y)
    for p, g in zip([m.table, *m.filters, m.out], grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at], 1e-3
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 2e-3 + 0.05 * abs(g[at])
    assert np.isfinite(db)


def test_pooling_against_one_text_at_a_time():
    rnd = np.random.default_rng(1)
    m = toxicity.Model()
    m.trained = True
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rnd.choice(words, n)) for n in (1, 2, 3, 50, 0, 7)]
    alone = np.concatenate([m.scores([t]) for t in texts])
    assert np.allclose(m.scores(texts), alone, atol=1e-6)
    assert np.allclose(m.scores([t.upper() for t in texts]), alone, atol=1e-6)


def plain_logit(m, words):
    """One text, one filter and one place at a time."""
    x, z = [sum(m.table[r] for r in w) for w in words], m.bias
    for k, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            places = [sum(float(x[i + j] @ m.filters[k][j][:, f]) for j in range(width)) for i in range(len(x) - width + 1)]
            z += m.out[k * toxicity.FILTERS + f] * max([0, *places])
    return z


def test_trained_model_against_plain_scoring():
    rnd = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rnd.choice(words, n)) + (" vile slur" if n % 3 == 0 else "") for n in range(1, 46)]
    y = np.array([n % 3 == 0 for n in range(1, 46)], dtype=np.float32)
    rows, first = toxicity.word_rows(texts)
    docs = [rows[a:b] for a, b in zip(first, first[1:])]
    models = [toxicity.Model() for _ in range(2)]
    for i, m in enumerate(models):
        m.train(docs[i::2], y[i::2])
    assert np.allclose([plain_logit(models[0], d) for d in docs], models[0].logits(rows, first), atol=1e-3)
    mean = np.array([np.mean([plain_logit(m, d) for m in models]) for d in docs])
    got = toxicity.Ensemble(models, 0.7, -0.2).scores(texts)
    assert np.allclose(got, 1 / (1 + np.exp(-(0.7 * mean - 0.2))), atol=1e-3)
    assert got[y == 1].min() > got[y == 0].max()


def test_calibration():
    rnd = np.random.default_rng(4)
    z = rnd.normal(0, 3, 20_000)
    y = (rnd.random(len(z)) < 1 / (1 + np.exp(-(0.6 * z + 0.8)))).astype(float)
    slope, shift = toxicity.calibrated(z, y)
    assert abs(slope - 0.6) < 0.05 and abs(shift - 0.8) < 0.1
    # Separable, reversed and constant logits keep a rising, finite curve.
    for x, t in ((z, (z > 0) * 1.0), (-z, (z > 0) * 1.0), (np.zeros(50), (np.arange(50) < 5) * 1.0), (z * 1e6, y)):
        slope, shift = toxicity.calibrated(x, t)
        assert 0 < slope < 100 and abs(shift) < 100


def test_threshold():
    assert 0.3 < toxicity.best_threshold(np.array([0.9, 0.8, 0.3, 0.1]), np.array([1, 1, 0, 0])) < 0.8


def test_degenerate_inputs(spark):
    docs = spark.createDataFrame([(1, None, None, "c"), (None, "x", "en", "c"), (2, "", "en", "c"), (2, "", "en", "c")],
                                 "doc_id long, text string, lang string, score string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.score(docs, *toxicity.fit(docs, labels, F.lit(True)))
    assert out.columns == ["doc_id", "text", "lang", "score", "flagged", "threshold"]
    assert [r.score for r in out.collect()] == [0.0] * 4
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, *toxicity.fit(docs, one, F.lit(True))).collect()} == {1.0}
    empty = docs.limit(0)
    assert toxicity.score(empty, *toxicity.fit(empty, labels, F.lit(True))).collect() == []


def test_held_out_documents(spark):
    base = "/root/testdata/sf0.1"
    got = QUERIES["op5_toxicity_cnn"](spark, base).collect()
    assert len(got) == spark.read.parquet(base + "/documents.parquet").count()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(base + "/labels.parquet").collect()}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(toxic[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in toxic]
    assert np.mean([p for y, p in held if y == 1]) > 0.9 and np.mean([p for y, p in held if y == 0]) < 0.03


def test_one_oversized_text_does_not_end_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 50_000)
    keys = sorted(range(400), key=lambda k: (zlib.crc32(str(k).encode()), str(k)))
    bad = set(keys[1::4])
    rows = [(k, ("vile slur here" if k in bad else "calm plain words") + f" w{k % 7}", "en") for k in keys]
    rows[0] = (keys[0], "long " * 20_000, "en")   # comes first and does not fit
    rows.append((keys[2], "long " * 20_000, "en"))   # a second text under a key, too long with it
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k in bad)) for k in keys], "doc_id long, toxic int")
    model, thresholds = toxicity.fit(docs, labels, F.lit(True))
    assert model.trained
    got = toxicity.score(docs, model, thresholds).collect()
    toxic, clean = ([r.score for r in got if (r.doc_id in bad) == want and len(r.text) < 100] for want in (True, False))
    assert np.mean(toxic) > np.mean(clean) + 0.2


def test_thresholds_count_every_labelled_row(spark, monkeypatch):
    rows = [(i, f"plain words number {i % 7} here" + (" vileword" if i % 5 == 0 else ""), "en", int(i % 5 == 0)) for i in range(600)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    seen = []
    kept = toxicity.best_threshold
    monkeypatch.setattr(toxicity, "best_threshold", lambda s, y, n=None: seen.append((len(s) if n is None else n.sum(), y.sum())) or kept(s, y, n))
    toxicity.fit(docs, labels, F.lit(True), sample=40)   # far fewer rows train
    assert seen == [(600, 120), (600, 120)]


def test_texts_stay_where_they_are(spark):
    """One pass over the texts, the labels meet numbers only; the same as fit and score."""
    rows = [(i, f"plain words number {i % 7} here" + (" vileword" if i % 5 == 0 else ""), "en" if i % 3 else None, "x") for i in range(600)]
    rows += [rows[5], (None, "vileword", "en", "x"), (10, None, "de", "x")]
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, z string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    learn = F.col("doc_id") % 4 != 2
    want = toxicity.score(docs, *toxicity.fit(docs, labels, learn, sample=40)).drop("text").collect()
    counted = docs.withColumn("text", F.udf(look, "string").asNondeterministic()("text"))
    got = toxicity.classify(counted, labels, learn, sample=40)
    assert got.columns == ["doc_id", "lang", "z", "score", "flagged", "threshold"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want))
    assert seen.value <= 3 * len(rows)   # the sample's sizes, its texts, all logits
    models, folds, _ = toxicity.classifiers(docs, labels, learn, sample=40)
    passed = toxicity.logits(docs, models, folds)   # this is what meets the labels
    assert "Exchange" not in passed._jdf.queryExecution().executedPlan().toString()
    assert passed.columns == ["row", "k", "lang", "z", "unseen"] and "text" not in passed.schema["row"].dataType.names
