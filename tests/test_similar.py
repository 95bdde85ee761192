"""Similar documents: exact lists against brute force, and the index's recall."""
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import similar_index as si
from skein.operators.similar import embed
from skein.sources import fixtures as fx


def brute(rows, k):
    """{query key: [(similar_id, n_rows, similarity)]} of rows (key, vector, asked)."""
    groups = defaultdict(list)
    for key, v, _ in rows:
        if v is not None and len(v) and any(v):
            groups[tuple(v)].append(key)
    least = {v: min(keys, key=lambda x: (x is None, x)) for v, keys in groups.items()}
    unit = {v: np.array(v) / np.linalg.norm(v) for v in groups}
    out = {}
    for key, v, asked in rows:
        if asked and key is not None and v is not None and tuple(v) in groups:
            near = [(-round(float(unit[tuple(v)] @ unit[w]), 6), (least[w] is None, least[w]), len(groups[w]) - (w == tuple(v)))
                    for w in groups if w != tuple(v) or len(groups[w]) > 1]
            out[key] = [(name[1], n, -s) for s, name, n in sorted(near)[:k]]
    return out


def lists(df, key="id"):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r[key], r["rank"])):
        out[r[key]].append((r.similar_id, r.n_rows, r.similarity))
    return dict(out)


def vectors(seed, n, dim=5):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, dim)], i % 7 == 0) for i in range(n)]
    rows += [(1000 + i, rows[7][1], i == 3) for i in range(40)]          # a group of copies with a query
    rows += [(None, rows[7][1], True), (2000, None, True), (2001, [], True), (2002, [0.0] * dim, True), (None, [9.0] * dim, False)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"BLOCK": 7, "QUERIES": 3}])
def test_exact_lists(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(si, name, value)
    rows = vectors(1, 150)
    df = spark.createDataFrame(rows, "id long, v array<double>, asked boolean").repartition(4)
    assert lists(si.similar(df, "id", "v", F.col("asked"), k=4, exact=True)) == brute(rows, 4)


def test_all_cells_and_split_cells(spark, monkeypatch):
    """Probing every cell is exact; a split hot cell still finds near neighbours in bounded blocks."""
    rows = vectors(2, 200)
    df = spark.createDataFrame(rows, "id long, v array<double>, asked boolean")
    want = brute(rows, 5)
    assert lists(si.similar(df, "id", "v", F.col("asked"), k=5, cells=8, probes=8)) == want
    monkeypatch.setattr(si, "HOT", 30)
    monkeypatch.setattr(si, "BLOCK", 16)
    got = lists(si.similar(df, "id", "v", F.col("asked"), k=5, cells=4, probes=4))
    assert got.keys() == want.keys()
    for key, near in got.items():
        assert len(near) == len({n[0] for n in near}) <= 5 and near == sorted(near, key=lambda x: -x[2])
    found = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert found >= 0.6 * sum(map(len, want.values()))


def test_empty(spark):
    df = spark.createDataFrame([], "id long, v array<float>")
    assert si.similar(df, "id", "v", F.col("id") % 2 == 0).count() == 0


def test_recall_on_documents(spark):
    docs = fx.table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    got = lists(si.similar_documents(docs, "doc_id", "text", F.col("doc_id") % 100 == 0), "doc_id")
    vec = [(r.doc_id, r.embedding, r.doc_id % 100 == 0) for r in embed(docs, "text").select("doc_id", "embedding").collect()]
    want = brute_fast(vec, 10)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    # A neighbour counts as found at the similarity of the true list's place or above.
    hits = sum(sum(s >= want[q][-1][2] - 1e-6 for _, _, s in got[q]) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def brute_fast(rows, k):
    x = np.array([v for _, v, _ in rows])
    keep = (x ** 2).sum(1) > 0
    distinct, at = np.unique(x[keep], axis=0, return_inverse=True)
    keys = np.array([key for key, _, _ in rows])[keep]
    count, unit = np.bincount(at.ravel()), distinct / np.linalg.norm(distinct, axis=1, keepdims=True)
    out = {}
    for key, c in zip(keys, at.ravel()):
        if key % 100 == 0:
            s = np.round(unit @ unit[c], 6)
            if count[c] == 1:
                s[c] = -np.inf
            out[int(key)] = [(None, None, v) for v in sorted(s.tolist(), reverse=True)[:k]]
    return out


def test_encoder_and_table_of_vectors(spark):
    from skein.operators.similar import embed_from_table
    from skein.plans.catalog import _trigram_encoder
    df = spark.createDataFrame([(1, "some text"), (1, "some text"), (2, ""), (None, None), (3, "é" * 5000)], "k int, t string")
    got = embed(df, "t", method="encoder", model=_trigram_encoder).collect()
    encode = _trigram_encoder()
    for r in got:
        assert r.embedding is None if r.t is None else np.allclose(r.embedding, encode(np.array([r.t]))[0])
    assert len(got) == 5
    vectors = spark.createDataFrame([(1, [2.0, 0.0]), (1, [1.0, 5.0]), (None, [9.0, 9.0])], "id int, v array<float>")
    rows = embed_from_table(df, "k", vectors, "id", "v").collect()
    assert sorted(map(str, ((r.k, r.embedding) for r in rows))) == sorted(map(str, [
        (1, [1.0, 5.0]), (1, [1.0, 5.0]), (2, None), (None, None), (3, None)]))


def test_word2vec_trains_in_as_many_parts_as_run_at_once(spark):
    """More shuffle partitions do not add models to move and average; the vocabulary is whole."""
    from skein.operators.similar import fit_word2vec
    rows = [(i, f"red green blue word{i % 40} once{i}") for i in range(300)] + [(300, None), (301, "")]
    df = spark.createDataFrame(rows, "k int, t string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    try:
        for partitions in (10 * cores, 1):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            m = fit_word2vec(df, "t", dim=4)
            assert m.getNumPartitions() == min(cores, partitions)
            assert {r.word for r in m.getVectors().collect()} == {"red", "green", "blue"} | {f"word{i}" for i in range(40)}
            every = fit_word2vec(df, "t", dim=4, min_count=1)
            assert every.getVectors().count() == 43 + 300
            got = {r.k: r.embedding for r in embed(df, "t", method="word2vec", dim=4, model=m).collect()}
            assert len(got) == 302 and got[300] == got[301] == [0.0] * 4 and any(got[0])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
