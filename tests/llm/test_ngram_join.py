import math
import random

import numpy as np

from skein.llm import ngram_join as nj
from skein.llm.graph import components


def grams(text, n=5):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows, threshold=0.8):
    sets = [grams(t) for _, t in rows]
    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if sets[i] == sets[j] or (union and len(sets[i] & sets[j]) >= threshold * union - 1e-9):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    members = {}
    for i in range(n):
        members.setdefault(root(i), []).append(i)
    least = lambda ids: min((k for k in ids if k is not None), default=None)
    out = []
    for i, (k, _) in enumerate(rows):
        same = [j for j in range(n) if sets[j] == sets[i]]
        out.append((k, least(rows[j][0] for j in members[root(i)]), least(rows[j][0] for j in same), len(same), links[i]))
    return sorted(out, key=str)


def fixture():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(4))
    rows = []
    for b in range(12):
        base = [word() for _ in range(rnd.choice([6, 30, 120]))]
        for _ in range(rnd.choice([1, 3, 12])):
            t = list(base)
            for _ in range(rnd.randrange(4)):
                t[rnd.randrange(len(t))] = word()
            rows.append((len(rows), " ".join(t)))
    big = [word() for _ in range(150)]
    for _ in range(60):
        t = list(big)
        for _ in range(rnd.randrange(5)):
            t[rnd.randrange(len(t))] = word()
        rows.append((len(rows), rnd.choice([" ", "\n", "  "]).join(t)))
    rows += [(1000 + i, rows[-1][1].upper()) for i in range(30)]
    return rows + [(2000, None), (2001, ""), (2002, " \n"), (2003, "One two"), (2004, "one TWO"), (None, rows[0][1]), (None, "alone here"),
                   (5, rows[5][1]), (5, "other text under the same key"), (2005, "long " * 20_000), (2006, "long " * 19_000)]


def test_against_brute_force(spark, monkeypatch):
    rows = fixture()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, class_id string, node int")
    want = brute(rows)
    for chunk in (400, 7):   # the large group in one cell, and in many
        monkeypatch.setattr(nj, "CHUNK_SETS", chunk)
        out = nj.join(df)
        assert out.columns == ["doc_id", "class_id", "copy_id", "n_copies", "n_links"]
        assert sorted((tuple(r) for r in out.collect()), key=str) == want
    assert max(w[4] for w in want) > 30


def test_one_of_each_class_stays(spark):
    rows = fixture()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, class_id string, node int")
    out = nj.deduplicated(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id for r in out.collect()), key=str)
    want = {(c[1], c[0] if c[1] is None else 0) for c in brute(rows)}
    assert got == sorted((c for c, _ in want), key=str)
    assert nj.deduplicated(df.limit(0)).collect() == [] and nj.join(df.limit(0)).collect() == []


def test_classes_with_the_same_least_key_each_keep_one(spark):
    rnd = random.Random(12)
    text = lambda: [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    a, b, c = text(), text(), text()
    near = lambda t: " ".join([*t[:-1], "changed"])
    rows = [(7, " ".join(a)), (8, near(a)), (7, " ".join(b)), (9, near(b)), (None, " ".join(c)), (None, near(c))]
    assert all(links == 1 for *_, links in brute(rows))
    got = nj.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id for r in got), key=str) == [7, 7, None]
    assert {rows[0][1], rows[2][1]} < {r.text for r in got}


def test_pruning_bound_is_the_posterior():
    # P(similarity >= t) under Beta(m + 1, n - m + 1), by a fine sum over the density.
    x = np.linspace(0, 1, 200_001)[1:-1]
    for n in (16, 64, 128):
        m = nj.least_matches(n, 0.8, 1e-3)
        for k, above in ((m, True), (m - 1, False)):
            if k >= 0:
                log = k * np.log(x) + (n - k) * np.log(1 - x) + math.lgamma(n + 2) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                assert (np.exp(log)[x >= 0.8].sum() / len(x) >= 1e-3) == above


def test_min_hashes_estimate_similarity():
    rnd = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        a = rnd.integers(0, 1 << 63, 200).astype(np.uint64)
        b = np.concatenate([a[:160], rnd.integers(0, 1 << 63, 40).astype(np.uint64)])
        errors.append((nj.min_hashes(a) == nj.min_hashes(b)).mean() - 160 / 240)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(80)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
