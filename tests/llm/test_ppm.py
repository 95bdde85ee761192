import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import ppm
from skein.llm.queries import QUERIES
from skein.llm.vec import Table


class Plain:
    """The same model by dictionaries, one byte at a time."""

    def __init__(self, texts, order):
        self.order, self.trie = order, defaultdict(Counter)
        for t in texts:
            b = b"\xff" * order + t.encode() + b"\xff"
            for i in range(order, len(b)):
                for j in range(order + 1):
                    self.trie[b[i - j:i]][b[i]] += 1

    def chance(self, context, symbol):
        p, excluded = 1.0, set()
        for j in range(self.order, -1, -1):
            seen = {s: c for s, c in self.trie.get(context[self.order - j:], {}).items() if s not in excluded}
            if not seen:
                continue
            n = sum(seen.values())
            if symbol in seen:
                return p * (2 * seen[symbol] - 1) / (2 * n)
            p *= len(seen) / (2 * n)
            excluded |= set(seen)
        return p / (256 - len(excluded))

    def score(self, text):
        b = b"\xff" * self.order + text.encode() + b"\xff"
        return sum(math.log10(self.chance(b[i - self.order:i], b[i])) for i in range(self.order, len(b)))


def base(texts, train):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) + [None]
    counts = Counter(w for t in train for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return n, [(len(words(t)), sum(counts[w] > 0 for w in words(t)), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)))
               for t in texts]


def test_plain_model_is_a_distribution():
    m = Plain(["abracadabra", "abba", ""], 2)
    for context in (b"\xff\xff", b"ab", b"zz", b"ra"):
        assert abs(sum(m.chance(context, s) for s in range(256)) - 1) < 1e-9


@pytest.mark.parametrize("order,grams,words", [(2, 20, 3), (5, 50, 10), (5, 1 << 20, 1 << 18)])
def test_against_plain_model(spark, order, grams, words):
    rnd = random.Random(order)
    pool = ["the", "The", "theta", "abc", "été", "ß", "日本", "x!", "\t", "\n"]
    texts = [" ".join(rnd.choice(pool) for _ in range(rnd.randrange(12))) for _ in range(80)] + ["", None, "new bytes: Ωµ~", "q" * 5000]
    rows = [(i if i % 9 else None, t, i % 4 != 0, 1) for i, t in enumerate(texts)] + [(3, texts[3], True, 1)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean, rid int")
    got = ppm.score(df, F.col("train"), order=order, grams=grams, words=words).collect()
    train = [t or "" for _, t, k, _ in rows if k]
    n, want_base = base([t or "" for _, t, _, _ in rows], train)
    model = Plain(train, order)
    want = sorted((str(k), l, b[0], b[1], n, round(b[2], 6), round(model.score(t or ""), 6)) for (k, t, l, _), b in zip(rows, want_base))
    assert Counter((str(r.doc_id), r.learned, r.train_tokens) for r in got) == Counter(w[:2] + (n,) for w in want)
    for a, b in zip(sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in got),
                    sorted((w[0], w[2], w[3], w[5], w[6]) for w in want)):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-5) and a[4] == pytest.approx(b[4], abs=1e-5)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    r = ppm.score(df, F.lit(False)).collect()[0]
    assert r.score == pytest.approx(-3 * math.log10(256)) and (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (2, 0, 0, 0)
    assert ppm.score(df.limit(0), F.lit(True)).collect() == []


def test_table():
    rnd = np.random.default_rng(0)
    keys = rnd.choice(1 << 40, 5000, replace=False).astype(np.uint64)
    t = Table(keys[:4000], np.arange(4000))
    values, held = t.get(keys)
    assert held.tolist() == [True] * 4000 + [False] * 1000 and values[:4000].tolist() == list(range(4000))


def test_better_than_the_baseline_on_held_out_texts(spark):
    got = QUERIES["op8_ppm_scores"](spark, "/root/testdata/sf0.1").collect()
    assert len(got) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
