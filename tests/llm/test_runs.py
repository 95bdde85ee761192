"""Periodic runs against a check of every stretch and period."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from skein.llm import runs
from skein.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=6, times=4):
    found = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            smallest = all(any(words[x] != words[x + r] for x in range(i, i + n - r)) for r in range(1, q))
            if n >= max(least, times * q) and smallest:
                found.append((i, n, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found))


def texts_of(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        while len(words) < rng.choice([0, 5, 40, 200]):
            unit = [rng.choice("abcde") for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 11, 19]))]
            if rng.random() < 0.3:
                unit = unit * rng.randint(2, 3) + [rng.choice("abcde")]
            times = rng.choice([0.7, 1, 2.5, 4, 4.3, 6, 9])
            words += (unit * 10)[:int(len(unit) * times)]
        out.append(words)
    return out


@pytest.mark.parametrize("least,times", [(6, 4), (1, 4), (30, 5), (9, 8)])
def test_every_run_and_no_other(least, times):
    texts = texts_of(least * 31 + times, 120)
    ids = np.array([ord(w) for t in texts for w in t], dtype=np.int64)
    got = runs.find(ids, np.cumsum([0, *map(len, texts)]), least, times)
    assert got == [plain_runs(t, least, times) for t in texts]
    assert sum(map(len, got)) > 20


def test_structured_words():
    """Words over two letters with many squares: Fibonacci, Thue-Morse, powers."""
    fib, tm = ["a", "ab"], "a"
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    while len(tm) < 300:
        tm += tm.translate(str.maketrans("ab", "ba"))
    texts = [fib[-1], tm, tm[:16] * 9, fib[6] * 7 + fib[7] * 5, "a" * 100, "ab" * 50 + "b" * 7, ("a" * 9 + "b") * 12, (tm[:8] * 4 + "c") * 5]
    ids = np.array([ord(w) for t in texts for w in t], dtype=np.int64)
    assert runs.find(ids, np.cumsum([0, *map(len, texts)])) == [plain_runs(t) for t in texts]


def test_scales_guarantee_a_seed():
    for least, times in ((6, 4), (1, 4), (50, 6)):
        behind = 0
        for low, high, k in runs.scales(5000, least, times):
            assert low == behind + 1 and k >= 2 * high or low == high
            assert all(max(least, times * q) - q >= k for q in range(low, high + 1))
            behind = high
        assert behind >= 5000 // times or least > 1


def test_no_run_across_texts():
    assert runs.find(np.zeros(10, dtype=np.int64), np.array([0, 5, 10])) == [[], []]
    with pytest.raises(ValueError):
        runs.find(np.zeros(10, dtype=np.int64), np.array([0, 10]), times=3)


def test_rows_of_any_kind(spark):
    texts = [None, "", " \n ", "a a a a a a", "a a a a a a", "x " * 3, "word " * 200_000, "é b " * 8]
    rows = [(None if i == 3 else i % 3, t, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, RUNS int").repartition(3)
    got = {r.collapsed: r for r in runs.find_runs(df).collect()}
    assert runs.find_runs(df).columns == ["doc_id", "text", *runs.OUTPUTS]
    assert got["a"].runs == [(0, 6, 1)] and got["word"].best == (0, 200_000, 1) and got["x x x"].best is None
    assert got["é b"].best == (0, 8, 1) and got[""].runs == [] and got[""].n_words == 0
    assert runs.find_runs(df).count() == len(texts)
    assert runs.find_runs(df.limit(0)).count() == 0


def test_query(spark):
    base = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(base + "/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op11_periodic_runs"](spark, base).collect()
    assert len(got) == len(docs) and sum(r.n_runs for r in got) > 3
    for r in got:
        words = WORD.findall(docs[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        number = {w: i for i, w in enumerate(words)}
        ids = np.array([number[w] for w in words], dtype=np.int64)
        found = plain_lags(ids)
        assert r.n_runs == len(found)
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        kept = np.ones(n, dtype=bool)
        for s, m, q in found:
            kept[s + q:s + m] = False
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for w, k in zip(words, kept) if k).encode()).hexdigest()


def plain_lags(ids):
    """All runs by comparing the text with itself at every lag."""
    found, held = [], set()
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]]).astype(np.int8)
        edge = np.flatnonzero(np.diff(same))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            n = e - s + q
            # A smaller period of the same stretch was found before, at a divisor of q.
            if n >= max(6, 4 * q) and (s, n) not in held:
                held.add((s, n))
                found.append((s, n, q))
    return sorted(found, key=lambda r: (r[0], r[2]))
