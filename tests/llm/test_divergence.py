"""The audit against plain counting, and the transducer against a sorted list."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from skein.llm import divergence
from skein.llm.automaton import Transducer

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=3, top=200):
    """The audit's rows of (text, lang, source), with Python's whole numbers."""
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        docs[lang].update(set(terms))
        count[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=str.encode)
        share = lambda c: [1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept]  # noqa: B023, E731
        whole = sum((count[lang, s] for s in sources), Counter())
        p, q = {s: share(count[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [(o, sum((a - b) ** 2 // b for a, b in zip(p[s], p[o]))) for o in sources if o != s]
            terms = [(t, (a - b) ** 2 // b) for t, a, b in zip(kept, p[s], q) if count[lang, s][t] and a > b]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:most])]
    return sorted(out)


def rows_of(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["der", "Die", "das", "é", "Éa", "x" * 90, "日本", "ſ", "K"] + ["".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(60)]
    rows = [(" 1-".join(rng.choices(vocabulary, k=rng.randint(0, 30))), rng.choice(["de", "en", "", None, "d\0e"]),
             rng.choices(["hot", "s1", "s2", None, "é"], [9, 2, 2, 1, 1])[0]) for _ in range(n)]
    return rows + [(None, "de", "s1"), ("", "empty", "a"), (None, "empty", "b"), ("once", "few", "a"), ("two", "few", "b")] + [rows[0]] * 40


def audit(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, source string, gid int, TERM int").repartition(5)
    out = divergence.audit(df, **more)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("resident,bucket,cells,tile", [(1 << 19, 1 << 16, 1 << 20, 512), (7, 40, 30, 2), (0, 1 << 16, 1, 1)])
def test_against_plain_counts(spark, monkeypatch, resident, bucket, cells, tile):
    for name, value in (("BUCKET", bucket), ("CELLS", cells), ("TILE", tile)):
        monkeypatch.setattr(divergence, name, value)
    rows = rows_of(resident)
    assert audit(spark, rows, resident=resident) == plain(rows)


def test_small_bounds_in_tasks(spark):
    """Least documents, a short list, and ties by bytes."""
    rows = [(f"{a} {b}", "en", s) for a in ("zz", "aa", "é") for b in ("mm", "nn") for s in "pqr"] + [("aa", "en", "p")]
    for least, top in ((1, 2), (6, 200), (99, 5)):
        assert audit(spark, rows, least_docs=least, top=top) == plain(rows, least, top)


def test_few_rows(spark):
    for rows in ([], [(None, None, None)], [("a b", "en", "s")] * 3):
        assert audit(spark, rows) == plain(rows)


def test_long_text_in_pieces():
    raw = b"ab " * 700_000 + b"\xc3\xa9" * 600_000 + b" cd"
    pieces = list(divergence._pieces(raw))
    assert b"".join(pieces) == raw and len(pieces) == 4
    assert set(b" ".join(pieces).split()) == set(raw.split())


def test_shares_are_exact():
    rng = random.Random(3)
    for _ in range(300):
        n, total, terms = rng.randint(0, 10**rng.randint(0, 15)), rng.randint(0, 10**rng.randint(0, 15)), rng.randint(1, 10**6)
        assert int(divergence.shares(np.array([n]), np.array([n + total]), terms)[0]) == 1 + 10**9 * (n + 1) // (n + total + terms)


def test_transducer():
    rng = random.Random(1)
    for _ in range(150):
        words = sorted({bytes(rng.choices(b"abc", k=rng.randint(0, 6))) for _ in range(rng.randint(0, 60))})
        t = Transducer(words)
        assert t.words() == words
        probe = [bytes(rng.choices(b"abcd", k=rng.randint(0, 7))) for _ in range(50)] + words
        lengths = np.array([len(p) for p in probe])
        starts = np.cumsum(lengths) - lengths
        got = t.find(np.frombuffer(b"".join(probe) + b"\0", dtype=np.uint8), starts, starts + lengths)
        assert got.tolist() == [words.index(p) if p in words else -1 for p in probe]
        # Minimal: one state for each set of possible endings.
        endings = {frozenset(w[i:] for w in words if w.startswith(x[:i])) for x in words for i in range(len(x) + 1)}
        assert len(t.ends) == max(1, len(endings))
