"""Sentiment by blocks: a plain scorer beside it, and what moves."""
import re

from pyspark.sql import functions as F

from skein import fixed
from skein.operators import sentiment as se

ENTRIES = [("good", 2.0, "word"), ("good", 1.0, "word"), ("bad", -2.0, "word"), ("fine", 0.0, "word"), ("meh", None, "word"),
           ("both", 1.5, "word"), ("both", None, "booster"), ("very", None, "booster"), ("slightly", None, "dampener"),
           ("not", None, "negation"), ("not", None, "negation"), (None, 1.0, "word"), ("odd", 3.0, None)]


def plain(texts):
    """Score of the texts under one key, an entry at a time."""
    if any(t is None for t in texts):
        return None
    s, amp = 0.0, 0.0
    for text in texts:
        toks = [w.strip("!?'.") or w for w in text.split()]
        low, ups = [t.lower() for t in toks], [t.upper() == t and t.lower() != t for t in toks]
        mixed = any(ups) and not all(ups)
        amp = max(amp, min(text.count("!"), 4) * 0.292 + (0.96 if text.count("?") > 3 else 0.18 * text.count("?") if text.count("?") > 1 else 0))
        for i, t in enumerate(low):
            for v in [v for w, v, k in ENTRIES if w == t and k == "word" and v is not None]:
                ways = [(v + (mixed and ups[i]) * (0.733 if v > 0 else -0.733), 1.0)]
                sign = -1 if ways[0][0] < 0 else 1
                for d in (1, 2, 3):
                    kinds = [k for w, _, k in ENTRIES if i >= d and w == low[i - d] and k not in ("word", None)] or [None]
                    ways = [(x + sign * fixed.SENT_BOOST_DECAY[d - 1] * ({"booster": 0.293, "dampener": -0.293}[k] + 0.733 * (mixed and ups[i - d]))
                             if k in ("booster", "dampener") else x, m * (-0.74 if k == "negation" else 1)) for x, m in ways for k in kinds]
                but = low.index("but") if "but" in low else i
                s += sum(x * m for x, m in ways) * (0.5 if i < but else 1.5 if i > but else 1)
    s += amp if s > 0 else -amp if s < 0 else 0
    return round(s / (s * s + 15) ** 0.5, 4)


def test_blocks_against_a_plain_scorer(spark, monkeypatch):
    words = "good VERY bad not but fine 'BOTH' meh slightly x GOOD odd! ?? BUT Very".split()
    rows = [(i // 2 if i % 10 == 0 else None if i % 37 == 0 else i + 1000,
             None if i % 41 == 0 else " ".join(words[(i * (j + 3) + j * j) % len(words)] for j in range(i % 13)) + "!" * (i % 6) + "?" * (i % 5))
            for i in range(400)]
    df = spark.createDataFrame(rows, "k long, t string")
    lexicon = spark.createDataFrame(ENTRIES, "token string, valence double, kind string")
    by_key = {}
    for k, t in rows:
        by_key.setdefault(k, []).append(t)
    want = {k: plain(ts) for k, ts in by_key.items()}
    for size in (se.BLOCK_BYTES, 500):
        monkeypatch.setattr(se, "BLOCK_BYTES", size)
        got = {r.k: r.score for r in se.sentiment_long(df, "k", ["t"], lexicon).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == want[k] or abs(got[k] - want[k]) < 1.5e-4 for k in want)


def test_tokens_are_chunks_without_outer_punctuation(spark):
    texts = ["", " a ", "'tis don't!! :-) (B)\u0085c", "é1_ ́x́ 😀😀y 😀", "--\ta--b--\n-- --", None, "!\x0b?a"]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in d.select(F.regexp_extract_all("t", F.lit(se.TOKEN), 0)).collect()]
    word = re.compile(r"[^\W]")
    for t, toks in zip(texts, got):
        if t is not None:
            chunks = [c for c in re.split(r"[ \t\n\r\f\x0B]+", t) if c]
            at = [[i for i, x in enumerate(c) if word.match(x)] for c in chunks]
            assert toks == [c[i[0]:i[-1] + 1] if i else c for c, i in zip(chunks, at)]


def test_tokens_do_not_move_one_by_one(spark):
    """The lexicon is met once, by the distinct tokens of a block, at any size of it."""
    df = spark.createDataFrame([(i, "good bad good") for i in range(300)], "k long, t string")
    lexicon = spark.createDataFrame(ENTRIES, "token string, valence double, kind string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = se.sentiment_long(df, "k", ["t"], lexicon)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin [") == 1 and "hashpartitioning(block" in plan
