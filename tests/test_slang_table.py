"""Slang by a table: equal to the dictionary's regex, in the rows and by the join."""
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from skein import fixed
from skein.functions import text as tx
from skein.operators import slang as sl

KEYS = {"a": "1", "a b": "2", "a-b": "3", "b": "<a>", "-a": "4", "b-": "5", "a b c": "6", "cc": "", "b a": "7"}


def plain(text, mapping):
    """The alternation as a regex, on ASCII texts."""
    pat = re.compile(r"\b(" + "|".join(re.escape(k) for k in mapping) + r")\b")
    return pat.sub(lambda m: mapping[m.group(1)], text), [m.group(1) for m in pat.finditer(text)]


@pytest.mark.parametrize("limit", [sl.LIMIT, -1])
@pytest.mark.parametrize("order", [1, -1])
def test_equal_to_a_regex(spark, limit, order):
    mapping = dict(list(KEYS.items())[::order])
    rng = random.Random(3)
    texts = ["".join(rng.choice("aabbc -") for _ in range(rng.randrange(14))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts + texts[:5]], "t string")
    got = sl.expand_slang_table(df, "t", sl.slang_table(spark, mapping), limit=limit).collect()
    assert sorted((r.t, r.expanded, r.slang_hits) for r in got) == sorted((t, *plain(t, mapping)) for t in texts + texts[:5])


@pytest.mark.parametrize("limit", [sl.LIMIT, -1])
def test_equal_to_the_dictionary(spark, limit):
    rows = ["u.s. r/x fré", "vibe check, cap/no cap idk", "ú r", "", None, "  lol", "lol!", "(u) (u", "ſus sus_ sus", "‍u u‍"]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    got = sl.expand_slang_table(df, "t", sl.slang_table(spark, fixed.SLANG), limit=limit)
    want = df.select("t", tx.expand_slang(F.col("t")).alias("expanded"), tx.slang_hits(F.col("t")).alias("slang_hits"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("limit", [sl.LIMIT, -1])
def test_nulls_ties_and_clashing_names(spark, limit):
    table = spark.createDataFrame([("x", "late", 9), ("x", "b", 1), ("x", "a", 1), (None, "n", 0), ("", "e", 0), ("y", None, 2)],
                                  "slang string, expansion string, place long")
    df = spark.createDataFrame([("x y", "old", 1), ("x y", "old", 1), (None, None, None)], "t string, Expanded string, runs int")
    got = sl.expand_slang_table(df, "t", table, limit=limit)
    assert got.columns == ["t", "runs", "expanded", "slang_hits"]
    assert sorted(map(str, got.collect())) == sorted(map(str, [*spark.createDataFrame(
        [("x y", 1, "a ", ["x", "y"])] * 2 + [(None, None, None, None)], "t string, runs int, expanded string, slang_hits array<string>").collect()]))
    assert sl.expand_slang_table(df.limit(0), "t", table, limit=limit).count() == 0
    assert sl.expand_slang_table(df, "t", table.limit(0), limit=limit).filter("expanded <=> t").count() == 3


def test_fifty_thousand_entries(spark):
    n = 50_000
    table = spark.range(n).select(F.concat(F.lit("w"), F.col("id")).alias("slang"), F.concat(F.lit("x"), F.col("id")).alias("expansion"),
                                  F.col("id").alias("place"))
    index = sl.Index([(f"w{i}", i, f"x{i}", 1) for i in range(n)], [f"w{i}" for i in range(n)])
    runs = [r for i in range(200_000) for r in (f"w{i % (2 * n)}", " ")]
    start = time.time()
    assert len(index.find(runs, True)) == 100_000 and time.time() - start < 5
    df = spark.createDataFrame([(" ".join(f"w{i}" for i in range(0, 2 * n, 7)),)], "t string")
    got = sl.expand_slang_table(df, "t", table).first()
    assert got.expanded == " ".join((f"x{i}" if i < n else f"w{i}") for i in range(0, 2 * n, 7))


def test_stretches_of_a_text_meet_the_table_once():
    from skein.operators.slang import _stretches
    assert _stretches(["u", " ", "u", " ", "lol"], True, [(1, True)]) == {"u": [0, 2], "lol": [4]}
    assert _stretches(["(", "u", " ", "b", ")"], False, [(3, True), (1, False)]) == {"u b": [1], " ": [2]}
