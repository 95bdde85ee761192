"""Sentence scoring by blocks: sums against a plain version, what moves, what is written."""
import math
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skein import session
from skein.operators import summarise as su
from skein.streaming import threads as th

ROWS = [(1, "The cat sat. The dog ran away!\nA cat"), (1, "Dog and dog. ..."), (2, "One line only"), (3, ""), (4, None), (5, "... !"),
        (None, "A null key here. Cat."), (None, "Cat again."), *[(k, f"Word{k} the word. The other word{k % 7}.") for k in range(10, 60)]]
IDF = {"the": 1.5, "cat": 2.0, "dog": 0.5, "word": 3.0, "word3": 1.25, "null": None}


def plain():
    """{(key, spos): [n, tf_mass, mass, both, own, [sentences]]} of the rows that share a key as one text."""
    found = {}
    for k, t in ROWS:
        for i, s in enumerate(x for x in (y.strip(" ") for y in re.sub(r"([.!?])[ \n]+|\n+", "\\1\x01", t or "").split("\x01")) if x):
            c, texts = found.setdefault((k, i), (Counter(), []))
            c.update(x for x in re.findall(r"\w+", s.lower()) if len(x) > 1)
            texts.append(s)
    whole = {}
    for (k, _), (c, _) in found.items():
        whole.setdefault(k, Counter()).update(c)
    w = lambda t: IDF.get(t) or 0.0
    return {(k, i): [sum(c.values()), *[sum(f(n, whole[k][t], w(t)) for t, n in c.items()) for f in (
        lambda c, t, w: t * w, lambda c, t, w: c * w, lambda c, t, w: c * t * w * w, lambda c, t, w: c * c * w * w)], sorted(texts)]
        for (k, i), (c, texts) in found.items()}


@pytest.mark.parametrize("block_bytes", [16 << 20, 40])
def test_sums_of_a_key_in_any_block(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(su, "BLOCK_BYTES", block_bytes)
    d = spark.createDataFrame(ROWS, "k int, t string")
    idf = spark.createDataFrame(list(IDF.items()), "term string, idf double")
    rows = su.sentence_sums(d, "k", "t", idf, lambda s: F.transform(s, lambda x: F.struct(x.alias("x")))).collect()
    want, got = plain(), {}
    assert len(rows) == len({r.k for r in rows})
    for r in rows:
        assert math.isclose(r.whole, sum(v[3] for (k, _), v in want.items() if k == r.k), abs_tol=1e-9)
        for s in r.s:
            v = got.setdefault((r.k, s.spos), [s.n, *[round(s[x], 9) for x in ("tf_mass", "mass", "both", "own")], []])
            v[-1].append(s.e.x)
    assert {k: [*v[:-1], sorted(v[-1])] for k, v in got.items()} == {k: [v[0], *[round(x, 9) for x in v[1:5]], v[5]] for k, v in want.items()}


def test_terms_meet_their_idf_once_a_block(spark):
    d = spark.createDataFrame([r for r in ROWS if r[0] is not None], "k int, t string")
    idf = spark.createDataFrame(list(IDF.items()), "term string, idf double")
    df = su.sentence_scores(d, "k", "t", idf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in plan and "SortMergeJoin [k" not in plan
    assert plan.count("ReusedExchange") == 1   # texts move once, for the terms and for the sums


def test_copies_count_once_and_leave_where_they_are_read():
    batches = [pa.record_batch({"k": ["a", "b", "a", None], "t": ["1", "2", "1", "0"]}), pa.record_batch({"k": ["b", "c", None], "t": ["2", "3", "0"]})]
    assert [b.to_pydict()["k"] for b in su._first_seen(batches)] == [["a", "b", None], ["c"]]


def test_equal_threads_are_written_once(spark, monkeypatch):
    names = []
    monkeypatch.setattr(th, "written", lambda df, name: names.append((name, df.count())) or session.written(df, name))
    text = "One thread here. It has Two parts."
    d = spark.createDataFrame([(i, text) for i in range(40)] + [(40, "Another thread."), (41, "()")], "k long, t string")
    got = {r.k: tuple(r)[1:] for r in th.thread_batch(d, "k", "t").collect()}
    assert names == [("threads", 42), ("summaries", 2)]   # no copy of the distinct threads, none of a thread without sentences
    assert len(got) == 42 and len({got[i] for i in range(40)}) == 1 and got[0][0] == text
    assert got[41][0] == "" and got[41][2] == ""


def test_written_tables_are_packed(spark):
    at = session.written(spark.range(10), "packed").inputFiles()
    assert at and all(f.endswith(".zstd.parquet") for f in at)
