"""Steps that large tables run through: how often rows are read and made, and plain counts beside them."""
import math
import os
from collections import Counter

from pyspark.sql import functions as F

from skein.functions import text as tx
from skein.functions import tokens as tk
from skein.operators import quality as qa
from skein.operators import summarise as su
from skein.operators import tfidf as tf
from skein.operators import topics as tp
from skein.plans.catalog import REGISTRY

SMOKE = "/root/testdata/sf0.001"


def counted(spark, df, column):
    """``df`` with a column that counts how often a row is made."""
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x
    return df.withColumn(column, F.udf(look, "string").asNondeterministic()(column)), seen


def test_stream_reads_a_folder_of_files(spark, scratch):
    d = spark.createDataFrame([(1, "One thread here. It has two parts."), (2, "About Paris. And more.")], "doc_id long, text string")
    d.repartition(2).write.parquet(os.path.join(scratch, "documents.parquet"))
    assert sorted(r.doc_id for r in REGISTRY["thread_stream"].run(spark, scratch).collect()) == [1, 2]


def test_cleaning_is_done_once_a_row(spark):
    d = spark.createDataFrame([("see u @me LOL",)], "t string")
    plan = d.select(tx.normalise_col(F.col("t")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("http") == 1


def test_slang_with_and_without_the_mark(spark):
    texts = ["u and lol", "lol", "", None, "\x01u\x01", "a\x01 u lol b", "no hit", "u u", "btw, u"]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = [None if t is None else t.replace("lol", "laughing out loud").replace("btw", "by the way") for t in texts]
    plain = [None if t is None else " ".join("you" if w == "u" else w for w in t.split(" ")).replace("\x01u\x01", "\x01you\x01") for t in plain]
    assert [r[0] for r in d.select(tx.expand_slang(F.col("t"))).collect()] == plain


def test_topic_fit_tokenises_once(spark):
    d = spark.range(40).select(F.concat_ws(" ", *[F.concat(F.lit(f"word{i}x"), (F.col("id") % (i + 2)).cast("string")) for i in range(6)]).alias("t"))
    d, seen = counted(spark, d, "t")
    m = tp.fit_topics(d, "t", k=2, iters=5, vocab_size=50)
    assert seen.value <= 2 * 40
    assert len(m.stages) == 4 and tp.dominant_topic(m, d, "t").count() == 40


def test_one_text_against_many_is_the_same_as_pairs(spark):
    d = spark.createDataFrame([(1, "a b c d", ["a b", "x", "", "d d a"]), (2, None, ["a"]), (3, "q", []), (4, "a", None)], "k int, r string, h array<string>")
    each = d.select("k", F.posexplode(qa.rouge1_each(F.col("r"), F.col("h"))).alias("i", "x"))
    rows = d.select("k", "r", F.posexplode("h").alias("i", "one"))
    pairs = qa.score_pairs(rows, "k", "r", "one", rouge_orders=(1,), bleu=False, carry=["i"]).select("k", "i", "rouge1")
    assert sorted(each.collect()) == sorted(pairs.collect()) and each.count() == 5


def test_stems_and_subsequence_beside_the_counts(spark):
    d = spark.createDataFrame([(1, "running dogs jumped over houses", "a dog jumps over the running house")] * 200, "k int, r string, h string")
    got = qa.score_pairs(d, "k", "r", "h", rouge_l=True, stem=True).select("rouge1", "rougeL").distinct().collect()
    # run dog jump over hous | a dog jump over the run hous: 5 in common, 4 in order
    assert len(got) == 1
    assert abs(got[0].rouge1 - 2 * 1.0 * (5 / 7) / (1.0 + 5 / 7)) < 1e-9
    assert abs(got[0].rougeL - 2 * (4 / 5) * (4 / 7) / (4 / 5 + 4 / 7)) < 1e-9


def test_terms_go_to_their_idf_once_a_document(spark):
    texts = {1: ["the cat the dog", "the end", "..."], 2: ["cat cat"]}
    rows = [(k, i, s) for k, ss in texts.items() for i, s in enumerate(ss)]
    sents = spark.createDataFrame(rows, "k int, spos int, sentence string")
    idf = spark.createDataFrame([("the", 1.5), ("cat", 2.0)], "term string, idf double")
    got = su.term_places(sents, "k", idf)
    want = []
    for k, ss in texts.items():
        whole = Counter(" ".join(ss).replace("...", "").split())
        for i, s in enumerate(ss):
            own = Counter(s.replace("...", "").split())
            want += [(k, i, c, whole[t], {"the": 1.5, "cat": 2.0}.get(t), True) for t, c in own.items()] or [(k, i, 1, 1, None, False)]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.select("k", "spos", "c", "t", "idf", "known").collect()), key=key) == sorted(want, key=key)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list") > plan.index("Join LeftOuter")   # gathered below the join


def test_cosine_sends_a_term_once_for_all_columns(spark):
    rows = [(1, "a b b", "b c", ""), (2, "c d", "c d", "x"), (None, "a", "a", "a"), (3, None, "a", "b")]
    d = spark.createDataFrame(rows, "k int, x string, y string, z string")
    pairs = (("xy", "x", "y"), ("xz", "x", "z"))
    got = tf.cosine_tfidf(d, "k", ["x", "y", "z"], pairs, "x", lambda c: F.split(F.coalesce(c, F.lit("")), " "))
    df = Counter(t for _, x, *_ in rows for t in set((x or "").split(" ")))
    idf = {t: math.log(5 / (1 + n)) + 1 for t, n in df.items()}

    def cosine(a, b):
        u, v = ({t: c * idf[t] for t, c in Counter((x or "").split(" ")).items() if t in idf} for x in (a, b))
        size = math.sqrt(sum(x * x for x in u.values())) * math.sqrt(sum(x * x for x in v.values()))
        return sum(x * v.get(t, 0.0) for t, x in u.items()) / size if size else 0.0
    want = {k: (0.0, 0.0) if k is None else (cosine(x, y), cosine(x, z)) for k, x, y, z in rows}
    assert {r.k: (round(r.xy, 9), round(r.xz, 9)) for r in got.collect()} == {k: tuple(round(x, 9) for x in v) for k, v in want.items()}
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_pieces_are_dealt_to_rows_by_distinct_words(spark):
    from skein.operators.terms import word_pieces, wordpiece
    pieces = {"ab", "a", "##a", "b", "##b"}
    assert word_pieces(["abba"], pieces, 3) == ["ab", "##b", "##a"]   # the longest piece is given, not looked for again
    v = spark.createDataFrame([(x,) for x in pieces], "piece string")
    rows = [(1, ["abba", "b", "abba"]), (2, []), (3, None), (4, ["x", ""]), (5, ["b"])]
    got = wordpiece(spark.createDataFrame(rows, "k int, t array<string>").coalesce(1), "t", v)
    plain = {k: None if t is None else word_pieces(t, pieces) for k, t in rows}
    assert {r.k: r.pieces for r in got.collect()} == plain
