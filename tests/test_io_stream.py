"""Sources and sinks, model save/load, streaming = batch, entry contract."""
import os
import random
import re

from pyspark.sql import functions as F

from conftest import SMOKE
from skein.operators import summarise as su
from skein.sources import fixtures as fx
from skein.sources import io
from skein.streaming import threads as th


def test_json_union_by_name_and_csv_roundtrip(spark, scratch):
    a = spark.createDataFrame([("d1", "s1", ["x", "y"], ["1"])], io.THREAD)
    b = spark.createDataFrame([("d2", "s2", None, ["2", "3"])], io.THREAD)
    a.write.json(os.path.join(scratch, "p1.json"))
    b.write.json(os.path.join(scratch, "p2.json"))
    got = io.read_threads(spark, [os.path.join(scratch, "p1.json"), os.path.join(scratch, "p2.json")])
    assert got.count() == 2
    flat = io.flatten_arrays(got, {"ext_labels": ",", "rg_labels": ","})
    out = os.path.join(scratch, "clean.csv")
    io.write_threads(flat.withColumn("document", F.concat("document", F.lit("\nline2"))), out, fmt="csv")
    back = io.read_threads(spark, out, fmt="csv", schema=flat.schema)
    rows = sorted(back.collect())
    assert rows[0]["document"] == "d1\nline2" and rows[0]["ext_labels"] == "x,y" and rows[1]["ext_labels"] == ""


def test_suffix_filter(spark, scratch):
    d = os.path.join(scratch, "mixed")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('{"document": "x", "summary": "y"}\n')
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write('{"document": "z", "summary": "w"}\n')
    assert io.read_threads(spark, d, suffix="json").count() == 1


def test_model_save_load(spark, scratch):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import CountVectorizer, Tokenizer
    df = spark.createDataFrame([("a b c",), ("a b",)], "t string")
    m = Pipeline(stages=[Tokenizer(inputCol="t", outputCol="w"), CountVectorizer(inputCol="w", outputCol="v")]).fit(df)
    path = os.path.join(scratch, "model")
    io.save_model(m, path)
    again = io.load_model(path)
    assert again.stages[1].vocabulary == m.stages[1].vocabulary


def test_assemble_threads_order(spark):
    t = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, "b"), (2, 0, "z")], "conv_id int, turn int, text string")
    assert dict((r[0], r[2]) for r in th.assemble_threads(t).collect()) == {1: "a\nb\nc", 2: "z"}


COLS = ["doc_id", "summary", "share_url", "hashtag_line"]


def test_stream_equals_batch(spark, scratch):
    d = fx.table(spark, SMOKE, "documents").select("doc_id", "text")
    files = os.path.join(scratch, "in")
    d.repartition(3).write.parquet(files)
    idf = su.document_idf(th.thread_text(d, "doc_id", "text"), "thread").cache()
    sink, ckpt = th.sink_paths(scratch)
    th.thread_stream(spark, files, "*.parquet", d.schema, "doc_id", "text", sink, ckpt, idf, max_files=1)
    streamed = spark.read.parquet(sink)
    assert streamed.select("epoch").distinct().count() == 3
    batch = th.thread_batch(d, "doc_id", "text")
    assert sorted(streamed.select(*COLS).collect()) == sorted(batch.select(*COLS).collect())


def test_app_summaries_hold_the_preset(spark):
    d = fx.table(spark, SMOKE, "documents").select("doc_id", "text")
    threads = {r.doc_id: r.thread for r in th.thread_text(d, "doc_id", "text").collect()}
    got = th.thread_batch(d, "doc_id", "text").collect()
    assert len(got) == len(threads)
    long = 0
    for r in got:
        words = [w.lower() for w in r.summary.split()]
        n = len(re.findall(r"\w+", r.summary))
        assert n <= 160 and r.share_url.endswith(r.summary) and r.hashtag_line.count("#") <= 3
        long += n >= 70
    assert long > len(got) / 2   # the texts are long enough for most to reach 80 tokens


def test_replayed_epoch_and_rows_of_one_key(spark, scratch):
    rows = [(1, "One thread here. It has two parts."), (1, "Another Thread entirely. About Paris."), (1, "Another Thread entirely. About Paris."),
            (None, "A null key. Still a Row."), (2, "  "), (3, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    batch = th.thread_text(d, "doc_id", "text")
    idf = su.document_idf(batch, "thread")
    write = th.write_epoch(scratch + "/out", lambda b: th.thread_summaries(b, "doc_id", idf))
    for _ in range(2):   # the second is the same micro-batch again
        write(batch, 7)
    got = spark.read.parquet(scratch + "/out").select(*COLS)
    key = lambda r: str(tuple(r))
    assert got.count() == 4 and sorted(got.collect(), key=key) == sorted(th.thread_batch(d, "doc_id", "text").select(*COLS).collect(), key=key)
    assert sorted(r.summary for r in got.filter("doc_id = 1").collect())[0] == sorted(r.summary for r in got.filter("doc_id = 1").collect())[1]


def _turns():
    """Conversations of different lengths, with null texts, a repeated turn and a null key."""
    rng = random.Random(3)
    rows = []
    for c in [*range(30), None]:
        own = [(c, t, rng.choice([f"text {c} {t}", "", None])) for t in range(rng.randint(1, 9))]
        own += [own[0]] * (c == 4)
        rows += [(*r, len(own) if i == len(own) - 1 else None) for i, r in enumerate(own)]
    rng.shuffle(rows)
    return rows


def test_conversations_in_any_order(spark, scratch):
    rows = _turns()
    schema = "conv_id long, turn long, text string, n_turns long"
    df = spark.createDataFrame(rows, schema)
    source = os.path.join(scratch, "turns")
    for i in range(5):   # five files, one a micro-batch
        spark.createDataFrame(rows[i::5], schema).coalesce(1).write.mode("append").parquet(source)
    sink, ckpt = th.sink_paths(scratch)
    th.conversation_stream(spark, source, df.schema, sink, ckpt, max_files=1)
    got = spark.read.parquet(sink)
    assert got.filter("NOT complete").count() == 0
    key = lambda r: str(tuple(r))
    assert sorted(got.select("conv_id", "n_turns", "thread").collect(), key=key) == sorted(th.assemble_threads(df).collect(), key=key)
    # No state is left once every conversation has ended.
    assert spark.read.format("statestore").load(ckpt).count() == 0


def test_unfinished_conversation_stays_in_state(spark, scratch):
    schema = "conv_id long, turn long, text string, n_turns long"
    df = spark.createDataFrame([(1, 0, "a", None), (2, 1, "z", 2)], schema)
    source = os.path.join(scratch, "turns")
    sink, ckpt = th.sink_paths(scratch)
    df.write.parquet(source)
    th.conversation_stream(spark, source, df.schema, sink, ckpt)
    assert spark.read.format("statestore").load(ckpt).count() == 2
    spark.createDataFrame([(2, 0, "y", None)], schema).write.mode("append").parquet(source)   # late
    th.conversation_stream(spark, source, df.schema, sink, ckpt)
    assert [tuple(r)[:4] for r in spark.read.parquet(sink).select("conv_id", "n_turns", "thread", "complete").collect()] == [(2, 2, "y\nz", True)]
    assert spark.read.format("statestore").load(ckpt).count() == 1


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "rouge1" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
