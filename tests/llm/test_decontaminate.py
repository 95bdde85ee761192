import random
import time
import tracemalloc

import numpy as np

from skein.llm import decontaminate as dc
from skein.llm.queries import QUERIES

ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then it sleeps under the old oak tree."),
         (2, "Ünïcödé passages are compared by character, not by byte, é à ü ß and so on until the end."), (3, "tiny"), (4, None), (5, "")]


def least_edits(item, text):
    """Sellers' algorithm: the whole item against any stretch of the text,
    the full table row by row."""
    a, b = dc.folded(item), dc.folded(text)
    at = np.arange(len(b) + 1)
    row = np.zeros(len(b) + 1, dtype=int)
    for c in a:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (b != c))
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())


def edited(rnd, text, n):
    out = list(text)
    for _ in range(n):
        at, kind = rnd.randrange(len(out)), rnd.randrange(3)
        if kind == 0:
            out[at] = rnd.choice("xyzé")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rnd.choice("xyz "))
    return "".join(out)


def test_every_edited_passage_within_budget_and_no_other():
    rnd = random.Random(5)
    index = dc.Items(ITEMS)
    filler = " ".join(rnd.choice(["ore", "the", "fox", "old", "under", "passages", "end", "é"]) for _ in range(40))
    texts, want = [], []
    for _ in range(60):
        item = rnd.choice(ITEMS[:2])
        text = filler[:rnd.randrange(120)] + edited(rnd, item[1], rnd.randrange(14)) + filler[:rnd.randrange(120)]
        texts.append(text)
        want.append({i for i, t in ITEMS[:2] if least_edits(t, text) <= len(t) // 10})
    got = index.find(texts)
    assert [{h[0] for h in x} for x in got] == want
    assert 10 < sum(map(bool, want)) < 60
    for text, hits in zip(texts, got):
        for i, start, end, edits in hits:
            item = dict(ITEMS)[i]
            assert edits == least_edits(item, text)
            assert least_edits(item, text[start:end]) <= edits


def test_never_across_texts():
    index = dc.Items(ITEMS)
    t = ITEMS[0][1]
    assert index.find([t[:40], t[40:]]) == [[], []]
    assert [len(x) for x in index.find(["", t + t, "tiny", "tiny tiny", t.upper()])] == [0, 2, 1, 0, 1]


def plain_bands(index, text):
    """Shared q-grams of every band, pair by pair."""
    codes, out = dc.folded(text), {}
    for i, item in enumerate(index.texts):
        step, cells = int(index.k[i]) + 1, {}
        places = {}
        for y in range(len(item) - dc.Q + 1):
            places.setdefault(item[y:y + dc.Q].tobytes(), []).append(y)
        for x in range(len(codes) - dc.Q + 1):
            for y in places.get(codes[x:x + dc.Q].tobytes(), ()):
                cells[(x - y) // step] = cells.get((x - y) // step, 0) + 1
        good = [b for b, n in cells.items() if n + cells.get(b + 1, 0) >= index.bound[i]]
        if good:
            out[i] = sorted(good)
    return out


def bands(index, text):
    h = dc.grams(dc.folded(text))
    which = np.minimum(np.searchsorted(index.grams, h), len(index.grams) - 1)
    at = np.flatnonzero(index.grams[which] == h)
    return {i: sorted(b.tolist()) for i, b in index._bands(at, which[at])}


def test_bands_of_repetitive_texts(monkeypatch):
    items = [(1, "a" * 120), (2, "ab" * 60), (3, "a" * 40 + "b" * 60), (4, "xyz " * 30), (5, ITEMS[0][1])]
    texts = ["a" * 700, "ab" * 300, "a" * 90 + "b" * 90 + "ab" * 90, "xyz " * 100 + "a" * 200, ITEMS[0][1] * 3, "b" * 50, ""]
    index = dc.Items(items)
    want = [plain_bands(index, t) for t in texts]
    assert sum(map(len, want)) > 6
    for run, pairs in ((4096, 4 << 20), (5, 64), (1, 1000)):
        monkeypatch.setattr(dc, "RUN", run)
        monkeypatch.setattr(dc, "PAIRS", pairs)
        assert [bands(index, t) for t in texts] == want


def test_a_long_run_of_one_character():
    index = dc.Items([(1, "a" * 500), (2, ITEMS[0][1])])
    tracemalloc.start()
    begin = time.perf_counter()
    hits = index.find(["a" * 1_000_000])[0]
    assert time.perf_counter() - begin < 30 and tracemalloc.get_traced_memory()[1] < 1 << 30
    tracemalloc.stop()
    assert len(hits) > 1000 and {h[0] for h in hits} == {1} and all(h[2] - h[1] == 500 and h[3] == 0 for h in hits)


def test_text_item_ids(spark):
    bench = spark.createDataFrame([("mmlu/7", ITEMS[0][1]), (None, ITEMS[1][1])], "item_id string, text string")
    df = spark.createDataFrame([(1, "x " + ITEMS[0][1]), (2, ITEMS[1][1]), (3, "clean")], "doc_id long, text string")
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in dc.scan(df, bench).collect()}
    assert got == {1: (True, ["mmlu/7"]), 2: (True, [None]), 3: (False, [])}


def test_blocks_and_clashing_columns(spark, monkeypatch):
    rows = [(1, "x " + ITEMS[0][1] + " y " + ITEMS[1][1], "h"), (None, None, "h"), (2, "", "h"), (3, "clean " * 50_000, "h"),
            (4, ITEMS[0][1], "h"), (4, ITEMS[0][1], "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, hits string")
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    one = dc.scan(df, bench).collect()
    monkeypatch.setattr(dc, "BLOCK", 10)
    many = dc.scan(df, bench)
    assert many.columns == ["doc_id", "text", "contaminated", "item_ids", "hits"]
    key = lambda r: str((r.doc_id, r.text, r.item_ids))
    assert sorted(one, key=key) == sorted(many.collect(), key=key)
    assert {(r.doc_id, tuple(r.item_ids)) for r in one} == {(1, (1, 2)), (None, ()), (2, ()), (3, ()), (4, (1,))}
    assert dc.scan(df.limit(0), bench).collect() == []
    assert not any(r.contaminated for r in dc.scan(df, bench.limit(0)).collect())


def test_few_broadcasts_alive(spark, monkeypatch):
    """A benchmark of ten blocks, one or three of them held at a time."""
    from pyspark.core.broadcast import Broadcast
    items = [(i, " ".join(random.Random(i).sample("ore fox old under the passages end far mill".split(), 9))) for i in range(8)]
    items += [(8, items[3][1]), (9, "d" * 40)]
    df = spark.createDataFrame([(k, "x" * k + items[k % 10][1] + " " + items[(k + 3) % 10][1]) for k in range(20)] + [(None, None)],
                               "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = sorted(map(str, dc.scan(df, bench).collect()))
    monkeypatch.setattr(dc, "BLOCK", 60)
    alive, most, released = set(), [], Broadcast.unpersist
    made = type(spark.sparkContext).broadcast

    def broadcast(sc, value):
        b = made(sc, value)
        alive.add(id(b))
        most.append(len(alive))
        return b

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "unpersist", lambda b, blocking=False: (alive.discard(id(b)), released(b, blocking))[1])
    for held in (1, 3):
        monkeypatch.setattr(dc, "HELD", held)
        alive.clear()
        most.clear()
        assert sorted(map(str, dc.scan(df, bench).collect())) == want
        assert len(most) == 10 and max(most) == held


def test_query_finds_all_whole_passages(spark):
    base = "/root/testdata/sf0.01/"
    items = spark.read.parquet(base + "benchmark.parquet").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(base + "documents.parquet").collect()}
    got = {r.doc_id: set(r.item_ids) for r in QUERIES["op3_qgram_decontaminate"](spark, base).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        exact = {x.item_id for x in items if x.text.lower() in t.lower()}
        assert exact <= got[i]
        for extra in got[i] - exact:
            item = next(x.text for x in items if x.item_id == extra)
            assert least_edits(item, t) <= len(item) // 10
    assert any(got.values())
