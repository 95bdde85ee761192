"""The mix against a plain version that sorts."""
import hashlib
import random
import re
from collections import defaultdict

import pytest

from skein.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    """{(id, text, source): [taken, ...]} and the targets, of rows (id, text, source)."""
    size = lambda t: len(WORD.findall(t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, budget = set(), share * sum(sizes.values())
    while True:
        left = budget - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share_of = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share_of[s] > most * sizes[s]}
        if not over:
            break
        full |= over
    target = {s: most * sizes[s] if s in full else share_of[s] for s in names}

    def draw(r):
        return int(hashlib.md5(f"{'' if r[0] is None else r[0]}|{r[1] or ''}".encode()).hexdigest()[:15], 16)

    taken = defaultdict(list)
    for s in names:
        whole = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, before = target[s] - whole * sizes[s], 0
        for r in sorted((r for r in rows if r[2] == s), key=draw):
            n = size(r[1])
            taken[r].append(n * (whole + (n > 0 and before + n / 2 <= rest)))
            before += n
    return {k: sorted(v) for k, v in taken.items()}, target, sizes


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, TAKEN int").repartition(5)
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "text", "source", *mixing.OUTPUTS]
    got, (want, target, sizes) = defaultdict(list), plain(rows)
    by_source = defaultdict(int)
    for r in out.collect():
        got[r.doc_id, r.text, r.source].append(r.taken)
        assert abs(r.target - target[r.source]) <= 1e-9 * max(1, r.target) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size <= 2 * r.size
        by_source[r.source] += r.taken
    assert {k: sorted(v) for k, v in got.items()} == want
    for s, n in by_source.items():
        longest = max(len(WORD.findall(t or "")) for _, t, x in rows if x == s)
        assert abs(n - target[s]) <= longest / 2 + 1e-6
    return out


def test_against_sorting(spark):
    rng = random.Random(5)
    names = ["b", "a", "é", "", None, "zz", "\U0001f600", "￿"]
    rows = [(rng.choice([None, rng.randint(0, 300)]), " ".join(rng.choices(["x", "y z", "\tw"], k=int(rng.paretovariate(0.7)))),
             rng.choices(names, [8, 1, 1, 1, 2, 1, 0.1, 1])[0]) for _ in range(600)]
    rows += [(1, None, "b"), (2, "", "b"), (3, " \n", None), (9, None, "only empty")]
    out = check(spark, rows)
    assert sorted(map(str, out.collect())) == sorted(map(str, out.collect()))


def test_a_third_of_all_rows_equal(spark):
    rng = random.Random(6)
    rows = [(7, "one two three", "hot")] * 200 + [(rng.randint(0, 99), "w " * rng.randint(1, 9), rng.choice(["hot", "x", "y"])) for _ in range(400)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b", "s")], [(1, "a " * 50_000, "s"), (2, "b", "s"), (3, "c", "t")]])
def test_few_rows(spark, rows):
    check(spark, rows)


def test_repeated(spark):
    df = spark.createDataFrame([(i, "w " * (i % 7), "ab"[i % 2]) for i in range(50)], "doc_id long, text string, source string")
    mixed = mixing.mix(df)
    copies = {(r.doc_id, r.copies) for r in mixed.collect() if r.copies}
    got = mixing.repeated(mixed).groupBy("doc_id").count().collect()
    assert {(r.doc_id, r["count"]) for r in got} == copies
