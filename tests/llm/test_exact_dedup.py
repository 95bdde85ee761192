import hashlib
from collections import defaultdict

from skein.llm.exact_dedup import deduplicated, exact_dedup

SCHEMA = "doc_id long, text string, keep_id string, row string, lang string"


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r[1])].append(r[0])
    out = []
    for t, ids in groups.items():
        real = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(real) if real else None
        out += [(i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def fixture():
    rows = [(i, t, "k", "r", None) for i, t in enumerate(["Ab", "aB", "É", "é", "", None, "x" * 200_000, "X" * 200_000, "ab "])]
    rows += [(None, "ab", "k", None, "en"), (None, "only null", "k", "r", "en"), (3, "é", "k", "r", None), (3, "é", "k", "r", None)]
    rows += [(1000 + i, "Hot text" if i % 2 else "hot TEXT", "k", "r", "en") for i in range(400)]
    return rows + [(5000 + i, f"single {i}", "k", "r", "de") for i in range(300)]


def test_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA)
    for keep in ("smallest", "largest"):
        out = exact_dedup(df, keep=keep)
        assert out.columns == ["doc_id", "text", "row", "lang", "keep_id", "group_size", "kept", "text_sha256"]
        got = out.collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(rows, keep)
        kept = [r for r in got if r.kept]
        assert len({r.text_sha256 for r in kept}) == len(kept) == len({lowered(r[1]) for r in rows})
        assert all(r.doc_id == r.keep_id for r in kept)


def test_stage_keeps_the_columns(spark):
    df = spark.createDataFrame(fixture(), SCHEMA)
    out = deduplicated(df)
    assert out.columns == df.columns
    assert out.filter("keep_id = 'k'").count() == out.count() == len({lowered(r[1]) for r in fixture()})


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_and_one_text_exchange(spark):
    df = spark.createDataFrame(fixture(), SCHEMA)
    plan = exact_dedup(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
