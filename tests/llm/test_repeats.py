import random
import re

import pytest

from skein.llm import repeats


def brute(rows, unit, least=repeats.LEAST_WORDS):
    """Text left and spans removed, by plain dictionaries."""
    def units(t):
        pat = {"line": r"\n", "paragraph": r"\n\s*\n", "sentence": r"\n|(?<=[.!?])(?=[ \t\r\x0b\x0c])"}[unit]
        out, at = [], 0
        for m in [*re.finditer(pat, t), None]:
            stop = m.start() if m else len(t)
            if (words := t[at:stop].split()):
                begin = at + len(t[at:stop]) - len(t[at:stop].lstrip())
                out.append([begin, None, len(words), " ".join("".join(c.lower() if c.isascii() else c for c in w) for w in words)])
            at = m.end() if m else stop
        for a, b in zip(out, out[1:]):
            a[1] = b[0]
        if out:
            out[-1][1] = len(t)
        return out

    docs = sorted({(k, t or "") for k, t in rows}, key=lambda d: (d[0] is not None, d[0] or 0))
    first = {}
    for k, t in docs:
        for j, u in enumerate(units(t)):
            first.setdefault(u[3], (k, t, j))
    result = {}
    for k, t in docs:
        us = units(t)
        late = [first[u[3]] != (k, t, j) for j, u in enumerate(us)]
        cut, j, left, done = [], 0, "", 0
        while j < len(us):
            e = j
            while e < len(us) and late[e]:
                e += 1
            if e > j and sum(u[2] for u in us[j:e]) >= least:
                cut.append((us[j][0], us[e - 1][1]))
            j = max(e, j + 1)
        for a, b in cut:
            left, done = left + t[done:a], b
        result[k, t] = (left + t[done:], cut)
    return result


@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence"])
def test_against_brute_force(spark, unit):
    rnd = random.Random(7)
    pool = [" ".join(rnd.choice(["aé", "Be", "ce", "dé", "e", "f"]) for _ in range(rnd.randrange(1, 14))) + rnd.choice([".", "!", ""])
            for _ in range(40)]
    rows = [(i, rnd.choice(["", " "]) + rnd.choice([" ", "\n", "\n\n", "  \n"]).join(rnd.choices(pool, k=rnd.randrange(1, 9))))
            for i in range(120)]
    rows += [(500, rows[3][1].upper()), (501, ""), (502, None), (None, rows[4][1]), (503, "solo " * 30_000), (503, "solo " * 30_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, removed string, idx int")
    out = repeats.remove_repeats(df, unit=unit)
    assert out.columns == ["doc_id", "text", "idx", "removed", "n_units", "n_removed", "kept_in"]
    got, want = out.collect(), brute(rows, unit)
    assert len(got) == len(rows)
    by_key = {(k, w[0]): w[1] for (k, t), w in want.items()}
    for r in got:
        assert by_key[r.doc_id, r.text or ""] == [(s.start, s.end) for s in r.removed]
        assert bool(r.removed) == bool(r.kept_in)
    assert {r.text for r in got if r.doc_id == 502} == {None}
    assert any(r.removed for r in got)
    assert repeats.remove_repeats(df.limit(0), unit=unit).collect() == []


def test_passages_within_lines_leave_and_clean_text_stays(spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    sentence = lambda n: " ".join(word() for _ in range(n)) + "."
    passage = " ".join(sentence(9) for _ in range(7))
    rows = [(i, sentence(8) + " " + (passage + " " if i % 3 == 0 else "") + sentence(8)) for i in range(90)]
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), unit="sentence").collect()}
    for i, t in rows:
        if i % 3 == 0 and i:
            assert got[i].text == t.replace(passage + " ", "") and got[i].kept_in == [0]
            assert [t[s.start:s.end] for s in got[i].removed] == [passage + " "]
        else:
            assert got[i].text == t and not got[i].removed


def test_short_lines_leave_and_pieces_inside_a_line_are_reported(spark):
    rows = [(1, "Read more here.\nAlpha beta. Of it."), (2, "Gamma delta epsilon. Of it. Zeta eta\nRead  MORE here.\nTheta iota."),
            (3, "Read more here.\nKappa.\nOf it."), (4, "Alpha beta. Read more here.\nLambda.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in repeats.remove_repeats(df, unit="sentence", least_words=10, stays=True).collect()}
    assert got[1].text == rows[0][1] and got[1].stays == []
    assert got[2].text == "Gamma delta epsilon. Of it. Zeta eta\nTheta iota." and got[2].kept_in == [1]
    assert [(rows[1][1][s.start:s.end], s.kept_in) for s in got[2].stays] == [("Of it. ", 1)]
    assert got[3].text == "Kappa.\n" and got[3].n_removed == 2 and got[3].stays == []
    assert got[4].text == "Lambda." and got[4].n_removed == 2
    by_line = {r.doc_id: r.text for r in repeats.remove_repeats(df, unit="line", least_words=10).collect()}
    assert by_line[3] == "Kappa.\nOf it." and by_line[2].endswith("Zeta eta\nTheta iota.")
    whole = {r.doc_id: r.text for r in repeats.remove_repeats(df, unit="sentence").collect()}
    assert whole[2] == "Gamma delta epsilon. Zeta eta\nTheta iota."


def test_least_words_keep_only_pieces_inside_a_line(spark):
    rnd = random.Random(3)
    pool = [" ".join(rnd.choice("abcdef") for _ in range(rnd.randrange(1, 6))) + "." for _ in range(30)]
    rows = [(i, "\n".join(" ".join(rnd.choices(pool, k=rnd.randrange(1, 4)) + [f"own{i}x{j}."] * rnd.randrange(2))
                          for j in range(rnd.randrange(1, 6)))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in repeats.remove_repeats(df, unit="sentence", least_words=8, stays=True).collect()}
    every, few = brute(rows, "sentence", 1), brute(rows, "sentence", 8)
    part = 0
    for k, t in rows:
        cover = lambda spans: {c for a, b in spans for c in range(a, b)}
        removed, stays = cover(got[k].removed and [(s.start, s.end) for s in got[k].removed]), cover([(s.start, s.end) for s in got[k].stays])
        assert removed | stays == cover(every[k, t][1]) and not removed & stays
        assert cover(few[k, t][1]) <= removed
        at = 0
        for line in t.split("\n"):
            chars = set(range(at, at + len(line)))
            if chars <= cover(every[k, t][1]):
                assert chars <= removed
            at += len(line) + 1
        part += bool(stays)
    assert part
