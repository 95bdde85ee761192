"""SQL (DuckDB dialect) forms of the engine's text expressions, for the oracle.

RE2 classes are ASCII for \\w \\s \\b, so the Unicode sets are spelled out:
``S`` is Python's whitespace, ``W`` a word character. These strings mirror the
Spark expressions in ``skein.functions``; both are checked against each other
by the registered oracle queries.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from skein import fixed

S = r"[\s\v\x1c-\x1f\x{85}\p{Z}]"
NS = r"[^\s\v\x1c-\x1f\x{85}\p{Z}]"
W = r"[\p{L}\p{N}_]"
NW = r"[^\p{L}\p{N}_]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def links(x: str) -> str:
    return f"regexp_replace({x}, 'http{NS}+|www{NS}+|@{NS}+|<.*?>', '', 'g')"


def emails(x: str) -> str:
    return f"regexp_replace({x}, '{W}+@{W}+\\.{W}+', '', 'g')"


def mentions(x: str) -> str:
    return f"regexp_replace({x}, '@{W}+', '', 'g')"


def user_refs(x: str) -> str:
    return f"regexp_replace({x}, '(^|{NW})u/{W}+', '\\1', 'g')"


def parens(x: str) -> str:
    return (f"regexp_replace(regexp_replace({x}, '{S}*\\({S}*', ' ', 'g'), "
            f"'{S}*\\){S}*', ' ', 'g')")


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{S}+', ' ', 'g'))"


def clean(x: str) -> str:
    return squeeze(parens(user_refs(links(x))))


def _re2_escape(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in s)


def _placeholder(i: int) -> str:
    return f"zqslangkey{i}qz"


def _slang_prepared(x: str, mapping: Mapping[str, str]):
    """Multi-word keys first become one-word placeholders (whole words only);
    then the text is cut into word / non-word pieces and each piece looked up."""
    entries = {}
    for i, (k, v) in enumerate(mapping.items()):
        if re.fullmatch(r"\w+", k):
            entries[k] = v
        else:
            ph = _placeholder(i)
            x = f"regexp_replace({x}, '(^|{NW}){_re2_escape(k)}($|{NW})', {lit(chr(92) + '1' + ph + chr(92) + '2')}, 'g')"
            entries[ph] = (k, v)
    return x, entries


def slang(x: str, mapping: Mapping[str, str] = fixed.SLANG) -> str:
    x, entries = _slang_prepared(x, mapping)
    m = "MAP {" + ", ".join(f"{lit(k)}: {lit(v if isinstance(v, str) else v[1])}" for k, v in entries.items()) + "}"
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '{W}+|{NW}+'), "
            f"lambda p: coalesce({m}[p], p)), '')")


def slang_hits(x: str, mapping: Mapping[str, str] = fixed.SLANG) -> str:
    """List of the slang keys present, in text order."""
    x, entries = _slang_prepared(x, mapping)
    m = "MAP {" + ", ".join(f"{lit(k)}: {lit(k if isinstance(v, str) else v[0])}" for k, v in entries.items()) + "}"
    return (f"list_filter(list_transform(regexp_extract_all({x}, '{W}+'), lambda p: {m}[p]), "
            f"lambda h: h IS NOT NULL)")


def normalise(x: str, mapping: Mapping[str, str] = fixed.SLANG, lower: bool = True) -> str:
    c = clean(x)
    return slang(f"lower({c})" if lower else c, mapping)


def tokens(x: str) -> str:
    return (f"list_filter(string_split(trim(regexp_replace(coalesce({x}, ''), '{S}+', ' ', 'g')), ' '), "
            f"lambda t: t <> '')")


def word_tokens(x: str) -> str:
    return f"list_filter(coalesce(regexp_extract_all(lower({x}), '{W}+'), []), lambda t: length(t) > 1)"


def stop_list() -> str:
    return "[" + ", ".join(lit(w) for w in fixed.english_stop_words()) + "]"


def remove_stops(arr: str) -> str:
    return f"list_filter({arr}, lambda t: NOT list_contains({stop_list()}, t))"


def rouge_tokens(x: str) -> str:
    return (f"list_filter(string_split(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'), ' '), "
            f"lambda t: t <> '')")


def symbol_tokens(x: str, lower: bool = False) -> str:
    y = f"lower({x})" if lower else x
    return f"coalesce(regexp_extract_all(coalesce({y}, ''), '{W}+|[^\\p{{L}}\\p{{N}}_\\s\\v\\x1c-\\x1f\\x{{85}}\\p{{Z}}]'), [])"


def ngrams(arr: str, n: int) -> str:
    if n == 1:
        return arr
    return (f"CASE WHEN len({arr}) >= {n} THEN list_transform(range(1, len({arr}) - {n - 1} + 1), "
            f"lambda i: array_to_string({arr}[i:i + {n - 1}], ' ')) ELSE [] END")


def jaccard(a: str, b: str) -> str:
    ta, tb = tokens(a), tokens(b)
    return (f"CASE WHEN len(list_distinct(list_concat({ta}, {tb}))) = 0 THEN 0.0 ELSE "
            f"len(list_distinct(list_intersect({ta}, {tb})))::DOUBLE / len(list_distinct(list_concat({ta}, {tb}))) END")


def token_f1(ref: str, hyp: str) -> str:
    tr, th = symbol_tokens(ref, True), symbol_tokens(hyp, True)
    common = f"len(list_distinct(list_intersect({tr}, {th})))::DOUBLE"
    p = f"(CASE WHEN len({th}) > 0 THEN {common} / len({th}) ELSE 0.0 END)"
    r = f"(CASE WHEN len({tr}) > 0 THEN {common} / len({tr}) ELSE 0.0 END)"
    return f"(CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"


def sentences(x: str) -> str:
    return (f"list_filter(list_transform(string_split(regexp_replace({x}, '([.!?])[ \\n]+|\\n+', "
            f"'\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')")


def label(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} >= {fixed.SENT_POSITIVE} THEN 'Positive' "
            f"WHEN {x} <= {fixed.SENT_NEGATIVE} THEN 'Negative' ELSE 'Neutral' END")


def gram_overlap(src: str, key: str, ref: str, hyp: str, n: int, tok) -> str:
    """(key, ov): clipped n-gram overlap of two text columns of ``src``."""
    return (f"SELECT {key}, sum(least(cr, ch)) AS ov FROM (SELECT {key}, g, count(*) FILTER (WHERE s = 0) AS cr, "
            f"count(*) FILTER (WHERE s = 1) AS ch FROM (SELECT {key}, 0 AS s, unnest({ngrams(tok(ref), n)}) AS g "
            f"FROM ({src}) UNION ALL SELECT {key}, 1 AS s, unnest({ngrams(tok(hyp), n)}) AS g FROM ({src})) "
            f"GROUP BY {key}, g) GROUP BY {key}")


def pair_scores(src: str, key: str, ref: str, hyp: str, extra: str = "",
                metrics: tuple[str, ...] = ("rouge1", "rouge2", "bleu")) -> str:
    """(key, the metrics asked for, token_f1 [, extra]) for a pair of columns."""
    joins, cols = [], {}
    specs = [(f"r{n}", n, rouge_tokens) for n in (1, 2) if f"rouge{n}" in metrics]
    specs += [(f"b{n}", n, symbol_tokens) for n in (1, 2, 3, 4) if "bleu" in metrics]
    for lab, n, tok in specs:
        joins.append(f"LEFT JOIN ({gram_overlap(src, key, ref, hyp, n, tok)}) {lab} USING ({key})")
        cols[f"{lab}_ov"] = f"coalesce({lab}.ov, 0)::DOUBLE"
        cols[f"{lab}_ref"] = f"greatest(len({tok(ref)}) - {n - 1}, 0)"
        cols[f"{lab}_hyp"] = f"greatest(len({tok(hyp)}) - {n - 1}, 0)"
    inner = (f"SELECT s.*, {', '.join(f'{v} AS {k}' for k, v in cols.items())}, {token_f1(ref, hyp)} AS token_f1 "
             f"FROM ({src}) s {' '.join(joins)}")

    def fm(lab):
        p = f"({lab}_ov / greatest({lab}_hyp, 1))"
        r = f"({lab}_ov / greatest({lab}_ref, 1))"
        return f"CASE WHEN {lab}_ov > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END"

    ps = [f"({lab}_ov / greatest({lab}_hyp, 1))" for lab in ("b1", "b2", "b3", "b4")]
    geo = f"exp((ln({ps[0]}) + ln({ps[1]}) + ln({ps[2]}) + ln({ps[3]})) / 4)"
    bp = "CASE WHEN b1_hyp > b1_ref THEN 1.0 ELSE exp(1.0 - b1_ref::DOUBLE / greatest(b1_hyp, 1)) END"
    bleu = (f"CASE WHEN b1_ov = 0 OR b2_ov = 0 OR b3_ov = 0 OR b4_ov = 0 OR b1_hyp = 0 THEN 0.0 "
            f"ELSE {bp} * {geo} END")
    made = {"rouge1": fm("r1"), "rouge2": fm("r2"), "bleu": bleu}
    return f"SELECT {key}{extra}, {', '.join(f'{made[m]} AS {m}' for m in metrics)}, token_f1 FROM ({inner})"


def lead(x: str, k: int) -> str:
    return f"array_to_string(({sentences(x)})[1:{k}], ' ')"


def _upper(t: str) -> str:
    return f"(upper({t}) = {t} AND lower({t}) <> {t})"


def sentiment(src: str, key: str, cols, lexicon: str) -> str:
    """(key, column, score) with the rules of ``skein.operators.sentiment``."""
    u = " UNION ALL ".join(f"SELECT {key}, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS text FROM ({src})"
                           for c in cols)
    B, D, N = fixed.SENT_BOOST, fixed.SENT_BOOST_DECAY, fixed.SENT_NEGATE
    boost = " + ".join(f"CASE WHEN k{d} IN ('booster', 'dampener') THEN sgn * {D[d - 1]} * (CASE WHEN k{d} = 'booster' THEN {B} "
                       f"ELSE -{B} END + CASE WHEN caps_mix AND u{d} THEN {fixed.SENT_CAPS} ELSE 0.0 END) ELSE 0.0 END"
                       for d in (1, 2, 3))
    inner = f"regexp_replace(t, '{fixed.OUTER_PUNCTUATION}', '', 'g')"
    neg = " * ".join(f"CASE WHEN k{d} = 'negation' THEN {N} ELSE 1.0 END" for d in (1, 2, 3))
    return f"""
WITH lex AS ({lexicon}),
u AS ({u}),
r AS (SELECT {key}, "column", text,
        list_transform(coalesce(regexp_extract_all(coalesce(text, ''), '{fixed.CHUNK}'), []),
          lambda t: CASE WHEN {inner} = '' THEN t ELSE {inner} END) AS toks,
        length(text) - length(replace(text, '!', '')) AS bang,
        length(text) - length(replace(text, '?', '')) AS quest FROM u),
r2 AS (SELECT *, list_transform(toks, lambda t: lower(t)) AS low,
        least(bang, {fixed.SENT_EXCLAIM_MAX}) * {fixed.SENT_EXCLAIM} + CASE WHEN quest > 3 THEN {fixed.SENT_QUESTION_MANY}
          WHEN quest > 1 THEN quest * {fixed.SENT_QUESTION} ELSE 0.0 END AS amp,
        len(list_filter(toks, lambda t: {_upper('t')})) > 0 AND len(list_filter(toks, lambda t: NOT {_upper('t')})) > 0 AS caps_mix
      FROM r),
r3 AS (SELECT *, coalesce(list_position(low, 'but'), 0) - 1 AS but FROM r2),
ex AS (SELECT {key}, "column", caps_mix, but, pos, low[pos + 1] AS token, {_upper('toks[pos + 1]')} AS up,
         CASE WHEN pos >= 1 THEN low[pos] END AS p1, CASE WHEN pos >= 2 THEN low[pos - 1] END AS p2,
         CASE WHEN pos >= 3 THEN low[pos - 2] END AS p3, pos >= 1 AND {_upper('toks[pos]')} AS u1,
         pos >= 2 AND {_upper('toks[pos - 1]')} AS u2, pos >= 3 AND {_upper('toks[pos - 2]')} AS u3
       FROM (SELECT *, unnest(range(0, len(low))) AS pos FROM r3)),
tagged AS (SELECT ex.*, w.valence, m1.kind AS k1, m2.kind AS k2, m3.kind AS k3 FROM ex
       JOIN (SELECT token, valence FROM lex WHERE kind = 'word') w ON w.token = ex.token
       LEFT JOIN (SELECT token, kind FROM lex WHERE kind <> 'word') m1 ON m1.token = ex.p1
       LEFT JOIN (SELECT token, kind FROM lex WHERE kind <> 'word') m2 ON m2.token = ex.p2
       LEFT JOIN (SELECT token, kind FROM lex WHERE kind <> 'word') m3 ON m3.token = ex.p3),
v1 AS (SELECT *, valence + CASE WHEN caps_mix AND up THEN (CASE WHEN valence > 0 THEN {fixed.SENT_CAPS} ELSE -{fixed.SENT_CAPS} END) ELSE 0.0 END AS v FROM tagged),
v2 AS (SELECT *, CASE WHEN v < 0 THEN -1.0 ELSE 1.0 END AS sgn FROM v1),
v3 AS (SELECT {key}, "column", (v + {boost}) * {neg} * (CASE WHEN but < 0 THEN 1.0 WHEN pos < but THEN {fixed.SENT_BUT_BEFORE}
          WHEN pos > but THEN {fixed.SENT_BUT_AFTER} ELSE 1.0 END) AS v FROM v2),
s AS (SELECT {key}, "column", sum(v) AS s FROM v3 GROUP BY ALL),
j AS (SELECT r3.{key}, r3."column", r3.text IS NULL AS is_null, r3.amp, coalesce(s.s, 0.0) AS s FROM r3
      LEFT JOIN s ON s.{key} = r3.{key} AND s."column" = r3."column"),
k AS (SELECT *, s + CASE WHEN s > 0 THEN amp WHEN s < 0 THEN -amp ELSE 0.0 END AS s2 FROM j)
SELECT {key}, "column", CASE WHEN is_null THEN NULL ELSE round(s2 / sqrt(s2 * s2 + {fixed.SENT_ALPHA}), 4) END AS score FROM k
"""
