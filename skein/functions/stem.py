"""Suffix stripping for ROUGE with stemming (Q4).

The published Porter (1980) algorithm, applied as the ROUGE tokeniser does:
only to tokens longer than three characters. It runs inside an Arrow UDF
over token arrays with a per-batch memo, so each distinct word of a batch is
stemmed once and nothing is shuffled.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- FIXED VALUES: suffix rules of the published algorithm, in its order ------
STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
         ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
         ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
         ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
         ("ness", ""))
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
         "ism", "ate", "iti", "ous", "ive", "ize")


def _is_cons(w: str, i: int) -> bool:
    c = w[i]
    if c in "aeiou":
        return False
    if c == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        cons = _is_cons(stem, i)
        if cons and prev_vowel:
            m += 1
        prev_vowel = not cons
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    return (len(w) >= 3 and _is_cons(w, len(w) - 3) and not _is_cons(w, len(w) - 2)
            and _is_cons(w, len(w) - 1) and w[-1] not in "wxy")


def _longest(w: str, rules):
    best = None
    for suf, rep in rules:
        if w.endswith(suf) and (best is None or len(suf) > len(best[0])):
            best = (suf, rep)
    return best


def porter(w: str) -> str:
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    fix = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, fix = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, fix = w[:-3], True
    if fix:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # steps 2 and 3: the longest matching suffix decides
    for rules in (STEP2, STEP3):
        hit = _longest(w, rules)
        if hit and _measure(w[:-len(hit[0])]) > 0:
            w = w[:-len(hit[0])] + hit[1]
    # step 4
    hit = _longest(w, [(s, "") for s in STEP4])
    if hit:
        stem = w[:-len(hit[0])]
        if _measure(stem) > 1 and (hit[0] != "ion" or stem.endswith(("s", "t"))):
            w = stem
    # step 5a
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


def stem_token(t: str, min_len: int = 4) -> str:
    return porter(t) if len(t) >= min_len else t


class Stems:
    """Stems of token lists; each distinct word is stemmed once."""

    def __init__(self):
        self.memo: dict[str, str] = {}

    def of(self, tokens) -> list[str]:
        memo = self.memo
        return [memo[t] if t in memo else memo.setdefault(t, stem_token(t)) for t in tokens]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stem_arrays(arrs: pd.Series) -> pd.Series:
    stems = Stems()
    return arrs.map(lambda a: None if a is None else stems.of(a))


def stem_tokens(arr) -> Column:
    """Q4: Porter stems of a token array (tokens of 3 characters or fewer kept)."""
    return _stem_arrays(F.col(arr) if isinstance(arr, str) else arr)
