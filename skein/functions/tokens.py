"""Token, n-gram and per-row metric expressions (T1-T4, SI2, SI4, Q6, SE2, H7).

All are native Column expressions (split / regexp_extract_all / higher-order
array functions); none needs a shuffle because each works inside one row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein import fixed

# Word runs and single non-space symbols: the engine's BLEU / F1 tokeniser.
WORD_OR_SYMBOL = r"(?U)[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x1c-\x1f]"
WORD_RUN = r"[\p{L}\p{N}_]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(fn, **bound) -> Column:
    """Evaluate each bound expression once per row and pass them to ``fn`` as
    fields of one struct. Expressions referenced inside lambdas are otherwise
    re-evaluated at every reference (e.g. once per n-gram index)."""
    packed = F.array(F.struct(*[v.alias(k) for k, v in bound.items()]))
    return F.element_at(F.transform(packed, lambda s: fn(s)), 1)


def tokens(c) -> Column:
    """Whitespace tokens (Python ``str.split()``); null -> empty array."""
    parts = F.split(F.trim(F.regexp_replace(_c(c), fixed.SPACE_RUN_PATTERN, " ")), " ")
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def join_tokens(c, sep: str = " ") -> Column:
    """Array -> string (nulls skipped, null array -> '')."""
    return F.concat_ws(sep, _c(c))


def word_tokens(c) -> Column:
    """Lower-cased word runs of at least two characters."""
    runs = F.regexp_extract_all(F.lower(_c(c)), F.lit(WORD_RUN), 0)
    return F.coalesce(F.filter(runs, lambda x: F.length(x) > 1), F.array().cast("array<string>"))


def remove_stops(arr, stops: Iterable[str] | None = None) -> Column:
    """T4: drop stop words, keeping order and repeats. The literal IN list is
    turned into a hash-set lookup by the optimizer (InSet)."""
    stops = list(stops if stops is not None else fixed.english_stop_words())
    return F.filter(_c(arr), lambda x: ~x.isin(stops))


def ngrams(arr, n: int) -> Column:
    """Space-joined n-grams of a token array (empty when shorter than n)."""
    if n == 1:
        return _c(arr)

    def grams(s):
        a = s["a"]
        g = F.transform(F.sequence(F.lit(1), F.size(a) - n + 1), lambda i: F.array_join(F.slice(a, i, n), " "))
        return F.when(F.size(a) >= n, g).otherwise(F.array().cast("array<string>"))

    if isinstance(arr, str):
        return grams({"a": F.col(arr)})
    return let(grams, a=_c(arr))


def rouge_tokens(c) -> Column:
    """ROUGE tokeniser: lower case, runs outside [a-z0-9] become a space."""
    parts = F.split(F.regexp_replace(F.lower(_c(c)), r"[^a-z0-9]+", " "), " ")
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def symbol_tokens(c, lower: bool = False) -> Column:
    """Word runs and single symbols (BLEU uses the cased form, F1 the lower)."""
    x = F.lower(_c(c)) if lower else _c(c)
    return F.coalesce(F.regexp_extract_all(x, F.lit(WORD_OR_SYMBOL), 0),
                      F.array().cast("array<string>"))


def jaccard(a, b) -> Column:
    """SI4: |A n B| / |A u B| over whitespace-token sets; 0 when both empty."""
    def f(s):
        inter = F.size(F.array_intersect(s["a"], s["b"]))
        union = F.size(F.array_union(s["a"], s["b"]))
        return F.when(union == 0, F.lit(0.0)).otherwise(inter / union)
    return let(f, a=tokens(a), b=tokens(b))


def list_f1(ref: Column, hyp: Column) -> Column:
    """Set overlap of two arrays over their list lengths (repeats count in the
    denominators)."""
    def f(s):
        tr, th = s["r"], s["h"]
        common = F.size(F.array_intersect(tr, th)).cast("double")
        p = F.when(F.size(th) > 0, common / F.size(th)).otherwise(F.lit(0.0))
        r = F.when(F.size(tr) > 0, common / F.size(tr)).otherwise(F.lit(0.0))
        return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return let(f, r=ref, h=hyp)


def token_f1(ref, hyp) -> Column:
    """Q6 over words and symbols: ``list_f1`` of their lower-cased tokens."""
    return list_f1(symbol_tokens(ref, lower=True), symbol_tokens(hyp, lower=True))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def semantic_distance(a, b) -> Column:
    """SI2: 1 - cosine of two embedding arrays; zero norm -> distance 1."""
    def f(s):
        da, db = s["a"], s["b"]
        na = F.sqrt(dot(da, da))
        nb = F.sqrt(dot(db, db))
        return F.when((na == 0) | (nb == 0), F.lit(1.0)).otherwise(1.0 - dot(da, db) / (na * nb))
    return let(f, a=_c(a).cast("array<double>"), b=_c(b).cast("array<double>"))


def sentences(c) -> Column:
    """Sentence split used by the summarisers: after . ! ? followed by space or
    newline, and at every newline run; pieces trimmed, empties dropped."""
    marked = F.regexp_replace(_c(c), r"([.!?])[ \n]+|\n+", "$1\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda s: F.trim(s)), lambda s: s != "")


def sentiment_label(score) -> Column:
    """SE2: Positive / Negative / Neutral by the published thresholds."""
    s = _c(score)
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(s >= fixed.SENT_POSITIVE, "Positive")
            .when(s <= fixed.SENT_NEGATIVE, "Negative")
            .otherwise("Neutral"))


def share_url(c, encode: bool = False) -> Column:
    """H7: share link; the interactive app does not encode the text."""
    body = F.url_encode(_c(c)) if encode else _c(c)
    return F.concat(F.lit(fixed.SHARE_PREFIX), body)


def hashtag(phrase) -> Column:
    """H4 formatting: '#' + lower case with spaces removed."""
    return F.concat(F.lit("#"), F.lower(F.replace(_c(phrase), F.lit(" "), F.lit(""))))
