"""Summary quality metrics (Q1-Q9).

ROUGE-N and BLEU count the n-grams of one row's two texts, so they are row
functions: tokens are made in the JVM, one Arrow function counts all orders of
a row, and formulas on the counts are expressions again. ROUGE-L needs a
longest common subsequence, also by row in an Arrow function. Only averages
aggregate.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions.stem import Stems
from skein.functions.tokens import let, rouge_tokens, symbol_tokens, token_f1
from skein.operators.summarise import summarise_with

BLEU_ORDERS = (1, 2, 3, 4)


def overlap(ref: Sequence, hyp: Sequence, n: int) -> int:
    """How many n-grams of ``hyp`` are also in ``ref``, each counted as often
    as both have it. Of the longer side, only grams of the shorter are counted."""
    short, long = sorted((ref, hyp), key=len)
    one = Counter(zip(*[short[i:] for i in range(n)]))
    other = Counter(filter(one.__contains__, zip(*[long[i:] for i in range(n)])))
    return sum(min(c, one[g]) for g, c in other.items())


def lists(c: pa.Array) -> list:
    """A (nested) list array as Python lists; strings are converted all at once."""
    if not pa.types.is_list(c.type):
        return c.to_numpy(zero_copy_only=False).tolist()
    inner, ends = lists(c.flatten()), np.cumsum(pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False)).tolist()
    out = [inner[a:b] for a, b in zip([0, *ends], ends)]
    return out if c.null_count == 0 else [x if ok else None for x, ok in zip(out, c.is_valid().to_pylist())]


def _rows(columns: Sequence[pa.Array], most: int = 64):
    """The rows of a batch, a few at a time as Python objects."""
    for at in range(0, len(columns[0]), most):
        yield from zip(*[lists(c.slice(at, most)) for c in columns])


def gram_overlaps(df: DataFrame, key: str, ref: str, hyp: str,
                  rouge_orders: Sequence[int] = (1, 2), bleu: bool = True,
                  carry: Mapping[str, Column] | None = None, stem: bool = False, rouge_l: bool = False) -> DataFrame:
    """(key, <label>_overlap, <label>_ref, <label>_hyp ... , *carry), one row
    for each row of ``df``; with ``rouge_l`` also rougeL_*, whose overlap is
    the longest common subsequence.

    The texts are tokenised in the JVM; stems, grams and the subsequence of a
    row are made inside the row by one Arrow function, so no gram is a row,
    nothing is shuffled, and repeated rows and null keys stay apart. The
    counts need the memory of the shorter text's grams, and the tokens of a
    few rows are Python objects at a time, however long a batch is."""
    carry = dict(carry or {})
    specs, sides = [], []
    stemmed = 2 if stem and (rouge_orders or rouge_l) else 0   # the first sides are ROUGE's
    if rouge_orders or rouge_l:
        sides += [rouge_tokens(F.col(ref)), rouge_tokens(F.col(hyp))]
        specs += [(f"rouge{n}", n, 0) for n in rouge_orders] + ([("rougeL", 0, 0)] if rouge_l else [])
    if bleu:
        specs += [(f"bleu{n}", n, len(sides)) for n in BLEU_ORDERS]
        sides += [symbol_tokens(F.col(ref)), symbol_tokens(F.col(hyp))]

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def counted(*columns: pa.Array) -> pa.Array:
        out, stems = [], Stems()
        for row in _rows(columns):
            row = [stems.of(x) if i < stemmed else x for i, x in enumerate(row)]
            found = []
            for _, n, at in specs:
                r, h = row[at], row[at + 1]
                found += [overlap(r, h, n) if n else _lcs_len(r, h), max(0, len(r) - max(n, 1) + 1), max(0, len(h) - max(n, 1) + 1)]
            out.append(found)
        return pa.array(out, pa.list_(pa.int64()))

    toks = {f"__t{i}": x for i, x in enumerate(sides)}
    own = df.select(key, *[v.alias(k) for k, v in toks.items()], *[v.alias(k) for k, v in carry.items()])
    own = own.withColumn("__n", counted(*toks)) if sides else own
    parts = [(f"{label}_{part}", 3 * i + j) for i, (label, _, _) in enumerate(specs) for j, part in enumerate(("overlap", "ref", "hyp"))]
    return own.select(key, *[F.col("__n")[at].cast("bigint" if at % 3 == 0 else "int").alias(name) for name, at in parts], *carry)


def _shared_tokens(ref: pa.Array, hyps: pa.Array) -> pa.Array:
    """For each row the unigram overlaps of its token list with each of its others."""
    n, n_ref = (pc.fill_null(pc.list_value_length(x), 0).to_numpy().astype(np.int64) for x in (hyps, ref))
    each = hyps.flatten()
    n_toks = pc.list_value_length(each).to_numpy()
    row = np.repeat(np.arange(len(n)), n)   # of each other text
    words = pc.unique(ref.flatten())
    size = max(len(words), 1)
    own, own_n = np.unique(np.repeat(np.arange(len(n)), n_ref) * size + pc.index_in(ref.flatten(), value_set=words).to_numpy(), return_counts=True)
    at = pc.index_in(each.flatten(), value_set=words)
    known, of = at.is_valid().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(each)), n_toks)
    pairs, count = np.unique(of[known] * size + at.drop_null().to_numpy(), return_counts=True)
    text, word = np.divmod(pairs, size)
    place = np.searchsorted(own, row[text] * size + word)
    both = place < len(own)
    both[both] = own[place[both]] == (row[text] * size + word)[both]
    shared = np.bincount(text[both], weights=np.minimum(count[both], own_n[place[both]]), minlength=len(each)).astype(np.int64)
    ends = pa.array(np.append(0, np.cumsum(n)).astype(np.int32), mask=np.append(hyps.is_null().to_numpy(zero_copy_only=False), False))
    return pa.ListArray.from_arrays(ends, pa.array(shared))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _unigram_overlaps(ref: pa.Array, hyps: pa.Array) -> pa.Array:
    most = 256   # rows at a time
    return pa.concat_arrays([_shared_tokens(ref.slice(i, most), hyps.slice(i, most)) for i in range(0, max(len(ref), 1), most)])


def rouge1_each(ref: Column, hyps: Column) -> Column:
    """Q1 of one text against each of an array of texts: an array of ROUGE-1 F
    values, so that the text's tokens are made and moved once, not with every
    other one."""
    def values(s):
        return F.transform(F.arrays_zip(s["o"].alias("o"), s["h"].alias("h")),
                           lambda x: _fmeasure(x["o"].cast("double"), F.size(s["r"]), F.size(x["h"])))
    r, h = rouge_tokens(ref), F.transform(hyps, rouge_tokens)
    return let(values, r=r, h=h, o=_unigram_overlaps(r, h))


def _fmeasure(ov, n_ref, n_hyp):
    p = ov / F.greatest(n_hyp, F.lit(1))
    r = ov / F.greatest(n_ref, F.lit(1))
    return F.when(ov > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def rouge_n_col(o: DataFrame, n: int | str):
    lab = f"rouge{n}"
    return _fmeasure(F.col(f"{lab}_overlap").cast("double"), F.col(f"{lab}_ref"), F.col(f"{lab}_hyp"))


def bleu_col(o: DataFrame):
    """Q5: sentence BLEU-4, equal weights, no smoothing; 0 when any order has
    no match or the hypothesis is empty; brevity penalty when hyp <= ref."""
    p = [F.col(f"bleu{n}_overlap") / F.greatest(F.col(f"bleu{n}_hyp"), F.lit(1)) for n in BLEU_ORDERS]
    any_zero = F.lit(False)
    for n in BLEU_ORDERS:
        any_zero = any_zero | (F.col(f"bleu{n}_overlap") == 0)
    h = F.col("bleu1_hyp").cast("double")
    r = F.col("bleu1_ref").cast("double")
    bp = F.when(h > r, F.lit(1.0)).otherwise(F.exp(1.0 - r / F.greatest(h, F.lit(1.0))))
    geo = F.exp(sum(F.log(x) for x in p) / len(BLEU_ORDERS))
    return F.when(any_zero | (h == 0), F.lit(0.0)).otherwise(bp * geo)


def score_pairs(df: DataFrame, key: str, ref: str, hyp: str, rouge_l: bool = False,
                carry: Sequence[str] | Mapping[str, Column] = (), stem: bool = False,
                rouge_orders: Sequence[int] = (1, 2), bleu: bool = True) -> DataFrame:
    """Q1, Q2, Q5, Q6 (and Q3 when asked): of each row of ``df`` its key, rouge1,
    rouge2, bleu, token_f1 [, rougeL] and the ``carry`` columns; ``stem``
    applies Porter stemming to the ROUGE tokens (Q4). Only grams of the
    ``rouge_orders`` and, with ``bleu``, of BLEU are counted."""
    extra = dict(carry) if isinstance(carry, Mapping) else {c: F.col(c) for c in carry}
    per_row = {"token_f1": token_f1(F.col(ref), F.col(hyp))}
    o = gram_overlaps(df, key, ref, hyp, rouge_orders, bleu, carry={**per_row, **extra}, stem=stem, rouge_l=rouge_l)
    return o.select(key, *[rouge_n_col(o, n).alias(f"rouge{n}") for n in rouge_orders],
                    *([bleu_col(o).alias("bleu")] if bleu else []), *per_row,
                    *([rouge_n_col(o, "L").alias("rougeL")] if rouge_l else []), *extra)


def score_all(df: DataFrame, key: str, pairs: Sequence[tuple[str, str, str]], carry: Sequence[str] = (), **options) -> DataFrame:
    """SI5: ``score_pairs`` for several pairs (name, ref, hyp) of columns in one
    scan: a row for each row of ``df`` and each pair, named in ``pair``."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("pair"), F.col(r).alias("__ref"), F.col(h).alias("__hyp")) for n, r, h in pairs]))
    rows = df.select(key, *carry, each.alias("e")).select(key, *carry, "e.*")
    return score_pairs(rows, key, "__ref", "__hyp", carry=["pair", *carry], **options)


def _lcs_len(a, b) -> int:
    """Length of the longest common subsequence, bit-parallel over ``b``
    (Allison-Dix / Hyyro): one big-integer update per token of ``a``."""
    if len(a) == 0 or len(b) == 0:
        return 0
    masks: dict = {}
    for i, t in enumerate(b):
        masks[t] = masks.get(t, 0) | (1 << i)
    full = (1 << len(b)) - 1
    v = full
    for t in a:
        u = v & masks.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - bin(v).count("1")


@F.pandas_udf(T.DoubleType())
def rouge_l_f(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    """Q3: ROUGE-L F-measure from the LCS of two token arrays."""
    out = []
    for r, h in zip(ref, hyp):
        r = [] if r is None else list(r)
        h = [] if h is None else list(h)
        lcs = _lcs_len(r, h)
        if lcs == 0:
            out.append(0.0)
            continue
        p, rc = lcs / len(h), lcs / len(r)
        out.append(2 * p * rc / (p + rc))
    return pd.Series(out, dtype="float64")


def evaluate_model(df: DataFrame, key: str, text: str, reference: str, make_fn: Callable[[], Callable[[str], str]],
                   max_in: int | None = None, by: Sequence[str] | None = None) -> DataFrame:
    """Q9: a supplied summariser (SU1: ``make_fn`` builds it once a partition)
    over the texts of ``df``, scored against ``reference`` as the reference
    metrics are (stemmed ROUGE-1/2/L, BLEU, token F1) and averaged, with ``n``
    and ``n_failed``. A failed row counts as an empty summary."""
    made = summarise_with(df.select(key, text, reference, *(by or [])), key, text, make_fn, max_in, carry=[reference, *(by or [])])
    rows = made.withColumn("summary_made", F.coalesce("summary_made", F.lit("")))
    s = score_pairs(rows, key, reference, "summary_made", rouge_l=True, stem=True, carry={
        "failed": F.col("error").isNotNull().cast("long"), **{c: F.col(c) for c in by or []}})
    means = [F.avg(m).alias(m) for m in ("rouge1", "rouge2", "rougeL", "bleu", "token_f1")]
    return (s.groupBy(*by) if by else s).agg(*means, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("failed"), F.lit(0)).alias("n_failed"))


def evaluate_summariser(df: DataFrame, key: str, text: str, reference: str, summariser,
                        by: Sequence[str] | None = None) -> DataFrame:
    """Q9 for any summariser, a function (df, key, text) -> (key, summary) as
    ``summarise.extractive``, ``summarise.supplied`` and ``ranker.load_ranker``
    give: averages as in ``evaluate_model`` and ``n``. A null or missing summary
    counts as an empty one. ``key`` names one document each."""
    made = summariser(df.select(key, text), key, text).select(key, F.col("summary").alias("__made"))
    rows = df.select(key, reference, *(by or [])).join(made, key, "left").withColumn("__made", F.coalesce("__made", F.lit("")))
    s = score_pairs(rows, key, reference, "__made", rouge_l=True, stem=True, carry=by or [])
    means = [F.avg(m).alias(m) for m in ("rouge1", "rouge2", "rougeL", "bleu", "token_f1")]
    return (s.groupBy(*by) if by else s).agg(*means, F.count(F.lit(1)).alias("n"))


METRICS = ("rouge1", "rouge2", "bleu", "token_f1")


def evaluate(scored: DataFrame, metrics: Sequence[str] = METRICS, by: Sequence[str] | None = None,
             rollup: bool = False) -> DataFrame:
    """Q7 / Q8: averages of the metric columns, overall, by group or with
    rollup subtotals. Empty input gives null averages and n = 0."""
    aggs = [F.avg(m).alias(m) for m in metrics] + [F.count(F.lit(1)).alias("n")]
    if not by:
        return scored.agg(*aggs)
    g = scored.rollup(*by) if rollup else scored.groupBy(*by)
    return g.agg(*aggs)
