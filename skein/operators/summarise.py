"""Summaries (SU1-SU4).

* ``lead_k``: first k sentences (row expression).
* ``sentence_scores``: every sentence scored by the TF-IDF mass of its words
  and ranked inside its document.
* ``summarise``: greedy pick under a token budget with n-gram blocking, a
  fold over each document's ranked sentences (``greedy_pick`` is the plain
  Python statement of the same rule, used as the reference in tests).
* ``summarise_with``: any supplied summariser, built once per partition in
  ``mapInPandas``; a failing row yields null plus an error message.

Shape of the scoring: terms never move one by one. Texts are dealt by key to
blocks of about ``BLOCK_BYTES``; the distinct terms of a block meet the idf
table, and a block's texts meet their own part of it, where all sums of a
sentence are counted at once (``sentence_sums``).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions.tokens import let, ngrams, sentences, tokens, word_tokens
from skein.session import shuffle_partitions

# Named generation presets: (max_in, min_tokens, max_tokens, block_ngram).
# Beams and length penalties have no extractive meaning; they are passed to a
# supplied model only.
PRESETS = {
    "pipeline": dict(max_in=1024, min_tokens=0, max_tokens=150, block_ngram=0),
    "eval": dict(max_in=512, min_tokens=0, max_tokens=150, block_ngram=0),
    "batch": dict(max_in=1024, min_tokens=40, max_tokens=150, block_ngram=0),
    "app": dict(max_in=1024, min_tokens=80, max_tokens=150, block_ngram=2),
}

BLOCK_BYTES = 16 << 20   # text of a block, about
_SUMS = ("tf_mass", "mass", "both", "own")


def lead_k(c, k: int = 3) -> Column:
    """SU4: the first k sentences joined by a space (a row expression)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.slice(sentences(c), 1, k), " ")


def document_idf(df: DataFrame, text: str) -> DataFrame:
    """(term, idf): ln((1+n)/(1+df)) + 1 over the documents of ``df``; one
    partial aggregate over each document's distinct words."""
    n = df.count()
    return (df.select(F.explode(F.array_distinct(word_tokens(F.coalesce(F.col(text), F.lit(""))))).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            .select("term", (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf")))


def term_places(sents: DataFrame, key: str, idf: DataFrame) -> DataFrame:
    """(key, spos, c, t, idf, known) of each term of each sentence of ``sents``
    (key, spos, sentence), partitioned by key: its counts in the sentence and
    the document. A sentence without terms has one row, not ``known``.

    Only one row for each term of a document goes to its idf and back, with
    the term's sentences and counts as an array (a number holds both)."""
    occ = (sents.select(key, "spos", F.explode_outer(word_tokens(F.col("sentence"))).alias("term"))
           .groupBy(key, "spos", "term").agg(F.count(F.lit(1)).alias("c")))
    terms = occ.groupBy(key, "term").agg(F.sum("c").alias("t"), F.collect_list(F.shiftleft(F.col("spos").cast("long"), 32) + F.col("c")).alias("at"))
    back = (terms.join(idf, "term", "left").select(key, "t", "at", "idf", F.col("term").isNotNull().alias("known"))
            .repartition(shuffle_partitions(sents), key))
    each = back.select(key, "t", "idf", "known", F.explode("at").alias("at"))
    return each.select(key, F.shiftright("at", 32).cast("int").alias("spos"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).alias("c"),
                       "t", "idf", "known")


def _first_seen(batches):
    """The first row of each key (the first column) in a partition."""
    seen = set()
    for b in batches:
        own = []
        for k in b.column(0).to_pylist():
            own.append(k not in seen)
            seen.add(k)
        yield b.filter(pa.array(own, pa.bool_()))


def _block_sums(texts: pa.Table, own: pa.Table, copies: bool = False) -> pa.Table:
    """(__key, whole, s) of each key of a block, given the block's idf table."""
    texts = texts.filter(pc.greater(pc.list_value_length(texts.column("e")), 0))   # those with a sentence
    codes = texts.column("__key").combine_chunks().dictionary_encode("encode").indices.to_numpy()
    keys, first = np.unique(codes, return_index=True)
    if len(keys) < len(codes):   # the rows of a key side by side, or one of them
        order = first if copies else np.argsort(codes, kind="stable")
        texts, codes = texts.take(order), codes[order]
    codes = np.unique(codes, return_inverse=True)[1]   # in the order of rows, if no key comes twice
    first = np.unique(codes, return_index=True)[1]
    each, toks = texts.column("e").combine_chunks(), texts.column("toks").combine_chunks()
    n_sents = pc.list_value_length(each).to_numpy().astype(np.int64)
    ends = np.append(0, np.cumsum(n_sents))
    spos = np.arange(ends[-1]) - np.repeat(ends[:-1], n_sents)
    # A group is a key's sentence position; rows that share a key share their groups.
    place = np.repeat(codes, n_sents).astype(np.int64) << 32 | spos
    groups, group = np.unique(place, return_inverse=True)
    toks = toks.flatten()
    of = np.repeat(group, pc.list_value_length(toks).to_numpy())
    terms = own.column("term").combine_chunks()
    at = pc.index_in(toks.flatten(), value_set=terms)
    known, size = at.is_valid().to_numpy(zero_copy_only=False), max(len(terms), 1)
    pairs, c = np.unique(of[known] * size + at.drop_null().to_numpy(), return_counts=True)
    g, term = np.divmod(pairs, size)
    _, inverse = np.unique((groups[g] >> 32) * size + term, return_inverse=True)
    t = np.bincount(inverse, weights=c)[inverse] if len(inverse) else c   # counts in the whole text
    w = pc.fill_null(own.column("idf"), 0.0).to_numpy()[term]
    sums = [np.bincount(g, weights=x, minlength=len(groups)).astype(float) for x in (t * w, c * w, c * t * w * w, c * c * w * w)]
    whole = np.bincount(groups >> 32, weights=sums[2]).astype(float)
    found = pa.StructArray.from_arrays([pa.array(spos.astype(np.int32)), pa.array(np.bincount(of, minlength=len(groups))[group].astype(np.int32)),
                                        *[pa.array(x[group]) for x in sums], each.flatten()], ["spos", "n", *_SUMS, "e"])
    per_key = pa.ListArray.from_arrays(pa.array(np.append(ends[first], ends[-1]).astype(np.int32)), found)
    return pa.table({"__key": texts.column("__key").take(pa.array(first)), "whole": whole[codes[first]], "s": per_key})


def sentence_sums(df: DataFrame, key: str, text: str, idf: DataFrame, carry: Callable[[Column], Column],
                  copies: bool = False) -> DataFrame:
    """(key, whole, s), a row for each key with a sentence. ``s`` has a struct
    for each sentence of the key's texts: ``spos``, ``n`` (its word tokens), ``e``
    (what ``carry`` makes of the sentence array: as many structs), and sums over
    its distinct terms with c the count in the sentence, t in the key's texts, w
    the idf (0 for a term that the table lacks): ``tf_mass`` of t w, ``mass`` of
    c w, ``both`` of c t w w, ``own`` of c c w w. ``whole`` is ``both`` of all
    sentences. Rows that share a key are one text's sentences or, with ``copies``,
    the same text, which counts once."""
    n = shuffle_partitions(df)
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    docs = df.select(key, *[x for x in df.columns if x != key])
    docs = docs.mapInArrow(_first_seen, docs.schema) if copies else docs
    # One exchange of the texts, by block. Both branches below read it; to be one, both read all of its
    # columns (the condition always holds).
    rest = [x for x in docs.columns if x not in (key, text)]
    reads_rest = F.xxhash64(*rest) >= F.lit(-1 << 63) if rest else F.lit(True)
    block = F.pmod(F.xxhash64(key), F.lit(max(2 * n, size // BLOCK_BYTES)))
    cut = docs.repartition(n, block).withColumn("block", block).withColumn("__s", sentences(F.col(text)))
    toks = F.transform("__s", word_tokens)
    need = (cut.select("block", F.explode_outer(F.when(reads_rest, F.array_distinct(F.flatten(toks)))).alias("term"))
            .filter(F.col("term").isNotNull()).distinct())
    own = need.join(idf, "term").select(F.col("block").alias("of"), "term", F.col("idf").cast("double").alias("idf"))
    cut = cut.select("block", F.col(key).alias("__key"), carry(F.col("__s")).alias("e"), toks.alias("toks"))
    each = T.StructType([T.StructField("spos", T.IntegerType()), T.StructField("n", T.IntegerType()),
                         *[T.StructField(x, T.DoubleType()) for x in _SUMS], T.StructField("e", cut.schema["e"].dataType.elementType)])
    schema = T.StructType([cut.schema["__key"], T.StructField("whole", T.DoubleType()), T.StructField("s", T.ArrayType(each))])
    sums = cut.groupBy("block").cogroup(own.repartition(n, "of").groupBy("of")).applyInArrow(
        lambda texts, terms: _block_sums(texts, terms, copies), schema)
    return sums.withColumnRenamed("__key", key)


def _ranked(df: DataFrame, key: str, text: str, idf: DataFrame | None, copies: bool = False) -> DataFrame:
    """(key, s): the scored sentences of each key, the best one first."""
    idf = document_idf(df, text) if idf is None else idf
    sums = sentence_sums(df.select(key, text).filter(F.col(key).isNotNull()), key, text, idf,
                         lambda s: F.transform(s, lambda x: F.struct(x.alias("sentence"))), copies)
    return sums.select(key, F.array_sort(F.transform("s", lambda x: F.struct(
        F.negative(F.round(F.when(x["n"] > 0, x["tf_mass"] / x["n"]).otherwise(F.lit(0.0)), 6)).alias("order"),
        x["spos"].alias("spos"), x["n"].alias("n_tokens"), x["e"]["sentence"].alias("sentence")))).alias("s"))


def sentence_scores(df: DataFrame, key: str, text: str, idf: DataFrame | None = None) -> DataFrame:
    """SU2 scoring: (key, spos, sentence, n_tokens, score, rank).

    score = sum over the sentence's distinct word tokens of (count of the term
    in the whole document x idf) / word tokens in the sentence, rounded to 6;
    idf = ln((1+n)/(1+df)) + 1 over the documents of ``df``. Rank 1 is the
    best sentence, ties to the earlier position. ``idf`` (term, idf) may come from other documents; a term
    that it lacks weighs nothing."""
    return (_ranked(df, key, text, idf).select(key, F.posexplode_outer("s").alias("at", "x"))
            .select(key, "x.spos", "x.sentence", "x.n_tokens", F.negative(F.col("x.order")).alias("score"), (F.col("at") + 1).alias("rank")))


def _grams(words, n):
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n > 0 else set()


def greedy_pick(rows: pd.DataFrame, min_tokens: int, max_tokens: int, block_ngram: int) -> list[int]:
    """Positions picked for one document, in rank order (see ``summarise``)."""
    picked, used, seen = [], 0, set()
    for r in rows.sort_values("rank").itertuples(index=False):
        if picked and used >= min_tokens:
            break
        words = str(r.sentence).split()
        if used + r.n_tokens > max_tokens:
            continue
        g = _grams([w.lower() for w in words], block_ngram)
        if block_ngram and g & seen:
            continue
        picked.append(int(r.spos))
        used += int(r.n_tokens)
        seen |= g
    return picked


def summarise(df: DataFrame, key: str, text: str, min_tokens: int = 40, max_tokens: int = 150,
              block_ngram: int = 0, idf: DataFrame | None = None) -> DataFrame:
    """SU2: extractive summary per document (``key_summaries``), a row for each
    row of ``df``; null for a text without sentences."""
    return df.select(key).join(key_summaries(df, key, text, min_tokens, max_tokens, block_ngram, idf), key, "left")


def key_summaries(df: DataFrame, key: str, text: str, min_tokens: int = 40, max_tokens: int = 150,
                  block_ngram: int = 0, idf: DataFrame | None = None, copies: bool = False) -> DataFrame:
    """(key, summary) of each key with a sentence. Rank in SQL, pick greedily: take
    sentences by rank, skipping one that would pass ``max_tokens`` or share a
    ``block_ngram``-gram (lower-cased words) with those already taken, until
    ``min_tokens`` is reached; if nothing fits, the top sentence cut to
    ``max_tokens`` words; output in document order. ``idf`` (term, idf): from
    other documents, as in ``sentence_scores``. ``copies``: rows that share a
    key have the same text, which counts once.

    The pick is sequential, so it is a fold (``aggregate``) over each
    document's rank-sorted sentence array - a native expression whose input is
    bounded by that one document."""
    per_doc = _ranked(df, key, text, idf, copies)
    init = F.struct(F.lit(0).alias("used"),
                    F.array().cast("array<struct<spos:int,sentence:string>>").alias("picked"),
                    F.array().cast("array<string>").alias("seen"))

    def taken(acc, x, grams):
        return F.struct((acc["used"] + x["n_tokens"]).alias("used"),
                        F.concat(acc["picked"], F.array(F.struct(x["spos"].alias("spos"),
                                                                 x["sentence"].alias("sentence")))).alias("picked"),
                        F.concat(acc["seen"], grams).alias("seen"))

    def unless_blocked(acc, x):
        def f(s):
            blocked = F.coalesce(F.arrays_overlap(s["acc"]["seen"], s["grams"]), F.lit(False))
            return F.when(blocked, s["acc"]).otherwise(taken(s["acc"], s["x"], s["grams"]))
        words = F.transform(tokens(x["sentence"]), F.lower)
        return let(f, acc=acc, x=x, grams=ngrams(words, block_ngram))

    def step(acc, x):
        stop = (F.size(acc["picked"]) > 0) & (acc["used"] >= min_tokens)
        too_long = acc["used"] + x["n_tokens"] > max_tokens
        take = unless_blocked(acc, x) if block_ngram else taken(acc, x, F.array().cast("array<string>"))
        return F.when(stop | too_long, acc).otherwise(take)

    picked = F.aggregate("s", init, step)["picked"]
    body = F.array_join(F.transform(F.array_sort(picked), lambda p: p["sentence"]), " ")
    fallback = F.array_join(F.slice(tokens(F.element_at("s", 1)["sentence"]), 1, max_tokens), " ")
    return per_doc.select(key, F.when(F.size(picked) > 0, body).otherwise(fallback).alias("summary"))


def summarise_with(df: DataFrame, key: str, text: str, make_fn: Callable[[], Callable[[str], str]],
                   max_in: int | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """SU1: run a supplied summariser over partitions. ``make_fn`` is called
    once per partition (model load). The text is passed untouched; with a
    preset's model input limit ``max_in`` (in words) it is cut after that
    word. A null text has a null summary; a failure yields a null summary
    with the error and the first 100 characters. With ``carry``, these columns
    come along, and the summary is named ``summary_made``."""
    made = "summary" if carry is None else "summary_made"
    schema = T.StructType([df.schema[c] for c in [key, *(carry or [])]] + [T.StructField(made, T.StringType()),
                                                                           T.StructField("error", T.StringType())])

    def run(batches):
        fn = make_fn()
        for pdf in batches:
            out, err = [], []
            for t in pdf[text]:
                try:
                    if t is not None and max_in is not None:
                        ends = [m.end() for m in islice(re.finditer(r"\S+", t), max_in)]
                        t = t[:ends[-1]] if ends else ""
                    out.append(None if t is None else fn(t))
                    err.append(None)
                except Exception as e:  # noqa: BLE001 - the error is the result
                    out.append(None)
                    err.append(f"{type(e).__name__}: {e} | {str(t)[:100]}")
            yield pd.DataFrame({**{c: pdf[c] for c in [key, *(carry or [])]}, made: out, "error": err})

    return df.select(*dict.fromkeys([key, text, *(carry or [])])).mapInPandas(run, schema=schema)


# A summariser is a function (df, key, text) -> (key, summary), one row for each row of ``df``.
Summariser = Callable[[DataFrame, str, str], DataFrame]


def extractive(preset: str) -> Summariser:
    """SU2 with a named preset."""
    p = PRESETS[preset]
    return lambda df, key, text: summarise(df, key, text, p["min_tokens"], p["max_tokens"], p["block_ngram"])


def supplied(make_fn: Callable[[], Callable[[str], str]], max_in: int | None = None) -> Summariser:
    """SU1 with a supplied function; a failed row has a null summary."""
    return lambda df, key, text: summarise_with(df, key, text, make_fn, max_in).select(key, "summary")
