"""Registered queries: one per inventory item, each a Spark plan over the
given tables plus, where SQL can express it, the DuckDB oracle statement.

Every query reads whole tables (no id subsets, no row caps beyond a limit
that is the feature itself, as in ``sample_n`` or a top-k report).
"""

from __future__ import annotations

import functools
import math
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein import fixed, session
from skein.functions import text as tx
from skein.functions import tokens as tk
from skein.operators import prep
from skein.operators import slang as sl
from skein.operators import terms
from skein.plans import sqltext as q
from skein.sources import fixtures as fx
from skein.sources import io


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | Callable[[], str] | None   # a callable is built when the statement is asked for


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | Callable[[], str] | None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf):
            session.ship_package(spark)
            return fn(spark, sf)
        REGISTRY[name] = Query(run, sql)
        return run
    return deco


def _corpus_sql(expr: str, alias: str = "clean") -> str:
    return f"SELECT kind, id, {expr} AS {alias} FROM ({fx.SQL['corpus']})"


def _corpus(spark, sf, fn, alias="clean"):
    return fx.corpus(spark, sf).select("kind", "id", fn(F.col("text")).alias(alias))


# ---------------------------------------------------------------- cleaning
@register("clean_links", _corpus_sql(q.links("text")))
def clean_links(spark, sf):
    return _corpus(spark, sf, tx.strip_links)


@register("clean_emails", _corpus_sql(q.emails("text")))
def clean_emails(spark, sf):
    return _corpus(spark, sf, tx.strip_emails)


@register("clean_mentions", _corpus_sql(q.mentions("text")))
def clean_mentions(spark, sf):
    return _corpus(spark, sf, tx.strip_mentions)


@register("clean_user_refs", _corpus_sql(q.user_refs("text")))
def clean_user_refs(spark, sf):
    return _corpus(spark, sf, tx.strip_user_refs)


@register("clean_parens", _corpus_sql(q.parens("text")))
def clean_parens(spark, sf):
    return _corpus(spark, sf, tx.strip_parens)


@register("clean_squeeze", _corpus_sql(q.squeeze("text")))
def clean_squeeze(spark, sf):
    return _corpus(spark, sf, tx.squeeze)


@register("clean_text", _corpus_sql(q.clean("text")))
def clean_text(spark, sf):
    return _corpus(spark, sf, tx.clean_text)


@register("expand_slang", _corpus_sql(q.slang("lower(text)")))
def expand_slang(spark, sf):
    return _corpus(spark, sf, lambda c: tx.expand_slang(F.lower(c)))


@register("normalise", _corpus_sql(q.normalise("text")))
def normalise(spark, sf):
    return _corpus(spark, sf, tx.normalise_col)


@register("normalise_cased", _corpus_sql(q.normalise("text", fixed.SLANG_APP, lower=False)))
def normalise_cased(spark, sf):
    return _corpus(spark, sf, lambda c: tx.normalise_col(c, fixed.SLANG_APP, lower=False))


@register("slang_stats",
          "SELECT slang, CAST(count(*) AS BIGINT) AS hits, CAST(count(DISTINCT (kind, id)) AS BIGINT) AS texts "
          f"FROM (SELECT kind, id, unnest({q.slang_hits('lower(' + q.clean('text') + ')')}) AS slang "
          f"FROM ({fx.SQL['corpus']})) GROUP BY slang")
def slang_stats(spark, sf):
    """Which slang entries fire, how often and in how many texts
    (explode straight into a partial aggregate)."""
    c = fx.corpus(spark, sf)
    hits = (c.select("kind", "id", F.explode_outer(tx.slang_hits(F.lower(tx.clean_text(F.col("text"))))).alias("slang"))
            .filter(F.col("slang").isNotNull()))
    return hits.groupBy("slang").agg(F.count(F.lit(1)).alias("hits"),
                                     F.count_distinct("kind", "id").alias("texts"))


@register("expand_slang_table", REGISTRY["expand_slang"].sql)
def expand_slang_table(spark, sf):
    """C9 by a table: the dictionary's entries, applied as a hash of any size."""
    low = fx.corpus(spark, sf).withColumn("text", F.lower("text"))
    return sl.expand_slang_table(low, "text", sl.slang_table(spark, fixed.SLANG), "clean").select("kind", "id", "clean")


@register("slang_table_stats",
          "WITH w AS (SELECT kind, id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS slang "
          f"FROM ({fx.SQL['corpus']})) SELECT slang, CAST(count(*) AS BIGINT) AS hits, "
          "CAST(count(DISTINCT (kind, id)) AS BIGINT) AS texts FROM w WHERE substr(md5(slang), 1, 1) < '4' GROUP BY slang")
def slang_table_stats(spark, sf):
    """C12 by a large table: a quarter of the corpus' own words as entries,
    which of them fire, how often and in how many texts."""
    c = fx.corpus(spark, sf).withColumn("text", F.lower("text"))
    words = (c.select(F.explode(F.regexp_extract_all("text", F.lit(fixed.WORD + "+"), F.lit(0))).alias("slang")).distinct()
             .filter(F.substring(F.md5("slang"), 1, 1) < "4"))
    table = words.select("slang", F.upper("slang").alias("expansion"), F.xxhash64("slang").alias("place"))
    hits = sl.expand_slang_table(c, "text", table).select("kind", "id", F.explode("slang_hits").alias("slang"))
    per_text = hits.groupBy("kind", "id", "slang").agg(F.count(F.lit(1)).alias("n"))
    return per_text.groupBy("slang").agg(F.sum("n").alias("hits"), F.count(F.lit(1)).alias("texts"))


# ---------------------------------------------------------------- tables (IO, U, P)
@register("union_by_name",
          "SELECT doc_id, text, lang FROM documents UNION ALL BY NAME SELECT item_id AS doc_id, text FROM benchmark")
def union_by_name(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text", "lang")
    bench = fx.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return io.combine([docs, bench])


@register("dedupe",
          "SELECT d.text, d.doc_id, d.lang, d.source, d.n_chars FROM documents d "
          "JOIN (SELECT text, min(doc_id) AS m FROM documents GROUP BY text) k ON d.doc_id = k.m")
def dedupe(spark, sf):
    return io.dedupe(fx.table(spark, sf, "documents"), ["text"], keep="doc_id")


@register("fill_text", f"SELECT doc_id, coalesce(text, '') AS text FROM ({fx.SQL['nulls']})")
def fill_text(spark, sf):
    return prep.fill_text(fx.nulls(spark, sf), ["text"]).select("doc_id", "text")


@register("drop_null_text", f"SELECT doc_id, text FROM ({fx.SQL['nulls']}) WHERE text IS NOT NULL")
def drop_null_text(spark, sf):
    return prep.drop_null_text(fx.nulls(spark, sf), ["text"]).select("doc_id", "text")


def _profile_sql() -> str:
    cols = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
    parts = [f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{t}' AS type, "
             f"CAST(count({c}) AS BIGINT) AS non_null, CAST(count(*) - count({c}) AS BIGINT) AS nulls "
             f"FROM ({fx.SQL['nulls']})" for i, (c, t) in enumerate(cols)]
    return " UNION ALL ".join(parts)


@register("profile", _profile_sql())
def profile(spark, sf):
    return io.profile(fx.nulls(spark, sf).select("doc_id", "text", "lang", "source", "n_chars"))


@register("flatten_arrays",
          f"SELECT doc_id, concat_ws(',', lang, source) AS ext_labels, "
          f"array_to_string({q.tokens('split_part(text, chr(10), 1)')}, ',') AS rg_labels FROM documents")
def flatten_arrays(spark, sf):
    d = fx.table(spark, sf, "documents").select(
        "doc_id", F.array("lang", "source").alias("ext_labels"), tk.tokens(fx.first_line(F.col("text"))).alias("rg_labels"))
    return io.flatten_arrays(d, {"ext_labels": ",", "rg_labels": ","})


@register("preview", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5")
def preview(spark, sf):
    """IO6: the first rows (ordered by key so the preview is reproducible)."""
    return io.preview(fx.table(spark, sf, "documents").orderBy("doc_id"), ["doc_id", "lang", "source"], 5)


@register("select_text", "SELECT text AS document, split_part(text, chr(10), 1) AS summary FROM documents")
def select_text(spark, sf):
    return prep.select_text(fx.pairs(spark, sf), ["document", "summary"])


_HASH_SQL = "md5(CAST(doc_id AS VARCHAR) || ':42')"


@register("sample_n", f"SELECT doc_id, lang, source FROM documents ORDER BY {_HASH_SQL}, doc_id LIMIT 100")
def sample_n(spark, sf):
    """P5 with the generation notebook's size (100 rows, seed 42)."""
    return prep.sample_n(fx.table(spark, sf, "documents"), 100, "doc_id", 42).select("doc_id", "lang", "source")


@register("split_exact",
          "SELECT doc_id, source, CASE WHEN rn <= ceil(0.2 * cnt) THEN 'test' ELSE 'train' END AS split FROM "
          f"(SELECT doc_id, source, row_number() OVER (ORDER BY {_HASH_SQL}, doc_id) AS rn, "
          "count(*) OVER () AS cnt FROM documents)")
def split_exact(spark, sf):
    return prep.split_column(fx.table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 0.2, 42)


@register("split_approx",
          "SELECT doc_id, source, CASE WHEN CAST(concat('0x', substr(" + _HASH_SQL + ", 1, 8)) AS BIGINT) < "
          f"{int(0.2 * 2 ** 32)} THEN 'test' ELSE 'train' END AS split FROM documents")
def split_approx(spark, sf):
    return prep.split_column(fx.table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 0.2, 42,
                             exact=False)


# ---------------------------------------------------------------- tokens
@register("tokens", f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS joined "
                    f"FROM (SELECT doc_id, {q.tokens('text')} AS t FROM documents)")
def tokens(spark, sf):
    d = fx.table(spark, sf, "documents").select("doc_id", tk.tokens(F.col("text")).alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), tk.join_tokens("t").alias("joined"))


@register("word_tokens", f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS joined "
                         f"FROM (SELECT doc_id, {q.word_tokens('text')} AS t FROM documents)")
def word_tokens(spark, sf):
    d = fx.table(spark, sf, "documents").select("doc_id", tk.word_tokens(F.col("text")).alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), tk.join_tokens("t").alias("joined"))


@register("remove_stops", f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS joined "
                          f"FROM (SELECT doc_id, {q.remove_stops(q.word_tokens('text'))} AS t FROM documents)")
def remove_stops(spark, sf):
    d = fx.table(spark, sf, "documents").select("doc_id", tk.remove_stops(tk.word_tokens(F.col("text"))).alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), tk.join_tokens("t").alias("joined"))


_VOCAB_SQL = (f"SELECT term, n, CAST(row_number() OVER (ORDER BY n DESC, term) AS INTEGER) AS rank FROM "
              f"(SELECT term, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({q.remove_stops(q.word_tokens('text'))}) "
              f"AS term FROM documents) GROUP BY term) QUALIFY rank <= 7000")


@register("vocabulary", _VOCAB_SQL)
def vocabulary(spark, sf):
    d = fx.table(spark, sf, "documents").select(tk.remove_stops(tk.word_tokens(F.col("text"))).alias("t"))
    return terms.vocabulary(d, "t", 7000)


@register("term_counts", f"SELECT doc_id, term, CAST(count(*) AS BIGINT) AS n FROM "
                         f"(SELECT doc_id, unnest({q.tokens('text')}) AS term FROM documents) GROUP BY doc_id, term")
def term_counts(spark, sf):
    d = fx.table(spark, sf, "documents").select("doc_id", tk.tokens(F.col("text")).alias("t"))
    return terms.term_counts(d, "doc_id", "t")


@register("doc_top_terms",
          "SELECT d.doc_id, coalesce(t.topics, 'No Topic') AS topics FROM documents d LEFT JOIN "
          "(SELECT doc_id, string_agg(term, ' + ' ORDER BY r) AS topics FROM "
          "(SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, term) AS r FROM "
          f"(SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({q.tokens('normalised')}) AS term FROM "
          f"(SELECT doc_id, {q.normalise('text')} AS normalised FROM documents)) GROUP BY doc_id, term)) "
          "WHERE r <= 5 GROUP BY doc_id) t ON d.doc_id = t.doc_id")
def doc_top_terms(spark, sf):
    """T7 over the normalised text, as the analysis job runs it."""
    d = fx.table(spark, sf, "documents").select("doc_id", tk.tokens(tx.normalise_col(F.col("text"))).alias("t"))
    return terms.doc_top_terms(d, "doc_id", "t", 5)


def _ids_sql(col: str, width: int) -> str:
    return (f"list_transform(({q.word_tokens(col)})[1:{width}], "
            f"lambda t: coalesce(m[t], 1))")


_ENCODE_SQL = (
    f"WITH vocab AS ({_VOCAB_SQL}), "
    "vmap AS (SELECT map(list(term ORDER BY term), list(CAST(rank + 1 AS INTEGER) ORDER BY term)) AS m FROM vocab), "
    f"enc AS (SELECT doc_id, {_ids_sql('text', 1024)} AS i, {_ids_sql('split_part(text, chr(10), 1)', 150)} AS l "
    "FROM documents, vmap), w AS (SELECT max(len(i)) AS wi, max(len(l)) AS wl FROM enc) "
    "SELECT doc_id, array_to_string(list_resize(i, wi, 0), ' ') AS input_ids, "
    "CAST(len(i) AS INTEGER) AS attention, array_to_string(list_resize(l, wl, 0), ' ') AS labels FROM enc, w")


@register("encode_pairs", _ENCODE_SQL)
def encode_pairs(spark, sf):
    """Vocabulary ids (stop words removed when fitting the vocabulary, not
    when encoding), 1024 input / 150 label positions, padded to the longest."""
    p = fx.pairs(spark, sf).select("doc_id", tk.word_tokens(F.col("document")).alias("dt"),
                                   tk.word_tokens(F.col("summary")).alias("st"))
    vocab = terms.vocabulary(p.select(tk.remove_stops(F.col("dt")).alias("t")), "t", 7000)
    e = terms.encode_pairs(p, "doc_id", "dt", "st", vocab, 1024, 150, pad="longest")
    return e.select("doc_id", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("attention"),
                    F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"))


# ---------------------------------------------------------------- pair metrics (SI, Q)
from skein.operators import quality as qa  # noqa: E402
from skein.operators import tfidf as tf  # noqa: E402


def _r6(c):
    return F.round(c, 6)


_JACCARD_PAIRS = (("jaccard_doc_summary", "document", "summary"),
                  ("jaccard_summary_predicted", "summary", "predicted_summary"),
                  ("jaccard_doc_predicted", "document", "predicted_summary"))


@register("jaccard", "SELECT doc_id, " + ", ".join(f"round({q.jaccard(a, b)}, 6) AS {n}" for n, a, b in _JACCARD_PAIRS)
          + f" FROM ({fx.SQL['pairs3']})")
def jaccard(spark, sf):
    p = fx.pairs3(spark, sf)
    return p.select("doc_id", *[_r6(tk.jaccard(F.col(a), F.col(b))).alias(n) for n, a, b in _JACCARD_PAIRS])


@register("melt", " UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS Type, round({q.jaccard(a, b)}, 6) AS value FROM ({fx.SQL['pairs3']})"
    for n, a, b in _JACCARD_PAIRS))
def melt(spark, sf):
    """The three similarity columns as a long (Type, value) table."""
    return prep.melt(jaccard(spark, sf), ["doc_id"], [n for n, _, _ in _JACCARD_PAIRS], "Type", "value")


@register("token_f1", f"SELECT doc_id, round({q.token_f1('summary', 'predicted_summary')}, 6) AS token_f1 "
                      f"FROM ({fx.SQL['pairs3']})")
def token_f1(spark, sf):
    p = fx.pairs3(spark, sf)
    return p.select("doc_id", _r6(tk.token_f1(F.col("summary"), F.col("predicted_summary"))).alias("token_f1"))


_SCORES_SQL = q.pair_scores(fx.SQL["pairs3"], "doc_id", "summary", "predicted_summary", ", lang, source")


def _scores(spark, sf):
    p = fx.pairs3(spark, sf)
    return qa.score_pairs(p, "doc_id", "summary", "predicted_summary", carry=["lang", "source"])


@register("pair_metrics", f"SELECT doc_id, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2, "
                          f"round(bleu, 6) AS bleu, round(token_f1, 6) AS token_f1 FROM ({_SCORES_SQL})")
def pair_metrics(spark, sf):
    """SI5: ROUGE-1/2, BLEU and token F1 from one shared n-gram pass."""
    s = qa.score_pairs(fx.pairs3(spark, sf), "doc_id", "summary", "predicted_summary")
    return s.select("doc_id", *[_r6(F.col(c)).alias(c) for c in ("rouge1", "rouge2", "bleu", "token_f1")])


def _one_sql(metric: str) -> str:
    scores = q.pair_scores(fx.SQL["pairs3"], "doc_id", "summary", "predicted_summary", metrics=(metric,))
    return f"SELECT doc_id, round({metric}, 6) AS {metric} FROM ({scores})"


def _one(spark, sf, metric: str, **made):
    s = qa.score_pairs(fx.pairs3(spark, sf), "doc_id", "summary", "predicted_summary", **made)
    return s.select("doc_id", _r6(F.col(metric)).alias(metric))


@register("rouge_1", _one_sql("rouge1"))
def rouge_1(spark, sf):
    return _one(spark, sf, "rouge1", rouge_orders=(1,), bleu=False)


@register("rouge_2", _one_sql("rouge2"))
def rouge_2(spark, sf):
    return _one(spark, sf, "rouge2", rouge_orders=(2,), bleu=False)


@register("bleu", _one_sql("bleu"))
def bleu(spark, sf):
    return _one(spark, sf, "bleu", rouge_orders=())


@register("bleu_turns", "SELECT conv_id, turn, round(bleu, 6) AS bleu FROM (" +
          q.pair_scores(f"SELECT conv_id * 1000 + turn AS k, * FROM ({fx.SQL['turn_pairs']})", "k", "summary",
                        "document", ", conv_id, turn") + ")")
def bleu_turns(spark, sf):
    """Q5 on user/assistant turn pairs (mostly the zero path)."""
    t = fx.turn_pairs(spark, sf).withColumn("k", F.col("conv_id") * 1000 + F.col("turn"))
    s = qa.score_pairs(t, "k", "summary", "document", carry=["conv_id", "turn"])
    return s.select("conv_id", "turn", _r6(F.col("bleu")).alias("bleu"))


_AVG = ", ".join(f"round(avg({m}), 6) AS {m}" for m in qa.METRICS)


@register("evaluate", f"SELECT {_AVG}, CAST(count(*) AS BIGINT) AS n FROM ({_SCORES_SQL})")
def evaluate(spark, sf):
    """Q7: one row of averages (the driver receives one row)."""
    e = qa.evaluate(_scores(spark, sf))
    return e.select(*[_r6(F.col(m)).alias(m) for m in qa.METRICS], "n")


@register("evaluate_rollup", f"SELECT lang, source, {_AVG}, CAST(count(*) AS BIGINT) AS n FROM ({_SCORES_SQL}) "
                             "GROUP BY ROLLUP (lang, source)")
def evaluate_rollup(spark, sf):
    """Q8: averages per language and source with subtotals and a grand total."""
    e = qa.evaluate(_scores(spark, sf), by=["lang", "source"], rollup=True)
    return e.select("lang", "source", *[_r6(F.col(m)).alias(m) for m in qa.METRICS], "n")


@register("evaluate_stemmed", None)
def evaluate_stemmed(spark, sf):
    """Q3, Q4, Q7, Q8: stemmed ROUGE-1/2/L, BLEU and token F1, averaged per
    language with a total, for the three pairs of text columns."""
    names = ["rouge1", "rouge2", "rougeL", "bleu", "token_f1"]
    scored = qa.score_all(fx.pairs3(spark, sf), "doc_id", _TEXT_PAIRS, ["lang"], rouge_l=True, stem=True)
    averages = [F.avg(m).alias(m) for m in names]
    e = scored.groupingSets([["pair", "lang"], ["pair"]], "pair", "lang").agg(*averages, F.count(F.lit(1)).alias("n"))
    return e.select("pair", "lang", *[_r6(F.col(m)).alias(m) for m in names], "n")


_TEXT_PAIRS = (("doc_summary", "document", "summary"), ("summary_predicted", "summary", "predicted_summary"),
               ("doc_predicted", "document", "predicted_summary"))


@register("pair_metrics_all", None)
def pair_metrics_all(spark, sf):
    """SI5: ROUGE-1/2, BLEU and token F1 of all three pairs of text columns
    (whole documents among them) in one scan. SQL takes minutes for the whole
    documents' grams; tests hold it against plain counts."""
    s = qa.score_all(fx.pairs3(spark, sf), "doc_id", _TEXT_PAIRS)
    return s.select("doc_id", "pair", *[_r6(F.col(c)).alias(c) for c in qa.METRICS])


@register("semantic_distance",
          "SELECT vec_id, round(CASE WHEN list_dot_product(a::DOUBLE[], a::DOUBLE[]) = 0 OR "
          "list_dot_product(b::DOUBLE[], b::DOUBLE[]) = 0 THEN 1.0 ELSE "
          "1.0 - list_cosine_similarity(a::DOUBLE[], b::DOUBLE[]) END, 6) AS semantic_distance "
          f"FROM ({fx.SQL['embedding_pairs']})")
def semantic_distance(spark, sf):
    e = fx.embedding_pairs(spark, sf)
    return e.select("vec_id", _r6(tk.semantic_distance(F.col("a"), F.col("b"))).alias("semantic_distance"))


# TF-IDF: weights fitted on the documents (stop words out, 7,000 terms).
def _tfidf_sql(apply_col: str) -> str:
    toks = q.remove_stops(q.word_tokens("text"))
    atoks = q.remove_stops(q.word_tokens(apply_col))
    return (f"WITH t AS (SELECT doc_id, unnest({toks}) AS term FROM documents), "
            "tc AS (SELECT doc_id, term, count(*) AS c FROM t GROUP BY ALL), "
            "v AS (SELECT term, sum(c) AS tf, count(*) AS df FROM tc GROUP BY term ORDER BY tf DESC, term LIMIT 7000), "
            "idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0 AS idf FROM v), "
            f"a AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest({atoks}) AS term FROM documents) "
            "GROUP BY ALL), w AS (SELECT doc_id, term, c * idf AS w FROM a JOIN idf USING (term)) "
            "SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w")


def _tfidf(spark, sf, apply_first_line: bool):
    d = fx.table(spark, sf, "documents")
    fit = d.select("doc_id", tk.remove_stops(tk.word_tokens(F.col("text"))).alias("t"))
    idf = tf.fit_tfidf(fit, "doc_id", "t", size=7000)
    src = fx.first_line(F.col("text")) if apply_first_line else F.col("text")
    app = d.select("doc_id", tk.remove_stops(tk.word_tokens(src)).alias("t"))
    w = tf.tfidf_weights(app, "doc_id", "t", idf, bounded=True)
    return w.select("doc_id", "term", _r6(F.col("weight")).alias("weight"))


@register("tfidf_weights", _tfidf_sql("text"))
def tfidf_weights(spark, sf):
    """M1: fit on the documents, weights of the documents themselves."""
    return _tfidf(spark, sf, False)


@register("tfidf_apply", _tfidf_sql("split_part(text, chr(10), 1)"))
def tfidf_apply(spark, sf):
    """M2: the fitted vocabulary applied to another column (first lines)."""
    return _tfidf(spark, sf, True)


@register("tfidf_refreshed", REGISTRY["tfidf_weights"].sql)
def tfidf_refreshed(spark, sf):
    """M1/M2 as a kept model: counts fitted on one half of the documents and
    saved, refreshed with the other half's, saved and loaded again; the
    weights are those of a fit on all."""
    d = fx.table(spark, sf, "documents").select("doc_id", tk.remove_stops(tk.word_tokens(F.col("text"))).alias("t"))
    half = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0, F.lit(True))
    first, model = _fresh(spark, "idf"), _fresh(spark, "idf")
    tf.tfidf_counts(d.filter(half), "doc_id", "t").write.parquet(first)
    tf.merged_counts(spark.read.parquet(first), tf.tfidf_counts(d.filter(~half), "doc_id", "t")).write.parquet(model)
    w = tf.tfidf_weights(d, "doc_id", "t", tf.idf_of(spark.read.parquet(model), 7000), bounded=True)
    return w.select("doc_id", "term", _r6(F.col("weight")).alias("weight"))


_COS_PAIRS = (("cosine_sim_doc_summary", "document", "summary"),
              ("cosine_sim_summary_predicted", "summary", "predicted_summary"),
              ("cosine_sim_doc_predicted", "document", "predicted_summary"))
_COS_COLS = ("document", "summary", "predicted_summary")


def _cosine_sql() -> str:
    t = " UNION ALL ".join(f"SELECT doc_id, {i} AS side, unnest({q.word_tokens(c)}) AS term FROM p"
                           for i, c in enumerate(_COS_COLS))
    idx = {c: i for i, c in enumerate(_COS_COLS)}
    sims = ", ".join(f"round(coalesce(sum(w{idx[a]} * w{idx[b]}), 0.0), 6) AS {n}" for n, a, b in _COS_PAIRS)
    return (f"WITH p AS ({fx.SQL['pairs3']}), t AS ({t}), "
            "dfc AS (SELECT term, count(DISTINCT doc_id) AS df FROM t WHERE side = 0 GROUP BY term), "
            "idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM p)) / (1.0 + df)) + 1.0 AS idf FROM dfc), "
            "tf AS (SELECT doc_id, side, term, count(*) AS c FROM t GROUP BY ALL), "
            "w AS (SELECT doc_id, side, term, c * idf AS w FROM tf JOIN idf USING (term)), "
            "wn AS (SELECT doc_id, side, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, side)) AS w FROM w), "
            "pt AS (SELECT doc_id, term, " + ", ".join(f"sum(w) FILTER (WHERE side = {i}) AS w{i}" for i in range(3))
            + " FROM wn GROUP BY doc_id, term) "
            f"SELECT p.doc_id, {sims} FROM p LEFT JOIN pt USING (doc_id) GROUP BY p.doc_id")


@register("cosine_tfidf", _cosine_sql())
def cosine_tfidf(spark, sf):
    """SI1: TF-IDF fitted on the documents (default vectoriser: no stop list,
    no cap), cosine for the three column pairs."""
    p = fx.pairs3(spark, sf)
    c = tf.cosine_tfidf(p, "doc_id", _COS_COLS, _COS_PAIRS, "document", tk.word_tokens)
    return c.select("doc_id", *[_r6(F.col(n)).alias(n) for n, _, _ in _COS_PAIRS])


# ---------------------------------------------------------------- flagship
def _flagship_src_sql() -> str:
    return (f"SELECT doc_id, lang, {q.normalise('summary')} AS summary, "
            f"{q.normalise(q.lead('document', 3))} AS predicted_summary FROM ({fx.SQL['pairs']})")


@register("flagship", f"SELECT lang, {_AVG.replace('token_f1), 6) AS token_f1', 'token_f1), 6) AS token_f1')}, "
                      f"round(avg(jaccard), 6) AS jaccard, CAST(count(*) AS BIGINT) AS n FROM ("
                      f"SELECT s.*, {q.jaccard('x.summary', 'x.predicted_summary')} AS jaccard FROM ("
                      + q.pair_scores(_flagship_src_sql(), "doc_id", "summary", "predicted_summary", ", lang")
                      + f") s JOIN ({_flagship_src_sql()}) x USING (doc_id)) GROUP BY ROLLUP (lang)")
def flagship(spark, sf):
    """pairs -> normalise -> lead-3 extractive summary -> Jaccard, ROUGE-1/2,
    BLEU, token F1 -> averages per language with a grand total."""
    from skein.operators.summarise import lead_k

    p = fx.pairs(spark, sf)
    p = p.select("doc_id", "lang", tx.normalise_col(F.col("summary")).alias("summary"),
                 tx.normalise_col(lead_k(F.col("document"), 3)).alias("predicted_summary"))
    s = qa.score_pairs(p, "doc_id", "summary", "predicted_summary",
                       carry={"lang": F.col("lang"), "jaccard": tk.jaccard(F.col("summary"), F.col("predicted_summary"))})
    e = qa.evaluate(s, metrics=list(qa.METRICS) + ["jaccard"], by=["lang"], rollup=True)
    return e.select("lang", *[_r6(F.col(m)).alias(m) for m in list(qa.METRICS) + ["jaccard"]], "n")


# ---------------------------------------------------------------- sentiment (SE1-SE4)
from skein.operators import sentiment as se  # noqa: E402


@register("sentiment_score", "SELECT doc_id, score FROM (" +
          q.sentiment("SELECT doc_id, text FROM documents", "doc_id", ["text"], fx.SQL["lexicon"]) + ")")
def sentiment_score(spark, sf):
    """SE1: compound score of every document with the corpus-derived lexicon."""
    d = fx.table(spark, sf, "documents").select("doc_id", "text")
    return se.sentiment_long(d, "doc_id", ["text"], fx.lexicon(spark, sf)).select("doc_id", "score")


_SENT_COLS = ["document", "summary", "predicted_summary"]
_SENT2 = q.sentiment(fx.SQL["pairs3"], "doc_id", _SENT_COLS, fx.SQL["lexicon"])
_SENT2_WIDE = ("SELECT doc_id, " + ", ".join(f"max(score) FILTER (WHERE \"column\" = '{c}') AS {c}_score" for c in _SENT_COLS)
               + " FROM (" + _SENT2 + ") GROUP BY doc_id")


@register("sentiment_label", "SELECT doc_id, " + ", ".join(f"{c}_score, {q.label(c + '_score')} AS {c}_sentiment" for c in _SENT_COLS)
          + f" FROM ({_SENT2_WIDE})")
def sentiment_label(spark, sf):
    """SE2/SE3: three text columns scored in one token pass, score and label kept."""
    return se.sentiment_scores(fx.pairs3(spark, sf), "doc_id", _SENT_COLS, fx.lexicon(spark, sf))


@register("sentiment_summary",
          "SELECT lang, " + ", ".join(f"CAST(count(*) FILTER (WHERE lab = '{x}') AS BIGINT) AS {x}"
                                      for x in ("Positive", "Neutral", "Negative"))
          + f" FROM (SELECT p.lang, {q.label('w.document_score')} AS lab FROM ({fx.SQL['pairs']}) p "
            f"JOIN ({_SENT2_WIDE}) w USING (doc_id)) GROUP BY lang")
def sentiment_summary(spark, sf):
    """SE4: document label counts per language."""
    p = fx.pairs(spark, sf)
    s = se.sentiment_scores(p, "doc_id", ["document", "summary"], fx.lexicon(spark, sf))
    return se.sentiment_summary(s.join(p.select("doc_id", "lang"), "doc_id"), ["lang"], "document_sentiment")


# ---------------------------------------------------------------- summaries (SU)
from skein.operators import summarise as su  # noqa: E402


@register("lead_k", f"SELECT doc_id, {q.lead('text', 3)} AS lead FROM documents")
def lead_k(spark, sf):
    """SU4: lead-3 baseline summary of every document."""
    return fx.table(spark, sf, "documents").select("doc_id", su.lead_k(F.col("text"), 3).alias("lead"))


_SENT_SCORES_SQL = f"""
WITH d AS (SELECT doc_id, text FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({q.word_tokens('text')}) AS term FROM d) GROUP BY ALL),
idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM d)) / (1.0 + count(*))) + 1.0 AS idf FROM tf GROUP BY term),
s AS (SELECT doc_id, unnest(range(0, len(ss))) AS spos, unnest(ss) AS sentence FROM (SELECT doc_id, {q.sentences('text')} AS ss FROM d)),
st AS (SELECT doc_id, spos, sentence, {q.word_tokens('sentence')} AS st FROM s),
terms AS (SELECT doc_id, spos, unnest(list_distinct(st)) AS term FROM st),
mass AS (SELECT doc_id, spos, sum(tf * idf) AS mass FROM terms JOIN tf USING (doc_id, term) JOIN idf USING (term) GROUP BY ALL),
sc AS (SELECT st.doc_id, st.spos, st.sentence, len(st.st) AS n_tokens,
        round(CASE WHEN len(st.st) > 0 THEN coalesce(mass, 0.0) / len(st.st) ELSE 0.0 END, 6) AS score
       FROM st LEFT JOIN mass USING (doc_id, spos))
SELECT doc_id, CAST(spos AS INTEGER) AS spos, sentence, CAST(n_tokens AS INTEGER) AS n_tokens, score,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, spos) AS INTEGER) AS rank FROM sc"""


@register("sentence_scores", _SENT_SCORES_SQL)
def sentence_scores(spark, sf):
    """SU2 scoring and ranking of every sentence of every document."""
    return su.sentence_scores(fx.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")


@register("summarise", None)
def summarise(spark, sf):
    """SU2: extractive summaries with the batch preset (40..150 tokens)."""
    d = fx.table(spark, sf, "documents").select("doc_id", "text")
    p = su.PRESETS["batch"]
    return su.summarise(d, "doc_id", "text", p["min_tokens"], p["max_tokens"], p["block_ngram"])


@register("rouge_l", None)
def rouge_l(spark, sf):
    """Q3: ROUGE-L F of summary vs lead-2 via the bit-parallel LCS UDF."""
    p = fx.pairs3(spark, sf).select("doc_id", tk.rouge_tokens(F.col("summary")).alias("r"),
                                    tk.rouge_tokens(F.col("predicted_summary")).alias("h"))
    return p.select("doc_id", _r6(qa.rouge_l_f(F.col("r"), F.col("h"))).alias("rougeL"))


# ---------------------------------------------------------------- distributions (D)
from skein.operators import dist  # noqa: E402

_J_COLS = [n for n, _, _ in _JACCARD_PAIRS]
_J_LONG_SQL = " UNION ALL ".join(f"SELECT '{n}' AS series, {q.jaccard(a, b)} AS x FROM ({fx.SQL['pairs3']})"
                                 for n, a, b in _JACCARD_PAIRS)


def _jaccard_raw(spark, sf):
    p = fx.pairs3(spark, sf)
    return p.select("doc_id", *[tk.jaccard(F.col(a), F.col(b)).alias(n) for n, a, b in _JACCARD_PAIRS])


@register("histogram", f"""
WITH long AS ({_J_LONG_SQL}),
rng AS (SELECT series, min(x) AS mn, max(x) AS mx FROM long GROUP BY series),
b AS (SELECT l.series, x, mn, mx, CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((x - mn) / ((mx - mn) / 20)), 19) END AS INTEGER) AS bin
      FROM long l JOIN rng USING (series))
SELECT series, bin, round(CASE WHEN mx = mn THEN mn ELSE mn + bin * ((mx - mn) / 20) END, 6) AS lo,
       round(CASE WHEN mx = mn THEN mx ELSE mn + (bin + 1) * ((mx - mn) / 20) END, 6) AS hi, CAST(count(*) AS BIGINT) AS n
FROM b GROUP BY series, bin, mn, mx""")
def histogram(spark, sf):
    """20-bin histograms of the three Jaccard series."""
    return dist.histogram(_jaccard_raw(spark, sf), _J_COLS, 20)


_S2PI = repr(math.sqrt(2 * math.pi))


@register("density", f"""
WITH w AS ({_SENT2_WIDE}),
long AS (SELECT 'document_score' AS series, document_score AS x FROM w WHERE document_score IS NOT NULL
         UNION ALL SELECT 'summary_score', summary_score FROM w WHERE summary_score IS NOT NULL
         UNION ALL SELECT 'predicted_summary_score', predicted_summary_score FROM w WHERE predicted_summary_score IS NOT NULL),
stats AS (SELECT series, count(*) AS n, stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM long GROUP BY series),
binned AS (SELECT series, floor(x * 1000 + 0.5) / 1000 AS b, count(*) AS c FROM long GROUP BY ALL),
g AS (SELECT unnest(range(0, 200)) AS i),
contrib AS (SELECT series, i, n, h, CAST(-1.0 AS DOUBLE) + CAST(2.0 AS DOUBLE) * i / CAST(199 AS DOUBLE) AS gx, b, c FROM binned JOIN stats USING (series), g)
SELECT series, CAST(i AS INTEGER) AS i, round(gx, 6) AS x,
       round(CASE WHEN h > 0 THEN sum(c * exp(-pow((gx - b) / h, 2) / 2)) / (n * h * CAST({_S2PI} AS DOUBLE)) END, 6) AS y
FROM contrib GROUP BY series, i, gx, n, h""")
def density(spark, sf):
    """Kernel density of the sentiment of documents, summaries and
    predicted summaries on [-1, 1]."""
    s = se.sentiment_scores(fx.pairs3(spark, sf), "doc_id", _SENT_COLS, fx.lexicon(spark, sf), labels=False)
    d = dist.density(s, [f"{c}_score" for c in _SENT_COLS], -1.0, 1.0, 200)
    return d.select("series", F.col("i").cast("int").alias("i"), "x", "y")


# D1/D2 of the other two similarities: TF-IDF cosine of the three pairs, and the distance of embedding pairs.
_SIM_COLS = [n for n, _, _ in _COS_PAIRS] + ["semantic_distance"]
_SIM_LONG_SQL = f"WITH c AS MATERIALIZED ({_cosine_sql()}) " + " UNION ALL ".join(
    [f"SELECT '{n}' AS series, {n} AS x FROM c" for n, _, _ in _COS_PAIRS]
    + [f"SELECT 'semantic_distance', semantic_distance FROM ({REGISTRY['semantic_distance'].sql})"])


def _similarities(spark, sf):
    return cosine_tfidf(spark, sf).unionByName(semantic_distance(spark, sf), allowMissingColumns=True)


@register("similarity_histogram", REGISTRY["histogram"].sql.replace(_J_LONG_SQL, _SIM_LONG_SQL))
def similarity_histogram(spark, sf):
    """20-bin histograms of TF-IDF cosines and embedding distances."""
    return dist.histogram(_similarities(spark, sf), _SIM_COLS, 20)


@register("similarity_density", f"""
WITH long AS ({_SIM_LONG_SQL}),
stats AS (SELECT series, count(*) AS n, stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM long GROUP BY series),
binned AS (SELECT series, floor(x * 1000 + 0.5) / 1000 AS b, count(*) AS c FROM long GROUP BY ALL),
g AS (SELECT unnest(range(0, 200)) AS i),
contrib AS (SELECT series, i, n, h, CAST(0.0 AS DOUBLE) + CAST(1.5 AS DOUBLE) * i / CAST(199 AS DOUBLE) AS gx, b, c FROM binned JOIN stats USING (series), g)
SELECT series, CAST(i AS INTEGER) AS i, round(gx, 6) AS x,
       round(CASE WHEN h > 0 THEN sum(c * exp(-pow((gx - b) / h, 2) / 2)) / (n * h * CAST({_S2PI} AS DOUBLE)) END, 6) AS y
FROM contrib GROUP BY series, i, gx, n, h""")
def similarity_density(spark, sf):
    """Density curves of TF-IDF cosines and embedding distances on [0, 1.5]."""
    d = dist.density(_similarities(spark, sf), _SIM_COLS, 0.0, 1.5, 200)
    return d.select("series", F.col("i").cast("int").alias("i"), "x", "y")


@register("metric_summary", f"SELECT series, CAST(count(*) AS BIGINT) AS n, round(avg(x), 6) AS mean, "
                            f"round(stddev_samp(x), 6) AS sd, min(x) AS min, max(x) AS max FROM ({_J_LONG_SQL}) "
                            "GROUP BY series")
def metric_summary(spark, sf):
    """Numeric summary of the three Jaccard series."""
    return dist.metric_summary(_jaccard_raw(spark, sf), _J_COLS)


_QUANTS = (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))


@register("metric_quantiles", f"WITH r AS (SELECT series, x, row_number() OVER (PARTITION BY series ORDER BY x) AS rk, "
                              f"count(*) OVER (PARTITION BY series) AS n FROM ({_J_LONG_SQL}) WHERE x IS NOT NULL) "
                              "SELECT series, " + ", ".join(f"min(x) FILTER (WHERE rk >= ceil({p} * n)) AS {c}"
                                                            for c, p in _QUANTS) + " FROM r GROUP BY series")
def metric_quantiles(spark, sf):
    """D4 quartiles of the three Jaccard series, exact at any size."""
    q = dist.metric_quantiles(_jaccard_raw(spark, sf), _J_COLS, [p for _, p in _QUANTS])
    return q.select("series", *[F.col("q")[i].alias(c) for i, (c, _) in enumerate(_QUANTS)])


# ---------------------------------------------------------------- hashtags (H)
from skein.operators import tags as tg  # noqa: E402


def _kp_sql(src: str) -> str:
    stops = q.stop_list()
    W = q.W

    def runs(member: str, kind: int) -> str:
        return (f"(SELECT doc_id, {kind} AS kind, string_agg(tok, ' ' ORDER BY pos) AS phrase, min(pos) AS first_pos, "
                f"count(*) AS n_words, max(CAST(sent_start AS INTEGER)) AS starts FROM "
                f"(SELECT *, sum(CASE WHEN {member} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos "
                f"ROWS UNBOUNDED PRECEDING) AS run FROM f2) WHERE {member} GROUP BY doc_id, run)")

    return f"""
WITH src AS ({src}),
toks AS (SELECT doc_id, unnest(range(0, len(tt))) AS pos, unnest(tt) AS tok FROM (SELECT doc_id, {q.symbol_tokens('text')} AS tt FROM src)),
f AS (SELECT *, regexp_matches(tok, '^{W}') AS is_word, list_contains({stops}, lower(tok)) AS is_stop,
        lag(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS prev FROM toks),
f2 AS (SELECT *, is_word AND regexp_matches(tok, '^\\p{{Lu}}') AS is_cap,
        (pos = 0 OR coalesce(prev IN ('.', '!', '?'), false)) AS sent_start FROM f),
cands AS (SELECT * FROM {runs('is_word AND NOT is_stop', 1)}
          UNION ALL SELECT * FROM {runs('is_cap', 0)} WHERE NOT (n_words = 1 AND starts = 1)),
kp AS (SELECT doc_id, phrase, min(kind) AS kind, CAST(count(*) AS BIGINT) AS freq, min(first_pos) AS first_pos
       FROM cands WHERE NOT list_contains({stops}, lower(phrase)) GROUP BY doc_id, phrase)"""


_TAG_SRC = f"SELECT doc_id, lang, predicted_summary AS text FROM ({fx.SQL['pairs3']})"
_TAGS_SQL = (_kp_sql(_TAG_SRC) + ", top AS (SELECT doc_id, '#' || lower(replace(phrase, ' ', '')) AS tag, "
             "row_number() OVER (PARTITION BY doc_id ORDER BY kind, freq DESC, first_pos, phrase) AS r FROM kp QUALIFY r <= 3), "
             "line AS (SELECT doc_id, string_agg(tag, ', ' ORDER BY r) AS line FROM top GROUP BY doc_id) ")


@register("key_phrases", _kp_sql(_TAG_SRC) + " SELECT doc_id, phrase, CAST(kind AS INTEGER) AS kind, freq, "
                                             "CAST(first_pos AS INTEGER) AS first_pos FROM kp")
def key_phrases(spark, sf):
    """H1-H3: candidate phrases of every lead-2 summary."""
    src = fx.pairs3(spark, sf).select("doc_id", F.col("predicted_summary").alias("text"))
    k = tg.key_phrases(src, "doc_id", "text")
    return k.select("doc_id", "phrase", F.col("kind").cast("int").alias("kind"), "freq",
                    F.col("first_pos").cast("int").alias("first_pos"))


@register("hashtags", _TAGS_SQL + f"SELECT s.doc_id, coalesce(line.line, '') AS hashtag_line FROM ({_TAG_SRC}) s "
                                  "LEFT JOIN line USING (doc_id)")
def hashtags(spark, sf):
    """H4/H5: three hashtags per summary, joined for display."""
    src = fx.pairs3(spark, sf).select("doc_id", F.col("predicted_summary").alias("text"))
    return tg.hashtags(src, "doc_id", "text", 3).select("doc_id", "hashtag_line")


@register("hashtag_counts", _TAGS_SQL + "SELECT lang, tag, n, CAST(rank AS INTEGER) AS rank FROM ("
                                        "SELECT lang, tag, CAST(count(*) AS BIGINT) AS n, row_number() OVER "
                                        "(PARTITION BY lang ORDER BY count(*) DESC, tag) AS rank FROM top JOIN "
                                        f"({_TAG_SRC}) s USING (doc_id) GROUP BY lang, tag) WHERE rank <= 10")
def hashtag_counts(spark, sf):
    """H6: the ten most used hashtags per language."""
    src = fx.pairs3(spark, sf).select("doc_id", "lang", F.col("predicted_summary").alias("text"))
    t = tg.hashtags(src, "doc_id", "text", 3).join(src.select("doc_id", "lang"), "doc_id")
    return tg.hashtag_counts(t, ["lang"], 10).select("lang", "tag", "n", F.col("rank").cast("int").alias("rank"))


@register("share_url", f"SELECT doc_id, {q.lit(fixed.SHARE_PREFIX)} || summary AS url, {q.lit(fixed.SHARE_PREFIX)} || "
                       "replace(replace(replace(url_encode(summary), '%20', '+'), '%2A', '*'), '~', '%7E') AS url_encoded "
                       f"FROM ({fx.SQL['pairs']})")
def share_url(spark, sf):
    """H7: share link, raw as the app builds it and URL-encoded."""
    p = fx.pairs(spark, sf)
    return p.select("doc_id", tk.share_url(F.col("summary")).alias("url"),
                    tk.share_url(F.col("summary"), encode=True).alias("url_encoded"))


# ---------------------------------------------------------------- topics (M)
from skein.operators import topics as tp  # noqa: E402


@register("enrich_with_topics", f"""
WITH t AS (SELECT doc_id, CAST(doc_id % 10 AS INTEGER) AS topic, text FROM documents),
c AS (SELECT topic, term, count(*) AS n FROM (SELECT topic, unnest({q.remove_stops(q.word_tokens('text'))}) AS term FROM t) GROUP BY ALL),
r AS (SELECT topic, term, row_number() OVER (PARTITION BY topic ORDER BY n DESC, term) AS r FROM c QUALIFY r <= 10),
kw AS (SELECT topic, string_agg(term, ' ' ORDER BY r DESC) AS kw FROM r GROUP BY topic)
SELECT doc_id, topic, concat_ws(' ', text, kw) AS new_document FROM t LEFT JOIN kw USING (topic)""")
def enrich_with_topics(spark, sf):
    """M6 with a model-free topic table: topic = doc_id mod 10, keywords =
    the topic's ten most frequent terms (weakest first)."""
    d = fx.table(spark, sf, "documents").select("doc_id", "text").join(fx.topic_assignment(spark, sf), "doc_id")
    kw = tp.keywords_by_counts(d.select("topic", tk.remove_stops(tk.word_tokens(F.col("text"))).alias("t")), "topic", "t")
    return tp.enrich_with_topics(d, "text", "topic", kw).select("doc_id", "topic", "new_document")


# ---------------------------------------------------------------- threads (ST)
from skein.streaming import threads as th  # noqa: E402


@register("assemble_threads", "SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, "
                              "string_agg(text, chr(10) ORDER BY turn) AS thread FROM conversations GROUP BY conv_id")
def assemble_threads(spark, sf):
    """ST3: conversations as one text each, turns in order."""
    return th.assemble_threads(fx.table(spark, sf, "conversations"))


# ---------------------------------------------------------------- model-based, rows-only
from skein.operators import ranker as rk  # noqa: E402
from skein.operators import similar as sm  # noqa: E402
from skein.operators import similar_index as si  # noqa: E402


_LDA = dict(k=10, iters=10, seed=42, vocab_size=7000)


def _topic_docs(spark, sf):
    # A fixed row order inside each partition (mini-batches follow row order);
    # ties in the fitted vocabulary can still reorder term indices between runs.
    return fx.table(spark, sf, "documents").select("doc_id", "source", "text").sortWithinPartitions("doc_id")


@register("topics", None)
def topics(spark, sf):
    """M3/M4: LDA (10 topics, 10 iterations, seed 42) over TF-IDF of the
    documents; the dominant topic of every document."""
    return tp.fit_dominant(_topic_docs(spark, sf), "text", ["doc_id"], **_LDA)[1]


@register("topic_keywords", None)
def topic_keywords(spark, sf):
    """M5: ten keywords per fitted topic, weakest first."""
    m = tp.fit_topics(_topic_docs(spark, sf), "text", **_LDA)
    return tp.topic_keywords(m, spark, 10).select("topic", F.array_join("keywords", " ").alias("keywords"))


@register("dominant_topic_enriched", None)
def dominant_topic_enriched(spark, sf):
    """M4+M5+M6 as the model notebook chains them: fitted topic per document,
    its keywords appended to the text."""
    m, dt = tp.fit_dominant(_topic_docs(spark, sf), "text", ["doc_id", "text"], **_LDA)
    return tp.enrich_with_topics(dt, "text", "topic", tp.topic_keywords(m, spark, 10)).select("doc_id", "topic", "new_document")


@register("topic_summary", None)
def topic_summary(spark, sf):
    """M7: documents per fitted topic and source."""
    return tp.topic_summary(tp.fit_dominant(_topic_docs(spark, sf), "text", ["source"], **_LDA)[1], "topic", ["source"])


@register("embed", None)
def embed(spark, sf):
    """SI3 + SI2: hashed-term embeddings of the three texts, distances per pair."""
    pairs = (("doc_summary", "document", "summary"), ("summary_predicted", "summary", "predicted_summary"),
             ("doc_predicted", "document", "predicted_summary"))
    e = sm.embedding_distances(fx.pairs3(spark, sf), "doc_id", pairs, "hashing", 64)
    return e.select("doc_id", *[_r6(F.col(c)).alias(c) for c in e.columns if c != "doc_id"])


_EMBED_PAIRS = (("doc_summary", "document", "summary"), ("summary_predicted", "summary", "predicted_summary"),
                ("doc_predicted", "document", "predicted_summary"))


def _trigram_encoder():
    """An encoder as a caller supplies it: hashed character trigrams of each
    text, projected to 64 columns by a fixed matrix that is made once."""
    import zlib

    import numpy as np
    matrix = np.random.default_rng(42).standard_normal((4096, 64)) / 8

    def encode(texts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(texts), 64))
        for i, t in enumerate(texts.reshape(-1)):
            raw = np.frombuffer(t.encode(), np.uint8).astype(np.int64)
            if len(raw) > 2:
                gram = (raw[:-2] * 65599 + raw[1:-1]) * 65599 + raw[2:]
                out[i] = np.bincount(gram % 4096, minlength=4096) @ matrix
            elif len(raw):
                out[i] = matrix[zlib.crc32(raw.tobytes()) % 4096]
        return out
    return encode


@register("embed_encoder", None)
def embed_encoder(spark, sf):
    """SI3 with a supplied encoder over the three texts, distances per pair."""
    e = sm.embedding_distances(fx.pairs3(spark, sf), "doc_id", _EMBED_PAIRS, "encoder", model=_trigram_encoder)
    return e.select("doc_id", *[_r6(F.col(c)).alias(c) for c in e.columns if c != "doc_id"])


@register("embed_word2vec", None)
def embed_word2vec(spark, sf):
    """SI3 by one Word2Vec model fitted on the documents, distances per pair."""
    p = fx.pairs3(spark, sf)
    e = sm.embedding_distances(p, "doc_id", _EMBED_PAIRS, "word2vec", model=sm.fit_word2vec(p, "document"))
    return e.select("doc_id", *[_r6(F.col(c)).alias(c) for c in e.columns if c != "doc_id"])


@register("embed_table",
          "SELECT d.doc_id, round(CASE WHEN a.embedding IS NULL OR b.embedding IS NULL THEN NULL "
          "WHEN list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]) = 0 OR "
          "list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]) = 0 THEN 1.0 ELSE "
          "1.0 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) END, 6) AS semantic_distance "
          "FROM documents d LEFT JOIN embeddings a ON a.vec_id = d.doc_id LEFT JOIN embeddings b ON b.vec_id = d.doc_id // 2")
def embed_table(spark, sf):
    """SI3 by a table of vectors: distance of each document to the one with
    half its number, null where the table lacks a vector."""
    d = fx.table(spark, sf, "documents").select("doc_id", F.floor(F.col("doc_id") / 2).alias("other"))
    v = fx.table(spark, sf, "embeddings")
    both = sm.embed_from_table(sm.embed_from_table(d, "doc_id", v, "vec_id", "embedding", "a"), "other", v, "vec_id", "embedding", "b")
    known = F.col("a").isNotNull() & F.col("b").isNotNull()
    return both.select("doc_id", F.when(known, _r6(tk.semantic_distance(F.col("a"), F.col("b")))).alias("semantic_distance"))


_SIMILAR_SQL = """
WITH e AS (SELECT min(vec_id) AS id, count(*) AS n, embedding::DOUBLE[] AS v FROM embeddings GROUP BY embedding),
q AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 100 = 0),
s AS (SELECT q.vec_id, e.id AS similar_id, n - (q.v = e.v)::BIGINT AS n_rows, round(list_cosine_similarity(q.v, e.v), 6) AS similarity
      FROM q, e WHERE n > 1 OR q.v <> e.v)
SELECT * FROM (SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, similar_id)::INTEGER AS rank,
                      similar_id, n_rows, similarity FROM s) WHERE rank <= 10"""


@register("similar_vectors", _SIMILAR_SQL)
def similar_vectors(spark, sf):
    """SI6 over the embedding table, exact: the ten nearest vectors of every
    hundredth one, among all, block by block."""
    return si.similar(fx.table(spark, sf, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0, exact=True)


@register("similar_documents", None)
def similar_documents(spark, sf):
    """SI6: the ten most similar documents of every hundredth one, among all,
    by an index of cells over hashed-term embeddings of the whole texts."""
    return si.similar_documents(fx.table(spark, sf, "documents"), "doc_id", "text", F.col("doc_id") % 100 == 0)


_FEATURES_SQL = f"""
WITH d AS ({fx.SQL['pairs']}),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({q.word_tokens('document')}) AS term FROM d) GROUP BY ALL),
idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM d)) / (1.0 + count(*))) + 1.0 AS idf FROM tf GROUP BY term),
s AS (SELECT doc_id, summary, len(ss) AS n_sent, unnest(range(0, len(ss))) AS spos, unnest(ss) AS sentence
      FROM (SELECT doc_id, summary, {q.sentences('document')} AS ss FROM d)),
st AS (SELECT doc_id, spos, unnest({q.word_tokens('sentence')}) AS term FROM s),
o AS (SELECT doc_id, spos, term, count(*) AS c FROM st GROUP BY ALL),
o2 AS (SELECT *, sum(c) OVER (PARTITION BY doc_id, term) AS t FROM o),
m AS (SELECT doc_id, spos, sum(c) AS n, sum(c * idf) AS mass, sum(c * t * idf * idf) AS both_, sum(c * c * idf * idf) AS own
      FROM o2 JOIN idf USING (term) GROUP BY ALL),
m2 AS (SELECT *, sum(both_) OVER (PARTITION BY doc_id) AS whole FROM m),
r AS (SELECT k, rouge1 FROM ({q.pair_scores("SELECT doc_id * 100000 + spos AS k, summary, sentence FROM s", "k", "summary", "sentence", metrics=("rouge1",))})),
f AS (SELECT s.doc_id, CAST(s.spos AS INTEGER) AS spos, round(s.spos / n_sent, 6) AS rel_pos, coalesce(n, 0)::DOUBLE AS n_tokens,
             round(coalesce(mass / n, 0.0), 6) AS mean_idf,
             round(coalesce(CASE WHEN own > 0 AND whole > 0 THEN both_ / sqrt(own * whole) ELSE 0.0 END, 0.0), 6) AS cosine,
             round(len(list_filter({q.tokens('sentence')}, lambda x: regexp_matches(x, '^\\p{{Lu}}'))) / greatest(len({q.tokens('sentence')}), 1), 6) AS capitals,
             round(rouge1, 6) AS rouge1
      FROM s LEFT JOIN m2 USING (doc_id, spos) JOIN r ON r.k = s.doc_id * 100000 + s.spos)
SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY rouge1 DESC, spos) = 1)::INTEGER::DOUBLE AS label FROM f"""


@register("sentence_features", _FEATURES_SQL)
def sentence_features(spark, sf):
    """SU3: the five features of every sentence of every document, its
    ROUGE-1 F against the summary, and the label."""
    return rk.sentence_features(fx.pairs(spark, sf), "doc_id", "document", "summary")


@register("sentence_ranker", None)
def sentence_ranker(spark, sf):
    """SU3: logistic sentence ranker trained on the 80 % split, scored on the 20 %."""
    _, scored = rk.fit_sentence_ranker(fx.pairs(spark, sf), "doc_id", "document", "summary")
    return scored.select("doc_id", "spos", "label", _r6(F.col("p")).alias("p"))


@register("ranker_evaluation", None)
def ranker_evaluation(spark, sf):
    """SU3 evaluated on the 20 %: accuracy at 1, and ROUGE-1 of the pick
    against lead-1 and the best sentence."""
    _, scored = rk.fit_sentence_ranker(fx.pairs(spark, sf), "doc_id", "document", "summary")
    e = rk.ranking_evaluation(scored, "doc_id")
    return e.select("n", *[_r6(F.col(c)).alias(c) for c in e.columns if c != "n"])


@register("summarise_with", None)
def summarise_with(spark, sf):
    """SU1 with a supplied summariser (here: first sentence of the text, built
    once per partition); failures come back as null + error."""
    def make():
        def first_sentence(t: str) -> str:
            cut = [i for i in (t.find(". "), t.find("\n")) if i >= 0]
            return t[:min(cut) + 1] if cut else t
        return first_sentence
    d = fx.table(spark, sf, "documents").select("doc_id", "text")
    return su.summarise_with(d, "doc_id", "text", make)


@register("evaluate_model", None)
def evaluate_model(spark, sf):
    """Q9: exact 80/20 split -> extractive summaries of the test documents ->
    ROUGE-1/2/L (stemmed, as the reference scores), BLEU, token F1 -> one row
    of averages."""
    p = fx.pairs(spark, sf)
    _, test = prep.split_exact(p, "doc_id", 0.2, 42)
    pre = su.PRESETS["pipeline"]
    gen = su.summarise(test.select("doc_id", "document"), "doc_id", "document",
                       pre["min_tokens"], pre["max_tokens"], pre["block_ngram"])
    pairs_df = test.select("doc_id", "summary").join(gen.withColumnRenamed("summary", "predicted"), "doc_id")
    s = qa.score_pairs(pairs_df, "doc_id", "summary", "predicted", rouge_l=True, stem=True)
    e = qa.evaluate(s, metrics=["rouge1", "rouge2", "rougeL", "bleu", "token_f1"])
    return e.select(*[_r6(F.col(c)).alias(c) for c in ("rouge1", "rouge2", "rougeL", "bleu", "token_f1")], "n")


def _lead_3():
    """A summariser as a caller supplies it: the first three sentences."""
    import re
    ends = re.compile(r"(?<=[.!?])[ \n]+|\n+")
    return lambda t: " ".join([x for x in ends.split(t) if x.strip()][:3])


def _frequent_3():
    """Another: the three sentences with the most frequent words of the text, in order."""
    import re
    from collections import Counter
    ends, word = re.compile(r"(?<=[.!?])[ \n]+|\n+"), re.compile(r"\w{2,}")

    def summary(t: str) -> str:
        parts = [x for x in ends.split(t) if x.strip()]
        n = Counter(word.findall(t.lower()))
        weight = [sum(n[w] for w in set(word.findall(x.lower()))) / (1 + len(word.findall(x))) for x in parts]
        best = sorted(sorted(range(len(parts)), key=lambda i: (-weight[i], i))[:3])
        return " ".join(parts[i] for i in best)
    return summary


@register("evaluate_summarisers", None)
def evaluate_summarisers(spark, sf):
    """Q9 with supplied summarisers: each run over the test documents of the
    exact split (built once a partition) and scored; one row each."""
    _, test = prep.split_exact(fx.pairs(spark, sf), "doc_id", 0.2, 42)
    out = [qa.evaluate_model(test, "doc_id", "document", "summary", make).withColumn("summariser", F.lit(name))
           for name, make in (("lead_3", _lead_3), ("frequent_3", _frequent_3))]
    e = out[0].unionByName(out[1])
    return e.select("summariser", *[_r6(F.col(c)).alias(c) for c in ("rouge1", "rouge2", "rougeL", "bleu", "token_f1")], "n", "n_failed")


@register("evaluate_loaded", None)
def evaluate_loaded(spark, sf):
    """Q9 behind one interface: the extractive summariser, a supplied one, and
    a ranker fitted on the train documents, saved (IO8) and loaded again;
    each over the test documents of the exact split, one row each."""
    p, path = fx.pairs(spark, sf), _fresh(spark, "ranker")
    train, test = prep.split_exact(p, "doc_id", 0.2, 42)
    idf = session.written(su.document_idf(train, "document"), "idf")   # read by the fit and saved with it
    rk.save_ranker(rk.fit_on(train, "doc_id", "document", "summary", idf), idf, path)
    made = {"extractive": su.extractive("pipeline"), "lead_3": su.supplied(_lead_3), "ranker": rk.load_ranker(spark, path)}
    out = [qa.evaluate_summariser(test, "doc_id", "document", "summary", s).withColumn("summariser", F.lit(name))
           for name, s in made.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), out).select(
        "summariser", *[_r6(F.col(c)).alias(c) for c in ("rouge1", "rouge2", "rougeL", "bleu", "token_f1")], "n")


@register("token_f1_pieces", None)
def token_f1_pieces(spark, sf):
    """Q6 on subword tokens, as the models' tokenizers give them: word pieces
    of summary and lead-2 over one piece vocabulary."""
    p = fx.pairs3(spark, sf)
    both = {c: tk.word_tokens(F.col(c)) for c in ("summary", "predicted_summary")}
    vocab = terms.piece_vocabulary(p.select(tk.word_tokens(F.col("document")).alias("t")), "t", 7000)
    w = p.select("doc_id", *[v.alias(c) for c, v in both.items()])
    w = terms.wordpiece(terms.wordpiece(w, "summary", vocab, "r"), "predicted_summary", vocab, "h")
    return w.select("doc_id", _r6(tk.list_f1(F.col("r"), F.col("h"))).alias("token_f1"))


@register("batched", None)
def batched(spark, sf):
    """Fixed-size batches of 10 rows, numbered inside each partition
    (partition id, batch number) - never a global row number."""
    from skein.operators.terms import batched as tb
    return tb(fx.table(spark, sf, "documents").select("doc_id", "text"), 10).select("doc_id", "partition", "batch")


def _stream_paths(spark):
    return th.sink_paths(_fresh(spark, "stream"))


@register("thread_stream", None)
def thread_stream(spark, sf):
    """ST1/ST2: documents through the streaming flow (file source, cleaning in
    the plan, app-preset summary and hashtags of whole threads per
    micro-batch, Parquet sink, availableNow), read back from the sink."""
    sink, ckpt = _stream_paths(spark)
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    idf = session.cut_lineage(su.document_idf(th.thread_text(docs, "doc_id", "text"), "thread"))
    # A pattern, as the table is one file or a folder of files (a stream takes no path of one file).
    th.thread_stream(spark, os.path.join(sf, "documents.parque[t]"), "*.parquet", docs.schema, "doc_id", "text", sink, ckpt, idf)
    return spark.read.parquet(sink).select("doc_id", "summary", "share_url", "hashtag_line")


@register("thread_batch", None)
def thread_batch(spark, sf):
    """ST1 as one batch job: the rows that the stream must give."""
    return th.thread_batch(fx.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")


@register("conversation_stream", REGISTRY["assemble_threads"].sql.replace(" AS thread FROM", " AS thread, true AS complete FROM"))
def conversation_stream(spark, sf):
    """ST3 as a stream: the turns of all conversations dealt by hash over
    files that arrive one after another, so turns come late and out of order;
    the last turn of a conversation states how many there are."""
    sink, ckpt = _stream_paths(spark)
    turns = fx.table(spark, sf, "conversations")
    ends = turns.groupBy("conv_id").agg(F.max("turn").alias("turn"), F.count(F.lit(1)).alias("n_turns"))
    source = _fresh(spark, "turns")
    # One row of the last turn's number states the count; a turn that comes twice may state it twice.
    dealt = turns.join(ends, ["conv_id", "turn"], "left").select("conv_id", "turn", "text", "n_turns")
    dealt.repartition(6, F.xxhash64("conv_id", "turn", "text")).write.parquet(source)
    th.conversation_stream(spark, source, dealt.schema, sink, ckpt, max_files=2)
    return spark.read.parquet(sink).select("conv_id", "n_turns", "thread", "complete")


@register("rouge_stemmed", None)
def rouge_stemmed(spark, sf):
    """Q1-Q4: ROUGE-1/2/L with Porter stemming (tokens over 3 characters)."""
    s = qa.score_pairs(fx.pairs3(spark, sf), "doc_id", "summary", "predicted_summary", rouge_l=True, stem=True)
    return s.select("doc_id", *[_r6(F.col(c)).alias(c) for c in ("rouge1", "rouge2", "rougeL")])


@register("wordpiece", None)
def wordpiece(spark, sf):
    """Word pieces of every document over a corpus-built piece vocabulary
    (7,000 words plus single-character pieces)."""
    d = fx.table(spark, sf, "documents").select("doc_id", tk.word_tokens(F.col("text")).alias("t"))
    vocab = terms.piece_vocabulary(d, "t", 7000)
    w = terms.wordpiece(d, "t", vocab)
    return w.select("doc_id", F.size("t").alias("n_words"), F.size("pieces").alias("n_pieces"),
                    F.array_join("pieces", " ").alias("pieces"))


@register("series_filter", f"SELECT doc_id, Type, value FROM (" + " UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS Type, round({q.jaccard(a, b)}, 6) AS value FROM ({fx.SQL['pairs3']})"
    for n, a, b in _JACCARD_PAIRS) + ") WHERE Type = 'jaccard_summary_predicted'")
def series_filter(spark, sf):
    """One series of the long (Type, value) table, as each density curve
    selects its own series."""
    return melt(spark, sf).filter(F.col("Type") == "jaccard_summary_predicted")


@register("row_ids", None)
def row_ids(spark, sf):
    """P10: stable ids for the combined documents + benchmark table, hashed
    from the source name and its key (identical on every re-run)."""
    docs = fx.table(spark, sf, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("key"), "text")
    bench = fx.table(spark, sf, "benchmark").select(F.lit("benchmark").alias("src"), F.col("item_id").alias("key"), "text")
    return prep.with_row_id(io.combine([docs, bench]), ["src", "key"]).select("src", "key", "row_id")


# ---------------------------------------------------------------- sources and sinks (IO1-IO4, IO8)
def _fresh(spark, name: str) -> str:
    import uuid
    return os.path.join(session.ensure_checkpoint_dir(spark), f"skein-{name}-{uuid.uuid4().hex}")


_DOC_COLS = ["doc_id", "text", "lang", "source"]
_DOC_SCHEMA = "doc_id long, text string, lang string, source string"
_DOC_SQL = "SELECT doc_id, text, lang, source FROM documents"


@register("io_json", _DOC_SQL)
def io_json(spark, sf):
    """IO1/IO2/IO4: documents written as JSON lines to two folders, read back
    as one multi-path source with a declared schema; other files (here CSV
    beside them) are left out by suffix."""
    docs, base = fx.table(spark, sf, "documents").select(*_DOC_COLS), _fresh(spark, "json")
    halves = [F.col("doc_id") % 2 == 0, F.coalesce(F.col("doc_id") % 2 != 0, F.lit(True))]
    paths = [f"{base}/train_{i}" for i in (0, 1)]
    for path, half in zip(paths, halves):
        io.write_threads(docs.filter(half), path, "json")
        io.write_threads(docs.filter(half).limit(1), path, "csv", mode="append")
    return io.read_threads(spark, paths, "json", _DOC_SCHEMA, suffix=".json")


@register("io_csv", _DOC_SQL)
def io_csv(spark, sf):
    """IO3/IO4: CSV round trip of whole texts (line ends and quotes inside)."""
    base = _fresh(spark, "csv")
    io.write_threads(fx.table(spark, sf, "documents").select(*_DOC_COLS), base, "csv")
    return io.read_threads(spark, base, "csv", _DOC_SCHEMA)


@register("io_parquet", _DOC_SQL)
def io_parquet(spark, sf):
    """IO4: Parquet round trip, partitioned by language."""
    base = _fresh(spark, "parquet")
    io.write_threads(fx.table(spark, sf, "documents").select(*_DOC_COLS), base, partition_by=["lang"])
    return spark.read.parquet(base).select(*_DOC_COLS)


@register("io_model", None)
def io_model(spark, sf):
    """IO8: a fitted topic model saved to the shared folder, loaded again and
    applied to every document."""
    docs, base = fx.table(spark, sf, "documents").select("doc_id", "text"), _fresh(spark, "model")
    io.save_model(tp.fit_topics(docs, "text", k=5, iters=3), base)
    return tp.dominant_topic(io.load_model(base), docs, "text").select("doc_id", "topic")


# ---------------------------------------------------------------- whole texts (H1-H6, Q1-Q8)
# The hashtag and metric queries above read the first lines; these read every
# line of ``text``, and the extractive summary of it.
_TEXT_SRC = "SELECT doc_id, lang, text FROM documents"


def _whole_texts(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", "lang", "text")


def _summaries(spark, sf):
    """(doc_id, lang, source, document, text): whole texts and, as ``text``,
    their extractive summaries (batch preset)."""
    d = fx.table(spark, sf, "documents").select("doc_id", "lang", "source", F.col("text").alias("document"))
    p = su.PRESETS["batch"]
    s = su.summarise(d, "doc_id", "document", p["min_tokens"], p["max_tokens"], p["block_ngram"])
    return d.join(s.withColumnRenamed("summary", "text"), "doc_id")


def _phrases(src):
    return tg.key_phrases(src, "doc_id", "text").select(
        "doc_id", "phrase", F.col("kind").cast("int").alias("kind"), "freq", F.col("first_pos").cast("int").alias("first_pos"))


def _tag_counts(src):
    t = tg.hashtags(src, "doc_id", "text", 3).join(src.select("doc_id", "lang"), "doc_id")
    return tg.hashtag_counts(t, ["lang"], 10).select("lang", "tag", "n", F.col("rank").cast("int").alias("rank"))


@register("key_phrases_text", REGISTRY["key_phrases"].sql.replace(_TAG_SRC, _TEXT_SRC))
def key_phrases_text(spark, sf):
    """H1-H3: candidate phrases of every whole text."""
    return _phrases(_whole_texts(spark, sf))


@register("hashtags_text", REGISTRY["hashtags"].sql.replace(_TAG_SRC, _TEXT_SRC))
def hashtags_text(spark, sf):
    """H4/H5: three hashtags per whole text."""
    return tg.hashtags(_whole_texts(spark, sf), "doc_id", "text", 3).select("doc_id", "hashtag_line")


@register("hashtag_counts_text", REGISTRY["hashtag_counts"].sql.replace(_TAG_SRC, _TEXT_SRC))
def hashtag_counts_text(spark, sf):
    """H6: the ten most used hashtags of whole texts per language."""
    return _tag_counts(_whole_texts(spark, sf))


@register("hashtag_trends", None)
def hashtag_trends(spark, sf):
    """H6 rolled up: states of the hashtags of whole texts by language and
    source, written once, and the ten most used of each language from them."""
    src, path = _whole_texts(spark, sf), _fresh(spark, "tags")
    t = tg.hashtags(src, "doc_id", "text", 3).join(fx.table(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id")
    tg.tag_states(t, ["lang", "source"]).write.parquet(path)
    return tg.trending(spark.read.parquet(path), ["lang"], 10).select("lang", "tag", "n", "n_over", F.col("rank").cast("int").alias("rank"))


@register("key_phrases_summary", None)
def key_phrases_summary(spark, sf):
    """H1-H3: candidate phrases of every extractive summary."""
    return _phrases(_summaries(spark, sf))


@register("hashtags_summary", None)
def hashtags_summary(spark, sf):
    """H4/H5: three hashtags per extractive summary."""
    return tg.hashtags(_summaries(spark, sf), "doc_id", "text", 3).select("doc_id", "hashtag_line")


@register("hashtag_counts_summary", None)
def hashtag_counts_summary(spark, sf):
    """H6: the ten most used hashtags of extractive summaries per language."""
    return _tag_counts(_summaries(spark, sf))


_TEXT_METRICS = ["rouge1", "rouge2", "rougeL", "bleu", "token_f1"]


@register("pair_metrics_text", None)
def pair_metrics_text(spark, sf):
    """Q1-Q3, Q5, Q6: every whole document against its extractive summary."""
    s = qa.score_pairs(_summaries(spark, sf), "doc_id", "document", "text", rouge_l=True)
    return s.select("doc_id", *[_r6(F.col(c)).alias(c) for c in _TEXT_METRICS])


@register("rouge_stemmed_text", None)
def rouge_stemmed_text(spark, sf):
    """Q1-Q4: stemmed ROUGE of every whole document against its extractive summary."""
    s = qa.score_pairs(_summaries(spark, sf), "doc_id", "document", "text", rouge_l=True, stem=True, bleu=False)
    return s.select("doc_id", *[_r6(F.col(c)).alias(c) for c in ("rouge1", "rouge2", "rougeL")])


@register("evaluate_rollup_text", None)
def evaluate_rollup_text(spark, sf):
    """Q7, Q8: averages of pair_metrics_text per language and source with
    subtotals and a grand total."""
    s = qa.score_pairs(_summaries(spark, sf), "doc_id", "document", "text", rouge_l=True, carry=["lang", "source"])
    e = qa.evaluate(s, metrics=_TEXT_METRICS, by=["lang", "source"], rollup=True)
    return e.select("lang", "source", *[_r6(F.col(m)).alias(m) for m in _TEXT_METRICS], "n")
