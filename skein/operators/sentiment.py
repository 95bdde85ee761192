"""Rule-based sentiment (SE1-SE4) over a lexicon table.

The lexicon is an input table ``(token, valence, kind)`` where ``kind`` is
``word`` (has a valence), ``booster``, ``dampener`` or ``negation``. Tokens
are the runs between white space without their outer punctuation (a run of
nothing else, like an emoticon, stays whole), so entries may hold apostrophes
and symbols. Rules, in order
(published rule-based method, Hutto & Gilbert 2014):

* valence of each lexicon word, +/-0.733 if it is in capitals and the text
  mixes case;
* a booster 1, 2 or 3 tokens before adds +/-0.293 x (1, 0.95, 0.9), a
  dampener takes as much away; either adds 0.733 first if it is in capitals;
* a negation 1, 2 or 3 tokens before multiplies by -0.74 (each);
* words before the first ``but`` x 0.5, after it x 1.5;
* sum s; if s != 0 add +/-(0.292 per '!', at most 4; 0.18 per '?' when 2-3,
  0.96 when more);  compound = s / sqrt(s^2 + 15), rounded to 4.

Shape: tokens never move one by one. Rows are written once and dealt to blocks
of about ``BLOCK_BYTES`` of text; the distinct tokens of each block meet the
lexicon (its entries for a token summed to a few numbers, so that an entry
that comes twice counts twice), and a block's texts meet its own part of the
lexicon, where one look-up a token and shifted arrays give the scores.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein import fixed
from skein.functions.tokens import sentiment_label
from skein.session import shuffle_partitions, written


BLOCK_BYTES = 16 << 20   # text of a block, about
_X, _S = r"\p{L}\p{N}_", r" \t\n\r\f\x0B"
#: The tokens of a text at once: ``fixed.CHUNK`` without its ``fixed.OUTER_PUNCTUATION``, or whole if it has nothing else.
TOKEN = rf"[{_X}](?:[^{_S}]*[{_X}])?|(?<![^{_S}])[^{_X}{_S}]++(?![^{_S}])"
_NUMBERS = {"v": 0.0, "v_caps": 0.0, "s": 0.0, "s_caps": 0.0, "negate": 1.0, "boost": 0.0, "boosts": 0.0}   # of a token that no lexicon holds


def _is_upper(t, low):
    return (low != t) & (F.upper(t) == t)


def _blocks(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(block, __key, texts): the rows, written once; a block is a share of one partition's rows."""
    texts = F.array(*[F.col(c).cast("string") for c in cols])
    rows = written(df.select(F.col(key).alias("__key"), texts.alias("texts")).withColumns({
        "part": F.spark_partition_id(), "size": F.aggregate("texts", F.lit(0).cast("long"), lambda n, t: n + F.coalesce(F.octet_length(t), F.lit(0)))}), "sentiment")
    shares = rows.groupBy("part").agg((F.floor(F.sum("size") / BLOCK_BYTES) + 1).alias("shares"))   # one row a partition
    share = F.pmod(F.xxhash64("__key", "texts"), F.col("shares"))
    return rows.join(F.broadcast(shares), "part").select(F.xxhash64("part", share).alias("block"), "__key", "texts")


def _lexicon_numbers(lexicon: DataFrame) -> DataFrame:
    """(token, numbers): sums over the entries of a token, without and with capitals for its valence."""
    word, v = F.col("kind") == "word", F.col("valence").cast("double")
    caps = v + F.when(v > 0, fixed.SENT_CAPS).otherwise(-fixed.SENT_CAPS)
    sign = [F.when(x.isNull(), None).when(x < 0, -1.0).otherwise(1.0) for x in (v, caps)]
    boosts = F.col("kind").isin("booster", "dampener")
    aggs = {"v": F.when(word, v), "v_caps": F.when(word, caps), "s": F.when(word, sign[0]), "s_caps": F.when(word, sign[1]),
            "negate": F.when(~word, F.when(F.col("kind") == "negation", fixed.SENT_NEGATE).otherwise(1.0)),
            "boost": F.when(F.col("kind") == "booster", fixed.SENT_BOOST).when(boosts, -fixed.SENT_BOOST),
            "boosts": F.when(boosts, 1.0)}
    return (lexicon.filter(F.col("token").isNotNull()).groupBy("token")
            .agg(*[F.coalesce(F.sum(x), F.lit(_NUMBERS[n])).alias(n) for n, x in aggs.items()]))


def _block_sums(texts: pa.Table, own: pa.Table) -> pa.Table:
    """The sum s of each text of a block, given the block's lexicon."""
    low = texts.column("low").combine_chunks()
    n = pc.list_value_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    at = pc.index_in(low.flatten(), value_set=own.column("token").combine_chunks()).fill_null(own.num_rows).to_numpy()
    number = {c: np.append(own.column(c).to_numpy(), none) for c, none in _NUMBERS.items()}   # the last is of tokens that are not there
    up = texts.column("ups").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(bool)
    text = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    up &= texts.column("caps_mix").to_numpy().astype(bool)[text]
    factors, boosts = [], []
    for d in (1, 2, 3):
        before = np.full(len(at), own.num_rows)
        before[d:] = at[:-d]
        before[pos < d] = own.num_rows
        loud = np.zeros(len(at), dtype=bool)
        loud[d:] = up[:-d]   # of another text where there is no predecessor, which has no boosts
        factors.append(number["negate"][before])
        boosts.append(fixed.SENT_BOOST_DECAY[d - 1] * (number["boost"][before] + fixed.SENT_CAPS * loud * number["boosts"][before]))
    f1, f2, f3 = factors
    v = np.where(up, number["v_caps"][at], number["v"][at]) * (f1 * f2 * f3)
    v += np.where(up, number["s_caps"][at], number["s"][at]) * (boosts[0] * f2 * f3 + boosts[1] * f1 * f3 + boosts[2] * f1 * f2)
    but = texts.column("but").to_numpy()[text]
    v *= np.where((but < 0) | (pos == but), 1.0, np.where(pos < but, fixed.SENT_BUT_BEFORE, fixed.SENT_BUT_AFTER))
    sums = pa.array(np.bincount(text, weights=v, minlength=len(n)).astype(float))
    return texts.select(["__key", "column", "is_null", "amp"]).append_column("s", sums)


def sentiment_long(df: DataFrame, key: str, cols: Sequence[str], lexicon: DataFrame) -> DataFrame:
    """SE1/SE3: (key, column, score) for every key and text column."""
    names = F.array(*[F.lit(c) for c in cols])
    rows = _blocks(df, key, cols)
    need = (rows.select("block", F.explode(F.regexp_extract_all(F.array_join("texts", " "), F.lit(TOKEN), 0)).alias("token"))
            .select("block", F.lower("token").alias("token")).distinct())
    own = need.join(_lexicon_numbers(lexicon), "token").select(F.col("block").alias("of"), "token", *_NUMBERS)
    n = shuffle_partitions(df)
    # Texts move as they are and are cut into tokens where their block is.
    long = rows.repartition(n, "block").select("block", "__key", F.posexplode("texts").alias("i", "text"))
    bang = F.length("text") - F.length(F.replace(F.col("text"), F.lit("!"), F.lit("")))
    quest = F.length("text") - F.length(F.replace(F.col("text"), F.lit("?"), F.lit("")))
    amp = (F.least(bang, F.lit(fixed.SENT_EXCLAIM_MAX)) * fixed.SENT_EXCLAIM
           + F.when(quest > 3, fixed.SENT_QUESTION_MANY).when(quest > 1, quest * fixed.SENT_QUESTION).otherwise(0.0))
    toks = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(TOKEN), 0)
    long = long.select("block", "__key", F.get(names, F.col("i")).alias("column"), F.col("text").isNull().alias("is_null"),
                       amp.alias("amp"), toks.alias("toks"))
    long = long.withColumn("low", F.transform("toks", F.lower)).withColumn("ups", F.zip_with("toks", "low", _is_upper)).drop("toks")
    long = long.withColumns({
        "but": F.array_position("low", "but") - 1,
        "caps_mix": F.array_contains("ups", True) & F.array_contains("ups", False),
    })
    schema = T.StructType([*[long.schema[c] for c in ("__key", "column", "is_null", "amp")], T.StructField("s", T.DoubleType())])
    sums = long.groupBy("block").cogroup(own.repartition(n, "of").groupBy("of")).applyInArrow(_block_sums, schema)
    s = (sums.groupBy("__key", "column")
         .agg(F.sum("s").alias("s"), F.max("amp").alias("amp"), F.max(F.col("is_null").cast("int")).alias("is_null")))
    s2 = (F.col("s") + F.when(F.col("s") > 0, F.col("amp")).when(F.col("s") < 0, -F.col("amp")).otherwise(0.0))
    score = F.round(s2 / F.sqrt(s2 * s2 + fixed.SENT_ALPHA), 4)
    return s.select(F.col("__key").alias(key), "column",
                    F.when(F.col("is_null") == 1, F.lit(None).cast("double")).otherwise(score).alias("score"))


def sentiment_scores(df: DataFrame, key: str, cols: Sequence[str], lexicon: DataFrame,
                     labels: bool = True) -> DataFrame:
    """SE1-SE3 wide: key, ``<col>_score`` (and ``<col>_sentiment`` label)."""
    long = sentiment_long(df, key, cols, lexicon)
    wide = long.groupBy(key).agg(*[F.max(F.when(F.col("column") == c, F.col("score"))).alias(f"{c}_score")
                                   for c in cols])
    if labels:
        wide = wide.withColumns({f"{c}_sentiment": sentiment_label(F.col(f"{c}_score")) for c in cols})
    return wide


def sentiment_summary(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """SE4: counts of each label per group (pivot on the three known labels,
    so no extra job discovers the pivot values)."""
    p = df.groupBy(*by).pivot(label, ["Positive", "Neutral", "Negative"]).count()
    return p.fillna(0, subset=["Positive", "Neutral", "Negative"]).select(
        *by, *[F.col(c).cast("bigint").alias(c) for c in ("Positive", "Neutral", "Negative")])
