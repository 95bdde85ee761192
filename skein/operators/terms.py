"""Vocabulary, bags of words, per-document top terms, model inputs.

Shape: ``explode`` straight into a ``groupBy(key, term)``. The hash aggregate
runs a partial (map-side) step first, so a 20,000-word document or a word
present everywhere is collapsed inside its task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein import fixed
from skein.session import shuffle_partitions


def term_counts(df: DataFrame, key: str, tok: str) -> DataFrame:
    """(key, term, n) for an array-of-tokens column."""
    return (df.select(key, F.explode_outer(tok).alias("term")).filter(F.col("term").isNotNull())
            .groupBy(key, "term").agg(F.count(F.lit(1)).alias("n")))


def vocabulary(df: DataFrame, tok: str, size: int | None = 7000) -> DataFrame:
    """T5: (term, n, rank) - the ``size`` most frequent terms, ties by term.

    The global count is a partial+final aggregate; the top-k is a
    TakeOrderedAndProject (each task keeps ``size`` rows)."""
    counts = (df.select(F.explode_outer(tok).alias("term")).filter(F.col("term").isNotNull()).groupBy("term")
              .agg(F.count(F.lit(1)).alias("n")))
    ordered = counts.orderBy(F.col("n").desc(), F.col("term"))
    top = ordered.limit(size) if size else ordered
    w = Window.orderBy(F.col("n").desc(), F.col("term"))
    # The window runs over at most ``size`` rows (already a single partition).
    return top.withColumn("rank", F.row_number().over(w)) if size else top


def doc_top_terms(df: DataFrame, key: str, tok: str, k: int = 5, out: str = "topics") -> DataFrame:
    """The k most frequent tokens of each row, count desc then term asc,
    joined with ' + '; 'No Topic' for an empty row.

    A one-topic model fit on a single document ranks its words by count, so
    the per-row model becomes one aggregate. ``row_number() <= k`` plans as a
    WindowGroupLimit, which also trims each task's rows before the shuffle."""
    # One exchange of the token arrays by key (Spark drops it on input already
    # partitioned by key): the counts, the per-key top-k and the final
    # aggregate then stay in the key's partition.
    df = df.select(key, tok).repartition(shuffle_partitions(df), key)
    # explode_outer keeps rows with no token (one null term), so every key
    # survives to the final aggregate without a join back to the input.
    counts = (df.select(key, F.explode_outer(tok).alias("term"))
              .groupBy(key, "term").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy(key).orderBy(F.col("term").isNull(), F.col("n").desc(), F.col("term"))
    top = (counts.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)
           .groupBy(key).agg(F.array_sort(F.collect_list(
               F.when(F.col("term").isNotNull(), F.struct("r", "term")))).alias("t")))
    joined = F.array_join(F.transform("t", lambda s: s["term"]), fixed.TOPIC_JOIN)
    return top.select(key, F.when(F.size("t") > 0, joined).otherwise(F.lit(fixed.NO_TOPIC)).alias(out))


def encode(df: DataFrame, key: str, tok: str, vocab: DataFrame, max_len: int, prefix: str = "input") -> DataFrame:
    """Token ids for one text column: 0 = pad, 1 = unknown, 2.. by vocabulary
    rank, truncated to the model input length ``max_len`` (as the model's own
    tokenizer truncates) before anything is exploded. Spark broadcasts the
    vocabulary if its bytes allow."""
    ids = vocab.select(F.col("term"), (F.col("rank") + 1).cast("int").alias("id"))
    exploded = (df.select(key, F.posexplode_outer(F.slice(F.col(tok), 1, max_len)).alias("pos", "term"))
                .filter(F.col("pos").isNotNull()))
    joined = exploded.join(ids, "term", "left")
    return (joined.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("id", F.lit(1)).alias("id")))).alias("s"))
            .select(key, F.transform("s", lambda s: s["id"]).alias(f"{prefix}_ids")))


def encode_pairs(df: DataFrame, key: str, doc_tok: str, sum_tok: str, vocab: DataFrame,
                 max_in: int = 1024, max_out: int = 150, pad: str = "longest") -> DataFrame:
    """(key, input_ids, attention_mask, labels) padded with 0.

    ``pad='longest'`` pads to the longest row (one extra global max, a
    one-row aggregate), ``pad='max'`` to ``max_in`` / ``max_out``."""
    base = df.select(key)
    enc_in = encode(df, key, doc_tok, vocab, max_in, "input")
    enc_out = encode(df, key, sum_tok, vocab, max_out, "label")
    t = (base.join(enc_in, key, "left").join(enc_out, key, "left")
         .withColumns({"input_ids": F.coalesce("input_ids", F.array().cast("array<int>")),
                       "label_ids": F.coalesce("label_ids", F.array().cast("array<int>"))}))
    if pad == "longest":
        # Widths come from the token arrays alone: the encoding itself runs once.
        row = df.agg(F.max(F.least(F.size(F.coalesce(F.col(doc_tok), F.array().cast("array<string>"))), F.lit(max_in))).alias("a"),
                     F.max(F.least(F.size(F.coalesce(F.col(sum_tok), F.array().cast("array<string>"))), F.lit(max_out))).alias("b")).first()
        width_in, width_out = int(row["a"] or 0), int(row["b"] or 0)
    else:
        width_in, width_out = max_in, max_out

    def padded(c, width):
        return F.concat(F.col(c), F.array_repeat(F.lit(0), F.greatest(F.lit(width) - F.size(c), F.lit(0))))

    return t.select(key,
                    padded("input_ids", width_in).alias("input_ids"),
                    F.concat(F.array_repeat(F.lit(1), F.size("input_ids")),
                             F.array_repeat(F.lit(0), F.greatest(F.lit(width_in) - F.size("input_ids"), F.lit(0))))
                    .alias("attention_mask"),
                    padded("label_ids", width_out).alias("labels"))


def batched(df: DataFrame, size: int) -> DataFrame:
    """(partition, batch) for every row: batches of ``size`` consecutive
    rows inside each partition (the low 33 bits of Spark's increasing id are
    the row's place in its partition): no global row number, no shuffle."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumns({"partition": F.spark_partition_id(), "batch": F.floor(place / size).cast("long")})


UNKNOWN_PIECE = "[UNK]"
CONTINUATION = "##"


def piece_vocabulary(df: DataFrame, tok: str, size: int = 7000) -> DataFrame:
    """(piece): the ``size`` most frequent words plus every character seen, as
    a start piece and as a continuation piece. Bounded by ``size`` plus the
    alphabet, so it can be shipped to every task."""
    words = vocabulary(df, tok, size).select(F.col("term").alias("piece"))
    distinct_words = df.select(F.explode_outer(tok).alias("w")).filter(F.col("w").isNotNull()).distinct()
    chars = (distinct_words.select(F.explode(F.split(F.col("w"), "")).alias("c"))
             .filter(F.col("c") != "").distinct())
    return words.unionByName(chars.select(F.col("c").alias("piece"))).unionByName(
        chars.select(F.concat(F.lit(CONTINUATION), F.col("c")).alias("piece"))).distinct()


def word_pieces(words, vocab: set[str], longest: int | None = None):
    """Greedy longest-match split of each word; a word with an unmatched part
    becomes one unknown piece. ``longest``: the length of the vocabulary's
    longest piece, if it is known."""
    out, longest = [], max(map(len, vocab), default=0) if longest is None else longest
    for w in words:
        start, pieces = 0, []
        while start < len(w):
            # No piece is longer than the longest of the vocabulary, so long words stay linear.
            end, cur = min(len(w), start + longest), None
            while start < end:
                sub = w[start:end] if start == 0 else CONTINUATION + w[start:end]
                if sub in vocab:
                    cur = sub
                    break
                end -= 1
            if cur is None:
                pieces = [UNKNOWN_PIECE]
                break
            pieces.append(cur)
            start = end
        out.extend(pieces)
    return out


def wordpiece(df: DataFrame, tok: str, vocab: DataFrame, out: str = "pieces") -> DataFrame:
    """Word pieces for a token-array column. ``vocab`` is a piece
    vocabulary: a stated number of words and two pieces a character, and so
    of bounded size. A task splits each distinct word once."""
    pieces = frozenset(r[0] for r in vocab.collect())
    longest = max(map(len, pieces), default=0)   # looked for once, not with each word

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo: dict = {}
        for rows in batches:
            # Only a batch's distinct words are Python objects; their pieces are dealt to the rows as arrays.
            words = rows.flatten().dictionary_encode()
            distinct = words.dictionary.to_pylist()
            for w in distinct:
                if w not in memo:
                    memo[w] = word_pieces([w], pieces, longest)
            own = pa.array([memo[w] for w in distinct], pa.list_(pa.string())).take(words.indices)
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(own).to_numpy(zero_copy_only=False))])
            at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False))])
            yield pa.ListArray.from_arrays(pa.array(ends[at], pa.int32()), own.flatten(), mask=rows.is_null())

    return df.withColumn(out, split_words(F.col(tok)))
