"""Mixing sources to target weights by hash-threshold histograms.

A document's size is its number of words. The sources, by code point and null
last, weigh by a repeating pattern and share a budget (a multiple of all
sizes). A target stops at ``most`` times its source's size; what is over goes
to the others by weight, until none is above: one small aggregate over the
sources a round.

A source takes all its documents as often as its target holds its size, and
once more those whose draw (a hash of key and text) lies below a threshold.
The threshold is found without sorting: sizes are summed by source and the
draw's first ``DIGIT`` bits, the bucket in which the rest of the budget runs
out is found from the running sums, and only that bucket's documents are
summed again by their next bits, until one document is left. That one is
taken if at least half of it is within the budget, so a source misses its
target by half a document at most. Thresholds are nested: a larger budget
takes what a smaller one takes. Draws decide for all documents alike, so
reruns agree.

Rows equal in key and text draw alike; then the bits of a row number decide.
Which of them is taken does not show.

Defined results: a null text has size 0 and takes 0 words; null keys and
repeated rows are rows like any other; a null source is a source of its own,
the last; an empty table gives an empty one. Input columns named like an
output give way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.frames import col, numbered, unpacked, written

DIGIT = 12                       # bits of a draw that one histogram tells apart
LEVELS = ([("draw", s) for s in range(48, -1, -DIGIT)] + [("rid", s) for s in range(60, -1, -DIGIT)])
OUTPUTS = ["size", "source_size", "target", "taken", "copies"]
WHITE = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """How many words a text has, without making them: each word, with the
    white space behind it, becomes one sign."""
    bare = F.ltrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.length(F.regexp_replace(bare, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "w")).cast("long")


def draw(key: Column, text: Column) -> Column:
    """60 bits of a hash of key and text."""
    both = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) of ``sources`` (source, size)."""
    ranked = numbered(sources, F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    ranked = written(ranked.withColumn("w", F.element_at(pattern, (F.col("place") % len(weights) + 1).cast("int"))), "mix-sources")
    cap = F.col("size") * F.lit(float(most))
    total, weight = ranked.agg(F.sum("size"), F.sum("w")).first()
    left, budget = weight, share * float(total or 0)
    over = budget
    while left:
        full = cap < F.lit(over) * F.col("w") / F.lit(left)
        capped, rest = ranked.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("w")))).first()
        if (rest or 0.0) == left:
            break
        over, left = budget - (capped or 0.0), rest or 0.0
    own = F.lit(over) * F.col("w") / F.lit(left) if left else cap
    return ranked.select("source", F.col("size").alias("source_size"), F.when(cap < own, cap).otherwise(own).alias("target"))


def _edges(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """(source, rest, t_draw, t_rid): of each source the threshold below which
    documents are taken once more."""
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    open_ = quotas.select("source", "rest", F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("draw_from"),
                          F.lit(0).cast("long").alias("rid_from"))
    found = None
    for column, shift in LEVELS:
        wider = shift + DIGIT
        near = (F.shiftright(rows["draw"], wider) == F.shiftright(open_["draw_from"], wider)) if column == "draw" and wider < 60 else \
            (rows["draw"] == open_["draw_from"]) & (F.shiftright(rows["rid"], wider) == F.shiftright(open_["rid_from"], wider)) \
            if column == "rid" and wider < 64 else (rows["draw"] == open_["draw_from"]) if column == "rid" else F.lit(True)
        inside = rows.join(open_, same(rows, open_) & near).select(
            rows["source"], "rest", "below", "draw_from", "rid_from", "size", F.shiftright(rows[column], shift).alias("bucket"))
        sums = inside.groupBy("source", "bucket").agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"), F.first("rest").alias("rest"), F.first("below").alias("below"),
            F.first("draw_from").alias("draw_from"), F.first("rid_from").alias("rid_from"))
        up = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("below") + F.coalesce(F.sum("size").over(up), F.lit(0))
        edge = sums.withColumn("start", start).filter((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("size")))
        edge = written(edge.select("source", "rest", F.col("start").alias("below"), "size", "rows", "bucket", "draw_from", "rid_from"), "mix-edge")
        # One document left: it is taken if its middle is within the budget, then the threshold is the next bucket.
        lower = F.shiftleft(F.col("bucket"), shift)
        upper = F.shiftleft(F.col("bucket") + F.when(F.col("below") + F.col("size") / 2 <= F.col("rest"), 1).otherwise(0), shift)
        zero = F.lit(0).cast("long")
        at, done = ((lower, zero), (upper, zero)) if column == "draw" else ((F.col("draw_from"), lower), (F.col("draw_from"), upper))
        single = edge.filter("rows = 1").select("source", done[0].alias("t_draw"), done[1].alias("t_rid"))
        found = single if found is None else found.unionByName(single)
        open_ = edge.filter("rows > 1").select("source", "rest", "below", at[0].alias("draw_from"), at[1].alias("rid_from"))
        if open_.isEmpty():
            break
    return found


def mix(df: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, key: str = "doc_id",
        text: str = "text", source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``df`` (all, if not given), and of each row
    ``size``, ``source_size``, ``target`` (its source's), ``taken`` (words that
    the mix takes of it, repeats counted) and ``copies``."""
    carry = df.columns if carry is None else carry
    rows = written(df.select(F.struct(*map(col, carry)).alias("row"), col(source).alias("source"), words(col(text)).alias("size"),
                             draw(col(key), col(text)).alias("draw"), F.monotonically_increasing_id().alias("rid")), "mix-rows")
    aims = targets(rows.groupBy("source").agg(F.sum("size").alias("size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    aims = written(aims.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    edges = _edges(rows.filter("size > 0"), aims)
    limits = written(aims.alias("a").join(edges.alias("e"), F.col("a.source").eqNullSafe(F.col("e.source")), "left")
                     .select("a.*", "t_draw", "t_rid"), "mix-limits").withColumnRenamed("source", "of")
    # The limits are one narrow row a source: Spark broadcasts them by their size, or splits a hot source.
    once_more = F.coalesce((F.col("draw") < F.col("t_draw")) | ((F.col("draw") == F.col("t_draw")) & (F.col("rid") < F.col("t_rid"))), F.lit(False))
    out = (rows.join(limits, F.col("source").eqNullSafe(F.col("of")))
           .withColumn("copies", (F.col("whole") + once_more.cast("long")).cast("int"))
           .withColumn("taken", F.col("copies") * F.col("size")))
    return unpacked(out, carry, OUTPUTS)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as the mix takes it."""
    return mixed.filter("copies > 0").withColumn("copy", F.explode(F.expr("sequence(1, copies)")))


def sql(weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> str:
    pattern = "[" + ", ".join(f"{float(w)}" for w in weights) + "]"
    return rf"""
    WITH d AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS draw
      FROM documents),
    s AS (
      SELECT source, sum(size)::DOUBLE AS size, {pattern}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)}] AS w
      FROM d GROUP BY source),
    f AS (
      SELECT *, {share} * sum(size) OVER () AS budget, sum(w) OVER () AS all_w,
             coalesce(sum({most} * size) OVER b, 0) AS caps, coalesce(sum(w) OVER b, 0) AS ws
      FROM s WINDOW b AS (ORDER BY size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    c AS (SELECT *, {most} * size < (budget - caps) * w / (all_w - ws) AS full_ FROM f),
    l AS (SELECT coalesce(sum({most} * size) FILTER (full_), 0) AS caps, sum(w) FILTER (NOT full_) AS ws FROM c),
    t AS (
      SELECT source, size, CASE WHEN full_ THEN {most} * size ELSE (budget - l.caps) * w / l.ws END AS target
      FROM c, l),
    q AS (SELECT *, CASE WHEN size > 0 THEN floor(target / size) ELSE 0 END AS whole FROM t),
    r AS (
      SELECT d.*, q.size::BIGINT AS source_size, target, whole, target - whole * q.size AS rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
    SELECT doc_id, size, source_size, target,
           CAST(size * (whole + CASE WHEN before + size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM r"""
