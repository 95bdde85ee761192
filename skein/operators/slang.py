"""Slang expansion by a table of any size.

The table has columns ``slang``, ``expansion`` and ``place`` (its order: the
least wins where two entries fit at one position, as the first alternative of
a regex does). An entry stands at whole words, so it always covers whole runs
of word or non-word characters; texts are cut into those runs in the JVM, and
a place of a text is looked up once for each length (in runs) that entries
have. The time is linear in the text and does not grow with the table.

A table up to ``limit`` bytes is broadcast as a hash index and applied inside
the rows; beyond it, the runs join with the table by shuffle. Both ways give
the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators.quality import lists
from skein.session import cut_lineage, written

LIMIT = 8 << 20
RUNS = r"(?U)\w+|\W+"


def _runs(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(RUNS), F.lit(0))


def _is_word(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?U)^\w"), F.lit(False))


def slang_table(spark: SparkSession, mapping) -> DataFrame:
    """A dictionary as a table, in its order."""
    rows = [(k, v, i) for i, (k, v) in enumerate(mapping.items())]
    return spark.createDataFrame(rows, "slang string, expansion string, place long")


def _entries(table: DataFrame) -> DataFrame:
    """One row of each slang (least place, then expansion) with its runs; null and empty ones match nothing."""
    one = (table.filter("length(slang) > 0").groupBy("slang")
           .agg(F.min(F.struct(F.col("place").cast("long").alias("place"), F.coalesce("expansion", F.lit("")).alias("expansion"))).alias("e")))
    return one.select("slang", "e.place", "e.expansion", F.size(_runs(F.col("slang"))).alias("n"))


def _pick(runs: list[str], found: dict[int, tuple[int, str, str]]) -> tuple[str, list[str]]:
    """Left to right, an entry covers its runs; ``found`` has (runs, slang, expansion) by place."""
    out, hits, i = [], [], 0
    while i < len(runs):
        hit = found.get(i)
        if hit is None:
            out.append(runs[i])
            i += 1
        else:
            out.append(hit[2])
            hits.append(hit[1])
            i += hit[0]
    return "".join(out), hits


class Index:
    """The table as a hash of slang, with the lengths that entries have by their first run."""

    def __init__(self, entries: list[tuple[str, int, str, int]], firsts: list[str]):
        self.of = {slang: (place, n, slang, expansion) for slang, place, expansion, n in entries}
        self.lengths: dict[str, set[int]] = {}
        for (_, _, _, n), first in zip(entries, firsts):
            self.lengths.setdefault(first, set()).add(n)

    def find(self, runs: list[str], first_is_word: bool) -> dict[int, tuple[int, str, str]]:
        """At each run the entry of least place that stands there. Runs take turns, so
        whether one is a word follows from the first."""
        found, last = {}, len(runs) - 1
        for i, run in enumerate(runs):
            lengths = self.lengths.get(run)
            if lengths is None or (i == 0 and not first_is_word):
                continue
            best = None
            for n in lengths:
                j = i + n - 1
                if j > last or (j == last and (j % 2 == 0) != first_is_word):
                    continue
                e = self.of.get(run if n == 1 else "".join(runs[i:j + 1]))
                if e is not None and (best is None or e < best):
                    best = e
            if best is not None:
                found[i] = best[1:]
        return found


def expand_slang_table(df: DataFrame, text: str, table: DataFrame, out: str = "expanded", hits: str = "slang_hits",
                       limit: int = LIMIT) -> DataFrame:
    """The columns of ``df``, the text with every entry replaced
    (``out``) and the entries replaced, in text order (``hits``). Columns of
    these two names give way. A null text has nulls, an empty one ``''`` and
    no hits; repeated rows stay apart."""
    kept = [c for c in df.columns if c.lower() not in (out.lower(), hits.lower())]
    entries = cut_lineage(_entries(table))
    size = entries.agg(F.coalesce(F.sum(F.octet_length("slang") + F.octet_length("expansion") + 16), F.lit(0)).alias("b")).first().b
    base = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    if size <= limit:
        made = _inside(_cut(base, "row"), entries)
    else:
        # The text stands in the row already, if the row keeps it.
        made = _joined(base.drop("text") if text in kept else base, entries, F.col("row").getField(text) if text in kept else F.col("text"))
    return made.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("expanded").alias(out), F.col("hits").alias(hits))


def _cut(df: DataFrame, *columns: str, text: Column | None = None) -> DataFrame:
    """``columns``, the runs of ``text`` and whether the first is a word."""
    cut = df.select(*columns, _runs(F.col("text") if text is None else text).alias("runs"))
    return cut.withColumn("word", _is_word(F.get("runs", F.lit(0))))


def _schema(base: DataFrame) -> T.StructType:
    return T.StructType([base.schema["row"], T.StructField("expanded", T.StringType()),
                         T.StructField("hits", T.ArrayType(T.StringType()))])


def _inside(base: DataFrame, entries: DataFrame) -> DataFrame:
    first = F.get(_runs(F.col("slang")), F.lit(0)).alias("first")
    shared = base.sparkSession.sparkContext.broadcast(entries.select("slang", "place", "expansion", "n", first).toArrow())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *columns, firsts = shared.value.columns
        index = Index(list(zip(*(c.to_pylist() for c in columns))), firsts.to_pylist())
        for b in batches:
            made = [(None, None) if r is None else _pick(r, index.find(r, w))
                    for r, w in zip(lists(b.column(1)), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m[0] for m in made], pa.string()),
                                              pa.array([m[1] for m in made], pa.list_(pa.string()))], names=["row", "expanded", "hits"])

    return base.mapInArrow(run, _schema(base))


def _stretches(runs: list[str], first_is_word: bool, kinds: list[tuple[int, bool]]) -> dict[str, list[int]]:
    """The stretches of runs that are as long as some entry, each with where it stands."""
    at: dict[str, list[int]] = {}
    last = len(runs) - 1
    top = last if (last % 2 == 0) == first_is_word else last - 1   # an entry ends with a word run, unless others follow
    for n, word in kinds:
        start = 0 if first_is_word == word else 1
        for i in range(start if first_is_word or word else 2, last - n + 2, 2):
            if i + n - 1 < last or i + n - 1 == top:
                at.setdefault(runs[i] if n == 1 else "".join(runs[i:i + n]), []).append(i)
    return at


def _joined(base: DataFrame, entries: DataFrame, text: Column) -> DataFrame:
    """The same by a join: every stretch of runs that is as long as some entry
    meets the table, once for each text with all its places there."""
    # As many kinds as entries have lengths; a table of words alone never asks for what stands between them.
    kinds = [(r.n, bool(r.word)) for r in entries.select("n", _is_word(F.col("slang")).alias("word")).distinct().collect()]
    # Ids are given before the rows are written, so they stay the same when a task is run again.
    base = written(base.withColumn("id", F.monotonically_increasing_id()), "slang")

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                b = whole.slice(start, 256)
                rows = [(k, s, at) for k, r, w in zip(b.column(0).to_pylist(), lists(b.column(1)), b.column(2).to_pylist())
                        if r for s, at in _stretches(r, w, kinds).items()]
                k, s, at = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(s, pa.string()), pa.array(at, pa.list_(pa.int32()))],
                                                 names=["id", "slang", "at"])

    met = _cut(base, "id", text=text).mapInArrow(stretch, "id long, slang string, at array<int>").join(entries, "slang")
    found = met.groupBy("id").agg(F.collect_list(F.struct("place", "n", "slang", "expansion", "at")).alias("found"))

    def best(hits) -> dict[int, tuple[int, str, str]]:
        """At each place the entry of least place in the table, then the shortest."""
        at: dict[int, tuple] = {}
        for h in hits or []:
            e = (h["place"], h["n"], h["slang"], h["expansion"])
            for i in h["at"]:
                if i not in at or e < at[i]:
                    at[i] = e
        return {i: e[1:] for i, e in at.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                b = whole.slice(start, 256)
                made = [(None, None) if r is None else _pick(r, best(f)) for r, f in zip(lists(b.column(2)), b.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m[0] for m in made], pa.string()),
                                                  pa.array([m[1] for m in made], pa.list_(pa.string()))], names=["row", "expanded", "hits"])

    # Runs are cut again behind the join: a text is smaller than its runs.
    both = base.join(found, "id", "left")
    return _cut(both, "row", "found", text=text).select("row", "found", "runs").mapInArrow(run, _schema(base))
