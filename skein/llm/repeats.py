"""Removal of repeated passages by hashing lines, paragraphs or sentences.

A text is cut into units; each is normalised (A-Z in lower case, runs of
white space as one) and digested to 128 bits. All units of all documents are
grouped by digest; the earliest occurrence by rank (key, then place in the
document) stays, every later one is marked and taken out of the text. Offsets
are characters of the original text.

A caller that cuts lines into sentences can ask that pieces inside a line stay
unless their run of marked neighbours has ``least_words`` words, since short
phrases meet by chance. Lines (and paragraphs) that are marked as a whole
leave at any length. The pieces that stay are returned with their offsets and
keepers on demand (``stays``).

What is shuffled for each unit is two digests and its rank, not its text; the
grouping combines in the map tasks, so a unit that is everywhere arrives once
a task; the join that marks its occurrences is one that Spark splits when a
key is skewed. The marks of a document meet its text in one join.

Defined results: null and empty texts have no units; a null key ranks first;
rows that are equal in key and text count as one document and share its
result; a document may lose all its text. An empty table gives an empty one.
Input columns named like an output give way, except the text itself, which
becomes the text that is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.frames import col, written
from skein.llm.vec import SPACE, Words, in_parts, mixed, powers

LEAST_WORDS = 1
OUTPUTS = ["removed", "n_units", "n_removed", "kept_in"]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Units:
    """The units of some texts: ``first`` (of each text, one more at the
    end), ``words`` (how many each has), ``digests`` (two columns), ``line``
    (equal for the units of one line) and the character offsets at which they
    begin and end."""

    def __init__(self, texts: list[str], unit: str):
        w = Words([t.encode("utf-8") for t in texts], ~SPACE)
        n = len(w.starts)
        lines = np.concatenate([[0], np.cumsum(w.buf == 10)])
        text_ends = np.append(w.text_starts[1:], len(w.buf) + 1) - 1
        owner = w.text_of()
        after = np.append(w.starts[1:], len(w.buf))
        gap = lines[np.minimum(after, len(w.buf))] - lines[w.ends] if n else np.zeros(0, dtype=np.int64)
        last = np.zeros(n, dtype=bool)
        last[w.first[1:][w.counts > 0] - 1] = True
        if unit == "paragraph":
            last |= gap > 1
        else:
            last |= gap > 0
            if unit == "sentence":
                last |= np.isin(w.buf[w.ends - 1], list(b".!?")) if n else False
        end = np.flatnonzero(last)
        start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
        self.words = end - start + 1
        self.line = (lines[w.starts[start]] if unit == "sentence" else start) if n else start
        self.first = np.searchsorted(start, w.first)
        chars = np.concatenate([[0], np.cumsum((w.buf & 0xC0) != 0x80)])
        base = chars[w.text_starts][owner[start]] if n else np.zeros(0, dtype=np.int64)
        same = owner[start][1:] == owner[start][:-1] if n else np.zeros(0, dtype=bool)
        nxt = np.where(np.append(same, False), np.append(w.starts[start][1:], 0), text_ends[owner[start]]) if n else start
        self.begin, self.end = chars[w.starts[start]] - base if n else start, chars[nxt] - base if n else start
        if not n:
            self.digests = np.zeros((0, 2), dtype=np.int64)
            return
        h = w.hashes(buf=_LOWER[w.buf])
        place = np.arange(n) - np.repeat(start, self.words)
        power = powers(int(self.words.max()) + 1)[place]
        two = [np.add.reduceat(x * power, start) for x in (h, mixed(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)))]
        self.digests = np.stack([mixed(x).view(np.int64) for x in two], axis=1)


def _units(df: DataFrame, key: str, text: str, unit: str) -> DataFrame:
    """(h1, h2, key, doc, idx): a row for each unit. ``doc`` is a hash of key
    and text, which tells apart documents that share a key."""
    rows = df.select(col(key).alias("key"), F.xxhash64(col(key), col(text)).alias("doc"), col(text).alias("text"))
    schema = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), rows.schema["key"],
                           T.StructField("doc", T.LongType()), T.StructField("idx", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_parts(batches, 2):
            u = Units(texts, unit)
            owner = pa.array(np.repeat(np.arange(len(texts)), np.diff(u.first)))
            idx = np.arange(len(u.words)) - np.repeat(u.first[:-1], np.diff(u.first))
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.digests[:, 0]), pa.array(u.digests[:, 1]), part.column(0).take(owner), part.column(1).take(owner),
                 pa.array(idx.astype(np.int32))], names=["h1", "h2", "key", "doc", "idx"])

    return rows.mapInArrow(run, schema)


def marked_units(df: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "line") -> DataFrame:
    """(key, doc, marks): the units of each document that occur earlier, as
    (idx, key of the document that keeps it)."""
    units = _units(df, key, text, unit)
    rank = F.struct("key", "doc", "idx")
    seen = (units.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
            .filter(~F.col("first").eqNullSafe(F.col("last"))).select("h1", "h2", "first"))
    # Written, so that both sides of the join are exchanged anew and a unit that is everywhere can be split.
    later = units.join(written(seen, "repeats"), ["h1", "h2"]).filter(~rank.eqNullSafe(F.col("first")))
    return (later.groupBy("key", "doc")
            .agg(F.collect_set(F.struct("idx", F.col("first.key").alias("kept"))).alias("marks")))


def _runs(mark: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))).tolist()
    return list(zip(edge[0::2], edge[1::2]))


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "line",
                   least_words: int = LEAST_WORDS, stays: bool = False) -> DataFrame:
    """The columns of ``df``, the text without repeated passages, ``removed``
    (their offsets), ``n_units``, ``n_removed`` (units taken out) and
    ``kept_in`` (sorted keys of the documents that keep what was removed).
    ``least_words`` holds for runs of sentences inside a line only. With
    ``stays``, a column of that name has the repeated units that it leaves in
    the text: offsets, and the key of the document with the first one."""
    if unit not in ("line", "paragraph", "sentence"):
        raise ValueError("unit is 'line', 'paragraph' or 'sentence'")
    outputs = OUTPUTS + ["stays"] * stays
    taken = {o.lower() for o in outputs}
    kept = [c for c in df.columns if c.lower() not in taken]
    body = df.select(F.struct(*[col(c) for c in kept]).alias("row"), F.xxhash64(col(key), col(text)).alias("doc"),
                     col(key).alias("key"))
    marks = marked_units(df, key, text, unit).withColumnsRenamed({"key": "m_key", "doc": "m_doc"})
    joined = body.join(marks, (F.col("doc") == F.col("m_doc")) & F.col("key").eqNullSafe(F.col("m_key")), "left")
    flat = joined.select(*[F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(kept)],
                         F.col("marks.idx").alias("idx"), F.col("marks.kept").alias("kept"))
    at, n = kept.index(text), len(kept)
    key_type = df.schema[key].dataType
    fields = [T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(kept)]
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType(fields + [T.StructField("removed", T.ArrayType(span)), T.StructField("n_units", T.IntegerType()),
                                    T.StructField("n_removed", T.IntegerType()),
                                    T.StructField("kept_in", T.ArrayType(key_type))])
    if stays:
        schema = schema.add("stays", T.ArrayType(T.StructType([*span.fields, T.StructField("kept_in", key_type)])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for part, texts in in_parts(batches, at):
            u = Units(texts, unit)
            nulls = part.column(at).is_null().to_pylist()
            left, removed, gone, where, rest = [], [], [], [], []
            for i, (t, idx, keys) in enumerate(zip(texts, part.column(n).to_pylist(), part.column(n + 1).to_pylist())):
                lo, hi = u.first[i], u.first[i + 1]
                out, cut, count, sources, kept_units = [], [], 0, set(), []
                if idx:
                    of = dict(zip(idx, keys))
                    mark = np.zeros(hi - lo, dtype=bool)
                    mark[np.array(idx)] = True
                    new_line = np.append(True, np.diff(u.line[lo:hi]) != 0)
                    goes = np.logical_and.reduceat(mark, np.flatnonzero(new_line))[np.cumsum(new_line) - 1]
                    for a, b in _runs(mark):
                        if u.words[lo + a:lo + b].sum() >= least_words:
                            goes[a:b] = True
                    for a, b in _runs(goes):
                        cut.append((int(u.begin[lo + a]), int(u.end[lo + b - 1])))
                        count += b - a
                        sources.update(of[j] for j in range(a, b))
                    kept_units = [{"start": int(u.begin[lo + j]), "end": int(u.end[lo + j]), "kept_in": of[j]}
                                  for j in np.flatnonzero(mark & ~goes).tolist()] if stays else []
                done = 0
                for a, b in cut:
                    out.append(t[done:a])
                    done = b
                left.append(None if nulls[i] else "".join([*out, t[done:]]))
                removed.append([{"start": a, "end": b} for a, b in cut])
                gone.append(int(count))
                where.append(sorted(sources, key=lambda k: (k is not None, k)))
                rest.append(kept_units)
            cols = [pa.array(left, pa.string()) if i == at else part.column(i) for i in range(n)]
            keys_type = part.schema.field(n + 1).type
            more = [pa.array(rest, pa.list_(pa.struct([*spans.value_type, ("kept_in", keys_type.value_type)])))] if stays else []
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(removed, spans), pa.array(np.diff(u.first).astype(np.int32)), pa.array(gone, pa.int32()),
                 pa.array(where, keys_type), *more], names=schema.names)

    out = flat.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *outputs)
