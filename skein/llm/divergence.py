"""How sources differ in vocabulary from each other and from their language.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. A
language keeps the terms that at least ``least_docs`` of its documents have.
The kept terms of all languages are sorted by language and term, and a term's
place there is its ordinal.

A minimal acyclic transducer of the sorted terms (a language's name, a zero
byte, the term) gives ordinals as its output. The texts are streamed through
it once more, all words of a slice a byte at a step, and counted by group
(language and source) and ordinal; no term travels with a count. Ordinals are
in order of language and bytes, so they also break ties.

The transducer that every task holds has the ``RESIDENT`` terms of the most
documents, of ``LONGEST`` bytes at most (so what is broadcast is bounded, at
any vocabulary). Where there are more kept terms, the words it does not
accept are counted in the task and sent by hash to buckets of about
``BUCKET`` words, each with a transducer of the other kept terms there. The
split decides where a word is recognised, never whether.

Smoothed shares are whole numbers: with count c of a term in a group, N of
all kept terms in it and V terms kept, p = 1 + floor(10^9 (c + 1) / (N + V)).
The divergence of p from q adds floor((p - q)^2 / q) by term. Sums of one
language are worked out by blocks of ordinals; a block holds all groups'
counts of its terms, and its width falls with the number of groups.

Defined results: null texts, languages and sources count as empty; documents
are rows, so repeated ones count as often as they come; a group without terms
has N = 0; a language that keeps no terms has pairs of value 0; an empty
table gives an empty one. Only the named columns are read, so none can clash.
One term is in memory at a time as it stands, and a text in pieces of
``PIECE`` bytes when documents are counted; streaming holds about 60 bytes a
byte of the longest text. A text's rows never depend on others in its task.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.automaton import Transducer
from skein.llm.frames import col, numbered, written
from skein.llm.vec import Words, in_parts

LEAST_DOCS, TOP = 3, 200
RESIDENT, LONGEST, BUCKET = 1 << 19, 64, 1 << 16
HELD, HELD_BYTES = 300_000, 24 << 20   # entries (and their bytes) that a counting task holds before it hands them on
PIECE = 1 << 20
CELLS = 1 << 18          # groups x terms of a block
TILE = 512               # groups whose pairs one task works out
UNIT = 10 ** 9
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LOWER = np.frombuffer(LOWER, dtype=np.uint8)
_TERM, _OTHER = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")
_HELD: dict[str, tuple] = {}   # transducers of the job that a worker works on


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about PIECE bytes, cut between terms."""
    start = 0
    while len(raw) - start > PIECE:
        cut = _OTHER.search(raw, start + PIECE)
        end = cut.end() if cut else len(raw)
        yield raw[start:end]
        start = end
    yield raw[start:]


def _document_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, docs) of ``docs`` (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _HELD.clear()
        held: dict[str, Counter] = {}
        entries = size = 0

        def handed_on():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()),
                                                  pa.array(list(counts.values()), pa.int64())], names=["lang", "term", "docs"])
            held.clear()

        for part, texts in in_parts(batches, 1):
            for lang, text in zip(part.column(0).to_pylist(), texts):
                terms: set[bytes] = set()
                for piece in _pieces(text.encode("utf-8").translate(LOWER)):
                    terms.update(_TERM.findall(piece))
                own = held.setdefault(lang, Counter())
                before = len(own)
                own.update(terms)
                entries += len(own) - before
                size += sum(map(len, terms)) if len(text) > PIECE else 0
                if entries > HELD or size > HELD_BYTES:
                    yield from handed_on()
                    entries = size = 0
        yield from handed_on()

    return (docs.select("lang", "text").mapInArrow(run, "lang string, term binary, docs long")
            .groupBy("lang", "term").agg(F.sum("docs").alias("docs")))


def vocabulary(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term binary, docs, ordinal): the kept terms and their ordinals."""
    kept = _document_counts(docs).filter(F.col("docs") >= least_docs)
    return written(numbered(kept, F.col("lang"), F.col("term"), name="ordinal"), "vocabulary")


def _resident(kept: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The kept terms of the most documents, ``most`` at most (all from the
    least sixteenth of a power of two on that fits), and the others."""
    step = F.floor(F.log2("docs") * 16).cast("int")
    short = F.octet_length("term") + F.octet_length("lang") <= LONGEST
    least, held = 1 << 20, 0
    for r in kept.filter(short).groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        held += r["count"]
        if held > most:
            break
        least = r.step
    inside = short & (step >= least)
    return kept.filter(inside), kept.filter(~inside)


def _key(lang: str) -> bytes:
    return lang.encode("utf-8") + b"\0"


def _counted(docs: DataFrame, kept: DataFrame, resident: int) -> DataFrame:
    """(gid, ordinal, n): occurrences of kept terms in ``docs`` (gid, lang, text)."""
    inside, outside = _resident(kept, resident)
    rows = inside.select("lang", "term", "ordinal").orderBy("ordinal").toArrow()
    ordinals = rows.column("ordinal").to_numpy()
    keys = [_key(lang) + term for lang, term in zip(rows.column("lang").to_pylist(), rows.column("term").to_pylist())]
    others = outside.count()
    name, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast((Transducer(keys), ordinals, others > 0))
    del rows, keys

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _HELD:
            _HELD.clear()
            _HELD[name] = shared.value
        automaton, ordinal, more = _HELD[name]
        prefixes: dict[str, tuple[int, int] | None] = {}
        gids: dict[int, int] = {}
        known, unknown, size = [], Counter(), 0

        def handed_on():
            nonlocal known, size
            if known:
                pairs, n = _summed(known)
                group = np.fromiter(gids, dtype=np.int64, count=len(gids))[pairs >> 32]
                none = pa.nulls(len(pairs))
                yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(ordinal[pairs & 0xFFFFFFFF]), none.cast(pa.string()),
                                                  none.cast(pa.binary()), pa.array(n)], names=NAMES)
            if unknown:
                group, lang, term = zip(*unknown)
                yield pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), pa.nulls(len(group), pa.int64()), pa.array(lang, pa.string()),
                                                  pa.array(term, pa.binary()), pa.array(list(unknown.values()), pa.int64())], names=NAMES)
            unknown.clear()
            known, size = [], 0

        for part, texts in in_parts(batches, 2, PIECE // 2):
            words = Words([t.encode("utf-8") for t in texts], LETTER)
            buf, of = _LOWER[words.buf], words.text_of()
            langs, groups = part.column(1).to_pylist(), part.column(0).to_pylist()
            for lang in set(langs).difference(prefixes):
                prefixes[lang] = automaton.prefix(_key(lang))
            begin = np.array([prefixes[lang] or (-1, 0) for lang in langs], dtype=np.int64)
            mine = np.array([gids.setdefault(g, len(gids)) for g in groups], dtype=np.int64)
            place = np.full(len(of), -1, dtype=np.int64)
            walk = np.flatnonzero(begin[of, 0] >= 0)
            place[walk] = automaton.find(buf, words.starts[walk], words.ends[walk], begin[of[walk], 0], begin[of[walk], 1])
            held = place >= 0
            known.append(np.unique(mine[of[held]] << 32 | place[held], return_counts=True))
            if len(known) > 4:
                known = [_summed(known)]
            if more:
                raw = buf.tobytes()
                for i in np.flatnonzero(~held).tolist():
                    term = raw[words.starts[i]:words.ends[i]]
                    unknown[groups[of[i]], langs[of[i]], term] += 1
                    size += len(term)
            if sum(len(k) for k, _ in known) + len(unknown) > HELD or size > 4 * HELD_BYTES:
                yield from handed_on()
        yield from handed_on()

    NAMES = ["gid", "ordinal", "lang", "term", "n"]
    found = docs.select("gid", "lang", "text").mapInArrow(stream, "gid long, ordinal long, lang string, term binary, n long")
    if not others:
        return found.groupBy("gid", "ordinal").agg(F.sum("n").alias("n"))
    found = written(found.groupBy("gid", "ordinal", "lang", "term").agg(F.sum("n").alias("n")), "terms-found")
    rest = found.filter("ordinal IS NULL")
    bucket = F.pmod(F.xxhash64("lang", "term"), F.lit(math.ceil((others + rest.count()) / BUCKET))).alias("bucket")

    def recognise(terms: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        """The ordinals of the words of a bucket."""
        entries = sorted((_key(lang) + bytes(term), o) for lang, term, o in zip(terms["lang"], terms["term"], terms["ordinal"]))
        words = [_key(lang) + bytes(term) for lang, term in zip(seen["lang"], seen["term"])]
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts = np.cumsum(lengths) - lengths
        at = Transducer([k for k, _ in entries]).find(np.frombuffer(b"".join(words) + b"\0", dtype=np.uint8), starts, starts + lengths)
        held = at >= 0
        own = np.fromiter((o for _, o in entries), dtype=np.int64, count=len(entries))
        return pd.DataFrame({"gid": seen["gid"].to_numpy()[held], "ordinal": own[at[held]], "n": seen["n"].to_numpy()[held]})

    late = (outside.select(bucket, "lang", "term", "ordinal").groupBy("bucket")
            .cogroup(rest.select(bucket, "gid", "lang", "term", "n").groupBy("bucket")).applyInPandas(recognise, "gid long, ordinal long, n long"))
    return found.filter("ordinal IS NOT NULL").select("gid", "ordinal", "n").unionByName(late)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    keys, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(keys), dtype=np.int64)
    np.add.at(out, at, counts)
    return keys, out


def shares(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(UNIT (count + 1) / (total + terms)), exactly: long division
    by thousands, so nothing leaves 64 bits."""
    whole = np.asarray(total, dtype=np.int64) + terms
    out, left = np.divmod(counts + 1, whole)
    for _ in range(3):
        digit, left = np.divmod(left * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def _block(width: int, tiles: int, top: int):
    """The work of one block of ordinals of a language, for one tile of groups."""
    def work(key, counts: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        block, tile = int(key[1]), int(key[2])
        groups = groups.sort_values("gid")
        gid, total = groups["gid"].to_numpy(), groups["total"].to_numpy()
        first, last, terms, lang_total = (int(groups[c].iloc[0]) for c in ("first", "last", "terms", "lang_total"))
        lo, hi = max(first, block * width), min(last + 1, (block + 1) * width) if terms else max(first, block * width)
        table = np.zeros((len(gid), max(0, hi - lo)), dtype=np.int64)
        table[np.searchsorted(gid, counts["gid"]), counts["ordinal"].to_numpy(dtype=np.int64) - lo] = counts["n"]
        own = np.flatnonzero(np.arange(len(gid)) % tiles == tile)
        p, q = table, table.sum(axis=0)
        if terms:
            p, q = shares(p, total[:, None], terms), shares(q, lang_total, terms)
        parts = []
        for a in own:
            value = ((p[a] - p) ** 2 // p).sum(axis=1) if table.shape[1] else np.zeros(len(gid), dtype=np.int64)
            others = np.arange(len(gid)) != a
            parts.append(pd.DataFrame({"pair": True, "gid": gid[a], "other": gid[others], "value": value[others]}))
            more = np.flatnonzero((table[a] > 0) & (p[a] > q))
            value = (p[a, more] - q[more]) ** 2 // q[more]
            best = np.lexsort((more, -value))[:top]
            parts.append(pd.DataFrame({"pair": False, "gid": gid[a], "other": more[best] + lo, "value": value[best]}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"pair": [], "gid": [], "other": [], "value": []}) \
            .astype({"pair": bool, "gid": "int64", "other": "int64", "value": "int64"})

    return work


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS,
          top: int = TOP, resident: int = RESIDENT) -> DataFrame:
    """One row for each ordered pair of a language's sources (``part`` 'pair':
    ``item`` is the other source) and each of a group's ``top`` terms that it
    has more of than its language ('term'): ``lang``, ``source``, ``part``,
    ``item``, ``value`` and ``rank``."""
    empty = F.lit("")
    docs = df.select(F.coalesce(col(lang).cast("string"), empty).alias("lang"), F.coalesce(col(source).cast("string"), empty).alias("source"),
                     col(text).alias("text")).withColumn("gid", F.xxhash64("lang", "source"))
    kept = vocabulary(docs, least_docs)
    counts = written(_counted(docs, kept, resident), "term-counts")
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.min("ordinal").alias("first"), F.max("ordinal").alias("last"))
    groups = (docs.select("gid", "lang", "source").distinct()
              .join(counts.groupBy("gid").agg(F.sum("n").alias("total")), "gid", "left").fillna(0, ["total"])
              .join(by_lang, "lang", "left").fillna({"terms": 0, "first": 0, "last": -1}))
    whole = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count(F.lit(1)).alias("members"))
    groups = written(groups.join(whole, "lang"), "term-groups")
    bound = groups.agg(F.max("members").alias("members"), F.count(F.lit(1)).alias("n"), F.countDistinct("gid").alias("gids")).first()
    if bound.gids != bound.n:
        raise ValueError("two groups have the same hash")
    members = bound.members or 1
    width = max(1, CELLS // members)
    tiles = math.ceil(members / TILE)
    tile = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile")
    blocks = F.sequence(F.floor(F.col("first") / width), F.greatest(F.floor(F.col("last") / width), F.floor(F.col("first") / width)))
    per_block = (groups.select("*", F.explode(blocks).alias("block")).select("*", tile)
                 .select("lang", F.col("block").cast("long"), "tile", "gid", "total", "first", "last", "terms", "lang_total"))
    cells = (counts.join(groups.select("gid", F.col("lang").alias("of")), "gid")
             .select(F.col("of").alias("lang"), F.floor(F.col("ordinal") / width).cast("long").alias("block"), tile, "gid", "ordinal", "n"))
    by = ["lang", "block", "tile"]
    values = written(cells.groupBy(*by).cogroup(per_block.groupBy(*by))
                     .applyInPandas(_block(width, tiles, top), "pair boolean, gid long, other long, value long"), "term-values")
    who = groups.select("gid", "lang", "source")
    pairs = values.filter("pair").groupBy("gid", "other").agg(F.sum("value").alias("value"))
    pairs = (pairs.join(who, "gid").join(who.select(F.col("gid").alias("other"), F.col("source").alias("item")), "other")
             .withColumn("rank", F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), F.col("item")))))
    ranked = F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), F.col("other")))
    terms = (values.filter("NOT pair").withColumn("rank", ranked).filter(F.col("rank") <= top)
             .join(kept.select(F.col("ordinal").alias("other"), F.col("term").cast("string").alias("item")), "other").join(who, "gid"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(*columns)
            .unionByName(terms.withColumn("part", F.lit("term")).select(*columns)))


def sql(least_docs: int = LEAST_DOCS, top: int = TOP) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
               FROM documents),
    w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'),
                 '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {least_docs}),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
    dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
              FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    p AS (SELECT *, 1 + (1000000000 * (n + 1)::HUGEINT) // (sum(n) OVER s + count(*) OVER s)::HUGEINT AS p
          FROM dense WINDOW s AS (PARTITION BY lang, source)),
    l AS (SELECT lang, term, sum(n) AS n FROM dense GROUP BY lang, term),
    q AS (SELECT lang, term, 1 + (1000000000 * (n + 1)::HUGEINT) // (sum(n) OVER s + count(*) OVER s)::HUGEINT AS q
          FROM l WINDOW s AS (PARTITION BY lang)),
    pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    terms AS (SELECT p.lang, p.source, p.term AS item, ((p - q) * (p - q)) // q AS value
              FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
    everything AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
      UNION ALL SELECT lang, source, 'term', item, value FROM terms),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM everything)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""
