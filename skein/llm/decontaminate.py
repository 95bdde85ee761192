"""Benchmark decontamination by q-gram filtering and banded alignment.

A document is contaminated when a stretch of it is a whole benchmark item but
for a budget of single-character edits (``EDIT_SHARE`` of the item's length).
By the q-gram lemma such a stretch keeps at least n - q + 1 - k q of the
item's q-grams (n: its length, k: the budget), and on diagonals (place in the
text less place in the item) at most k apart. Shared q-grams are therefore
counted in overlapping bands of diagonals, 2 (k + 1) wide, one beginning
every k + 1; bands that reach the bound are verified by a banded alignment of
the whole item against the text, free at both ends.

Texts are compared by character, letters in lower case and white space as
spaces; offsets are those of the original text. Every whole document is
scanned where it lies; the benchmark goes to the workers in blocks of
``BLOCK`` characters, each a broadcast of bounded size and a step of the same
pass. After ``HELD`` blocks the rows with their hits are written to the shared
folder and those broadcasts are released, so the room that is needed does not
grow with the benchmark (a larger one reads the rows once more for every
``HELD`` blocks). No pairs are shuffled.

Defined results: null or empty documents and items match nothing; for an item
too short for its budget the budget shrinks until the bound is at least one
q-gram; an item shorter than q contaminates only a document that equals it.
Rows are scanned one by one, so repeated rows and null keys need no care; an
empty table gives an empty one. Input columns named like an output give way.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.frames import col, written
from skein.llm.vec import in_parts, mixed

Q = 8
EDIT_SHARE = 0.1
BLOCK = 4 << 20        # characters of benchmark in a pass
HELD = 4               # passes in one plan; more write the rows in between
FILTER_BITS = 20       # of the table that sorts out most q-grams
RUN, PAIRS = 4096, 4 << 20   # places of a run of one q-gram; pairs of places that are counted at once, about
CELL_BITS, HALF = 40, 1 << 39
OUTPUTS = ["contaminated", "item_ids", "hits"]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """One-to-one lower case and spaces, for code points below 2^16."""
    if not _FOLD:
        table = np.arange(1 << 16, dtype=np.uint32)
        for i in range(1 << 16):
            c = chr(i)
            if c.isspace():
                table[i] = 32
            elif len(low := c.lower()) == 1 and ord(low) < 1 << 16:
                table[i] = ord(low)
        table[0] = 1   # 0 stands between texts
        _FOLD.append(table)
    return _FOLD[0]


def folded(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    table = _fold()
    small = table[np.minimum(codes, len(table) - 1)]
    return np.where(codes < len(table), small, codes) if len(codes) and codes.max() >= len(table) else small


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q characters from each place on (q a power of two)."""
    h, width, base = codes.astype(np.uint64), 1, _BASE
    while width < q:
        if len(h) <= width:
            return np.zeros(0, dtype=np.uint64)
        h = h[:-width] * base + h[width:]
        base, width = np.uint64(int(base) ** 2 & 0xFFFFFFFFFFFFFFFF), 2 * width
    return mixed(h)


class Items:
    """The q-gram index of a block of benchmark items."""

    def __init__(self, items: list[tuple], share: float = EDIT_SHARE):
        items = [(i, folded(t)) for i, t in items if t]
        self.whole = {t.tobytes(): i for i, t in items if len(t) < Q}
        items = [(i, t) for i, t in items if len(t) >= Q]
        self.ids, self.texts = [i for i, _ in items], [t for _, t in items]
        n = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.n, self.k = n, np.minimum((n * share).astype(np.int64), (n - Q) // Q)
        self.bound = n - Q + 1 - self.k * Q
        h = [grams(t) for t in self.texts]
        flat = np.concatenate(h) if h else np.zeros(0, dtype=np.uint64)
        order = np.argsort(flat, kind="stable")
        self.item = np.repeat(np.arange(len(h)), [len(x) for x in h])[order] if h else np.zeros(0, dtype=np.int64)
        self.place = np.concatenate([np.arange(len(x)) for x in h])[order] if h else np.zeros(0, dtype=np.int64)
        self.grams, self.start, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.seen[self.grams >> np.uint64(64 - FILTER_BITS)] = True

    def find(self, texts: list[str]) -> list[list[tuple]]:
        """Of each text its hits: (item id, start, end, edits)."""
        codes = [folded(t) for t in texts]
        hits = [[(self.whole[c.tobytes()], 0, len(c), 0)] if len(c) < Q and c.tobytes() in self.whole else [] for c in codes]
        if not len(self.grams):
            return hits
        gap = np.zeros(1, dtype=np.uint32)
        flat = np.concatenate([x for c in codes for x in (c, gap)])
        ends = np.cumsum([len(c) + 1 for c in codes])
        h = grams(flat)
        at = np.flatnonzero(self.seen[h >> np.uint64(64 - FILTER_BITS)])
        which = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        real = self.grams[which] == h[at]
        at, which = at[real], which[real]
        raw = flat.tobytes()
        for item, band in self._bands(at, which):
            starts, width = band * (self.k[item] + 1), int(4 * self.k[item] + 2)
            # A band holds diagonals starts .. starts + 2 k + 1; k more on each side for drift.
            low, open_ = starts - int(self.k[item]), []
            for lo in low.tolist():
                # The alignment without edits needs no table.
                found = _within(raw, self.texts[item].tobytes(), max(0, lo), lo + width + int(self.n[item]))
                if found is None:
                    open_.append(lo)
                else:
                    self._hit(ends, codes, item, found, found + int(self.n[item]), 0, hits)
            if open_:
                self._verify(flat, ends, codes, item, np.array(open_), width, hits)
        return [_best(x) for x in hits]

    def _cells(self, first: np.ndarray, last: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, count) of the shared q-grams of runs of text places that have
        one q-gram: a cell is an item and a step of its diagonals (in budgets
        plus one) as one number. A run meets each place of its q-gram in an
        item on a row of diagonals, which adds to each step at once."""
        count = self.count[gram]
        own = np.repeat(self.start[gram], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        item, place = self.item[own], self.place[own]
        step = self.k[item] + 1
        low, high = np.repeat(first, count) - place, np.repeat(last, count) - place
        bands = high // step - low // step + 1
        if bands.max(initial=1) == 1:
            return (item << CELL_BITS) + (low // step + HALF), high - low + 1
        to = np.repeat(np.arange(len(item)), bands)
        band = low[to] // step[to] + np.arange(len(to)) - np.repeat(np.cumsum(bands) - bands, bands)
        weight = np.minimum(high[to], (band + 1) * step[to] - 1) - np.maximum(low[to], band * step[to]) + 1
        return (item[to] << CELL_BITS) + (band + HALF), weight

    def _bands(self, at: np.ndarray, which: np.ndarray):
        """(item, bands that reach the bound); a band is named by the
        diagonal it begins on, in steps of the budget plus one, and two steps
        wide. Repetitive texts and items share a q-gram at many pairs of
        places: runs of one q-gram count as one, and the rest is counted in
        parts, so memory is bounded."""
        if not len(at):
            return
        # Runs of places with one q-gram, RUN at most.
        new = np.append(True, (which[1:] != which[:-1]) | (at[1:] != at[:-1] + 1))
        begin = np.flatnonzero(new)
        inside = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
        begin = np.flatnonzero(inside % RUN == 0)
        first, last, gram = at[begin], at[np.append(begin[1:], len(at)) - 1], which[begin]
        work = np.cumsum(self.count[gram] * (1 + (last - first) // (int(self.k.min()) + 1)))
        cuts = np.unique(np.append(np.searchsorted(work, np.arange(PAIRS, int(work[-1]), PAIRS)), [0, len(work)]))
        cells, n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            more, weight = self._cells(first[lo:hi], last[lo:hi], gram[lo:hi])
            if len(cuts) == 2:
                # A coarse count first leaves few to sort.
                slot = lambda x: (x * np.int64(0x9E3779B1)) & ((1 << 22) - 1)
                total = np.bincount(slot(more), weights=weight, minlength=1 << 22)
                here, bound = total[slot(more)], self.bound[more >> CELL_BITS]
                keep = (here + total[slot(more + 1)] >= bound) | (here + total[slot(more - 1)] >= bound)
                more, weight = more[keep], weight[keep]
            cells, where = np.unique(np.concatenate([cells, more]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([n, weight]), minlength=len(cells)).astype(np.int64)
        if not len(cells):
            return
        # A band is a step and the next one; it begins where its least diagonal lies.
        after = np.minimum(np.searchsorted(cells, cells + 1), len(cells) - 1)
        item = cells >> CELL_BITS
        good = n + np.where(cells[after] == cells + 1, n[after], 0) >= self.bound[item]
        band = (cells & ((1 << CELL_BITS) - 1)) - HALF
        for i in np.unique(item[good]):
            yield int(i), band[good & (item == i)]

    def _hit(self, ends, codes, item: int, start: int, end: int, edits: int, hits: list) -> None:
        doc = int(np.searchsorted(ends, end - 1, "right"))
        base = int(ends[doc]) - len(codes[doc]) - 1
        hits[doc].append((self.ids[item], max(0, start - base), end - base, edits))

    def _verify(self, flat, ends, codes, item: int, lows: np.ndarray, width: int, hits: list) -> None:
        text, k, n = self.texts[item], int(self.k[item]), int(self.n[item])
        for low in np.array_split(lows, -(-len(lows) // 64)):
            cost, off = _align(flat, text, low, width)
            good = cost <= k
            if not good.any():
                continue
            end = (low + n + off)[good]
            _, back = _align(flat[::-1], text[::-1], len(flat) - end - k, 2 * k + 1, anchor=k)
            for c, e, b in zip(cost[good].tolist(), end.tolist(), back.tolist()):
                self._hit(ends, codes, item, e - n - (b - k), e, c, hits)


def _within(raw: bytes, item: bytes, low: int, high: int) -> int | None:
    """Where the item stands unchanged in these characters of the text."""
    at = raw.find(item, 4 * low, 4 * high)
    while at >= 0 and at % 4:
        at = raw.find(item, at + 1, 4 * high)
    return at // 4 if at >= 0 else None


def _align(flat: np.ndarray, item: np.ndarray, low: np.ndarray, width: int, anchor: int | None = None):
    """Least edits of the whole item against the text on the diagonals
    ``low`` to ``low + width - 1`` (many bands at once), and the diagonal (from
    ``low``) that the best alignment ends on. The text's ends are free, or
    with ``anchor`` the alignment begins on that diagonal."""
    steps, far = np.arange(width), 1 << 20
    start = np.zeros(width, dtype=np.int64) if anchor is None else np.where(steps < anchor, far, steps - anchor)
    cost = np.tile(start, (len(low), 1))
    at = low[:, None] + steps
    for i, c in enumerate(item):
        j = at + i
        inside = (j >= 0) & (j < len(flat))
        read = flat[np.where(inside, j, 0)]
        gap = ~inside | (read == 0)   # between texts: neither replaced nor skipped
        step = cost + np.where(gap, far, read != c)
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        # Skipping text moves along a row, one edit a character, up to the next gap.
        lift = steps + far * np.cumsum(gap, axis=1)
        cost = np.minimum.accumulate(step - lift, axis=1) + lift
    best = cost.argmin(1)
    return cost[np.arange(len(low)), best], best


def _best(found: list[tuple]) -> list[tuple]:
    """One hit of each item for each stretch: the one with fewest edits."""
    out = []
    for hit in sorted(found, key=lambda h: (h[3], h[1], str(h[0]))):
        if not any(o[0] == hit[0] and o[1] < hit[2] and hit[1] < o[2] for o in out):
            out.append(hit)
    return sorted(out, key=lambda h: (h[1], h[2], str(h[0])))


_INDEX: dict[str, Items] = {}


def _index(name: str, shared) -> Items:
    if name not in _INDEX:
        _INDEX.clear()
        _INDEX[name] = Items(*shared.value)
    return _INDEX[name]


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """The benchmark in blocks of about BLOCK characters."""
    block, size = [], 0
    for r in benchmark.select(col(item).alias("i"), col(text).alias("t")).filter(F.length("t") > 0).toLocalIterator():
        if block and size + len(r.t) > BLOCK:
            yield block
            block, size = [], 0
        block.append((r.i, r.t))
        size += len(r.t)
    yield block


def scan(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
         share: float = EDIT_SHARE) -> DataFrame:
    """The columns of ``df`` and ``contaminated``, ``item_ids`` (sorted) and
    ``hits`` (item, start and end in characters of the text, edits)."""
    sc = df.sparkSession.sparkContext
    kept = [c for c in df.columns if c.lower() not in OUTPUTS]
    hit = T.StructType([T.StructField("item_id", benchmark.schema[item].dataType), *[T.StructField(n, T.IntegerType()) for n in ("start", "end", "edits")]])
    out = df.select(*[col(c) for c in kept], F.array().cast(T.ArrayType(hit)).alias("hits"))
    at, alive = kept.index(text), []
    for block in _blocks(benchmark, item, item_text):
        if len(alive) == HELD:   # more blocks follow: these have done their part once the rows are written
            out = written(out, "hits")
            for b in alive:
                b.unpersist()
            alive = []
        shared, name, schema = sc.broadcast((block, share)), uuid.uuid4().hex, out.schema
        alive.append(shared)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            index = _index(name, shared)
            for part, texts in in_parts(batches, at):
                old = part.column(len(kept)).to_pylist()
                new = [sorted((o or []) + [dict(zip(("item_id", "start", "end", "edits"), h)) for h in f],
                              key=lambda h: (h["start"], h["end"], str(h["item_id"]))) for o, f in zip(old, index.find(texts))]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(kept))], pa.array(new, part.column(len(kept)).type)],
                                                 names=[*kept, "hits"])

        out = out.mapInArrow(run, schema)
    return out.select(*[col(c) for c in kept], (F.size("hits") > 0).alias("contaminated"),
                      F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"]))).alias("item_ids"), "hits")
