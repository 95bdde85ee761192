"""Periodic runs of words in a text, by seed and extension along diagonals.

A run is a stretch of words with smallest period q (words q apart are
identical), of at least ``least`` words and ``times`` periods, that no
neighbouring word extends. Along the diagonal of lag q a run of length l is a
stretch of l - q matching places.

The lags are taken in scales. For the lags of a scale, the least such stretch
is the overlap that a run guarantees: k places. So the k-grams of words are
indexed (by two rolling hashes, within each text), and every run of the scale
holds a k-gram that occurs again one lag further on. A scale ends where k
falls under twice its largest lag; up to there two occurrences in the same run
are one smallest period apart with none between, so pairs of neighbouring
occurrences are enough, and their number is that of the places. Only places
whose k-gram occurs again go on to the next scale, where k is larger. A pair
is a seed: it is compared word by word and extended both ways, unless the
table of the furthest place covered on each lag holds it already.

One text's words are in one task's memory: about 60 bytes of arrays and
objects a word, and texts in slices of ``PART`` bytes. Texts are never cut.
Words are numbered exactly; a hash only proposes seeds.

Defined results: null and empty texts have no words, no runs and collapse to
the empty text; every row is worked on by itself, so null keys and repeated
rows need no care; an empty table gives an empty one. Input columns named
like an output give way.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skein.llm.frames import col
from skein.llm.vec import in_parts, mixed, powers

PART = 1 << 20
LEAST, TIMES = 6, 4
PRIME, BASE = np.uint64((1 << 31) - 1), 1_000_003
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("best", RUN),
          T.StructField("collapsed", T.StringType())]
OUTPUTS = [f.name for f in FIELDS]


def scales(longest: int, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int, int]]:
    """(first lag, last lag, k) of each scale for texts of ``longest`` words."""
    overlap = lambda q: max(least, times * q) - q
    first = 1
    while max(least, times * first) <= longest:
        last = max(first, (times - 1) * first // 2)
        k = min(overlap(first), overlap(last))
        while last > first and k < 2 * last:
            last -= 1
            k = min(overlap(first), overlap(last))
        yield first, last, k
        first = last + 1


def _powers_mod(n: int) -> np.ndarray:
    out, step = np.ones(1, dtype=np.uint64), BASE
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(step) % PRIME])
        step = step * step % int(PRIME)
    return out[:n]


class Grams:
    """Hashes of k-grams of numbers, for any k."""

    def __init__(self, ids: np.ndarray):
        n, value = len(ids), mixed(ids.astype(np.uint64) + np.uint64(1))
        self.wide = powers(n + 1)[:n + 1][::-1]
        self.wide_sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * powers(n + 1)[:n])])
        small = _powers_mod(n + 1)
        self.small = small[::-1]
        self.small_sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum((value >> np.uint64(33)) % PRIME * small[:n] % PRIME)])

    def keys(self, at: np.ndarray, k: int) -> np.ndarray:
        a = (self.wide_sum[at + k] - self.wide_sum[at]) * self.wide[at]
        b = (self.small_sum[at + k] - self.small_sum[at]) % PRIME * self.small[at] % PRIME
        return a ^ mixed(b + np.uint64(1))


def _reach(ids: np.ndarray, at: int, lag: int, lo: int, hi: int) -> tuple[int, int]:
    """The matching places around ``at`` on the diagonal of ``lag``, within a
    text's words [lo, hi): first, and one behind the last."""
    right, step = at, 32
    while right + lag < hi:
        end = min(right + step, hi - lag)
        off = ids[right:end] != ids[right + lag:end + lag]
        stop = int(off.argmax())
        if off[stop]:
            right += stop
            break
        right, step = end, 2 * step
    left, step = at, 32
    while left > lo:
        start = max(left - step, lo)
        off = (ids[start:left] != ids[start + lag:left + lag])[::-1]
        stop = int(off.argmax())
        if off[stop]:
            left -= stop
            break
        left, step = start, 2 * step
    return left, right


def find(ids: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start, then period.
    ``ids``: numbers that stand for the words of all texts; ``first``: each
    text's first word, and the end. ``times`` is 4 at least: below, a scale
    would hold one lag only."""
    if times < 4:
        raise ValueError("runs of fewer than four periods are not searched for")
    lengths = np.diff(first)
    out: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    if not len(ids):
        return out
    of = np.repeat(np.arange(len(lengths)), lengths)
    behind, salt = first[1:][of], mixed(np.arange(1, len(lengths) + 1).astype(np.uint64) << np.uint64(20))
    grams, active, covered = Grams(ids), np.arange(len(ids)), {}
    for low, high, k in scales(int(lengths.max()), least, times):
        active = active[active + k <= behind[active]]
        if len(active) < 2:
            break
        keys = grams.keys(active, k) ^ salt[of[active]]
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], active[order]
        again = (keys[1:] == keys[:-1]) & (of[places[1:]] == of[places[:-1]])
        lag = places[1:] - places[:-1]
        seed = again & (lag >= low) & (lag <= high)
        at, lags = places[:-1][seed], lag[seed]
        active = np.sort(places[np.append(again, False) | np.append(False, again)])
        order = np.lexsort((at, lags))
        at, lags = at[order], lags[order]
        # The next place on the same lag is on the same stretch.
        new = np.append(True, (lags[1:] != lags[:-1]) | (at[1:] != at[:-1] + 1))[:len(at)]
        for i, q in zip(at[new].tolist(), lags[new].tolist()):
            if i < covered.get(q, 0):
                continue
            d = int(of[i])
            left, right = _reach(ids, i, q, int(first[d]), int(first[d + 1]))
            covered[q] = right
            if right - left + q >= max(least, times * q):
                out[d].append((left - int(first[d]), right - left + q, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def best_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period; the earliest, then shortest period, of equals."""
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    return best


def _lists(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
    flat = np.array([r for runs in rows for r in runs], dtype=np.int64).reshape(-1, 3)
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=RUN.names)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def find_runs(df: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``df`` (all, if not given), and of each text
    ``n_words``, ``runs`` (start, length, period; by start, then period),
    ``best`` (greatest length / period) and ``collapsed``: the words that no
    run holds behind its first period, joined by one space."""
    taken = set(OUTPUTS)
    carry = [c for c in (df.columns if carry is None else carry) if c.lower() not in taken]
    rows = df.select(*map(col, carry), col(text))
    schema = T.StructType([df.schema[c] for c in carry] + FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_parts(batches, len(carry), PART):
            words, ids = [], []
            for t in texts:
                own = t.encode("utf-8").split()   # of bytes: at 20 and 09 to 0D
                number: dict[bytes, int] = {}
                words.append(own)
                ids.append(np.fromiter([number.setdefault(w, len(number)) for w in own], dtype=np.int64, count=len(own)))
            counts = [len(w) for w in words]
            found = find(np.concatenate(ids), np.cumsum([0, *counts]), least, times)
            collapsed = []
            for own, runs in zip(words, found):
                if runs:
                    drop = np.zeros(len(own) + 1, dtype=np.int32)
                    for s, n, q in runs:
                        drop[s + q] += 1
                        drop[s + n] -= 1
                    own = compress(own, (np.cumsum(drop[:-1]) == 0).tolist())
                collapsed.append(b" ".join(own).decode("utf-8"))
            best = [b and dict(zip(RUN.names, b)) for b in map(best_of, found)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(counts, pa.int64()), _lists(found),
                 pa.array(best, pa.struct([(n, pa.int64()) for n in RUN.names])), pa.array(collapsed, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
