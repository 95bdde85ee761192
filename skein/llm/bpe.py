"""Byte-level BPE encoding and decoding with a transducer lexicon.

The words of a text are the pieces that the tokenizer's split pattern makes.
Spark counts the words of the whole corpus; the most frequent
ones (``lexicon_size`` at most, a documented size) are encoded once and compiled
into a minimal acyclic transducer: states with equal futures are shared, and
the outputs along a word's arcs add up to its place in the table of ids. The
automaton is one block of bytes that the workers map into memory. Words that
it does not hold are merged exactly, pair by pair, by the tokenizer's ranks,
so the lexicon only decides speed, never results.

The vocabulary comes from a tokenizer file (a parameter) that only the driver
reads; its tables and the lexicon are of bounded size and are broadcast.

Defined results: null and empty texts have no ids and decode to the empty
text; texts are taken whole; every row is encoded by itself, so repeated rows
and null keys need no care. Input columns named like an output give way.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.frames import col, written
from skein.llm.vec import in_parts

LEXICON_SIZE = 262_144
CACHE_ENTRIES = 160_000   # memoised words in a worker; only speed depends on it
PART = 1 << 20             # bytes of text that a worker encodes at once
COUNT_ENTRIES = 300_000   # distinct words that a counting task holds before it hands them on
LONG_WORD = 48            # bytes from which merging uses a heap, and the lexicon is not asked

# --- FIXED VALUES: the split pattern of the tokenizer files -----------------------
LETTERS, DIGITS = r"\p{L}", r"\p{N}"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{l}{n}]+|\s+(?!\S)|\s+"
# --- FIXED VALUES: code points that became letters or numbers after Unicode 16, which
# the tokenizers library counts as neither ------------------------------------------
LATE = (
    "՘ ֋-֌ ࢏ ౜ ೜ ₏ ₝-₟ ꟎-꟏ ꟒ ꟔ ꟝ ꟢ ꟱ "
    "꭬-꭭ \U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee "
    "\U00011b0a \U00011db0-\U00011ddb \U00011de0-\U00011de9 \U00011df1 \U0001246f \U00012475-\U0001247f "
    "\U00012550-\U00012686 \U00016ea0-\U00016eb8 \U00016ebb-\U00016ed3 \U00016ff2-\U00016ff3 \U00016ff4-\U00016ff6 "
    "\U000187f8-\U000187ff \U00018cd6-\U00018cda \U00018d09-\U00018d20 \U00018d80-\U00018df2 \U00018e00-\U00019191 "
    "\U000191a0-\U000191d2 \U0001b123-\U0001b128 \U0001b168 \U0001d6a6 \U0001df1f-\U0001df24 \U0001df2b-\U0001df81 "
    "\U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de \U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 "
    "\U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff \U0002b73a-\U0002b73f \U0002b81e "
    "\U0002cea2-\U0002cead \U000323b0-\U00033479 \U0003d000-\U0003fc3f"
).replace(" ", "")


def _pattern(letters: str, digits: str) -> str:
    return (SPLIT.replace("{L}", f"[{letters}]").replace("{N}", f"[{digits}]")
            .replace("{l}", letters).replace("{n}", digits))


def _near(first: str) -> str:
    """The characters below NEAR whose category begins with ``first``, as a class."""
    return "".join(re.escape(c) for c in map(chr, range(NEAR)) if unicodedata.category(c)[0] == first)


NEAR = 0x558   # below this, one bitmap of letters and numbers holds for every Unicode version in use
_FAR = re.compile(f"[{chr(NEAR)}-{chr(0x10FFFF)}\x1c-\x1f]")   # re's white space also has 1C to 1F
_ASCII = re.compile(_pattern("A-Za-z", "0-9"), re.ASCII)
_LATIN = re.compile(_pattern(_near("L"), _near("N")))
_ANY = regex.compile(_pattern(LETTERS, DIGITS))
_LATE = re.compile(f"[{LATE}]")
_OLD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}--[X]]+| ?[\p{N}--[X]]+| ?(?:[^\s\p{L}\p{N}]|[X])+|\s+(?!\S)|\s+"
                     .replace("X", LATE), regex.V1)


def words_of(text: str) -> list[str]:
    """The pieces between which no merge reaches."""
    if text.isascii():
        return _ASCII.findall(text)
    if not _FAR.search(text):
        return _LATIN.findall(text)
    return (_OLD if _LATE.search(text) else _ANY).findall(text)


# ------------------------------------------------------------------ tokenizer file
def byte_signs() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself where it is printable in Latin-1, else the next free
    code point from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_tokenizer(path: str) -> dict:
    """Vocabulary, merge ranks and special strings of a byte-level BPE file of
    the tokenizers library; settings that would change results are refused."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
                       "ignore_merges") if model.get(k)]
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or \
            not pre.get("use_regex", True) or spec.get("normalizer") or odd or \
            any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"]):
        raise ValueError("only plain byte-level BPE files are supported")
    signs = byte_signs()
    vocab = {bytes(signs[c] for c in t): i for t, i in model["vocab"].items() if all(c in signs for c in t)}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    raw = [tuple(bytes(signs[c] for c in side) for side in m) for m in pairs]
    special = {a["content"]: a["id"] for a in spec["added_tokens"]}
    return {"bytes": [vocab[bytes([b])] for b in range(256)],
            "merges": np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in raw], dtype=np.int32).tobytes(),
            "tokens": {i: t for t, i in vocab.items()} | {i: t.encode() for t, i in special.items()},
            "special": special}


class Merger:
    """Exact merging by rank, lowest first, then leftmost."""

    def __init__(self, spec: dict):
        rows = np.frombuffer(spec["merges"], dtype=np.int32).reshape(-1, 3).tolist()
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(rows)}
        self.made = [c for _, _, c in rows]
        self.single = spec["bytes"]

    def ids(self, word: bytes) -> list[int]:
        ids = [self.single[b] for b in word]
        if len(ids) >= LONG_WORD:
            return self._by_heap(ids)
        rank, none = self.rank.get, len(self.made)
        found = [rank(p, none) for p in zip(ids, ids[1:])]
        while found and (best := min(found)) < none:
            at = found.index(best)
            ids[at:at + 2] = [self.made[best]]
            del found[at]
            if at < len(found):
                found[at] = rank((ids[at], ids[at + 1]), none)
            if at:
                found[at - 1] = rank((ids[at - 1], ids[at]), none)
        return ids

    def _by_heap(self, ids: list) -> list[int]:
        n, rank = len(ids), self.rank
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(rank[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.made[r], None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (p := (ids[k], ids[after[k]])) in rank:
                    heapq.heappush(heap, (rank[p], k, *p))
        return [i for i in ids if i is not None]


# ------------------------------------------------------------------ lexicon
def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """A minimal acyclic transducer of the words, as one block of bytes:
    six lengths, then arc labels, end flags, first arc of each state, arc
    targets, arc outputs, id offsets and ids."""
    entries = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    counts: list[int] = []

    def frozen(node) -> int:
        """The shared state with this node's future."""
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
            counts.append(key[0] + sum(counts[t] for _, t in key[1]))
        return register[key]

    path = [[False, []]]   # the nodes of the last word, not yet shared: end flag, arcs
    labels: list[int] = []
    for word, _ in entries:
        same = 0
        while same < min(len(word), len(labels)) and word[same] == labels[same]:
            same += 1
        while len(path) > same + 1:
            node = path.pop()
            path[-1][1].append((labels.pop(), frozen(node)))
        for b in word[same:]:
            labels.append(b)
            path.append([False, []])
        path[-1][0] = True
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((labels.pop(), frozen(node)))
    root = frozen(path[0])
    # The root comes first; arcs lie state by state.
    order = [root, *[s for s in range(len(states)) if s != root]]
    place = {s: i for i, s in enumerate(order)}
    first, arc_label, target, out = [0], bytearray(), [], []
    for s in order:
        seen = int(states[s][0])
        for label, t in states[s][1]:
            arc_label.append(label)
            target.append(place[t])
            out.append(seen)
            seen += counts[t]
        first.append(len(target))
    ends = bytes(int(states[s][0]) for s in order)
    offsets = np.cumsum([0, *[len(ids) for _, ids in entries]])
    ids = [i for _, own in entries for i in own]
    ints = [np.array(x, dtype="<i4").tobytes() for x in (first, target, out, offsets, ids)]
    pad = -(len(arc_label) + len(ends)) % 4
    head = np.array([len(arc_label), len(ends), len(offsets), len(ids), pad, 0], dtype="<i4").tobytes()
    return head + bytes(arc_label) + ends + bytes(pad) + b"".join(ints)


class Lexicon:
    """Look-up of many words at once in a memory-mapped lexicon."""

    def __init__(self, block: bytes):
        if hasattr(os, "memfd_create"):   # a file in memory, gone with the process
            with os.fdopen(os.memfd_create("lexicon"), "r+b") as f:
                f.write(block)
                f.flush()
                self.map = mmap.mmap(f.fileno(), len(block), access=mmap.ACCESS_READ)
        else:
            self.map = mmap.mmap(-1, len(block))
            self.map.write(block)
        arcs, states, words, ids, pad, _ = np.frombuffer(block[:24], dtype="<i4").tolist()
        part = lambda at, n, kind="<i4": np.frombuffer(self.map, dtype=kind, count=n, offset=at)
        labels, self.ends = part(24, arcs, "u1"), part(24 + arcs, states, "?")
        at, parts = 24 + arcs + states + pad, []
        for n in (states + 1, arcs, arcs, words, ids):
            parts.append(part(at, n))
            at += 4 * n
        first, self.target, self.out, self.offsets, self.ids = parts
        # Arcs lie by state, then label: their keys rise.
        self.keys = np.repeat(np.arange(states, dtype=np.int64) << 8, np.diff(first)) | labels

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the table of ids, -1 for one not held."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts, raw = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(words) + b"\0", dtype=np.uint8)
        state, total = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        live = np.arange(len(words)) if len(self.keys) else np.zeros(0, dtype=np.int64)
        total[:] = -1 if not len(live) else 0
        step = 0
        while len(live):
            more = lengths[live] > step
            done = live[~more]
            total[done] = np.where(self.ends[state[done]], total[done], -1)
            live = live[more]
            key = (state[live] << 8) | raw[starts[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            held = self.keys[arc] == key
            total[live[~held]] = -1
            live, arc = live[held], arc[held]
            total[live] += self.out[arc]
            state[live] = self.target[arc]
            step += 1
        if not len(self.keys) and len(self.ends) and self.ends[0]:
            total[lengths == 0] = 0
        return total

    def get(self, word: bytes) -> list[int] | None:
        at = int(self.find([word])[0])
        return None if at < 0 else self.ids[self.offsets[at]:self.offsets[at + 1]].tolist()


class Coder:
    """Encodes and decodes in a worker; memoises words between batches, as ids
    in decimal and as the bytes that they decode to."""

    def __init__(self, spec: dict, block: bytes):
        self.tokens, self.special = spec["tokens"], spec["special"]
        self.merger, self.lexicon = Merger(spec), Lexicon(block)
        self.ids: dict[str, str] = {}
        self.raw: dict[str, bytes] = {}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.decimal = {i: str(i) for i in self.tokens}
        for content, i in self.special.items():
            self.ids[content], self.raw[content] = self._entry([i])

    def _entry(self, ids: list[int]) -> tuple[str, bytes]:
        return ",".join([self.decimal[i] for i in ids]), b"".join([self.tokens[i] for i in ids])

    def _learn(self, new: list[str]) -> None:
        """Memoise words: by the lexicon, and the rest merged."""
        raw = [w.encode("utf-8") for w in new]
        short = [i for i, w in enumerate(raw) if len(w) < LONG_WORD]
        place = np.full(len(raw), -1)
        place[short] = self.lexicon.find([raw[i] for i in short])
        offsets, held = self.lexicon.offsets, self.lexicon.ids
        lo, hi = offsets[place].tolist(), offsets[np.minimum(place + 1, len(offsets) - 1)].tolist()
        for w, r, known, a, b in zip(new, raw, (place >= 0).tolist(), lo, hi):
            self.ids[w], self.raw[w] = self._entry(held[a:b].tolist() if known else self.merger.ids(r))

    def _parts(self, text: str) -> list[str]:
        if self.cut and self.cut.search(text):
            return [w for part in self.cut.split(text) if part for w in ([part] if part in self.special else words_of(part))]
        return words_of(text)

    def encode(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Of each text its ids, in decimal joined by commas, and their decoded text."""
        if len(self.ids) > CACHE_ENTRIES:   # the first ones learned are the frequent ones
            self.ids, self.raw = (dict(islice(d.items(), CACHE_ENTRIES // 2)) for d in (self.ids, self.raw))
        parts = [self._parts(t) for t in texts]
        self._learn(list(set().union(*parts).difference(self.ids)))
        for p in parts:
            yield ",".join(map(self.ids.__getitem__, p)), b"".join(map(self.raw.__getitem__, p)).decode("utf-8", "replace")


_CODERS: dict[str, Coder] = {}


def _coder(name: str, shared) -> Coder:
    """One coder in a worker process, kept for the later tasks of its job."""
    if name not in _CODERS:
        _CODERS.clear()
        _CODERS[name] = Coder(*shared.value)
    return _CODERS[name]


# ------------------------------------------------------------------ Spark
def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word binary, count long) over every whole text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _CODERS.clear()   # of an earlier job in this worker
        held: Counter = Counter()

        def handed_on():
            out = pa.RecordBatch.from_arrays([pa.array([w.encode("utf-8") for w in held], pa.binary()),
                                              pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for t in batch.column(0):
                held.update(words_of(t.as_py() or ""))
                if len(held) >= COUNT_ENTRIES:
                    yield handed_on()
        if held:
            yield handed_on()

    return (df.select(col(text)).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("count")))


def build_lexicon(df: DataFrame, spec: dict, text: str = "text", size: int = LEXICON_SIZE) -> bytes:
    """The lexicon of the most frequent words of ``df``, ``size`` at most: all
    those from the least step of a sixteenth power of two on that fits."""
    # Words that the lexicon is never asked for are left out, so what is collected is bounded in bytes too.
    counts = written(word_counts(df, text).filter(F.octet_length("word") < LONG_WORD), "word-counts")
    step = F.floor(F.log2("count") * 16).cast("int")   # at most 1,024 steps
    steps = counts.groupBy(step.alias("step")).count().collect()
    least, held = None, 0
    for r in sorted(steps, key=lambda r: -r.step):
        held += r["count"]
        if held > size:
            break
        least = r.step
    top = counts.filter(step >= least).select("word").collect() if least is not None else []
    merger = Merger(spec)
    return compile_lexicon([(w, merger.ids(w)) for w in (bytes(r.word) for r in top)])


FIELDS = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "ids_sha256": T.StringType(),
          "decoded": T.StringType(), "decoded_sha256": T.StringType()}


def encode(df: DataFrame, tokenizer: str, text: str = "text", lexicon_size: int = LEXICON_SIZE,
           outputs: tuple[str, ...] = ("n_tokens", "ids")) -> DataFrame:
    """The columns of ``df`` and, of each text, any of ``n_tokens``, ``ids``,
    ``ids_sha256`` (hash of the decimal ids joined by commas), ``decoded`` and
    ``decoded_sha256``. ``tokenizer`` is the path of a byte-level BPE file."""
    spec, name = read_tokenizer(tokenizer), uuid.uuid4().hex
    shared = df.sparkSession.sparkContext.broadcast((spec, build_lexicon(df, spec, text, lexicon_size)))
    taken = {o.lower() for o in outputs}
    kept = [c for c in df.columns if c.lower() not in taken]
    at = df.columns.index(text)
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(o, FIELDS[o]) for o in outputs])
    keep_at = [df.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(name, shared)
        for batch, texts in in_parts(batches, at, PART):
            made = {o: [] for o in outputs}
            lengths = []
            for ids, decoded in coder.encode(texts):
                lengths.append(ids.count(",") + 1 if ids else 0)
                if "ids" in made:
                    made["ids"].append(ids)
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                if "decoded" in made:
                    made["decoded"].append(decoded)
                if "decoded_sha256" in made:
                    made["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            if "n_tokens" in made:
                made["n_tokens"] = pa.array(lengths, pa.int64())
            if "ids" in made:
                values = np.fromstring(",".join([x for x in made["ids"] if x]), dtype=np.int32, sep=",")
                offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
                made["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
            cols = [batch.column(i) for i in keep_at]
            cols += [made[o] if isinstance(made[o], pa.Array) else pa.array(made[o], pa.string()) for o in outputs]
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, *outputs])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """The columns of ``df`` and the text that each list of ids stands for
    (null for a null list); bytes that are not UTF-8 become U+FFFD."""
    tokens = read_tokenizer(tokenizer)["tokens"]
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    kept = [c for c in df.columns if c.lower() != output.lower()]
    at, keep_at = df.columns.index(ids), [df.columns.index(c) for c in kept]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(output, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            texts = [None if x is None else b"".join(map(table.__getitem__, x)).decode("utf-8", "replace")
                     for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep_at], pa.array(texts, pa.string())],
                                             names=[*kept, output])

    return df.mapInArrow(run, schema)
