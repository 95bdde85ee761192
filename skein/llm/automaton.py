"""A minimal acyclic transducer of a sorted set of words: states with equal
futures are shared, and the outputs along a word's arcs add up to its place
in the order (its ordinal).

It is built from arrays: neighbours' common prefixes give the trie, and its
nodes are merged by height, from the leaves up, where they have the same end
flag and the same arcs to the same states. It is walked for many words at
once, one byte a step.
"""

from __future__ import annotations

import numpy as np

from skein.llm.vec import Table


def _trie(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(parent, label, child) of the arcs, in order of parent and label, and
    the nodes' end flags; node 0 is the root."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    width = int(lengths.max())
    inside = np.arange(width) < lengths[:, None]
    letters = np.zeros(inside.shape, dtype=np.uint8)
    letters[inside] = np.frombuffer(b"".join(words), dtype=np.uint8)
    same = (letters[1:] == letters[:-1]) & inside[1:] & inside[:-1]
    common = np.append(0, np.where(same.all(axis=1), width, same.argmin(axis=1)))
    number = np.arange(len(words))
    parents, labels, ends = [], [], [np.array([lengths[0] == 0])]
    at, nodes = np.zeros(len(words), dtype=np.int64), 1
    for d in range(1, width + 1):
        made = np.flatnonzero((common < d) & (lengths >= d))
        parents.append(at[made])
        labels.append(letters[made, d - 1])
        own = np.full(len(words), -1, dtype=np.int64)
        own[made] = np.arange(nodes, nodes + len(made))
        # Words that share their first d bytes lie behind the one that made the node.
        own = own[np.maximum.accumulate(np.where(common < d, number, 0))]
        end = np.zeros(len(made), dtype=bool)
        end[own[lengths == d] - nodes] = True
        ends.append(end)
        at, nodes = own, nodes + len(made)
    parent = np.concatenate(parents) if parents else np.zeros(0, dtype=np.int64)
    label = np.concatenate(labels) if labels else np.zeros(0, dtype=np.uint8)
    return parent, label.astype(np.int64), np.arange(1, nodes), np.concatenate(ends)


class Transducer:
    """``label``, ``target`` and ``out`` by arc, arcs by state and label;
    ``first`` arc of each state, and the end; ``ends`` by state; ``root``."""

    def __init__(self, words: list[bytes]):
        """``words``: distinct, in byte order."""
        if not words:
            self.first, self.ends, self.root = np.zeros(2, dtype=np.int64), np.zeros(1, dtype=bool), 0
            self.label = self.target = self.out = np.zeros(0, dtype=np.int64)
            return
        parent, label, child, end = _trie(words)
        arity = np.bincount(parent, minlength=len(end))
        start = np.cumsum(arity) - arity
        height = np.zeros(len(end), dtype=np.int64)
        for p, c in zip(parent[::-1].tolist(), child[::-1].tolist()):   # children have larger numbers
            if height[c] >= height[p]:
                height[p] = height[c] + 1
        state, kept, made = np.full(len(end), -1, dtype=np.int64), [], 0
        by_height = np.lexsort((arity, height))
        cut = np.flatnonzero(np.append(True, (np.diff(height[by_height]) != 0) | (np.diff(arity[by_height]) != 0)))
        for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(by_height)]):
            nodes = by_height[lo:hi]
            k = int(arity[nodes[0]])
            # Equal end flag, labels and target states: one row of numbers for each node.
            arcs = start[nodes][:, None] + np.arange(k)
            rows = np.concatenate([end[nodes][:, None].astype(np.int64), label[arcs] | state[child[arcs]] << 8], axis=1)
            if k < 2:
                rows = (rows[:, 0] | rows[:, -1] << 1) if k else rows[:, 0]
            else:
                rows = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.itemsize * (k + 1)))).ravel()
            _, some, which = np.unique(rows, return_index=True, return_inverse=True)
            state[nodes] = made + which.ravel()
            kept.append(nodes[some])
            made += len(some)
        node = np.concatenate(kept)   # a node of each state, by state
        counts = arity[node]
        self.first = np.append(0, np.cumsum(counts))
        arcs = np.repeat(start[node] - self.first[:-1], counts) + np.arange(self.first[-1])
        self.label, self.target = label[arcs], state[child[arcs]]
        self.ends, self.root = end[node], int(state[0])
        below = np.zeros(made, dtype=np.int64)   # words from each state on; states come after their targets
        for s, (lo, hi) in enumerate(zip(self.first[:-1].tolist(), self.first[1:].tolist())):
            below[s] = self.ends[s] + below[self.target[lo:hi]].sum()
        run = np.append(0, np.cumsum(below[self.target]))
        self.out = run[:-1] - np.repeat(run[self.first[:-1]], counts) + np.repeat(self.ends, counts)

    @property
    def arcs(self) -> Table:
        if not hasattr(self, "_arcs"):
            keys = (np.repeat(np.arange(len(self.ends)), np.diff(self.first)) << 8 | self.label).astype(np.uint64)
            self._arcs = Table(keys, np.arange(len(keys), dtype=np.int32))
        return self._arcs

    def __getstate__(self):
        return {k: v for k, v in vars(self).items() if k != "_arcs"}

    def prefix(self, word: bytes) -> tuple[int, int] | None:
        """The state behind ``word`` and the ordinal of its first word."""
        state, total = self.root, 0
        for b in word:
            lo, hi = int(self.first[state]), int(self.first[state + 1])
            at = lo + int(np.searchsorted(self.label[lo:hi], b))
            if at == hi or self.label[at] != b:
                return None
            state, total = int(self.target[at]), total + int(self.out[at])
        return state, total

    def find(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray | None = None,
             totals: np.ndarray | None = None) -> np.ndarray:
        """The ordinal of each word ``buf[start:end]``, -1 of one that is not
        held, walked from the given states (else the root)."""
        n = len(starts)
        found = np.full(n, -1, dtype=np.int64)
        state = np.full(n, self.root, dtype=np.int64) if states is None else states.astype(np.int64)
        total = np.zeros(n, dtype=np.int64) if totals is None else totals.astype(np.int64)
        live, at, end = np.arange(n), starts.astype(np.int64), ends
        while len(live):
            done = at == end
            if done.any():
                held = done.copy()
                held[done] = self.ends[state[done]]
                found[live[held]] = total[held]
                more = ~done
                live, at, end, state, total = live[more], at[more], end[more], state[more], total[more]
                if not len(live):
                    break
            arc, held = self.arcs.get((state << 8 | buf[at]).astype(np.uint64))
            if not held.all():
                live, at, end, total, arc = live[held], at[held], end[held], total[held], arc[held]
            state, total, at = self.target[arc], total + self.out[arc], at + 1
        return found

    def words(self) -> list[bytes]:
        """All words, in order."""
        out, stack = [], [(self.root, b"")]
        while stack:
            state, word = stack.pop()
            if self.ends[state]:
                out.append(word)
            for arc in range(int(self.first[state + 1]) - 1, int(self.first[state]) - 1, -1):
                stack.append((int(self.target[arc]), word + bytes([self.label[arc]])))
        return out
