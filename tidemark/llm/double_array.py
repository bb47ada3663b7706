"""Double-array tries of byte strings, built and walked with numpy.

A node is a slot. Its child for byte ``c`` is slot ``base[node] + c`` if
``check`` of that slot names the node. Slot 0 is the root. Nodes with several
children are placed in rounds: all of one size propose a place at once, those
that meet no taken slot and no one else's proposal stay. Single children fill
the slots left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROOT = 0


@dataclass
class Trie:
    base: np.ndarray
    check: np.ndarray
    #: Slot at which each key ends.
    ends: np.ndarray

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and which of them exist."""
        to = self.base[states] + symbols
        return to, self.check[to] == states

    def find(self, key: bytes) -> int:
        """State after ``key`` from the root, -1 if there is none."""
        at = ROOT
        for c in key:
            to = int(self.base[at]) + c
            if self.check[to] != at:
                return -1
            at = to
        return at


def _edges(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(parents, bytes, last)``: edges in order of their parents, the child of
    edge ``i`` being node ``i + 1``; ``last``: the node of each key."""
    begin, size = bounds[:-1], np.diff(bounds)
    node = np.zeros(len(size), np.int32)
    parents, symbols, total, level = [], [], 0, 0
    alive = np.flatnonzero(size > 0)
    while len(alive):
        mine, c = node[alive], data[begin[alive] + level]
        new = np.ones(len(alive), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (c[1:] != c[:-1])
        node[alive] = total + np.cumsum(new)
        parents.append(mine[new])
        symbols.append(c[new])
        total += int(new.sum())
        level += 1
        alive = alive[size[alive] > level]
    if not parents:
        return np.zeros(0, np.int32), np.zeros(0, np.uint8), node
    return np.concatenate(parents), np.concatenate(symbols), node


def build_list(keys: list[bytes]) -> Trie:
    """The trie of sorted, distinct, non-empty keys."""
    return build(np.frombuffer(b"".join(keys), np.uint8), np.cumsum([0, *map(len, keys)]))


def build(data: np.ndarray, bounds: np.ndarray) -> Trie:
    """The trie of keys that stand in ``data`` end to end, cut at ``bounds``."""
    parents, symbols, last = _edges(data, bounds)
    nodes = len(parents) + 1
    first = np.searchsorted(parents, np.arange(nodes), "left")
    count = np.searchsorted(parents, np.arange(nodes), "right") - first
    rng = np.random.default_rng(0)
    used = np.zeros(max(1024, int(1.5 * nodes) + 512), bool)
    used[:256] = True
    base = np.zeros(nodes, np.int32)
    for k in sorted(set(count[count > 1].tolist()), reverse=True):
        left = np.flatnonzero(count == k)
        while len(left):
            some = left[: max(1, (1 << 21) // k)]
            kids = symbols[first[some][:, None] + np.arange(k)].astype(np.int64)
            at = rng.integers(256, len(used) - 256, len(some))
            slots = at[:, None] + kids
            owner = np.full(len(used), -1, np.int32)
            good = ~used[slots].any(1)
            rows = np.flatnonzero(good)
            owner[slots[rows]] = rows[:, None]
            good[rows] = (owner[slots[rows]] == rows[:, None]).all(1)
            used[slots[good].ravel()] = True
            base[some[good]] = at[good]
            if good.sum() * 20 < len(some):
                used = np.concatenate([used, np.zeros(len(used) // 4, bool)])
            left = np.concatenate([some[~good], left[len(some):]])
    only = np.flatnonzero(count == 1)
    free = np.flatnonzero(~used[: len(used) - 256])
    if len(free) < len(only):
        used = np.concatenate([used, np.zeros(len(only) - len(free), bool)])
        free = np.flatnonzero(~used[: len(used) - 256])
    base[only] = free[: len(only)] - symbols[first[only]]
    slot = np.zeros(nodes, np.int32)
    slot[1:] = base[parents] + symbols
    bases, check = np.zeros(len(used) + 256, np.int32), np.full(len(used) + 256, -1, np.int32)
    bases[slot] = base
    check[slot[1:]] = slot[parents]
    return Trie(bases, check, slot[last])
