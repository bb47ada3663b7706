"""Adaptive context-mixing range coder for blocks of token ids.

A block is coded on its own: its models start empty, and it carries checksums
of its bytes and of the ids it must give back. Its ids run in parallel lanes
(consecutive stretches of the block), which share the models: in each step
every lane codes one id with the models as they are, then all ids of the step
update them; frequencies and shares take up what the last steps (four, after
the first eight) gathered. Each step is a few numpy operations over all lanes.

Three predictors are mixed for each id: order 0, the adaptive frequencies of
all ids so far; order 1, the id last seen after the previous id; order 2, the
id last seen after the previous two. The last two carry a confidence. The share
of each predictor is learned separately for every combination of confidences,
from how much of the probability of past ids each contributed. Coding is exact
integer arithmetic; floats hold whole numbers only.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TMB2"
HEAD = struct.Struct("<4sIIIIIII")
#: Probabilities are shares of 2^TOTAL; predictors' shares of 2^SHARES; every
#: id keeps at least GAP of order 0.
TOTAL, SHARES, GAP = 28, 12, 64
UNIT = TOTAL - SHARES
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
WORD = np.uint64(16)
STEPS, LANES = 256, 4096
TABLE = 20
GAIN = 32
#: Cells of the probabilities, from which an id is looked for.
CELL = 12
#: Confidence after a miss and after a hit, by the confidence before.
NEXT = np.array([0, 0, 1, 2, 1, 2, 3, 3], np.int32)


class _Models:
    """What both directions know before each step."""

    def __init__(self, ids: int, lanes: int):
        self.n, self.lanes, self.step = ids, lanes, 0
        self.count = np.ones(ids, np.int64)
        # last id and confidence (two bits) of each context
        self.one, self.two = np.zeros(ids, np.int32), np.zeros(1 << TABLE, np.int32)
        self.mixed = np.tile(np.array([64.0, 32.0, 32.0]) * 64, (32, 1))
        self.prev, self.prev2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.reach = (1 << TOTAL) - GAP * ids
        self.ramp = np.arange(ids + 1, dtype=np.int64) * GAP
        self.fresh: list[np.ndarray] = []

    def refresh(self) -> None:
        """Frequencies and shares, from all ids so far."""
        if self.fresh:
            self.count += GAIN * np.bincount(np.concatenate(self.fresh), minlength=self.n)
            self.fresh.clear()
        total = np.zeros(self.n + 1, np.int64)
        np.cumsum(self.count, out=total[1:])
        q = (total * (self.reach / total[-1])).astype(np.int64)
        q[-1] = self.reach
        self.q = np.minimum(q, self.reach) + self.ramp
        self.cell = None
        every = self.mixed.sum(axis=1)
        room = (1 << SHARES) - 296
        w1 = 1 + (self.mixed[:, 1] * room // every).astype(np.int64)
        w2 = 1 + (self.mixed[:, 2] * room // every).astype(np.int64)
        self.share0, self.share1, self.share2 = (1 << SHARES) - w1 - w2, w1 << UNIT, w2 << UNIT

    def predict(self) -> None:
        if self.step < 8 or self.step % 4 == 0:
            self.refresh()
        self.step += 1
        self.slot = ((self.prev2 * 0x9E3779B1 + self.prev * 0x85EBCA6B) & 0xFFFFFFFF) * 0xC2B2AE35 >> 12 & ((1 << TABLE) - 1)
        self.t1, self.t2 = self.one.take(self.prev), self.two.take(self.slot)
        p1, p2 = self.t1 >> 2, self.t2 >> 2
        self.same = p1 == p2
        self.case = ((self.t1 & 3) * 8 + (self.t2 & 3) * 2 + self.same).astype(np.int64)
        self.p1, self.p2 = p1.astype(np.int64), p2.astype(np.int64)
        self.w0, self.u1, self.u2 = self.share0.take(self.case), self.share1.take(self.case), self.share2.take(self.case)

    def interval(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of each lane's id; keeps the predictors' parts."""
        a = self.q.take(s) * self.w0 >> SHARES
        b = self.q.take(s + 1) * self.w0 >> SHARES
        self.hit1, self.hit2 = self.p1 == s, self.p2 == s
        self.m1, self.m2 = self.u1 * self.hit1, self.u2 * self.hit2
        return a + self.u1 * (self.p1 < s) + self.u2 * (self.p2 < s), b - a + self.m1 + self.m2

    def find(self, v: np.ndarray) -> np.ndarray:
        """The id whose interval holds ``v`` in each lane."""
        at = lambda x: self.q.take(x) * self.w0 >> SHARES
        p1, p2, u1, u2 = self.p1, self.p2, self.u1, self.u2
        # where the predictors' ids start and end; both are one where they agree
        start1, start2 = at(p1) + u2 * (p2 < p1), at(p2) + u1 * (p1 < p2)
        end1, end2 = at(p1 + 1) + u1 + u2 * (p2 <= p1), at(p2 + 1) + u2 + u1 * (p1 <= p2)
        past1, past2 = v >= end1, v >= end2
        is1, is2 = (v >= start1) & ~past1, (v >= start2) & ~past2
        out = np.where(is1, p1, p2)
        other = np.flatnonzero(~(is1 | is2))
        rest = v.take(other) - u1.take(other) * past1.take(other) - u2.take(other) * past2.take(other)
        # less than 2^41 over at most 2^12: the quotient's whole part is exact
        x = (((rest + 1 << SHARES) - 1) / self.w0.take(other)).astype(np.int64)
        out[other] = self.search(x)
        return out

    def search(self, x: np.ndarray) -> np.ndarray:
        """The last id whose frequencies start at or before ``x``."""
        if self.cell is None:
            self.cell = np.repeat(np.arange(self.n), np.diff(self.q + ((1 << CELL) - 1) >> CELL))
        s = self.cell.take(x >> CELL)
        left = np.flatnonzero(self.q.take(s + 1) <= x)
        s[left] += 1
        left = left[self.q.take(s.take(left) + 1) <= x.take(left)]
        s[left] = np.searchsorted(self.q, x.take(left), "right") - 1
        return s

    def update(self, s: np.ndarray, width: np.ndarray) -> None:
        # shares of the ids' probability, in whole 2^-SHARES; order 0 has the rest
        per = float(1 << SHARES) / width
        one = np.bincount(self.case, np.floor(self.m1 * per), 32)
        two = np.bincount(self.case, np.floor(self.m2 * per), 32)
        self.mixed[:, 0] += np.bincount(self.case, minlength=32) * float(1 << SHARES) - one - two
        self.mixed[:, 1] += one
        self.mixed[:, 2] += two
        self.fresh.append(s)
        own = s.astype(np.int32) << 2
        for key, table, t, hit in ((self.prev, self.one, self.t1, self.hit1), (self.slot, self.two, self.t2, self.hit2)):
            state = (t & 3) + (hit.view(np.int8) << 2)
            table[key] = np.where(state > 0, t & -4, own) + NEXT.take(state)
        self.prev2, self.prev = self.prev, s


def _layout(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // STEPS))
    return lanes, -(-n // lanes)


def _due(low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes that move a word on, and which of them must shorten their range first."""
    settled = (low ^ (low + width)) < TOP
    short = ~settled & (width < BOTTOM)
    due = np.flatnonzero(settled | short)
    return due, short[due]


def encode_block(ids: np.ndarray) -> bytes:
    """Bytes of one block. ``ids``: unsigned 32-bit integers."""
    ids = np.ascontiguousarray(ids, "<u4")
    n = len(ids)
    if n and ids.max() < 1 << 20:
        seen = np.zeros(int(ids.max()) + 1, bool)
        seen[ids] = True
        alphabet = np.flatnonzero(seen).astype("<u4")
        ranks = (np.cumsum(seen) - 1)[ids]
    else:
        alphabet, ranks = np.unique(ids, return_inverse=True)
    names = zlib.compress(np.diff(alphabet, prepend=np.uint32(0)).astype("<u4").tobytes())
    lanes, steps = _layout(n) if n else (0, 0)
    lens, words = np.zeros(0, "<u4"), np.zeros(0, "<u2")
    if n:
        x = np.pad(ranks, (0, lanes * steps - n), mode="edge").reshape(lanes, steps).T.astype(np.int64, order="C")
        m = _Models(len(alphabet), lanes)
        low, width = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
        each = 3 * steps + 8
        # words of the lanes side by side: lanes fill at about the same pace
        out, first = np.zeros(lanes * each, np.uint16), np.arange(lanes)
        fill = first.copy()
        for s in x:
            m.predict()
            start, size = m.interval(s)
            r = width >> np.uint64(TOTAL)
            low = low + r * start.astype(np.uint64)
            width = r * size.astype(np.uint64)
            due, short = _due(low, width)
            while len(due):
                now, wide, at = low.take(due), width.take(due), fill.take(due)
                wide = np.where(short, (~now + np.uint64(1)) & (BOTTOM - np.uint64(1)), wide)
                out[at] = now >> np.uint64(48)
                fill[due] = at + lanes
                now, wide = now << WORD, wide << WORD
                low[due], width[due] = now, wide
                more, short = _due(now, wide)
                due = due[more]
            m.update(s, size)
        for _ in range(4):
            out[fill] = low >> np.uint64(48)
            fill += lanes
            low = low << WORD
        lens = ((fill - first) // lanes).astype("<u4")
        words = out.reshape(each, lanes).T[np.arange(each) < lens[:, None]].astype("<u2")
    body = names + lens.tobytes() + words.tobytes()
    return HEAD.pack(MAGIC, n, len(alphabet), lanes, len(names), len(words), zlib.crc32(ids), zlib.crc32(body)) + body


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; raises ValueError if a checksum does not hold."""
    magic, n, size, lanes, named, count, of_ids, of_body = HEAD.unpack_from(block)
    body = memoryview(block)[HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != of_body:
        raise ValueError("damaged block")
    if not n:
        return np.zeros(0, np.uint32)
    alphabet = np.cumsum(np.frombuffer(zlib.decompress(body[:named]), "<u4"), dtype=np.uint32)
    lens = np.frombuffer(body, "<u4", lanes, named)
    # words of the lanes side by side, as they are used
    words = np.zeros((int(lens.max()), lanes), np.uint16)
    words.T[np.arange(len(words)) < lens[:, None]] = np.frombuffer(body, "<u2", count, named + 4 * lanes)
    words, at = words.ravel(), np.arange(lanes)
    steps = -(-n // lanes)
    m = _Models(size, lanes)
    low, width, code = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64), np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = code << WORD | words.take(at)
        at = at + lanes
    out = np.zeros((steps, lanes), np.int64)
    for i in range(steps):
        m.predict()
        r = width >> np.uint64(TOTAL)
        v = np.minimum((code - low) // r, np.uint64((1 << TOTAL) - 1)).astype(np.int64)
        s = m.find(v)
        start, wide = m.interval(s)
        low = low + r * start.astype(np.uint64)
        width = r * wide.astype(np.uint64)
        due, short = _due(low, width)
        while len(due):
            now, w, place = low.take(due), width.take(due), at.take(due)
            w = np.where(short, (~now + np.uint64(1)) & (BOTTOM - np.uint64(1)), w)
            code[due] = code.take(due) << WORD | words.take(place)
            at[due] = place + lanes
            now, w = now << WORD, w << WORD
            low[due], width[due] = now, w
            more, short = _due(now, w)
            due = due[more]
        m.update(s, wide)
        out[i] = s
    ids = alphabet[out.T.ravel()[:n]]
    if zlib.crc32(np.ascontiguousarray(ids, "<u4")) != of_ids:
        raise ValueError("block gives other ids than were written")
    return ids
