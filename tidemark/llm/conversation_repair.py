"""Repair of conversations whose turns are blank, repeated, cut off or out of
order, as the cheapest edit script that gives roles ``(system? (user
assistant)+)?``.

Conversations are repartitioned by id and sorted by turn; ``mapInPandas``
streams the rows and carries the state of a dynamic program from batch to
batch, so no conversation is held. The program has four states (nothing
written; system, user, or assistant written last). For each it keeps the cost
of the cheapest script that leads there and the rank of that script among the
others in ASCII order: scripts that have used the same rows and end in one
that uses a row are never prefixes of each other, so ranks alone decide ties
later on. Costs are kept relative to the least; few such states exist, so steps
are looked up. Each row leaves one 20-bit back pointer (for every state: where
from, by which edit), spilled to a file of the task beyond ``SPILL`` rows, as
are the digests by which repeated turns are found.

``repair`` gives a report with the audit script of each conversation;
``apply_repairs`` streams rows beside their script and gives the repaired rows.

Edits: Keep 0; Rerole to user or assistant 3; Delete 4, required for blank and
duplicate rows; Insert an empty user or assistant turn 3. A truncated row that
is not deleted adds 3. The first fault of a row counts: blank (only white
space), duplicate (role and text seen earlier in the conversation), truncated
(the last character that is no white space is none of ``.!?``).

Defined results: null role or text: one space; a null turn stands first and
does not count for gaps; rows of one turn stand in order of role and text;
repeated rows are duplicates; a null conversation id is a conversation; roles
count by their first character, an empty role fits nowhere; rows marked as
dropped keep their conversation in the report, with zeros if none is left; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
#: Rows of one conversation whose back pointers or digests stay in memory.
SPILL = 1 << 18

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: Edits that use a row, each alone or after an insertion, in ASCII order.
STEPS = ["D", "ID", "IK", "IR", "K", "R"]
CLOSE = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
FIRST = ((0, 0), None, None, None)


def _kept(state: int, initial: str) -> int | None:
    """State after a row of this initial is kept."""
    if state == START and initial == "s":
        return SYSTEM
    role, after = NEXT[state]
    return after if initial == role[0] else None


def _uses(state: int, initial: str, delete: bool, cut: bool) -> Iterator[tuple[str, int, int]]:
    """``(edit, cost, state after)`` of the ways to use a row in a state."""
    yield "D", DELETE, state
    if not delete:
        more = CUT_OFF if cut else 0
        after = _kept(state, initial)
        if after is not None:
            yield "K", KEEP + more, after
        yield "R", REROLE + more, NEXT[state][1]


_steps: dict = {}


def _step(now: tuple, initial: str, delete: bool, cut: bool) -> tuple[tuple, int, int]:
    """``(states after the row, cost taken off all, back pointer)``."""
    known = _steps.get((now, initial, delete, cut))
    if known is not None:
        return known
    best: dict[int, tuple] = {}
    for state, held in enumerate(now):
        if held is None:
            continue
        cost, rank = held
        for before, begin, extra in (("", state, 0), ("I", NEXT[state][1], INSERT)):
            for edit, price, after in _uses(begin, initial, delete, cut):
                offer = (cost + extra + price, rank, STEPS.index(before + edit), state)
                if after not in best or offer < best[after]:
                    best[after] = offer
    least = min(x[0] for x in best.values())
    order = sorted(best, key=lambda s: best[s][1:3])
    after = tuple((best[s][0] - least, order.index(s)) if s in best else None for s in range(4))
    back = sum((best[s][3] << 3 | best[s][2]) << 5 * s for s in best)
    _steps[now, initial, delete, cut] = after, least, back
    return after, least, back


class _Spilled:
    """Numbers appended in order; beyond a limit they go to a file of the task."""

    def __init__(self, limit: int):
        self.limit, self.tail, self.file, self.blocks = limit, array("I"), None, 0

    def append(self, value: int) -> None:
        self.tail.append(value)
        if len(self.tail) >= self.limit:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.tail.tofile(self.file)
            self.blocks, self.tail = self.blocks + 1, array("I")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.tail)
        for k in range(self.blocks - 1, -1, -1):
            self.file.seek(k * self.limit * self.tail.itemsize)
            block = array("I")
            block.fromfile(self.file, self.limit)
            yield from reversed(block)


class _Seen:
    """Set of 128-bit digests; full sets go to files of the task as sorted
    runs, which are searched in place."""

    def __init__(self, limit: int):
        self.limit, self.held, self.runs = limit, set(), []

    def add(self, digest: bytes) -> bool:
        """Whether the digest is new."""
        if digest in self.held:
            return False
        high, low = np.frombuffer(digest, "<u8")
        for a, b in self.runs:
            lo, hi = np.searchsorted(a, high, "left"), np.searchsorted(a, high, "right")
            if (b[lo:hi] == low).any():
                return False
        self.held.add(digest)
        if len(self.held) >= self.limit:
            pairs = np.frombuffer(b"".join(self.held), "<u8").reshape(-1, 2)
            pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
            self.runs.append(tuple(self._file(pairs[:, k]) for k in (0, 1)))
            self.held = set()
        return True

    @staticmethod
    def _file(values: np.ndarray) -> np.ndarray:
        with tempfile.TemporaryFile() as f:
            np.ascontiguousarray(values).tofile(f)
            f.flush()
            return np.memmap(f, "<u8", "r", shape=values.shape)


class _Conversation:
    def __init__(self, spill: int):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.cost = 0
        self.low = self.high = self.before = None
        self.seen, self.back, self.now = _Seen(spill), _Spilled(spill), FIRST

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.rows += 1
        if turn is not None:
            if self.high != turn:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial, said = role[:1], text.strip(SPACE)
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        new = self.seen.add(hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest())
        delete, cut = not said or not new, False
        if not said:
            self.blank += 1
        elif not new:
            self.duplicate += 1
        elif said[-1] not in ".!?":
            self.truncated += 1
            cut = True
        self.now, least, back = _step(self.now, initial if initial in ("s", "u", "a") else "", delete, cut)
        self.cost += least
        self.back.append(back)

    def audit(self) -> tuple[int, str]:
        """Cost and edits of the cheapest script."""
        ends = [(held[0] + INSERT * len(CLOSE[s]), held[1], CLOSE[s], s) for s, held in enumerate(self.now) if held]
        more, _, close, state = min(ends)
        edits = bytearray(close, "ascii")
        for back in self.back.backwards():
            code = back >> 5 * state & 31
            edits += STEPS[code & 7][::-1].encode()
            state = code >> 3
        edits = edits[len(close):][::-1] + edits[: len(close)]
        return self.cost + more, edits.decode()

    def report(self) -> tuple:
        cost, audit = self.audit()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.rows, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _ordered(turns: DataFrame, conv: str, turn: str, role: str, text: str, dropped: Column) -> DataFrame:
    """Rows by conversation, in order of turn (nulls first), role and text; ids
    and turns as text, so that nulls and large numbers pass pandas unchanged."""
    fill = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(F.col(conv).cast("string").alias("c"), F.col(turn).cast("long").alias("n"), fill(role).alias("role"),
                        fill(text).alias("text"), F.coalesce(dropped, F.lit(False)).alias("dropped"))


def repair(turns: DataFrame, *, dropped: Column | None = None, spill: int = SPILL, conv_col: str = "conv_id",
           turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, rows, gaps, blank, duplicate, truncated, illegal, cost,
    audit)`` of every conversation. ``dropped``: rows that are gone, but whose
    conversation is still reported."""
    rows = _ordered(turns, conv_col, turn_col, role_col, text_col, F.lit(False) if dropped is None else dropped)
    ordered = (rows.repartition("c").sortWithinPartitions("c", "n", "role", "text")
               .select("c", F.col("n").cast("string").alias("n"), "role", "text", "dropped"))
    names = ["c", "rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def stream(batches):
        open_, conv, out, size = None, None, [], 0
        for b in batches:
            for c, n, role, text, gone in zip(*(b[x].tolist() for x in ("c", "n", "role", "text", "dropped"))):
                if open_ is None or c != conv:
                    if open_ is not None:
                        out.append((conv, *open_.report()))
                        size += len(out[-1][-1]) + 100
                        if size > 4 << 20:
                            yield pd.DataFrame(out, columns=names)
                            out, size = [], 0
                    conv, open_ = c, _Conversation(spill)
                if not gone:
                    open_.add(None if n is None else int(n), role, text)
        if open_ is not None:
            out.append((conv, *open_.report()))
        if out:
            yield pd.DataFrame(out, columns=names)

    found = ordered.mapInPandas(stream, "c string, rows long, gaps long, blank long, duplicate long, truncated long, "
                                        "illegal long, cost long, audit string")
    return found.select(F.col("c").cast(turns.schema[conv_col].dataType).alias("conv_id"), *names[1:])


def apply_repairs(turns: DataFrame, report: DataFrame, *, dropped: Column | None = None, conv_col: str = "conv_id",
                  turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, seq, edit, role, text)``: the rows of the repaired
    conversations in order of ``seq`` (deleted rows are gone). ``report``: that
    of :func:`repair` on the same rows."""
    rows = _ordered(turns, conv_col, turn_col, role_col, text_col, F.lit(False) if dropped is None else dropped)
    script = report.select(F.col("conv_id").cast("string").alias("c"), F.lit(None).cast("long").alias("n"), F.lit("").alias("role"),
                           F.col("audit").alias("text"), F.lit(0).alias("kind"))
    both = rows.filter(~F.col("dropped")).drop("dropped").withColumn("kind", F.lit(1)).unionByName(script)
    ordered = (both.repartition("c").sortWithinPartitions("c", "kind", "n", "role", "text").select("c", "kind", "role", "text"))

    def stream(batches):
        out, size = [], 0
        conv, script, at, seq, state = None, "", 0, 0, START

        def inserted():
            nonlocal at, seq, state
            while at < len(script) and script[at] == "I":
                role, state = NEXT[state]
                out.append((conv, seq, "I", role, ""))
                at, seq = at + 1, seq + 1

        for b in batches:
            for c, kind, role, text in zip(*(b[x].tolist() for x in ("c", "kind", "role", "text"))):
                if kind == 0:
                    inserted()  # the end of the conversation before
                    conv, script, at, seq, state = c, text, 0, 0, START
                    continue
                inserted()
                edit = script[at]
                at += 1
                if edit == "R":
                    role, state = NEXT[state]
                elif edit == "K":
                    state = _kept(state, role[:1])
                if edit != "D":
                    out.append((conv, seq, edit, role, text))
                    seq += 1
                    size += len(text) + 50
                if size > 4 << 20:
                    yield pd.DataFrame(out, columns=["c", "seq", "edit", "role", "text"])
                    out, size = [], 0
        inserted()
        if out:
            yield pd.DataFrame(out, columns=["c", "seq", "edit", "role", "text"])

    found = ordered.mapInPandas(stream, "c string, seq long, edit string, role string, text string")
    return found.select(F.col("c").cast(turns.schema[conv_col].dataType).alias("conv_id"), "seq", "edit", "role", "text")


def text_digests(repaired: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: digest of ``role:text`` of each
    conversation's rows, joined by newlines, streamed in order."""
    kind = repaired.schema["conv_id"].dataType
    ordered = (repaired.select(F.col("conv_id").cast("string").alias("c"), "seq", "role", "text").repartition("c")
               .sortWithinPartitions("c", "seq").select("c", "seq", "role", "text"))

    def stream(batches):
        out, conv, digest = [], None, None
        for b in batches:
            for c, seq, role, text in zip(*(b[x].tolist() for x in ("c", "seq", "role", "text"))):
                if digest is None or seq == 0:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["c", "sha"])
                out = []
        if digest is not None:
            out.append((conv, digest.hexdigest()))
        if out:
            yield pd.DataFrame(out, columns=["c", "sha"])

    return ordered.mapInPandas(stream, "c string, sha string").select(F.col("c").cast(kind).alias("conv_id"), F.col("sha").alias("repaired_sha256"))


def damage(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text, dropped)``: the rows with faults chosen by
    ``crc32(conv_id:turn) % 20`` (nulls are one space): 0 marks a row as
    dropped, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4
    makes the role user."""
    fill = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(fill(conv_col), F.lit(":"), fill(turn_col)).cast("binary")) % 20
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), fill(role_col).alias("role"),
                        fill(text_col).alias("text"), fault.alias("fault"))
    text = (F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("fault") == 0).alias("dropped"), F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1)))
                                                                          .otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")
