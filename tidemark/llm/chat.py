"""Chat formatting by incremental black-box rendering.

A template is any function from a list of ``(role, text)`` turns to a string.
It is not looked into: successive prefixes of a conversation are rendered, and
comparing consecutive outputs gives the span of each turn. If an output does
not begin with the one before it, the template rewrites history there; the
turn is marked and its span starts where the outputs part.

Turns of a conversation are streamed in order through one task, after a sort
that can spill. Every prefix is rendered whole: the turns of a conversation are
held until it ends, and its renders grow with the square of its length. For a
template that declares itself local (``template.local = True``: each turn's
piece is the same whatever turns stand before it) a turn is rendered after the
last ``window`` turns only, and the declaration is put to the proof: at 16, 32,
64, ... turns and at the end the whole prefix is rendered and compared with the
pieces joined, which costs linear time in all. Where they part, the turns since
the last proof, and all that follow, are rendered by whole prefixes. Nothing is
given out before it is proved.

Output: one row per turn with the span at which the consecutive outputs part,
in the output after that turn, and the text there. Unless a turn rewrites
history, a conversation's text is its pieces in order, so no row holds a whole
conversation.

Defined results: null role or text: empty; turns with the same number stand in
order of role and text; repeated rows are turns of their own; a null
conversation id is a conversation; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Template = Callable[[list[tuple[str, str]]], str]
WINDOW = 8
CONTROL = re.compile(r"<(?=/?s>)|\[(?=/?INST\])")
TURN = re.compile(r"<s>\[INST\] (.*?)\[/INST\](.*?)</s>", re.S)


def escape(text: str) -> str:
    """``text`` without control strings: backslashes are doubled and a single
    one breaks each control string after its first character."""
    return CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def marked_turns(turns: list[tuple[str, str]]) -> str:
    """Each turn as ``<s>[INST] role[/INST]text</s>`` with escaped parts."""
    return "".join(f"<s>[INST] {escape(r)}[/INST]{escape(t)}</s>" for r, t in turns)


marked_turns.local = True


def common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


def render_spans(turns, template: Template, window: int = WINDOW) -> Iterator[tuple[int, str, bool]]:
    """``(start, piece, rewrites)`` for each turn of one conversation, in order:
    where the output with the turn parts from the one before it, what stands
    from there on, and whether some of the earlier output was replaced."""
    seen: list[tuple[str, str]] = []
    before = template([])

    def by_prefix(turn) -> tuple[int, str, bool]:
        nonlocal before
        seen.append(turn)
        now = template(seen)
        keep = common_prefix(before, now)
        rewrites = keep < len(before)
        start = 0 if len(seen) == 1 and not rewrites else keep
        before = now
        return start, now[start:], rewrites

    stream = iter(turns)
    if not getattr(template, "local", False):
        yield from map(by_prefix, stream)
        return
    proved, text, held, size = 0, before, [], len(before)

    def holds() -> bool:
        return template(seen) == text + "".join(p for _, p, _ in held)

    for turn in stream:
        seen.append(turn)
        tail = seen[-window:]
        shorter, longer = template(tail[:-1]), template(tail)
        piece = longer[len(shorter):]
        if len(seen) == 1:
            held.append((0, longer, False))
            text, size = "", len(longer)
        else:
            held.append((size, piece, False))
            size += len(piece)
        count = len(seen)
        broken = not longer.startswith(shorter)
        if broken or count >= 16 and count & (count - 1) == 0:
            if broken or not holds():
                break
            text += "".join(p for _, p, _ in held)
            proved = len(seen)
            yield from held
            held = []
    else:
        if not held:
            return
        if holds():
            yield from held
            return
    # the template is not local: whole prefixes from the last proof on
    again = seen[proved:]
    del seen[proved:]
    before = template(seen)
    yield from map(by_prefix, again)
    yield from map(by_prefix, stream)


def _conversations(batches) -> Iterator[tuple]:
    """``(conversation, role, text)`` in order from sorted batches."""
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(b.num_columns)))


def format_conversations(turns: DataFrame, template: Template = marked_turns, *, window: int = WINDOW,
                         conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """``(conv_id, seq, role, start, end, piece, rewrites)``: each turn's place
    in its conversation, its span in the text formatted up to it, and the text
    of the span."""
    rows = turns.select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("n"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartition("c").sortWithinPartitions("c", "n", "role", "text").select("c", "role", "text")
    types = [("conv_id", pa.int64()), ("seq", pa.int64()), ("role", pa.string()), ("start", pa.int64()),
             ("end", pa.int64()), ("piece", pa.string()), ("rewrites", pa.bool_())]

    def render(batches):
        out: list[tuple] = []
        stream = _conversations(batches)
        row = next(stream, None)
        size = 0
        while row is not None:
            conv, state = row[0], {"row": row}

            def own(roles):
                """Turns of this conversation; leaves the next one's first row in ``state``."""
                while state["row"] is not None and state["row"][0] == conv:
                    roles.append(state["row"][1])
                    yield state["row"][1], state["row"][2]
                    state["row"] = next(stream, None)

            roles: list[str] = []
            for seq, (start, piece, rewrites) in enumerate(render_spans(own(roles), template, window)):
                out.append((conv, seq, roles[seq], start, start + len(piece), piece, rewrites))
                size += len(piece)
                if size > 1 << 20:
                    yield _batch(out, types)
                    out, size = [], 0
            row = state["row"]
        if out:
            yield _batch(out, types)

    return ordered.mapInArrow(render, "conv_id long, seq long, role string, start long, end long, piece string, rewrites boolean")


def _batch(rows: list[tuple], types) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)],
                                      names=[n for n, _ in types])


def read_back(formatted: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Digests of each conversation, parsed from its formatted text alone (the
    pieces as one stream, whatever their borders)."""
    types = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
             ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("rewrites", pa.int64())]

    def parse(batches):
        out, conv, open_ = [], None, None

        def close():
            if open_["rest"]:
                raise ValueError(f"conversation {conv}: {len(open_['rest'])} characters are no turn")
            out.append((conv, open_["n"], open_["all"].hexdigest(), open_["loss"], open_["mask"].hexdigest(),
                        open_["chars"], open_["rewrites"]))

        for c, piece, rewrites in _conversations(batches):
            if open_ is None or c != conv:
                if open_ is not None:
                    close()
                    if len(out) >= 10_000:
                        yield _batch(out, types)
                        out.clear()
                conv, open_ = c, {"rest": "", "n": 0, "all": hashlib.sha256(), "loss": 0, "mask": hashlib.sha256(),
                                  "chars": 0, "rewrites": 0}
            open_["chars"] += len(piece)
            open_["rewrites"] += rewrites
            text, at = open_["rest"] + piece, 0
            while m := TURN.match(text, at):
                role, said = unescape(m[1]), unescape(m[2])
                open_["n"] += 1
                open_["all"].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                if role == loss_role:
                    open_["loss"] += len(said)
                    open_["mask"].update(said.encode("utf-8", "surrogatepass"))
                at = m.end()
            open_["rest"] = text[at:]
        if open_ is not None:
            close()
        if out:
            yield _batch(out, types)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "seq").select("conv_id", "piece", "rewrites")
    return ordered.mapInArrow(parse, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                     "formatted_chars long, rewrites long")
