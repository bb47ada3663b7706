"""SentencePiece encoding (merge-type models) by backtracking, and decoding.

A merge-type model joins, again and again, the two neighbours whose joined text
is the best-scored piece (the leftmost of equals). Which neighbours meet at a
border between two final pieces depends on those two pieces alone, so a
sequence of pieces is the model's encoding exactly if every piece encodes to
itself and every two neighbours *fit*: merging their joined text anew gives
just the two. Hence:

* an Aho-Corasick automaton (of the reversed pieces, run over the reversed
  text) gives the longest piece that starts at each position;
* from left to right the longest piece that fits the one before is taken, else
  the next shorter piece that is its prefix;
* where none fits, the position is marked failed in a bit field and the last
  piece is taken back. The encoding of a text up to a position is unique, so a
  position that failed once fails always: the work is linear in the text.

Texts are normalised by the library and cut where no piece can lie across: in
front of a run of word marks, and around characters that occur in no longer
piece. Units between cuts are encoded once and looked up afterwards (two
generations of a bounded table), so a long text is streamed unit by unit.
Characters without a piece become their byte pieces, or the unknown piece.

Decoding hands the ids to the library's ``decode``.

Defined results: null and empty texts have no ids and decode to an empty text;
repeated rows are rows of their own; an empty table gives an empty result;
extra columns are ignored, whatever their names. Models with user-defined
symbols, unused pieces or of another type are refused with an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"  # the library's word mark
UNITS = 150_000
PAIRS = 400_000
#: Characters of a text that are cut into units at a time.
SLICE = 1 << 18
#: Bytes of ids or text in one Arrow batch that goes back to Spark.
BATCH_BYTES = 4 << 20


class Encoder:
    """Encoding of texts by one model; ``encode`` gives ids as little-endian
    32-bit integers."""

    def __init__(self, path: str, units: int = UNITS, pairs: int = PAIRS):
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        own = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in own}
        self.text = list(self.score)
        self.out = [np.array([i], "<i4").tobytes() for i in own]
        # characters of longer pieces that are no piece themselves
        for c in sorted({c for p in self.text for c in p}.difference(self.score)):
            self.text.append(c)
            self.out.append(self._fallback(c))
        self.index = {p: k for k, p in enumerate(self.text)}
        self.size = [len(p) for p in self.text]
        self.shorter = [next((self.index[p[:j]] for j in range(len(p) - 1, 0, -1) if p[:j] in self.index), -1) for p in self.text]
        self.automaton = ahocorasick.Automaton()
        for k, p in enumerate(self.text):
            self.automaton.add_word(p[::-1], k)
        self.automaton.make_automaton()
        self.joins = {c for p in self.text if len(p) > 1 for c in p}
        # no cut in front of a word mark if some piece holds one after another character
        marked = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.text)
        letters = "".join(map(re.escape, sorted(self.joins if marked else self.joins - {MARK})))
        self.cut = re.compile(f"[{letters}]+|[^{letters}]" if marked else f"{MARK}+[{letters}]*|[{letters}]+|[^{letters}{MARK}]")
        self.border = None if marked else re.compile(f"(?<=[^{MARK}]){MARK}")
        self.units, self.limit = {}, units
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.most, self.histories = pairs, {}
        for probe in (f"{MARK * 3}a", "ab ba", *self.text[:: max(1, len(self.text) // 50)]):
            if self.encode(probe) != np.array(sp.encode(probe), "<i4").tobytes():
                raise ValueError(f"not a merge-type model, or one with user-defined symbols: {probe!r} differs")

    def _fallback(self, char: str) -> bytes:
        if self.byte:
            return np.array([self.byte[b] for b in char.encode("utf-8", "surrogatepass")], "<i4").tobytes()
        return np.array([self.model.unk_id()], "<i4").tobytes()

    def _history(self, piece: int) -> tuple[bool, list[float], list[str], list[str]]:
        """The merges of a piece's own text, from its characters: whether they
        end in the piece; their scores in order; the part at the left and the
        right end before each merge and after the last."""
        known = self.histories.get(piece)
        if known is None:
            parts, score = list(self.text[piece]), self.score
            scores, left, right = [], [parts[0]], [parts[-1]]
            while True:
                best, value = -1, 0.0
                for i in range(len(parts) - 1):
                    s = score.get(parts[i] + parts[i + 1])
                    if s is not None and (best < 0 or s > value):
                        best, value = i, s
                if best < 0:
                    break
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
                scores.append(value)
                left.append(parts[0])
                right.append(parts[-1])
            known = self.histories[piece] = (len(parts) == 1, scores, left, right)
        return known

    def _meet(self, last: int, piece: int) -> bool:
        """Whether merging the two texts anew, side by side, ends in the two
        pieces: no merge across the border comes before those on either side
        (of equal scores the leftmost goes first)."""
        whole, b, left, _ = self._history(piece)
        if last < 0 or not whole:
            return whole
        whole, a, _, right = self._history(last)
        if not whole:
            return False
        score, i, j, never = self.score, 0, 0, float("-inf")
        while True:
            here = a[i] if i < len(a) else never
            there = b[j] if j < len(b) else never
            across = score.get(right[i] + left[j])
            if across is not None and across > here and across >= there:
                return False
            if here == there == never:
                return True
            if here >= there:
                i += 1
            else:
                j += 1

    def _fits(self, last: int, piece: int) -> bool:
        """Whether ``piece`` may follow ``last`` (-1: begin a unit)."""
        known = self._meet(last, piece)
        if len(self.pairs) >= self.most:
            self.pairs.clear()
        self.pairs[last * len(self.text) + piece] = known
        return known

    def encode_unit(self, unit: str) -> list[int]:
        """Pieces (numbers in ``text``) of one unit."""
        n, m, size, shorter, known = len(self.text), len(unit), self.size, self.shorter, self.pairs.get
        longest = [-1] * m
        for end, k in self.automaton.iter(unit[::-1]):
            at = m - 1 - end
            if longest[at] < 0 or size[longest[at]] < size[k]:
                longest[at] = k
        open_ = bytearray(b"\x01") * (m + 1)
        taken: list[int] = []
        at, last, piece = 0, -1, longest[0]
        while at < m:
            while piece >= 0:
                end = at + size[piece]
                if open_[end]:
                    fits = known(last * n + piece)
                    if self._fits(last, piece) if fits is None else fits:
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                at, last = end, piece
                piece = longest[at] if at < m else -1
            else:
                open_[at] = 0
                piece = taken.pop()
                at -= size[piece]
                last = taken[-1] if taken else -1
                piece = shorter[piece]
        return taken

    def _learn(self, unit: str) -> bytes:
        if len(unit) == 1 and unit not in self.index:
            return self._fallback(unit)
        return b"".join([self.out[k] for k in self.encode_unit(unit)])

    def _slices(self, text: str) -> Iterator[str]:
        """``text`` in parts of about ``SLICE`` characters that no piece spans."""
        lo = 0
        while len(text) - lo > SLICE and self.border is not None:
            hit = self.border.search(text, lo + SLICE)
            if hit is None:
                break
            yield text[lo : hit.start()]
            lo = hit.start()
        yield text[lo:] if lo else text

    def encode(self, text: str) -> bytes:
        found = []
        for part in self._slices(self.model.normalize(text)):
            units = self.cut.findall(part)
            new = set(units).difference(self.units)
            if new:
                if len(self.units) > self.limit:
                    self.older, self.units = self.units, {}
                    new = set(units)
                for u in new:
                    known = self.older.get(u)
                    self.units[u] = self._learn(u) if known is None else known
            found.append(b"".join(map(self.units.__getitem__, units)))
        return found[0] if len(found) == 1 else b"".join(found)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder of a model."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_texts(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)`` of every row; ``model``: path of the model file, which
    every executor can read."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        own = encoder(model)
        for b in batches:
            texts, lo = b.column(1), 0
            while lo < b.num_rows:
                found, held, hi = [], 0, lo
                while hi < b.num_rows and held < BATCH_BYTES:
                    found.append(own.encode(texts[hi].as_py()))
                    held += len(found[-1])
                    hi += 1
                ends = np.cumsum([0, *map(len, found)]) // 4
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(
                    pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), ids], names=["doc_id", "ids"])
                lo = hi

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, model: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, ids, text)``: the library's decoding of every row's ids; null
    ids are none."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        decode = encoder(model).model.decode if model in _encoders else sentencepiece.SentencePieceProcessor(model_file=model).decode
        for b in batches:
            lists, lo = b.column(1), 0
            while lo < b.num_rows:
                texts, held, hi = [], 0, lo
                while hi < b.num_rows and held < BATCH_BYTES:
                    ids = lists[hi].values.to_numpy(zero_copy_only=False).tolist()
                    texts.append(decode(ids) if ids else "")
                    held += 4 * len(ids)
                    hi += 1
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), lists.slice(lo, hi - lo), pa.array(texts, pa.string())],
                                                 names=["doc_id", "ids", "text"])
                lo = hi

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
