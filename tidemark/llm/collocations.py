"""Phrases whose words stand together more often than apart, by language.

Level-wise mining in the Apriori way: every part of a frequent phrase is
frequent. Words are counted first, as byte strings. The frequent ones are put
into double-array tries of about ``trie_bytes`` bytes of keys, broadcast
together: one more pass over the texts walks them and files each text as numbers
of its words, equal for equal words only. All longer phrases are counted from
these numbers, so that passes over the texts do not grow with the candidates.

Phrases of a length are candidates if their shorter parts passed; what passed is
broadcast as a bit map of 64 bits for each phrase, of 128 MB at most, and a bit
set by another phrase only adds a candidate that turns out to be rare. Keys are
the word numbers themselves (as digits of as few 64-bit integers as hold them),
never hashes of words, so counts are exact. They are dealt by a hash of the key
in sorted runs, one row for each task and part of the keys, and numpy sums the
runs of a part.

Scores: for each cut of a phrase ``floor(1000000 a a / (l r))`` in decimals, the
lowest cut counts (ties: the first). A phrase is dropped if a longer frequent
phrase that contains it has at least half its count.

Defined results: a null language is ``und``, a null text is empty; repeated rows
count each; texts without words add nothing; an empty table gives an empty
result; extra columns are ignored. Texts of any length are read in blocks; one
word longer than a block is a block of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, cut, mix64, unmix64
from .double_array import Trie, build

MIN_COUNT, MAX_WORDS, TOP = 10, 3, 2000
#: Bit maps have this many bits for each phrase, and 2 ** LARGEST bits at most.
SPARSE, SMALLEST, LARGEST = 64, 20, 30
SEGMENT = 1 << 18
#: Words and keys that a task combines before it hands them on.
COMBINED_WORDS, COMBINED = 1 << 20, 1 << 21
#: Words of the texts for each part of the keys: fewest, and most once there are PARTS parts.
PART, LARGE_PART, PARTS = 1 << 19, 1 << 21, 4096
#: Word numbers in a row of numbered texts.
NUMBERS = 1 << 12
#: Keys in a row of a part's runs.
RUN = 1 << 12
#: Keys are held as integers below this.
SPACE = 1 << 64
TRIE_BYTES = 16 << 20
BLOCK = 1 << 19
TEXTS = 500
END, GAP = 10, 32
#: Tab is a gap between words; these end a piece.
FOLD = bytes.maketrans(b"\t.,;:!?\x0a\x0b\x0c\x0d", bytes([GAP]) + bytes([END]) * 10)
_MULT = np.uint64(0xD6E8FEB86659FD93)
#: Of a word's number: the next word does not go on the piece.
_BREAK = np.uint32(1 << 31)


# --- text as blocks of words ------------------------------------------------------

def _cuts(data: bytes, words: int, limit: int) -> Iterator[tuple[bytes, int]]:
    """``(block, own)``: parts of a long folded text; phrases that begin before
    ``own`` are the block's. A piece longer than a block is cut at a gap and
    overlaps the next block by the words a phrase may still need."""
    lo = 0
    while len(data) - lo > limit:
        at = data.rfind(b"\n", lo, lo + limit)
        if at > lo:
            yield data[lo : at + 1], at + 1 - lo
            lo = at + 1
            continue
        at = data.rfind(b" ", lo, lo + limit)
        if at <= lo:
            found = re.compile(rb"[ \n]").search(data, lo + limit)
            if found is None:
                break
            at = found.start()
        end = re.compile(rb"(?: *[^ \n]+){0,%d}" % (words - 1)).match(data, at).end()
        yield data[lo:end], at - lo
        lo = at
    yield data[lo:], len(data) - lo


def batch_blocks(batch: pa.RecordBatch, words: int) -> Iterator[tuple[str, bytes, int]]:
    """Blocks of a batch of ``(lang, text)``, some hundred texts at a time."""
    for lo in range(0, batch.num_rows, TEXTS):
        part = batch.slice(lo, TEXTS)
        yield from blocks(part.column(0).to_pylist(), part.column(1).to_pylist(), words)


def blocks(langs: list, texts: list, words: int, limit: int = BLOCK) -> Iterator[tuple[str, bytes, int]]:
    """``(lang, block, own)`` of a batch; a block holds texts of one language."""
    by: dict[str, list[str]] = {}
    for lang, text in zip(langs, texts):
        if text:
            by.setdefault("und" if lang is None else lang, []).append(text)
    for lang, own in by.items():
        held, size = [], 0
        for text in own:
            data = text.encode("utf-8", "surrogatepass").lower().translate(FOLD)
            if len(data) > limit:
                for part, mine in _cuts(data, words, limit):
                    yield lang, part, mine
                continue
            held.append(data)
            size += len(data) + 1
            if size > limit:
                yield lang, b"\n".join(held), size
                held, size = [], 0
        if held:
            yield lang, b"\n".join(held), size


class Line:
    """Words of a block, end to end with one separator after each: ``GAP`` if
    the next word goes on the piece, else ``END``. ``own``: the words whose
    phrases are the block's."""

    def __init__(self, block: bytes, own: int):
        low = np.frombuffer(block + b"\n", np.uint8)
        apart = (low == GAP) | (low == END)
        ends = np.flatnonzero(apart[1:] & ~apart[:-1]) + 1
        inside = ~apart
        starts = np.flatnonzero(inside & np.concatenate([[True], apart[:-1]]))
        breaks = np.zeros(len(starts) + 1, bool)  # one more for what stands before the first word
        breaks[np.searchsorted(starts, np.flatnonzero(low == END))] = True
        breaks = breaks[1:]
        inside[ends] = True
        self.bytes = low[inside]
        self.stop = np.cumsum(ends - starts + 1) - 1
        self.start = self.stop - (ends - starts)
        self.bytes[self.stop] = np.where(breaks, END, GAP)
        self.breaks = breaks
        self.own = starts < own

    def phrase(self, i: int, words: int) -> bytes:
        return self.bytes[self.start[i] : self.stop[i + words - 1]].tobytes()


# --- words ------------------------------------------------------------------------------

def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))


def _words(line: Line) -> pa.Array:
    """A block's words, each with one ``GAP`` behind it."""
    data = line.bytes.copy()
    data[line.stop] = GAP
    bounds = np.append(line.start, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(line.start), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def _count_words(docs: DataFrame) -> DataFrame:
    """``(lang, word, n)``: counts of each task's words; with a null word, all
    words of a language."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def batch(lang, words, n):
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), words, n], schema=schema)

    def combined(parts):
        words, n = (pa.concat_arrays(x) for x in zip(*parts))
        found = words.dictionary_encode()
        sums = np.zeros(len(found.dictionary), np.int64)
        np.add.at(sums, found.indices.to_numpy(), n.to_numpy())
        return found.dictionary, pa.array(sums)

    def emit(lang, parts):
        words, n = combined(parts)
        for lo in range(0, len(n), 1 << 14):
            yield batch(lang, pc.binary_slice(words[lo : lo + (1 << 14)], 0, -1), n[lo : lo + (1 << 14)])

    def count(batches):
        totals, held, size = {}, {}, 0
        for b in batches:
            for lang, block, mine in batch_blocks(b, 1):
                line = Line(block, mine)
                own = int(line.own.sum())
                totals[lang] = totals.get(lang, 0) + own
                if not own:
                    continue
                found = pc.value_counts(_words(line).slice(0, own))
                held.setdefault(lang, []).append((found.field("values"), found.field("counts")))
                size += len(found)
                if size > COMBINED_WORDS:
                    held = {lang: [combined(parts)] for lang, parts in held.items()}
                    size = sum(len(n) for (_, n), in held.values())
                    if size > COMBINED_WORDS // 2:
                        for lang, parts in held.items():
                            yield from emit(lang, parts)
                        held, size = {}, 0
        for lang, parts in held.items():
            yield from emit(lang, parts)
        for lang, n in totals.items():
            yield batch(lang, pa.nulls(1, pa.binary()), pa.array([n], pa.int64()))

    return docs.mapInArrow(count, "lang string, word binary, n long")


class Lexicon:
    """Words by number, from 1: ``tries`` of ``lang number, END, word``."""

    def __init__(self, words: DataFrame, trie_bytes: int):
        """``words``: ``(lang, word)``, distinct."""
        spark: SparkSession = words.sparkSession
        self.langs = [r["lang"] for r in words.select("lang").distinct().collect()]  # one row per language
        numbers = spark.createDataFrame(list(zip(self.langs, range(len(self.langs)))), "lang string, k int")
        key = F.concat(F.col("k").cast("string").cast("binary"), F.lit(b"\n"), F.col("word"))
        keys = words.join(F.broadcast(numbers), "lang").select(key.alias("key"), "k", F.octet_length("word").alias("size"))
        size = keys.agg(F.sum(F.octet_length("key"))).first()[0] or 0
        tries = max(1, -(-size // trie_bytes))
        self.tries, self.count, held = [], 0, []
        for t in range(tries):
            found = keys.filter(F.pmod(F.xxhash64("key"), F.lit(tries)) == t).orderBy("key").toArrow().combine_chunks()
            if not len(found):
                continue
            whole = found["key"].combine_chunks().cast(pa.large_binary())
            _, bounds, data = whole.buffers()
            bounds, data = np.frombuffer(bounds, np.int64)[: len(whole) + 1].copy(), np.frombuffer(data, np.uint8)
            data = data[: bounds[-1]]
            trie: Trie = build(data, bounds)
            number = np.zeros(len(trie.base), np.int32)
            number[trie.ends] = np.arange(self.count + 1, self.count + 1 + len(whole))
            starts = {lang: trie.find(f"{k}\n".encode()) for k, lang in enumerate(self.langs)}
            self.tries.append((trie.base, trie.check, number, starts))
            self.count += len(whole)
            held.append((data.tobytes(), bounds[1:], found["size"].to_numpy(), found["k"].to_numpy()))
        ends, at = [], 0
        for data, stop, _, _ in held:
            ends.append(stop + at)
            at += len(data)
        cat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        #: Bytes, end, size and language of each word, by number less 1.
        self.names = (b"".join(x[0] for x in held), cat(ends, np.int64), cat([x[2] for x in held], np.int32), cat([x[3] for x in held], np.int32))


def _numbers(tries: list, lang: str, words: pa.Array) -> np.ndarray:
    """Number of each word (``GAP`` behind it), 0 for those in no trie."""
    bounds, data = (np.frombuffer(x, kind) for x, kind in zip(words.buffers()[1:], (np.int32, np.uint8)))
    found = np.zeros(len(words), np.int32)
    for base, check, number, starts in tries:
        if starts.get(lang, -1) < 0:
            continue
        trie = Trie(base, check, number)
        left = np.arange(len(words))
        at = bounds[: len(words)].copy()
        states = np.full(len(words), starts[lang], np.int32)
        while len(left):
            states, good = trie.step(states, data[at])
            states, at, left = states[good], at[good] + 1, left[good]
            done = data[at] == GAP
            found[left[done]] = number[states[done]]
            states, at, left = states[~done], at[~done], left[~done]
    return found


def _numbered(docs: DataFrame, lexicon: Lexicon, most: int) -> DataFrame:
    """``(words, own)``: the texts as numbers of their words, 0 for rare ones;
    phrases that begin before ``own`` are the row's."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon.tries)

    def number(batches):
        held, own = [], []

        def done():
            return pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), pa.array(own, pa.int32())], names=["words", "own"])

        for b in batches:
            for lang, block, mine in batch_blocks(b, most):
                line = Line(block, mine)
                n = int(line.own.sum())
                if not n:
                    continue
                found = _words(line).dictionary_encode()
                ids = _numbers(shared.value, lang, found.dictionary)[found.indices.to_numpy()].view(np.uint32)
                ids[line.breaks] |= _BREAK
                for lo in range(0, n, NUMBERS):
                    hi = min(n, lo + NUMBERS)
                    held.append(ids[lo : hi + most - 1].astype("<u4").tobytes())
                    own.append(hi - lo)
                if len(held) > 64:
                    yield done()
                    held, own = [], []
        if held:
            yield done()

    filed = cut(docs.mapInArrow(number, "words binary, own int"), "phrase-texts")
    shared.unpersist()
    return filed


# --- phrases ------------------------------------------------------------------------------

class Keys:
    """Phrases of some words as columns of 64-bit integers, whose digits are
    the words' numbers."""

    def __init__(self, numbers: int, words: int, space: int):
        self.radix, per = numbers + 1, 1
        while self.radix ** (per + 1) <= space:
            per += 1
        self.sizes = [min(per, words - lo) for lo in range(0, words, per)]

    def pack(self, ids: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        cols = []
        for size in self.sizes:
            col = ids[at]
            for i in range(1, size):
                col = col * np.uint64(self.radix) + ids[at + i]
            at = at + size
            cols.append(col)
        return cols

    def unpack(self, cols: list[np.ndarray]) -> list[np.ndarray]:
        """Numbers of the first words, of the second, and so on."""
        ids = []
        for size, col in zip(self.sizes, cols):
            own = []
            for _ in range(size):
                col, digit = np.divmod(col, np.uint64(self.radix))
                own.append(digit.astype(np.int64))
            ids += own[::-1]
        return ids

    def runs(self, cols: list[np.ndarray]) -> list[np.ndarray]:
        """Hash first; a single column is known by it."""
        return [_hash(cols), *(cols if len(cols) > 1 else [])]

    def columns(self, run: list[np.ndarray]) -> list[np.ndarray]:
        return run[1:] or [unmix64(run[0])]


def _hash(cols: list[np.ndarray]) -> np.ndarray:
    h = mix64(cols[0])
    for col in cols[1:]:
        h = mix64(h * _MULT + col)
    return h


def _combined(run: list[np.ndarray], n: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys in order of their hashes and the sums of their counts (1 each, if
    none are given)."""
    if n is None and len(run) == 1:
        run = [np.sort(run[0])]
    else:
        order = np.argsort(run[0], kind="stable")
        if len(run) > 1 and any((np.diff(x[order]) != 0)[np.diff(run[0][order]) == 0].any() for x in run[1:]):
            order = np.lexsort(run[::-1])  # keys that share a hash
        run, n = [x[order] for x in run], n if n is None else n[order]
    new = np.zeros(len(run[0]), bool)
    new[:1] = True
    for x in run:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    sums = np.diff(np.append(first, len(new))) if n is None else np.add.reduceat(n, first) if len(first) else n
    return [x[first] for x in run], sums.astype(np.int64)


def _place(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of the hash."""
    return ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = _place(h, (len(bits) * 8).bit_length() - 1)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _begins(words: np.ndarray, ids: np.ndarray, kinds: list[Keys], maps: list[np.ndarray]) -> np.ndarray:
    """Words at which a phrase of ``len(kinds) + 1`` words begins whose parts
    all passed; ``kinds``, ``maps``: of 2 words, 3 words and so on, the last
    length without a map."""
    good = (ids > 0)
    good[:-1] &= good[1:] & (words[:-1] < _BREAK)
    good[-1:] = False
    for kind, bits in zip(kinds, maps):
        at = np.flatnonzero(good)
        good[at] = _passes(bits, _hash(kind.pack(ids, at)))
        good[:-1] &= good[1:]
        good[-1:] = False
    return np.flatnonzero(good)


def _frequent(numbered: DataFrame, kinds: list[Keys], maps: list[np.ndarray], parts: int, least: int) -> DataFrame:
    """``(n, c0, c1, ...)``: count and key columns of the frequent phrases of
    ``len(kinds) + 1`` words."""
    shared = numbered.sparkSession.sparkContext.broadcast(maps)
    kind = kinds[-1]
    width = len(kind.sizes) + (len(kind.sizes) > 1)

    def emit(run, n):
        part = _part(run[0], parts)
        cuts = np.unique(np.concatenate([np.flatnonzero(part[1:] != part[:-1]) + 1, np.arange(0, len(part), RUN), [len(part)]]))
        for k in range(0, len(cuts) - 1, 32):
            some = list(zip(cuts[k : k + 32].tolist(), cuts[k + 1 : k + 33].tolist()))
            yield pa.RecordBatch.from_arrays([
                pa.array([int(part[lo]) for lo, _ in some], pa.int32()),
                pa.array([b"".join(x[lo:hi].astype("<u8").tobytes() for x in run) for lo, hi in some], pa.binary()),
                pa.array([n[lo:hi].astype(np.uint8 if n[lo:hi].max() < 256 else "<i8").tobytes() for lo, hi in some], pa.binary())],
                names=["part", "run", "n"])

    def count(batches):
        raw, runs, size, more = [], [], 0, 0

        def merged():
            if raw:
                runs.append(_combined([np.concatenate(x) for x in zip(*raw)]))
                raw.clear()
            if len(runs) == 1:
                return runs[0]
            return _combined([np.concatenate(x) for x in zip(*(r for r, _ in runs))], np.concatenate([n for _, n in runs]))

        for b in batches:
            for data, own in zip(b.column(0), b.column(1).to_pylist()):
                words = np.frombuffer(data.as_buffer(), "<u4")
                ids = (words & ~_BREAK).astype(np.uint64)
                at = _begins(words, ids, kinds, shared.value)
                at = at[: np.searchsorted(at, own)]
                raw.append(kind.runs(kind.pack(ids, at)))
                more += len(at)
            if more > COMBINED:
                runs.append(_combined([np.concatenate(x) for x in zip(*raw)]))
                raw.clear()
                size, more = size + len(runs[-1][1]), 0
                if size > COMBINED:
                    yield from emit(*merged())
                    runs.clear()
                    size = 0
        if raw or runs:
            yield from emit(*merged())

    def add(batches):
        now, held = None, []

        def done():
            run, n = _combined([np.concatenate(x) for x in zip(*(r for r, _ in held))], np.concatenate([n for _, n in held]))
            often = n >= least
            cols = kind.columns([x[often] for x in run])
            for lo in range(0, len(cols[0]), 1 << 15):
                yield pa.RecordBatch.from_arrays([pa.array(n[often][lo : lo + (1 << 15)], pa.int64()),
                                                  *[pa.array(np.ascontiguousarray(c[lo : lo + (1 << 15)]).view(np.int64)) for c in cols]],
                                                 names=["n", *[f"c{i}" for i in range(len(cols))]])

        for b in batches:
            for part, data, counts in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if part != now:
                    if held:
                        yield from done()
                    now, held = part, []
                run = list(np.frombuffer(data.as_py(), "<u8").reshape(width, -1))
                counts = counts.as_py()
                held.append((run, np.frombuffer(counts, np.uint8 if len(counts) == len(run[0]) else "<i8").astype(np.int64)))
        if held:
            yield from done()

    runs = numbered.mapInArrow(count, "part int, run binary, n binary").repartition("part").sortWithinPartitions("part")
    found = cut(runs.mapInArrow(add, ", ".join(["n long", *[f"c{i} long" for i in range(len(kind.sizes))]])), f"phrases-{len(kinds) + 1}")
    shared.unpersist()
    return found


def _bit_map(passing: DataFrame) -> np.ndarray:
    """Bit map of the phrases' hashes, built by segments in Spark; only its bits
    come to the driver."""
    n = passing.count()
    bits = min(LARGEST, max(SMALLEST, (SPARSE * n).bit_length()))
    span = min(SEGMENT * 8, 1 << bits)  # bits of a segment
    cols = [c for c in passing.columns if c != "n"]

    def places(batches):
        for b in batches:
            place = _place(_hash([c.to_numpy().view(np.uint64) for c in b.columns]), bits)
            yield pa.RecordBatch.from_arrays([pa.array(place // span, pa.int32()), pa.array(place % span, pa.int32())], names=["segment", "bit"])

    ordered = passing.select(*cols).mapInArrow(places, "segment int, bit int").repartition("segment").sortWithinPartitions("segment")

    def pack(batches):
        now, held = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array(
                [np.packbits(held, bitorder="little").tobytes()], pa.binary())], names=["segment", "bits"])

        for b in batches:
            segment, bit = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(segment)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(segment)]):
                if hi > lo and segment[lo] != now:
                    if now is not None:
                        yield done()
                    now, held = int(segment[lo]), np.zeros(span, bool)
                held[bit[lo:hi]] = True
        if now is not None:
            yield done()

    found = np.zeros((1 << bits) // 8, np.uint8)
    for row in ordered.mapInArrow(pack, "segment int, bits binary").toLocalIterator():
        part = np.frombuffer(row["bits"], np.uint8)
        found[row["segment"] * (span // 8) :][: len(part)] = part
    return found


def _spelled(passing: DataFrame, lexicon: Lexicon, names, kind: Keys) -> DataFrame:
    """``(lang, phrase, f)`` of phrases by number; ``names``: the lexicon's, broadcast."""
    langs = lexicon.langs

    def spell(batches):
        data, ends, sizes, ks = names.value
        for b in batches:
            ids = [x - 1 for x in kind.unpack([c.to_numpy().view(np.uint64) for c in b.columns[1:]])]
            words = [[data[y - n : y] for y, n in zip(ends[i].tolist(), sizes[i].tolist())] for i in ids]
            yield pa.RecordBatch.from_arrays([
                pa.array([langs[k] for k in ks[ids[0]].tolist()], pa.string()),
                pa.array([b" ".join(x) for x in zip(*words)], pa.binary()).cast(pa.string()), b.column(0)], names=["lang", "phrase", "f"])

    return passing.mapInArrow(spell, "lang string, phrase string, f long")


def count_phrases(docs: DataFrame, *, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, trie_bytes: int = TRIE_BYTES,
                  lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, f)`` of all frequent phrases of up to ``max_words``
    words, and ``(lang, n)``, the words of each language."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = _texts(docs, lang_col, text_col)
    sums = _count_words(texts).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    sums = cut(sums.filter(F.col("word").isNull() | (F.col("n") >= min_count)), "phrase-words")
    totals = sums.filter("word IS NULL").select("lang", "n")
    words = sums.filter("word IS NOT NULL")
    counts = words.select("lang", F.col("word").cast("string").alias("phrase"), F.col("n").alias("f"))
    lexicon = Lexicon(words, trie_bytes)
    if not lexicon.count:
        return counts, totals
    numbered = _numbered(texts, lexicon, max_words)
    lexicon.tries.clear()
    names = spark.sparkContext.broadcast(lexicon.names)
    size = totals.agg(F.sum("n")).first()[0]
    parts = max(1, size // LARGE_PART, min(PARTS, size // PART))
    kinds, maps = [], []
    for level in range(2, max_words + 1):
        kinds.append(Keys(lexicon.count, level, SPACE))
        passing = _frequent(numbered, kinds, maps, parts, min_count)
        counts = counts.unionByName(_spelled(passing, lexicon, names, kinds[-1]))
        if level < max_words:
            maps = [*maps, _bit_map(passing)]
    counts = cut(counts, "phrase-counts")
    names.unpersist()
    return counts, totals


def collocations(docs: DataFrame, *, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, **options) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first
    ``top`` phrases."""
    counts, totals = count_phrases(docs, min_count=min_count, max_words=max_words, **options)
    counts = counts.withColumn("words", F.split("phrase", " ", -1))
    found = counts.filter((F.size("words") > 1) & (F.col("f") >= min_count))
    # phrases inside longer ones: their largest holder
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.size("words") - k + 1), lambda i: F.array_join(F.slice("words", i, k), " "))))
    holders = (found.filter(F.size("words") > 2).select("lang", F.explode(inner).alias("phrase"), F.col("f").alias("longer"))
               .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (found.join(holders, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * 50)))
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("rest"))
    short = counts.filter(F.size("words") < max_words)
    part = lambda name, f: short.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    big = lambda c: f"cast({c} as decimal(15,0))"
    score = F.expr(f"cast(1000000 as decimal(7,0)) * {big('a')} * {big('a')} div ({big('l')} * {big('r')})")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


#: The query's result in DuckDB's own terms.
SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lines AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lines GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lines),
grams AS (
  SELECT lang, 1 AS k, w[i] AS phrase FROM places
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM places WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM places WHERE i + 2 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
holders AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, regexp_extract(phrase, '^([^ ]+ [^ ]+)', 1) AS phrase, f FROM f WHERE k = 3
    UNION ALL SELECT lang, regexp_extract(phrase, '([^ ]+ [^ ]+)$', 1), f FROM f WHERE k = 3) GROUP BY lang, phrase),
kept AS (
  SELECT f.lang, f.k, f.phrase, f.f AS a FROM f LEFT JOIN holders h ON f.lang = h.lang AND f.phrase = h.phrase
  WHERE f.k >= 2 AND (h.longer IS NULL OR 100 * h.longer < 50 * f.f)),
cuts AS (
  SELECT *, 1 AS head, regexp_extract(phrase, '^([^ ]+)', 1) AS first, regexp_extract(phrase, '^[^ ]+ (.*)$', 1) AS rest FROM kept
  UNION ALL SELECT *, 2, regexp_extract(phrase, '^([^ ]+ [^ ]+)', 1), regexp_extract(phrase, '([^ ]+)$', 1) FROM kept WHERE k = 3),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, c.head,
    ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, head) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
