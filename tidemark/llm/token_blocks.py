"""Token ids as compressed binary blocks.

Texts are put in id order by one range exchange, encoded with a public
tokenizer, closed with the end id and packed into blocks of whole documents
(about ``block_ids`` ids each), coded by :mod:`range_coder`. A block is a row of
a Parquet table in the shared folder: its place (``part``, ``block``), the ids
and lengths of its documents, and the coded bytes. Spark commits the files, so a
lost executor leaves no half-written block; blocks are read independently.

The tokenizer drops white space and never joins across it, so a text's ids are
those of its pieces in order. Pieces are encoded once for each worker and looked
up afterwards (a bounded table, started anew when full). Where the tokenizer's
normalizer and pre-tokenizer are the known ones (``PLAIN``), runs of letters,
digits and runs of marks are cut from the bytes of many texts at once and looked
up in lower case, and the library's model encodes the new ones. All other
pieces (up to the white space around them) are encoded by the whole tokenizer,
many at once with a special token between them, which the tokenizer splits off
before anything else, so each piece's ids are its own.

Defined results: null and empty texts have the end id only; repeated rows are
rows of their own; a null document id stands first; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..config import scratch_path
from .common import Chunk, chunks
from .range_coder import decode_block, encode_block

END_ID = 1
BLOCK_IDS = 1 << 20
#: Pieces and ids that a worker keeps; of pieces that are kept as byte strings
#: so many, and bytes.
PIECES, KEPT_IDS, STRINGS, STRING_BYTES = 2_000_000, 1 << 25, 300_000, 1 << 25
CHUNK_BYTES = 1 << 20
TOGETHER = 500

#: Normalizer and pre-tokenizer under which plain pieces are known: those of
#: ASCII without ' and <, and of the letters from U+00C0 to U+00FF. None of these
#: is composed with another, and each has one lower case.
PLAIN = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})
SPACE, LETTER, DIGIT, MARK, ODD = range(5)


def _kinds(of) -> np.ndarray:
    return np.array([of(chr(b), b) for b in range(256)], np.uint8)


BYTES = {
    "none": _kinds(lambda c, b: SPACE if c in " \n" else ODD),
    "plain": _kinds(lambda c, b: SPACE if c in " \t\n\r" else ODD if not 32 < b < 127 or c in "'<" else LETTER if c.isalpha() else DIGIT if c.isdigit() else MARK),
}
LOW = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Second bytes after 0xC3; all but the signs of multiplication and division.
C3_LETTER = np.array([0x80 <= b <= 0xBF and b not in (0x97, 0xB7) for b in range(256)])
C3_LOW = np.array([b + 32 if 0x80 <= b <= 0x9E else b for b in range(256)], np.uint8)
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Characters that stand for the bytes in a byte-level vocabulary.
_shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LEVEL = np.arange(256, dtype="<u2")
BYTE_LEVEL[[b for b in range(256) if b not in _shown]] = 0x100 + np.arange(256 - len(_shown))
BYTE_LEVEL[32] = 32


class Pieces:
    """Numbers of short byte strings: open addressing over two words of 8 bytes
    each, many keys at a time. Keys are compared whole; 0 means not held."""

    def __init__(self, bits: int = 16):
        self.slot, self.bits = np.zeros(1 << bits, np.int32), bits
        self.one, self.two, self.known = np.zeros(1 << 15, np.uint64), np.zeros(1 << 15, np.uint64), np.zeros(1 << 15, np.int32)
        self.n = 1

    def _first(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        h = (one ^ (two * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        return (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        at = self._first(one, two)
        row = self.slot.take(at).astype(np.int64)
        left = np.flatnonzero((self.one.take(row) != one) | (self.two.take(row) != two))
        left = left[row[left] > 0]
        while len(left):
            at[left] = at[left] + 1 & len(self.slot) - 1
            row[left] = now = self.slot[at[left]]
            left = left[(now > 0) & ((self.one[now] != one[left]) | (self.two[now] != two[left]))]
        return self.known.take(row)

    def _place(self, rows: np.ndarray) -> None:
        at = self._first(self.one[rows], self.two[rows])
        while len(rows):
            free = self.slot[at] == 0
            self.slot[at[free]] = rows[free]
            left = self.slot[at] != rows
            rows, at = rows[left], at[left] + 1 & len(self.slot) - 1

    def add(self, one: np.ndarray, two: np.ndarray, numbers: np.ndarray) -> None:
        """New and distinct keys."""
        n, end = self.n, self.n + len(one)
        while end > len(self.one):
            self.one, self.two, self.known = (np.concatenate([x, np.zeros_like(x)]) for x in (self.one, self.two, self.known))
        self.one[n:end], self.two[n:end], self.known[n:end], self.n = one, two, numbers, end
        if 2 * end > len(self.slot):
            while 2 * end > 1 << self.bits:
                self.bits += 1
            self.slot, n = np.zeros(1 << self.bits, np.int32), 1
        self._place(np.arange(n, end, dtype=np.int32))


class Encoder:
    """Ids of texts by way of their pieces."""

    def __init__(self, path: str, pieces: int = PIECES, end_id: int = END_ID):
        # one thread for each task: the library's own threads would take the
        # cores of other tasks, and memory for each
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer, self.limit, self.end_id = Tokenizer.from_file(path), pieces, end_id
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.between = special[-1] if special else None
        self.kind, self.last = BYTES["none"], None
        known = json.loads(self.tokenizer.to_str())
        suffix = known["model"].get("end_of_word_suffix")
        if (known["normalizer"], known["pre_tokenizer"]) == PLAIN and suffix and all("<" in t["content"] for t in known["added_tokens"]):
            self.kind, self.model = BYTES["plain"], Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.last[[i for t, i in self.tokenizer.get_vocab(False).items() if t.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.short, self.number, self.bytes = Pieces(), {}, 0
        self.flat, self.start, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        # number 0: the end of a document
        self.flat[0], self.size[0], self.used, self.n = self.end_id, 1, 1, 1

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many belong to each piece."""
        if self.between is None:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter((i for x in ids for i in x), np.uint32, int(lens.sum())), lens
        token, text = self.between
        joined = [text.join(pieces[lo : lo + TOGETHER]) + text for lo in range(0, len(pieces), TOGETHER)]
        found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        stop = flat == token
        ends = np.flatnonzero(stop)
        return flat[~stop], np.diff(ends, prepend=-1) - 1

    def _plain_ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of plain pieces: the library's model alone is left to run."""
        joined = [b" ".join(pieces[lo : lo + TOGETHER]) for lo in range(0, len(pieces), TOGETHER)]
        joined = [BYTE_LEVEL[np.frombuffer(x, np.uint8)].tobytes().decode("utf-16-le") for x in joined]
        found = self.model.encode_batch_fast(joined, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        ends = np.flatnonzero(self.last[flat])
        if len(ends) != len(pieces) or ends[-1] != len(flat) - 1:
            # a vocabulary without some byte or without the last mark
            return self._ids([p.decode() for p in pieces])
        return flat, np.diff(ends, prepend=-1)

    def _keep(self, ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Numbers of new pieces with these ids."""
        n, k, total = self.n, len(lens), len(ids)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + k > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used : self.used + total] = ids
        self.start[n : n + k] = self.used + np.cumsum(lens) - lens
        self.size[n : n + k] = lens
        self.used, self.n = self.used + total, n + k
        return np.arange(n, n + k)

    def _learn(self, new: list[bytes]) -> None:
        texts = [p.decode() for p in new]
        self.bytes += sum(map(len, new))
        # a piece that holds the token between is encoded by itself
        alone = [self.between is not None and self.between[1] in t for t in texts]
        kept = self.between
        for by_itself in (False, True):
            keys = [p for p, x in zip(new, alone) if x is by_itself]
            some = [t for t, x in zip(texts, alone) if x is by_itself]
            self.between = None if by_itself else kept
            for lo in range(0, len(some), 20_000):
                self.number.update(zip(keys[lo : lo + 20_000], self._keep(*self._ids(some[lo : lo + 20_000])).tolist()))
        self.between = kept

    def _learn_short(self, one: np.ndarray, two: np.ndarray) -> None:
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        first = np.ones(len(one), bool)
        first[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        one, two = one[first], two[first]
        for lo in range(0, len(one), 20_000):
            a, b = one[lo : lo + 20_000], two[lo : lo + 20_000]
            self.short.add(a, b, self._keep(*self._plain_ids(np.column_stack([a, b]).view("S16").ravel().tolist())))

    def _numbers(self, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of a chunk, and each piece's first byte."""
        raw = np.zeros(len(c.data) + 16, np.uint8)
        raw[: len(c.data)] = c.data
        look = lambda table: np.frombuffer(bytearray(raw).translate(table.tobytes()), np.uint8)
        n, kind, low = len(c.data), look(self.kind), raw
        if self.last is not None:
            low = look(LOW)
            at = np.flatnonzero(raw == 0xC3)
            if len(at):  # the letters from U+00C0 to U+00FF
                b = raw[at + 1]
                at, b = at[is_letter := C3_LETTER[b]] + 1, b[is_letter]
                kind[at] = kind[at - 1] = LETTER
                low[at] = C3_LOW[b]
        kind = kind[:n]
        edge = np.zeros(n + 1, bool)
        edge[c.offs] = True
        turn = edge[:n]
        odd = np.flatnonzero(kind == ODD)
        if len(odd):  # then all between white space is one piece
            solid = kind != SPACE
            start = np.flatnonzero(turn | np.diff(solid, prepend=False))
            hit = np.zeros(len(start), bool)
            hit[np.searchsorted(start, odd, "right") - 1] = True
            kind[np.repeat(hit, np.diff(start, append=n))] = ODD
        turn[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        start = np.flatnonzero(turn)
        size = np.diff(start, append=n)
        of = kind[start]
        held = of != SPACE
        start, size, of = start[held], size[held], of[held]
        number = np.zeros(len(start), np.int64)
        whole = (of == ODD) | (size > 16)
        if whole.any():
            at = np.flatnonzero(whole)
            source = {False: low.tobytes(), True: raw.tobytes()}
            keys = [source[o][a : a + k] for o, a, k in zip((of[at] == ODD).tolist(), start[at].tolist(), size[at].tolist())]
            new = set(keys).difference(self.number)
            if new:
                self._learn(list(new))
            number[at] = np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))
            at = np.flatnonzero(~whole)
            start_in, size_in = start[at], size[at]
        else:
            at, start_in, size_in = slice(None), start, size
        if len(start_in):
            eight = np.lib.stride_tricks.as_strided(low.view(np.uint8)[:8].view("<u8"), (n + 9,), (1,))
            one = eight.take(start_in) & FIRST_BYTES[np.minimum(size_in, 8)]
            two = np.zeros(len(one), np.uint64)
            long = np.flatnonzero(size_in > 8)
            two[long] = eight.take(start_in[long] + 8) & FIRST_BYTES[size_in[long] - 8]
            got = self.short.find(one, two)
            lost = np.flatnonzero(got == 0)
            if len(lost):
                self._learn_short(one[lost], two[lost])
                got[lost] = self.short.find(one[lost], two[lost])
            number[at] = got
        return number, start

    def encode(self, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's closed with the end id, and how many belong to
        each text."""
        if self.n > self.limit or self.used > KEPT_IDS:
            self.clear()
        elif len(self.number) > STRINGS or self.bytes > STRING_BYTES:
            self.number, self.bytes = {}, 0
        number, start = self._numbers(c)
        stop = np.searchsorted(start, c.offs[1:])
        number = np.insert(number, stop, 0)
        size = self.size.take(number)
        ends = np.cumsum(size)
        at = np.repeat(self.start.take(number) - ends + size, size)
        at += np.arange(ends[-1])
        return self.flat.take(at), np.diff(ends[stop + np.arange(len(stop))], prepend=0)

    def encode_all(self, texts: pa.Array):
        """What :meth:`encode` returns for consecutive texts, chunk by chunk. A
        text beyond a chunk is cut at white space and joined again."""
        for c in chunks(texts, CHUNK_BYTES):
            if len(c.data) <= 2 * CHUNK_BYTES:
                yield self.encode(c)
                continue
            parts, lo, n = [], 0, len(c.data)
            while lo < n:
                hi = lo + CHUNK_BYTES
                while hi < n and not len(at := np.flatnonzero(self.kind[c.data[hi : hi + CHUNK_BYTES]] == SPACE)):
                    hi += CHUNK_BYTES
                hi = hi + int(at[0]) if hi < n else n
                ids, _ = self.encode(Chunk(0, 1, c.data[lo:hi], np.array([0, hi - lo])))
                parts.append(ids[: len(ids) - (hi < n)])
                lo = hi
            ids = np.concatenate(parts)
            yield ids, np.array([len(ids)])


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int = END_ID) -> Encoder:
    """This worker's encoder, kept from task to task. Tasks call it by its name:
    a function sent to them would bring an empty copy of the dictionary."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id=end_id)
    return _encoders[path, end_id]


BLOCKS = "part int, block int, n_ids long, docs array<long>, sizes array<long>, data binary"


def write_blocks(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the blocks of ``docs`` to the folder ``path``; the ids of all
    documents in id order are those of parts and blocks in order."""
    # rows of one id may fill more than a partition: they go on by text and row
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange("id", F.xxhash64("text", "row")).sortWithinPartitions("id", F.xxhash64("text", "row"))

    def pack(batches):
        coder = encoder(tokenizer, end_id)
        part, block = TaskContext.get().partitionId(), 0
        own: list[np.ndarray] = []
        ids: list = []
        sizes: list[int] = []
        held = 0

        def close():
            nonlocal block, held
            row = pa.RecordBatch.from_pylist(
                [{"part": part, "block": block, "n_ids": held, "docs": list(ids), "sizes": list(sizes),
                  "data": encode_block(np.concatenate(own))}],
                pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("docs", pa.list_(pa.int64())),
                           ("sizes", pa.list_(pa.int64())), ("data", pa.binary())]))
            block, held = block + 1, 0
            own.clear(), ids.clear(), sizes.clear()
            return row

        for b in batches:
            every, lo = b.column(0).to_pylist(), 0
            for found, lens in coder.encode_all(b.column(1)):
                ends, done, at = np.cumsum(lens), 0, 0
                while done < len(lens):
                    # up to the text that fills the block
                    stop = min(int(np.searchsorted(ends, at + block_ids - held)) + 1, len(lens))
                    own.append(found[at : ends[stop - 1]])
                    ids += every[lo + done : lo + stop]
                    sizes += lens[done:stop].tolist()
                    held += int(ends[stop - 1]) - at
                    done, at = stop, int(ends[stop - 1])
                    if held >= block_ids:
                        yield close()
                lo += len(lens)
        if ids:
            yield close()

    rows.select("id", "text").mapInArrow(pack, BLOCKS).write.parquet(path)


def read_blocks(blocks: DataFrame) -> DataFrame:
    """``(doc_id, part, block, at, n_tokens, ids_crc32)`` of every document, from
    the decoded blocks; ``at``: its place in the block."""

    def unpack(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = np.ascontiguousarray(decode_block(row["data"]), "<u4")
                size = np.array(row["sizes"], np.int64)
                if size.sum() != len(ids):
                    raise ValueError("block and its document lengths differ")
                at = np.cumsum(size) - size
                crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(at.tolist(), size.tolist())]
                k = len(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["docs"], pa.int64()), pa.array([row["part"]] * k, pa.int32()), pa.array([row["block"]] * k, pa.int32()),
                     pa.array(at), pa.array(size), pa.array(crc, pa.int64())],
                    names=["doc_id", "part", "block", "at", "n_tokens", "ids_crc32"])

    return blocks.mapInArrow(unpack, "doc_id long, part int, block int, at long, n_tokens long, ids_crc32 long")


def read_ids(blocks: DataFrame) -> DataFrame:
    """``(doc_id, ids)`` of every document."""

    def unpack(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = decode_block(row["data"]).astype(np.int64)
                size = np.array(row["sizes"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["docs"], pa.int64()), pa.array(np.split(ids, np.cumsum(size)[:-1]), pa.list_(pa.int64()))],
                    names=["doc_id", "ids"])

    return blocks.mapInArrow(unpack, "doc_id long, ids array<long>")


def starts(blocks: DataFrame) -> DataFrame:
    """``(part, block, first)``: ids before each block, by prefix sums over the
    parts and then inside each part."""
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "before")
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids")
    return sizes.withColumn("inside", inside).join(before, "part").select(
        "part", "block", (F.col("before") + F.col("inside")).alias("first"))


def token_table(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Writes the blocks to the shared scratch folder and returns what they
    hold: ``(doc_id, start, n_tokens, ids_crc32)`` per document."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-blocks")
    write_blocks(docs, path, tokenizer, **options)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    return read_blocks(blocks).join(starts(blocks), ["part", "block"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
