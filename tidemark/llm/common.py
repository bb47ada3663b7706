"""Helpers shared by the training-data operators: lineage cuts in the shared
folder, size-checked broadcasts and vectorised word hashing of text batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path

BROADCAST_ROWS = 2_000_000


#: Rows of texts in one Arrow batch.
ARROW_ROWS = 1_000


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch to ``ARROW_ROWS`` (a lower
    setting stays). Texts hold kilobytes: the default of 10,000 rows makes
    batches of tens of megabytes, held off-heap by the JVM and by each Python
    worker, and kept by their allocators afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later steps
    start from the files, also after an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows (of a few short
    columns) stay within ``limit``; without one otherwise."""
    return F.broadcast(df) if rows <= limit else df


def held_out(id_col: str, folds: int, fold: int):
    """Whether an id falls in the fold that labels are not learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, y, text)`` of at most ``rows`` labelled ids for which ``learn`` holds."""
    ids = (labels.filter(learn & F.col(label).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("y"))
           .orderBy(F.xxhash64("__id"), "__id").limit(rows))
    return (docs.select(F.col(id_col).alias("__doc"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(ids), F.col("__doc") == F.col("__id")).select(F.col("__id").alias("id"), "y", "text"))


# --- text batches as byte arrays ------------------------------------------------

@dataclass
class Chunk:
    """Consecutive texts of a batch: rows ``lo`` to ``hi``, their UTF-8 bytes
    end to end and the offsets of each text (``hi - lo + 1`` values)."""

    lo: int
    hi: int
    data: np.ndarray
    offs: np.ndarray


def chunks(texts: pa.Array, limit: int = 1 << 20) -> Iterator[Chunk]:
    """Whole texts in pieces of about ``limit`` bytes (a longer text is a piece
    of its own); a null text is empty. Bounds the size of numpy temporaries."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, off_buf, data_buf = texts.buffers()
    offs = np.frombuffer(off_buf, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield Chunk(lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        lo = hi


def byte_table(is_word) -> np.ndarray:
    """Byte -> lower-cased byte (A-Z only) for word bytes, 0 for separators."""
    t = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        if is_word(low):
            t[b] = low
    return t


#: Words of letters, digits and every non-ASCII character.
ALNUM = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: Words between white space.
NONSPACE = byte_table(lambda b: not (b == 32 or 9 <= b <= 13) and b != 0)

_P = 0x9E3779B97F4A7C15 | 1
_PI = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("p")
    if have is None or len(have) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        for key, base in (("p", _P), ("i", _PI)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _powers[key] = np.multiply.accumulate(a)
    return _powers["p"], _powers["i"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unmix64(x: np.ndarray) -> np.ndarray:
    """Values that ``mix64`` turns into ``x``."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = (x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


@dataclass
class Words:
    """Words of a chunk: byte range, 64-bit hash and number of the text each
    belongs to; ``first`` holds the index of each text's first word (one more
    entry closes the last text)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    low: np.ndarray


def words(c: Chunk, table: np.ndarray) -> Words:
    low = table[c.data]
    inside = low != 0
    n = len(low)
    edge = np.zeros(n + 1, bool)
    edge[c.offs] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    p, inv = _pow(n + 1)
    pref = np.zeros(n + 1, np.uint64)
    np.cumsum(low.astype(np.uint64) * p[:n], out=pref[1:])
    h = mix64((pref[e] - pref[s]) * inv[s] + (e - s).astype(np.uint64))
    first = np.searchsorted(s, c.offs)
    doc = np.repeat(np.arange(len(c.offs) - 1), np.diff(first))
    return Words(s, e, h, doc, first, low)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each position, and whether all of them
    are words of one text."""
    size = len(w.hash)
    if size < n:
        return np.zeros(size, np.uint64), np.zeros(size, bool)
    h = np.zeros(size, np.uint64)
    ok = np.zeros(size, bool)
    ok[: size - n + 1] = w.doc[: size - n + 1] == w.doc[n - 1 :]
    for j in range(n):
        h[: size - n + 1] = h[: size - n + 1] * np.uint64(_P) + w.hash[j : size - n + 1 + j]
    return mix64(h), ok
