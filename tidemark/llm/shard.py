"""Sharding by histogram sort.

Rows get a 64-bit sort key. Splitters that cut all bytes into equal shares are
found without sorting: every round counts, in each partition, the exact bytes
and rows below a sorted list of candidate keys, sums the counts, and puts new
candidates only into the gaps that still hold a share boundary, until each
splitter is within tolerance (or next to the nearest possible key). Then the
rows are exchanged once, by the cell between two splitters.

A shard is a run of cells, so a shard's rows are ranked cell by cell in
parallel; a cell's first slot is the sum of the row counts before it. The
driver sees counts of at most ``candidates`` keys for each splitter.

The key is a hash of id and text whose low 16 bits are dealt at random, so that
neither equal texts nor a repeated row can fill a cell; it is written to the
shared folder once, so all counts and the exchange see the same keys.

Defined results: a null text has no bytes (size 1) and checksum 0; repeated
rows are rows like others; an empty table gives an empty result; extra columns
are kept, and columns named like the added ones are replaced. Shards may stay
empty if there are fewer rows than shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut

SHARDS = 16
CELL_ROWS = 50_000
MAX_CELLS = 4096
CANDIDATES = 8
TOLERANCE = 0.001
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _below(keys: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each probe."""
    sent = np.sort(probes)

    def count(batches):
        size = np.zeros(len(sent) + 1, np.int64)
        rows = np.zeros(len(sent) + 1, np.int64)
        for b in batches:
            at = np.searchsorted(sent, b.column(0).to_numpy(), "right")
            np.add.at(size, at, b.column(1).to_numpy())
            rows += np.bincount(at, minlength=len(rows))
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(size[full]), pa.array(rows[full])],
                                         names=["at", "size", "n"])

    got = keys.mapInArrow(count, "at int, size long, n long").groupBy("at").agg(F.sum("size"), F.sum("n")).collect()
    size = np.zeros(len(sent) + 1, np.int64)
    rows = np.zeros(len(sent) + 1, np.int64)
    for at, s, n in got:
        size[at], rows[at] = s, n
    return np.cumsum(size)[:-1], np.cumsum(rows)[:-1]


def splitters(keys: DataFrame, parts: int, *, strict_every: int = 1, tolerance: float = TOLERANCE,
              candidates: int = CANDIDATES) -> np.ndarray:
    """Keys that cut the bytes of ``keys(key, size)`` into ``parts`` nearly
    equal parts. Every ``strict_every``-th boundary is held to ``tolerance`` of
    the bytes between two of those; the others to a quarter of a part."""
    low, high, total, count = keys.agg(F.min("key"), F.max("key"), F.sum("size"), F.count(F.lit(1))).first()
    if not count or parts < 2:
        return np.full(parts - 1, 0 if low is None else low, np.int64)
    goals = np.array([total * j // parts for j in range(1, parts)], np.int64)
    strict = np.arange(1, parts) % strict_every == 0
    slack = np.where(strict, tolerance * total * strict_every / parts, total / parts / 4)
    # bracket of each splitter: keys with the bytes and rows below them
    lo, hi = [int(low)] * (parts - 1), [int(high) + 1] * (parts - 1)
    lo_b, hi_b = np.zeros(parts - 1, np.int64), np.full(parts - 1, total, np.int64)
    lo_n, hi_n = np.zeros(parts - 1, np.int64), np.full(parts - 1, count, np.int64)
    best = [lo[j] if goals[j] - lo_b[j] <= hi_b[j] - goals[j] else hi[j] for j in range(parts - 1)]
    off = np.minimum(goals - lo_b, hi_b - goals)
    while True:
        open_ = [j for j in range(parts - 1)
                 if off[j] > slack[j] and hi[j] - lo[j] > 1 and hi_n[j] - lo_n[j] > 1]
        if not open_:
            # a key above the largest int64 can't be a probe; the last bracket ends there
            return np.sort(np.array([min(x, 2**63 - 1) for x in best], np.int64))
        tries: set[int] = set()
        for j in open_:
            width = hi[j] - lo[j]
            tries |= {lo[j] + width * (i + 1) // (candidates + 1) for i in range(candidates)}
            # and where the goal lies if the bytes are spread evenly
            guess = lo[j] + width * int(goals[j] - lo_b[j]) // max(1, int(hi_b[j] - lo_b[j]))
            tries |= {min(max(guess, lo[j] + 1), hi[j] - 1)}
        probes = np.array(sorted(t for t in tries if int(low) < t <= int(high)), np.int64)
        size, rows = _below(keys, probes - 1)  # keys up to probe - 1 are those below the probe
        for j in open_:
            i = int(np.searchsorted(size, goals[j], "right"))
            for k in (i - 1, i):
                if not 0 <= k < len(probes):
                    continue
                p, b, n = int(probes[k]), int(size[k]), int(rows[k])
                if abs(int(goals[j]) - b) < off[j]:
                    off[j], best[j] = abs(int(goals[j]) - b), p
                if b <= goals[j] and p > lo[j]:
                    lo[j], lo_b[j], lo_n[j] = p, b, n
                elif b > goals[j] and p < hi[j]:
                    hi[j], hi_b[j], hi_n[j] = p, b, n


def histogram_shards(docs: DataFrame, shards: int = SHARDS, *, id_col: str = "doc_id", text_col: str = "text",
                     tolerance: float = TOLERANCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``docs`` plus ``size``, ``text_crc32``, ``law`` (``bytes``), ``shard``,
    ``slot`` and ``grown_shard`` (null under this law)."""
    text = F.col(text_col).cast("string")
    spread = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(0xFFFF))
    key = F.xxhash64(F.col(id_col), text).bitwiseAND(F.lit(-0x10000)).bitwiseOR(spread)
    kept = [c for c in docs.columns if c not in ADDED]
    keyed = cut(docs.select(*kept, (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("__size"),
                            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("__crc"), key.alias("__key")), "shard")
    keys = keyed.select(F.col("__key").alias("key"), F.col("__size").alias("size"))
    each = max(1, min(MAX_CELLS // shards, -(-keyed.count() // (cell_rows * shards))))
    bounds = splitters(keys, shards * each, strict_every=each, tolerance=tolerance)

    @F.arrow_udf("int")
    def cell_of(k: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, k.to_numpy(zero_copy_only=False), "right"), pa.int32())

    dealt = keyed.withColumn("__cell", cell_of("__key"))
    # at most MAX_CELLS counts
    counts = {r[0]: r[1] for r in dealt.groupBy("__cell").count().collect()}
    first, at = [], 0
    for c in range(shards * each):
        at = 0 if c % each == 0 else at
        first.append(at)
        at += counts.get(c, 0)
    firsts = F.broadcast(docs.sparkSession.createDataFrame(list(enumerate(first)), "__c int, __first long"))
    rank = F.row_number().over(Window.partitionBy("__cell").orderBy("__key"))
    ranked = dealt.withColumn("__rank", rank).join(firsts, F.col("__cell") == F.col("__c"))
    return ranked.select(*kept, F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
                         F.lit("bytes").alias("law"), F.floor(F.col("__cell") / each).cast("int").alias("shard"),
                         (F.col("__first") + F.col("__rank") - 1).cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
