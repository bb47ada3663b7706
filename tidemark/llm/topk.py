"""Exact top-k search over binary codes by incremental multi-index hashing.

A code's 64 bits are cut into ``m`` segments. Round ``r`` probes, for each
query and segment, the index entries whose segment differs from the query's in
exactly ``r`` bits, and verifies the full Hamming distance. After round ``r``
every code within m * (r + 1) - 1 bits has been found, since a code farther
than ``r`` in every segment differs in at least that many plus one; each
segment of a round covers one more bit. So a query goes into the next round
with only as many segments as its k-th verified distance, which can only get
smaller, still needs, and ends when that distance is covered.

Equal codes are one index entry with their ``k`` smallest ids (found over salted
groups, so a code that a third of the rows share is no hot task), and equal
queries are searched once. Each candidate is met once: in the first round and
segment that reach it. Segments are about three quarters as wide as the
logarithm of the number of codes: a probe then meets some codes, and fewer
rounds, whose probes grow with the width to the power of the radius, are needed.

Ties in distance are broken by the smaller id. Defined results: rows with a null
code or id are neither found nor queries; repeated rows (same id and code) are
one; fewer than ``k`` rows give as many results; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut

K = 10
SALTS = 64


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def sign_codes(embedding):
    """64-bit codes of vectors of up to 64 numbers: bit i is set if number i is
    above zero. A null vector has no code; null and NaN set no bit."""

    def codes(vectors: pa.Array) -> pa.Array:
        out = []
        for v in vectors:
            x = v.as_py()
            if x is None or len(x) > 64:
                if x is not None:
                    raise ValueError(f"{len(x)} numbers do not fit a 64-bit code")
                out.append(None)
            else:
                out.append(_signed(sum(1 << i for i in np.flatnonzero(np.array(x, np.float64) > 0).tolist())))
        return pa.array(out, pa.int64())

    return F.arrow_udf(codes, "long")(embedding)


def segments(codes: int) -> list[int]:
    """Masks of the segments for an index of so many codes."""
    width = min(21, max(8, round(0.75 * log2(max(codes, 2)))))
    m = -(-64 // width)
    bounds = [64 * i // m for i in range(m + 1)]
    return [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(bounds, bounds[1:])]


def _probes(masks: list[int], r: int):
    """Rows ``(q, need, far)`` -> ``(q, far, seg, value)``: the values of the
    first ``need`` segments with exactly ``r`` of their bits flipped."""

    def probe(batches):
        flips = [np.array([sum(1 << b for b in c) for c in combinations([b for b in range(64) if x >> b & 1], r)], np.uint64)
                 for x in masks]
        for batch in batches:
            every, need, far = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for lo in range(0, len(every), 256):
                for i, (x, flip) in enumerate(zip(masks, flips)):
                    use = need[lo : lo + 256] > i
                    q, bound = every[lo : lo + 256][use], far[lo : lo + 256][use]
                    if len(flip) and len(q):
                        value = ((q & np.uint64(x))[:, None] ^ flip).ravel()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(q, len(flip)).view(np.int64)), pa.array(np.repeat(bound, len(flip)), pa.int32()),
                             pa.array(np.full(len(value), i, np.int32)), pa.array(value.view(np.int64))],
                            names=["q", "far", "seg", "value"])

    return probe


def search(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``rows(id, code)``, ``queries(id, code)`` -> ``(query_id, rank, id, distance)``."""
    spark = rows.sparkSession
    rows = rows.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    # the k smallest ids of each code, first within salted groups
    part = Window.partitionBy("code", F.pmod(F.xxhash64("id"), F.lit(SALTS))).orderBy("id")
    whole = Window.partitionBy("code").orderBy("id")
    entries = (rows.withColumn("r", F.row_number().over(part)).filter(F.col("r") <= k)
               .withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= k)
               .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    entries = cut(entries, "mih-codes")
    n, held = entries.agg(F.count(F.lit(1)), F.sum(F.size("ids"))).first()
    enough = min(k, held or 0)
    masks = segments(n)
    m = len(masks)
    cuts = F.array(*[F.struct(F.lit(i).alias("seg"), F.col("code").bitwiseAND(F.lit(_signed(x))).alias("value"))
                     for i, x in enumerate(masks)])
    index = cut(entries.select("code", "ids", F.explode(cuts).alias("s")).select("s.seg", "s.value", "code", "ids"), "mih-index")
    asked = cut(queries.filter("id IS NOT NULL AND code IS NOT NULL").select(F.col("id").alias("query_id"), F.col("code").alias("q")).distinct(),
                "mih-queries")
    active = asked.select("q").distinct().withColumn("need", F.lit(m)).withColumn("far", F.lit(64))
    if not enough:
        active = active.limit(0)
    best = spark.createDataFrame([], f"q long, id {rows.schema['id'].dataType.simpleString()}, distance int")
    done = []
    widest = max(bin(x).count("1") for x in masks)
    for r in range(widest + 1):
        if not active.limit(1).count():
            break
        probes = active.select("q", "need", "far").mapInArrow(_probes(masks, r), "q long, far int, seg int, value long")
        apart = [F.bit_count(F.col("q").bitwiseXOR(F.col("code")).bitwiseAND(F.lit(_signed(x)))) for x in masks]
        # met for the first time, and no farther than the k-th so far
        new = F.bit_count(F.col("q").bitwiseXOR(F.col("code"))) <= F.col("far")
        for i, d in enumerate(apart):
            new = new & F.when(F.col("seg") > i, d > r).otherwise(d >= r)
        # there are many more probes than the queries that Spark sizes them by
        met = (probes.hint("merge").join(index.hint("merge"), ["seg", "value"]).filter(new)
               .select("q", F.explode("ids").alias("id"), F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).alias("distance")))
        order = Window.partitionBy("q").orderBy("distance", "id")
        best = cut(best.unionByName(met).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                   .select("q", "id", "distance"), "mih-best")
        # covered so far: all of round r - 1, and one more bit for each segment of this round
        state = active.select("q", "need").join(best.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far")), "q", "left")
        state = cut(state.select("q", ((F.coalesce("n", F.lit(0)) >= enough) & (F.col("far") <= m * r - 1 + F.col("need"))
                                       | F.lit(r == widest)).alias("closed"),
                                 F.when(F.coalesce("n", F.lit(0)) >= enough, F.least(F.lit(m), F.col("far") - (m * (r + 1) - 1)))
                                 .otherwise(F.lit(m)).alias("need"),
                                 F.when(F.col("n") >= enough, F.col("far")).otherwise(F.lit(64)).alias("far")), "mih-state")
        closed, active = state.filter("closed").select("q"), state.filter("NOT closed").select("q", "need", "far")
        done.append(best.join(closed, "q", "left_semi"))
        best = best.join(active.select("q"), "q", "left_semi")
    found = done[0] if done else best
    for d in done[1:]:
        found = found.unionByName(d)
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy("distance", "id"))
    return asked.join(found, "q").withColumn("rank", rank).select("query_id", "rank", "id", "distance")


SQL = """
WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 50 = 0),
d AS (
  SELECT q.vec_id AS query_id, e.vec_id,
         LIST_SUM([CASE WHEN (x[1] > 0) <> (x[2] > 0) THEN 1 ELSE 0 END FOR x IN LIST_ZIP(q.embedding, e.embedding)])::INT AS distance
  FROM q CROSS JOIN embeddings e
)
SELECT query_id, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank, vec_id, distance
FROM d QUALIFY rank <= 10
"""
