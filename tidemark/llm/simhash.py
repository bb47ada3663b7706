"""SimHash near-duplicates by the generalised pigeonhole principle.

Each text gets a 64-bit SimHash of its word shingles (:func:`fingerprints`).
Two fingerprints link if they differ in at most ``max_bits`` bits, and every
row gets the smallest id reachable over links (:func:`near_duplicates`).

Copies collapse first: only distinct fingerprints are linked. The 64 bits are
grouped into partitions of correlated bits. Thresholds t_i >= -1 with
sum(t_i + 1) = max_bits + 1 are dealt to the partitions by dynamic programming
on estimated candidate counts: two fingerprints within ``max_bits`` agree, up to
t_i bits, in at least one partition with t_i >= 0 (:func:`plan`). Index rows
carry their partition's bits, probe rows these bits with up to t_i of them
flipped; rows with equal bits meet and the full distance is verified.

A bucket with more than ``bucket_rows`` fingerprints is not paired off. Its
members go to *midpoints* instead: within distance 2r of each other are exactly
those that share a value at distance r or less from both. A midpoint has a
bounded number of neighbours (65 for r = 1), so this is linear in the members
and exact. Only bits that vary inside the bucket are flipped.

Connected components: :func:`components`, on distinct fingerprints only.

Defined results: a null or empty text has no words and fingerprint 0, which
links like any other; a row with a null id takes part and can't be a smallest
id; repeated rows get the same component; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut

SEED = 42
SHINGLE = 3
MAX_BITS = 2
BUCKET_ROWS = 64
SAMPLE = 2048


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    x = xxhash.xxh64_intdigest
    if len(parts) <= shingle:
        return x(joined, SEED)
    lens = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(lens)
    starts = (ends - lens).tolist()
    hashes = [x(joined[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    h = np.array(hashes, np.uint64)
    count = np.zeros(64, np.int64)
    for i in range(0, len(h), 4096):
        bits = np.unpackbits(h[i : i + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * count > len(h)).tolist())


def fingerprints(text, shingle: int = SHINGLE):
    """Column of signed 64-bit fingerprints of a text column."""

    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        out = np.array([simhash(t.as_py(), shingle) for t in texts], np.uint64)
        return pa.array(out.view(np.int64))

    return fp(text)


# --- the plan: partitions and thresholds ----------------------------------------

def together(fps: DataFrame) -> np.ndarray:
    """How often each pair of bits is set in the same fingerprint (64 x 64)."""

    def count(batches):
        total = np.zeros((64, 64), np.float64)
        for b in batches:
            raw = np.ascontiguousarray(b.column(0).to_numpy()).astype("<i8")
            bits = np.unpackbits(raw.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            total += bits.T @ bits
        i, j = np.divmod(np.arange(4096), 64)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel().astype(np.int64))],
                                         names=["i", "j", "n"])

    out = np.zeros((64, 64))
    for i, j, n in fps.select("fp").mapInArrow(count, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n")).collect():
        out[i, j] = n
    return out


def group_bits(pairs: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """``parts`` groups of nearly equal size; each grows by the bit that is most
    correlated with it, so that what varies together is probed together."""
    p = np.diag(pairs) / max(rows, 1)
    cov = pairs / max(rows, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(64)), []
    for g in range(parts):
        size = 64 // parts + (g < 64 % parts)
        order = sorted(free)
        first = order[int(np.argmax(corr[np.ix_(order, order)].sum(axis=1)))]
        group = [first]
        free.discard(first)
        while len(group) < size:
            order = sorted(free)
            best = order[int(np.argmax(corr[np.ix_(order, group)].mean(axis=1)))]
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def ball(width: int, radius: int) -> int:
    return sum(comb(width, k) for k in range(radius + 1))


def allocate(cost: list[list[float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = max_bits + 1 and the least sum of
    ``cost[i][t_i]`` (a partition with -1 is not used and costs nothing)."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, max_bits + 1 - used):
                new = (c + (row[t] if t >= 0 else 0.0), [*ts, t])
                if used + t + 1 not in step or new < step[used + t + 1]:
                    step[used + t + 1] = new
        best = step
    return best[max_bits + 1]


def plan(fps: DataFrame, rows: int, max_bits: int = MAX_BITS, sample: int = SAMPLE) -> list[tuple[list[int], int]]:
    """Partitions (their bits) with thresholds. Candidates are estimated from
    the distances of a bounded sample (``sample`` fingerprints, those with the
    smallest hashes), which steers cost only, never the result."""
    pairs = together(fps)
    picked = [r[0] for r in fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()]
    some = np.array(picked, np.int64).view(np.uint64)
    diff = some[:, None] ^ some[None, :]
    # what a row can cost at most: beyond it, its bucket goes to midpoints
    most = ball(64, (max_bits + 1) // 2)
    best = None
    for parts in range(1, max_bits + 3):
        groups = group_bits(pairs, rows, parts)
        cost = []
        for g in groups:
            far = np.bitwise_count(diff & np.uint64(mask_of(g)))
            row = []
            for t in range(max_bits + 1):
                chance = ball(len(g), t) / 2.0 ** len(g)
                others = ((far <= t).sum(axis=1) - 1) / max(len(some) - 1, 1) + chance if len(some) else np.zeros(1)
                row.append(rows * (1 + ball(len(g), t)) + rows * float(np.minimum(others * rows / 2, most).mean()))
            cost.append(row)
        c, ts = allocate(cost, max_bits)
        if best is None or c < best[0]:
            best = (c, [(g, t) for g, t in zip(groups, ts) if t >= 0])
    return best[1]


# --- links and components -------------------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _flips(bits: list[int], radius: int) -> list[int]:
    """Masks of up to ``radius`` of ``bits``."""
    return [_signed(mask_of(list(c))) for k in range(radius + 1) for c in combinations(bits, k)]


def links(fps: DataFrame, rows: int, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints of ``fps(fp)`` that
    connect exactly those within ``max_bits`` of each other, directly or over
    one midpoint's smallest member."""
    if max_bits < 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    sides = []
    for n, (bits, t) in enumerate(plan(fps, rows, max_bits)):
        masked = F.col("fp").bitwiseAND(F.lit(_signed(mask_of(bits))))
        if t == 0:
            row = fps.select(F.lit(n).alias("p"), masked.alias("v"), "fp", F.lit(0).alias("near"))
        else:
            flips = F.array(*[F.lit(m) for m in _flips(bits, t)])
            row = fps.select(F.lit(n).alias("p"), masked.alias("__v"), "fp", F.explode(flips).alias("__m")).select(
                "p", F.col("__v").bitwiseXOR(F.col("__m")).alias("v"), "fp",
                F.when(F.col("__m") == 0, 0).otherwise(1).alias("near"))
        sides.append(row)
    probes = sides[0]
    for s in sides[1:]:
        probes = probes.unionByName(s)
    # buckets with more than one row and an index row; what varies inside each
    vary = F.expr("bit_or(fp)").bitwiseXOR(F.expr("bit_and(fp)"))
    buckets = (probes.groupBy("p", "v").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("best"), vary.alias("vary"))
               .filter("n > 1 AND best = 0"))
    members = cut(probes.join(buckets.select("p", "v", "n", "vary"), ["p", "v"]), "simhash-members")
    light = members.filter(F.col("n") <= bucket_rows)
    a = light.filter("near = 0").select("p", "v", F.col("fp").alias("a"))
    b = light.select("p", "v", F.col("fp").alias("b"), "near")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = (a.join(b, (a.p == b.p) & (a.v == b.v) & ((b.near == 1) | (F.col("a") < F.col("b"))) & (F.col("a") != F.col("b")) & close)
             .select("a", "b"))
    heavy = members.filter(F.col("n") > bucket_rows)
    radius = (max_bits + 1) // 2
    stars = F.array(*[F.lit(m) for m in _flips(list(range(64)), radius)])
    # flips of bits that all members share lead to no other member
    useful = F.filter(stars, lambda m: m.bitwiseAND(F.bitwise_not(F.col("vary"))) == 0)
    star = heavy.select("fp", "p", "v", F.explode(useful).alias("m")).select("p", "v", "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("mid"))
    if max_bits % 2 == 0:
        groups = star.groupBy("p", "v", "mid").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).filter(F.size("all") > 1)
        joined = groups.select("a", F.explode("all").alias("b")).filter("a != b")
    else:
        left, right = star.withColumnRenamed("fp", "a"), star.withColumnRenamed("fp", "b")
        joined = left.join(right, ["p", "v", "mid"]).filter((F.col("a") < F.col("b")) & close).select("a", "b")
    return pairs.unionByName(joined).distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and two checksums of a set of edges."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.shiftrightunsigned(h, 24))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` with the smallest node of each component, for every
    node of ``edges``. Alternates large-star and small-star steps, whose rounds
    grow with the logarithm of a component's size; each round is a table in the
    shared folder, and only a count of changed edges comes to the driver."""
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "cc")
    now = _state(e)
    while True:
        # large-star: every larger neighbour of u points to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        w = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(w, "u").withColumn("m", F.least("u", "m")).filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small-star: u and its smaller neighbours point to the smallest of them
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        rows = large.join(m, "u")
        nxt = cut(rows.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
                  .unionByName(rows.select("u", F.col("m").alias("v"))).distinct(), "cc")
        e, before, now = nxt, now, _state(nxt)
        if before == now:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _classes(docs: DataFrame, keep: list[str], shingle: int, max_bits: int, id_col: str,
             text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows as a written table (``keep``, ``__fp`` and a row number
    ``__row``), and each distinct fingerprint with its first row and the
    smallest fingerprint of its component."""
    fp = fingerprints(F.col(text_col).cast("string"), shingle)
    rows = cut(docs.select(*[F.col(c) for c in keep], fp.alias("__fp"), F.monotonically_increasing_id().alias("__row")), "simhash")
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("__row").alias("row")))
    distinct = cut(rows.groupBy(F.col("__fp").alias("fp")).agg(first.alias("first")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), distinct.count(), max_bits))
    return rows, distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` (signed) and ``component_id``."""
    rows, classes = _classes(docs, [id_col], shingle, max_bits, id_col, text_col)
    classes = cut(classes.select("fp", "root", F.col("first.id").alias("id")), "simhash-classes")
    least = classes.groupBy("root").agg(F.min("id").alias("component_id"))
    found = classes.join(least, "root").select(F.col("fp").alias("__f"), "component_id")
    return rows.join(found, F.col("__fp") == F.col("__f")).select(id_col, F.col("__fp").alias("fp"), "component_id")


def keep_one(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (a row
    with a null id only if no other is there; one row if an id repeats)."""
    rows, classes = _classes(docs, docs.columns, shingle, max_bits, id_col, text_col)
    stay = classes.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("__row"))
    return rows.join(stay, "__row", "left_semi").select(*docs.columns)
