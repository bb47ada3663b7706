"""As-of (interval) join: each left row finds the version of its key that was
valid at the left row's time, ``valid_from <= ts < valid_to`` (open when
``valid_to`` is NULL), LEFT OUTER.

Plan: no range join. Left rows and versions are unioned, sorted by time within
the key, and every left row takes the last version seen before it
(``last(..., ignorenulls)`` over a running window), then the interval end is
checked. That is one shuffle and one sort, linear in the input, instead of a
per-key nested loop over all versions.

A key that holds a large share of all rows would put all of them in one task,
so keys with more than ``max_rows_per_group`` rows are split into time slices
of about that many rows each. Each slice starts with a *carry* row that holds
the version valid at the slice start; the carry rows come from a per-slice
aggregate and a window over the slices of one key, both small. A slice that
still holds more than ``max_rows_per_group`` left rows (a burst, or rows that
share one timestamp, which time cannot split) spreads them over one hash bucket
per that many counted rows, with the slice's versions copied into each. The
tables of hot keys and of full slices are written to the shared scratch folder
when the join is built, and broadcast only up to a counted size (see
:mod:`tidemark.operators.skew`); without hot keys the plan is the plain scan.
Left rows without a key or a time match nothing and are spread over groups by
a hash.

Precondition: the versions of one key do not overlap (SCD2 histories built by
:mod:`tidemark.operators.scd2` satisfy it). Then the result equals the SQL
``LEFT JOIN ... ON key = key AND ts >= valid_from AND (ts < valid_to OR
valid_to IS NULL)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_us, is_ntz, ts_to_us
from .skew import settle, small

DEFAULT_MAX_ROWS_PER_GROUP = 2_000_000

#: Quantiles that split a crowded slice at a time, and rounds of splitting.
PARTS, ROUNDS = 1000, 4
_T, _KIND, _L, _V, _S, _HOT, _SALT = "__t", "__kind", "__left", "__ver", "__slice", "__hot", "__salt"


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def key_stats(df: DataFrame, keys: Sequence[str], ts: Column) -> DataFrame:
    """Rows per key and their time range (epoch microseconds): ``(keys...,
    __cnt, __lo, __hi)``. A partial aggregate over key and time columns only."""
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("__cnt"), F.min(ts).alias("__lo"), F.max(ts).alias("__hi")))


def hot_key_slices(stats: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Hot keys (more than ``max_rows`` rows) of a :func:`key_stats` table with
    their slicing rule ``(keys..., __lo, __width, __n)``: slice =
    floor((t - lo) / width), ``n`` slices of about ``max_rows`` rows each when
    the key's rows are spread evenly in time.

    At most ``total_rows / max_rows`` keys (500 keys per billion rows at the
    default), each a few dozen bytes. Rows without a key are never hot."""
    hot_stats = stats.filter(F.col("__cnt") > F.lit(max_rows)).dropna(subset=list(keys))
    n = F.ceil(F.col("__cnt") / F.lit(max_rows)).cast("long")
    span = F.col("__hi") - F.col("__lo") + F.lit(1)
    width = F.greatest(F.ceil(span / n), F.lit(1)).cast("long")
    return hot_stats.select(*keys, F.col("__lo"), width.alias("__width"), n.alias("__n"))


def _slice_of(t_col, hot_prefix: str = "") -> F.Column:
    lo, width, n = F.col(f"{hot_prefix}__lo"), F.col(f"{hot_prefix}__width"), F.col(f"{hot_prefix}__n")
    s = F.floor((t_col - lo) / width).cast("long")
    return F.when(lo.isNull(), F.lit(0).cast("long")).otherwise(
        F.least(F.greatest(s, F.lit(0).cast("long")), n - 1))


def as_of_join(left: DataFrame, versions: DataFrame, left_keys: str | Sequence[str],
               right_keys: str | Sequence[str], ts: str, *, as_: str = "v",
               valid_from: str = "valid_from", valid_to: str = "valid_to",
               max_rows_per_group: int | None = DEFAULT_MAX_ROWS_PER_GROUP,
               stats: DataFrame | None = None) -> DataFrame:
    """Left rows plus one struct column ``as_`` holding the matching version
    (all its columns), NULL when no version of the key covers ``ts``.
    NULL keys and NULL times never match, as in SQL.

    ``stats`` may supply per-key row counts and time ranges (columns named
    like ``right_keys`` plus ``__cnt``, ``__lo``, ``__hi`` in epoch
    microseconds, see :func:`key_stats`) when the caller can derive them more
    cheaply than an extra pass over ``left`` (e.g. when ``left`` is itself a
    join result). An over-estimate is harmless: it only splits a key that did
    not need it. ``max_rows_per_group=None`` disables splitting."""
    lk, rk = _as_list(left_keys), _as_list(right_keys)
    kn = [f"__k{i}" for i in range(len(lk))]
    lcols, vcols = left.columns, versions.columns

    # left rows carry their row in __left, versions theirs in __ver; the
    # union fills the other payload with a typed NULL
    lpart = left.select(
        *[F.col(a).alias(b) for a, b in zip(lk, kn)],
        epoch_us(left, ts).alias(_T), F.lit(1).alias(_KIND), F.struct(*lcols).alias(_L))
    # a version that holds at no time would only hide the one that does
    valid = F.col(valid_from).isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from)))
    for k in rk:
        valid = valid & F.col(k).isNotNull()
    vpart = versions.filter(valid).select(
        *[F.col(a).alias(b) for a, b in zip(rk, kn)],
        epoch_us(versions, valid_from).alias(_T), F.lit(0).alias(_KIND), F.struct(*vcols).alias(_V))
    end_ntz = is_ntz(versions, valid_to)
    u = lpart.unionByName(vpart, allowMissingColumns=True)

    if max_rows_per_group:
        if stats is None:
            st = key_stats(u, kn, F.col(_T))
        else:
            st = stats.select(*[F.col(a).alias(b) for a, b in zip(rk, kn)], "__cnt", "__lo", "__hi")
        hot, n_hot = settle(hot_key_slices(st, kn, max_rows_per_group), "asof-hot-keys")
    else:
        n_hot = 0
    if n_hot:
        u = u.join(small(hot, n_hot), on=kn, how="left").select(
            *kn, _T, _KIND, _L, _V, _slice_of(F.col(_T)).alias(_S), F.col("__lo").isNotNull().alias(_HOT))
        grid = hot.select(*kn, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)).alias(_S))
        for _ in range(ROUNDS):
            crowded, n_crowded = settle(_crowded_slices(u, kn, max_rows_per_group), "asof-crowded-slices")
            if not n_crowded:
                break
            u = _split_by_rank(u, crowded, n_crowded, kn)
            grid = u.filter(F.col(_HOT)).select(*kn, _S).distinct()
        full, n_full = settle(_full_slices(u, kn, max_rows_per_group), "asof-full-slices")
        carry = _carry_rows(u, grid, kn, valid_to, end_ntz)
        u = u.drop(_HOT).unionByName(carry, allowMissingColumns=True)
        u = _salt(u, full, n_full, kn) if n_full else u.withColumn(_SALT, F.lit(0))
    else:
        u = u.withColumn(_S, F.lit(0).cast("long")).withColumn(_SALT, F.lit(0))

    # left rows without a key or a time match nothing: each goes to a group of
    # few by a hash of the row, so that they don't all meet in one group
    lost = F.col(_T).isNull()
    for k in kn:
        lost = lost | F.col(k).isNull()
    u = u.withColumn(_S, F.when((F.col(_KIND) == 1) & lost, F.pmod(F.xxhash64(F.col(_L)), F.lit(1 << 20))).otherwise(F.col(_S)))

    vt_end = ts_to_us(F.col(f"{_V}.{valid_to}"), end_ntz)
    w = (Window.partitionBy(*kn, _S, _SALT)
               .orderBy(F.col(_T).asc_nulls_first(), F.col(_KIND), vt_end.asc_nulls_last())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    m = F.last(F.col(_V), ignorenulls=True).over(w)
    scanned = u.select(_T, _KIND, _L, *kn, m.alias("__m"))
    rows = scanned.filter(F.col(_KIND) == 1)
    keys_ok = F.lit(True)
    for k in kn:
        keys_ok = keys_ok & F.col(k).isNotNull()
    end_ok = F.col(f"__m.{valid_to}").isNull() | (F.col(_T) < ts_to_us(F.col(f"__m.{valid_to}"), end_ntz))
    ok = keys_ok & F.col(_T).isNotNull() & F.col("__m").isNotNull() & end_ok
    return rows.select(*[F.col(f"{_L}.{c}").alias(c) for c in lcols],
                       F.when(ok, F.col("__m")).alias(as_))


def _crowded_slices(u: DataFrame, kn: list[str], max_rows: int) -> DataFrame:
    """Slices of hot keys with more than ``max_rows`` versions, and the times
    that split them into parts of about that many: ``(keys..., __slice,
    __bounds)``. At most ``PARTS`` numbers per slice; starts of versions of one
    key differ, so every split makes parts smaller."""
    probs = [i / PARTS for i in range(1, PARTS)]
    found = (u.filter(F.col(_HOT) & (F.col(_KIND) == 0)).groupBy(*kn, _S)
              .agg(F.count(F.lit(1)).alias("__cnt"), F.min(_T).alias("__first"), F.percentile_approx(_T, probs, 10 * PARTS).alias("__q"))
              .filter(F.col("__cnt") > F.lit(max_rows)))
    parts = F.least(F.ceil(F.col("__cnt") / F.lit(max_rows)), F.lit(PARTS)).cast("int")
    bounds = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.element_at("__q", F.greatest(F.floor(i * PARTS / parts), F.lit(1)).cast("int")))
    return (found.select(*kn, _S, F.filter(F.array_distinct(bounds), lambda x: x > F.col("__first")).alias("__bounds"))
                 .filter(F.size("__bounds") > 0))


def _split_by_rank(u: DataFrame, crowded: DataFrame, n_crowded: int, kn: list[str]) -> DataFrame:
    """Every row of a crowded slice in its part; slices keep their order."""
    u = u.join(small(crowded, n_crowded), on=kn + [_S], how="left")
    part = F.coalesce(F.size(F.filter("__bounds", lambda x: x <= F.col(_T))), F.lit(0))
    part = F.when(F.col("__bounds").isNull(), F.lit(0)).otherwise(part)
    return u.withColumn(_S, F.col(_S) * F.lit(1024).cast("long") + part).drop("__bounds")


def _carry_rows(u: DataFrame, grid: DataFrame, kn: list[str], valid_to: str, end_ntz: bool) -> DataFrame:
    """For every slice of ``grid`` after the first of a hot key: the newest
    version that started in an earlier slice, as a row sorting before the
    slice's rows. "Newest" is the scan's own order: start, then end (open last).
    Only versions of hot keys take part; the window runs over the slices of one
    key (about ``rows / max_rows_per_group`` of them)."""
    end = F.coalesce(ts_to_us(F.col(f"{_V}.{valid_to}"), end_ntz), F.lit(2**63 - 1))
    per_slice = (u.filter((F.col(_KIND) == 0) & F.col(_HOT))
                  .groupBy(*kn, _S)
                  .agg(F.max_by(F.col(_V), F.struct(F.col(_T), end)).alias("__last")))
    w = Window.partitionBy(*kn).orderBy(_S).rowsBetween(Window.unboundedPreceding, -1)
    carried = (grid.join(per_slice, on=kn + [_S], how="left")
                   .select(*kn, _S, F.last("__last", ignorenulls=True).over(w).alias(_V)))
    return carried.filter(F.col(_V).isNotNull()).select(
        *kn, F.lit(None).cast("long").alias(_T), F.lit(-1).alias(_KIND), _V, _S)


def _full_slices(u: DataFrame, kn: list[str], max_rows: int) -> DataFrame:
    """Slices of hot keys with more than ``max_rows`` left rows, and the buckets
    that many rows need: ``(keys..., __slice, __nsalt)``."""
    return (u.filter(F.col(_HOT) & (F.col(_KIND) == 1)).groupBy(*kn, _S).agg(F.count(F.lit(1)).alias("__cnt"))
             .filter(F.col("__cnt") > F.lit(max_rows))
             .select(*kn, _S, F.ceil(F.col("__cnt") / F.lit(max_rows)).cast("int").alias("__nsalt")))


def _salt(u: DataFrame, full: DataFrame, n_full: int, kn: list[str]) -> DataFrame:
    """Spread the left rows of full slices over ``__nsalt`` buckets by a hash of
    the row (deterministic, so a re-run task buckets alike) and copy the
    slice's versions and carry row into every bucket: each left row is in
    exactly one group, together with every version it can match. Versions of
    full slices are copied ``__nsalt`` times; left rows are not copied."""
    u = u.join(small(full, n_full), on=kn + [_S], how="left")
    m = F.coalesce(F.col("__nsalt"), F.lit(1))
    left_bucket = F.pmod(F.xxhash64(F.col(_L)), m.cast("long")).cast("int")
    bucket = F.when(F.col(_KIND) == 1, F.array(left_bucket)).otherwise(F.sequence(F.lit(0), m - 1))
    return u.select(*[c for c in u.columns if c != "__nsalt"], F.explode(bucket).alias(_SALT))
