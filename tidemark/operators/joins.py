"""LEFT OUTER join that fans out to many right rows per key, safe when one key
holds a large share of the right side.

Adaptive execution can split a skewed partition of the *left* side of a left
outer join, but not of the right side: every left row must meet all of its
right rows to know whether it matched. So the right side's hot keys (more than
``max_rows_per_key`` rows; found by a partial aggregate over the key column,
written to the shared scratch folder, and broadcast up to a counted size) are
salted: their right rows are spread over ``n = ceil(rows / max_rows_per_key)``
buckets by a hash of the row (or of ``spread``, columns that tell equal rows
apart), and their left rows are copied to every bucket.
One join on (key, bucket) then puts each bucket in its own task. A copy that
meets no right row in its bucket is dropped (a hot key has right rows, so the
left row still appears with each of its matches exactly once). Cold keys use
bucket 0 and keep plain left-join semantics, including unmatched left rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import settle, small

DEFAULT_MAX_ROWS_PER_KEY = 1_000_000
_SALT, _N, _HIT = "__salt", "__nsalt", "__hit"


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys with more than ``max_rows`` rows and their bucket count."""
    return (df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
              .filter(F.col("__n") > F.lit(max_rows))
              .select(*keys, F.ceil(F.col("__n") / F.lit(max_rows)).cast("int").alias(_N)))


def left_join_fanout(left: DataFrame, right: DataFrame, keys: Sequence[str],
                     max_rows_per_key: int | None = DEFAULT_MAX_ROWS_PER_KEY,
                     spread: Sequence[str] = ()) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` with the right side's hot keys
    salted. ``max_rows_per_key=None`` gives the plain join. ``spread``: columns
    of ``right`` that only choose the bucket and are not returned; without
    them, equal right rows share a bucket."""
    keys = list(keys)
    found = n_hot = None
    if max_rows_per_key:
        found, n_hot = settle(hot_keys(right, keys, max_rows_per_key), "fanout-hot-keys")
    if not n_hot:
        return left.join(right.drop(*spread), on=keys, how="left")
    hot = small(found, n_hot)
    rcols = [c for c in right.columns if c not in keys and c not in spread]
    n = F.coalesce(F.col(_N), F.lit(1))
    # deterministic bucket: a re-run task (lost executor) puts every row in the same bucket again
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in spread or right.columns]), n.cast("long")).cast("int")
    r = (right.join(hot, on=keys, how="left")
              .select(*keys, *rcols, bucket.alias(_SALT), F.lit(True).alias(_HIT)))
    lcols = [c for c in left.columns if c not in keys]
    copies = F.explode(F.sequence(F.lit(0), n - 1))
    lft = left.join(hot, on=keys, how="left").select(
        *keys, *lcols, copies.alias(_SALT), F.col(_N).isNotNull().alias("__hot"))
    j = lft.join(r, on=keys + [_SALT], how="left")
    return (j.filter(~F.col("__hot") | F.col(_HIT).isNotNull())
             .select(*keys, *lcols, *rcols))
