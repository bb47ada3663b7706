"""Overlap of two histories: for each version of a key that refers to another
key, the pieces of its interval during which one version of that other key held.

An account names its customer; the customer has versions of its own. The pieces
of an account's version partition its interval: they begin where it begins and
wherever a version of its customer begins or ends inside it. An as-of join
against the pieces then finds both versions at once.

Plan: no range join. The points where a piece may begin (starts of the left
versions; starts and ends of right versions, once for every left key that ever
referred to their key) are joined as-of with both histories; a piece ends at the
next point of the same left version. Cost and size are linear in the number of
points: left versions, and right versions times the left keys that share them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .asof import as_of_join

_P = "__point"


def _solid(df: DataFrame) -> DataFrame:
    """Versions that hold at some time."""
    return df.filter(F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))


def shared_points(left: DataFrame, right: DataFrame, key: str, ref: str) -> int:
    """Points that :func:`overlap_histories` adds to the left versions; two
    aggregates of key columns."""
    owners = left.select(key, ref).dropna().distinct()
    per_ref = right.groupBy(ref).agg(F.count(F.lit(1)).alias("n"))
    return 2 * int(owners.join(per_ref, ref).agg(F.sum("n")).first()[0] or 0)


def overlap_histories(left: DataFrame, right: DataFrame, key: str, ref: str, *, left_as: str, right_as: str) -> DataFrame:
    """``(key, valid_from, valid_to, left_as, right_as)``: the pieces of every
    left version, as half-open intervals, with the version itself and the right
    version (both as structs; NULL where no right version holds). A NULL
    ``ref`` meets nothing; left rows without a key have no pieces. Versions of
    one key must not overlap (on either side)."""
    left = _solid(left).filter(F.col(key).isNotNull())
    right = _solid(right).filter(F.col(ref).isNotNull())
    owners = left.select(key, ref).dropna().distinct()
    edges = right.select(ref, F.explode(F.array("valid_from", "valid_to")).alias(_P)).filter(F.col(_P).isNotNull())
    points = left.select(key, ref, F.col("valid_from").alias(_P)).unionByName(edges.join(owners, ref).select(key, ref, _P)).distinct()
    with_left = as_of_join(points, left, key, key, _P, as_=left_as)
    # a point of a customer the account has left, or does not have yet, is none
    with_left = with_left.filter(F.col(left_as).isNotNull() & F.col(f"{left_as}.{ref}").eqNullSafe(F.col(ref)))
    both = as_of_join(with_left, right, ref, ref, _P, as_=right_as)
    after = F.lead(_P).over(Window.partitionBy(key, F.col(f"{left_as}.valid_from")).orderBy(_P))
    return both.select(key, F.col(_P).alias("valid_from"), F.coalesce(after, F.col(f"{left_as}.valid_to")).alias("valid_to"),
                       left_as, right_as)
