"""Latest state per key, delete filter, high-water mark, incremental slice and
key upsert: the building blocks of the silver layer."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import OP_DELETE
from ..functions.time import max_ts, ts_lit, type_name
from ..schemas import LATEST_ORDER

_RN = "__row_num"

OrderSpec = Sequence[Column | str]


def _newest_first(order_by: OrderSpec) -> list[Column]:
    """Names sort newest first (DESC, NULLS LAST); Columns are used as given."""
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order_by]


def _check_order(df: DataFrame, order_by: OrderSpec) -> None:
    missing = [c for c in order_by if isinstance(c, str) and c not in df.columns]
    if missing:
        raise ValueError(f"no order without the columns {missing}: rows of equal {[c for c in order_by if c not in missing]} have no first")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: OrderSpec = LATEST_ORDER) -> DataFrame:
    """One row per key: the first row in ``order_by`` order (newest first).

    Written as ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ...) = 1``.
    Catalyst turns the rank filter into a partial ``WindowGroupLimit`` before
    the shuffle, so every map task forwards at most one row per key: a key that
    holds a third of all rows costs one row per task in the exchange, not a
    third of the data in one reducer. ``order_by`` must be a total order for a
    deterministic result; the bronze default is ingestion time, then source
    commit time, then source offset. A table without one of the named columns
    is refused.
    """
    _check_order(df, order_by)
    order = _newest_first(order_by)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def drop_replays(df: DataFrame, partition: str = "source_partition", offset: str = "source_offset") -> DataFrame:
    """One row for each source position: a batch delivered twice counts once.
    Rows without a position (backfills) stay as they are."""
    placed = F.col(partition).isNotNull() & F.col(offset).isNotNull()
    return df.filter(placed).dropDuplicates([partition, offset]).unionByName(df.filter(~placed))


def drop_deleted(df: DataFrame, op_col: str = "cdc_op") -> DataFrame:
    """Keep rows whose op is not a delete. Three-valued on purpose: a NULL op
    (tombstone, malformed record) is dropped too."""
    return df.filter(F.col(op_col) != F.lit(OP_DELETE))


def live_rows(df: DataFrame, keys: Sequence[str], order_by: OrderSpec = LATEST_ORDER,
              op_col: str = "cdc_op") -> DataFrame:
    """Latest row per key, then the delete filter (in that order: a key whose
    newest change is a delete disappears)."""
    return drop_deleted(latest_per_key(df, keys, order_by), op_col)


def high_water_mark(target: DataFrame, col: str = "ingested_at"):
    """``MAX(col)`` of the target (its wall clock), or None when the target is
    empty. A one-row aggregate; only the scalar reaches the driver."""
    return max_ts(target, col)


AUTO = object()  # new_rows: take the mark from the target


def new_rows(bronze: DataFrame, target: DataFrame | None, *, col: str = "ingested_at",
             date_col: str | None = "ingestion_date", strict: bool = False,
             lookback: _dt.timedelta | None = None, mark=AUTO):
    """Rows of ``bronze`` not yet reflected in ``target``.

    * no target, or an empty one (NULL mark) -> everything (full load);
    * otherwise rows with ``col >= mark`` (``strict=True``: ``>``, the
      original, which can skip rows that share the mark's timestamp);
    * ``lookback`` lowers the mark for loads that may arrive late.

    The mark is ``MAX(col)`` of the target unless given: a pipeline that
    records the newest ingestion time it processed passes it as ``mark`` and
    never scans the target for it (and a delete-only batch advances it too).
    A mark is a wall clock or, for a zoned column, epoch microseconds, which
    mean the same in every session zone.
    Beside the timestamp predicate a date predicate on the partition column is
    added, so the scan prunes whole ``ingestion_date`` partitions.
    Returns ``(rows, mark)``.
    """
    if target is None:
        return bronze, None
    if mark is AUTO:
        mark = high_water_mark(target, col)
    if mark is None:
        return bronze, None
    if lookback is not None:
        mark = mark - (lookback // _dt.timedelta(microseconds=1) if isinstance(mark, int) else lookback)
    m = F.timestamp_micros(F.lit(mark)) if isinstance(mark, int) else ts_lit(mark, type_name(bronze, col))
    cond = F.col(col) > m if strict else F.col(col) >= m
    if date_col and date_col in bronze.columns:
        # the partition may have been dated in another zone than this session's
        cond = (F.col(date_col) >= F.date_sub(F.to_date(m), 2)) & cond
    return bronze.filter(cond), mark


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge on unique key without MERGE support: every update row replaces the
    target row with its key; target rows without an update stay.

    ``updates ∪ (target ANTI JOIN updates ON keys)``. Only the keys of the
    update side take part in the join, and the join strategy is left to the
    planner (AQE turns it into a broadcast when the incremental slice is small).
    """
    cols = target.columns
    untouched = target.join(updates.select(*keys), on=list(keys), how="left_anti")
    return updates.select(*cols).unionByName(untouched.select(*cols))


def upsert_ordered(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                   order_by: OrderSpec = LATEST_ORDER) -> DataFrame:
    """Upsert in which an update replaces a target row only if it is not older
    (rows that arrive late, or are read again, may be stale). The target must
    hold the order columns, and its deleted keys as rows: else a change older
    than a key's delete would bring the key back."""
    cols = target.columns
    both = target.select(*cols).unionByName(updates.select(*cols))
    return latest_per_key(both, keys, order_by)


def upsert_newer(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """:func:`upsert_ordered` of two sides that hold each key once (a NULL key
    is a key): one join of them instead of ranking their rows, which sorts both
    twice. Of rows that rank alike the update stays."""
    _check_order(target, order_by)
    cols, rank = target.columns, lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order_by])
    t = target.select(*cols, F.lit(True).alias("__has")).alias("t")
    u = updates.select(*cols, F.lit(True).alias("__has")).alias("u")
    on = None
    for k in keys:
        same = F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}"))
        on = same if on is None else on & same
    # structs compare field by field, NULL lowest: the order of the newest first, NULLS LAST
    wins = F.col("t.__has").isNull() | (F.col("u.__has").isNotNull() & (rank("u") >= rank("t")))
    return t.join(u, on, "full_outer").select(*[F.when(wins, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols])
