"""Slowly changing history (type 2): timestamp and column-check strategies.

A history table holds the snapshotted columns plus ``scd_id``,
``scd_updated_at``, ``valid_from`` and ``valid_to``; the interval is half open,
``[valid_from, valid_to)``, and a NULL ``valid_to`` marks the open version.
Every key has at most one open version.

A snapshot run joins the *open* versions with the current rows on the key
(both sides have one row per key, so the join cannot skew) and emits, per key,
at most two rows: the open version (closed when the key changed) and the new
version. Closed versions never change again: ``snapshot_*_open`` reads and
returns only the open set plus what the run closed (stored by run in
:class:`tidemark.sources.tables.HistoryTable`), and the whole-history
``snapshot_timestamp`` / ``snapshot_check`` pass closed versions through
without a shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_us, ts_lit, ts_to_us

SCD_COLS = ["scd_id", "scd_updated_at", "valid_from", "valid_to"]
_O, _C = "__open", "__cur"


def _scd_id(keys: Sequence[str | Column], at: Column) -> Column:
    """md5 of the key values and the version start (epoch microseconds of its
    wall clock, independent of the session zone)."""
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts, ts_to_us(at.cast("timestamp_ntz")).cast("string")))


def _version(df: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    return df.select(
        *df.columns,
        _scd_id(keys, at).alias("scd_id"),
        at.alias("scd_updated_at"),
        at.alias("valid_from"),
        F.lit(None).cast(_type_of(df, at)).alias("valid_to"),
    )


def _type_of(df: DataFrame, c: Column) -> str:
    return df.select(c.alias("x")).schema["x"].dataType.simpleString()


def current(history: DataFrame) -> DataFrame:
    """Open versions only (the current state of every key)."""
    return history.filter(F.col("valid_to").isNull())


def _filter_ops(df: DataFrame, ops: Sequence[str] | None, op_col: str) -> DataFrame:
    if ops is None:
        return df
    return df.filter(F.col(op_col).isin(list(ops)))


def _advance(open_: DataFrame, cur: DataFrame, keys: Sequence[str], changed: Column,
             new_from: Column, close_at: Column, hard_delete_at: Column | None) -> DataFrame:
    """Open versions after one run: per key the open version (closed when the
    key changed) and the new version. ``changed``/``new_from``/``close_at``
    are written over the struct columns ``__open`` and ``__cur`` of the
    joined row. Reads only open versions, so a run costs O(keys), not
    O(history)."""
    cols = list(open_.columns)
    data_cols = [c for c in cols if c not in SCD_COLS]
    o = open_.select(*[F.col(k) for k in keys], F.struct(*cols).alias(_O))
    c = cur.select(*[F.col(k) for k in keys], F.struct(*data_cols).alias(_C))
    j = o.join(c, on=list(keys), how="full_outer")

    has_o, has_c = F.col(_O).isNotNull(), F.col(_C).isNotNull()
    is_changed = has_o & has_c & changed
    if hard_delete_at is not None:
        end = (F.when(is_changed, close_at)
                .when(has_o & ~has_c, hard_delete_at)
                .otherwise(F.col(f"{_O}.valid_to")))
    else:
        end = F.when(is_changed, close_at).otherwise(F.col(f"{_O}.valid_to"))
    old_row = F.struct(*[F.col(f"{_O}.{n}").alias(n) for n in data_cols],
                       F.col(f"{_O}.scd_id").alias("scd_id"),
                       F.col(f"{_O}.scd_updated_at").alias("scd_updated_at"),
                       F.col(f"{_O}.valid_from").alias("valid_from"),
                       end.alias("valid_to"))
    key_cols = [F.col(f"{_C}.{k}") for k in keys]
    new_row = F.struct(*[F.col(f"{_C}.{n}").alias(n) for n in data_cols],
                       _scd_id(key_cols, new_from).alias("scd_id"),
                       new_from.alias("scd_updated_at"),
                       new_from.alias("valid_from"),
                       F.lit(None).cast(open_.schema["valid_to"].dataType).alias("valid_to"))
    emit_new = has_c & (~has_o | changed)
    rows = F.array(F.when(has_o, old_row), F.when(emit_new, new_row))
    out = j.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("__r")).select("__r.*")
    return out.select(*cols)


def _split(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    return history.filter(F.col("valid_to").isNotNull()), history.filter(F.col("valid_to").isNull())


def snapshot_timestamp(history: DataFrame | None, cur: DataFrame, keys: Sequence[str],
                       updated_at: str, *, ops: Sequence[str] | None = None, op_col: str = "cdc_op",
                       invalidate_hard_deletes: bool = False,
                       run_at: _dt.datetime | None = None) -> DataFrame:
    """Timestamp strategy over a whole history: a key gets a new version when
    its ``updated_at`` is later than the open version's ``valid_from``; the old
    version is closed at the new ``updated_at``. Equal or older rows change
    nothing; keys missing from ``cur`` stay open unless
    ``invalidate_hard_deletes`` (closed at ``run_at``). ``ops`` restricts the
    input to those change operations. The first run (``history=None``) opens
    one version per key at its ``updated_at``. Closed versions pass through
    without a shuffle."""
    if history is None:
        return first_snapshot(cur, keys, F.col(updated_at), ops=ops, op_col=op_col)
    closed, open_ = _split(history)
    step = snapshot_timestamp_open(open_, cur, keys, updated_at, ops=ops, op_col=op_col,
                                   invalidate_hard_deletes=invalidate_hard_deletes, run_at=run_at)
    return closed.unionByName(step)


def snapshot_check(history: DataFrame | None, cur: DataFrame, keys: Sequence[str],
                   check_cols: Sequence[str], run_at: _dt.datetime, *,
                   ops: Sequence[str] | None = None, op_col: str = "cdc_op",
                   invalidate_hard_deletes: bool = False) -> DataFrame:
    """Check strategy over a whole history: a key gets a new version when any
    of ``check_cols`` differs from the open version, NULL-safe (NULL -> value
    and value -> NULL are changes). Versions open and close at ``run_at``."""
    if history is None:
        return first_snapshot(cur, keys, ts_lit(run_at), ops=ops, op_col=op_col)
    closed, open_ = _split(history)
    step = snapshot_check_open(open_, cur, keys, check_cols, run_at, ops=ops, op_col=op_col,
                               invalidate_hard_deletes=invalidate_hard_deletes)
    return closed.unionByName(step)


def snapshot_timestamp_open(open_: DataFrame, cur: DataFrame, keys: Sequence[str], updated_at: str, *,
                            ops: Sequence[str] | None = None, op_col: str = "cdc_op",
                            invalidate_hard_deletes: bool = False,
                            run_at: _dt.datetime | None = None) -> DataFrame:
    """One timestamp-strategy run over the *open* versions only; returns the
    advanced rows (versions closed by this run have ``valid_to`` set, the rest
    are open). Closed history is untouched and need not be read."""
    cur = _filter_ops(cur, ops, op_col)
    if op_col in cur.columns and op_col not in open_.columns:
        cur = cur.drop(op_col)
    new_at = F.col(f"{_C}.{updated_at}")
    changed = new_at > F.col(f"{_O}.valid_from")
    hd = ts_lit(run_at, open_.schema["valid_to"].dataType.simpleString()) if invalidate_hard_deletes else None
    return _advance(open_, cur, keys, changed, new_at, new_at, hd)


def snapshot_check_open(open_: DataFrame, cur: DataFrame, keys: Sequence[str],
                        check_cols: Sequence[str], run_at: _dt.datetime, *,
                        ops: Sequence[str] | None = None, op_col: str = "cdc_op",
                        invalidate_hard_deletes: bool = False) -> DataFrame:
    """One check-strategy run over the *open* versions only (see
    :func:`snapshot_timestamp_open`)."""
    cur = _filter_ops(cur, ops, op_col)
    if op_col in cur.columns and op_col not in open_.columns:
        cur = cur.drop(op_col)
    at = ts_lit(run_at)
    changed = F.lit(False)
    for c in check_cols:
        changed = changed | ~F.col(f"{_O}.{c}").eqNullSafe(F.col(f"{_C}.{c}"))
    return _advance(open_, cur, keys, changed, at, at, at if invalidate_hard_deletes else None)


def first_snapshot(cur: DataFrame, keys: Sequence[str], at: Column, *,
                   ops: Sequence[str] | None = None, op_col: str = "cdc_op") -> DataFrame:
    """First run of either strategy: one open version per key starting at ``at``."""
    cur = _filter_ops(cur, ops, op_col)
    if op_col in cur.columns:
        cur = cur.drop(op_col)
    return _version(cur, keys, at)


def history_from_changes(changes: DataFrame, keys: Sequence[str], updated_at: str,
                         tiebreak: Sequence[str] = (),
                         max_rows_per_group: int | None = 2_000_000) -> DataFrame:
    """Full history in one pass over a change log: every change opens a version
    that lasts until the key's next change (``lead`` over the key in
    ``updated_at`` order). Equivalent to running the timestamp snapshot after
    every change.

    Keys with more than ``max_rows_per_group`` changes are cut into time slices
    (see :mod:`tidemark.operators.asof`): ``lead`` runs per slice, and the last
    change of a slice ends where the key's next non-empty slice starts (a
    per-slice minimum and a window over the slices of one key, both small)."""
    from .asof import _slice_of, hot_key_slices, key_stats
    from .skew import settle, small

    at = F.col(updated_at)
    order = [at] + [F.col(c) for c in tiebreak]
    base = changes.select(
        *changes.columns,
        _scd_id(keys, at).alias("scd_id"),
        at.alias("scd_updated_at"),
        at.alias("valid_from"))
    t_us = epoch_us(changes, updated_at)
    n_hot = 0
    if max_rows_per_group:
        hot, n_hot = settle(hot_key_slices(key_stats(changes, keys, t_us), keys, max_rows_per_group), "history-hot-keys")
    if not n_hot:
        w = Window.partitionBy(*keys).orderBy(*order)
        return base.withColumn("valid_to", F.lead(at).over(w))
    sliced = base.join(small(hot, n_hot), on=list(keys), how="left").select(
        *base.columns, _slice_of(t_us).alias("__slice"), F.col("__lo").isNotNull().alias("__hot"))
    # where each slice of a hot key ends: the start of the key's next non-empty slice
    starts = (sliced.filter("__hot").groupBy(*keys, "__slice").agg(F.min(updated_at).alias("__start")))
    ws = Window.partitionBy(*keys).orderBy("__slice")
    ends, n_ends = settle(starts.select(*keys, "__slice", F.lead("__start").over(ws).alias("__next")), "history-slice-ends")
    w = Window.partitionBy(*keys, "__slice").orderBy(*order)
    with_lead = sliced.withColumn("__lead", F.lead(at).over(w))
    joined = with_lead.join(small(ends, n_ends), on=list(keys) + ["__slice"], how="left")
    return joined.select(*base.columns, F.coalesce("__lead", "__next").alias("valid_to"))
