"""Silver models: one live row per key, built from the bronze change log,
either as a full refresh or incrementally on top of the previous silver table."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import ms_to_ts
from ..operators.latest import (
    AUTO,
    OrderSpec,
    drop_deleted,
    latest_per_key,
    new_rows,
    upsert,
    upsert_newer,
)
from ..schemas import LATEST_ORDER


@dataclass(frozen=True)
class SilverModel:
    name: str
    keys: tuple[str, ...]
    project: Callable[..., DataFrame]


def _tail() -> list[Column]:
    return [F.col("cdc_op"), F.col("ingested_at"), F.col("ingestion_date")]


def _transactions(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "transaction_id", "account_id", F.col("type").alias("transaction_type"), "amount",
        "currency", "exchange_rate", "amount_in_usd", "status", "channel", "country", "city",
        "description", "cdc_op",
        ms_to_ts("created_at").alias("transaction_created_at"),
        ms_to_ts("updated_at").alias("transaction_updated_at"),
        "ingested_at", "ingestion_date", *extra,
    )


def _customers(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "customer_id", "full_name", "email", "phone", "nationality",
        ms_to_ts("created_at").alias("customer_created_at"),
        ms_to_ts("updated_at").alias("customer_updated_at"),
        *_tail(), *extra,
    )


def _accounts(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "account_id", "customer_id", "bank_id", "account_type", "balance", "currency",
        "account_status",
        ms_to_ts("opened_at").alias("account_opened_at"),
        ms_to_ts("updated_at").alias("account_updated_at"),
        *_tail(), *extra,
    )


def _legs(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "leg_id", "transaction_id", "direction", "account_id", "bank_id",
        "external_account_reference", "external_account_name", "amount", "currency",
        *_tail(), *extra,
    )


MODELS = {
    "transactions": SilverModel("silver_transactions", ("transaction_id",), _transactions),
    "customers": SilverModel("silver_customers", ("customer_id",), _customers),
    "accounts": SilverModel("silver_accounts", ("account_id",), _accounts),
    "transaction_legs": SilverModel("silver_transaction_legs", ("leg_id",), _legs),
}


#: Order columns that a silver state keeps beside the silver columns
#: (``ingested_at`` is one of those).
STATE_EXTRA = tuple(c for c in LATEST_ORDER if c != "ingested_at")


def newest_changes(table: str, rows: DataFrame, order_by: OrderSpec = LATEST_ORDER) -> DataFrame:
    """The newest change per key of some bronze rows, deletes included, with
    the silver columns and the order columns."""
    model = MODELS[table]
    return model.project(latest_per_key(rows, list(model.keys), order_by), *STATE_EXTRA)


def newer_of(table: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Merge of a silver state with newest changes: the newer of both per key,
    in whatever order changes arrive. Both hold each key once."""
    keys = list(MODELS[table].keys)
    return lambda state, changes: upsert_newer(state, changes, keys)


def silver_state(table: str, bronze: DataFrame, state: DataFrame | None = None, *, apply_deletes: bool = True,
                 strict_mark: bool = False, lookback: _dt.timedelta | None = None, mark=AUTO) -> DataFrame:
    """The newest change per key of ``bronze`` and an earlier ``state``: a
    silver table that still has its deleted keys (as rows whose op is a delete)
    and the order columns, so that a change which arrives late never wins over
    a newer one, nor over a newer delete. With a state only the bronze rows that
    :func:`new_rows` gives are read. ``apply_deletes=False`` drops deletes
    before the merge, as the original does. Silver is :func:`live` of it."""
    rows, _ = new_rows(bronze, state, strict=strict_mark, lookback=lookback, mark=mark)
    changes = newest_changes(table, rows)
    if not apply_deletes:
        changes = drop_deleted(changes)
    return changes if state is None else newer_of(table)(state, changes)


def live(state: DataFrame) -> DataFrame:
    """Silver of a state: the rows that are not deleted, the silver columns."""
    return drop_deleted(state).drop(*STATE_EXTRA)


def build_silver(table: str, bronze: DataFrame, target: DataFrame | None = None, *,
                 order_by: OrderSpec = LATEST_ORDER, apply_deletes: bool = True,
                 strict_mark: bool = False, mark=AUTO) -> DataFrame:
    """Silver table for one captured table.

    ``target=None`` is a full refresh: latest change per key, deletes removed.
    With a previous ``target`` only bronze rows at or above its high-water mark
    are ranked and merged on the key.

    ``apply_deletes`` (default) lets a newest-change delete remove the target
    row; ``False`` is the original behaviour, where the delete is filtered out
    before the merge and the old row survives until a full refresh.
    ``strict_mark=True`` uses the original ``> mark``. Rows that arrive below
    the mark are not seen: see :func:`silver_state` and the pipeline's change
    source.
    """
    model = MODELS[table]
    keys = list(model.keys)
    rows, _ = new_rows(bronze, target, strict=strict_mark, mark=mark)
    changes = model.project(latest_per_key(rows, keys, order_by))
    if target is None:
        return drop_deleted(changes)
    if not apply_deletes:
        changes = drop_deleted(changes)
    return drop_deleted(upsert(target, changes, keys))


def silver_transactions(bronze: DataFrame, target: DataFrame | None = None, **kw) -> DataFrame:
    return build_silver("transactions", bronze, target, **kw)


def silver_customers(bronze: DataFrame, target: DataFrame | None = None, **kw) -> DataFrame:
    return build_silver("customers", bronze, target, **kw)


def silver_accounts(bronze: DataFrame, target: DataFrame | None = None, **kw) -> DataFrame:
    return build_silver("accounts", bronze, target, **kw)


def silver_transaction_legs(bronze: DataFrame, target: DataFrame | None = None, **kw) -> DataFrame:
    return build_silver("transaction_legs", bronze, target, **kw)
