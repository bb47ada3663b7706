"""Adapters that reshape the shared test tables into the pipeline's inputs.

The source system ships no data, so its change logs are derived from the test
parquet: ``events`` plays the account, customer and transaction change log,
``lineitem`` the transaction legs (its (orderkey, linenumber) pairs repeat,
which gives the latest-per-key logic real work) and ``supplier``/``nation`` the
banks. Every derived change log grows with the source table it reads;
customers (and the banks that accounts name) are a fixed number of keys.

The same shapes are written as SQL in :mod:`tidemark.plans.oracle`, so each
query can be checked against an independent engine.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import data_dir
from ..functions.time import ts_lit, type_name

MONTH_MS = 30 * 24 * 3600 * 1000
BANKS_LOADED_AT = _dt.datetime(2024, 1, 1)
# Cut points used by the incremental and snapshot queries.
CUT_1 = _dt.datetime(2024, 1, 15)
CUT_2 = _dt.datetime(2024, 1, 29)
SNAPSHOT_CUT = _dt.datetime(2024, 1, 16)
CHECK_RUN_1 = _dt.datetime(2024, 1, 16)
CHECK_RUN_2 = _dt.datetime(2024, 2, 1)


_READS: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared test table; the DataFrame is reused per session and path
    (the session is kept with it, so a reused id cannot match another one)."""
    path = data_dir(sf_dir, name)
    key = (id(spark), path)
    hit = _READS.get(key)
    if hit is None or hit[0] is not spark:
        hit = _READS[key] = (spark, spark.read.parquet(path))
    return hit[1]


MS = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})"  # UTC wall clock, any session zone


def _ms(c: str) -> str:
    return MS.format(c=c)


def _op_of_event(view_op: str | None = "u") -> str:
    """signup -> create, error -> delete, others -> update; ``view_op`` sets
    the op of 'view' events (None: an unreadable record, 'r': a snapshot read)."""
    view = "" if view_op == "u" else (
        "WHEN 'view' THEN CAST(NULL AS STRING) " if view_op is None else f"WHEN 'view' THEN '{view_op}' ")
    return f"CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' {view}ELSE 'u' END"


def _position(ts: str, offset: str) -> list[str]:
    return [
        f"{ts} AS ingested_at",
        f"CAST({ts} AS DATE) AS ingestion_date",
        f"{_ms(ts)} AS source_ts_ms",
        "CAST(NULL AS INT) AS source_partition",
        f"{offset} AS source_offset",
    ]


def _extra(extra: tuple[str, ...]) -> list[str]:
    return [f"{c} AS ev_{c}" for c in extra]


def bronze_accounts(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Account change log: one change per event of the user. ``extra`` event
    columns are carried along (used by the message renderer)."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS INT) AS account_id",
        "CAST(user_id % 50 AS INT) AS customer_id",
        "CAST(user_id % 10 AS INT) AS bank_id",
        "event_type AS account_type",
        "value AS balance",
        "CASE WHEN user_id % 3 = 0 THEN 'GBP' WHEN user_id % 3 = 1 THEN 'EUR' ELSE 'USD' END AS currency",
        "CASE WHEN event_type = 'error' THEN 'frozen' WHEN event_type = 'view' THEN 'dormant' "
        "ELSE 'active' END AS account_status",
        f"{_ms('ts')} - {MONTH_MS} AS opened_at",
        f"{_ms('ts')} AS updated_at",
        f"{_op_of_event()} AS cdc_op",
        *_position("ts", "event_id"),
        *_extra(extra),
    )


def bronze_customers(spark: SparkSession, sf_dir: str, view_op: str | None = "u", extra: tuple[str, ...] = ()) -> DataFrame:
    """Customer change log: customer = user_id % 50."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id % 50 AS INT) AS customer_id",
        "concat('cust-', CAST(user_id % 50 AS STRING)) AS full_name",
        "concat('u', CAST(user_id AS STRING), '@mail.test') AS email",
        "CASE WHEN event_type = 'click' THEN CAST(NULL AS STRING) "
        "ELSE concat('+44-', CAST(user_id AS STRING)) END AS phone",
        "concat('nation-', CAST(user_id % 25 AS STRING)) AS nationality",
        f"{_ms('ts')} - {MONTH_MS} AS created_at",
        f"{_ms('ts')} AS updated_at",
        f"{_op_of_event(view_op)} AS cdc_op",
        *_position("ts", "event_id"),
        *_extra(extra),
    )


def bronze_transactions(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Transaction change log: purchase events, one create each. The ATM
    channel books the amount unconverted: a planted rule violation."""
    return table(spark, sf_dir, "events").filter("event_type = 'purchase'").selectExpr(
        "CAST(event_id AS INT) AS transaction_id",
        "CAST(user_id AS INT) AS account_id",
        "CASE WHEN event_id % 3 = 0 THEN 'deposit' WHEN event_id % 3 = 1 THEN 'withdrawal' "
        "ELSE 'transfer' END AS type",
        "value AS amount",
        "'GBP' AS currency",
        "CAST(1.27 AS DOUBLE) AS exchange_rate",
        "CASE WHEN event_id % 5 = 2 THEN value ELSE value * CAST(1.27 AS DOUBLE) END AS amount_in_usd",
        "CASE WHEN event_id % 10 = 0 THEN 'failed' WHEN event_id % 10 < 3 THEN 'pending' "
        "ELSE 'completed' END AS status",
        "CASE WHEN event_id % 5 = 0 THEN 'online' WHEN event_id % 5 = 1 THEN 'mobile' "
        "WHEN event_id % 5 = 2 THEN 'atm' WHEN event_id % 5 = 3 THEN 'branch' ELSE 'card' END AS channel",
        "'United Kingdom' AS country",
        "concat('city-', CAST(user_id % 7 AS STRING)) AS city",
        "props AS description",
        f"{_ms('ts')} AS created_at",
        f"{_ms('ts')} AS updated_at",
        "'c' AS cdc_op",
        *_position("ts", "event_id"),
        *_extra(extra),
    )


# lineitem has no unique row id, but (shipdate, partkey, suppkey, extendedprice)
# has no ties at any scale; the source position columns encode the last three,
# so the standard bronze order (ingested_at, source_ts_ms, source_offset) is total.


def bronze_transaction_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leg change log from lineitem: leg = (orderkey, linenumber); status F is
    the debit leg, others the credit leg; return flag R marks a delete."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey * 8 + l_linenumber AS INT) AS leg_id",
        "CAST(l_orderkey AS INT) AS transaction_id",
        "CASE WHEN l_linestatus = 'F' THEN 'debit' ELSE 'credit' END AS direction",
        "CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey AS INT) END AS account_id",
        "CAST(l_suppkey AS INT) AS bank_id",
        "CASE WHEN l_linestatus <> 'F' THEN concat('GB', CAST(l_partkey AS STRING)) END AS external_account_reference",
        "CASE WHEN l_linestatus <> 'F' THEN concat('name-', CAST(l_suppkey AS STRING)) END AS external_account_name",
        "l_extendedprice AS amount",
        "'GBP' AS currency",
        "CASE WHEN l_returnflag = 'R' THEN 'd' WHEN l_returnflag = 'A' THEN 'u' ELSE 'c' END AS cdc_op",
        "l_shipdate AS ingested_at",
        "CAST(l_shipdate AS DATE) AS ingestion_date",
        "l_partkey AS source_ts_ms",
        "CAST(NULL AS INT) AS source_partition",
        "l_suppkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS source_offset",
    )


def bronze_banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank change log from supplier + nation; a negative balance marks a
    deleted bank. nation is a fixed 25-row table, so it is broadcast."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    at = "CAST(TIMESTAMP_NTZ '2024-01-01 00:00:00' AS TIMESTAMP_NTZ)"
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "inner").selectExpr(
        "CAST(s_suppkey AS INT) AS bank_id",
        "s_name AS bank_name",
        "n_name AS country",
        "concat('SW', CAST(s_suppkey AS STRING)) AS swift_code",
        "CASE WHEN s_acctbal < 0 THEN 'd' ELSE 'c' END AS cdc_op",
        f"{at} AS ingested_at",
        f"CAST({at} AS DATE) AS ingestion_date",
        "CAST(NULL AS BIGINT) AS source_ts_ms",
        "CAST(NULL AS INT) AS source_partition",
        "s_suppkey AS source_offset",
    )


def before(df: DataFrame, cut: _dt.datetime, col: str = "ingested_at") -> DataFrame:
    return df.filter(F.col(col) < ts_lit(cut, type_name(df, col)))


def accounts_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account versions: every non-purchase change opens a version that lasts
    until the account's next change."""
    from ..operators.scd2 import history_from_changes
    from .silver import MODELS
    b = bronze_accounts(spark, sf_dir).filter("account_type <> 'purchase'")
    changes = MODELS["accounts"].project(b).select(*SNAPSHOT_COLS["accounts"], "ingested_at")
    return history_from_changes(changes, ["account_id"], "account_updated_at", ["ingested_at"]).drop("ingested_at")


def customers_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer versions: every change but a delete opens a version."""
    from ..operators.scd2 import history_from_changes
    from .silver import MODELS
    b = bronze_customers(spark, sf_dir).filter("cdc_op <> 'd'")
    changes = MODELS["customers"].project(b).select(*SNAPSHOT_COLS["customers"], "ingested_at")
    return history_from_changes(changes, ["customer_id"], "customer_updated_at", ["ingested_at"]).drop("ingested_at")


# Columns each snapshot keeps of its silver table.
SNAPSHOT_COLS = {
    "accounts": ["account_id", "customer_id", "bank_id", "account_type", "balance", "currency",
                 "account_opened_at", "account_updated_at"],
    "customers": ["customer_id", "full_name", "email", "phone", "nationality",
                  "customer_created_at", "customer_updated_at"],
}


# --- change messages rendered from the events table --------------------------

STREAM_TABLES = ("accounts", "transactions")
TRUNCATED_PROPS = '{"k": 13}'   # these account messages lose their tail
WRONG_TYPE_PROPS = '{"k": 42}'  # these carry a text balance


def _message_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Bronze change rows of ``table`` with the stream position of their
    messages: ``__partition``, ``__offset``, ``__at``, and ``__props``."""
    extra = ("user_id", "props", "event_type", "ts")
    if table == "accounts":
        r = bronze_accounts(spark, sf_dir, extra).filter("ev_event_type <> 'purchase'")
    elif table == "customers":
        r = bronze_customers(spark, sf_dir, extra=extra)
    elif table == "transactions":
        r = bronze_transactions(spark, sf_dir, extra)
    elif table == "transaction_legs":
        r = bronze_transaction_legs(spark, sf_dir)
        return r.withColumns({"__partition": (F.col("transaction_id") % 4).cast("int"), "__offset": F.col("source_offset") * 2,
                              "__at": F.col("ingested_at").cast("timestamp"), "__props": F.lit(None).cast("string")})
    else:
        r = bronze_banks(spark, sf_dir)
        return r.withColumns({"__partition": F.lit(0), "__offset": F.col("source_offset").cast("long") * 2,
                              "__at": F.col("ingested_at").cast("timestamp"), "__props": F.lit(None).cast("string")})
    return r.withColumns({"__partition": (F.col("ev_user_id") % 4).cast("int"), "__offset": F.col("source_offset") * 2,
                          "__at": F.col("ev_ts").cast("timestamp"), "__props": F.col("ev_props")})


def change_messages(spark: SparkSession, sf_dir: str, *, corrupt: bool = False,
                    envelope: bool = False, tables: tuple[str, ...] = STREAM_TABLES) -> DataFrame:
    """Stream-shaped rows (topic, partition, offset, timestamp, value) for the
    topics of ``tables`` (default: accounts, from non-purchase events, and
    transactions, from purchase events). Each message is the flattened change
    record as JSON (or the unflattened envelope); every account delete is
    followed by a tombstone (NULL value). Offsets: twice the change's, and one
    more for its tombstone. ``corrupt`` truncates some account messages and
    mistypes a field in others.
    """
    from ..config import topic_of
    from ..schemas import ROW_FIELDS
    parts = []
    for t in tables:
        r = _message_rows(spark, sf_dir, t)
        row = F.struct(*[F.col(n) for n, _ in ROW_FIELDS[t]])
        if envelope:
            is_del = F.col("cdc_op") == "d"
            body = F.struct(
                F.when(is_del, row).alias("before"),
                F.when(~is_del, row).alias("after"),
                F.col("cdc_op").alias("op"),
                F.struct(F.lit(t).alias("table"), F.col("source_ts_ms").alias("ts_ms")).alias("source"),
                F.col("source_ts_ms").alias("ts_ms"))
        else:
            body = F.struct(*[F.col(n) for n, _ in ROW_FIELDS[t]],
                            F.col("cdc_op").alias("__op"), F.lit(t).alias("__table"),
                            F.col("source_ts_ms").alias("__source_ts_ms"))
        r = r.withColumn("__text", F.to_json(body))
        text = F.col("__text")
        if corrupt and t == "accounts":
            text = (F.when(F.col("__props") == TRUNCATED_PROPS,
                           F.expr("substring(__text, 1, length(__text) - 5)"))
                     .when(F.col("__props") == WRONG_TYPE_PROPS,
                           F.regexp_replace(text, r'"balance":[^,}]*', '"balance":"n/a"'))
                     .otherwise(text))
        msg = r.select(
            F.lit(topic_of(t)).alias("topic"),
            F.col("__partition").alias("partition"),
            F.col("__offset").alias("offset"),
            F.col("__at").alias("timestamp"),
            text.cast("binary").alias("value"),
            F.col("cdc_op"))
        if t == "accounts":
            tomb = msg.filter(F.col("cdc_op") == "d").select(
                "topic", "partition", (F.col("offset") + 1).alias("offset"), "timestamp",
                F.lit(None).cast("binary").alias("value"), "cdc_op")
            msg = msg.unionByName(tomb)
        parts.append(msg.drop("cdc_op"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
