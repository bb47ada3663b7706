"""Declared schemas of the change records and of the bronze tables.

Schemas are fixed and hand-declared, never inferred: unknown JSON fields are
dropped and missing ones become NULL when a record is parsed against them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Metadata the connector adds to every flattened change record.
META_FIELDS = [
    StructField("__op", StringType()),
    StructField("__table", StringType()),
    StructField("__source_ts_ms", LongType()),
]


def _record(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t) for n, t in fields] + META_FIELDS)


# --- fixed values: row columns of the five captured tables ------------------
ROW_FIELDS = {
    "transactions": [
        ("transaction_id", IntegerType()),
        ("account_id", IntegerType()),
        ("type", StringType()),
        ("amount", DoubleType()),
        ("currency", StringType()),
        ("exchange_rate", DoubleType()),
        ("amount_in_usd", DoubleType()),
        ("status", StringType()),
        ("channel", StringType()),
        ("country", StringType()),
        ("city", StringType()),
        ("description", StringType()),
        ("created_at", LongType()),
        ("updated_at", LongType()),
    ],
    "customers": [
        ("customer_id", IntegerType()),
        ("full_name", StringType()),
        ("email", StringType()),
        ("phone", StringType()),
        ("nationality", StringType()),
        ("created_at", LongType()),
        ("updated_at", LongType()),
    ],
    "accounts": [
        ("account_id", IntegerType()),
        ("customer_id", IntegerType()),
        ("bank_id", IntegerType()),
        ("account_type", StringType()),
        ("balance", DoubleType()),
        ("currency", StringType()),
        ("account_status", StringType()),
        ("opened_at", LongType()),
        ("updated_at", LongType()),
    ],
    "transaction_legs": [
        ("leg_id", IntegerType()),
        ("transaction_id", IntegerType()),
        ("direction", StringType()),
        ("account_id", IntegerType()),
        ("bank_id", IntegerType()),
        ("external_account_reference", StringType()),
        ("external_account_name", StringType()),
        ("amount", DoubleType()),
        ("currency", StringType()),
    ],
    "banks": [
        ("bank_id", IntegerType()),
        ("bank_name", StringType()),
        ("country", StringType()),
        ("swift_code", StringType()),
    ],
}

# --- end of fixed values ----------------------------------------------------

CHANGE_SCHEMAS = {t: _record(*f) for t, f in ROW_FIELDS.items()}

# Columns the bronze log adds to the row columns. The first three are the
# original bronze columns; the source position columns make "latest change
# per key" a total order when several changes share one ingestion time.
BRONZE_EXTRA = [
    StructField("cdc_op", StringType()),
    StructField("ingested_at", TimestampType()),
    StructField("ingestion_date", DateType()),
    StructField("source_ts_ms", LongType()),
    StructField("source_partition", IntegerType()),
    StructField("source_offset", LongType()),
]

BRONZE_SCHEMAS = {
    t: StructType([StructField(n, ty) for n, ty in f] + BRONZE_EXTRA)
    for t, f in ROW_FIELDS.items()
}

# Shape of one message read from the change stream.
STREAM_ROW = StructType([
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("value", BinaryType()),
])

# Default total order for "latest change per key", newest first.
LATEST_ORDER = ["ingested_at", "source_ts_ms", "source_offset"]
