"""Registered queries: each takes ``(spark, sf_dir)``, reads the shared test
tables through the fixture adapters and returns a DataFrame. The matching SQL
is in :mod:`tidemark.plans.oracle`."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CHANNELS, TABLES, scratch_path, topic_of
from ..functions.cdc import for_topic, parse_changes, split_corrupt, table_of, unwrap_envelope
from ..functions.time import ms_to_ts, ts_lit, ts_to_ms
from ..operators.asof import as_of_join
from ..operators.latest import drop_replays, high_water_mark, latest_per_key, live_rows
from ..operators.quality import (violations_balance, violations_domain, violations_fk, violations_fx,
                                 violations_overlap, violations_unique)
from ..operators.scd2 import snapshot_check, snapshot_timestamp
from ..schemas import BRONZE_SCHEMAS, CHANGE_SCHEMAS, ROW_FIELDS
from ..sources.files import load_new_files, read_rejects
from ..sources.tables import backfill_bronze, publish, read_bronze, write_text
from ..streaming.ingest import ingest_batch
from . import fixtures as fx
from .gold import (credit_legs, debit_legs, dim_accounts, dim_banks, dim_customers, fct_transactions,
                   transactions_as_of, transactions_reporting)
from .pipeline import (PipelineConfig, read_checks, read_gold, read_history, read_silver, run_gold, run_load, run_pipeline,
                       run_silver, run_snapshots)
from .silver import (build_silver, live, silver_accounts, silver_customers, silver_state,
                     silver_transaction_legs, silver_transactions)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- silver (E1, B12, F2-F5, H3) ------------------------------------------

@query("silver_accounts")
def q_silver_accounts(spark, sf):
    return silver_accounts(fx.bronze_accounts(spark, sf))


@query("silver_customers")
def q_silver_customers(spark, sf):
    return silver_customers(fx.bronze_customers(spark, sf))


@query("silver_transactions")
def q_silver_transactions(spark, sf):
    return silver_transactions(fx.bronze_transactions(spark, sf))


@query("silver_legs")
def q_silver_legs(spark, sf):
    return silver_transaction_legs(fx.bronze_transaction_legs(spark, sf))


@query("latest_per_key")
def q_latest_per_key(spark, sf):
    return latest_per_key(fx.bronze_accounts(spark, sf), ["account_id"])


@query("delete_filter")
def q_delete_filter(spark, sf):
    # 'view' events carry a NULL op (unreadable record): dropped like deletes
    b = fx.bronze_customers(spark, sf, view_op=None)
    return live_rows(b, ["customer_id"]).select("customer_id", "full_name", "email", "cdc_op", "ingested_at")


@query("dim_banks")
def q_dim_banks(spark, sf):
    return dim_banks(fx.bronze_banks(spark, sf))


# --- as-of joins and gold (C1-C4, B13, B14, H1-H5) ------------------------

def _gold_inputs(spark, sf):
    txn = silver_transactions(fx.bronze_transactions(spark, sf))
    legs = silver_transaction_legs(fx.bronze_transaction_legs(spark, sf))
    return txn, fx.accounts_history(spark, sf), fx.customers_history(spark, sf), legs


@query("asof_account")
def q_asof_account(spark, sf):
    txn, acc, _, _ = _gold_inputs(spark, sf)
    versions = acc.select("account_id", "account_type", "balance", "valid_from", "valid_to")
    j = as_of_join(txn.select("transaction_id", "account_id", "transaction_created_at"), versions,
                   "account_id", "account_id", "transaction_created_at", as_="a")
    return j.select("transaction_id", "transaction_created_at",
                    F.col("a.account_id").alias("account_id"),
                    F.col("a.account_type").alias("account_type_at_time"),
                    F.col("a.balance").alias("balance_at_time"),
                    F.col("a.valid_from").alias("account_valid_from"))


@query("asof_customer")
def q_asof_customer(spark, sf):
    txn, acc, cus, _ = _gold_inputs(spark, sf)
    j = transactions_as_of(txn, acc, cus)
    return j.select("transaction_id", F.col("a.account_id").alias("account_id"),
                    F.col("c.customer_id").alias("customer_id"),
                    F.col("c.full_name").alias("customer_name_at_time"),
                    F.col("c.email").alias("customer_email_at_time"),
                    F.col("c.valid_from").alias("customer_valid_from"))


@query("fct_transactions")
def q_fct_transactions(spark, sf):
    return fct_transactions(*_gold_inputs(spark, sf))


@query("reporting")
def q_reporting(spark, sf):
    return transactions_reporting(*_gold_inputs(spark, sf))


@query("credit_legs")
def q_credit_legs(spark, sf):
    return credit_legs(silver_transaction_legs(fx.bronze_transaction_legs(spark, sf)))


@query("debit_legs")
def q_debit_legs(spark, sf):
    return debit_legs(silver_transaction_legs(fx.bronze_transaction_legs(spark, sf)))


@query("dim_accounts")
def q_dim_accounts(spark, sf):
    return dim_accounts(fx.accounts_history(spark, sf))


@query("dim_customers")
def q_dim_customers(spark, sf):
    return dim_customers(fx.customers_history(spark, sf))


# --- SCD2 snapshots (G1-G4, B15) --------------------------------------------

def _two_runs(spark, sf, table, view_op="u"):
    """Silver state at the snapshot cut and at the end of the log."""
    if table == "accounts":
        bronze = fx.bronze_accounts(spark, sf)
    else:
        bronze = fx.bronze_customers(spark, sf, view_op=view_op)
    cols = fx.SNAPSHOT_COLS[table] + ["cdc_op"]
    s1 = build_silver(table, fx.before(bronze, fx.SNAPSHOT_CUT)).select(*cols)
    s2 = build_silver(table, bronze).select(*cols)
    return s1, s2


@query("snapshot_ts_accounts")
def q_snapshot_ts_accounts(spark, sf):
    s1, s2 = _two_runs(spark, sf, "accounts")
    h1 = snapshot_timestamp(None, s1, ["account_id"], "account_updated_at")
    return snapshot_timestamp(h1, s2, ["account_id"], "account_updated_at")


@query("snapshot_ts_customers")
def q_snapshot_ts_customers(spark, sf):
    s1, s2 = _two_runs(spark, sf, "customers")
    h1 = snapshot_timestamp(None, s1, ["customer_id"], "customer_updated_at")
    return snapshot_timestamp(h1, s2, ["customer_id"], "customer_updated_at")


CUSTOMER_CHECK_COLS = ["full_name", "email", "phone", "nationality"]
ACCOUNT_CHECK_COLS = ["account_type", "balance", "currency"]


@query("snapshot_check_customers")
def q_snapshot_check_customers(spark, sf):
    s1, s2 = _two_runs(spark, sf, "customers")
    h1 = snapshot_check(None, s1, ["customer_id"], CUSTOMER_CHECK_COLS, fx.CHECK_RUN_1)
    return snapshot_check(h1, s2, ["customer_id"], CUSTOMER_CHECK_COLS, fx.CHECK_RUN_2)


@query("snapshot_check_accounts")
def q_snapshot_check_accounts(spark, sf):
    s1, s2 = _two_runs(spark, sf, "accounts")
    h1 = snapshot_check(None, s1, ["account_id"], ACCOUNT_CHECK_COLS, fx.CHECK_RUN_1)
    return snapshot_check(h1, s2, ["account_id"], ACCOUNT_CHECK_COLS, fx.CHECK_RUN_2)


@query("snapshot_op_filter")
def q_snapshot_op_filter(spark, sf):
    """Check snapshot fed only by updates and creates: 'view' changes arrive
    as snapshot reads ('r') and are left out."""
    s1, s2 = _two_runs(spark, sf, "customers", view_op="r")
    ops = ("u", "c")
    h1 = snapshot_check(None, s1, ["customer_id"], CUSTOMER_CHECK_COLS, fx.CHECK_RUN_1, ops=ops)
    return snapshot_check(h1, s2, ["customer_id"], CUSTOMER_CHECK_COLS, fx.CHECK_RUN_2, ops=ops)


# --- incremental silver (D1, F1, A9) ----------------------------------------

@query("high_water_mark")
def q_high_water_mark(spark, sf):
    target = build_silver("accounts", fx.before(fx.bronze_accounts(spark, sf), fx.CUT_1))
    mark = high_water_mark(target)
    return spark.range(1).select((ts_lit(mark) if mark is not None else F.lit(None).cast("timestamp_ntz")).alias("mark"))


@query("silver_incremental")
def q_silver_incremental(spark, sf):
    """Three runs (cut 1, cut 2, end), deletes applied: equals a full refresh."""
    bronze = fx.bronze_accounts(spark, sf)
    t1 = build_silver("accounts", fx.before(bronze, fx.CUT_1))
    t2 = build_silver("accounts", fx.before(bronze, fx.CUT_2), t1)
    return build_silver("accounts", bronze, t2)


@query("silver_upsert")
def q_silver_upsert(spark, sf):
    """Original merge behaviour: deletes filtered before the merge, so rows
    deleted after cut 2 survive."""
    bronze = fx.bronze_accounts(spark, sf)
    t1 = build_silver("accounts", fx.before(bronze, fx.CUT_2))
    return build_silver("accounts", bronze, t1, apply_deletes=False)


def _late(df):
    """Changes that reach bronze late: every seventh, whatever its time."""
    return df.filter(F.col("source_offset") % 7 == 0)


def _on_time(df):
    return df.filter(F.col("source_offset") % 7 != 0)


@query("silver_late")
def q_silver_late(spark, sf):
    """Accounts and transactions staged as files in two waves, the second with
    older ingestion times than the newest of the first; load and silver run
    after each, without a look-back: equals a full refresh. Transactions use the
    partitioned layout."""
    root = scratch_path(spark, "silver_late")
    cfg = PipelineConfig(root=root, staged=f"{root}/staged", silver_tables=("accounts", "transactions"),
                         silver_partitions={"transactions": "floor(transaction_id / 10000)"})
    logs = {"accounts": fx.bronze_accounts(spark, sf), "transactions": fx.bronze_transactions(spark, sf)}
    for wave, part in (("first", _on_time), ("late", _late)):
        for table, df in logs.items():
            _stage(part(df), table, f"{root}/staged/{table}/{wave}")
        run_load(spark, cfg)
        run_silver(spark, cfg)
    keep = ["amount_or_balance", "cdc_op", "ingested_at", "ingestion_date"]
    acc = read_silver(spark, cfg, "accounts").withColumns({"table_name": F.lit("accounts"), "row_key": F.col("account_id"),
                                                           "amount_or_balance": F.col("balance")})
    txn = read_silver(spark, cfg, "transactions").withColumns({"table_name": F.lit("transactions"), "row_key": F.col("transaction_id"),
                                                               "amount_or_balance": F.col("amount")})
    out = acc.select("table_name", "row_key", *keep).unionByName(txn.select("table_name", "row_key", *keep))
    return out.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query("silver_lookback")
def q_silver_lookback(spark, sf):
    """By mark, with a look-back: the late changes of the time before cut 2
    arrive after it and are found by reading two months below the mark. Stale
    ones do not win, nor bring deleted keys back: equals a full refresh."""
    bronze = fx.bronze_accounts(spark, sf)
    state = silver_state("accounts", fx.before(_on_time(bronze), fx.CUT_2))
    return live(silver_state("accounts", bronze, state, lookback=dt.timedelta(days=62)))


# --- change parsing (B1-B8, B11) ---------------------------------------------

def _accounts_topic(spark, sf, **kw):
    return for_topic(fx.change_messages(spark, sf, **kw), topic_of("accounts"))


ACCOUNT_FIELDS = ["account_id", "customer_id", "bank_id", "account_type", "balance", "currency",
                  "account_status", "opened_at", "updated_at"]


@query("cdc_demux")
def q_cdc_demux(spark, sf):
    m = _accounts_topic(spark, sf)
    return m.select(table_of("topic").alias("table_name"), F.col("partition").alias("message_partition"),
                    F.col("offset").alias("message_offset"), F.col("value").isNull().alias("is_tombstone"))


@query("cdc_parse")
def q_cdc_parse(spark, sf):
    return parse_changes(_accounts_topic(spark, sf), CHANGE_SCHEMAS["accounts"])


@query("cdc_quarantine")
def q_cdc_quarantine(spark, sf):
    parsed = parse_changes(_accounts_topic(spark, sf, corrupt=True), CHANGE_SCHEMAS["accounts"], keep_corrupt=True)
    _, bad = split_corrupt(parsed)
    return bad.select("source_partition", "source_offset", "account_id", "balance", "cdc_op")


@query("cdc_unwrap")
def q_cdc_unwrap(spark, sf):
    u = unwrap_envelope(_accounts_topic(spark, sf, envelope=True), CHANGE_SCHEMAS["accounts"])
    return u.select(F.col("offset").alias("message_offset"), *ACCOUNT_FIELDS,
                    "__op", "__table", "__source_ts_ms")


@query("epoch_ms")
def q_epoch_ms(spark, sf):
    e = fx.table(spark, sf, "events")
    return e.select("event_id", ts_to_ms("ts").alias("ts_ms"), ms_to_ts(ts_to_ms("ts")).alias("ts_back"))


# --- sinks and loads (A3-A6, A10, K5) ----------------------------------------

def _stamps():
    return fx.CUT_1, fx.CHECK_RUN_2


@query("bronze_append")
def q_bronze_append(spark, sf):
    """Two micro-batches (before / after cut 1) ingested with fixed stamps into
    a date-partitioned bronze; read back with partition discovery."""
    root = scratch_path(spark, "bronze_append")
    msgs = fx.change_messages(spark, sf)
    cut = ts_lit(fx.CUT_1, "timestamp")
    for i, (part, at) in enumerate(zip((msgs.filter(F.col("timestamp") < cut), msgs.filter(F.col("timestamp") >= cut)),
                                      _stamps())):
        ingest_batch(part, i, bronze_root=f"{root}/bronze", dead_letter_root=f"{root}/dead", at=at)
    b = read_bronze(spark, "accounts", f"{root}/bronze/accounts")
    return b.drop("ingested_at")


@query("dead_letter")
def q_dead_letter(spark, sf):
    """A poisoned accounts slice (strict parsing) goes to the dead letters
    whole; the transactions slice of the same batch still loads."""
    root = scratch_path(spark, "dead_letter")
    status = ingest_batch(fx.change_messages(spark, sf, corrupt=True), 0, bronze_root=f"{root}/bronze",
                          dead_letter_root=f"{root}/dead", parse_mode="FAILFAST")
    if status.get("transactions") != "ok":
        raise RuntimeError(f"transactions slice should load: {status}")
    d = spark.read.parquet(f"{root}/dead/accounts")
    return d.select("topic", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                    F.col("value").isNull().alias("is_tombstone"))


@query("replay_dedup")
def q_replay_dedup(spark, sf):
    """The same batch delivered twice (at-least-once): duplicates removed on
    the source position."""
    root = scratch_path(spark, "replay")
    msgs = fx.change_messages(spark, sf)
    for i in range(2):
        ingest_batch(msgs, i, bronze_root=f"{root}/bronze", dead_letter_root=f"{root}/dead", at=fx.CUT_1)
    b = read_bronze(spark, "accounts", f"{root}/bronze/accounts")
    return drop_replays(b).drop("ingested_at", "ingestion_date")


@query("ingest_quarantine")
def q_ingest_quarantine(spark, sf):
    """Malformed and mistyped messages go to the quarantine, the rest of the
    slice to bronze."""
    root = scratch_path(spark, "quarantine")
    ingest_batch(fx.change_messages(spark, sf, corrupt=True), 0, bronze_root=f"{root}/bronze",
                 dead_letter_root=f"{root}/dead", quarantine_root=f"{root}/bad", at=fx.CUT_1)
    good = read_bronze(spark, "accounts", f"{root}/bronze/accounts").select(
        F.lit("bronze").alias("place"), "source_partition", "source_offset", "account_id", "cdc_op")
    bad = spark.read.parquet(f"{root}/bad/accounts").select(F.lit("quarantine").alias("place"), "source_partition", "source_offset")
    return good.unionByName(bad, allowMissingColumns=True)


@query("ingest_envelope")
def q_ingest_envelope(spark, sf):
    """Unflattened change events through the same ingest."""
    root = scratch_path(spark, "envelope")
    ingest_batch(fx.change_messages(spark, sf, envelope=True), 0, bronze_root=f"{root}/bronze",
                 dead_letter_root=f"{root}/dead", envelope=True, at=fx.CUT_1)
    return read_bronze(spark, "accounts", f"{root}/bronze/accounts").drop("ingested_at", "ingestion_date")


@query("ingest_transactions")
def q_ingest_transactions(spark, sf):
    """The transactions half of the ingests of ``bronze_append``,
    ``replay_dedup``, ``ingest_quarantine`` and ``ingest_envelope``, which
    return the accounts half: whole rows, by ingest and place."""
    root = scratch_path(spark, "ingest_transactions")
    msgs = fx.change_messages(spark, sf)
    cut = ts_lit(fx.CUT_1, "timestamp")
    first, second = _stamps()
    early, late = msgs.filter(F.col("timestamp") < cut), msgs.filter(F.col("timestamp") >= cut)
    for run, batches, options in [
            ("append", [(early, first), (late, second)], {}),
            ("replay", [(msgs, first), (msgs, first)], {}),
            ("quarantine", [(fx.change_messages(spark, sf, corrupt=True), first)], {"quarantine_root": f"{root}/quarantine/bad"}),
            ("envelope", [(fx.change_messages(spark, sf, envelope=True), first)], {"envelope": True})]:
        for i, (part, at) in enumerate(batches):
            ingest_batch(part, i, bronze_root=f"{root}/{run}/bronze", dead_letter_root=f"{root}/{run}/dead", at=at, **options)

    def rows(run):
        return read_bronze(spark, "transactions", f"{root}/{run}/bronze/transactions").drop("ingested_at")

    bad = spark.read.parquet(f"{root}/quarantine/bad/transactions").select("source_partition", "source_offset")
    out = bad.select(F.lit("quarantine").alias("run"), F.lit("quarantine").alias("place"), "*")
    for run, df in [("append", rows("append")), ("replay", drop_replays(rows("replay"))),
                    ("quarantine", rows("quarantine")), ("envelope", rows("envelope"))]:
        out = out.unionByName(df.withColumns({"run": F.lit(run), "place": F.lit("bronze")}), allowMissingColumns=True)
    return out


@query("ingest_envelope_quarantine")
def q_ingest_envelope_quarantine(spark, sf):
    """Unflattened events, some truncated, some with a field of the wrong type:
    both kinds go to the quarantine, the rest to bronze."""
    root = scratch_path(spark, "envelope_quarantine")
    ingest_batch(fx.change_messages(spark, sf, corrupt=True, envelope=True), 0, bronze_root=f"{root}/bronze",
                 dead_letter_root=f"{root}/dead", quarantine_root=f"{root}/bad", envelope=True, at=fx.CUT_1)
    out = None
    for t, key in (("accounts", "account_id"), ("transactions", "transaction_id")):
        good = read_bronze(spark, t, f"{root}/bronze/{t}").select(
            F.lit("bronze").alias("place"), F.lit(t).alias("table_name"), "source_partition", "source_offset",
            F.col(key).alias("row_key"), "cdc_op")
        bad = spark.read.parquet(f"{root}/bad/{t}").select(
            F.lit("quarantine").alias("place"), F.lit(t).alias("table_name"), "source_partition", "source_offset",
            F.lit(None).cast("int").alias("row_key"), F.lit(None).cast("string").alias("cdc_op"))
        both = good.unionByName(bad)
        out = both if out is None else out.unionByName(both)
    return out


@query("ingest_all_topics")
def q_ingest_all_topics(spark, sf):
    """The messages of all five topics, delivered twice under one batch number:
    bronze and the quarantine hold each once; and again with strict parsing,
    where the accounts slice goes to the dead letters, once. All outputs."""
    root = scratch_path(spark, "all_topics")
    msgs = fx.change_messages(spark, sf, corrupt=True, tables=tuple(TABLES)).persist(StorageLevel.MEMORY_AND_DISK)
    for _ in range(2):
        ingest_batch(msgs, 0, bronze_root=f"{root}/bronze", dead_letter_root=f"{root}/dead", at=fx.CUT_1,
                     quarantine_root=f"{root}/bad", ledger=f"{root}/units")
        ingest_batch(msgs, 0, bronze_root=f"{root}/strict/bronze", dead_letter_root=f"{root}/dead", at=fx.CUT_1,
                     topics=[topic_of("accounts"), topic_of("banks")], parse_mode="FAILFAST", ledger=f"{root}/strict/units")
    msgs.unpersist()
    out = None
    for t, fields in ROW_FIELDS.items():
        for place in ("bronze", *(["strict/bronze"] if t == "banks" else [])):
            b = read_bronze(spark, t, f"{root}/{place}/{t}").select(
                F.lit(place).alias("place"), F.lit(t).alias("table_name"), F.col(fields[0][0]).alias("row_key"), "cdc_op", "source_ts_ms",
                "source_partition", "source_offset", "ingestion_date")
            out = b if out is None else out.unionByName(b)
    bad = spark.read.parquet(f"{root}/bad/accounts").select(F.lit("quarantine").alias("place"), F.lit("accounts").alias("table_name"),
                                                          "source_partition", "source_offset")
    dead = spark.read.parquet(f"{root}/dead/accounts").select(F.lit("dead_letter").alias("place"), F.lit("accounts").alias("table_name"),
                                                            F.col("offset").alias("source_offset"))
    return out.unionByName(bad, allowMissingColumns=True).unionByName(dead, allowMissingColumns=True)


@query("bronze_load")
def q_bronze_load(spark, sf):
    """Files staged in two waves; three load runs. Each file is loaded once."""
    root = scratch_path(spark, "bronze_load")
    schema = BRONZE_SCHEMAS["accounts"]
    b = _as_bronze(fx.bronze_accounts(spark, sf), schema)
    cut = ts_lit(fx.CUT_1, "timestamp")
    b.filter(F.col("ingested_at") < cut).write.parquet(f"{root}/stage/wave1")
    load_new_files(spark, f"{root}/stage", schema, f"{root}/bronze", f"{root}/ckpt", recursive=True)
    b.filter(F.col("ingested_at") >= cut).write.parquet(f"{root}/stage/wave2")
    load_new_files(spark, f"{root}/stage", schema, f"{root}/bronze", f"{root}/ckpt", recursive=True)
    again = load_new_files(spark, f"{root}/stage", schema, f"{root}/bronze", f"{root}/ckpt", recursive=True)
    if again != 0:
        raise RuntimeError(f"a repeated load read {again} rows")
    return _loaded(spark, f"{root}/bronze", schema)


@query("bronze_mixed_load")
def q_bronze_mixed_load(spark, sf):
    """Appends and a file load on one bronze table: append up to cut 1, load
    the rows up to cut 2 from files, append the rest; every row is read back."""
    root = scratch_path(spark, "bronze_mixed")
    schema = BRONZE_SCHEMAS["accounts"]
    b = _as_bronze(fx.bronze_accounts(spark, sf), schema)
    cut_1, cut_2 = ts_lit(fx.CUT_1, "timestamp"), ts_lit(fx.CUT_2, "timestamp")
    at = F.col("ingested_at")
    backfill_bronze(b.filter(at < cut_1), f"{root}/bronze")
    b.filter((at >= cut_1) & (at < cut_2)).write.parquet(f"{root}/stage/wave")
    load_new_files(spark, f"{root}/stage", schema, f"{root}/bronze", f"{root}/ckpt", recursive=True)
    backfill_bronze(b.filter(at >= cut_2), f"{root}/bronze")
    return _loaded(spark, f"{root}/bronze", schema)


@query("load_by_name")
def q_load_by_name(spark, sf):
    """Staged files with upper-case names, a missing column, an extra column
    and an unreadable file: loaded by name against the declared schema."""
    root = scratch_path(spark, "load_by_name")
    schema = BRONZE_SCHEMAS["accounts"]
    b = _as_bronze(fx.bronze_accounts(spark, sf), schema)
    staged = b.select(*[F.col(c).alias(c.upper()) for c in schema.fieldNames() if c != "currency"],
                      F.lit("x").alias("UNUSED_EXTRA"))
    staged.write.parquet(f"{root}/stage/good")
    _write_junk(spark, f"{root}/stage/bad")
    load_new_files(spark, f"{root}/stage", schema, f"{root}/bronze", f"{root}/ckpt", recursive=True)
    return _loaded(spark, f"{root}/bronze", schema)


@query("load_rejects")
def q_load_rejects(spark, sf):
    """Staged account files in three shapes: as declared; with ids as text and
    balances as text, some of them no numbers; without a balance. Rows whose
    values cannot be cast are rejected by value, all others are loaded."""
    root = scratch_path(spark, "load_rejects")
    schema = BRONZE_SCHEMAS["accounts"]
    b = _as_bronze(fx.bronze_accounts(spark, sf), schema)
    part = F.col("source_offset") % 3
    b.filter(part == 0).write.parquet(f"{root}/stage/plain")
    text = F.when(F.col("account_type") == "click", "n/a").otherwise(F.col("source_ts_ms").cast("string"))
    (b.filter(part == 1).withColumns({"account_id": F.col("account_id").cast("string"), "source_ts_ms": text})
      .write.parquet(f"{root}/stage/text"))
    b.filter(part == 2).drop("balance").write.parquet(f"{root}/stage/short")
    load_new_files(spark, f"{root}/stage", schema, f"{root}/bronze", f"{root}/ckpt", recursive=True)
    good = spark.read.schema(schema).parquet(f"{root}/bronze").select(
        F.lit("bronze").alias("place"), "account_id", "balance", "source_ts_ms", "source_offset")
    bad = read_rejects(spark, f"{root}/ckpt").select(
        F.lit("rejects").alias("place"), F.col("column").alias("reject_column"), F.col("value").alias("reject_value"),
        F.regexp_extract("file", "/stage/([a-z]+)/", 1).alias("staged"), F.get_json_object("row", "$.source_offset").cast("long").alias("source_offset"))
    return good.unionByName(bad, allowMissingColumns=True)


def _as_bronze(df, schema):
    """Fixture rows in the declared bronze types (ingestion time is zoned)."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def _loaded(spark, path, schema):
    """A loaded bronze table, with the wall-clock ingestion time of the staged rows."""
    b = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return b.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


def _write_junk(spark, path):
    """One file named like parquet that is not parquet, one text file."""
    write_text(spark, f"{path}/broken.parquet", "not parquet at all")
    write_text(spark, f"{path}/notes.txt", "ignored by the file-name pattern")


@query("gold_append_twice")
def q_gold_append_twice(spark, sf):
    """A gold model published in append mode on two runs holds every row twice."""
    path = scratch_path(spark, "gold_append")
    d = dim_banks(fx.bronze_banks(spark, sf))
    publish(d, path, mode="append")
    publish(d, path, mode="append")
    return spark.read.parquet(path)


# --- quality checks (Q1-Q5) ----------------------------------------------------

@query("chk_unique")
def q_chk_unique(spark, sf):
    return violations_unique(fx.bronze_transaction_legs(spark, sf), ["leg_id"])


@query("chk_fk")
def q_chk_fk(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = fx.table(spark, sf, "lineitem")
    return violations_fk(orders, lines, ["o_orderkey"], ["l_orderkey"])


@query("chk_domain")
def q_chk_domain(spark, sf):
    t = silver_transactions(fx.bronze_transactions(spark, sf))
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    bad_status = violations_domain(o, "o_orderstatus", ["F", "O"])
    bad_channel = violations_domain(t, "channel", CHANNELS)
    return (bad_status.select(F.lit("orders.o_orderstatus").alias("rule"), F.col("o_orderkey").alias("row_key"),
                              F.col("o_orderstatus").alias("value"))
            .unionByName(bad_channel.select(F.lit("transactions.channel").alias("rule"),
                                            F.col("transaction_id").cast("long").alias("row_key"),
                                            F.col("channel").alias("value"))))


@query("chk_balance")
def q_chk_balance(spark, sf):
    legs = silver_transaction_legs(fx.bronze_transaction_legs(spark, sf))
    return violations_balance(legs)


@query("chk_fx")
def q_chk_fx(spark, sf):
    t = silver_transactions(fx.bronze_transactions(spark, sf))
    return violations_fx(t).select("transaction_id", "amount", "amount_in_usd", "channel")


# --- one whole pipeline run (P1) --------------------------------------------

@query("pipeline_run")
def q_pipeline_run(spark, sf):
    """Fixture change logs staged as files of the five tables, then one
    pipeline run (load, silver, snapshots, gold, checks); returns the gold fact."""
    cfg, result = _staged_run(spark, sf)
    return spark.read.parquet(result["gold"]["fct_transactions"])


@query("pipeline_reporting")
def q_pipeline_reporting(spark, sf):
    """The reporting model of the same run."""
    cfg, _ = _staged_run(spark, sf)
    return read_gold(spark, cfg, "gold_transactions_reporting")


@query("pipeline_checks")
def q_pipeline_checks(spark, sf):
    """Violations of every constraint after the same run."""
    cfg, _ = _staged_run(spark, sf)
    return read_checks(spark, cfg)


@query("pipeline_tables")
def q_pipeline_tables(spark, sf):
    """Snapshots and dimensions of the same run, by table."""
    cfg, _ = _staged_run(spark, sf)
    acc, cus = (read_history(spark, cfg, t).withColumn("table_name", F.lit(f"snapshot_{t}")) for t in ("accounts", "customers"))
    out = acc.select("table_name", F.col("account_id").alias("row_key"), F.col("account_type").alias("label"), "scd_id", "valid_from", "valid_to")
    out = out.unionByName(cus.select("table_name", F.col("customer_id").alias("row_key"), F.col("email").alias("label"), "scd_id", "valid_from", "valid_to"))
    for name, key, label in (("dim_accounts", "account_id", "account_type"), ("dim_customers", "customer_id", "email"), ("dim_banks", "bank_id", "swift_code")):
        out = out.unionByName(read_gold(spark, cfg, name).select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"),
                                                                F.col(label).alias("label")), allowMissingColumns=True)
    return out


@query("gold_incremental")
def q_gold_incremental(spark, sf):
    """The fact after two runs, of which the second rewrites only the partitions
    that late and new changes reach: account and customer versions of both
    runs, transactions and legs that arrive late."""
    root = scratch_path(spark, "gold_incremental")
    cfg = PipelineConfig(root=root, run_at=fx.CHECK_RUN_2, gold_partitions="floor(transaction_id / 1000)",
                         silver_partitions={"transactions": "floor(transaction_id / 10000)"})
    acc, cus = fx.bronze_accounts(spark, sf), fx.bronze_customers(spark, sf)
    txn, legs, banks = fx.bronze_transactions(spark, sf), _by_year(fx.bronze_transaction_legs(spark, sf)), fx.bronze_banks(spark, sf)
    cut = lambda df: F.col("ingested_at") < ts_lit(fx.SNAPSHOT_CUT)
    waves = [{"accounts": acc.filter(cut(acc)), "customers": cus.filter(cut(cus)), "transactions": _on_time(txn),
              "transaction_legs": _on_time(legs), "banks": banks},
             {"accounts": acc.filter(~cut(acc)), "customers": cus.filter(~cut(cus)), "transactions": _late(txn),
              "transaction_legs": _late(legs)}]
    for wave in waves:
        for table, df in wave.items():
            backfill_bronze(_as_bronze(df, BRONZE_SCHEMAS[table]), cfg.path("bronze", table))
        run_silver(spark, cfg)
        run_snapshots(spark, cfg, cfg.run_at)
        run_gold(spark, cfg)
    return read_gold(spark, cfg, "fct_transactions")


def _by_year(df):
    """Leg changes filed under their year: the fixture's legs span 2,500 days
    of a few rows each, and a folder for each day is all that a run would write."""
    return df.withColumn("ingestion_date", F.trunc("ingestion_date", "YEAR"))


def _stage(df, table, path):
    df.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE_SCHEMAS[table].fields]).write.parquet(path)


def _staged_run(spark, sf):
    root = scratch_path(spark, "pipeline")
    logs = {"accounts": fx.bronze_accounts(spark, sf), "customers": fx.bronze_customers(spark, sf),
            "transactions": fx.bronze_transactions(spark, sf),
            "transaction_legs": _by_year(fx.bronze_transaction_legs(spark, sf)), "banks": fx.bronze_banks(spark, sf)}
    for table, df in logs.items():
        _stage(df, table, f"{root}/staged/{table}")
    # transactions use the partitioned silver layout (ids grow with time), the rest versioned tables
    cfg = PipelineConfig(root=root, staged=f"{root}/staged", run_at=fx.CHECK_RUN_2,
                         silver_partitions={"transactions": "floor(transaction_id / 10000)"})
    return cfg, run_pipeline(spark, cfg)


@query("chk_overlap")
def q_chk_overlap(spark, sf):
    """Overlap check over a history whose versions each last one hour from the
    change: changes of one customer less than an hour apart overlap."""
    b = fx.bronze_customers(spark, sf)
    h = b.selectExpr("customer_id", "source_offset", "ingested_at AS valid_from",
                     "timestampadd(HOUR, 1, ingested_at) AS valid_to")
    return violations_overlap(h, ["customer_id"]).select("customer_id", "source_offset", "valid_from")
