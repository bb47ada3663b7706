"""Independent SQL for every registered query, runnable by DuckDB on the shared
parquet tables (pre-registered as views named after the tables).

The fixture adapters of :mod:`tidemark.plans.fixtures` are repeated here as
CTEs; the operator logic is written in DuckDB's own terms (``DISTINCT ON``, ``ASOF
JOIN``, ``IS DISTINCT FROM``), not the way the Spark plans compute it.
"""

from __future__ import annotations

MS = "(epoch_us({c}) // 1000)"


def ms(c: str) -> str:
    return MS.format(c=c)


OP_OF_EVENT = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END"

BRONZE_ACCOUNTS = f"""
  SELECT CAST(user_id AS INTEGER) AS account_id,
         CAST(user_id % 50 AS INTEGER) AS customer_id,
         CAST(user_id % 10 AS INTEGER) AS bank_id,
         event_type AS account_type,
         value AS balance,
         CASE WHEN user_id % 3 = 0 THEN 'GBP' WHEN user_id % 3 = 1 THEN 'EUR' ELSE 'USD' END AS currency,
         CASE WHEN event_type = 'error' THEN 'frozen' WHEN event_type = 'view' THEN 'dormant' ELSE 'active' END AS account_status,
         {ms('ts')} - 2592000000 AS opened_at,
         {ms('ts')} AS updated_at,
         {OP_OF_EVENT} AS cdc_op,
         ts AS ingested_at, CAST(ts AS DATE) AS ingestion_date,
         {ms('ts')} AS source_ts_ms, CAST(NULL AS INTEGER) AS source_partition, event_id AS source_offset
  FROM events"""

BRONZE_CUSTOMERS = f"""
  SELECT CAST(user_id % 50 AS INTEGER) AS customer_id,
         'cust-' || CAST(user_id % 50 AS VARCHAR) AS full_name,
         'u' || CAST(user_id AS VARCHAR) || '@mail.test' AS email,
         CASE WHEN event_type = 'click' THEN NULL ELSE '+44-' || CAST(user_id AS VARCHAR) END AS phone,
         'nation-' || CAST(user_id % 25 AS VARCHAR) AS nationality,
         {ms('ts')} - 2592000000 AS created_at,
         {ms('ts')} AS updated_at,
         {OP_OF_EVENT} AS cdc_op,
         ts AS ingested_at, CAST(ts AS DATE) AS ingestion_date,
         {ms('ts')} AS source_ts_ms, CAST(NULL AS INTEGER) AS source_partition, event_id AS source_offset
  FROM events"""

BRONZE_TRANSACTIONS = f"""
  SELECT CAST(event_id AS INTEGER) AS transaction_id,
         CAST(user_id AS INTEGER) AS account_id,
         CASE WHEN event_id % 3 = 0 THEN 'deposit' WHEN event_id % 3 = 1 THEN 'withdrawal' ELSE 'transfer' END AS type,
         value AS amount, 'GBP' AS currency, 1.27::DOUBLE AS exchange_rate,
         CASE WHEN event_id % 5 = 2 THEN value ELSE value * 1.27::DOUBLE END AS amount_in_usd,
         CASE WHEN event_id % 10 = 0 THEN 'failed' WHEN event_id % 10 < 3 THEN 'pending' ELSE 'completed' END AS status,
         CASE WHEN event_id % 5 = 0 THEN 'online' WHEN event_id % 5 = 1 THEN 'mobile' WHEN event_id % 5 = 2 THEN 'atm'
              WHEN event_id % 5 = 3 THEN 'branch' ELSE 'card' END AS channel,
         'United Kingdom' AS country,
         'city-' || CAST(user_id % 7 AS VARCHAR) AS city,
         props AS description,
         {ms('ts')} AS created_at, {ms('ts')} AS updated_at,
         'c' AS cdc_op,
         ts AS ingested_at, CAST(ts AS DATE) AS ingestion_date,
         {ms('ts')} AS source_ts_ms, CAST(NULL AS INTEGER) AS source_partition, event_id AS source_offset
  FROM events WHERE event_type = 'purchase'"""

BRONZE_LEGS = """
  SELECT CAST(l_orderkey * 8 + l_linenumber AS INTEGER) AS leg_id,
         CAST(l_orderkey AS INTEGER) AS transaction_id,
         CASE WHEN l_linestatus = 'F' THEN 'debit' ELSE 'credit' END AS direction,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey AS INTEGER) END AS account_id,
         CAST(l_suppkey AS INTEGER) AS bank_id,
         CASE WHEN l_linestatus <> 'F' THEN 'GB' || CAST(l_partkey AS VARCHAR) END AS external_account_reference,
         CASE WHEN l_linestatus <> 'F' THEN 'name-' || CAST(l_suppkey AS VARCHAR) END AS external_account_name,
         l_extendedprice AS amount, 'GBP' AS currency,
         CASE WHEN l_returnflag = 'R' THEN 'd' WHEN l_returnflag = 'A' THEN 'u' ELSE 'c' END AS cdc_op,
         l_shipdate AS ingested_at, CAST(l_shipdate AS DATE) AS ingestion_date,
         l_partkey AS source_ts_ms, CAST(NULL AS INTEGER) AS source_partition,
         l_suppkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS source_offset
  FROM lineitem"""
LATEST_ORDER_SQL = "ingested_at DESC NULLS LAST, source_ts_ms DESC NULLS LAST, source_offset DESC NULLS LAST"

BRONZE_BANKS = """
  SELECT CAST(s_suppkey AS INTEGER) AS bank_id, s_name AS bank_name, n_name AS country,
         'SW' || CAST(s_suppkey AS VARCHAR) AS swift_code,
         CASE WHEN s_acctbal < 0 THEN 'd' ELSE 'c' END AS cdc_op,
         TIMESTAMP '2024-01-01 00:00:00' AS ingested_at, DATE '2024-01-01' AS ingestion_date,
         CAST(NULL AS BIGINT) AS source_ts_ms, CAST(NULL AS INTEGER) AS source_partition, s_suppkey AS source_offset
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def ts(ms_expr: str) -> str:
    return f"make_timestamp_ms({ms_expr})"


def newest(src: str, key: str, order: str = LATEST_ORDER_SQL) -> str:
    return f"SELECT DISTINCT ON ({key}) * FROM ({src}) s ORDER BY {key}, {order}"


SILVER_ACCOUNTS_COLS = f"""account_id, customer_id, bank_id, account_type, balance, currency, account_status,
         {ts('opened_at')} AS account_opened_at, {ts('updated_at')} AS account_updated_at,
         cdc_op, ingested_at, ingestion_date"""
SILVER_CUSTOMERS_COLS = f"""customer_id, full_name, email, phone, nationality,
         {ts('created_at')} AS customer_created_at, {ts('updated_at')} AS customer_updated_at,
         cdc_op, ingested_at, ingestion_date"""
SILVER_TRANSACTIONS_COLS = f"""transaction_id, account_id, type AS transaction_type, amount, currency, exchange_rate,
         amount_in_usd, status, channel, country, city, description, cdc_op,
         {ts('created_at')} AS transaction_created_at, {ts('updated_at')} AS transaction_updated_at,
         ingested_at, ingestion_date"""
SILVER_LEGS_COLS = """leg_id, transaction_id, direction, account_id, bank_id, external_account_reference,
         external_account_name, amount, currency, cdc_op, ingested_at, ingestion_date"""


def silver(src: str, key: str, cols: str, order: str = LATEST_ORDER_SQL) -> str:
    return f"SELECT {cols} FROM ({newest(src, key, order)}) d WHERE cdc_op <> 'd'"


def silver_accounts_sql(src: str = BRONZE_ACCOUNTS) -> str:
    return silver(src, "account_id", SILVER_ACCOUNTS_COLS)


def silver_customers_sql(src: str = BRONZE_CUSTOMERS) -> str:
    return silver(src, "customer_id", SILVER_CUSTOMERS_COLS)


def silver_transactions_sql(src: str = BRONZE_TRANSACTIONS) -> str:
    return silver(src, "transaction_id", SILVER_TRANSACTIONS_COLS)


def silver_legs_sql(src: str = BRONZE_LEGS) -> str:
    return silver(src, "leg_id", SILVER_LEGS_COLS)


SQL: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    SQL[name] = sql.strip()


register("silver_accounts", silver_accounts_sql())
register("silver_customers", silver_customers_sql())
register("silver_transactions", silver_transactions_sql())
register("silver_legs", silver_legs_sql())
register("latest_per_key", f"""
  SELECT * FROM ({newest(BRONZE_ACCOUNTS, 'account_id')}) r""")
register("delete_filter", f"""
  SELECT customer_id, full_name, email, cdc_op, ingested_at
  FROM ({newest(BRONZE_CUSTOMERS.replace(OP_OF_EVENT, "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'view' THEN NULL ELSE 'u' END"), 'customer_id')}) r
  WHERE cdc_op <> 'd'""")
register("dim_banks", f"""
  SELECT bank_id, bank_name, country, swift_code
  FROM ({newest(BRONZE_BANKS, 'bank_id')}) d WHERE cdc_op <> 'd'""")
DIM_BANKS = SQL["dim_banks"]


# --- histories, as-of joins, gold ---------------------------------------------

ACC_SNAP_COLS = "account_id, customer_id, bank_id, account_type, balance, currency, account_opened_at, account_updated_at"
CUS_SNAP_COLS = "customer_id, full_name, email, phone, nationality, customer_created_at, customer_updated_at"


def scd_id(keys: list[str], at: str) -> str:
    parts = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"md5({parts} || '|' || CAST(epoch_us({at}) AS VARCHAR))"


ACC_HIST = f"""
  SELECT {ACC_SNAP_COLS},
         {scd_id(['account_id'], 'account_updated_at')} AS scd_id,
         account_updated_at AS scd_updated_at,
         account_updated_at AS valid_from,
         lead(account_updated_at) OVER (PARTITION BY account_id ORDER BY account_updated_at, ingested_at) AS valid_to
  FROM (SELECT {SILVER_ACCOUNTS_COLS} FROM ({BRONZE_ACCOUNTS}) b WHERE account_type <> 'purchase') x"""

CUS_HIST = f"""
  SELECT {CUS_SNAP_COLS},
         {scd_id(['customer_id'], 'customer_updated_at')} AS scd_id,
         customer_updated_at AS scd_updated_at,
         customer_updated_at AS valid_from,
         lead(customer_updated_at) OVER (PARTITION BY customer_id ORDER BY customer_updated_at, ingested_at) AS valid_to
  FROM (SELECT {SILVER_CUSTOMERS_COLS} FROM ({BRONZE_CUSTOMERS}) b WHERE cdc_op <> 'd') x"""

GOLD_CTES = f"""
WITH t AS ({silver_transactions_sql()}),
     a AS (SELECT * FROM ({ACC_HIST}) h WHERE valid_to IS DISTINCT FROM valid_from),
     c AS (SELECT * FROM ({CUS_HIST}) h WHERE valid_to IS DISTINCT FROM valid_from),
     legs AS ({silver_legs_sql()})
"""

# these histories have no gaps: a version lasts until the next one of its key
ASOF_A = "ASOF LEFT JOIN a ON a.account_id = t.account_id AND a.valid_from <= t.transaction_created_at"
ASOF_C = "ASOF LEFT JOIN c ON c.customer_id = a.customer_id AND c.valid_from <= t.transaction_created_at"
CREDITS = "LEFT JOIN legs cl ON cl.direction = 'credit' AND cl.transaction_id = t.transaction_id"
RECEIVER = """cl.external_account_name AS receiver_name, cl.external_account_reference AS receiver_iban,
      cl.bank_id AS receiver_bank_id"""
FACT_SEL = """a.account_id, a.account_type AS account_type_at_time, a.balance AS balance_at_time,
      a.currency AS account_currency_at_time,
      c.customer_id, c.full_name AS customer_name_at_time, c.nationality AS customer_nationality_at_time,
      c.email AS customer_email_at_time"""
REPORT_SEL = """a.account_id, a.account_type, a.balance AS balance_at_transaction_time, a.currency AS account_currency,
      c.customer_id, c.full_name AS customer_name, c.nationality AS customer_nationality_at_time,
      c.email AS customer_email"""
TXN_SEL = """t.transaction_id, t.transaction_type, t.amount, t.currency, t.exchange_rate, t.amount_in_usd,
      t.status, t.channel, t.country, t.city, t.description, t.transaction_created_at, t.transaction_updated_at"""

register("asof_account", GOLD_CTES + f"""
SELECT t.transaction_id, t.transaction_created_at, a.account_id, a.account_type AS account_type_at_time,
       a.balance AS balance_at_time, a.valid_from AS account_valid_from
FROM t {ASOF_A}""")

register("asof_customer", GOLD_CTES + f"""
SELECT t.transaction_id, a.account_id, c.customer_id, c.full_name AS customer_name_at_time,
       c.email AS customer_email_at_time, c.valid_from AS customer_valid_from
FROM t {ASOF_A} {ASOF_C}""")

FACT = f"SELECT {TXN_SEL}, {FACT_SEL}, {RECEIVER} FROM t {ASOF_A} {ASOF_C} {CREDITS}"
# a transaction with several debit legs counts once for each
REPORT = f"""SELECT {TXN_SEL}, {REPORT_SEL}, {RECEIVER} FROM t {ASOF_A} {ASOF_C} {CREDITS}
LEFT JOIN legs dl ON dl.direction = 'debit' AND dl.transaction_id = t.transaction_id"""
register("fct_transactions", f"{GOLD_CTES} {FACT}")
register("reporting", f"{GOLD_CTES} {REPORT}")
register("credit_legs", f"""
SELECT transaction_id, external_account_reference, external_account_name, bank_id AS receiver_bank_id
FROM ({silver_legs_sql()}) l WHERE direction = 'credit'""")
register("debit_legs", f"""
SELECT transaction_id, account_id AS sender_account_id, bank_id AS sender_bank_id
FROM ({silver_legs_sql()}) l WHERE direction = 'debit'""")
register("dim_accounts", f"""
SELECT account_id, customer_id, bank_id, account_type, balance, currency, account_opened_at
FROM ({ACC_HIST}) h WHERE valid_to IS NULL""")
register("dim_customers", f"""
SELECT customer_id, full_name, email, phone, nationality, customer_created_at
FROM ({CUS_HIST}) h WHERE valid_to IS NULL""")


# --- SCD2 snapshot runs -----------------------------------------------------------

SNAPSHOT_CUT = "TIMESTAMP '2024-01-16 00:00:00'"
CHECK_RUN_1 = "TIMESTAMP '2024-01-16 00:00:00'"
CHECK_RUN_2 = "TIMESTAMP '2024-02-01 00:00:00'"


def _runs(table: str, bronze: str) -> str:
    cols = (ACC_SNAP_COLS if table == "accounts" else CUS_SNAP_COLS) + ", cdc_op"
    sql = silver_accounts_sql if table == "accounts" else silver_customers_sql
    return f"""s1 AS (SELECT {cols} FROM ({sql(f"SELECT * FROM ({bronze}) b WHERE ingested_at < {SNAPSHOT_CUT}")}) x),
     s2 AS (SELECT {cols} FROM ({sql(bronze)}) x)"""


def snapshot_ts_sql(table: str, key: str, upd: str, bronze: str) -> str:
    cols = ACC_SNAP_COLS if table == "accounts" else CUS_SNAP_COLS
    ocols = ", ".join(f"o.{c}" for c in cols.split(", "))
    ncols = ", ".join(f"n.{c}" for c in cols.split(", "))
    return f"""
WITH {_runs(table, bronze)},
     h1 AS (SELECT {cols}, {scd_id([key], upd)} AS scd_id, {upd} AS scd_updated_at,
                   {upd} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM s1)
SELECT {ocols}, o.scd_id, o.scd_updated_at, o.valid_from,
       CASE WHEN n.{key} IS NOT NULL AND n.{upd} > o.valid_from THEN n.{upd} ELSE o.valid_to END AS valid_to
FROM h1 o LEFT JOIN s2 n ON o.{key} = n.{key}
UNION ALL
SELECT {ncols}, {scd_id(['n.' + key], 'n.' + upd)}, n.{upd}, n.{upd}, CAST(NULL AS TIMESTAMP)
FROM s2 n LEFT JOIN h1 o ON o.{key} = n.{key}
WHERE o.{key} IS NULL OR n.{upd} > o.valid_from"""


def snapshot_check_sql(table: str, key: str, check: list[str], bronze: str,
                       op_filter: str = "") -> str:
    cols = ACC_SNAP_COLS if table == "accounts" else CUS_SNAP_COLS
    ocols = ", ".join(f"o.{c}" for c in cols.split(", "))
    ncols = ", ".join(f"n.{c}" for c in cols.split(", "))
    diff = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in check)
    where = f"WHERE {op_filter}" if op_filter else ""
    return f"""
WITH {_runs(table, bronze)},
     f1 AS (SELECT * FROM s1 {where}),
     f2 AS (SELECT * FROM s2 {where}),
     h1 AS (SELECT {cols}, {scd_id([key], CHECK_RUN_1)} AS scd_id, {CHECK_RUN_1} AS scd_updated_at,
                   {CHECK_RUN_1} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM f1)
SELECT {ocols}, o.scd_id, o.scd_updated_at, o.valid_from,
       CASE WHEN n.{key} IS NOT NULL AND ({diff}) THEN {CHECK_RUN_2} ELSE o.valid_to END AS valid_to
FROM h1 o LEFT JOIN f2 n ON o.{key} = n.{key}
UNION ALL
SELECT {ncols}, {scd_id(['n.' + key], CHECK_RUN_2)}, {CHECK_RUN_2}, {CHECK_RUN_2}, CAST(NULL AS TIMESTAMP)
FROM f2 n LEFT JOIN h1 o ON o.{key} = n.{key}
WHERE o.{key} IS NULL OR ({diff})"""


register("snapshot_ts_accounts", snapshot_ts_sql("accounts", "account_id", "account_updated_at", BRONZE_ACCOUNTS))
register("snapshot_ts_customers", snapshot_ts_sql("customers", "customer_id", "customer_updated_at", BRONZE_CUSTOMERS))
register("snapshot_check_customers", snapshot_check_sql(
    "customers", "customer_id", ["full_name", "email", "phone", "nationality"], BRONZE_CUSTOMERS))
register("snapshot_check_accounts", snapshot_check_sql(
    "accounts", "account_id", ["account_type", "balance", "currency"], BRONZE_ACCOUNTS))
register("snapshot_op_filter", snapshot_check_sql(
    "customers", "customer_id", ["full_name", "email", "phone", "nationality"],
    BRONZE_CUSTOMERS.replace(OP_OF_EVENT, "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'view' THEN 'r' ELSE 'u' END"),
    op_filter="cdc_op IN ('u', 'c')"))


# --- incremental silver -----------------------------------------------------------

CUT_1 = "TIMESTAMP '2024-01-15 00:00:00'"
CUT_2 = "TIMESTAMP '2024-01-29 00:00:00'"


def _before(src: str, cut: str) -> str:
    return f"SELECT * FROM ({src}) b WHERE ingested_at < {cut}"


register("high_water_mark", f"SELECT max(ingested_at) AS mark FROM ({silver_accounts_sql(_before(BRONZE_ACCOUNTS, CUT_1))}) t")
register("silver_incremental", silver_accounts_sql())
register("silver_upsert", f"""
WITH target AS ({silver_accounts_sql(_before(BRONZE_ACCOUNTS, CUT_2))}),
     upd AS ({silver_accounts_sql(f"SELECT * FROM ({BRONZE_ACCOUNTS}) b WHERE ingested_at >= (SELECT max(ingested_at) FROM target)")})
SELECT * FROM upd
UNION ALL
SELECT * FROM target WHERE account_id NOT IN (SELECT account_id FROM upd)""")


# --- change messages ---------------------------------------------------------------

ACC_FIELDS = "account_id, customer_id, bank_id, account_type, balance, currency, account_status, opened_at, updated_at"
ACC_MSGS = BRONZE_ACCOUNTS.replace(
    "\n  FROM events", ", user_id AS ev_user_id, props AS ev_props, event_type AS ev_event_type\n  FROM events")
ACC_NULLS = ", ".join(f"CAST(NULL AS {t}) AS {n}" for n, t in [
    ("account_id", "INTEGER"), ("customer_id", "INTEGER"), ("bank_id", "INTEGER"), ("account_type", "VARCHAR"),
    ("balance", "DOUBLE"), ("currency", "VARCHAR"), ("account_status", "VARCHAR"), ("opened_at", "BIGINT"),
    ("updated_at", "BIGINT")])
PART = "CAST(ev_user_id % 4 AS INTEGER)"


def _acc_msgs(where: str = "") -> str:
    w = f" AND ({where})" if where else ""
    return f"SELECT * FROM ({ACC_MSGS}) m WHERE ev_event_type <> 'purchase'{w}"


register("cdc_demux", f"""
SELECT 'accounts' AS table_name, {PART} AS message_partition, source_offset * 2 AS message_offset,
       false AS is_tombstone FROM ({_acc_msgs()}) m
UNION ALL
SELECT 'accounts', {PART}, source_offset * 2 + 1, true FROM ({_acc_msgs("cdc_op = 'd'")}) m""")

CDC_PARSE = f"""
SELECT {ACC_FIELDS}, cdc_op, source_ts_ms, {PART} AS source_partition, source_offset * 2 AS source_offset
FROM ({_acc_msgs()}) m
UNION ALL
SELECT {ACC_NULLS}, CAST(NULL AS VARCHAR) AS cdc_op, CAST(NULL AS BIGINT) AS source_ts_ms,
       {PART} AS source_partition, source_offset * 2 + 1 AS source_offset
FROM ({_acc_msgs("cdc_op = 'd'")}) m"""
register("cdc_parse", CDC_PARSE)
register("replay_dedup", CDC_PARSE)

register("cdc_quarantine", f"""
SELECT {PART} AS source_partition, source_offset * 2 AS source_offset,
       CASE WHEN ev_props = '{{"k": 42}}' THEN account_id END AS account_id,
       CAST(NULL AS DOUBLE) AS balance,
       CASE WHEN ev_props = '{{"k": 42}}' THEN cdc_op END AS cdc_op
FROM ({_acc_msgs("ev_props IN ('{\"k\": 13}', '{\"k\": 42}')")}) m""")

register("cdc_unwrap", f"""
SELECT source_offset * 2 AS message_offset, {ACC_FIELDS}, cdc_op AS __op, 'accounts' AS __table,
       source_ts_ms AS __source_ts_ms
FROM ({_acc_msgs()}) m
UNION ALL
SELECT source_offset * 2 + 1, {ACC_NULLS}, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)
FROM ({_acc_msgs("cdc_op = 'd'")}) m""")

BAD_PROPS = "ev_props IN ('{\"k\": 13}', '{\"k\": 42}')"
register("ingest_quarantine", f"""
SELECT 'bronze' AS place, {PART} AS source_partition, source_offset * 2 AS source_offset, account_id, cdc_op
FROM ({_acc_msgs(f"({BAD_PROPS}) IS NOT TRUE")}) m
UNION ALL
SELECT 'bronze', {PART}, source_offset * 2 + 1, NULL, NULL FROM ({_acc_msgs("cdc_op = 'd'")}) m
UNION ALL
SELECT 'quarantine', {PART}, source_offset * 2, NULL, NULL FROM ({_acc_msgs(BAD_PROPS)}) m""")
register("ingest_envelope", CDC_PARSE)

register("epoch_ms", f"""
SELECT event_id, {ms('ts')} AS ts_ms, make_timestamp_ms({ms('ts')}) AS ts_back FROM events""")

APPEND_DATE = f"CASE WHEN ingested_at < {CUT_1} THEN DATE '2024-01-15' ELSE DATE '2024-02-01' END"
register("bronze_append", f"""
SELECT {ACC_FIELDS}, cdc_op, {APPEND_DATE} AS ingestion_date, source_ts_ms, {PART} AS source_partition,
       source_offset * 2 AS source_offset
FROM ({_acc_msgs()}) m
UNION ALL
SELECT {ACC_NULLS}, CAST(NULL AS VARCHAR), {APPEND_DATE}, CAST(NULL AS BIGINT), {PART}, source_offset * 2 + 1
FROM ({_acc_msgs("cdc_op = 'd'")}) m""")

TXN_FIELDS = """transaction_id, account_id, type, amount, currency, exchange_rate, amount_in_usd, status, channel, country,
       city, description, created_at, updated_at"""


def _txn_rows(run: str, date: str) -> str:
    return f"""
SELECT '{run}' AS run, 'bronze' AS place, {TXN_FIELDS}, cdc_op, {date} AS ingestion_date, source_ts_ms,
       account_id % 4 AS source_partition, source_offset * 2 AS source_offset
FROM ({BRONZE_TRANSACTIONS}) t"""


register("ingest_transactions", " UNION ALL ".join(
    [_txn_rows("append", APPEND_DATE), *[_txn_rows(r, "DATE '2024-01-15'") for r in ("replay", "quarantine", "envelope")]]))

register("dead_letter", f"""
SELECT 'banking.banking.accounts' AS topic, source_offset * 2 AS "offset", ingested_at AS "timestamp",
       false AS is_tombstone FROM ({_acc_msgs()}) m
UNION ALL
SELECT 'banking.banking.accounts', source_offset * 2 + 1, ingested_at, true FROM ({_acc_msgs("cdc_op = 'd'")}) m""")

BRONZE_FIELDS = ACC_FIELDS + ", cdc_op, ingested_at, ingestion_date, source_ts_ms, source_partition, source_offset"
register("bronze_load", f"SELECT {BRONZE_FIELDS} FROM ({BRONZE_ACCOUNTS}) b")
register("bronze_mixed_load", f"SELECT {BRONZE_FIELDS} FROM ({BRONZE_ACCOUNTS}) b")
register("load_by_name", f"SELECT {BRONZE_FIELDS.replace('currency', 'CAST(NULL AS VARCHAR) AS currency')} FROM ({BRONZE_ACCOUNTS}) b")
register("gold_append_twice", f"{SQL['dim_banks']} UNION ALL {SQL['dim_banks']}")


# --- quality checks -----------------------------------------------------------------

register("chk_unique", f"SELECT leg_id, count(*) AS n_rows FROM ({BRONZE_LEGS}) b GROUP BY leg_id HAVING count(*) > 1")
register("chk_fk", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE o_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
register("chk_domain", f"""
SELECT 'orders.o_orderstatus' AS rule, o_orderkey AS row_key, o_orderstatus AS value FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')
UNION ALL
SELECT 'transactions.channel', CAST(transaction_id AS BIGINT), channel FROM ({silver_transactions_sql()}) t
WHERE channel IS NOT NULL AND channel NOT IN ('online', 'mobile', 'atm', 'branch', 'card')""")
register("chk_balance", f"""
SELECT transaction_id, CAST(debit_total AS DOUBLE) AS debit_total, CAST(credit_total AS DOUBLE) AS credit_total
FROM (SELECT transaction_id,
             SUM(CASE WHEN direction = 'debit' THEN CAST(amount AS DECIMAL(18,2)) END) AS debit_total,
             SUM(CASE WHEN direction = 'credit' THEN CAST(amount AS DECIMAL(18,2)) END) AS credit_total
      FROM ({silver_legs_sql()}) l GROUP BY transaction_id) s
WHERE abs(coalesce(debit_total, 0) - coalesce(credit_total, 0)) > 0.01""")
register("chk_fx", f"""
SELECT transaction_id, amount, amount_in_usd, channel FROM ({silver_transactions_sql()}) t
WHERE abs(amount_in_usd - round(amount * coalesce(exchange_rate, 1.0), 2)) > 0.01""")


# --- one whole pipeline run: snapshots after a single run ------------------------

RUN_CTES = f"""
WITH t AS ({silver_transactions_sql()}),
     accounts AS ({silver_accounts_sql()}),
     customers AS ({silver_customers_sql()}),
     a AS (SELECT *, account_updated_at AS valid_from FROM accounts),
     c AS (SELECT *, customer_updated_at AS valid_from FROM customers),
     legs AS ({silver_legs_sql()}),
     banks AS ({DIM_BANKS})
"""
register("pipeline_run", f"{RUN_CTES} {FACT}")
register("pipeline_reporting", f"{RUN_CTES} {REPORT}")


def _twice(name: str, table: str, col: str) -> str:
    return f"SELECT '{name}' AS \"check\", count(*) - count(*) FILTER (n = 1) AS n FROM (SELECT count({col}) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}) g"


def _orphans(name: str, child: str, col: str, parent: str) -> str:
    return f"SELECT '{name}', count(*) FROM {child} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {col} FROM {parent})"


def _outside(name: str, table: str, col: str, allowed: str) -> str:
    return f"SELECT '{name}', count(*) FROM {table} WHERE {col} NOT IN ({allowed})"


register("pipeline_checks", RUN_CTES + " UNION ALL ".join([
    _twice("unique_transactions", "t", "transaction_id"), _twice("unique_customers", "customers", "customer_id"),
    _twice("unique_accounts", "accounts", "account_id"), _twice("unique_transaction_legs", "legs", "leg_id"),
    _twice("unique_customer_email", "customers", "email"), _twice("unique_banks", "banks", "bank_id"),
    _twice("unique_bank_swift_code", "banks", "swift_code"),
    _orphans("fk_account_customer", "accounts", "customer_id", "customers"),
    _orphans("fk_account_bank", "accounts", "bank_id", "banks"),
    _orphans("fk_transaction_account", "t", "account_id", "accounts"),
    _orphans("fk_leg_transaction", "legs", "transaction_id", "t"),
    _orphans("fk_leg_account", "legs", "account_id", "accounts"),
    _orphans("fk_leg_bank", "legs", "bank_id", "banks"),
    _outside("domain_account_type", "accounts", "account_type", "'current', 'savings'"),
    _outside("domain_account_status", "accounts", "account_status", "'active', 'frozen', 'dormant', 'closed'"),
    _outside("domain_channel", "t", "channel", "'online', 'mobile', 'atm', 'branch', 'card'"),
    _outside("domain_type", "t", "transaction_type", "'deposit', 'withdrawal', 'transfer'"),
    _outside("domain_status", "t", "status", "'pending', 'completed', 'failed'"),
    _outside("domain_direction", "legs", "direction", "'debit', 'credit'"),
    f"SELECT 'fx', count(*) FROM ({SQL['chk_fx']}) x", f"SELECT 'balance', count(*) FROM ({SQL['chk_balance']}) x",
    "SELECT 'overlap_accounts_history', 0", "SELECT 'overlap_customers_history', 0"]))

register("chk_overlap", f"""
SELECT customer_id, source_offset, valid_from FROM (
  SELECT customer_id, source_offset, valid_from, valid_to,
         lag(valid_from) OVER w AS prev_from, lag(valid_to) OVER w AS prev_to
  FROM (SELECT customer_id, source_offset, ingested_at AS valid_from, ingested_at + INTERVAL 1 HOUR AS valid_to
        FROM ({BRONZE_CUSTOMERS}) b) h
  WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from, valid_to NULLS LAST)) x
WHERE prev_from IS NOT NULL AND (prev_to IS NULL OR prev_to > valid_from)""")


# --- late changes, rejects, all topics -------------------------------------------------

register("silver_late", f"""
SELECT 'accounts' AS table_name, account_id AS row_key, balance AS amount_or_balance, cdc_op, ingested_at, ingestion_date
FROM ({silver_accounts_sql()}) a
UNION ALL
SELECT 'transactions', transaction_id, amount, cdc_op, ingested_at, ingestion_date FROM ({silver_transactions_sql()}) t""")
register("silver_lookback", silver_accounts_sql())

register("load_rejects", f"""
SELECT 'bronze' AS place, account_id, CASE WHEN source_offset % 3 <> 2 THEN balance END AS balance, source_ts_ms, source_offset,
       CAST(NULL AS VARCHAR) AS reject_column, CAST(NULL AS VARCHAR) AS reject_value, CAST(NULL AS VARCHAR) AS staged
FROM ({BRONZE_ACCOUNTS}) b WHERE NOT (source_offset % 3 = 1 AND account_type = 'click')
UNION ALL
SELECT 'rejects', NULL, NULL, NULL, source_offset, 'source_ts_ms', 'n/a', 'text'
FROM ({BRONZE_ACCOUNTS}) b WHERE source_offset % 3 = 1 AND account_type = 'click'""")

register("ingest_envelope_quarantine", f"""
SELECT 'bronze' AS place, 'accounts' AS table_name, {PART} AS source_partition, source_offset * 2 AS source_offset,
       account_id AS row_key, cdc_op
FROM ({_acc_msgs(f"({BAD_PROPS}) IS NOT TRUE")}) m
UNION ALL
SELECT 'bronze', 'accounts', {PART}, source_offset * 2 + 1, NULL, NULL FROM ({_acc_msgs("cdc_op = 'd'")}) m
UNION ALL
SELECT 'quarantine', 'accounts', {PART}, source_offset * 2, NULL, NULL FROM ({_acc_msgs(BAD_PROPS)}) m
UNION ALL
SELECT 'bronze', 'transactions', account_id % 4, source_offset * 2, transaction_id, cdc_op FROM ({BRONZE_TRANSACTIONS}) t""")

AT = "DATE '2024-01-15'"
CUS_MSGS = BRONZE_CUSTOMERS.replace("\n  FROM events", ", user_id AS ev_user_id\n  FROM events")
BANK_ROWS = f"bank_id, cdc_op, source_ts_ms, 0, source_offset * 2, {AT} FROM ({BRONZE_BANKS}) b"
register("ingest_all_topics", f"""
SELECT 'bronze' AS place, 'accounts' AS table_name, account_id AS row_key, cdc_op, source_ts_ms, {PART} AS source_partition,
       source_offset * 2 AS source_offset, {AT} AS ingestion_date
FROM ({_acc_msgs(f"({BAD_PROPS}) IS NOT TRUE")}) m
UNION ALL
SELECT 'bronze', 'accounts', NULL, NULL, NULL, {PART}, source_offset * 2 + 1, {AT} FROM ({_acc_msgs("cdc_op = 'd'")}) m
UNION ALL
SELECT 'bronze', 'customers', customer_id, cdc_op, source_ts_ms, {PART}, source_offset * 2, {AT} FROM ({CUS_MSGS}) c
UNION ALL
SELECT 'bronze', 'transactions', transaction_id, cdc_op, source_ts_ms, account_id % 4, source_offset * 2, {AT} FROM ({BRONZE_TRANSACTIONS}) t
UNION ALL
SELECT 'bronze', 'transaction_legs', leg_id, cdc_op, source_ts_ms, transaction_id % 4, source_offset * 2, {AT} FROM ({BRONZE_LEGS}) l
UNION ALL
SELECT 'bronze', 'banks', {BANK_ROWS}
UNION ALL
SELECT 'strict/bronze', 'banks', {BANK_ROWS}
UNION ALL
SELECT 'quarantine', 'accounts', NULL, NULL, NULL, {PART}, source_offset * 2, NULL FROM ({_acc_msgs(BAD_PROPS)}) m
UNION ALL
SELECT 'dead_letter', 'accounts', NULL, NULL, NULL, NULL, source_offset * 2, NULL FROM ({_acc_msgs()}) m
UNION ALL
SELECT 'dead_letter', 'accounts', NULL, NULL, NULL, NULL, source_offset * 2 + 1, NULL FROM ({_acc_msgs("cdc_op = 'd'")}) m""")

_SNAP = "CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP)"
register("pipeline_tables", f"""{RUN_CTES}
SELECT 'snapshot_accounts' AS table_name, account_id AS row_key, account_type AS label, {scd_id(['account_id'], 'valid_from')} AS scd_id,
       valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM a
UNION ALL
SELECT 'snapshot_customers', customer_id, email, {scd_id(['customer_id'], 'valid_from')}, valid_from, NULL FROM c
UNION ALL SELECT 'dim_accounts', account_id, account_type, {_SNAP} FROM a
UNION ALL SELECT 'dim_customers', customer_id, email, {_SNAP} FROM c
UNION ALL SELECT 'dim_banks', bank_id, swift_code, {_SNAP} FROM banks""")

# versions of both runs; a version of the first may end long before the second opens none
register("gold_incremental", f"""
WITH t AS ({silver_transactions_sql()}),
     ah AS ({SQL['snapshot_ts_accounts']}),
     ch AS ({SQL['snapshot_ts_customers']}),
     legs AS ({silver_legs_sql()})
SELECT {TXN_SEL}, {FACT_SEL}, {RECEIVER}
FROM t
LEFT JOIN ah a ON a.account_id = t.account_id AND a.valid_from <= t.transaction_created_at
  AND (a.valid_to IS NULL OR a.valid_to > t.transaction_created_at)
LEFT JOIN ch c ON c.customer_id = a.customer_id AND c.valid_from <= t.transaction_created_at
  AND (c.valid_to IS NULL OR c.valid_to > t.transaction_created_at)
{CREDITS}""")
