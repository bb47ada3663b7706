import os
import sys

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "transaction_id" in df.columns


def test_every_query_matches_its_oracle(spark):
    import __spark_entry__ as E
    from oracle_check import TABLES, digest
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    bad = []
    for name, fn in sorted(qs.items()):
        df = fn(spark, SF)
        rows, cols = [tuple(r) for r in df.collect()], df.columns
        if name not in sql:
            continue
        cur = con.execute(sql[name])
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        if sorted(cols) != sorted(ocols) or digest(rows, cols)[0] != digest(orows, ocols)[0]:
            bad.append(name)
    assert bad == []


def test_results_do_not_depend_on_the_session_time_zone(spark):
    import __spark_entry__ as E
    from oracle_check import TABLES, digest
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sql = E.queries(), E.oracle_sql()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        bad = []
        for name in ["epoch_ms", "silver_accounts", "asof_customer", "snapshot_check_customers",
                     "silver_upsert", "bronze_append", "load_by_name"]:
            df = qs[name](spark, SF)
            cur = con.execute(sql[name])
            ocols = [d[0] for d in cur.description]
            if digest([tuple(r) for r in df.collect()], df.columns)[0] != digest(cur.fetchall(), ocols)[0]:
                bad.append(name)
        assert bad == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_ingest_queries_cover_the_transactions_topic(spark):
    import __spark_entry__ as E
    from oracle_check import digest
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    df = E.queries()["ingest_transactions"](spark, SF)
    rows, cur = [tuple(r) for r in df.collect()], con.execute(E.oracle_sql()["ingest_transactions"])
    want, columns = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(rows, df.columns)[0] == digest(want, columns)[0]
    purchases = con.execute("SELECT count(*) FROM events WHERE event_type = 'purchase'").fetchone()[0]
    run = df.columns.index("run")
    assert purchases > 0
    for name in ("append", "replay", "quarantine", "envelope"):
        assert sum(r[run] == name for r in rows) == purchases, name
