"""Runs that stop and go on, batches delivered again, gold by changes, and many
rules in one pass."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark.config import topic_of
from tidemark.operators import quality
from tidemark.plans import fixtures as fx
from tidemark.plans import gold, pipeline
from tidemark.plans.pipeline import (PipelineConfig, check_counts, read_gold, read_history, read_silver, run_gold, run_pipeline,
                                     run_silver, run_snapshots)
from tidemark.schemas import BRONZE_SCHEMAS
from tidemark.sources import commit
from tidemark.sources.changes import read_changes
from tidemark.sources.tables import HistoryTable, PartitionedTable, backfill_bronze, read_bronze, remove
from tidemark.streaming import ingest
from tidemark.streaming.ingest import ingest_batch, start_ingest

SF = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 1, 15)
RUN_AT = dt.datetime(2024, 2, 1)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


# --- ingest ------------------------------------------------------------------------

def places(scratch, spark):
    out = {}
    for place in ("bronze", "bad", "dead"):
        for t in ("accounts", "transactions"):
            p = f"{scratch}/{place}/{t}"
            if os.path.exists(p) and any(not x.startswith(("_", ".")) for x in os.listdir(p)):
                out[place, t] = spark.read.parquet(p).count()
    return out


@pytest.mark.parametrize("stop", [None, "after quarantine", "after bronze", "in commit", "after commit"])
def test_a_batch_delivered_again_leaves_what_one_delivery_leaves(spark, scratch, monkeypatch, stop):
    msgs = fx.change_messages(spark, SF, corrupt=True).persist()
    kw = dict(bronze_root=f"{scratch}/bronze", dead_letter_root=f"{scratch}/dead", quarantine_root=f"{scratch}/bad", ledger=f"{scratch}/units",
              topics=[topic_of("accounts")], at=AT)

    def killed(name, module, after=True):
        do = getattr(module, name)

        def then(*a, **k):
            if after:
                do(*a, **k)
            raise SystemExit("killed")  # no failure of the slice: the process is gone
        monkeypatch.setattr(module, name, then)

    if stop == "after quarantine":
        killed("write_quarantine", ingest)
    elif stop == "after bronze":
        killed("append_bronze", ingest)
    elif stop == "in commit":
        killed("_move", commit.Unit, after=False)
    elif stop == "after commit":
        killed("commit", commit.Unit)
    if stop:
        with pytest.raises(SystemExit):
            ingest_batch(msgs, 4, **kw)
        monkeypatch.undo()
        if stop in ("after quarantine", "after bronze"):
            assert places(scratch, spark) == {}
    for _ in range(2):
        metrics = {}
        assert ingest_batch(msgs, 4, **kw, metrics=metrics) == {"accounts": "ok"}
    total = msgs.filter(F.col("topic") == topic_of("accounts")).count()
    got = places(scratch, spark)
    assert got["bronze", "accounts"] + got["bad", "accounts"] == total and got["bad", "accounts"] > 0
    assert metrics == {"accounts": got["bronze", "accounts"]} and ("dead", "accounts") not in got
    ingest_batch(msgs, 5, **kw)  # another batch is another
    assert places(scratch, spark) == {k: 2 * n for k, n in got.items()}


def test_dead_letters_of_a_batch_delivered_again_are_written_once(spark, scratch):
    msgs = fx.change_messages(spark, SF, corrupt=True, envelope=True).persist()
    kw = dict(bronze_root=f"{scratch}/bronze", dead_letter_root=f"{scratch}/dead", quarantine_root=f"{scratch}/bad", ledger=f"{scratch}/units",
              envelope=True, parse_mode="FAILFAST")
    for _ in range(2):
        status = ingest_batch(msgs, 0, **kw)
        assert status["transactions"] == "ok" and status["accounts"].startswith("MalformedMessages")
    got = places(scratch, spark)
    assert got["dead", "accounts"] == msgs.filter(F.col("topic") == topic_of("accounts")).count()
    assert got["bronze", "transactions"] == msgs.filter(F.col("topic") == topic_of("transactions")).count()
    assert ("bronze", "accounts") not in got and ("bad", "accounts") not in got


def test_envelopes_with_mistyped_fields_keep_their_text(spark, scratch):
    msgs = fx.change_messages(spark, SF, corrupt=True, envelope=True)
    ingest_batch(msgs, 0, bronze_root=f"{scratch}/bronze", dead_letter_root=f"{scratch}/dead", quarantine_root=f"{scratch}/bad", envelope=True)
    bad = spark.read.parquet(f"{scratch}/bad/accounts")
    assert bad.filter(F.col("value").contains('"balance":"n/a"')).count() > 0
    assert read_bronze(spark, "accounts", f"{scratch}/bronze/accounts").filter("account_id IS NOT NULL AND balance IS NULL").count() == 0


def test_a_ledger_does_not_cover_catalog_tables(spark, scratch):
    with pytest.raises(ValueError, match="ledger"):
        ingest_batch(spark.createDataFrame([], "topic string"), 0, bronze_root="x", dead_letter_root="y", ledger="z", catalog="c")


def test_processing_time_trigger_runs_batch_after_batch(spark, scratch):
    msgs = fx.change_messages(spark, SF).filter(F.col("topic") == topic_of("transactions")).persist()
    n = msgs.count()
    src = f"{scratch}/src"
    msgs.filter("offset % 4 = 0").coalesce(1).write.mode("append").parquet(src)
    q = start_ingest(read_changes(spark, "files", path=src), f"{scratch}/ck", bronze_root=f"{scratch}/bronze",
                     dead_letter_root=f"{scratch}/dead", processing_time="1 second")
    try:
        end = time.time() + 60
        while q.lastProgress is None and time.time() < end:
            time.sleep(0.2)
        msgs.filter("offset % 4 <> 0").coalesce(1).write.mode("append").parquet(src)
        while read_bronze(spark, "transactions", f"{scratch}/bronze/transactions").count() < n and time.time() < end:
            time.sleep(0.5)
    finally:
        q.stop()
    assert q.exception() is None and read_bronze(spark, "transactions", f"{scratch}/bronze/transactions").count() == n
    assert {f"transactions-{i}.json" for i in (0, 1)} <= set(os.listdir(f"{scratch}/ck/_units"))


def test_catalog_tables_are_created_and_appended_to(spark, scratch):
    msgs = fx.change_messages(spark, SF)
    src = f"{scratch}/src"
    msgs.write.parquet(src)
    spark.sql("CREATE DATABASE IF NOT EXISTS lake LOCATION '" + f"{scratch}/db'")
    try:
        q = start_ingest(read_changes(spark, "files", path=src), f"{scratch}/ck", bronze_root="unused", dead_letter_root=f"{scratch}/dead",
                         available_now=True, catalog="lake", catalog_using="parquet", catalog_location=f"{scratch}/tables")
        q.awaitTermination()
        assert q.exception() is None
        assert sorted(r.tableName for r in spark.sql("SHOW TABLES IN lake").collect()) == sorted(BRONZE_SCHEMAS)
        for t in ("accounts", "transactions", "banks"):
            assert spark.table(f"lake.{t}").count() == msgs.filter(F.col("topic") == topic_of(t)).count()
        assert spark.table("lake.accounts").filter("cdc_op = 'd' AND account_id IS NULL").count() == 0
    finally:
        spark.sql("DROP DATABASE lake CASCADE")


# --- pipeline runs ---------------------------------------------------------------------

def logs(spark):
    legs = fx.bronze_transaction_legs(spark, SF).withColumn("ingestion_date", F.trunc("ingestion_date", "YEAR"))
    return {"accounts": fx.bronze_accounts(spark, SF), "customers": fx.bronze_customers(spark, SF),
            "transactions": fx.bronze_transactions(spark, SF), "transaction_legs": legs, "banks": fx.bronze_banks(spark, SF)}


def write(spark, cfg, table, df):
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE_SCHEMAS[table].fields])
    backfill_bronze(rows.withColumn("ingestion_date", F.trunc("ingestion_date", "MONTH")), cfg.path("bronze", table))


def test_gold_by_changes_equals_gold_anew_after_every_run(spark, scratch):
    cfg = PipelineConfig(root=f"{scratch}/lake", gold_partitions="floor(transaction_id / 100)", run_at=RUN_AT)
    all_ = logs(spark)
    for k in range(3):
        for table, df in all_.items():
            late = F.col("source_offset") % 3  # a third each run, whatever its time
            write(spark, cfg, table, df.filter(late == k))
        run_silver(spark, cfg), run_snapshots(spark, cfg, RUN_AT), run_gold(spark, cfg)
        parts = [read_silver(spark, cfg, "transactions"), read_history(spark, cfg, "accounts"), read_history(spark, cfg, "customers")]
        legs = read_silver(spark, cfg, "transaction_legs")
        assert same(gold.fct_transactions(*parts, legs), read_gold(spark, cfg, "fct_transactions"))
        assert same(gold.transactions_reporting(*parts, legs), read_gold(spark, cfg, "gold_transactions_reporting"))
    fact = PartitionedTable(spark, cfg.path("gold", "fct_transactions"), pipeline.GOLD_PART)
    before = fact.commit()
    run_silver(spark, cfg), run_snapshots(spark, cfg, RUN_AT), run_gold(spark, cfg)  # nothing new
    assert fact.commit()["parts"] == before["parts"]
    # one late leg reaches the partition of its transaction, and no other
    one = all_["transaction_legs"].limit(1).withColumns({"leg_id": F.lit(7), "cdc_op": F.lit("c"), "direction": F.lit("credit"), "transaction_id": F.lit(150),
                                                         "external_account_name": F.lit("late")})
    write(spark, cfg, "transaction_legs", one)
    run_silver(spark, cfg), run_snapshots(spark, cfg, RUN_AT), run_gold(spark, cfg)
    after = fact.commit()
    assert [n for n, r in after["parts"].items() if before["parts"].get(n) != r] in (["gold_part=1"], [])
    parts = [read_silver(spark, cfg, "transactions"), read_history(spark, cfg, "accounts"), read_history(spark, cfg, "customers")]
    assert same(gold.fct_transactions(*parts, read_silver(spark, cfg, "transaction_legs")), read_gold(spark, cfg, "fct_transactions"))
    # a silver table that is thrown away is built anew, and gold with it
    remove(spark, cfg.path("silver", "transaction_legs"))
    run_silver(spark, cfg), run_gold(spark, cfg)
    assert same(gold.fct_transactions(*parts, read_silver(spark, cfg, "transaction_legs")), read_gold(spark, cfg, "fct_transactions"))


def test_changed_since_names_the_earliest_time(spark):
    ts = lambda n: f"TIMESTAMP_NTZ'2024-01-0{n} 00:00:00'"
    rows = lambda *r: spark.sql(" UNION ALL ".join(f"SELECT {k} AS k, {a} AS valid_from, {b} AS valid_to" for k, a, b in r))
    none = "CAST(NULL AS TIMESTAMP_NTZ)"
    before = rows((1, ts(1), none), (2, ts(1), none), (3, ts(1), none))
    opened = rows((1, ts(1), none), (2, ts(4), none), (3, ts(5), none), (4, ts(2), none))
    closed = rows((2, ts(1), ts(4)), (3, ts(1), ts(2)), (3, ts(2), ts(5)))
    got = {r[0]: r[1].day for r in pipeline.changed_since(before, opened, closed, "k").collect()}
    assert got == {2: 4, 3: 2, 4: 2}


def test_a_run_killed_after_any_stage_goes_on(spark, scratch, monkeypatch):
    few = {t: df.filter("source_offset % 5 = 0") for t, df in logs(spark).items()}
    whole = PipelineConfig(root=f"{scratch}/whole", run_at=RUN_AT, snapshot_strategy="check")
    cut = PipelineConfig(root=f"{scratch}/cut", run_at=RUN_AT, snapshot_strategy="check", gold_mode="append")
    for cfg in (whole, cut):
        for table, df in few.items():
            write(spark, cfg, table, df)
    run_pipeline(spark, whole)
    kept, stage = [], pipeline.RunLedger.stage

    def killed(self, name, do):
        if name in self.state["done"]:
            return self.state["done"][name]
        if name.startswith(("snapshots/accounts", "gold/dim_banks", "gold/fct")) and name not in kept:
            kept.append(name)
            do()  # committed, but not recorded
            raise SystemExit("killed")
        return stage(self, name, do)

    monkeypatch.setattr(pipeline.RunLedger, "stage", killed)
    for _ in range(3):
        with pytest.raises(SystemExit):
            # a later clock must not matter: the run keeps its own time
            run_pipeline(spark, PipelineConfig(**{**cut.__dict__, "run_at": RUN_AT + dt.timedelta(days=len(kept))}))
    monkeypatch.undo()
    run_pipeline(spark, cut)
    assert len(kept) == 3
    for t in ("accounts", "customers"):
        assert HistoryTable(spark, cut.path("snapshots", t)).last_run() == 1
        assert same(read_history(spark, whole, t), read_history(spark, cut, t))
    for name in ("dim_accounts", "dim_banks", "fct_transactions", "gold_transactions_reporting"):
        assert same(read_gold(spark, whole, name), read_gold(spark, cut, name)), name
    assert pipeline.RunLedger(spark, cut).run == 2  # the next call begins a new run


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


# --- rules in one pass -----------------------------------------------------------------------

def test_fused_counts_equal_the_single_checks_with_one_scan_per_table(spark, scratch):
    p = f"{scratch}/t"
    spark.range(400).selectExpr("CASE WHEN id % 9 = 0 THEN NULL ELSE id % 90 END AS k", "CASE WHEN id % 2 = 0 THEN 'x' ELSE 'z' END AS d",
                                "id % 120 AS ref", "CAST(id AS DOUBLE) / 3 AS amount",
                                "CASE WHEN id % 3 = 0 THEN 'debit' WHEN id % 3 = 1 THEN 'credit' END AS direction").write.parquet(f"{p}/a")
    spark.range(100).selectExpr("CASE WHEN id = 5 THEN NULL ELSE id END AS b", "concat('m', id % 60) AS mail").write.parquet(f"{p}/b")
    a, b = spark.read.parquet(f"{p}/a"), spark.read.parquet(f"{p}/b")
    rules = [quality.Unique("ua", "a", "k"), quality.Unique("ub", "b", "mail"), quality.Unique("gone", "c", "x"), quality.Foreign("fk", "a", "ref", "b", "b"),
             quality.Foreign("fk2", "a", "k", "b", "b"), quality.Rule("dom", "a", quality.outside("d", ["x"])), quality.Balance("bal", "a", "k")]
    counts = quality.count_violations({"a": a, "b": b}, rules)
    assert {r[0]: r[1] for r in counts.collect()} == {
        "ua": quality.violations_unique(a.dropna(subset=["k"]), ["k"]).count(), "ub": quality.violations_unique(b, ["mail"]).count(),
        "fk": quality.violations_fk(a, b, ["ref"], ["b"]).count(), "fk2": quality.violations_fk(a, b, ["k"], ["b"]).count(),
        "dom": quality.violations_domain(a, "d", ["x"]).count(), "bal": quality.violations_balance(a, "k").count()}
    assert scans(counts) == 2
    assert {r[0]: r[1] for r in quality.count_violations({"a": a.limit(0), "b": b.limit(0)}, rules).collect()} == dict.fromkeys(
        ["ua", "ub", "fk", "fk2", "dom", "bal"], 0)
    assert quality.count_violations({}, rules) is None


def test_checks_of_a_run_scan_each_table_once(spark, scratch):
    cfg = PipelineConfig(root=f"{scratch}/lake", run_at=RUN_AT)
    for table, df in logs(spark).items():
        write(spark, cfg, table, df.filter("source_offset % 9 = 0"))
    run_pipeline(spark, cfg)
    assert scans(check_counts(spark, cfg)) == 7  # four silver tables, banks, two histories


def test_checks_of_a_run_are_kept_and_need_no_second_count(spark, scratch, monkeypatch):
    cfg = PipelineConfig(root=f"{scratch}/lake", run_at=RUN_AT)
    for table, df in logs(spark).items():
        write(spark, cfg, table, df.filter("source_offset % 9 = 0"))
    counted = run_pipeline(spark, cfg)["checks"]
    monkeypatch.setattr(pipeline, "check_counts", lambda *a: pytest.fail("counted again"))
    kept = pipeline.read_checks(spark, cfg)
    assert scans(kept) == 1 and {r["check"]: r["n"] for r in kept.collect()} == counted


def test_entries_of_fused_counts_are_numbers_and_made_in_generated_code(spark, scratch):
    spark.sql("SELECT * FROM VALUES (1, 'a', 'debit', 7036874417.93D), (1, 'b', 'credit', 7036874417.95D), (2, 'b', 'debit', 0.01D), "
              "(2, 'c', 'credit', 0.01D), (3, 'c', 'debit', 5e9D), (3, '3', 'credit', 5e9D), (CAST(NULL AS INT), 'd', 'debit', 7.0D) "
              "AS t(k, mail, direction, amount)").write.parquet(f"{scratch}/t")
    t = spark.read.parquet(f"{scratch}/t")
    rules = [quality.Unique("k", "t", "k"), quality.Foreign("mail", "t", "mail", "t", "k"), quality.Unique("m", "t", "mail"),
             quality.Foreign("self", "t", "k", "t", "k"), quality.Balance("bal", "t", "k")]
    counts = quality.count_violations({"t": t}, rules)
    assert {r[0]: r[1] for r in counts.collect()} == {"k": 3, "mail": 6, "m": 2, "self": 0, "bal": 2}
    assert quality.violations_balance(t, "k").count() == 2
    alone = quality.count_violations({"t": t}, [quality.Unique("k", "t", "k"), quality.Balance("bal", "t", "k")])
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "cast(k#" in plan and "as string" not in plan


# --- work that is done once ------------------------------------------------------------------

def test_a_committed_batch_is_not_read_again_and_a_callers_cache_stays(spark, scratch):
    msgs = fx.change_messages(spark, SF).persist()
    kw = {"bronze_root": f"{scratch}/bronze", "dead_letter_root": f"{scratch}/dead", "at": AT, "ledger": f"{scratch}/units",
          "topics": [topic_of("accounts"), topic_of("transactions")]}
    try:
        first = ingest_batch(msgs, 0, **kw)
        assert msgs.storageLevel.useMemory
    finally:
        msgs.unpersist()
    unread = msgs.filter(F.raise_error(F.lit("read again")).isNull())
    seen = {}
    assert ingest_batch(unread, 0, metrics=seen, **kw) == first == {"accounts": "ok", "transactions": "ok"}
    assert seen == {t: spark.read.parquet(f"{scratch}/bronze/{t}").count() for t in first}


@pytest.mark.parametrize("options", [{}, {"quarantine_root": "bad", "ledger": "units"}, {"parse_mode": "FAILFAST", "envelope": True}])
def test_a_slice_is_parsed_once_and_written_unsorted(spark, scratch, monkeypatch, options):
    options = {k: f"{scratch}/{v}" if k in ("quarantine_root", "ledger") else v for k, v in options.items()}
    plans, real = [], ingest.append_bronze

    def append(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        real(df, *args)

    monkeypatch.setattr(ingest, "append_bronze", append)
    msgs = fx.change_messages(spark, SF, envelope=options.get("envelope", False))
    assert ingest_batch(msgs, 0, bronze_root=f"{scratch}/bronze", dead_letter_root=f"{scratch}/dead", at=AT, topics=[topic_of("transactions")],
                        **options) == {"transactions": "ok"}
    assert plans[0].count("InMemoryRelation") == 1
    assert plans[0].index("ingestion_date") < plans[0].index("CollectMetrics")  # else the write sorts by the stamp
    assert spark.read.parquet(f"{scratch}/bronze/transactions").count() == msgs.filter(F.col("topic") == topic_of("transactions")).count()


def test_a_run_joins_the_legs_once_and_writes_silver_changes_once(spark, scratch, monkeypatch):
    cfg = PipelineConfig(root=f"{scratch}/lake", run_at=RUN_AT)
    for table, df in logs(spark).items():
        write(spark, cfg, table, df.filter("source_offset % 9 = 0"))
    joins, real = [], gold.left_join_fanout
    monkeypatch.setattr(gold, "left_join_fanout", lambda *a, **k: joins.append(a) or real(*a, **k))
    run_pipeline(spark, cfg)
    assert len(joins) == 1
    assert not [t for t in cfg.silver_tables if os.path.exists(cfg.path("silver", t, "_new"))]
    args = read_silver(spark, cfg, "transactions"), read_history(spark, cfg, "accounts"), read_history(spark, cfg, "customers")
    legs = read_silver(spark, cfg, "transaction_legs")
    assert same(read_gold(spark, cfg, "fct_transactions"), gold.fct_transactions(*args, legs))
    assert same(read_gold(spark, cfg, "gold_transactions_reporting"), gold.transactions_reporting(*args, legs))
