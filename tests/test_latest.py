import datetime as dt
import random

import pytest

from tidemark.operators.latest import (drop_deleted, high_water_mark, latest_per_key, live_rows,
                                       new_rows, upsert)
from tidemark.plans.silver import build_silver, live, silver_state

T0 = dt.datetime(2024, 1, 1)
COLS = "k int, v string, cdc_op string, ingested_at timestamp_ntz, source_ts_ms long, source_offset long"


def _df(spark, rows):
    return spark.createDataFrame(rows, COLS)


def _t(h):
    return T0 + dt.timedelta(hours=h)


def test_ties_broken_by_source_time_then_offset(spark):
    rows = [(1, "a", "u", _t(1), 10, 5), (1, "b", "u", _t(1), 11, 1), (1, "c", "u", _t(1), 11, 0),
            (2, "x", "u", _t(1), None, 1), (2, "y", "u", _t(1), 3, 0)]
    got = {r.k: r.v for r in latest_per_key(_df(spark, rows), ["k"]).collect()}
    assert got == {1: "b", 2: "y"}


def test_delete_filter_is_three_valued(spark):
    rows = [(1, "a", "c", _t(1), 1, 1), (1, "b", None, _t(2), 2, 2),
            (2, "a", "c", _t(1), 1, 3), (2, "b", "d", _t(2), 2, 4),
            (3, "a", "c", _t(1), 1, 5), (3, "b", "u", _t(2), 2, 6)]
    live = {r.k: r.v for r in live_rows(_df(spark, rows), ["k"]).collect()}
    assert live == {3: "b"}  # NULL op and delete both remove the key
    assert drop_deleted(_df(spark, rows)).count() == 4


def _bronze_accounts(spark, rows):
    base = ("account_id int, customer_id int, bank_id int, account_type string, balance double, currency string, "
            "account_status string, opened_at long, updated_at long, cdc_op string, ingested_at timestamp_ntz, "
            "ingestion_date date, source_ts_ms long, source_partition int, source_offset long")
    full = [(k, 1, 1, "current", bal, "GBP", "active", 0, 1000 * h, op, _t(h), _t(h).date(), h, 0, off)
            for (k, bal, op, h, off) in rows]
    return spark.createDataFrame(full, base)


def test_incremental_deletes_both_ways(spark):
    b = _bronze_accounts(spark, [(1, 10.0, "c", 1, 1), (2, 20.0, "c", 1, 2), (1, 11.0, "u", 30, 3),
                                 (2, 0.0, "d", 30, 4)])
    cut = b.filter(b.ingested_at < _t(24))
    t1 = build_silver("accounts", cut)
    applied = {r.account_id: r.balance for r in build_silver("accounts", b, t1).collect()}
    parity = {r.account_id: r.balance for r in build_silver("accounts", b, t1, apply_deletes=False).collect()}
    assert applied == {1: 11.0}
    assert parity == {1: 11.0, 2: 20.0}  # the original keeps a deleted row until a full refresh


def test_empty_target_means_full_load(spark):
    b = _bronze_accounts(spark, [(1, 10.0, "c", 1, 1), (2, 20.0, "c", 2, 2)])
    empty = build_silver("accounts", b).limit(0)
    assert high_water_mark(empty) is None
    rows, mark = new_rows(b, empty)
    assert mark is None and rows.count() == 2
    assert build_silver("accounts", b, empty).count() == 2


def test_strict_mark_skips_rows_sharing_the_mark(spark):
    b = _bronze_accounts(spark, [(1, 10.0, "c", 5, 1), (2, 20.0, "c", 5, 2)])
    target = build_silver("accounts", b.filter(b.account_id == 1))
    assert {r.account_id for r in build_silver("accounts", b, target).collect()} == {1, 2}
    strict = build_silver("accounts", b, target, strict_mark=True)
    assert {r.account_id for r in strict.collect()} == {1}


def test_lookback_does_not_let_stale_rows_win(spark):
    b = _bronze_accounts(spark, [(1, 10.0, "c", 1, 1), (1, 12.0, "u", 10, 2), (2, 5.0, "c", 1, 4), (2, 5.0, "d", 10, 5)])
    state = silver_state("accounts", b)
    late = _bronze_accounts(spark, [(1, 10.0, "c", 1, 1), (1, 12.0, "u", 10, 2), (1, 99.0, "u", 9, 3), (2, 7.0, "u", 9, 6)])
    out = live(silver_state("accounts", late, state, lookback=dt.timedelta(hours=5))).collect()
    assert [(r.account_id, r.balance) for r in out] == [(1, 12.0)]  # nor over a newer delete


def test_order_columns_must_be_there(spark):
    rows = _df(spark, [(1, "a", "u", _t(1), 1, 1)])
    with pytest.raises(ValueError, match="source_offset"):
        latest_per_key(rows.drop("source_offset"), ["k"])
    assert latest_per_key(rows.drop("source_offset"), ["k"], ["ingested_at"]).count() == 1


def test_silver_state_in_any_order_of_arrival_equals_a_full_refresh(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(12), float(off), rnd.choice(["c", "u", "u", "d", None]), rnd.randrange(60), off) for off in range(200)]
    full = sorted(tuple(r) for r in build_silver("accounts", _bronze_accounts(spark, rows)).collect())
    rnd.shuffle(rows)
    state = None
    for k in range(4):
        state = silver_state("accounts", _bronze_accounts(spark, rows[k * 50 : k * 50 + 50]), state, mark=_t(-1))
        state = spark.createDataFrame(state.collect(), state.schema)
    assert sorted(tuple(r) for r in live(state).collect()) == full


def test_upsert_replaces_by_key(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    u = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(tuple(r) for r in upsert(t, u, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "C")]


def test_incremental_in_k_batches_equals_full_refresh(spark):
    rnd = random.Random(7)
    rows = []
    for off in range(300):
        rows.append((rnd.randrange(25), float(off), rnd.choice(["c", "u", "u", "d", None]), rnd.randrange(100), off))
    b = _bronze_accounts(spark, rows)
    full = sorted(tuple(r) for r in build_silver("accounts", b).collect())
    target = None
    for cut in (20, 45, 70, 101):
        target = build_silver("accounts", b.filter(b.ingested_at < _t(cut)), target)
        target = spark.createDataFrame(target.collect(), target.schema)  # materialise each run
    assert sorted(tuple(r) for r in target.collect()) == full
    # re-running the last batch changes nothing
    again = build_silver("accounts", b, target)
    assert sorted(tuple(r) for r in again.collect()) == full


def test_partitioned_silver_rewrites_only_touched_partitions(spark, scratch):
    from tidemark.plans.pipeline import PipelineConfig, read_silver, run_silver
    from tidemark.sources.tables import backfill_bronze
    rnd = random.Random(11)
    rows = [(rnd.randrange(40), float(off), rnd.choice(["c", "u", "u", "d"]), rnd.randrange(100), off)
            for off in range(400)]
    # every key of partition 3 (keys 30-39) ends deleted in the last batch
    rows += [(k, 0.0, "d", 120, 1000 + k) for k in range(30, 40)]
    b = _bronze_accounts(spark, rows)
    part = {"accounts": "floor(account_id / 10)"}
    cfg = PipelineConfig(root=f"{scratch}/p", silver_tables=("accounts",), silver_partitions=part)
    bronze_path = cfg.path("bronze", "accounts")
    seen = 0
    for cut in (30, 60, 90, 200):
        batch = b.filter((b.ingested_at >= _t(seen)) & (b.ingested_at < _t(cut)))
        backfill_bronze(batch, bronze_path, 2)
        seen = cut
        run_silver(spark, cfg)
    full = sorted(tuple(r) for r in build_silver("accounts", b).collect())
    got = sorted(tuple(r) for r in read_silver(spark, cfg, "accounts").select(*build_silver("accounts", b).columns).collect())
    assert got == full
    assert all(r.account_id < 30 for r in read_silver(spark, cfg, "accounts").collect())
