import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.scd2 import current, history_from_changes, snapshot_check, snapshot_timestamp

T0 = dt.datetime(2024, 1, 1)
COLS = "k int, name string, upd timestamp_ntz, cdc_op string"


def _t(d):
    return T0 + dt.timedelta(days=d)


def _cur(spark, rows):
    return spark.createDataFrame(rows, COLS)


def _check_invariants(h):
    """One open version per key, intervals disjoint and ordered."""
    opens = h.filter("valid_to IS NULL").groupBy("k").count().filter("count > 1").count()
    assert opens == 0
    w = Window.partitionBy("k").orderBy("valid_from")
    bad = (h.withColumn("prev_to", F.lag("valid_to").over(w))
            .filter("prev_to IS NULL AND valid_from IS NULL OR prev_to > valid_from").count())
    assert bad == 0


def test_timestamp_runs(spark):
    h1 = snapshot_timestamp(None, _cur(spark, [(1, "a", _t(1), "c"), (2, "b", _t(1), "c")]), ["k"], "upd")
    assert h1.filter("valid_to IS NULL").count() == 2
    run2 = _cur(spark, [(1, "a2", _t(3), "u"), (2, "b-old", _t(1), "u"), (3, "c", _t(2), "c")])
    h2 = snapshot_timestamp(h1, run2, ["k"], "upd")
    rows = {(r.k, r.name): (r.valid_from, r.valid_to) for r in h2.collect()}
    assert rows == {(1, "a"): (_t(1), _t(3)), (1, "a2"): (_t(3), None),
                    (2, "b"): (_t(1), None), (3, "c"): (_t(2), None)}
    # key 3 missing from run 3 stays open; an older row for key 1 is ignored
    h3 = snapshot_timestamp(h2, _cur(spark, [(1, "a-stale", _t(2), "u")]), ["k"], "upd")
    assert sorted((r.k, r.name) for r in current(h3).collect()) == [(1, "a2"), (2, "b"), (3, "c")]
    assert h3.count() == 4
    _check_invariants(h3)


def test_hard_deletes_flag(spark):
    h1 = snapshot_timestamp(None, _cur(spark, [(1, "a", _t(1), "c"), (2, "b", _t(1), "c")]), ["k"], "upd")
    h2 = snapshot_timestamp(h1, _cur(spark, [(1, "a", _t(1), "u")]), ["k"], "upd",
                            invalidate_hard_deletes=True, run_at=_t(9))
    assert {r.k: r.valid_to for r in h2.collect()} == {1: None, 2: _t(9)}


def test_check_strategy_null_safe(spark):
    run1 = _cur(spark, [(1, None, _t(1), "c"), (2, "x", _t(1), "c"), (3, "same", _t(1), "c")])
    h1 = snapshot_check(None, run1, ["k"], ["name"], _t(10))
    run2 = _cur(spark, [(1, "now", _t(2), "u"), (2, None, _t(2), "u"), (3, "same", _t(5), "u")])
    h2 = snapshot_check(h1, run2, ["k"], ["name"], _t(20))
    versions = {}
    for r in h2.collect():
        versions.setdefault(r.k, []).append((r.name, r.valid_from, r.valid_to))
    assert sorted(versions[1], key=str) == sorted([(None, _t(10), _t(20)), ("now", _t(20), None)], key=str)
    assert sorted(versions[2], key=str) == sorted([("x", _t(10), _t(20)), (None, _t(20), None)], key=str)
    assert versions[3] == [("same", _t(10), None)]  # updated_at moved, checked column did not
    _check_invariants(h2)


def test_op_filter(spark):
    run1 = _cur(spark, [(1, "a", _t(1), "r"), (2, "b", _t(1), "c")])
    h1 = snapshot_check(None, run1, ["k"], ["name"], _t(10), ops=("u", "c"))
    assert [r.k for r in h1.collect()] == [2]


def test_history_from_changes(spark):
    ch = _cur(spark, [(1, "a", _t(1), "c"), (1, "b", _t(4), "u"), (1, "c", _t(9), "u"), (2, "x", _t(2), "c")])
    h = history_from_changes(ch, ["k"], "upd")
    got = sorted((r.k, r.name, r.valid_from, r.valid_to) for r in h.collect())
    assert got == [(1, "a", _t(1), _t(4)), (1, "b", _t(4), _t(9)), (1, "c", _t(9), None), (2, "x", _t(2), None)]
    _check_invariants(h)


def test_history_from_changes_with_hot_keys(spark):
    import random
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        k = 0 if i % 2 else rnd.randrange(1, 6)   # key 0 holds half the changes
        rows.append((k, f"n{i}", _t(rnd.randrange(0, 60)), "u"))
    ch = _cur(spark, rows)
    want = sorted(tuple(r) for r in history_from_changes(ch, ["k"], "upd", ["name"], max_rows_per_group=None)
                  .select("k", "name", "valid_from", "valid_to").collect())
    got = sorted(tuple(r) for r in history_from_changes(ch, ["k"], "upd", ["name"], max_rows_per_group=10)
                 .select("k", "name", "valid_from", "valid_to").collect())
    assert got == want


def test_history_table_runs_equal_whole_history(spark, scratch):
    from pyspark.sql import functions as F

    from tidemark.operators.scd2 import first_snapshot, snapshot_check_open, snapshot_timestamp_open
    from tidemark.sources.tables import HistoryTable
    runs = [
        [(1, "a", _t(1), "c"), (2, "b", _t(1), "c")],
        [(1, "a2", _t(3), "u"), (3, "c", _t(2), "c")],
        [(1, "a3", _t(5), "u"), (2, "b2", _t(6), "u"), (3, "c", _t(2), "u")],
    ]
    for strategy in ("timestamp", "check"):
        store = HistoryTable(spark, f"{scratch}/{strategy}")
        whole = None
        for i, rows in enumerate(runs):
            cur, at = _cur(spark, rows), _t(10 * (i + 1))
            if strategy == "timestamp":
                whole = snapshot_timestamp(whole, cur, ["k"], "upd")
                open_ = store.read_open()
                step = (first_snapshot(cur, ["k"], F.col("upd")) if open_ is None
                        else snapshot_timestamp_open(open_, cur, ["k"], "upd"))
            else:
                whole = snapshot_check(whole, cur, ["k"], ["name"], at)
                open_ = store.read_open()
                step = (first_snapshot(cur, ["k"], F.lit(at).cast("timestamp_ntz")) if open_ is None
                        else snapshot_check_open(open_, cur, ["k"], ["name"], at))
            store.write_run(step)
            whole = spark.createDataFrame(whole.collect(), whole.schema)
        cols = ["k", "name", "upd", "scd_id", "scd_updated_at", "valid_from", "valid_to"]
        got = sorted(tuple(r) for r in store.read().select(*cols).collect())
        want = sorted(tuple(r) for r in whole.select(*cols).collect())
        assert got == want, strategy
        _check_invariants(store.read())
