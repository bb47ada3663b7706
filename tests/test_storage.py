"""History and version storage, staged loads, replays, and spread of hot keys."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from tidemark.config import prune_scratch, scratch_path
from tidemark.operators.asof import as_of_join
from tidemark.operators.joins import left_join_fanout
from tidemark.operators.latest import drop_replays, upsert_newer, upsert_ordered
from tidemark.operators.scd2 import first_snapshot, history_from_changes, snapshot_timestamp_open
from tidemark.plans.pipeline import PipelineConfig, read_gold, read_skipped, run_pipeline
from tidemark.schemas import BRONZE_SCHEMAS
from tidemark.sources import commit, tables
from tidemark.sources.files import load_new_files, read_rejects, skipped_files
from tidemark.sources.tables import HistoryTable, PackedTable, PartitionedTable, VersionedTable, write_text


def _cur(spark, n, day):
    return spark.range(n).selectExpr("CAST(id AS INT) AS k", f"'{day}' AS name", "'u' AS cdc_op",
                                     f"timestampadd(DAY, {day}, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS upd")


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_history_is_one_scan_however_many_runs(spark, scratch):
    store = HistoryTable(spark, f"{scratch}/h")
    assert store.read() is None and store.read_open() is None
    store.write_run(first_snapshot(_cur(spark, 5, 0), ["k"], F.col("upd")))
    for day in range(1, 7):
        assert store.write_run(snapshot_timestamp_open(store.read_open(), _cur(spark, 5, day), ["k"], "upd")) == day + 1
    assert store.read().count() == 35 and store.read_open().count() == 5
    assert _scans(store.read()) == 1 and _scans(store.read_open()) == 1
    assert sorted(os.listdir(f"{scratch}/h/state=open")) == ["run=6", "run=7"]


def test_failed_run_is_not_read_and_is_replaced(spark, scratch):
    store = HistoryTable(spark, f"{scratch}/h")
    store.write_run(first_snapshot(_cur(spark, 3, 0), ["k"], F.col("upd")))
    stale = first_snapshot(_cur(spark, 9, 0), ["k"], F.col("upd"))
    for state in ("open", "closed"):
        stale.write.parquet(f"{scratch}/h/state={state}/run=2")
    assert store.read().count() == 3
    store.write_run(snapshot_timestamp_open(store.read_open(), _cur(spark, 3, 0), ["k"], "upd"))
    assert store.read().count() == 3


def test_history_without_rows(spark, scratch):
    store = HistoryTable(spark, f"{scratch}/h")
    store.write_run(first_snapshot(_cur(spark, 0, 0), ["k"], F.col("upd")))
    assert store.read().count() == 0
    store.write_run(snapshot_timestamp_open(store.read_open(), _cur(spark, 2, 0), ["k"], "upd"))
    assert store.read().count() == 2


def test_old_versions_go(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/v", keep=2)
    for n in range(4):
        table.write(spark.range(n))
    assert table.versions() == [3, 4] and table.read().count() == 3


def test_staged_files_are_the_first_stage(spark, scratch):
    def stage(table, n, wave):
        have = {"account_id": F.col("id"), "customer_id": F.col("id"), "cdc_op": F.lit("c"), "source_offset": F.col("id"),
                "updated_at": F.lit(wave), "ingested_at": F.timestamp_seconds(F.lit(1_700_000_000 + wave)),
                "ingestion_date": F.lit("2023-11-14")}
        rows = spark.range(n).select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMAS[table].fields])
        rows.coalesce(1).write.parquet(f"{scratch}/staged/{table}/wave={wave}")

    cfg = PipelineConfig(root=f"{scratch}/lake", staged=f"{scratch}/staged", run_at=dt.datetime(2024, 2, 1))
    stage("accounts", 4, 1), stage("customers", 3, 1)
    write_text(spark, f"{scratch}/staged/accounts/broken.parquet", "no parquet")
    first = run_pipeline(spark, cfg)
    assert first["loaded"] == {"accounts": 4, "customers": 3}
    assert first["checks"]["fk_account_customer"] == 1 and first["checks"]["unique_bank_swift_code"] == 0
    assert [os.path.basename(r[0]) for r in read_skipped(spark, cfg, "accounts").collect()] == ["broken.parquet"]
    stage("accounts", 6, 2)
    assert run_pipeline(spark, cfg)["loaded"] == {"accounts": 6, "customers": 0}
    assert read_gold(spark, cfg, "dim_accounts").count() == 6


def test_replays_are_dropped_by_position_only(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 0, 5), (2, 0, 6), (3, None, None), (3, None, None)],
                               "id int, source_partition int, source_offset long")
    assert sorted(r.id for r in drop_replays(df).collect()) == [1, 2, 3, 3]


def _largest_share(spark, df):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return max(sizes) / sum(sizes), sum(sizes)


def test_a_burst_is_spread_over_as_many_groups_as_it_needs(spark):
    # 3000 rows within one second, 10 spread over a year, all of one key
    left = spark.range(3010).selectExpr("1 AS k", "id", "CASE WHEN id < 3000 THEN timestampadd(MICROSECOND, id, TIMESTAMP_NTZ'2024-06-01 00:00:00') "
                                        "ELSE timestampadd(MONTH, CAST(id - 3000 AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00') END AS at")
    versions = spark.createDataFrame([(1,)], "k int").selectExpr(
        "k", "TIMESTAMP_NTZ'2023-01-01 00:00:00' AS valid_from", "CAST(NULL AS TIMESTAMP_NTZ) AS valid_to")
    j = as_of_join(left, versions, "k", "k", "at", max_rows_per_group=50)
    share, rows = _largest_share(spark, j)
    assert rows == 3010 and share < 0.4
    assert j.filter("v IS NULL").count() == 0


def test_rows_without_a_time_are_spread(spark):
    left = spark.range(2000).selectExpr("1 AS k", "id", "CAST(NULL AS TIMESTAMP_NTZ) AS at")
    versions = spark.createDataFrame([(1,)], "k int").selectExpr(
        "k", "TIMESTAMP_NTZ'2023-01-01 00:00:00' AS valid_from", "CAST(NULL AS TIMESTAMP_NTZ) AS valid_to")
    j = as_of_join(left, versions, "k", "k", "at")
    share, rows = _largest_share(spark, j)
    assert rows == 2000 and share < 0.4 and j.filter("v IS NOT NULL").count() == 0


def test_equal_right_rows_are_spread_by_their_id(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, l string")
    right = spark.range(2000).selectExpr("1 AS k", "'same' AS r", "id")
    j = left_join_fanout(left, right, ["k"], 20, ["id"])
    assert j.columns == ["k", "l", "r"]
    share, rows = _largest_share(spark, j)
    assert rows == 2001 and share < 0.4


def test_history_of_a_hot_key_equals_the_plain_one(spark):
    rows = spark.range(300).selectExpr("CAST(CASE WHEN id % 3 = 0 THEN id ELSE 0 END AS INT) AS k", "id",
                                       "timestampadd(SECOND, CAST(id * id % 997 AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00') AS at")
    plain = history_from_changes(rows, ["k"], "at", ["id"], max_rows_per_group=None)
    cut = history_from_changes(rows, ["k"], "at", ["id"], max_rows_per_group=20)
    assert plain.exceptAll(cut).count() == 0 and cut.count() == 300


def _kept(old, new):
    gone = old.join(new, "id", "left_anti")
    return gone.unionByName(new.filter("cdc_op <> 'd'"))


def _parts(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, part long, cdc_op string")


def test_partitioned_merge_rewrites_only_touched_partitions(spark, scratch):
    table = PartitionedTable(spark, f"{scratch}/p", "part")
    assert table.read() is None and table.commit() is None
    assert table.merge(_parts(spark, [(1, "a", 0, "c"), (2, "a", 0, "c"), (3, "a", 1, "c")]), _kept) == 1
    table.merge(_parts(spark, [(1, "b", 0, "u"), (5, "b", 2, "c")]), _kept)
    assert table.commit()["parts"] == {"part=0": 2, "part=1": 1, "part=2": 2}
    assert sorted(map(tuple, table.read().select("id", "v").collect())) == [(1, "b"), (2, "a"), (3, "a"), (5, "b")]
    # a partition left without rows goes; no changes, no run
    table.merge(_parts(spark, [(1, "b", 0, "d"), (2, "b", 0, "d")]), _kept)
    assert table.commit()["parts"] == {"part=1": 1, "part=2": 2}
    assert table.merge(_parts(spark, []), _kept) == 3
    # folders that only dropped commits name are gone
    assert not os.path.exists(f"{scratch}/p/run=1/part=0") and os.path.exists(f"{scratch}/p/run=1/part=1")
    table.merge(_parts(spark, [(3, "b", 1, "d"), (5, "b", 2, "d")]), _kept)
    assert table.read().count() == 0 and table.read().columns == ["id", "v", "part", "cdc_op"]


def test_a_failed_partitioned_merge_leaves_the_table(spark, scratch, monkeypatch):
    table = PartitionedTable(spark, f"{scratch}/p", "part")
    table.merge(_parts(spark, [(1, "a", 0, "c"), (3, "a", 1, "c")]), _kept)
    before = sorted(map(tuple, table.read().collect()))
    change = _parts(spark, [(1, "b", 0, "u"), (3, "b", 1, "u"), (4, "b", 4, "c")])
    write = tables.write_text
    monkeypatch.setattr(tables, "write_text", lambda *a: 1 / 0)  # killed after the rows, before the commit
    for _ in range(2):
        try:
            table.merge(change, _kept)
        except ZeroDivisionError:
            pass
        assert sorted(map(tuple, PartitionedTable(spark, f"{scratch}/p", "part").read().collect())) == before
    monkeypatch.setattr(tables, "write_text", write)
    assert table.merge(change, _kept) == 2
    assert sorted(map(tuple, table.read().select("id", "v").collect())) == [(1, "b"), (3, "b"), (4, "b")]


def test_a_units_outputs_appear_together_and_once(spark, scratch, monkeypatch):
    a, b, ledger = f"{scratch}/a", f"{scratch}/b", f"{scratch}/ledger"

    def attempt(stop=None):
        unit = commit.Unit(spark, ledger, "batch-0")
        if unit.committed() is None:
            spark.range(5).withColumn("day", F.col("id") % 2).write.partitionBy("day").parquet(unit.stage(a))
            if stop == "between":
                raise RuntimeError("killed")
            spark.range(3).coalesce(1).write.parquet(unit.stage(b))
            unit.commit(rows=5)

    def rows():
        return [spark.read.schema("id long").parquet(p).count() if os.path.exists(p) and any(not x.startswith("_") for x in os.listdir(p)) else 0
                for p in (a, b)]

    try:
        attempt("between")
    except RuntimeError:
        pass
    assert rows() == [0, 0]
    # killed in the middle of the moves: the next attempt finishes them
    fs_of, moved = commit._fs, []

    def one_move(spark, path):
        if "/_staged/" in path and "part-" in path:
            moved.append(path)
            if len(moved) == 2:
                raise RuntimeError("killed")
        return fs_of(spark, path)

    monkeypatch.setattr(commit, "_fs", one_move)
    monkeypatch.setattr(commit, "MOVES", 1)
    try:
        attempt()
    except RuntimeError:
        pass
    monkeypatch.setattr(commit, "_fs", fs_of)
    assert rows() != [5, 3]
    for _ in range(3):
        attempt()
        assert rows() == [5, 3]
    assert not os.path.exists(f"{a}/_staged/batch-0") and sorted(x for x in os.listdir(a) if "=" in x) == ["day=0", "day=1"]


def test_staged_files_of_other_types_give_rows_and_rejects(spark, scratch):
    schema = BRONZE_SCHEMAS["accounts"]

    def stage(name, **cols):
        have = {"account_id": "id", "cdc_op": "'c'", "ingested_at": "timestamp_seconds(1700000000)", "ingestion_date": "DATE'2023-11-14'"} | cols
        spark.range(4).coalesce(1).selectExpr(*[f"{e} AS {n}" for n, e in have.items()]).write.parquet(f"{scratch}/stage/{name}")

    stage("plain", account_id="CAST(id AS INT)", balance="1.5D")
    stage("wide", balance="CAST(2 AS FLOAT)")                              # account_id is a long
    stage("text", account_id="CASE WHEN id = 3 THEN 99999999999 ELSE id + 10 END", balance="CASE WHEN id = 1 THEN 'n/a' ELSE '2.5' END")
    stage("nested", account_id="CAST(id + 20 AS INT)", balance="named_struct('x', id)")
    write_text(spark, f"{scratch}/stage/broken.parquet", "no parquet")
    loaded = load_new_files(spark, f"{scratch}/stage", schema, f"{scratch}/bronze", f"{scratch}/ck", recursive=True)
    got = spark.read.schema(schema).parquet(f"{scratch}/bronze")
    assert loaded == 10 and sorted((r.account_id, r.balance) for r in got.collect()) == sorted(
        [(i, 1.5) for i in range(4)] + [(i, 2.0) for i in range(4)] + [(10, 2.5), (12, 2.5)])
    bad = read_rejects(spark, f"{scratch}/ck").collect()
    assert sorted((r["column"], r["value"]) for r in bad) == sorted(
        [("account_id", "99999999999"), ("balance", "n/a")] + [("balance", f'{{"x":{i}}}') for i in range(4)])
    assert all(("/text/" in r["file"]) != ("/nested/" in r["file"]) and '"cdc_op":"c"' in r["row"] for r in bad)
    assert sorted(os.path.basename(r[0])[:6] for r in skipped_files(spark, f"{scratch}/stage", f"{scratch}/ck", recursive=True).collect()) == [
        "broken", "part-0"]  # all of the nested file's rows are rejects
    assert load_new_files(spark, f"{scratch}/stage", schema, f"{scratch}/bronze", f"{scratch}/ck", recursive=True) == 0


def test_a_load_delivered_again_is_not_loaded_again(spark, scratch, monkeypatch):
    schema = BRONZE_SCHEMAS["accounts"]
    rows = spark.range(6).selectExpr("CAST(id AS INT) AS account_id", "DATE'2023-11-14' AS ingestion_date")
    rows.coalesce(1).write.parquet(f"{scratch}/stage/a")
    done = commit.Unit.commit

    def killed(self, **info):
        done(self, **info)
        raise RuntimeError("killed")  # after the commit, before the stream records its batch

    monkeypatch.setattr(commit.Unit, "commit", killed)
    try:
        load_new_files(spark, f"{scratch}/stage", schema, f"{scratch}/bronze", f"{scratch}/ck", recursive=True)
    except Exception:  # noqa: BLE001
        pass
    monkeypatch.setattr(commit.Unit, "commit", done)
    assert load_new_files(spark, f"{scratch}/stage", schema, f"{scratch}/bronze", f"{scratch}/ck", recursive=True) == 0
    assert spark.read.schema(schema).parquet(f"{scratch}/bronze").count() == 6


def test_old_scratch_tables_are_removed_and_new_ones_stay(spark):
    old, new = scratch_path(spark, "prune-old"), scratch_path(spark, "prune-new")
    for p in (old, new):
        spark.range(3).write.parquet(p)
    past = time.time() - 400 * 86400
    os.utime(old.removeprefix("file:"), (past, past))
    assert prune_scratch(spark, 300 * 24) >= 1
    assert not os.path.exists(old.removeprefix("file:")) and spark.read.parquet(new).count() == 3


# --- exchanges that are not needed --------------------------------------------------------------

def test_large_staged_files_of_few_dates_are_loaded_without_an_exchange(spark, scratch, monkeypatch):
    from tidemark.sources import files
    for i, day in enumerate(("2024-01-01", "2024-01-02")):
        spark.range(50).selectExpr("CAST(id AS INT) AS bank_id", f"DATE '{day}' AS ingestion_date").coalesce(1).write.parquet(f"{scratch}/src/{i}")
    plans, real = [], files.append_bronze

    def append(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        real(df, *args)

    monkeypatch.setattr(files, "append_bronze", append)
    for n, (least, exchanged) in enumerate([(files.WHOLE_FILE, True), (1, False), (1 << 30, True)]):
        monkeypatch.setattr(files, "WHOLE_FILE", least)
        assert load_new_files(spark, f"{scratch}/src", BRONZE_SCHEMAS["banks"], f"{scratch}/t{n}", f"{scratch}/ck{n}", recursive=True) == 100
        assert ("RebalancePartitions" in plans[-1]) == exchanged
        found = spark.read.parquet(f"{scratch}/t{n}").groupBy("ingestion_date").count().collect()
        assert sorted((str(r[0]), r[1]) for r in found) == [("2024-01-01", 50), ("2024-01-02", 50)]


def test_many_small_partitions_share_folders(spark, scratch):
    table = PackedTable(spark, f"{scratch}/p", "part")
    rows = spark.range(3000).selectExpr("CAST(id AS INT) AS id", "'a' AS v", "id DIV 2 AS part", "'c' AS cdc_op")
    whole = rows.unionByName(spark.sql("SELECT -1 AS id, 'a' AS v, CAST(NULL AS BIGINT) AS part, 'c' AS cdc_op"))
    assert table.merge(whole, _kept) == 1
    assert sum(x.startswith("part") for x in os.listdir(f"{scratch}/p/run=1")) <= 6 and len(table.commit()["parts"]) == 1501
    # a run replaces what its changes reach, the null partition too, and nothing else
    table.merge(_parts(spark, [(1, "b", 0, "u"), (2, "b", 1, "d"), (3, "b", 1, "d"), (-1, "b", None, "u"), (9000, "b", 4500, "c")]), _kept)
    parts = table.commit()["parts"]
    assert [n for n, r in parts.items() if r == 2] == ["part=0", "part=4500", "part=__HIVE_DEFAULT_PARTITION__"] and "part=1" not in parts
    want = {i: "a" for i in range(3000) if i not in (2, 3)} | {1: "b", -1: "b", 9000: "b"}
    assert {r.id: r.v for r in table.read().collect()} == want and table.read().count() == len(want)
    assert sorted(r.id for r in table.part(["part=0", "part=700"]).collect()) == [0, 1, 1400, 1401]
    # a folder of which less than half still counts is copied, and then removed
    table.merge(spark.range(4, 400).selectExpr("CAST(id AS INT) AS id", "'c' AS v", "id DIV 2 AS part", "'u' AS cdc_op"), _kept)
    want |= {i: "c" for i in range(4, 400)}
    assert {r.id: r.v for r in table.read().collect()} == want and table.read().count() == len(want)
    assert not [n for n, r in table.commit()["parts"].items() if r == 1 and table.commit()["packs"][n] == 0]
    table.merge(_parts(spark, [(9000, "c", 4500, "u")]), _kept)
    assert not os.path.exists(f"{scratch}/p/run=1/part_pack=0") and os.path.exists(f"{scratch}/p/run=1/part_pack=1")
    assert {r.id: r.v for r in table.read().collect()} == want | {9000: "c"}


def test_a_table_of_folders_is_read_and_packed_by_the_next_run(spark, scratch):
    old = PartitionedTable(spark, f"{scratch}/p", "part")
    old.merge(_parts(spark, [(1, "a", 0, "c"), (2, "a", 1, "c"), (3, "a", None, "c")]), _kept)
    table = PackedTable(spark, f"{scratch}/p", "part")
    assert sorted(r.id for r in table.read().collect()) == [1, 2, 3]
    table.merge(_parts(spark, [(2, "b", 1, "u")]), _kept)
    assert sorted(map(tuple, table.read().select("id", "v", "part").collect()), key=str) == [(1, "a", 0), (2, "b", 1), (3, "a", None)]
    words = PackedTable(spark, f"{scratch}/w", "v")
    words.merge(_parts(spark, [(1, "a/b", 0, "c"), (2, "c", 1, "c")]), _kept)
    words.merge(_parts(spark, [(2, "c", 5, "u")]), _kept)
    assert sorted(map(tuple, words.read().select("id", "v", "part").collect())) == [(1, "a/b", 0), (2, "c", 5)]


def test_newer_rows_of_two_sides_are_those_that_ranking_finds(spark):
    side = lambda n, shift: spark.range(n).selectExpr(
        f"CASE WHEN id = 0 THEN NULL ELSE id + {shift} END AS k", f"'{shift}' AS v", "CASE WHEN id % 4 = 1 THEN NULL ELSE (id * 7) % 5 END AS ingested_at",
        f"CASE WHEN id % 3 = {shift} THEN NULL ELSE (id * 5 + {shift}) % 4 END AS source_ts_ms", f"2 * id + {shift} AS source_offset")
    t, u = side(60, 0), side(50, 1)
    got = upsert_newer(t, u, ["k"])
    assert sorted(map(str, got.collect())) == sorted(map(str, upsert_ordered(t, u, ["k"]).collect())) and {"0", "1"} == {r.v for r in got.collect()}
    tied = t.withColumn("v", F.lit("new"))
    assert {r.v for r in upsert_newer(t, tied, ["k"]).collect()} == {"new"}
    assert upsert_newer(t.limit(0), u, ["k"]).count() == 50 and upsert_newer(t, u.limit(0), ["k"]).count() == 60
