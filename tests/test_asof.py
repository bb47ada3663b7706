import datetime as dt
import random

import pytest

from tidemark.operators.asof import as_of_join

T0 = dt.datetime(2024, 1, 1)


def _t(m):
    return None if m is None else T0 + dt.timedelta(minutes=m)


def _versions(spark, rows):
    return spark.createDataFrame([(k, v, _t(a), _t(b)) for k, v, a, b in rows],
                                 "k int, ver string, valid_from timestamp_ntz, valid_to timestamp_ntz")


def _left(spark, rows):
    return spark.createDataFrame([(i, k, _t(m)) for i, k, m in rows], "id int, k int, ts timestamp_ntz")


def _sql_join(spark, left, versions):
    left.createOrReplaceTempView("l_")
    versions.createOrReplaceTempView("v_")
    return spark.sql("""
        SELECT l_.id, v_.ver FROM l_ LEFT JOIN v_ ON l_.k = v_.k AND l_.ts >= v_.valid_from
           AND (l_.ts < v_.valid_to OR v_.valid_to IS NULL)""")


def _pairs(df):
    return sorted((r[0], r[1]) for r in df.collect())


def test_edges(spark):
    v = _versions(spark, [(1, "a", 0, 10), (1, "b", 10, None), (2, "c", 5, 8)])
    left = _left(spark, [(1, 1, 0), (2, 1, 10), (3, 1, 9), (4, 1, -1), (5, 2, 8), (6, None, 3),
                         (7, 1, None), (8, 3, 4), (9, 2, 7)])
    out = as_of_join(left, v, "k", "k", "ts", as_="a").selectExpr("id", "a.ver")
    assert _pairs(out) == [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None), (6, None),
                           (7, None), (8, None), (9, "c")]


@pytest.mark.parametrize("max_rows", [None, 3, 1_000_000])
def test_matches_range_join_with_hot_keys(spark, max_rows):
    rnd = random.Random(max_rows or 0)
    vrows = []
    for k in range(6):
        t = rnd.randrange(20)
        n = 40 if k == 0 else rnd.randrange(1, 5)  # key 0 is hot
        for j in range(n):
            step = rnd.randrange(1, 15)
            end = t + step if j < n - 1 else (None if k % 2 == 0 else t + step)
            vrows.append((k, f"{k}-{j}", t, end))
            t += step + (rnd.randrange(3) if k == 3 else 0)  # key 3 has gaps
    lrows = [(i, rnd.choice([0, 0, 0, 1, 2, 3, 4, 5, 6, None]), rnd.randrange(-5, 400)) for i in range(400)]
    v, left = _versions(spark, vrows), _left(spark, lrows)
    got = as_of_join(left, v, "k", "k", "ts", as_="a", max_rows_per_group=max_rows).selectExpr("id", "a.ver")
    assert _pairs(got) == _pairs(_sql_join(spark, left, v))


def test_left_columns_and_struct(spark):
    v = _versions(spark, [(1, "a", 0, None)])
    left = _left(spark, [(1, 1, 5)])
    out = as_of_join(left, v, "k", "k", "ts", as_="acct")
    assert out.columns == ["id", "k", "ts", "acct"]
    r = out.first()
    assert r.acct.ver == "a" and r.acct.k == 1


@pytest.mark.parametrize("limit", [None, 2, 1000])
def test_left_join_fanout_equals_left_join(spark, limit):
    from tidemark.operators.joins import left_join_fanout
    rnd = random.Random(3)
    left = spark.createDataFrame([(i, rnd.choice([1, 2, 3, 4, None])) for i in range(50)], "id int, k int")
    right = spark.createDataFrame([(rnd.choice([1, 1, 1, 2, 5, None]), j) for j in range(40)], "k int, r int")
    got = sorted(tuple(r) for r in left_join_fanout(left, right, ["k"], limit).select("id", "k", "r").collect())
    want = sorted(tuple(r) for r in left.join(right, ["k"], "left").select("id", "k", "r").collect())
    assert sorted(got, key=str) == sorted(want, key=str)


def test_zero_length_versions_across_slices(spark):
    # key 1 is hot (max 3 rows per group); a zero-length version [5,5) shares its
    # start with [5, None): the open one must win, in every slice
    v = _versions(spark, [(1, "z", 5, 5), (1, "open", 5, None), (1, "early", 0, 5)])
    left = _left(spark, [(i, 1, m) for i, m in enumerate([1, 4, 5, 6, 50, 90, 120, 200, 300, 400])])
    got = as_of_join(left, v, "k", "k", "ts", as_="a", max_rows_per_group=3).selectExpr("id", "a.ver")
    assert _pairs(got) == _pairs(_sql_join(spark, left, v))


@pytest.mark.parametrize("max_rows", [None, 4])
def test_hot_key_burst_at_one_timestamp(spark, max_rows):
    # key 1: 60 left rows at one instant plus a few spread ones, three versions
    v = _versions(spark, [(1, "a", 0, 10), (1, "b", 10, 10), (1, "c", 10, None), (2, "x", 0, None)])
    rows = [(i, 1, 10) for i in range(60)] + [(100 + i, 1, m) for i, m in enumerate([-1, 0, 5, 9, 11, 30])]
    rows += [(200, 2, 3), (201, None, 10)]
    left = _left(spark, rows)
    got = as_of_join(left, v, "k", "k", "ts", as_="a", max_rows_per_group=max_rows).selectExpr("id", "a.ver")
    assert _pairs(got) == _pairs(_sql_join(spark, left, v))


def _ntz(minutes):
    return f"timestampadd(MINUTE, CAST({minutes} AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')"


def _histories(spark, accounts=12, versions=6):
    """Accounts that change owner and pause, customers with gaps, equal starts,
    versions that hold at no time, accounts without a customer."""
    acc = spark.range(accounts * versions).selectExpr(
        "CAST(id % 12 AS INT) AS account_id", "CAST(CASE WHEN id % 17 = 3 THEN NULL ELSE (id * 7) % 5 END AS INT) AS customer_id",
        "concat('t', id) AS account_type", "CAST(id AS DOUBLE) AS balance", "'GBP' AS currency",
        f"{_ntz('floor(id / 12) * 100 + (id % 12) % 5')} AS valid_from",
        f"CASE WHEN id >= 60 THEN CAST(NULL AS TIMESTAMP_NTZ) ELSE {_ntz('floor(id / 12) * 100 + (id % 12) % 5 + CASE WHEN id % 4 = 1 THEN 60 ELSE 100 END')} END AS valid_to")
    cus = spark.range(40).selectExpr(
        "CAST(id % 4 AS INT) AS customer_id", "concat('n', id) AS full_name", "'x' AS nationality", "concat('e', id) AS email",
        f"{_ntz('floor(id / 4) * 55')} AS valid_from",
        f"CASE WHEN id >= 36 THEN CAST(NULL AS TIMESTAMP_NTZ) ELSE {_ntz('floor(id / 4) * 55 + CASE id % 3 WHEN 0 THEN 55 WHEN 1 THEN 30 ELSE 0 END')} END AS valid_to")
    return acc, cus


def _transactions(spark, n=900):
    from tidemark.plans.gold import TXN_COLS
    have = {"transaction_id": "CAST(id AS INT)", "transaction_created_at": f"CASE WHEN id % 50 = 0 THEN NULL ELSE {_ntz('(id * 37) % 640 - 10')} END"}
    return spark.range(n).selectExpr("CAST(CASE WHEN id % 41 = 0 THEN NULL ELSE id % 13 END AS INT) AS account_id",
                                     *[f"{have.get(c, 'CAST(NULL AS STRING)')} AS {c}" for c in TXN_COLS])


def test_one_pass_over_the_overlap_equals_two_passes(spark):
    from tidemark.plans.gold import transactions_as_of
    acc, cus = _histories(spark)
    t = _transactions(spark)
    cols = ["transaction_id", "a.account_type AS at", "a.valid_from AS af", "c.full_name AS cn", "c.valid_from AS cf"]
    one = transactions_as_of(t, acc, cus, combined=True)
    two = transactions_as_of(t, acc, cus, combined=False)
    got = sorted(map(str, one.selectExpr(*cols).collect()))
    assert got == sorted(map(str, two.selectExpr(*cols).collect())) and len(got) == 900
    t.createOrReplaceTempView("ov_t"), acc.createOrReplaceTempView("ov_a"), cus.createOrReplaceTempView("ov_c")
    want = spark.sql("""SELECT transaction_id, a.account_type AS at, a.valid_from AS af, c.full_name AS cn, c.valid_from AS cf FROM ov_t t
        LEFT JOIN ov_a a ON a.account_id = t.account_id AND a.valid_from <= transaction_created_at AND (a.valid_to IS NULL OR transaction_created_at < a.valid_to)
        LEFT JOIN ov_c c ON c.customer_id = a.customer_id AND c.valid_from <= transaction_created_at AND (c.valid_to IS NULL OR transaction_created_at < c.valid_to)""")
    assert got == sorted(map(str, want.collect()))
    assert any("cn=None" in r and "at='t" in r for r in got)  # an account's version with no customer's
    # the fact (with its description) is shuffled once instead of twice
    def shuffles(df):
        def walk(node):
            own = node.nodeName() == "Window" and "description" in node.schema().json()
            return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))
        return walk(df._jdf.queryExecution().optimizedPlan())

    assert shuffles(one) == 1 and shuffles(two) == 2
    cut = transactions_as_of(t, acc, cus, 20, combined=True)
    assert sorted(map(str, cut.selectExpr(*cols).collect())) == got


def test_pieces_partition_each_version(spark):
    from tidemark.operators.overlap import overlap_histories, shared_points
    acc, cus = _histories(spark)
    pieces = overlap_histories(acc, cus, "account_id", "customer_id", left_as="a", right_as="c").collect()
    by = {}
    for p in pieces:
        by.setdefault((p["account_id"], p["a"]["valid_from"]), []).append(p)
        if p["c"] is not None:
            assert p["c"]["customer_id"] == p["a"]["customer_id"] and p["c"]["valid_from"] <= p["valid_from"]
            assert p["c"]["valid_to"] is None or (p["valid_to"] is not None and p["valid_to"] <= p["c"]["valid_to"])
    assert len(by) == acc.count()
    for (_, start), own in by.items():
        own.sort(key=lambda p: p["valid_from"])
        assert own[0]["valid_from"] == start and own[-1]["valid_to"] == own[0]["a"]["valid_to"]
        assert all(x["valid_to"] == y["valid_from"] for x, y in zip(own, own[1:]))
    assert len(pieces) <= acc.count() + shared_points(acc, cus, "account_id", "customer_id")
    assert overlap_histories(acc.limit(0), cus, "account_id", "customer_id", left_as="a", right_as="c").count() == 0


def test_many_versions_of_a_hot_key_in_one_slice_are_split_by_rank(spark):
    # one key: 20,000 versions within 20 ms, the rest of its time almost empty
    at = "timestampadd(MICROSECOND, CASE WHEN id < 20000 THEN id ELSE (id - 20000) * 3600000000 END, TIMESTAMP_NTZ'2024-01-01 00:00:00')"
    v = spark.range(20100).selectExpr("1 AS k", "id AS n", f"{at} AS valid_from").filter("n <> 20000")
    v = v.selectExpr("k", "n", "valid_from", "lead(valid_from) OVER (PARTITION BY k ORDER BY valid_from) AS valid_to").cache()
    left = spark.range(3000).selectExpr("1 AS k", "id", "timestampadd(MICROSECOND, id * 7, TIMESTAMP_NTZ'2023-12-31 23:59:59.999000') AS at")
    left = left.unionByName(spark.range(100).selectExpr("1 AS k", "id + 3000 AS id", "timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01 00:30:00') AS at"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = as_of_join(left, v, "k", "k", "at", max_rows_per_group=400)
        got = {r["id"]: r["n"] for r in j.selectExpr("id", "v.n").collect()}
        groups = _group_sizes(j)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(groups) <= 800 and sum(groups) >= 23000
    want = as_of_join(left, v, "k", "k", "at", max_rows_per_group=None)
    assert got == {r["id"]: r["n"] for r in want.selectExpr("id", "v.n").collect()}
    assert sum(n is not None for n in got.values()) > 2500


def _group_sizes(j):
    """Rows of each group of the scan's window, counted below it."""
    plan = j._jdf.queryExecution().analyzed()
    # the window's input: count rows by its partition columns
    while plan.nodeName() != "Window":
        plan = plan.children().apply(0)
    from pyspark.sql import DataFrame
    child = DataFrame(j.sparkSession._jvm.org.apache.spark.sql.classic.Dataset.ofRows(j.sparkSession._jsparkSession, plan.children().apply(0)), j.sparkSession)
    keys = [c for c in child.columns if c in ("__k0", "__slice", "__salt")]
    return [r["count"] for r in child.groupBy(*keys).count().collect()]
