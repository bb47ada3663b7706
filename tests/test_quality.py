from tidemark.operators.quality import (violations_balance, violations_domain, violations_fk,
                                        violations_fx, violations_unique)


def test_checks(spark):
    legs = spark.createDataFrame(
        [(1, 1, "debit", 10.0), (2, 1, "credit", 10.0), (3, 2, "debit", 5.0), (4, 2, "credit", 4.0),
         (4, 3, "credit", 1.0)], "leg_id int, transaction_id int, direction string, amount double")
    assert [(r.leg_id, r.n_rows) for r in violations_unique(legs, ["leg_id"]).collect()] == [(4, 2)]
    bal = sorted((r.transaction_id, r.debit_total, r.credit_total) for r in violations_balance(legs).collect())
    assert bal == [(2, 5.0, 4.0), (3, None, 1.0)]
    parent = spark.createDataFrame([(1,), (2,)], "transaction_id int")
    assert [r.transaction_id for r in violations_fk(legs, parent, ["transaction_id"]).collect()] == [3]
    assert [r.direction for r in violations_domain(legs, "direction", ["debit"]).collect()] == ["credit"] * 3
    txn = spark.createDataFrame([(1, 100.0, 1.27, 127.0), (2, 100.0, None, 100.0), (3, 100.0, 1.27, 100.0)],
                                "transaction_id int, amount double, exchange_rate double, amount_in_usd double")
    assert [r.transaction_id for r in violations_fx(txn).collect()] == [3]


def test_overlap_check(spark):
    import datetime as dt

    from tidemark.operators.quality import violations_overlap
    t = [dt.datetime(2024, 1, d) for d in range(1, 10)]
    h = spark.createDataFrame(
        [(1, t[0], t[2]), (1, t[2], None),          # contiguous: fine
         (2, t[0], t[4]), (2, t[3], t[5]),          # overlaps the previous one
         (3, t[0], None), (3, t[1], None)],         # two open versions
        "k int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert sorted((r.k, r.valid_from) for r in violations_overlap(h, ["k"]).collect()) == [(2, t[3]), (3, t[1])]
