"""Gold models: dimensions of the open versions, the as-of transaction fact and
the reporting table.

The fact reads each transaction's account and customer *as they were* at the
transaction time (two chained as-of joins), then attaches the receiving side of
the transfer (credit legs). Every join is LEFT OUTER: a transaction is never
lost because a version or a leg is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_us
from ..operators.asof import DEFAULT_MAX_ROWS_PER_GROUP, as_of_join, key_stats
from ..operators.joins import DEFAULT_MAX_ROWS_PER_KEY, left_join_fanout
from ..operators.latest import LATEST_ORDER, live_rows
from ..operators.overlap import overlap_histories, shared_points
from ..operators.scd2 import current

TXN_COLS = ["transaction_id", "transaction_type", "amount", "currency", "exchange_rate",
            "amount_in_usd", "status", "channel", "country", "city", "description",
            "transaction_created_at", "transaction_updated_at"]


def dim_customers(customers_history: DataFrame) -> DataFrame:
    return current(customers_history).select(
        "customer_id", "full_name", "email", "phone", "nationality", "customer_created_at")


def dim_accounts(accounts_history: DataFrame) -> DataFrame:
    return current(accounts_history).select(
        "account_id", "customer_id", "bank_id", "account_type", "balance", "currency",
        "account_opened_at")


def dim_banks(bronze_banks: DataFrame, order_by=LATEST_ORDER) -> DataFrame:
    """Latest live bank straight from the bronze log (full scan each run)."""
    return live_rows(bronze_banks, ["bank_id"], order_by).select(
        "bank_id", "bank_name", "country", "swift_code")


def credit_legs(legs: DataFrame) -> DataFrame:
    return _credit_legs(legs).drop("leg_id")


def _credit_legs(legs: DataFrame) -> DataFrame:
    return legs.filter(F.col("direction") == "credit").select(
        "leg_id", "transaction_id", "external_account_reference", "external_account_name",
        F.col("bank_id").alias("receiver_bank_id"))


def debit_legs(legs: DataFrame) -> DataFrame:
    return legs.filter(F.col("direction") == "debit").select(
        "transaction_id", F.col("account_id").alias("sender_account_id"),
        F.col("bank_id").alias("sender_bank_id"))


def transactions_as_of(transactions: DataFrame, accounts_history: DataFrame,
                       customers_history: DataFrame,
                       max_rows_per_group: int | None = DEFAULT_MAX_ROWS_PER_GROUP, *,
                       combined: bool | None = False) -> DataFrame:
    """Transactions with struct columns ``a`` (account version at the
    transaction time) and ``c`` (customer version, found through the matched
    account's customer_id, at the same time).

    Two ways give the same rows. ``combined``: the two histories are overlapped
    into one (:func:`~tidemark.operators.overlap.overlap_histories`) and the
    transactions pass one as-of join: one shuffle and sort of the fact. Else
    they pass two, which is right where the overlap would be larger than the
    fact: many accounts that share customers with many versions. None: counted
    and decided here (for tables that are read from files)."""
    t = transactions.select(*TXN_COLS, "account_id")
    acc = accounts_history.select("account_id", "customer_id", "account_type", "balance",
                                  "currency", "valid_from", "valid_to")
    cus = customers_history.select("customer_id", "full_name", "nationality", "email",
                                   "valid_from", "valid_to")
    if combined is None:
        combined = shared_points(acc, cus, "account_id", "customer_id") + acc.count() <= transactions.count()
    if combined:
        both = overlap_histories(acc, cus, "account_id", "customer_id", left_as="a", right_as="c")
        found = as_of_join(t, both, "account_id", "account_id", "transaction_created_at", as_="__both",
                           max_rows_per_group=max_rows_per_group)
        return found.select(*t.columns, F.col("__both.a").alias("a"), F.col("__both.c").alias("c"))
    acc_stats = cus_stats = None
    if max_rows_per_group:
        per_account = key_stats(t, ["account_id"], epoch_us(t, "transaction_created_at"))
        acc_stats = _sum_stats(per_account.unionByName(
            key_stats(acc, ["account_id"], epoch_us(acc, "valid_from"))), "account_id")
        cus_stats = customer_stats(per_account, acc, cus)
    ta = as_of_join(t, acc, "account_id", "account_id", "transaction_created_at", as_="a",
                    max_rows_per_group=max_rows_per_group, stats=acc_stats)
    ta = ta.withColumn("__acust", F.col("a.customer_id"))
    tac = as_of_join(ta, cus, "__acust", "customer_id", "transaction_created_at", as_="c",
                     max_rows_per_group=max_rows_per_group, stats=cus_stats)
    return tac.drop("__acust")


def _sum_stats(stats: DataFrame, key: str) -> DataFrame:
    return stats.groupBy(key).agg(F.sum("__cnt").alias("__cnt"), F.min("__lo").alias("__lo"),
                                  F.max("__hi").alias("__hi"))


def customer_stats(per_account: DataFrame, acc: DataFrame, cus: DataFrame) -> DataFrame:
    """Per-customer row estimate for the second as-of join without running the
    first: transactions per account (``per_account``, a :func:`key_stats`
    table), summed over every customer the account ever belonged to, plus the
    customer's own versions. Aggregates of key columns only; an account that
    changed owner counts for each owner."""
    owners = acc.select("account_id", "customer_id").distinct()
    via_accounts = per_account.join(owners, "account_id").drop("account_id")
    own = key_stats(cus, ["customer_id"], epoch_us(cus, "valid_from"))
    return _sum_stats(via_accounts.unionByName(own), "customer_id")


def _fanout_limit(max_rows_per_group: int | None) -> int | None:
    return DEFAULT_MAX_ROWS_PER_KEY if max_rows_per_group else None


def fct_transactions(transactions: DataFrame, accounts_history: DataFrame,
                     customers_history: DataFrame, legs: DataFrame,
                     max_rows_per_group: int | None = DEFAULT_MAX_ROWS_PER_GROUP) -> DataFrame:
    tac = transactions_as_of(transactions, accounts_history, customers_history, max_rows_per_group)
    return fct_from_as_of(tac, legs, max_rows_per_group)


def fct_from_as_of(tac: DataFrame, legs: DataFrame,
                   max_rows_per_group: int | None = DEFAULT_MAX_ROWS_PER_GROUP) -> DataFrame:
    """The fact from :func:`transactions_as_of` output."""
    j = left_join_fanout(tac, _credit_legs(legs), ["transaction_id"], _fanout_limit(max_rows_per_group), ["leg_id"])
    return fct_rows(j)


def with_legs(tac: DataFrame, legs: DataFrame,
              max_rows_per_group: int | None = DEFAULT_MAX_ROWS_PER_GROUP) -> DataFrame:
    """:func:`transactions_as_of` output with its credit legs, one row for each
    (or one without), and the transaction's number of debit legs: what both
    the fact (:func:`fct_rows`) and the reporting model (:func:`reporting_rows`)
    are selected from. A pipeline run writes it once."""
    debits = debit_legs(legs).groupBy("transaction_id").agg(F.count(F.lit(1)).cast("int").alias("__debits"))
    return left_join_fanout(tac.join(debits, "transaction_id", "left"), _credit_legs(legs), ["transaction_id"],
                            _fanout_limit(max_rows_per_group), ["leg_id"])


def fct_rows(joined: DataFrame) -> DataFrame:
    """The fact's columns of transactions joined with their credit legs."""
    return joined.select(
        *TXN_COLS,
        F.col("a.account_id").alias("account_id"),
        F.col("a.account_type").alias("account_type_at_time"),
        F.col("a.balance").alias("balance_at_time"),
        F.col("a.currency").alias("account_currency_at_time"),
        F.col("c.customer_id").alias("customer_id"),
        F.col("c.full_name").alias("customer_name_at_time"),
        F.col("c.nationality").alias("customer_nationality_at_time"),
        F.col("c.email").alias("customer_email_at_time"),
        F.col("external_account_name").alias("receiver_name"),
        F.col("external_account_reference").alias("receiver_iban"),
        "receiver_bank_id",
    )


def transactions_reporting(transactions: DataFrame, accounts_history: DataFrame,
                           customers_history: DataFrame, legs: DataFrame,
                           max_rows_per_group: int | None = DEFAULT_MAX_ROWS_PER_GROUP) -> DataFrame:
    """As the fact, with other names, plus the debit-leg join. No debit column
    is shown, but the join stays: it multiplies rows when a transaction has
    several debit legs, and the row count is part of the result. Only counts of
    debit legs are joined: one row per transaction, and each result row is
    repeated that often."""
    tac = transactions_as_of(transactions, accounts_history, customers_history, max_rows_per_group)
    return reporting_from_as_of(tac, legs, max_rows_per_group)


def reporting_from_as_of(tac: DataFrame, legs: DataFrame,
                         max_rows_per_group: int | None = DEFAULT_MAX_ROWS_PER_GROUP) -> DataFrame:
    return reporting_rows(with_legs(tac, legs, max_rows_per_group))


def reporting_rows(joined: DataFrame) -> DataFrame:
    """The reporting model of :func:`with_legs` output: each row as often as its
    transaction has debit legs (once if it has none)."""
    times = F.sequence(F.lit(1), F.coalesce("__debits", F.lit(1)))
    return joined.withColumn("__n", F.explode(times)).select(
        *TXN_COLS,
        F.col("a.account_id").alias("account_id"),
        F.col("a.account_type").alias("account_type"),
        F.col("a.balance").alias("balance_at_transaction_time"),
        F.col("a.currency").alias("account_currency"),
        F.col("c.customer_id").alias("customer_id"),
        F.col("c.full_name").alias("customer_name"),
        F.col("c.nationality").alias("customer_nationality_at_time"),
        F.col("c.email").alias("customer_email"),
        F.col("external_account_name").alias("receiver_name"),
        F.col("external_account_reference").alias("receiver_iban"),
        "receiver_bank_id",
    )
