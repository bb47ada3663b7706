"""Constraint checks as Spark jobs. Each returns the violating rows (empty when
the data is clean), so a pipeline can count, store or fail on them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: Lower half of an amount.
LOW = (1 << 32) - 1


def violations_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count. A partial
    aggregate: each map task sends one row per distinct key."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def violations_fk(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                  parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent row. The parent side is
    reduced to its distinct keys first (partial aggregate), so a hot parent key
    is one row in the join."""
    pk = list(parent_keys or child_keys)
    ck = list(child_keys)
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(pk, ck)]).distinct()
    present = child
    for c in ck:
        present = present.filter(F.col(c).isNotNull())
    return present.join(keys, on=ck, how="left_anti")


def violations_domain(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose non-NULL value is outside the accepted values."""
    return df.filter(outside(col, allowed))


def outside(col: str, allowed: Sequence[str]) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(list(allowed))


def violations_balance(legs: DataFrame, key: str = "transaction_id", amount: str = "amount",
                       direction: str = "direction", tolerance: float = 0.01) -> DataFrame:
    """Transactions whose debit total differs from their credit total.
    Sums run in DECIMAL(38,2), so the totals do not depend on summation order."""
    amt = F.col(amount).cast("decimal(18,2)")
    sums = legs.groupBy(key).agg(
        F.sum(F.when(F.col(direction) == "debit", amt)).alias("debit_total"),
        F.sum(F.when(F.col(direction) == "credit", amt)).alias("credit_total"))
    d, c = F.coalesce("debit_total", F.lit(0)), F.coalesce("credit_total", F.lit(0))
    return (sums.filter(F.abs(d - c) > F.lit(tolerance))
                .select(key, F.col("debit_total").cast("double").alias("debit_total"),
                        F.col("credit_total").cast("double").alias("credit_total")))


def violations_fx(txn: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Transactions whose USD amount is not ``round(amount * rate, 2)``; a
    missing rate counts as 1."""
    return txn.filter(fx_differs(tolerance))


def fx_differs(tolerance: float = 0.01) -> Column:
    rate = F.coalesce(F.col("exchange_rate"), F.lit(1.0))
    return F.abs(F.col("amount_in_usd") - F.round(F.col("amount") * rate, 2)) > F.lit(tolerance)


def violations_overlap(history: DataFrame, keys: Sequence[str], valid_from: str = "valid_from",
                       valid_to: str = "valid_to") -> DataFrame:
    """Versions whose interval overlaps the previous version of the same key
    (the previous one is open, or ends after this one starts), and keys with
    more than one open version. SCD2 histories must have none: the as-of join
    relies on it. One window over each key's versions, which a history holds
    one per run."""
    w = Window.partitionBy(*keys).orderBy(F.col(valid_from), F.col(valid_to).asc_nulls_last())
    prev_to = F.lag(F.col(valid_to)).over(w)
    prev_from = F.lag(F.col(valid_from)).over(w)
    flagged = history.select(*history.columns, prev_from.alias("__pf"), prev_to.alias("__pt"))
    overlap = F.col("__pf").isNotNull() & (F.col("__pt").isNull() | (F.col("__pt") > F.col(valid_from)))
    return flagged.filter(overlap).drop("__pf", "__pt")


# --- many rules in one pass ----------------------------------------------------

@dataclass(frozen=True)
class Unique:
    """No value of ``col`` stands in two rows (counted: values that do)."""
    name: str
    table: str
    col: str


@dataclass(frozen=True)
class Foreign:
    """Every value of ``col`` is one of ``parent_col`` (counted: rows without)."""
    name: str
    table: str
    col: str
    parent: str
    parent_col: str


@dataclass(frozen=True)
class Rule:
    """No row meets ``broken`` (counted: rows that do)."""
    name: str
    table: str
    broken: Column


@dataclass(frozen=True)
class Balance:
    """Per ``key``, debits equal credits (counted: keys that differ)."""
    name: str
    table: str
    key: str
    amount: str = "amount"
    direction: str = "direction"
    tolerance: float = 0.01


def count_violations(tables: dict[str, DataFrame], rules: Sequence[Unique | Foreign | Rule | Balance]) -> DataFrame | None:
    """``(check, n)`` of every rule whose tables are given, with one scan of
    each table.

    A row becomes one entry for each role it plays: it *holds* a key that must
    be unique or that others refer to, it *refers* to a key, it books an amount
    under a key, or it breaks a row rule. Entries of all tables meet in one
    aggregate by key space and key, partial before the shuffle, so a key that a
    third of all rows refer to is one row per task; its result is counted in a
    second aggregate, of one row per rule. Row rules are keys without a value.
    Entries are narrow: whole-number keys stay numbers (others are compared as
    text), roles are numbered within their space, and amounts are summed as
    hundredths in two 32-bit halves, debits less credits, which is exact.
    """
    rules = [r for r in rules if r.table in tables and (not isinstance(r, Foreign) or r.parent in tables)]
    if not rules:
        return None
    foreign = [r for r in rules if isinstance(r, Foreign)]
    held = {(r.table, r.col) for r in rules if isinstance(r, Unique)} | {(r.parent, r.parent_col) for r in foreign}
    place = {space: i for i, space in enumerate(sorted(held))}
    role: dict[str, int] = {}  # of a reference; 0: holds the key
    for space in place:
        role |= {r.name: i for i, r in enumerate((r for r in foreign if (r.parent, r.parent_col) == space), 1)}
    sums = {r.name: len(place) + i for i, r in enumerate(r for r in rules if isinstance(r, Balance))}
    broken = {r.name: len(place) + len(sums) + i for i, r in enumerate(r for r in rules if isinstance(r, Rule))}
    cols = {space: [key] for key, space in place.items()}
    for r in foreign:
        cols[place[r.parent, r.parent_col]].append((r.table, r.col))
    cols |= {sums[r.name]: [(r.table, r.key)] for r in rules if isinstance(r, Balance)}
    numbers = {space for space, of in cols.items() if all(isinstance(tables[t].schema[c].dataType, IntegralType) for t, c in of)}

    def entry(space: int, key: Column, part: int = 0, cents: Column | None = None) -> Column:
        none, text = F.lit(None).cast("long"), F.lit(None).cast("string")
        high, low = (none, none) if cents is None else (F.shiftright(cents, 32), cents.bitwiseAND(F.lit(LOW)))
        return F.struct(F.lit(space).alias("space"), (key.cast("long") if space in numbers else none).alias("num"),
                        (text if space in numbers else key.cast("string")).alias("text"), F.lit(part).alias("role"),
                        high.alias("high"), low.alias("low"))

    parts = None
    for t, df in tables.items():
        own = []
        for (table, col), space in place.items():
            if table == t:
                own.append(F.when(F.col(col).isNotNull(), entry(space, F.col(col))))
        for r in rules:
            if r.table != t:
                continue
            if isinstance(r, Foreign):
                own.append(F.when(F.col(r.col).isNotNull(), entry(place[r.parent, r.parent_col], F.col(r.col), role[r.name])))
            elif isinstance(r, Balance):
                cents = (F.col(r.amount).cast("decimal(18,2)") * F.lit(100)).cast("long")
                side = F.when(F.col(r.direction) == "debit", cents).when(F.col(r.direction) == "credit", -cents)
                own.append(entry(sums[r.name], F.col(r.key), cents=side))
            elif isinstance(r, Rule):
                own.append(F.when(r.broken, entry(broken[r.name], F.lit(None))))
        if own:
            # no higher-order filter inside the array: it would keep the scan out of generated code
            rows = df.select(F.explode(F.array(*own)).alias("e")).filter(F.col("e").isNotNull()).select("e.*")
            parts = rows if parts is None else parts.unionByName(rows)
    by_key = parts.groupBy("space", "num", "text").agg(
        *[F.count(F.when(F.col("role") == i, 1)).alias(f"r{i}") for i in range(max(role.values(), default=0) + 1)],
        F.sum("high").alias("high"), F.sum("low").alias("low"))
    whole = F.coalesce("high", F.lit(0)).cast("decimal(38,0)") * F.lit(LOW + 1) + F.coalesce("low", F.lit(0))
    differs = F.abs(whole.cast("decimal(36,0)") * F.lit(Decimal("0.01")))
    counts = []
    for r in rules:
        space = {Unique: lambda: place[r.table, r.col], Foreign: lambda: place[r.parent, r.parent_col],
                 Balance: lambda: sums[r.name], Rule: lambda: broken[r.name]}[type(r)]()
        here = F.col("space") == space
        if isinstance(r, Unique):
            n = F.count(F.when(here & (F.col("r0") > 1), 1))
        elif isinstance(r, Foreign):
            n = F.coalesce(F.sum(F.when(here & (F.col("r0") == 0), F.col(f"r{role[r.name]}"))), F.lit(0))
        elif isinstance(r, Balance):
            n = F.count(F.when(here & (differs > F.lit(r.tolerance)), 1))
        else:
            n = F.coalesce(F.sum(F.when(here, F.col("r0"))), F.lit(0))
        counts.append(n.cast("long").alias(r.name))
    one = by_key.agg(*counts)
    each = F.array(*[F.struct(F.lit(r.name).alias("check"), F.col(r.name).alias("n")) for r in rules])
    return one.select(F.explode(each).alias("x")).select("x.check", "x.n")
