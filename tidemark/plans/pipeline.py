"""One pipeline run: bronze -> silver -> snapshots -> gold -> checks, strictly
in that order; the tables of a layer are brought up to date side by side. Every
layer is written before the next one reads it, so each stage starts from files
(the lineage is cut at every layer).

Silver follows bronze as a change source: every bronze file is read once,
whenever it appears and whatever ingestion times its rows carry, and a row only
replaces an older one. Gold is recomputed, or (``gold_partitions``) only in the
partitions of the fact that the run's changes reach.

A run keeps a ledger of the outputs its stages committed and of its run time. A
run that was killed is taken up by the next call: finished stages are not done
again, and a stage that had committed without being recorded finds that out.
"""

from __future__ import annotations

import datetime as _dt
import json
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ACCOUNT_STATUSES, ACCOUNT_TYPES, CHANNELS, DIRECTIONS, STATUSES, TABLES, TRANSACTION_TYPES
from ..operators.latest import AUTO, drop_deleted, new_rows
from ..operators.quality import Balance, Foreign, Rule, Unique, count_violations, fx_differs, outside, violations_overlap
from ..operators.scd2 import first_snapshot, snapshot_check_open, snapshot_timestamp_open
from ..functions.time import max_ts, ts_lit, type_name
from ..schemas import BRONZE_SCHEMAS
from ..sources.commit import Unit
from ..sources.files import follow_table, load_new_files, skipped_files
from ..sources.tables import (HistoryTable, PackedTable, VersionedTable, ensure_bronze, path_exists,
                              numbered, read_bronze, read_text, write_text)
from . import gold
from .silver import STATE_EXTRA, live, newer_of, newest_changes

SNAPSHOTS = {
    # table: (key, updated_at column, snapshotted columns, check columns)
    "accounts": ("account_id", "account_updated_at",
                 ["account_id", "customer_id", "bank_id", "account_type", "balance", "currency",
                  "account_opened_at", "account_updated_at"],
                 ["account_type", "balance", "currency"]),
    "customers": ("customer_id", "customer_updated_at",
                  ["customer_id", "full_name", "email", "phone", "nationality",
                   "customer_created_at", "customer_updated_at"],
                  ["full_name", "email", "phone", "nationality"]),
}


@dataclass
class PipelineConfig:
    root: str                                # shared folder for all layers
    staged: str | None = None                # folder of staged change files, one sub-folder per table
    run_at: _dt.datetime | None = None       # run time (check strategy, hard deletes)
    apply_deletes: bool = True               # False: original merge, deletes survive until a full refresh
    silver_source: str = "changes"           # every bronze file once; "mark": rows above a high-water mark
    strict_mark: bool = False                # original "> mark" (reads by mark)
    lookback: _dt.timedelta | None = None    # re-read this far below the mark (reads by mark)
    snapshot_strategy: str = "timestamp"     # or "check"
    snapshot_ops: tuple[str, ...] | None = None   # e.g. ("u", "c")
    gold_mode: str = "overwrite"             # "append" reproduces key-less incremental gold
    silver_tables: tuple[str, ...] = ("transactions", "customers", "accounts", "transaction_legs")
    # table -> SQL expression of its key: store that silver table partitioned by
    # it and rewrite only touched partitions per run (e.g. for append-mostly
    # tables with increasing ids: {"transactions": "floor(transaction_id / 1000000)"})
    silver_partitions: dict[str, str] = field(default_factory=dict)
    # SQL expression of transaction_id (a whole number) by which the fact and
    # the reporting table are partitioned: a run then rewrites only the
    # partitions its changes reach. None: both are recomputed.
    gold_partitions: str | None = None

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def by_mark(self) -> bool:
        return self.silver_source == "mark" or self.strict_mark or self.lookback is not None


def side_by_side(work: dict[str, Callable]) -> dict:
    """Results of independent stages, run at once; the first failure is raised
    after all have ended."""
    if not work:
        return {}
    with ThreadPoolExecutor(len(work)) as pool:
        found = {name: pool.submit(do) for name, do in work.items()}
    return {name: f.result() for name, f in found.items()}


class RunLedger:
    """Progress of one pipeline run, in ``<root>/_run.json`` (replaced in one
    step): its number, run time, and what each finished stage gave."""

    def __init__(self, spark: SparkSession, cfg: PipelineConfig):
        self.spark, self.file, self.lock = spark, cfg.path("_run.json"), threading.Lock()
        found = json.loads(read_text(spark, self.file)) if path_exists(spark, self.file) else None
        if found is None or found["finished"]:
            at = cfg.run_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            found = {"run": found["run"] + 1 if found else 1, "run_at": at.isoformat(), "done": {}, "finished": False}
            self.state = found
            self._write()
        self.state = found

    @property
    def run(self) -> int:
        return self.state["run"]

    @property
    def run_at(self) -> _dt.datetime:
        return _dt.datetime.fromisoformat(self.state["run_at"])

    @property
    def tag(self) -> str:
        return f"run-{self.run}"

    def _write(self) -> None:
        write_text(self.spark, self.file, json.dumps(self.state))

    def stage(self, name: str, do: Callable):
        """The result of ``do()``, or what the stage gave before it was cut off."""
        if name not in self.state["done"]:
            out = do()
            with self.lock:
                self.state["done"][name] = out
                self._write()
        return self.state["done"][name]

    def finish(self) -> None:
        self.state["finished"] = True
        self._write()


def _bronze(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame | None:
    p = cfg.path("bronze", table)
    return read_bronze(spark, table, p) if path_exists(spark, p) else None


def run_load(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """Load the files staged for each table since the last run into its bronze
    table; returns the rows loaded. The streams of the five tables run side by
    side. Files that gave no rows: :func:`read_skipped`."""
    def load(table: str) -> Callable[[], int]:
        return lambda: load_new_files(spark, f"{cfg.staged.rstrip('/')}/{table}", BRONZE_SCHEMAS[table], cfg.path("bronze", table),
                                      cfg.path("_load", table), recursive=True)

    return side_by_side({t: load(t) for t in TABLES if path_exists(spark, f"{cfg.staged.rstrip('/')}/{t}")})


def read_skipped(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame:
    """Staged files of ``table`` that have given no rows."""
    return skipped_files(spark, f"{cfg.staged.rstrip('/')}/{table}", cfg.path("_load", table), recursive=True)


SILVER_PART, STATE, LIVE, DELETED = "silver_part", "state", "live", "deleted"


class SilverStore:
    """State of one silver table (see :func:`.silver.silver_state`): a versioned
    table in which ``state=live`` is silver, or a partitioned one."""

    def __init__(self, spark: SparkSession, cfg: PipelineConfig, table: str):
        self.spark, self.table, self.path = spark, table, cfg.path("silver", table)
        self.expr = cfg.silver_partitions.get(table)
        self.parts = PackedTable(spark, self.path, SILVER_PART)
        self.versions = VersionedTable(spark, self.path)
        self.cfg = cfg

    def _schema(self):
        empty = newest_changes(self.table, self.spark.createDataFrame([], BRONZE_SCHEMAS[self.table]))
        return empty.withColumn(STATE, F.lit("")).schema

    def read(self) -> DataFrame | None:
        """The newest change of every key, deletes included."""
        if self.expr:
            found = self.parts.read()
            return None if found is None else found.drop(SILVER_PART)
        at = self.versions.current_path()
        return None if at is None else self.spark.read.schema(self._schema()).parquet(at).drop(STATE)

    def read_live(self) -> DataFrame | None:
        if self.expr:
            found = self.read()
            return None if found is None else live(found)
        at = self.versions.current_path()
        if at is None:
            return None
        return self.spark.read.schema(self._schema()).parquet(at).filter(F.col(STATE) == LIVE).drop(STATE, *STATE_EXTRA)

    def merge(self, changes: DataFrame) -> None:
        """Let the changes win over older ones."""
        if self.expr:
            self.parts.merge(changes.withColumn(SILVER_PART, F.expr(self.expr)), newer_of(self.table))
            return
        state = self.read()
        merged = changes if state is None else newer_of(self.table)(state, changes)
        flag = F.when(F.col("cdc_op") != F.lit("d"), LIVE).otherwise(DELETED)
        self.versions.write(merged.withColumn(STATE, flag), [STATE])

    def place(self) -> str | None:
        """Folder of the live rows (the table's, if partitioned)."""
        if self.expr:
            return self.path
        at = self.versions.current_path()
        return None if at is None else f"{at}/{STATE}={LIVE}"


def read_silver(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame | None:
    """Current silver table, whichever layout it is stored in."""
    return SilverStore(spark, cfg, table).read_live()


def _mark_file(cfg: PipelineConfig, table: str) -> str:
    return cfg.path("silver", f"_{table}_mark.json")


def read_mark(spark: SparkSession, cfg: PipelineConfig, table: str):
    """Newest bronze ingestion time a committed silver run has processed, or
    AUTO (take it from the silver table) when none was recorded."""
    p = _mark_file(cfg, table)
    if not path_exists(spark, p):
        return AUTO
    text = read_text(spark, p)
    recorded = json.loads(text) if text.strip() else {}
    if "micros" in recorded:
        return int(recorded["micros"])
    return _dt.datetime.fromisoformat(recorded["mark"]) if recorded.get("mark") else AUTO


def _record_mark(spark: SparkSession, cfg: PipelineConfig, table: str, bronze: DataFrame, mark) -> None:
    """After a committed run: the newest ingestion time among the rows it read
    (one column of the partition-pruned slice)."""
    slice_, _ = new_rows(bronze, None if mark is AUTO else bronze, mark=mark)
    if type_name(slice_, "ingested_at") == "timestamp":
        # epoch microseconds: the same instant whatever zone the next run's session has
        micros = slice_.agg(F.unix_micros(F.max("ingested_at"))).first()[0]
        if micros is not None:
            write_text(spark, _mark_file(cfg, table), json.dumps({"micros": micros}))
        return
    newest = max_ts(slice_, "ingested_at")
    if newest is not None:
        write_text(spark, _mark_file(cfg, table), json.dumps({"mark": newest.isoformat()}))


def run_silver(spark: SparkSession, cfg: PipelineConfig, ledger: RunLedger | None = None) -> dict[str, str]:
    """Bring every silver table up to date with its bronze log: by the bronze
    files not read before or, if asked for, by the rows above a recorded mark.
    Versioned tables are rewritten as a new version; partitioned ones (see
    ``PipelineConfig.silver_partitions``) only in the partitions touched."""
    def bring(table: str) -> str | None:
        bronze = _bronze(spark, cfg, table)
        if bronze is None:
            return None
        store = SilverStore(spark, cfg, table)
        if cfg.by_mark:
            _silver_by_mark(spark, cfg, store, bronze)
        else:
            follow_table(spark, cfg.path("bronze", table), BRONZE_SCHEMAS[table], f"{store.path}/_checkpoint",
                         lambda rows, n: _merge_changes(spark, cfg, store, rows, n))
        if store.read() is None:  # no file yet: an empty table
            store.merge(_changes(cfg, table, bronze))
        return store.place()

    work = {t: (lambda t=t: bring(t)) for t in cfg.silver_tables}
    if ledger is not None:
        work = {t: (lambda t=t, do=do: ledger.stage(f"silver/{t}", do)) for t, do in work.items()}
    return {t: p for t, p in side_by_side(work).items() if p is not None}


def _changes(cfg: PipelineConfig, table: str, rows: DataFrame) -> DataFrame:
    changes = newest_changes(table, rows)
    return changes if cfg.apply_deletes else drop_deleted(changes)


def _merge_changes(spark: SparkSession, cfg: PipelineConfig, store: SilverStore, rows: DataFrame, batch: int) -> None:
    """One batch of new bronze rows. Merging it again changes nothing, as only
    newer rows win. Where gold follows the changes too, they are written once
    and read for both; else the merge is all that reads them. The first batch
    is its own table: it is merged, and gold reads it there."""
    changes = _changes(cfg, store.table, rows)
    if cfg.gold_partitions and store.table in FED:
        if store.read() is None:
            # cut off in between, it is delivered again and meets itself: the same partitions
            store.merge(changes)
            _feed(spark, cfg, store, store.read(), batch, first=True)
            return
        path = f"{store.path}/_new"
        changes.write.mode("overwrite").parquet(path)
        changes = spark.read.parquet(path)
        _feed(spark, cfg, store, changes, batch)
    store.merge(changes)


def _silver_by_mark(spark: SparkSession, cfg: PipelineConfig, store: SilverStore, bronze: DataFrame) -> None:
    """The original's way: rows above the newest ingestion time seen; rows that
    arrive later with an older one are missed unless ``lookback`` reaches them."""
    state = store.read()
    mark = AUTO if cfg.strict_mark else read_mark(spark, cfg, store.table)
    rows, _ = new_rows(bronze, state, strict=cfg.strict_mark, lookback=cfg.lookback, mark=mark)
    _merge_changes(spark, cfg, store, rows, len(fed(spark, cfg, store.table)))
    _record_mark(spark, cfg, store.table, bronze, mark)


GOLD_PART = "gold_part"
#: Tables whose changes gold follows by partitions.
FED = ("transactions", "transaction_legs")


def _gold_part(cfg: PipelineConfig):
    """Partition of the fact that a transaction id belongs to."""
    return F.coalesce(F.expr(cfg.gold_partitions).cast("long"), F.lit(-1).cast("long")).alias(GOLD_PART)


def fed(spark: SparkSession, cfg: PipelineConfig, table: str) -> list[int]:
    """Numbers of the change batches recorded for gold."""
    return numbered(spark, cfg.path("silver", table, "_feed"), "batch=")


def _feed(spark: SparkSession, cfg: PipelineConfig, store: SilverStore, changes: DataFrame, batch: int, first: bool = False) -> None:
    """Record the fact partitions that a batch of changes reaches, before it is
    merged (unless it is the ``first``): those of its transactions, or of its
    legs' transactions as they are and as they were. At most as many rows as the
    fact has partitions."""
    path = f"{store.path}/_feed/batch={batch}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        return  # delivered again: the state it was compared with is gone
    parts = changes.select(_gold_part(cfg))
    state = store.read() if store.table == "transaction_legs" and not first else None
    if state is not None:
        parts = parts.unionByName(state.join(changes.select("leg_id"), "leg_id", "left_semi").select(_gold_part(cfg)))
    parts.distinct().write.mode("overwrite").parquet(path)


def run_snapshots(spark: SparkSession, cfg: PipelineConfig, run_at: _dt.datetime, ledger: RunLedger | None = None) -> dict[str, int]:
    """Advance each history by one run. Only the open versions are read and
    rewritten; versions closed by the run are appended. A history that a run
    cut off before had already advanced stays as it is."""
    def advance(table: str) -> int | None:
        key, upd, cols, check = SNAPSHOTS[table]
        silver = read_silver(spark, cfg, table)
        if silver is None:
            return None
        store = HistoryTable(spark, cfg.path("snapshots", table))
        if ledger is not None and store.tagged(ledger.tag) is not None:
            return store.tagged(ledger.tag)
        cur = silver.select(*cols, "cdc_op")
        open_ = store.read_open()
        if open_ is None:
            at = ts_lit(run_at) if cfg.snapshot_strategy == "check" else F.col(upd)
            rows = first_snapshot(cur, [key], at, ops=cfg.snapshot_ops)
        elif cfg.snapshot_strategy == "check":
            rows = snapshot_check_open(open_, cur, [key], check, run_at, ops=cfg.snapshot_ops)
        else:
            rows = snapshot_timestamp_open(open_, cur, [key], upd, ops=cfg.snapshot_ops)
        return store.write_run(rows, ledger.tag if ledger is not None else None)

    work = {t: (lambda t=t: advance(t)) for t in SNAPSHOTS}
    if ledger is not None:
        work = {t: (lambda t=t, do=do: ledger.stage(f"snapshots/{t}", do)) for t, do in work.items()}
    return {t: n for t, n in side_by_side(work).items() if n is not None}


def read_history(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame | None:
    return HistoryTable(spark, cfg.path("snapshots", table)).read()


FACTS = {"fct_transactions": gold.fct_rows, "gold_transactions_reporting": gold.reporting_rows}


def run_gold(spark: SparkSession, cfg: PipelineConfig, ledger: RunLedger | None = None) -> dict[str, str]:
    """The gold models; dimensions side by side, then the fact and the
    reporting table from one as-of join and one join with the legs, written once. With
    ``gold_partitions`` see :func:`_run_facts`."""
    silver = {t: read_silver(spark, cfg, t) for t in cfg.silver_tables}
    snaps = {t: read_history(spark, cfg, t) for t in SNAPSHOTS}
    opened = {t: HistoryTable(spark, cfg.path("snapshots", t)).read_open() for t in SNAPSHOTS}
    stage = ledger.stage if ledger is not None else lambda name, do: do()

    def put(name: str, df: DataFrame) -> str:
        p = cfg.path("gold", name)
        if cfg.gold_mode == "overwrite":
            return VersionedTable(spark, p).write(df)
        # appended once by each run, also by one that is taken up again
        unit = Unit(spark, cfg.path("_gold_units"), f"{name}-{ledger.tag if ledger is not None else _dt.datetime.now().timestamp()}")
        if unit.committed() is None:
            df.write.parquet(unit.stage(p))
            unit.commit()
        return p

    work = {}
    if opened["customers"] is not None:
        work["dim_customers"] = lambda: put("dim_customers", gold.dim_customers(opened["customers"]))
    if opened["accounts"] is not None:
        work["dim_accounts"] = lambda: put("dim_accounts", gold.dim_accounts(opened["accounts"]))
    banks = _bronze(spark, cfg, "banks")
    if banks is not None:
        work["dim_banks"] = lambda: put("dim_banks", gold.dim_banks(banks))
    out = side_by_side({n: (lambda n=n, do=do: stage(f"gold/{n}", do)) for n, do in work.items()})
    parts = (silver.get("transactions"), snaps["accounts"], snaps["customers"])
    legs = silver.get("transaction_legs")
    if any(p is None for p in parts) or legs is None:
        return out
    if cfg.gold_partitions and cfg.gold_mode == "overwrite":
        return out | stage("gold/facts", lambda: _run_facts(spark, cfg, *parts, legs))

    def work_table() -> str:
        work = cfg.path("gold", "_work", "transactions_with_legs")
        gold.with_legs(gold.transactions_as_of(*parts, combined=None), legs).write.mode("overwrite").parquet(work)
        return work

    joined = spark.read.parquet(stage("gold/_joined", work_table))
    return out | side_by_side({n: (lambda n=n, make=make: stage(f"gold/{n}", lambda: put(n, make(joined)))) for n, make in FACTS.items()})


def _run_facts(spark: SparkSession, cfg: PipelineConfig, txn: DataFrame, accounts: DataFrame, customers: DataFrame,
               legs: DataFrame) -> dict[str, str]:
    """The fact and the reporting table by partitions of the transaction id.

    What a run must do again follows from what changed since the tables' last
    commit: transactions and legs by the feed that the silver merges left;
    account and customer versions by comparing the open sets and the versions
    closed since, which gives, per account, the time from which its
    transactions may see another version. Only partitions that hold such rows
    are computed and replaced, all or nothing; without any, none is written. The
    first run, or one whose earlier open set is gone, computes all."""
    stores = {n: PackedTable(spark, cfg.path("gold", n), GOLD_PART) for n in FACTS}
    histories = {t: HistoryTable(spark, cfg.path("snapshots", t)) for t in SNAPSHOTS}
    now = {"feed": {t: fed(spark, cfg, t)[-1:] for t in FED},
           "snapshots": {t: h.last_run() for t, h in histories.items()}, "by": cfg.gold_partitions}
    done = [s.commit() for s in stores.values()]
    values = None
    if all(c is not None and c["info"].get("by") == cfg.gold_partitions for c in done):
        if all(c["info"] == now for c in done):
            return {n: s.path for n, s in stores.items()}
        # both tables were committed one after the other: start from the older
        last = min((c["info"] for c in done), key=lambda i: (i["snapshots"]["accounts"], i["feed"]["transactions"]))
        reached = _reached(spark, cfg, last, txn, accounts, histories)
        if reached is not None:
            values = sorted(r[0] for r in reached.distinct().collect())  # at most one row per partition
    own = _gold_part(cfg)
    if values is not None:
        if not values:
            for s in stores.values():
                s.replace(spark.createDataFrame([], "x int"), [], now)
            return {n: s.path for n, s in stores.items()}
        some = F.broadcast(spark.createDataFrame([(v,) for v in values], f"{GOLD_PART} long"))
        txn, legs = (df.withColumn(GOLD_PART, own).join(some, GOLD_PART, "left_semi").drop(GOLD_PART) for df in (txn, legs))
    work = cfg.path("gold", "_work", "transactions_with_legs")
    gold.with_legs(gold.transactions_as_of(txn, accounts, customers, combined=None), legs).write.mode("overwrite").parquet(work)
    joined = spark.read.parquet(work)

    def put(name: str) -> str:
        rows = FACTS[name](joined).withColumn(GOLD_PART, own)
        if values is None:
            stores[name].write(rows, now)
        else:
            stores[name].replace(rows, [f"{GOLD_PART}={v}" for v in values], now)
        return stores[name].path

    return side_by_side({n: (lambda n=n: put(n)) for n in FACTS})


def _reached(spark: SparkSession, cfg: PipelineConfig, last: dict, txn: DataFrame, accounts: DataFrame,
             histories: dict[str, HistoryTable]) -> DataFrame | None:
    """``(gold_part)`` of the rows that changes since ``last`` may alter, None
    if that cannot be told."""
    found = spark.createDataFrame([], f"{GOLD_PART} long")
    for table, seen in last["feed"].items():
        have = fed(spark, cfg, table)
        if seen and (not have or have[-1] < seen[0]):
            return None  # silver was built anew
        new = [n for n in have if not seen or n > seen[0]]
        if new:
            found = found.unionByName(spark.read.parquet(*[cfg.path("silver", table, "_feed", f"batch={n}") for n in new]))
    since = {}
    for table, h in histories.items():
        run = last["snapshots"][table]
        if h.last_run() == run:
            continue
        before = h.open_at(run)
        if before is None:
            return None
        since[table] = changed_since(before, h.read_open(), h.closed_after(run), SNAPSHOTS[table][0])
    moved = since.get("accounts")
    if "customers" in since:
        owners = accounts.select("account_id", "customer_id").distinct()
        through = owners.join(since["customers"], "customer_id").select("account_id", "since")
        moved = through if moved is None else moved.unionByName(through)
    if moved is not None:
        moved = moved.groupBy("account_id").agg(F.min("since").alias("since"))
        hit = txn.select("transaction_id", "account_id", "transaction_created_at").join(moved, "account_id")
        found = found.unionByName(hit.filter(F.col("transaction_created_at") >= F.col("since")).select(_gold_part(cfg)))
    return found


def changed_since(before: DataFrame, opened: DataFrame, closed: DataFrame, key: str) -> DataFrame:
    """``(key, since)``: keys whose versions changed, with the earliest time at
    which another version holds: the start of a version that was not open
    before, or the end of one that was and is closed."""
    old = before.select(key, "valid_from", F.lit(True).alias("__was"))
    new = opened.select(key, "valid_from", "valid_to").unionByName(closed.select(key, "valid_from", "valid_to"))
    j = new.join(old, [key, "valid_from"], "left")
    since = F.when(F.col("__was").isNull(), F.col("valid_from")).otherwise(F.col("valid_to"))
    return j.select(key, since.alias("since")).filter(F.col("since").isNotNull()).groupBy(key).agg(F.min("since").alias("since"))


def run_checks(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """Constraint checks on silver, returned as violation counts (the
    violating rows come from the same ``violations_*`` calls), which are also
    kept as a table (:func:`read_checks`). At most one row per check reaches the
    driver."""
    counts = check_counts(spark, cfg)
    if counts is None:
        return {}
    VersionedTable(spark, cfg.path("checks")).write(counts)
    return {r["check"]: r["n"] for r in read_checks(spark, cfg).collect()}


def read_checks(spark: SparkSession, cfg: PipelineConfig) -> DataFrame | None:
    """``(check, n)`` as the last run counted them."""
    return VersionedTable(spark, cfg.path("checks")).read()


#: Unique columns, and (child, column, parent) of each foreign key.
UNIQUE = {"unique_transactions": ("transactions", "transaction_id"), "unique_customers": ("customers", "customer_id"),
          "unique_accounts": ("accounts", "account_id"), "unique_transaction_legs": ("transaction_legs", "leg_id"),
          "unique_customer_email": ("customers", "email"), "unique_banks": ("banks", "bank_id"),
          "unique_bank_swift_code": ("banks", "swift_code")}
FOREIGN = {"fk_account_customer": ("accounts", "customer_id", "customers"), "fk_account_bank": ("accounts", "bank_id", "banks"),
           "fk_transaction_account": ("transactions", "account_id", "accounts"),
           "fk_leg_transaction": ("transaction_legs", "transaction_id", "transactions"),
           "fk_leg_account": ("transaction_legs", "account_id", "accounts"),
           "fk_leg_bank": ("transaction_legs", "bank_id", "banks")}
def rules() -> list:
    return [
        *[Unique(name, t, k) for name, (t, k) in UNIQUE.items()],
        *[Foreign(name, child, k, parent, k) for name, (child, k, parent) in FOREIGN.items()],
        Rule("domain_account_type", "accounts", outside("account_type", ACCOUNT_TYPES)),
        Rule("domain_account_status", "accounts", outside("account_status", ACCOUNT_STATUSES)),
        Rule("domain_channel", "transactions", outside("channel", CHANNELS)),
        Rule("domain_type", "transactions", outside("transaction_type", TRANSACTION_TYPES)),
        Rule("domain_status", "transactions", outside("status", STATUSES)),
        Rule("fx", "transactions", fx_differs()),
        Rule("domain_direction", "transaction_legs", outside("direction", DIRECTIONS)),
        Balance("balance", "transaction_legs", "transaction_id"),
    ]


def check_counts(spark: SparkSession, cfg: PipelineConfig) -> DataFrame | None:
    """``(check, n)``: the violations of every constraint whose tables exist:
    one scan of each table for all of its rules, and one of each history. A NULL
    is no duplicate of another NULL."""
    s = {t: read_silver(spark, cfg, t) for t in cfg.silver_tables}
    banks = _bronze(spark, cfg, "banks")
    s["banks"] = None if banks is None else gold.dim_banks(banks)
    found = count_violations({t: df for t, df in s.items() if df is not None}, rules())
    for table, (key, *_rest) in SNAPSHOTS.items():
        history = read_history(spark, cfg, table)
        if history is not None:
            n = violations_overlap(history, [key]).agg(F.count(F.lit(1)).alias("n"))
            n = n.select(F.lit(f"overlap_{table}_history").alias("check"), "n")
            found = n if found is None else found.unionByName(n)
    return found


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Load of the staged files (with ``cfg.staged``), then silver, snapshots,
    gold and checks over the bronze tables under ``cfg.root/bronze``, which the
    load, the stream ingest and backfills may all write. Bronze
    tables that do not exist yet are created empty with their fixed schema,
    so every model runs (on no rows) before its first change arrives.

    A run that did not end is taken up where it stopped, with its run time; its
    result then holds what its finished stages gave (``loaded``: the rows of
    the call that finished the load)."""
    ledger = RunLedger(spark, cfg)
    for table in TABLES:
        ensure_bronze(spark, table, cfg.path("bronze", table))
    result: dict = {"loaded": ledger.stage("load", lambda: run_load(spark, cfg)) if cfg.staged else {}}
    result["silver"] = run_silver(spark, cfg, ledger)
    result["snapshots"] = run_snapshots(spark, cfg, ledger.run_at, ledger)
    result["gold"] = run_gold(spark, cfg, ledger)
    result["checks"] = ledger.stage("checks", lambda: run_checks(spark, cfg))
    ledger.finish()
    return result


def read_gold(spark: SparkSession, cfg: PipelineConfig, name: str) -> DataFrame:
    """A gold table as the last run left it."""
    p = cfg.path("gold", name)
    if cfg.gold_mode != "overwrite":
        return spark.read.parquet(p)
    if cfg.gold_partitions and name in FACTS:
        return PackedTable(spark, p, GOLD_PART).read().drop(GOLD_PART)
    return VersionedTable(spark, p).read()
