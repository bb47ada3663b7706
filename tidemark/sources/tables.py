"""Bronze and gold table I/O on plain parquet (or a catalog table when one is
configured): create-if-absent, append, publish, and versioned replacement for
keyed tables that are rewritten (there is no MERGE on plain files)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, IntegralType, LongType, StringType, StructField, StructType

from ..schemas import BRONZE_SCHEMAS

PARTITION_COL = "ingestion_date"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers ``n`` of the folders ``<prefix><n>`` under ``path``, ascending."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def ensure_bronze(spark: SparkSession, table: str, path: str) -> None:
    """Create an empty partitioned bronze table with the fixed schema when
    absent, so that readers see the schema before the first change arrives."""
    if path_exists(spark, path):
        return
    empty = spark.createDataFrame([], BRONZE_SCHEMAS[table])
    empty.write.mode("append").partitionBy(PARTITION_COL).parquet(path)


def ensure_catalog_bronze(spark: SparkSession, table: str, name: str, using: str | None = None, location: str | None = None) -> None:
    """Create the bronze table of ``table`` in a catalog as ``name`` when absent:
    fixed schema, partitioned by ingestion date. ``using``: a table format
    (default: the catalog's)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BRONZE_SCHEMAS[table].fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) {f'USING {using} ' if using else ''}PARTITIONED BY ({PARTITION_COL})"
              + (f" LOCATION '{location}'" if location else ""))


def read_bronze(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Bronze with the declared schema; ``ingestion_date`` comes from partition
    discovery, so date predicates prune directories."""
    return spark.read.schema(BRONZE_SCHEMAS[table]).parquet(path)


def append_bronze(df: DataFrame, path: str, table: str | None = None) -> None:
    """Append one batch to a bronze table, one directory per ingestion date, or
    to the catalog table ``table``, matched by name."""
    if table is not None:
        df.select(*df.sparkSession.table(table).columns).write.insertInto(table)
        return
    df.write.mode("append").partitionBy(PARTITION_COL).parquet(path)


def backfill_bronze(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Append a historical change log that spans many ingestion dates.

    Rows are rebalanced by date first: a task writes few dates instead of a
    file in every date it happens to hold, and adaptive execution splits a date
    too large for one task over several. Streaming batches do not need this:
    all rows of one batch share one ingestion date. ``partitions``: how many
    partitions to start from."""
    (df.hint("rebalance", *([partitions] if partitions else []), PARTITION_COL)
       .write.mode("append").partitionBy(PARTITION_COL).parquet(path))


def publish(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a table. ``overwrite`` (default) replaces it; ``append`` adds the
    rows again on every run, like an incremental model without key. A failed
    overwrite leaves no table: see :class:`VersionedTable`."""
    df.write.mode(mode).parquet(path)


class VersionedTable:
    """A keyed table that is rewritten as a whole on each run.

    Each write goes to a new ``v=<n>`` folder; readers take the newest folder
    that has a success marker, so a path is never overwritten while it is being
    read, and a failed write leaves the previous version current. After a write
    only the newest ``keep`` versions stay.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 3):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keep = keep

    def versions(self) -> list[int]:
        fs, p = _fs(self.spark, self.path)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v="):
                marker = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
                if fs.exists(marker):
                    out.append(int(name[2:]))
        return sorted(out)

    def current_path(self) -> str | None:
        v = self.versions()
        return f"{self.path}/v={v[-1]}" if v else None

    def read(self) -> DataFrame | None:
        cur = self.current_path()
        return self.spark.read.parquet(cur) if cur else None

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        v = self.versions()
        out = self.write_version(df, (v[-1] + 1) if v else 1, partition_by)
        for old in self.versions()[: -self.keep]:
            remove(self.spark, f"{self.path}/v={old}")
        return out

    def write_version(self, df: DataFrame, n: int, partition_by: list[str] | None = None) -> str:
        """Write version ``n``; a leftover of a failed attempt (no success
        marker, so never read) is replaced."""
        out = f"{self.path}/v={n}"
        df.write.mode("overwrite").partitionBy(*partition_by or []).parquet(out)
        return out


class PartitionedTable:
    """A keyed table stored by partitions (``part_col``, a function of the key,
    so a key never changes partition), of which a run rewrites only those its
    changes touch, all or nothing.

    Run ``n`` writes to ``run=<n>/<part_col>=<value>`` and then, in one step,
    ``_commits/<n>.json``: the schema and, for every partition folder, the run
    that holds it. Readers take the newest commit, so a run that fails anywhere
    leaves the table as it was, and its folder is replaced by the next attempt.
    A read names exactly the folders of the commit. The folders that only older
    commits than the last ``keep`` name are removed. A commit has one entry per
    partition, which is all that passes through the driver. One writer at a
    time is assumed.
    """

    def __init__(self, spark: SparkSession, path: str, part_col: str, keep: int = 2):
        self.spark, self.path, self.part_col, self.keep = spark, path.rstrip("/"), part_col, keep

    def runs(self) -> list[int]:
        """Numbers of the commits that are kept, ascending."""
        fs, p = _fs(self.spark, f"{self.path}/_commits")
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def commit(self, run: int | None = None) -> dict | None:
        """The newest commit (or that of ``run``): run, schema, parts, info."""
        if run is None:
            runs = self.runs()
            if not runs:
                return None
            run = runs[-1]
        return json.loads(read_text(self.spark, f"{self.path}/_commits/{run}.json"))

    def _rows(self, commit: dict, names: list[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(commit["schema"])
        parts = commit["parts"]
        paths = [f"{self.path}/run={parts[n]}/{n}" for n in (parts if names is None else names) if n in parts]
        if not paths:
            return self.spark.createDataFrame([], schema)
        full = StructType([*schema.fields, StructField("run", IntegerType())])
        return self.spark.read.schema(full).option("basePath", self.path).parquet(*paths).select(*schema.fieldNames())

    def read(self) -> DataFrame | None:
        found = self.commit()
        return None if found is None else self._rows(found)

    def _folders(self, root: str) -> list[str]:
        fs, p = _fs(self.spark, root)
        if not fs.exists(p):
            return []
        return [n for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.startswith(f"{self.part_col}=")]

    def _write(self, rows: DataFrame, path: str) -> list[str]:
        rows.hint("rebalance", self.part_col).write.mode("overwrite").partitionBy(self.part_col).parquet(path)
        return self._folders(path)

    def write(self, rows: DataFrame, info: dict | None = None) -> int:
        """Replace the whole table."""
        last = self.commit()
        run = (last["run"] if last else 0) + 1
        names = self._write(rows, f"{self.path}/run={run}")
        return self._commit(run, rows.schema, dict.fromkeys(names, run), info)

    def replace(self, rows: DataFrame, touched: list[str], info: dict | None = None) -> int:
        """Replace the partitions named ``touched`` (folder names) by ``rows``,
        which hold rows of these partitions only; the others stay. Without
        touched partitions nothing is written but the commit."""
        last = self.commit()
        run = last["run"] + 1
        names = self._write(rows.select(*StructType.fromJson(last["schema"]).fieldNames()), f"{self.path}/run={run}") if touched else []
        parts = {n: r for n, r in last["parts"].items() if n not in touched} | dict.fromkeys(names, run)
        return self._commit(run, StructType.fromJson(last["schema"]), parts, info)

    def touched(self, changes: DataFrame) -> tuple[DataFrame, list[str]]:
        """``changes``, written once beside the table, and the names of the
        partitions they touch."""
        staged = f"{self.path}/_changes"
        names = self._write(changes, staged)
        return self.spark.read.schema(changes.schema).parquet(staged), names

    def part(self, names: list[str]) -> DataFrame:
        """The rows of some partitions."""
        return self._rows(self.commit(), names)

    def merge(self, changes: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], info: dict | None = None) -> int:
        """Rewrite the touched partitions as ``how(their rows, the changes)``;
        the first merge makes the table. Returns the run."""
        last = self.commit()
        if last is None:
            return self.write(how(changes.limit(0), changes), info)
        staged, names = self.touched(changes)
        if not names:
            return last["run"]
        return self.replace(how(self._rows(last, names), staged), names, info)

    def _places(self, commit: dict) -> set[str]:
        """Folders that a commit names."""
        return {f"run={r}/{n}" for n, r in commit["parts"].items()}

    def _commit(self, run: int, schema: StructType, parts: dict[str, int], info: dict | None, **more) -> int:
        found = {"run": run, "schema": schema.jsonValue(), "parts": parts, "info": info or {}, **more}
        write_text(self.spark, f"{self.path}/_commits/{run}.json", json.dumps(found))
        runs = self.runs()
        needed = {p for r in runs[-self.keep:] for p in self._places(self.commit(r))}
        for old in runs[: -self.keep]:
            for place in sorted(self._places(self.commit(old)) - needed):
                remove(self.spark, f"{self.path}/{place}")
            remove(self.spark, f"{self.path}/_commits/{old}.json")
        return run


#: Consecutive partitions of a :class:`PackedTable` that share a folder, and
#: folders that partitions without consecutive numbers are dealt to.
PACK, PACKS = 256, 64


class PackedTable(PartitionedTable):
    """A partitioned table for many small partitions: ``PACK`` consecutive ones
    share the files of a folder ``run=<n>/<part_col>_pack=<number>``, in which
    ``part_col`` is an ordinary column. A folder for each partition costs its
    writer, the committer and every reader more than its rows do.

    The commit names, as before, the run that holds each partition, and
    ``packs`` its folder there. A run still writes only the rows of the
    partitions it replaces; in folders of earlier runs their old rows stay, and
    readers leave out the rows of partitions that a later run holds. A folder of
    which less than half of its partitions still count is given up: the run
    copies the others, so that the table never takes twice its rows for long.
    Commits of a :class:`PartitionedTable` are read, and packed by the next run.
    """

    @property
    def pack_col(self) -> str:
        return f"{self.part_col}_pack"

    def _name(self):
        """Name of a row's partition, as the folder's would be."""
        return F.concat(F.lit(f"{self.part_col}="), F.coalesce(F.col(self.part_col).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))

    def _pack(self, schema: StructType):
        if isinstance(schema[self.part_col].dataType, IntegralType):
            return F.coalesce(F.floor(F.col(self.part_col) / PACK), F.lit(0)).cast("long")
        return F.pmod(F.xxhash64(self._name()), F.lit(PACKS)).cast("long")

    def _place(self, commit: dict, name: str) -> str:
        return f"run={commit['parts'][name]}/{self.pack_col}={commit['packs'][name]}"

    def _places(self, commit: dict) -> set[str]:
        return {self._place(commit, n) for n in commit["parts"]} if "packs" in commit else super()._places(commit)

    def _rows(self, commit: dict, names: list[str] | None = None) -> DataFrame:
        if "packs" not in commit:
            return super()._rows(commit, names)
        schema, parts = StructType.fromJson(commit["schema"]), commit["parts"]
        wanted = [n for n in (parts if names is None else names) if n in parts]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        held: dict[str, int] = {}
        for n in wanted:
            place = self._place(commit, n)
            held[place] = held.get(place, 0) + 1
        full = StructType([*schema.fields, StructField(self.pack_col, LongType()), StructField("run", IntegerType())])

        def read(places: list[str]) -> DataFrame:
            return self.spark.read.schema(full).option("basePath", self.path).parquet(*[f"{self.path}/{p}" for p in places])

        # folders that are wanted whole need no look at their rows
        whole = [p for p, k in held.items() if k == commit["written"][p]]
        some = [p for p, k in held.items() if k != commit["written"][p]]
        found = [read(whole)] if whole else []
        if some:
            left_in = set(some)
            live = self.spark.createDataFrame([(n, parts[n]) for n in wanted if self._place(commit, n) in left_in], "__name string, run int")
            found.append(read(some).withColumn("__name", self._name()).join(F.broadcast(live), ["__name", "run"], "left_semi"))
        rows = found[0].select(*schema.fieldNames())
        return rows if len(found) == 1 else rows.unionByName(found[1].select(*schema.fieldNames()))

    def _names(self, path: str) -> list[str]:
        """Partitions of the rows in a folder: one pass over one column."""
        return sorted(r[0] for r in self.spark.read.parquet(path).select(self._name()).distinct().collect())

    def _write_packs(self, rows: DataFrame, path: str) -> dict[str, int]:
        """Write the rows; returns the pack of each partition."""
        packed = rows.withColumn(self.pack_col, self._pack(rows.schema)).hint("rebalance", self.pack_col)
        (packed.sortWithinPartitions(self.pack_col, self.part_col)
               .write.mode("overwrite").partitionBy(self.pack_col).parquet(path))
        full = StructType([*rows.schema.fields, StructField(self.pack_col, LongType())])
        found = self.spark.read.schema(full).parquet(path).select(self._name().alias("name"), self.pack_col).distinct().collect()
        return {r["name"]: r[self.pack_col] for r in sorted(found)}

    def _commit_packs(self, run: int, schema: StructType, last: dict | None, kept: dict[str, int], new: dict[str, int],
                      info: dict | None) -> int:
        """Commit ``kept`` partitions of ``last`` and ``new`` ones of this run."""
        found = {"parts": kept | dict.fromkeys(new, run), "packs": {n: last["packs"][n] for n in kept} | new}
        written = {p: last["written"][p] for p in {self._place(last, n) for n in kept}}
        for g in new.values():
            place = f"run={run}/{self.pack_col}={g}"
            written[place] = written.get(place, 0) + 1
        return self._commit(run, schema, found["parts"], info, packs=found["packs"], written=written)

    def write(self, rows: DataFrame, info: dict | None = None) -> int:
        last = self.commit()
        run = (last["run"] if last else 0) + 1
        return self._commit_packs(run, rows.schema, None, {}, self._write_packs(rows, f"{self.path}/run={run}"), info)

    def replace(self, rows: DataFrame, touched: list[str], info: dict | None = None) -> int:
        last = self.commit()
        run, schema, gone = last["run"] + 1, StructType.fromJson(last["schema"]), set(touched)
        kept = {n: r for n, r in last["parts"].items() if n not in gone}
        if "packs" in last:
            left: dict[str, int] = {}
            for n in kept:
                left[self._place(last, n)] = left.get(self._place(last, n), 0) + 1
            carried = [n for n in kept if 2 * left[self._place(last, n)] < last["written"][self._place(last, n)]]
        else:
            carried = list(kept)
        new: dict[str, int] = {}
        if touched or carried:
            rows = rows.select(*schema.fieldNames()) if touched else self.spark.createDataFrame([], schema)
            if carried:
                rows = rows.unionByName(self._rows(last, carried))
            new = self._write_packs(rows, f"{self.path}/run={run}")
        again = set(carried)
        return self._commit_packs(run, schema, last, {n: r for n, r in kept.items() if n not in again}, new, info)

    def touched(self, changes: DataFrame) -> tuple[DataFrame, list[str]]:
        staged = f"{self.path}/_changes"
        changes.write.mode("overwrite").parquet(staged)
        return self.spark.read.schema(changes.schema).parquet(staged), self._names(staged)


def merge_into(spark: SparkSession, table: str, updates: DataFrame, keys: list[str], *,
               delete_op: str | None = "d", op_col: str = "cdc_op") -> None:
    """Key upsert into a catalog table whose format supports ``MERGE INTO``
    (Delta, Iceberg): matched rows are replaced, new keys inserted, and with
    ``delete_op`` a matched row whose newest change is a delete is removed.
    ``updates`` must hold one row per key (see ``latest_per_key``). Plain
    parquet tables reject MERGE; use ``VersionedTable`` with ``upsert`` there.
    Not exercised by the tests here: no such table format is on this class path."""
    view = f"__tidemark_updates_{abs(hash((table, tuple(keys)))) % 10**8}"
    updates.createOrReplaceTempView(view)
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    # same three-valued rule as the delete filter: a NULL op removes, never inserts
    delete = (f"WHEN MATCHED AND coalesce(s.`{op_col}`, '{delete_op}') = '{delete_op}' THEN DELETE "
              if delete_op and op_col in updates.columns else "")
    insert_guard = (f"AND s.`{op_col}` <> '{delete_op}' "
                    if delete_op and op_col in updates.columns else "")
    spark.sql(f"MERGE INTO {table} t USING {view} s ON {on} {delete}"
              f"WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED {insert_guard}THEN INSERT *")
    spark.catalog.dropTempView(view)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file in one step: written under a new name beside
    it, then renamed over it."""
    part = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    fs, new = _fs(spark, part)
    out = fs.create(new, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    how = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    how[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(new, hadoop.Path(path), how)


def read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


class HistoryTable:
    """Storage for an SCD2 history that grows by runs.

    Run ``n`` writes its rows once, to ``state=closed/run=<n>`` (versions this
    run closed; a closed version never changes again) and ``state=open/run=<n>``
    (the open set after the run, one row per key). The newest committed run is
    named in ``_committed.json``, replaced in one step after the write, so
    readers never see a run in part and a retried run first removes what its
    failed attempt left. The history is one scan, pruned by those two folders,
    however many runs it has. A run reads only the newest open set, so it costs
    O(keys), not O(history); open sets older than the last ``keep`` are removed.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keep = keep

    def _committed(self) -> dict | None:
        p = f"{self.path}/_committed.json"
        return json.loads(read_text(self.spark, p)) if path_exists(self.spark, p) else None

    def last_run(self) -> int:
        """The newest committed run, 0 before the first."""
        found = self._committed()
        return found["run"] if found else 0

    def _rows(self, committed: dict) -> DataFrame:
        schema = StructType.fromJson(committed["schema"])
        names = schema.fieldNames()
        full = schema.add("state", StringType()).add("run", IntegerType())
        return self.spark.read.schema(full).parquet(self.path).select(*names, "state", "run")

    def read_open(self) -> DataFrame | None:
        found = self._committed()
        if found is None:
            return None
        return self._rows(found).filter((F.col("state") == "open") & (F.col("run") == found["run"])).drop("state", "run")

    def read(self) -> DataFrame | None:
        """The whole history: closed versions of every committed run and the
        newest open set."""
        found = self._committed()
        if found is None:
            return None
        state, run, last = F.col("state"), F.col("run"), F.lit(found["run"])
        return self._rows(found).filter(((state == "closed") & (run <= last)) | ((state == "open") & (run == last))).drop("state", "run")

    def tagged(self, tag: str) -> int | None:
        """The newest run, if it was committed under ``tag``."""
        found = self._committed()
        return found["run"] if found and found.get("tag") == tag else None

    def open_at(self, run: int) -> DataFrame | None:
        """The open set after an earlier run, None if it is gone."""
        if not path_exists(self.spark, f"{self.path}/state=open/run={run}"):
            return None
        return self._rows(self._committed()).filter((F.col("state") == "open") & (F.col("run") == run)).drop("state", "run")

    def closed_after(self, run: int) -> DataFrame:
        """Versions closed by committed runs after ``run``."""
        found = self._committed()
        at = (F.col("state") == "closed") & (F.col("run") > run) & (F.col("run") <= found["run"])
        return self._rows(found).filter(at).drop("state", "run")

    def write_run(self, rows: DataFrame, tag: str | None = None) -> int:
        """Store one run's rows (the output of a ``snapshot_*_open`` step, or
        of ``first_snapshot``) in a single write. ``tag``: who asked for it
        (see :meth:`tagged`)."""
        run = self.last_run() + 1
        for state in ("open", "closed"):
            remove(self.spark, f"{self.path}/state={state}/run={run}")
        state = F.when(F.col("valid_to").isNull(), "open").otherwise("closed")
        (rows.withColumn("state", state).withColumn("run", F.lit(run))
             .write.mode("append").partitionBy("state", "run").parquet(self.path))
        write_text(self.spark, f"{self.path}/_committed.json", json.dumps({"run": run, "schema": rows.schema.jsonValue(), "tag": tag}))
        for old in numbered(self.spark, f"{self.path}/state=open", "run="):
            if old <= run - self.keep:
                remove(self.spark, f"{self.path}/state=open/run={old}")
        return run
