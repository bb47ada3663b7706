"""Incremental file loads, the change source over bronze, and dead-letter
output."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..functions.cdc import CORRUPT
from .commit import Unit, prune
from .tables import PARTITION_COL, append_bronze, path_exists


#: Staged files are loaded however old they are when they are first seen.
MAX_FILE_AGE = "36500d"
#: Bytes of staged files that make a bronze file worth writing without an exchange.
WHOLE_FILE = 4 << 20
FILE_ROW = "path string, modificationTime timestamp, length long, content binary"
REJECT = "file string, column string, value string, row string"


def load_new_files(spark: SparkSession, source_dir: str, schema: StructType, target: str,
                   checkpoint: str, *, glob: str = "*.parquet", ignore_corrupt: bool = True,
                   table: str | None = None, max_files_per_trigger: int = 1000,
                   recursive: bool = False, rejects: str | None = None) -> int:
    """Load every parquet file of ``source_dir`` into the bronze table ``target``
    once.

    A stream over the file names run with ``availableNow``: the checkpoint
    remembers which files were read, so a second run loads only files added
    since, however old their modification time; the source files are left in
    place. The files of a micro-batch are grouped by the types in their footers
    (all at once if they agree, else by halves). Columns are matched by name
    against the declared ``schema``, whatever their case; a missing column
    reads as NULL and an extra one is ignored. A column of another type is
    cast; a row with a value that cannot be cast is not loaded, and each such
    value goes, with its file, column and whole row as JSON, to the reject table
    (``rejects``, default ``<checkpoint>_rejects``: see :func:`read_rejects`).
    Unreadable files are skipped (``ignore_corrupt``) and listed by
    :func:`skipped_files`. ``recursive`` also reads files in sub-folders;
    partition columns are then not discovered.

    The rows of a micro-batch, its rejects and the names of the files that gave
    rows become visible together and once (:class:`~.commit.Unit`): a batch
    that is delivered again after a failure is not loaded again. Rows for the
    catalog table ``table`` are appended to it instead, at least once.
    Returns the number of rows loaded by this run.
    """
    rejects = rejects or f"{checkpoint.rstrip('/')}_rejects"
    found = (spark.readStream.format("binaryFile").schema(FILE_ROW)
             .option("pathGlobFilter", glob)
             .option("maxFileAge", MAX_FILE_AGE)
             .option("maxFilesPerTrigger", str(max_files_per_trigger))
             .option("recursiveFileLookup", str(recursive).lower())
             .load(source_dir).select("path", "length"))
    loaded, ledger = 0, f"{checkpoint.rstrip('/')}/_units"  # goes with the checkpoint, whose batch numbers it counts

    def load(batch: DataFrame, batch_id: int) -> None:
        nonlocal loaded
        unit = Unit(spark, ledger, f"load-{batch_id}")
        if unit.committed() is not None:
            return
        staged = batch.collect()  # at most ``max_files_per_trigger`` names and lengths
        names, size = [r["path"] for r in staged], sum(r["length"] for r in staged)
        rows = bad = None
        for some, own in by_footer(spark, names, ignore_corrupt):
            good, wrong = _conform(_read_files(spark, some, own, source_dir, recursive, ignore_corrupt), schema)
            rows = good if rows is None else rows.unionByName(good)
            if wrong is not None:
                bad = wrong if bad is None else bad.unionByName(wrong)
        count, files = 0, []
        if rows is not None:
            seen = Observation(f"load_{batch_id}")
            if PARTITION_COL in rows.columns and _scattered(rows, size):
                rows = rows.hint("rebalance", PARTITION_COL)
            # observed above the exchange, which an empty batch would otherwise
            # remove together with its metrics
            rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set("__file").alias("files")).drop("__file")
            append_bronze(rows, target if table else unit.stage(target), table)
            count, files = seen.get["rows"], seen.get["files"]
        if bad is not None:
            bad.write.parquet(unit.stage(rejects))
        names = spark.createDataFrame([(f,) for f in files], "file string")
        names.coalesce(1).write.parquet(unit.stage(_files(checkpoint)))
        unit.commit(rows=count)
        prune(spark, ledger, "load-", batch_id)
        loaded += count

    q = found.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return loaded


def _scattered(rows: DataFrame, size: int) -> bool:
    """Whether rows from files of ``size`` bytes, written as they are read,
    would leave files of less than ``WHOLE_FILE`` bytes: each task writes one for
    every date it holds. Then they are rebalanced by date first (see
    :func:`.tables.backfill_bronze`); else that exchange of whole rows is
    spared. One pass over the date column counts tasks' dates."""
    if size < WHOLE_FILE:
        return True
    held = rows.select(F.spark_partition_id().alias("task"), PARTITION_COL).distinct().count()
    return size < held * WHOLE_FILE


def by_footer(spark: SparkSession, names: list[str], ignore_corrupt: bool = True) -> Iterator[tuple[list[str], StructType]]:
    """Groups of files whose columns have the same types, with their schema.
    The footers of a group are read and merged in one job; files that do not
    agree are halved. Files that cannot be read are left out."""
    if not names:
        return
    try:
        reader = spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", str(ignore_corrupt).lower())
        yield names, reader.option("recursiveFileLookup", "true").parquet(*names).schema
    except Exception as e:  # noqa: BLE001 - types that differ, or no readable footer
        if len(names) == 1:
            if ignore_corrupt and (isinstance(e, AnalysisException) or "FAILED_READ_FILE" in str(e) or "CANNOT_READ_FILE_FOOTER" in str(e)):
                return
            raise
        half = len(names) // 2
        yield from by_footer(spark, names[:half], ignore_corrupt)
        yield from by_footer(spark, names[half:], ignore_corrupt)


def _read_files(spark: SparkSession, names: list[str], own: StructType, source_dir: str, recursive: bool, ignore_corrupt: bool) -> DataFrame:
    reader = spark.read.option("ignoreCorruptFiles", str(ignore_corrupt).lower())
    if recursive:
        reader = reader.schema(own).option("recursiveFileLookup", "true")
    else:  # columns of partition folders count as columns of the file
        reader = reader.option("mergeSchema", "true").option("basePath", source_dir)
    return reader.parquet(*names).withColumn("__file", F.col("_metadata.file_path"))


def _castable(df: DataFrame, name: str, kind: DataType) -> Column:
    value = F.col(f"`{name}`")
    try:
        cast = value.try_cast(kind)
        df.select(cast)
        return cast
    except AnalysisException:
        text = F.to_json(value) if df.schema[name].dataType.typeName() in ("struct", "array", "map") else value.cast("string")
        return text.try_cast(kind)


def _conform(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame | None]:
    """``(rows in the declared schema with their __file, rejects)``; no rejects
    (None) if every column has its type."""
    have = {c.lower(): c for c in df.columns if c != "__file"}
    cols, casts = [], {}
    for f in schema.fields:
        own = have.get(f.name.lower())
        if own is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[own].dataType == f.dataType:
            cols.append(F.col(f"`{own}`").alias(f.name))
        else:
            casts[f.name] = (own, _castable(df, own, f.dataType))
            cols.append(casts[f.name][1].alias(f.name))
    if not casts:
        return df.select(*cols, "__file"), None
    failed = {n: F.col(f"`{own}`").isNotNull() & cast.isNull() for n, (own, cast) in casts.items()}
    any_failed = None
    for c in failed.values():
        any_failed = c if any_failed is None else any_failed | c
    text = lambda own: (F.to_json(F.col(f"`{own}`")) if df.schema[own].dataType.typeName() in ("struct", "array", "map")
                        else F.col(f"`{own}`").cast("string"))
    each = F.array(*[F.when(failed[n], F.struct(F.lit(n).alias("column"), text(own).alias("value"))) for n, (own, _) in casts.items()])
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "__file"]))
    bad = (df.filter(any_failed).select(F.col("__file").alias("file"), row.alias("row"), F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x"))
             .select("file", "x.column", "x.value", "row"))
    return df.filter(~any_failed).select(*cols, "__file"), bad


def read_rejects(spark: SparkSession, checkpoint: str, rejects: str | None = None) -> DataFrame:
    """``(file, column, value, row)`` of the values that kept rows from being
    loaded."""
    path = rejects or f"{checkpoint.rstrip('/')}_rejects"
    return spark.read.schema(REJECT).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], REJECT)


def _files(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}_files"


def skipped_files(spark: SparkSession, source_dir: str, checkpoint: str, *, glob: str = "*.parquet",
                  recursive: bool = False) -> DataFrame:
    """``(file)``: staged files that have given no rows: unreadable, empty, of
    rejected rows only, or not loaded yet."""
    staged = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", str(recursive).lower()).load(source_dir).select(F.col("path").alias("file")))
    if not path_exists(spark, _files(checkpoint)):
        return staged
    loaded = spark.read.schema("file string").parquet(_files(checkpoint)).select("file")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  both spellings of a local path
    return staged.join(loaded.select(plain(F.col("file")).alias("__f")), plain(F.col("file")) == F.col("__f"), "left_anti")


def follow_table(spark: SparkSession, path: str, schema: StructType, checkpoint: str,
                 handle: Callable[[DataFrame, int], None], *, max_files_per_trigger: int | None = None) -> int:
    """Hand every file of a parquet table that was not seen before to
    ``handle(rows, batch)``, whatever times its rows or the file itself carry:
    the table read as a change source. Files are told apart by name, so rows
    that arrive late are neither missed nor read twice. One batch holds all new
    files unless ``max_files_per_trigger`` is given. A batch whose handling
    failed, or was not recorded, is handed over again with the same number and
    files. Returns the number of batches."""
    reader = (spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("maxFileAge", MAX_FILE_AGE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    batches = 0

    def run(batch: DataFrame, batch_id: int) -> None:
        nonlocal batches
        handle(batch, batch_id)
        batches += 1

    q = (reader.parquet(path).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return batches


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Append the raw text of malformed messages with their source position
    (the second half of :func:`tidemark.functions.cdc.split_corrupt`)."""
    (bad.select(F.col(CORRUPT).alias("value"), "source_partition", "source_offset", F.current_timestamp().alias("quarantined_at"))
        .write.mode("append").parquet(path))


def write_dead_letter(messages: DataFrame, path: str, error: str, *,
                      kafka_servers: str | None = None, topic: str | None = None) -> None:
    """Append failed messages with the failure time and error text, to a
    parquet folder, or (``kafka_servers``) as JSON records to ``topic``."""
    dead = messages.select(
        F.col("topic"), F.col("value"), F.col("offset"), F.col("timestamp"),
        F.current_timestamp().alias("failed_at"),
        F.lit(error).alias("error_message"))
    if kafka_servers:
        (dead.select(F.to_json(F.struct(*[F.col(c) for c in dead.columns])).alias("value"))
             .write.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
             .option("topic", topic).save())
        return
    dead.write.mode("append").parquet(path)
