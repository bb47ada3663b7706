"""Small tables of hot keys, settled before the plan that uses them is built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import scratch_path

#: Broadcast up to this many rows (a few dozen bytes each); beyond it, adaptive
#: execution chooses the join and splits its skewed partitions.
BROADCAST_ROWS = 200_000


def settle(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` to the shared scratch folder; returns it read back and its
    row count (from the file footers). Later uses neither compute it again nor
    plan its lineage, and a caller can leave out what an empty table makes
    needless."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    return out, out.count()


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` allow it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
