"""File loads beside other writers, and incremental marks across zones."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from tidemark.operators.asof import as_of_join
from tidemark.operators.latest import new_rows
from tidemark.schemas import BRONZE_SCHEMAS
from tidemark.sources.files import load_new_files, skipped_files
from tidemark.sources.tables import append_bronze

SCHEMA = BRONZE_SCHEMAS["accounts"]


def _rows(spark, ids):
    have = {"account_id": F.col("id").cast("int"), "cdc_op": F.lit("c"), "ingested_at": F.timestamp_seconds(F.lit(1_700_000_000)),
            "ingestion_date": F.lit("2023-11-14").cast("date")}
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    return df.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMA.fields])


def test_load_and_append_share_a_table_whatever_a_files_age(spark, scratch):
    stage, bronze, ck = f"{scratch}/stage", f"{scratch}/bronze", f"{scratch}/ckpt"
    append_bronze(_rows(spark, range(5)), bronze)
    _rows(spark, range(5, 12)).coalesce(1).write.parquet(f"{stage}/a")
    assert load_new_files(spark, stage, SCHEMA, bronze, ck, recursive=True) == 7
    _rows(spark, range(12, 15)).coalesce(1).write.parquet(f"{stage}/b")
    old = time.time() - 20 * 86400
    for f in os.listdir(f"{stage}/b".removeprefix("file:")):
        os.utime(os.path.join(f"{stage}/b", f), (old, old))
    with open(f"{stage}/a/broken.parquet", "w") as f:
        f.write("no parquet")
    assert load_new_files(spark, stage, SCHEMA, bronze, ck, recursive=True, max_files_per_trigger=1) == 3
    assert load_new_files(spark, stage, SCHEMA, bronze, ck, recursive=True) == 0
    append_bronze(_rows(spark, range(15, 18)), bronze)
    got = spark.read.schema(SCHEMA).parquet(bronze)
    assert sorted(r[0] for r in got.select("account_id").collect()) == list(range(18))
    assert [os.path.basename(r[0]) for r in skipped_files(spark, stage, ck, recursive=True).collect()] == ["broken.parquet"]


def test_a_mark_in_microseconds_means_the_same_in_every_zone(spark):
    df = spark.range(4).select("id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600).alias("ingested_at"),
                               F.lit("2023-11-14").cast("date").alias("ingestion_date"))
    mark = (1_700_000_000 + 2 * 3600) * 10**6
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert sorted(r.id for r in new_rows(df, df, mark=mark)[0].select("id").collect()) == [2, 3]
            late, _ = new_rows(df, df, mark=mark, lookback=dt.timedelta(hours=1))
            assert sorted(r.id for r in late.select("id").collect()) == [1, 2, 3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rows_without_a_key_are_spread(spark):
    left = spark.range(2000).selectExpr("CAST(NULL AS INT) AS k", "id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS at")
    versions = spark.createDataFrame([(1,)], "k int").selectExpr(
        "k", "TIMESTAMP_NTZ'2023-01-01 00:00:00' AS valid_from", "CAST(NULL AS TIMESTAMP_NTZ) AS valid_to")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        j = as_of_join(left, versions, "k", "k", "at")
        sizes = [r[0] for r in j.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 2000 and max(sizes) < 600
    assert j.filter("v IS NOT NULL").count() == 0
