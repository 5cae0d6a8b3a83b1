"""Sinks: tables, day partitions with retention, CTAS, appends, small CSV exports."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str) -> None:
    """sink.table: replace a whole table."""
    df.write.mode("overwrite").parquet(path)


def write_partition(df: DataFrame, path: str, date_col: str = "record_ingestion_date",
                    cluster_by: Sequence[str] = ("Name",), spread: int = 1) -> None:
    """sink.partition: overwrite only the day partitions present in ``df``
    (dynamic overwrite; the session default is STATIC, which would wipe
    the other days), rows clustered by ``cluster_by`` inside each file so
    Parquet min/max statistics skip row groups on symbol filters.

    Rows are hash-partitioned on (date, cluster key) before the write, so
    each task writes a few large files instead of every task writing a small
    file into every day.  ``spread`` > 1 adds a salt so one hot (day, key)
    is written by ``spread`` tasks instead of one (use it for row-level
    tables; one bar per symbol and day needs none)."""
    keys = [F.col(date_col), *[F.col(c) for c in cluster_by]]
    if spread > 1:
        keys.append(F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread)))
    out = df.repartition(*keys).sortWithinPartitions(date_col, *cluster_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col).parquet(path))


def list_partitions(spark: SparkSession, path: str, date_col: str = "record_ingestion_date") -> list[str]:
    """Partition values of a day-partitioned table, from the directory listing."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = re.fullmatch(rf"{re.escape(date_col)}=(.+)", st.getPath().getName())
        if st.isDirectory() and m:
            out.append(m.group(1))
    return sorted(out)


def expire_partitions(spark: SparkSession, path: str, as_of, days: int,
                      date_col: str = "record_ingestion_date") -> list[str]:
    """sink.retention: delete day partitions older than ``days`` days before
    ``as_of`` (partition expiry: 180 days for prices, 60 for the sample).
    Works on the directory listing only; no data is read."""
    as_of = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    cutoff = as_of - dt.timedelta(days=days)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = []
    for v in list_partitions(spark, path, date_col):
        if dt.date.fromisoformat(v) < cutoff:
            p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{date_col}={v}")
            p.getFileSystem(conf).delete(p, True)
            dropped.append(v)
    return dropped


def _replace(spark: SparkSession, name: str, fresh: str) -> None:
    """Let ``name`` be the finished table ``fresh``: the old one steps aside under another name, comes
    back if the second rename fails, and goes only when the new one is in its place."""
    old = f"{name}_{uuid.uuid4().hex[:8]}_old"
    had = spark.catalog.tableExists(name)
    if had:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    if had:
        spark.sql(f"DROP TABLE {old}")


def ctas(spark: SparkSession, name: str, select_sql: str, location: str, partition_by: Sequence[str] = (),
         comment: str | None = None) -> DataFrame:
    """sink.ctas: create-or-replace a (partitioned) table from a query, stored
    at ``location`` on shared storage.  The new table is complete before the
    old one steps aside, so whatever fails leaves the old one or the new one."""
    fresh = f"{name}_{uuid.uuid4().hex[:8]}"
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    cmt = f"COMMENT '{comment}'" if comment else ""
    spark.sql(f"CREATE TABLE {fresh} USING parquet {parts} {cmt} LOCATION '{location.rstrip('/')}/{fresh}' AS {select_sql}")
    _replace(spark, name, fresh)
    return spark.table(name)


def append_rows(df: DataFrame, path: str) -> None:
    """sink.append_rows: append; any failure raises (the job fails rather than
    skipping rows)."""
    df.write.mode("append").parquet(path)


def write_csv_single(df: DataFrame, path: str) -> None:
    """sink.csv_single: one CSV file with a header.  One writer task: meant
    for small exports (reports, aggregates), never for fact tables."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, location: str) -> DataFrame:
    """A table hash-bucketed (and sorted) on ``key`` into ``buckets`` buckets,
    stored at ``location`` on shared storage.  Two tables bucketed on their
    join keys with the same bucket count join without shuffling either side,
    so a fact joined repeatedly pays its shuffle once, at write time."""
    spark, fresh = df.sparkSession, f"{name}_{uuid.uuid4().hex[:8]}"
    (df.write.bucketBy(buckets, key).sortBy(key)
       .option("path", f"{location.rstrip('/')}/{fresh}").saveAsTable(fresh))
    _replace(spark, name, fresh)
    return spark.table(name)
