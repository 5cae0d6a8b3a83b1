"""Shared helpers: scratch tables, column checks, safe temporary names."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.session import scratch_path


def write_scratch(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` under the folder named by ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: a lost executor costs the readers nothing but a
    re-read.  Every call takes a folder of its own.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop_scratch(*tables: DataFrame) -> None:
    """Delete tables of write_scratch.  Only for tables whose readers have all
    been written to tables themselves: nothing will be computed from them again."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tidy() -> None:
    """Give memory that is free in this Python worker back to the system: workers stay for later stages."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return next(n for k in range(len(taken) + 1) if (n := f"__{name}{k or ''}").lower() not in taken)


def least_hashed(ids: DataFrame, group: str, count: int) -> DataFrame:
    """The ``count`` rows of each group with the least hash ``h`` (ties by ``id``).

    The hashes are counted in 4,096 cells; whole cells below the limit are kept,
    and only rows of the cell in which it lies are ranked.  The limits, a row
    per group, are broadcast: groups are the classes of a model, few by nature.
    """
    cell, before = "__cell", "__before"
    ids = ids.withColumn(cell, F.shiftright("h", 52))
    sizes = ids.groupBy(group, cell).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(group).orderBy(cell)
    sizes = sizes.withColumn(before, F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    limits = sizes.filter(F.col(before) < count).groupBy(group).agg(F.max(cell).alias("__last"), F.max(before).alias(before))
    kept = ids.join(F.broadcast(limits), group).filter(F.col(cell) <= F.col("__last"))
    kept = kept.withColumn("__k", F.row_number().over(Window.partitionBy(group, cell).orderBy("h", "id")))
    return kept.filter((F.col(cell) < F.col("__last")) | (F.col("__k") <= count - F.col(before))).drop(cell, before, "__last", "__k")


def task_count(spark: SparkSession) -> int:
    """Partitions for a shuffle: what the session asks for, at least one per core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def vocabulary(name: str) -> str:
    """Place of a vocabulary file where this runs: a path is itself, a bare name is looked up among the public tokenizers."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
