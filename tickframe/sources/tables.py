"""src.table / src.query / src.view: named tables and SQL text over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """src.table: one Parquet table read lazily (pushdown and pruning apply)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def query(spark: SparkSession, sf_dir: str, sql: str, names=TABLES) -> DataFrame:
    """src.query: the result of a SQL text over the named tables."""
    register_views(spark, sf_dir, names)
    return spark.sql(sql)


def read_view(spark: SparkSession, sf_dir: str, obj: str, is_query: bool = False) -> DataFrame:
    """src.view: a table name or a SQL text, read lazily.  A caller that reads
    it often persists and unpersists it around its own work."""
    return query(spark, sf_dir, obj) if is_query else table(spark, sf_dir, obj)
