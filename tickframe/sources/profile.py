"""cat.profile and src.profile: data profiling jobs over the tables themselves."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _hashable(df: DataFrame, c: str):
    """A column as something a distinct-count sketch takes."""
    return F.xxhash64(F.col(f"`{c}`")) if df.schema[c].dataType.typeName() not in ("long", "string") else F.col(f"`{c}`")


def profile_tables(tables: Mapping[str, DataFrame], approx_distinct: bool = True) -> DataFrame:
    """cat.profile: one row per (table, column): position, rows, the table's
    column count, NULL count, approximate distinct count (HyperLogLog,
    bounded memory), plus the table's size in GB (10⁹ bytes, 2 d.p.) and last
    modification time from file metadata.

    One scan and one aggregate per table gives all of it: rows are counted per
    file first (a partial aggregate per task), files are summed up then."""
    out = None
    for name, df in tables.items():
        cols, m = df.columns, F.col("_metadata")
        per_file = [F.count(F.lit(1)).alias("__rows"), F.max(m["file_size"]).alias("__size"), F.max(m["file_modification_time"]).alias("__time")]
        whole = [F.sum("__rows").alias("__rows"), F.round(F.sum("__size") / F.pow(F.lit(10), F.lit(9)), 2).alias("__gb"), F.max("__time").alias("__time")]
        for i, c in enumerate(cols):
            per_file.append(F.count(F.col(f"`{c}`")).alias(f"__v{i}"))
            whole.append((F.sum("__rows") - F.sum(f"__v{i}")).alias(f"__n{i}"))
            if approx_distinct:
                per_file.append(F.hll_sketch_agg(_hashable(df, c)).alias(f"__h{i}"))
                whole.append(F.hll_sketch_estimate(F.hll_union_agg(f"__h{i}")).alias(f"__d{i}"))
        one = df.groupBy(m["file_path"].alias("__file")).agg(*per_file).agg(*whole)
        stack = ", ".join(f"'{c}', {i + 1}, `__n{i}`, " + (f"`__d{i}`" if approx_distinct else "CAST(NULL AS BIGINT)") for i, c in enumerate(cols))
        long = one.selectExpr(f"'{name}' AS table_name", "`__rows` AS n_rows", f"{len(cols)} AS n_columns",
                              f"stack({len(cols)}, {stack}) AS (column_name, position, n_nulls, approx_distinct)",
                              "`__gb` AS size_gb", "`__time` AS last_modified")
        out = long if out is None else out.unionByName(long)
    # largest tables first, as the source listing orders them
    return out.orderBy(F.col("size_gb").desc(), "table_name", "position")


def shape(df: DataFrame, key: str, unique: str) -> DataFrame:
    """src.profile: shape, number of unique values, first and last key
    (``head``/``tail`` by key order) in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"),
                  F.countDistinct(unique).alias("n_unique"), F.min(key).alias("head_key"),
                  F.max(key).alias("tail_key"))
