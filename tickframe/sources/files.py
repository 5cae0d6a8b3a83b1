"""File sources: CSV, JSON, whole-text files, sharded tables, per-symbol files.

All reads are one distributed scan; none loops over files on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """src.csv: CSV with a header row and a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def load_csv_append(spark: SparkSession, csv_path: str, table_path: str) -> DataFrame:
    """src.csv_load: autodetect the schema of a CSV load and append it to a
    Parquet table (inference costs an extra pass; use for ad-hoc loads)."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(csv_path)
    df.write.mode("append").parquet(table_path)
    return spark.read.parquet(table_path)


def read_json_infer(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """src.json_infer: JSON lines with an inferred schema."""
    return spark.read.option("samplingRatio", sampling_ratio).json(path)


# ISO-8601 with microseconds, for timestamps in JSON text
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"


def parse_json(df: DataFrame, col: str, schema: StructType | str, alias: str = "j") -> DataFrame:
    """src.json_schema: parse a JSON string column with a declared schema;
    ISO strings become timestamps (microseconds kept)."""
    opts = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_FORMAT}
    return df.withColumn(alias, F.from_json(F.col(col), schema, opts))


def read_text_files(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """src.text_files: every matching file under ``path`` as one row
    (``value`` = whole text, ``file`` = its path)."""
    # the options go through text()'s own arguments: its defaults would override .option()
    return (spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
            .select(F.col("_metadata.file_path").alias("file"), "value"))


def read_sharded(spark: SparkSession, glob: str, suffix_regex: str, schema: StructType | None = None) -> DataFrame:
    """src.wildcard: union of date-sharded tables matched by a path glob; the
    shard suffix (the ``_TABLE_SUFFIX`` of the source dialect) is taken from
    the file path, so filters on it can be written as plain predicates."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(glob)
    return df.withColumn("_table_suffix", F.regexp_extract(F.col("_metadata.file_path"), suffix_regex, 1))


def symbol_list(spark: SparkSession, text: str) -> DataFrame:
    """The comma-separated symbol list of the job config: split, trimmed,
    blanks dropped, de-duplicated (the source job sorts but keeps repeats)."""
    one = spark.range(1).select(F.explode(F.split(F.lit(text), ",")).alias("Name"))
    return one.select(F.trim("Name").alias("Name")).filter(F.col("Name") != "").distinct()


def read_symbols(spark: SparkSession, root: str, symbols: DataFrame, key: str = "Name") -> DataFrame:
    """src.per_symbol, re-aimed: one parallel read of a table partitioned by
    symbol, restricted to the listed symbols by a semi join (dynamic
    partition pruning skips the other symbols' files).  Listed symbols with
    no files are simply absent, as failed downloads are skipped upstream."""
    df = spark.read.option("ignoreMissingFiles", True).parquet(root)
    return df.join(symbols, key, "left_semi")  # adaptive execution broadcasts a short list
