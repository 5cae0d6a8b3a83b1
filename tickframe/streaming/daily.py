"""The daily price increment as a Structured Streaming job.

New raw files land in a folder; ``readStream`` picks them up and
``foreachBatch`` merges each batch into the stored table with
``increment_prices``.  With ``trigger(availableNow=True)`` the job processes
everything that has arrived and stops, so it can run on a schedule; the
checkpoint (on shared storage) records which files were done.  No custom
state store is needed: the state is the stored table itself.

The table is partitioned by the month of each row's own day.  Beside it lies a
*tail index*: for each symbol and month the first and last day and the last
close, one row where the table has a month of rows.  A batch reads

* the months its own rows lie in,
* the month of the next stored row of each symbol after them (that row's change
  alters with its predecessor), found in the index, and
* from all other months the tails only, for the predecessors of first rows.

It puts its rows in place of those with the same (Name, Date), computes the
changes of the new rows and of the one row after each, and overwrites the
months it read.  All other stored rows keep what they have, however late a
file is.  So several files of one day, late files and a batch that is replayed
after a crash all end in the table that one batch run over all files would
give.  The index follows the table; if a crash falls between the two, the
replayed batch writes both again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickframe.operators import timeseries as ts
from tickframe.operators import windows
from tickframe.operators.relational import null_safe_join
from tickframe.sources import sinks

MONTH = "market_month"


CHANGES = ("prev_close", "change", "change_in_percent")


def with_month(prices: DataFrame) -> DataFrame:
    return prices.withColumn(MONTH, F.trunc("Date", "MM"))


def tails_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}_tails"


def write_tails(spark: SparkSession, table_path: str, months: list | None = None) -> None:
    """Bring the tail index of some months (of all by default) up to the stored table."""
    stored = spark.read.parquet(table_path)
    if months is not None:
        stored = stored.filter(F.col(MONTH).isin(months))
    tails = stored.groupBy(MONTH, "Name").agg(F.min("Date").alias("first_date"), F.max("Date").alias("last_date"),
                                              F.max_by("Close", "Date").alias("last_close"))
    sinks.write_partition(tails, tails_path(table_path), date_col=MONTH)


def read_tails(spark: SparkSession, table_path: str) -> DataFrame:
    """The tail index, built first where a table has none."""
    if not sinks.list_partitions(spark, tails_path(table_path), MONTH):
        write_tails(spark, table_path)
    return spark.read.parquet(tails_path(table_path))


def store_prices(prices: DataFrame, table_path: str) -> None:
    """Write whole months of prices and their tails."""
    sinks.write_partition(with_month(prices), table_path, date_col=MONTH)
    write_tails(prices.sparkSession, table_path)


def touched_months(new: DataFrame, tails: DataFrame) -> list:
    """Months that hold new rows or the next stored row of a symbol after new rows.

    A list on the driver; the calendar bounds it."""
    own = with_month(new).groupBy("Name", MONTH).agg(F.max("Date").alias("new_last"))
    stored = tails.select("Name", MONTH, F.col(MONTH).alias("stored"), "last_date", F.lit(None).cast("date").alias("new_last"))
    both = stored.unionByName(own.withColumns({"stored": F.lit(None).cast("date"), "last_date": F.lit(None).cast("date")}))
    both = both.groupBy("Name", MONTH).agg(F.max("stored").alias("stored"), F.max("last_date").alias("last_date"), F.max("new_last").alias("new_last"))
    after = Window.partitionBy("Name").orderBy(MONTH).rowsBetween(1, Window.unboundedFollowing)
    both = both.withColumn("next", F.min("stored").over(after)).filter("new_last IS NOT NULL")
    # a later stored row in the same month is the next one
    beyond = F.when(F.col("last_date") > F.col("new_last"), None).otherwise(F.col("next"))
    months = both.select(F.explode(F.array(F.col(MONTH), beyond)).alias("m")).filter("m IS NOT NULL").distinct()
    return sorted(r.m for r in months.collect())


def merged_months(new: DataFrame, stored: DataFrame, tails: DataFrame, months: list) -> DataFrame:
    """The rows of ``months`` after the cleaned rows ``new`` are merged in."""
    kind, old = "__kind", "__old"  # 0: the tail of a month that is not read, 1: stored, 2: new
    nothing = F.lit(None).cast("struct<" + ",".join(f"{c}:double" for c in CHANGES) + ">")
    fresh = new.withColumns({kind: F.lit(2), old: nothing})
    here = stored.filter(F.col(MONTH).isin(months)).select(*ts.PRICE_COLS, F.lit(1).alias(kind), F.struct(*CHANGES).alias(old))
    here = null_safe_join(here, new.select("Name", "Date"), ["Name", "Date"], "left_anti")
    carried = tails.filter(~F.col(MONTH).isin(months) & (F.col(MONTH) < F.lit(months[-1]))).select(
        "Name", F.col("last_date").alias("Date"), F.col("last_close").alias("Close"), F.lit(0).alias(kind))
    rows = fresh.unionByName(here).unionByName(carried, allowMissingColumns=True)
    rows = windows.lag_change(rows.withColumn("__after", F.lag(kind).over(Window.partitionBy("Name").orderBy("Date"))))
    # only a new row, or the row after one, has another change than before
    keep = (F.col(kind) == 1) & (F.coalesce("__after", F.lit(0)) != 2)
    rows = rows.filter(F.col(kind) > 0).select(*ts.PRICE_COLS, *[F.when(keep, F.col(old)[c]).otherwise(F.col(c)).alias(c) for c in CHANGES])
    return with_month(rows)


def merge_prices(batch: DataFrame, table_path: str, run_date, staged: str) -> None:
    """Merge raw rows into the stored table; doing it again changes nothing."""
    spark = batch.sparkSession
    if not sinks.list_partitions(spark, table_path, MONTH):
        store_prices(ts.build_prices(batch, run_date), table_path)
        return
    new = ts.clean_prices(batch, run_date)
    new.write.mode("overwrite").parquet(f"{staged}/new")
    new = spark.read.schema(new.schema).parquet(f"{staged}/new")
    tails = read_tails(spark, table_path)
    months = touched_months(new, tails)
    if not months:
        return
    rows = merged_months(new, spark.read.parquet(table_path), tails, months)
    # materialise before writing into the table that was read
    rows.write.mode("overwrite").parquet(f"{staged}/rows")
    sinks.write_partition(spark.read.parquet(f"{staged}/rows"), table_path, date_col=MONTH)
    write_tails(spark, table_path, months)


def run_daily_stream(spark: SparkSession, source_dir: str, table_path: str, checkpoint: str,
                     raw_schema: StructType | str, files_per_batch: int = 1,
                     date_col: str = "Date", keep_days: int | None = None) -> None:
    """Merge every raw file in ``source_dir`` not yet in ``checkpoint`` into ``table_path``.

    Each micro-batch is stamped with its own last market day as the run date;
    with ``keep_days``, months that began longer before it are dropped."""
    stream = (spark.readStream.schema(raw_schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(source_dir))

    def apply(batch: DataFrame, epoch_id: int) -> None:
        run_date = batch.select(F.max(date_col)).first()[0]  # one scalar per micro-batch
        if run_date is None:
            return
        merge_prices(batch, table_path, run_date, f"{checkpoint.rstrip('/')}/staged/epoch={epoch_id}")
        if keep_days is not None:
            for path in (table_path, tails_path(table_path)):
                sinks.expire_partitions(spark, path, run_date, keep_days, date_col=MONTH)

    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
