"""§2.1 scans, sources, sinks and catalog.

Sources that need files of another format (CSV, JSON, text, shards, per-symbol
files) first write them from the test tables into the shared scratch folder
(``spark.checkpoint.dir``), then read them back the way a job would.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from tickframe.functions.money import D, DSUM, DAVG, NET, dsum, davg, net
from tickframe.operators import timeseries as ts
from tickframe.plans.prices import CUT_DATE, INGEST_DATE, SQL_PRICES, prices, raw_feed
from tickframe.plans.registry import register
from tickframe.session import scratch_path
from tickframe.sources import files, profile, sinks, snapshots
from tickframe.sources.tables import TABLES, query, read_view, table

T = table
PRICES_WITH = "WITH " + SQL_PRICES % {"ingest": INGEST_DATE}


def scratch(spark, name):
    return scratch_path(spark, f"io/{name}-{uuid.uuid4().hex[:10]}")


ORDERS_SCHEMA = T_.StructType([
    T_.StructField("o_orderkey", T_.LongType()), T_.StructField("o_custkey", T_.LongType()),
    T_.StructField("o_orderstatus", T_.StringType()), T_.StructField("o_totalprice", T_.DoubleType()),
    T_.StructField("o_orderdate", T_.TimestampNTZType()), T_.StructField("o_orderpriority", T_.StringType())])

SQL_ORDERS_BY_STATUS = f"""
SELECT o_orderstatus, count(*) AS n, {DSUM(D('o_totalprice'))} AS total FROM orders GROUP BY 1"""


def _by_status(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), dsum("o_totalprice").alias("total"))


@register("src.table", "SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem")
def src_table(spark, d):
    return T(spark, d, "lineitem")


SQL_SRC_QUERY = """
SELECT n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_acctbal > 0 GROUP BY n_name"""


@register("src.query", SQL_SRC_QUERY)
def src_query(spark, d):
    return query(spark, d, SQL_SRC_QUERY, ("customer", "nation"))


@register("src.view", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def src_view(spark, d):
    return read_view(spark, d, "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1", is_query=True)


@register("src.as_of", """
SELECT user_id, event_id, ts, event_type, value FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def src_as_of(spark, d):
    e = T(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return snapshots.as_of(e, ["user_id"], "ts", "2024-01-20 00:00:00", tie=["event_id"])


@register("src.as_of.newest", """
SELECT event_id, ts, user_id FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 10 MINUTE
ORDER BY ts DESC, event_id DESC LIMIT 100""")
def src_as_of_newest(spark, d):
    e = T(spark, d, "events").select("event_id", "ts", "user_id")
    return snapshots.newest(e, "ts", "2024-01-20 00:00:00", 10, 100, tie=["event_id"])


@register("src.wildcard", """
SELECT strftime(CAST(ts AS DATE), '%Y%m%d') AS _table_suffix, count(*) AS n, {avg} AS avg_value FROM events
WHERE strftime(CAST(ts AS DATE), '%Y%m%d') BETWEEN '20240110' AND '20240119' GROUP BY 1""".format(avg=DAVG(D('value'))))
def src_wildcard(spark, d):
    base = scratch(spark, "shards")
    e = T(spark, d, "events").withColumn("shard", F.date_format("ts", "yyyyMMdd"))
    e.write.partitionBy("shard").parquet(base)
    # the glob selects the shards of 2024-01-1x; the suffix comes from the path
    s = files.read_sharded(spark, f"{base}/shard=2024011*", r"shard=(\d{8})")
    s = s.filter(F.col("_table_suffix").between("20240110", "20240119"))
    return s.groupBy("_table_suffix").agg(F.count(F.lit(1)).alias("n"), davg("value").alias("avg_value"))


@register("src.csv", SQL_ORDERS_BY_STATUS)
def src_csv(spark, d):
    path = scratch(spark, "orders_csv")
    T(spark, d, "orders").write.option("header", True).csv(path)
    return _by_status(files.read_csv(spark, path, ORDERS_SCHEMA))


@register("src.csv_load", SQL_ORDERS_BY_STATUS)
def src_csv_load(spark, d):
    csv1, csv2, tbl = scratch(spark, "load1"), scratch(spark, "load2"), scratch(spark, "loaded")
    o = T(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    o.filter(F.year("o_orderdate") < 1998).write.option("header", True).csv(csv1)
    o.filter(F.year("o_orderdate") >= 1998).write.option("header", True).csv(csv2)
    files.load_csv_append(spark, csv1, tbl)
    return _by_status(files.load_csv_append(spark, csv2, tbl))


@register("src.json_infer", f"""
SELECT event_type, count(*) AS n, {DSUM(D('value'))} AS total_value,
       CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k FROM events GROUP BY 1""")
def src_json_infer(spark, d):
    path = scratch(spark, "events_json")
    T(spark, d, "events").select("event_id", "event_type", "value", "props").write.json(path)
    e = files.read_json_infer(spark, path)  # event_id: bigint, value: double, props: string
    props = scratch(spark, "props_json")
    e.select("props").write.text(props)
    inner = files.read_json_infer(spark, props).schema  # the embedded documents: {"k": n} → k: bigint
    parsed = e.withColumn("p", F.from_json("props", inner))
    return parsed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), dsum("value").alias("total_value"),
                                            F.sum("p.k").cast("long").alias("sum_k"))


@register("src.json_schema", """
SELECT event_type AS action, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1""")
def src_json_schema(spark, d):
    raw = T(spark, d, "events").select(
        F.to_json(F.struct(F.col("event_type").alias("action"), F.col("ts").alias("timestamp")),
                  {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("json"))
    schema = T_.StructType([T_.StructField("action", T_.StringType()),
                            T_.StructField("timestamp", T_.TimestampNTZType())])
    p = files.parse_json(raw, "json", schema)
    return p.groupBy(F.col("j.action").alias("action")).agg(
        F.count(F.lit(1)).alias("n"), F.min("j.timestamp").alias("first_ts"), F.max("j.timestamp").alias("last_ts"))


@register("src.text_files", """
SELECT source, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes, count(*) AS n_docs FROM documents GROUP BY 1""")
def src_text_files(spark, d):
    path = scratch(spark, "docs_txt")
    # a file is read back as one row, so its size is bounded
    T(spark, d, "documents").select("source", "text").write.option("maxRecordsPerFile", 1000).partitionBy("source").text(path)
    t = files.read_text_files(spark, path, "*.txt")
    t = t.withColumn("source", F.regexp_extract("file", r"source=([^/]+)/", 1))
    # whole files, read back byte for byte: each document plus the writer's newline
    docs = T(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    per = t.groupBy("source").agg(F.sum(F.octet_length("value")).cast("long").alias("n_bytes"))
    return per.join(docs, "source")


# Fixed value: the job's symbol list, with repeats and blanks as in its config.
SYMBOL_TEXT = "O, F,P ,O, X, F"


@register("src.per_symbol", PRICES_WITH + """
SELECT Name, count(*) AS n_days, CAST(sum(CAST(Close AS DECIMAL(18,2))) AS DOUBLE) AS sum_close FROM prices
WHERE Name IN ('O', 'F', 'P', 'X') GROUP BY Name""")
def src_per_symbol(spark, d):
    root = scratch(spark, "per_symbol")
    prices(spark, d).write.partitionBy("Name").parquet(root)
    got = files.read_symbols(spark, root, files.symbol_list(spark, SYMBOL_TEXT))
    return got.groupBy("Name").agg(F.count(F.lit(1)).alias("n_days"), dsum("Close").alias("sum_close"))


@register("src.rows", """
WITH labels(code, label) AS (VALUES ('O', 'open'), ('F', 'filled'), ('P', 'partial'))
SELECT label, count(*) AS n FROM orders JOIN labels ON o_orderstatus = code GROUP BY label""")
def src_rows(spark, d):
    labels = spark.createDataFrame([("O", "open"), ("F", "filled"), ("P", "partial")], "code string, label string")
    o = T(spark, d, "orders")
    return o.join(F.broadcast(labels), o.o_orderstatus == labels.code).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@register("src.pandas", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2""")
def src_pandas(spark, d):
    small = T(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    pdf = small.toPandas()  # bounded: statuses × priorities
    return spark.createDataFrame(pdf, schema=small.schema)


@register("sink.table", PRICES_WITH + """
SELECT * REPLACE (CAST(Date AS VARCHAR) AS Date, CAST(record_ingestion_date AS VARCHAR) AS record_ingestion_date)
FROM prices""")
def sink_table(spark, d):
    path = scratch(spark, "prices_table")
    sinks.write_table(prices(spark, d), path)
    return spark.read.parquet(path)


@register("sink.partition", PRICES_WITH + f"""
SELECT '{INGEST_DATE}' AS record_ingestion_date, count(*) AS n FROM prices WHERE Date >= DATE '{CUT_DATE}'
UNION ALL SELECT '2000-12-31', count(*) FROM prices WHERE Date < DATE '{CUT_DATE}'""")
def sink_partition(spark, d):
    path = scratch(spark, "prices_by_day")
    raw = raw_feed(spark, d)
    history = ts.build_prices(raw.filter(F.col("Date") < F.lit(CUT_DATE).cast("date")), "2000-12-31")
    sinks.write_partition(history, path)
    stored = spark.read.parquet(path)
    new_day = raw.filter(F.col("Date") >= F.lit(CUT_DATE).cast("date"))
    for _ in range(2):  # a rerun of the same day computes it again and replaces only that day's partition
        inc = ts.increment_prices(new_day, stored, INGEST_DATE)
        # materialise to shared storage before writing into the table it was read from
        inc_path = scratch(spark, "increment")
        inc.write.parquet(inc_path)
        sinks.write_partition(spark.read.parquet(inc_path), path)
        stored = spark.read.parquet(path)
    out = spark.read.parquet(path)
    return out.groupBy(F.col("record_ingestion_date").cast("string").alias("record_ingestion_date")).agg(
        F.count(F.lit(1)).alias("n"))


@register("sink.retention", PRICES_WITH + """
SELECT record_ingestion_date, count(*) AS n FROM (
  SELECT CASE WHEN Date < DATE '2001-06-16' THEN '2001-06-15' ELSE '2001-08-01' END AS record_ingestion_date
  FROM prices WHERE Date >= DATE '2001-01-16') GROUP BY 1""")
def sink_retention(spark, d):
    path = scratch(spark, "retention")
    p = prices(spark, d).drop("record_ingestion_date")
    day = F.to_date(F.lit("2001-01-15"))
    stamped = p.withColumn("record_ingestion_date",
                           F.when(F.col("Date") < F.lit("2001-01-16").cast("date"), day)
                            .when(F.col("Date") < F.lit("2001-06-16").cast("date"), F.to_date(F.lit("2001-06-15")))
                            .otherwise(F.to_date(F.lit("2001-08-01"))))
    sinks.write_partition(stamped, path)
    sinks.expire_partitions(spark, path, "2001-08-02", 60)
    out = spark.read.parquet(path)
    return out.groupBy(F.col("record_ingestion_date").cast("string").alias("record_ingestion_date")).agg(
        F.count(F.lit(1)).alias("n"))


@register("sink.ctas", f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, {DAVG(D('value'))} AS avg_value
FROM events WHERE value < 400 GROUP BY 1, 2""")
def sink_ctas(spark, d):
    T(spark, d, "events").createOrReplaceTempView("events_src")
    name = f"daily_events_{uuid.uuid4().hex[:8]}"
    sql = (f"SELECT CAST(to_date(ts) AS STRING) AS day, event_type, count(*) AS n, "
           f"CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS avg_value "
           f"FROM events_src WHERE value < 400 GROUP BY 1, 2")
    t = sinks.ctas(spark, name, sql, scratch(spark, name), partition_by=["event_type"],
                   comment="daily events, partitioned by type")
    return t.select("day", "event_type", "n", "avg_value")


@register("sink.append_rows", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def sink_append_rows(spark, d):
    path = scratch(spark, "appended")
    docs = T(spark, d, "documents").select("doc_id", "lang")
    sinks.append_rows(docs.filter(F.col("doc_id") % 2 == 0), path)
    sinks.append_rows(docs.filter(F.col("doc_id") % 2 == 1), path)
    return spark.read.parquet(path).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@register("sink.csv_single", "SELECT CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows FROM (SELECT DISTINCT o_orderpriority, "
                             "o_orderstatus FROM orders)")
def sink_csv_single(spark, d):
    path = scratch(spark, "report_csv")
    rep = T(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    sinks.write_csv_single(rep, path)
    back = spark.read.option("header", True).csv(path)
    return back.agg(F.countDistinct(F.col("_metadata.file_path")).alias("n_files"), F.count(F.lit(1)).alias("n_rows"))


# The column lists of the test tables, in table order.
TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _profile_sql():
    parts = []
    for t, cols in TABLE_COLUMNS.items():
        for i, c in enumerate(cols):
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({i + 1} AS BIGINT) AS position, "
                         f"CAST({len(cols)} AS BIGINT) AS n_columns, "
                         f"count(*) AS n_rows, CAST(count(*) - count({c}) AS BIGINT) AS n_nulls, true AS distinct_in_range, "
                         f"true AS has_size, true AS has_time FROM {t}")
    return "\nUNION ALL ".join(parts)


@register("cat.profile", _profile_sql())
def cat_profile(spark, d):
    prof = profile.profile_tables({t: T(spark, d, t) for t in TABLES})
    # bounds that hold for any column; the sketch's error is measured in the tests
    some = F.col("n_rows") - F.col("n_nulls")
    near = F.col("approx_distinct").between(F.least(some, F.lit(1)), F.ceil(some * 1.1) + 1)
    return prof.select("table_name", "column_name", "position", "n_columns", "n_rows", "n_nulls", near.alias("distinct_in_range"),
                       (F.col("size_gb") >= 0).alias("has_size"), F.col("last_modified").isNotNull().alias("has_time"))


@register("src.profile", """
SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_cols, count(DISTINCT o_orderstatus) AS n_unique, min(o_orderkey) AS head_key,
       max(o_orderkey) AS tail_key FROM orders""")
def src_profile(spark, d):
    return profile.shape(T(spark, d, "orders"), "o_orderkey", "o_orderstatus")


@register("join.inner_equi.bucketed", f"""
SELECT o_orderpriority, count(*) AS n, {DSUM(NET)} AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def join_inner_equi_bucketed(spark, d):
    """The fact-to-fact join on co-located tables: both sides bucketed on the
    order key with the same bucket count, so the join reads bucket i of one
    table next to bucket i of the other with no exchange."""
    tag = uuid.uuid4().hex[:8]
    li = sinks.write_bucketed(T(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount"),
                              f"lineitem_b_{tag}", "l_orderkey", 16, scratch(spark, "lineitem_bucketed"))
    o = sinks.write_bucketed(T(spark, d, "orders").select("o_orderkey", "o_orderpriority"),
                             f"orders_b_{tag}", "o_orderkey", 16, scratch(spark, "orders_bucketed"))
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), dsum(net()).alias("revenue"))
