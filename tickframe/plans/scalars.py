"""§2.7 scalar functions: math, string, null, cast, date, timestamp, array,
JSON and bucketise, each over a whole test table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from tickframe.functions import dialect
from tickframe.operators.quantiles import exact_percentiles
from tickframe.plans.registry import register
from tickframe.sources.tables import table

T = table


@register("fn.math", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(l_extendedprice / 7, 2) AS r2, abs(l_discount - 0.05) AS abs_d,
       pow(l_quantity, 2) AS sq, sqrt(l_quantity) AS rt, round_even(l_quantity / 4, 1) AS half_even,
       round(l_quantity / 4, 1) AS half_up
FROM lineitem""")
def fn_math(spark, d):
    li = T(spark, d, "lineitem")
    q4 = F.col("l_quantity") / 4
    return li.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") / 7, 2).alias("r2"),
                     F.abs(F.col("l_discount") - 0.05).alias("abs_d"), F.pow("l_quantity", 2).alias("sq"),
                     F.sqrt("l_quantity").alias("rt"), F.bround(q4, 1).alias("half_even"),
                     F.round(q4, 1).alias("half_up"))


@register("fn.string", """
SELECT c_custkey, substr(c_name, 1, 8) AS prefix, concat(c_mktsegment, '-', CAST(c_nationkey AS VARCHAR)) AS tag,
       upper(substr(c_mktsegment, 1, 3)) AS seg3, trim('  ' || c_mktsegment || ' ') = c_mktsegment AS trimmed_ok,
       str_split(c_name, '#')[1] AS name_head, ends_with(c_mktsegment, 'ING') AS ends_ing,
       c_mktsegment LIKE 'AUTO%' AS is_auto,
       printf('%.2f%%', c_acctbal) AS pct_text
FROM customer""")
def fn_string(spark, d):
    c = T(spark, d, "customer")
    return c.select(
        "c_custkey", F.substring("c_name", 1, 8).alias("prefix"),
        F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string")).alias("tag"),
        F.upper(F.substring("c_mktsegment", 1, 3)).alias("seg3"),
        (F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))) == F.col("c_mktsegment")).alias("trimmed_ok"),
        F.split("c_name", "#").getItem(0).alias("name_head"),
        F.endswith("c_mktsegment", F.lit("ING")).alias("ends_ing"),
        F.col("c_mktsegment").like("AUTO%").alias("is_auto"),
        F.format_string("%.2f%%", F.col("c_acctbal")).alias("pct_text"))


@register("fn.null", """
WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg, nullif(c_acctbal, c_acctbal) AS nb,
                  IF(c_acctbal < 0, 'NaN'::DOUBLE, c_acctbal) AS bal FROM customer)
SELECT c_custkey, coalesce(seg, 'unknown') AS seg, seg IS NULL AS seg_null, coalesce(nb, 0) AS nb0,
       isnan(bal) AS bal_nan FROM c""")
def fn_null(spark, d):
    c = T(spark, d, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"),
        F.nullif("c_acctbal", "c_acctbal").alias("nb"),
        F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("bal"))
    return c.select("c_custkey", F.coalesce("seg", F.lit("unknown")).alias("seg"), F.isnull("seg").alias("seg_null"),
                    F.coalesce("nb", F.lit(0.0)).alias("nb0"), F.isnan("bal").alias("bal_nan"))


@register("fn.cast", """
SELECT o_orderkey, CAST(CAST(o_totalprice / 3 AS DECIMAL(38,9)) AS DOUBLE) AS as_numeric,
       CAST(round(o_totalprice / 1000) AS BIGINT) AS as_int64, CAST(o_orderkey AS VARCHAR) AS as_string,
       CAST(CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS DATE) = CAST(o_orderdate AS DATE) AS date_roundtrip,
       CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS as_float64
FROM orders""")
def fn_cast(spark, d):
    o = T(spark, d, "orders")
    return o.select(
        "o_orderkey", dialect.numeric(F.col("o_totalprice") / 3).cast("double").alias("as_numeric"),
        dialect.int64_cast(F.col("o_totalprice") / 1000).alias("as_int64"),
        F.col("o_orderkey").cast("string").alias("as_string"),
        (F.to_date("o_orderdate").cast("string").cast("date") == F.to_date("o_orderdate")).alias("date_roundtrip"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("as_float64"))


@register("fn.date", """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CAST(make_date(year(d), month(d), 1) AS VARCHAR) AS month_start,
       CAST(d + INTERVAL 30 DAY AS DATE)::VARCHAR AS plus30, CAST(d - INTERVAL 7 DAY AS DATE)::VARCHAR AS minus7,
       datediff('day', DATE '1995-01-01', d) AS days_since, year(d) AS yr, quarter(d) AS qtr,
       dayofweek(d) + 1 AS dow, d >= CAST(strptime('19980101', '%Y%m%d') AS DATE) AS after_98,
       CAST(date_trunc('month', d) AS DATE)::VARCHAR AS trunc_month
FROM o""")
def fn_date(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.select(
        "o_orderkey", dialect.date3(F.year("d"), F.month("d"), F.lit(1)).alias("month_start"),
        dialect.add_days("d", 30).alias("plus30"), F.date_sub("d", 7).alias("minus7"),
        F.datediff("d", F.lit("1995-01-01").cast("date")).alias("days_since"),
        F.year("d").alias("yr"), F.quarter("d").alias("qtr"), F.dayofweek("d").alias("dow"),
        (F.col("d") >= F.to_date(F.lit("19980101"), "yyyyMMdd")).alias("after_98"),
        F.trunc("d", "month").alias("trunc_month"))


@register("fn.timestamp", """
SELECT event_id, hour(ts) AS hr,
       (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 1000000 AS secs_since,
       make_timestamp(2024, 1, CAST(day(ts) AS BIGINT), 0, 0, 0) AS day_start,
       ts - INTERVAL 10 MINUTE AS minus10,
       epoch_ms(epoch_us(ts) // 1000) AS via_millis,
       strptime(CAST(CAST(ts AS DATE) AS VARCHAR) || ' 12:00:00', '%Y-%m-%d %H:%M:%S') AS noon
FROM events""")
def fn_timestamp(spark, d):
    e = T(spark, d, "events")
    return e.select(
        "event_id", F.hour("ts").alias("hr"),
        dialect.ts_diff_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")).alias("secs_since"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.dayofmonth("ts"), F.lit(0), F.lit(0), F.lit(0)).alias("day_start"),
        (F.col("ts") - F.expr("INTERVAL 10 MINUTES")).alias("minus10"),
        F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))).cast("timestamp_ntz").alias("via_millis"),
        F.to_timestamp_ntz(F.concat(F.to_date("ts").cast("string"), F.lit(" 12:00:00"))).alias("noon"))


@register("fn.array", """
WITH q AS (SELECT event_type, quantile_cont(value, [0.25, 0.5, 0.75]) AS qs FROM events GROUP BY 1),
u AS (SELECT event_type, unnest(range(0, 3)) AS pos, unnest(qs) AS val FROM q)
SELECT event_type, CAST(pos AS BIGINT) AS pos, round(val, 6) AS val, CAST([5, 10, 17][CAST(pos AS BIGINT) + 1] AS BIGINT) AS split
FROM u""")
def fn_array(spark, d):
    qs = exact_percentiles(T(spark, d, "events"), ["event_type"], "value", [0.25, 0.5, 0.75])
    # gather the three quartiles of each type into an array ordered by q
    q = qs.groupBy("event_type").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("q", "value"))), lambda s: s["value"]).alias("qs"))
    splits = F.array(F.lit(5), F.lit(10), F.lit(17))
    x = q.select("event_type", F.posexplode("qs").alias("pos", "val"))
    return x.select("event_type", "pos", F.round("val", 6).alias("val"),
                    F.element_at(splits, F.col("pos") + 1).alias("split"))


@register("fn.json", """
SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       max(CAST(json_extract_string(props, '$.k') AS VARCHAR)) AS max_k_text, count(*) AS n
FROM events GROUP BY event_type""")
def fn_json(spark, d):
    e = T(spark, d, "events")
    schema = T_.StructType([T_.StructField("k", T_.IntegerType())])
    p = e.select("event_type", F.from_json("props", schema).alias("p"), F.get_json_object("props", "$.k").alias("kt"))
    return p.groupBy("event_type").agg(F.sum("p.k").cast("long").alias("sum_k"), F.max("kt").alias("max_k_text"),
                                       F.count(F.lit(1)).alias("n"))


@register("fn.bucketise", """
SELECT CASE WHEN hour(ts) < 5 THEN 'bin_1' WHEN hour(ts) < 10 THEN 'bin_2' WHEN hour(ts) < 17 THEN 'bin_3'
            ELSE 'bin_4' END AS hour_bin, count(*) AS n
FROM events GROUP BY 1""")
def fn_bucketise(spark, d):
    e = T(spark, d, "events")
    return e.groupBy(dialect.bucketize(F.hour("ts"), [5, 10, 17]).alias("hour_bin")).agg(F.count(F.lit(1)).alias("n"))
