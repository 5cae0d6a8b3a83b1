"""§2.4 aggregations."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.functions.money import D, DAVG, DSUM, NET, dec, davg, dsum, net
from tickframe.operators import relational as rel
from tickframe.operators import sketches, stats, windows
from tickframe.operators.quantiles import exact_percentiles
from tickframe.plans.prices import SQL_PRICES, INGEST_DATE, prices
from tickframe.plans.registry import register
from tickframe.session import scratch_path
from tickframe.sources.tables import table

T = table
PRICES_WITH = "WITH " + SQL_PRICES % {"ingest": INGEST_DATE}


@register("agg.sum", f"SELECT l_returnflag, {DSUM(NET)} AS revenue, {DSUM(D('l_quantity'))} AS qty "
                     "FROM lineitem GROUP BY l_returnflag")
def agg_sum(spark, d):
    return T(spark, d, "lineitem").groupBy("l_returnflag").agg(
        dsum(net()).alias("revenue"), dsum("l_quantity").alias("qty"))


@register("agg.avg", f"SELECT o_orderpriority, {DAVG(D('o_totalprice'))} AS avg_price FROM orders GROUP BY 1")
def agg_avg(spark, d):
    return T(spark, d, "orders").groupBy("o_orderpriority").agg(davg("o_totalprice").alias("avg_price"))


@register("agg.min", "SELECT p_type, min(p_retailprice) AS min_price, min(p_name) AS first_name FROM part GROUP BY 1")
def agg_min(spark, d):
    return T(spark, d, "part").groupBy("p_type").agg(F.min("p_retailprice").alias("min_price"),
                                                      F.min("p_name").alias("first_name"))


@register("agg.max", "SELECT p_type, max(p_retailprice) AS max_price, CAST(max(p_size) AS BIGINT) AS max_size FROM part GROUP BY 1")
def agg_max(spark, d):
    return T(spark, d, "part").groupBy("p_type").agg(F.max("p_retailprice").alias("max_price"),
                                                      F.max("p_size").alias("max_size"))


@register("agg.count", """
SELECT c_mktsegment, count(*) AS n_rows, count(1) AS n_one, count(nullif(c_nationkey, 0)) AS n_nonzero_nation
FROM customer GROUP BY 1""")
def agg_count(spark, d):
    return T(spark, d, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit("*")).alias("n_rows"), F.count(F.lit(1)).alias("n_one"),
        F.count(F.nullif("c_nationkey", F.lit(0))).alias("n_nonzero_nation"))


@register("agg.count_distinct", f"""
SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts,
       count(DISTINCT l_suppkey) AS n_supps, {DSUM(NET)} AS revenue
FROM lineitem GROUP BY 1""")
def agg_count_distinct(spark, d):
    return rel.distinct_counts(T(spark, d, "lineitem"), ["l_returnflag"],
                               {"n_orders": "l_orderkey", "n_parts": "l_partkey", "n_supps": "l_suppkey"},
                               [dsum(net()).alias("revenue")])


@register("agg.stddev", """
SELECT l_suppkey % 50 AS bucket, round(stddev_samp(l_quantity), 6) AS sd_qty,
       round(stddev_samp(IF(l_linenumber = 1 AND l_orderkey < 3, l_quantity, NULL)), 6) AS sd_tiny
FROM lineitem GROUP BY 1""")
def agg_stddev(spark, d):
    tiny = F.when((F.col("l_linenumber") == 1) & (F.col("l_orderkey") < 3), F.col("l_quantity"))
    return T(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 50).alias("bucket")).agg(
        F.round(F.stddev_samp("l_quantity"), 6).alias("sd_qty"),
        F.round(F.stddev_samp(tiny), 6).alias("sd_tiny"))  # 0/1-row groups give NULL


@register("agg.cov", """
SELECT l_returnflag, l_linestatus,
       round(CASE avg(l_quantity) WHEN 0 THEN NULL ELSE stddev_samp(l_quantity) / avg(l_quantity) END, 6) AS cov
FROM lineitem GROUP BY 1, 2""")
def agg_cov(spark, d):
    m, s = F.avg("l_quantity"), F.stddev_samp("l_quantity")
    return T(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.when(m == 0, None).otherwise(s / m), 6).alias("cov"))


@register("agg.corr", """
WITH day AS (SELECT CAST(ts AS DATE) AS d, event_type, avg(value) AS avg_v, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, round(corr(avg_v, n), 3) AS corr_value_count,
       round(corr(avg_v, n), 3) > 0.5 OR round(corr(avg_v, n), 3) < -0.5 AS strong
FROM day GROUP BY event_type""")
def agg_corr(spark, d):
    day = (T(spark, d, "events").groupBy(F.to_date("ts").alias("d"), "event_type")
           .agg(F.avg("value").alias("avg_v"), F.count(F.lit(1)).alias("n")))
    c = F.round(F.corr("avg_v", "n"), 3)
    return day.groupBy("event_type").agg(c.alias("corr_value_count"), (F.abs(c) > 0.5).alias("strong"))


def _corr_sql(measure, min_corr):
    return f"""
WITH a AS (SELECT CAST(l_shipdate AS DATE) AS d, {measure} AS t FROM lineitem),
x AS (SELECT CAST(o_orderdate AS DATE) AS d, concat(o_orderpriority, ': ', o_orderstatus) AS descriptor, count(*) AS day_count
      FROM orders GROUP BY 1, 2),
y AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS all_count FROM lineitem GROUP BY 1),
b AS (SELECT x.d, descriptor, day_count, day_count / all_count AS share FROM x JOIN y ON x.d = y.d),
g AS (SELECT avg(share) AS avg_share, avg(day_count) AS avg_count, sum(day_count) AS total, descriptor, t
      FROM a JOIN b ON a.d = b.d GROUP BY descriptor, t)
SELECT descriptor, CAST(sum(total) AS BIGINT) AS total_count, count(t) AS data_count, round(corr(t, avg_count), 3) AS corr_count,
       round(corr(t, avg_share), 3) AS corr_share
FROM g GROUP BY descriptor
HAVING total_count > 5000 AND abs(corr_share) > {min_corr} AND data_count > 5
ORDER BY abs(corr_share) DESC, descriptor"""


def _corr_points(spark, d, measure):
    """Calls are orders (complaint = priority and status), the weather of a day its shipped lines."""
    calls = T(spark, d, "orders").select(F.to_date("o_orderdate").alias("d"),
                                         F.concat("o_orderpriority", F.lit(": "), "o_orderstatus").alias("descriptor"))
    return stats.corr_points(calls, T(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("d"), measure.alias("t")), "descriptor", "d", "t")


@register("agg.corr.report", _corr_sql("month(l_shipdate)", 0.5))
def agg_corr_report(spark, d):
    return stats.corr_report(_corr_points(spark, d, F.month("l_shipdate")), "descriptor", "t")


@register("agg.corr.report.second", _corr_sql("year(l_shipdate) * 4 + quarter(l_shipdate)", 0.3))
def agg_corr_report_second(spark, d):
    """The same report over another measure of the second source."""
    points = _corr_points(spark, d, F.year("l_shipdate") * 4 + F.quarter("l_shipdate"))
    return stats.corr_report(points, "descriptor", "t", min_corr=0.3)


@register("agg.corr.regroup", """
SELECT l_returnflag, count(*) AS n, round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem GROUP BY 1
UNION ALL SELECT NULL, count(*), round(corr(l_quantity, l_extendedprice), 6) FROM lineitem""")
def agg_corr_regroup(spark, d):
    """Correlations per flag and over all lines from the stored states of months, without the lines."""
    months = stats.comoments(T(spark, d, "lineitem").withColumn("m", F.trunc("l_shipdate", "MM")), ["l_returnflag", "m"], "l_quantity", "l_extendedprice")
    flags = stats.merge_comoments(months, ["l_returnflag"])
    whole = stats.merge_comoments(flags, []).withColumn("l_returnflag", F.lit(None).cast("string"))
    return flags.unionByName(whole).select("l_returnflag", "n", F.round(stats.corr_of(), 6).alias("corr"))


# The eleven boundaries of a 10-quantile split.
DECILES = [i / 10 for i in range(11)]


@register("agg.approx_quantiles", """
SELECT event_type, CAST(unnest(range(11)) AS BIGINT) AS decile, true AS within_error FROM (SELECT DISTINCT event_type FROM events)""")
def agg_approx_quantiles(spark, d):
    """APPROX_QUANTILES(x, 10): bounded-memory sketch per group.  The values
    depend on the layout, so what is compared is whether the rank of each is
    within the sketch's error of its decile (or a tie covers it)."""
    e = T(spark, d, "events").select("event_type", "value")
    q = e.groupBy("event_type").agg(F.percentile_approx("value", DECILES, 10000).alias("q"), F.count("value").alias("n"))
    deciles = F.array(*[F.lit(x) for x in DECILES])
    # one pass for the ranks: rows below and up to each of the eleven values
    j = e.join(q.select("event_type", "q"), "event_type")
    below = [F.count(F.when(F.col("value") < F.col("q")[i], 1)).alias(f"b{i}") for i in range(11)]
    upto = [F.count(F.when(F.col("value") <= F.col("q")[i], 1)).alias(f"u{i}") for i in range(11)]
    ranks = j.groupBy("event_type").agg(*below, *upto)
    both = F.arrays_zip(F.array(*[F.col(f"b{i}") for i in range(11)]).alias("b"), F.array(*[F.col(f"u{i}") for i in range(11)]).alias("u"))
    out = ranks.join(q.select("event_type", "n"), "event_type").select("event_type", "n", F.posexplode(both).alias("decile", "r"))
    slack = F.col("n") / 10000 + 1
    want = deciles[F.col("decile")] * F.col("n")
    return out.select("event_type", F.col("decile").cast("long").alias("decile"),
                      ((F.col("r.b") <= want + slack) & (F.col("r.u") >= want - slack)).alias("within_error"))


@register("agg.quantiles_wide", f"""
WITH q AS (SELECT event_type, quantile_cont(value, {DECILES}) AS qs FROM events GROUP BY 1)
SELECT event_type, {', '.join(f'round(qs[{i + 1}], 6) AS "{i * 10}%"' for i in range(11))} FROM q""")
def agg_quantiles_wide(spark, d):
    # exact and skew-safe: no event type is gathered whole into one task
    q = exact_percentiles(T(spark, d, "events"), ["event_type"], "value", DECILES)
    wide = q.groupBy("event_type").pivot("q", DECILES).agg(F.first("value"))
    return wide.select("event_type", *[F.round(F.col(f"`{wide.columns[i + 1]}`"), 6).alias(f"{i * 10}%")
                                       for i in range(11)])


@register("agg.any_value", """
SELECT o_custkey, any_value(c_name) AS c_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY o_custkey""")
def agg_any_value(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    # the value is functionally dependent on the key, so any_value is deterministic here
    return o.join(c, o.o_custkey == c.c_custkey).groupBy("o_custkey").agg(
        F.any_value("c_name").alias("c_name"), F.count(F.lit(1)).alias("n"))


DAYS = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]


@register("agg.conditional", "SELECT year(o_orderdate) AS yr, " + ", ".join(
    f"{DSUM(f'CASE WHEN dayofweek(o_orderdate) = {i} THEN {D(chr(111) + "_totalprice")} ELSE 0 END')} AS {n}_sales"
    for i, n in enumerate(DAYS)) + " FROM orders GROUP BY 1")
def agg_conditional(spark, d):
    o = T(spark, d, "orders")
    dow = F.dayofweek("o_orderdate")  # 1 = Sunday
    return o.groupBy(F.year("o_orderdate").alias("yr")).agg(*[
        F.sum(F.when(dow == i + 1, dec("o_totalprice")).otherwise(F.lit(0))).cast("double").alias(f"{n}_sales")
        for i, n in enumerate(DAYS)])


@register("agg.global", f"""
SELECT count(*) AS n, {DSUM(NET)} AS revenue, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem""")
def agg_global(spark, d):
    return T(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"), dsum(net()).alias("revenue"),
                                       F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


@register("agg.group_expr", """
SELECT year(o_orderdate) AS yr, count(*) AS n FROM orders GROUP BY year(o_orderdate), substr(o_orderpriority, 1, 1)""")
def agg_group_expr(spark, d):
    o = T(spark, d, "orders")
    g = o.groupBy(F.year("o_orderdate").alias("yr"), F.substring("o_orderpriority", 1, 1).alias("p"))
    return g.agg(F.count(F.lit(1)).alias("n")).drop("p")  # grouped by a column not selected


@register("agg.having", f"""
SELECT p_brand, count(*) AS n, {DSUM(NET)} AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
HAVING count(*) > (SELECT 0.98 * count(*) / 25 FROM lineitem) AND {DSUM(NET)} > (SELECT 0.9 * {DAVG(NET)} * count(*) / 25 FROM lineitem)""")
def agg_having(spark, d):
    li, p = T(spark, d, "lineitem"), T(spark, d, "part")
    thr = li.select(0.9 * davg(net()) * F.count(F.lit(1)) / 25).scalar()
    g = li.join(p, li.l_partkey == p.p_partkey).groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), dsum(net()).alias("revenue"))
    rows = li.select(F.lit(0.98).cast("decimal(3,2)") * F.count(F.lit(1)) / 25).scalar()
    return g.filter((F.col("n") > rows) & (F.col("revenue") > thr))


SQL_GEO = """
geo AS (SELECT r_name, n_name, c_mktsegment, CAST(o_totalprice AS DECIMAL(18,2)) AS v
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)"""


def _geo(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    n, r = F.broadcast(T(spark, d, "nation")), F.broadcast(T(spark, d, "region"))
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select("r_name", "n_name", "c_mktsegment", dec("o_totalprice").alias("v")))


@register("agg.rollup", f"""
WITH {SQL_GEO}
SELECT r_name, n_name, CAST(sum(v) AS DOUBLE) AS total, count(*) AS n,
       CAST(grouping(r_name) + grouping(n_name) AS BIGINT) AS lochierarchy
FROM geo GROUP BY ROLLUP (r_name, n_name)""")
def agg_rollup(spark, d):
    out = rel.rollup_labelled(_geo(spark, d), ["r_name", "n_name"], {"total": ("sum", "v"), "n": ("count", "v")})
    return out.withColumn("total", F.col("total").cast("double")).withColumn("n", F.col("n").cast("long"))


ROLLUP8 = ["r_name", "n_name", "c_mktsegment", "o_orderpriority", "o_orderstatus", "yr", "qtr", "mo"]


@register("agg.rollup.wide", f"""
WITH g AS (SELECT r_name, n_name, c_mktsegment, o_orderpriority, o_orderstatus, year(o_orderdate) AS yr,
                  quarter(o_orderdate) AS qtr, month(o_orderdate) AS mo, CAST(o_totalprice AS DECIMAL(18,2)) AS v
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey),
r AS (SELECT {', '.join(ROLLUP8)}, sum(v) AS total FROM g GROUP BY ROLLUP ({', '.join(ROLLUP8)})),
k AS (SELECT *, rank() OVER (PARTITION BY r_name ORDER BY total DESC) AS rk FROM r)
SELECT r_name, n_name, c_mktsegment, o_orderpriority, o_orderstatus, CAST(yr AS VARCHAR) AS yr,
       CAST(qtr AS VARCHAR) AS qtr, CAST(mo AS VARCHAR) AS mo, CAST(total AS DOUBLE) AS total, rk
FROM k WHERE rk <= 100""")
def agg_rollup_wide(spark, d):
    """An 8-column ROLLUP (9 levels) and the top 100 per region, as the
    corpus's category report: the rollup runs on groups pre-aggregated over
    all eight keys, and rank ≤ 100 becomes a per-partition group limit."""
    o = _geo_orders(spark, d)
    r = rel.rollup_labelled(o, ROLLUP8, {"total": ("sum", "v")}).drop("lochierarchy")
    w = Window.partitionBy("r_name").orderBy(F.col("total").desc())
    # rolled-up levels are NULL: calendar keys as text read back the same in every client
    return (r.withColumn("rk", F.rank().over(w)).filter(F.col("rk") <= 100)
             .withColumn("total", F.col("total").cast("double"))
             .withColumns({c: F.col(c).cast("string") for c in ("yr", "qtr", "mo")}))


def _geo_orders(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    n, r = F.broadcast(T(spark, d, "nation")), F.broadcast(T(spark, d, "region"))
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select("r_name", "n_name", "c_mktsegment", "o_orderpriority", "o_orderstatus",
                     F.year("o_orderdate").alias("yr"), F.quarter("o_orderdate").alias("qtr"),
                     F.month("o_orderdate").alias("mo"), dec("o_totalprice").alias("v")))


@register("agg.rollup_label", f"""
WITH {SQL_GEO},
r AS (SELECT r_name, c_mktsegment, sum(v) AS total, r_name || c_mktsegment AS label,
             CAST(grouping(r_name) + grouping(c_mktsegment) AS BIGINT) AS lochierarchy
      FROM geo GROUP BY ROLLUP (r_name, c_mktsegment))
SELECT r_name, c_mktsegment, CAST(total AS DOUBLE) AS total, label, lochierarchy FROM r""")
def agg_rollup_label(spark, d):
    out = rel.rollup_labelled(_geo(spark, d), ["r_name", "c_mktsegment"], {"total": ("sum", "v")},
                              label=["r_name", "c_mktsegment"])
    return out.withColumn("total", F.col("total").cast("double"))


@register("agg.nested", f"""
WITH per AS (SELECT o_custkey, sum({D('o_totalprice')}) AS total FROM orders GROUP BY 1)
SELECT CAST(max(total) AS DOUBLE) AS max_total, {DAVG('total')} AS avg_total, count(*) AS n_customers FROM per""")
def agg_nested(spark, d):
    per = T(spark, d, "orders").groupBy("o_custkey").agg(F.sum(dec("o_totalprice")).alias("total"))
    return per.agg(F.max("total").cast("double").alias("max_total"), davg(F.col("total")).alias("avg_total"),
                   F.count(F.lit(1)).alias("n_customers"))


@register("agg.ratio", f"""
SELECT l_linestatus,
       CAST(sum(IF(l_returnflag = 'R', {D('l_extendedprice')}, 0)) AS DOUBLE)
         / CAST(sum({D('l_extendedprice')}) AS DOUBLE) AS return_ratio,
       CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS count_ratio
FROM lineitem GROUP BY 1""")
def agg_ratio(spark, d):
    r = F.col("l_returnflag") == "R"
    g = T(spark, d, "lineitem").groupBy("l_linestatus").agg(
        F.sum(F.when(r, dec("l_extendedprice")).otherwise(0)).alias("ret"), F.sum(dec("l_extendedprice")).alias("all"),
        F.count(F.when(r, 1)).alias("nr"), F.count(F.lit(1)).alias("n"))
    return g.select("l_linestatus", rel.ratio(F.col("ret"), F.col("all")).alias("return_ratio"),
                    rel.ratio(F.col("nr"), F.col("n")).alias("count_ratio"))


SQL_THREE = f"""
three AS (
  SELECT l_partkey,
         CAST(sum(IF(l_returnflag = 'N', {NET}, 0)) AS DOUBLE) AS n_rev,
         CAST(sum(IF(l_returnflag = 'A', {NET}, 0)) AS DOUBLE) AS a_rev,
         CAST(sum(IF(l_returnflag = 'R', {NET}, 0)) AS DOUBLE) AS r_rev
  FROM lineitem GROUP BY l_partkey)"""


def _three(spark, d):
    li = T(spark, d, "lineitem")
    f = F.col("l_returnflag")
    return li.groupBy("l_partkey").agg(*[
        F.sum(F.when(f == k, net()).otherwise(0)).cast("double").alias(f"{k.lower()}_rev") for k in ("N", "A", "R")])


@register("agg.share3", f"""
WITH {SQL_THREE}
SELECT l_partkey, n_rev / ((n_rev + a_rev + r_rev) / 3) * 100 AS n_dev, a_rev / ((n_rev + a_rev + r_rev) / 3) * 100 AS a_dev,
       r_rev / ((n_rev + a_rev + r_rev) / 3) * 100 AS r_dev
FROM three WHERE n_rev + a_rev + r_rev > 0""")
def agg_share3(spark, d):
    t = _three(spark, d)
    mean3 = (F.col("n_rev") + F.col("a_rev") + F.col("r_rev")) / 3
    return t.filter(F.col("n_rev") + F.col("a_rev") + F.col("r_rev") > 0).select(
        "l_partkey", *[(F.col(f"{k}_rev") / mean3 * 100).alias(f"{k}_dev") for k in ("n", "a", "r")])


@register("agg.band", f"""
WITH {SQL_THREE}
SELECT l_partkey, n_rev, a_rev, r_rev FROM three
WHERE n_rev BETWEEN 0.5 * a_rev AND 1.5 * a_rev AND n_rev BETWEEN 0.5 * r_rev AND 1.5 * r_rev
  AND a_rev BETWEEN 0.5 * n_rev AND 1.5 * n_rev AND a_rev BETWEEN 0.5 * r_rev AND 1.5 * r_rev
  AND r_rev BETWEEN 0.5 * n_rev AND 1.5 * n_rev AND r_rev BETWEEN 0.5 * a_rev AND 1.5 * a_rev""")
def agg_band(spark, d):
    t = _three(spark, d)
    return t.filter(rel.within_band([F.col("n_rev"), F.col("a_rev"), F.col("r_rev")], 0.5))


@register("agg.bucket", f"""
WITH per AS (SELECT o_custkey, CAST(sum({D('o_totalprice')}) AS DOUBLE) AS total FROM orders GROUP BY 1),
seg AS (SELECT CAST(round(total / 500000) AS BIGINT) AS segment FROM per)
SELECT segment, count(*) AS num_customers, segment * 500000 AS segment_base FROM seg GROUP BY segment""")
def agg_bucket(spark, d):
    per = T(spark, d, "orders").groupBy("o_custkey").agg(dsum("o_totalprice").alias("total"))
    # the source dialect's float→int cast rounds; Spark's truncates, so round first
    seg = per.select(F.round(F.col("total") / 500000).cast("long").alias("segment"))
    return seg.groupBy("segment").agg(F.count(F.lit(1)).alias("num_customers")).withColumn(
        "segment_base", F.col("segment") * 500000)


@register("agg.summary", """
SELECT 'l_quantity' AS "column", count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean,
       round(stddev_samp(l_quantity), 6) AS std, min(l_quantity) AS min,
       quantile_cont(l_quantity, 0.25) AS q25, quantile_cont(l_quantity, 0.5) AS q50,
       quantile_cont(l_quantity, 0.75) AS q75, max(l_quantity) AS max FROM lineitem
UNION ALL
SELECT 'l_discount', count(l_discount), round(avg(l_discount), 6), round(stddev_samp(l_discount), 6), min(l_discount),
       quantile_cont(l_discount, 0.25), quantile_cont(l_discount, 0.5), quantile_cont(l_discount, 0.75),
       max(l_discount) FROM lineitem""")
def agg_summary(spark, d):
    out = stats.describe(T(spark, d, "lineitem"), ["l_quantity", "l_discount"])
    return out.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@register("agg.quantile", PRICES_WITH + """,
r AS (SELECT Name, Close / lag(Close) OVER (PARTITION BY Name ORDER BY Date) - 1 AS ret FROM prices)
SELECT Name, round(quantile_cont(ret, 0.05), 9) AS q05 FROM r GROUP BY Name""")
def agg_quantile(spark, d):
    r = windows.pct_change(prices(spark, d), "Name", "Date", "Close", out="ret")
    q = exact_percentiles(r, ["Name"], "ret", [0.05])
    return q.select("Name", F.round("ret", 9).alias("q05"))


@register("agg.histogram", """
WITH r AS (SELECT event_type, value, min(value) OVER (PARTITION BY event_type) AS lo,
                  max(value) OVER (PARTITION BY event_type) AS hi FROM events),
b AS (SELECT event_type, lo, hi,
             CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / ((hi - lo) / 50)), 49) END AS BIGINT) AS bin
      FROM r)
SELECT event_type, bin, count(*) AS count, lo + bin * (hi - lo) / 50 AS edge_lo FROM b GROUP BY event_type, bin, lo, hi""")
def agg_histogram(spark, d):
    return stats.histogram(T(spark, d, "events"), "value", 50, by=["event_type"])


@register("agg.mean_std", PRICES_WITH + """,
r AS (SELECT Name, Close / lag(Close) OVER (PARTITION BY Name ORDER BY Date) - 1 AS ret FROM prices)
SELECT Name, round(avg(ret), 9) AS expected_return, round(stddev_samp(ret), 9) AS risk FROM r GROUP BY Name""")
def agg_mean_std(spark, d):
    r = windows.pct_change(prices(spark, d), "Name", "Date", "Close", out="ret")
    return r.groupBy("Name").agg(F.round(F.avg("ret"), 9).alias("expected_return"),
                                 F.round(F.stddev_samp("ret"), 9).alias("risk"))


@register("agg.pivot", PRICES_WITH + """
SELECT CAST(Date AS VARCHAR) AS Date, max(Close) FILTER (WHERE Name = 'F') AS F,
       max(Close) FILTER (WHERE Name = 'O') AS O, max(Close) FILTER (WHERE Name = 'P') AS P
FROM prices GROUP BY Date""")
def agg_pivot(spark, d):
    # one column per symbol there is; Spark refuses more than spark.sql.pivotMaxValues
    return prices(spark, d).groupBy("Date").pivot("Name").agg(F.first("Close"))


@register("agg.corr_matrix", PRICES_WITH + """,
r AS (SELECT Name, Date, Close / lag(Close) OVER (PARTITION BY Name ORDER BY Date) - 1 AS ret FROM prices)
SELECT a.Name AS a, b.Name AS b, round(corr(a.ret, b.ret), 9) AS corr
FROM r a JOIN r b ON a.Date = b.Date AND a.Name <= b.Name GROUP BY 1, 2""")
def agg_corr_matrix(spark, d):
    r = windows.pct_change(prices(spark, d), "Name", "Date", "Close", out="ret")
    m = stats.corr_matrix(r, "Name", "Date", "ret")
    return m.withColumn("corr", F.round("corr", 9))


@register("agg.corr_matrix.parts", f"""
WITH m AS (SELECT l_partkey % 300 AS k, CAST(date_trunc('month', l_shipdate) AS DATE) AS m, CAST(sum({NET}) AS DOUBLE) AS rev
           FROM lineitem GROUP BY 1, 2)
SELECT a.k AS a, b.k AS b, round(corr(a.rev, b.rev), 6) AS corr FROM m a JOIN m b ON a.m = b.m AND a.k <= b.k GROUP BY 1, 2""")
def agg_corr_matrix_parts(spark, d):
    """Every pair of 300 groups of parts by monthly revenue."""
    m = T(spark, d, "lineitem").groupBy((F.col("l_partkey") % 300).alias("k"), F.trunc("l_shipdate", "MM").alias("m")).agg(
        F.sum(net()).cast("double").alias("rev"))
    return stats.corr_matrix(m, "k", "m", "rev").withColumn("corr", F.round("corr", 6))


@register("agg.regr", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 9) AS r2
FROM lineitem GROUP BY 1""")
def agg_regr(spark, d):
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    return T(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 6).alias("intercept"),
        F.round(F.regr_r2(y, x), 9).alias("r2"))


def change_report(prices_df, as_of, days: int, top: int = 50, digits: int = 2):
    """agg.window_report: per name min / max / avg (2 d.p.) of the daily
    change in the ``days`` days before ``as_of``, the ``top`` names by
    average change (name as tie-breaker)."""
    f = prices_df.filter(F.col("Date") > F.date_sub(F.lit(as_of).cast("date"), days))
    g = f.groupBy(F.col("Name").alias("name")).agg(
        F.min("change_in_percent").alias("min_price_change_percent"),
        F.max("change_in_percent").alias("max_price_change_percent"),
        F.round(F.avg("change_in_percent"), digits).alias("avg__price_change_percent"))
    return g.orderBy(F.col("avg__price_change_percent").desc(), "name").limit(top)


def _report_sql(days):
    return PRICES_WITH + f"""
SELECT Name AS name, min(change_in_percent) AS min_price_change_percent,
       max(change_in_percent) AS max_price_change_percent, round(avg(change_in_percent), 2) AS avg__price_change_percent
FROM prices WHERE Date > DATE '2001-08-01' - INTERVAL {days} DAY
GROUP BY Name ORDER BY avg__price_change_percent DESC, name LIMIT 50"""


@register("agg.window_report", _report_sql(30))
def agg_window_report(spark, d):
    return change_report(prices(spark, d), "2001-08-01", 30)


@register("agg.window_report.weekly", _report_sql(7))
def agg_window_report_weekly(spark, d):
    return change_report(prices(spark, d), "2001-08-01", 7)


SKETCH_LAST, SKETCH_WINDOWS = "2024-01-30", (30, 7)


@register("agg.approx_quantiles.window", """
WITH e AS (SELECT event_type, CAST(ts AS DATE) AS d, value FROM events),
w AS (SELECT unnest([30, 7]) AS days)
SELECT CAST(days AS BIGINT) AS days, event_type, count(value) AS n, min(value) AS least, max(value) AS largest,
       round(CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(value), 6) AS mean, true AS within_error
FROM e JOIN w ON d <= DATE '2024-01-30' AND d > DATE '2024-01-30' - days::INTEGER GROUP BY 1, 2""")
def agg_quantiles_window(spark, d):
    """Deciles over 30 and 7 days from the stored sketches of days; the rank of each in the window's
    rows must lie within the sketch's error of its decile."""
    e = T(spark, d, "events").select("event_type", "ts", "value")
    path = scratch_path(spark, f"sketches/{uuid.uuid4().hex}")
    sketches.store_days(e, ["event_type"], "ts", "value", path)
    out = None
    for days in SKETCH_WINDOWS:
        w = sketches.over_window(spark, path, ["event_type"], SKETCH_LAST, days, DECILES)
        last = F.lit(SKETCH_LAST).cast("date")
        rows = e.filter((F.to_date("ts") <= last) & (F.to_date("ts") > F.date_sub(last, days)))
        j = rows.join(w.select("event_type", "quantiles"), "event_type")
        q = F.col("quantiles")
        ranks = j.groupBy("event_type").agg(*[F.avg((F.col("value") < q[i]).cast("double")).alias(f"b{i}") for i in range(11)],
                                            *[F.avg((F.col("value") <= q[i]).cast("double")).alias(f"u{i}") for i in range(11)])
        slack, ok = sketches.rank_error() * 2, F.lit(True)
        for i, x in enumerate(DECILES):
            ok = ok & (F.col(f"b{i}") <= x + slack) & (F.col(f"u{i}") >= x - slack)
        part = w.join(ranks.select("event_type", ok.alias("within_error")), "event_type").select(
            F.lit(days).alias("days"), "event_type", "n", "least", "largest", F.round("mean", 6).alias("mean"), "within_error")
        out = part if out is None else out.unionByName(part)
    return out


@register("agg.window_report.stored", PRICES_WITH + """,
r AS (SELECT Name AS name, min(change_in_percent) AS min_price_change_percent, max(change_in_percent) AS max_price_change_percent,
             round(CAST(sum(CAST(change_in_percent AS DECIMAL(18,4))) AS DOUBLE) / count(change_in_percent), 2) AS avg__price_change_percent
      FROM prices WHERE Date > DATE '2001-08-01' - INTERVAL 30 DAY GROUP BY Name)
SELECT * FROM r ORDER BY avg__price_change_percent DESC, name LIMIT 50""")
def agg_window_report_stored(spark, d):
    """The monthly change report from stored daily summaries (kept for 180 days, as the price table is);
    days that are written again count once."""
    p = prices(spark, d).select("Name", "Date", "change_in_percent").filter(F.col("Date") > F.date_sub(F.lit("2001-08-01").cast("date"), 180))
    path = scratch_path(spark, f"sketches/{uuid.uuid4().hex}")
    sketches.store_days(p, ["Name"], "Date", "change_in_percent", path)
    sketches.store_days(p.filter("Date >= '2001-07-20'"), ["Name"], "Date", "change_in_percent", path)
    w = sketches.over_window(spark, path, ["Name"], "2001-08-01", 30)
    return w.select(F.col("Name").alias("name"), F.col("least").alias("min_price_change_percent"),
                    F.col("largest").alias("max_price_change_percent"), F.round("mean", 2).alias("avg__price_change_percent")).orderBy(
        F.col("avg__price_change_percent").desc(), "name").limit(50)
