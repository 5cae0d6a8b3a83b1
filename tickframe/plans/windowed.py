"""§2.5 window functions and §2.6 sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.functions.money import D, NET, dec, net
from tickframe.operators import relational as rel
from tickframe.operators import windows
from tickframe.plans.prices import INGEST_DATE, SQL_PRICES, prices
from tickframe.plans.registry import register
from tickframe.sources.tables import query, table

T = table
PRICES_WITH = "WITH " + SQL_PRICES % {"ingest": INGEST_DATE}

SQL_BRAND_REV = f"""
br AS (SELECT p_type, p_brand, CAST(sum({NET}) AS DOUBLE) AS rev
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def brand_rev(spark, d):
    li, p = T(spark, d, "lineitem"), T(spark, d, "part")
    return (li.join(p, li.l_partkey == p.p_partkey).groupBy("p_type", "p_brand")
              .agg(F.sum(net()).cast("double").alias("rev")))


@register("win.rank", f"""
WITH {SQL_BRAND_REV},
t AS (SELECT p_type, CAST(sum({NET}) AS DOUBLE) AS type_rev, rank() OVER (ORDER BY sum({NET}) DESC) AS type_rank
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT br.p_type, p_brand, rank() OVER (PARTITION BY br.p_type ORDER BY br.rev DESC) AS rk_in_type,
       type_rev, type_rank
FROM br JOIN t ON br.p_type = t.p_type""")
def win_rank(spark, d):
    br = brand_rev(spark, d)
    # un-partitioned rank: reduce to one row per type first, then rank the small table
    li, p = T(spark, d, "lineitem"), T(spark, d, "part")
    t = li.join(p, li.l_partkey == p.p_partkey).groupBy("p_type").agg(F.sum(net()).cast("double").alias("type_rev"))
    t = t.withColumn("type_rank", F.rank().over(Window.orderBy(F.col("type_rev").desc())))
    w = Window.partitionBy("p_type").orderBy(F.col("rev").desc())
    return br.withColumn("rk_in_type", F.rank().over(w)).join(t, "p_type").drop("rev")


@register("win.rank_agg", f"""
SELECT p_type, substr(p_brand, 1, 7) AS brand_group, CAST(sum({NET}) AS DOUBLE) AS rev,
       rank() OVER (PARTITION BY p_type ORDER BY sum({NET}) DESC, substr(p_brand, 1, 7)) AS rk
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, substr(p_brand, 1, 7)""")
def win_rank_agg(spark, d):
    li, p = T(spark, d, "lineitem"), T(spark, d, "part")
    g = (li.join(p, li.l_partkey == p.p_partkey)
         .groupBy("p_type", F.substring("p_brand", 1, 7).alias("brand_group")).agg(F.sum(net()).alias("rev")))
    w = Window.partitionBy("p_type").orderBy(F.col("rev").desc(), "brand_group")
    return g.withColumn("rk", F.rank().over(w)).withColumn("rev", F.col("rev").cast("double"))


@register("win.top_n", f"""
WITH {SQL_BRAND_REV}
SELECT * FROM (SELECT p_type, p_brand, rev, rank() OVER (PARTITION BY p_type ORDER BY rev DESC, p_brand) AS rk FROM br)
WHERE rk <= 5""")
def win_top_n(spark, d):
    w = Window.partitionBy("p_type").orderBy(F.col("rev").desc(), "p_brand")
    # rank <= n becomes a WindowGroupLimit below the shuffle
    return brand_rev(spark, d).withColumn("rk", F.rank().over(w)).filter(F.col("rk") <= 5)


@register("win.best_worst", f"""
WITH s AS (SELECT l_partkey AS item, CAST(sum({NET}) AS DOUBLE) / count(*) AS score FROM lineitem GROUP BY 1),
a AS (SELECT item AS best_item, score AS best_score, rank() OVER (ORDER BY score ASC) AS rnk FROM s),
b AS (SELECT item AS worst_item, score AS worst_score, rank() OVER (ORDER BY score DESC) AS rnk FROM s)
SELECT a.rnk, best_item, best_score, worst_item, worst_score FROM a JOIN b ON a.rnk = b.rnk WHERE a.rnk <= 10""")
def win_best_worst(spark, d):
    s = T(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("item")).agg(
        (F.sum(net()).cast("double") / F.count(F.lit(1))).alias("score"))
    return rel.pair_extremes(s, "item", "score", 10)


@register("win.avg_of_sum", f"""
WITH m AS (SELECT p_brand, year(l_shipdate) AS yr, CAST(sum({NET}) AS DOUBLE) AS rev
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
a AS (SELECT *, avg(rev) OVER (PARTITION BY p_brand) AS avg_rev FROM m)
SELECT p_brand, yr, rev, round(avg_rev, 4) AS avg_rev FROM a
WHERE CASE WHEN avg_rev > 0 THEN abs(rev - avg_rev) / avg_rev ELSE NULL END > 0.1""")
def win_avg_of_sum(spark, d):
    li, p = T(spark, d, "lineitem"), T(spark, d, "part")
    m = (li.join(p, li.l_partkey == p.p_partkey).groupBy("p_brand", F.year("l_shipdate").alias("yr"))
         .agg(F.sum(net()).cast("double").alias("rev")))
    a = m.withColumn("avg_rev", F.avg("rev").over(Window.partitionBy("p_brand")))
    dev = F.when(F.col("avg_rev") > 0, F.abs(F.col("rev") - F.col("avg_rev")) / F.col("avg_rev"))
    return a.filter(dev > 0.1).withColumn("avg_rev", F.round("avg_rev", 4))


@register("win.share", f"""
WITH {SQL_BRAND_REV}
SELECT p_type, p_brand, rev, round(rev * 100 / sum(rev) OVER (PARTITION BY p_type), 6) AS revenueratio FROM br""")
def win_share(spark, d):
    br = brand_rev(spark, d)
    return br.withColumn("revenueratio", F.round(F.col("rev") * 100 / F.sum("rev").over(Window.partitionBy("p_type")), 6))


SQL_DAILY = f"""
daily AS (SELECT l_returnflag AS ch, CAST(l_shipdate AS DATE) AS d, sum({NET}) AS rev
          FROM lineitem GROUP BY 1, 2)"""


def _daily(spark, d):
    li = T(spark, d, "lineitem")
    return li.groupBy(F.col("l_returnflag").alias("ch"), F.to_date("l_shipdate").alias("d")).agg(
        F.sum(net()).alias("rev"))


@register("win.running_sum", f"""
WITH {SQL_DAILY}
SELECT ch, CAST(d AS VARCHAR) AS d, CAST(sum(rev) OVER (PARTITION BY ch ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING
       AND CURRENT ROW) AS DOUBLE) AS cume_rev FROM daily""")
def win_running_sum(spark, d):
    out = windows.running(_daily(spark, d), "ch", "d", "rev", "sum", out="cume_rev")
    return out.select("ch", "d", F.col("cume_rev").cast("double").alias("cume_rev"))


SQL_CUME = f"""
daily AS (SELECT l_returnflag AS ch, l_partkey AS item, CAST(l_shipdate AS DATE) AS d, sum({NET}) AS rev FROM lineitem GROUP BY 1, 2, 3),
cume AS (SELECT ch, item, d, CAST(sum(rev) OVER (PARTITION BY ch, item ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS DOUBLE) AS cume FROM daily)"""


@register("win.running_max", f"""
WITH {SQL_CUME},
j AS (SELECT coalesce(n.item, r.item) AS item, coalesce(n.d, r.d) AS d, n.cume AS n_sales, r.cume AS r_sales
      FROM (SELECT * FROM cume WHERE ch = 'N') n FULL OUTER JOIN (SELECT * FROM cume WHERE ch = 'R') r ON n.item = r.item AND n.d = r.d),
m AS (SELECT *, max(n_sales) OVER (PARTITION BY item ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_cummax,
             max(r_sales) OVER (PARTITION BY item ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r_cummax FROM j)
SELECT item, CAST(d AS VARCHAR) AS d, n_sales, r_sales, n_cummax, r_cummax FROM m WHERE n_cummax > r_cummax
ORDER BY item, d LIMIT 100""")
def win_running_max(spark, d):
    """Per item, the running sales of two channels side by side and the days on
    which the first is ahead; the source reports the first 100."""
    li = T(spark, d, "lineitem").filter(F.col("l_returnflag").isin("N", "R"))
    daily = li.groupBy(F.col("l_returnflag").alias("ch"), F.col("l_partkey").alias("item"), F.to_date("l_shipdate").alias("d")).agg(
        F.sum(net()).alias("rev"))
    cume = windows.running(daily, ["ch", "item"], "d", "rev", "sum", out="cume")

    def channel(ch):
        return cume.filter(F.col("ch") == ch).select("item", "d", F.col("cume").cast("double").alias(f"{ch.lower()}_sales"))
    j = channel("N").join(channel("R"), ["item", "d"], "full")
    j = windows.running(j, "item", "d", "n_sales", "max", out="n_cummax")
    j = windows.running(j, "item", "d", "r_sales", "max", out="r_cummax")
    return j.filter("n_cummax > r_cummax").orderBy("item", "d").limit(100)


@register("win.neighbours", f"""
WITH m AS (SELECT p_type, year(l_shipdate) AS yr, month(l_shipdate) AS mo, CAST(sum({NET}) AS DOUBLE) AS rev
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
r AS (SELECT *, rank() OVER (PARTITION BY p_type ORDER BY yr, mo) AS rn FROM m)
SELECT c.p_type, c.yr, c.mo, c.rev, p.rev AS psum, n.rev AS nsum
FROM r c JOIN r p ON c.p_type = p.p_type AND c.rn = p.rn + 1 JOIN r n ON c.p_type = n.p_type AND c.rn + 1 = n.rn""")
def win_neighbours(spark, d):
    li, p = T(spark, d, "lineitem"), T(spark, d, "part")
    m = (li.join(p, li.l_partkey == p.p_partkey)
         .groupBy("p_type", F.year("l_shipdate").alias("yr"), F.month("l_shipdate").alias("mo"))
         .agg(F.sum(net()).cast("double").alias("rev")))
    # lag/lead over the same partition replace the rank±1 self-joins
    return windows.with_neighbours(m, ["p_type"], ["yr", "mo"], "rev")


@register("win.rolling_mean", PRICES_WITH + """
SELECT Name, CAST(Date AS VARCHAR) AS Date,
       round(avg(Close) OVER (PARTITION BY Name ORDER BY Date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 4) AS sma_5,
       CASE WHEN count(Close) OVER (PARTITION BY Name ORDER BY Date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) >= 30
            THEN round(avg(Close) OVER (PARTITION BY Name ORDER BY Date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 4)
       END AS sma_30
FROM prices""")
def win_rolling_mean(spark, d):
    p = prices(spark, d).select("Name", "Date", "Close")
    p = windows.rolling(p, "Name", "Date", "Close", "mean", 5, min_periods=1, out="sma_5")
    p = windows.rolling(p, "Name", "Date", "Close", "mean", 30, out="sma_30")
    return p.select("Name", "Date", F.round("sma_5", 4).alias("sma_5"), F.round("sma_30", 4).alias("sma_30"))


@register("win.rolling_std", PRICES_WITH + """,
r AS (SELECT Name, Date, Close / lag(Close) OVER (PARTITION BY Name ORDER BY Date) - 1 AS ret FROM prices)
SELECT Name, CAST(Date AS VARCHAR) AS Date,
       CASE WHEN count(ret) OVER w >= 30 THEN round(stddev_samp(ret) OVER w, 9) END AS volatility
FROM r WINDOW w AS (PARTITION BY Name ORDER BY Date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def win_rolling_std(spark, d):
    r = windows.pct_change(prices(spark, d), "Name", "Date", "Close", out="ret")
    r = windows.rolling(r, "Name", "Date", "ret", "std", 30, out="volatility")
    return r.select("Name", "Date", F.round("volatility", 9).alias("volatility"))


@register("win.rolling_extreme", PRICES_WITH + """
SELECT Name, CAST(Date AS VARCHAR) AS Date,
       CASE WHEN count(Close) OVER w = 20 THEN max(Close) OVER w END AS prev_max,
       CASE WHEN count(Close) OVER w = 20 THEN min(Close) OVER w END AS prev_min
FROM prices WINDOW w AS (PARTITION BY Name ORDER BY Date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)""")
def win_rolling_extreme(spark, d):
    p = prices(spark, d).select("Name", "Date", "Close")
    p = windows.rolling(p, "Name", "Date", "Close", "max", 20, shift=1, out="prev_max")
    p = windows.rolling(p, "Name", "Date", "Close", "min", 20, shift=1, out="prev_min")
    return p.drop("Close")


@register("win.pct_change", PRICES_WITH + """
SELECT Name, CAST(Date AS VARCHAR) AS Date, Close / lag(Close) OVER (PARTITION BY Name ORDER BY Date) - 1 AS pct_change
FROM prices""")
def win_pct_change(spark, d):
    return windows.pct_change(prices(spark, d), "Name", "Date", "Close").select("Name", "Date", "pct_change")


@register("win.diff", PRICES_WITH + """
SELECT Name, CAST(Date AS VARCHAR) AS Date, Close - lag(Close) OVER (PARTITION BY Name ORDER BY Date) AS diff FROM prices""")
def win_diff(spark, d):
    return windows.diff(prices(spark, d), "Name", "Date", "Close").select("Name", "Date", "diff")


@register("win.lag_features", PRICES_WITH + """,
f AS (SELECT Name, Date, Close, first_value(Close) OVER (PARTITION BY Name ORDER BY Date) AS c0,
             lag(Close, 1) OVER w AS l1, lag(Close, 2) OVER w AS l2, lag(Close, 3) OVER w AS l3
      FROM prices WINDOW w AS (PARTITION BY Name ORDER BY Date))
SELECT Name, CAST(Date AS VARCHAR) AS Date,
       [coalesce(l2, c0) - coalesce(l3, c0), coalesce(l1, c0) - coalesce(l2, c0), Close - coalesce(l1, c0)] AS state
FROM f""")
def win_lag_features(spark, d):
    out = windows.lag_features(prices(spark, d), "Name", "Date", "Close", 3)
    return out.select("Name", "Date", "state")


@register("win.split_last", PRICES_WITH + """
SELECT Name, CAST(Date AS VARCHAR) AS Date,
       row_number() OVER (PARTITION BY Name ORDER BY Date DESC) <= 30 AS is_holdout FROM prices""")
def win_split_last(spark, d):
    return windows.split_last(prices(spark, d), "Name", "Date", 30).select("Name", "Date", "is_holdout")


# ------------------------------------------------------------------ §2.6 sorts, limits, sets

@register("sort.multi", f"""
SELECT o_orderpriority, o_orderstatus, count(*) AS n, CAST(sum({D('o_totalprice')}) AS DOUBLE) AS total
FROM orders GROUP BY 1, 2 ORDER BY o_orderpriority ASC NULLS FIRST, total DESC""")
def sort_multi(spark, d):
    g = T(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(dec("o_totalprice")).cast("double").alias("total"))
    return g.orderBy(F.col("o_orderpriority").asc(), F.col("total").desc())


@register("sort.expr", """
SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand
ORDER BY abs(count(*) - 80), CASE WHEN p_brand LIKE 'Brand#1%' THEN 0 ELSE 1 END, p_brand LIMIT 10""")
def sort_expr(spark, d):
    g = T(spark, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.abs(F.col("n") - 80), F.when(F.col("p_brand").like("Brand#1%"), 0).otherwise(1),
                     "p_brand").limit(10)


SQL_ORDINAL = """
SELECT o_orderstatus, o_orderpriority, year(o_orderdate) AS yr, count(*) AS n FROM orders
GROUP BY 1, 2, 3 ORDER BY 1, 4 DESC, 2, 3 LIMIT 20"""


@register("sort.ordinal", SQL_ORDINAL)
def sort_ordinal(spark, d):
    return query(spark, d, SQL_ORDINAL, ("orders",))


@register("limit.topk", f"""
SELECT o_custkey, CAST(sum({D('o_totalprice')}) AS DOUBLE) AS total FROM orders GROUP BY 1
ORDER BY total DESC, o_custkey LIMIT 100""")
def limit_topk(spark, d):
    g = T(spark, d, "orders").groupBy("o_custkey").agg(F.sum(dec("o_totalprice")).cast("double").alias("total"))
    # ORDER BY + LIMIT → TakeOrderedAndProject: a partial top-k per partition
    return g.orderBy(F.col("total").desc(), "o_custkey").limit(100)


@register("limit.plain", "SELECT CAST(least(count(*), 5) AS BIGINT) AS n, CAST(least(count(*), 5) AS BIGINT) AS n_known FROM events")
def limit_plain(spark, d):
    """LIMIT without ORDER BY gives any 5 rows, so what is compared is how many
    there are and how many of them are rows of the table."""
    e = T(spark, d, "events").select("event_id", "user_id", "ts")
    some = e.limit(5)
    known = some.join(e.withColumn("known", F.lit(1)), ["event_id", "user_id", "ts"], "left")
    return known.agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("n_known"))


@register("set.union_all", """
SELECT 'N' AS ch, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem WHERE l_returnflag = 'N'
UNION ALL SELECT 'R', l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'A', l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem WHERE l_returnflag = 'A'""")
def set_union_all(spark, d):
    li = T(spark, d, "lineitem")
    parts = [li.filter(F.col("l_returnflag") == f).select(F.lit(f).alias("ch"), "l_orderkey", "l_linenumber")
             for f in ("N", "R", "A")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SQL_CP = """(SELECT o_custkey, l_partkey % 100 AS pgroup FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             WHERE l_returnflag = '{f}')"""


def _cust_parts(spark, d):
    """(customer, part group) pairs with a flag per channel that has them: what INTERSECT and EXCEPT
    of the channels' distinct pairs ask for, from one scan and one join."""
    li, o = T(spark, d, "lineitem"), T(spark, d, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey).groupBy("o_custkey", (F.col("l_partkey") % 100).alias("pgroup"))
    return j.agg(*[F.max(F.col("l_returnflag") == c).alias(c) for c in ("N", "A", "R")])


@register("set.intersect", f"""
SELECT count(*) AS n FROM ({SQL_CP.format(f='N')} INTERSECT {SQL_CP.format(f='A')} INTERSECT {SQL_CP.format(f='R')})""")
def set_intersect(spark, d):
    return _cust_parts(spark, d).filter("N AND A AND R").agg(F.count(F.lit(1)).alias("n"))


@register("set.except", f"""
SELECT count(*) AS n FROM ({SQL_CP.format(f='N')} EXCEPT {SQL_CP.format(f='A')} EXCEPT {SQL_CP.format(f='R')})""")
def set_except(spark, d):
    return _cust_parts(spark, d).filter("N AND NOT A AND NOT R").agg(F.count(F.lit(1)).alias("n"))
