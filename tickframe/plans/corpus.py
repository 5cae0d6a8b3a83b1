"""The corpus's benchmark subset (templates 96, 7, 75, 44) re-expressed on the
stand-in tables, each composed from the library operators.

* q96 — count in a time slice over a star join;
* q7  — per-item averages for one customer segment and "promotion";
* q75 — year-on-year decline of sales net of returns over channels;
* q44 — ten best and ten worst items by average profit, paired.

Two of the large templates beside them:

* q64 — items sold well through one channel, their sales through another by place of seller and
  buyer, one year beside the next;
* q54 — customers of two channels in a month, their revenue through the third in the
  following quarter, in segments.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions.money import D, DAVG, NET, dec, davg, net
from tickframe.operators import relational as rel
from tickframe.plans.registry import register
from tickframe.sources.tables import table

T = table


@register("corpus.q96", """
SELECT count(*) AS n FROM lineitem, orders, customer, supplier
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND l_suppkey = s_suppkey
  AND month(o_orderdate) = 8 AND day(o_orderdate) >= 15 AND c_mktsegment = 'BUILDING' AND s_nationkey = 7""")
def corpus_q96(spark, d):
    li, o, c, s = (T(spark, d, x) for x in ("lineitem", "orders", "customer", "supplier"))
    o = o.filter((F.month("o_orderdate") == 8) & (F.dayofmonth("o_orderdate") >= 15))
    c = c.filter(F.col("c_mktsegment") == "BUILDING")
    s = s.filter(F.col("s_nationkey") == 7)
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
           .join(s, li.l_suppkey == s.s_suppkey))
    return j.agg(F.count(F.lit(1)).alias("n"))


@register("corpus.q7", f"""
SELECT p_name, {DAVG(D('l_quantity'))} AS agg1, {DAVG(D('l_extendedprice'))} AS agg2,
       {DAVG(D('l_discount'))} AS agg3, {DAVG(D('l_tax'))} AS agg4
FROM lineitem, orders, customer, part
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND l_partkey = p_partkey
  AND c_mktsegment = 'AUTOMOBILE' AND year(o_orderdate) = 1998
  AND (o_orderpriority = '1-URGENT' OR o_orderstatus = 'F')
GROUP BY p_name ORDER BY p_name LIMIT 100""")
def corpus_q7(spark, d):
    li, o, c, p = (T(spark, d, x) for x in ("lineitem", "orders", "customer", "part"))
    o = o.filter((F.col("o_orderdate") >= F.lit("1998-01-01").cast("date")) & (F.col("o_orderdate") < F.lit("1999-01-01").cast("date"))
                 & ((F.col("o_orderpriority") == "1-URGENT") | (F.col("o_orderstatus") == "F")))
    c = c.filter(F.col("c_mktsegment") == "AUTOMOBILE")
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
           .join(p, li.l_partkey == p.p_partkey))
    g = j.groupBy("p_name").agg(davg("l_quantity").alias("agg1"), davg("l_extendedprice").alias("agg2"),
                                davg("l_discount").alias("agg3"), davg("l_tax").alias("agg4"))
    return g.orderBy("p_name").limit(100)


SQL_Q75 = f"""
WITH ret AS (SELECT l_orderkey AS r_order, l_partkey AS r_part, sum({D('l_quantity')}) AS r_qty,
                    sum({NET}) AS r_amt FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
detail AS (
  SELECT l_linestatus AS channel, year(l_shipdate) AS yr, p_brand, p_size,
         {D('l_quantity')} - coalesce(r_qty, 0) AS cnt, {NET} - coalesce(r_amt, 0) AS amt
  FROM lineitem JOIN part ON l_partkey = p_partkey
       LEFT JOIN ret ON l_orderkey = r_order AND l_partkey = r_part
  WHERE p_type = 'PROMO'),
all_sales AS (SELECT yr, p_brand, p_size, sum(cnt) AS sales_cnt, sum(amt) AS sales_amt
              FROM detail GROUP BY 1, 2, 3)
SELECT p.yr AS prev_year, c.yr AS year, c.p_brand, CAST(c.p_size AS BIGINT) AS p_size,
       CAST(p.sales_cnt AS DOUBLE) AS prev_yr_cnt, CAST(c.sales_cnt AS DOUBLE) AS curr_yr_cnt,
       CAST(c.sales_cnt - p.sales_cnt AS DOUBLE) AS sales_cnt_diff, CAST(c.sales_amt - p.sales_amt AS DOUBLE) AS sales_amt_diff
FROM all_sales c JOIN all_sales p ON c.p_brand = p.p_brand AND c.p_size = p.p_size AND p.yr = c.yr - 1
WHERE c.yr = 1999 AND CAST(c.sales_cnt AS DOUBLE) / CAST(p.sales_cnt AS DOUBLE) < 0.9
ORDER BY sales_cnt_diff, sales_amt_diff, c.p_brand, c.p_size LIMIT 100"""


@register("corpus.q75", SQL_Q75)
def corpus_q75(spark, d):
    li, p = T(spark, d, "lineitem"), T(spark, d, "part").filter(F.col("p_type") == "PROMO")
    ret = (li.filter(F.col("l_returnflag") == "R")
             .groupBy(F.col("l_orderkey").alias("r_order"), F.col("l_partkey").alias("r_part"))
             .agg(F.sum(dec("l_quantity")).alias("r_qty"), F.sum(net()).alias("r_amt")))
    # the channel is a column of the one fact, and the two years are two sums: one scan, one grouping
    first, middle, last = (F.lit(f"{y}-01-01").cast("date") for y in (1998, 1999, 2000))
    sold = li.filter((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < last)).join(p, li.l_partkey == p.p_partkey)
    j = sold.join(ret, (F.col("l_orderkey") == F.col("r_order")) & (F.col("l_partkey") == F.col("r_part")), "left")
    detail = j.select("p_brand", "p_size", (F.col("l_shipdate") >= middle).alias("curr"),
                      (dec("l_quantity") - F.coalesce("r_qty", F.lit(0))).alias("cnt"),
                      (net() - F.coalesce("r_amt", F.lit(0))).alias("amt"))
    years = {"prev": ~F.col("curr"), "curr": F.col("curr")}
    both = detail.groupBy("p_brand", "p_size").agg(*[
        F.sum(F.when(cond, F.col(v))).alias(f"{y}_{v}") for y, cond in years.items() for v in ("cnt", "amt")])
    ratio = rel.ratio(F.col("curr_cnt"), F.col("prev_cnt"))  # NULL where a year has no sales
    out = both.filter(ratio < 0.9).select(
        F.lit(1998).alias("prev_year"), F.lit(1999).alias("year"), "p_brand", "p_size",
        F.col("prev_cnt").cast("double").alias("prev_yr_cnt"), F.col("curr_cnt").cast("double").alias("curr_yr_cnt"),
        (F.col("curr_cnt") - F.col("prev_cnt")).cast("double").alias("sales_cnt_diff"),
        (F.col("curr_amt") - F.col("prev_amt")).cast("double").alias("sales_amt_diff"))
    return out.orderBy("sales_cnt_diff", "sales_amt_diff", "p_brand", "p_size").limit(100)


SQL_Q44 = f"""
WITH lines AS (SELECT l_partkey, l_returnflag, {NET} AS profit FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
               WHERE s_nationkey = 7),
base AS (SELECT 0.9 * {DAVG('profit')} AS lim FROM lines WHERE l_returnflag = 'R'),
v AS (SELECT l_partkey AS item, {DAVG('profit')} AS score FROM lines GROUP BY 1
      HAVING {DAVG('profit')} > (SELECT lim FROM base)),
a AS (SELECT item, rank() OVER (ORDER BY score ASC) AS rnk FROM v),
b AS (SELECT item, rank() OVER (ORDER BY score DESC) AS rnk FROM v)
SELECT a.rnk, p1.p_name AS best_performing, p2.p_name AS worst_performing
FROM a JOIN b ON a.rnk = b.rnk JOIN part p1 ON p1.p_partkey = a.item JOIN part p2 ON p2.p_partkey = b.item
WHERE a.rnk < 11 ORDER BY a.rnk LIMIT 100"""


@register("corpus.q44", SQL_Q44)
def corpus_q44(spark, d):
    li, s, p = T(spark, d, "lineitem"), T(spark, d, "supplier"), T(spark, d, "part")
    lines = li.join(s.filter(F.col("s_nationkey") == 7), li.l_suppkey == s.s_suppkey).select(
        "l_partkey", "l_returnflag", net().alias("profit"))
    lim = lines.filter(F.col("l_returnflag") == "R").select(0.9 * davg(F.col("profit"))).scalar()
    v = lines.groupBy(F.col("l_partkey").alias("item")).agg(davg(F.col("profit")).alias("score")).filter(
        F.col("score") > lim)
    pairs = rel.pair_extremes(v, "item", "score", 10)
    names = p.select("p_partkey", "p_name")
    out = (pairs.join(names.withColumnRenamed("p_name", "best_performing"), pairs.best_item == names.p_partkey)
                .drop("p_partkey")
                .join(names.withColumnRenamed("p_name", "worst_performing"), F.col("worst_item") == F.col("p_partkey")))
    return out.select("rnk", "best_performing", "worst_performing").orderBy("rnk").limit(100)


SQL_Q64 = f"""
WITH ui AS (
  SELECT s.l_partkey AS item FROM (SELECT l_partkey, sum({NET}) AS sale FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) s
    JOIN (SELECT l_partkey, sum({D('l_extendedprice')} * {D('l_discount')}) AS refund FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r
      ON s.l_partkey = r.l_partkey
  WHERE sale > 2 * refund),
cross_sales AS (
  SELECT p_name, p_partkey AS item, ns.n_name AS store, nc.n_regionkey AS buyer_region, year(o_orderdate) AS yr, count(*) AS cnt,
         sum({D('l_quantity')}) AS s1, sum({D('l_extendedprice')}) AS s2, sum({NET}) AS s3
  FROM lineitem, ui, orders, customer, supplier, part, nation ns, nation nc
  WHERE l_returnflag = 'N' AND l_partkey = item AND l_partkey = p_partkey AND l_orderkey = o_orderkey AND o_custkey = c_custkey
    AND l_suppkey = s_suppkey AND s_nationkey = ns.n_nationkey AND c_nationkey = nc.n_nationkey AND s_nationkey <> c_nationkey
    AND p_type IN ('PROMO', 'ECONOMY') AND p_size BETWEEN 10 AND 10 + 20 AND p_size BETWEEN 10 + 1 AND 10 + 30
  GROUP BY 1, 2, 3, 4, 5)
SELECT a.p_name, a.store, CAST(a.buyer_region AS BIGINT) AS buyer_region, CAST(b.buyer_region AS BIGINT) AS next_region, a.cnt AS cnt1, b.cnt AS cnt2,
       CAST(a.s1 AS DOUBLE) AS s11, CAST(a.s2 AS DOUBLE) AS s21, CAST(a.s3 AS DOUBLE) AS s31, CAST(b.s1 AS DOUBLE) AS s12,
       CAST(b.s2 AS DOUBLE) AS s22, CAST(b.s3 AS DOUBLE) AS s32
FROM cross_sales a JOIN cross_sales b ON a.item = b.item AND a.store = b.store
WHERE a.yr = 1998 AND b.yr = 1999 AND b.cnt <= a.cnt
ORDER BY a.p_name, a.store, cnt2, s11, s12"""


@register("corpus.q64", SQL_Q64)
def corpus_q64(spark, d):
    """Everything that narrows the lines goes first: the items as a semi-join, the two years as one
    filter on orders; the lines are then counted per place and year once, and the years meet as groups."""
    li, o, c, s, p, n = (T(spark, d, x) for x in ("lineitem", "orders", "customer", "supplier", "part", "nation"))
    sale, refund = net(), dec("l_extendedprice") * dec("l_discount")
    # one pass over the two channels of the first step
    both = li.filter(F.col("l_returnflag").isin("A", "R")).groupBy(F.col("l_partkey").alias("item")).agg(
        F.sum(F.when(F.col("l_returnflag") == "A", sale)).alias("sale"), F.sum(F.when(F.col("l_returnflag") == "R", refund)).alias("refund"))
    items = both.filter(F.col("sale") > 2 * F.col("refund")).select("item")
    p = p.filter(F.col("p_type").isin("PROMO", "ECONOMY") & F.col("p_size").between(11, 30)).select("p_partkey", "p_name")
    p = p.join(items, p.p_partkey == items.item, "left_semi")
    o = o.filter((F.col("o_orderdate") >= F.lit("1998-01-01").cast("date")) & (F.col("o_orderdate") < F.lit("2000-01-01").cast("date")))
    o = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", F.year("o_orderdate").alias("yr"), "c_nationkey")
    j = li.filter(F.col("l_returnflag") == "N").join(p, li.l_partkey == p.p_partkey).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.join(s, F.col("l_suppkey") == F.col("s_suppkey")).filter("s_nationkey <> c_nationkey")
    g = j.groupBy("p_name", "p_partkey", "s_nationkey", "c_nationkey", "yr").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(dec("l_quantity")).alias("s1"), F.sum(dec("l_extendedprice")).alias("s2"), F.sum(net()).alias("s3"))
    # names and regions of the few nations after the first grouping
    g = g.join(F.broadcast(n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("store"))), "s_nationkey")
    g = g.join(F.broadcast(n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("region"))), "c_nationkey")
    g = g.groupBy("p_name", "p_partkey", "store", "region", "yr").agg(*[F.sum(x).alias(x) for x in ("cnt", "s1", "s2", "s3")])
    a, b = (g.filter(F.col("yr") == y).select(*[F.col(x).alias(f"{x}_{t}") for x in g.columns]) for t, y in (("a", 1998), ("b", 1999)))
    j = a.join(b, (F.col("p_partkey_a") == F.col("p_partkey_b")) & (F.col("store_a") == F.col("store_b"))).filter("cnt_b <= cnt_a")
    out = j.select(F.col("p_name_a").alias("p_name"), F.col("store_a").alias("store"), F.col("region_a").alias("buyer_region"),
                   F.col("region_b").alias("next_region"), F.col("cnt_a").alias("cnt1"), F.col("cnt_b").alias("cnt2"),
                   *[F.col(f"s{k}_{t}").cast("double").alias(f"s{k}{m}") for m, t in ((1, "a"), (2, "b")) for k in (1, 2, 3)])
    return out.orderBy("p_name", "store", "cnt2", "s11", "s12")


SEGMENT = 10_000
SQL_Q54 = f"""
WITH my_customers AS (
  SELECT DISTINCT c_custkey, c_nationkey
  FROM (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'A'
        UNION ALL SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R') x, orders, part, customer
  WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey AND o_custkey = c_custkey AND p_type = 'PROMO'
    AND month(o_orderdate) = 4 AND year(o_orderdate) = 1998),
my_revenue AS (
  SELECT c_custkey, sum({NET}) AS revenue
  FROM my_customers, orders, lineitem, supplier, nation ns, nation nc
  WHERE o_custkey = c_custkey AND l_orderkey = o_orderkey AND l_returnflag = 'N' AND l_suppkey = s_suppkey
    AND s_nationkey = ns.n_nationkey AND c_nationkey = nc.n_nationkey AND ns.n_regionkey = nc.n_regionkey
    AND year(o_orderdate) * 12 + month(o_orderdate) BETWEEN (SELECT DISTINCT 1998 * 12 + 4 + 1 FROM region)
                                                        AND (SELECT DISTINCT 1998 * 12 + 4 + 3 FROM region)
  GROUP BY c_custkey),
segments AS (SELECT CAST(floor(CAST(revenue AS DOUBLE) / {SEGMENT} + 0.5) AS BIGINT) AS segment FROM my_revenue)
SELECT segment, count(*) AS num_customers, segment * {SEGMENT} AS segment_base FROM segments GROUP BY segment
ORDER BY segment, num_customers LIMIT 100"""


@register("corpus.q54", SQL_Q54)
def corpus_q54(spark, d):
    li, o, c, s, p, n = (T(spark, d, x) for x in ("lineitem", "orders", "customer", "supplier", "part", "nation"))

    def between(first, last):
        return (F.col("o_orderdate") >= F.lit(first).cast("date")) & (F.col("o_orderdate") < F.lit(last).cast("date"))
    # the two channels are two values of the one fact's flag: one scan
    bought = li.filter(F.col("l_returnflag").isin("A", "R")).join(p.filter("p_type = 'PROMO'"), li.l_partkey == p.p_partkey, "left_semi")
    buyers = o.filter(between("1998-04-01", "1998-05-01")).join(bought, o.o_orderkey == bought.l_orderkey, "left_semi").select("o_custkey").distinct()
    region = F.broadcast(n.select("n_nationkey", "n_regionkey"))
    mine = c.join(buyers, c.c_custkey == buyers.o_custkey, "left_semi").join(region, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_regionkey").alias("home"))
    sellers = s.join(region, s.s_nationkey == F.col("n_nationkey")).select("s_suppkey", F.col("n_regionkey").alias("seat"))
    orders = o.filter(between("1998-05-01", "1998-08-01")).join(mine, o.o_custkey == mine.c_custkey).select("o_orderkey", "c_custkey", "home")
    lines = li.filter(F.col("l_returnflag") == "N").join(orders, li.l_orderkey == orders.o_orderkey)
    lines = lines.join(sellers, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("home") == F.col("seat")))
    revenue = lines.groupBy("c_custkey").agg(F.sum(net()).cast("double").alias("revenue"))
    seg = revenue.select(F.floor(F.col("revenue") / SEGMENT + 0.5).cast("long").alias("segment"))
    return seg.groupBy("segment").agg(F.count(F.lit(1)).alias("num_customers")).select(
        "segment", "num_customers", (F.col("segment") * SEGMENT).alias("segment_base")).orderBy("segment", "num_customers").limit(100)
