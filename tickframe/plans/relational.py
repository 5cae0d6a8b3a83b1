"""§2.2 projections / filters / predicates and §2.3 joins / subqueries.

Stand-ins (SURVEY §7.2): ``lineitem`` split by ``l_returnflag`` plays the
three sales channels, ``part``/``customer``/``supplier`` (+ nation, region)
the dimensions.  region and nation have a fixed size (5 and 25 rows by the
TPC-H specification), so they are the only sides broadcast by hint; every
other join is left to AQE, which broadcasts only below its size threshold.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions.money import D, DAVG, DSUM, NET, dec, davg, dsum, net
from tickframe.operators import clean, relational as rel
from tickframe.plans.registry import register
from tickframe.sources.tables import query, table


def T(spark, d, name):
    return table(spark, d, name)


# ------------------------------------------------------------------ §2.2 projections

@register("proj.select", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def proj_select(spark, d):
    return T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@register("proj.rename", "SELECT l_orderkey, l_extendedprice AS price, l_discount AS disc FROM lineitem")
def proj_rename(spark, d):
    return (T(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
            .withColumnsRenamed({"l_extendedprice": "price", "l_discount": "disc"}))


@register("proj.derive", f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST({NET} AS DOUBLE) AS revenue,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem""")
def proj_derive(spark, d):
    li = T(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     net().cast("double").alias("revenue"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"))


@register("proj.literal", """
SELECT o_orderkey, 'store channel' AS channel, 's' AS code, CAST(0 AS DOUBLE) AS zero,
       CAST(CAST(strptime('20010801', '%Y%m%d') AS DATE) AS VARCHAR) AS as_of FROM orders""")
def proj_literal(spark, d):
    return T(spark, d, "orders").select(
        "o_orderkey", F.lit("store channel").alias("channel"), F.lit("s").alias("code"),
        F.lit(0).cast("double").alias("zero"), F.to_date(F.lit("20010801"), "yyyyMMdd").alias("as_of"))


@register("proj.star_except", "SELECT * EXCLUDE (l_tax, l_shipdate, l_linestatus) REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem")
def proj_star_except(spark, d):
    return T(spark, d, "lineitem").drop("l_tax", "l_shipdate", "l_linestatus")


@register("proj.arith", f"""
SELECT l_returnflag,
       CAST(((sum({D('l_extendedprice')}) - sum({D('l_extendedprice')} * {D('l_discount')})
              - sum({D('l_tax')} * {D('l_extendedprice')})) + sum({D('l_quantity')})) / 2 AS DOUBLE) AS score
FROM lineitem GROUP BY l_returnflag""")
def proj_arith(spark, d):
    li = T(spark, d, "lineitem")
    p, disc, tax, q = dec("l_extendedprice"), dec("l_discount"), dec("l_tax"), dec("l_quantity")
    return li.groupBy("l_returnflag").agg(
        (((F.sum(p) - F.sum(p * disc) - F.sum(tax * p)) + F.sum(q)) / 2).cast("double").alias("score"))


@register("proj.case_searched", f"""
SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_class,
       count(*) AS n, {DSUM(D('l_extendedprice'))} AS price
FROM lineitem GROUP BY 1""")
def proj_case_searched(spark, d):
    li = T(spark, d, "lineitem")
    cls = (F.when(F.col("l_quantity") < 10, "small").when(F.col("l_quantity") < 30, "medium")
           .otherwise("large"))
    return li.groupBy(cls.alias("size_class")).agg(F.count(F.lit(1)).alias("n"), dsum("l_extendedprice").alias("price"))


@register("proj.case_simple", """
SELECT CASE l_linestatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS status, count(*) AS n
FROM lineitem GROUP BY 1""")
def proj_case_simple(spark, d):
    s = F.when(F.col("l_linestatus") == "O", "open").when(F.col("l_linestatus") == "F", "filled")
    return T(spark, d, "lineitem").groupBy(s.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("proj.if", f"""
SELECT l_linestatus, {DSUM(f"IF(l_returnflag = 'R', {D('l_quantity')}, 0)")} AS returned_qty,
       {DSUM(f"IF(l_returnflag = 'R', 0, {D('l_quantity')})")} AS kept_qty
FROM lineitem GROUP BY l_linestatus""")
def proj_if(spark, d):
    r = F.col("l_returnflag") == "R"
    q = dec("l_quantity")
    return T(spark, d, "lineitem").groupBy("l_linestatus").agg(
        F.sum(F.when(r, q).otherwise(F.lit(0))).cast("double").alias("returned_qty"),
        F.sum(F.when(r, F.lit(0)).otherwise(q)).cast("double").alias("kept_qty"))


@register("proj.decode_type", """
SELECT CASE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) WHEN 1 THEN 'urgent' WHEN 2 THEN 'high'
            WHEN 3 THEN 'medium' ELSE NULL END AS priority_label, count(*) AS n
FROM orders GROUP BY 1""")
def proj_decode_type(spark, d):
    code = F.substring("o_orderpriority", 1, 1).cast("int")
    lab = F.when(code == 1, "urgent").when(code == 2, "high").when(code == 3, "medium")
    return T(spark, d, "orders").groupBy(lab.alias("priority_label")).agg(F.count(F.lit(1)).alias("n"))


# events with sentinels written in, as a weather feed writes 999.9 for "missing"
SQL_SENTINEL_FEED = ("feed AS (SELECT event_type, IF(value > 400, 999.9, value) AS reading, "
                     "IF(value > 400, '999.9', printf('%.2f', value)) AS reading_text FROM events)")


def sentinel_feed(spark, d):
    e = T(spark, d, "events")
    hot = F.col("value") > 400
    return e.select("event_type", F.when(hot, F.lit(999.9)).otherwise(F.col("value")).alias("reading"),
                    F.when(hot, F.lit("999.9")).otherwise(F.format_string("%.2f", "value")).alias("reading_text"))


@register("proj.sentinel_null", f"""
WITH {SQL_SENTINEL_FEED},
c AS (SELECT event_type, IF(reading = 999.9, NULL, reading) AS as_null,
             IF(reading = 999.9, 0, reading) AS as_zero, reading = 999.9 AS was_sentinel,
             IF(reading_text = '999.9', NULL, CAST(reading_text AS DOUBLE)) AS text_as_null FROM feed)
SELECT event_type, {DAVG(D('as_null'))} AS avg_null, {DAVG(D('as_zero'))} AS avg_zero,
       {DAVG(D('text_as_null'))} AS avg_text_null,
       CAST(sum(CAST(was_sentinel AS INTEGER)) AS BIGINT) AS n_sentinel
FROM c GROUP BY event_type""")
def proj_sentinel_null(spark, d):
    f = sentinel_feed(spark, d)
    a = clean.sentinel_to(f.withColumn("as_null", F.col("reading")), {"as_null": (999.9, None)})
    a = clean.sentinel_to(a.withColumn("as_zero", F.col("reading")), {"as_zero": (999.9, 0.0)})
    # a string column: the sentinel is compared as text, before the cast
    a = clean.sentinel_to(a.withColumn("text_as_null", F.col("reading_text")), {"text_as_null": ("999.9", None, "double")})
    return a.groupBy("event_type").agg(
        davg("as_null").alias("avg_null"), davg("as_zero").alias("avg_zero"), davg("text_as_null").alias("avg_text_null"),
        F.sum((F.col("reading") == 999.9).cast("int")).cast("long").alias("n_sentinel"))


@register("proj.distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def proj_distinct(spark, d):
    return T(spark, d, "part").select("p_brand", "p_type").distinct()


# ------------------------------------------------------------------ filters

@register("filt.cmp", f"""
SELECT l_returnflag, count(*) AS n, {DSUM(D('l_extendedprice'))} AS price FROM lineitem
WHERE l_quantity > 1990 - 1950 AND l_discount <> 0.05 AND l_tax <= 0.08 * 0.5 AND l_linestatus = 'F'
GROUP BY l_returnflag""")
def filt_cmp(spark, d):
    li = T(spark, d, "lineitem").filter(
        (F.col("l_quantity") > F.lit(1990) - 1950) & (F.col("l_discount") != 0.05)
        & (F.col("l_tax") <= F.lit(0.08) * 0.5) & (F.col("l_linestatus") == "F"))
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), dsum("l_extendedprice").alias("price"))


@register("filt.between", f"""
WITH a AS (SELECT {DAVG(D('o_totalprice'))} AS m FROM orders)
SELECT o_orderpriority, count(*) AS n FROM orders, a
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-01-01' + INTERVAL 90 DAY
  AND o_totalprice BETWEEN 0.5 * a.m AND 1.5 * a.m
GROUP BY o_orderpriority""")
def filt_between(spark, d):
    o = T(spark, d, "orders")
    m = o.select(davg("o_totalprice")).scalar()
    day = F.to_date("o_orderdate")
    lo = F.lit("1996-01-01").cast("date")
    f = o.filter(day.between(lo, F.date_add(lo, 90)) & F.col("o_totalprice").between(0.5 * m, 1.5 * m))
    return f.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


# Fixed value: a 400-member key list, built by a rule (every 3rd key from 7).
IN_LIST = [7 + 3 * i for i in range(400)]


@register("filt.in_list", f"""
SELECT o_orderstatus, count(*) AS n FROM orders
WHERE o_custkey IN ({', '.join(map(str, IN_LIST))}) AND o_orderpriority IN ('1-URGENT', '2-HIGH')
GROUP BY o_orderstatus""")
def filt_in_list(spark, d):
    o = T(spark, d, "orders").filter(F.col("o_custkey").isin(IN_LIST)
                                     & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("filt.like", """
SELECT p_brand, count(*) AS n FROM part WHERE p_name LIKE 'blue%' OR p_brand LIKE 'Brand#1_'
GROUP BY p_brand""")
def filt_like(spark, d):
    p = T(spark, d, "part").filter(F.col("p_name").like("blue%") | F.col("p_brand").like("Brand#1_"))
    return p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@register("filt.null", """
WITH c AS (SELECT c_nationkey, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer)
SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, count(*) FILTER (WHERE seg IS NULL) AS n_null,
       count(*) FILTER (WHERE seg IS NOT NULL) AS n_not_null
FROM c GROUP BY c_nationkey""")
def filt_null(spark, d):
    c = T(spark, d, "customer").select("c_nationkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    return c.groupBy("c_nationkey").agg(
        F.count(F.when(F.col("seg").isNull(), 1)).alias("n_null"),
        F.count(F.when(F.col("seg").isNotNull(), 1)).alias("n_not_null"))


SQL_DNF_PRED = """
      (p_brand = 'Brand#12' AND p_type IN ('SMALL', 'PROMO') AND l_quantity BETWEEN 1 AND 11 AND p_size BETWEEN 1 AND 5)
   OR (p_brand = 'Brand#23' AND p_type IN ('MEDIUM', 'LARGE') AND l_quantity BETWEEN 10 AND 20 AND p_size BETWEEN 1 AND 10)
   OR (p_brand = 'Brand#34' AND p_type IN ('STANDARD', 'ECONOMY') AND l_quantity BETWEEN 20 AND 30 AND p_size BETWEEN 1 AND 15)"""


@register("filt.dnf", f"""
SELECT l_returnflag, count(*) AS n, {DSUM(NET)} AS revenue
FROM lineitem, part WHERE p_partkey = l_partkey AND ({SQL_DNF_PRED})
GROUP BY l_returnflag""")
def filt_dnf(spark, d):
    li, p = T(spark, d, "lineitem"), T(spark, d, "part")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey")).filter(F.expr(SQL_DNF_PRED))
    return j.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), dsum(net()).alias("revenue"))


@register("filt.string_date", """
SELECT l_linestatus, count(*) AS n FROM lineitem
WHERE CAST(l_shipdate AS DATE) >= CAST('1998-01-01' AS DATE)
  AND CAST(l_shipdate AS DATE) < CAST('1998-01-01' AS DATE) + INTERVAL 30 DAY
GROUP BY l_linestatus""")
def filt_string_date(spark, d):
    day = F.to_date("l_shipdate")
    lo = F.to_date(F.lit("1998-01-01"))
    return (T(spark, d, "lineitem").filter((day >= lo) & (day < F.date_add(lo, 30)))
            .groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n")))


@register("clean.nan", f"""
WITH feed AS (SELECT event_type, IF(value > 400, 'NaN'::DOUBLE, value) AS v FROM events)
SELECT event_type, count(*) AS n, {DAVG(D('v'))} AS avg_v FROM feed WHERE NOT isnan(v) GROUP BY event_type""")
def clean_nan(spark, d):
    e = T(spark, d, "events").select(
        "event_type", F.when(F.col("value") > 400, F.lit(float("nan"))).otherwise(F.col("value")).alias("v"))
    e = clean.drop_nan(e, "v")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), davg("v").alias("avg_v"))


@register("clean.dropna", """
WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg, nullif(c_nationkey, 3) AS nk FROM customer)
SELECT count(*) AS n_complete FROM c WHERE seg IS NOT NULL AND nk IS NOT NULL""")
def clean_dropna(spark, d):
    c = T(spark, d, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"),
        F.nullif("c_nationkey", F.lit(3)).alias("nk"))
    return clean.dropna(c).agg(F.count(F.lit(1)).alias("n_complete"))


# ------------------------------------------------------------------ §2.3 joins

@register("join.inner_equi", f"""
SELECT o_orderpriority, count(*) AS n, {DSUM(NET)} AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def join_inner_equi(spark, d):
    j = T(spark, d, "lineitem").join(T(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), dsum(net()).alias("revenue"))


@register("join.star", f"""
SELECT r_name, p_type, count(*) AS n, {DSUM(NET)} AS revenue
FROM lineitem, orders, customer, nation, region, part, supplier
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey
  AND n_regionkey = r_regionkey AND l_partkey = p_partkey AND l_suppkey = s_suppkey
GROUP BY r_name, p_type""")
def join_star(spark, d):
    li, o, c = T(spark, d, "lineitem"), T(spark, d, "orders"), T(spark, d, "customer")
    n, r = F.broadcast(T(spark, d, "nation")), F.broadcast(T(spark, d, "region"))
    p, s = T(spark, d, "part"), T(spark, d, "supplier")
    # orders shrink to (order, region) before they meet the lines, lines to (region, part) before they meet parts
    home = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("c_custkey", "r_name")
    geo = o.join(home, o.o_custkey == home.c_custkey).select("o_orderkey", "r_name")
    lines = li.join(s, li.l_suppkey == s.s_suppkey, "left_semi").join(geo, li.l_orderkey == geo.o_orderkey)
    per_part = lines.groupBy("r_name", "l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum(net()).alias("revenue"))
    return per_part.join(p, per_part.l_partkey == p.p_partkey).groupBy("r_name", "p_type").agg(
        F.sum("n").alias("n"), F.sum("revenue").cast("double").alias("revenue"))


@register("join.role_playing", f"""
SELECT n1.n_name AS supp_nation, n2.n_name AS cust_nation, count(*) AS n, {DSUM(NET)} AS revenue
FROM lineitem, orders, customer, supplier, nation n1, nation n2
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND l_suppkey = s_suppkey
  AND s_nationkey = n1.n_nationkey AND c_nationkey = n2.n_nationkey AND n1.n_name <> n2.n_name
GROUP BY 1, 2""")
def join_role_playing(spark, d):
    li, o, c, s = (T(spark, d, x) for x in ("lineitem", "orders", "customer", "supplier"))
    nat = T(spark, d, "nation")
    n1 = F.broadcast(nat.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("supp_nation")))
    n2 = F.broadcast(nat.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cust_nation")))
    buyers = o.join(c.join(n2, F.col("c_nationkey") == F.col("cn_key")), o.o_custkey == c.c_custkey).select("o_orderkey", "cust_nation")
    sellers = s.join(n1, F.col("s_nationkey") == F.col("sn_key")).select("s_suppkey", "supp_nation")
    j = (li.join(sellers, li.l_suppkey == sellers.s_suppkey).join(buyers, li.l_orderkey == buyers.o_orderkey)
           .filter(F.col("supp_nation") != F.col("cust_nation")))
    return j.groupBy("supp_nation", "cust_nation").agg(F.count(F.lit(1)).alias("n"), dsum(net()).alias("revenue"))


@register("join.left", f"""
WITH q AS (SELECT l_partkey, {DSUM(D('l_quantity'))} AS qty FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey)
SELECT p_partkey, p_brand, coalesce(qty, 0) AS returned_qty FROM part LEFT JOIN q ON p_partkey = l_partkey""")
def join_left(spark, d):
    q = (T(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
         .groupBy("l_partkey").agg(dsum("l_quantity").alias("qty")))
    p = T(spark, d, "part")
    j = p.join(q, p.p_partkey == q.l_partkey, "left")
    return j.select("p_partkey", "p_brand", F.coalesce("qty", F.lit(0.0)).alias("returned_qty"))


@register("join.left_then_filter", """
SELECT o_orderstatus, count(*) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
WHERE l_returnflag = 'R' GROUP BY o_orderstatus""")
def join_left_then_filter(spark, d):
    o, li = T(spark, d, "orders"), T(spark, d, "lineitem")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left").filter(F.col("l_returnflag") == "R")
    return j.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("join.full", """
WITH s AS (SELECT DISTINCT o_custkey AS ck, l_partkey AS pk FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           WHERE l_returnflag = 'N'),
     c AS (SELECT DISTINCT o_custkey AS ck, l_partkey AS pk FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           WHERE l_returnflag = 'A')
SELECT CAST(sum(CASE WHEN s.ck IS NOT NULL AND c.ck IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS store_only,
       CAST(sum(CASE WHEN s.ck IS NULL AND c.ck IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS catalog_only,
       CAST(sum(CASE WHEN s.ck IS NOT NULL AND c.ck IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS store_and_catalog
FROM s FULL OUTER JOIN c ON s.ck = c.ck AND s.pk = c.pk""")
def join_full(spark, d):
    li, o = T(spark, d, "lineitem"), T(spark, d, "orders")
    lo = li.join(o, li.l_orderkey == o.o_orderkey)

    def pairs(flag, tag):
        return (lo.filter(F.col("l_returnflag") == flag)
                .select(F.col("o_custkey").alias("ck"), F.col("l_partkey").alias("pk")).distinct()
                .withColumn(tag, F.lit(1)))
    j = pairs("N", "in_s").join(pairs("A", "in_c"), ["ck", "pk"], "full")
    s_, c_ = F.col("in_s").isNotNull(), F.col("in_c").isNotNull()
    return j.agg(F.sum(F.when(s_ & ~c_, 1).otherwise(0)).cast("long").alias("store_only"),
                 F.sum(F.when(~s_ & c_, 1).otherwise(0)).cast("long").alias("catalog_only"),
                 F.sum(F.when(s_ & c_, 1).otherwise(0)).cast("long").alias("store_and_catalog"))


@register("join.anti_null", """
SELECT c_mktsegment, count(*) AS n_without_urgent
FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') u ON c_custkey = o_custkey
WHERE o_orderkey IS NULL GROUP BY c_mktsegment""")
def join_anti_null(spark, d):
    c, o = T(spark, d, "customer"), T(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    a = rel.anti(c, o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    return a.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_without_urgent"))


@register("join.semi_in", f"""
SELECT o_orderpriority, count(*) AS n, {DSUM(D('o_totalprice'))} AS total FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN
        (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')))
GROUP BY o_orderpriority""")
def join_semi_in(spark, d):
    r = T(spark, d, "region").filter(F.col("r_name") == "ASIA")
    n = T(spark, d, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    c = T(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    o = T(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), dsum("o_totalprice").alias("total"))


SQL_SEMI_IN_OR = """
SELECT l_returnflag, count(*) AS n FROM lineitem
WHERE substr(CAST(l_suppkey AS VARCHAR), 1, 1) IN ('1', '2')
   OR l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45)
GROUP BY l_returnflag"""


@register("join.semi_in_or", SQL_SEMI_IN_OR)
def join_semi_in_or(spark, d):
    # IN-subquery inside OR: Catalyst plans an ExistenceJoin
    return query(spark, d, SQL_SEMI_IN_OR.replace("VARCHAR", "STRING"), ("lineitem", "part"))


@register("join.exists", """
SELECT l1.l_linestatus, count(*) AS n FROM lineitem l1
WHERE EXISTS (SELECT 1 FROM lineitem l2 WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey)
GROUP BY l1.l_linestatus""")
def join_exists(spark, d):
    l1 = T(spark, d, "lineitem").alias("l1")
    l2 = T(spark, d, "lineitem").select(F.col("l_orderkey").alias("k2"), F.col("l_suppkey").alias("s2"))
    j = l1.join(l2, (F.col("l1.l_orderkey") == F.col("k2")) & (F.col("l1.l_suppkey") != F.col("s2")), "left_semi")
    return j.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@register("join.not_exists", """
SELECT l1.l_linestatus, count(*) AS n FROM lineitem l1
WHERE EXISTS (SELECT 1 FROM lineitem l2 WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey)
  AND NOT EXISTS (SELECT 1 FROM lineitem l3 WHERE l3.l_orderkey = l1.l_orderkey
                  AND l3.l_suppkey <> l1.l_suppkey AND l3.l_returnflag = 'R')
GROUP BY l1.l_linestatus""")
def join_not_exists(spark, d):
    li = T(spark, d, "lineitem")
    l1 = li.alias("l1")
    other = li.select(F.col("l_orderkey").alias("k2"), F.col("l_suppkey").alias("s2"), F.col("l_returnflag").alias("f2"))
    cond = (F.col("l1.l_orderkey") == F.col("k2")) & (F.col("l1.l_suppkey") != F.col("s2"))
    j = l1.join(other, cond, "left_semi").join(other.filter(F.col("f2") == "R"), cond, "left_anti")
    return j.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"))


SQL_EXISTS_OR = """
SELECT c_mktsegment, count(*) AS n FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o.o_orderdate) = 1996)
  AND (EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o.o_orderdate) = 1997)
       OR EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o.o_orderdate) = 1998))
GROUP BY c_mktsegment"""


@register("join.exists_or", SQL_EXISTS_OR)
def join_exists_or(spark, d):
    # the three EXISTS as three flags of one aggregate: orders is read once, with the dates pushed to the scan
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    start = {y: F.lit(f"{y}-01-01").cast("date") for y in range(1996, 2000)}
    day = F.col("o_orderdate")
    flags = o.filter((day >= start[1996]) & (day < start[1999])).groupBy("o_custkey").agg(
        *[F.max((day >= start[y]) & (day < start[y + 1])).alias(f"in_{y}") for y in range(1996, 1999)])
    found = flags.filter("in_1996 AND (in_1997 OR in_1998)")
    return c.join(found, c.c_custkey == found.o_custkey, "left_semi").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@register("join.self_offset", f"""
WITH y AS (SELECT o_custkey, year(o_orderdate) AS yr, {DSUM(D('o_totalprice'))} AS total
           FROM orders GROUP BY 1, 2)
SELECT a.yr, count(*) AS n_growing FROM y a JOIN y b ON a.o_custkey = b.o_custkey AND b.yr = a.yr + 1
WHERE b.total > a.total GROUP BY a.yr""")
def join_self_offset(spark, d):
    y = (T(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("yr"))
         .agg(dsum("o_totalprice").alias("total")))
    j = rel.compare_periods(y, ["o_custkey"], "yr", ["total"], offset=1)
    return j.filter(F.col("total_next") > F.col("total")).groupBy("yr").agg(F.count(F.lit(1)).alias("n_growing"))


@register("join.self_theta", """
SELECT count(DISTINCT l1.l_orderkey) AS n_multi_supplier_orders
FROM lineitem l1 JOIN lineitem l2 ON l1.l_orderkey = l2.l_orderkey AND l1.l_suppkey <> l2.l_suppkey""")
def join_self_theta(spark, d):
    # same answer without emitting line pairs: an order has two suppliers
    # exactly when its min and max supplier differ
    per = T(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("a"), F.max("l_suppkey").alias("b"))
    return per.filter(F.col("a") != F.col("b")).agg(F.count(F.lit(1)).alias("n_multi_supplier_orders"))


@register("join.theta_residual", """
SELECT o_orderpriority, count(*) AS n FROM lineitem JOIN orders
  ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate + INTERVAL 5 DAY AND l_extendedprice <= 0.1 * o_totalprice
GROUP BY o_orderpriority""")
def join_theta_residual(spark, d):
    li, o = T(spark, d, "lineitem"), T(spark, d, "orders")
    cond = ((li.l_orderkey == o.o_orderkey)
            & (li.l_shipdate > o.o_orderdate + F.expr("INTERVAL 5 DAYS"))
            & (li.l_extendedprice <= 0.1 * o.o_totalprice))
    return li.join(o, cond).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@register("join.expr_key", """
WITH s AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n_ship FROM lineitem GROUP BY 1),
     o AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_ord FROM orders GROUP BY 1)
SELECT year(s.d) AS yr, CAST(sum(n_ship * n_ord) AS BIGINT) AS same_day_pairs, count(*) AS days
FROM s JOIN o ON s.d = o.d GROUP BY 1""")
def join_expr_key(spark, d):
    # join on DATE(ts) = DATE(ts): aggregate both sides to the derived key first
    s = T(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(F.count(F.lit(1)).alias("n_ship"))
    o = T(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n_ord"))
    return s.join(o, "d").groupBy(F.year("d").alias("yr")).agg(
        F.sum(F.col("n_ship") * F.col("n_ord")).cast("long").alias("same_day_pairs"),
        F.count(F.lit(1)).alias("days"))


# The six quantity bands of the source query.
BANDS = [(0, 5), (6, 10), (11, 15), (16, 20), (21, 25), (26, 30)]


def _band_sql(i, lo, hi):
    return (f"(SELECT {DAVG(D('l_extendedprice'))} AS b{i}_avg, count(l_extendedprice) AS b{i}_cnt, "
            f"count(DISTINCT l_extendedprice) AS b{i}_cntd FROM lineitem "
            f"WHERE l_quantity BETWEEN {lo} AND {hi} AND l_discount BETWEEN 0.02 AND 0.08) b{i}")


@register("join.cross_scalar", "SELECT * FROM " + ", ".join(_band_sql(i, lo, hi) for i, (lo, hi) in enumerate(BANDS)))
def join_cross_scalar(spark, d):
    li = T(spark, d, "lineitem").filter(F.col("l_discount").between(0.02, 0.08))
    # the bands are disjoint, so one grouped aggregate replaces six scans (or six distinct aggregates)
    bands = {f"b{i}": F.col("l_quantity").between(lo, hi) for i, (lo, hi) in enumerate(BANDS)}
    return rel.band_scalars(li, bands, {
        "avg": lambda: davg("l_extendedprice"),
        "cnt": lambda: F.count("l_extendedprice"),
        "cntd": lambda: F.countDistinct("l_extendedprice"),
    })


@register("join.cross_rows", """
WITH a AS (SELECT l_returnflag, count(*) AS n_flag FROM lineitem GROUP BY 1),
     b AS (SELECT l_linestatus, count(*) AS n_status FROM lineitem GROUP BY 1)
SELECT * FROM a CROSS JOIN b""")
def join_cross_rows(spark, d):
    li = T(spark, d, "lineitem")
    a = li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_flag"))
    b = li.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n_status"))
    # both sides are bounded by the number of distinct flags / statuses
    return a.crossJoin(b)


@register("join.multi_fact", f"""
WITH lo AS (SELECT o_custkey, l_partkey, l_returnflag, l_quantity, l_extendedprice
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT s.l_partkey % 10 AS part_bucket, count(*) AS n, min(s.l_quantity) AS min_sold_qty,
       {DSUM(D('r.l_extendedprice'))} AS returned_value
FROM lo s JOIN lo r ON s.o_custkey = r.o_custkey AND s.l_partkey = r.l_partkey
JOIN lo c ON c.o_custkey = s.o_custkey AND c.l_partkey = s.l_partkey
WHERE s.l_returnflag = 'N' AND r.l_returnflag = 'R' AND c.l_returnflag = 'A'
GROUP BY 1""")
def join_multi_fact(spark, d):
    li, o = T(spark, d, "lineitem"), T(spark, d, "orders")
    lo = li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_partkey", "l_returnflag", "l_quantity",
                                                         "l_extendedprice")
    s = lo.filter("l_returnflag = 'N'").select("o_custkey", "l_partkey", F.col("l_quantity").alias("sq"))
    r = lo.filter("l_returnflag = 'R'").select("o_custkey", "l_partkey", F.col("l_extendedprice").alias("rv"))
    c = lo.filter("l_returnflag = 'A'").select("o_custkey", "l_partkey")
    j = s.join(r, ["o_custkey", "l_partkey"]).join(c, ["o_custkey", "l_partkey"])
    return j.groupBy((F.col("l_partkey") % 10).alias("part_bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("sq").alias("min_sold_qty"), dsum("rv").alias("returned_value"))


@register("join.channel_union", f"""
WITH ch AS (
  SELECT 'store' AS channel, l_partkey, {NET} AS rev FROM lineitem WHERE l_returnflag = 'N'
  UNION ALL SELECT 'catalog', l_partkey, {NET} FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL SELECT 'web', l_partkey, {NET} FROM lineitem WHERE l_returnflag = 'R'),
per AS (SELECT channel, p_brand, sum(rev) AS rev FROM ch JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT p_brand, CAST(sum(rev) AS DOUBLE) AS total_rev, count(*) AS n_channels FROM per GROUP BY p_brand""")
def join_channel_union(spark, d):
    li, p = T(spark, d, "lineitem"), T(spark, d, "part")
    channels = {"store": li.filter("l_returnflag = 'N'"), "catalog": li.filter("l_returnflag = 'A'"),
                "web": li.filter("l_returnflag = 'R'")}

    def build(_, df):
        j = df.join(p, df.l_partkey == p.p_partkey)
        return j.groupBy("p_brand").agg(F.sum(net()).alias("rev"))
    u = rel.union_channels(channels, build)
    return u.groupBy("p_brand").agg(F.sum("rev").cast("double").alias("total_rev"),
                                    F.count(F.lit(1)).alias("n_channels"))


# ------------------------------------------------------------------ subqueries

@register("sub.scalar", f"""
SELECT l_returnflag, count(*) AS n FROM lineitem
WHERE l_extendedprice > (SELECT 1.2 * {DAVG(D('l_extendedprice'))} FROM lineitem) GROUP BY l_returnflag""")
def sub_scalar(spark, d):
    li = T(spark, d, "lineitem")
    avg = li.select(1.2 * davg("l_extendedprice")).scalar()
    return li.filter(F.col("l_extendedprice") > avg).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@register("sub.scalar_corr", f"""
WITH t AS (SELECT o_custkey, c_nationkey, sum({D('o_totalprice')}) AS total
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, count(*) AS n_big FROM t a
WHERE CAST(total AS DOUBLE) > (SELECT 1.2 * {DAVG('b.total')} FROM t b WHERE b.c_nationkey = a.c_nationkey)
GROUP BY c_nationkey""")
def sub_scalar_corr(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    t = (o.join(c, o.o_custkey == c.c_custkey).groupBy("o_custkey", "c_nationkey")
         .agg(F.sum(dec("o_totalprice")).alias("total")))
    # decorrelated: the group's own average, joined back on the correlation key
    avg = t.groupBy("c_nationkey").agg((1.2 * davg(F.col("total"))).alias("lim"))
    j = t.join(avg, "c_nationkey").filter(F.col("total").cast("double") > F.col("lim"))
    return j.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_big"))


SQL_SCALAR_CORR_COUNT = """
SELECT DISTINCT p_brand FROM part p1
WHERE p_size BETWEEN 10 AND 20
  AND (SELECT count(*) FROM part p2 WHERE p2.p_brand = p1.p_brand
       AND ((p2.p_type = 'PROMO' AND p2.p_size > 45) OR (p2.p_type = 'SMALL' AND p2.p_retailprice < 905))) > 0"""


@register("sub.scalar_corr_count", SQL_SCALAR_CORR_COUNT)
def sub_scalar_corr_count(spark, d):
    p = T(spark, d, "part")
    hit = p.filter(((F.col("p_type") == "PROMO") & (F.col("p_size") > 45))
                   | ((F.col("p_type") == "SMALL") & (F.col("p_retailprice") < 905))).select("p_brand")
    return p.filter(F.col("p_size").between(10, 20)).join(hit, "p_brand", "left_semi").select("p_brand").distinct()


@register("sub.scalar_select", f"""
SELECT CASE WHEN (SELECT count(*) FROM lineitem WHERE l_quantity BETWEEN 1 AND 20) > 10000
            THEN (SELECT {DAVG(D('l_extendedprice'))} FROM lineitem WHERE l_quantity BETWEEN 1 AND 20)
            ELSE (SELECT {DAVG(D('l_tax'))} FROM lineitem WHERE l_quantity BETWEEN 1 AND 20) END AS bucket1,
       CASE WHEN (SELECT count(*) FROM lineitem WHERE l_quantity BETWEEN 21 AND 40) > 100000
            THEN (SELECT {DAVG(D('l_extendedprice'))} FROM lineitem WHERE l_quantity BETWEEN 21 AND 40)
            ELSE (SELECT {DAVG(D('l_tax'))} FROM lineitem WHERE l_quantity BETWEEN 21 AND 40) END AS bucket2""")
def sub_scalar_select(spark, d):
    li = T(spark, d, "lineitem")
    outs = []
    for i, (lo, hi, thr) in enumerate([(1, 20, 10000), (21, 40, 100000)], start=1):
        p = F.col("l_quantity").between(lo, hi)
        cnt = F.count(F.when(p, 1))
        outs.append(F.when(cnt > thr, davg(F.when(p, dec("l_extendedprice"))))
                    .otherwise(davg(F.when(p, dec("l_tax")))).alias(f"bucket{i}"))
    # one scan with conditional aggregates instead of six scalar subqueries
    return li.agg(*outs)


@register("sub.cte", f"""
WITH rev AS (SELECT o_custkey, {DSUM(D('o_totalprice'))} AS total FROM orders GROUP BY o_custkey),
     top AS (SELECT max(total) AS mx FROM rev)
SELECT o_custkey, total FROM rev, top WHERE total >= 0.8 * mx""")
def sub_cte(spark, d):
    rev = T(spark, d, "orders").groupBy("o_custkey").agg(dsum("o_totalprice").alias("total"))
    mx = rev.select(F.max("total")).scalar()  # the CTE is referenced twice; Spark reuses the exchange
    return rev.filter(F.col("total") >= 0.8 * mx)
