"""Relational core: scans, projections, filters, joins, aggregates, set
operations, subqueries, sort and limit, on the base tables.

Entity mapping used throughout (reference entity -> table here):
customers/orders/order_details/products -> customer/orders/lineitem/part;
categories -> p_type; units in stock -> p_size; discontinued -> p_size % 7 = 0;
freight -> o_totalprice; employees' manager tree -> (c_custkey - 1) div 3.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..operators import joins, rollup, sampling, setops, subqueries
from ..operators.range_join import range_join
from ..operators.windows import asc, desc, distinct_on
from ..sources.tables import Tables
from . import sqltext as q
from .registry import query

# ----------------------------------------------------------------- scans


@query("scan_region", "SELECT * FROM region")
def scan_region(spark, d):
    return Tables(spark, d).region


# ----------------------------------------------------------- projections


@query("proj_customer", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def proj_customer(spark, d):
    return Tables(spark, d).customer.select("c_custkey", "c_name", "c_nationkey")


@query("proj_rename_price", "SELECT p_partkey, p_name, p_retailprice AS price_in_usd FROM part")
def proj_rename_price(spark, d):
    return Tables(spark, d).part.select("p_partkey", "p_name", F.col("p_retailprice").alias("price_in_usd"))


@query("distinct_part_size", "SELECT DISTINCT p_size FROM part")
def distinct_part_size(spark, d):
    return Tables(spark, d).part.select("p_size").distinct()


@query("distinct_rows_li", "SELECT DISTINCT * FROM lineitem")
def distinct_rows_li(spark, d):
    return Tables(spark, d).lineitem.distinct()


# Stock status labels (0 -> Out of Stock, < 20 -> Low Stock, else In Stock).
_STOCK_SQL = """
SELECT p_partkey, p_size AS units_in_stock,
       CASE WHEN p_size = 0 THEN 'Out of Stock' WHEN p_size < 20 THEN 'Low Stock'
            ELSE 'In Stock' END AS stock_status
FROM part"""


@query("case_stock_status", _STOCK_SQL)
def case_stock_status(spark, d):
    p = Tables(spark, d).part
    status = (F.when(F.col("p_size") == 0, "Out of Stock").when(F.col("p_size") < 20, "Low Stock")
               .otherwise("In Stock"))
    return p.select("p_partkey", F.col("p_size").alias("units_in_stock"), status.alias("stock_status"))


# Status codes 1 -> GDM, 0 -> Non-GDM, otherwise Unknown; flags Yes / No / Unknown.
@query("case_code_label", """
SELECT p_partkey, code,
       CASE WHEN code = 1 THEN 'GDM' WHEN code = 0 THEN 'Non-GDM' ELSE 'Unknown' END AS status_label,
       CASE WHEN code = 1 THEN 'Yes' WHEN code = 0 THEN 'No' ELSE 'Unknown' END AS yes_no
FROM (SELECT p_partkey,
             CASE WHEN p_size % 7 = 0 THEN 1 WHEN p_size % 7 = 1 THEN 0 END AS code
      FROM part) t""")
def case_code_label(spark, d):
    p = Tables(spark, d).part
    code = F.when(F.col("p_size") % 7 == 0, F.lit(1)).when(F.col("p_size") % 7 == 1, F.lit(0))
    t = p.select("p_partkey", code.alias("code"))
    return t.select("p_partkey", "code",
                    fx.code_label("code", {1: "GDM", 0: "Non-GDM"}, "Unknown").alias("status_label"),
                    fx.yes_no("code").alias("yes_no"))


def price_category(col="p_retailprice"):
    # Price bands Low < 920 <= Medium <= 950 < High (the
    # reference's 20 / 50 bands moved onto this table's 900-2000 price range).
    c = F.col(col)
    return F.when(c < 920.0, "Low").when(c <= 950.0, "Medium").when(c > 950.0, "High")


_PRICE_CASE = ("CASE WHEN p_retailprice < 920.0 THEN 'Low' WHEN p_retailprice <= 950.0 THEN 'Medium' "
               "WHEN p_retailprice > 950.0 THEN 'High' END")


@query("band_price", f"SELECT p_partkey, p_retailprice, {_PRICE_CASE} AS price_category FROM part")
def band_price(spark, d):
    p = Tables(spark, d).part
    return p.select("p_partkey", "p_retailprice", price_category().alias("price_category"))


@query("distinct_on_brand", """
SELECT DISTINCT ON (p_brand) p_brand, p_partkey, p_name, p_retailprice
FROM part ORDER BY p_brand, p_retailprice DESC, p_partkey""")
def distinct_on_brand(spark, d):
    p = Tables(spark, d).part.select("p_brand", "p_partkey", "p_name", "p_retailprice")
    return distinct_on(p, ["p_brand"], [desc("p_retailprice"), asc("p_partkey")])


@query("proj_quoted_names", """
SELECT * FROM (SELECT l_orderkey, l_linenumber, l_quantity AS "0H_quantity", l_tax AS "US Tax",
                      l_discount AS "Rebate 10" FROM lineitem) t""")
def proj_quoted_names(spark, d):
    li = Tables(spark, d).lineitem
    t = li.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("0H_quantity"),
                  F.col("l_tax").alias("US Tax"), F.col("l_discount").alias("Rebate 10"))
    return t.select("l_orderkey", "l_linenumber", "`0H_quantity`", "`US Tax`", "`Rebate 10`")


# --------------------------------------------------------------- filters


@query("filter_eq_segment",
       "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq_segment(spark, d):
    c = Tables(spark, d).customer
    return c.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name", "c_mktsegment")


@query("filter_or", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment = 'MACHINERY' OR c_mktsegment = 'AUTOMOBILE'""")
def filter_or(spark, d):
    c = Tables(spark, d).customer
    return (c.where((F.col("c_mktsegment") == "MACHINERY") | (F.col("c_mktsegment") == "AUTOMOBILE"))
             .select("c_custkey", "c_mktsegment"))


@query("filter_and", """
SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size % 7 <> 0 AND p_retailprice > 950""")
def filter_and(spark, d):
    p = Tables(spark, d).part
    return (p.where((F.col("p_size") % 7 != 0) & (F.col("p_retailprice") > 950))
             .select("p_partkey", "p_name", "p_retailprice"))


@query("filter_gt_price", """
SELECT p_partkey, p_type, p_size, p_retailprice FROM part
WHERE p_retailprice > 990 AND p_type <> 'PROMO' AND p_size >= 10""")
def filter_gt_price(spark, d):
    p = Tables(spark, d).part
    return (p.where((F.col("p_retailprice") > 990) & (F.col("p_type") != "PROMO") & (F.col("p_size") >= 10))
             .select("p_partkey", "p_type", "p_size", "p_retailprice"))


@query("filter_nulls", f"""
SELECT o_orderkey, {q.day('o_orderdate')} AS order_date, s.last_ship
FROM orders LEFT JOIN (SELECT l_orderkey, max({q.day('l_shipdate')}) AS last_ship
                       FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o_orderkey
WHERE s.last_ship IS NULL""")
def filter_nulls(spark, d):
    t = Tables(spark, d)
    ship = t.lineitem.groupBy("l_orderkey").agg(F.max(fx.to_day("l_shipdate")).alias("last_ship"))
    o = t.orders.select("o_orderkey", fx.to_day("o_orderdate").alias("order_date"))
    j = o.join(ship, o.o_orderkey == ship.l_orderkey, "left")
    return j.where(F.col("last_ship").isNull()).select("o_orderkey", "order_date", "last_ship")


@query("filter_in", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def filter_in(spark, d):
    o = Tables(spark, d).orders
    return o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("filter_not_in", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (1, 5, 10)")
def filter_not_in(spark, d):
    c = Tables(spark, d).customer
    # The reference compares an integer key with text literals; cast them once.
    codes = [int(x) for x in ("1", "5", "10")]
    return c.where(~F.col("c_nationkey").isin(codes)).select("c_custkey", "c_nationkey")


def _date_range(col: str, lo: str, hi_exclusive: str):
    """Sargable range on a timestamp column (pushed into the Parquet scan)."""
    c = F.col(col)
    return (c >= F.lit(lo).cast("timestamp_ntz")) & (c < F.lit(hi_exclusive).cast("timestamp_ntz"))


@query("filter_between_dates", f"""
SELECT o_orderkey, {q.day('o_orderdate')} AS order_date FROM orders
WHERE {q.day('o_orderdate')} BETWEEN DATE '1996-07-01' AND DATE '1996-12-31'""")
def filter_between_dates(spark, d):
    o = Tables(spark, d).orders
    # BETWEEN '07/01/1996' AND '12/31/1996' on the date: same rows as the
    # half-open timestamp range, which the scan can use.
    return (o.where(_date_range("o_orderdate", "1996-07-01", "1997-01-01"))
             .select("o_orderkey", fx.to_day("o_orderdate").alias("order_date")))


@query("filter_like_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'b%'")
def filter_like_prefix(spark, d):
    p = Tables(spark, d).part
    return p.where(F.col("p_name").like("b%")).select("p_partkey", "p_name")


@query("filter_year_compound", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
WHERE year(o_orderdate) = 1997 AND (o_totalprice > 300000 OR o_orderstatus = 'F')""")
def filter_year_compound(spark, d):
    o = Tables(spark, d).orders
    return (o.where(_date_range("o_orderdate", "1997-01-01", "1998-01-01")
                    & ((F.col("o_totalprice") > 300000) | (F.col("o_orderstatus") == "F")))
             .select("o_orderkey", "o_totalprice", "o_orderstatus"))


@query("exists_big_orders", """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)""")
def exists_big_orders(spark, d):
    t = Tables(spark, d)
    big = t.orders.where(F.col("o_totalprice") > 450000).select("o_custkey")
    c = t.customer.select("c_custkey", "c_name")
    return subqueries.exists_where(c, big, c.c_custkey == big.o_custkey)


# ----------------------------------------------------------------- joins


@query("join_inner_order_customer", f"""
SELECT o_orderkey, c_name, {q.day('o_orderdate')} AS order_date
FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner_order_customer(spark, d):
    t = Tables(spark, d)
    o, c = t.orders, t.customer
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name",
                                                        fx.to_day("o_orderdate").alias("order_date"))


@query("join_inner_4way", """
SELECT c_name, o_orderkey, l_linenumber, p_name, l_quantity
FROM customer JOIN orders ON o_custkey = c_custkey
JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey""")
def join_inner_4way(spark, d):
    t = Tables(spark, d)
    c = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    o = t.orders.select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"))
    li = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), F.col("l_partkey").alias("partkey"),
                           "l_linenumber", "l_quantity")
    p = t.part.select(F.col("p_partkey").alias("partkey"), "p_name")
    j = joins.chain([c, o, li, p], ["custkey", "orderkey", "partkey"])
    return j.select("c_name", F.col("orderkey").alias("o_orderkey"), "l_linenumber", "p_name", "l_quantity")


@query("join_left_chain", """
SELECT o_orderkey, l_linenumber, p_name, s_name || ' (' || n_name || ')' AS supplier_label, r_name
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def join_left_chain(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = t.part.select("p_partkey", "p_name")
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region
    # Suppliers get their nation and region first, so the order lines are joined once with all three.
    places = (s.join(n, F.col("n_nationkey") == F.col("s_nationkey"), "left")
               .join(r, F.col("r_regionkey") == F.col("n_regionkey"), "left"))
    j = (o.join(li, o.o_orderkey == li.l_orderkey, "left")
          .join(p, F.col("p_partkey") == F.col("l_partkey"), "left")
          .join(places, F.col("s_suppkey") == F.col("l_suppkey"), "left"))
    return j.select("o_orderkey", "l_linenumber", "p_name",
                    fx.pg_concat("s_name", F.lit(" ("), "n_name", F.lit(")")).alias("supplier_label"),
                    "r_name")


@query("join_right_part", """
SELECT p_partkey, p_name, l_orderkey, l_quantity
FROM lineitem RIGHT JOIN part ON l_partkey + 10 = p_partkey""")
def join_right_part(spark, d):
    """Every part with the order lines of the part it replaced (its number is
    ten lower); the first ten parts replaced none."""
    t = Tables(spark, d)
    li = t.lineitem.select((F.col("l_partkey") + 10).alias("successor"), "l_orderkey", "l_quantity")
    p = t.part.select("p_partkey", "p_name")
    return li.join(p, li.successor == p.p_partkey, "right").select("p_partkey", "p_name", "l_orderkey",
                                                                   "l_quantity")


# The category table of the full-outer-join example (one
# category without products, and PROMO products without a category).
CATEGORIES = [
    ("ECONOMY", "Budget range"),
    ("LARGE", "Bulky goods"),
    ("MEDIUM", "Standard sizes"),
    ("SMALL", "Compact goods"),
    ("STANDARD", "Core range"),
    ("TOY", "Games and toys"),
]
_CATEGORY_VALUES = ", ".join(f"('{a}', '{b}')" for a, b in CATEGORIES)


@query("join_full_outer", f"""
SELECT p_partkey, COALESCE(p.p_type, c.category) AS category, c.description
FROM part p FULL OUTER JOIN (VALUES {_CATEGORY_VALUES}) AS c(category, description)
ON p.p_type = c.category""")
def join_full_outer(spark, d):
    cats = spark.createDataFrame(CATEGORIES, "category string, description string")
    p = Tables(spark, d).part.select("p_partkey", "p_type")
    # The category table is the fixed list above, so its broadcast is bounded.
    j = joins.full_outer_lookup(p, F.broadcast(cats), "category", left_key="p_type", right_key="category")
    return j.select("p_partkey", "category", "description")


@query("join_cross_nation_region", "SELECT n_name, r_name FROM nation CROSS JOIN region")
def join_cross_nation_region(spark, d):
    t = Tables(spark, d)
    # region has a fixed five rows: broadcasting it is bounded by the schema.
    return t.nation.select("n_name").crossJoin(F.broadcast(t.region.select("r_name")))


def manager_of(col="c_custkey"):
    """Parent in the reference's employee tree: root 0, then three reports each."""
    return F.when(F.col(col) == 0, F.lit(None)).otherwise(F.expr(f"({col} - 1) div 3")).cast("long")


_MANAGER_SQL = "CASE WHEN c_custkey = 0 THEN NULL ELSE (c_custkey - 1) // 3 END"


@query("join_self_parent", f"""
SELECT e.c_custkey, e.c_name, e.manager_key, m.c_name AS manager_name
FROM (SELECT c_custkey, c_name, {_MANAGER_SQL} AS manager_key FROM customer) e
LEFT JOIN customer m ON m.c_custkey = e.manager_key""")
def join_self_parent(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_name", manager_of().alias("manager_key"))
    j = joins.self_parent(c, "c_custkey", "manager_key", ["c_name"], prefix="manager_")
    return j.select("c_custkey", "c_name", "manager_key", F.col("manager_c_name").alias("manager_name"))


def ship_via():
    """A nullable payload: LOW-priority orders have no shipping choice."""
    return F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(
        F.substring("o_orderpriority", 1, 1).cast("int"))


@query("join_left_is_null", """
SELECT c_custkey, o_orderkey
FROM customer LEFT JOIN (SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL
            ELSE CAST(substring(o_orderpriority, 1, 1) AS INTEGER) END AS ship_via FROM orders) o
  ON o.o_custkey = c_custkey
WHERE o.ship_via IS NULL""")
def join_left_is_null(spark, d):
    t = Tables(spark, d)
    c = t.customer.select("c_custkey")
    o = t.orders.select("o_orderkey", "o_custkey", ship_via().alias("ship_via"))
    return joins.left_where_null(c, o, c.c_custkey == o.o_custkey, "ship_via").select("c_custkey", "o_orderkey")


@query("join_anti", """
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 1998)""")
def join_anti(spark, d):
    t = Tables(spark, d)
    o98 = t.orders.where(_date_range("o_orderdate", "1998-01-01", "1999-01-01")).select("o_custkey")
    c = t.customer.select("c_custkey", "c_name")
    return joins.anti(c, o98, c.c_custkey == o98.o_custkey)


@query("join_semi", """
SELECT p_partkey, p_name FROM part
WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)""")
def join_semi(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.where(F.col("l_quantity") > 49).select("l_partkey")
    p = t.part.select("p_partkey", "p_name")
    return joins.semi(p, li, p.p_partkey == li.l_partkey)


# Quantity bands [lo, hi) of the range join.
QUANTITY_BANDS = [(0.0, 10.0, "small"), (10.0, 25.0, "medium"), (25.0, 40.0, "large"), (40.0, None, "bulk")]


@query("join_band_range", """
SELECT b.band, count(*) AS n_lines, sum(l_quantity) AS total_qty
FROM lineitem JOIN (VALUES (0.0, 10.0, 'small'), (10.0, 25.0, 'medium'), (25.0, 40.0, 'large'),
                           (40.0, NULL, 'bulk')) AS b(lo, hi, band)
  ON l_quantity >= b.lo AND (b.hi IS NULL OR l_quantity < b.hi)
GROUP BY b.band""")
def join_band_range(spark, d):
    li = Tables(spark, d).lineitem.select("l_quantity")
    bands = joins.bands_frame(spark, QUANTITY_BANDS)
    j = joins.band_join(li, "l_quantity", bands).where(F.col("band").isNotNull())
    return j.groupBy("band").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("total_qty"))


@query("join_range_orders", """
SELECT o.o_orderkey, count(*) AS n_lines, sum(l.l_quantity) AS total_qty
FROM lineitem l JOIN orders o ON l.l_shipdate >= o.o_orderdate AND l.l_shipdate < o.o_orderdate + INTERVAL 12 HOUR
WHERE o.o_orderpriority = '1-URGENT' GROUP BY o.o_orderkey""")
def join_range_orders(spark, d):
    """Range join of two tables that both grow: the lines shipped in the half day from each urgent order on."""
    t = Tables(spark, d)
    li = t.lineitem.select("l_shipdate", "l_quantity")
    o = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", "o_orderdate", (F.col("o_orderdate") + F.expr("INTERVAL 12 HOURS")).alias("o_until"))
    j = range_join(li, "l_shipdate", o, "o_orderdate", "o_until", totals={"n_lines": None, "total_qty": "l_quantity"})
    return j.groupBy("o_orderkey").agg(F.sum("n_lines").alias("n_lines"), F.sum("total_qty").alias("total_qty"))


@query("join_range_left", """
SELECT c_custkey, c_acctbal, p_partkey
FROM customer LEFT JOIN (SELECT p_partkey, p_retailprice AS lo, p_retailprice + p_size / 50.0 AS hi FROM part) p
  ON c_acctbal >= p.lo AND c_acctbal < p.hi""")
def join_range_left(spark, d):
    """Bands from the data: parts whose price band holds a customer's balance; customers in no band stay."""
    t = Tables(spark, d)
    c = t.customer.select("c_custkey", "c_acctbal")
    p = t.part.select("p_partkey", F.col("p_retailprice").alias("lo"),
                      (F.col("p_retailprice") + F.col("p_size") / F.lit(50.0)).alias("hi"))
    return range_join(c, "c_acctbal", p, "lo", "hi", how="left").select("c_custkey", "c_acctbal", "p_partkey")


def line_flags(t):
    """Per order, four 0/1 flags from one aggregate of lineitem."""
    li = t.lineitem
    flag = lambda cond: F.max(F.when(cond, 1).otherwise(0))
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        flag(F.col("l_returnflag") == "R").alias("previous_flag"),
        flag(F.col("l_discount") > 0.08).alias("current_flag"),
        F.min(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("outcome_a"),
        flag(F.col("l_quantity") > 45).alias("outcome_b"))


_FLAGS_SQL = """
SELECT l_orderkey AS o_orderkey,
       max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS previous_flag,
       max(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END) AS current_flag,
       min(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS outcome_a,
       max(CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END) AS outcome_b
FROM lineitem GROUP BY l_orderkey"""


def labelled_orders(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey", "o_orderstatus")
    j = joins.chain([o, line_flags(t)], ["o_orderkey"])
    status = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    return j.select("o_orderkey",
                    fx.code_label(status, {1: "GDM", 0: "Non-GDM"}, "Unknown").alias("status_label"),
                    fx.yes_no("previous_flag").alias("previous_label"),
                    fx.yes_no("current_flag").alias("current_label"),
                    fx.yes_no("outcome_a").alias("outcome_a_label"),
                    fx.yes_no("outcome_b").alias("outcome_b_label"))


_LABELS_SQL = f"""
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN 'GDM' WHEN o_orderstatus = 'O' THEN 'Non-GDM' ELSE 'Unknown' END
    AS status_label,
  CASE WHEN previous_flag = 1 THEN 'Yes' WHEN previous_flag = 0 THEN 'No' ELSE 'Unknown' END AS previous_label,
  CASE WHEN current_flag = 1 THEN 'Yes' WHEN current_flag = 0 THEN 'No' ELSE 'Unknown' END AS current_label,
  CASE WHEN outcome_a = 1 THEN 'Yes' WHEN outcome_a = 0 THEN 'No' ELSE 'Unknown' END AS outcome_a_label,
  CASE WHEN outcome_b = 1 THEN 'Yes' WHEN outcome_b = 0 THEN 'No' ELSE 'Unknown' END AS outcome_b_label
FROM orders JOIN ({_FLAGS_SQL}) f USING (o_orderkey)"""


@query("join_5way_labels", _LABELS_SQL)
def join_5way_labels(spark, d):
    return labelled_orders(spark, d)


@query("filter_yes_yes", f"""
SELECT * FROM ({_LABELS_SQL}) t WHERE previous_label = 'Yes' AND current_label = 'Yes'""")
def filter_yes_yes(spark, d):
    j = labelled_orders(spark, d)
    return j.where((F.col("previous_label") == "Yes") & (F.col("current_label") == "Yes"))


_FIVE_SQL = """
SELECT c_custkey AS participant,
  CASE WHEN c_acctbal < 0 THEN 'Yes' WHEN c_acctbal >= 0 THEN 'No' ELSE 'Unknown' END AS previous_label,
  CASE WHEN n_open > 0 THEN 'Yes' WHEN n_open = 0 THEN 'No' ELSE 'Unknown' END AS current_label,
  CASE WHEN returned = 1 THEN 'Yes' WHEN returned = 0 THEN 'No' ELSE 'Unknown' END AS screening_label,
  CASE WHEN errors = 1 THEN 'Yes' WHEN errors = 0 THEN 'No' ELSE 'Unknown' END AS history_label,
  CASE WHEN p_size > 25 THEN 'Yes' WHEN p_size <= 25 THEN 'No' ELSE 'Unknown' END AS outcome_label
FROM customer
JOIN (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open FROM orders GROUP BY 1) o ON o_custkey = c_custkey
JOIN (SELECT o_custkey AS who, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) l ON l.who = c_custkey
JOIN (SELECT user_id, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS errors FROM events GROUP BY 1) e
  ON e.user_id = c_custkey
JOIN part ON p_partkey = c_custkey"""


def five_inputs(spark, d):
    """Five tables with one row per participant (the customer number), joined on it."""
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("participant"), "o_orderstatus")
    yes = lambda cond: F.max(F.when(cond, 1).otherwise(0))
    demographics = t.customer.select(F.col("c_custkey").alias("participant"), F.when(F.col("c_acctbal") < 0, 1)
                                     .when(F.col("c_acctbal") >= 0, 0).alias("previous"))
    visits = o.groupBy("participant").agg(yes(F.col("o_orderstatus") == "O").alias("current"))
    li = t.lineitem.select("l_orderkey", "l_returnflag")
    screening = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("participant")
                   .agg(yes(F.col("l_returnflag") == "R").alias("returned")))
    history = t.events.groupBy(F.col("user_id").alias("participant")).agg(yes(F.col("event_type") == "error").alias("errors"))
    outcomes = t.part.select(F.col("p_partkey").alias("participant"), F.when(F.col("p_size") > 25, 1)
                             .when(F.col("p_size") <= 25, 0).alias("outcome"))
    j = joins.chain([demographics, visits, screening, history, outcomes], ["participant"] * 4)
    return j.select("participant", fx.yes_no("previous").alias("previous_label"), fx.yes_no("current").alias("current_label"),
                    fx.yes_no("returned").alias("screening_label"), fx.yes_no("errors").alias("history_label"),
                    fx.yes_no("outcome").alias("outcome_label"))


@query("join_five_inputs", _FIVE_SQL)
def join_five_inputs(spark, d):
    return five_inputs(spark, d)


@query("status_of_participant", f"SELECT * FROM ({_FIVE_SQL}) t WHERE participant = 7")
def status_of_participant(spark, d):
    """The procedure for one id: its predicate reaches all five scans."""
    return five_inputs(spark, d).where(F.col("participant") == 7)


@query("outcomes_of_yes_yes", f"SELECT participant, history_label, outcome_label FROM ({_FIVE_SQL}) t WHERE current_label = 'Yes' AND screening_label = 'Yes'")
def outcomes_of_yes_yes(spark, d):
    """The recursive row-by-row procedure as one filter over all participants."""
    j = five_inputs(spark, d).where((F.col("current_label") == "Yes") & (F.col("screening_label") == "Yes"))
    return j.select("participant", "history_label", "outcome_label")


@query("join_distinct_views", """
SELECT v1.l_orderkey, v1.l_partkey, v2.p_brand
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) v1
JOIN (SELECT DISTINCT p_partkey, p_brand FROM part) v2 ON v1.l_partkey = v2.p_partkey""")
def join_distinct_views(spark, d):
    t = Tables(spark, d)
    v1 = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    v2 = t.part.select("p_partkey", "p_brand").distinct()
    return v1.join(v2, v1.l_partkey == v2.p_partkey).select("l_orderkey", "l_partkey", "p_brand")


# ------------------------------------------------------------ aggregates


@query("agg_count_by_segment", "SELECT c_mktsegment, count(*) AS n_customers FROM customer GROUP BY c_mktsegment")
def agg_count_by_segment(spark, d):
    return Tables(spark, d).customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_customers"))


AGG_YEAR_QUARTER_SQL = f"""
SELECT c_mktsegment, {q.i32('year(o_orderdate)')} AS order_year, {q.i32('quarter(o_orderdate)')} AS order_quarter,
       count(*) AS n_orders, {q.avg_money('o_totalprice')} AS avg_price
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_totalprice > 100000
GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"""


@query("agg_year_quarter", AGG_YEAR_QUARTER_SQL)
def agg_year_quarter(spark, d):
    """Flagship: orders with customer, per segment/year/quarter count and average."""
    t = Tables(spark, d)
    o = t.orders.where(F.col("o_totalprice") > 100000).select("o_custkey", "o_orderdate", "o_totalprice")
    c = t.customer.select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    day = fx.to_day("o_orderdate")
    return (j.groupBy("c_mktsegment", F.year(day).alias("order_year"), F.quarter(day).alias("order_quarter"))
             .agg(F.count(F.lit(1)).alias("n_orders"), fx.avg_money("o_totalprice").alias("avg_price"))
             .orderBy("c_mktsegment", "order_year", "order_quarter"))


@query("agg_having_minmax", """
SELECT n_name, count(*) AS n_orders, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
GROUP BY n_name HAVING count(*) >= 600""")
def agg_having_minmax(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_custkey", "o_totalprice")
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    g = j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_orders"), F.min("o_totalprice").alias("min_price"),
                                F.max("o_totalprice").alias("max_price"))
    return g.where(F.col("n_orders") >= 600)


@query("agg_count_distinct_dow", f"""
SELECT {q.i32('dayofweek(ts)')} AS dow, rpad(dayname(ts), 9, ' ') AS day_name,
       count(DISTINCT user_id) AS n_users
FROM events GROUP BY 1, 2""")
def agg_count_distinct_dow(spark, d):
    e = Tables(spark, d).events
    return (e.groupBy(fx.pg_dow("ts").alias("dow"), fx.pg_day_name("ts").alias("day_name"))
             .agg(F.count_distinct("user_id").alias("n_users")))


_USER_DAYS = "SELECT user_id, CAST(ts AS DATE) AS day FROM events"


@query("agg_distinct_rollup", " UNION ALL ".join(f"""
SELECT '{level}' AS level, {value} AS value, count(DISTINCT user_id) AS n_users FROM ({_USER_DAYS}) e GROUP BY 2"""
    for level, value in (("year", "CAST(year(day) AS VARCHAR)"), ("month", "strftime(day, '%Y-%m')"),
                         ("weekday", "CAST(dayofweek(day) AS VARCHAR)"), ("day", "CAST(day AS VARCHAR)"))))
def agg_distinct_rollup(spark, d):
    """Distinct users per year, month, weekday and day, all from one table of bitmaps per day."""
    e = Tables(spark, d).events
    days = rollup.distinct_bitmaps(e, {"day": fx.to_day("ts")}, "user_id")
    return rollup.rolled_up_levels(days, {
        "year": F.year("day"), "month": F.date_format("day", "yyyy-MM"), "weekday": F.dayofweek("day") - 1,
        "day": F.col("day")}, "n_users")


@query("agg_avg_price_band", f"""
SELECT p_type, count(*) AS n_parts, {q.avg_money('p_retailprice')} AS avg_price FROM part GROUP BY p_type""")
def agg_avg_price_band(spark, d):
    p = Tables(spark, d).part
    return p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n_parts"), fx.avg_money("p_retailprice").alias("avg_price"))


@query("agg_stock_value", f"""
SELECT p_type, CAST(sum({q.money('p_retailprice')} * p_size) AS DOUBLE) AS stock_value FROM part GROUP BY p_type""")
def agg_stock_value(spark, d):
    p = Tables(spark, d).part
    return p.groupBy("p_type").agg(F.sum(fx.money("p_retailprice") * F.col("p_size")).cast("double").alias("stock_value"))


@query("agg_stddev", f"""
SELECT l_returnflag, {q.rhu('stddev_samp(l_quantity)', 4)} AS sd_quantity FROM lineitem GROUP BY l_returnflag""")
def agg_stddev(spark, d):
    li = Tables(spark, d).lineitem
    return li.groupBy("l_returnflag").agg(fx.round_half_up(F.stddev("l_quantity"), 4).alias("sd_quantity"))


@query("agg_max", f"""
SELECT max(o_totalprice) AS max_price, {q.day('max(o_orderdate)')} AS last_order_date FROM orders""")
def agg_max(spark, d):
    o = Tables(spark, d).orders
    return o.agg(F.max("o_totalprice").alias("max_price"), fx.to_day(F.max("o_orderdate")).alias("last_order_date"))


@query("agg_first_letter", """
SELECT left(p_name, 1) AS first_letter, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, first_letter""")
def agg_first_letter(spark, d):
    p = Tables(spark, d).part
    return (p.groupBy(F.left("p_name", F.lit(1)).alias("first_letter")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), "first_letter"))


@query("agg_cross_label", """
SELECT c_mktsegment,
       CASE WHEN c_acctbal < 0 THEN 'In debt' WHEN c_acctbal >= 0 THEN 'Solvent' ELSE 'Unknown' END
         AS balance_status,
       count(*) AS n
FROM customer GROUP BY 1, 2""")
def agg_cross_label(spark, d):
    c = Tables(spark, d).customer
    status = (F.when(F.col("c_acctbal") < 0, "In debt").when(F.col("c_acctbal") >= 0, "Solvent")
               .otherwise("Unknown"))
    return c.groupBy("c_mktsegment", status.alias("balance_status")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_argmax_ties", f"""
WITH per_day AS (SELECT {q.i32('dayofweek(ts)')} AS dow, count(*) AS n_events FROM events GROUP BY 1)
SELECT dow, n_events FROM per_day WHERE n_events = (SELECT max(n_events) FROM per_day)""")
def agg_argmax_ties(spark, d):
    e = Tables(spark, d).events
    per_day = e.groupBy(fx.pg_dow("ts").alias("dow")).agg(F.count(F.lit(1)).alias("n_events"))
    return subqueries.eq_max(per_day, "n_events")


@query("agg_price_band", f"""
SELECT {_PRICE_CASE} AS price_category, count(*) AS n_parts, {q.avg_money('p_retailprice')} AS avg_price
FROM part GROUP BY 1""")
def agg_price_band(spark, d):
    # The reference joins the banded CTE back to products on the primary key;
    # that self join is the identity, so the band is derived in place.
    p = Tables(spark, d).part
    return (p.groupBy(price_category().alias("price_category"))
             .agg(F.count(F.lit(1)).alias("n_parts"), fx.avg_money("p_retailprice").alias("avg_price")))


@query("agg_task_count", "SELECT l_suppkey, count(*) AS n_tasks FROM lineitem GROUP BY l_suppkey")
def agg_task_count(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_tasks"))


# -------------------------------------------------------------- set ops

_NAMES_C = "SELECT c_name AS name, c_nationkey AS nationkey FROM customer"
_NAMES_S = "SELECT s_name, s_nationkey FROM supplier"


def _names(t):
    c = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"))
    s = t.supplier.select("s_name", "s_nationkey")
    return c, s


@query("set_union", f"{_NAMES_C} UNION {_NAMES_S} ORDER BY nationkey, name")
def set_union(spark, d):
    c, s = _names(Tables(spark, d))
    return setops.union(c, s).orderBy("nationkey", "name")


@query("set_union_all", f"{_NAMES_C} UNION ALL {_NAMES_S}")
def set_union_all(spark, d):
    c, s = _names(Tables(spark, d))
    return setops.union_all(c, s)


_P96 = "SELECT l_partkey FROM lineitem WHERE year(l_shipdate) = 1996"
_P99 = "SELECT l_partkey FROM lineitem WHERE year(l_shipdate) = 1999"


def _parts_shipped(t, year):
    return t.lineitem.where(_date_range("l_shipdate", f"{year}-01-01", f"{year + 1}-01-01")).select("l_partkey")


@query("set_intersect", f"{_P96} INTERSECT {_P99}")
def set_intersect(spark, d):
    t = Tables(spark, d)
    return setops.intersect(_parts_shipped(t, 1996), _parts_shipped(t, 1999))


@query("set_except", f"{_P96} EXCEPT {_P99}")
def set_except(spark, d):
    t = Tables(spark, d)
    return setops.except_(_parts_shipped(t, 1996), _parts_shipped(t, 1999))


# ------------------------------------------------------------ subqueries


@query("subq_in", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def subq_in(spark, d):
    t = Tables(spark, d)
    big = t.orders.where(F.col("o_totalprice") > 400000)
    return subqueries.in_subquery(t.customer.select("c_custkey", "c_name"), "c_custkey", big, "o_custkey")


@query("subq_scalar_top1", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey = (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1)""")
def subq_scalar_top1(spark, d):
    t = Tables(spark, d)
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    top = subqueries.top1_key(counts, "o_custkey", [F.col("n").desc(), F.col("o_custkey").asc()])
    return t.orders.where(F.col("o_custkey") == top).select("o_orderkey", "o_custkey", "o_totalprice")


_PROMO_BIG = "SELECT p_retailprice FROM part WHERE p_type = 'PROMO' AND p_size > 45"


@query("subq_any", f"SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > ANY ({_PROMO_BIG})")
def subq_any(spark, d):
    p = Tables(spark, d).part
    sub = p.where((F.col("p_type") == "PROMO") & (F.col("p_size") > 45))
    return subqueries.gt_any(p.select("p_partkey", "p_retailprice"), "p_retailprice", sub, "p_retailprice")


@query("subq_all", f"SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > ALL ({_PROMO_BIG})")
def subq_all(spark, d):
    p = Tables(spark, d).part
    sub = p.where((F.col("p_type") == "PROMO") & (F.col("p_size") > 45))
    return subqueries.gt_all(p.select("p_partkey", "p_retailprice"), "p_retailprice", sub, "p_retailprice")


@query("subq_last_inserted", """
SELECT * FROM customer
WHERE c_custkey = (SELECT user_id FROM events WHERE ts = (SELECT max(ts) FROM events))""")
def subq_last_inserted(spark, d):
    t = Tables(spark, d)
    e = t.events
    last_ts = e.agg(F.max("ts")).scalar()
    last_user = e.where(F.col("ts") == last_ts).select("user_id").scalar()
    return t.customer.where(F.col("c_custkey") == last_user)


@query("subq_eq_max", """
WITH per_nation AS (SELECT c_nationkey, count(*) AS n_orders
                    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)
SELECT c_nationkey, n_orders FROM per_nation WHERE n_orders = (SELECT max(n_orders) FROM per_nation)""")
def subq_eq_max(spark, d):
    t = Tables(spark, d)
    o, c = t.orders.select("o_custkey"), t.customer.select("c_custkey", "c_nationkey")
    per_nation = o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return subqueries.eq_max(per_nation, "n_orders")


# -------------------------------------------------------- sort and limit


@query("sort_multi_key", """
SELECT p_partkey, p_type, p_retailprice FROM part ORDER BY p_type, p_retailprice DESC, p_partkey""")
def sort_multi_key(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_type", "p_retailprice")
    return p.orderBy(F.col("p_type").asc_nulls_last(), F.col("p_retailprice").desc_nulls_first(), "p_partkey")


@query("limit_first10", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def limit_first10(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy("o_orderkey").limit(10)


@query("limit_offset_page", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 20""")
def limit_offset_page(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy("o_orderkey").offset(20).limit(10)


def _draw_sql(key: str, seed: int) -> str:
    return f"md5('{seed}|' || {key})"


@query("sample_seeded", f"""
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY {_draw_sql('c_custkey', 52)}, c_custkey LIMIT 10""")
def sample_seeded(spark, d):
    """Ten random customers of one segment; the same ones for the same seed."""
    c = Tables(spark, d).customer.where(F.col("c_mktsegment") == "BUILDING")
    return sampling.sample_fixed(c, 10, ["c_custkey"], 52).select("c_custkey", "c_name")


@query("sample_by_segment", f"""
SELECT c_custkey, c_mktsegment FROM (
  SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {_draw_sql('c_custkey', 7)}, c_custkey) AS n
  FROM customer) t
WHERE n <= 20""")
def sample_by_segment(spark, d):
    """Twenty random customers of every segment."""
    c = Tables(spark, d).customer.select("c_custkey", "c_mktsegment")
    return sampling.sample_stratified(c, ["c_mktsegment"], 20, ["c_custkey"], 7)


@query("sample_by_price", f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0
ORDER BY -ln((CAST('0x' || substr({_draw_sql('o_orderkey', 11)}, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
         / o_totalprice, o_orderkey
LIMIT 50""")
def sample_by_price(spark, d):
    """Fifty orders drawn without replacement, each with a chance in proportion to its price."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    return sampling.sample_weighted(o, 50, "o_totalprice", ["o_orderkey"], 11)


@query("sample_random10")
def sample_random10(spark, d):
    """Ten random customers of one segment; differs per run (rows-only check)."""
    c = Tables(spark, d).customer
    return c.where(F.col("c_mktsegment") == "BUILDING").orderBy(F.rand()).limit(10).select("c_custkey", "c_name")
