"""Windows, hierarchy, scalar functions and the reference's row functions
re-expressed set-based (one pass over all ids instead of one call per id).

Clinical stand-ins: a "visit measure" pair is (l_extendedprice / 500,
2 * l_quantity) for blood pressure, weight = l_quantity + 40 kg and height =
1.5 + l_linenumber / 20 m for BMI, the expected delivery date is the order
date, and the form-signing log is ``events``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..operators import keys as keyops
from ..operators.hierarchy import walk_down
from ..operators.windows import (asc, desc, global_position, global_rank, lag, lead, rows_at_nth_distinct,
                                 running_count)
from ..sources.tables import Tables
from . import sqltext as q
from .registry import query
from .relational import manager_of, _MANAGER_SQL

# ------------------------------------------------------------- windows


@query("win_rank_customer_orders", """
WITH per_customer AS (SELECT c_custkey, c_name, count(*) AS n_orders
                      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_name)
SELECT c_custkey, c_name, n_orders, rank() OVER (ORDER BY n_orders DESC) AS order_rank FROM per_customer""")
def win_rank_customer_orders(spark, d):
    t = Tables(spark, d)
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    c = t.customer.select("c_custkey", "c_name")
    per_customer = counts.join(c, counts.o_custkey == c.c_custkey).select("c_custkey", "c_name", "n_orders")
    return global_rank(per_customer, [desc("n_orders")], [asc("c_custkey")], "order_rank")


@query("win_dense_rank_nth", """
SELECT p_partkey, p_name, p_retailprice FROM (
  SELECT p_partkey, p_name, p_retailprice, dense_rank() OVER (ORDER BY p_retailprice DESC) AS dr
  FROM part WHERE p_retailprice IS NOT NULL) t
WHERE dr = 2""")
def win_dense_rank_nth(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_name", "p_retailprice")
    return rows_at_nth_distinct(p, "p_retailprice", 2, descending=True)


def map_value():
    return fx.mean_arterial_pressure(F.col("l_extendedprice") / F.lit(500.0), F.col("l_quantity") * F.lit(2.0))


def map_band(col="map_value"):
    # MAP bands of the reference (NULL kept as NULL).
    c = F.col(col)
    return F.when(c.isNull(), F.lit(None)).when(c < 70, "Low").when(c <= 100, "Normal").otherwise("High")


_MAP_SQL = "((l_extendedprice / 500.0) + 2.0 * (l_quantity * 2.0)) / 3.0"
_MAP_BAND_SQL = ("CASE WHEN map_value IS NULL THEN NULL WHEN map_value < 70 THEN 'Low' "
                 "WHEN map_value <= 100 THEN 'Normal' ELSE 'High' END")
_MAP_ROWS_SQL = f"SELECT l_orderkey, l_linenumber, {_MAP_SQL} AS map_value FROM lineitem"


def map_rows(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber", map_value().alias("map_value")) \
             .withColumn("map_band", map_band())


@query("band_map", f"""
SELECT l_orderkey, l_linenumber, {q.rhu('map_value')} AS map_value, {_MAP_BAND_SQL} AS map_band
FROM ({_MAP_ROWS_SQL}) t""")
def band_map(spark, d):
    m = map_rows(spark, d)
    return m.select("l_orderkey", "l_linenumber", fx.round_half_up("map_value").alias("map_value"), "map_band")


@query("win_rank_bands", f"""
SELECT map_band, n, dense_rank() OVER (ORDER BY n DESC) AS band_rank
FROM (SELECT {_MAP_BAND_SQL} AS map_band, count(*) AS n FROM ({_MAP_ROWS_SQL}) t GROUP BY 1) b""")
def win_rank_bands(spark, d):
    counts = map_rows(spark, d).groupBy("map_band").agg(F.count(F.lit(1)).alias("n"))
    # At most four band rows: a global window over them is bounded.
    return counts.withColumn("band_rank", F.dense_rank().over(Window.orderBy(F.col("n").desc())).cast("long"))


@query("win_count_over", f"""
SELECT DISTINCT ON (map_band) map_band, count(*) OVER (PARTITION BY map_band) AS band_size
FROM (SELECT {_MAP_BAND_SQL} AS map_band FROM ({_MAP_ROWS_SQL}) t) b ORDER BY map_band""")
def win_count_over(spark, d):
    # COUNT(*) OVER (PARTITION BY band) followed by one row per band is a
    # plain grouped count: one partial aggregate instead of a full window.
    return map_rows(spark, d).groupBy("map_band").agg(F.count(F.lit(1)).alias("band_size"))


_CHANGE_SQL = f"{q.money('l_extendedprice')} * CAST(l_discount AS DECIMAL(4,2))"


@query("win_avg_over", f"""
SELECT DISTINCT ON (l_returnflag) l_returnflag,
  {q.rhu(f'CAST(sum({_CHANGE_SQL}) OVER (PARTITION BY l_returnflag) AS DOUBLE) / count(*) OVER (PARTITION BY l_returnflag)')}
    AS avg_change
FROM lineitem ORDER BY l_returnflag""")
def win_avg_over(spark, d):
    li = Tables(spark, d).lineitem
    change = fx.money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")
    return li.groupBy("l_returnflag").agg(
        fx.round_half_up(F.sum(change).cast("double") / F.count(F.lit(1))).alias("avg_change"))


_LAG_SQL = f"""
SELECT o_custkey, o_orderkey, {q.day('o_orderdate')} AS order_date, o_totalprice,
       {{fn}}(o_totalprice, 1, o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
         AS {{name}}
FROM orders"""


@query("win_lag_diff", f"""
SELECT *, CAST({q.money('o_totalprice')} - {q.money('prev_price')} AS DOUBLE) AS price_change
FROM ({_LAG_SQL.format(fn='lag', name='prev_price')}) t""")
def win_lag_diff(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    lagged = lag(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", "prev_price",
                 default="o_totalprice")
    return lagged.select("o_custkey", "o_orderkey", fx.to_day("o_orderdate").alias("order_date"), "o_totalprice",
                         "prev_price",
                         (fx.money("o_totalprice") - fx.money("prev_price")).cast("double").alias("price_change"))


@query("win_lead_diff", f"""
SELECT *, CAST({q.money('next_price')} - {q.money('o_totalprice')} AS DOUBLE) AS price_change
FROM ({_LAG_SQL.format(fn='lead', name='next_price')}) t""")
def win_lead_diff(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    led = lead(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", "next_price",
               default="o_totalprice")
    return led.select("o_custkey", "o_orderkey", fx.to_day("o_orderdate").alias("order_date"), "o_totalprice",
                      "next_price",
                      (fx.money("next_price") - fx.money("o_totalprice")).cast("double").alias("price_change"))


_ROWNUM_SQL = """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_num FROM orders"""


def _numbered_orders(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return global_position(o, ["o_orderdate", "o_orderkey"], "row_num").select("o_orderkey", "row_num")


@query("win_row_number", _ROWNUM_SQL)
def win_row_number(spark, d):
    return _numbered_orders(spark, d)


@query("win_row_at", f"SELECT * FROM ({_ROWNUM_SQL}) t WHERE row_num = 100")
def win_row_at(spark, d):
    return _numbered_orders(spark, d).where(F.col("row_num") == 100)


# ------------------------------------------------------------ hierarchy


@query("recursive_hierarchy", f"""
WITH RECURSIVE emp AS (SELECT c_custkey, c_name, {_MANAGER_SQL} AS manager_key FROM customer),
tree AS (SELECT c_custkey, manager_key, 1 AS level, c_name FROM emp WHERE manager_key IS NULL
         UNION ALL
         SELECT e.c_custkey, e.manager_key, t.level + 1, e.c_name
         FROM emp e JOIN tree t ON e.manager_key = t.c_custkey)
SELECT c_custkey, manager_key, level, c_name FROM tree""")
def recursive_hierarchy(spark, d):
    emp = Tables(spark, d).customer.select("c_custkey", "c_name", manager_of().alias("manager_key"))
    return walk_down(emp, "c_custkey", "manager_key", keep=("c_name",))


_CHAIN_SQL = "CASE WHEN o_orderkey % 500 = 0 THEN NULL ELSE o_orderkey - 1 END"


@query("hierarchy_chains", f"""
SELECT o_orderkey, {_CHAIN_SQL} AS previous_key, CAST(o_orderkey % 500 + 1 AS INTEGER) AS level FROM orders
WHERE o_orderkey - o_orderkey % 500 IN (SELECT o_orderkey FROM orders)""")
def hierarchy_chains(spark, d):
    """Chains of 500 orders, each pointing to the one before: deep rather than wide."""
    o = Tables(spark, d).orders.select("o_orderkey", F.when(F.col("o_orderkey") % 500 != 0, F.col("o_orderkey") - 1)
                                       .alias("previous_key"))
    return walk_down(o, "o_orderkey", "previous_key", cycles="error")


# ---------------------------------------------------------- scalar fns


@query("fn_split_part", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', 2) AS second_word FROM part""")
def fn_split_part(spark, d):
    p = Tables(spark, d).part
    return p.select("p_partkey", fx.split_part("p_name", " ", 1).alias("first_word"),
                    fx.split_part("p_name", " ", 2).alias("second_word"))


@query("fn_concat", """
SELECT c_custkey, c_name || ' - ' || CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS label
FROM customer""")
def fn_concat(spark, d):
    c = Tables(spark, d).customer
    seg = F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", fx.pg_concat("c_name", F.lit(" - "), seg).alias("label"))


@query("fn_char_positions", """
WITH t AS (SELECT p_partkey,
  list_filter(range(1, length(lower(p_name)) + 1), lambda i: substring(lower(p_name), i::INTEGER, 1) = 'e') AS pos
  FROM part)
SELECT p_partkey, array_to_string(pos, ',') AS positions, CAST(len(pos) AS INTEGER) AS n_positions FROM t""")
def fn_char_positions(spark, d):
    p = Tables(spark, d).part
    pos = fx.char_positions("p_name", "e")
    return p.select("p_partkey", F.array_join(pos, ",").alias("positions"), F.size(pos).alias("n_positions"))


@query("fn_day_name", "SELECT o_orderkey, rpad(dayname(o_orderdate), 9, ' ') AS day_name FROM orders")
def fn_day_name(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", fx.pg_day_name("o_orderdate").alias("day_name"))


@query("fn_date_parts", f"""
SELECT o_orderkey, {q.i32('year(o_orderdate)')} AS order_year, {q.i32('quarter(o_orderdate)')} AS order_quarter,
       {q.i32('dayofweek(o_orderdate)')} AS order_dow FROM orders""")
def fn_date_parts(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", F.year("o_orderdate").alias("order_year"),
                    F.quarter("o_orderdate").alias("order_quarter"), fx.pg_dow("o_orderdate").alias("order_dow"))


@query("fn_due_date", f"""
SELECT o_orderkey, {q.day('o_orderdate')} AS edd, {q.day('o_orderdate')} - 280 AS conception_date FROM orders""")
def fn_due_date(spark, d):
    o = Tables(spark, d).orders
    edd = fx.to_day("o_orderdate")
    # ALTER TABLE ADD COLUMN conception_date + UPDATE SET = edd - 280 days
    return o.select("o_orderkey", edd.alias("edd")).withColumn("conception_date", F.date_sub("edd", 280))


@query("fn_visit_schedule", f"""
SELECT o_orderkey, {q.day('o_orderdate')} + 7 * 12 AS visit_12w, {q.day('o_orderdate')} + 7 * 20 AS visit_20w,
       {q.day('o_orderdate')} + 7 * 28 AS visit_28w FROM orders""")
def fn_visit_schedule(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", fx.add_weeks("o_orderdate", 12).alias("visit_12w"),
                    fx.add_weeks("o_orderdate", 20).alias("visit_20w"),
                    fx.add_weeks("o_orderdate", 28).alias("visit_28w"))


@query("fn_date_diff", f"""
SELECT l_orderkey, l_linenumber,
       {q.i32("date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))")} AS days_to_ship
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def fn_date_diff(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", fx.days_between("l_shipdate", "o_orderdate").alias("days_to_ship"))


@query("fn_round", f"""
SELECT l_orderkey, l_linenumber,
       {q.round_money(f"{q.money('l_extendedprice')} * (1 - CAST(l_discount AS DECIMAL(4,2)))")} AS net_price
FROM lineitem""")
def fn_round(spark, d):
    li = Tables(spark, d).lineitem
    net = fx.money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return li.select("l_orderkey", "l_linenumber", fx.round_money(net).alias("net_price"))


def bmi_value():
    return fx.bmi(F.col("l_quantity") + F.lit(40.0), F.lit(1.5) + F.col("l_linenumber") / F.lit(20.0))


def bmi_category(col="bmi"):
    # BMI categories (kg/m2) of the reference.
    return fx.band(col, [(18.5, "Underweight"), (25.0, "Normal"), (30.0, "Overweight")], "Obese",
                   null_label="Unknown")


_BMI_SQL = ("(l_quantity + 40.0) / ((1.5 + CAST(l_linenumber AS DOUBLE) / 20.0) "
            "* (1.5 + CAST(l_linenumber AS DOUBLE) / 20.0))")
_BMI_CAT_SQL = ("CASE WHEN bmi IS NULL THEN 'Unknown' WHEN bmi < 18.5 THEN 'Underweight' WHEN bmi < 25.0 "
                "THEN 'Normal' WHEN bmi < 30.0 THEN 'Overweight' ELSE 'Obese' END")


@query("fn_bmi", f"""
SELECT l_orderkey, l_linenumber, {q.rhu('bmi')} AS bmi, {_BMI_CAT_SQL} AS bmi_category
FROM (SELECT l_orderkey, l_linenumber, {_BMI_SQL} AS bmi FROM lineitem) t""")
def fn_bmi(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", bmi_value().alias("bmi"))
    return li.select("l_orderkey", "l_linenumber", fx.round_half_up("bmi").alias("bmi"),
                     bmi_category().alias("bmi_category"))


@query("band_bmi", f"""
SELECT {_BMI_CAT_SQL} AS bmi_category, count(*) AS n
FROM (SELECT {_BMI_SQL} AS bmi FROM lineitem) t GROUP BY 1""")
def band_bmi(spark, d):
    li = Tables(spark, d).lineitem.select(bmi_value().alias("bmi"))
    return li.groupBy(bmi_category().alias("bmi_category")).agg(F.count(F.lit(1)).alias("n"))


_VISITS_SQL = """
SELECT o_orderkey, v1, v2, v3,
  (coalesce(v1, 0.0) + coalesce(v2, 0.0) + coalesce(v3, 0.0))
    / NULLIF((CASE WHEN v1 IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN v2 IS NOT NULL THEN 1 ELSE 0 END)
             + (CASE WHEN v3 IS NOT NULL THEN 1 ELSE 0 END), 0) AS mean_value
FROM orders LEFT JOIN (
  SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) AS v1,
         max(CASE WHEN l_linenumber = 2 THEN l_extendedprice END) AS v2,
         max(CASE WHEN l_linenumber = 3 THEN l_extendedprice END) AS v3
  FROM lineitem GROUP BY l_orderkey) v ON v.l_orderkey = o_orderkey"""


def _visits(spark, d):
    t = Tables(spark, d)
    li = t.lineitem
    v = li.groupBy("l_orderkey").agg(*[
        F.max(F.when(F.col("l_linenumber") == i, F.col("l_extendedprice"))).alias(f"v{i}") for i in (1, 2, 3)])
    o = t.orders.select("o_orderkey")
    j = o.join(v, o.o_orderkey == v.l_orderkey, "left")
    return j.select("o_orderkey", "v1", "v2", "v3", fx.mean_of_present(["v1", "v2", "v3"]).alias("mean_value"))


@query("fn_mean_of_nonnull", f"""
SELECT o_orderkey, v1, v2, v3, {q.rhu('mean_value')} AS mean_value FROM ({_VISITS_SQL}) t""")
def fn_mean_of_nonnull(spark, d):
    v = _visits(spark, d)
    return v.withColumn("mean_value", fx.round_half_up("mean_value"))


THRESHOLD = 60000.0


@query("label_threshold", f"""
SELECT o_orderkey, {q.rhu('mean_value')} AS mean_value,
       CASE WHEN mean_value >= {THRESHOLD} THEN 'suspected' ELSE 'not suspected' END AS label
FROM ({_VISITS_SQL}) t""")
def label_threshold(spark, d):
    v = _visits(spark, d)
    label = F.when(F.col("mean_value") >= THRESHOLD, "suspected").otherwise("not suspected")
    return v.select("o_orderkey", fx.round_half_up("mean_value").alias("mean_value"), label.alias("label"))


@query("fn_casts", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price_text,
       CAST(o_orderdate AS DATE) AS order_day, CAST(o_orderkey AS VARCHAR) AS key_text,
       CAST(floor(o_totalprice) AS BIGINT) AS price_whole
FROM orders""")
def fn_casts(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", o.o_totalprice.cast("decimal(12,2)").cast("string").alias("price_text"),
                    o.o_orderdate.cast("date").alias("order_day"), o.o_orderkey.cast("string").alias("key_text"),
                    F.floor("o_totalprice").cast("long").alias("price_whole"))


@query("pct_change_both", f"""
WITH halves AS (
  SELECT user_id,
         count(*) FILTER (WHERE day(ts) <= 15) AS n1, count(*) FILTER (WHERE day(ts) > 15) AS n3,
         CAST(sum(CASE WHEN day(ts) <= 15 THEN {q.money('value')} END) AS DOUBLE) AS s1,
         CAST(sum(CASE WHEN day(ts) > 15 THEN {q.money('value')} END) AS DOUBLE) AS s3
  FROM events GROUP BY user_id),
pct AS (SELECT user_id, (n3 - n1) / NULLIF(n1, 0) * 100.0 AS pct_events,
               (s3 - s1) / NULLIF(s1, 0) * 100.0 AS pct_value FROM halves)
SELECT user_id, {q.rhu('pct_events')} AS pct_events, {q.rhu('pct_value')} AS pct_value
FROM pct WHERE pct_events > 20 AND pct_value > 20""")
def pct_change_both(spark, d):
    e = Tables(spark, d).events
    first = F.dayofmonth("ts") <= 15
    halves = e.groupBy("user_id").agg(
        F.count(F.when(first, 1)).alias("n1"), F.count(F.when(~first, 1)).alias("n3"),
        F.sum(F.when(first, fx.money("value"))).cast("double").alias("s1"),
        F.sum(F.when(~first, fx.money("value"))).cast("double").alias("s3"))
    pct = halves.select("user_id", fx.pct_change("n1", "n3").alias("pct_events"),
                        fx.pct_change("s1", "s3").alias("pct_value"))
    return (pct.where((F.col("pct_events") > 20) & (F.col("pct_value") > 20))
               .select("user_id", fx.round_half_up("pct_events").alias("pct_events"),
                       fx.round_half_up("pct_value").alias("pct_value")))


# ------------------------------------------------- routines, set-based


@query("fn_stock_value", f"""
WITH req AS (SELECT DISTINCT p_type AS category FROM part UNION SELECT 'TOY'),
     v AS (SELECT p_type, CAST(sum({q.money('p_retailprice')} * p_size) AS DOUBLE) AS stock_value
           FROM part GROUP BY p_type)
SELECT category, stock_value, CASE WHEN stock_value IS NULL THEN 'missing' ELSE 'ok' END AS status
FROM req LEFT JOIN v ON v.p_type = req.category""")
def fn_stock_value(spark, d):
    """total_stock_value_of_category(id) for every requested id at once;
    an id without products is reported (the routine raised)."""
    p = Tables(spark, d).part
    requested = p.select(F.col("p_type").alias("category")).union(
        spark.createDataFrame([("TOY",)], "category string")).distinct()
    values = p.groupBy("p_type").agg(F.sum(fx.money("p_retailprice") * F.col("p_size")).cast("double")
                                     .alias("stock_value"))
    j = requested.join(values, requested.category == values.p_type, "left")
    status = F.when(F.col("stock_value").isNull(), "missing").otherwise("ok")
    return j.select("category", "stock_value", status.alias("status"))


@query("task_assign_counts", f"""
SELECT o_custkey, o_orderkey,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS task_no,
       count(*) OVER (PARTITION BY o_custkey) AS n_tasks
FROM orders""")
def task_assign_counts(spark, d):
    """assign_task(employee, task, INOUT count): orders as tasks of a customer."""
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    r = running_count(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "task_no", size_name="n_tasks")
    return r.select("o_custkey", "o_orderkey", "task_no", "n_tasks")


@query("surrogate_keys", """
SELECT event_id, user_id, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY ts, event_id)
       AS new_custkey
FROM events WHERE event_type = 'signup'""")
def surrogate_keys(spark, d):
    t = Tables(spark, d)
    signups = t.events.where(F.col("event_type") == "signup").select("event_id", "user_id", "ts")
    ided = keyops.assign_ids(signups, ["ts", "event_id"], "new_custkey", existing=t.customer,
                             existing_col="c_custkey")
    return ided.select("event_id", "user_id", "new_custkey")
