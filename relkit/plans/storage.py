"""Sources and sinks, partitioned storage, data-quality rules and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..operators import profile as prof
from ..operators import dml, publish, quality
from ..operators.refresh import AggregateView, MaterializedView
from ..session import scratch_path
from ..sources import files
from ..sources.batches import pending_batches
from ..sources.evolve import evolve
from ..sources.tables import Tables
from .analytics import map_rows, _MAP_BAND_SQL, _MAP_ROWS_SQL
from .registry import query
from .relational import manager_of, _MANAGER_SQL

# ------------------------------------------------------------ CSV


@query("csv_roundtrip_part", "SELECT * FROM part")
def csv_roundtrip_part(spark, d):
    p = Tables(spark, d).part
    path = scratch_path(spark, "part_csv")
    files.write_csv(p, path)
    return files.read_csv(spark, path, p.schema)


# ------------------------------------------------- month partitions

def monthly_orders(spark, d):
    """Orders written as a month-partitioned table."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice",
                                       fx.to_day("o_orderdate").alias("order_date"))
    path = scratch_path(spark, "orders_by_month")
    files.write_by_month(o, "order_date", path)
    return spark.read.schema(o.withColumn(files.MONTH, F.lit("")).schema).parquet(path)


_MONTH_SQL = "strftime(o_orderdate, '%Y-%m')"
_MONTH_ROWS_SQL = f"""
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date, {_MONTH_SQL} AS month
FROM orders"""


@query("part_month_prune", f"""
SELECT * FROM ({_MONTH_ROWS_SQL}) t WHERE order_date BETWEEN DATE '1996-03-01' AND DATE '1996-05-31'""")
def part_month_prune(spark, d):
    return files.between_dates(monthly_orders(spark, d), "order_date", "1996-03-01", "1996-05-31")


@query("partition_inventory", f"""
SELECT month, min(order_date) AS min_date, max(order_date) AS max_date, count(*) AS n_rows
FROM ({_MONTH_ROWS_SQL}) t GROUP BY month""")
def partition_inventory(spark, d):
    return files.partition_inventory(monthly_orders(spark, d), "order_date")


@query("partition_inventory_footers", f"""
SELECT month, min(order_date) AS min_date, max(order_date) AS max_date, count(*) AS n_rows
FROM ({_MONTH_ROWS_SQL}) t GROUP BY month""")
def partition_inventory_footers(spark, d):
    """The inventory from the files' statistics; no row is read."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice", fx.to_day("o_orderdate").alias("order_date"))
    path = scratch_path(spark, "orders_inventory")
    files.write_by_month(o, "order_date", path)
    return files.inventory_from_footers(spark, path, o.withColumn(files.MONTH, F.lit("")).schema, "order_date")


@query("part_single_month", f"SELECT * FROM ({_MONTH_ROWS_SQL}) t WHERE month = '1997-06'")
def part_single_month(spark, d):
    return files.single_month(monthly_orders(spark, d), "1997-06")


# ------------------------------------------- snapshot, view, batches


@query("matview_band_counts", f"""
SELECT map_band, count(*) AS n FROM (SELECT {_MAP_BAND_SQL} AS map_band FROM ({_MAP_ROWS_SQL}) t) b
GROUP BY map_band""")
def matview_band_counts(spark, d):
    snap = publish.materialize(map_rows(spark, d), scratch_path(spark, "map_snapshot"))
    return snap.groupBy("map_band").agg(F.count(F.lit(1)).alias("n"))


@query("matview_refresh", """
WITH changed AS (
  SELECT o_custkey % 100 AS customer_group, o_orderstatus,
         CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) + 10
              ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS price
  FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL
  SELECT o_custkey % 100, 'N', CAST(o_totalprice AS DECIMAL(18,2)) FROM orders WHERE o_orderkey % 11 = 0)
SELECT customer_group, o_orderstatus, count(*) AS n_rows, CAST(sum(price) AS DOUBLE) AS sum_price,
       CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price
FROM changed GROUP BY customer_group, o_orderstatus""")
def matview_refresh(spark, d):
    """A stored aggregate after an update, a delete and an insert of its table, refreshed from their changes."""
    o = Tables(spark, d).orders.select("o_orderkey", (F.col("o_custkey") % 100).alias("customer_group"), "o_orderstatus",
                                       "o_orderpriority", fx.money("o_totalprice").alias("price"))
    source, base = scratch_path(spark, "refresh_orders"), scratch_path(spark, "refresh_view")
    publish.publish(o, source)
    view = MaterializedView(AggregateView(("customer_group", "o_orderstatus"), ("price",), ("price",)), source, base)
    view.create(spark)

    def change(statement):
        tx = publish.begin(spark, source)
        tx.commit(statement(tx.read()), ["o_orderkey"])

    again = o.where(F.col("o_orderkey") % 11 == 0).withColumns(
        {"o_orderkey": -F.col("o_orderkey") - 1, "o_orderstatus": F.lit("N")})
    change(lambda t: dml.update(t, {"price": F.col("price") + 10}, F.col("o_orderpriority") == "5-LOW"))
    change(lambda t: dml.delete(t, F.col("o_orderkey") % 7 == 0))
    change(lambda t: dml.insert(t, again))
    view.refresh(spark)
    return view.read(spark).select("customer_group", "o_orderstatus", "n_rows", *[
        F.col(f"{agg}_price").cast("double").alias(f"{agg}_price") for agg in ("sum", "min", "max")])


@query("view_part_supp_nation", """
SELECT l_orderkey, l_linenumber, p_name, s_name, n_name
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey""")
def view_part_supp_nation(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = t.part.select("p_partkey", "p_name")
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    v = (li.join(p, li.l_partkey == p.p_partkey).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
           .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
           .select("l_orderkey", "l_linenumber", "p_name", "s_name", "n_name"))
    v.createOrReplaceTempView("v_part_supp_nation")
    return spark.sql("SELECT * FROM v_part_supp_nation")


@query("batch_load_ids", """
SELECT c_custkey, c_name, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 100 + 1 AS BIGINT) AS batch_id
FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)""")
def batch_load_ids(spark, d):
    c = Tables(spark, d).customer
    loaded = c.where(F.col("c_nationkey") < 5)
    src = c.select("c_custkey", "c_name")
    return pending_batches(src, loaded, ["c_custkey"], ["c_custkey"], batch_size=100)


@query("schema_evolve_customer", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_email
FROM customer""")
def schema_evolve_customer(spark, d):
    c = Tables(spark, d).customer
    return evolve(c, add={"c_email": "string"}, retype={"c_nationkey": "bigint"}, drop=["c_mktsegment"])


# ------------------------------------------------------ data quality

_SHIP_FRAME_SQL = """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, s.last_ship
FROM orders LEFT JOIN (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS last_ship
                       FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o_orderkey"""


@query("dq_not_null", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) AS n_rows FROM ({_SHIP_FRAME_SQL}) f"
    for c in ("o_orderkey", "o_custkey", "order_date", "last_ship")))
def dq_not_null(spark, d):
    t = Tables(spark, d)
    ship = t.lineitem.groupBy("l_orderkey").agg(F.max(fx.to_day("l_shipdate")).alias("last_ship"))
    o = t.orders.select("o_orderkey", "o_custkey", fx.to_day("o_orderdate").alias("order_date"))
    f = o.join(ship, o.o_orderkey == ship.l_orderkey, "left").select("o_orderkey", "o_custkey", "order_date",
                                                                     "last_ship")
    return quality.null_counts(f)


@query("dq_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dq_unique(spark, d):
    return quality.unique_violations(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


_FK_CHECKS = [
    ("lineitem_part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem_supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders_customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer_nation", "customer", "c_nationkey", "nation", "n_nationkey"),
]


@query("dq_foreign_key", " UNION ALL ".join(
    f"SELECT '{name}' AS constraint_name, count(*) AS n_violations FROM {child} "
    f"WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent})"
    for name, child, fk, parent, pk in _FK_CHECKS))
def dq_foreign_key(spark, d):
    t = Tables(spark, d)
    out = None
    for name, child, fk, parent, pk in _FK_CHECKS:
        bad = quality.foreign_key_violations(getattr(t, child).select(fk), [fk], getattr(t, parent), [pk])
        row = bad.agg(F.count(F.lit(1)).alias("n_violations")).select(
            F.lit(name).alias("constraint_name"), "n_violations")
        out = row if out is None else out.unionByName(row)
    return out


@query("dq_length", """
SELECT p_partkey, p_name, CAST(length(p_name) AS INTEGER) AS name_length FROM part WHERE length(p_name) > 10""")
def dq_length(spark, d):
    p = Tables(spark, d).part
    return quality.length_violations(p, "p_name", 10).select("p_partkey", "p_name",
                                                             F.char_length("p_name").alias("name_length"))


@query("dq_check", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date, CAST(o_orderdate AS DATE) AS order_date
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE NOT (l_shipdate >= o_orderdate)""")
def dq_check(spark, d):
    """CHECK (ship date >= order date) over the order lines."""
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    bad = quality.check_violations(j, F.col("l_shipdate") >= F.col("o_orderdate"))
    return bad.select("l_orderkey", "l_linenumber", fx.to_day("l_shipdate").alias("ship_date"),
                      fx.to_day("o_orderdate").alias("order_date"))


_SELF_POINTERS = {"manager": _MANAGER_SQL, "next_customer": "c_custkey + 1"}


@query("dq_self_fk", " UNION ALL ".join(f"""
SELECT '{name}' AS pointer, count(*) AS n_checked,
       count(*) FILTER (WHERE target IS NOT NULL AND target NOT IN (SELECT c_custkey FROM customer)) AS n_orphans
FROM (SELECT {sql} AS target FROM customer) t""" for name, sql in _SELF_POINTERS.items()))
def dq_self_fk(spark, d):
    """Pointers of all customers into their own table: the manager, and the
    next customer number (which the last customer lacks)."""
    c = Tables(spark, d).customer.select("c_custkey", manager_of().alias("manager"),
                                         (F.col("c_custkey") + 1).alias("next_customer"))
    out = None
    for name in _SELF_POINTERS:
        orphans = quality.foreign_key_violations(c.select(name), [name], c, ["c_custkey"])
        row = (c.select(F.lit(1).alias("checked"), F.lit(0).alias("orphan"))
                .unionByName(orphans.select(F.lit(0).alias("checked"), F.lit(1).alias("orphan")))
                .agg(F.coalesce(F.sum("checked"), F.lit(0)).alias("n_checked"),
                     F.coalesce(F.sum("orphan"), F.lit(0)).alias("n_orphans"))
                .select(F.lit(name).alias("pointer"), "n_checked", "n_orphans"))
        out = row if out is None else out.unionByName(row)
    return out


PROFILED_AT = "2024-01-01 00:00:00"


@query("profile_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, (count(*) - count({c})) / count(*) AS null_frac, "
    f"count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS min_value, "
    f"CAST(max({c}) AS VARCHAR) AS max_value, TIMESTAMP '{PROFILED_AT}' AS profiled_at FROM customer"
    for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")))
def profile_columns(spark, d):
    return prof.profile(Tables(spark, d).customer, profiled_at=PROFILED_AT)


_FREQUENT = [("part", "p_type"), ("customer", "c_nationkey"), ("lineitem", "l_shipdate")]


@query("profile_frequent", " UNION ALL ".join(f"""
SELECT * FROM (SELECT '{col}' AS column_name, strftime({col}, '%Y-%m-%d') AS value, count(*) AS freq FROM {table}
               GROUP BY 2 ORDER BY freq DESC, value NULLS LAST LIMIT 5) t{i}""" if col == "l_shipdate" else f"""
SELECT * FROM (SELECT '{col}' AS column_name, CAST({col} AS VARCHAR) AS value, count(*) AS freq FROM {table}
               GROUP BY 2 ORDER BY freq DESC, value NULLS LAST LIMIT 5) t{i}"""
    for i, (table, col) in enumerate(_FREQUENT)))
def profile_frequent(spark, d):
    """The five most common values of a column, as a planner's statistics list them."""
    t = Tables(spark, d)
    out = None
    for table, col in _FREQUENT:
        value = F.date_format(col, "yyyy-MM-dd") if col == "l_shipdate" else F.col(col).cast("string")
        top = prof.frequent_values(getattr(t, table).select(value.alias("value")), "value")
        top = top.select(F.lit(col).alias("column_name"), "value", "freq")
        out = top if out is None else out.unionByName(top)
    return out


_SKETCHED = ("l_extendedprice", "l_partkey", "l_shipdate", "l_returnflag")


@query("profile_sketches", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) AS n_rows, (count(*) - count({c})) / count(*) AS null_frac, TRUE AS distinct_within,
       {'TRUE' if c != 'l_returnflag' else 'NULL'} AS bounds_within FROM lineitem""" for c in _SKETCHED))
def profile_sketches(spark, d):
    """Statistics merged from sketches stored per ship month, held against exact counts: distinct values within 5%,
    and every histogram bound within 2% of the rows of its share."""
    li = Tables(spark, d).lineitem.select(*_SKETCHED)
    stored = publish.materialize(prof.sketches(li, files.month_key("l_shipdate"), _SKETCHED), scratch_path(spark, "sketches"))
    found = prof.from_sketches(stored, _SKETCHED)
    exact = prof.profile(li, _SKETCHED).select(F.col("column_name").alias("c"), F.col("n_distinct").alias("exact"))
    # The four rows of bounds meet every row once: for each bound, the rows below it and up to it.
    drawn = found.where(F.col("bounds").isNotNull()).select("column_name", F.posexplode("bounds").alias("j", "bound"))
    number = {"l_extendedprice": F.col("l_extendedprice"), "l_partkey": F.col("l_partkey").cast("double"),
              "l_shipdate": fx.ntz_micros(F.col("l_shipdate").cast("timestamp_ntz")).cast("double")}
    values = prof.value_counts(li.select(*[x.alias(c) for c, x in number.items()]), list(number)).select(
        F.col("column_name").alias("vc"), F.col("value").cast("double").alias("x"), "freq")
    ranks = values.join(F.broadcast(drawn), F.col("vc") == F.col("column_name")).groupBy("column_name", "j").agg(
        (F.sum(F.when(F.col("x") < F.col("bound"), F.col("freq")).otherwise(0)) / F.sum("freq")).alias("below"),
        (F.sum(F.when(F.col("x") <= F.col("bound"), F.col("freq")).otherwise(0)) / F.sum("freq")).alias("upto"))
    share = F.col("j") / 10
    within = ranks.groupBy(F.col("column_name").alias("b")).agg(
        F.bool_and((F.col("below") - 0.02 <= share) & (share <= F.col("upto") + 0.02)).alias("bounds_within"))
    out = found.join(F.broadcast(exact), F.col("column_name") == F.col("c")).join(F.broadcast(within), F.col("column_name") == F.col("b"), "left")
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))
    return out.select("column_name", "n_rows", "null_frac", close.alias("distinct_within"), "bounds_within")
