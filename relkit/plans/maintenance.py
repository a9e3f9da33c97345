"""Table maintenance queries: each returns the new snapshot, the RETURNING
rows or the audit rows of a DML job over the base tables (the tables
themselves are never modified)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..operators import dml, keys as keyops, publish
from ..operators.cascade import CASCADE, SET_NULL, ForeignKey, Schema
from ..operators.dml import S, When
from ..session import scratch_path
from ..sources.tables import Tables
from ..sources.temp import TempTable
from . import sqltext as q
from .registry import query

AUDIT_AT = "2024-01-01 00:00:00"  # injected clock, so audit rows are reproducible
_NEXT_PART = "(SELECT max(p_partkey) + 1 FROM part)"
_PART_COLS = "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice"


def _next_key(df, col):
    return df.agg(F.max(col) + F.lit(1)).scalar()


def _priced(factor: str):
    return fx.round_money(fx.money("p_retailprice") * fx.dec(factor))


def _priced_sql(factor: str) -> str:
    return q.round_money(f"{q.money('p_retailprice')} * {factor}")


def _new_parts(p):
    base = _next_key(p, "p_partkey")
    return p.where(F.col("p_size") == 1).select((F.col("p_partkey") + base).alias("p_partkey"),
                                                 F.concat("p_name", F.lit(" v2")).alias("p_name"),
                                                 "p_retailprice")


_NEW_PARTS_SQL = f"""
SELECT p_partkey + {_NEXT_PART} AS p_partkey, p_name || ' v2' AS p_name, p_retailprice FROM part WHERE p_size = 1"""


@query("dml_insert", f"""
SELECT * FROM part UNION ALL
SELECT p_partkey, p_name, NULL, NULL, 0, p_retailprice FROM ({_NEW_PARTS_SQL}) n""")
def dml_insert(spark, d):
    p = Tables(spark, d).part
    return dml.insert(p, _new_parts(p), defaults={"p_size": 0}).snapshot


@query("audit_insert", f"""
SELECT row_number() OVER (ORDER BY p_partkey) AS audit_id, p_partkey, 'loader' AS user_name,
       TIMESTAMP '{AUDIT_AT}' AS changed_at
FROM ({_NEW_PARTS_SQL}) n""")
def audit_insert(spark, d):
    p = Tables(spark, d).part
    audit = dml.insert(p, _new_parts(p), defaults={"p_size": 0}, audit_keys=["p_partkey"],
                       at=AUDIT_AT, user="loader").audit
    return keyops.assign_ids(audit, ["p_partkey"], "audit_id").select("audit_id", "p_partkey", "user_name",
                                                                       "changed_at")


@query("dml_update", f"""
SELECT p_partkey, p_name, p_brand, p_type, p_size,
       CASE WHEN p_type = 'PROMO' THEN {_priced_sql('1.10')} ELSE p_retailprice END AS p_retailprice
FROM part""")
def dml_update(spark, d):
    p = Tables(spark, d).part
    return dml.update(p, {"p_retailprice": _priced("1.10")}, F.col("p_type") == "PROMO").snapshot


@query("dml_fill_unknown", """
SELECT c_custkey, COALESCE(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END, 'Unknown') AS c_segment_code
FROM customer""")
def dml_fill_unknown(spark, d):
    c = Tables(spark, d).customer
    target = c.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
                      .alias("c_segment_code"))
    return dml.update(target, {"c_segment_code": F.lit("Unknown")}, F.col("c_segment_code").isNull()).snapshot


_DELETE_PRED_SQL = "l_returnflag = 'R' AND l_discount > 0.08"


def _delete_lines(spark, d):
    li = Tables(spark, d).lineitem
    return dml.delete(li, (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.08))


@query("dml_delete", f"SELECT * FROM lineitem WHERE NOT COALESCE({_DELETE_PRED_SQL}, FALSE)")
def dml_delete(spark, d):
    return _delete_lines(spark, d).snapshot


@query("dml_delete_returning", f"SELECT * FROM lineitem WHERE {_DELETE_PRED_SQL}")
def dml_delete_returning(spark, d):
    return _delete_lines(spark, d).returning


_UPSERT_SRC_SQL = f"""
SELECT p_partkey, upper(p_name) AS p_name, p_brand, p_type, p_size, {_priced_sql('0.90')} AS p_retailprice
FROM part WHERE p_size > 45
UNION ALL
SELECT p_partkey + {_NEXT_PART}, p_name || ' v2', p_brand, p_type, p_size, p_retailprice FROM part WHERE p_size = 1"""


@query("dml_upsert", f"""
WITH src AS ({_UPSERT_SRC_SQL})
SELECT * FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM src)
UNION ALL SELECT * FROM src""")
def dml_upsert(spark, d):
    p = Tables(spark, d).part
    base = _next_key(p, "p_partkey")
    upd = p.where(F.col("p_size") > 45).select("p_partkey", F.upper("p_name").alias("p_name"), "p_brand", "p_type",
                                                "p_size", _priced("0.90").alias("p_retailprice"))
    new = p.where(F.col("p_size") == 1).select((F.col("p_partkey") + base).alias("p_partkey"),
                                                F.concat("p_name", F.lit(" v2")).alias("p_name"),
                                                "p_brand", "p_type", "p_size", "p_retailprice")
    return dml.upsert(p, upd.unionByName(new), ["p_partkey"]).snapshot


_MERGE_SRC_SQL = f"""
SELECT p_partkey, upper(p_name) AS name, CAST({q.money('p_retailprice')} - 10 AS DOUBLE) AS price,
       CASE WHEN p_size % 7 = 0 THEN 1 ELSE 0 END AS disc, p_type AS ptype, p_size AS psize
FROM part WHERE p_size >= 45
UNION ALL
SELECT p_partkey + {_NEXT_PART}, p_name || ' new', p_retailprice, CASE WHEN p_size = 2 THEN 1 ELSE 0 END,
       p_type, p_size
FROM part WHERE p_size <= 2"""


@query("dml_merge", f"""
WITH src AS ({_MERGE_SRC_SQL})
SELECT * FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM src)
UNION ALL
SELECT p.p_partkey, s.name, p.p_brand, p.p_type, p.p_size, s.price
FROM part p JOIN src s ON p.p_partkey = s.p_partkey WHERE s.disc = 0
UNION ALL
SELECT s.p_partkey, s.name, NULL, s.ptype, s.psize, s.price
FROM src s WHERE s.disc = 0 AND s.p_partkey NOT IN (SELECT p_partkey FROM part)""")
def dml_merge(spark, d):
    """MERGE: matched & discontinued -> delete; matched -> update name and
    price; not matched & not discontinued -> insert."""
    p = Tables(spark, d).part
    base = _next_key(p, "p_partkey")
    existing = p.where(F.col("p_size") >= 45).select(
        "p_partkey", F.upper("p_name").alias("name"), (fx.money("p_retailprice") - 10).cast("double").alias("price"),
        F.when(F.col("p_size") % 7 == 0, 1).otherwise(0).alias("disc"), F.col("p_type").alias("ptype"),
        F.col("p_size").alias("psize"))
    new = p.where(F.col("p_size") <= 2).select(
        (F.col("p_partkey") + base).alias("p_partkey"), F.concat("p_name", F.lit(" new")).alias("name"),
        F.col("p_retailprice").alias("price"), F.when(F.col("p_size") == 2, 1).otherwise(0).alias("disc"),
        F.col("p_type").alias("ptype"), F.col("p_size").alias("psize"))
    clauses = [
        When(True, "delete", S("disc") == 1),
        When(True, {"p_name": S("name"), "p_retailprice": S("price")}, S("disc") == 0),
        When(False, {"p_partkey": S("p_partkey"), "p_name": S("name"), "p_type": S("ptype"),
                     "p_size": S("psize"), "p_retailprice": S("price")}, S("disc") == 0),
    ]
    return dml.merge(p, existing.unionByName(new), ["p_partkey"], clauses).snapshot


@query("dml_merge_temp", f"""
WITH src AS (SELECT p_partkey, CAST({q.money('p_retailprice')} - 10 AS DOUBLE) AS price, p_size % 2 AS disc, p_name AS name
             FROM part WHERE p_size >= 40
             UNION ALL SELECT p_partkey + {_NEXT_PART}, p_retailprice, 0, p_name || ' new' FROM part WHERE p_size <= 2)
SELECT * FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM src)
UNION ALL SELECT p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size, s.price FROM part p JOIN src s USING (p_partkey) WHERE s.disc = 0
UNION ALL SELECT p_partkey, name, NULL, NULL, NULL, price FROM src WHERE disc = 0 AND p_partkey NOT IN (SELECT p_partkey FROM part)""")
def dml_merge_temp(spark, d):
    """CREATE TEMP TABLE, two INSERTs into it, and a MERGE that reads it by name."""
    p = Tables(spark, d).part
    base = _next_key(p, "p_partkey")
    updates = TempTable(spark, f"updated_products_{uuid.uuid4().hex[:8]}", "product bigint, name string, price double, disc int")
    updates.insert(p.where(F.col("p_size") >= 40).select(
        F.col("p_partkey").alias("product"), F.col("p_name").alias("name"),
        (fx.money("p_retailprice") - 10).cast("double").alias("price"), (F.col("p_size") % 2).alias("disc")))
    updates.insert(p.where(F.col("p_size") <= 2).select(
        (F.col("p_partkey") + base).alias("product"), F.concat("p_name", F.lit(" new")).alias("name"),
        F.col("p_retailprice").alias("price")), defaults={"disc": 0})
    source = updates.read().withColumnRenamed("product", "p_partkey")
    clauses = [When(True, "delete", S("disc") == 1), When(True, {"p_retailprice": S("price")}, S("disc") == 0),
               When(False, {"p_partkey": S("p_partkey"), "p_name": S("name"), "p_retailprice": S("price")}, S("disc") == 0)]
    return dml.merge(p, source, ["p_partkey"], clauses).snapshot


@query("dml_cascade_update", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3)
            THEN l_suppkey + (SELECT max(s_suppkey) + 1 FROM supplier) ELSE l_suppkey END AS l_suppkey
FROM lineitem""")
def dml_cascade_update(spark, d):
    t = Tables(spark, d)
    s = t.supplier
    base = _next_key(s, "s_suppkey")
    key_map = s.where(F.col("s_nationkey") == 3).select(F.col("s_suppkey").alias("old_key"),
                                                          (F.col("s_suppkey") + base).alias("new_key"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dml.cascade_update(li, "l_suppkey", key_map)


@query("dml_cascade_delete", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')""")
def dml_cascade_delete(spark, d):
    """DELETE category PROMO -> its products -> their order lines."""
    t = Tables(spark, d)
    parts = t.part.select("p_partkey", "p_type")
    level1 = dml.delete(parts, F.col("p_type") == "PROMO")  # products of the deleted category
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return dml.cascade_delete(li, "l_partkey", level1.returning, "p_partkey").snapshot


_CASCADE_GONE_SQL = """
WITH RECURSIVE made AS (SELECT p_partkey, p_type, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_partkey - 1 END AS made_from
                        FROM part),
gone AS (SELECT p_partkey FROM made WHERE p_type = 'PROMO'
         UNION SELECT m.p_partkey FROM made m JOIN gone g ON m.made_from = g.p_partkey)"""


def _shop(spark, d):
    """Categories, products (some made from the one before), order lines and suppliers' featured products."""
    t = Tables(spark, d)
    made_from = F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey") - 1)
    tables = {"category": t.part.select("p_type").distinct(),
              "product": t.part.select("p_name", "p_partkey", "p_type", made_from.alias("made_from")),
              "line": t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
              "supplier": t.supplier.select("s_name", "s_suppkey", F.col("s_suppkey").alias("featured"))}
    # Line numbers repeat within an order in these tables; with the product they name the lines that go together.
    keys = {"category": ("p_type",), "product": ("p_partkey",), "line": ("l_orderkey", "l_linenumber", "l_partkey"),
            "supplier": ("s_suppkey",)}
    part = ("p_partkey",)
    return Schema(tables, keys, [
        ForeignKey("product", ("p_type",), "category", ("p_type",), CASCADE),
        ForeignKey("product", ("made_from",), "product", part, CASCADE, CASCADE),
        ForeignKey("line", ("l_partkey",), "product", part, CASCADE, CASCADE),
        ForeignKey("supplier", ("featured",), "product", part, SET_NULL, SET_NULL)])


@query("dml_cascade_graph", f"""{_CASCADE_GONE_SQL}
SELECT 'category' AS table_name, p_type AS key, CAST(NULL AS BIGINT) AS pointer FROM (SELECT DISTINCT p_type FROM part) c
WHERE p_type <> 'PROMO'
UNION ALL SELECT 'product', p_name, p_partkey FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM gone)
UNION ALL SELECT 'line', l_orderkey || '-' || l_linenumber, l_partkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM gone)
UNION ALL SELECT 'supplier', s_name, CASE WHEN s_suppkey IN (SELECT p_partkey FROM gone) THEN NULL ELSE s_suppkey END
FROM supplier""")
def dml_cascade_graph(spark, d):
    """DELETE of a category: its products, what is made from them, their lines; featured products become NULL."""
    out = _shop(spark, d).delete("category", F.col("p_type") == "PROMO")
    kept = {name: res.snapshot for name, res in out.items()}
    shown = [
        kept["category"].select(F.lit("category").alias("table_name"), F.col("p_type").alias("key"),
                                F.lit(None).cast("long").alias("pointer")),
        kept["product"].select(F.lit("product"), "p_name", "p_partkey"),
        kept["line"].select(F.lit("line"), F.concat_ws("-", "l_orderkey", "l_linenumber"), "l_partkey"),
        kept["supplier"].select(F.lit("supplier"), "s_name", "featured")]
    result = shown[0]
    for df in shown[1:]:
        result = result.union(df)
    return result


_NEW_KEY_SQL = f"CASE WHEN {{0}} % 20 = 3 AND {{0}} IN (SELECT p_partkey FROM part) THEN {{0}} + {_NEXT_PART} ELSE {{0}} END"


@query("dml_cascade_keys", f"""
SELECT 'product' AS table_name, {_NEW_KEY_SQL.format('p_partkey')} AS key,
       {_NEW_KEY_SQL.format('made_from')} AS pointer
FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_partkey - 1 END AS made_from FROM part) p
UNION ALL SELECT 'line', l_orderkey * 10 + l_linenumber, {_NEW_KEY_SQL.format('l_partkey')} FROM lineitem
UNION ALL SELECT 'supplier', s_suppkey,
  CASE WHEN s_suppkey % 20 = 3 AND s_suppkey IN (SELECT p_partkey FROM part) THEN NULL ELSE s_suppkey END FROM supplier""")
def dml_cascade_keys(spark, d):
    """UPDATE of product keys: the self reference and the lines follow, featured products become NULL."""
    shop = _shop(spark, d)
    p = shop.tables["product"]
    base = _next_key(p, "p_partkey")
    key_map = p.where(F.col("p_partkey") % 20 == 3).select(F.col("p_partkey").alias("old_key"),
                                                           (F.col("p_partkey") + base).alias("new_key"))
    kept = {name: res.snapshot for name, res in shop.update_keys("product", "p_partkey", key_map).items()}
    return (kept["product"].select(F.lit("product").alias("table_name"), F.col("p_partkey").alias("key"),
                                   F.col("made_from").alias("pointer"))
            .union(kept["line"].select(F.lit("line"), F.col("l_orderkey") * 10 + F.col("l_linenumber"), "l_partkey"))
            .union(kept["supplier"].select(F.lit("supplier"), "s_suppkey", "featured")))


@query("dml_set_null", """
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 5)
                        THEN NULL ELSE o_custkey END AS o_custkey
FROM orders""")
def dml_set_null(spark, d):
    t = Tables(spark, d)
    deleted = dml.delete(t.customer, F.col("c_nationkey") == 5).returning
    return dml.set_null(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", deleted, "c_custkey")


@query("dml_view_update", f"""
SELECT p_partkey, p_name, p_brand, p_type, p_size,
       CASE WHEN p_size < 10 AND p_type = 'SMALL' THEN {_priced_sql('1.10')} ELSE p_retailprice END AS p_retailprice
FROM part""")
def dml_view_update(spark, d):
    p = Tables(spark, d).part
    res = dml.update_through_view(p, F.col("p_size") < 10, {"p_retailprice": _priced("1.10")},
                                  F.col("p_type") == "SMALL")
    return res.snapshot


@query("dml_reprice", f"""
SELECT p_partkey, p_retailprice AS old_price,
       CASE WHEN p_retailprice < 950 THEN {_priced_sql('1.10')} ELSE {_priced_sql('0.95')} END AS new_price
FROM part WHERE p_size % 7 <> 0""")
def dml_reprice(spark, d):
    """The cursor loop as one expression over the live (not discontinued) rows."""
    p = Tables(spark, d).part
    price = F.when(F.col("p_retailprice") < 950, _priced("1.10")).otherwise(_priced("0.95"))
    res = dml.update(p, {"p_retailprice": price}, F.col("p_size") % 7 != 0, audit_keys=["p_partkey"])
    return res.audit.select("p_partkey", F.col("old_p_retailprice").alias("old_price"),
                            F.col("new_p_retailprice").alias("new_price"))


@query("audit_update_prices", f"""
SELECT row_number() OVER (ORDER BY p_partkey) AS audit_id, p_partkey, p_name, p_retailprice AS old_price,
       CASE WHEN p_size > 45 THEN {_priced_sql('1.05')} ELSE p_retailprice END AS new_price,
       'auditor' AS user_name, TIMESTAMP '{AUDIT_AT}' AS changed_at
FROM part WHERE p_type = 'PROMO'""")
def audit_update_prices(spark, d):
    """Every updated row is logged, also when its price did not change."""
    p = Tables(spark, d).part
    price = F.when(F.col("p_size") > 45, _priced("1.05")).otherwise(F.col("p_retailprice"))
    res = dml.update(p, {"p_retailprice": price}, F.col("p_type") == "PROMO",
                     audit_keys=["p_partkey", "p_name"], at=AUDIT_AT, user="auditor")
    ided = keyops.assign_ids(res.audit, ["p_partkey"], "audit_id")
    return ided.select("audit_id", "p_partkey", "p_name", F.col("old_p_retailprice").alias("old_price"),
                       F.col("new_p_retailprice").alias("new_price"), "user_name", "changed_at")


@query("audit_session", """
SELECT 'DELETE' AS operation, p_partkey, TRUE AS by_session_user, current_date AS changed_on, TRUE AS within_statement
FROM part WHERE p_size = 50""")
def audit_session(spark, d):
    """Audit rows with the session's own user, date and statement time (CURRENT_USER, CURRENT_DATE, CURRENT_TIMESTAMP)."""
    before = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    audit = dml.delete(Tables(spark, d).part, F.col("p_size") == 50, audit_keys=["p_partkey"]).audit
    recent = F.col("changed_at") >= F.lit(before)
    return audit.select("operation", "p_partkey", (F.col("user_name") == F.current_user()).alias("by_session_user"),
                        F.to_date("changed_at").alias("changed_on"),
                        (recent & (F.to_date("changed_at") == F.current_date())).alias("within_statement"))


@query("audit_all_ops", f"""
WITH ins AS (SELECT p_partkey + {_NEXT_PART} AS p_partkey, p_type, p_size FROM part WHERE p_size = 1),
     s1 AS (SELECT p_partkey, p_type, p_size FROM part UNION ALL SELECT * FROM ins)
SELECT 'INSERT' AS operation, p_partkey FROM ins
UNION ALL SELECT 'UPDATE', p_partkey FROM s1 WHERE p_type = 'SMALL' AND p_size < 5
UNION ALL SELECT 'DELETE', p_partkey FROM s1 WHERE p_size = 50""")
def audit_all_ops(spark, d):
    """INSERT, a no-op UPDATE and a DELETE in sequence; all are audited."""
    p = Tables(spark, d).part.select("p_partkey", "p_type", "p_size")
    base = _next_key(p, "p_partkey")
    new = p.where(F.col("p_size") == 1).select((F.col("p_partkey") + base).alias("p_partkey"), "p_type", "p_size")
    r1 = dml.insert(p, new, audit_keys=["p_partkey"])
    r2 = dml.update(r1.snapshot, {"p_type": F.lit("SMALL")},
                    (F.col("p_type") == "SMALL") & (F.col("p_size") < 5), audit_keys=["p_partkey"])
    r3 = dml.delete(r2.snapshot, F.col("p_size") == 50, audit_keys=["p_partkey"])
    cols = ["operation", "p_partkey"]
    return r1.audit.select(*cols).unionByName(r2.audit.select(*cols)).unionByName(r3.audit.select(*cols))


_FIRST_ORDER_SQL = """
SELECT DISTINCT ON (o_custkey) o_custkey AS c_custkey, o_orderkey FROM orders
ORDER BY o_custkey, o_orderdate, o_orderkey"""
_TARGET_KEYS_SQL = "SELECT c_custkey FROM customer WHERE c_nationkey < 20"


def _registrations(spark, d):
    t = Tables(spark, d)
    target = t.customer.where(F.col("c_nationkey") < 20).select("c_custkey")
    batch = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate")
    return dml.insert_new_only(target, batch, ["c_custkey"], ["o_orderdate", "o_orderkey"])


@query("dml_insert_new_only", f"""
SELECT c_custkey, o_orderkey FROM ({_FIRST_ORDER_SQL}) f WHERE c_custkey NOT IN ({_TARGET_KEYS_SQL})""")
def dml_insert_new_only(spark, d):
    accepted, _ = _registrations(spark, d)
    return accepted.select("c_custkey", "o_orderkey")


@query("dml_rejected_dups", f"""
SELECT c_custkey, o_orderkey, 'key exists' AS reason FROM ({_FIRST_ORDER_SQL}) f
WHERE c_custkey IN ({_TARGET_KEYS_SQL})
UNION ALL
SELECT o_custkey, o_orderkey, 'duplicate in batch' FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_FIRST_ORDER_SQL}) f2)""")
def dml_rejected_dups(spark, d):
    _, rejected = _registrations(spark, d)
    return rejected.select("c_custkey", "o_orderkey", "reason")


@query("guarded_update", f"""
SELECT p_partkey, {_priced_sql('1.10')} AS new_price FROM part
WHERE p_type = 'PROMO' AND {_priced_sql('1.10')} > 1050""")
def guarded_update(spark, d):
    """BEGIN; UPDATE ...; abort if any new price > 1050; COMMIT.

    The new snapshot is published as a version only when the violation set
    is empty; the query returns the violations (empty = committed).
    """
    p = Tables(spark, d).part
    res = dml.update(p, {"p_retailprice": _priced("1.10")}, F.col("p_type") == "PROMO")
    violations = res.returning.where(F.col("p_retailprice") > 1050).select(
        "p_partkey", F.col("p_retailprice").alias("new_price"))
    publish.publish(res.snapshot, scratch_path(spark, "guarded_part"), guard=violations)
    return violations


@query("guarded_commit", f"""
SELECT p_partkey, p_type, CASE WHEN p_type = 'PROMO' THEN {_priced_sql('1.10')} ELSE p_retailprice END AS p_retailprice
FROM part""")
def guarded_commit(spark, d):
    """A guarded update that commits, a later one that aborts, and the version read back.

    The first guard (no price below zero) finds nothing, so the repriced
    snapshot is published; the second (any price at all) fires, so the emptied
    table it guards is not.
    """
    p = Tables(spark, d).part
    base = scratch_path(spark, "committed_part")
    res = dml.update(p, {"p_retailprice": _priced("1.10")}, F.col("p_type") == "PROMO")
    publish.publish(res.snapshot, base, guard=res.returning.where(F.col("p_retailprice") < 0))
    committed = publish.read_current(spark, base)
    publish.publish(committed.limit(0), base, guard=committed.where(F.col("p_retailprice") >= 0))
    return publish.read_current(spark, base).select("p_partkey", "p_type", "p_retailprice")


@query("publish_conflict", f"""
SELECT p_partkey,
       CASE p_type WHEN 'PROMO' THEN {_priced_sql('1.10')} WHEN 'SMALL' THEN {_priced_sql('0.90')}
                   ELSE p_retailprice END AS p_retailprice,
       p_type, 'committed as 2, rebased as 3, conflict' AS outcome
FROM part WHERE p_size < 50 OR p_type <> 'SMALL'""")
def publish_conflict(spark, d):
    """Three writers that read one version: a repricing, a disjoint repricing with a
    delete, and one that wants the first one's rows; the last is refused."""
    base = scratch_path(spark, "conflict_part")
    publish.publish(Tables(spark, d).part.select("p_retailprice", "p_partkey", "p_type", "p_size"), base)
    writers = [publish.begin(spark, base) for _ in range(3)]
    promo, small, late = (w.read() for w in writers)
    price = lambda factor: {"p_retailprice": _priced(factor)}
    first = dml.update(promo, price("1.10"), F.col("p_type") == "PROMO")
    cheaper = dml.update(small, price("0.90"), (F.col("p_type") == "SMALL") & (F.col("p_size") < 50))
    gone = dml.delete(cheaper.snapshot, (F.col("p_type") == "SMALL") & (F.col("p_size") >= 50))
    second = dml.DmlResult(gone.snapshot, delta=cheaper.delta.unionByName(gone.delta))
    outcome = [f"committed as {writers[0].commit(first, ['p_partkey'])}",
               f"rebased as {writers[1].commit(second, ['p_partkey'])}"]
    try:
        writers[2].commit(dml.update(late, price("2.00"), F.col("p_type") == "PROMO"), ["p_partkey"])
        outcome.append("lost update")
    except publish.PublishConflict:
        outcome.append("conflict")
    return publish.read_current(spark, base).select("p_partkey", "p_retailprice", "p_type",
                                                    F.lit(", ".join(outcome)).alias("outcome"))


@query("dml_upsert_key_last", f"""
WITH src AS ({_UPSERT_SRC_SQL})
SELECT p_name, p_retailprice, p_partkey FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM src)
UNION ALL SELECT p_name, p_retailprice, p_partkey FROM src""")
def dml_upsert_key_last(spark, d):
    """The upsert on a table whose key is its last column: the snapshot keeps that order."""
    p = Tables(spark, d).part
    base = _next_key(p, "p_partkey")
    target = p.select("p_name", "p_retailprice", "p_partkey")
    upd = p.where(F.col("p_size") > 45).select(F.upper("p_name").alias("p_name"), _priced("0.90").alias("p_retailprice"),
                                               "p_partkey")
    new = p.where(F.col("p_size") == 1).select(F.concat("p_name", F.lit(" v2")).alias("p_name"), "p_retailprice",
                                               (F.col("p_partkey") + base).alias("p_partkey"))
    return dml.upsert(target, upd.unionByName(new), ["p_partkey"]).snapshot
