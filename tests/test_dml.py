from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from relkit.operators import dml
from relkit.operators.dml import S, When

PRODUCTS = "productid int, productname string, unitprice decimal(10,2), discontinued int, categoryid int"


def _target(spark):
    return spark.createDataFrame([(100, "Tea", Decimal("10.00"), 0, 1), (101, "Coffee", Decimal("12.00"), 0, 1)],
                                 PRODUCTS)


def test_merge_reference_fixture(spark):
    # Source rows of the reference MERGE: 100 discontinued, 101 repriced, 102/103 new.
    src = spark.createDataFrame([(100, "Tea", Decimal("10.00"), 1, 1), (101, "Coffee", Decimal("19.99"), 0, 1),
                                 (102, "Cocoa", Decimal("5.00"), 0, 2), (103, "Mate", Decimal("7.00"), 0, 2)],
                                PRODUCTS)
    clauses = [
        When(True, "delete", S("discontinued") == 1),
        When(True, {"productname": S("productname"), "unitprice": S("unitprice")}, S("discontinued") == 0),
        When(False, {c: S(c) for c in ["productid", "productname", "unitprice", "discontinued", "categoryid"]},
             S("discontinued") == 0),
    ]
    res = dml.merge(_target(spark), src, ["productid"], clauses)
    assert rows(res.snapshot, "productid", "unitprice") == [(101, Decimal("19.99")), (102, Decimal("5.00")),
                                                            (103, Decimal("7.00"))]
    assert rows(res.audit, "operation", "productid") == [("DELETE", 100), ("INSERT", 102), ("INSERT", 103),
                                                         ("UPDATE", 101)]


def test_merge_rejects_double_match(spark):
    src = spark.createDataFrame([(101, "A", Decimal("1.00"), 0, 1), (101, "B", Decimal("2.00"), 0, 1)], PRODUCTS)
    with pytest.raises(ValueError):
        dml.merge(_target(spark), src, ["productid"], [When(True, {"unitprice": S("unitprice")})])


def test_upsert_excluded_wins_and_duplicates_rejected(spark):
    src = spark.createDataFrame([(101, "Coffee", Decimal("15.00"), 0, 1), (102, "Cocoa", Decimal("5.00"), 0, 2)],
                                PRODUCTS)
    res = dml.upsert(_target(spark), src, ["productid"])
    assert rows(res.snapshot, "productid", "unitprice") == [(100, Decimal("10.00")), (101, Decimal("15.00")),
                                                            (102, Decimal("5.00"))]
    assert rows(res.audit, "operation", "productid") == [("INSERT", 102), ("UPDATE", 101)]
    dup = src.unionByName(src)
    with pytest.raises(ValueError):
        dml.upsert(_target(spark), dup, ["productid"])


def test_update_null_predicate_keeps_row_and_noop_is_audited(spark):
    df = spark.createDataFrame([(1, "White"), (2, None), (3, "Black")], "id int, ethnicity string")
    res = dml.update(df, {"ethnicity": F.lit("White")}, F.col("ethnicity") == "White", audit_keys=["id"])
    assert rows(res.snapshot) == rows(df)          # no-op update
    assert rows(res.audit, "id", "old_ethnicity", "new_ethnicity") == [(1, "White", "White")]
    fill = dml.update(df, {"ethnicity": F.lit("Unknown")}, F.col("ethnicity").isNull())
    assert rows(fill.snapshot, "id", "ethnicity") == [(1, "White"), (2, "Unknown"), (3, "Black")]


def test_delete_returning_and_null_predicate(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, v int")
    res = dml.delete(df, F.col("v") > 10)
    assert rows(res.snapshot, "id") == [(1,), (2,)]
    assert rows(res.returning, "id") == [(3,)]


def test_insert_by_name_with_defaults(spark):
    df = spark.createDataFrame([(1, "a", 3)], "id int, name string, qty int")
    new = spark.createDataFrame([(2, "b")], "id int, name string")
    res = dml.insert(df, new, defaults={"qty": 0}, audit_keys=["id"])
    assert rows(res.snapshot) == [(1, "a", 3), (2, "b", 0)]
    assert rows(res.audit, "operation", "id") == [("INSERT", 2)]


def test_cascades(spark):
    parent_map = spark.createDataFrame([(1, 1001)], "old_key int, new_key int")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id int, fk int")
    assert rows(dml.cascade_update(child, "fk", parent_map)) == [(10, 1001), (11, 2), (12, None)]
    deleted = spark.createDataFrame([(2,)], "k int")
    assert rows(dml.cascade_delete(child, "fk", deleted, "k").snapshot, "id") == [(10,), (12,)]
    assert rows(dml.set_null(child, "fk", deleted, "k")) == [(10, 1), (11, None), (12, None)]


def test_view_check_option(spark):
    df = spark.createDataFrame([(1, 5), (2, 50)], "id int, stock int")
    ok = dml.update_through_view(df, F.col("stock") < 10, {"stock": F.col("stock") + 1})
    assert rows(ok.snapshot) == [(1, 6), (2, 50)]
    with pytest.raises(ValueError):
        dml.update_through_view(df, F.col("stock") < 10, {"stock": F.col("stock") + 100})


def test_insert_new_only(spark):
    target = spark.createDataFrame([(1,)], "pid int")
    batch = spark.createDataFrame([(1, 1), (2, 2), (2, 3), (3, 4)], "pid int, seq int")
    acc, rej = dml.insert_new_only(target, batch, ["pid"], ["seq"])
    assert rows(acc) == [(2, 2), (3, 4)]
    assert rows(rej, "pid", "seq", "reason") == [(1, 1, "key exists"), (2, 3, "duplicate in batch")]


def test_insert_new_only_loses_no_row(spark):
    target = spark.createDataFrame([(9,)], "pid int")
    batch = spark.createDataFrame([(5, 1), (5, 1), (5, 1), (6, None), (6, None), (None, 1), (None, 1)], "pid int, seq int")
    acc, rej = dml.insert_new_only(target, batch, ["pid"], ["seq"])
    assert rows(acc) == rows(spark.createDataFrame([(5, 1), (6, None), (None, 1), (None, 1)], "pid int, seq int"))
    assert rows(rej.drop("reason")) == rows(spark.createDataFrame([(5, 1), (5, 1), (6, None)], "pid int, seq int"))


def test_insert_names_resolve_or_raise(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    assert rows(dml.insert(df, spark.createDataFrame([(2, "b")], "id int, NAME string")).snapshot) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        dml.insert(df, spark.createDataFrame([(2, "b")], "id int, nick string"))
