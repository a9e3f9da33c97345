"""Cascades over declared keys against a row-by-row version."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from relkit.operators.cascade import CASCADE, NO_ACTION, RESTRICT, SET_NULL, ForeignKey, Restricted, Schema


def shop(spark, line_action=CASCADE, offer_action=SET_NULL, **more):
    tables = {
        "category": spark.createDataFrame([("tea",), ("pots",), ("none",)], "name string"),
        "product": spark.createDataFrame([("P1", 1, "tea", None), ("P2", 2, "pots", 1), ("P3", 3, "pots", 2), ("P4", 4, None, 3),
                                          ("P5", 5, "pots", 5), ("P6", 6, "pots", None)],
                                         "label string, id int, category string, made_from int"),
        "line": spark.createDataFrame([(1, 1, 1), (1, 2, 6), (2, 1, 4), (3, 1, None)], "orderno int, n int, product int"),
        "offer": spark.createDataFrame([(9, 3), (8, 6), (7, None)], "offer int, product int"),
    }
    keys = {"category": ("name",), "product": ("id",), "line": ("orderno", "n"), "offer": ("offer",)}
    fks = [ForeignKey("product", ("category",), "category", ("name",), CASCADE, CASCADE),
           ForeignKey("product", ("made_from",), "product", ("id",), CASCADE, CASCADE),
           ForeignKey("line", ("product",), "product", ("id",), line_action, CASCADE),
           ForeignKey("offer", ("product",), "product", ("id",), offer_action, SET_NULL)]
    return Schema(tables, keys, fks)


def replayed(schema, out):
    """Each table with its delta applied must be its snapshot."""
    for name, res in out.items():
        table = schema.tables[name]
        both = table.withColumn("_sign", F.lit(1)).unionByName(res.delta)
        left = both.groupBy(*table.columns).agg(F.sum("_sign").alias("_times")).where("_times <> 0")
        assert rows(left.where("_times = 1"), *table.columns) == rows(res.snapshot) and left.where("_times <> 1").count() == 0
        assert res.snapshot.columns == table.columns


def test_a_delete_goes_all_the_way(spark):
    schema = shop(spark)
    out = schema.delete("category", F.col("name") == "tea")
    # P1 goes with its category, P2, P3 and P4 as they are made from it; P5 is made from itself.
    assert rows(out["product"].snapshot, "id") == [(5,), (6,)]
    assert rows(out["product"].returning, "id") == [(1,), (2,), (3,), (4,)]
    assert rows(out["line"].snapshot) == [(1, 2, 6), (3, 1, None)]
    assert rows(out["offer"].snapshot) == [(7, None), (8, 6), (9, None)]
    assert rows(out["offer"].delta) == [(9, 3, -1), (9, None, 1)]
    replayed(schema, out)


def test_nothing_to_delete_and_self_references(spark):
    schema = shop(spark)
    out = schema.delete("category", F.col("name") == "none")
    assert list(out) == ["category"] and out["category"].snapshot.count() == 2
    assert rows(schema.delete("category", F.col("name") == "?")["category"].returning) == []
    own = schema.delete("product", F.col("id") == 5)
    assert rows(own["product"].returning, "id") == [(5,)]
    null = schema.delete("product", F.col("category") == "no such")  # a NULL predicate keeps the row
    assert null["product"].returning.count() == 0


def test_restrict_and_no_action(spark):
    with pytest.raises(Restricted):
        shop(spark, line_action=RESTRICT).delete("category", F.col("name") == "tea")
    with pytest.raises(Restricted):
        shop(spark, offer_action=NO_ACTION).delete("category", F.col("name") == "tea")
    for action in (RESTRICT, NO_ACTION):
        assert rows(shop(spark, action, action).delete("product", F.col("id") == 5)["product"].returning, "id") == [(5,)]


def test_no_action_allows_rows_that_go_too(spark):
    tables = {"a": spark.createDataFrame([(1,), (2,)], "id int"), "b": spark.createDataFrame([(1, 1), (2, 2)], "id int, a int"),
              "c": spark.createDataFrame([(1, 1, 1)], "id int, a int, b int")}
    keys = dict.fromkeys(tables, ("id",))
    for action, error in ((NO_ACTION, False), (RESTRICT, True)):
        fks = [ForeignKey("b", ("a",), "a", ("id",), CASCADE), ForeignKey("c", ("a",), "a", ("id",), action),
               ForeignKey("c", ("b",), "b", ("id",), CASCADE)]
        schema = Schema(tables, keys, fks)
        if error:
            with pytest.raises(Restricted):
                schema.delete("a", F.col("id") == 1)
        else:
            out = schema.delete("a", F.col("id") == 1)
            assert rows(out["c"].snapshot) == [] and rows(out["b"].snapshot) == [(2, 2)]


def test_two_tables_that_reference_each_other(spark):
    rnd = random.Random(6)
    left = [(k, rnd.choice([None, *range(40)])) for k in range(40)]
    right = [(k, rnd.choice([None, *range(40)])) for k in range(40)]
    schema = Schema({"l": spark.createDataFrame(left, "id int, r int"), "r": spark.createDataFrame(right, "id int, l int")},
                    {"l": ("id",), "r": ("id",)},
                    [ForeignKey("l", ("r",), "r", ("id",), CASCADE), ForeignKey("r", ("l",), "l", ("id",), CASCADE)])
    out = schema.delete("l", F.col("id") < 3)
    gone = {("l", k) for k in range(3)}
    while True:
        more = ({("l", k) for k, r in left if ("r", r) in gone} | {("r", k) for k, x in right if ("l", x) in gone}) - gone
        if not more:
            break
        gone |= more
    assert {("l", r.id) for r in out["l"].returning.collect()} == {g for g in gone if g[0] == "l"}
    assert {("r", r.id) for r in out["r"].returning.collect()} == {g for g in gone if g[0] == "r"}
    replayed(schema, out)


def test_keys_of_two_columns(spark):
    schema = Schema({"p": spark.createDataFrame([(1, 1), (1, 2), (None, 1)], "a int, b int"),
                     "c": spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 1, None), (4, None, 1)], "id int, a int, b int")},
                    {"p": ("a", "b"), "c": ("id",)}, [ForeignKey("c", ("a", "b"), "p", ("a", "b"), SET_NULL)])
    out = schema.delete("p", F.col("b") == 1)
    assert rows(out["p"].snapshot) == [(1, 2)]
    assert rows(out["c"].snapshot) == [(1, None, None), (2, 1, 2), (3, 1, None), (4, None, 1)]
    replayed(schema, out)
    with pytest.raises(ValueError):
        ForeignKey("c", ("a",), "p", ("a", "b"))
    with pytest.raises(ValueError):
        Schema(schema.tables, schema.primary_keys, [ForeignKey("x", ("a",), "p", ("a",))])


def test_new_keys_are_followed(spark):
    schema = shop(spark)
    out = schema.update_keys("product", "id", spark.createDataFrame([(2, 1002), (6, 1006), (99, 1)], "old_key int, new_key int"))
    assert rows(out["product"].snapshot, "id", "made_from") == rows(
        spark.createDataFrame([(1, None), (3, 1002), (4, 3), (5, 5), (1002, 1), (1006, None)], "id int, made_from int"))
    assert rows(out["line"].snapshot) == [(1, 1, 1), (1, 2, 1006), (2, 1, 4), (3, 1, None)]
    assert rows(out["offer"].snapshot) == [(7, None), (8, None), (9, 3)]
    replayed(schema, out)
    named = schema.update_keys("category", "name", spark.createDataFrame([("pots", "jars")], "old_key string, new_key string"))
    assert sorted(named) == ["category", "product"] and named["product"].snapshot.where("category = 'jars'").count() == 4
    with pytest.raises(ValueError):
        schema.update_keys("product", "id", spark.createDataFrame([(2, 5), (2, 6)], "old_key int, new_key int"))
    kept = Schema(schema.tables, schema.primary_keys, [ForeignKey("line", ("product",), "product", ("id",))])
    with pytest.raises(Restricted):
        kept.update_keys("product", "id", spark.createDataFrame([(6, 60)], "old_key int, new_key int"))
