import pytest
from pyspark.sql import functions as F

from conftest import rows
from relkit.operators.hierarchy import walk_down


def test_reference_manager_tree(spark):
    # Dump form: 2 is the root; 5 reports to 2; 6, 7, 9 report to 5; 1, 3, 4, 8 report to 2.
    edges = spark.createDataFrame([(1, 2), (2, None), (3, 2), (4, 2), (5, 2), (6, 5), (7, 5), (8, 2), (9, 5)],
                                  "employee_id int, reports_to int")
    got = walk_down(edges, "employee_id", "reports_to")
    assert rows(got, "employee_id", "level") == [(1, 2), (2, 1), (3, 2), (4, 2), (5, 2), (6, 3), (7, 3), (8, 2),
                                                 (9, 3)]


def test_orphans_and_unrooted_cycles_are_not_reached(spark):
    edges = spark.createDataFrame([(1, None), (2, 1), (3, 99), (4, 5), (5, 4)], "id int, parent int")
    assert rows(walk_down(edges, "id", "parent"), "id", "level") == [(1, 1), (2, 2)]


def test_cycle_reachable_from_root_is_reported(spark):
    edges = spark.createDataFrame([(1, None), (2, 1), (2, 3), (3, 2)], "id int, parent int")
    with pytest.raises(RuntimeError):
        walk_down(edges, "id", "parent", max_depth=6)


def test_keeps_payload_columns(spark):
    edges = spark.createDataFrame([(1, None, "root"), (2, 1, "kid")], "id int, parent int, name string")
    got = walk_down(edges, "id", "parent", keep=("name",))
    assert rows(got, "id", "name", "level") == [(1, "root", 1), (2, "kid", 2)]
    assert got.where(F.col("level") > 2).count() == 0


def test_sql_recursive_form_matches_loop(spark):
    from relkit.operators.hierarchy import walk_down_sql
    edges = spark.range(0, 200).select(F.col("id").alias("k"),
                                       F.when(F.col("id") == 0, None).otherwise(F.expr("(id - 1) div 3")).alias("p"))
    edges.createOrReplaceTempView("t_edges")
    assert rows(walk_down_sql(spark, "t_edges", "k", "p")) == rows(walk_down(edges, "k", "p"))


def test_star_shaped_tree_hot_parent(spark):
    # One manager with most of the nodes as direct reports.
    edges = spark.range(0, 3000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") == 0, None).when(F.col("id") < 2500, F.lit(0)).otherwise(F.col("id") - 500).alias("p"))
    got = walk_down(edges, "k", "p")
    levels = {r["level"]: r["count"] for r in got.groupBy("level").count().collect()}
    assert levels == {1: 1, 2: 2499, 3: 500}


def test_deep_chain_takes_few_rounds(spark, monkeypatch):
    from relkit.operators import hierarchy
    rounds = []
    written = hierarchy._written
    monkeypatch.setattr(hierarchy, "_written", lambda df, name: rounds.append(name) or written(df, name))
    depth = 10_000
    # Ids in no order, so that nothing but the pointers leads along the chain.
    name = lambda k: (k * 7919) % depth
    chain = spark.createDataFrame([(name(k), None if k == 0 else name(k - 1), k + 1) for k in range(depth)],
                                  "id int, parent int, want int")
    got = walk_down(chain, "id", "parent", keep=("want",))
    assert got.count() == depth and got.where("level <> want").count() == 0
    assert len(rounds) <= 16
    with pytest.raises(RuntimeError):
        walk_down(chain, "id", "parent", max_depth=depth - 1)


def test_levels_equal_the_recursion_on_random_forests(spark):
    import random
    from relkit.operators.hierarchy import walk_down_sql
    rnd = random.Random(4)
    for size in (1, 2, 50, 300):
        # Parents before, after, missing, self and NULL: trees, orphans and cycles.
        edges = [(k, rnd.choice([None, rnd.randrange(size), rnd.randrange(max(1, k)), size + 5, max(0, k - 1)])) for k in range(size)]
        frame = spark.createDataFrame(edges, "id int, parent int")
        frame.createOrReplaceTempView("t_forest")
        spark.conf.set("spark.sql.cteRecursionLevelLimit", 400)
        assert rows(walk_down(frame, "id", "parent")) == rows(walk_down_sql(spark, "t_forest", "id", "parent"))


def test_cycles_below_no_root_can_be_an_error(spark):
    ring = [(k, (k + 1) % 7) for k in range(7)] + [(7, 3), (8, 7)]
    tail = [(100 + k, 99 + k) for k in range(40)]  # below a missing parent: no cycle
    tree = [(200, None), (201, 200)]
    frame = lambda edges: spark.createDataFrame(edges, "id int, parent int")
    assert rows(walk_down(frame(ring + tail + tree), "id", "parent"), "id", "level") == [(200, 1), (201, 2)]
    assert walk_down(frame(tail + tree), "id", "parent", cycles="error").count() == 2
    with pytest.raises(RuntimeError):
        walk_down(frame(ring + tail + tree), "id", "parent", cycles="error")
    with pytest.raises(ValueError):
        walk_down(frame(tree), "id", "parent", cycles="ignore")


def test_repeated_and_missing_ids(spark):
    twice = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 2), (4, 3), (5, 4)], "id int, parent int")
    assert rows(walk_down(twice, "id", "parent"), "id", "level") == [(1, 1), (2, 2), (3, 2), (4, 3), (4, 3), (5, 4), (5, 4)]
    unnamed = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (None, 1, "c"), (None, 9, "d"), (2, 1, "e")],
                                    "id int, parent int, name string")
    got = walk_down(unnamed, "id", "parent", keep=("name",))
    assert rows(got, "name", "level") == [("a", 1), ("b", 1), ("c", 2), ("e", 2)]
    assert walk_down(unnamed.limit(0), "id", "parent").count() == 0
