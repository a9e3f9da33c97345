"""Refreshed aggregates equal rebuilt ones after mixed changes."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from relkit.operators import dml, publish
from relkit.operators.refresh import AggregateView, MaterializedView, equal
from relkit.session import scratch_path

SCHEMA = "id int, g string, h int, price decimal(10,2), size int"
VIEW = AggregateView(("g", "h"), ("price", "size"), ("price", "size"))


def some_rows(rnd, ids):
    money = lambda: rnd.choice([None, Decimal(rnd.randrange(1000)) / 4])
    return [(k, rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]), money(), rnd.choice([None, rnd.randrange(30)])) for k in ids]


def statements(rnd, spark, table, next_id):
    new = spark.createDataFrame(some_rows(rnd, range(next_id, next_id + 15)), SCHEMA)
    yield lambda t: dml.insert(t, new)
    yield lambda t: dml.update(t, {"price": F.col("price") - 3, "g": F.lit("c")}, F.pmod("id", F.lit(rnd.randrange(2, 6))) == 0)
    yield lambda t: dml.delete(t, F.col("size") > rnd.randrange(15, 30))
    yield lambda t: dml.upsert(t, spark.createDataFrame(some_rows(rnd, range(5, 12)), SCHEMA), ["id"])
    yield lambda t: dml.delete(t, (F.col("g") == "a") & (F.col("h") == 1))  # a whole group


@pytest.mark.parametrize("seed", [1, 2])
def test_refresh_equals_rebuild(spark, seed):
    rnd = random.Random(seed)
    table = spark.createDataFrame(some_rows(rnd, range(80)), SCHEMA)
    state = VIEW.build(table)
    for statement in statements(rnd, spark, table, 100):
        result = statement(table)
        table = spark.createDataFrame(result.snapshot.collect(), SCHEMA)
        delta = spark.createDataFrame(result.delta.collect(), SCHEMA + ", _sign int")
        state = spark.createDataFrame(VIEW.refresh(state, delta, table).collect(), state.schema)
        assert equal(VIEW, state, VIEW.build(table))


def test_only_groups_that_lost_an_extreme_are_read_again(spark):
    table = spark.createDataFrame([(1, "a", 1, None, 5), (2, "a", 1, None, 9), (3, "b", 1, None, 5), (4, "b", 1, None, 9),
                                   (5, "b", 1, None, 7)], SCHEMA)
    view = AggregateView(("g",), (), ("size",))
    res = dml.delete(table, F.col("id").isin(2, 5))
    # A table that lacks group b shows that it was not needed: only a lost its maximum.
    state = view.refresh(view.build(table), res.delta, res.snapshot.where(F.col("g") == "a"))
    assert rows(state, "g", "n_rows", "min_size", "max_size") == [("a", 1, 5, 5), ("b", 2, 5, 9)]


def test_no_changes_no_rows_and_no_groups(spark):
    table = spark.createDataFrame(some_rows(random.Random(3), range(20)), SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    none = spark.createDataFrame([], SCHEMA + ", _sign int")
    assert equal(VIEW, VIEW.refresh(VIEW.build(table), none, table), VIEW.build(table))
    all_new, all_gone = dml.insert(empty, table), dml.delete(table, F.lit(True))
    assert equal(VIEW, VIEW.refresh(VIEW.build(empty), all_new.delta, table), VIEW.build(table))
    assert VIEW.refresh(VIEW.build(table), all_gone.delta, empty).count() == 0
    with pytest.raises(ValueError):
        AggregateView(())


def test_a_stored_view_follows_its_table(spark):
    rnd = random.Random(7)
    source, base = scratch_path(spark, "t_source"), scratch_path(spark, "t_view")
    publish.publish(spark.createDataFrame(some_rows(rnd, range(60)), SCHEMA), source)
    view = MaterializedView(VIEW, source, base)
    assert view.create(spark) == 1 and view.refresh(spark) == 1
    for statement in list(statements(rnd, spark, None, 100))[:3]:
        tx = publish.begin(spark, source)
        tx.commit(statement(tx.read()), ["id"])
    assert view.version(spark) == 1 and view.refresh(spark) == 4
    assert equal(VIEW, view.read(spark), VIEW.build(publish.read_current(spark, source)))
    publish.publish(publish.read_current(spark, source).limit(5), source)  # no changes to go by
    assert view.refresh(spark) == 5
    assert equal(VIEW, view.read(spark), VIEW.build(publish.read_current(spark, source)))
