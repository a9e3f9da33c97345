"""Concurrent publishers: one wins, disjoint changes are rebased, nothing is lost."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import rows
from relkit.operators import dml, publish
from relkit.session import scratch_path


@pytest.fixture()
def base(spark):
    path = scratch_path(spark, "t_publish")
    publish.publish(spark.createDataFrame([("a", 1, 10), ("b", 2, 20), ("c", 3, 30)], "name string, id int, price int"), path)
    return path


def raised(tx, where, by=1):
    return dml.update(tx.read(), {"price": F.col("price") + by}, where)


def test_same_keys_conflict_and_nothing_is_lost(spark, base):
    one, other = publish.begin(spark, base), publish.begin(spark, base)
    first, second = raised(one, F.col("id") <= 2), raised(other, F.col("id") >= 2, 100)
    assert one.commit(first, ["id"]) == 2
    with pytest.raises(publish.PublishConflict):
        other.commit(second, ["id"])
    assert publish.current_version(spark, base) == 2
    assert rows(publish.read_current(spark, base), "id", "price") == [(1, 11), (2, 21), (3, 30)]
    # The loser reads again and succeeds.
    again = publish.begin(spark, base)
    assert again.commit(raised(again, F.col("id") >= 2, 100), ["id"]) == 3
    assert rows(publish.read_current(spark, base), "id", "price") == [(1, 11), (2, 121), (3, 130)]
    assert rows(publish.read_version(spark, base, 1), "id", "price") == [(1, 10), (2, 20), (3, 30)]


def test_disjoint_keys_are_rebased(spark, base):
    one, other, third = (publish.begin(spark, base) for _ in range(3))
    assert one.commit(raised(one, F.col("id") == 1), ["id"]) == 2
    gone = dml.delete(other.read(), F.col("id") == 2)
    assert other.commit(gone, ["id"]) == 3
    new = dml.insert(third.read(), spark.createDataFrame([("d", 4, 40)], "name string, id int, price int"))
    assert third.commit(new, ["id"]) == 4
    table = publish.read_current(spark, base)
    assert table.columns == ["name", "id", "price"] and rows(table) == [("a", 1, 11), ("c", 3, 30), ("d", 4, 40)]


def test_statements_in_sequence_are_rebased_as_one(spark, base):
    one, other = publish.begin(spark, base), publish.begin(spark, base)
    one.commit(raised(one, F.col("id") == 1), ["id"])
    new = dml.insert(other.read(), spark.createDataFrame([("d", 4, 40), ("e", 5, 50)], "name string, id int, price int"))
    dearer = dml.update(new.snapshot, {"price": F.col("price") * 2}, F.col("id") == 5)
    gone = dml.delete(dearer.snapshot, F.col("id").isin(3, 4))
    delta = new.delta.unionByName(dearer.delta).unionByName(gone.delta)
    assert other.commit(dml.DmlResult(gone.snapshot, delta=delta), ["id"]) == 3
    assert rows(publish.read_current(spark, base), "id", "price") == [(1, 11), (2, 20), (5, 100)]


def test_two_inserts_of_one_key_conflict(spark, base):
    row = spark.createDataFrame([("d", 4, 40)], "name string, id int, price int")
    one, other = publish.begin(spark, base), publish.begin(spark, base)
    one.commit(dml.insert(one.read(), row), ["id"])
    with pytest.raises(publish.PublishConflict):
        other.commit(dml.insert(other.read(), row), ["id"])


def test_a_replacement_conflicts_with_everything(spark, base):
    one, other, third = (publish.begin(spark, base) for _ in range(3))
    assert one.replace(one.read().limit(1)) == 2
    with pytest.raises(publish.PublishConflict):
        other.commit(raised(other, F.col("id") == 3), ["id"])
    with pytest.raises(publish.PublishConflict):
        third.replace(third.read())
    assert publish.read_current(spark, base).count() == 1


def test_guards_see_the_snapshot_that_would_be_published(spark, base):
    dear = lambda df: df.where(F.col("price") > 35)
    one, other = publish.begin(spark, base), publish.begin(spark, base)
    with pytest.raises(publish.GuardViolated):
        one.commit(raised(one, F.col("id") == 3, 10), ["id"], guard=dear)
    assert publish.current_version(spark, base) == 1
    total = lambda df: df.agg(F.sum("price").alias("s")).where(F.col("s") > 65)
    assert one.commit(raised(one, F.col("id") == 1, 5), ["id"], guard=total) == 2
    with pytest.raises(publish.GuardViolated):  # 65 by now: its own five more are too many
        other.commit(raised(other, F.col("id") == 2, 5), ["id"], guard=total)


def test_changed_rows_need_their_keys(spark, base):
    tx = publish.begin(spark, base)
    row = spark.createDataFrame([("d", None, 40)], "name string, id int, price int")
    with pytest.raises(ValueError):
        tx.commit(dml.insert(tx.read(), row), ["id"])


def test_of_many_writers_of_one_file_one_wins(spark):
    path = f"{scratch_path(spark, 't_claim')}/_log/{7:012d}.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: publish.create_exclusive(spark, path, f'{{"writer": {k}}}'), range(16)))
    assert won.count(True) == 1
    entry = publish.log_entry(spark, path.rsplit("/", 1)[0], 7)
    assert entry == {"writer": won.index(True)}
    assert publish.log_versions(spark, path.rsplit("/", 1)[0]) == [7]


def test_racing_commits_are_all_kept(spark, base):
    def add(k):
        tx = publish.begin(spark, base)
        new = spark.createDataFrame([(f"n{k}", 100 + k, k)], "name string, id int, price int")
        return tx.commit(dml.insert(tx.read(), new), ["id"])

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(add, range(6)))
    assert sorted(versions) == [2, 3, 4, 5, 6, 7]
    assert rows(publish.read_current(spark, base), "id") == [(1,), (100,), (101,), (102,), (103,), (104,), (105,), (2,), (3,)]
