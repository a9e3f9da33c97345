"""The range join against all pairs, and its plan."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest

from relkit.operators.range_join import range_join


def pairs(points, intervals, how="inner"):
    out = Counter()
    for p, v in points:
        held = [(p, i) for i, lo, hi in intervals if v is not None and (lo is None or v >= lo) and (hi is None or v < hi)
                and (lo is None or hi is None or lo < hi)]
        out.update(held or ([(p, None)] if how == "left" else []))
    return out


def joined(spark, points, intervals, kind, how="inner", **more):
    p = spark.createDataFrame(points, f"p int, v {kind}")
    i = spark.createDataFrame(intervals, f"i int, lo {kind}, hi {kind}")
    return Counter((r.p, r.i) for r in range_join(p, "v", i, "lo", "hi", how, **more).collect())


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [None, 5, 50])
def test_equals_all_pairs(spark, how, share):
    rnd = random.Random(share)
    spot = lambda: rnd.choice([rnd.random() * 1000, 500 + rnd.random(), float(rnd.randrange(10)), 500.0])
    points = [(k, spot()) for k in range(300)] + [(300, None), (301, float("inf")), (302, float("-inf")), (303, 1e300)]
    intervals = [(k, lo, lo + rnd.choice([0.0, 0.1, 5.0, 300.0, -1.0])) for k in range(60) for lo in [spot()]]
    intervals += [(60, None, None), (61, None, 500.0), (62, 500.0, None), (63, 500.0, 500.0), (64, float("-inf"), float("inf"))]
    assert joined(spark, points, intervals, "double", how, rows_per_task=share) == pairs(points, intervals, how)


@pytest.mark.parametrize("kind, value", [
    ("int", lambda k: k - 50), ("decimal(20,4)", lambda k: Decimal(k) / 7 if k else Decimal("-0.5")),
    ("date", lambda k: dt.date(1965, 1, 1) + dt.timedelta(days=k * 11)),
    ("timestamp", lambda k: dt.datetime(1969, 12, 31) + dt.timedelta(seconds=k * 977, microseconds=k)),
    ("timestamp_ntz", lambda k: dt.datetime(2024, 3, 31) + dt.timedelta(minutes=k)),
    ("bigint", lambda k: (1 << 60) + k)])
def test_kinds_of_values(spark, kind, value):
    if kind.startswith("decimal"):
        plain, value = value, lambda k: plain(k).quantize(Decimal("0.0001"))
    points = [(k, value(k)) for k in range(0, 100)] + [(100, None)]
    intervals = [(k, value(3 * k), value(3 * k + k)) for k in range(20)] + [(50, None, value(9)), (51, value(90), None)]
    assert joined(spark, points, intervals, kind) == pairs(points, intervals)


def test_hot_values_and_intervals_are_split(spark):
    points = [(k, 7.0 if k % 3 else float(k)) for k in range(600)]
    intervals = [(k, 6.5 if k % 2 else float(k), 8.0 if k % 2 else k + 1.0) for k in range(80)]
    for how in ("inner", "left"):
        assert joined(spark, points, intervals, "double", how, rows_per_task=20) == pairs(points, intervals, how)


def test_empty_sides_and_one_value(spark):
    assert joined(spark, [], [(1, 0.0, 1.0)], "double") == Counter()
    assert joined(spark, [(1, 0.5)], [], "double") == Counter()
    assert joined(spark, [(1, 0.5)], [], "double", "left") == Counter({(1, None): 1})
    assert joined(spark, [(1, None)], [(1, None, None)], "double", "left") == Counter({(1, None): 1})
    assert joined(spark, [(k, 5.0) for k in range(4)], [(1, 5.0, 6.0), (2, 4.0, 5.0)], "double") == Counter({(k, 1): 1 for k in range(4)})


def test_names_and_ways(spark):
    p = spark.createDataFrame([(1, 1.0)], "lo int, v double")
    i = spark.createDataFrame([(1, 1.0, 2.0)], "i int, lo double, hi double")
    with pytest.raises(ValueError):
        range_join(p, "v", i, "lo", "hi")
    with pytest.raises(ValueError):
        range_join(p.drop("lo"), "v", i, "lo", "hi", how="full")


def test_plan_has_an_equality(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        p = spark.range(5000).selectExpr("id AS p", "double(id % 1000) AS v")
        i = spark.range(500).selectExpr("id AS i", "double(id * 2) AS lo", "double(id * 2 + 3) AS hi")
        out = range_join(p, "v", i, "lo", "hi")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        assert out.count() == 7495  # the last interval holds two of the values, all others three
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def totalled(spark, points, intervals, kind, quantity="double"):
    """The operator's totals per interval, and those of all pairs."""
    p = spark.createDataFrame(points, f"p int, v {kind}, q {quantity}")
    i = spark.createDataFrame(intervals, f"i int, lo {kind}, hi {kind}")
    got = Counter(tuple(r) for r in range_join(p, "v", i, "lo", "hi", totals={"n": None, "total": "q"}).select("i", "n", "total").collect())
    want, q = {}, {k: x for k, _, x in points}
    for k, iv in enumerate(intervals):
        held = [q[a] for (a, _), n in pairs([r[:2] for r in points], [iv]).items() for _ in range(n)]
        if held:
            want[k] = (iv[0], len(held), sum(x for x in held if x is not None) if any(x is not None for x in held) else None)
    return got, Counter(want.values())


@pytest.mark.parametrize("seed", range(4))
def test_totals_equal_all_pairs(spark, seed):
    rnd = random.Random(seed)
    spot = lambda: rnd.choice([rnd.random() * 1000, 500 + rnd.random(), float(rnd.randrange(10)), 500.0, -0.0])
    points = [(k, spot(), rnd.choice([None, 0.5, 2.0, 7.0])) for k in range(rnd.choice([5, 300, 700]))]
    points += [(900, None, 1.0), (901, float("inf"), 1.0), (902, float("-inf"), 1.0), (903, 1e300, None)]
    intervals = [(k, lo, lo + rnd.choice([0.0, 0.1, 5.0, 300.0, -1.0])) for k in range(80) for lo in [spot()]]
    intervals += [(3, 2.0, 9.0), (3, 2.0, 9.0), (None, 2.0, 9.0), (60, None, None), (61, None, 500.0), (62, 500.0, None)]
    got, want = totalled(spark, points, intervals, "double")
    assert got == want


def test_totals_of_distant_sizes_stay_exact(spark):
    """A sum holds the interval's own points only: a large one before it, or a NaN, takes nothing from it."""
    points = [(0, 0.0, 1e300), (1, 1.0, 0.1), (2, 2.0, 0.2), (3, 3.0, float("nan"))]
    got, want = totalled(spark, points, [(1, 1.0, 2.0), (2, 1.0, 3.0), (3, 2.0, 2.5), (4, 5.0, 6.0)], "double")
    assert got == want and len(got) == 3


def test_totals_of_kinds_and_empty_sides(spark):
    day = lambda k: dt.datetime(1969, 12, 1) + dt.timedelta(hours=k)
    points = [(k, day(k % 97), k) for k in range(200)] + [(200, None, 5)]
    intervals = [(k, day(5 * k), day(5 * k + 12)) for k in range(20)] + [(30, None, None)]
    for kind in ("timestamp", "timestamp_ntz"):
        got, want = totalled(spark, points, intervals, kind, "bigint")
        assert got == want
    money = [(k, Decimal(k) / 4, Decimal(k)) for k in range(30)]
    got, want = totalled(spark, money, [(1, Decimal("1.25"), Decimal("3.5")), (2, None, Decimal(2))], "decimal(20,4)", "decimal(10,2)")
    assert got == want
    for some, others in (([], [(1, 0.0, 1.0)]), ([(1, 0.5, 1.0)], []), ([], []), ([(1, None, 1.0)], [(1, None, None)])):
        got, want = totalled(spark, some, others, "double")
        assert got == want == Counter()
    with pytest.raises(ValueError):
        p = spark.createDataFrame([(1, 1.0)], "p int, v double")
        range_join(p, "v", spark.createDataFrame([(1, 1.0, 2.0)], "i int, lo double, hi double"), "lo", "hi", "left", totals={"n": None})


def test_totals_list_no_pairs(spark):
    """400 points in each of 300 intervals of one value: no step of the plan puts out the 120,000 pairs."""
    p = spark.range(400).selectExpr("id AS p", "double(id % 5) AS v", "1.0D AS q")
    i = spark.range(300).selectExpr("id AS i", "0.0D AS lo", "double(10 + id % 3) AS hi")
    out = range_join(p, "v", i, "lo", "hi", totals={"n": None, "total": "q"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {(r.n, r.total) for r in out.collect()} == {(400, 400.0)} and out.count() == 300

    def most(node):
        counted = node.metrics().get("numOutputRows")
        own = counted.get().value() if counted.isDefined() else 0
        below = [node.children().apply(k) for k in range(node.children().size())]
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            below.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            below.append(node.plan())
        return max([own, *map(most, below)])

    out.collect()
    assert 300 <= most(out._jdf.queryExecution().executedPlan()) < 5000
