"""Range join: points and the intervals ``[lo, hi)`` that hold them.

Spark plans a join on ``v >= lo AND v < hi`` as a nested loop over all pairs
or a broadcast of one side.  Here both sides are dealt to bins of the value
range, so that the join has an equality to shuffle on:

* the bin width comes from the data: the range of the points divided by the
  mean length of the intervals (clipped to that range), so an interval is
  copied to two bins on average, however long some of them are;
* a point lies in one bin, so a pair meets in one bin only;
* a bin with more than its share of points or intervals is split: its points
  are dealt to ``p`` parts and its intervals to ``i`` parts by a hash of the
  row, each side is copied to the other's parts, and the ``p * i`` cells are
  join keys of their own.  No more bins can be heavy than there are shares in
  the data, so the table of heavy bins is small at any size and is broadcast.

The pairs themselves grow with the product of the sides when points grow
denser.  Where only their totals per interval are wanted (``totals``), they are
not listed: the points are added up per distinct value, the values and the
bounds are numbered in one order, and blocks of 4, 16, 64, ... numbers are added
up; an interval is then at most six blocks of each size, joined by their
numbers.  No total is a difference of two others, so sums are of the interval's
own points.  Work and shuffles grow with the distinct values and bounds times
the block sizes in use (the logarithm of the longest interval).

Bounds that are NULL are open; a NULL point is in no interval; an interval
whose ``hi`` is not above ``lo`` holds nothing.  Values may be numbers, dates
or timestamps; bins only need a conversion to double that keeps the order, the
exact comparison follows in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from ..functions.scalar import ntz_micros
from ..session import default_parallelism, scratch_path
from .windows import global_position

#: Bins at most: their numbers stay exact as doubles and integers.
MAX_BINS = 1 << 30


def _number(df: DataFrame, col: str) -> Column:
    """The value as a double, in the same order (ties allowed)."""
    kind = df.schema[col].dataType
    if isinstance(kind, DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, TimestampNTZType):
        return ntz_micros(col).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(col).cast("double")
    return F.col(col).cast("double")


class _Bins:
    """The cut of the points' range into bins of one width."""

    def __init__(self, low: float, width: float, count: int) -> None:
        self.low, self.width, self.count = low, width, count

    def of(self, number: Column) -> Column:
        # NaN is above all numbers in Spark's order, here as there.
        place = F.floor((number - F.lit(self.low)) / F.lit(self.width)).cast("double")
        place = F.when(F.isnan(number), F.lit(float(self.count - 1))).otherwise(place)
        clipped = F.least(F.greatest(place, F.lit(0.0)), F.lit(float(self.count - 1))).cast("int")
        return F.when(number.isNotNull(), clipped)  # greatest() and least() pass over NULLs


def _bins(points: DataFrame, intervals: DataFrame) -> _Bins:
    """One row of statistics of each side decides the width."""
    finite = F.when(F.abs("_rj_v") < float("inf"), F.col("_rj_v"))
    p = points.agg(F.min(finite).alias("lo"), F.max(finite).alias("hi")).first()
    if p["lo"] is None or p["lo"] == p["hi"]:
        return _Bins(p["lo"] or 0.0, 1.0, 1)
    low, high = F.lit(p["lo"]), F.lit(p["hi"])
    clip = lambda c, other: F.least(F.greatest(F.coalesce(c, other), low), high)
    length = clip(F.col("_rj_hi_n"), high) - clip(F.col("_rj_lo_n"), low)
    mean = intervals.agg(F.avg(F.greatest(length, F.lit(0.0))).alias("mean")).first()["mean"]
    span = p["hi"] - p["lo"]
    count = max(1, min(MAX_BINS, int(span / mean) if mean else MAX_BINS))
    return _Bins(p["lo"], span / count, count)


def _parts(binned: DataFrame, share: int, name: str) -> DataFrame:
    """The bins with more than ``share`` rows, and into how many parts they go."""
    sizes = binned.groupBy("_rj_bin").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share)
    return sizes.select("_rj_bin", F.ceil(F.col("n") / F.lit(share)).cast("int").alias(name))


def _totals(points: DataFrame, value: str, intervals: DataFrame, lo: str, hi: str,
            totals: dict[str, str | None]) -> DataFrame:
    """Each interval that holds points, with the totals of its points."""
    spark = points.sparkSession
    added = [F.count(F.lit(1)) if c is None else F.sum(c) for c in totals.values()]
    names = [f"_rj_t{k}" for k in range(len(added))]
    leaves = points.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_rj_x")).agg(
        *[c.alias(n) for c, n in zip(added, names)])
    intervals = intervals.where(F.coalesce(F.col(lo) < F.col(hi), F.lit(True)))
    spans = intervals.select(F.col(lo).alias("_rj_lo"), F.col(hi).alias("_rj_hi")).distinct()
    bounds = spans.select(F.explode(F.array("_rj_lo", "_rj_hi")).alias("_rj_x")).where(F.col("_rj_x").isNotNull()).distinct()
    marks = (leaves.withColumn("_rj_point", F.lit(1))
             .unionByName(bounds.withColumn("_rj_point", F.lit(0)), allowMissingColumns=True))
    # A bound stands before the points of its value: they are in an interval that begins there, not in one that ends.
    marks = global_position(marks, ["_rj_x", "_rj_point"], "_rj_at")
    end = (marks.agg(F.max("_rj_at").alias("end")).first()["end"] or 0) + 1
    at = marks.where(F.col("_rj_point") == 0)
    first = at.select(F.col("_rj_x").alias("_rj_fx"), F.col("_rj_at").alias("_rj_a"))
    last = at.select(F.col("_rj_x").alias("_rj_lx"), F.col("_rj_at").alias("_rj_b"))
    spans = (spans.join(first, F.col("_rj_lo") == F.col("_rj_fx"), "left").join(last, F.col("_rj_hi") == F.col("_rj_lx"), "left")
             .select("_rj_lo", "_rj_hi", F.coalesce("_rj_a", F.lit(0)).cast("long").alias("_rj_a"),
                     F.coalesce("_rj_b", F.lit(end)).cast("long").alias("_rj_b")))
    path = scratch_path(spark, "range-spans")
    spans.write.parquet(path)
    spans = spark.read.schema(spans.schema).parquet(path)
    longest = spans.agg(F.max(F.col("_rj_b") - F.col("_rj_a")).alias("n")).first()["n"] or 0
    # Blocks of size 4 ** size; one size more would not fit into the longest interval.
    sizes = F.explode(F.sequence(F.lit(0), F.lit(max(0, (longest.bit_length() - 1) // 2)))).alias("_rj_size")

    blocks = (marks.where(F.col("_rj_point") == 1).select("_rj_at", *names, sizes)
              .groupBy("_rj_size", F.expr("shiftright(_rj_at, 2 * _rj_size)").alias("_rj_block"))
              .agg(*[F.sum(n).alias(n) for n in names]))
    # Whole blocks of one size in [a, b), but for those that are in whole blocks of the next size.
    up, down = "shiftright({0} + shiftleft(1L, 2 * {1}) - 1, 2 * {1})", "shiftright({0}, 2 * {1})"
    own = spans.select("*", sizes).select(
        "_rj_lo", "_rj_hi", F.col("_rj_size").alias("_rj_s"),
        F.expr(up.format("_rj_a", "_rj_size")).alias("f"), F.expr(down.format("_rj_b", "_rj_size")).alias("t"),
        F.expr(up.format("_rj_a", "(_rj_size + 1)")).alias("uf"), F.expr(down.format("_rj_b", "(_rj_size + 1)")).alias("ut"))
    own = own.where("f < t").withColumns({"l": F.expr("if(uf < ut, 4 * uf, t)"), "r": F.expr("if(uf < ut, 4 * ut, t)")})
    run = "if({0} < {1}, sequence({0}, {1} - 1), cast(array() AS array<bigint>))"
    own = own.select("_rj_lo", "_rj_hi", "_rj_s", F.explode(F.expr(
        f"concat({run.format('f', 'l')}, {run.format('r', 't')})")).alias("_rj_b"))
    found = own.join(blocks, (F.col("_rj_s") == F.col("_rj_size")) & (F.col("_rj_b") == F.col("_rj_block")))
    kinds = {n: leaves.schema[n].dataType for n in names}
    found = found.groupBy("_rj_lo", "_rj_hi").agg(*[F.sum(n).cast(kinds[n]).alias(n) for n in names])
    held = intervals.join(found, F.col(lo).eqNullSafe(F.col("_rj_lo")) & F.col(hi).eqNullSafe(F.col("_rj_hi")))
    return held.select(*intervals.columns, *[F.col(n).alias(name) for n, name in zip(names, totals)])


def range_join(points: DataFrame, value: str, intervals: DataFrame, lo: str, hi: str, how: str = "inner",
               rows_per_task: int | None = None, totals: dict[str, str | None] | None = None) -> DataFrame:
    """Pairs with ``lo <= value < hi``; ``how="left"`` also keeps points in no interval.

    The columns are those of the points and then of the intervals; they must
    not share names.  ``rows_per_task`` is a bin's share of rows (by default
    the rows of a side divided by the shuffle partitions, at least 10,000).

    With ``totals`` (new name -> a column of the points to sum, or None for the
    number of points) each interval that holds a point is one row, with its own
    columns and the totals over its pairs.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    if totals is not None and how != "inner":
        raise ValueError("totals are of the inner join")
    clash = {c.lower() for c in points.columns} & {c.lower() for c in intervals.columns}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    if totals is not None:
        return _totals(points, value, intervals, lo, hi, totals)
    names = [*points.columns, *intervals.columns]
    p = points.withColumn("_rj_v", _number(points, value))
    i = intervals.withColumn("_rj_lo_n", _number(intervals, lo)).withColumn("_rj_hi_n", _number(intervals, hi))
    i = i.where(F.coalesce(F.col(lo) < F.col(hi), F.lit(True)))
    if how == "inner":
        p = p.where(F.col(value).isNotNull())
    bins = _bins(p, i)
    p = p.withColumn("_rj_bin", bins.of(F.col("_rj_v")))
    first = F.coalesce(bins.of(F.col("_rj_lo_n")), F.lit(0))
    last = F.coalesce(bins.of(F.col("_rj_hi_n")), F.lit(bins.count - 1))
    i = i.withColumn("_rj_bin", F.explode(F.sequence(first, last)))

    tasks = default_parallelism(points.sparkSession)
    share = lambda df: rows_per_task or max(10_000, df.count() // tasks)
    # At most `tasks` bins on each side can hold more than their share (the points' NULLs are no bin).
    heavy_p = _parts(p.where(F.col("_rj_bin").isNotNull()), share(p), "_rj_np")
    heavy = heavy_p.withColumn("_rj_ni", F.lit(1))
    if how == "inner":
        heavy_i = _parts(i, share(i), "_rj_ni")
        heavy = heavy_p.join(heavy_i, "_rj_bin", "full").select(
            "_rj_bin", F.coalesce("_rj_np", F.lit(1)).alias("_rj_np"), F.coalesce("_rj_ni", F.lit(1)).alias("_rj_ni"))
    heavy = [tuple(r) for r in heavy.collect()]

    def dealt(df: DataFrame, own: str, other: str, tag: str) -> DataFrame:
        """Add the cell: this side's part by hash, a copy for each part of the other side."""
        if not heavy:
            return df.withColumn("_rj_cell", F.lit(0))
        table = df.sparkSession.createDataFrame(heavy, "_rj_bin int, _rj_np int, _rj_ni int")
        df = df.join(F.broadcast(table), "_rj_bin", "left")
        of = lambda c: F.coalesce(F.col(c), F.lit(1))
        part = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if not kind.startswith(("map", "variant"))], F.lit(tag)), of(own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), of(other) - 1))
        df = df.withColumn("_rj_part", part).withColumn("_rj_copy", copies)
        row, col = ("_rj_part", "_rj_copy") if own == "_rj_np" else ("_rj_copy", "_rj_part")
        return df.withColumn("_rj_cell", F.col(row) * of("_rj_ni") + F.col(col)).drop("_rj_np", "_rj_ni", "_rj_part", "_rj_copy")

    left = dealt(p, "_rj_np", "_rj_ni", "p").withColumnsRenamed({"_rj_bin": "_rj_pb", "_rj_cell": "_rj_pc"})
    right = dealt(i, "_rj_ni", "_rj_np", "i")
    inside = ((F.col("_rj_pb") == F.col("_rj_bin")) & (F.col("_rj_pc") == F.col("_rj_cell"))
              & (F.col(lo).isNull() | (F.col(value) >= F.col(lo))) & (F.col(hi).isNull() | (F.col(value) < F.col(hi))))
    return left.join(right, inside, how).select(*names)
