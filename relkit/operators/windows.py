"""Ordered (window) operators that stay parallel on skewed or global orders.

A window without ``PARTITION BY`` sends every row to one task, and a window
partitioned by a hot key sends a third of the table to one task.  The
operators here avoid both:

* ``global_position`` numbers rows in a total order: Spark's range partitioner
  deals and sorts them once, and the result, with each row's range and place
  in it, is written to the shared scratch folder.  Everything later reads that
  table, so a lost executor cannot change a number, and the rows before each
  range come from counts, one row per range;
* ranks derive from positions (first position of each tie group), with
  aggregation before any shuffle of the tie groups;
* ``lag``/``lead`` are Spark's window with one exchange, in which the rows of
  a hot partition key are cut into ranges; edges are joined from a table with
  one row per range.  Larger offsets join rows to their neighbour by position,
  an equi-join on a unique key.

Per-group top-n (DISTINCT ON, n-th per group) uses Spark's window with a rank
filter, which plans a partial ``WindowGroupLimit`` before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_parallelism, scratch_path

#: ``monotonically_increasing_id`` holds the partition above these bits and the row below them.
_ROW_BITS = 33


class SortKey:
    """One ORDER BY item: column name, direction and NULL placement."""

    def __init__(self, name: str, ascending: bool = True, nulls_first: bool | None = None):
        self.name = name
        self.ascending = ascending
        # PostgreSQL's default: NULLS LAST for ASC, NULLS FIRST for DESC.
        self.nulls_first = not ascending if nulls_first is None else nulls_first

    def column(self) -> Column:
        c = F.col(self.name)
        if self.ascending:
            return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()
        return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()


def asc(name: str, nulls_first: bool = False) -> SortKey:
    return SortKey(name, True, nulls_first)


def desc(name: str, nulls_first: bool = True) -> SortKey:
    return SortKey(name, False, nulls_first)


def _keys(order: Sequence[SortKey | str]) -> list[SortKey]:
    return [k if isinstance(k, SortKey) else SortKey(k) for k in order]


def range_buckets(df: DataFrame, order: Sequence[SortKey | str], num_buckets: int | None = None,
                  name: str = "_bucket", place: str | None = None) -> DataFrame:
    """Tag rows with the index of their range in the total order ``order``.

    One range shuffle and sort over the input, written and read back; with
    ``place``, also each row's 1-based place in its range.  The ranges are cut
    on full key tuples, so a hot leading key is split by the remaining keys.
    """
    spark = df.sparkSession
    cols = [k.column() for k in _keys(order)]
    dealt = (df.repartitionByRange(num_buckets or default_parallelism(spark), *cols).sortWithinPartitions(*cols)
               .withColumn("_rb_id", F.monotonically_increasing_id()))
    path = scratch_path(spark, "ranges")
    dealt.write.parquet(path)
    out = spark.read.schema(dealt.schema).parquet(path).withColumn(name, F.shiftrightunsigned("_rb_id", _ROW_BITS).cast("int"))
    if place:
        out = out.withColumn(place, F.col("_rb_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1)
    return out.drop("_rb_id")


def global_position(df: DataFrame, order: Sequence[SortKey | str], name: str = "pos",
                    num_buckets: int | None = None) -> DataFrame:
    """Add a 1-based position of each row in the total order ``order``.

    Same result as ``row_number() OVER (ORDER BY order)`` but without moving
    every row into one task: the place of a row in its range is shifted by the
    row count of all earlier ranges.  The offset table has one row per
    range (bounded by configuration), so broadcasting it is safe.  Give an
    order that is unique (append a key as tie-break) for a deterministic
    numbering.
    """
    keys = _keys(order)
    tagged = range_buckets(df, keys, num_buckets, "_gp_b", "_gp_local")
    counts = tagged.groupBy("_gp_b").agg(F.count(F.lit(1)).alias("_gp_n"))
    before = Window.orderBy("_gp_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_gp_b", F.coalesce(F.sum("_gp_n").over(before), F.lit(0)).alias("_gp_off"))
    return (tagged.join(F.broadcast(offsets), "_gp_b")
                    .withColumn(name, F.col("_gp_off") + F.col("_gp_local"))
                    .drop("_gp_b", "_gp_local", "_gp_off"))


def global_cumsum(df: DataFrame, order: Sequence[SortKey | str], value_col: str, name: str,
                  num_buckets: int | None = None) -> DataFrame:
    """Running total of ``value_col`` in the total order ``order`` (unique keys).

    ``SUM(value) OVER (ORDER BY order ROWS UNBOUNDED PRECEDING)`` computed per
    range bucket and shifted by the totals of the earlier buckets (one row
    per bucket, broadcast).
    """
    keys = _keys(order)
    tagged = range_buckets(df, keys, num_buckets, "_cs_b")
    w = (Window.partitionBy("_cs_b").orderBy(*[k.column() for k in keys])
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = tagged.withColumn("_cs_local", F.sum(value_col).over(w))
    totals = tagged.groupBy("_cs_b").agg(F.sum(value_col).alias("_cs_t"))
    before = Window.orderBy("_cs_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_cs_b", F.coalesce(F.sum("_cs_t").over(before), F.lit(0)).alias("_cs_off"))
    return (local.join(F.broadcast(offsets), "_cs_b")
                 .withColumn(name, F.col("_cs_off") + F.col("_cs_local"))
                 .drop("_cs_b", "_cs_local", "_cs_off"))


def global_rank(df: DataFrame, order: Sequence[SortKey | str], tie: Sequence[SortKey | str] = (),
                name: str = "rank", dense: bool = False) -> DataFrame:
    """``RANK()``/``DENSE_RANK() OVER (ORDER BY order)`` without one-task windows.

    Tied rows share a rank, so only the distinct order keys are ordered: a
    histogram ``key -> row count`` is aggregated map-side, RANK is one plus
    the running count of the keys before it and DENSE_RANK the position of
    the key; the per-key value is joined back (an equi-join AQE can
    broadcast when the histogram is small or split when one key is hot).
    ``tie`` is accepted for symmetry with ROW_NUMBER and not needed.
    """
    keys = _keys(order)
    key_cols = [k.name for k in keys]
    if dense:
        groups = df.select(*key_cols).distinct()
        per_group = global_position(groups, keys, "_rk_val")
        return _join_group_value(df, per_group, key_cols, "_rk_val", name)
    hist = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_rk_n"))
    cum = global_cumsum(hist, keys, "_rk_n", "_rk_cum")
    per_group = cum.select(*key_cols, (F.col("_rk_cum") - F.col("_rk_n") + F.lit(1)).alias("_rk_val"))
    return _join_group_value(df, per_group, key_cols, "_rk_val", name)


def _join_group_value(df: DataFrame, groups: DataFrame, key_cols: Sequence[str],
                      value_col: str, name: str) -> DataFrame:
    """Attach a per-group value to every row (NULL-safe on the group key)."""
    renamed = groups.select(*[F.col(c).alias(f"_jg_{i}") for i, c in enumerate(key_cols)],
                            F.col(value_col).alias(name))
    cond = None
    for i, c in enumerate(key_cols):
        e = F.col(c).eqNullSafe(F.col(f"_jg_{i}"))
        cond = e if cond is None else cond & e
    return df.join(renamed, cond, "inner").drop(*[f"_jg_{i}" for i in range(len(key_cols))])


def _not_before(values: Sequence[Column], bounds: Sequence[Column], keys: Sequence[SortKey]) -> Column:
    """Whether the tuple ``values`` is at or after ``bounds`` in the order ``keys``."""
    out = F.lit(True)
    for v, b, k in reversed(list(zip(values, bounds, keys))):
        later = v > b if k.ascending else v < b
        # A NULL against a value: before it or after it, as the key says.
        above = (v.isNotNull() & b.isNull()) if k.nulls_first else (v.isNull() & b.isNotNull())
        out = F.coalesce(later, F.lit(False)) | above | (v.eqNullSafe(b) & out)
    return out


def _hot_ranges(df: DataFrame, partition_cols: Sequence[str], keys: Sequence[SortKey], rows_per_range: int) -> DataFrame | None:
    """Partition keys with more than ``rows_per_range`` rows, each with the bounds that cut it into ranges.

    There are at most rows / ``rows_per_range`` such keys, and as many bounds:
    a number set by the caller's parallelism, whatever the size of the table.
    Bounds come from a sample of the hot keys' rows by a hash of the row, so a
    retried task draws the same one.
    """
    sizes = df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("_hr_n")).where(F.col("_hr_n") > rows_per_range)
    sizes = sizes.select(*[F.col(c).alias(f"_hr_{i}") for i, c in enumerate(partition_cols)], "_hr_n")
    sizes = df.sparkSession.createDataFrame(sizes.collect(), sizes.schema)
    if sizes.isEmpty():
        return None
    same = F.lit(True)
    for i, c in enumerate(partition_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_hr_{i}"))
    ranges = F.ceil(F.col("_hr_n") / F.lit(rows_per_range))
    # About 64 sampled rows per range.
    draw = F.pmod(F.xxhash64(*partition_cols, *[k.name for k in keys]), F.lit(1 << 30)) < F.least(
        F.lit(1.0), 64.0 * ranges / F.col("_hr_n")) * (1 << 30)
    drawn = df.select(*dict.fromkeys([*partition_cols, *[k.name for k in keys]])).join(F.broadcast(sizes), same).where(draw)
    hot = Window.partitionBy(*[f"_hr_{i}" for i in range(len(partition_cols))])
    place = F.row_number().over(hot.orderBy(*[k.column() for k in keys]))
    every = F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(hot) / ranges))
    bounds = (drawn.withColumn("_hr_p", place).withColumn("_hr_e", every).where(F.col("_hr_p") % F.col("_hr_e") == 0)
              .groupBy(*[f"_hr_{i}" for i in range(len(partition_cols))])
              .agg(F.collect_list(F.struct(*[F.col(k.name).alias(f"k{i}") for i, k in enumerate(keys)])).alias("_hr_bounds")))
    return df.sparkSession.createDataFrame(bounds.collect(), bounds.schema)


def shift(df: DataFrame, partition_cols: Sequence[str], order: Sequence[SortKey | str],
          value_col: str, offset: int, name: str, default: Column | str | None = None,
          rows_per_range: int | None = None) -> DataFrame:
    """``LAG(value, offset, default)`` (offset > 0) or ``LEAD`` (offset < 0).

    ``order`` must make rows unique within a partition.  ``default`` may be a
    column (``LAG(x, 1, x)``); it applies only when the neighbouring row does
    not exist, never when the neighbour's value is NULL.

    For offset 1 within partitions this is Spark's window, with one exchange,
    on (partition, range): a count per key, reduced map-side, finds the keys
    with more than ``rows_per_range`` rows, and only their rows are cut into
    ranges of the order (all others are one range).  The row at a range's edge
    takes its neighbour from a boundary table with one row per range of a hot
    key.  Without partitions the whole table is one hot key, which
    ``range_buckets`` deals and writes; larger offsets join rows to their
    neighbour by global position.
    """
    if abs(offset) != 1:
        return _shift_by_position(df, partition_cols, order, value_col, offset, name, default)
    dflt = F.lit(None) if default is None else F.col(default) if isinstance(default, str) else default
    if not partition_cols:
        return _shift_in_buckets(df, order, value_col, offset, name, dflt)
    keys = _keys(order)
    narrow = df.select(*dict.fromkeys([*partition_cols, *[k.name for k in keys]]))
    if rows_per_range is None:
        rows_per_range = max(1 << 20, narrow.count() // default_parallelism(df.sparkSession))
    hot = _hot_ranges(narrow, partition_cols, keys, rows_per_range)
    is_lag = offset == 1
    fn = F.lag if is_lag else F.lead
    nb = F.struct(F.col(value_col).alias("v"))
    cols = [k.column() for k in keys]
    if hot is None:
        found = df.withColumn("_sh_nb", fn(nb, 1).over(Window.partitionBy(*partition_cols).orderBy(*cols)))
        return found.withColumn(name, F.when(F.col("_sh_nb").isNotNull(), F.col("_sh_nb.v")).otherwise(dflt)).drop("_sh_nb")
    same = F.lit(True)
    for i, c in enumerate(partition_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_hr_{i}"))
    after = lambda b: _not_before([F.col(k.name) for k in keys], [b[f"k{i}"] for i in range(len(keys))], keys)
    cut = F.when(F.col("_hr_bounds").isNotNull(), F.size(F.filter("_hr_bounds", after))).otherwise(F.lit(0))
    tagged = (df.join(F.broadcast(hot), same, "left").withColumn("_sh_r", cut)
                .withColumn("_sh_hot", F.col("_hr_bounds").isNotNull()).drop(*hot.columns))
    w = Window.partitionBy(*partition_cols, "_sh_r")
    win = (tagged.withColumn("_sh_nb", fn(nb, 1).over(w.orderBy(*cols)))
                 .withColumn("_sh_far", (F.lead if is_lag else F.lag)(nb, 1).over(w.orderBy(*cols)).isNull()))
    # The last row of each range of a hot key (the first one for LEAD) goes to the next range that has rows.
    edge = win.where(F.col("_sh_hot") & F.col("_sh_far")).select(
        *[F.col(c).alias(f"_hr_{i}") for i, c in enumerate(partition_cols)], "_sh_r", nb.alias("_sh_edge"))
    per_key = Window.partitionBy(*[f"_hr_{i}" for i in range(len(partition_cols))]).orderBy("_sh_r")
    to = (F.lead if is_lag else F.lag)("_sh_r", 1).over(per_key)
    edge = edge.withColumn("_hr_r", to).where(F.col("_hr_r").isNotNull()).drop("_sh_r")
    joined = win.join(F.broadcast(edge), same & (F.col("_sh_r") == F.col("_hr_r")) & F.col("_sh_nb").isNull(), "left")
    neighbour = F.coalesce("_sh_nb", "_sh_edge")
    return (joined.withColumn(name, F.when(neighbour.isNotNull(), neighbour.getField("v")).otherwise(dflt))
                  .drop("_sh_nb", "_sh_far", "_sh_r", "_sh_hot", "_sh_edge", "_hr_r", *[f"_hr_{i}" for i in range(len(partition_cols))]))


def _shift_in_buckets(df: DataFrame, order: Sequence[SortKey | str], value_col: str, offset: int, name: str,
                      dflt: Column) -> DataFrame:
    """LAG or LEAD of one over the whole table, in balanced ranges of the order."""
    keys = _keys(order)
    tagged = range_buckets(df, keys, None, "_sh_b")
    w = Window.partitionBy("_sh_b").orderBy(*[k.column() for k in keys])
    nb = F.struct(F.col(value_col).alias("v"))
    is_lag = offset == 1
    fn, back = (F.lag, F.lead) if is_lag else (F.lead, F.lag)
    win = tagged.withColumn("_sh_nb", fn(nb, 1).over(w)).withColumn("_sh_far", back(nb, 1).over(w).isNull())
    # One row per non-empty bucket; pass it to the next non-empty bucket
    # (previous one for LEAD).  Bounded by the bucket count.
    boundary = win.where("_sh_far").select("_sh_b", nb.alias("_sh_edge"))
    step = back("_sh_b").over(Window.orderBy("_sh_b"))
    boundary = boundary.select(step.alias("_sh_b"), "_sh_edge").where(F.col("_sh_b").isNotNull())
    joined = win.join(F.broadcast(boundary), "_sh_b", "left").select(*win.columns, "_sh_edge")
    neighbour = F.coalesce("_sh_nb", "_sh_edge")
    return (joined.withColumn(name, F.when(neighbour.isNotNull(), neighbour.getField("v")).otherwise(dflt))
                  .drop("_sh_b", "_sh_nb", "_sh_far", "_sh_edge"))


def _shift_by_position(df, partition_cols, order, value_col, offset, name, default):
    """Neighbour at any offset: equi-join on global position +- offset."""
    keys = [*_keys(partition_cols), *_keys(order)]
    pos = global_position(df, keys, "_sh_pos")
    neighbour = pos.select(
        (F.col("_sh_pos") + F.lit(offset)).alias("_sh_pos"),
        *[F.col(c).alias(f"_sh_p_{i}") for i, c in enumerate(partition_cols)],
        F.col(value_col).alias("_sh_val"),
        F.lit(True).alias("_sh_hit"),
    )
    joined = pos.join(neighbour, "_sh_pos", "left")
    same = F.col("_sh_hit").isNotNull()
    for i, c in enumerate(partition_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_sh_p_{i}"))
    if default is None:
        dflt = F.lit(None)
    else:
        dflt = F.col(default) if isinstance(default, str) else default
    return (joined.withColumn(name, F.when(same, F.col("_sh_val")).otherwise(dflt))
                  .drop("_sh_pos", "_sh_val", "_sh_hit", *[f"_sh_p_{i}" for i in range(len(partition_cols))]))


def lag(df, partition_cols, order, value_col, name, offset=1, default=None):
    return shift(df, partition_cols, order, value_col, offset, name, default)


def lead(df, partition_cols, order, value_col, name, offset=1, default=None):
    return shift(df, partition_cols, order, value_col, -offset, name, default)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey | str]) -> DataFrame:
    """``SELECT DISTINCT ON (keys) ... ORDER BY keys, order``: first row per key.

    The ``row_number() = 1`` filter is planned with a partial WindowGroupLimit
    before the shuffle, so each map task sends at most one row per key.
    """
    w = Window.partitionBy(*keys).orderBy(*[k.column() for k in _keys(order)])
    return df.withColumn("_do_rn", F.row_number().over(w)).filter(F.col("_do_rn") == 1).drop("_do_rn")


def nth_dense_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey | str],
                        n: int, name: str = "dense_rank") -> DataFrame:
    """Rows whose DENSE_RANK within their group equals ``n`` (all ties)."""
    w = Window.partitionBy(*keys).orderBy(*[k.column() for k in _keys(order)])
    return df.withColumn(name, F.dense_rank().over(w)).filter(F.col(name) == n)


def nth_distinct_value(df: DataFrame, col: str, n: int, descending: bool = True) -> DataFrame:
    """One-row frame holding the n-th distinct non-NULL value of ``col``.

    Distinct values are reduced map-side, then only ``n`` of them per task
    reach the top-n (TakeOrderedAndProject); the result is a single row.
    """
    vals = df.select(col).where(F.col(col).isNotNull()).distinct()
    top = vals.orderBy(F.col(col).desc() if descending else F.col(col).asc()).limit(n)
    agg = F.min(col) if descending else F.max(col)
    counted = top.agg(agg.alias("_nth"), F.count(F.lit(1)).alias("_k"))
    return counted.where(F.col("_k") == n).select("_nth")


def rows_at_nth_distinct(df: DataFrame, col: str, n: int, descending: bool = True) -> DataFrame:
    """``WHERE dense_rank() OVER (ORDER BY col DESC) = n`` with all ties, NULLs excluded."""
    nth = nth_distinct_value(df, col, n, descending)
    # `nth` has at most one row by construction.
    return df.join(F.broadcast(nth), df[col] == nth["_nth"], "inner").drop("_nth")


def running_count(df: DataFrame, group_cols: Sequence[str], order: Sequence[SortKey | str],
                  name: str = "running_n", size_name: str | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY order)`` for skewed groups.

    Position in the global (group, order) order minus the first position of
    the group.  Group starts (and, with ``size_name``, the group size, i.e.
    ``COUNT(*) OVER (PARTITION BY group)``) come from one aggregate that is
    reduced map-side before it is joined back.
    """
    pos = global_position(df, [*_keys(group_cols), *_keys(order)], "_rc_pos")
    aggs = [F.min("_rc_pos").alias("_rc_start")]
    if size_name:
        aggs.append(F.count(F.lit(1)).alias("_rc_size"))
    groups = pos.groupBy(*group_cols).agg(*aggs)
    renamed = groups.select(*[F.col(c).alias(f"_jg_{i}") for i, c in enumerate(group_cols)],
                            "_rc_start", *(["_rc_size"] if size_name else []))
    cond = None
    for i, c in enumerate(group_cols):
        e = F.col(c).eqNullSafe(F.col(f"_jg_{i}"))
        cond = e if cond is None else cond & e
    joined = pos.join(renamed, cond, "inner").drop(*[f"_jg_{i}" for i in range(len(group_cols))])
    out = joined.withColumn(name, F.col("_rc_pos") - F.col("_rc_start") + F.lit(1))
    if size_name:
        out = out.withColumnRenamed("_rc_size", size_name)
    return out.drop("_rc_pos", "_rc_start")
