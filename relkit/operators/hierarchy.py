"""Recursive hierarchy walk (``WITH RECURSIVE`` over a parent pointer).

Pointer doubling: every node holds a pointer to an ancestor and the number of
steps to it, at first its parent and one.  A round joins each pointer with the
state of the node it points to: where that node has a level, so has this one
(the steps added), else the pointer moves on to that node's own ancestor and
the steps add up.  Steps double every round, so a tree of depth ``d`` takes
about log2(d) rounds, where a walk from the roots down takes ``d``.  A round
moves three narrow columns; parents and payload join once, at the end.

Every round is written to the shared scratch folder, so a lost executor costs
one round.  A round in which no pointer ended ends the walk: in any chain that
ends at a root (or at a missing parent), some node of each length ends in its
round, so what is left is on a cycle or below one.

The result is that of the ``UNION ALL`` recursion: rows below a missing parent
and on a cycle that no root reaches are not emitted.  Where ids repeat, a node
reachable along two paths is emitted twice, and a cycle that a root reaches,
which the recursion would follow without end, raises ``RuntimeError``; such
tables are walked from the roots, level by level, with the edges partitioned by
(parent, salt) once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import default_parallelism, ensure_checkpoint_dir, scratch_path

SALT = 32


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def walk_down(edges: DataFrame, id_col: str, parent_col: str, max_depth: int | None = None,
              keep: tuple = (), cycles: str = "omit") -> DataFrame:
    """Rows ``(id, parent, level, *keep)`` for every node reachable from a root.

    ``cycles="error"`` also raises for cycles that no root reaches.  More than
    ``max_depth`` levels raise.
    """
    if cycles not in ("omit", "error"):
        raise ValueError("cycles is 'omit' or 'error'")
    nodes = edges.select(F.col(id_col).alias("_h_id"), F.col(parent_col).alias("_h_parent"),
                         *[F.col(c).alias(f"_h_k{i}") for i, c in enumerate(keep)])
    start = _written(nodes.select("_h_id", F.col("_h_parent").alias("_h_to"), F.lit(1).cast("long").alias("_h_steps"),
                                  F.when(F.col("_h_parent").isNull(), 1).cast("int").alias("_h_level")), "hierarchy")
    # A row without an id is nobody's parent.
    repeats = start.dropna(subset=["_h_id"]).groupBy("_h_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeats.isEmpty():
        return _walk_levels(edges, id_col, parent_col, max_depth, keep)
    # Rows without an id need no pointer: their level is their parent's and one, as for any other row, but
    # they cannot be joined back by id.  They take part under no id and are joined by their parent.
    done = start.where(F.col("_h_level").isNotNull() & F.col("_h_id").isNotNull())
    active = start.where(F.col("_h_level").isNull() & F.col("_h_id").isNotNull())
    left = active.count()
    while left:
        state = done.unionByName(active).select(
            F.col("_h_id").alias("_h_to"), F.col("_h_to").alias("_h_next"), F.col("_h_steps").alias("_h_more"),
            F.col("_h_level").alias("_h_base"))
        moved = active.drop("_h_level").join(state, "_h_to").select(
            "_h_id", F.col("_h_next").alias("_h_to"), (F.col("_h_steps") + F.col("_h_more")).alias("_h_steps"),
            (F.col("_h_base") + F.col("_h_steps")).cast("int").alias("_h_level"))
        moved = _written(moved, "hierarchy")
        done = done.unionByName(moved.where(F.col("_h_level").isNotNull()))
        active = moved.where(F.col("_h_level").isNull())
        before, left = left, active.count()
        if left == before:
            if cycles == "error":
                raise RuntimeError(f"{left} rows are on a cycle or below one")
            break
    levels = done.select("_h_id", "_h_level")
    if max_depth is not None and not levels.where(F.col("_h_level") > max_depth).isEmpty():
        raise RuntimeError(f"hierarchy deeper than {max_depth} levels")
    out = nodes.join(levels, "_h_id")
    unnamed = nodes.where(F.col("_h_id").isNull())
    above = levels.select(F.col("_h_id").alias("_h_parent"), (F.col("_h_level") + 1).alias("_h_level"))
    below = unnamed.join(above, "_h_parent").select(*out.columns)
    roots = unnamed.where(F.col("_h_parent").isNull()).withColumn("_h_level", F.lit(1)).select(*out.columns)
    return (out.unionByName(below).unionByName(roots)
               .select(F.col("_h_id").alias(id_col), F.col("_h_parent").alias(parent_col), F.col("_h_level").alias("level"),
                       *[F.col(f"_h_k{i}").alias(c) for i, c in enumerate(keep)]))


def _walk_levels(edges: DataFrame, id_col: str, parent_col: str, max_depth: int | None, keep: tuple) -> DataFrame:
    """The walk level by level, for tables whose ids repeat."""
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    nodes = (edges.select(F.col(id_col).alias("_h_id"), F.col(parent_col).alias("_h_parent"),
                          *[F.col(c) for c in keep])
                  .withColumn("_h_salt", F.pmod(F.xxhash64("_h_id"), F.lit(SALT)))
                  .repartition(default_parallelism(spark), "_h_parent", "_h_salt")
                  .checkpoint(eager=True))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long")))
    frontier = nodes.where(F.col("_h_parent").isNull()).withColumn("_h_level", F.lit(1)).checkpoint(eager=True)
    levels = [frontier]
    depth = 1
    # A walk deeper than the number of rows goes round a cycle.
    limits = [x for x in (max_depth, nodes.count()) if x is not None]
    while True:
        parents = frontier.select(F.col("_h_id").alias("_h_parent"), F.col("_h_level").alias("_h_plevel"),
                                  salts.alias("_h_salt"))
        children = (nodes.join(parents, ["_h_parent", "_h_salt"])
                         .withColumn("_h_level", F.col("_h_plevel") + F.lit(1)).drop("_h_plevel")
                         .checkpoint(eager=True))
        if children.count() == 0:  # one job over the checkpointed level
            break
        depth += 1
        if depth > min(limits):
            raise RuntimeError(f"hierarchy deeper than {min(limits)} levels (or a cycle reachable from a root)")
        levels.append(children)
        frontier = children
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out.select(F.col("_h_id").alias(id_col), F.col("_h_parent").alias(parent_col),
                      F.col("_h_level").alias("level"), *[F.col(c) for c in keep])


def walk_down_sql(spark, view: str, id_col: str, parent_col: str, keep: tuple = ()) -> DataFrame:
    """The same walk as Spark SQL ``WITH RECURSIVE`` over a registered view.

    Convenient for shallow, small trees; Spark caps recursion by
    ``spark.sql.cteRecursionLevelLimit`` / ``...RowLimit``, so deep or large
    hierarchies use ``walk_down``.
    """
    extra = "".join(f", {c}" for c in keep)
    extra_e = "".join(f", e.{c}" for c in keep)
    return spark.sql(f"""
        WITH RECURSIVE tree AS (
          SELECT {id_col}, {parent_col}, 1 AS level{extra} FROM {view} WHERE {parent_col} IS NULL
          UNION ALL
          SELECT e.{id_col}, e.{parent_col}, t.level + 1{extra_e}
          FROM {view} e JOIN tree t ON e.{parent_col} = t.{id_col})
        SELECT {id_col}, {parent_col}, level{extra} FROM tree""")
