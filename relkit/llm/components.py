"""Connected components of an edge table by alternating star contractions.

Every round replaces edges by edges to a smaller neighbour (large star, then
small star) until each component is one star around its smallest node.  All
steps are joins and map-side combined minimums; no neighbour list is ever
built, and each round is written to the shared scratch folder.  Edges that are
stars already (as the near-duplicate rounds make them) take no round at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import stored


def _star(directed: DataFrame, keep_larger: bool) -> DataFrame:
    """Link the neighbours of each ``u`` (and ``u``) to the smallest of them.

    ``directed`` has a row for each (u, v) that u looks at.  With
    ``keep_larger`` only the neighbours above ``u`` move.
    """
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("u2"), F.least("u", "m").alias("m"))
    moved = directed.join(least, F.col("u") == F.col("u2"))
    if keep_larger:
        return moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (moved.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.where(F.col("u2") != F.col("m")).select(F.col("u2").alias("u"), F.col("m").alias("v"))))


def _all_stars(e: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` and no ``v`` is a ``u``."""
    twice = e.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.isEmpty() and e.join(e.select(F.col("u").alias("inner")).distinct(), F.col("v") == F.col("inner"), "left_semi").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """(node, root) for every node on an edge; ``root`` is the least node it reaches.

    ``rows``: how many edges there are at most, if known.  NULL ends and self loops are ignored; an empty edge table gives no rows.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    e = stored(e, "cc-edges", rows)
    # No round has more edges than the one before.
    rows = e.count()
    while not _all_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, keep_larger=True).distinct()
        e = stored(_star(large, keep_larger=False).distinct(), "cc-stars", rows)
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
