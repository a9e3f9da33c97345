"""Centroid clustering with a Walsh-Hadamard progressive search (operator 12).

Vectors become integers, floor(scale * x).  Vectors and centroids go through
the exact integer Walsh-Hadamard transform, whose coefficients keep squared
distances up to the factor ``size``.  Per vector the squared differences of
coefficients are added up from the coarsest to the finest (by sequency).  The
centroid that leads after the first few is finished at once and bounds the
others: a centroid whose sum so far is strictly above the best finished one
goes, all others finish every coefficient.  So the nearest centroid and its
distance are exact, ties included.

A round is one pass over the stored vectors.  Every task adds up its own sums,
Spark adds the tasks' sums, and the driver sees one row per centroid and
component (``k * size`` numbers, whatever the input).

Defined cases: vectors that are NULL, of another length, or with a NULL, NaN
or infinite component are left out, and so are those with a component of
2**44 / scale or more in size, whose distances no long can hold; distances and sums
beyond a long are NULL; of rows that share an id each is a vector of its own;
NULL ids come last among the first centroids; fewer than ``k`` vectors give as
many centroids; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import batch, prepare, stored

#: Integers up to this size have distances that 64-bit arithmetic holds at every step.
_EXACT = 1 << 20
_LARGEST = 1 << 44
_LONG = (1 << 63) - 1


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of every row, in Hadamard order; the row length is a power of two."""
    n, size = x.shape
    step = 1
    while step < size:
        pairs = x.reshape(n, size // (2 * step), 2, step)
        left, right = pairs[:, :, 0, :], pairs[:, :, 1, :]
        x = np.stack([left + right, left - right], axis=2).reshape(n, size)
        step *= 2
    return x


def coarse_to_fine(size: int) -> np.ndarray:
    """The coefficients by the sign changes of their rows, fewest first."""
    rows = walsh_hadamard(np.eye(size, dtype=np.int64))
    return np.argsort((np.diff(rows, axis=1) != 0).sum(axis=1), kind="stable")


def _steps(size: int) -> list[slice]:
    """Ever larger parts of the coefficients: the first 4, up to 8, 16 and so on."""
    edges = [0, *(e for e in (4 << k for k in range(60)) if e < size), size]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _squares(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    diff = one - other
    return (diff * diff).sum(axis=1)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid (ties: the smaller number)."""
    n, size = vectors.shape
    k = len(centroids)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if max(np.abs(vectors).max(), np.abs(centroids).max()) > _EXACT:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    order = coarse_to_fine(size)
    v, c = walsh_hadamard(vectors)[:, order], walsh_hadamard(centroids)[:, order]
    row, number = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    total = np.zeros(n * k, v.dtype)
    bound = None
    for part in _steps(size):
        total = total + _squares(v[row, part], c[number, part])
        if bound is None:
            leader = np.argmin(total.reshape(n, k), axis=1)
            bound = _squares(v, c[leader])
        stay = total <= bound[row]
        row, number, total = row[stay], number[stay], total[stay]
    # All that are left have all coefficients; rows and numbers are still in ascending order.
    first = np.flatnonzero(np.diff(row, prepend=-1))
    best = np.minimum.reduceat(total, first)
    hit = np.flatnonzero(total == np.repeat(best, np.diff(np.append(first, len(row)))))
    _, at = np.unique(row[hit], return_index=True)
    return number[hit[at]], best // size


def _integers(column, size: int, scale: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).astype(np.int64).reshape(-1, size)


def _assigned(rb: pa.RecordBatch, centroids: np.ndarray, scale: int, rows: int = 2048):
    """Slices of a batch: ids, vectors, nearest centroids and distances."""
    for at in range(0, rb.num_rows, rows):
        part = rb.slice(at, rows)
        vectors = _integers(part.column(1), centroids.shape[1], scale)
        yield part.column(0), vectors, *nearest(vectors, centroids)


_SUMS = pa.schema([("cluster", pa.int32()), ("at", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])


def _sums(centroids: np.ndarray, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        k, size = centroids.shape
        count, total = [0] * k, [[0] * size for _ in range(k)]
        for rb in batches:
            for _, vectors, number, _ in _assigned(rb, centroids, scale):
                for c in np.unique(number):
                    own = vectors[number == c]
                    count[c] += len(own)
                    total[c] = [a + int(b) for a, b in zip(total[c], own.sum(axis=0))]
        rows = [(c, j, count[c], Decimal(total[c][j])) for c in range(k) if count[c] for j in range(size)]
        if rows:
            yield batch(_SUMS, *zip(*rows))
    return run


def _moved(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """One round: every non-empty centroid becomes floor(sum / count) of its vectors."""
    sums = (vectors.mapInArrow(_sums(centroids, scale), "cluster int, at int, n long, total decimal(38,0)")
            .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")))
    new = centroids.copy()
    # One row per centroid and component.
    for r in sums.collect():
        new[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return new


_RESULT = "id long, cluster int, distance long"
_ROWS = pa.schema([("id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def _assign(centroids: np.ndarray, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for ids, _, number, distance in _assigned(rb, centroids, scale):
                yield batch(_ROWS, ids, number, [d if d <= _LONG else None for d in distance.tolist()])
    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """(id, vector) of the rows whose vector has ``size`` finite components."""
    limit = float(_LARGEST)
    fine = F.forall("vector", lambda x: F.coalesce(F.abs(x.cast("double") * scale) < limit, F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    # Spark takes NaN as larger than any number, so it fails the comparison.
    return rows.where((F.size("vector") == size) & fine)


def first_centroids(vectors: DataFrame, k: int, salt: str, scale: int) -> np.ndarray:
    """The integers of the ``k`` vectors with the smallest sha256 of salt and id."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    rows = vectors.orderBy(digest.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.array([[int(np.floor(float(x) * scale)) for x in r["vector"]] for r in rows], np.int64)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 64, k: int = 40,
            rounds: int = 5, salt: str = "2:", scale: int = 256) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every usable vector, and the final centroids."""
    if size & (size - 1) or size < 1:
        raise ValueError("the transform needs a power of two as the vector size")
    spark = vectors.sparkSession
    prepare(spark)
    kept = stored(usable(vectors, id_col, vector_col, size, scale), "centroids-vectors")
    centroids = first_centroids(kept, k, salt, scale)
    if not len(centroids):
        return spark.createDataFrame([], _RESULT), np.zeros((0, size), np.int64)
    for _ in range(rounds):
        centroids = _moved(kept, centroids, scale)
    return stored(kept.mapInArrow(_assign(centroids, scale), _RESULT), "centroids-assigned"), centroids


def digests(assigned: DataFrame, centroids: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """The assigned rows with the inertia of their cluster and of all, and their centroid's sha256."""
    spark = assigned.sparkSession
    named = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    names = spark.createDataFrame(named, "c int, centroid_sha256 string")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    known = F.count("distance") == F.count(F.lit(1))
    sums = assigned.groupBy(F.col("cluster").alias("s")).agg(F.when(known, total).alias("cluster_sum"))
    whole = sums.agg(F.when(F.count("cluster_sum") == F.count(F.lit(1)), F.sum("cluster_sum")).alias("sum"))
    long = lambda c: F.expr(f"try_cast({c} AS bigint)")
    # One row per centroid: at most k.
    per = sums.join(F.broadcast(names), F.col("s") == F.col("c")).crossJoin(F.broadcast(whole)).select(
        "s", long("cluster_sum").alias("cluster_inertia"), long("sum").alias("inertia"), "centroid_sha256")
    return assigned.join(F.broadcast(per), F.col("cluster") == F.col("s")).select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 40, rounds: int = 5, size: int = 64, salt: str = "2:", scale: int = 256) -> str:
    """DuckDB SQL for the digests of ``embeddings``."""
    parts = [f"""v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
             f"""c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, q
  FROM (SELECT sha256('{salt}' || vec_id) AS h, q FROM v ORDER BY h LIMIT {k}))"""]

    def assigned(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (
  SELECT vec_id, q, CAST(best % {k} AS INT) AS cluster, best // {k} AS distance
  FROM (SELECT v.vec_id, v.q, min(list_sum(list_transform(v.q, lambda x, i: (x - c.q[i]) * (x - c.q[i]))) * {k} + c.c) AS best
        FROM v CROSS JOIN c{r} c GROUP BY v.vec_id, v.q))"""

    for r in range(rounds):
        parts.append(assigned(r))
        parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT o.c, COALESCE(m.q, o.q) AS q
  FROM c{r} o LEFT JOIN (
    SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY i) AS q
    FROM (SELECT cluster, i, sum(x) AS total, count(*) AS n
          FROM (SELECT cluster, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{r}) GROUP BY cluster, i)
    GROUP BY cluster) m ON m.cluster = o.c)""")
    parts.append(assigned(rounds))
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, a.cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.q, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.cluster"""
