"""Near-duplicate documents by min-max hashing (operator 4).

Each document's 5-word shingle set (``shingles.py``) is hashed under m linear
permutations; both the minimum and the maximum of each are kept, so m hash
evaluations per shingle give 2m signature values.  For sets of similarity s a
minimum agrees with probability s, and so does a maximum, which keeps the
estimate unbiased and lowers its variance.  The values are cut into bands of
``ROWS``; the number of bands follows from the threshold and ``MISS``, the
probability that a pair exactly at the threshold shares no band.

Work is done on classes of equal shingle sets.  A band bucket never emits its
pairs: every member is compared with a few pivots of its bucket on full sets,
and a bucket whose members are then connected is done.  Members of the others
are dealt into blocks of bounded size, and every two blocks are compared on full
sets in one task, which returns only the links that connect.  Nothing is capped.
The comparisons of a bucket that stays unconnected grow with the square of its
members outside its largest component; rows and shuffled bytes grow with its
members times its blocks.

Defined cases: NULL or empty text, or text without words, has an empty set and
is linked with nothing; fewer than five words make one shingle; repeated rows
and repeated ids are rows of their own (equal texts are linked whatever their
ids); a NULL id never becomes a component id unless the component has no
other; extra columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .shingles import mix, odd_multipliers, set_digest, shingle_set
from .util import batch, prepare, stored, text_or_empty

ROWS = 5
MISS = 1e-7
#: Members of a bucket that all others are compared with first.
PIVOTS = 4
#: Shingles in a block of a bucket that the pivots leave unconnected; a set counts as ``LEAST`` at least.
BLOCK, LEAST = 1 << 17, 128
#: Shingles that count as one row where it is decided how many files the sets go into.
SET_ROW = 64


def n_bands(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands needed so that a pair at the threshold is missed with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log1p(-threshold ** rows)) if threshold < 1 else 1


def min_max_bands(hashes: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """The band keys of a shingle set: from the least and greatest value under each permutation."""
    m = -(-bands * rows // 2)
    a, b = odd_multipliers(m, 101), odd_multipliers(m, 211)
    low = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(m, np.uint64)
    for at in range(0, len(hashes), 4096):
        x = np.multiply.outer(a, hashes[at:at + 4096])
        x += b[:, None]
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    values = np.stack([low, high], axis=1).reshape(-1)[: bands * rows].reshape(bands, rows)
    place = odd_multipliers(rows, 307)
    return mix((values * place).sum(axis=1, dtype=np.uint64) + odd_multipliers(bands, 401)).view(np.int64)


_FEATURES = pa.schema([("doc_id", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()),
                       ("n_shingles", pa.int64()), ("cls", pa.binary()), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("cls", pa.binary()), ("s", pa.binary())])
_EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _featurize(bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            n, cls, keys = [], [], []
            for text in rb.column(3).to_pylist():
                s = shingle_set(text)
                n.append(len(s))
                cls.append(set_digest(s) if len(s) else None)
                keys.append(min_max_bands(s, bands) if len(s) else None)
            yield batch(_FEATURES, rb.column(0), rb.column(1), rb.column(2), n, cls, keys)
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in batches:
        s = [shingle_set(t) for t in rb.column(0).to_pylist()]
        yield batch(_SETS, [set_digest(x) for x in s], [x.tobytes() for x in s])


def _confirm(num: int, den: int):
    """Keep the pairs with ``den * intersection >= num * union`` on full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            keep = []
            for x, y in zip(rb.column(2), rb.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield rb.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _spark_schema(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def text_keys() -> list:
    """Two hashes that tell a row's text apart, beside its id."""
    t = text_or_empty()
    return [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit("second"), t).alias("t2")]


def near_duplicates(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """Link documents with ``den * |A & B| >= num * |A | B|`` and label the components.

    Returns a row per document: doc_id, t1, t2 (text hashes), n_shingles,
    component_id (least doc_id reachable), kept (doc_id = component_id) and
    first (the one row key of the component to keep when ids repeat).
    """
    return _linked(docs, num, den)[0]


def _linked(docs: DataFrame, num: int, den: int) -> tuple[DataFrame, int]:
    """What ``near_duplicates`` returns, and its number of rows."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_keys(), text_or_empty().alias("text"))
    bands = n_bands(num / den)
    feats = stored(rows.mapInArrow(_featurize(bands), _spark_schema(_FEATURES)), "nd-features")
    n_rows = feats.count()
    classes = stored(
        feats.where(F.col("cls").isNotNull()).groupBy("cls")
        .agg(F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "t1", "t2")).alias("rep"),
             F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "t1", "t2"))).alias("top"),
             F.first("bands").alias("bands"), F.first("n_shingles").alias("size")), "nd-classes", n_rows)
    labels = _label(rows, classes, bands, num, den)
    if labels is None:
        named = classes.select("cls", "least_id", F.coalesce("top", "rep").alias("top"))
    else:
        rooted = classes.join(labels, F.col("cls") == F.col("node"), "left").select(
            "cls", "least_id", "top", "rep", F.coalesce("root", "cls").alias("root"))
        least = rooted.groupBy("root").agg(F.min("least_id").alias("least_id"),
                                           F.coalesce(F.min("top"), F.min("rep")).alias("top"))
        named = rooted.select("cls", "root").join(least, "root").select("cls", "least_id", "top")
    named = named.select(F.col("cls").alias("c"), "least_id", "top")
    own = F.struct("doc_id", "t1", "t2")
    linked = (feats.where(F.col("cls").isNotNull()).join(named, F.col("cls") == F.col("c"))
              .select("doc_id", "t1", "t2", "n_shingles", F.col("least_id").alias("component_id"),
                      own.eqNullSafe(F.col("top")).alias("first")))
    alone = feats.where(F.col("cls").isNull()).select(
        "doc_id", "t1", "t2", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    out = linked.unionByName(alone)
    out = out.select("doc_id", "t1", "t2", "n_shingles", "component_id",
                     F.coalesce(F.col("doc_id") == F.col("component_id"),
                                F.col("component_id").isNull()).alias("kept"), "first")
    return out, n_rows


def _label(rows: DataFrame, classes: DataFrame, bands: int, num: int, den: int) -> DataFrame | None:
    """(node, root) of the classes that have a link; None when no bucket has two members."""
    held = classes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("shingles")).first()
    banded = classes.select("cls", F.greatest("size", F.lit(LEAST)).alias("weight"), F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("k"))
    left = stored(banded.join(shared, F.col("key") == F.col("k")).select("key", "cls", "weight"), "nd-members", held["n"] * bands)
    members = left.count()
    if not members:
        return None
    involved = classes.join(left.select(F.col("cls").alias("m")).distinct(), F.col("cls") == F.col("m"), "left_semi")
    wanted = involved.select(*(F.col(f"rep.{c}").alias(f"r_{c}") for c in ("doc_id", "t1", "t2")))
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("r_doc_id")) & (F.col("t1") == F.col("r_t1"))
                      & (F.col("t2") == F.col("r_t2")), "left_semi").select("text")
    # Repeated rows give their set twice; one copy of each is kept.
    sets = stored(texts.mapInArrow(_sets, _spark_schema(_SETS)).groupBy("cls").agg(F.first("s").alias("s")), "nd-sets",
                  held["shingles"] // SET_ROW)
    nth = F.row_number().over(Window.partitionBy("key").orderBy("cls"))
    pivot = left.withColumn("nth", nth).where(F.col("nth") <= PIVOTS).select(F.col("key").alias("pk"), F.col("cls").alias("pc"))
    pairs = (left.join(pivot, (F.col("key") == F.col("pk")) & (F.col("cls") != F.col("pc")))
             .select(F.greatest("cls", "pc").alias("a"), F.least("cls", "pc").alias("b")).distinct())
    labels = components(_verified(pairs, sets, num, den), rows=members * PIVOTS)
    links = stored(_open_links(left, labels, sets, num, den), "nd-links")
    found = links.count()
    if not found:
        return labels
    # What is known so far goes in as stars, so only the new links have to be contracted.
    return components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links),
                      rows=held["n"] + found)


def _open_links(members: DataFrame, labels: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between labels, from all pairs of different labels that share a bucket.

    A bucket's members are dealt by hash into blocks of about ``BLOCK`` shingles;
    a task compares two blocks and returns links that connect the same labels as
    all links do.  Blocks of the label with the most members are not compared
    with each other.
    """
    at = members.join(labels, F.col("cls") == F.col("node"), "left").select(
        "key", "cls", "weight", F.coalesce("root", "cls").alias("label"))
    per_label = at.groupBy("key", "label").agg(F.sum("weight").alias("w"))
    per_key = (per_label.groupBy("key").agg(F.max(F.struct("w", "label")).alias("top"), F.sum("w").alias("w"),
                                            F.count(F.lit(1)).alias("labels"))
               .where("labels > 1")
               .select(F.col("key").alias("k"), F.col("top.label").alias("top"),
                       F.ceil((F.col("w") - F.col("top.w")) / BLOCK).cast("int").alias("n_rest"),
                       F.ceil(F.col("top.w") / BLOCK).cast("int").alias("n_top")))
    at = at.join(per_key, F.col("key") == F.col("k"))
    spot = F.xxhash64("cls")
    is_top = F.col("label") == F.col("top")
    block = F.when(is_top, F.col("n_rest") + F.pmod(spot, F.col("n_top"))).otherwise(F.pmod(spot, F.col("n_rest"))).cast("int")
    others = F.when(is_top, F.col("n_rest")).otherwise(F.col("n_rest") + F.col("n_top"))
    dealt = at.select("key", "cls", "label", block.alias("block"), F.explode(F.sequence(F.lit(0), others - 1)).alias("other"))
    dealt = dealt.select("key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
                         "block", "cls", "label")
    whole = dealt.join(sets.select(F.col("cls").alias("c"), "s"), F.col("cls") == F.col("c")).drop("c", "cls")
    return whole.groupBy("key", "p", "q").applyInArrow(_compare(num, den), _spark_schema(_EDGES))


def _compare(num: int, den: int):
    """Links between the two blocks of one group, or inside its one block."""
    def run(table: pa.Table) -> pa.Table:
        p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
        block = table.column("block").to_numpy()
        label = table.column("label").to_pylist()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("s")]
        one, two = np.flatnonzero(block == p), np.flatnonzero(block == q)
        both = common_counts([sets[i] for i in one], [sets[i] for i in two])
        size = np.array([len(s) for s in sets], np.int64)
        linked = den * both >= num * (size[one][:, None] + size[two][None, :] - both)
        names = {name: i for i, name in enumerate(sorted(set(label)))}
        of = np.array([names[x] for x in label], np.int64)
        i, j = np.nonzero(linked & (of[one][:, None] != of[two][None, :]))
        found = np.unique(np.stack([of[one[i]], of[two[j]]], axis=1), axis=0)
        root, edges = list(range(len(names))), []
        name = list(names)

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for x, y in found.tolist():
            if top(x) != top(y):
                root[top(x)] = top(y)
                edges.append((name[x], name[y]))
        return pa.table([pa.array([e[0] for e in edges], pa.binary()), pa.array([e[1] for e in edges], pa.binary())], schema=_EDGES)
    return run


def common_counts(one: list[np.ndarray], two: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """How many values each set of ``one`` shares with each of ``two``, ``width`` values at a time."""
    sides = []
    for group in (one, two):
        values = np.concatenate([np.zeros(0, np.uint64), *group])
        sides.append((values, np.repeat(np.arange(len(group)), [len(s) for s in group])))
    shared = np.intersect1d(sides[0][0], sides[1][0])
    placed = []
    for values, row in sides:
        at = np.searchsorted(shared, values)
        hit = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == values) if len(shared) else np.zeros(0, np.int64)
        hit = hit[np.argsort(at[hit], kind="stable")]
        placed.append((at[hit], row[hit]))
    out = np.zeros((len(one), len(two)), np.int64)
    for start in range(0, len(shared), width):
        cells = []
        for (at, row), group in zip(placed, (one, two)):
            lo, hi = np.searchsorted(at, [start, start + width])
            m = np.zeros((len(group), min(width, len(shared) - start)), np.float32)
            m[row[lo:hi], at[lo:hi] - start] = 1
            cells.append(m)
        out += (cells[0] @ cells[1].T).astype(np.int64)
    return out


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    one = sets.select(F.col("cls").alias("ca"), F.col("s").alias("sa"))
    two = sets.select(F.col("cls").alias("cb"), F.col("s").alias("sb"))
    both = (pairs.join(one, F.col("a") == F.col("ca")).drop("ca")
            .join(two, F.col("b") == F.col("cb")).select("a", "b", "sa", "sb"))
    return both.mapInArrow(_confirm(num, den), _spark_schema(_EDGES))


def drop_near_duplicates(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component (and of each repeated row) left."""
    names = docs.columns
    linked, n_rows = _linked(docs, num, den)
    found = stored(linked.select("doc_id", "t1", "t2", "first"), "nd-decisions", n_rows)
    keys = [F.col(k).alias(f"p_{k}") for k in ("doc_id", "t1", "t2")]
    dropped = found.where(~F.col("first")).select(*keys).distinct()
    again = (found.where("first").groupBy("doc_id", "t1", "t2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys))
    # The row travels as one struct, so that its names meet no others.
    t1, t2 = text_keys()
    rows = docs.select(F.struct(*names).alias("row"), F.col("doc_id").cast("long").alias("id"), t1, t2)
    same = F.col("id").eqNullSafe(F.col("p_doc_id")) & (F.col("t1") == F.col("p_t1")) & (F.col("t2") == F.col("p_t2"))
    single = rows.join(dropped.unionByName(again), same, "left_anti").select("row.*")
    if again.isEmpty():
        return single
    # Rows of one id and text: one of them is left.
    return single.unionByName(rows.join(again, same, "left_semi").dropDuplicates(["id", "t1", "t2"]).select("row.*"))
