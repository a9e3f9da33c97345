"""Benchmark decontamination by containment search (operator 6, DataFrame functions only).

Finds the short test items whose 5-word shingles a document holds to a share of
at least ``SHARE`` (items below five words are one shingle of their length).

Candidates come from MinHash in its containment form.  An item's sketch is the
shingle with the least hash under each of ``HASHES`` functions; a document that
holds the share t of the item holds each of them with probability t, however
long the document is, where a similarity of whole sets would vanish.  Documents
are partitioned by size (powers of two of their shingle count), and the hits a
candidate needs rise with the size class, as longer documents meet more
shingles by chance; the miss probability stays below 1e-6 in every class.
Candidates are then verified: distinct shingle texts of the item that occur in
the document are counted exactly.

The sketch is broadcast in blocks of at most ``BLOCK`` rows; a larger benchmark
takes several passes, so no document is shuffled for the search.

Defined cases: NULL or empty texts, and items without words, match nothing;
rows that share an id are judged by their own text; repeated item ids count as
one item with the union of their shingles; NULL item ids are ignored; empty
tables give no hit; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .near_dedup import text_keys
from .urls import ascii_lower
from .util import prepare, stored, text_or_empty

WIDTH = 5
SHARE = 0.8
HASHES = 16
BLOCK = 200_000
KEYS = ["doc_id", "t1", "t2"]


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def shingles(held: Column, width: Column | int) -> Column:
    """All runs of ``width`` words (with repeats); empty with fewer words."""
    width = F.lit(width) if isinstance(width, int) else width
    last = F.size(held) - width + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(held, i, width), " "))
    return F.when(last >= 1, runs).otherwise(F.array().cast("array<string>"))


def needed_hits(size_class: Column) -> Column:
    """Sketch hits a candidate needs, by the power of two of its shingle count."""
    return F.lit(1) + (size_class >= 10).cast("int") + (size_class >= 14).cast("int")


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """(item_id, width, sh), distinct: a width below five only for items that short."""
    held = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), words(text_or_empty()).alias("w"))
    width = F.least(F.size("w"), F.lit(WIDTH))
    return (held.where(F.size("w") > 0).select("item_id", width.alias("width"), F.explode(shingles(F.col("w"), width)).alias("sh"))
            .distinct())


def sketch(items: DataFrame, hashes: int = HASHES) -> DataFrame:
    """(item_id, seed, width, sh): the shingle with the least hash under each function."""
    least = items.groupBy("item_id").agg(*(F.min(F.struct(F.xxhash64(F.lit(k), "sh").alias("h"), F.lit(k).alias("seed"),
                                                          "width", "sh")).alias(f"s{k}") for k in range(hashes)))
    return least.select("item_id", F.explode(F.array(*(f"s{k}" for k in range(hashes)))).alias("s")).select("item_id", "s.seed", "s.width", "s.sh")


def _exploded(rows: DataFrame, width: int) -> DataFrame:
    held = rows.select(*KEYS, words(F.col("text")).alias("w"))
    return held.select(*KEYS, F.greatest(F.size("w") - (width - 1), F.lit(0)).alias("n_sh"),
                       F.explode(shingles(F.col("w"), width)).alias("dsh"))


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, hashes: int = HASHES,
                 block: int = BLOCK) -> DataFrame:
    """(doc_id, t1, t2, item_id, containment) for every document and item at ``share`` or more."""
    prepare(docs.sparkSession)
    items = stored(item_shingles(benchmark), "dc-items")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_keys(), text_or_empty().alias("text"))
    # One row per width present: at most five.
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())
    marks = stored(sketch(items, hashes).withColumn("h", F.xxhash64("sh")), "dc-sketch", hashes * items.count())
    blocks = math.ceil(max(1, marks.count()) / block)
    hits = None
    for width in widths:
        for b in range(blocks):
            mine = marks.where((F.col("width") == width) & (F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b))
            seen = _exploded(rows, width).join(F.broadcast(mine.select("item_id", "seed", "h", "sh")),
                                               (F.xxhash64("dsh") == F.col("h")) & (F.col("dsh") == F.col("sh")))
            some = seen.select(*KEYS, "n_sh", "item_id", "seed").distinct()
            hits = some if hits is None else hits.unionByName(some)
    if hits is None:
        return rows.select(*KEYS, F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("containment")).limit(0)
    size_class = F.floor(F.log2(F.greatest(F.max("n_sh"), F.lit(1))))
    candidates = stored(hits.groupBy(*KEYS, "item_id").agg(F.count(F.lit(1)).alias("n"), needed_hits(size_class).alias("need"))
                        .where("n >= need").select(*KEYS, "item_id"), "dc-candidates")
    return _verify(rows, items, candidates, widths, share)


def _verify(rows: DataFrame, items: DataFrame, candidates: DataFrame, widths: list[int], share: float) -> DataFrame:
    """The candidates that hold the share of the item's distinct shingles."""
    asked = candidates.select(*(F.col(k).alias(f"c_{k}") for k in KEYS)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("c_doc_id")) & (F.col("t1") == F.col("c_t1")) & (F.col("t2") == F.col("c_t2"))
    texts = rows.join(asked, same, "left_semi")
    wanted = items.join(candidates.select(F.col("item_id").alias("i")).distinct(), F.col("item_id") == F.col("i"), "left_semi")
    sizes = items.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    found = None
    for width in widths:
        own = wanted.where(F.col("width") == width).select("item_id", "sh")
        each = _exploded(texts, width).select(*KEYS, "dsh").distinct()
        pairs = each.join(own, F.col("dsh") == F.col("sh")).select(*KEYS, "item_id", "sh")
        found = pairs if found is None else found.unionByName(pairs)
    counts = found.groupBy(*KEYS, "item_id").agg(F.count(F.lit(1)).alias("n")).join(sizes, "item_id")
    full = counts.withColumn("containment", F.col("n") / F.col("n_item")).where(F.col("containment") >= share)
    both = [F.col(f"f.{k}").eqNullSafe(F.col(f"c.{k}")) for k in (*KEYS, "item_id")]
    return full.alias("f").join(candidates.alias("c"), both, "left_semi").select(*KEYS, "item_id", "containment")


def flag_documents(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """Per row: doc_id, n_items, items (ids in order, comma-joined), max_containment, contaminated."""
    pairs = contaminated(docs, benchmark, share)
    per = pairs.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("ids"),
                                   F.max("containment").alias("max_containment"))
    per = per.select(*(F.col(k).alias(f"p_{k}") for k in KEYS), "n_items", "ids", "max_containment")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_keys())
    same = F.col("doc_id").eqNullSafe(F.col("p_doc_id")) & (F.col("t1") == F.col("p_t1")) & (F.col("t2") == F.col("p_t2"))
    return rows.join(per, same, "left").select(
        "doc_id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.col("ids").cast("array<string>"), ","), F.lit("")).alias("items"),
        F.coalesce("max_containment", F.lit(0.0)).alias("max_containment"), F.col("n_items").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    found = contaminated(docs, benchmark, share).select(*(F.col(k).alias(f"p_{k}") for k in KEYS)).distinct()
    # The row travels as one struct, so that its names meet no others.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), *text_keys())
    same = F.col("id").eqNullSafe(F.col("p_doc_id")) & (F.col("t1") == F.col("p_t1")) & (F.col("t2") == F.col("p_t2"))
    return rows.join(found, same, "left_anti").select("row.*")
