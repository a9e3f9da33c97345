"""Threshold-scaled document fingerprints (operator 10).

A fingerprint keeps every shingle hash of a text below a fixed fraction of the
hash range.  Because the threshold is the same for every text, the kept hashes
of a union are the union of the kept hashes: fingerprints merge, and the share
of one text's hashes found in another estimates containment however unequal
the two are.  Written form: ``<set size>:<digest of the full set>:<kept hashes,
sorted, 12 hex digits each>``; the digest makes equality exact for texts too
short to have a kept hash.

``next_edits`` compares each document with an edited copy that borrows the
next document's beginning.  One range shuffle by doc_id puts neighbours next
to each other; only the first and last document of each partition wait for a
second, small step over the stored result.

Defined cases: NULL reads as the empty text, whose fingerprint has no hash;
two texts without any kept hash are alike (1.0) if their sets are equal, else
0.0; rows that share an id follow each other in an order that their texts fix; NULL ids
come after all others; one document is its own next document; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shingles import set_digest, shingle_set
from .util import batch, prepare, stored, text_or_empty

#: One hash in ``SCALE`` is kept; a power of two up to 2**16.
SCALE = 8


def kept(hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The hashes below the fixed fraction 1/scale of the range (still sorted)."""
    return hashes[: np.searchsorted(hashes, np.uint64((1 << 64) // scale))]


def fingerprint(text: str, scale: int = SCALE) -> tuple[str, np.ndarray]:
    """The written fingerprint of a text, and its kept hashes (48 bits each)."""
    s = shingle_set(text)
    low = np.unique(kept(s, scale) >> np.uint64(16 - (scale.bit_length() - 1)))
    digits = low.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()
    return f"{len(s)}:{set_digest(s).hex()}:{digits}", low


def parse(written: str) -> tuple[int, str, np.ndarray]:
    """Set size, digest and kept hashes of a written fingerprint."""
    size, digest, digits = written.split(":")
    raw = np.frombuffer(bytes.fromhex(digits), np.uint8).reshape(-1, 6).astype(np.uint64)
    weights = np.array([1 << (40 - 8 * k) for k in range(6)], np.uint64)
    return int(size), digest, (raw * weights).sum(axis=1, dtype=np.uint64)


def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The kept hashes of the union of two texts' sets."""
    return np.union1d(one, other)


def containment(inner: np.ndarray, outer: np.ndarray) -> float:
    """The estimated share of the inner set that the outer one holds (0.0 for no kept hash)."""
    return len(np.intersect1d(inner, outer, assume_unique=True)) / len(inner) if len(inner) else 0.0


def likeness(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> float:
    """The estimated similarity (intersection by union) of two fingerprints."""
    if a[0] == b[0]:
        return 1.0
    both = len(np.intersect1d(a[1], b[1], assume_unique=True))
    union = len(a[1]) + len(b[1]) - both
    return both / union if union else 0.0


def fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """doc_id and fingerprint of every row (no shuffle)."""
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            yield batch(schema, rb.column(0), [fingerprint(t, scale)[0] for t in rb.column(1).to_pylist()])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


_RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
           ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
           ("near_edited", pa.float64()), ("near_next", pa.float64())]
#: Stored rows hold both fingerprints in one column: what they share stands close together and takes little space.
#: ``part`` is set on the rows that wait for a neighbour; ``head`` marks the first row of a partition.
_WAITING = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("both", pa.string()),
                      ("near_edited", pa.float64()), ("near_next", pa.float64()),
                      ("part", pa.int64()), ("head", pa.bool_()), ("text", pa.string())])
_BLANK = (None,) * 5
_SPARK = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double", pa.bool_(): "boolean"}


def _ddl(fields) -> str:
    return ", ".join(f"{name} {_SPARK[kind]}" for name, kind in fields)


def _compared(doc: int | None, text: str, own: tuple, following: str, after: tuple, scale: int) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    changed = fingerprint(edited, scale)
    return (doc, len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest(), own[0], changed[0],
            likeness(own, changed), likeness(own, after))


def _neighbours(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None
        for rb in batches:
            out = []
            for doc, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                own = fingerprint(text, scale)
                if last is None:
                    out.append((None, *_BLANK, part, True, text))
                else:
                    d, n, sha, one, other, *near = _compared(*last, text, own, scale)
                    out.append((d, n, sha, f"{one}|{other}", *near, None, None, None))
                last = (doc, text, own)
            yield batch(_WAITING, *map(list, zip(*out))) if out else batch(_WAITING, *([] for _ in _WAITING))
        if last is not None:
            yield batch(_WAITING, *([v] for v in (last[0], *_BLANK, part, False, last[1])))
    return run


def _finish(scale: int):
    schema = pa.schema(_RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            out = [_compared(doc, text, fingerprint(text, scale), following, fingerprint(following, scale), scale)
                   for doc, text, following in zip(*(rb.column(k).to_pylist() for k in range(3)))]
            yield batch(schema, *(map(list, zip(*out)) if out else ([] for _ in schema)))
    return run


def next_edits(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprints of each text and of the text whose second half comes from the next document.

    The next document is the one with the next lower doc_id; the lowest is
    followed by the highest.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # The text's hash splits an id that many rows share over several ranges.
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order, "text")
    done = stored(dealt.mapInArrow(_neighbours(scale), _ddl([(f.name, f.type) for f in _WAITING])), "fp-neighbours")
    one, other = (F.split("both", r"\|", -1)[k].alias(c) for k, c in enumerate(("fingerprint", "edited_fingerprint")))
    ends = done.where(F.col("part").isNotNull())
    # One row per partition: which partition with rows follows it, the first one after the last.
    parts = ends.where("head").select(F.col("part").alias("p"))
    turn = Window.orderBy("p")
    follows = parts.select("p", F.lead("p").over(turn).alias("q"), F.min("p").over(Window.partitionBy()).alias("least"))
    follows = follows.select("p", F.coalesce("q", "least").alias("q"))
    heads = ends.where("head").select(F.col("part").alias("hp"), F.col("text").alias("following"))
    waiting = (ends.where(~F.col("head")).select("doc_id", "text", "part")
               .join(follows, F.col("part") == F.col("p")).join(heads, F.col("q") == F.col("hp"))
               .select("doc_id", "text", "following"))
    return done.where(F.col("part").isNull()).select(
        "doc_id", "n_chars", "edited_sha256", one, other, "near_edited", "near_next").unionByName(
        waiting.mapInArrow(_finish(scale), _ddl(_RESULT)))
