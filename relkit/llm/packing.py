"""Best-fit packing by minimum bin slack (operator 9).

Documents are token ids plus a closing id; one longer than a sequence is cut
into full pieces from its end, so only its first piece may be shorter.  Full
pieces are sequences of their own.  For all others, minimum bin slack works on
the histogram of piece lengths: per bin, a subset-sum dynamic program over the
available lengths (a bitset of reachable sums, one shift per length) finds the
fullest feasible combination, seeded with the longest piece left.  The same
combination stays the fullest until one of its lengths runs out, so it is
taken as often as the counts allow at once.  The plan therefore needs at most
a few steps per distinct length however many pieces there are; the histogram
and the plan (bounded by the sequence length) are all the driver sees.

Pieces find their place by joins: the pieces of one length are numbered by
counting per (length, salt) and within it, so one frequent length is spread
over many tasks, and the number picks the plan's step, repetition and offset.

With ``by``, a column of the documents, a sequence holds pieces of one value of it
only: the histogram, the plan and the numbering are then each value's own, so what
the driver sees is bounded by the sequence length times the number of values.

Defined cases: NULL or empty text is one piece that holds the closing id only;
a NULL in ``by`` is a value of its own;
repeated rows are packed as often as they stand there; NULL ids pass through;
an empty table packs nothing; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .encoders import load
from .token_counts import spliced_ids
from .util import batch, prepare, stored, text_or_empty

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64())])
_SEGMENT = pa.schema([*((c, pa.int64()) for c in ("length", "first", "upto", "uses", "base", "at")), ("value", pa.string())])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: only the first may be short."""
    first = n % capacity or capacity
    at = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(at, [*at[1:], n])]


def _pieces(tokenizer: str, capacity: int, closing: int, by: str | None = None):
    schema = _PIECES.append(pa.field(by, pa.string())) if by else _PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer)
        for rb in batches:
            rows: list[list] = [[] for _ in schema]
            for doc, text, *own in zip(*(c.to_pylist() for c in rb.columns)):
                ids = np.concatenate([*spliced_ids(encoder, text), [closing]]).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    for column, value in zip(rows, (doc, k, start, length, crc, *own)):
                        column.append(value)
            yield batch(schema, *rows)
    return run


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """The lengths (with repeats) whose sum is as near to ``room`` as the counts allow.

    ``reach`` is a bitset of reachable sums; longer lengths are offered first,
    and the program stops as soon as the room can be filled.
    """
    goal, reach = 1 << room, 1
    mask = (goal << 1) - 1
    steps: list[tuple[int, int]] = []
    for length in sorted(counts, reverse=True):
        for _ in range(min(counts[length], room // length)):
            grown = (reach | reach << length) & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
            if reach & goal:
                break
        if reach & goal:
            break
    total = reach.bit_length() - 1
    taken = []
    for length, before in reversed(steps):
        if not before >> total & 1:
            taken.append(length)
            total -= length
    return taken


def minimum_slack_plan(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(combination, how often) that packs all pieces counted in ``histogram``."""
    left = {k: v for k, v in histogram.items() if v > 0}
    plan = []
    while left:
        seed = max(left)
        rest = {k: v - (k == seed) for k, v in left.items() if v > (k == seed) and k <= capacity - seed}
        lengths = [seed, *fullest(rest, capacity - seed)]
        uses = {k: lengths.count(k) for k in lengths}
        times = min(left[k] // n for k, n in uses.items())
        plan.append((lengths, times))
        for k, n in uses.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def _segments(plan: list[tuple[list[int], int]], base: int = 0) -> list[tuple]:
    """Per step and length: which numbers of that length it takes, and where they go, in sequences from ``base`` on."""
    out, used = [], {}
    for lengths, times in plan:
        at = 0
        for length in dict.fromkeys(lengths):
            uses = lengths.count(length)
            first = used.get(length, 0)
            used[length] = first + uses * times
            out.append((length, first, used[length], uses, base, at))
            at += uses * length
        base += times
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, closing: int = 0, by: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset for every piece of every row.

    With ``by`` that column follows, as a string, and no sequence holds two values of it.
    """
    spark = docs.sparkSession
    prepare(spark)
    own = [F.col(by).cast("string").alias(by)] if by else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *own)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (f", `{by}` string" if by else "")
    pieces = stored(rows.mapInArrow(_pieces(tokenizer, capacity, closing, by), schema), "pack-pieces")
    placed = place(pieces, capacity, by=by)
    return placed.select(*[c for c in placed.columns if c != by], by) if by else placed


def place(pieces: DataFrame, capacity: int, rows_per_salt: int = 20_000, by: str | None = None) -> DataFrame:
    """Give each piece (any columns beside ``length``) its sequence_id and offset."""
    spark = pieces.sparkSession
    own = [by] if by else []
    counts = pieces.groupBy(*own, "length").agg(F.count(F.lit(1)).alias("n"))
    # At most `capacity` rows for each value of `by`: one per length.
    histograms: dict[str | None, dict[int, int]] = {}
    for r in counts.collect():
        histograms.setdefault(r[by] if by else None, {})[r["length"]] = r["n"]
    salts = max(1, -(-sum(sum(h.values()) for h in histograms.values()) // rows_per_salt))
    segments, base = [], 0
    for value in sorted(histograms, key=lambda v: (v is not None, v)):
        plan = minimum_slack_plan(histograms[value], capacity)
        segments += [(*segment, value) for segment in _segments(plan, base)]
        base += sum(times for _, times in plan)
    names = pieces.columns
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*names), F.lit(salts)).cast("int"))
    sizes = salted.groupBy(*own, "length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    # One row per (value of `by`, length, salt): the running count of one length's salts.
    before = Window.partitionBy(*own, "length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*[F.col(c).alias("_fg") for c in own], F.col("length").alias("_l"), F.col("_salt").alias("_s"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    of_value = lambda c: F.col(by).eqNullSafe(F.col(c)) if by else F.lit(True)
    nth = F.row_number().over(Window.partitionBy(*own, "length", "_salt").orderBy(*names)) - 1
    numbered = (salted.withColumn("_nth", nth)
                .join(firsts, (F.col("length") == F.col("_l")) & (F.col("_salt") == F.col("_s")) & of_value("_fg"))
                .withColumn("_rank", F.col("_first") + F.col("_nth")))
    # As an Arrow table: from rows, Spark would start a second set of Python workers on every executor.
    steps = spark.createDataFrame(pa.Table.from_pylist([dict(zip(_SEGMENT.names, s)) for s in segments], _SEGMENT))
    by_length = steps.groupBy(F.col("value").alias("_pg"), F.col("length").alias("_pl")).agg(
        F.collect_list(F.struct("first", "upto", "uses", "base", "at")).alias("_steps"))
    step = F.filter("_steps", lambda s: (s["first"] <= F.col("_rank")) & (F.col("_rank") < s["upto"]))[0]
    # The plan has at most a few rows per length (and value): it is small at any input size.
    placed = numbered.join(F.broadcast(by_length), (F.col("length") == F.col("_pl")) & of_value("_pg")).withColumn("_step", step)
    rel = F.col("_rank") - F.col("_step.first")
    return placed.select(
        *names, (F.col("_step.base") + F.floor(rel / F.col("_step.uses"))).cast("long").alias("sequence_id"),
        (F.col("_step.at") + F.pmod(rel, F.col("_step.uses")) * F.col("length")).cast("long").alias("offset"))
