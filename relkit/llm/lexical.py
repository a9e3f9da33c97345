"""Ranked lexical search by presence masks (operator 13).

Every item of a query set is searched in all documents.  One pass cuts the
texts into terms and stores, per document, its length and the counts of those
terms that an item may hold (a bitmap of fixed size, filled from the items'
terms, decides; the exact weights drop what it lets through).  Document
frequencies are counted from that table, and the items' terms get weights.

The search is a second pass over the stored counts, for a block of items of
bounded size at a time.  A task takes its documents in blocks.  For an item, a
presence mask (one bit per distinct term) is or-ed together per document from
the terms' postings, and documents with equal masks form a group.  A mask's
maximum score is the sum of its terms' highest contributions in the block.
The distinct masks are evaluated by descending maximum, until the item's
k-th score so far is above the next maximum; the scores so far carry on
from block to block.  Tasks give at most k rows per item, and the best k of
these are the result.

Defined cases: NULL and empty texts have no terms, and such an item no rows;
every row of the items is an item of its own, also where ids repeat; documents that share an id are documents of
their own; among equal scores NULL doc_ids come last; no document or no item
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .util import batch, prepare, stored, text_or_empty

#: Bits of the filter of the items' terms (1 MB at any number of items).
FILTER_BITS = 1 << 23
#: Bytes of item terms that one search pass carries to the tasks.
ITEM_BYTES = 16 << 20
#: Documents and stored counts that a task looks at together.
BLOCK_DOCS = 1 << 14
BLOCK_COUNTS = 1 << 22
_SLICE = 1 << 20

_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def term_counts(data: bytes) -> Counter:
    """The terms of a UTF-8 text: runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    if len(data) <= _SLICE:
        return Counter(data.translate(_TERM).split())
    found: Counter = Counter()
    data = data.translate(_TERM)
    at = 0
    while at < len(data):
        # A slice ends where a term ends.
        upto = data.find(b" ", at + _SLICE)
        upto = len(data) if upto < 0 else upto
        found.update(data[at:upto].split())
        at = upto
    return found


def _bit(term: Column) -> Column:
    return F.pmod(F.crc32(term.cast("binary")), F.lit(FILTER_BITS)) + 1


def term_filter(terms: DataFrame) -> np.ndarray:
    """One byte per bit of the filter; ``terms`` has a column ``term``."""
    bits = (terms.select(_bit(F.col("term")).alias("b"))
            .groupBy(F.expr("bitmap_bucket_number(b)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(b))").alias("bits")))
    out = np.zeros(FILTER_BITS, bool)
    # At most FILTER_BITS / 32768 rows of 4 KB.
    for r in bits.collect():
        own = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        at = (r["bucket"] - 1) * len(own)
        out[at:at + len(own)] = own[: len(out) - at]
    return out


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.string())), ("tfs", pa.list_(pa.int32()))])


def _count(bits: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, str | None] = {}

        def listed(term: bytes) -> str | None:
            if len(known) > 1 << 18:
                known.clear()
            known[term] = word = term.decode() if bits[zlib.crc32(term) & (FILTER_BITS - 1)] else None
            return word

        for rb in batches:
            ns, terms, tfs = [], [], []
            for data in rb.column(1).to_pylist():
                counts = term_counts(data)
                own = [(known[t] if t in known else listed(t), c) for t, c in counts.items()]
                ns.append(sum(counts.values()))
                terms.append([w for w, _ in own if w is not None])
                tfs.append([c for w, c in own if w is not None])
            yield batch(_COUNTS, rb.column(0), ns, terms, tfs)
    return run


def _terms(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1), lambda t: t != "")


def weighted_items(items: DataFrame, counts: DataFrame, n_docs: int) -> DataFrame:
    """Per item (no, item_id) its distinct terms that some document holds, with repeats and weights."""
    df = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    used = items.select("no", "item_id", F.explode("terms").alias("term")).groupBy("no", "item_id", "term").agg(
        F.count(F.lit(1)).alias("uses"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2.0 * F.col("df") + 1)))
    return (used.join(df, "term").select("no", "item_id", "term", "uses", weight.cast("long").alias("w"))
            .groupBy("no", "item_id").agg(F.collect_list(F.struct("term", "uses", "w")).alias("terms")))


class _Best:
    """The k best documents of one item so far: high scores first, then small ids, NULL ids last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.doc, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, bool))

    def least(self) -> int:
        """A score below this one is of no use."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        self.score, self.doc, self.null = (np.concatenate(x) for x in (
            (self.score, score), (self.doc, doc), (self.null, null)))
        keep = np.lexsort((self.doc, self.null, -self.score))[: self.k]
        self.score, self.doc, self.null = self.score[keep], self.doc[keep], self.null[keep]


class _Block:
    """The postings of a block of documents, by term of the item block."""

    def __init__(self, parts: list[pa.RecordBatch], words: pa.Array, total_docs: int, total_terms: int) -> None:
        rows = pa.Table.from_batches(parts).combine_chunks()
        ids = rows["doc_id"].combine_chunks()
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
        terms = rows["terms"].combine_chunks()
        n = rows["n"].to_numpy()
        m = 25 + (75 * n * total_docs) // total_terms
        doc = np.repeat(np.arange(len(n)), terms.value_lengths().to_numpy())
        tf = rows["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
        term = pc.index_in(terms.flatten(), words).fill_null(-1).to_numpy(zero_copy_only=False)
        held = np.flatnonzero(term >= 0)
        held = held[np.argsort(term[held], kind="stable")]
        self._term, self.at, tf = term[held], doc[held], tf[held]
        #: What one use of the term with weight 1 gives the document.
        self.part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.at])
        self._ends = np.searchsorted(self._term, np.arange(len(words) + 1))

    def search(self, terms: np.ndarray, factor: np.ndarray, best: _Best) -> None:
        """Bring the documents of one item (term numbers, weight times uses) into ``best``."""
        spans = [slice(self._ends[t], self._ends[t + 1]) for t in terms]
        present = [(s, f) for s, f in zip(spans, factor.tolist()) if s.stop > s.start and f]
        highest = np.array([int(self.part[s].max()) * f for s, f in present], np.int64)
        if not present or highest.sum() < best.least():
            return
        # Bitmaps: bit b of a document's mask says that it holds the b-th of these terms.
        masks = np.zeros((len(self.doc), -(-len(present) // 64)), np.uint64)
        for b, (s, _) in enumerate(present):
            masks[self.at[s], b // 64] |= np.uint64(1 << (b % 64))
        docs = np.flatnonzero(masks.any(axis=1))
        masks = masks[docs]
        if masks.shape[1] == 1:
            distinct, group = np.unique(masks[:, 0], return_inverse=True)
            distinct = distinct[:, None]
        else:
            distinct, group = np.unique(masks, axis=0, return_inverse=True)
            group = group.reshape(-1)
        bits = np.unpackbits(np.ascontiguousarray(distinct.astype("<u8")).view(np.uint8), axis=1, bitorder="little")
        maximum = bits[:, : len(present)].astype(np.int64) @ highest
        members = docs[np.argsort(group, kind="stable")]
        starts = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=len(distinct)))])
        order = np.argsort(-maximum, kind="stable")
        chosen = np.zeros(len(self.doc), bool)
        done, wave = 0, 4 * best.k
        while done < len(order) and maximum[order[done]] >= best.least():
            # The next masks, for about twice as many documents each time.
            size = np.cumsum(starts[order[done:] + 1] - starts[order[done:]])
            upto = done + int(np.searchsorted(size, wave)) + 1
            take = [g for g in order[done:upto] if maximum[g] >= best.least()]
            own = np.concatenate([members[starts[g]:starts[g + 1]] for g in take])
            chosen[own] = True
            score = np.zeros(len(self.doc), np.int64)
            for s, f in present:
                hit = chosen[self.at[s]]
                score[self.at[s][hit]] += f * self.part[s][hit]
            chosen[own] = False
            own = own[score[own] >= max(1, best.least())]
            best.add(score[own], self.doc[own], self.null[own])
            done, wave = upto, 2 * wave


_HITS = pa.schema([("no", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search(items: list[tuple], total_docs: int, total_terms: int, k: int, block_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        wanted = []
        for no, item_id, terms in items:
            at = np.array([number.setdefault(t, len(number)) for t, _, _ in terms])
            wanted.append((at, np.array([uses * w for _, uses, w in terms], np.int64), _Best(k)))
        words = pa.array(list(number), pa.string())

        def search(parts: list[pa.RecordBatch]) -> None:
            block = _Block(parts, words, total_docs, total_terms)
            for at, factor, best in wanted:
                block.search(at, factor, best)

        parts: list[pa.RecordBatch] = []
        for rb in batches:
            parts.append(rb)
            if sum(p.num_rows for p in parts) >= block_docs or sum(len(p.column(2).flatten()) for p in parts) >= BLOCK_COUNTS:
                search(parts)
                parts = []
        if parts:
            search(parts)
        for (no, item_id, _), (_, _, best) in zip(items, wanted):
            if len(best.score):
                ids = [None if null else d for d, null in zip(best.doc.tolist(), best.null.tolist())]
                size = len(ids)
                yield batch(_HITS, [no] * size, [item_id] * size, ids, best.score)
    return run


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple]]:
    """The items in lists of at most ``most`` bytes of terms (one item at least)."""
    own, size = [], 0
    for r in items.toLocalIterator():
        row = (r["no"], r["item_id"], [(t["term"], t["uses"], t["w"]) for t in r["terms"]])
        bytes_ = sum(32 + len(t) for t, _, _ in row[2])
        if own and size + bytes_ > most:
            yield own
            own, size = [], 0
        own.append(row)
        size += bytes_
    if own:
        yield own


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, item_bytes: int = ITEM_BYTES,
                  block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item."""
    spark = docs.sparkSession
    prepare(spark)
    asked = stored(items.select(F.monotonically_increasing_id().alias("no"), F.col("item_id").cast("long").alias("item_id"),
                                _terms(text_or_empty()).alias("terms")), "lexical-items")
    bits = term_filter(asked.select(F.explode("terms").alias("term"))).tobytes()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    counts = stored(rows.mapInArrow(_count(bits), "doc_id long, n long, terms array<string>, tfs array<int>"), "lexical-counts")
    total = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    hits = spark.createDataFrame([], "no long, item_id long, doc_id long, score long")
    if total["docs"]:
        weighted = stored(weighted_items(asked, counts, total["docs"]), "lexical-weights")
        holding = counts.where(F.size("terms") > 0)
        for block in _blocks(weighted, item_bytes):
            # A pass ends written, so that passes do not pile up in one plan.
            found = holding.mapInArrow(_search(block, total["docs"], total["terms"], k, block_docs),
                                       "no long, item_id long, doc_id long, score long")
            hits = hits.unionByName(stored(found, "lexical-hits"))
    best = Window.partitionBy("no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


#: DuckDB SQL for ``ranked_search`` of ``benchmark`` in ``documents``.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, docs),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
uses AS (SELECT item_id, term, count(*) AS uses FROM asked GROUP BY item_id, term),
scores AS (
  SELECT u.item_id, c.doc_id,
         CAST(sum(u.uses * x.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (25 + (75 * l.n * t.docs) // t.terms)))) AS BIGINT) AS score
  FROM uses u JOIN weights x USING (term) JOIN counts c USING (term) JOIN lengths l ON l.doc_id = c.doc_id, totals t
  GROUP BY u.item_id, c.doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
