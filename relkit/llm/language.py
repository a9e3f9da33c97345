"""Language identification by prediction by partial matching (operator 7).

Each language has a byte context tree of order 3: for every context of 3, 2, 1
and 0 bytes the counts of the byte that follows.  A byte that a context has
seen costs -log2(count / (total + kinds)) bits; one it has not costs the
escape, -log2(kinds / (total + kinds)), plus its cost in the next shorter
context, down to 8 bits in none at all.  Statistics are frozen after learning,
so every 4-byte string has one exact cost per language; those seen in learning
are tabulated with their escapes resolved and all others follow the escapes.
The language with the shortest code wins; the score is its probability among
the languages when each code length is read as -log2 of a likelihood.

Learning takes a bounded sample, about ``SAMPLE_DOCS`` whole documents per
language chosen by a hash of doc_id and text, and counts their 4-byte strings on the
executors.  Every count is kept, and each language has a table of its own, so
no language depends on how many others there are; the sample bounds the model
that is broadcast.  Prediction reads whole texts.

Defined cases: NULL or empty text, or text without a letter, is ``und`` with
score 0.0, and so is every text when nothing was learned; rows with a NULL
lang or NULL doc_id teach nothing; a NULL doc_id is not held out; ties go to
the language first in order of name; repeated rows are rows of their own;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded
from .util import batch, prepare, text_or_empty

ORDER = 3
SAMPLE_DOCS = 2000
_PAD = b"\n" * ORDER
#: Bytes scored or counted at a time.
_BLOCK = 1 << 20


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo ``folds``; false for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(4-byte strings, number of the text each one's last byte belongs to), some megabytes at a time."""
    held, owners, size = [], [], 0
    for k, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        for at in range(0, len(data), _BLOCK):
            piece = (_PAD + data[:_BLOCK]) if at == 0 else data[at - ORDER:at + _BLOCK]
            held.append(np.frombuffer(piece, np.uint8))
            owners.append(k)
            size += len(piece)
            if size >= _BLOCK:
                yield _grams(held, owners)
                held, owners, size = [], [], 0
    if held:
        yield _grams(held, owners)


def _grams(pieces: list[np.ndarray], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    data = np.concatenate(pieces).astype(np.uint32)
    grams = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    lengths = np.array([len(p) for p in pieces])
    # A string that ends in the first bytes of the next piece belongs to none.
    own = np.ones(len(grams), bool)
    for edge in np.cumsum(lengths)[:-1]:
        own[edge - ORDER:edge] = False
    return grams[own], np.repeat(np.array(owners), lengths - ORDER)


_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in batches:
        langs, texts = rb.column(0).to_pylist(), rb.column(1).to_pylist()
        for lang in sorted(set(langs)):
            for grams, _ in _blocks([t for t, own in zip(texts, langs) if own == lang]):
                seen, n = np.unique(grams, return_counts=True)
                yield batch(_COUNTS, [lang] * len(seen), seen.astype(np.int64), n.astype(np.int64))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each wanted value among sorted distinct keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    places = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return places, keys[places] == wanted


@dataclass
class Tree:
    """Frozen code lengths in bits of one language."""

    grams: list[np.ndarray]     # seen strings of 3 and of 4 bytes
    cost: list[np.ndarray]      # code length of the last byte, per seen string
    contexts: np.ndarray        # seen contexts of 3 bytes
    escape3: np.ndarray         # escape per seen context
    contexts2: np.ndarray       # seen contexts of 2 bytes
    escape2: np.ndarray         # escape per seen context
    pairs: np.ndarray           # seen strings of 2 bytes
    cost1: np.ndarray           # code length of the last byte, per seen string
    escape1: np.ndarray         # escape per byte
    cost0: np.ndarray           # code length per byte

    def short(self, grams: np.ndarray) -> np.ndarray:
        """Bits of each 3-byte string's last byte where the string itself is new."""
        place, known = _find(self.contexts2, grams >> np.uint32(8))
        out = np.zeros(len(grams), np.float32)
        out[known] = self.escape2[place[known]]
        pairs = grams & np.uint32(0xFFFF)
        lower = (self.escape1[pairs >> np.uint32(8)] + self.cost0[pairs & np.uint32(0xFF)]).astype(np.float32)
        place, known = _find(self.pairs, pairs)
        lower[known] = self.cost1[place[known]]
        return out + lower

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """Bits of each string's last byte after its first three."""
        place, known = _find(self.grams[1], grams)
        out = np.zeros(len(grams), np.float32)
        out[known] = self.cost[1][place[known]]
        new = grams[~known]
        if len(new):
            short = new & np.uint32(0xFFFFFF)
            lower = self.short(short)
            place, there = _find(self.grams[0], short)
            lower[there] = self.cost[0][place[there]]
            place, there = _find(self.contexts, new >> np.uint32(8))
            lower[there] += self.escape3[place[there]]
            out[~known] = lower
        return out


@dataclass
class Model:
    """A tree per language; its size is the sum of theirs."""

    langs: list[str]
    trees: list[Tree]

    def bits(self, texts: list[str]) -> np.ndarray:
        """The code length of each text in each language."""
        total = np.zeros((len(texts), len(self.langs)))
        for grams, owner in _blocks(texts):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            distinct, at = np.unique(grams, return_inverse=True)
            for k, tree in enumerate(self.trees):
                np.add.at(total[:, k], owner[first], np.add.reduceat(tree.costs(distinct)[at], first, dtype=np.float64))
        return total


def _level(strings: np.ndarray, counts: np.ndarray, shorter: np.ndarray | float) -> tuple:
    """Code lengths of strings under their context, its strings and their escapes.

    ``shorter``: each string's code length in the next shorter context.
    """
    contexts, at = np.unique(strings >> np.uint32(8), return_inverse=True)
    total = np.bincount(at, counts, len(contexts))
    kinds = np.bincount(at, counts > 0, len(contexts))
    with np.errstate(divide="ignore", invalid="ignore"):
        escape = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0.0)
        seen = -np.log2(counts / (total + kinds)[at])
    return contexts, escape, np.where(counts > 0, seen, escape[at] + shorter)


def _tree(grams: np.ndarray, n: np.ndarray) -> Tree:
    def merged(strings: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, where = np.unique(strings, return_inverse=True)
        return out, np.bincount(where, counts, len(out))

    g4, c4 = merged(grams.astype(np.uint32), n)
    g3, c3 = merged(g4 & np.uint32(0xFFFFFF), c4)
    g2, c2 = merged(g3 & np.uint32(0xFFFF), c3)
    every, pairs = np.arange(256, dtype=np.uint32), np.arange(1 << 16, dtype=np.uint32)
    full2 = np.zeros(1 << 16)
    full2[g2] = c2
    _, _, cost0 = _level(every, np.bincount(g2 & np.uint32(0xFF), c2, 256), 8.0)
    _, escape1, cost1 = _level(pairs, full2, cost0[pairs & np.uint32(0xFF)])
    x2, e2, cost2 = _level(g3, c3, cost1[g3 & np.uint32(0xFFFF)])
    x3, e3, cost3 = _level(g4, c4, cost2[np.searchsorted(g3, g4 & np.uint32(0xFFFFFF))])
    f = np.float32
    return Tree([g3, g4], [cost2.astype(f), cost3.astype(f)], x3, e3.astype(f), x2, e2.astype(f), g2, cost1[g2].astype(f),
                escape1, cost0)


def build(langs: list[str], grams: np.ndarray, lang_of: np.ndarray, n: np.ndarray) -> Model:
    """The frozen model from (4-byte string, language, count) triples."""
    order = np.argsort(lang_of, kind="stable")
    ends = np.searchsorted(lang_of[order], np.arange(len(langs) + 1))
    own = [order[a:b] for a, b in zip(ends, ends[1:])]
    return Model(langs, [_tree(grams[k], n[k]) for k in own])


def learn(docs: DataFrame, folds: int = 5, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Fit on a bounded hash sample of the rows that are not held out; None without any."""
    prepare(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                      F.col("text").cast("string").alias("text"))
    own = own.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), folds)
                    & F.col("text").isNotNull())
    slots = 1 << 30
    # One row of two numbers per language: its share of the hash range.  Texts are not shuffled for it, unless there
    # are more languages than a table of 16 MB holds.
    own = own.withColumn("h", F.xxhash64("lang"))
    sizes = own.groupBy(F.col("h").alias("l")).agg(F.count(F.lit(1)).alias("n")).select(
        "l", F.least(F.lit(slots), F.floor(F.lit(slots * sample_docs) / F.col("n"))).cast("long").alias("share"))
    spot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots))
    sample = own.join(broadcast_if_bounded(sizes, 1_000_000), F.col("h") == F.col("l")).where(spot < F.col("share"))
    counts = (sample.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    table = counts.toArrow()
    if table.num_rows == 0:
        return None
    named = table.column("lang").combine_chunks().dictionary_encode()
    langs = sorted(named.dictionary.to_pylist())
    place = {lang: k for k, lang in enumerate(langs)}
    lang_of = np.array([place[v] for v in named.dictionary.to_pylist()])[named.indices.to_numpy()]
    return build(langs, table.column("gram").to_numpy(), lang_of, table.column("n").to_numpy())


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                     ("score", pa.float64())])


def identify(docs: DataFrame, model: Model | None, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs`` (text only decides)."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rb in batches:
            texts = [t if ok else "" for t, ok in zip(rb.column(2).to_pylist(), rb.column(3).to_pylist())]
            if m is None:
                pred, score = ["und"] * len(texts), [0.0] * len(texts)
            else:
                bits = m.bits(texts)
                best = bits.argmin(axis=1) if len(texts) else []
                chance = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1) if len(texts) else []
                pred = [m.langs[b] if t else "und" for b, t in zip(best, texts)]
                score = [float(c) if t else 0.0 for c, t in zip(chance, texts)]
            yield batch(_SCHEMA, rb.column(0), rb.column(1), pred, score)

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), folds).alias("held_out"),
                       text.alias("text"), text.rlike(r"\p{L}").alias("letters"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model | None, least_score: float = 0.0) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or scored below ``least_score``.

    ``lang`` (where the input has it) becomes the identified language; all
    other columns stay as they are.
    """
    spark = docs.sparkSession
    prepare(spark)
    names = docs.columns
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rb in batches:
            letters = rb.column(len(names)).to_pylist()
            texts = [t if ok else "" for t, ok in zip(rb.column(names.index("text")).to_pylist(), letters)]
            if m is None or not texts:
                continue
            bits = m.bits(texts)
            chance = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
            keep = np.array([bool(t) for t in texts]) & (chance >= least_score)
            langs = pa.array([m.langs[b] for b in bits.argmin(axis=1)], pa.string())
            columns = [langs.cast(rb.schema.field(k).type) if c == "lang" else rb.column(k) for k, c in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    # The last column, read by its place: its name may be that of another one.
    letters = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)).alias(max(names, key=len) + "_letters")
    return docs.select(*names, letters).mapInArrow(run, docs.schema)
