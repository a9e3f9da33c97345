"""Byte-level BPE encoding and decoding by overlapping chunks (operator 11).

A rank file is run by ``tiktoken``; each match of the pattern (a pre-token) is
encoded by itself.  A text longer than ``chunk`` code points is cut into
chunks that reach ``overlap`` beyond the next one's start.  Every chunk is
pre-tokenised from its own start, wherever that falls.  A match depends only
on where it starts and on what follows, so two scans that share one boundary
share all later ones: the first boundary that a chunk and its successor have
in common is the seam, and the texts between seams are encoded as pieces, side
by side.  Chunks whose overlap holds no common boundary (an unbroken run) are
joined and scanned anew until every seam is found.  Ids of a text stay in the
order of its pieces; decoding concatenates the tokens' bytes, which is the
text again.

The scan must split as the library does, whose Unicode tables are older than
Python's: the classes of its pattern are read off the library once per worker.
A white-space run that the library's matcher has no stack for is encoded
pre-token by pre-token.

Only chunks of long texts are stored and shuffled.  Their digests run over
the pieces in order without holding the whole text.

Defined cases: NULL and empty texts have no ids and decode to no bytes;
special strings are ordinary text; repeated rows and NULL ids are rows of
their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .util import batch, prepare, stored, text_or_empty

CHUNK = 1 << 16
OVERLAP = 1 << 11
#: A white-space run of this length is not given to the library's matcher.
LONG_RUN = 1 << 16
#: How far beyond its end a match that is over may have looked.
LOOK_AHEAD = 8


def _ranges(points: list[int]) -> str:
    """The inside of a character class that holds exactly these code points."""
    out, at = [], 0
    while at < len(points):
        upto = at
        while upto + 1 < len(points) and points[upto + 1] == points[upto] + 1:
            upto += 1
        out.append(f"\\U{points[at]:08x}-\\U{points[upto]:08x}")
        at = upto + 1
    return "".join(out)


def _library_class(name: str) -> str:
    """A class such as ``\\p{L}`` with the members that the library gives it."""
    import regex
    import tiktoken

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    one_byte = {bytes([b]): b for b in range(256)}
    members = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=one_byte, special_tokens={})
    library = set(bytes(members.encode_ordinary(every)).decode())
    own = set(regex.findall(name, every))
    more, less = (sorted(map(ord, s)) for s in (library - own, own - library))
    found = f"[{name}||[{_ranges(more)}]]" if more else name
    return f"[{found}--[{_ranges(less)}]]" if less else found


class RankedBytes:
    """Encoding and decoding by one rank file and one pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as f:
            self._ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._pattern = pattern
        self._library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self._ranks, special_tokens={})
        self._long_run = regex.compile(r"\s{%d}" % LONG_RUN)
        self._space = regex.compile(r"\s")

    @functools.cached_property
    def _one(self):
        """One match, whatever the text: all of it is one pre-token."""
        import tiktoken

        return tiktoken.Encoding("one", pat_str=r"[\s\S]+", mergeable_ranks=self._ranks, special_tokens={})

    @functools.cached_property
    def _matches(self):
        """The pattern with the library's classes; only long texts need it."""
        import regex

        pattern = self._pattern
        for name in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(name, _library_class(name))
        return regex.compile("(?V1)" + pattern)

    def boundaries(self, text: str, final: bool) -> list[int]:
        """The ends of the matches in ``text``; unless ``final``, only those that more text would not move."""
        ends = [0, *(m.end() for m in self._matches.finditer(text))]
        # The last match may go on, and one that ends just before could have taken more.
        return ends if final else [e for e in ends[:-1] if e < len(text) - LOOK_AHEAD]

    def cuts(self, text: str, ends: list[int], low: int, high: int) -> list[int]:
        """Those boundaries in [low, high] at which a text can be cut and encoded in two.

        White space before the cut would be matched differently at the end of a text.
        """
        return [e for e in ends if low <= e <= high and not (e and self._space.match(text, e - 1))]

    def encode(self, text: str) -> np.ndarray:
        if len(text) < LONG_RUN or not self._long_run.search(text):
            return np.array(self._library.encode_ordinary(text), "<u4")
        ids: list[int] = []
        for m in self._matches.finditer(text):
            ids += self._one.encode_ordinary(m.group())
        return np.array(ids, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return self._library.decode_bytes(ids.tolist())


@functools.cache
def load(path: str, pattern: str) -> RankedBytes:
    """The vocabulary of a rank file; a worker reads each file once."""
    return RankedBytes(path, pattern)


#: One piece of a text's encoding: ``row`` names the text, ``piece`` grows along it.
PIECES = "doc_id long, row string, piece int, last boolean, ids binary"
_PIECE = pa.schema([("doc_id", pa.int64()), ("row", pa.string()), ("piece", pa.int32()), ("last", pa.bool_()),
                    ("ids", pa.binary())])
_CHUNK = pa.schema([("doc_id", pa.int64()), ("row", pa.string()), ("k", pa.int32()), ("last", pa.bool_()),
                    ("text", pa.string())])
_MARK = pa.schema([("row", pa.string()), ("piece", pa.int32()), ("upto", pa.int32()), ("last", pa.bool_()),
                   ("heads", pa.list_(pa.int32())), ("tails", pa.list_(pa.int32()))])
_MARKS = "row string, piece int, upto int, last boolean, heads array<int>, tails array<int>"


def _whole(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path, pattern)
        for rb in batches:
            ids = [vocabulary.encode(t).tobytes() for t in rb.column(1).to_pylist()]
            n = rb.num_rows
            yield batch(_PIECE, rb.column(0), pa.nulls(n, pa.string()), [0] * n, [True] * n, ids)
    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for rb in batches:
            for doc, text in zip(rb.column(0), rb.column(1)):
                doc, text, row = doc.as_py(), text.as_py(), f"{part}-{n}"
                n += 1
                starts = range(0, len(text), chunk)
                for k, at in enumerate(starts):
                    yield batch(_CHUNK, [doc], [row], [k], [k == len(starts) - 1], [text[at:at + chunk + overlap]])
    return run


def _marks(path: str, pattern: str, chunk: int, overlap: int):
    """Where groups of chunks can meet their neighbours; rows come sorted by (row, piece, k)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path, pattern)
        name, texts, upto, final = None, [], 0, False

        def mark() -> Iterator[pa.RecordBatch]:
            if name is not None:
                text = "".join(texts)
                # Where the next group starts, in this group's text.
                after = len(texts) * chunk
                ends = vocabulary.boundaries(text, final)
                heads = vocabulary.cuts(text, ends, 0, overlap)
                tails = [] if final else [e - after for e in vocabulary.cuts(text, ends, after, after + overlap)]
                yield batch(_MARK, [name[0]], [name[1]], [upto], [final], [heads], [tails])

        for rb in batches:
            for row, piece, k, last, text in zip(*(c.to_pylist() for c in rb.columns)):
                if (row, piece) != name:
                    yield from mark()
                    name, texts = (row, piece), []
                # All but a group's last chunk go without their overlap, which the next one holds.
                texts[-1:] = [texts[-1][:chunk], text] if texts else [text]
                upto, final = k, last
        yield from mark()
    return run


def _spliced(path: str, pattern: str, chunk: int):
    """Encode groups of chunks; rows come sorted by (row, piece, k)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path, pattern)
        name, texts, seen = None, [], ()

        def piece() -> Iterator[pa.RecordBatch]:
            if name is not None:
                text = "".join(texts)
                after = len(texts) * chunk
                text = text[seen[4]:] if seen[3] else text[seen[4]:after + seen[5]]
                yield batch(_PIECE, [seen[0]], [seen[1]], [seen[2]], [seen[3]], [vocabulary.encode(text).tobytes()])

        for rb in batches:
            for doc, row, number, last, start, stop, text in zip(*(c.to_pylist() for c in rb.columns)):
                if (row, number) != name:
                    yield from piece()
                    name, texts = (row, number), []
                # A group reaches from its seam with the one before to its seam with the next; ``texts`` ends with
                # a whole chunk, overlap included, until it is known whether another of the group follows.
                texts[-1:] = [texts[-1][:chunk], text] if texts else [text]
                seen = doc, row, number, last, start or 0, stop
        yield from piece()
    return run


def whole_texts(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK) -> DataFrame:
    """The single pieces of all texts of at most ``chunk`` code points."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.where(F.length("text") <= chunk).mapInArrow(_whole(path, pattern), PIECES)


def spliced_texts(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The pieces of all longer texts."""
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must be positive and no longer than a chunk")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    cut = rows.where(F.length("text") > chunk).mapInArrow(
        _cut(chunk, overlap), "doc_id long, row string, k int, last boolean, text string")
    chunks = stored(cut, "bpe-chunks")
    n = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def gathered(groups: DataFrame | None) -> DataFrame:
        """The chunks of the groups (row, piece, upto, ...), each group's together and in order."""
        if groups is None:
            rows = chunks.withColumn("piece", F.col("k"))
        else:
            rows = chunks.join(groups.withColumn("k", F.explode(F.sequence("piece", "upto"))).drop("last"), ["row", "k"])
        return rows.repartition(n, "row", "piece").sortWithinPartitions("row", "piece", "k")

    def marked(groups: DataFrame | None) -> DataFrame:
        rows = gathered(groups).select("row", "piece", "k", "last", "text")
        return rows.mapInArrow(_marks(path, pattern, chunk, overlap), _MARKS)

    # Every chunk is a group at first.  Marks are one small row per group, in a window per text.
    marks = stored(marked(None), "bpe-marks")
    turn = Window.partitionBy("row").orderBy("piece")
    while True:
        seam = F.array_min(F.array_intersect("tails", F.lead("heads").over(turn)))
        seams = marks.withColumn("stop", seam).withColumn("start", F.lag("stop").over(turn))
        if seams.where(F.col("stop").isNull() & ~F.col("last")).isEmpty():
            break
        # Neighbours without a seam become one group, which is scanned anew; all others keep their marks.
        opens = F.when((F.col("piece") == 0) | F.col("start").isNotNull(), F.col("piece"))
        named = seams.withColumn("into", F.max(opens).over(turn.rowsBetween(Window.unboundedPreceding, 0)))
        sizes = named.groupBy("row", "into").agg(F.count(F.lit(1)).alias("size"), F.max("upto").alias("until"))
        named = stored(named.join(sizes, ["row", "into"]), "bpe-groups")
        same = named.where("size = 1").select(marks.columns)
        merged = named.where("size > 1").select("row", F.col("into").alias("piece"), F.col("until").alias("upto")).distinct()
        marks = stored(same.unionByName(marked(merged)), "bpe-marks")
    seams = stored(seams.select("row", "piece", "upto", "start", "stop"), "bpe-seams")
    return (gathered(seams).select("doc_id", "row", "piece", "last", "start", "stop", "text")
            .mapInArrow(_spliced(path, pattern, chunk), PIECES))


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, row, piece, last and ids (little-endian unsigned 32 bit) of every text's pieces.

    ``row`` is NULL for texts of one piece by themselves; else it names the text.
    """
    prepare(docs.sparkSession)
    return whole_texts(docs, path, pattern, chunk).unionByName(spliced_texts(docs, path, pattern, chunk, overlap))


def _decode(path: str, pattern: str):
    schema = pa.schema([*list(_PIECE)[:4], ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path, pattern)
        for rb in batches:
            data = [vocabulary.decode(np.frombuffer(ids, "<u4")) for ids in rb.column(4).to_pylist()]
            yield batch(schema, *rb.columns[:4], data)
    return run


def decode(pieces: DataFrame, path: str, pattern: str) -> DataFrame:
    """The pieces with the bytes that their ids stand for instead of the ids."""
    prepare(pieces.sparkSession)
    rows = pieces.select("doc_id", "row", "piece", "last", "ids")
    return rows.mapInArrow(_decode(path, pattern), PIECES.replace("ids binary", "data binary"))


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])


def _digests(path: str, pattern: str):
    """Digests of texts whose pieces come one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path, pattern)
        ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
        for rb in batches:
            rows: list[list] = [[], [], [], []]
            for doc, last, ids in zip(*(rb.column(c).to_pylist() for c in range(3))):
                ids_hash.update(ids)
                text_hash.update(vocabulary.decode(np.frombuffer(ids, "<u4")))
                n += len(ids) // 4
                if last:
                    for column, value in zip(rows, (doc, n, ids_hash.hexdigest(), text_hash.hexdigest())):
                        column.append(value)
                    ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
            yield batch(_DIGEST, *rows)
    return run


def digests(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text: encoded, then decoded."""
    prepare(docs.sparkSession)
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    columns = ("doc_id", "last", "ids")
    single = whole_texts(docs, path, pattern, chunk).select(*columns)
    pieces = spliced_texts(docs, path, pattern, chunk, overlap)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.repartition(n, "row").sortWithinPartitions("row", "piece").select(*columns)
    return (single.mapInArrow(_digests(path, pattern), ddl)
            .unionByName(ordered.mapInArrow(_digests(path, pattern), ddl)))
