"""Token counts by overlap resynchronisation (operator 2).

A text longer than ``window`` bytes is encoded in windows that overlap.  Two
neighbouring windows are spliced at a byte where both encodings end a token
and which is proven stable: the text there splits into tokens the same way
whatever stands further away (``Encoder.proven``).  When the overlap holds no
such byte it is widened by going back twice as far, up to the whole window,
and then the window grows up to the next one; so a run without any safe place
is encoded whole, once, and the count is always the library's count of the
whole text.

Only one window is encoded at a time.  Documents need no shuffle.

Defined cases: NULL and empty text count 0 bytes and 0 tokens; special strings
inside texts are what the tokenizer's library makes of them; a tokenizer
without byte offsets (sentencepiece) encodes whole texts; repeated rows and
NULL ids are rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoders import ByteLevelBPE, Encoder, load
from .util import batch, prepare, text_or_empty

WINDOW = 1 << 15
OVERLAP = 1 << 8


def _clip(data: bytes, at: int) -> int:
    """The first byte at or after ``at`` that starts a character."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


#: Where a proven place can be: a letter before something that is neither letter nor digit.
_CANDIDATE = re.compile(r"[^\W\d_][\W_]")


def _places(encoder: ByteLevelBPE, data: bytes, low: int, high: int) -> list[int]:
    """The proven places of ``data`` in (low, high), ascending."""
    low, high = _clip(data, low), _clip(data, high)
    text, out, seen, at = data[low:high].decode("utf-8"), [], 0, low
    for m in _CANDIDATE.finditer(text):
        at += len(text[seen:m.start() + 1].encode("utf-8"))
        seen = m.start() + 1
        if encoder.proven(data, at):
            out.append(at)
    return out


def spliced_ids(encoder: Encoder, text: str, window: int = WINDOW, overlap: int = OVERLAP) -> Iterator[np.ndarray]:
    """The token ids of ``text`` in order, encoded window by window."""
    data = text.encode("utf-8")
    if len(data) <= window or not isinstance(encoder, ByteLevelBPE):
        yield encoder.ids(text)
        return

    def encode(at: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
        ids = encoder.ids(data[at:upto].decode("utf-8"))
        return ids, at + encoder.ends_of(ids)

    start, size = 0, window
    stop = _clip(data, size)
    ids, ends = encode(start, stop)
    while stop < len(data):
        back = overlap
        again = _clip(data, max(start, stop - back))
        places = _places(encoder, data, again, stop)
        while not places and again > start:
            # No safe place in the overlap: widen it, up to the whole window.
            back *= 2
            again = _clip(data, max(start, stop - back))
            places = _places(encoder, data, again, stop)
        if places:
            # The next window reaches beyond this one, however far the overlap goes back.
            after = _clip(data, stop + size)
            next_ids, next_ends = encode(again, after)
            # The two share the bytes from `again` to `stop`; a token's end there can be the seam if it is proven.
            common = np.intersect1d(np.intersect1d(ends, next_ends), places)
            if len(common):
                seam = int(common[-1])
                yield ids[: np.searchsorted(ends, seam, side="right")]
                beyond = next_ends > seam
                ids, ends = next_ids[beyond], next_ends[beyond]
                start, stop, size = seam, after, window
                continue
        # No safe place in the whole window: let it grow until it has one, and encode it anew.
        while True:
            size *= 2
            before, stop = stop, _clip(data, start + size)
            if stop >= len(data) or _places(encoder, data, max(start, before - 8), stop):
                break
        ids, ends = encode(start, stop)
    yield ids


def spliced_count(encoder: Encoder, text: str, window: int = WINDOW, overlap: int = OVERLAP) -> int:
    """The number of tokens of ``text``."""
    return sum(map(len, spliced_ids(encoder, text, window, overlap)))


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, window: int = WINDOW,
                 overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) for every row of ``docs``."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer)
        for rb in batches:
            n = [spliced_count(encoder, t, window, overlap) for t in rb.column(1).to_pylist()]
            yield batch(_SCHEMA, rb.column(0), rb.column(2), n)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                       F.octet_length(text_or_empty()).cast("long").alias("n_bytes"))
    return (rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
