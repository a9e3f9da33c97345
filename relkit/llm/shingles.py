"""Word shingles as 64-bit hashes, for the operators that compare documents.

Words are the runs of characters other than space and U+0009-U+000D after A-Z
is lower-cased; a document's set holds the distinct 5-word shingles, or the
whole sequence as one shingle when there are fewer words, and is empty without
words.  A shingle is a 64-bit mix of its words' 64-bit hashes.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WIDTH = 5
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words whose hash a worker remembers, the first ones it meets (some 15 MB); others are hashed each time.
_MEMO_WORDS = 100_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < _MEMO_WORDS:
            self[word] = value
        return value


_memo = _WordHashes()
#: Bytes of text that are split into words at a time.
_BLOCK = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    at = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mix(at) | np.uint64(1)


_PLACES = odd_multipliers(WIDTH, 17)


def word_hashes(text: str) -> np.ndarray:
    """The hashes of a text's words in order, read block by block (long texts stay cheap)."""
    data = text.encode("utf-8", "surrogatepass").translate(_LOWER)
    parts, at = [], 0
    while at < len(data):
        end = at + _BLOCK
        gap = _SPACE.search(data, end) if end < len(data) else None
        end = gap.start() if gap else len(data)
        words = data[at:end].split()
        parts.append(np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words)))
        at = end
    return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint64), *parts])


def shingle_set(text: str) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    h = word_hashes(text)
    n = len(h)
    if n == 0:
        return h
    if n < WIDTH:
        # Fewer words than a shingle holds: one shingle, told apart by its length.
        return mix((h * _PLACES[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    out = h[: n - WIDTH + 1] * _PLACES[0]
    for k in range(1, WIDTH):
        out += h[k: n - WIDTH + 1 + k] * _PLACES[k]
    return np.unique(mix(out))


def set_digest(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a whole shingle set."""
    return xxhash.xxh3_128_digest(hashes.tobytes())
