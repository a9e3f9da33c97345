"""Tokenizer files as encoders that give token ids.

``load(path)`` reads a ``tokenizers`` JSON file or a ``sentencepiece`` model.
A byte-level BPE file whose merges are in id order is run by ``tiktoken`` on
the same vocabulary, which gives the same ids several times faster; texts that
hold one of its special strings or very long white space, and every other file,
go through the file's own library.  The tests hold the two against each other.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np

# The byte-level pre-tokenizer's pattern.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: A white-space run of this length goes through the file's own library.
LONG_RUN = 1 << 16


@functools.lru_cache(1 << 16)
def _is_letter(c: str) -> bool:
    return bool(c) and unicodedata.ucd_3_2_0.category(c)[0] == "L"


@functools.lru_cache(1 << 16)
def _ends_letters(c: str) -> bool:
    """White space, punctuation or a symbol."""
    return bool(c) and (c in "\t\n\v\f\r" or unicodedata.ucd_3_2_0.category(c)[0] in "ZPS")


def _byte_of_symbol() -> dict[str, int]:
    """The byte that each printable symbol of a byte-level vocabulary stands for."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """``ids(text)`` of one tokenizer file, without begin, end or other added tokens."""

    def ids(self, text: str) -> np.ndarray:
        raise NotImplementedError


class ByteLevelBPE(Encoder):
    """Byte-level BPE, whose tokens cover the bytes of the text exactly."""

    def proven(self, data: bytes, at: int) -> bool:
        """Whether ``at`` splits the encoding of any text that holds ``data`` here.

        True between a letter and a white-space, punctuation or symbol
        character: only letters continue a run of letters, so the pre-token
        with the letter ends there whatever stands further left, and the next
        one does not look back.  Characters count as what they are in Unicode
        3.2 already, on which all later tables agree.  A character that a
        special string holds proves nothing, as the string is cut out first.
        """
        if not 0 < at < len(data) or data[at] & 0xC0 == 0x80:
            return False
        left = data[max(0, at - 4):at].decode("utf-8", "ignore")[-1:]
        right = data[at:at + 4].decode("utf-8", "ignore")[:1]
        return _is_letter(left) and _ends_letters(right) and right not in self._special_symbols

    def __init__(self, spec: dict, slow) -> None:
        import tiktoken

        symbol = _byte_of_symbol()
        special = [t["content"] for t in spec["added_tokens"]]
        ranks = {bytes(symbol[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._fast = tiktoken.Encoding("vocabulary", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._slow = slow
        self._special_symbols = set("".join(special))
        self._long_run = re.compile(r"\s{%d}" % LONG_RUN)
        size = max([*ranks.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self._width = np.zeros(size, np.int64)
        for piece, i in ranks.items():
            self._width[i] = len(piece)
        for t in spec["added_tokens"]:
            self._width[t["id"]] = len(t["content"].encode())

    def ids(self, text: str) -> np.ndarray:
        # The fast matcher has no stack for very long white space.
        if (self._special and self._special.search(text)) or (len(text) >= LONG_RUN and self._long_run.search(text)):
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self._fast.encode_ordinary(text), np.uint32)

    def ends_of(self, ids: np.ndarray) -> np.ndarray:
        """Where each token ends, in bytes of the text that ``ids`` encode."""
        return np.cumsum(self._width[ids])


class LibraryTokenizer(Encoder):
    def __init__(self, slow) -> None:
        self._slow = slow

    def ids(self, text: str) -> np.ndarray:
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)


class SentencePieceModel(Encoder):
    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self._model.encode(text, num_threads=1), np.uint32)


def _plain_byte_level(spec: dict) -> bool:
    """Whether ``tiktoken`` can stand in: byte-level, no normalizer, merges in id order."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if not (model.get("type", "BPE") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and spec.get("normalizer") is None and not model.get("dropout")
            and not model.get("ignore_merges") and spec.get("truncation") is None):
        return False
    vocab = model["vocab"]
    made = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    return None not in made and all(a < b for a, b in zip(made, made[1:])) and min(made, default=256) >= 256


@functools.cache
def load(path: str) -> Encoder:
    """The encoder of a tokenizer file; a worker reads each file once."""
    if path.endswith(".model"):
        return SentencePieceModel(path)
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    slow = Tokenizer.from_file(path)
    slow.no_truncation()
    slow.no_padding()
    return ByteLevelBPE(spec, slow) if _plain_byte_level(spec) else LibraryTokenizer(slow)
