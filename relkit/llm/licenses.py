"""Licence scan by TF-IDF cosine, with directory inheritance (operator 3).

The templates are short notices (``TEMPLATES``) and full licence texts
(``FULL``).  A text's words, in order and without those no template has, are
compared with each template in every window of the template's length, so a
notice is found at any place of a header or file, wrapped or beside other words.
Each distinct word weighs its count times ln((1 + files) / (1 + files that hold
it)) + 1, with document frequencies counted over all whole texts.  A window
whose cosine is ``LIKE`` or more is a match; one of a short notice must name a
licence (``CUE``) and hold the template's words that tell licences apart
(``NAME_WORDS``).  Matches do not overlap: full texts go before the notices
inside them, then the better goes first.  The best match is the file's own licence.

A licence file - by its name, or because its matches make up ``OWN_SHARE`` of
its words - speaks for its directory.  Every directory is joined with its
ancestors by path, and a file without an own licence inherits from the nearest
ancestor directory that has one.  The largest directories are salted in these
joins, as one source may hold a third of all files.

Defined cases: NULL or empty text has no own licence and can inherit; a NULL
path is a file of the root directory; equal scores go to the name first in
order, in a file and in a directory; repeated rows are rows of their own; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import batch, prepare, stored, text_or_empty

# Notices that stand in files, by SPDX name.
TEMPLATES: dict[str, Sequence[str]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License.",
                   "Apache License, Version 2.0"),
    "BSD-3-Clause": ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
                     "Released under the BSD 3-Clause License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or any later version."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT license.", "The MIT License"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
# Full licence texts, one file per SPDX name.
_TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")
FULL = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0")
# Words that tell licences apart.  SPDX identifiers are others.
NAME_WORDS = frozenset("""apache bsd bsd-style 2-clause 3-clause by by-nc attribution attribution-noncommercial cc commons
    general lesser mit mozilla public 2 3 2.0 2.1 4.0""".split())
_SPDX = "spdx-license-identifier"
CUE = r"(?i)licen[sc]e"
#: Every template holds one of these.
_ANY_CUE = r"(?i)licen[sc]e|warrant"
LIKE = 0.75
OWN_SHARE = 0.3
#: So many of the largest directories are spread over so many places in the joins by path.
HOT_KEYS, SALTS = 64, 64
FILE_NAME = r"(?i)^(un)?(licen[sc]e|copying|notice)([.-].*)?$"
_WORD = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
_NOT_WORD = r"[^a-z0-9.-]+"


def words_of(text: str) -> list[str]:
    return re.findall(_WORD, text.lower())


def _tags(name: str) -> list[str]:
    """The SPDX tags of a licence."""
    return [f"SPDX-License-Identifier: {name}{end}" for end in (("", "-only", "-or-later") if "GPL" in name else ("",))]


def full_texts() -> dict[str, str]:
    out = {}
    for name in FULL:
        with open(os.path.join(_TEXTS, f"{name}.txt"), encoding="utf-8") as f:
            out[name] = f.read()
    return out


class Weights:
    """Word weights and the templates' vectors under them."""

    def __init__(self, templates: Mapping[str, Sequence[str]], full: Mapping[str, str], files: int, holders: Mapping[str, int]) -> None:
        self._ids = {w: k for k, w in enumerate(sorted(holders))}
        self._idf = np.array([math.log((1 + files) / (1 + holders[w])) + 1 for w in sorted(holders)])
        self._cues = np.array([bool(re.search(CUE, w)) for w in sorted(holders)], bool)
        texts = [(name, text, True) for name, text in sorted(full.items())]
        texts += [(name, text, False) for name in sorted({*templates, *full}) for text in (*templates.get(name, ()), *_tags(name))]
        self._templates = []
        for name, text, whole in texts:
            words = words_of(text)
            vector = np.bincount([self._ids[w] for w in words], minlength=len(self._idf)) * self._idf
            named = {self._ids[w] for w in words if w in NAME_WORDS or _SPDX in words}
            self._templates.append((name, whole, len(words), vector / math.sqrt(vector @ vector), frozenset() if whole else frozenset(named)))

    def _cosines(self, ids: np.ndarray, size: int, vector: np.ndarray) -> np.ndarray:
        """The cosine of each window of ``size`` words with the template."""
        weight = self._idf[ids]
        sums = np.r_[0.0, np.cumsum(weight * vector[ids])]
        dots = sums[size:] - sums[:-size]
        held: dict[int, int] = {}
        square, squares = 0.0, []
        own, weights = ids.tolist(), (weight * weight).tolist()
        for k, w in enumerate(own):
            n = held.get(w, 0)
            held[w] = n + 1
            square += (2 * n + 1) * weights[k]
            if k >= size:
                gone = own[k - size]
                n = held[gone]
                held[gone] = n - 1
                square -= (2 * n - 1) * weights[k - size]
            if k >= size - 1:
                squares.append(square)
        return np.minimum(1.0, dots / np.sqrt(squares))

    def matches(self, text: str, like: float) -> list[tuple[float, str, int]]:
        """Score, name and number of words of each match, none of which overlap."""
        words = words_of(text)
        pairs = [(k, self._ids[w]) for k, w in enumerate(words) if w in self._ids]
        if not pairs:
            return []
        at, ids = np.array(pairs).T
        present = np.unique(ids)
        cues = np.flatnonzero(self._cues[ids])
        found = []
        for name, whole, size, vector, named in self._templates:
            # No window's cosine is above the share of the template's norm that the text's words hold.
            if math.sqrt((vector[present] ** 2).sum()) < like - 1e-9 or not named.issubset(present.tolist()):
                continue
            size = min(size, len(ids))
            near = [(0, len(ids))] if whole else []
            for c in cues.tolist() if not whole else ():
                start, end = max(0, c - size + 1), min(len(ids), c + size)
                if near and start <= near[-1][1]:
                    near[-1] = (near[-1][0], end)
                else:
                    near.append((start, end))
            for start, end in near:
                part = ids[start:end]
                if len(part) < size:
                    continue
                cosines = self._cosines(part, size, vector)
                for k in np.flatnonzero(cosines >= like).tolist():
                    window = part[k:k + size]
                    if whole or self._cues[window].any() and named.issubset(window.tolist()):
                        found.append((not whole, -round(float(cosines[k]), 12), name, start + k, size))
        free = np.ones(len(ids), bool)
        out = []
        for _, score, name, start, size in sorted(found):
            if free[start:start + size].all():
                free[start:start + size] = False
                out.append((-score, name, int(at[start + size - 1] - at[start]) + 1))
        return out


def _weights(files: DataFrame, templates: Mapping[str, Sequence[str]]) -> Weights:
    """Document frequencies of the templates' words over all whole texts."""
    full = full_texts()
    vocabulary = sorted({w for t in (*full.values(), *(t for texts in templates.values() for t in texts),
                                           *(t for name in {*templates, *full} for t in _tags(name))) for w in words_of(t)})
    held = F.array_intersect(F.transform(F.split(F.lower(F.col("text")), _NOT_WORD, -1), lambda w: F.trim(w, F.lit(".-"))),
                             F.array(*map(F.lit, vocabulary)))
    # One row per vocabulary word, and one for the number of files.
    rows = (files.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("w"))
            .where(F.col("w").isin("", *vocabulary)).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect())
    counts = {r["w"]: r["n"] for r in rows}
    n = counts.pop("", 0)
    return Weights(templates, full, n, {w: counts.get(w, 0) for w in vocabulary})


_OWN = pa.schema([("key", pa.int64()), ("path", pa.string()), ("own_license", pa.string()), ("own_score", pa.float64()),
                  ("notice_words", pa.int64()), ("n_words", pa.int64())])


def _own(weights: Weights, like: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, list] = {}
        for rb in batches:
            names, scores, sizes = [], [], []
            for text in rb.column(2).to_pylist():
                if text is not None and text not in memo:
                    if len(memo) > 1000:
                        memo.clear()
                    memo[text] = weights.matches(text, like)
                found = memo[text] if text is not None else []
                score, name = min(((-score, name) for score, name, _ in found), default=(0.0, None))
                names.append(name)
                scores.append(abs(score))
                sizes.append(sum(n for _, _, n in found))
            yield batch(_OWN, rb.column(0), rb.column(1), names, scores, sizes, rb.column(3))
    return run


def directory_of(path):
    """The path up to its last slash; empty for a file of the root."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan_licenses(files: DataFrame, key: str = "doc_id", templates: Mapping[str, Sequence[str]] = TEMPLATES,
                  like: float = LIKE) -> DataFrame:
    """key, path, own_license, own_score, license, origin (own, inherited, none) and from_dir for every row.

    ``files`` has the columns ``key``, path and text.
    """
    prepare(files.sparkSession)
    rows = files.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                        text_or_empty().alias("text"))
    weights = _weights(rows, templates)
    named = F.when(F.col("text").rlike(_ANY_CUE), F.col("text"))
    size = F.when(F.col("text").rlike(_ANY_CUE), F.size(F.split("text", r"\s+", -1))).otherwise(0).cast("long")
    ddl = "key long, path string, own_license string, own_score double, notice_words long, n_words long"
    own = stored(rows.select("key", "path", named.alias("named"), size.alias("n_words")).mapInArrow(_own(weights, like), ddl),
                 "license-own").withColumn("dir", directory_of(F.col("path")))
    return _inherit(own).withColumnRenamed("key", key)


def _join_spread(left: DataFrame, right: DataFrame, key: str, other: str, how: str, spread_by: list[str]) -> DataFrame:
    """``left`` joined with ``right`` (one row per ``other``) on ``key`` = ``other``.

    The ``HOT_KEYS`` keys with the most rows in ``left`` are dealt over ``SALTS``
    places by a hash of ``spread_by``, and their rows of ``right`` stand in each.
    """
    hot = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), key).limit(HOT_KEYS).select(F.col(key).alias("_hot"))
    is_hot = F.col("_hot").isNotNull()
    many = left.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(*spread_by), F.lit(SALTS))).otherwise(0).cast("int")).drop("_hot")
    places = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    one = right.join(F.broadcast(hot), F.col(other) == F.col("_hot"), "left").withColumn("_place", F.explode(places)).drop("_hot")
    return many.join(one, (F.col(key) == F.col(other)) & (F.col("_salt") == F.col("_place")), how).drop("_salt", "_place")


def _inherit(own: DataFrame) -> DataFrame:
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    speaks = F.col("own_license").isNotNull() & (base.rlike(FILE_NAME) | (F.col("notice_words") >= OWN_SHARE * F.col("n_words")))
    granted = own.where(speaks).groupBy("dir").agg(F.min(F.struct((-F.col("own_score")).alias("s"), "own_license")).alias("g")).select(
        F.col("dir").alias("granting"), F.col("g.own_license").alias("granted"))
    parts = F.split("dir", "/", -1)
    # Each directory with itself and its ancestors, the root (depth 0) included.
    above = own.select("dir").distinct().select("dir", F.explode(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts)))).alias("depth"))
    above = above.withColumn("ancestor", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    nearest = (_join_spread(above, granted, "ancestor", "granting", "inner", ["dir"])
               .groupBy("dir").agg(F.max(F.struct("depth", "granted", "ancestor")).alias("n"))
               .select(F.col("dir").alias("d"), F.col("n.granted").alias("granted"), F.col("n.ancestor").alias("ancestor")))
    with_dir = _join_spread(own, nearest, "dir", "d", "left", ["key", "path"])
    has_own = F.col("own_license").isNotNull()
    return with_dir.select(
        "key", "path", "own_license", "own_score", F.coalesce("own_license", "granted").alias("license"),
        F.when(has_own, "own").when(F.col("granted").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~has_own, F.col("ancestor")).alias("from_dir"))
