"""License scan against a definition-level version: every window of every template, and inheritance by walking up."""

import math
import random
import re
from collections import Counter

import pytest

from relkit.llm import licenses


def words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", text.lower())


def all_templates() -> list[tuple[str, bool, list[str]]]:
    full = licenses.full_texts()
    out = [(name, True, words(text)) for name, text in full.items()]
    for name in {*licenses.TEMPLATES, *full}:
        tags = [f"SPDX-License-Identifier: {name}" + end for end in (("", "-only", "-or-later") if "GPL" in name else ("",))]
        out += [(name, False, words(t)) for t in (*licenses.TEMPLATES.get(name, ()), *tags)]
    return out


def cosine(a: Counter, b: Counter, idf: dict[str, float]) -> float:
    dot = sum(a[w] * b[w] * idf[w] ** 2 for w in a)
    norm = lambda c: math.sqrt(sum((n * idf[w]) ** 2 for w, n in c.items()))
    return dot / (norm(a) * norm(b))


def own_matches(text: str, templates: list, idf: dict[str, float]) -> list[tuple[float, str, int]]:
    kept = [(k, w) for k, w in enumerate(words(text)) if w in idf]
    found = []
    for name, whole, template in templates:
        size = min(len(template), len(kept))
        must = set() if whole else {w for w in template if w in licenses.NAME_WORDS or "spdx-license-identifier" in template}
        for start in range(len(kept) - size + 1 if size else 0):
            window = [w for _, w in kept[start:start + size]]
            if not whole and not (must <= set(window) and any(re.search("licen[sc]e", w) for w in window)):
                continue
            score = cosine(Counter(window), Counter(template), idf)
            if score >= licenses.LIKE:
                found.append((not whole, -round(score, 12), name, start, size))
    used: set[int] = set()
    out = []
    for _, score, name, start, size in sorted(found):
        if not used & set(range(start, start + size)):
            used |= set(range(start, start + size))
            out.append((-score, name, kept[start + size - 1][0] - kept[start][0] + 1))
    return out


def brute(rows: list[tuple[int, str, str]]) -> dict[int, tuple]:
    templates = all_templates()
    vocabulary = {w for _, _, t in templates for w in t}
    holders = Counter(w for _, _, text in rows for w in set(words(text)) & vocabulary)
    idf = {w: math.log((1 + len(rows)) / (1 + holders[w])) + 1 for w in vocabulary}
    own, granted = {}, {}
    for key, path, text in rows:
        found = own_matches(text, templates, idf)
        own[key] = min(((-s, name) for s, name, _ in found), default=(0.0, None))
        folder, _, base = path.rpartition("/")
        share = sum(n for _, _, n in found) >= 0.3 * len(re.split(r"\s+", text))
        if found and (share or re.match(r"(?i)(un)?(licen[sc]e|copying|notice)([.-].*)?$", base)):
            granted[folder] = min(granted.get(folder, (1.0, "")), own[key])
    out = {}
    for key, path, _ in rows:
        at = path.rpartition("/")[0]
        while at and at not in granted:
            at = at.rpartition("/")[0]
        score, name = own[key]
        from_dir = at if name is None and at in granted else None
        out[key] = (name, -score, name or (granted[at][1] if at in granted else None), from_dir)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_scan_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    notices = [t for texts in licenses.TEMPLATES.values() for t in texts]
    filler = [*sorted({w for t in notices for w in words(t)}), *(f"word{k}" for k in range(60))]
    rows = []
    for key in range(60):
        own = [rng.choice(filler) for _ in range(rng.randrange(0, 25))]
        if rng.random() < 0.5:
            notice = rng.choice(notices).split()
            for _ in range(rng.randrange(0, 4)):
                at = rng.randrange(len(notice))
                notice[at:at + rng.randrange(0, 2)] = [rng.choice(filler)]
            at = rng.randrange(len(own) + 1)
            own[at:at] = notice
        folder = "/".join(rng.choice("abc") for _ in range(rng.randrange(0, 4)))
        name = rng.choice(["LICENSE", "copying.txt", "x.py", "y.md"])
        rows.append((key, f"{folder}/{key}-{name}" if rng.random() < 0.6 else f"{folder}/{name}".lstrip("/"), rng.choice([" ", "\n", ", "]).join(own)))
    want = brute(rows)
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert {k: (r["own_license"], r["license"], r["from_dir"]) for k, r in got.items()} == {k: (w[0], w[2], w[3]) for k, w in want.items()}
    assert all(got[k]["own_score"] == pytest.approx(w[1], abs=1e-9) for k, w in want.items())
    assert len({w[0] for w in want.values()}) > 4 and any(w[3] for w in want.values())
