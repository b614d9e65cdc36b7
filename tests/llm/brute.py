"""Slow and plain versions of what the operators compute."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import xxhash

WORDS = "tion the ent and ing ness over under water stone light house river cloud paper green seven fox".split()


def words(rng, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def fingerprint(text: str) -> int:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    shingles = [" ".join(found[i:i + 3]) for i in range(max(1, len(found) - 2))]
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def components(prints: list[int], radius: int = 3) -> list[int]:
    """For each fingerprint the position of the first one it is connected with."""
    label = list(range(len(prints)))
    arr = np.array(prints, dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(arr[i] ^ arr[i + 1:]) <= radius) + i + 1:
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    return label


BASE = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32)]


ACCESS_RUN, HEX_RUN = re.compile("AKIA[A-Z0-9]{12,}"), re.compile("[0-9a-f]{32,}")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, kind), in order."""
    return sorted((m.start(), n, m.end(), kind) for n, (kind, pattern, group, least) in enumerate(BASE)
                  for m in pattern.finditer(text) if len(m[group]) >= least)


LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+"


def markov_ratios(texts: list[str]) -> list[float]:
    """The secret scan's table, from all texts: (space and letters) by letters."""
    counts = {True: Counter(), False: Counter()}
    base = re.compile("|".join(p.pattern for p in (ACCESS_RUN, HEX_RUN)))
    for text in texts:
        values = [m[2] for m in BASE[0][1].finditer(text)] + ACCESS_RUN.findall(text) + HEX_RUN.findall(text)
        shown = [w for v in values if len(v) >= 8 and re.search("[0-9]", v) for w in re.findall("[A-Za-z0-9+]+", v)]
        rest = re.sub(f"{base.pattern}|(?i:{BASE[0][1].pattern})", " ", text, flags=re.A)
        for random, words_ in ((True, shown), (False, [w for w in re.findall("[A-Za-z0-9+]{4,}", rest) if len(w) < 16])):
            counts[random].update(a + b for w in words_ for a, b in zip(" " + w, w))

    def model(c, random):
        single = {x: 1 + sum(c[b + x] for b in " " + LETTERS) for x in LETTERS}
        for b in " " + LETTERS:
            n = sum(c[b + x] for x in LETTERS)
            for x in LETTERS:
                yield (0.5 * (c[b + x] + 1) / (n + 63) + 0.5 / 63 if random else (c[b + x] + 20.0 * single[x] / sum(single.values())) / (n + 20.0))
    return [math.log(r) - math.log(o) for r, o in zip(model(counts[True], True), model(counts[False], False))]


def random_spans(text: str, ratios: list[float]) -> list[tuple[int, int, int, str]]:
    """Runs outside the base spans whose ratio is high enough, as ``base_spans`` gives its own."""
    shown = list(text)
    for start, _, end, _ in base_spans(text):
        shown[start:end] = " " * (end - start)
    out = []
    for m in re.finditer("[A-Za-z0-9+]{16,}", "".join(shown)):
        total = sum(ratios[(0 if a == " " else LETTERS.index(a) + 1) * 63 + LETTERS.index(b)] for a, b in zip(" " + m[0], m[0]))
        if re.search("[A-Za-z]", m[0]) and total >= 8 + len(m[0]):
            out.append((m.start(), 3, m.end(), "random"))
    return out


def edit_distance(pattern: str, text: str) -> int:
    """Least distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != t))
    return min(row)
