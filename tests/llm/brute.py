"""Plain versions of the operators, one row at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np


class Sets:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.find(a)] = self.find(b)


def ordered(rows) -> list:
    return sorted((tuple(r) for r in rows), key=str)


def repeated_bytes(rows, length: int) -> list:
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return ordered(out)


def repeated_words(rows, width: int) -> list:
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    lowest: dict = {}
    for d, w in split:
        if d is not None:
            for i in range(len(w) - width + 1):
                k = tuple(w[i:i + width])
                lowest[k] = min(lowest.get(k, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if d is not None and lowest[tuple(w[i:i + width])] < d:
                gone[i:i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return ordered(out)


def jaccard(rows, width: int, percent: int) -> list:
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        grams = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
        sets.append(grams)
    links, inside = Sets(len(rows)), defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in inside[g])
        for g in s:
            inside[g].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                links.join(i, j)
    name: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            name[links.find(i)] = min(name.get(links.find(i), d), d)
    return ordered((d, len(s), name.get(links.find(i)) if s else d)
                   for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def usable(v) -> bool:
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def near_vectors(rows, threshold: float) -> list:
    links, count, name = Sets(len(rows)), [0] * len(rows), {}
    ok = [i for i, (_, v, label) in enumerate(rows) if usable(v) and label is not None]
    for i in ok:
        for j in ok:
            a, b = rows[i], rows[j]
            if i != j and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    count[i] += 1
                    links.join(i, j)
    for i, r in enumerate(rows):
        if r[0] is not None:
            name[links.find(i)] = min(name.get(links.find(i), r[0]), r[0])
    return ordered((r[0], count[i], name.get(links.find(i))) for i, r in enumerate(rows))


def best_fit(lengths: list[int], cap: int) -> list[int]:
    """Fill of each sequence of document-by-document best-fit decreasing."""
    bins: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, b in enumerate(bins) if cap - b >= n]
        if fits:
            bins[max(fits, key=lambda k: bins[k])] += n
        else:
            bins.append(n)
    return sorted(bins)


def _pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for p in re.split(r"[.,;:!?\x0A-\x0D]", low) if (w := re.findall(r"[^\x20\x09]+", p))]


def collocations(rows, least: int, longest: int, top: int) -> list:
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in _pieces(text):
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside: dict = {}
    for (lang, *w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[(lang, *w[i:i + k])] = max(a, inside.get((lang, *w[i:i + k]), 0))
    out = defaultdict(list)
    for (lang, *w), a in cand.items():
        if inside.get((lang, *w), 0) >= a:
            continue
        score, k = min((1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return ordered((lang, rank, p.decode(), -a, x, y, n[lang], -score)
                   for lang, found in out.items() for rank, (score, a, p, x, y) in enumerate(sorted(found)[:top], 1))


def equal_texts(rows) -> list:
    groups = defaultdict(list)
    norm = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "") for _, t in rows]
    for i, t in enumerate(norm):
        groups[t].append(i)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in groups[norm[i]]]
        named = [x for x in ids if x is not None]
        out.append((d, max(named) if named else None, len(ids), hashlib.sha256(norm[i].encode()).hexdigest()))
    return ordered(out)


def integer_rows(rows) -> list:
    """(id, Python integers) of the usable vectors."""
    return [(d, [int(np.floor(1024 * float(c))) + 100_000 for c in v]) for d, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]


def whitened(rows, components: int = 8):
    """Ids, exact deviations, whitened rows, explained shares: two plain passes over the rows."""
    fit = integer_rows(rows)
    n, dim = len(fit), len(fit[0][1])
    sums = [sum(x[d] for _, x in fit) for d in range(dim)]
    exact = [[n * x[d] - sums[d] for d in range(dim)] for _, x in fit]
    z = np.array([[float(v) / n for v in r] for r in exact])
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, dim)
    return ([d for d, _ in fit], [sum(v * v for v in r) for r in exact], z @ u[:, :k] / np.sqrt(np.where(e[:k] > 0, e[:k], 1)), e[:k] / e.sum())
