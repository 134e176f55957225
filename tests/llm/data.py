"""Small tables with the awkward cases: nulls, empty texts, ties, repeated rows, columns whose names clash."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

CLASHING = ("text_key", "anchor", "node", "hashes", "k1", "carried_0", "shard", "label_", "rank", "length", "_bucket",
            "lang_pred", "score", "part", "_id", "_key", "component")


def clash(df):
    """``df`` with extra columns named like the operators' own."""
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING if c not in df.columns])


def passages(seed: int = 3, n: int = 60, length: int = 300) -> list[tuple]:
    """Texts of a few letters sharing passages, some of them more than once."""
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("ab cé") for _ in range(length)) for _ in range(5)]
    rows = []
    for i in range(n):
        t = ""
        for _ in range(rnd.randint(0, 5)):
            b, a = rnd.choice(base), rnd.randint(0, length - 10)
            t += b[a:a + rnd.randint(1, 60)] + rnd.choice(["", "xyz", "q" * rnd.randint(0, 70)])
        rows.append((i, t))
    return rows + [(None, rows[0][1]), (None, None), (7, rows[7][1]), (7, "ab" * 100), (8, ""), (900, " \t\n")]


def near_copies(seed: int = 5, bases: int = 15, copies: int = 7) -> list[tuple]:
    """Word sequences of all sizes with exact and edited copies."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(bases):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([2, 3, 4, 6, 9, 12, 20, 40, 90, 300]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4, 8])):
                i = rnd.randrange(len(w))
                if rnd.random() < 0.5:
                    w[i] = rnd.choice(vocabulary)
                elif rnd.random() < 0.5:
                    w.insert(i, rnd.choice(vocabulary))
                elif len(w) > 1:
                    w.pop(i)
            rows.append((len(rows), " ".join(w)))
    return rows + [(None, rows[3][1]), (None, None), (5, rows[9][1]), (900, ""), (901, " \t"), (902, "A b"),
                   (903, "a B"), (904, "a")]


def words_sharing(seed: int = 9, n: int = 40) -> list[tuple]:
    """Texts of words that share runs around the window length."""
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    runs = [[rnd.choice(vocabulary) for _ in range(k)] for k in (12, 13, 14, 30, 60)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rnd.randint(0, 4)):
            w += rnd.choice(runs) if rnd.random() < 0.6 else [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 25))]
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(w)))
    return rows + [(None, rows[4][1]), (None, None), (3, rows[3][1]), (3, rows[5][1]), (600, ""), (601, "x " * 40)]


def near_vectors(seed: int = 2) -> list[tuple]:
    import numpy as np

    rng = np.random.default_rng(seed)
    rows = []
    for b in range(25):
        c = rng.normal(size=8)
        for _ in range(rng.integers(1, 12)):
            rows.append((len(rows), (c + rng.normal(size=8) * rng.choice([0, 0.02, 0.1, 0.3])).tolist(), int(b % 3)))
    return rows + [(None, rows[0][1], 0), (500, None, 1), (501, [0.0] * 8, 1), (502, [1.0, None] * 4, 1),
                   (503, [float("nan")] * 8, 1), (504, rows[5][1], None), (505, [1.0, 2.0], 1), (506, [2.0, 4.0], 1),
                   (3, rows[3][1], rows[3][2]), (507, [], 1)]
