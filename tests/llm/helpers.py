"""Plain-Python definitions that the operators are compared with, and awkward small tables."""

from __future__ import annotations

import random

SPACE = b" \t\n\x0b\x0c\r"


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text, size=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w)} if len(w) < size else {tuple(w[i: i + size]) for i in range(len(w) - size + 1)}


def docs_frame(spark, rows, extra=True):
    """documents(doc_id, text) with columns whose names clash with the operators' own."""
    names = "doc_id long, text string"
    if extra:
        names += ", size long, rule string, id long, _id string, kept boolean, n int"
        rows = [(*r, 7, "x", 1, "y", True, 3) for r in rows]
    return spark.createDataFrame(rows, names)


def near_copies(seed=5, bases=6, copies=7):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, at = [], 0
    for _ in range(bases):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 12, 40, 150, 400]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((at, " ".join(w)))
            at += 1
    return rows
