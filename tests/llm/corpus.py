"""Small documents with the awkward cases that every operator must handle."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, size long, node string, spans string, key string"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def edited(text: str, seed: int, edits: int) -> str:
    draw = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"edit{draw.randrange(10**6)}"
    return " ".join(words)


def awkward() -> list[tuple]:
    """Nulls in any column, empty, long and short texts, ties, copies, repeated rows and ids; the
    extra columns have names that operators use inside."""
    base, passage = prose(1, 150), prose(2, 70)
    texts = [base, edited(base, 1, 1), edited(base, 2, 3), edited(base, 3, 5), base.upper(), prose(3, 200), prose(3, 200), prose(4, 60) + " " + passage, prose(5, 60) + "\n" + passage + "\tx", passage,
             "", " \n\t ", None, "one", "one", "one two three", "a " * 300, prose(6, 5000), "ends é ß 日本", " nbsp  x\x0by"]
    rows = [(i, t, "en" if i % 3 else None, ("s1", "s2", None)[i % 3] if i % 5 else "s1", len(t) if t else None) for i, t in enumerate(texts)]
    rows += [(0, base, "en", "s1", 3), (None, base, None, None, None), (None, None, "en", "s2", None), (7, prose(9, 90), "en", "s1", 0)]
    return [(*r, 1, 2, "n", "s", "k") for r in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA).repartition(3)
