"""Substring dedup against all windows of a small corpus."""

from __future__ import annotations

import hashlib

import numpy as np

from tests.llm.corpus import SCHEMA, awkward, edited, frame, prose
from tidewell.llm import substring_dedup as s
from tidewell.llm.passages import names_of


def brute(rows, n=50):
    owner, out = {}, []
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]
    for i, w in texts:
        for k in range(len(w) - n + 1 if i is not None else 0):
            key = tuple(w[k : k + n])
            owner[key] = min(owner.get(key, i), i)
    for i, w in texts:
        gone = set()
        for k in range(len(w) - n + 1 if i is not None else 0):
            if owner[tuple(w[k : k + n])] < i:
                gone.update(range(k, k + n))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digest(row):
    text = row["kept_text"]
    return row["doc_id"], row["n_words"], row["n_removed"], row["seq"].hex() if text is None else hashlib.sha256(text.encode()).hexdigest()


def test_cover_is_a_difference_cover():
    assert {(a - b) % s.PERIOD for a in s.COVER for b in s.COVER} == set(range(s.PERIOD))


def test_awkward_rows(spark):
    got = s.dedup(frame(spark)).collect()
    assert sorted(map(digest, got), key=str) == brute(awkward())


def test_passages_at_every_alignment(spark):
    passage = prose(7, 50)
    rows = [(i, f"{prose(500 + i, i)} {passage} {prose(600 + i, 3 + i % 7)}") for i in range(70)]
    rows += [(100 + i, f"{prose(700 + i, 5)} {' '.join(passage.split()[:49])} {prose(800 + i, 5)}") for i in range(5)]
    rows += [(200 + i, edited(rows[3][1] + " " + prose(8, 200), i, 2)) for i in range(30)]
    rows = [(*r, None, None, None, 0, 0, "", "", "") for r in rows]
    got = s.dedup(frame(spark, rows)).collect()
    assert sorted(map(digest, got), key=str) == brute(rows)


def test_empty_table(spark):
    assert s.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_hashes_of_other_words(spark):
    """Contexts go by the 128-bit hash of their words: equal ranks alone, here of all windows, remove nothing."""
    words = [b"w%d" % i for i in range(400)]
    same = np.zeros(len(words) - s.ANCHOR + 1, dtype=np.uint64)
    low, high, rank, place = s.stretches(np.arange(len(words) - s.WINDOW + 1), same)
    assert (rank == 0).all() and low[0] == 0 and high[-1] == len(words) - s.WINDOW and (low[1:] == high[:-1] + 1).all() and (place >= high).all()
    texts = {i: b" ".join([b"t%d" % i] * 6 + words[:60]) for i in range(4)} | {9: b" ".join(words[2:62] + [b"x"] * 6)}
    part = lambda i, low, high: b" ".join(texts[i].split()[low : high + s.WINDOW])
    # windows 8 to 16 of text i are windows 0 to 8 of text 9, and all contexts have one rank
    name = lambda string: (int(x[0]) for x in names_of([string]))
    rows = [(i, i, 0, *name(part(i, 0, 12)), 0, 12, 12) for i in range(4)] + [(9, 9, 0, *name(part(9, 0, 11)), 0, 11, 4)]
    contexts = spark.createDataFrame(rows, s.CONTEXT_SQL)
    candidates = spark.createDataFrame([(i, i, t.decode()) for i, t in texts.items()], "doc_id long, cid long, text string")
    gone = {(r["cid"], at) for r in s.earlier(contexts, candidates, s._STRINGS).collect() for at in range(r["low"], r["high"] + 1)}
    assert gone == {(i, at) for i in (1, 2, 3) for at in range(6, 13)} | {(9, at) for at in range(5)}
