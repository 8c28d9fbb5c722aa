"""Runs against all lags and all stretches of short texts, splitting against recounting, and hostile texts."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from tests.llm.corpus import SCHEMA, awkward, frame, prose
from tidewell.llm import periodic_runs as p


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(r for r in out if not any(q < r[2] and s <= r[0] and r[0] + r[1] <= s + n for s, n, q in out))


def brute(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        q = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[a + (i - a) % q] if i >= a else x for i, x in enumerate(w)]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = (None,) * 4
    if found:
        s, n, q = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = s, n, q, 1000 * n // q
    digests = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode(), b" ".join(x for i, x in enumerate(w) if i not in gone)
    return doc_id, len(found), *best, *(hashlib.sha256(x).hexdigest() for x in digests)


def drawn(seed, most=150):
    draw = random.Random(seed)
    n, v = draw.randrange(most), draw.choice([1, 2, 3, 5, 30])
    words = [b"%d" % draw.randrange(v) for _ in range(n)]
    for _ in range(draw.randrange(4) if n > 30 else 0):
        a, q = draw.randrange(n), draw.randrange(1, 20)
        for i in range(a, min(n, a + draw.randrange(10, 90))):
            words[i] = words[a + (i - a) % q]
    return words


def test_runs_of_drawn_texts():
    for seed in range(1500):
        words = drawn(seed)
        assert p.runs(words) == brute_runs(words), seed


def recounted(codes):
    alive = np.ones(len(codes), dtype=bool)
    while True:
        part, before = np.cumsum(~alive), alive.sum()
        count = {}
        for i in np.flatnonzero(alive).tolist():
            count.setdefault((part[i], codes[i]), []).append(i)
        for places in count.values():
            if len(places) < 3:
                alive[places] = False
        if alive.sum() == before:
            return alive


def test_splitting_by_passes_and_by_single_splits():
    """Both ways of splitting leave the same words.  A word counts as rare where no three occurrences in a row
    share a segment, so that is what recounting the segments gives."""
    for seed in range(400):
        codes = np.array(drawn(seed, 120), dtype=np.int64)
        assert (p.split_rare(codes) == recounted(codes)).all(), seed
        assert (p.split_rare(codes, passes=0) == recounted(codes)).all(), seed
        assert (p.split_rare(codes, passes=1) == recounted(codes)).all(), seed


def test_a_chain_of_splits():
    """Each split makes one more word rare: a pass a split would be quadratic."""
    words = [x for k in range(40_000) for x in (k + 1, k, k + 1)] + [40_000]
    codes = np.array(words, dtype=np.int64)
    assert not p.split_rare(codes).any()


def test_long_hostile_texts():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 50_000:
        a, b = b, b + a
    assert all(n >= 3 * q for _, n, q in p.runs(b))
    assert p.runs([b"x"] * 200_000) == [(0, 200_000, 1)]
    assert p.runs([b"%d" % (i % 40_000) for i in range(150_000)]) == [(0, 150_000, 40_000)]
    thue = np.array([bin(i).count("1") % 2 for i in range(1 << 15)])
    assert p.runs([b"%d" % x for x in thue.tolist()]) == []


def test_equal_hashes_of_other_words(spark, monkeypatch):
    """Hashes only propose: with one hash for all words the results are the same."""
    monkeypatch.setattr(p, "mix", lambda x: np.zeros(len(x), dtype=np.uint64))
    for seed in range(100):
        words = drawn(seed, 90)
        assert p.runs(words) == brute_runs(words), seed


def rows_of(df):
    out = p.find_runs(df, plant=True)
    best = [out["best"][k].alias(name) for k, name in enumerate(("start", "length", "period"))]
    got = []
    for r in out.select("doc_id", "runs", *best, "runs_sha256", "collapsed").collect():
        milli = None if r["start"] is None else 1000 * r["length"] // r["period"]
        got.append((r["doc_id"], len(r["runs"]), r["start"], r["length"], r["period"], milli, r["runs_sha256"], hashlib.sha256(r["collapsed"]).hexdigest()))
    return sorted(got, key=str)


def test_awkward_rows(spark):
    assert rows_of(frame(spark)) == sorted((brute(r[0], r[1]) for r in awkward()), key=str)


def test_planted_ends_ties_and_unplanted(spark):
    rows = [(i, prose(i, 40 + i % 50) if i % 3 else "a b " * 15 + prose(i, 9) + " c d" * 15) for i in range(150)]
    rows = [(*r, None, None, 0, 0, 0, "", "", "") for r in rows]
    got = rows_of(frame(spark, rows))
    assert got == sorted((brute(r[0], r[1]) for r in rows), key=str) and sum(g[1] > 0 for g in got) > 50
    plain = p.find_runs(frame(spark, rows)).where("n_words > 0").collect()
    assert all([tuple(x) for x in r["runs"]] == brute_runs(rows[r["doc_id"]][1].encode().split()) for r in plain)


def test_empty_table(spark):
    assert p.find_runs(spark.createDataFrame([], SCHEMA)).count() == 0
