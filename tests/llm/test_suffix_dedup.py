"""Suffix dedup against all 100-byte strings of a small corpus."""

from __future__ import annotations

import hashlib
import random

import numpy as np

from tests.llm.corpus import SCHEMA, awkward, edited, frame, prose
from tidewell.llm import suffix_dedup as s


def brute(rows):
    n, first = s.MATCH, {}
    texts = [(k, i, (t or "").encode()) for k, (i, t) in enumerate(rows)]
    for _, i, t in texts:
        for at in range(len(t) - n + 1 if i is not None else 0):
            key = t[at : at + n]
            first[key] = min(first.get(key, i), i)
    out = []
    for _, i, t in texts:
        own, gone = set(), bytearray(len(t))
        for at in range(len(t) - n + 1):
            key = t[at : at + n]
            if key in own or (i is not None and first[key] < i):
                gone[at : at + n] = b"\1" * n
            own.add(key)
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        spans = len([p for p in bytes(gone).split(b"\0") if p])
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    rows = []
    for r in s.dedup(df).collect():
        rows.append((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["seq"].hex() if r["kept"] is None else hashlib.sha256(r["kept"]).hexdigest()))
    return sorted(rows, key=str)


def rows_of(texts):
    return [(i, t, None, None, 0, 0, 0, "", "", "") for i, t in texts]


def test_samples_depend_on_the_string_alone(monkeypatch):
    draw = random.Random(1)
    for block in (s.BLOCK, 64, 7):
        monkeypatch.setattr(s, "BLOCK", block)
        chosen = {}
        for _ in range(20):
            text = bytes(draw.choice(b"ab") for _ in range(draw.randrange(400)))
            first, last, ranks, places = s.samples(text)
            assert ((places >= last) & (places < first + s.REACH)).all()
            assert s._all_starts(first, last).tolist() == list(range(max(0, len(text) - s.MATCH + 1)))
            for low, high, rank in zip(first.tolist(), last.tolist(), ranks.tolist(), strict=True):
                for at in range(low, high + 1):
                    assert chosen.setdefault(text[at : at + s.MATCH], rank) == rank


def test_own_repeats_survive_equal_hashes(monkeypatch):
    monkeypatch.setattr(s, "_BYTES", np.zeros(256, dtype=np.uint64))
    text = (prose(1, 40) + prose(2, 40) + prose(1, 40)).encode()
    seen, want = set(), []
    for at in range(len(text) - s.MATCH + 1):
        if text[at : at + s.MATCH] in seen:
            want.append(at)
        seen.add(text[at : at + s.MATCH])
    assert s._own_repeats(text, np.arange(len(text) - s.MATCH + 1)).tolist() == want and want


def test_awkward_rows(spark):
    assert got(frame(spark)) == brute([r[:2] for r in awkward()])


def test_passages_of_every_length_and_place(spark):
    passage, draw = prose(7, 60), random.Random(2)
    texts = [(i, f"{prose(500 + i, 20)[: draw.randrange(90)]}{passage[: 90 + i % 25]}{prose(600 + i, 20)[: draw.randrange(90)]}") for i in range(60)]
    texts += [(100 + i, passage[i : i + 99] + "é" * (i % 3) + passage[i : i + 100]) for i in range(0, 60, 3)]
    texts += [(200 + i, edited(texts[3][1] + " " + prose(8, 200), i, 2)) for i in range(20)]
    texts += [(300 + i, "ab" * 90 + "a" * (95 + i) + prose(i, 3)) for i in range(8)] + [(400, ""), (401, "é" * 49), (402, "é" * 50), (403, "é" * 51), (404, "é" * 50)]
    texts += [(500, texts[5][1]), (501, texts[5][1]), (500, texts[6][1]), (None, passage + passage), (None, texts[5][1])]
    assert got(frame(spark, rows_of(texts))) == brute(texts)


def test_long_texts(spark):
    """Passages over the edges of blocks, and a text of one letter."""
    long = prose(1, 30_000)
    assert len(long) > 2 * s.BLOCK
    texts = [(1, long[: s.BLOCK + 500]), (2, "x" + long), (3, prose(2, 10) + long[s.BLOCK - 60 : s.BLOCK + 60] + prose(3, 10)), (4, "a" * 90_000), (5, "b" + "a" * 120)]
    assert got(frame(spark, rows_of(texts))) == brute(texts)


def test_empty_table(spark):
    assert s.dedup(spark.createDataFrame([], SCHEMA)).count() == 0
