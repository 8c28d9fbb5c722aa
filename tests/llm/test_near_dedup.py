"""Near-duplicates against all pairs of a small corpus."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np

from tests.llm.corpus import SCHEMA, awkward, edited, frame, prose
from tidewell.llm import near_dedup
from tidewell.llm.components import components


def sets_of(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of every row, from all pairs of distinct sets."""
    found = [(r[0], sets_of(r[1])) for r in rows]
    nodes = sorted({s for i, s in found if s and i is not None}, key=sorted)
    parent = {s: s for s in nodes}

    def top(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for x, y in combinations(nodes, 2):
        if 100 * len(x & y) >= 75 * len(x | y):
            parent[top(x)] = top(y)
    least = {}
    for i, s in found:
        if s and i is not None:
            least[top(s)] = min(least.get(top(s), i), i)
    out = []
    for i, s in found:
        c = least[top(s)] if s and i is not None else i
        out.append((i, len(s), c, i is None or i == c))
    return sorted(out, key=str)


def test_awkward_rows(spark):
    got = near_dedup.near_duplicates(frame(spark)).collect()
    assert sorted(map(tuple, got), key=str) == brute(awkward())


def test_chains_and_large_groups_of_near_copies(spark):
    """Copies with one to eight edits: many pairs near the threshold, and links that only chains make."""
    draw, rows = random.Random(5), []
    for g in range(3):
        base = prose(100 + g, 150)
        for k in range(60):
            rows.append((len(rows), edited(base, 1000 * g + k, draw.randrange(0, 9)), None, None, None, 0, 0, "", "", ""))
    walk = prose(200, 150)
    for k in range(20):
        walk = edited(walk, 50 + k, 1)
        rows.append((len(rows), walk, None, None, None, 0, 0, "", "", ""))
    rows += [(len(rows) + i, prose(300, 80) + " " + prose(400 + i, 60), None, None, None, 0, 0, "", "", "") for i in range(40)]
    got = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_null_id_before_the_only_copy_in_its_task(spark):
    rows = [(None, prose(1, 60)), (1, prose(1, 60)), (2, prose(2, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_table(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_keep_first_keeps_columns(spark):
    docs = frame(spark)
    kept = near_dedup.keep_first(docs)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} >= {0, 5, 10, 11, 12, 17, None}
    assert 6 not in {r["doc_id"] for r in kept.collect()}


def test_keep_first_decides_by_row(spark):
    """Two sets share an id, an exact row repeats; copies without an id go, and one of them stays if there is no other."""
    a, b, c, d = (prose(k, 60) for k in range(1, 5))
    rows = [(7, a), (7, b), (3, b), (9, a), (5, c), (5, c), (None, c), (None, d), (None, d), (None, edited(d, 1, 1)), (None, None), (None, "")]
    kept = near_dedup.keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    kept = [tuple(r) for r in kept]
    last = [r for r in kept if r[0] is None and r[1]]
    assert len(last) == 1 and last[0][1] in (d, edited(d, 1, 1))
    assert sorted(set(kept) - set(last), key=str) == sorted([(7, a), (3, b), (5, c), (None, None), (None, "")], key=str)


def test_registers_merge_and_estimate():
    draw = np.random.default_rng(3)
    pool = draw.integers(0, 2**63, 3000).astype(np.uint64)
    x, y = pool[:2000], pool[500:2500]
    merged = np.maximum(near_dedup.registers(x), near_dedup.registers(y))
    assert (merged == near_dedup.registers(np.union1d(x, y))).all()
    first, second = near_dedup.registers(x)[None], near_dedup.registers(y)[None]
    got = near_dedup.joint_estimate(first, second, np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(got - 1500 / 2500) < 0.15


def test_odd_sketches_bound_differences():
    """Whole or folded, they never count more than the sets differ by, and whole ones come close to it."""
    draw = np.random.default_rng(4)
    for n, same in ((150, 130), (3000, 2400), (3000, 100), (40, 40)):
        pool = draw.integers(0, 2**63, 2 * n).astype(np.uint64)
        x, y = np.sort(pool[:n]), np.sort(np.concatenate([pool[:same], pool[n : 2 * n - same]]))
        a, b = (np.frombuffer(near_dedup.odd_sketch(s, 1 << 15), dtype=np.uint64)[None] for s in (x, y))
        apart, folds = (int(np.bitwise_count(f(a) ^ f(b)).sum()) for f in (lambda s: s, near_dedup.folded))
        assert folds <= apart <= 2 * (n - same) and apart >= 0.8 * 2 * (n - same)
        assert (near_dedup.folded(a)[0] == np.frombuffer(near_dedup.odd_sketch(x, 1 << 12), dtype=np.uint64)).all()


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 4), (20, 21), (22, 21), (30, 30)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 9: 1, 20: 20, 21: 20, 22: 20}


def components_of(rows):
    """component_id by doc_id from all pairs, for large tables: the intersections are one matrix product."""
    sets = [sets_of(r[1]) for r in rows]
    times = Counter(s for found in sets for s in found)
    column = {s: k for k, s in enumerate(s for s, n in times.items() if n > 1)}
    known = np.zeros((len(rows), len(column)), dtype=np.float32)
    for k, found in enumerate(sets):
        known[k, [column[s] for s in found if s in column]] = 1
    sizes = np.array([len(s) for s in sets])
    both = np.rint(known @ known.T)
    linked = 100 * both >= 75 * (sizes[:, None] + sizes[None] - both)
    least = np.arange(len(rows))
    while True:
        now = np.where(linked, least[None], len(rows)).min(axis=1)
        if (now == least).all():
            return [rows[k][0] for k in now]
        least = now


def modular(n, seed=11):
    """Pages of one template: three quarters of the words are shared, and each has five sections of a pool
    of 100, so that most pairs are at a similarity of 0.55 to 0.74."""
    draw = random.Random(seed)
    head, pool = prose(900, 450, 10**6), [prose(901 + k, 30, 10**6) for k in range(100)]
    return [(k, head + " " + " ".join(pool[s] for s in sorted(draw.sample(range(100), 5))), None, None, None, 0, 0, "", "", "") for k in range(n)]


def test_modular_templates(spark, monkeypatch):
    """Links are found without verifying the pairs of a group, by blocks of any size."""
    verified, linked = [], near_dedup._linked

    def counted(pairs, sets):
        pairs = near_dedup.settle(pairs, "counted")
        verified.append(pairs.count())
        return linked(pairs, sets)

    monkeypatch.setattr(near_dedup, "_linked", counted)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 1 << 18)
    rows = modular(2000)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    want = components_of(rows)
    assert [got[r[0]] for r in rows] == want and len(set(want)) < len(rows)
    stars, seconds, rest = verified
    assert stars + seconds < 10 * len(rows) and rest < len(rows), verified
