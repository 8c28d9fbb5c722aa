"""Mixing: targets by resharing step by step, words taken, the schedule's evenness."""

from __future__ import annotations

from collections import defaultdict

from tests.llm.corpus import SCHEMA, awkward, frame, prose
from tidewell.llm import mixing


def size(text):
    return len((text or "").encode().split())


def brute_targets(rows, weights=(1, 2, 3), most=3):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, total = dict.fromkeys(names, 0.0), sum(sizes.values())
    while True:
        free = [s for s in names if target[s] < most * sizes[s]]
        left = total - sum(target[s] for s in names if s not in free)
        if not free:
            return target, sizes
        share = {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        for s in over or free:
            target[s] = most * sizes[s] if over else share[s]
        if not over:
            return target, sizes


def check(rows, got):
    target, sizes = brute_targets(rows)
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1


def test_awkward_rows(spark):
    check(awkward(), mixing.mix(frame(spark)).collect())


def test_hot_source_and_caps(spark):
    rows = [(i, prose(i, 5 + i % 40), None, "hot" if i % 3 else f"s{i % 11}", 0, 0, 0, "", "", "") for i in range(600)]
    rows += [(1000, prose(1, 3), None, "tiny", 0, 0, 0, "", "", ""), (1001, "", None, "void", 0, 0, 0, "", "", "")]
    docs = frame(spark, rows)
    first = mixing.mix(docs).collect()
    check(rows, first)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_schedule_spreads_sources(spark):
    rows = [(i, prose(i, 300), None, f"s{i % 3}", 0, 0, 0, "", "", "") for i in range(240)]
    mixed, sized, sources = mixing.stream(frame(spark, rows), block=64)
    order = {r["slot"]: r["source"] for r in mixed.join(sized, "row").select("slot", "source").distinct().collect()}
    slots = sorted(order)
    shares = {r["source"]: r["n_slots"] for r in sources.collect()}
    for at in range(0, len(slots) - 120, 60):
        part = [order[s] for s in slots[at : at + 120]]
        for name, n in shares.items():
            assert abs(part.count(name) - 120 * n / sum(shares.values())) < 6


def test_empty_and_wordless(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, None, "a", 0, 0, 0, "", "", ""), (2, " ", None, None, 0, 0, 0, "", "", "")]
    assert {r["taken"] for r in mixing.mix(frame(spark, rows)).collect()} == {0}


def test_mixed_documents_keep_columns(spark):
    out = mixing.mixed_documents(frame(spark))
    assert {"doc_id", "text", "node", "taken"} <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    assert out.where("taken = 0").count() == 0


def test_one_source_over_many_levels(spark, monkeypatch):
    """Tiny ranges, chunks and fans give four levels of sums, and the same words as a plan of one level."""
    rows = [(i, prose(i, 1 + i % 60), None, "only", 0, 0, 0, "", "", "") for i in range(700)]
    rows += [(1000 + i, prose(i, 30), None, "b", 0, 0, 0, "", "", "") for i in range(40)]
    docs = frame(spark, rows)
    want = sorted(map(tuple, mixing.mix(docs).collect()))
    for name, value in {"_CHUNK": 4, "_RANGE_ROWS": 12, "_FAN": 4}.items():
        monkeypatch.setattr(mixing, name, value)
    got = mixing.mix(docs).collect()
    check(rows, got)
    assert sorted(map(tuple, got)) == want


def test_offsets(spark):
    rows = [(s, p, 1 + (7 * p + s) % 5) for s in (0, 3) for p in range(0, 1000, 3)]
    sums = spark.createDataFrame(rows, "sid long, place long, n long")
    got = {(r["sid"], r["place"]): r["offset"] for r in mixing.offsets(sums, "place", 999).collect()}
    assert got == {(s, p): sum(n for t, q, n in rows if t == s and q < p) for s, p, _ in rows}


def test_many_null_and_repeated_ids(spark, monkeypatch):
    """Half the ids are null, a sixth are one id, and a third of all rows are equal: ranges stay small."""
    monkeypatch.setattr(mixing, "_RANGE_ROWS", 100)
    seen = []

    def settled(df, name, before=mixing.settle):
        seen.append((name, before(df, name)))
        return seen[-1][1]

    monkeypatch.setattr(mixing, "settle", settled)
    rows = [((None, i, None, 7, None, i)[i % 6], "same words again" if i % 3 == 0 else prose(i, 3 + i % 20), None, "hot" if i % 4 else "cold", 0, 0, 0, "", "", "") for i in range(3000)]
    got = mixing.mix(frame(spark, rows)).collect()
    check(rows, got)
    again = mixing.mix(frame(spark, rows[::-1])).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    sizes = [r["count"] for name, df in seen if name == "ranges" for r in df.groupBy("sid", "range").count().collect()]
    assert max(sizes) < 400


def test_many_sources(spark):
    """More sources than cells of the guide, nearly all of them tiny."""
    rows = [(i, prose(i, 4), None, f"s{i}" if i % 2 else "hot", 0, 0, 0, "", "", "") for i in range(5000)]
    check(rows, mixing.mix(frame(spark, rows)).collect())
