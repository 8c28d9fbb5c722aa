"""Customer analysis on small tables: ranks, bitmaps over many months, and the fit against a brute-force one."""

from __future__ import annotations

import datetime
import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidewell.operators import customers as c
from tidewell.operators.ranks import global_ranks, tile


def test_tiles_are_those_of_ntile(spark):
    for n in (0, 1, 3, 5, 7, 23, 100):
        rows = spark.createDataFrame([(i, (i * 7) % 4) for i in range(n)], "id long, v long").repartition(3)
        ranked, total = global_ranks(rows, [F.asc("v"), F.asc("id")], "rank")
        got = sorted((r["rank"], r["v"], r["id"], r["t"]) for r in ranked.withColumn("t", tile(F.col("rank"), total, 5)).collect())
        ordered = sorted((v, i) for i, v in ((i, (i * 7) % 4) for i in range(n)))
        want, at = [], 0
        for t in range(5):
            for _ in range(n // 5 + (t < n % 5)):
                want.append((at, *ordered[at], t + 1))
                at += 1
        assert total == n and got == want


def test_scores_and_segments(spark):
    rows = spark.createDataFrame([(i, i % 10, i % 3, i * 1.5) for i in range(1, 41)], "customer_id long, recency long, frequency long, money double")
    got = {r["customer_id"]: r for r in c.segments(c.scores(rows)).collect()}
    assert len(got) == 40 and all(r["segment"] for r in got.values())
    assert got[40]["m"] == 5 and got[1]["m"] == 1 and got[10]["r"] == 5 and got[9]["r"] == 1
    first = {s: next(i for i, x in enumerate(c.SEGMENTS) if x[0] == s) for s in {r["segment"] for r in got.values()}}
    for r in got.values():
        assert [r[k] >= least for k, least in zip("rfm", c.SEGMENTS[first[r["segment"]]][1:], strict=True)] == [True] * 3


def orders(spark, rows):
    return spark.createDataFrame([(k, datetime.date(y, m, 5) if y else None) for k, y, m in rows], "customer_id long, order_date date")


def test_bitmaps_longer_than_a_word(spark):
    """150 months need three words; nulls don't count, and repeated orders count once."""
    draw = random.Random(4)
    rows = [(k, 1995 + m // 12, m % 12 + 1) for k in range(30) for m in draw.sample(range(150), draw.randrange(1, 12))]
    rows += [(0, 1995, 1), (1, 2007, 6), (None, 1980, 1), (3, None, None), *rows[:9]]
    bitmaps, months = c.activity(orders(spark, rows))
    assert months.number == 150 and len(months.words) == 3
    active = {}
    for k, y, m in rows:
        if k is not None and y:
            active.setdefault(k, set()).add((y - 1995) * 12 + m - 1)
    text = lambda m: f"{1995 + m // 12:04d}-{m % 12 + 1:02d}"
    want = {}
    for months_of in active.values():
        for m in months_of:
            key = (text(min(months_of)), m - min(months_of))
            want[key] = want.get(key, 0) + 1
    got = c.retention(bitmaps, months).collect()
    assert {(r["cohort"], r["months_later"]): r["customers"] for r in got} == want
    assert all(r["share"] == round(r["customers"] / want[(r["cohort"], 0)], 6) for r in got)
    lost = {r["month"]: tuple(r)[1:] for r in c.churn(bitmaps, months).collect()}
    for m in range(150):
        on = [s for s in active.values() if m in s]
        gone = [s for s in active.values() if m - 3 in s and not {m - 2, m - 1, m} & s]
        assert lost[text(m)] == (len(on), sum(min(s) == m for s in on), sum(min(s) < m for s in on), len(gone))


def test_no_orders(spark):
    bitmaps, months = c.activity(orders(spark, [(None, 1990, 1)]))
    assert c.retention(bitmaps, months).count() == 0 and c.churn(bitmaps, months).count() == 0
    empty = c.purchases(spark.createDataFrame([], "customer_id long, order_date date, total_due double"), F.lit("2000-01-01").cast("date"))
    assert c.lifetime_value(empty, c.fit(empty), 30).count() == 0


def likelihood(shape, days, x, age):
    return sum(sum(math.log(shape + j) for j in range(n)) + shape * math.log(days) - (shape + n) * math.log(days + t) for n, t in zip(x, age, strict=True))


def test_fit_finds_the_most_likely_model(spark):
    draw = np.random.default_rng(8)
    ages = draw.integers(30, 2000, 800)
    x = draw.poisson(draw.gamma(1.7, 1 / 420.0, 800) * ages)
    rows = []
    for k, (n, age) in enumerate(zip(x.tolist(), ages.tolist(), strict=True)):
        mean = draw.normal(100, 10)
        values = draw.normal(mean, 20, n + 1)
        rows.append((k, n + 1, n, age, float(values.sum()), float((values**2).sum())))
    known = spark.createDataFrame(rows, "customer_id long, n long, x long, age int, spent double, squares double").repartition(4)
    model = c.fit(known)
    best = likelihood(model.shape, model.days, x.tolist(), ages.tolist())
    # no point of a fine grid around it, nor of a coarse one everywhere, is more likely
    near = [(model.shape * (1 + a), model.days * (1 + b)) for a in (-0.01, 0, 0.01) for b in (-0.01, 0, 0.01) if a or b]
    far = [(s, d) for s in (0.2, 0.5, 1, 2, 4, 8) for d in (20, 100, 400, 1000, 4000)]
    assert all(likelihood(s, d, x.tolist(), ages.tolist()) < best for s, d in near + far)
    assert 1.2 < model.shape < 2.4 and 280 < model.days < 620
    assert abs(model.mean_value - 100) < 2 and 1.5 < model.weight < 12  # 20 ** 2 / 10 ** 2 = 4
    got = {r["customer_id"]: r for r in c.lifetime_value(known, model, 365).collect()}
    for k, n, repeats, age, spent, _ in rows[:50]:
        expected = (repeats + model.shape) / (age + model.days) * 365
        value = (spent + model.weight * model.mean_value) / (n + model.weight)
        assert math.isclose(got[k]["expected_orders"], expected) and math.isclose(got[k]["lifetime_value"], expected * value)


def test_one_rate_for_all(spark):
    """Without repeat orders, or without spread between customers, the fit still gives numbers."""
    once = spark.createDataFrame([(1, 1, 0, 10, 5.0, 25.0), (2, 1, 0, 20, 7.0, 49.0)], "customer_id long, n long, x long, age int, spent double, squares double")
    assert all(math.isfinite(r["lifetime_value"]) for r in c.lifetime_value(once, c.fit(once), 30).collect())
    alike = spark.createDataFrame([(k, 11, 10, 1000, 110.0, 1100.0) for k in range(50)], "customer_id long, n long, x long, age int, spent double, squares double")
    for r in c.lifetime_value(alike, c.fit(alike, most_steps=25), 100).collect():
        assert abs(r["expected_orders"] - 1.0) < 0.05 and abs(r["expected_value"] - 10.0) < 1e-6
