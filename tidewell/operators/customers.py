"""Customer analysis: segments by recency, frequency and money, cohorts, churn and lifetime value.

Activity is one bitmap of months a customer, built in one pass over the orders; cohorts and churn read
the bitmaps, equal ones counted together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ranks import global_ranks, tile
from tidewell.sources.settled import settle

#: Segments in the order in which they are tried: scores of recency, frequency and money, at least.
SEGMENTS = (
    ("champion", 4, 4, 4), ("loyal", 3, 4, 1), ("big spender", 1, 1, 5), ("new", 5, 1, 1), ("promising", 3, 2, 1), ("lapsing", 2, 1, 1), ("lost", 1, 1, 1),
)
#: Months that one word of a bitmap holds.
WORD = 60


def scores(customers: DataFrame, tiles: int = 5) -> DataFrame:
    """customer_id, recency, frequency, money with r, f and m: quintiles, 5 the best; equal values go by id."""
    out = customers
    for column, name, worst_first in (("recency", "r", F.desc), ("frequency", "f", F.asc), ("money", "m", F.asc)):
        ranked, rows = global_ranks(out, [worst_first(column), F.asc("customer_id")], "_rank")
        out = ranked.withColumn(name, tile(F.col("_rank"), rows, tiles)).drop("_rank")
    return out


def segments(scored: DataFrame) -> DataFrame:
    """Adds the first segment whose least scores a customer reaches."""
    named = F.lit(None).cast("string")
    for segment, r, f, m in reversed(SEGMENTS):
        named = F.when((F.col("r") >= r) & (F.col("f") >= f) & (F.col("m") >= m), segment).otherwise(named)
    return scored.withColumn("segment", named)


@dataclass(frozen=True)
class Months:
    """The months of a table: the first, counted from year 0, and how many."""

    first: int
    number: int

    @property
    def words(self) -> list[str]:
        return [f"_w{k}" for k in range(-(-self.number // WORD))]


def month_number(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day) - 1).cast("int")


def month_text(number: Column) -> Column:
    return F.format_string("%04d-%02d", F.floor(number / 12), number % 12 + 1)


def activity(orders: DataFrame, day: str = "order_date") -> tuple[DataFrame, Months]:
    """A row for each first month and bitmap of active months: first, the bitmap's words, and its customers.
    Bits count from the table's first month, which one aggregate finds; orders without a day or customer don't count."""
    rows = orders.where(F.col(day).isNotNull() & F.col("customer_id").isNotNull())
    ends = rows.agg(F.min(month_number(F.col(day))).alias("low"), F.max(month_number(F.col(day))).alias("high")).first()
    months = Months(ends["low"] or 0, (ends["high"] - ends["low"] + 1) if ends["low"] is not None else 0)
    place = month_number(F.col(day)) - months.first
    words = [F.bit_or(F.when(F.floor(place / WORD) == k, F.expr(f"shiftleft(1L, pmod(_place, {WORD}))")).otherwise(F.lit(0).cast("long"))).alias(w) for k, w in enumerate(months.words)]
    if not words:
        return rows.sparkSession.createDataFrame([], "first int, customers long"), months
    each = rows.withColumn("_place", place).groupBy("customer_id").agg(F.min("_place").alias("first"), *words)
    return settle(each.groupBy("first", *months.words).agg(F.count("*").alias("customers")), "activity"), months


def active_in(place: Column, months: Months) -> Column:
    """Whether the bitmap has the month at this place; False outside the table."""
    word = F.array(*months.words)[F.least(F.greatest(F.floor(place / WORD).cast("int"), F.lit(0)), F.lit(len(months.words) - 1))]
    return (place >= 0) & (place < months.number) & (F.call_function("getbit", word, F.pmod(place, F.lit(WORD)).cast("int")) == 1)


def retention(bitmaps: DataFrame, months: Months) -> DataFrame:
    """cohort (month of the first order), months_later, customers active then, and their share of the cohort."""
    if not months.number:
        return bitmaps.selectExpr("'' as cohort", "0L as months_later", "0L as customers", "0D as share").where("false")
    each = bitmaps.withColumn("later", F.explode(F.sequence(F.lit(0), F.lit(months.number - 1) - F.col("first"))))
    active = F.sum(F.when(active_in(F.col("first") + F.col("later"), months), F.col("customers")).otherwise(0))
    counted = each.groupBy("first", "later").agg(active.alias("active"), F.sum("customers").alias("all"))
    return counted.where("active > 0").select(
        month_text(F.col("first") + months.first).alias("cohort"), F.col("later").cast("long").alias("months_later"), F.col("active").alias("customers"), F.round(F.col("active") / F.col("all"), 6).alias("share")
    )


def churn(bitmaps: DataFrame, months: Months, silent: int = 3) -> DataFrame:
    """Per month: active customers, new ones, returning ones (active before), and churned ones: active
    ``silent`` months ago and not since.  Months without orders have a row as well."""
    if not months.number:
        return bitmaps.selectExpr("'' as month", "0L as active", "0L as new", "0L as returning", "0L as churned").where("false")
    each = bitmaps.withColumn("at", F.explode(F.sequence(F.col("first"), F.lit(months.number - 1))))
    now, fresh = active_in(F.col("at"), months), F.col("at") == F.col("first")
    gone = active_in(F.col("at") - silent, months)
    for k in range(silent):
        gone = gone & ~active_in(F.col("at") - k, months)
    count = lambda condition: F.sum(F.when(condition, F.col("customers")).otherwise(0))
    counted = each.groupBy("at").agg(count(now).alias("active"), count(fresh).alias("new"), count(now & ~fresh).alias("returning"), count(gone).alias("churned"))
    return counted.select(month_text(F.col("at") + months.first).alias("month"), "active", "new", "returning", "churned")


@dataclass(frozen=True)
class PurchaseModel:
    """Orders come at a rate of their own to each customer, and rates follow a gamma distribution of this shape
    and scale (in days); orders' values vary around a customer's mean, and means around the mean of all."""

    shape: float
    days: float
    mean_value: float
    #: How many orders of a customer weigh as much as the mean of all.
    weight: float


def fit(customers: DataFrame, most_steps: int = 60, close: float = 1e-10) -> PurchaseModel:
    """The most likely shape and scale for repeat orders x in age days T, by Newton's method; customers: x, age, n, spent, squares.

    A customer's likelihood is prod(shape + j, j < x) * days ** shape / (days + T) ** (shape + x), but for a
    factor that no parameter changes.  Each step is one aggregate over the counts of (x, T), so only six sums reach
    the driver.  The mean value's weight is the variance within customers over that between them."""
    counts = settle(customers.groupBy("x", "age").agg(F.count("*").alias("customers")), "purchases")
    totals = customers.agg(F.sum("x").alias("x"), F.sum("age").alias("age"), F.sum("n").alias("n"), F.sum("spent").alias("spent"), F.count("*").alias("customers")).first()
    if not totals["customers"] or not totals["x"] or not totals["age"]:
        return PurchaseModel(1.0, 1.0, float(totals["spent"] or 0.0) / max(1, totals["n"] or 0), 1.0)
    n, x, age = (F.col(c) for c in ("customers", "x", "age"))

    def sums(shape: float, days: float) -> dict[str, float]:
        of_each = lambda power: F.expr(f"aggregate(sequence(0, greatest(x, 1) - 1), 0D, (s, j) -> s + if(j < x, power({shape!r}D + j, {power}), 0D))")
        logs = F.expr(f"aggregate(sequence(0, greatest(x, 1) - 1), 0D, (s, j) -> s + if(j < x, ln({shape!r}D + j), 0D))")
        row = counts.agg(
            F.sum(n * (logs + shape * math.log(days) - (x + shape) * F.log(age + days))).alias("value"), F.sum(n * (of_each(-1) + math.log(days) - F.log(age + days))).alias("s"),
            F.sum(n * (shape / days - (x + shape) / (age + days))).alias("d"), F.sum(-n * of_each(-2)).alias("ss"), F.sum(n * (1 / days - 1 / (age + days))).alias("sd"),
            F.sum(n * ((x + shape) / ((age + days) * (age + days)) - shape / days**2)).alias("dd"),
        )
        return row.first().asDict()

    # Newton's steps in the logarithms of both; where the surface is no hill, along the gradient
    u, v = 0.0, math.log(totals["age"] / totals["x"])
    now = sums(math.exp(u), math.exp(v))
    for _ in range(most_steps):
        shape, days = math.exp(u), math.exp(v)
        gu, gv = now["s"] * shape, now["d"] * days
        huu, hvv, huv = now["ss"] * shape**2 + gu, now["dd"] * days**2 + gv, now["sd"] * shape * days
        det = huu * hvv - huv**2
        du, dv = (-(hvv * gu - huv * gv) / det, -(huu * gv - huv * gu) / det) if det > 0 and huu < 0 else (gu / (abs(gu) + abs(gv)), gv / (abs(gu) + abs(gv)))
        scale = min(1.0, 2.0 / max(abs(du), abs(dv), 1e-300))
        du, dv = du * scale, dv * scale
        while True:
            there = sums(math.exp(u + du), math.exp(v + dv))
            if there["value"] >= now["value"] or max(abs(du), abs(dv)) < close:
                break
            du, dv = du / 2, dv / 2
        u, v, gain, now = u + du, v + dv, there["value"] - now["value"], there
        if max(abs(du), abs(dv)) < 1e-7 or abs(gain) < close:
            break
    mean = float(totals["spent"]) / totals["n"]
    spread = customers.agg(
        F.sum(F.col("squares") - F.col("spent") * F.col("spent") / F.col("n")).alias("within"), F.sum(F.col("n") - 1).alias("free"),
        F.sum(F.col("n") * F.pow(F.col("spent") / F.col("n") - mean, 2)).alias("between"), F.sum(F.col("n") * F.col("n")).alias("pairs"),
    ).first()
    within = spread["within"] / spread["free"] if spread["free"] else 0.0
    between = (spread["between"] - (totals["customers"] - 1) * within) / max(1e-9, totals["n"] - spread["pairs"] / totals["n"])
    return PurchaseModel(math.exp(u), math.exp(v), mean, within / between if between > 0 else math.inf)


def purchases(orders: DataFrame, as_of: Column, day: str = "order_date", value: str = "total_due") -> DataFrame:
    """customer_id, n orders, x repeat orders, age in days since the first order, spent and squares of the values."""
    amount = F.col(value).cast("double")
    rows = orders.where(F.col(day).isNotNull() & F.col("customer_id").isNotNull())
    each = rows.groupBy("customer_id").agg(F.count("*").alias("n"), F.datediff(as_of, F.min(day)).alias("age"), F.sum(amount).alias("spent"), F.sum(amount * amount).alias("squares"))
    return each.withColumn("x", F.col("n") - 1)


def lifetime_value(customers: DataFrame, model: PurchaseModel, horizon: int) -> DataFrame:
    """customer_id, orders expected in the next ``horizon`` days, the value expected of an order, and both multiplied."""
    expected = (F.col("x") + model.shape) / (F.col("age") + model.days) * horizon
    value = F.lit(model.mean_value) if math.isinf(model.weight) else (F.col("spent") + model.weight * model.mean_value) / (F.col("n") + model.weight)
    return customers.select("customer_id", "n", "age", expected.alias("expected_orders"), value.alias("expected_value"), (expected * value).alias("lifetime_value"))
