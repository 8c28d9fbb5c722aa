"""The calendar's weeks and holidays, from SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Holidays by month and day, and by days from Easter Sunday.
FIXED = {"New Year": (1, 1), "Labour Day": (5, 1), "Christmas Day": (12, 25), "Second Christmas Day": (12, 26)}
MOVABLE = {"Good Friday": -2, "Easter Monday": 1, "Ascension Day": 39, "Whit Monday": 50}


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year: the Sunday after the first ecclesiastical full moon of spring."""
    whole = lambda x: F.floor(x).cast("int")
    golden, century = year % 19, whole(year / 100)
    # the moon's age on the first of March, with the centuries' leap days and the moon's own drift taken out
    epact = (whole(century / 4) + whole((8 * century + 13) / 25) - century + 11 * golden + 8) % 30
    epact = F.pmod(epact, F.lit(30))
    late = F.when((epact == 24) | ((epact == 25) & (golden > 10)), epact + 1).otherwise(epact)  # two moons of 29 days
    moon = F.when(late < 24, 44 - late).otherwise(74 - late)  # days from the first of March, from 1
    full = F.date_add(F.make_date(year, F.lit(3), F.lit(1)), moon - 1)
    return F.next_day(full, "Sunday")


def with_holidays(dates: DataFrame) -> DataFrame:
    """Adds the ISO week, is_holiday and the holiday's name (of two on one day the first by name, else NULL)."""
    day, spring = F.col("full_date"), easter(F.year("full_date"))
    named = [F.when((F.month(day) == m) & (F.dayofmonth(day) == d), n) for n, (m, d) in FIXED.items()]
    named += [F.when(day == F.date_add(spring, shift), n) for n, shift in MOVABLE.items()]
    holiday = F.array_min(F.array_compact(F.array(*named)))
    return dates.withColumns({"week": F.weekofyear(day).cast("bigint"), "is_holiday": holiday.isNotNull(), "holiday": holiday})
