"""Column functions of the sales engine: conversions that fail to NULL, text cleaning, hashes, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(19,4)"


def to_date(column: Column, formats: tuple[str, ...] = ("yyyy-MM-dd",)) -> Column:
    """A date by the first format that fits, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(column, F.lit(f)).cast("date") for f in formats])


def to_number(column: Column, kind: str = MONEY) -> Column:
    """A decimal, else NULL; infinities and NaN are no numbers."""
    return column.cast("string").try_cast(kind)


def is_whole(column: Column) -> Column:
    """True for numbers without a fraction, NULL for what is no number."""
    number = to_number(column, "decimal(28,8)")
    return number == F.floor(number)


def strip(column: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def is_blank(column: Column) -> Column:
    return column.isNotNull() & (strip(column.cast("string")) == "")


def full_name(first: Column, last: Column) -> Column:
    return strip(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))))


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def record_hash(columns: list[str]) -> Column:
    r"""SHA-256 of the columns in name order; NULL is \N, so it differs from an empty text."""
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(r"\N")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("\x1f", *values), 256)


def money(ten_thousandths: Column) -> Column:
    """A DECIMAL(19,4) from a whole number of ten-thousandths, without a rounded double on the way."""
    return (ten_thousandths.cast("decimal(15,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast(MONEY)


def ratio(above: Column, below: Column) -> Column:
    """above / below as doubles; 0.0 where below is 0 or NULL."""
    bottom = below.cast("double")
    return F.when(F.coalesce(bottom, F.lit(0.0)) == 0.0, F.lit(0.0)).otherwise(above.cast("double") / bottom)
