"""Row quality: split into valid and rejected rows, deduplication, profiles, orphans."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.columns import is_blank, is_whole, record_hash, to_date, to_number


class ContractError(ValueError):
    """A table breaks what its contract promises."""


@dataclass(frozen=True)
class ConversionRules:
    """Columns that must convert where they are not NULL; checked in this order."""

    dates: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()


def conversion_reasons(rules: ConversionRules, columns: list[str]) -> Column:
    """The failed conversions of a row, joined by '; ' (empty: none); rules for absent columns rest."""
    checks: list[tuple[str, Column]] = []
    checks += [(f"invalid date: {c}", F.col(c).isNotNull() & to_date(F.col(c)).isNull()) for c in rules.dates if c in columns]
    checks += [(f"invalid numeric: {c}", F.col(c).isNotNull() & to_number(F.col(c)).isNull()) for c in rules.numbers if c in columns]
    checks += [(f"invalid integer: {c}", F.col(c).isNotNull() & ~F.coalesce(is_whole(F.col(c)), F.lit(False))) for c in rules.integers if c in columns]
    checks += [(f"blank string: {c}", is_blank(F.col(c))) for c in rules.texts if c in columns]
    if not checks:
        return F.lit("")
    return F.array_join(F.array_compact(F.array(*[F.when(failed, F.lit(reason)) for reason, failed in checks])), "; ")


def with_reasons(df: DataFrame, rules: ConversionRules) -> DataFrame:
    return df.withColumn("rejection_reason", conversion_reasons(rules, df.columns))


def valid_rows(df: DataFrame, rules: ConversionRules) -> DataFrame:
    return with_reasons(df, rules).where("rejection_reason = ''").drop("rejection_reason")


def rejected_rows(df: DataFrame, rules: ConversionRules, key: str) -> DataFrame:
    """record_key and rejection_reason; the payload stays out of the quarantine."""
    return with_reasons(df, rules).where("rejection_reason <> ''").select(F.col(key).cast("string").alias("record_key"), "rejection_reason")


def null_key_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows without a primary key, named by their record hash."""
    return df.where(F.col(key).isNull()).select(F.col("_record_hash").alias("record_key"), F.lit(f"NULL primary key: {key}").alias("rejection_reason"))


def dedup_latest(df: DataFrame, key: str) -> DataFrame:
    """Per key the row of the latest load date, then of the greatest record hash; NULLs come last."""
    place = Window.partitionBy(key).orderBy(F.col("_load_date").desc_nulls_last(), F.col("_record_hash").desc_nulls_last())
    return df.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def with_signature(df: DataFrame, key: str) -> DataFrame:
    """Adds the hash of all columns but the key."""
    return df.withColumn("_signature", record_hash([c for c in df.columns if c != key]))


def dedup_by_signature(df: DataFrame, key: str, signature: str | None = None, dealt: str | None = None) -> DataFrame:
    """The cleaners' rule: the latest load date, then the least signature of all columns but the key.
    Winners of parts, kept with their signatures, give the winner of the whole.  dealt: a column that follows
    from the key and by which the rows are dealt already, so that they are not shuffled again."""
    least = F.col(signature) if signature else record_hash([c for c in df.columns if c != key])
    place = Window.partitionBy(*filter(None, (dealt, key))).orderBy(F.col("_load_date").desc_nulls_last(), least.asc())
    return df.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def first_per_key(df: DataFrame, key: str) -> DataFrame:
    """The dimensions' rule: per key the least row over all columns, NULLs last."""
    place = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in df.columns])
    return df.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    return df.agg((F.count(key) - F.count_distinct(key)).alias("duplicate_keys"))


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key is not NULL and names no parent."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_parent"), "left_anti")


def profile_nulls(df: DataFrame) -> DataFrame:
    """Per column: NULLs and their percentage of the rows (0.0 if there are none), from one pass."""
    names = df.columns
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in names]))
    out = counts.select("_rows", pairs.alias("p")).select("p.column_name", "p.null_count", "_rows")
    percent = F.when(F.col("_rows") == 0, 0.0).otherwise(F.round(100.0 * F.col("null_count") / F.col("_rows"), 2))
    return out.select("column_name", "null_count", percent.cast("double").alias("null_percent"))


def profile_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    ends = df.agg(*[f(c).cast("date").cast("string").alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"low_{c}").alias("first_date"), F.col(f"high_{c}").alias("last_date")) for c in columns]))
    return ends.select(pairs.alias("p")).select("p.*")


def inventory(tables: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Rows per table, and per schema; tables: name -> (schema, frame)."""
    counts = reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("row_count")).select(F.lit(s).alias("schema_name"), F.lit(n).alias("table_name"), "row_count") for n, (s, df) in tables.items()])
    whole = counts.groupBy("schema_name").agg(F.sum("row_count").alias("row_count")).select("schema_name", F.lit("*").alias("table_name"), "row_count")
    return counts.unionByName(whole)
