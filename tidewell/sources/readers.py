"""Sources and sinks: scans by key, snapshots, formats, JDBC."""

from __future__ import annotations

from functools import reduce
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.identity import safe_name
from tidewell.operators.quality import ContractError
from tidewell.sources.settled import settle

FORMATS = ("parquet", "orc", "json", "csv")


def read(spark: SparkSession, path: str, kind: str = "parquet", schema: str | None = None, **options: str) -> DataFrame:
    """A table of files; csv and json take a schema, as inferring one reads the data twice."""
    if kind not in FORMATS:
        raise ContractError(f"format {kind} is not one of {', '.join(FORMATS)}")
    reader = spark.read.format(kind).options(**({"header": "true"} if kind == "csv" else {}) | options)
    return (reader.schema(schema) if schema else reader).load(path)


CORRUPT = "_corrupt_line"


def read_lines(spark: SparkSession, path: str, kind: str, schema: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """Rows of csv or json lines, and what of them is malformed: record_key (the line's SHA-256), rejection_reason and
    the line.  A line is malformed if it does not parse, lacks or exceeds columns, or holds a value of another type.
    The lines are parsed once, with all columns, and written as a table: which lines are malformed must not depend on what is asked for."""
    if kind not in ("csv", "json"):
        raise ContractError(f"{kind} has no lines")
    reader = spark.read.format(kind).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options)
    parsed = settle(reader.schema(f"{schema}, {CORRUPT} string").load(path), "lines")
    bad = parsed.where(F.col(CORRUPT).isNotNull())
    rejected = bad.select(F.sha2(CORRUPT, 256).alias("record_key"), F.lit(f"malformed {kind} line").alias("rejection_reason"), F.col(CORRUPT).alias("line"))
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rejected


def write(df: DataFrame, path: str, kind: str = "parquet", mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> None:
    if kind not in FORMATS:
        raise ContractError(f"format {kind} is not one of {', '.join(FORMATS)}")
    df.write.format(kind).options(**({"header": "true"} if kind == "csv" else {})).mode(mode).partitionBy(*partition_by).save(path)


def jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, properties: dict[str, str] | None = None) -> DataFrame:
    """A database table read in parallel ranges of its key."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=parts, properties=properties or {})


def quantile_ranges(keys: DataFrame, key: str, parts: int, accuracy: int = 10_000) -> list[str]:
    """SQL conditions that cut a table into ``parts`` ranges of about equally many rows, wherever its whole-number keys
    lie; rows without a key are in the first.  Keys that repeat very often stay in one range."""
    shares = [i / parts for i in range(1, parts)]
    found = keys.agg(F.percentile_approx(key, F.lit(shares), F.lit(accuracy)).alias("cuts")).first()["cuts"] if shares else []
    cuts = sorted({int(c) for c in found or []})
    if not cuts:
        return ["1 = 1"]
    inner = [f"{key} > {low} AND {key} <= {high}" for low, high in pairwise(cuts)]
    return [f"{key} <= {cuts[0]} OR {key} IS NULL", *inner, f"{key} > {cuts[-1]}"]


def jdbc_balanced(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, properties: dict[str, str] | None = None) -> DataFrame:
    """A database table read in parallel ranges of about equally many rows: one pass over the keys, in ranges of equal
    width, finds their quantiles."""
    name = safe_name(key)
    keys = jdbc(spark, url, table, name, low, high, parts, properties).select(name)
    return spark.read.jdbc(url, table, predicates=quantile_ranges(keys, name, parts), properties=properties or {})


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 1000, parts: int | None = None, properties: dict[str, str] | None = None) -> None:
    """Rows into a database table: multi-row inserts of ``batch_size``, at most ``parts`` connections at once.
    With mode "overwrite" the table is emptied, not dropped, so its keys and grants stay.  A task that is
    tried again appends its rows again, so load into a staging table and publish that by one statement."""
    options = {"batchsize": str(batch_size), "truncate": "true"} | ({"numPartitions": str(parts)} if parts else {})
    df.write.options(**options).jdbc(url, table, mode=mode, properties=properties or {})


def scan(df: DataFrame, columns: list[str], key: str | None = None, after: int | str | None = None) -> DataFrame:
    """The named columns of a table, after a checkpoint (exclusive) if there is one."""
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    return rows.select(*columns)


def between_keys(df: DataFrame, key: str, low: int | None, high: int) -> DataFrame:
    """Rows of one batch: low < key <= high; without low, from the start."""
    inside = F.col(key) <= F.lit(high)
    return df.where(inside if low is None else (F.col(key) > F.lit(low)) & inside)


def of_snapshot(df: DataFrame, wanted: str, current: str) -> DataFrame:
    """The rows of a snapshot, which must be the one that the pointer names."""
    if wanted != current:
        raise ContractError(f"snapshot {wanted} is not current; the pointer names {current}")
    return df.where(F.col("source_snapshot_id") == wanted)


def union_batches(batches: list[DataFrame]) -> DataFrame:
    if not batches:
        raise ContractError("no batches")
    return reduce(DataFrame.unionByName, batches)


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text, as the oldest loader stored them."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def catalog(spark: SparkSession, tables: dict[str, DataFrame], foreign_keys: dict[tuple[str, str], str]) -> DataFrame:
    """A row a column: table, column, type, place, the table's rows and what the column refers to ("": nothing).
    Schemas are read on the driver; rows are counted by one aggregate a table."""
    rows = [(name, f.name, f.dataType.simpleString(), i, foreign_keys.get((name, f.name), "")) for name, df in sorted(tables.items()) for i, f in enumerate(df.schema.fields, 1)]
    columns = spark.createDataFrame(rows, "table_name string, column_name string, type string, place int, refers_to string")
    counts = union_batches([df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()])
    return columns.join(counts, "table_name")
