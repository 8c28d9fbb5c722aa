"""Validation: one aggregate per table yields the counters, the driver or SQL compares them."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.gold import MEASURES
from tidewell.operators.kpi import TOLERANCE, kpi_baseline, kpi_gold, kpi_variance
from tidewell.operators.quality import ContractError, orphans
from tidewell.sources.settled import settle

LINEAGE = ("_source_system", "_source_table", "_load_date", "_record_hash")
FORMULA_TOLERANCE = 1e-4
#: Foreign keys of the fact: column -> dimension.
FACT_KEYS = {"order_date_id": ("dim_date", "date_id"), "customer_id": ("dim_customer", "customer_id"), "product_id": ("dim_product", "product_id"), "territory_id": ("dim_territory", "territory_id"), "salesperson_id": ("dim_salesperson", "salesperson_id")}
FACT_COLUMNS = ("sales_order_detail_id", "sales_order_id", "order_date_id", "customer_id", "product_id", "territory_id", "salesperson_id", *MEASURES)


@dataclass
class Report:
    """Named checks and whether each passed."""

    checks: dict[str, bool] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def passed(self) -> bool:
        return all(self.checks.values())

    def as_dict(self) -> dict:
        return asdict(self) | {"passed": self.passed}

    def require(self, what: str) -> None:
        if failed := [n for n, ok in self.checks.items() if not ok]:
            raise ContractError(f"{what}: {', '.join(failed)}")


def key_counters(key: str) -> list[Column]:
    """Rows, NULL keys and repeated keys; NULLs repeat nothing, they have their own count."""
    return [F.count("*").alias("row_count"), F.count_if(F.col(key).isNull()).alias("null_keys"), (F.count(key) - F.count_distinct(key)).alias("duplicate_keys")]


def missing_columns(df: DataFrame, wanted: tuple[str, ...] | list[str]) -> list[str]:
    return sorted(set(wanted) - set(df.columns))


def bronze_counters(df: DataFrame, key: str, source_table: str) -> DataFrame:
    missing_lineage = F.count_if(F.greatest(*[F.col(c).isNull().cast("int") for c in LINEAGE]) == 1)
    return df.agg(*key_counters(key), missing_lineage.alias("missing_lineage"), F.count_if(~F.col("_source_table").eqNullSafe(source_table)).alias("foreign_rows"))


def bronze_report(df: DataFrame, key: str, source_table: str, required: tuple[str, ...], source_count: int, rejected: int = 0, threshold: int = 0) -> Report:
    report = Report({"columns": not missing_columns(df, [*required, *LINEAGE])})
    if not report.passed:
        return report
    row = bronze_counters(df, key, source_table).first()
    report.counts = row.asDict()
    report.checks |= {
        "null_keys": row["null_keys"] == 0, "duplicate_keys": row["duplicate_keys"] == 0, "lineage": row["missing_lineage"] == 0, "source_table": row["foreign_rows"] == 0,
        "row_count": row["row_count"] + rejected == source_count, "rejections": rejected <= threshold,
    }
    return report


def count_parity(source_count: int, target_count: int, source_table: str, target_table: str) -> None:
    if source_count != target_count:
        raise ContractError(f"{source_table} has {source_count} rows, {target_table} {target_count}")


def silver_counters(df: DataFrame, key: str, required: tuple[str, ...] = ()) -> DataFrame:
    blanks = [F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).alias(f"missing_{c}") for c in required]
    return df.agg(*key_counters(key), *blanks)


def silver_report(df: DataFrame, key: str, columns: tuple[str, ...], source_count: int, required: tuple[str, ...] = (), rejected: int = 0, threshold: int = 0) -> Report:
    """Fewer rows than the source are fine (dedup); more are not."""
    report = Report({"columns": not missing_columns(df, columns)})
    if not report.passed:
        return report
    row = silver_counters(df, key, required).first()
    report.counts = row.asDict()
    report.checks |= {"null_keys": row["null_keys"] == 0, "duplicate_keys": row["duplicate_keys"] == 0, "growth": row["row_count"] <= source_count - rejected, "rejections": rejected <= threshold}
    report.checks["required_joins"] = all(row[f"missing_{c}"] == 0 for c in required)
    return report


#: The values that Silver tables must have, per table, key first.
REQUIRED = {
    "sales_order_header": ("sales_order_id", "order_date", "customer_id"), "sales_order_detail": ("sales_order_detail_id", "sales_order_id", "product_id", "order_qty", "unit_price"),
    "customer": ("customer_id", "customer_name"), "sales_territory": ("territory_id", "territory_name"), "sales_person": ("salesperson_id", "salesperson_name"),
    "product": ("product_id", "product_name", "list_price"),
}


def silver_quality(bronze: DataFrame, clean: DataFrame, table: str) -> DataFrame:
    """Rows before and after, repeated keys and missing required values (all columns together) of one table."""
    key, *_ = REQUIRED[table]
    missing = reduce(Column.__add__, [F.count_if(F.col(c).isNull()) for c in REQUIRED[table]])
    groups = clean.groupBy(key).agg(F.count("*").alias("_n"), missing.alias("_missing"))
    zero = F.lit(0).cast("bigint")
    before = bronze.agg(F.count("*").alias("bronze_rows")).select("bronze_rows", zero.alias("silver_rows"), zero.alias("duplicate_key_groups"), zero.alias("missing_required"))
    after = groups.agg(F.max(zero).alias("bronze_rows"), F.sum("_n").alias("silver_rows"), F.count_if(F.col("_n") > 1).alias("duplicate_key_groups"), F.sum("_missing").alias("missing_required"))
    both = before.unionByName(after).agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in before.columns])
    return both.select(F.lit(table).alias("table_name"), "bronze_rows", "silver_rows", (F.col("silver_rows") <= F.col("bronze_rows")).alias("no_unexpected_rows"), "duplicate_key_groups", "missing_required")


def output_schema(df: DataFrame, schema: T.StructType, extra: tuple[str, ...] = ()) -> Report:
    """Exactly the contract's columns (plus allowed extras) with its types."""
    wanted = {f.name: f.dataType for f in schema.fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    return Report({"missing": not set(wanted) - set(have), "unexpected": not set(have) - set(wanted) - set(extra), "types": all(have[n].simpleString() == t.simpleString() for n, t in wanted.items() if n in have)})


def detail_grain(raw: DataFrame, key: str) -> DataFrame:
    """Checked on the rows as they came, before any dedup hides a repeated detail."""
    return raw.agg(F.count("*").alias("row_count"), F.count_distinct(key).alias("distinct_keys"), (F.count(key) - F.count_distinct(key)).alias("duplicate_keys"))


def dimension_counters(df: DataFrame, name: str, key: str) -> DataFrame:
    return df.agg(*key_counters(key)).select(F.lit(name).alias("table_name"), "row_count", "null_keys", "duplicate_keys")


def fact_counters(fact: DataFrame) -> DataFrame:
    """Keys, negative measures, and lines that break the formulas."""
    gap = F.col("order_qty").cast("decimal(5,0)") * F.col("unit_price").cast("decimal(14,4)") - F.col("line_total") - F.col("discount_amount")
    return fact.agg(
        *key_counters("sales_order_detail_id"), *[F.count_if(F.col(m) < -1e-9).alias(f"negative_{m}") for m in MEASURES], *[F.count_if(F.col(m).isNull()).alias(f"null_{m}") for m in MEASURES],
        F.count_if(F.abs(gap) > FORMULA_TOLERANCE).alias("broken_discount"), F.count_if(F.col("net_sales") != F.col("line_total")).alias("broken_net_sales"),
    )


def orphan_counts(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Orphans of every foreign key.  The fact is read once: its keys are counted per column and value
    before they are shuffled, and the few distinct values meet the dimensions' keys."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("foreign_key"), F.col(c).cast("bigint").alias("value")) for c in FACT_KEYS]))
    counted = fact.select(values.alias("v")).select("v.*").where("value is not null").groupBy("foreign_key", "value").agg(F.count("*").alias("n"))
    keys = [dimensions[name].select(F.lit(column).alias("foreign_key"), F.col(key).cast("bigint").alias("value")) for column, (name, key) in FACT_KEYS.items()]
    lost = counted.join(reduce(DataFrame.unionByName, keys), ["foreign_key", "value"], "left_anti").select("foreign_key", "n")
    none = fact.sparkSession.createDataFrame([(c, 0) for c in FACT_KEYS], "foreign_key string, n bigint")
    return lost.unionByName(none).groupBy("foreign_key").agg(F.sum("n").alias("orphans"))


def gold_integrity(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Every check of the star schema and the rows that fail it: keys, required values, formulas, orphans.
    The fact is read by two aggregates, so it is written once rather than joined twice."""
    fact = settle(fact.select(*FACT_COLUMNS), "fact")
    counted = fact_counters(fact).drop("row_count")
    facts = counted.select(F.explode(F.array(*[F.struct(F.lit(f"fact_sales.{c}").alias("check"), F.col(c).cast("bigint").alias("failures")) for c in counted.columns])).alias("c")).select("c.*")
    keys = {name: key for name, key in FACT_KEYS.values()}
    parts = []
    for name, frame in dimensions.items():
        counts = dimension_counters(frame, name, keys[name])
        checks = [F.struct(F.lit(f"{name}.{c}").alias("check"), F.col(c).cast("bigint").alias("failures")) for c in ("null_keys", "duplicate_keys")]
        parts.append(counts.select(F.explode(F.array(*checks)).alias("c")).select("c.*"))
    lost = orphan_counts(fact, dimensions).select(F.concat(F.lit("orphans."), F.col("foreign_key")).alias("check"), F.col("orphans").alias("failures"))
    return reduce(DataFrame.unionByName, [facts, *parts, lost]).withColumn("passed", F.col("failures") == 0)


def stored_problems(frames: dict[str, DataFrame], specs: dict) -> list[str]:
    """What is wrong with stored tables by their contracts (name -> ModelSpec): columns and types that are
    missing, unexpected or different, keys that are null or repeat, foreign keys to nowhere."""
    wrong = [f"{name}: not stored" for name in specs if name not in frames]
    for name, frame in frames.items():
        spec = specs[name]
        wrong += [f"{name}: {check}" for check, fine in output_schema(frame, spec.schema).checks.items() if not fine]
        if spec.key in frame.columns:
            row = frame.agg(*key_counters(spec.key)).first()
            wrong += [f"{name}: {n} {what}" for what, n in (("null keys", row["null_keys"]), ("repeated keys", row["duplicate_keys"])) if n]
        for column, (parent, key) in spec.foreign_keys.items():
            if parent in frames and column in frame.columns and key in frames[parent].columns:
                n = orphans(frame.select(column), column, frames[parent], key).count()
                wrong += [f"{name}: {n} orphans of {column}"] if n else []
    return wrong


def gold_report(fact: DataFrame, dimensions: dict[str, DataFrame], details: DataFrame, headers: DataFrame, tolerance: float = TOLERANCE) -> Report:
    """The gate before a version is published."""
    report = Report({"fact_columns": sorted(FACT_COLUMNS) == sorted(c for c in fact.columns if c in FACT_COLUMNS)})
    report.require("gold")
    row = fact_counters(fact).first().asDict()
    report.counts = row
    report.checks |= {n: v == 0 for n, v in row.items() if n != "row_count"}
    for name, frame in dimensions.items():
        key = next(k for d, k in FACT_KEYS.values() if d == name)
        counts = dimension_counters(frame, name, key).first()
        report.checks |= {f"{name}.null_keys": counts["null_keys"] == 0, f"{name}.duplicate_keys": counts["duplicate_keys"] == 0}
    report.checks |= {f"orphans.{r['foreign_key']}": r["orphans"] == 0 for r in orphan_counts(fact, dimensions).collect()}
    report.checks |= {f"kpi.{r['kpi']}": r["passed"] for r in kpi_variance(kpi_gold(fact), kpi_baseline(details, headers), tolerance).collect()}
    return report
