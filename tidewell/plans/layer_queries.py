"""Queries that go through the stores of the layers: batches, versions, quarantine, thresholds, contracts.

Each works in a folder of its own below the shared one, which goes when the driver ends.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.identity import batch_id
from tidewell.operators import gold, quality, silver, validation
from tidewell.plans import queries as q
from tidewell.plans.audit import Quarantine
from tidewell.plans.batches import BatchLog, batch_of, plan_batches, read_committed, write_batches
from tidewell.plans.contracts import BRONZE, GOLD, Status
from tidewell.plans.gates import overall
from tidewell.plans.increments import IncrementalGold, IncrementalSilver
from tidewell.plans.jobs import conform
from tidewell.plans.store import Store
from tidewell.plans.versions import Versions
from tidewell.sources import raw, readers
from tidewell.sources.adapter import SalesTables
from tidewell.sources.settled import discard, shared_folder


def _store(t: SalesTables) -> Store:
    root = f"{shared_folder(t.spark)}/tidewell-layers-{uuid.uuid4().hex}"
    atexit.register(discard, t.spark, root)
    return Store(t.spark, root)


_FACT = """SELECT sales_order_detail_id, sales_order_id, order_date_id, customer_id, product_id, territory_id, salesperson_id, order_qty, CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_amount AS DOUBLE) AS discount_amount,
    CAST(line_total AS DOUBLE) AS line_total, CAST(net_sales AS DOUBLE) AS net_sales FROM fact"""
q._RETURNS |= {"batched_fact_load": ("salesperson_id",), "published_fact": ("salesperson_id",), "silver_snapshot": ("person_id", "store_id")}


def _loaded(t: SalesTables, store: Store) -> BatchLog:
    """Writes the fact in batches of 10,000; their markers."""
    headers, details = t.header(), t.detail()
    batches = plan_batches(details, "fact_sales", "sales_order_detail_id", 10_000, "snap-1")
    log = BatchLog(store, "load-1")
    write_batches(details, "sales_order_detail_id", batches, log, "staging/fact", lambda rows: conform(gold.fact_sales(rows, headers), GOLD["fact_sales"]))
    return log


@q.query("batched_fact_load", _FACT, "fact")
def batched_fact_load(t):
    return read_committed(_loaded(t, _store(t)), "staging/fact")


@q.query(
    "committed_batches",
    """SELECT b AS number, max(k) AS high, count(*) AS rows FROM (SELECT sales_order_detail_id AS k, CAST((row_number() OVER (ORDER BY sales_order_detail_id) - 1) // 10000 + 1 AS BIGINT) AS b FROM detail) GROUP BY b""",
    "detail",
)
def committed_batches(t):
    """The commit markers of such a load, which later runs resume from."""
    marks = _loaded(t, _store(t)).committed()
    return t.spark.createDataFrame([(m["number"], m["high"], m["rows"]) for m in marks], "number long, high long, rows long")


@q.query(
    "batch_identities",
    """SELECT number, sha256(concat_ws(chr(31), 'orders', 'o_orderkey', coalesce(CAST(lag(high) OVER (ORDER BY number) AS VARCHAR), 'None'), CAST(high AS VARCHAR), 'snap-1')) AS batch_id, rows FROM (
    SELECT CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 + 1 AS BIGINT) AS number, max(o_orderkey) OVER () AS whole, o_orderkey FROM orders) n
    JOIN (SELECT number, max(o_orderkey) AS high, count(*) AS rows FROM (SELECT CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 + 1 AS BIGINT) AS number, o_orderkey FROM orders) GROUP BY number) h USING (number)
    WHERE o_orderkey = high""",
)
def batch_identities(t):
    """The same batch of the same snapshot has the same id in every run; rows find theirs by their key."""
    orders = t.table("orders").select("o_orderkey")
    batches = plan_batches(orders, "orders", "o_orderkey", 4000, "snap-1")
    assert all(b.batch_id == batch_id("orders", "o_orderkey", b.low, b.high, "snap-1") for b in batches)
    counts = orders.groupBy(batch_of(F.col("o_orderkey"), batches).alias("batch_id")).agg(F.count("*").alias("rows"))
    numbers = t.spark.createDataFrame([(b.number, b.batch_id) for b in batches], "number long, batch_id string")
    return numbers.join(counts, "batch_id").select("number", "batch_id", "rows")


@q.query("full_extract", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def full_extract(t):
    """A table read whole and in no order: one scan, whose partitions are the batches."""
    return readers.scan(t.table("orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


@q.query("published_fact", _FACT, "fact")
def published_fact(t):
    """A version that is written, validated and published, as readers see it."""
    versions = Versions(_store(t), "gold")
    version = versions.allocate("run-1", "snap-1")
    versions.write(version, "fact_sales", conform(q.fact(t), GOLD["fact_sales"]))
    report = validation.output_schema(versions.read(version, "fact_sales"), GOLD["fact_sales"].schema)
    versions.publish(version, ["fact_sales"], report.as_dict())
    return versions.read_current("fact_sales", "snap-1")


@q.query("silver_snapshot", "SELECT customer_id, customer_name, customer_type, person_id, store_id FROM dim_customer", "dim_customer")
def silver_snapshot(t):
    """A Silver table of the current snapshot."""
    versions = Versions(_store(t), "silver")
    people = q.named_customers(t)
    first = versions.allocate("run-1", "snap-1")
    versions.write(first, "customer", people)
    versions.publish(first, ["customer"], {"passed": True})
    return versions.read_current("customer", "snap-1").select("customer_id", "customer_name", "customer_type", "person_id", "store_id")


def _bound(t: SalesTables) -> int:
    """An order id that nine tenths of the orders do not pass; an aggregate of one row."""
    return t.table("orders").agg(F.percentile_approx("o_orderkey", 0.9).alias("bound")).first()["bound"] or 0


@q.query("incremental_silver", q._CLEAN_HEADER, "raw_header")
def incremental_silver(t):
    """Headers up to a bound are published; then the rest comes, with newer loads of orders below the bound."""
    rows, bound = raw.raw_header(t), _bound(t)
    later = (F.col("SalesOrderID") > bound) | ((F.col("SalesOrderID") > bound - bound // 10) & (F.col("_load_date") == raw.NEW))
    increments = IncrementalSilver(_store(t))
    for snapshot, part in (("snap-1", ~later), ("snap-2", later)):
        increments.apply({"sales_order_header": rows.where(part)}, raw.raw_person(t), snapshot)
    return increments.read("sales_order_header").drop("_record_hash")


@q.query("incremental_kpis", q._KPI_GOLD, "fact")
def incremental_kpis(t):
    """KPIs from kept parts, after the orders past a bound came to a published fact, with changed lines below it."""
    details, headers, bound = t.detail(), t.header(), _bound(t)
    old = details.where(F.col("sales_order_id") <= bound).withColumn("order_qty", F.when(F.col("sales_order_id") % 50 == 0, F.lit(1).cast("long")).otherwise(F.col("order_qty")))
    increments = IncrementalGold(_store(t))
    increments.apply(old, headers, "snap-1")
    increments.apply(details.where((F.col("sales_order_id") > bound) | (F.col("sales_order_id") % 50 == 0)), headers, "snap-2")
    return increments.kpis()


@q.query(
    "malformed_lines",
    f"""SELECT 'valid' AS outcome, CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_orderstatus, '' AS line FROM orders WHERE o_orderkey % 40 NOT IN (0, 1, 2, 3) UNION ALL
    SELECT 'malformed csv line', NULL, NULL, '', CASE o_orderkey % 40 WHEN 1 THEN 'x' ELSE '' END || o_orderkey || ',' || o_custkey || CASE o_orderkey % 40 WHEN 0 THEN '' ELSE ',' || o_orderstatus END
    || CASE o_orderkey % 40 WHEN 2 THEN ',extra' ELSE '' END FROM orders WHERE o_orderkey % 40 IN (0, 1, 2) UNION ALL
    SELECT 'malformed json line', NULL, NULL, '', '{{"o_orderkey":' || o_orderkey || ',"o_custkey":' FROM orders WHERE o_orderkey % 40 = 3""",
)
def malformed_lines(t):
    """Orders as csv lines, of which one in 40 each lacks a column, has a text for a number or a column too many, and as
    json lines, of which one in 40 ends too soon: what is valid, and what the quarantine gets."""
    orders, root = t.table("orders"), f"{shared_folder(t.spark)}/tidewell-lines-{uuid.uuid4().hex}"
    atexit.register(discard, t.spark, root)
    kind, text = F.col("o_orderkey") % 40, lambda c: F.col(c).cast("string")
    status = F.when(kind == 0, F.lit("")).otherwise(F.concat(F.lit(","), F.col("o_orderstatus")))
    line = F.concat(F.when(kind == 1, "x").otherwise(""), text("o_orderkey"), F.lit(","), text("o_custkey"), status, F.when(kind == 2, ",extra").otherwise(""))
    orders.where(kind < 3).select(line.alias("value")).write.text(f"{root}/csv")
    whole = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus"))
    cut = F.concat(F.lit('{"o_orderkey":'), text("o_orderkey"), F.lit(',"o_custkey":'))
    orders.where(kind >= 3).select(F.when(kind == 3, cut).otherwise(whole).alias("value")).write.text(f"{root}/json")
    parts = []
    for kind in ("csv", "json"):
        valid, rejected = readers.read_lines(t.spark, f"{root}/{kind}", kind, "o_orderkey long, o_custkey long, o_orderstatus string")
        parts.append(valid.select(F.lit("valid").alias("outcome"), F.col("o_orderkey").cast("double").alias("o_orderkey"), F.col("o_custkey").cast("double").alias("o_custkey"), "o_orderstatus", F.lit("").alias("line")))
        none = F.lit(None).cast("double")
        parts.append(rejected.select(F.col("rejection_reason").alias("outcome"), none.alias("o_orderkey"), none.alias("o_custkey"), F.lit("").alias("o_orderstatus"), "line"))
    return readers.union_batches(parts)


@q.query("quarantined_rows", f"SELECT DISTINCT CAST(SalesOrderID AS VARCHAR) AS record_key, {q._REASONS} AS rejection_reason FROM raw_header WHERE {q._REASONS} <> ''", "raw_header")
def quarantined_rows(t):
    """Two loads reject the same rows; the quarantine has each key and reason once."""
    quarantine = Quarantine(_store(t))
    rejected = quality.rejected_rows(raw.raw_header(t), q._HEADER_RULES, "SalesOrderID")
    for load in ("load-1", "load-2"):
        quarantine.add(rejected, "sales_order_header", "run-1", load)
    return quarantine.read("sales_order_header").select("record_key", "rejection_reason")


#: Rejected rows that each table may have in rejection_thresholds.
_ALLOWED = {"sales_order_header": 10**6, "sales_order_detail": 0, "customer": 10**6, "sales_territory": 1, "sales_person": 0, "product": 10**6}
_REJECTED = {
    "sales_order_header": f"SELECT count(*) AS n, count(*) FILTER (WHERE {q._REASONS} <> '') AS rejected FROM raw_header",
    "sales_order_detail": "SELECT count(*) AS n, count(*) FILTER (WHERE OrderQty = '1.5' OR LineTotal = '1,000') AS rejected FROM raw_detail",
    "customer": "SELECT count(*) AS n, count(*) FILTER (WHERE trim(AccountNumber) = '') AS rejected FROM raw_customer",
    "sales_territory": r"""SELECT count(*) AS n, count(*) FILTER (WHERE regexp_replace(CountryRegionCode, '^\s+$', '') = '' OR trim("Group") = '') AS rejected FROM raw_territory""",
    "sales_person": "SELECT count(*) AS n, 0 AS rejected FROM raw_salesperson",
    "product": "SELECT count(*) AS n, count(*) FILTER (WHERE ListPrice = 'n/a' OR trim(ProductNumber) = '') AS rejected FROM raw_product",
}


@q.query(
    "rejection_thresholds",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, n AS rows_read, CAST(rejected AS BIGINT) AS rows_rejected, CASE WHEN rejected > {_ALLOWED[n]} THEN 'FAILED' WHEN rejected > 0 THEN 'SUCCESS_WITH_REJECTIONS' ELSE 'SUCCESS' END AS status FROM ({body})"
        for n, body in _REJECTED.items()
    ),
    *[n for _, n in q._CLEAN.values()],
)
def rejection_thresholds(t):
    """Each table's rejected rows against what is allowed, and its status."""
    parts = []
    for name, rows in q._raw_frames(t).items():
        counted = quality.with_reasons(rows, silver.RULES[name]).agg(F.count("*").alias("rows_read"), F.count_if(F.col("rejection_reason") != "").alias("rows_rejected"))
        status = F.when(F.col("rows_rejected") > _ALLOWED[name], str(Status.FAILED)).when(F.col("rows_rejected") > 0, str(Status.SUCCESS_WITH_REJECTIONS)).otherwise(str(Status.SUCCESS))
        parts.append(counted.select(F.lit(name).alias("table_name"), "rows_read", "rows_rejected", status.alias("status")))
    return readers.union_batches(parts)


@q.query(
    "run_totals",
    "SELECT CAST(sum(n) AS BIGINT) AS rows_read, CAST(sum(n - rejected) AS BIGINT) AS rows_written, CAST(sum(rejected) AS BIGINT) AS rows_rejected, CASE WHEN sum(rejected) > 0 THEN 'SUCCESS_WITH_REJECTIONS' ELSE 'SUCCESS' END AS status FROM ("
    + " UNION ALL ".join(_REJECTED.values())
    + ")",
    *[n for _, n in q._CLEAN.values()],
)
def run_totals(t):
    """The results of all tables added up, and the run's status from theirs; six rows reach the driver."""
    results = {}
    for name, rows in q._raw_frames(t).items():
        row = quality.with_reasons(rows, silver.RULES[name]).agg(F.count("*").alias("n"), F.count_if(F.col("rejection_reason") != "").alias("rejected")).first()
        results[name] = {"rows_read": row["n"], "rows_written": row["n"] - row["rejected"], "rows_rejected": row["rejected"], "status": Status.SUCCESS_WITH_REJECTIONS if row["rejected"] else Status.SUCCESS}
    sums = [sum(r[c] for r in results.values()) for c in ("rows_read", "rows_written", "rows_rejected")]
    return t.spark.createDataFrame([(*sums, str(overall(r["status"] for r in results.values())))], "rows_read long, rows_written long, rows_rejected long, status string")


_CONTRACT_TABLES = {"sales_order_header": "raw_header", "customer": "raw_customer", "sales_territory": "raw_territory", "product": "raw_product"}


@q.query(
    "schema_differences",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, column_name, 'missing' AS problem FROM (VALUES {", ".join(f"('{c}')" for c in [*BRONZE[n].required, "ModifiedDate"])}) w(column_name)
        WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM {v})) UNION ALL SELECT '{n}', column_name, 'unexpected' FROM (DESCRIBE SELECT * FROM {v})
        WHERE column_name NOT IN ({", ".join(f"'{c}'" for c in [*BRONZE[n].required, *validation.LINEAGE])})"""
        for n, v in _CONTRACT_TABLES.items()
    ),
    *_CONTRACT_TABLES.values(),
)
def schema_differences(t):
    """Columns that Bronze tables lack (all are asked for a ModifiedDate) or have beyond their contract."""
    frames = q._raw_frames(t)
    rows = []
    for name in _CONTRACT_TABLES:
        wanted, known = [*BRONZE[name].required, "ModifiedDate"], [*BRONZE[name].required, *validation.LINEAGE]
        rows += [(name, c, "missing") for c in validation.missing_columns(frames[name], wanted)] + [(name, c, "unexpected") for c in frames[name].columns if c not in known]
    return t.spark.createDataFrame(rows, "table_name string, column_name string, problem string")


_SPOILT_KEYS = """(SELECT product_id, CASE WHEN sales_order_detail_id % 37 = 0 THEN NULL WHEN sales_order_detail_id % 10 = 2 THEN sales_order_detail_id - 1 ELSE sales_order_detail_id END AS k FROM fact)"""


@q.query(
    "stored_contracts",
    f"""SELECT 'fact_sales: ' || count(*) || ' null keys' AS problem FROM {_SPOILT_KEYS} WHERE k IS NULL UNION ALL SELECT 'fact_sales: ' || (count(k) - count(DISTINCT k)) || ' repeated keys' FROM {_SPOILT_KEYS}
    UNION ALL SELECT 'fact_sales: ' || count(*) || ' orphans of product_id' FROM {_SPOILT_KEYS} WHERE product_id % 19 = 0 UNION ALL SELECT 'dim_product: missing' UNION ALL SELECT 'dim_product: unexpected'""",
    "fact",
)
def stored_contracts(t):
    """Stored tables against their contracts: the fact's key is spoilt, products are left out and lack a column."""
    versions = Versions(_store(t), "gold")
    version = versions.allocate("run-1", "snap-1")
    key = F.col("sales_order_detail_id")
    lines = q.fact(t).withColumn("sales_order_detail_id", F.when(key % 37 == 0, None).when(key % 10 == 2, key - 1).otherwise(key))
    versions.write(version, "fact_sales", conform(lines, GOLD["fact_sales"]))
    versions.write(version, "dim_product", gold.dim_product(t.product()).where("product_id % 19 <> 0").withColumnRenamed("product_style", "colour"))
    stored = {n: versions.read(version, n) for n in ("fact_sales", "dim_product")}
    return t.spark.createDataFrame([(p,) for p in validation.stored_problems(stored, {n: GOLD[n] for n in stored})], "problem string")

