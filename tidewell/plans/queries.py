"""The sales queries: each a Spark function over SalesTables, with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.columns import is_blank, is_whole, to_date, to_number
from tidewell.operators import gold, holidays, kpi, quality, silver, validation
from tidewell.plans.contracts import SILVER
from tidewell.sources import raw, readers
from tidewell.sources.adapter import RELATIONS, SalesTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Integer columns that may hold NULL; some clients turn these into doubles, so queries always do.
_NULLABLE = ("salesperson_id", "person_id", "store_id", "lower_bound")


def plain(df: DataFrame) -> DataFrame:
    """Types that compare alike everywhere: decimals as doubles, dates as texts, integers as longs."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType) or (f.name in _NULLABLE and isinstance(f.dataType, T.IntegralType)):
            casts[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType)):
            casts[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            casts[f.name] = F.col(f.name).cast("bigint")
    return df.withColumns(casts) if casts else df


#: In gold_integrity, the foreign key of every so many lines refers to nothing.
_BENT = {"order_date_id": 37, "customer_id": 41, "product_id": 43, "territory_id": 47, "salesperson_id": 53}
#: Relations that others are built from, in the order of their needs.
_GOLD = {
    "names": "SELECT business_entity_id, first_name || ' ' || last_name AS n FROM person",
    "dim_customer": """SELECT customer_id, CASE WHEN person_id IS NOT NULL THEN n ELSE account_number END AS customer_name, CASE WHEN person_id IS NOT NULL THEN 'INDIVIDUAL' ELSE 'STORE' END AS customer_type,
        CASE WHEN person_id IS NOT NULL THEN 'PERSON' ELSE 'ACCOUNT' END AS customer_name_source, person_id, store_id, territory_id, account_number FROM cust LEFT JOIN names ON business_entity_id = person_id""",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, CAST(CAST(d AS DATE) AS VARCHAR) AS full_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, day(d) AS day, isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(CAST(min(order_date) AS TIMESTAMP), CAST(max(order_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM header)""",
    "fact": """SELECT sales_order_detail_id, d.sales_order_id, CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS order_date_id, customer_id, product_id, territory_id, salesperson_id, order_qty, unit_price,
        CAST(round(CAST(order_qty AS DECIMAL(5,0)) * CAST(unit_price AS DECIMAL(14,4)) - line_total, 4) AS DECIMAL(19,4)) AS discount_amount, line_total, line_total AS net_sales FROM detail d JOIN header h ON d.sales_order_id = h.sales_order_id""",
    "spoilt": """SELECT * REPLACE ({bent}, CASE WHEN sales_order_detail_id % 29 = 0 THEN discount_amount - 5000 ELSE discount_amount END AS discount_amount, CASE WHEN sales_order_detail_id % 31 = 0 THEN net_sales + 1 ELSE net_sales END AS net_sales) FROM fact""".format(bent=", ".join(f"CASE WHEN sales_order_detail_id % {_BENT[c]} = 0 THEN {c} + 900000000 ELSE {c} END AS {c}" for c in _BENT)),
}
_NEEDS = {
    "detail": ("priced",), "names": ("person",), "dim_customer": ("cust", "names"), "dim_date": ("header",), "fact": ("detail", "header"),
    "raw_header": ("header",), "raw_detail": ("detail",), "raw_customer": ("cust",), "raw_product": ("product",),
    "raw_territory": ("territory",), "raw_salesperson": ("salesperson",), "spoilt": ("fact",),
}
_ALL = RELATIONS | _GOLD | raw.RAW


def sql(body: str, *names: str) -> str:
    """body with the CTEs it names, and theirs."""
    wanted: set[str] = set()

    def need(name: str) -> None:
        for other in _NEEDS.get(name, ()):
            need(other)
        wanted.add(name)

    for name in names:
        need(name)
    ctes = ", ".join(f"{n} AS ({_ALL[n]})" for n in _ALL if n in wanted)
    return f"WITH {ctes} {body}" if ctes else body


#: Which of the nullable columns a query returns.
_RETURNS = {
    "fact_sales": ("salesperson_id",), "dim_customer": ("person_id", "store_id"), "silver_customer": ("person_id", "store_id"), "silver_header": ("salesperson_id",), "fact_batches": ("lower_bound",),
    "dim_salesperson": ("salesperson_id",), "silver_salesperson": ("salesperson_id",), "top_salespersons": ("salesperson_id",), "revenue_by_salesperson": ("salesperson_id",),
    "orphans_fact_salesperson": ("salesperson_id",), "orphans_silver_header_salesperson": ("salesperson_id",),
}


def query(name: str, oracle: str | None = None, *names: str):
    def register(function: Callable[[SalesTables], DataFrame]):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(SalesTables(spark, sf_dir)))

        QUERIES[name] = run
        if oracle is not None:
            nullable = _RETURNS.get(name, ())
            body = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in nullable)}) FROM ({oracle})" if nullable else oracle
            ORACLES[name] = sql(body, *names)
        return function

    return register


# Frames that several queries share.


def _spoilt(lines: DataFrame) -> DataFrame:
    every = F.col("sales_order_detail_id")
    bent = {c: F.when(every % n == 0, F.col(c) + 900_000_000).otherwise(F.col(c)) for c, n in _BENT.items()}
    return lines.withColumns(bent | {"discount_amount": F.when(every % 29 == 0, F.col("discount_amount") - 5000).otherwise(F.col("discount_amount")), "net_sales": F.when(every % 31 == 0, F.col("net_sales") + 1).otherwise(F.col("net_sales"))})


def fact(t: SalesTables) -> DataFrame:
    return gold.fact_sales(t.detail(), t.header())


def named_customers(t: SalesTables) -> DataFrame:
    people = t.person().select(F.col("business_entity_id").alias("person_id"), F.concat_ws(" ", "first_name", "last_name").alias("_name"))
    individual = F.col("person_id").isNotNull()
    return t.customer().join(people, "person_id", "left").select(
        "customer_id", F.when(individual, F.col("_name")).otherwise(F.col("account_number")).alias("customer_name"), F.when(individual, "INDIVIDUAL").otherwise("STORE").alias("customer_type"),
        F.when(individual, "PERSON").otherwise("ACCOUNT").alias("customer_name_source"), "person_id", "store_id", "territory_id", "account_number",
    )


def dimensions(t: SalesTables) -> dict[str, DataFrame]:
    return {
        "dim_date": gold.dim_date(t.header()), "dim_customer": gold.dim_customer(named_customers(t)), "dim_product": gold.dim_product(t.product()),
        "dim_territory": gold.dim_territory(t.territory()), "dim_salesperson": gold.dim_salesperson(t.salesperson()),
    }


# Gold: dimensions, fact, dashboards.


@query("revenue_by_territory", "SELECT f.territory_id, territory_name, CAST(sum(net_sales) AS DOUBLE) AS revenue, count(*) AS line_items FROM fact f JOIN territory t ON f.territory_id = t.territory_id GROUP BY 1, 2", "fact", "territory")
def revenue_by_territory(t):
    return kpi.revenue_by_territory(fact(t), t.territory())


@query("orders_by_territory", "SELECT f.territory_id, territory_name, count(DISTINCT sales_order_id) AS orders FROM fact f JOIN territory t ON f.territory_id = t.territory_id GROUP BY 1, 2", "fact", "territory")
def orders_by_territory(t):
    return kpi.orders_by_territory(fact(t), t.territory())


@query(
    "fact_sales",
    """SELECT sales_order_detail_id, sales_order_id, order_date_id, customer_id, product_id, territory_id, salesperson_id, order_qty, CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_amount AS DOUBLE) AS discount_amount,
    CAST(line_total AS DOUBLE) AS line_total, CAST(net_sales AS DOUBLE) AS net_sales FROM fact""",
    "fact",
)
def fact_sales(t):
    return fact(t)


@query("dim_date", "SELECT * FROM dim_date", "dim_date")
def dim_date(t):
    return gold.dim_date(t.header())


#: Easter by another computation than the library's: Gauss's, with its two exceptions.
_EASTER = """SELECT y, make_date(y, 3, 22) + CAST(d + e - CASE WHEN e = 6 AND (d = 29 OR (d = 28 AND (11 * m + 11) % 30 < 19)) THEN 7 ELSE 0 END AS INT) AS easter FROM (
    SELECT *, (2 * (y % 4) + 4 * (y % 7) + 6 * d + n) % 7 AS e FROM (SELECT *, (19 * (y % 19) + m) % 30 AS d FROM (
    SELECT y, (15 - (13 + 8 * (y // 100)) // 25 + y // 100 - y // 400) % 30 AS m, (4 + y // 100 - y // 400) % 7 AS n FROM (SELECT DISTINCT year AS y FROM dim_date))))"""


@query(
    "calendar_holidays",
    f"""SELECT date_id, full_date, week, name IS NOT NULL AS is_holiday, coalesce(name, '') AS holiday FROM (SELECT date_id, full_date, CAST(week(CAST(full_date AS DATE)) AS BIGINT) AS week,
    (SELECT min(n) FROM (VALUES ('New Year', make_date(year, 1, 1)), ('Labour Day', make_date(year, 5, 1)), ('Christmas Day', make_date(year, 12, 25)), ('Second Christmas Day', make_date(year, 12, 26)),
    ('Good Friday', easter - 2), ('Easter Monday', easter + 1), ('Ascension Day', easter + 39), ('Whit Monday', easter + 50)) h(n, d) WHERE d = CAST(full_date AS DATE)) AS name FROM dim_date JOIN ({_EASTER}) ON y = year)""",
    "dim_date",
)
def calendar_holidays(t):
    return holidays.with_holidays(gold.dim_date(t.header())).select("date_id", "full_date", "week", "is_holiday", F.coalesce("holiday", F.lit("")).alias("holiday"))


@query("dim_customer", "SELECT * FROM dim_customer", "dim_customer")
def dim_customer(t):
    twice = named_customers(t)
    again = twice.where("customer_id % 9 = 0").withColumn("customer_name", F.concat(F.lit("zz "), F.col("customer_name")))
    return gold.dim_customer(twice.unionByName(again))


@query(
    "dim_product",
    "SELECT product_id, product_name, product_number, product_line, class AS product_class, style AS product_style, CAST(list_price AS DOUBLE) AS list_price, CAST(standard_cost AS DOUBLE) AS standard_cost, is_discontinued FROM product",
    "product",
)
def dim_product(t):
    products = t.product()
    return gold.dim_product(products.unionByName(products.where("product_id % 9 = 0").withColumn("style", F.lit("~"))))


@query("dim_territory", "SELECT * FROM territory", "territory")
def dim_territory(t):
    return gold.dim_territory(t.territory())


@query("dim_salesperson", "SELECT salesperson_id, territory_id, salesperson_name, sales_quota, bonus, commission_pct, name_source FROM salesperson", "salesperson")
def dim_salesperson(t):
    return gold.dim_salesperson(t.salesperson())


_KPI = """SELECT CAST(coalesce(sum({revenue}), 0) AS DOUBLE) AS total_revenue, count(DISTINCT sales_order_id) AS total_orders, count(*) AS total_line_items, CAST(coalesce(sum(order_qty), 0) AS BIGINT) AS total_units,
    CAST(sum({revenue}) AS DOUBLE) / count(DISTINCT sales_order_id) AS avg_order_value, CAST(sum(CAST(unit_price AS DECIMAL(14,4)) * CAST(order_qty AS DECIMAL(5,0))) AS DOUBLE) / CAST(sum(order_qty) AS DOUBLE) AS avg_item_price,
    CAST(sum({discount}) AS DOUBLE) AS total_discount, CAST(sum({discount}) AS DOUBLE) / CAST(sum(CAST(unit_price AS DECIMAL(14,4)) * CAST(order_qty AS DECIMAL(5,0))) AS DOUBLE) AS discount_rate,
    count(DISTINCT customer_id) AS total_customers FROM {rows}"""
_KPI_GOLD = _KPI.format(revenue="net_sales", discount="discount_amount", rows="fact")
_KPI_BASE = _KPI.format(revenue="line_total", discount="CAST(order_qty AS DECIMAL(5,0)) * CAST(unit_price AS DECIMAL(14,4)) - line_total", rows="(SELECT d.*, h.customer_id FROM detail d JOIN header h ON d.sales_order_id = h.sales_order_id)")


@query("kpi_gold", _KPI_GOLD, "fact")
def kpi_gold(t):
    return kpi.kpi_gold(fact(t))


@query("kpi_baseline", _KPI_BASE, "detail", "header")
def kpi_baseline(t):
    return kpi.kpi_baseline(t.detail(), t.header())


def _unpivot(source: str, name: str) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS kpi, CAST({k} AS DOUBLE) AS {name} FROM {source}" for k in kpi.KPIS)


@query(
    "kpi_variance",
    f"""SELECT kpi, actual, expected, CASE WHEN expected = 0 THEN CASE WHEN actual = 0 THEN 0.0 ELSE 1.0 END ELSE abs(actual - expected) / abs(expected) END AS variance,
    CASE WHEN expected = 0 THEN CASE WHEN actual = 0 THEN 0.0 ELSE 1.0 END ELSE abs(actual - expected) / abs(expected) END <= 0.02 AS passed
    FROM ({_unpivot("(" + _KPI_GOLD + ")", "actual")}) a JOIN ({_unpivot("(" + _KPI_BASE + ")", "expected")}) b USING (kpi)""",
    "fact", "detail", "header",
)
def kpi_variance(t):
    return kpi.kpi_variance(kpi.kpi_gold(fact(t)), kpi.kpi_baseline(t.detail(), t.header()))


_TOTALS = """SELECT count(*) AS line_items, count(DISTINCT sales_order_id) AS orders, count(DISTINCT customer_id) AS customers, CAST(round(sum(net_sales), 2) AS DOUBLE) AS revenue, CAST(round(sum(discount_amount), 2) AS DOUBLE) AS discount,
    CAST(sum(order_qty) AS BIGINT) AS units, round(CAST(sum(net_sales) AS DOUBLE) / count(*), 2) AS avg_line_value FROM fact"""


@query("dashboard_totals", _TOTALS, "fact")
def dashboard_totals(t):
    return kpi.dashboard_totals(fact(t))


@query("dashboard_totals_assigned", _TOTALS + " WHERE salesperson_id IS NOT NULL", "fact")
def dashboard_totals_assigned(t):
    return kpi.dashboard_totals(fact(t), assigned_only=True)


@query(
    "top_salespersons",
    """SELECT f.salesperson_id, salesperson_name, count(DISTINCT sales_order_id) AS orders, CAST(round(sum(net_sales), 2) AS DOUBLE) AS revenue, round(CAST(sum(net_sales) AS DOUBLE) / count(*), 2) AS avg_line_value
    FROM fact f JOIN salesperson s ON f.salesperson_id = s.salesperson_id GROUP BY 1, 2 ORDER BY revenue DESC, 1 LIMIT 10""",
    "fact", "salesperson",
)
def top_salespersons(t):
    return kpi.top_salespersons(fact(t), t.salesperson())


def _period(*parts: str) -> str:
    names = ", ".join(parts)
    return f"SELECT {names}, CAST(sum(net_sales) AS DOUBLE) AS revenue, count(DISTINCT sales_order_id) AS orders FROM fact JOIN dim_date ON order_date_id = date_id GROUP BY {names}"


@query("revenue_by_month", _period("year", "month"), "fact", "dim_date")
def revenue_by_month(t):
    return kpi.revenue_by_period(fact(t), gold.dim_date(t.header()), "year", "month")


@query("revenue_by_quarter", _period("year", "quarter"), "fact", "dim_date")
def revenue_by_quarter(t):
    return kpi.revenue_by_period(fact(t), gold.dim_date(t.header()), "year", "quarter")


@query("revenue_by_year", _period("year"), "fact", "dim_date")
def revenue_by_year(t):
    return kpi.revenue_by_period(fact(t), gold.dim_date(t.header()), "year")


@query(
    "top_products",
    "SELECT f.product_id, product_name, CAST(sum(net_sales) AS DOUBLE) AS revenue, CAST(sum(order_qty) AS BIGINT) AS quantity FROM fact f JOIN product p ON f.product_id = p.product_id GROUP BY 1, 2 ORDER BY sum(net_sales) DESC, 1 LIMIT 10",
    "fact", "product",
)
def top_products(t):
    return kpi.top_products(fact(t), t.product())


@query("revenue_by_salesperson", "SELECT f.salesperson_id, salesperson_name, CAST(sum(net_sales) AS DOUBLE) AS revenue FROM fact f JOIN salesperson s ON f.salesperson_id = s.salesperson_id GROUP BY 1, 2", "fact", "salesperson")
def revenue_by_salesperson(t):
    return kpi.revenue_by_salesperson(fact(t), t.salesperson())


@query(
    "top_customers",
    """SELECT f.customer_id, customer_name, count(DISTINCT sales_order_id) AS orders, CAST(sum(net_sales) AS DOUBLE) AS revenue, round(CAST(sum(net_sales) AS DOUBLE) / count(*), 2) AS avg_line_value
    FROM fact f JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY 1, 2 ORDER BY sum(net_sales) DESC, 1 LIMIT 20""",
    "fact", "dim_customer",
)
def top_customers(t):
    return kpi.top_customers(fact(t), named_customers(t))


@query(
    "bi_validation",
    """SELECT CAST(round(sum(net_sales), 2) AS DOUBLE) AS revenue, count(DISTINCT sales_order_id) AS orders, count(*) AS line_items, CAST(sum(order_qty) AS BIGINT) AS units,
    round(CAST(sum(net_sales) AS DOUBLE) / count(DISTINCT sales_order_id), 2) AS avg_order_value, round(CAST(sum(CAST(unit_price AS DECIMAL(14,4)) * CAST(order_qty AS DECIMAL(5,0))) AS DOUBLE) / CAST(sum(order_qty) AS DOUBLE), 2) AS avg_item_price,
    CAST(round(sum(discount_amount), 2) AS DOUBLE) AS discount, count(DISTINCT customer_id) AS customers, count(DISTINCT salesperson_id) AS salespeople FROM fact""",
    "fact",
)
def bi_validation(t):
    return kpi.bi_validation(fact(t))


@query(
    "sliced_revenue",
    """SELECT territory_id, CAST(sum(net_sales) AS DOUBLE) AS revenue, count(*) AS line_items FROM fact WHERE order_date_id BETWEEN 19960101 AND 19981231 AND territory_id IN (1, 2, 3, 5, 8)
    AND product_id IN (SELECT product_id FROM product WHERE product_line IN ('Brand#11', 'Brand#12', 'Brand#13')) GROUP BY 1""",
    "fact", "product",
)
def sliced_revenue(t):
    return kpi.sliced_revenue(fact(t), 19960101, 19981231, [1, 2, 3, 5, 8], t.product().where(F.col("product_line").isin("Brand#11", "Brand#12", "Brand#13")))


@query(
    "revenue_growth",
    f"SELECT year, revenue, round((revenue - lag(revenue) OVER (ORDER BY year)) / lag(revenue) OVER (ORDER BY year), 6) AS growth FROM ({_period('year')})",
    "fact", "dim_date",
)
def revenue_growth(t):
    """Extension beyond the reference."""
    return kpi.revenue_growth(fact(t), gold.dim_date(t.header()))


@query(
    "customer_rfm",
    """SELECT customer_id, CAST(DATE '2002-01-01' - strptime(CAST(max(order_date_id) AS VARCHAR), '%Y%m%d')::DATE AS BIGINT) AS recency, count(DISTINCT sales_order_id) AS frequency, CAST(sum(net_sales) AS DOUBLE) AS money FROM fact GROUP BY 1""",
    "fact",
)
def customer_rfm(t):
    """Extension beyond the reference."""
    return kpi.rfm(fact(t), 20020101)


# Bronze: scans, lineage, quarantine.


@query("bronze_scan", "SELECT l_orderkey, l_partkey, CAST(l_quantity AS DOUBLE) AS l_quantity FROM lineitem")
def bronze_scan(t):
    return readers.scan(t.table("lineitem"), ["l_orderkey", "l_partkey", "l_quantity"])


@query("resume_scan", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 1000")
def resume_scan(t):
    return readers.scan(t.table("orders"), ["o_orderkey", "o_custkey"], key="o_orderkey", after=1000)


@query("stable_key_batch", "SELECT sales_order_detail_id, product_id FROM detail WHERE sales_order_detail_id > 5000000 AND sales_order_detail_id <= 50000000", "detail")
def stable_key_batch(t):
    return readers.between_keys(t.detail(), "sales_order_detail_id", 5_000_000, 50_000_000).select("sales_order_detail_id", "product_id")


@query(
    "fact_batches",
    """SELECT b AS batch_number, lag(max(k)) OVER (ORDER BY b) AS lower_bound, max(k) AS upper_bound, count(*) AS rows
    FROM (SELECT sales_order_detail_id AS k, CAST((row_number() OVER (ORDER BY sales_order_detail_id) - 1) // 10000 + 1 AS BIGINT) AS b FROM detail) GROUP BY b""",
    "detail",
)
def fact_batches(t):
    return gold.fact_batches(t.detail(), 10_000)


@query("header_semijoin", "SELECT sales_order_id, customer_id FROM header WHERE sales_order_id IN (SELECT sales_order_id FROM detail WHERE sales_order_detail_id > 5000000 AND sales_order_detail_id <= 50000000)", "header", "detail")
def header_semijoin(t):
    batch = readers.between_keys(t.detail(), "sales_order_detail_id", 5_000_000, 50_000_000)
    return t.header().join(batch.select("sales_order_id"), "sales_order_id", "left_semi").select("sales_order_id", "customer_id")


@query("snapshot_read", "SELECT o_orderkey, o_totalprice, 'snap-2' AS source_snapshot_id FROM orders WHERE o_orderkey % 2 = 0")
def snapshot_read(t):
    parity = F.when(F.col("o_orderkey") % 2 == 0, "snap-2").otherwise("snap-1")
    return readers.of_snapshot(t.table("orders").withColumn("source_snapshot_id", parity), "snap-2", "snap-2").select("o_orderkey", "o_totalprice", "source_snapshot_id")


@query(
    "bronze_lineage",
    f"SELECT c_custkey, c_name, 'sales_oltp' AS _source_system, 'customer' AS _source_table, '2024-09-01' AS _load_date, {raw.hash_sql('c_custkey', 'c_name')} AS _record_hash FROM customer",
)
def bronze_lineage(t):
    return raw.with_lineage(t.table("customer").select("c_custkey", "c_name"), "customer", raw.OLD)


@query("bronze_quarantine", f"SELECT {raw.hash_sql('k', 'c_name')} AS record_key, 'NULL primary key: k' AS rejection_reason FROM (SELECT CASE WHEN c_custkey % 11 <> 0 THEN c_custkey END AS k, c_name FROM customer) WHERE k IS NULL")
def bronze_quarantine(t):
    rows = t.table("customer").select(F.when(F.col("c_custkey") % 11 != 0, F.col("c_custkey")).alias("k"), "c_name")
    return quality.null_key_rows(raw.with_lineage(rows, "customer", raw.OLD), "k")


@query("union_batches", "SELECT l_returnflag, count(*) AS rows FROM (SELECT * FROM lineitem WHERE l_orderkey <= 5000 UNION ALL SELECT * FROM lineitem WHERE l_orderkey > 5000) GROUP BY 1")
def union_batches(t):
    lines = t.table("lineitem")
    return readers.union_batches([lines.where("l_orderkey <= 5000"), lines.where("l_orderkey > 5000")]).groupBy("l_returnflag").agg(F.count("*").alias("rows"))


@query("legacy_text_load", 'SELECT CAST(p_partkey AS VARCHAR) AS "p_partkey", p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part')
def legacy_text_load(t):
    return readers.all_text(t.table("part"))


_CATALOG = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
_REFERS = {
    ("nation", "n_regionkey"): "region.r_regionkey", ("customer", "c_nationkey"): "nation.n_nationkey", ("supplier", "s_nationkey"): "nation.n_nationkey", ("orders", "o_custkey"): "customer.c_custkey",
    ("lineitem", "l_orderkey"): "orders.o_orderkey", ("lineitem", "l_partkey"): "part.p_partkey", ("lineitem", "l_suppkey"): "supplier.s_suppkey",
}


@query(
    "catalog_inventory",
    f"""SELECT c.table_name, c.column_name, CASE c.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date'
        WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE CASE WHEN c.data_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' ELSE lower(c.data_type) END END AS type,
    CAST(c.ordinal_position AS BIGINT) AS place, row_count, coalesce(r.refers_to, '') AS refers_to
    FROM information_schema.columns c JOIN ({" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _CATALOG)}) n ON n.table_name = c.table_name
    LEFT JOIN (VALUES {", ".join(f"('{t}', '{c}', '{to}')" for (t, c), to in _REFERS.items())}) r(table_name, column_name, refers_to) ON r.table_name = c.table_name AND r.column_name = c.column_name""",
)
def catalog_inventory(t):
    return readers.catalog(t.spark, {n: t.table(n) for n in _CATALOG}, _REFERS)


@query("quarantine_date", """SELECT SalesOrderID, CAST(try_cast(OrderDate AS DATE) AS VARCHAR) AS order_date, OrderDate IS NOT NULL AND try_cast(OrderDate AS DATE) IS NULL AS rejected FROM raw_header""", "raw_header")
def quarantine_date(t):
    day = to_date(F.col("OrderDate"))
    return raw.raw_header(t).select("SalesOrderID", day.alias("order_date"), (F.col("OrderDate").isNotNull() & day.isNull()).alias("rejected"))


@query("quarantine_numeric", "SELECT SalesOrderID, CAST(try_cast(TotalDue AS DECIMAL(19,4)) AS DOUBLE) AS total_due, try_cast(TotalDue AS DECIMAL(19,4)) IS NULL AS rejected FROM raw_header", "raw_header")
def quarantine_numeric(t):
    return raw.raw_header(t).select("SalesOrderID", to_number(F.col("TotalDue")).alias("total_due"), to_number(F.col("TotalDue")).isNull().alias("rejected"))


@query("quarantine_integer", "SELECT SalesOrderID, CustomerID, try_cast(CustomerID AS DECIMAL(28,8)) % 1 <> 0 AS rejected FROM raw_header", "raw_header")
def quarantine_integer(t):
    return raw.raw_header(t).select("SalesOrderID", "CustomerID", (~is_whole(F.col("CustomerID"))).alias("rejected"))


@query("quarantine_blank", "SELECT CustomerID, AccountNumber IS NOT NULL AND trim(AccountNumber) = '' AS rejected, _load_date FROM raw_customer", "raw_customer")
def quarantine_blank(t):
    return raw.raw_customer(t).select("CustomerID", is_blank(F.col("AccountNumber")).alias("rejected"), "_load_date")


_REASONS = """array_to_string(list_filter([CASE WHEN OrderDate IS NOT NULL AND try_cast(OrderDate AS DATE) IS NULL THEN 'invalid date: OrderDate' END, CASE WHEN TotalDue IS NOT NULL AND try_cast(TotalDue AS DECIMAL(19,4)) IS NULL THEN 'invalid numeric: TotalDue' END,
    CASE WHEN CustomerID IS NOT NULL AND try_cast(CustomerID AS DECIMAL(28,8)) % 1 <> 0 THEN 'invalid integer: CustomerID' END], lambda x: x IS NOT NULL), '; ')"""
_HEADER_RULES = quality.ConversionRules(("OrderDate",), ("TotalDue",), ("SalesOrderID", "CustomerID"))


@query("silver_rejected", f"SELECT CAST(SalesOrderID AS VARCHAR) AS record_key, {_REASONS} AS rejection_reason FROM raw_header WHERE {_REASONS} <> ''", "raw_header")
def silver_rejected(t):
    return quality.rejected_rows(raw.raw_header(t), _HEADER_RULES, "SalesOrderID")


@query("silver_valid", f"SELECT SalesOrderID, _load_date, _record_hash FROM raw_header WHERE {_REASONS} = ''", "raw_header")
def silver_valid(t):
    return quality.valid_rows(raw.raw_header(t), _HEADER_RULES).select("SalesOrderID", "_load_date", "_record_hash")


# Dedup rules.


@query("dedup_latest", "SELECT SalesOrderID, TotalDue, _load_date FROM raw_header QUALIFY row_number() OVER (PARTITION BY SalesOrderID ORDER BY _load_date DESC NULLS LAST, _record_hash DESC NULLS LAST) = 1", "raw_header")
def dedup_latest(t):
    return quality.dedup_latest(raw.raw_header(t), "SalesOrderID").select("SalesOrderID", "TotalDue", "_load_date")


_SIGNATURE = raw.hash_sql("o_orderstatus", "_load_date", "o_custkey")


@query(
    "dedup_cleaner",
    f"""SELECT * FROM (SELECT o_orderkey, o_custkey, o_orderstatus, '2024-09-01' AS _load_date FROM orders UNION ALL SELECT o_orderkey, o_custkey + 1, o_orderstatus, '2024-09-01' FROM orders WHERE o_orderkey % 7 = 0)
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY _load_date DESC NULLS LAST, {_SIGNATURE}) = 1""",
)
def dedup_cleaner(t):
    rows = t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.lit(raw.OLD).alias("_load_date"))
    return quality.dedup_by_signature(rows.unionByName(rows.where("o_orderkey % 7 = 0").withColumn("o_custkey", F.col("o_custkey") + 1)), "o_orderkey")


@query("dup_count", "SELECT count(SalesOrderID) - count(DISTINCT SalesOrderID) AS duplicate_keys FROM raw_header", "raw_header")
def dup_count(t):
    return quality.duplicate_count(raw.raw_header(t), "SalesOrderID")


@query("dup_groups", "SELECT SalesOrderID, count(*) AS rows FROM raw_header GROUP BY 1 HAVING count(*) > 1", "raw_header")
def dup_groups(t):
    return quality.duplicate_groups(raw.raw_header(t), "SalesOrderID")


@query("null_pk", "SELECT count(*) FILTER (WHERE k IS NULL) AS null_keys, count(*) AS row_count FROM (SELECT CASE WHEN c_custkey % 11 <> 0 THEN c_custkey END AS k FROM customer)")
def null_pk(t):
    rows = t.table("customer").select(F.when(F.col("c_custkey") % 11 != 0, F.col("c_custkey")).alias("k"))
    return rows.agg(F.count_if(F.col("k").isNull()).alias("null_keys"), F.count("*").alias("row_count"))


# Silver.

_LATEST_HEADER = "QUALIFY row_number() OVER (PARTITION BY SalesOrderID ORDER BY _load_date DESC NULLS LAST) = 1"


_CLEAN_HEADER = f"""SELECT SalesOrderID AS sales_order_id, CAST(CAST(OrderDate AS DATE) AS VARCHAR) AS order_date, DueDate AS due_date, ShipDate AS ship_date, CustomerID AS customer_id, SalesPersonID AS salesperson_id,
    TerritoryID AS territory_id, CAST(SubTotal AS DOUBLE) AS subtotal, CAST(TaxAmt AS DOUBLE) AS tax_amt, CAST(Freight AS DOUBLE) AS freight, CAST(CAST(TotalDue AS DECIMAL(19,4)) AS DOUBLE) AS total_due,
    OnlineOrderFlag AS is_online_order, Status AS status_code, _source_system, _load_date FROM (SELECT * FROM raw_header WHERE {_REASONS} = '') {_LATEST_HEADER}"""


@query("silver_header", _CLEAN_HEADER, "raw_header")
def silver_header(t):
    return silver.clean_header(quality.valid_rows(raw.raw_header(t), silver.RULES["sales_order_header"])).drop("_record_hash")


_CLEAN_DETAIL = """SELECT SalesOrderDetailID AS sales_order_detail_id, SalesOrderID AS sales_order_id, ProductID AS product_id, CAST(OrderQty AS BIGINT) AS order_qty, CAST(CAST(UnitPrice AS DECIMAL(19,4)) AS DOUBLE) AS unit_price,
    CAST(CAST(UnitPriceDiscount AS DECIMAL(19,4)) AS DOUBLE) AS unit_price_discount, CAST(CAST(LineTotal AS DECIMAL(19,4)) AS DOUBLE) AS line_total, _source_system, _load_date FROM raw_detail WHERE OrderQty <> '1.5' AND LineTotal <> '1,000'"""


@query("silver_detail", _CLEAN_DETAIL, "raw_detail")
def silver_detail(t):
    return silver.clean_detail(quality.valid_rows(raw.raw_detail(t), silver.RULES["sales_order_detail"])).drop("_record_hash")


_CLEAN_CUSTOMER = r"""SELECT CustomerID AS customer_id, CASE WHEN PersonID IS NOT NULL THEN n ELSE a END AS customer_name, CASE WHEN PersonID IS NOT NULL THEN 'INDIVIDUAL' ELSE 'STORE' END AS customer_type,
    CASE WHEN PersonID IS NOT NULL THEN 'PERSON' ELSE 'ACCOUNT' END AS customer_name_source, PersonID AS person_id, StoreID AS store_id, TerritoryID AS territory_id, a AS account_number, _source_system, _load_date
    FROM (SELECT *, regexp_replace(AccountNumber, '^\s+|\s+$', '', 'g') AS a FROM raw_customer WHERE trim(AccountNumber) <> '') LEFT JOIN names ON business_entity_id = PersonID
    QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY _load_date DESC) = 1"""


@query("silver_customer", _CLEAN_CUSTOMER, "raw_customer", "names")
def silver_customer(t):
    clean = silver.clean_customer(quality.valid_rows(raw.raw_customer(t), silver.RULES["customer"]), raw.raw_person(t))
    return clean.drop("_record_hash")


_CLEAN_TERRITORY = r"""SELECT TerritoryID AS territory_id, trim(Name) AS territory_name, CountryRegionCode AS country_region_code, "Group" AS territory_group, _source_system, _load_date FROM raw_territory
    WHERE regexp_replace(CountryRegionCode, '^\s+$', '') <> '' AND trim("Group") <> ''"""


@query("silver_territory", _CLEAN_TERRITORY, "raw_territory")
def silver_territory(t):
    return silver.clean_territory(quality.valid_rows(raw.raw_territory(t), silver.RULES["sales_territory"])).drop("_record_hash")


@query(
    "silver_rejected_territory",
    r"""SELECT CAST(TerritoryID AS VARCHAR) AS record_key, array_to_string(list_filter([CASE WHEN regexp_replace(CountryRegionCode, '^\s+$', '') = '' THEN 'blank string: CountryRegionCode' END,
    CASE WHEN trim("Group") = '' THEN 'blank string: Group' END], lambda x: x IS NOT NULL), '; ') AS rejection_reason FROM raw_territory WHERE regexp_replace(CountryRegionCode, '^\s+$', '') = '' OR trim("Group") = ''""",
    "raw_territory",
)
def silver_rejected_territory(t):
    return quality.rejected_rows(raw.raw_territory(t), silver.RULES["sales_territory"], "TerritoryID")


_SALESPERSON = """SELECT e AS salesperson_id, e AS business_entity_id, territory_id, coalesce(n, '') AS salesperson_name, CAST(250000 AS DOUBLE) AS sales_quota, CAST(0 AS DOUBLE) AS bonus,
    CAST(0.015 AS DOUBLE) AS commission_pct, 'PERSON' AS name_source, _source_system, _load_date FROM (SELECT BusinessEntityID AS e, TerritoryID AS territory_id, _source_system, _load_date FROM raw_salesperson) LEFT JOIN names ON business_entity_id = e"""


@query("silver_salesperson", _SALESPERSON, "raw_salesperson", "names")
def silver_salesperson(t):
    return silver.clean_salesperson(raw.raw_salesperson(t), raw.raw_person(t)).drop("_record_hash")


@query(
    "salesperson_fix",
    f"""SELECT * REPLACE (CAST(salesperson_id AS VARCHAR) AS salesperson_id, CAST(business_entity_id AS VARCHAR) AS business_entity_id, CASE WHEN salesperson_id % 3 = 0 THEN salesperson_name ELSE '' END AS salesperson_name) FROM ({_SALESPERSON})""",
    "raw_salesperson", "names",
)
def salesperson_fix(t):
    people = raw.raw_person(t).withColumn("PersonType", F.when(F.col("BusinessEntityID") % 3 == 0, "SP").otherwise("IN"))
    return silver.rebuild_salespeople(raw.raw_salesperson(t), people).drop("_record_hash")


_CLEAN_PRODUCT = """SELECT ProductID AS product_id, trim(Name) AS product_name, ProductNumber AS product_number, ProductLine AS product_line, Class AS class, Style AS style, CAST(CAST(ListPrice AS DECIMAL(19,4)) AS DOUBLE) AS list_price,
    CAST(NULL AS DOUBLE) AS standard_cost, DiscontinuedDate IS NOT NULL AS is_discontinued, _source_system, _load_date FROM raw_product WHERE ListPrice <> 'n/a' AND trim(ProductNumber) <> ''"""


@query(
    "silver_rejected_product",
    """SELECT CAST(ProductID AS VARCHAR) AS record_key, CASE WHEN ListPrice <> 'n/a' THEN 'blank string: ProductNumber' WHEN trim(ProductNumber) = '' THEN 'invalid numeric: ListPrice; blank string: ProductNumber' ELSE 'invalid numeric: ListPrice' END AS rejection_reason
    FROM raw_product WHERE ListPrice = 'n/a' OR trim(ProductNumber) = ''""",
    "raw_product",
)
def silver_rejected_product(t):
    return quality.rejected_rows(raw.raw_product(t), silver.RULES["product"], "ProductID")


@query("silver_product", _CLEAN_PRODUCT, "raw_product")
def silver_product(t):
    return silver.clean_product(quality.valid_rows(raw.raw_product(t), silver.RULES["product"])).drop("_record_hash")


# Orphans: foreign keys of the fact, and Silver's join checks; every 13th key is bent out of range.


def _bent(column: str) -> F.Column:
    return F.when(F.col("sales_order_detail_id") % 13 == 0, F.col(column) + 900_000_000).otherwise(F.col(column))


for _column, (_dimension, _key) in validation.FACT_KEYS.items():
    _parent = {"dim_date": "dim_date", "dim_customer": "cust", "dim_product": "product", "dim_territory": "territory", "dim_salesperson": "salesperson"}[_dimension]

    def _fact_orphans(t, column=_column, dimension=_dimension, key=_key):
        bent = fact(t).withColumn(column, _bent(column)).select("sales_order_detail_id", column)
        return quality.orphans(bent, column, dimensions(t)[dimension], key)

    query(
        f"orphans_fact_{_dimension.removeprefix('dim_')}",
        f"""SELECT sales_order_detail_id, k AS {_column} FROM (SELECT sales_order_detail_id, CASE WHEN sales_order_detail_id % 13 = 0 THEN {_column} + 900000000 ELSE {_column} END AS k FROM fact) f
        WHERE k IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_parent} p WHERE p.{_key} = f.k)""",
        "fact", _parent,
    )(_fact_orphans)

_SILVER_CHECKS = {
    "detail_header": ("detail", "sales_order_detail_id", "sales_order_id", "header", "sales_order_id"), "detail_product": ("detail", "sales_order_detail_id", "product_id", "product", "product_id"),
    "header_customer": ("header", "sales_order_id", "customer_id", "customer", "customer_id"), "header_territory": ("header", "sales_order_id", "territory_id", "territory", "territory_id"),
    "header_salesperson": ("header", "sales_order_id", "salesperson_id", "salesperson", "salesperson_id"),
}
for _name, (_child, _id, _fk, _parent, _pk) in _SILVER_CHECKS.items():

    def _silver_orphans(t, child=_child, row=_id, fk=_fk, parent=_parent, pk=_pk):
        rows = getattr(t, child)().select(row, fk) if row != fk else getattr(t, child)().select(row)
        return quality.orphans(rows, fk, getattr(t, parent)().where(f"{pk} % 17 <> 0"), pk).select(row, fk)

    _cte = "cust" if _parent == "customer" else _parent
    query(
        f"orphans_silver_{_name}",
        f"SELECT {_id}, {_fk} FROM {_child} c WHERE {_fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_cte} p WHERE p.{_pk} = c.{_fk} AND p.{_pk} % 17 <> 0)",
        _child, _cte,
    )(_silver_orphans)


# Profiles.


@query(
    "profile_nulls",
    """SELECT c AS column_name, n AS null_count, CASE WHEN r = 0 THEN 0.0 ELSE round(100.0 * CAST(n AS DOUBLE) / r, 2) END AS null_percent FROM (
    SELECT unnest(['sales_order_id', 'customer_id', 'salesperson_id', 'territory_id']) AS c, unnest([count(*) - count(sales_order_id), count(*) - count(customer_id), count(*) - count(salesperson_id), count(*) - count(territory_id)]) AS n, count(*) AS r FROM header)""",
    "header",
)
def profile_nulls(t):
    return quality.profile_nulls(t.header().select("sales_order_id", "customer_id", "salesperson_id", "territory_id"))


@query(
    "profile_dates",
    """SELECT 'o_orderdate' AS column_name, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_date, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_date FROM orders""",
)
def profile_dates(t):
    return quality.profile_dates(t.table("orders"), ["o_orderdate"])


_TABLES = {"orders": "Sales", "lineitem": "Sales", "customer": "Sales", "part": "Production", "supplier": "Person"}


@query(
    "profile_inventory",
    "WITH c AS ("
    + " UNION ALL ".join(f"SELECT '{s}' AS schema_name, '{n}' AS table_name, count(*) AS row_count FROM {n}" for n, s in _TABLES.items())
    + ") SELECT * FROM c UNION ALL SELECT schema_name, '*', CAST(sum(row_count) AS BIGINT) FROM c GROUP BY 1",
)
def profile_inventory(t):
    return quality.inventory({n: (s, t.table(n)) for n, s in _TABLES.items()})


# Validation counters.


@query(
    "bronze_validation",
    """SELECT count(*) AS row_count, count(*) FILTER (WHERE SalesOrderID IS NULL) AS null_keys, count(SalesOrderID) - count(DISTINCT SalesOrderID) AS duplicate_keys,
    count(*) FILTER (WHERE _load_date IS NULL OR _record_hash IS NULL) AS missing_lineage, count(*) FILTER (WHERE _source_table <> 'sales_order_header') AS foreign_rows FROM raw_header""",
    "raw_header",
)
def bronze_validation(t):
    return validation.bronze_counters(raw.raw_header(t), "SalesOrderID", "sales_order_header")


def _raw_frames(t: SalesTables) -> dict[str, DataFrame]:
    return {
        "sales_order_header": raw.raw_header(t), "sales_order_detail": raw.raw_detail(t), "customer": raw.raw_customer(t), "sales_territory": raw.raw_territory(t),
        "sales_person": raw.raw_salesperson(t), "product": raw.raw_product(t),
    }


def _clean_frames(t: SalesTables, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    people = raw.raw_person(t)
    valid = {n: quality.valid_rows(df, silver.RULES[n]) for n, df in frames.items()}
    return {n: silver.CLEANERS[n](df, people) if n in ("customer", "sales_person") else silver.CLEANERS[n](df) for n, df in valid.items()}


#: The clean tables for DuckDB, with the relations they need.
_CLEAN = {
    "sales_order_header": (_CLEAN_HEADER, "raw_header"), "sales_order_detail": (_CLEAN_DETAIL, "raw_detail"), "customer": (_CLEAN_CUSTOMER, "raw_customer"),
    "sales_territory": (_CLEAN_TERRITORY, "raw_territory"), "sales_person": (_SALESPERSON, "raw_salesperson"), "product": (_CLEAN_PRODUCT, "raw_product"),
}
_CLEAN_NEEDS = (*[n for _, n in _CLEAN.values()], "names")


def _missing(columns: tuple[str, ...], blank: bool) -> str:
    return " + ".join(f"count(*) FILTER (WHERE {c} IS NULL" + (f" OR trim(CAST({c} AS VARCHAR)) = ''" if blank else "") + ")" for c in columns) or "0"


@query(
    "silver_validation",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, count(*) FILTER (WHERE {SILVER[n].key} IS NULL) AS null_keys, count({SILVER[n].key}) - count(DISTINCT {SILVER[n].key}) AS duplicate_keys, {_missing(SILVER[n].required, True)} AS missing_required FROM ({body})"
        for n, (body, _) in _CLEAN.items()
    ),
    *_CLEAN_NEEDS,
)
def silver_validation(t):
    parts = []
    for name, df in _clean_frames(t, _raw_frames(t)).items():
        counters = validation.silver_counters(df, SILVER[name].key, SILVER[name].required)
        missing = sum((F.col(f"missing_{c}") for c in SILVER[name].required), F.lit(0).cast("bigint"))
        parts.append(counters.select(F.lit(name).alias("table_name"), "row_count", "null_keys", "duplicate_keys", missing.alias("missing_required")))
    return readers.union_batches(parts)


@query("detail_grain", "SELECT count(*) AS row_count, count(DISTINCT k) AS distinct_keys, count(k) - count(DISTINCT k) AS duplicate_keys FROM (SELECT l_orderkey * 10 + l_linenumber AS k FROM lineitem)")
def detail_grain(t):
    return validation.detail_grain(t.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k")), "k")


@query(
    "silver_quality",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, (SELECT count(*) FROM {bronze}) AS bronze_rows, count(*) AS silver_rows, count(*) <= (SELECT count(*) FROM {bronze}) AS no_unexpected_rows,
        (SELECT count(*) FROM (SELECT 1 FROM ({body}) GROUP BY {validation.REQUIRED[n][0]} HAVING count(*) > 1)) AS duplicate_key_groups, {_missing(validation.REQUIRED[n], False)} AS missing_required FROM ({body})"""
        for n, (body, bronze) in _CLEAN.items()
    ),
    *_CLEAN_NEEDS,
)
def silver_quality(t):
    frames = _raw_frames(t)
    return readers.union_batches([validation.silver_quality(frames[n], df, n) for n, df in _clean_frames(t, frames).items()])


@query(
    "dim_validation",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, count(*) FILTER (WHERE {k} IS NULL) AS null_keys, count({k}) - count(DISTINCT {k}) AS duplicate_keys FROM {c}"
        for n, k, c in (("dim_date", "date_id", "dim_date"), ("dim_customer", "customer_id", "cust"), ("dim_product", "product_id", "product"), ("dim_territory", "territory_id", "territory"), ("dim_salesperson", "salesperson_id", "salesperson"))
    ),
    "dim_date", "cust", "product", "territory", "salesperson",
)
def dim_validation(t):
    parts = [validation.dimension_counters(df, n, next(k for d, k in validation.FACT_KEYS.values() if d == n)) for n, df in dimensions(t).items()]
    return readers.union_batches(parts)


_NEGATIVE = ", ".join(f"count(*) FILTER (WHERE {m} < -1e-9) AS negative_{m}, count(*) FILTER (WHERE {m} IS NULL) AS null_{m}" for m in gold.MEASURES)


@query(
    "fact_validation",
    f"""SELECT count(*) AS row_count, count(*) FILTER (WHERE sales_order_detail_id IS NULL) AS null_keys, count(sales_order_detail_id) - count(DISTINCT sales_order_detail_id) AS duplicate_keys, {_NEGATIVE},
    count(*) FILTER (WHERE abs(order_qty * unit_price - line_total - discount_amount) > 0.0001) AS broken_discount, count(*) FILTER (WHERE net_sales <> line_total) AS broken_net_sales
    FROM (SELECT * REPLACE (CASE WHEN sales_order_detail_id % 29 = 0 THEN discount_amount - 5000 ELSE discount_amount END AS discount_amount) FROM fact)""",
    "fact",
)
def fact_validation(t):
    return validation.fact_counters(fact(t).withColumn("discount_amount", F.expr("if(sales_order_detail_id % 29 = 0, discount_amount - 5000, discount_amount)")))


_INTEGRITY_DIMENSIONS = (("order_date_id", "date_id", "dim_date", "dim_date"), ("customer_id", "customer_id", "dim_customer", "cust"), ("product_id", "product_id", "dim_product", "product"), ("territory_id", "territory_id", "dim_territory", "territory"), ("salesperson_id", "salesperson_id", "dim_salesperson", "salesperson"))
_FACT_CHECKS = {
    "null_keys": "sales_order_detail_id IS NULL", **{f"negative_{m}": f"{m} < -1e-9" for m in gold.MEASURES}, **{f"null_{m}": f"{m} IS NULL" for m in gold.MEASURES},
    "broken_discount": "abs(order_qty * unit_price - line_total - discount_amount) > 0.0001", "broken_net_sales": "net_sales <> line_total",
}


@query(
    "gold_integrity",
    "SELECT *, failures = 0 AS passed FROM ("
    + " UNION ALL ".join(
        [f"SELECT 'fact_sales.{n}' AS check, count(*) FILTER (WHERE {test}) AS failures FROM spoilt" for n, test in _FACT_CHECKS.items()]
        + ["SELECT 'fact_sales.duplicate_keys', count(sales_order_detail_id) - count(DISTINCT sales_order_detail_id) FROM spoilt"]
        + [f"SELECT '{d}.null_keys', count(*) FILTER (WHERE {k} IS NULL) FROM {p} UNION ALL SELECT '{d}.duplicate_keys', count({k}) - count(DISTINCT {k}) FROM {p}" for _, k, d, p in _INTEGRITY_DIMENSIONS]
        + [f"SELECT 'orphans.{c}', count(*) FROM spoilt f WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{k} = f.{c})" for c, k, _, p in _INTEGRITY_DIMENSIONS]
    )
    + ")",
    "spoilt", "dim_date", "cust", "product", "territory", "salesperson",
)
def gold_integrity(t):
    """All rows of all dimensions; some foreign keys of lines, discounts and net sales are spoilt."""
    return validation.gold_integrity(_spoilt(fact(t)), dimensions(t))
