"""The sales operators on literal rows, and every query against its SQL."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewell.functions import identity
from tidewell.operators import gold, holidays, kpi, quality, silver, validation
from tidewell.operators.quality import ContractError
from tidewell.plans.contracts import GOLD, check_contract, ddl
from tidewell.plans.registry import ORACLES, QUERIES
from tidewell.sources import readers

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{SMALL}/{name}.parquet"):
            connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: None if v is None else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted([tuple(norm(r[i]) for i in order) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        assert got
        return
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, want.fetchall())


def header(spark, *rows):
    return spark.createDataFrame(list(rows), "SalesOrderID int, OrderDate string, TotalDue string, CustomerID int, _load_date string")


def test_header_cleaner_takes_the_latest_load_in_any_order(spark):
    rows = [(1, "2024-01-02", "13.00", 7, "2024-08-31"), (1, "2024-01-03", "15.90", 7, "2024-09-01"), (2, "2024-01-04", "1", 8, None)]
    for order in (rows, rows[::-1]):
        got = {r["sales_order_id"]: r for r in silver.clean_header(header(spark, *order)).collect()}
        assert float(got[1]["total_due"]) == 15.9 and str(got[1]["order_date"]) == "2024-01-03" and len(got) == 2


def test_conversion_errors_are_rejected_with_reasons(spark):
    df = header(spark, (1, "2024-01-02", "1", 7, ""), (2, "not-a-date", "x", 7, ""), (3, None, None, None, ""))
    rules = silver.RULES["sales_order_header"]
    assert [r["SalesOrderID"] for r in quality.valid_rows(df, rules).collect()] == [1, 3]
    assert quality.rejected_rows(df, rules, "SalesOrderID").collect() == [("2", "invalid date: OrderDate; invalid numeric: TotalDue")]


@pytest.mark.parametrize(("text", "number", "whole"), [(" 12 ", 12.0, True), ("1e3", 1000.0, True), ("12.5", 12.5, False), ("", None, None), ("1,000", None, None), ("inf", None, None), ("NaN", None, None), (None, None, None)])
def test_numbers(spark, text, number, whole):
    from tidewell.functions.columns import is_whole, to_number

    row = spark.createDataFrame([(text,)], "t string").select(to_number(F.col("t")).cast("double").alias("n"), is_whole(F.col("t")).alias("w")).first()
    assert (row["n"], row["w"]) == (number, whole)


def test_customers_are_named_by_person_or_account(spark):
    people = spark.createDataFrame([(101, "Ada", "Lovelace"), (101, "Zoe", "Z")], "BusinessEntityID int, FirstName string, LastName string")
    frame = spark.createDataFrame([(1, 101, None, 3, "AW1"), (2, None, 9, 3, " AW000202\t")], "CustomerID int, PersonID int, StoreID int, TerritoryID int, AccountNumber string")
    got = {r["customer_id"]: (r["customer_name"], r["customer_type"], r["customer_name_source"]) for r in silver.clean_customer(frame, people).collect()}
    assert got == {1: ("Ada Lovelace", "INDIVIDUAL", "PERSON"), 2: ("AW000202", "STORE", "ACCOUNT")}
    lost = spark.createDataFrame([(3, 303, None, 3, "x")], frame.schema)
    with pytest.raises(PySparkException, match="without a resolved name: 3"):
        silver.clean_customer(lost, people).collect()


def test_product_cleaner(spark):
    frame = spark.createDataFrame([(1, "  Road Bike  ", "12.50", "2025-01-01"), (2, "B", "bad", None)], "ProductID int, Name string, ListPrice string, DiscontinuedDate string")
    got = {r["product_id"]: (r["product_name"], r["is_discontinued"], r["list_price"]) for r in silver.clean_product(frame).collect()}
    assert got[1][:2] == ("Road Bike", True) and got[2] == ("B", False, None)


def test_dedup_rules(spark):
    df = spark.createDataFrame([(1, "old", "2024-09-04", "a"), (1, "new", "2024-09-05", "a"), (2, "x", None, "b"), (2, "y", None, "c")], "id int, v string, _load_date string, _record_hash string")
    assert {(r["id"], r["v"]) for r in quality.dedup_latest(df, "id").collect()} == {(1, "new"), (2, "y")}
    assert quality.duplicate_count(df, "id").first()[0] == 2
    nulls = spark.createDataFrame([(1,), (1,), (None,), (None,)], "id int")
    assert quality.duplicate_count(nulls, "id").first()[0] == 1


def test_calendar(spark):
    days = gold.dim_date(spark.createDataFrame([("2011-05-28",), ("2011-05-30",), (None,)], "order_date string")).orderBy("date_id").collect()
    assert [(r["date_id"], r["is_weekend"], r["month_name"]) for r in days] == [(20110528, True, "May"), (20110529, True, "May"), (20110530, False, "May")]
    with pytest.raises(PySparkException, match="no valid order date"):
        gold.dim_date(spark.createDataFrame([(None,)], "order_date string")).collect()


def fact_input(spark, *details):
    d = spark.createDataFrame(list(details), "sales_order_id long, sales_order_detail_id long, product_id long, order_qty int, unit_price decimal(19,4), line_total decimal(19,4)")
    h = spark.createDataFrame([(1, "2011-06-15", 5, 6, None)], "sales_order_id long, order_date string, customer_id long, territory_id long, salesperson_id long")
    return d, h


def test_fact_measures_and_unmatched_lines(spark):
    from decimal import Decimal as D

    d, h = fact_input(spark, (1, 10, 1, 2, D(10), D(18)), (1, 11, 1, 1, D(10), D(10)))
    row = gold.fact_sales(d, h).where("sales_order_detail_id = 10").first()
    assert (row["order_date_id"], float(row["discount_amount"]), float(row["net_sales"]), row["salesperson_id"]) == (20110615, 2.0, 18.0, None)
    lost, h = fact_input(spark, (2, 10, 1, 2, D(10), D(18)))
    with pytest.raises(PySparkException, match="detail without header: order 2"):
        gold.fact_sales(lost, h).collect()
    with pytest.raises(ContractError):
        gold.require_unique(h.unionByName(h), "sales_order_id", "headers")


def test_kpis_of_nothing_are_zero(spark):
    d, h = fact_input(spark)
    row = kpi.kpi_gold(gold.fact_sales(d.where("false"), h)).first()
    assert set(row.asDict().values()) == {0}


def test_variance(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (102.0, 100.0)], "a double, e double")
    assert [round(r[0], 6) for r in df.select(kpi.relative_variance(F.col("a"), F.col("e"))).collect()] == [0.0, 1.0, 0.02]


def test_fact_batches(spark):
    d = spark.createDataFrame([(10,), (900001,), (None,)], "sales_order_detail_id long")
    assert sorted(map(tuple, gold.fact_batches(d, 1).collect())) == [(1, None, 10, 1), (2, 10, 900001, 1)]
    many = spark.range(1000).select((F.col("id") * 7).alias("sales_order_detail_id")).repartition(9)
    got = sorted(map(tuple, gold.fact_batches(many, 300).collect()))
    assert [(b[0], b[3]) for b in got] == [(1, 300), (2, 300), (3, 300), (4, 100)] and got[1][1] == got[0][2] == 299 * 7


def test_reports(spark):
    df = spark.createDataFrame([(1, "a"), (1, ""), (None, "b")], "id int, name string")
    report = validation.silver_report(df, "id", ("id", "name"), 3, ("name",))
    assert not report.passed and {n for n, ok in report.checks.items() if not ok} == {"null_keys", "duplicate_keys", "required_joins"}
    with pytest.raises(ContractError, match="duplicate_keys"):
        report.require("t")
    assert not validation.silver_report(df, "id", ("id", "other"), 3).checks["columns"]
    assert not validation.silver_report(df.where("name = 'a'"), "id", ("id", "name"), 1, rejected=3, threshold=1).checks["rejections"]
    with pytest.raises(ContractError):
        validation.count_parity(1, 2, "a", "b")


def test_contracts():
    assert not [w for s in GOLD.values() for w in check_contract(s, GOLD)]
    assert "FOREIGN KEY (customer_id) REFERENCES dim_customer (customer_id)" in ddl(GOLD["fact_sales"])


def test_identity(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    assert identity.content_hash(df) == identity.content_hash(df.repartition(7)) != identity.content_hash(df.union(df.limit(1)))
    assert identity.batch_id("t", "k", None, 5, "s") == identity.batch_id("t", "k", None, 5, "s") != identity.batch_id("t", "k", 5, 6, "s")
    assert identity.redact("Password = a;b pwd:x token hush", ["hush"]) == "Password = [REDACTED];b pwd:[REDACTED] token [REDACTED]"
    for bad in ("1a", "a-b", "", "a;drop"):
        with pytest.raises(ValueError, match="safe"):
            identity.safe_name(bad)


@pytest.mark.parametrize("kind", readers.FORMATS)
def test_formats_round_trip(spark, tmp_path, kind):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "é,\"x\"")], "id long, t string")
    readers.write(df, str(tmp_path / "t"), kind)
    assert sorted(map(tuple, readers.read(spark, str(tmp_path / "t"), kind, "id long, t string").collect())) == [(1, "a"), (2, None), (3, "é,\"x\"")]
    with pytest.raises(ContractError):
        readers.read(spark, "x", "xlsx")


def test_filters_reach_the_scan(spark):
    df = readers.scan(spark.read.parquet(f"{SMALL}/orders.parquet"), ["o_orderkey"], "o_orderkey", 1000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,1000)" in plan and "o_custkey" not in plan


def test_header_contract(spark):
    row = header(spark, (1, "2024-01-03", "13.00", 5, "2024-09-01"))
    clean = silver.clean_header(row)
    assert clean.columns == [
        "sales_order_id", "order_date", "due_date", "ship_date", "customer_id", "salesperson_id", "territory_id", "subtotal", "tax_amt", "freight", "total_due", "is_online_order", "status_code", "_source_system", "_load_date",
    ]
    assert clean.first()["_load_date"] == "2024-09-01" and clean.first()["_source_system"] is None


@pytest.mark.parametrize(
    ("table", "row", "reasons"),
    [
        ("sales_territory", {"TerritoryID": 1, "Name": "N", "CountryRegionCode": " ", "Group": ""}, "blank string: CountryRegionCode; blank string: Group"),
        ("sales_territory", {"TerritoryID": 1, "Name": "\t", "CountryRegionCode": "US", "Group": "G"}, "blank string: Name"),
        ("sales_territory", {"TerritoryID": 1, "Name": None, "CountryRegionCode": None, "Group": "G"}, None),
        ("product", {"ProductID": 1, "Name": "N", "ProductNumber": " ", "ListPrice": "1"}, "blank string: ProductNumber"),
        ("product", {"ProductID": 1, "Name": "N", "ProductNumber": "P", "ListPrice": "1"}, None),
    ],
)
def test_blank_texts_are_rejected(spark, table, row, reasons):
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"`{c}` {'int' if isinstance(v, int) else 'string'}" for c, v in row.items()))
    found = [r["rejection_reason"] for r in quality.rejected_rows(df, silver.RULES[table], next(iter(row))).collect()]
    assert found == ([reasons] if reasons else [])


def test_stored_tables_against_their_contracts(spark):
    specs = {n: GOLD[n] for n in ("dim_territory", "fact_sales")}
    names = GOLD["fact_sales"].columns
    facts = spark.createDataFrame([(1, 9), (1, 2), (None, 1)], "sales_order_detail_id bigint, territory_id bigint")
    whole = facts.select(*[(F.col(n) if n in facts.columns else F.lit(None)).cast(f.dataType).alias(n) for n, f in zip(names, GOLD["fact_sales"].schema.fields, strict=True)])
    territories = spark.createDataFrame([(1, "a", "b", "c"), (2, "a", "b", "c")], "territory_id bigint, territory_name string, country_region_code string, territory_group string")
    assert validation.stored_problems({"dim_territory": territories, "fact_sales": whole}, specs) == ["fact_sales: 1 null keys", "fact_sales: 1 repeated keys", "fact_sales: 1 orphans of territory_id"]
    assert validation.stored_problems({"dim_territory": territories.withColumn("x", F.lit(1)).drop("territory_name")}, specs) == ["fact_sales: not stored", "dim_territory: missing", "dim_territory: unexpected"]


def test_jdbc_round_trip(spark, tmp_path):
    """Spark ships an embedded database; the table keeps its columns when its rows are replaced."""
    url = f"jdbc:derby:{tmp_path}/shop;create=true"
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.range(1, 101).selectExpr("id", "concat('n', cast(id as string)) as name", "cast(id * 1.5 as decimal(10,2)) as price")
    readers.write_jdbc(rows, url, "ITEMS", "overwrite", batch_size=10, parts=2, properties=driver)
    readers.write_jdbc(rows.where("id > 90").withColumn("id", F.col("id") + 100), url, "ITEMS", "append", properties=driver)
    back = readers.jdbc(spark, url, "ITEMS", "id", 1, 200, 4, driver)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 110 and back.agg(F.sum("price")).first()[0] == rows.agg(F.sum("price")).first()[0] + rows.where("id > 90").agg(F.sum("price")).first()[0]
    readers.write_jdbc(rows.limit(3), url, "ITEMS", "overwrite", properties=driver)
    assert readers.jdbc(spark, url, "ITEMS", "id", 1, 200, 2, driver).count() == 3


def test_jdbc_ranges_of_equal_rows(spark, tmp_path):
    """Nine tenths of the keys lie in a thousandth of their range: equal widths would put them in one partition."""
    url = f"jdbc:derby:{tmp_path}/skewed;create=true"
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.range(2000).selectExpr("case when id % 10 > 0 then id else id * 1000 end as K", "id as V").unionByName(spark.range(5).selectExpr("cast(null as bigint) as K", "id as V"))
    readers.write_jdbc(rows, url, "skewed", properties=driver)
    read = readers.jdbc_balanced(spark, url, "skewed", "K", 0, 2_000_000, 8, driver)
    sizes = sorted(r["count"] for r in read.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert sum(sizes) == 2005 and len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
    assert read.where("v % 2 = 0").count() == 1003 and read.distinct().count() == 2005
    assert readers.quantile_ranges(spark.createDataFrame([], "k long"), "k", 4) == ["1 = 1"]
    assert readers.quantile_ranges(spark.createDataFrame([(5,)] * 9, "k long"), "k", 3) == ["k <= 5 OR k IS NULL", "k > 5"]
    with pytest.raises(ValueError, match="safe"):
        readers.jdbc_balanced(spark, url, "skewed", "k or 1=1", 0, 9, 2, driver)


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_malformed_lines_by_kind(spark, tmp_path, kind):
    lines = {"csv": ["1,a", "2", "x,b", "3,c,d", '4,"e,f"', ""], "json": ['{"k":1,"v":"a"}', '{"k":2,', '{"k":"x","v":"b"}', "[3", '{"k":4,"v":"e,f"}', ""]}[kind]
    (tmp_path / "lines.txt").write_text("\n".join(lines) + "\n")
    valid, rejected = readers.read_lines(spark, str(tmp_path / "lines.txt"), kind, "k int, v string")
    assert sorted(map(tuple, valid.collect())) == [(1, "a"), (4, "e,f")] and valid.columns == ["k", "v"]
    assert {r["line"] for r in rejected.collect()} == set(lines[1:4]) and rejected.select("record_key").distinct().count() == 3
    assert {r["rejection_reason"] for r in rejected.collect()} == {f"malformed {kind} line"} and valid.select("v").count() == 2
    with pytest.raises(ContractError, match="no lines"):
        readers.read_lines(spark, str(tmp_path), "parquet", "k int")


def test_easter_of_600_years(spark):
    def computus(y):
        a, b, c = y % 19, y // 100, y % 100
        h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
        l = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7  # noqa: E741
        m = (a + 11 * h + 22 * l) // 451
        return (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1

    got = spark.range(1700, 2300).select(F.col("id").cast("int").alias("y")).withColumn("d", holidays.easter(F.col("y"))).collect()
    assert all((r["d"].month, r["d"].day) == computus(r["y"]) for r in got)
