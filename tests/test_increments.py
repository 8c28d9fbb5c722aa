"""Incremental Silver and Gold against full loads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewell.operators import gold, kpi, quality, silver
from tidewell.operators.partials import partials, partials_of_heads, total
from tidewell.operators.quality import ContractError
from tidewell.plans.contracts import BRONZE
from tidewell.plans.increments import BucketedTables, IncrementalGold, IncrementalSilver, bucket_of
from tidewell.plans.jobs import BronzeJob, Context, read_bronze, read_fresh
from tidewell.plans.settings import Settings
from tidewell.plans.store import Store
from tidewell.sources import raw
from tidewell.sources.adapter import SalesTables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/warehouse")


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    return sorted(map(tuple, a.select(columns).collect()), key=str) == sorted(map(tuple, b.select(columns).collect()), key=str)


def test_only_touched_buckets_are_written(spark, store):
    rows = raw.raw_header(SalesTables(spark, SMALL)).where("SalesOrderID < 300").cache()
    people, old, late = None, rows.where("_load_date < '2024-09-02'"), rows.where("_load_date = '2024-09-02' and SalesOrderID in (7, 14, 210)")
    layer = IncrementalSilver(store, buckets=16)
    assert layer.apply({"sales_order_header": old}, people, "snap-1")["sales_order_header"] == list(range(16))
    before = layer.tables.current()["tables"]["sales_order_header"]
    changed = layer.apply({"sales_order_header": late}, people, "snap-2")["sales_order_header"]
    after = layer.tables.current()["tables"]["sales_order_header"]
    assert 1 <= len(changed) <= 3 and {int(b) for b in before if before[b] != after[b]} == set(changed)
    want = silver.clean_header(quality.valid_rows(old.unionByName(late), silver.RULES["sales_order_header"]))
    assert same(layer.read("sales_order_header"), want)
    assert layer.apply({"sales_order_header": late}, people, "snap-2") == {} and layer.tables.current()["tables"]["sales_order_header"] == after
    layer.apply({"sales_order_header": late}, people, "snap-3")  # rows that are there already change nothing
    assert same(layer.read("sales_order_header"), want)


def test_ties_of_a_load_date_go_by_signature(spark, store):
    """Winners of parts, with their signatures, give the winner of all, in any order of the increments."""
    rows = [(1, f"name {k}", "P-1", None, None, None, "5", "1", "2024-01-01" if k % 2 else None, "2024-09-01") for k in range(9)]
    columns = "ProductID int, Name string, ProductNumber string, ProductLine string, Class string, Style string, ListPrice string, StandardCost string, DiscontinuedDate string, _load_date string"
    want = silver.clean_product(spark.createDataFrame(rows, columns))
    for k, order in enumerate((rows, rows[::-1])):
        layer = IncrementalSilver(store, buckets=2)
        layer.tables.layer, layer.tables.document = f"silver{k}", f"control/pointers/silver{k}.json"
        for i, row in enumerate(order):
            layer.apply({"product": spark.createDataFrame([row], columns)}, None, f"snap-{i}")
        assert same(layer.read("product"), want)


def test_a_broken_increment_leaves_the_old_tables(spark, store, monkeypatch):
    rows = raw.raw_header(SalesTables(spark, SMALL)).where("SalesOrderID < 100")
    layer = IncrementalSilver(store, buckets=4)
    with pytest.raises(ContractError, match="nothing is published"):
        layer.read("sales_order_header")
    layer.apply({"sales_order_header": rows.where("SalesOrderID < 50")}, None, "snap-1")
    before = sorted(map(tuple, layer.read("sales_order_header").collect()), key=str)

    def lost(*_, **__):
        raise ConnectionError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(BucketedTables, "publish", lost)
        with pytest.raises(ConnectionError):
            layer.apply({"sales_order_header": rows}, None, "snap-2")
    assert sorted(map(tuple, layer.read("sales_order_header").collect()), key=str) == before
    layer.apply({"sales_order_header": rows}, None, "snap-2")
    assert same(layer.read("sales_order_header"), silver.clean_header(quality.valid_rows(rows, silver.RULES["sales_order_header"])))


def test_kpis_follow_changed_orders(spark, store):
    """An order that comes again replaces its lines, and its old customer no longer counts."""
    t = SalesTables(spark, SMALL)
    details, headers = t.detail().where("sales_order_id < 200").cache(), t.header().where("sales_order_id < 200").cache()
    layer = IncrementalGold(store, buckets=8)
    strangers = headers.withColumn("customer_id", F.when(F.col("sales_order_id") % 9 == 0, F.col("sales_order_id") + 10**7).otherwise(F.col("customer_id")))
    layer.apply(details.where("sales_order_id < 150"), strangers, "snap-1")
    layer.apply(details.where("sales_order_id >= 150 or sales_order_id % 9 = 0"), headers, "snap-2")
    want = gold.fact_sales(details, headers)
    assert same(layer.fact(), want) and same(layer.kpis(), kpi.kpi_gold(want))
    before = layer.tables.current()["tables"]["fact_sales"]
    touched = layer.apply(details.where("sales_order_id = 36"), headers, "snap-3")
    after = layer.tables.current()["tables"]["fact_sales"]
    assert len(touched) == 1 and [b for b in before if before[b] != after[b]] == [str(touched[0])]
    assert same(layer.kpis(), kpi.kpi_gold(want)) and layer.apply(details, headers, "snap-3") == []


def test_from_incremental_bronze(spark, store):
    """Bronze reads past its bound, and Silver and Gold take what it brought."""
    t = SalesTables(spark, SMALL)
    frames = {
        "sales_order_header": raw.raw_header(t).where("SalesOrderID < 400 and _load_date < '2024-09-02'").drop("_load_date"), "sales_order_detail": raw.raw_detail(t).where("SalesOrderID < 400").drop("_load_date"),
        "person": raw.raw_person(t), "customer": raw.raw_customer(t).where("_load_date < '2024-09-02'").drop("_load_date"),
    }
    specs = {n: BRONZE[n] for n in frames}
    silver_layer, gold_layer = IncrementalSilver(store, buckets=4), IncrementalGold(store, buckets=4)
    for snapshot, limit in (("snap-1", 250), ("snap-2", 400)):
        part = {n: df.where(F.col("SalesOrderID") < limit) if "SalesOrderID" in df.columns else df for n, df in frames.items()}
        job = BronzeJob(Context(store, Settings(batch_size=5000, retry_max_attempts=1)), lambda spec, part=part: part[spec.target], specs)
        results = job.run(snapshot, raw.OLD, mode="full" if snapshot == "snap-1" else "incremental")
        assert all(r["published"] for r in results.values()), results
        fresh = {n: df for n in ("sales_order_header", "sales_order_detail", "customer") if (df := read_fresh(store, n)) is not None}
        silver_layer.apply(fresh, read_bronze(store, "person"), snapshot)
        headers = silver_layer.read("sales_order_header")
        keys = fresh["sales_order_detail"].select(F.col("SalesOrderID").alias("sales_order_id")).distinct()
        details = silver_layer.read("sales_order_detail").join(keys, "sales_order_id", "left_semi").join(headers.select("sales_order_id"), "sales_order_id", "left_semi")
        gold_layer.apply(details, headers, snapshot)
    assert "customer" not in fresh and read_bronze(store, "sales_order_header").count() == frames["sales_order_header"].count()
    details = silver.clean_detail(quality.valid_rows(frames["sales_order_detail"], silver.RULES["sales_order_detail"]))
    headers = silver.clean_header(quality.valid_rows(frames["sales_order_header"], silver.RULES["sales_order_header"]))
    want = gold.fact_sales(details.join(headers.select("sales_order_id"), "sales_order_id", "left_semi"), headers)
    assert same(gold_layer.fact(), want) and same(gold_layer.kpis(), kpi.kpi_gold(want))


def test_parts_merge(spark):
    """Bitmaps of any split give the distinct counts of the whole; NULLs are no ids, and orders without ids count."""
    rows = [(i % 40 if i % 7 else None, i * 70_000 % 600_000 - 5 if i % 5 else None, i % 3 or None, i) for i in range(300)]
    lines = spark.createDataFrame(rows, "sales_order_id long, a long, b long, v long")
    sums = {"v": F.col("v")}
    whole = total(partials(lines, sums, ("a", "b")), ("v",), ("a", "b")).first()
    parts = [partials(lines.where(F.coalesce(F.col("sales_order_id"), F.lit(-1)) % 3 == k), sums, ("a", "b")) for k in (0, 1, 2, -1)]
    merged = total(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), ("v",), ("a", "b")).first()
    want = (len(rows), len({r[0] for r in rows} - {None}), sum(r[3] for r in rows), len({r[1] for r in rows} - {None}), len({r[2] for r in rows} - {None}))
    assert tuple(whole) == tuple(merged) == want
    assert tuple(total(partials(lines.where("false"), sums, ("a",)), ("v",), ("a",)).first()) == (0, 0, None, 0)
    plan = total(partials(lines, sums, ("a", "b")), ("v",), ("a", "b"))._jdf.queryExecution().toString()
    assert "Expand" not in plan


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_fact_increments_shuffle_once(spark, store):
    """Lines in the store and new ones are dealt by bucket, and by nothing else; filters on orders reach the scan of lines."""
    t = SalesTables(spark, SMALL)
    layer = IncrementalGold(store, buckets=4)
    fresh, old = (spark.createDataFrame([(k, k // 3, k % 4) for k in range(n)], "sales_order_detail_id long, sales_order_id long, bucket int") for n in (20, 90))
    assert shuffles(layer._newest(fresh, None)) == shuffles(layer._newest(fresh, old)) == 1
    assert "EqualTo(l_orderkey,5)" in t.detail().where("sales_order_id = 5")._jdf.queryExecution().executedPlan().toString()


def test_silver_increments_shuffle_once(spark, store):
    """Cleaning for a merge shuffles nothing, and the merge deals rows by bucket, and by nothing else."""
    rows = raw.raw_product(SalesTables(spark, SMALL))
    layer = IncrementalSilver(store, buckets=4)
    clean = silver.clean_product(rows.unionByName(rows), signature=True)
    fresh = clean.withColumn("bucket", bucket_of("product_id", 4))
    assert shuffles(clean) == 0 and shuffles(layer._latest(fresh, None, "product_id")) == shuffles(layer._latest(fresh, fresh, "product_id")) == 1
    assert same(layer._latest(fresh, fresh, "product_id").drop("bucket", "_signature"), silver.clean_product(rows))


def test_a_changed_order_may_have_fewer_lines(spark, store):
    t = SalesTables(spark, SMALL)
    details, headers = t.detail().where("sales_order_id < 100").cache(), t.header().cache()
    again = details.where("sales_order_id % 5 = 0 and sales_order_detail_id % 10000 = 1")
    layer = IncrementalGold(store, buckets=4)
    layer.apply(details, headers, "snap-1")
    layer.apply(again, headers, "snap-2")
    want = gold.fact_sales(details.where("sales_order_id % 5 <> 0").unionByName(again), headers)
    assert same(layer.fact(), want) and same(layer.kpis(), kpi.kpi_gold(want))


def test_parts_of_marked_orders(spark):
    """With one line of each order marked, the same sums and counts, and nothing is grouped by order."""
    rows = [(i // 3 if i % 50 else None, i * 70_000 % 600_000 - 5 if i % 5 else None, i % 3 or None, i % 3 == 0, i % 2) for i in range(300)]
    lines = spark.createDataFrame(rows, "sales_order_id long, a long, v long, head boolean, part long").where("sales_order_id is not null or not head")
    sums = {"v": F.col("v")}
    marked = lines.withColumn("part", F.col("sales_order_id") % 2)
    heads = partials_of_heads(marked, sums, ("a",), F.col("head"), part=F.col("part"))
    complete = marked.where("sales_order_id is null or sales_order_id % 50 <> 0")
    for frame, made in ((complete, partials_of_heads(complete, sums, ("a",), F.col("head"), part=F.col("part"))), (marked.where("false"), heads.where("false"))):
        assert tuple(total(made, ("v",), ("a",)).first()) == tuple(total(partials(frame, sums, ("a",), part=F.col("part")), ("v",), ("a",)).first())
    assert "AS _order" not in heads._jdf.queryExecution().executedPlan().toString()
