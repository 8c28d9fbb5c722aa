"""Incremental Silver and Gold: changed keys are merged into tables in hash buckets, KPIs from kept parts.

A table is a folder a bucket, and a document says which folder holds each bucket; folders are never
changed.  An increment reads the buckets of its keys, merges them with its rows, and writes them to
new folders; then one document is replaced, so readers see all tables before the increment or all after
it.  An increment that broke off leaves folders that no document names, and can be applied again: rows
that were merged already win against themselves.

Rows are shuffled once an increment, by bucket: a task has whole buckets, so windows over the keys of a bucket
pick the rows that stay, in the order in which they are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.identity import new_id
from tidewell.operators import gold, kpi, silver
from tidewell.operators.quality import ContractError, dedup_by_signature, valid_rows
from tidewell.plans.contracts import SILVER
from tidewell.plans.store import Store
from tidewell.sources.readers import union_batches
from tidewell.sources.settled import release, settle

#: Buckets of a table; one is a task's work, so a table of 10 billion rows wants some ten thousand.
BUCKETS = 64
#: Partitions for each bucket that is dealt: hashes of buckets seldom meet in so many, so few tasks have several.
_SPREAD = 2
#: Marks one line of each order in the fact's folders, for the KPIs' parts.
_HEAD = "_head"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


class BucketedTables:
    """The tables of a layer, and the document that says where their buckets are."""

    def __init__(self, store: Store, layer: str, buckets: int = BUCKETS):
        self.store, self.layer, self.buckets = store, layer, buckets
        self.document = f"control/pointers/{layer}.buckets.json"

    def current(self) -> dict:
        """Names of tables -> folders by bucket, and what was published with them."""
        return self.store.get(self.document, {"tables": {}})

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame | None:
        """The rows of a table (in some buckets), with their bucket, without marks; None if there are none."""
        where = self.current()["tables"].get(table, {})
        folders = sorted({f for b, f in where.items() if buckets is None or int(b) in buckets})
        parts = []
        for folder in folders:
            held = [int(b) for b, f in where.items() if f == folder and (buckets is None or int(b) in buckets)]
            parts.append(self.store.spark.read.parquet(self.store.path(folder)).where(F.col("bucket").isin(held)).drop(_HEAD))
        return union_batches(parts) if parts else None

    def dealt(self, rows: DataFrame, buckets: int | None = None) -> DataFrame:
        """rows (with a column bucket, of so many values) dealt so that a task has whole buckets."""
        return rows.repartition(_SPREAD * (buckets or self.buckets), "bucket")

    def stage(self, table: str, rows: DataFrame, touched: list[int] | None = None) -> dict[str, str]:
        """Writes whole buckets (rows are dealt) to a new folder; where each is then.  touched: these
        buckets, if they are known."""
        folder = f"{self.layer}/{table}/{new_id()}"
        rows.write.partitionBy("bucket").parquet(self.store.path(folder), compression="zstd")
        written = [n.removeprefix("bucket=") for n in self.store.names(folder) if n.startswith("bucket=")]
        return {b: folder for b in (written if touched is None else map(str, touched))}

    def publish(self, staged: dict[str, dict[str, str]], **more) -> None:
        """Moves all staged buckets of all tables at once."""
        now = self.current()
        tables = {t: now["tables"].get(t, {}) | staged.get(t, {}) for t in {*now["tables"], *staged}}
        self.store.put(self.document, now | more | {"tables": tables})

    def merge(self, table: str, rows: DataFrame, key: str, resolve: Callable[[DataFrame, DataFrame | None], DataFrame]) -> tuple[dict[str, str], list[int]]:
        """Stages the buckets of rows' keys with the rows merged in; these buckets.  resolve: the rows that stay, of
        new ones and of those in the same buckets, dealt.  A table's first rows are not written before they are dealt.
        Only the numbers of buckets reach the driver."""
        fresh = rows.withColumn("bucket", bucket_of(key, self.buckets))
        if not self.current()["tables"].get(table):
            where = self.stage(table, resolve(fresh, None))
            return where, sorted(map(int, where))
        fresh = settle(fresh, "increment", dense=True)
        touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
        where = self.stage(table, resolve(fresh, self.read(table, touched)), touched) if touched else {}
        release(fresh)
        return where, touched


class IncrementalSilver:
    """The clean tables, kept up to date from the new rows of Bronze alone."""

    def __init__(self, store: Store, buckets: int = BUCKETS, cleaners: dict[str, Callable[..., DataFrame]] | None = None):
        self.tables, self.cleaners = BucketedTables(store, "silver", buckets), cleaners or silver.CLEANERS

    def apply(self, fresh: dict[str, DataFrame], people: DataFrame, snapshot: str) -> dict[str, list[int]]:
        """Cleans the new raw rows of some tables and merges them; which buckets changed.  A snapshot that is
        published already changes nothing.  A detail id must not come with a second load."""
        if self.tables.current().get("snapshot") == snapshot:
            return {}
        staged, changed = {}, {}
        for name, raw in fresh.items():
            valid, key = valid_rows(raw, silver.RULES[name]), SILVER[name].key
            clean = self.cleaners[name](valid, people, signature=True) if name in ("customer", "sales_person") else self.cleaners[name](valid, signature=True)
            staged[name], changed[name] = self.tables.merge(name, clean, key, lambda fresh, old, key=key: self._latest(fresh, old, key))
        self.tables.publish(staged, snapshot=snapshot)
        return changed

    def _latest(self, fresh: DataFrame, old: DataFrame | None, key: str) -> DataFrame:
        """One row a key."""
        return dedup_by_signature(self.tables.dealt(fresh if old is None else old.unionByName(fresh)), key, "_signature", "bucket")

    def read(self, name: str) -> DataFrame:
        rows = self.tables.read(name)
        if rows is None:
            raise ContractError(f"silver {name}: nothing is published")
        return rows.drop("bucket", "_signature")


class IncrementalGold:
    """The fact in buckets of its orders, and the KPIs' parts of each bucket."""

    def __init__(self, store: Store, buckets: int = BUCKETS):
        self.tables = BucketedTables(store, "gold", buckets)

    def apply(self, details: DataFrame, headers: DataFrame, snapshot: str) -> list[int]:
        """Builds the lines of some orders (whole orders, with their headers), which replace those of the same
        orders, and the parts of their buckets; these buckets."""
        if self.tables.current().get("snapshot") == snapshot:
            return []
        where, touched = self.tables.merge("fact_sales", gold.fact_sales(details, headers), "sales_order_id", self._newest)
        if not touched:
            return []
        written = self.tables.store.spark.read.parquet(self.tables.store.path(next(iter(where.values()))))
        parts = kpi.kpi_partials(written, part=F.col("bucket").cast("long"), head=F.col(_HEAD)).withColumn("bucket", F.col("part").cast("int"))
        self.tables.publish({"fact_sales": where, "kpi_parts": self.tables.stage("kpi_parts", self.tables.dealt(parts, len(touched)), touched)}, snapshot=snapshot)
        return touched

    def _newest(self, fresh: DataFrame, old: DataFrame | None) -> DataFrame:
        """The lines of orders that come again, and the old ones of the others; one line of each order is marked."""
        new = fresh.withColumn("_new", F.lit(True))
        rows = self.tables.dealt(new if old is None else old.withColumn("_new", F.lit(False)).unionByName(new))
        lines = Window.partitionBy("bucket", "sales_order_id").orderBy(F.col("_new").desc(), "sales_order_detail_id")
        marked = rows.withColumns({_HEAD: F.row_number().over(lines) == 1, "_again": F.first("_new").over(lines)})
        return marked.where("_new = _again").drop("_new", "_again")

    def fact(self) -> DataFrame:
        return self.tables.read("fact_sales").drop("bucket")

    def kpis(self) -> DataFrame:
        """From the parts, without a look at the fact."""
        return kpi.kpis_of(self.tables.read("kpi_parts"))
