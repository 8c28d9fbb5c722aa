"""Audit of runs, tables and batches, the quarantine of rejected rows, and their queries."""

from __future__ import annotations

import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.identity import batch_id, redact, safe_name
from tidewell.operators.quality import ContractError
from tidewell.plans.contracts import GOOD, Status
from tidewell.plans.store import Store

KINDS = ("run", "table", "batch")


class Audit:
    """One document per run, table load and batch; later states replace earlier ones."""

    def __init__(self, store: Store, clock=time.time):
        self.store, self.clock = store, clock

    def _file(self, kind: str, name: str) -> str:
        if kind not in KINDS:
            raise ContractError(f"audit kind {kind}")
        return f"control/audit/{kind}/{name}.json"

    def start(self, kind: str, name: str, **fields) -> None:
        if kind == "batch" and (old := self.store.get(self._file(kind, name))) and old["status"] in GOOD:
            raise ContractError(f"batch {name} is audited as done")
        self.store.put(self._file(kind, name), fields | {"name": name, "status": Status.STARTED, "started": self.clock()})

    def finish(self, kind: str, name: str, status: Status, error: BaseException | None = None, **fields) -> None:
        known = self.store.get(self._file(kind, name)) or {"name": name, "started": self.clock()}
        detail = {"error_type": type(error).__name__, "error": redact(error)[:500]} if error else {}
        self.store.put(self._file(kind, name), known | fields | detail | {"status": status, "finished": self.clock(), "duration_ms": int(1000 * (self.clock() - known["started"]))})

    def entries(self, kind: str) -> list[dict]:
        return [self.store.get(f"control/audit/{kind}/{n}") for n in self.store.names(f"control/audit/{kind}")]

    def sweep_stale(self, seconds: float) -> list[str]:
        """Runs that started long ago and never ended are failed."""
        stale = [e["name"] for e in self.entries("run") if "finished" not in e and self.clock() - e["started"] > seconds]
        for name in stale:
            self.finish("run", name, Status.FAILED, TimeoutError("stale run"))
        return stale


class Quarantine:
    """Rejected rows by key and reason, without their payload; the same rejection is kept once."""

    def __init__(self, store: Store):
        self.store = store

    def add(self, rejected: DataFrame, table: str, run_id: str, load_id: str) -> int:
        path = self.store.path(f"quarantine/{safe_name(table)}/load={batch_id(table, 'quarantine', run_id, load_id, '')[:32]}")
        now = datetime.now(UTC).isoformat()
        rows = rejected.select("record_key", "rejection_reason", F.lit(run_id).alias("run_id"), F.lit(load_id).alias("load_id"), F.lit(now).alias("quarantined_at"))
        rows.dropDuplicates(["record_key", "rejection_reason"]).write.mode("overwrite").parquet(path)
        return self.store.spark.read.parquet(path).count()

    def read(self, table: str) -> DataFrame:
        """The latest rejection of each key and reason over all loads."""
        rows = self.store.spark.read.parquet(self.store.path(f"quarantine/{safe_name(table)}"))
        last = Window.partitionBy("record_key", "rejection_reason").orderBy(F.desc("quarantined_at"), "load_id")
        return rows.withColumn("_place", F.row_number().over(last)).where("_place = 1").drop("_place", "load")
