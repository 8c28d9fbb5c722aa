"""Versions of a layer and the pointer to the current one.

All tables of a version are written before the pointer document is replaced, so readers see either
all of the old version or all of the new one.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame

from tidewell.operators.quality import ContractError
from tidewell.plans.store import Store

KEEP_HOURS, KEEP_NEWEST = 48, 2


class RunActive(RuntimeError):
    """Another run holds the layer."""


class Versions:
    def __init__(self, store: Store, layer: str, clock=time.time):
        self.store, self.layer, self.clock = store, layer, clock
        self.pointer_file, self.lock_file = f"control/pointers/{layer}.json", f"control/locks/{layer}.json"

    @contextmanager
    def active_run(self, run_id: str):
        """One run at a time; the lock of a run that died is taken over by the same run id only."""
        if not self.store.create(self.lock_file, {"run_id": run_id, "since": self.clock()}) and self.store.get(self.lock_file, {}).get("run_id") != run_id:
            raise RunActive(f"{self.layer}: run {self.store.get(self.lock_file, {}).get('run_id')} is active")
        try:
            yield
        finally:
            self.store.delete(self.lock_file)

    def all(self) -> list[dict]:
        folder = f"control/versions/{self.layer}"
        return sorted((self.store.get(f"{folder}/{n}") for n in self.store.names(folder)), key=lambda v: v["number"])

    def _put(self, version: dict) -> None:
        self.store.put(f"control/versions/{self.layer}/{version['name']}.json", version)

    def allocate(self, run_id: str, snapshot_id: str) -> dict:
        """The candidate of a run: its own if it has one, else the next number."""
        known = self.all()
        for v in known:
            if v["run_id"] == run_id:
                return v
        number = max((v["number"] for v in known), default=0) + 1
        while True:
            version = {"name": f"v{number:03d}", "number": number, "run_id": run_id, "snapshot_id": snapshot_id, "state": "CANDIDATE", "since": self.clock(), "tables": {}}
            if self.store.create(f"control/versions/{self.layer}/{version['name']}.json", version):
                return version
            number += 1

    def folder(self, version: dict, table: str) -> str:
        return f"{self.layer}/{version['name']}/{table}"

    def write(self, version: dict, table: str, df: DataFrame) -> int:
        """Writes a candidate's table and notes its rows."""
        path = self.store.path(self.folder(version, table))
        df.write.mode("overwrite").parquet(path)
        return self.note(version, table, self.store.spark.read.parquet(path).count())

    def note(self, version: dict, table: str, rows: int) -> int:
        version["tables"][table] = rows
        self._put(version)
        return rows

    def read(self, version: dict, table: str) -> DataFrame:
        return self.store.spark.read.parquet(self.store.path(self.folder(version, table)))

    def publish(self, version: dict, required: list[str], report: dict) -> dict:
        """Moves the pointer; publishing the same run again changes nothing."""
        pointer = self.current()
        if pointer and pointer["run_id"] == version["run_id"]:
            return pointer
        if lost := sorted(set(required) - set(version["tables"])):
            raise ContractError(f"{self.layer} {version['name']} lacks {', '.join(lost)}")
        if not report.get("passed"):
            raise ContractError(f"{self.layer} {version['name']} is not validated")
        pointer = {"version": version["name"], "run_id": version["run_id"], "snapshot_id": version["snapshot_id"], "tables": version["tables"], "published": self.clock(), "before": pointer and pointer["version"]}
        self.store.put(self.pointer_file, pointer)
        version["state"] = "PUBLISHED"
        self._put(version)
        return pointer

    def fail(self, version: dict, reason: str) -> None:
        version |= {"state": "FAILED", "reason": reason, "since": self.clock()}
        self._put(version)

    def current(self) -> dict | None:
        return self.store.get(self.pointer_file)

    def read_current(self, table: str, snapshot_id: str | None = None) -> DataFrame:
        """A table of the current version, which must be of the wanted snapshot if one is given."""
        pointer = self.current()
        if pointer is None:
            raise ContractError(f"{self.layer}: nothing is published")
        if snapshot_id is not None and pointer["snapshot_id"] != snapshot_id:
            raise ContractError(f"{self.layer}: snapshot {snapshot_id} is wanted, {pointer['snapshot_id']} is current")
        return self.store.spark.read.parquet(self.store.path(f"{self.layer}/{pointer['version']}/{table}"))

    def clean_up(self) -> list[str]:
        """Removes old versions; the current one, the newest two and recent failures stay."""
        known, pointer = self.all(), self.current()
        keep = {v["name"] for v in known[-KEEP_NEWEST:]} | ({pointer["version"]} if pointer else set())
        gone = [v["name"] for v in known if v["name"] not in keep and self.clock() - v["since"] >= KEEP_HOURS * 3600]
        for name in gone:
            self.store.delete(f"{self.layer}/{name}")
            self.store.delete(f"control/versions/{self.layer}/{name}.json")
        return gone
