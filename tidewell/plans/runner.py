"""The whole pipeline: health, bootstrap, Bronze, Silver, Gold, result, report."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidewell.functions.identity import new_id
from tidewell.operators.quality import ContractError
from tidewell.plans.contracts import BRONZE, Status, TableSpec
from tidewell.plans.gates import overall
from tidewell.plans.jobs import BronzeJob, Context, GoldJob, SilverJob
from tidewell.plans.settings import Settings
from tidewell.plans.store import Store
from tidewell.sources.readers import read

MODES, STAGES = ("full", "incremental"), ("full", "bronze", "silver", "gold")
SCHEMA_VERSION = 1
FOLDERS = ("control", "staging", "quarantine", "silver", "gold")


def bootstrap(store: Store) -> dict:
    """Makes a warehouse ready, once; refuses one of another schema version."""
    store.create("control/schema.json", {"version": SCHEMA_VERSION})
    found = store.get("control/schema.json")["version"]
    if found != SCHEMA_VERSION:
        raise ContractError(f"warehouse has schema version {found}, {SCHEMA_VERSION} is needed")
    return {"status": "ready", "version": found}


def health(spark: SparkSession, settings: Settings, source: Callable[[TableSpec], DataFrame]) -> dict:
    """Whether every source table can be read and has its columns, and the warehouse be reached."""
    checks = {}
    for name, spec in BRONZE.items():
        try:
            lost = set(spec.required) - set(source(spec).columns)
            checks[name] = "ok" if not lost else f"lacks {', '.join(sorted(lost))}"
        except Exception as error:
            checks[name] = type(error).__name__
    try:
        Store(spark, settings.warehouse).exists("control")
        checks["warehouse"] = "ok"
    except Exception as error:
        checks["warehouse"] = type(error).__name__
    return {"status": "ok" if set(checks.values()) == {"ok"} else "degraded", "checks": checks}


def _total(value: Any, name: str) -> int:
    """The sum of a count over all results, however nested."""
    if isinstance(value, dict):
        return sum(_total(v, name) for v in value.values() if isinstance(v, dict)) + (value.get(name) or 0 if isinstance(value.get(name), int) else 0)
    return 0


class Runner:
    def __init__(self, spark: SparkSession, settings: Settings, source: Callable[[TableSpec], DataFrame] | None = None):
        self.spark, self.settings = spark, settings
        self.source = source or (lambda spec: read(spark, f"{settings.source_path}/{spec.source}", settings.source_format))
        self.context = Context(Store(spark, settings.warehouse), settings)

    def run(self, mode: str = "full", stage: str = "full", snapshot_id: str | None = None, recovery: dict | None = None) -> dict:
        """recovery: {"snapshot_id": ..., "load_ids": {target: load id}} of a run to take up."""
        started = datetime.now(UTC)
        try:
            if mode not in MODES or stage not in STAGES:
                raise ContractError(f"mode must be one of {', '.join(MODES)} and stage one of {', '.join(STAGES)}")
            bootstrap(self.context.store)
            results = self._stages(mode, stage, snapshot_id, recovery or {}, started)
            status = overall(r["status"] for r in results.values())
        except Exception as error:
            results, status = {"run": {"status": Status.FAILED, "error_type": type(error).__name__, "error": str(error)[:500]}}, Status.FAILED
        counts = {n: _total(results, n) for n in ("rows_read", "rows_written", "rows_rejected")}
        return {"status": status, "mode": mode, "stage": stage, "started": started.isoformat(), "finished": datetime.now(UTC).isoformat(), "settings": self.settings.safe_summary(), "stages": results} | counts

    def _stages(self, mode: str, stage: str, snapshot_id: str | None, recovery: dict, started: datetime) -> dict[str, dict]:
        results: dict[str, dict] = {}
        store = self.context.store
        if stage in ("full", "bronze"):
            snapshot_id = snapshot_id or recovery.get("snapshot_id") or new_id()
            tables = BronzeJob(self.context, self.source).run(snapshot_id, started.date().isoformat(), mode=mode, resume=recovery.get("load_ids"))
            results["bronze"] = {"status": overall(r["status"] for r in tables.values()), "snapshot_id": snapshot_id, "tables": tables}
        if stage == "silver" or (stage == "full" and results["bronze"]["status"] in (Status.SUCCESS, Status.SUCCESS_WITH_REJECTIONS)):
            if stage == "silver":  # the published Bronze tables stand for the results of their runs
                pointers = {n: store.get(f"control/pointers/bronze.{n}.json") for n in BRONZE}
                bronze = {n: p | {"status": Status.SUCCESS, "published": True} for n, p in pointers.items() if p}
                snapshot_id = snapshot_id or next(iter(bronze.values()), {}).get("snapshot_id")
            else:
                bronze = results["bronze"]["tables"]
            tables = SilverJob(self.context).run(bronze, snapshot_id)
            results["silver"] = {"status": overall(r["status"] for r in tables.values()), "snapshot_id": snapshot_id, "tables": tables}
        if stage == "gold" or (stage == "full" and results.get("silver", {}).get("status") in (Status.SUCCESS, Status.SUCCESS_WITH_REJECTIONS)):
            results["gold"] = GoldJob(self.context).run(snapshot_id)
        return results


def render(result: dict, kind: str = "json") -> str:
    """The run's report as JSON or Markdown."""
    if kind == "json":
        return json.dumps(result, indent=2, sort_keys=True, default=str)
    if kind != "markdown":
        raise ValueError(f"report format {kind} is not json or markdown")
    lines = ["# Pipeline report", "", f"Status: {result['status']}; mode {result['mode']}; stage {result['stage']}", "", f"Read {result['rows_read']}, written {result['rows_written']}, rejected {result['rows_rejected']} rows.", "", "| Stage | Table | Status | Read | Written | Rejected |", "|---|---|---|---:|---:|---:|"]
    for stage, found in result["stages"].items():
        for table, r in (found.get("tables") if isinstance(next(iter((found.get("tables") or {"": 0}).values())), dict) else None or {"-": found}).items():
            lines.append(f"| {stage} | {table} | {r['status']} | {r.get('rows_read', '')} | {r.get('rows_written', '')} | {r.get('rows_rejected', '')} |")
    return "\n".join(lines) + "\n"
