"""The jobs of the three layers: thin orchestration over DataFrame functions.

Sources, cleaners, builders and validators come in through the constructors, so a job can be run
with others.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.identity import new_id
from tidewell.operators import gold, silver, validation
from tidewell.operators.quality import ContractError, duplicate_count, null_key_rows, rejected_rows, valid_rows
from tidewell.plans.audit import Audit, Quarantine
from tidewell.plans.batches import BatchLog, plan_batches, read_committed, write_batches
from tidewell.plans.contracts import BRONZE, GOLD, SILVER, ModelSpec, Status, TableSpec, check_contract
from tidewell.plans.gates import layer_gate, overall, require_gate
from tidewell.plans.logs import event
from tidewell.plans.retry import Deadline, Retry, cancelled_after
from tidewell.plans.settings import Settings
from tidewell.plans.staging import Stage, Staging
from tidewell.plans.store import Store
from tidewell.plans.versions import Versions
from tidewell.sources.raw import with_lineage

LOG = logging.getLogger("tidewell")


@dataclass
class Context:
    """What all jobs share."""

    store: Store
    settings: Settings = field(default_factory=Settings)

    def __post_init__(self):
        self.audit, self.quarantine, self.staging = Audit(self.store), Quarantine(self.store), Staging(self.store)
        s = self.settings
        self.retry = Retry(s.retry_max_attempts, s.retry_initial_delay_seconds, s.retry_max_delay_seconds)


def _failed(error: BaseException, **fields) -> dict:
    return fields | {"status": Status.FAILED, "published": False, "error_type": type(error).__name__, "error": str(error)[:500]}


class BronzeJob:
    """Lands source tables: lineage, quarantine of rows without a key, batches, validation, publication."""

    def __init__(self, context: Context, source: Callable[[TableSpec], DataFrame], specs: dict[str, TableSpec] = BRONZE):
        self.context, self.source, self.specs = context, source, specs

    def run(self, snapshot_id: str, load_date: str, run_id: str | None = None, mode: str = "full", resume: dict[str, str] | None = None) -> dict[str, dict]:
        """A result per target.  resume: load ids to take up, by target.  An incremental run reads the
        rows whose ordering key is past the last published bound and adds them to what is published."""
        run_id = run_id or new_id()
        self.context.audit.sweep_stale(self.context.settings.stale_run_timeout_seconds)
        self.context.audit.start("run", run_id, mode=mode, snapshot_id=snapshot_id)
        results = {name: self._table(spec, snapshot_id, load_date, run_id, mode, (resume or {}).get(name)) for name, spec in self.specs.items()}
        self.context.audit.finish("run", run_id, overall(r["status"] for r in results.values()))
        return results

    def _table(self, spec: TableSpec, snapshot_id: str, load_date: str, run_id: str, mode: str, load_id: str | None) -> dict:
        """One table's load; its Spark jobs end when its time is up, and the other tables go on."""
        c, s = self.context, self.context.settings
        load_id = load_id or new_id()
        names = {"target_table": spec.target, "run_id": run_id, "load_id": load_id, "snapshot_id": snapshot_id}
        audit_name, staging = f"{run_id}-{spec.target}", None
        c.audit.start("table", audit_name, **names)
        try:
            with cancelled_after(c.store.spark, s.table_timeout_seconds, spec.target):
                deadline = Deadline(s.table_timeout_seconds, spec.target)
                rows = self.source(spec)
                if lost := validation.missing_columns(rows, spec.required):
                    raise ContractError(f"{spec.source} lacks {', '.join(lost)}")
                before = c.store.get(f"control/pointers/bronze.{spec.target}.json")
                after = before["high"] if mode == "incremental" and before else None
                rows = with_lineage(rows, spec.target, load_date)
                rows = rows if after is None else rows.where(F.col(spec.order_by) > F.lit(after))
                rejected = c.quarantine.add(null_key_rows(rows, spec.key), spec.target, run_id, load_id)
                if rejected > s.bronze_rejected_threshold:
                    raise ContractError(f"{spec.target}: {rejected} rejected rows, {s.bronze_rejected_threshold} allowed")
                valid = rows.where(F.col(spec.key).isNotNull())
                staging = c.staging.open(spec.target, load_id, snapshot_id)
                log, folder = BatchLog(c.store, staging), f"staging/{staging}"
                batches = plan_batches(valid, spec.source, spec.order_by, s.batch_size, snapshot_id, after)
                deadline.check()
                written = write_batches(valid, spec.order_by, batches, log, folder, retry=c.retry, before=lambda _: deadline.check())
                paths = [f"{folder}/batch_id={m['batch_id']}" for m in log.committed()]
                kept = before["paths"] if after is not None else []
                if not [*kept, *paths]:
                    raise ContractError(f"{spec.source} has no rows")
                if paths:
                    report = validation.bronze_report(read_committed(log, folder), spec.key, spec.target, spec.required, valid.count() + rejected, rejected, s.bronze_rejected_threshold)
                    report.require(spec.target)
                deadline.check()
                c.staging.update(staging, validated=True)
                high = log.checkpoint(after)
                c.store.put(f"control/pointers/bronze.{spec.target}.json", names | {"paths": [*kept, *paths], "fresh": paths, "high": high})
                c.staging.move(staging, Stage.PUBLISHED)
                status = Status.SUCCESS_WITH_REJECTIONS if rejected else Status.SUCCESS
                c.audit.finish("table", audit_name, status, rows_read=written + rejected, rows_written=written, rows_rejected=rejected)
                c.staging.update(staging, audited=True)
                event(LOG, "bronze_table", status=status, rows_written=written, rows_rejected=rejected, **{k: v for k, v in names.items()})
                return names | {"status": status, "published": True, "rows_read": written + rejected, "rows_written": written, "rows_rejected": rejected}
        except Exception as error:
            if staging and c.staging.get(staging)["state"] == Stage.ACTIVE:
                c.staging.move(staging, Stage.FAILED)
            c.audit.finish("table", audit_name, Status.FAILED, error)
            return _failed(error, **names)


def read_bronze(store: Store, target: str) -> DataFrame:
    """The published rows of a Bronze table."""
    pointer = store.get(f"control/pointers/bronze.{target}.json")
    if pointer is None:
        raise ContractError(f"bronze {target}: nothing is published")
    return store.spark.read.parquet(*[store.path(p) for p in pointer["paths"]])


def read_fresh(store: Store, target: str) -> DataFrame | None:
    """The rows that the last run brought to a Bronze table; None if it brought none."""
    pointer = store.get(f"control/pointers/bronze.{target}.json")
    if pointer is None:
        raise ContractError(f"bronze {target}: nothing is published")
    return store.spark.read.parquet(*[store.path(p) for p in pointer["fresh"]]) if pointer["fresh"] else None


def conform(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Exactly the contract's columns, in its types; a value that can't be cast raises."""
    if lost := validation.missing_columns(df, spec.columns):
        raise ContractError(f"{spec.name} lacks {', '.join(lost)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])


class SilverJob:
    """Cleans the six tables of a Bronze snapshot; the pointer moves only if all of them succeed."""

    def __init__(self, context: Context, reader: Callable[[str], DataFrame] | None = None, cleaners: dict[str, Callable] | None = None, specs: dict[str, ModelSpec] = SILVER):
        self.context, self.specs = context, specs
        self.reader = reader or (lambda name: read_bronze(context.store, name))
        self.cleaners = cleaners or silver.CLEANERS
        self.versions = Versions(context.store, "silver")

    def run(self, bronze: dict[str, dict], snapshot_id: str, run_id: str | None = None) -> dict[str, dict]:
        require_gate(layer_gate(bronze, BRONZE, snapshot_id), "bronze")
        run_id = run_id or new_id()
        with self.versions.active_run(run_id):
            version = self.versions.allocate(run_id, snapshot_id)
            people = self.reader("person")
            results = {name: self._table(name, spec, version, people, snapshot_id, run_id) for name, spec in self.specs.items()}
            if all(r["status"] != Status.FAILED for r in results.values()):
                self.versions.publish(version, list(self.specs), {"passed": True})
                results = {n: r | {"published": True} for n, r in results.items()}
            else:
                self.versions.fail(version, "; ".join(n for n, r in results.items() if r["status"] == Status.FAILED))
        return results

    def _table(self, name: str, spec: ModelSpec, version: dict, people: DataFrame, snapshot_id: str, run_id: str) -> dict:
        c = self.context
        names = {"target_table": spec.name, "run_id": run_id, "load_id": version["name"], "snapshot_id": snapshot_id}
        try:
            raw, rules = self.reader(name), silver.RULES[name]
            source_count = raw.count()
            rejected = c.quarantine.add(rejected_rows(raw, rules, BRONZE[name].key), spec.name, run_id, version["name"])
            if rejected > c.settings.silver_rejected_threshold:
                raise ContractError(f"{name}: {rejected} rejected rows, {c.settings.silver_rejected_threshold} allowed")
            valid = valid_rows(raw, rules)
            if name == "sales_order_detail" and duplicate_count(valid, BRONZE[name].key).first()[0]:
                raise ContractError("sales_order_detail: repeated detail ids")
            cleaner = self.cleaners[name]
            clean = cleaner(valid, people) if name in ("customer", "sales_person") else cleaner(valid)
            # in key order over all files, as readers of key ranges skip what they don't need
            ordered = conform(clean, spec).repartitionByRange(spec.key).sortWithinPartitions(spec.key)
            written = c.retry.run(lambda: self.versions.write(version, name, ordered))
            kept = self.versions.read(version, name)
            validation.output_schema(kept, spec.schema).require(spec.name)
            validation.silver_report(kept, spec.key, spec.columns, source_count, spec.required, rejected, c.settings.silver_rejected_threshold).require(spec.name)
            status = Status.SUCCESS_WITH_REJECTIONS if rejected else Status.SUCCESS
            event(LOG, "silver_table", status=status, rows_written=written, rows_rejected=rejected, **names)
            return names | {"status": status, "published": False, "rows_read": source_count, "rows_written": written, "rows_rejected": rejected, "rows_deduplicated": source_count - rejected - written}
        except Exception as error:
            return _failed(error, **names)


class GoldJob:
    """Builds the star schema of the current Silver version; resumes a fact that broke off."""

    def __init__(self, context: Context, specs: dict[str, ModelSpec] = GOLD):
        self.context, self.specs = context, specs
        self.versions, self.silver = Versions(context.store, "gold"), Versions(context.store, "silver")

    def run(self, snapshot_id: str | None = None, run_id: str | None = None, before_batch: Callable | None = None) -> dict:
        """snapshot_id: the Silver snapshot to build from; the current one by default."""
        run_id, s = run_id or new_id(), self.context.settings
        if wrong := [w for spec in self.specs.values() for w in check_contract(spec, self.specs)]:
            raise ContractError("; ".join(wrong))
        pointer = self.silver.current()
        snapshot_id = snapshot_id or (pointer or {}).get("snapshot_id")
        with self.versions.active_run(run_id):
            read = lambda name: self.silver.read_current(name, snapshot_id)
            headers, details = read("sales_order_header"), read("sales_order_detail")
            version = self.versions.allocate(run_id, snapshot_id)
            try:
                gold.require_unique(headers, "sales_order_id", "headers")
                built = {
                    "dim_date": gold.dim_date(headers), "dim_customer": gold.dim_customer(read("customer")), "dim_product": gold.dim_product(read("product")),
                    "dim_territory": gold.dim_territory(read("sales_territory")), "dim_salesperson": gold.dim_salesperson(read("sales_person")),
                }
                for name, df in built.items():
                    self.versions.write(version, name, conform(df, self.specs[name]))
                log, folder = BatchLog(self.context.store, f"gold-{version['name']}"), f"gold/{version['name']}/fact_sales"
                batches = plan_batches(details, "fact_sales", "sales_order_detail_id", s.batch_size, snapshot_id)
                fact = lambda rows: conform(gold.fact_sales(rows, headers), self.specs["fact_sales"])
                rows = write_batches(details, "sales_order_detail_id", batches, log, folder, fact, self.context.retry, before_batch)
                self.versions.note(version, "fact_sales", rows)
                dimensions = {n: self.versions.read(version, n) for n in built}
                written = read_committed(log, folder)
                for name, df in (dimensions | {"fact_sales": written}).items():
                    validation.output_schema(df.drop("batch_id"), self.specs[name].schema).require(name)
                report = validation.gold_report(written, dimensions, details, headers, s.kpi_tolerance)
                report.require("gold")
                pointer = self.versions.publish(version, list(self.specs), report.as_dict())
                self.context.audit.finish("run", f"gold-{run_id}", Status.PUBLISHED, gold_version=version["name"])
                self.versions.clean_up()
                event(LOG, "gold_published", gold_version=version["name"], rows_written=rows, snapshot_id=snapshot_id)
                return {"status": Status.SUCCESS, "published": True, "run_id": run_id, "gold_version": pointer["version"], "snapshot_id": snapshot_id, "rows_written": rows, "tables": pointer["tables"]}
            except Exception as error:
                self.versions.fail(version, f"{type(error).__name__}: {error}"[:500])
                return _failed(error, run_id=run_id, gold_version=version["name"], snapshot_id=snapshot_id)
