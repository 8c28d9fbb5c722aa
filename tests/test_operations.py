"""The control plane: retries, batches, staging, versions, gates, the runner and the CLI."""

from __future__ import annotations

import json
import logging
import time

import pytest
from pyspark.sql import functions as F

from tidewell.operators import gold
from tidewell.operators.quality import ContractError
from tidewell.plans import cli, logs
from tidewell.plans.audit import Audit, Quarantine
from tidewell.plans.batches import Action, BatchLog, batch_of, plan_batches, read_committed, write_batches
from tidewell.plans.contracts import BRONZE, SILVER, Status, TableSpec
from tidewell.plans.gates import layer_gate, overall
from tidewell.plans.jobs import BronzeJob, Context, GoldJob, SilverJob, read_bronze
from tidewell.plans.retry import Deadline, Retry, cancelled_after, is_transient
from tidewell.plans.runner import Runner, bootstrap, health, render
from tidewell.plans.settings import Settings
from tidewell.plans.staging import Stage, Staging, staging_name
from tidewell.plans.store import Store
from tidewell.plans.versions import RunActive, Versions
from tidewell.sources import raw
from tidewell.sources.adapter import SalesTables
from tidewell.streaming import incremental

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/warehouse")


# Retry and settings.


@pytest.mark.parametrize("attempts", [0, 4, 10])
def test_retry_limits(attempts):
    with pytest.raises(ValueError, match="attempts"):
        Retry(attempts)


def test_retry_only_what_may_pass():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError("connection reset")
        return "done"

    assert Retry(jitter=0).run(flaky, waits.append) == "done" and waits == [1.0, 2.0]
    with pytest.raises(ValueError, match="bad"):
        Retry().run(lambda: (_ for _ in ()).throw(ValueError("bad")), waits.append)
    with pytest.raises(TimeoutError):
        Retry(2).run(lambda: (_ for _ in ()).throw(TimeoutError()), lambda _: None)
    assert is_transient(RuntimeError("Deadlock found")) and not is_transient(RuntimeError("syntax"))
    assert Retry(first_wait=8, longest_wait=10, jitter=0.5).wait(3, 1.0) == 15


def test_deadline():
    now = [0.0]
    limit = Deadline(5, "table", lambda: now[0])
    limit.check()
    now[0] = 6
    with pytest.raises(TimeoutError, match="table took more than 5"):
        limit.check()


def slow(spark):
    """A job that would take minutes, in tasks that can be ended."""

    def wait(batches):
        for batch in batches:
            time.sleep(90)
            yield batch

    return spark.range(4).mapInPandas(wait, "id long")


def test_jobs_of_a_thread_end_with_its_time(spark):
    began = time.monotonic()
    with pytest.raises(TimeoutError, match="table t took more than 2"), cancelled_after(spark, 2, "table t"):
        slow(spark).count()
    assert time.monotonic() - began < 30
    with cancelled_after(spark, 60, "table u"):
        assert spark.range(10).count() == 10
    with pytest.raises(ValueError, match="mine"), cancelled_after(spark, 60, "table v"):
        raise ValueError("mine")
    assert not spark.sparkContext.getJobTags()


def test_a_hung_table_ends_and_the_others_go_on(spark, store):
    specs = {n: TableSpec(n, n, "id", ("id",)) for n in ("hung", "fine")}
    results = BronzeJob(Context(store, Settings(table_timeout_seconds=25, batch_timeout_seconds=25, retry_max_attempts=1)), lambda spec: slow(spark) if spec.target == "hung" else spark.range(3), specs).run("s", "2024-01-01")
    assert results["hung"]["status"] == Status.FAILED and "hung took more than 25 seconds" in results["hung"]["error"]
    assert results["fine"]["published"] and read_bronze(store, "fine").count() == 3


def test_settings():
    s = Settings.from_environment({"TIDEWELL_BATCH_SIZE": "5", "TIDEWELL_SOURCE_PASSWORD": "hush", "OTHER": "x"})
    assert s.batch_size == 5 and "hush" not in str(s.safe_summary())
    for wrong in ({"batch_size": 0}, {"retry_max_attempts": 4}, {"environment": "x"}, {"silver_rejected_threshold": -1}, {"retry_max_delay_seconds": 0.5}, {"environment": "production", "source_url": "jdbc:x"}):
        with pytest.raises(ValueError):
            Settings(**wrong)


def test_logs_hold_approved_fields_without_secrets(tmp_path):
    logger = logs.configure("INFO", str(tmp_path / "log"), ("hush",))
    logs.event(logger, "loaded password=abc", run_id="r hush", rows_read=3)
    with pytest.raises(ValueError, match="payload"):
        logs.event(logger, "x", payload="y")
    entry = json.loads((tmp_path / "log").read_text())
    assert entry["event"] == "loaded password=[REDACTED]" and entry["run_id"] == "r [REDACTED]" and entry["rows_read"] == 3
    logging.getLogger("tidewell").handlers.clear()


# Store, batches, staging, versions.


def test_store_replaces_atomically_and_locks(store):
    assert store.get("a/b.json") is None and store.create("a/b.json", {"x": 1}) and not store.create("a/b.json", {"x": 2})
    store.put("a/b.json", {"x": 3})
    assert store.get("a/b.json") == {"x": 3} and store.names("a") == ["b.json"]


def test_batches_resume_after_a_failure_and_skip_what_is_done(spark, store):
    df = spark.range(1, 26).withColumn("v", F.col("id") * 2)
    batches = plan_batches(df, "t", "id", 10, "s")
    assert [(b.low, b.high) for b in batches] == [(None, 10), (10, 20), (20, 25)]
    log = BatchLog(store, "load")

    def fail(batch):
        if batch.number == 2:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        write_batches(df, "id", batches, log, "staging/load", before=fail)
    assert log.checkpoint() == 10
    assert write_batches(df, "id", batches, log, "staging/load") == 25 and log.checkpoint() == 25
    marks = log.committed()
    assert write_batches(df, "id", batches, log, "staging/load") == 25 and log.committed() == marks
    assert read_committed(log, "staging/load").count() == 25
    with pytest.raises(ContractError, match="other content"):
        write_batches(df.withColumn("v", F.lit(0).cast("long")), "id", batches, log, "staging/load")
    assert log.resolve("unknown", "x") is Action.WRITE


def test_jobs_do_not_grow_with_batches(spark, store):
    """The first write and a resumed one, by 40 batches and by 60 (Spark lists over 32 folders by a job)."""
    df = spark.range(1, 601).withColumn("v", F.col("id") * 2)
    jobs = {}
    for size in (15, 10):
        batches = plan_batches(df, "t", "id", size, "s")
        log = BatchLog(store, f"load{size}")

        def fail(batch):
            if batch.number == 3:
                raise RuntimeError("lost")

        for run, before in enumerate((fail, None)):
            spark.sparkContext.setJobGroup(f"{size}-{run}", "batches")
            if before:
                with pytest.raises(RuntimeError):
                    write_batches(df, "id", batches, log, f"staging/{size}", before=before)
            else:
                assert write_batches(df, "id", batches, log, f"staging/{size}") == 600
            jobs[size, run] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{size}-{run}"))
        assert len(log.committed()) == len(batches) == 600 // size
        assert {m["rows"] for m in log.committed()} == {size} and read_committed(log, f"staging/{size}").distinct().count() == 600
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[15, 0] == jobs[10, 0] > 0 and jobs[15, 1] == jobs[10, 1] > 0


def test_markers_are_few_documents(spark, store):
    """A commit's markers are one document however many batches it has, also if the load breaks off; single ones are read beside them."""
    df = spark.range(1, 61).withColumn("v", F.col("id") * 2)
    batches, log = plan_batches(df, "t", "id", 2, "s"), BatchLog(store, "many")

    def fail(batch):
        if batch.number == 20:
            raise RuntimeError("lost")

    log.commit(batches[29], "x", 2)
    with pytest.raises(ContractError, match="other content"):
        write_batches(df, "id", batches, log, "staging/many")
    store.delete(f"{log.folder}/{batches[29].batch_id}.json")
    with pytest.raises(RuntimeError):
        write_batches(df, "id", batches, log, "staging/many", before=fail)
    assert len(log.committed()) == 19 and log.checkpoint() == 38 and len(store.names(log.folder)) == 1
    assert log.resolve(batches[5].batch_id, log.committed()[5]["content_hash"]) is Action.SKIP and log.resolve(batches[19].batch_id, "x") is Action.WRITE
    with pytest.raises(ContractError, match="other content"):
        log.resolve(batches[5].batch_id, "x")
    assert write_batches(df, "id", batches, log, "staging/many") == 60 and len(store.names(log.folder)) == 2
    assert [m["number"] for m in log.committed()] == list(range(1, 31)) and read_committed(log, "staging/many").distinct().count() == 60


def test_a_load_may_have_many_batches(spark):
    """A table of 10,000 batches and more is planned, each with its own bounds."""
    batches = plan_batches(spark.range(1, 12_002), "t", "id", 1, "s")
    assert len(batches) == 12_001 and [b.high for b in batches] == list(range(1, 12_002))


def test_batches_of_text_and_date_keys(spark, store):
    rows = spark.range(1, 31).selectExpr("concat('k', lpad(cast(id as string), 3, '0')) as k", "date_add(date'2024-01-01', cast(id as int)) as d", "id as v")
    for key in ("k", "d"):
        batches = plan_batches(rows, "t", key, 7, "s")
        log = BatchLog(store, f"load-{key}")
        assert len(batches) == 5 and write_batches(rows, key, batches, log, f"staging/{key}") == 30
        assert [m["rows"] for m in log.committed()] == [7, 7, 7, 7, 2]


def test_too_many_batches_raise(spark, monkeypatch):
    """The size asked for is kept; nobody gets larger batches without a word."""
    from tidewell.plans import batches as module

    monkeypatch.setattr(module, "MOST_BATCHES", 4)
    assert len(plan_batches(spark.range(1, 101), "t", "id", 25, "s")) == 4
    with pytest.raises(ContractError, match="ask for larger"):
        plan_batches(spark.range(1, 101), "t", "id", 10, "s")


def test_batches_of_a_key_that_repeats(spark, store):
    """Three quarters of the rows have one key, which stays in one batch; the load breaks off and is taken up."""
    df = spark.range(40).selectExpr("case when id < 3 then id when id < 33 then 5 else id end as k", "id as v")
    batches = plan_batches(df, "t", "k", 10, "s")
    assert [(b.low, b.high) for b in batches] == [(None, 5), (5, 39)] and len({b.batch_id for b in batches}) == 2
    assert sorted(map(tuple, gold.fact_batches(df, 10, "k").collect())) == [(1, None, 5, 33), (2, 5, 39, 7)]
    log = BatchLog(store, "hot")

    def fail(batch):
        if batch.number == 2:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        write_batches(df, "k", batches, log, "staging/hot", before=fail)
    assert log.checkpoint() == 5 and write_batches(df, "k", batches, log, "staging/hot") == 40
    assert [m["rows"] for m in log.committed()] == [33, 7] and read_committed(log, "staging/hot").distinct().count() == 40
    assert plan_batches(df.where("k is null"), "t", "k", 10, "s") == []


def test_batch_of_every_key(spark):
    """Keys on, between and beyond bounds, for any number of blocks."""
    for n in (1, 2, 3, 7, 16, 50):
        batches = plan_batches(spark.range(1, 2 * n + 1).selectExpr("id * 3 as k"), "t", "k", 2, "s")
        found = spark.range(1, 6 * n + 1).select("id", batch_of(F.col("id"), batches).alias("b")).collect()
        assert len(batches) == n and all(r["b"] == next(b.batch_id for b in batches if r["id"] <= b.high) for r in found)


def test_redaction_of_credentials():
    from tidewell.functions.identity import redact

    text = "db_password=x PGPASSWORD=y password: 'a b;c' {\"secret\": \"q\\\"w\"} pwd={a;b} jdbc:p://u:pw@h/db api_key = zz1"
    out = redact(text)
    assert not any(w in out for w in ("=x", "=y", "a b;c", "q\\", "a;b", "pw@", "zz1")) and out.count("[REDACTED]") == 7 and "u:[REDACTED]@h/db" in out
    assert redact("tokenizer=3, no secrets: none") != "" and redact("tokenizer=3") == "tokenizer=3" and redact("hush now", ["hush"]) == "[REDACTED] now"


def test_half_written_batches_are_not_read(spark, store):
    df = spark.range(1, 6)
    log = BatchLog(store, "load")
    batches = plan_batches(df, "t", "id", 5, "s")
    df.write.parquet(store.path(f"staging/load/batch_id={batches[0].batch_id}"))
    with pytest.raises(ContractError, match="no committed batch"):
        read_committed(log, "staging/load")
    assert write_batches(df, "id", batches, log, "staging/load") == 5


def test_staging_life(store):
    now = [0.0]
    staging = Staging(store, lambda: now[0])
    name = staging.open("t", "run", "load")
    assert staging.open("t", "run", "load") == name and len(staging_name("t" * 60, "r", "l")) <= 63
    with pytest.raises(ContractError, match="not validated"):
        staging.move(name, Stage.PUBLISHED)
    staging.update(name, validated=True)
    staging.move(name, Stage.PUBLISHED)
    assert staging.clean_up() == []
    staging.update(name, audited=True)
    assert staging.clean_up(keep={name}) == [] and staging.clean_up() == [name]
    other = staging.open("u", "run", "load")
    staging.move(other, Stage.FAILED)
    assert staging.clean_up() == []
    now[0] = 25 * 3600
    assert staging.clean_up() == [other]
    with pytest.raises(ContractError):
        staging.move(other, Stage.ACTIVE)


def test_versions(spark, store):
    now = [0.0]
    versions = Versions(store, "gold", lambda: now[0])
    with versions.active_run("a"):
        with pytest.raises(RunActive), versions.active_run("b"):
            pass
    with pytest.raises(ContractError, match="nothing is published"):
        versions.read_current("t")
    first = versions.allocate("a", "s1")
    assert versions.allocate("a", "s1")["name"] == first["name"] == "v001"
    versions.write(first, "t", spark.range(3))
    with pytest.raises(ContractError, match="lacks u"):
        versions.publish(first, ["t", "u"], {"passed": True})
    with pytest.raises(ContractError, match="not validated"):
        versions.publish(first, ["t"], {"passed": False})
    pointer = versions.publish(first, ["t"], {"passed": True})
    assert versions.publish(first, ["t"], {"passed": True}) == pointer and versions.read_current("t", "s1").count() == 3
    with pytest.raises(ContractError, match="is current"):
        versions.read_current("t", "s2")
    for k in "bcd":
        versions.fail(versions.allocate(k, "s2"), "broken")
    assert versions.current()["version"] == "v001" and versions.clean_up() == []
    now[0] = 49 * 3600
    assert versions.clean_up() == ["v002"]


def test_audit_and_quarantine(spark, store):
    now = [0.0]
    audit = Audit(store, lambda: now[0])
    audit.start("run", "r1")
    now[0] = 8000
    assert audit.sweep_stale(7200) == ["r1"] and audit.sweep_stale(7200) == []
    audit.start("batch", "b")
    audit.finish("batch", "b", Status.SUCCESS)
    with pytest.raises(ContractError):
        audit.start("batch", "b")
    audit.finish("run", "r2", Status.FAILED, RuntimeError("pwd=x"))
    assert "pwd=[REDACTED]" in [e for e in audit.entries("run") if e["name"] == "r2"][0]["error"]
    rejected = spark.createDataFrame([("1", "bad"), ("1", "bad"), ("2", "bad")], "record_key string, rejection_reason string")
    quarantine = Quarantine(store)
    assert quarantine.add(rejected, "t", "r", "l") == 2 and quarantine.add(rejected, "t", "r", "l") == 2
    quarantine.add(rejected, "t", "r", "l2")
    assert quarantine.read("t").count() == 2


def test_gates():
    good = {n: {"status": "SUCCESS", "published": True, "run_id": "r", "load_id": "l", "snapshot_id": "s"} for n in BRONZE}
    assert layer_gate(good, BRONZE, "s")["status"] == Status.SUCCESS
    for change in ({"status": "FAILED"}, {"published": False}, {"run_id": ""}, {"snapshot_id": "t"}):
        assert layer_gate(good | {"person": good["person"] | change}, BRONZE, "s")["failures"]
    assert layer_gate({n: r for n, r in good.items() if n != "person"}, BRONZE, "s")["failures"] == ["person: no result"]
    assert overall(["SUCCESS", "FAILED"]) == Status.PARTIAL_SUCCESS and overall([]) == Status.FAILED and overall(["SUCCESS", "SUCCESS_WITH_REJECTIONS"]) == Status.SUCCESS_WITH_REJECTIONS


# The jobs, on clean raw tables made of the smallest warehouse.


def sources(spark, dirty=False):
    t = SalesTables(spark, SMALL)
    plain = {
        "sales_order_header": raw.raw_header(t), "sales_order_detail": raw.raw_detail(t), "customer": raw.raw_customer(t), "sales_territory": raw.raw_territory(t),
        "sales_person": raw.raw_salesperson(t).withColumn("BusinessEntityID", F.col("BusinessEntityID") % 100_000_000), "person": raw.raw_person(t), "product": raw.raw_product(t),
    }
    plain["sales_territory"] = plain["sales_territory"].withColumns({c: F.when(F.trim(F.regexp_replace(c, "\\s", "")) == "", "x").otherwise(F.col(c)) for c in ("CountryRegionCode", "Group")})
    if not dirty:
        plain["product"] = plain["product"].withColumn("ProductNumber", F.when(F.trim("ProductNumber") == "", "x").otherwise(F.col("ProductNumber")))
        bad = "OrderDate = 'not-a-date' or TotalDue = 'abc' or CustomerID = '12.5'"
        plain["sales_order_header"] = plain["sales_order_header"].where(f"_load_date = '{raw.OLD}'").withColumns({"OrderDate": F.when(F.expr(bad), "1999-01-01").otherwise(F.col("OrderDate")), "TotalDue": F.when(F.expr(bad), "1").otherwise(F.col("TotalDue")), "CustomerID": F.when(F.expr(bad), "3").otherwise(F.col("CustomerID"))})
        plain["sales_order_detail"] = plain["sales_order_detail"].where("OrderQty <> '1.5' and LineTotal <> '1,000'")
        plain["customer"] = plain["customer"].where(f"_load_date = '{raw.OLD}' and trim(AccountNumber) <> ''").unionByName(plain["customer"].where("trim(AccountNumber) = ''").withColumn("AccountNumber", F.lit("x")))
        plain["product"] = plain["product"].withColumn("ListPrice", F.when(F.col("ListPrice") != "n/a", F.col("ListPrice")))
    return {n: df.drop("_load_date", "_record_hash", "_source_system", "_source_table") for n, df in plain.items()}


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    settings = Settings(warehouse=f"file://{tmp_path_factory.mktemp('w')}", batch_size=4000)
    frames = sources(spark)
    runner = Runner(spark, settings, lambda spec: frames[spec.target])
    return runner, runner.run(snapshot_id="snap-1")


def test_full_run(done):
    runner, result = done
    assert result["status"] == Status.SUCCESS, json.dumps(result["stages"], default=str)[:3000]
    gold = result["stages"]["gold"]
    assert gold["published"] and gold["gold_version"] == "v001" and set(gold["tables"]) == {"dim_date", "dim_customer", "dim_product", "dim_territory", "dim_salesperson", "fact_sales"}
    fact = runner.context.store.spark.read.parquet(runner.context.store.path("gold/v001/fact_sales"))
    assert fact.count() == gold["tables"]["fact_sales"] == result["stages"]["silver"]["tables"]["sales_order_detail"]["rows_written"]
    assert {"full", "bronze"} >= {result["stage"]} and "| gold |" in render(result, "markdown") and json.loads(render(result))["status"] == "SUCCESS"
    assert health(runner.spark, runner.settings, runner.source)["status"] == "ok"


def test_single_stages_build_on_what_is_published(done):
    runner, _ = done
    silver = runner.run(stage="silver")
    assert silver["status"] == Status.SUCCESS and set(silver["stages"]["silver"]["tables"]) == set(SILVER)
    gold = runner.run(stage="gold")
    assert gold["status"] == Status.SUCCESS and gold["stages"]["gold"]["gold_version"] == "v002"
    assert runner.run(mode="other")["status"] == Status.FAILED


def test_gold_resumes_and_a_failure_keeps_the_old_version(done):
    runner, _ = done
    job = GoldJob(runner.context)
    before = job.versions.current()["version"]

    def fail(batch):
        if batch.number == 2:
            raise RuntimeError("lost")

    broken = job.run(run_id="again", before_batch=fail)
    assert broken["status"] == Status.FAILED and job.versions.current()["version"] == before
    log = BatchLog(runner.context.store, f"gold-{broken['gold_version']}")
    assert len(log.committed()) == 1
    fixed = job.run(run_id="again")
    assert fixed["status"] == Status.SUCCESS and fixed["gold_version"] == broken["gold_version"] == job.versions.current()["version"]
    with pytest.raises(ContractError, match="is current"):
        job.run(snapshot_id="other")


def test_incremental_bronze_reads_past_the_last_bound(spark, store):
    spec = TableSpec("T", "t", "k", ("k", "v"))
    rows = {"n": 10}
    job = BronzeJob(Context(store, Settings(batch_size=4)), lambda _: spark.range(1, rows["n"] + 1).selectExpr("id as k", "id * 2 as v"), {"t": spec})
    assert job.run("s1", "2024-01-01")["t"]["rows_written"] == 10
    rows["n"] = 15
    assert job.run("s2", "2024-01-02", mode="incremental")["t"]["rows_written"] == 5
    assert read_bronze(store, "t").count() == 15
    again = job.run("s3", "2024-01-03", mode="incremental")["t"]
    assert again["status"] == Status.SUCCESS and again["rows_written"] == 0 and read_bronze(store, "t").count() == 15


def test_bronze_thresholds_and_missing_columns(spark, store):
    spec = TableSpec("T", "t", "k", ("k", "v"))
    rows = spark.createDataFrame([(1, 1), (None, 2)], "k int, v int")
    strict = BronzeJob(Context(store), lambda _: rows, {"t": spec}).run("s", "2024-01-01")["t"]
    assert strict["status"] == Status.FAILED and not strict["published"]
    loose = BronzeJob(Context(store, Settings(bronze_rejected_threshold=1)), lambda _: rows, {"t": spec}).run("s", "2024-01-01")["t"]
    assert loose["status"] == Status.SUCCESS_WITH_REJECTIONS and loose["rows_rejected"] == 1
    lost = BronzeJob(Context(store), lambda _: rows.drop("v"), {"t": spec}).run("s", "2024-01-01")["t"]
    assert "lacks v" in lost["error"]
    assert "no rows" in BronzeJob(Context(store), lambda _: rows.where("false"), {"t": spec}).run("s9", "2024-01-01")["t"]["error"]


def test_silver_fails_closed_on_rejections_and_missing_bronze(spark, tmp_path):
    frames = sources(spark, dirty=True)
    runner = Runner(spark, Settings(warehouse=f"file://{tmp_path}", batch_size=10**6), lambda spec: frames[spec.target])
    with pytest.raises(ContractError, match="bronze gate"):
        SilverJob(runner.context).run({}, "s")
    bronze = {n: {"status": "SUCCESS", "published": True, "run_id": "r", "load_id": "l", "snapshot_id": "s"} for n in BRONZE}
    job = SilverJob(runner.context, reader=lambda name: raw.with_lineage(frames[name], name, raw.OLD))
    results = job.run(bronze, "s")
    assert results["sales_order_header"]["status"] == Status.FAILED and "rejected rows" in results["sales_order_header"]["error"]
    assert results["sales_territory"]["status"] == Status.SUCCESS and not results["sales_territory"]["published"] and job.versions.current() is None


# CLI, bootstrap, streaming.


class FakeRunner:
    def __init__(self, status):
        self.status = status

    def run(self, *args):
        self.args = args
        return {"status": self.status, "mode": "full", "stage": "full", "rows_read": 0, "rows_written": 0, "rows_rejected": 0, "stages": {}}


@pytest.mark.parametrize(("status", "code"), [("SUCCESS", 0), ("SUCCESS_WITH_REJECTIONS", 0), ("PARTIAL_SUCCESS", 2), ("FAILED", 1)])
def test_exit_codes(tmp_path, status, code):
    report = tmp_path / "report.md"
    assert cli.main(["--report", str(report), "--report-format", "markdown"], lambda: FakeRunner(status)) == code
    assert status in report.read_text()


def test_cli_failures(tmp_path):
    assert cli.main(["--recovery-snapshot", str(tmp_path / "none")], lambda: FakeRunner("SUCCESS")) == 1
    assert cli.main(["--report", str(tmp_path / "no" / "dir")], lambda: FakeRunner("SUCCESS")) == 2
    with pytest.raises(SystemExit):
        cli.main(["--mode", "other"], lambda: FakeRunner("SUCCESS"))


def test_bootstrap(store):
    assert bootstrap(store)["version"] == bootstrap(store)["version"] == 1
    store.put("control/schema.json", {"version": 2})
    with pytest.raises(ContractError, match="schema version 2"):
        bootstrap(store)


def test_stream_commits_each_micro_batch_once(spark, store, tmp_path):
    source = tmp_path / "in"
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    first, rest = events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")
    first.write.parquet(str(source))
    log = BatchLog(store, "events")

    def load():
        incremental.load(incremental.read_stream(spark, str(source), events.schema), log, "staging/events", str(tmp_path / "check")).awaitTermination(120)

    load()
    assert read_committed(log, "staging/events").count() == first.count()
    rest.write.mode("append").parquet(str(source))
    load()
    load()
    assert read_committed(log, "staging/events").count() == events.count()


def test_windowed_counts(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    counts = incremental.windowed_counts(incremental.read_stream(spark, str(tmp_path / "in"), events.schema))
    counts.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start().awaitTermination(120)
    got = spark.sql("select sum(events) from windows").first()[0]
    assert got == events.count()


# Settled tables.


def test_scratch_releases_what_is_not_kept(spark):
    from tidewell.sources import settled

    with settled.scratch() as kept:
        one, two = settled.settle(spark.range(3), "one"), settled.settle(spark.range(4), "two")
        with settled.scratch() as inner:
            three, four = settled.settle(spark.range(5), "three"), settled.settle(spark.range(6), "four")
            inner.append(three)
        kept.append(two)
    gone = [t for t in (one, three, four) if t not in settled._settled]
    assert len(gone) == 3 and two.count() == 4


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from tidewell.sources.settled import shared_folder

    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None, set=lambda *_: None), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda _: None))

    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_folder(session(master))
    assert "tidewell-" in shared_folder(session("local[4]"))
