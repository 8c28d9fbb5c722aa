"""The pipeline against a brute-force version, stage by stage, on whole small tables."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.corpus import awkward, frame, prose
from tests.llm.test_mixing import check, size
from tests.llm.test_near_dedup import brute
from tests.llm.test_text_operators import PII_TEXTS, brute_hits, brute_spans
from tidewell.llm import language_id

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows, by name; every stage is written and read again."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
    return out


def test_language_stage_drops_only_what_has_no_language(spark, stages):
    model = language_id.train(spark.read.parquet(f"{SMALL}/documents.parquet"))
    want = [r for r in stages["documents"] if (d := language_id.decide(r["text"], model))[0] != "und" and d[1] >= corpus_pipeline.LEAST_SCORE]
    assert sorted(want) == sorted(stages["language_id"]) and len(want) > 0.95 * len(stages["documents"])


def test_near_dedup_stage_keeps_the_first_of_each_component(stages):
    keep = {i for i, _, _, kept in brute(stages["language_id"]) if kept}
    assert sorted(r for r in stages["language_id"] if r["doc_id"] in keep) == sorted(stages["near_dedup"])
    assert len(keep) < len(stages["language_id"])


def test_decontamination_stage(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = [r for r in stages["near_dedup"] if not brute_hits(r["text"], items)[-1]]
    assert sorted(want) == sorted(stages["decontamination"])


def test_pii_stage_leaves_no_personal_data_and_all_else(stages):
    before = {r["doc_id"]: r["text"] for r in stages["decontamination"]}
    assert len(stages["pii"]) == len(before) and any(brute_spans(t) for t in [*before.values(), *PII_TEXTS])
    for r in stages["pii"]:
        assert not brute_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not brute_spans(before[r["doc_id"]]) and "[IBAN]" not in r["text"] and "[ACCOUNT]" not in r["text"]:
            assert r["text"] == before[r["doc_id"]]


def test_mixing_stage(stages):
    got = {r["doc_id"]: r for r in stages["mixing"]}
    rows = [tuple(r[c] for c in COLUMNS) for r in stages["pii"]]
    full = [{"doc_id": r[0], "source": r[3], "size": size(r[1]), "taken": got[r[0]]["taken"] if r[0] in got else 0} for r in rows]
    known = {r["source"]: (r["target"], r["source_size"]) for r in stages["mixing"]}
    check(rows, [r | dict(zip(("target", "source_size"), known[r["source"]], strict=True)) for r in full])
    assert all(r["taken"] > 0 for r in stages["mixing"])


def test_stages_keep_the_columns_of_documents(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert list(stages[name][0].asDict()) == COLUMNS


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages["mixing"]))


@pytest.mark.parametrize("n", [0, None])
def test_stages_on_awkward_and_empty_tables(spark, tmp_path, n):
    """Extra columns pass through; language ID learns from these rows, so only its certain part is checked."""
    rows = awkward()[:n]
    docs = frame(spark, rows)
    spark.createDataFrame([(1, None), (None, "one two"), (2, prose(2, 70))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        assert set(docs.columns) <= set(kept.columns) and kept.count() <= docs.count()
        docs = kept
    texts = {r["text"] for r in docs.collect()}
    assert not texts & {None, "", " \n\t "} and (not rows or len(texts) > 5)
