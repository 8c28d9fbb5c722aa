"""The corpus pipeline: language ID, near-dedup, decontamination, PII, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that the stage
before it kept, and its decisions take effect.  Every stage but the last returns the columns of
documents.  run() writes each stage's result to the shared folder and reads it again, so a lost
executor never costs more than the stage at hand.

Rows with a null doc_id pass near-dedup; all other decisions go by row, so rows that share an id are
judged by their own texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import decontaminate, language_id, mixing, near_dedup, pii
from tidewell.llm.common import table
from tidewell.sources.settled import settle

#: Least score of a language decision.  Clear texts score near 1 and texts in two languages near 0.5,
#: which are kept; below this, no language stands out.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letter) or with an undecided one go."""
    model = language_id.train(docs)
    return language_id.keep_decided(docs, model, LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest id."""
    return near_dedup.keep_first(docs)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated by the benchmark go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with their sizes, their sources' targets and the words taken."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_documents),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
]

#: SQL cannot express the trained language filter; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
