"""Quality rules as a bitmask ledger.

One pass over the whole texts measures every document and evaluates every rule once: bit i of
``fail_bits`` is set where rule i fails.  The ledger (measurements and bits) is stored in the shared
folder.  A policy is a version name with a mask and a limit; applying or comparing policies reads
the stored bits alone, never the texts, and ablations are bitwise aggregates over the ledger.

Defined results: a null, empty or wordless text has no words, fails ``too_few_words`` and is not
kept; a repeated row gets a row of its own; an empty table gives an empty ledger; of the input
only doc_id (which may be null) and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import binaries, chunked, small_batches, table, windows, word_hashes
from tidewell.sources.settled import settle

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(0x41, 0x5B))
_LETTERS = bytes([*range(0x41, 0x5B), *range(0x61, 0x7B)])

#: The rules in bit order: name -> SQL condition of failure over the measurements (whole numbers only).
RULES: dict[str, str] = {
    "too_few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "n_lines > 3 and 10 * n_dup_lines > 5 * n_lines",
    "capitals": "n_letters > 0 and 10 * n_upper > 5 * n_letters",
}


@dataclass(frozen=True)
class Policy:
    """Keeps documents that fail none of ``fatal`` and fewer than ``limit`` of ``counted``."""

    version: str
    fatal: tuple[str, ...]
    counted: tuple[str, ...] = ()
    limit: int = 1


POLICIES = {
    p.version: p
    for p in (
        Policy("base", ("too_few_words", "repeated_words")),
        Policy("v1", ("too_few_words", "repeated_words", "symbols", "capitals", "duplicate_lines"), ("short_words", "long_words")),
    )
}
PRODUCTION = "v1"


def mask(names: tuple[str, ...]) -> int:
    order = list(RULES)
    return sum(1 << order.index(n) for n in names)


def measure(text: bytes | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_letters, n_upper of one text."""
    text = text or b""
    words = text.split()
    chars = len(text.translate(None, _SPACE + _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    letters = len(text) - len(text.translate(None, _LETTERS))
    upper = len(text) - len(text.translate(None, _UPPER))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if len(words) > WINDOW:
        at = windows(word_hashes(words), WINDOW)
        _, back, count = np.unique(at, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[back] > 1)
        if len(twice):
            edges = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edges, twice, 1)
            np.add.at(edges, twice + WINDOW, -1)
            repeated = int(np.count_nonzero(np.cumsum(edges)))
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), repeated, letters, upper


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")
_ARROW = pa.schema([("doc_id", pa.int64()), *((m, pa.int64()) for m in _MEASURES)])


def ledger(documents: DataFrame) -> DataFrame:
    """doc_id, the measurements and fail_bits of every document."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from chunked(((i, *measure(t)) for i, t in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), strict=True)), _ARROW)

    measured = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ", ".join(f"{f.name} long" for f in _ARROW))
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("fail_bits", total.cast("long"))


def keeps(policy: Policy, bits: Column) -> Column:
    """A policy's verdict from the failure bits alone."""
    fine = bits.bitwiseAND(F.lit(mask(policy.fatal))) == 0
    return fine & (F.bit_count(bits.bitwiseAND(F.lit(mask(policy.counted)))) < policy.limit) if policy.counted else fine


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that would be kept
    without it.  Counts meet by distinct bit pattern first, so no text and few rows are shuffled."""
    used = mask(policy.fatal + policy.counted)
    patterns = entries.select(F.col("fail_bits").bitwiseAND(F.lit(used)).alias("bits")).groupBy("bits").agg(F.count("*").alias("n"))
    rules = [(i, name) for i, name in enumerate(RULES) if name in policy.fatal + policy.counted]
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, name in rules]))
    seen = patterns.select("bits", "n", each.alias("r")).select("bits", "n", "r.rule", "r.bit").where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    without = F.col("bits").bitwiseXOR(F.col("bit"))
    return seen.groupBy("rule").agg(
        F.sum("n").alias("n_fail"),
        F.sum(F.when(without == 0, F.col("n")).otherwise(0)).alias("n_fail_alone"),
        F.sum(F.when(keeps(policy, without), F.col("n")).otherwise(0)).alias("n_kept_without"),
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = settle(ledger(table(spark, sf_dir, "documents")), "ledger")
    base, production = POLICIES["base"], POLICIES[PRODUCTION]
    return entries.select(
        "doc_id", *_MEASURES,
        (~keeps(base, F.col("fail_bits"))).alias("base_failed"),
        (keeps(base, F.col("fail_bits")) & keeps(production, F.col("fail_bits"))).alias("kept"),
        "fail_bits",
    )


def ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ablation of every policy, from one stored ledger."""
    entries = settle(ledger(table(spark, sf_dir, "documents")), "ledger")
    each = [ablation(entries, p).select(F.lit(p.version).alias("version"), "rule", "n_fail", "n_fail_alone", "n_kept_without") for p in POLICIES.values()]
    return reduce(DataFrame.unionByName, each)


_LEDGER = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 8)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
m AS (SELECT d.r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
             CAST(length(regexp_replace(t, '[^A-Za-z]+', '', 'g')) AS BIGINT) AS n_letters, CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_upper
      FROM d LEFT JOIN rep ON d.r = rep.r),
b AS (SELECT *, CAST((CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
             + (CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END) + (CASE WHEN word_chars > 25 * n_words THEN 8 ELSE 0 END)
             + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 16 ELSE 0 END) + (CASE WHEN n_lines > 3 AND 10 * n_dup_lines > 5 * n_lines THEN 32 ELSE 0 END)
             + (CASE WHEN n_letters > 0 AND 10 * n_upper > 5 * n_letters THEN 64 ELSE 0 END) AS BIGINT) AS fail_bits FROM m)
"""
ORACLE = f"""{_LEDGER}SELECT doc_id, {', '.join(_MEASURES)}, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b"""


def _ablation_sql(policy: Policy) -> str:
    """Each rule of a policy against its documents, one by one, with the bits spelled out."""
    used, fatal, counted = mask(policy.fatal + policy.counted), mask(policy.fatal), mask(policy.counted)
    kept = f"x & {fatal} = 0 AND ({counted} = 0 OR bit_count(x & {counted}) < {policy.limit})"
    rules = ", ".join(f"('{name}', {1 << i})" for i, name in enumerate(RULES) if name in policy.fatal + policy.counted)
    return f"""SELECT '{policy.version}' AS version, rule, CAST(count(*) AS BIGINT) AS n_fail, CAST(count(*) FILTER (WHERE fail_bits & {used} = bit) AS BIGINT) AS n_fail_alone,
        CAST(count(*) FILTER (WHERE {kept.replace('x &', f'(fail_bits & {used} & ~bit) &')}) AS BIGINT) AS n_kept_without
        FROM b JOIN (VALUES {rules}) r(rule, bit) ON fail_bits & bit <> 0 GROUP BY rule"""


ABLATION_ORACLE = f"{_LEDGER}{' UNION ALL '.join(map(_ablation_sql, POLICIES.values()))}"
