"""Suffix-array dedup by distributed prefix doubling.

A byte goes if it lies in a string of 100 bytes that also starts earlier: in a document with a smaller
id, or before in the same one.  Ranking every suffix of a corpus would sort a row a byte, so only sampled
suffixes are ranked: of the 61 strings of 20 bytes that begin in the first part of a 100-byte string, the
one with the least hash.  The choice depends on the string alone, so equal strings choose alike, and one
byte in about 31 is a sample.

A rank is a 64-bit name that stands for a pair of ranks: that of a sample's first 20 bytes and that of the
20 bytes behind them (formed in the task that has the text).  Spark sorts the ranks of 40 bytes by range; those
that one document alone has are unique and drop out.  In the next round what is left is ranked past the
threshold: by all bytes that the 100-byte strings with this sample cover (a context, 100 to 160 bytes).  If
a context stands in an earlier document, all its strings go.  Only where samples with equal ranks have
different contexts, at the ends of repeated passages, single strings are ranked.  In all, a row a sample
is sorted once, and a few rows an end of a passage after that.

Hot passages: ranks are dealt by range of (rank, sequence), contexts and strings are aggregated before they
are shuffled, and joins back are joins of two plain exchanges, which Spark splits by skew.  Exact copies
of a text are settled by its hash.  Contexts and strings are compared by 128-bit hashes, repeats within a text on its bytes.

Defined results: null and empty texts have 0 bytes and the hash of the empty string; texts under 100 bytes
lose nothing; rows with a null id, and rows that repeat an id, are compared with smaller ids (null: with none)
and with themselves; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import binaries, chunked, mix, powers, shared_names, small_batches, table
from tidewell.llm.passages import CONTEXT, CONTEXT_SQL, Strings, context_batch, earlier
from tidewell.sources.settled import release, settle

MATCH, GRAM = 100, 20
PREFIX = 2 * GRAM
#: A string's sample starts at one of its first REACH bytes, so its PREFIX bytes lie in the string.
REACH = MATCH - PREFIX + 1
#: Starts of strings that are handled at a time.
BLOCK = 1 << 16
_NOTHING = hashlib.sha256(b"").hexdigest()
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_HASH, _PLACE = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def _sums(text: bytes, start: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(size + 1)
    part = np.frombuffer(text, dtype=np.uint8, count=size, offset=start)
    return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTES[part] * up[:size])]), down


def samples(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each sample: the first and the last start of the strings that chose it, its rank and its place."""
    found = []
    for base in range(0, len(text) - MATCH + 1, BLOCK):
        starts = min(BLOCK, len(text) - MATCH + 1 - base)
        sums, down = _sums(text, base, starts + MATCH - 1)
        grams = (sums[GRAM:] - sums[:-GRAM]) * down[: len(sums) - GRAM]
        least, width = (grams & _HASH) | np.arange(len(grams), dtype=np.uint64), 1
        while 2 * width <= REACH:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        at = (np.minimum(least[:starts], least[REACH - width : REACH - width + starts]) & _PLACE).astype(np.int64)
        turns = np.flatnonzero(at[1:] != at[:-1]) + 1
        first, last = np.concatenate([[0], turns]), np.concatenate([turns - 1, [starts - 1]])
        at = at[first]
        found.append((first + base, last + base, mix((sums[at + PREFIX] - sums[at]) * down[at]).view(np.int64), at + base))
    if not found:
        return (np.empty(0, dtype=np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


_SKETCH = pa.schema([("doc_id", pa.int64()), ("seq", pa.binary()), ("n_bytes", pa.int64()), ("own", pa.bool_()), ("ranks", pa.list_(pa.int64()))])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's hash, whether it repeats a rank itself, and the ranks of each text once a task."""
    seen: dict[bytes, bool] = {}

    def rows(batch: pa.RecordBatch):
        for doc_id, text in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), strict=True):
            text = text or b""
            seq = hashlib.sha256(text).digest()
            if doc_id is None or len(text) < MATCH or seq in seen:
                yield doc_id, seq, len(text), seen.get(seq, False), []
            else:
                ranks = samples(text)[2]
                once = np.unique(ranks)
                seen[seq] = len(once) < len(ranks)
                yield doc_id, seq, len(text), seen[seq], once

    for batch in batches:
        yield from chunked(rows(batch), _SKETCH, 512)


def _spans(starts: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of bytes that strings at these starts (sorted) cover."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > MATCH)
    return list(zip(starts[np.concatenate([[0], breaks + 1])].tolist(), (starts[np.concatenate([breaks, [len(starts) - 1]])] + MATCH).tolist(), strict=True))


def _all_starts(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers from first to last, for each pair."""
    size = last - first + 1
    return np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


def _own_repeats(text: bytes, starts: np.ndarray) -> np.ndarray:
    """Of these starts (sorted), those whose string also stands at an earlier one of them."""
    hashes = np.empty(len(starts), dtype=np.uint64)
    for base in range(0, len(text) - MATCH + 1, BLOCK):
        low, high = np.searchsorted(starts, [base, base + BLOCK])
        if low < high:
            sums, down = _sums(text, base, min(BLOCK + MATCH - 1, len(text) - base))
            at = starts[low:high] - base
            hashes[low:high] = (sums[at + MATCH] - sums[at]) * down[at]
    order = np.argsort(hashes, kind="stable")
    same = np.concatenate([[False], hashes[order[1:]] == hashes[order[:-1]]])
    heads = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    again = []
    for k in np.flatnonzero(same).tolist():
        at = int(starts[order[k]])
        string = text[at : at + MATCH]
        for other in (int(starts[order[j]]) for j in range(heads[k], k)):  # the first is equal, but for chance
            if text[other : other + MATCH] == string:
                again.append(at)
                break
    return np.sort(np.array(again, dtype=np.int64))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contexts of the samples that may repeat, with the first and last start of their strings; and
    (with null names) the stretches of bytes that repeat within a text."""
    for batch in batches:
        ids, cids, shared = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
        found, own_rows = [], []
        for k, text in enumerate(binaries(batch.column(2))):
            first, last, ranks, places = samples(text)
            met = shared[k].values
            open_ = np.isin(ranks, met.to_numpy()) if met is not None else np.zeros(len(ranks), dtype=bool)
            _, back, count = np.unique(ranks, return_inverse=True, return_counts=True)
            if len(count) < len(ranks):
                own = count[back] > 1
                again = _own_repeats(text, _all_starts(first[own], last[own]))
                own_rows += [(ids[k], cids[k], None, None, None, low, high, None) for low, high in _spans(again)]
                left = last - first + 1 > np.searchsorted(again, last, side="right") - np.searchsorted(again, first)
                open_ = (open_ | own) & left
            at = np.flatnonzero(open_)
            low, high = first[at], last[at]
            found.append((ids[k], cids[k], ranks[at], [text[i:j] for i, j in zip(low.tolist(), (high + MATCH).tolist(), strict=True)], low, high, places[at]))
        yield context_batch(found)
        if own_rows:
            yield from chunked(own_rows, CONTEXT)


_STRINGS = Strings(MATCH, (16, 4, 1), lambda text: text, lambda units: units)


_CUT = pa.schema([("doc_id", pa.int64()), ("seq", pa.binary()), ("removed", pa.int64()), ("spans", pa.int64()), ("kept", pa.binary()), ("digest", pa.string())])
_CUT_SQL = "doc_id long, seq binary, removed long, spans long, kept binary, digest string"


def without(text: bytes, low: np.ndarray, high: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes and maximal stretches that go, and the bytes that stay."""
    edges = np.zeros(len(text) + 1, dtype=np.int32)
    np.add.at(edges, low, 1)
    np.add.at(edges, high, -1)
    stays = np.cumsum(edges[:-1]) == 0
    stretches = int(np.count_nonzero(np.diff(np.concatenate([[True], stays]).astype(np.int8)) == -1))
    return int(len(text) - stays.sum()), stretches, np.frombuffer(text, dtype=np.uint8)[stays].tobytes()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(batch: pa.RecordBatch):
        ids, seqs, gone = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
        for k, text in enumerate(binaries(batch.column(2))):
            parts = gone[k].values
            removed, stretches, kept = without(text, *(parts.field(i).to_numpy() for i in (0, 1)))
            yield ids[k], seqs[k], removed, stretches, kept, hashlib.sha256(kept).hexdigest()

    for batch in batches:
        yield from chunked(rows(batch), _CUT, 128)


def _cut_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without an id: compared with themselves."""

    def rows(batch: pa.RecordBatch):
        for text in binaries(batch.column(0)):
            text = text or b""
            spans = _spans(_own_repeats(text, np.arange(max(0, len(text) - MATCH + 1))))
            low, high = np.array(spans, dtype=np.int64).reshape(-1, 2).T
            removed, stretches, kept = without(text, low, high)
            yield None, hashlib.sha256(text).digest(), len(text), removed, stretches, kept, hashlib.sha256(kept).hexdigest()

    schema = pa.schema([*list(_CUT)[:2], pa.field("n_bytes", pa.int64()), *list(_CUT)[2:]])
    for batch in batches:
        yield from chunked(rows(batch), schema, 128)


def dedup(documents: DataFrame) -> DataFrame:
    """doc_id, seq (SHA-256 of the text), n_bytes, n_removed, n_spans, kept (the bytes that stay; null where all
    do) and their hash; one row a document."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    small_batches(spark)
    # Round 1: ranks of 40 bytes at the samples; unique ones drop out.
    sketches = settle(texts.where("doc_id is not null").mapInArrow(_sketch, "doc_id long, seq binary, n_bytes long, own boolean, ranks array<long>"), "ranks")
    known = settle(sketches.select("doc_id", "seq", "n_bytes", "own"), "rows")
    seq64 = F.xxhash64("seq")
    spread = sketches.select(F.explode("ranks").alias("name"), seq64.alias("seq64")).repartitionByRange("name", "seq64").sortWithinPartitions("name", "seq64")
    shared = spread.mapInArrow(shared_names, "seq64 long, name long").groupBy("seq64").agg(F.collect_set("name").alias("shared"))
    first = settle(known.where(F.col("n_bytes") >= MATCH).groupBy("seq").agg(F.min("doc_id").alias("doc_id"), F.max("own").alias("own")), "first")
    chosen = first.select("doc_id", "seq", "own", seq64.alias("seq64")).join(shared, "seq64", "left").where("own or shared is not null").select("doc_id", "seq", "shared")
    found = texts.where("doc_id is not null and text is not null").join(chosen, "doc_id").where("unhex(sha2(cast(text as binary), 256)) = seq").dropDuplicates(["doc_id", "seq"])
    candidates = settle(found.select("doc_id", F.monotonically_increasing_id().alias("cid"), "seq", "text", "shared"), "candidates", dense=True)
    release(sketches)
    # Round 2: past the threshold, by contexts.
    contexts = settle(candidates.select("doc_id", "cid", "text", "shared").mapInArrow(_contexts, CONTEXT_SQL), "contexts")
    # Further rounds, over parts of contexts down to single strings, follow where contexts of one rank differ.
    own = settle(contexts.where("a is null").select("cid", "low", "high"), "own")
    older = earlier(contexts, candidates, _STRINGS).select("cid", "low", (F.col("high") + MATCH).alias("high"))
    gone = older.unionByName(own).groupBy("cid").agg(F.collect_list(F.struct("low", "high")).alias("gone"))
    cut = candidates.join(gone, "cid").select("doc_id", "seq", "text", "gone").mapInArrow(_cut, _CUT_SQL)
    rows = known.join(first.select("seq", F.col("doc_id").alias("first_id")), "seq", "left").join(cut, ["doc_id", "seq"], "left")
    copy, none = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)), F.lit(0).cast("long")
    out = rows.select(
        "doc_id", "seq", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("removed", none)).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("spans", none)).alias("n_spans"), F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(copy, F.lit(_NOTHING)).otherwise(F.coalesce("digest", F.lower(F.hex("seq")))).alias("kept_sha256"),
    )
    alone = texts.where("doc_id is null").select("text").mapInArrow(_cut_alone, "doc_id long, seq binary, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return out.unionByName(alone)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
pieces AS (SELECT r, doc_id, c, substr(x, 2048 * c + 1, 2048 + 2 * {MATCH} - 2) AS x FROM (SELECT *, unnest(range(length(x) // 2048 + 1)) AS c FROM d)),
win AS (SELECT r, doc_id, 1024 * c + i AS i, md5(substr(x, 2 * i + 1, 2 * {MATCH})) AS h FROM (SELECT *, unnest(range(length(x) // 2 - {MATCH - 1})) AS i FROM pieces WHERE length(x) >= 2 * {MATCH})),
own AS (SELECT h, min((doc_id, i)) AS one FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {MATCH} THEN 0 ELSE 1 END AS fresh FROM win JOIN own USING (h) WHERE (doc_id, i) > one),
span AS (SELECT r, min(i) AS s, max(i) + {MATCH} AS e FROM (SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM gone) GROUP BY r, k),
gaps AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS before FROM span),
per AS (SELECT r, count(*) AS n, sum(e - s) AS bytes, max(e) AS tail, string_agg(substr(x, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS kept FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(bytes, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
sha256(unhex(coalesce(kept || substr(x, 2 * tail + 1), x))) AS kept_sha256
FROM d LEFT JOIN per USING (r)
"""
