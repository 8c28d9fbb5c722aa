"""Substring dedup with difference-cover anchors.

A word goes if it lies in a window of 50 words that also starts in a document with a smaller id.
Hashing every window of a corpus would shuffle a row per word, so only windows of 20 words that
start at cover positions are hashed: positions whose remainder modulo 31 is in a perfect difference
set.  Two equal runs of 50 words contain, within their first 31 positions, one aligned pair of
cover positions, so they share an anchor.  The anchors, sorted by range of (hash, sequence), show
which hashes occur in two sequences; only windows around those are extended.

The extension puts windows side by side that chose the same 20 words (those with the least hash of the
first 31) into one context, and compares contexts by the 128-bit hashes of their words; single windows become rows
only at the ends of repeated passages (``passages``).

Hot passages: anchors are split by range of (hash, sequence), so no task holds all occurrences of
one; contexts are aggregated before they are shuffled, and the joins back to them are ones that Spark
splits by skew.  Exact copies of whole texts collapse inside each task before anchors are shuffled
and are settled by the smallest id of their sequence.

Defined results: null and wordless texts have 0 words and the hash of the empty text; texts under
50 words lose nothing; rows with a null id lose nothing and take nothing away; rows that repeat an
id get a row each and take nothing from each other; windows are compared by the 128-bit hash of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import binaries, chunked, shared_names, small_batches, table, windows, word_hashes
from tidewell.llm.passages import CONTEXT_SQL, Strings, context_batch, earlier
from tidewell.sources.settled import release, settle

WINDOW, PERIOD = 50, 31
ANCHOR = WINDOW - PERIOD + 1
#: A perfect difference set: every difference modulo 31 but 0 occurs exactly once (fixed values).
COVER = (1, 5, 11, 24, 25, 27)
_NOTHING = hashlib.sha256(b"").hexdigest()
_HASH, _PLACE = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def cover_positions(n: int) -> np.ndarray:
    """Starts of anchors in a text of n words."""
    at = np.arange(max(0, n - ANCHOR + 1))
    return at[_IN_COVER[at % PERIOD]]


def anchors(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, anchor starts and anchor hashes of a text that has a window at all."""
    if len(words) < WINDOW:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    hashes = word_hashes(words)
    at = cover_positions(len(words))
    return hashes, at, windows(hashes, ANCHOR, at)


_SKETCH = pa.schema([("doc_id", pa.int64()), ("seq", pa.binary()), ("n_words", pa.int64()), ("anchors", pa.list_(pa.int64()))])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's sequence hash, and the anchors of each sequence once a task."""
    seen: set[bytes] = set()

    def rows(batch: pa.RecordBatch):
        for doc_id, text in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), strict=True):
            words = (text or b"").split()
            seq = hashlib.sha256(b" ".join(words)).digest()
            if doc_id is None or len(words) < WINDOW or seq in seen:
                yield doc_id, seq, len(words), []
            else:
                seen.add(seq)
                yield doc_id, seq, len(words), np.unique(anchors(words)[2]).view(np.int64)

    for batch in batches:
        yield from chunked(rows(batch), _SKETCH, 512)


def stretches(starts: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of windows side by side that chose the same gram of ANCHOR words: first and last start, the gram's rank and place."""
    least, width = (grams & _HASH) | np.arange(len(grams), dtype=np.uint64), 1
    while 2 * width <= PERIOD:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    at = (np.minimum(least[starts], least[starts + PERIOD - width]) & _PLACE).astype(np.int64)
    turns = np.flatnonzero((at[1:] != at[:-1]) | (np.diff(starts) > 1)) + 1
    first = np.concatenate([[0], turns])
    return starts[first], starts[np.concatenate([turns, [len(starts)]]) - 1], grams[at[first]].view(np.int64), at[first]


def _places(words: list[bytes]) -> tuple[bytes, list[int]]:
    """The words joined by spaces, and where each starts (and a last one would)."""
    return b" ".join(words), np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of all windows that hold a shared anchor within their first PERIOD positions."""
    for batch in batches:
        ids, cids, shared, made = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), []
        for k, text in enumerate(binaries(batch.column(2))):
            words = text.split()
            hashes, at, found = anchors(words)
            hits = at[np.isin(found.view(np.int64), shared[k].values.to_numpy())]
            n = len(hashes) - WINDOW + 1
            edges = np.zeros(n + 1, dtype=np.int64)
            np.add.at(edges, np.minimum(np.maximum(0, hits - PERIOD + 1), n), 1)
            np.add.at(edges, np.minimum(hits + 1, n), -1)
            starts = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
            if len(starts):
                joined, places = _places(words)
                low, high, ranks, chosen = stretches(starts, windows(hashes, ANCHOR))
                made.append((ids[k], cids[k], ranks, [joined[places[i] : places[j + WINDOW] - 1] for i, j in zip(low.tolist(), high.tolist(), strict=True)], low, high, chosen))
        yield context_batch(made)


_STRINGS = Strings(WINDOW, (8, 1), bytes.split, b" ".join)


_KEPT = pa.schema([("doc_id", pa.int64()), ("seq", pa.binary()), ("removed", pa.int64()), ("kept_text", pa.binary()), ("digest", pa.string())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words outside the windows that go."""

    def rows(batch: pa.RecordBatch):
        ids, seqs, gone = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
        for k, text in enumerate(binaries(batch.column(2))):
            words = text.split()
            edges = np.zeros(len(words) + 1, dtype=np.int64)
            low, high = (gone[k].values.field(i).to_numpy() for i in (0, 1))
            np.add.at(edges, low, 1)
            np.add.at(edges, high + WINDOW, -1)
            keep = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
            kept = b" ".join([words[i] for i in keep])
            yield ids[k], seqs[k], len(words) - len(keep), kept, hashlib.sha256(kept).hexdigest()

    for batch in batches:
        yield from chunked(rows(batch), _KEPT, 256)


def _right_text(seq: str, text: str) -> str:
    """Spark SQL: the words of a text, joined by spaces, hash to the sequence (ids may repeat)."""
    return f"unhex(sha2(cast(trim(regexp_replace({text}, '[\\\\x20\\\\x09-\\\\x0D]+', ' ')) as binary), 256)) = {seq}"


def dedup(documents: DataFrame) -> DataFrame:
    """doc_id, seq (hash of the words), n_words, n_removed, kept_text, which is null where the words are
    kept as they are, and the hash of the kept words; one row a document."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    small_batches(spark)
    sketches = settle(texts.mapInArrow(_sketch, "doc_id long, seq binary, n_words long, anchors array<long>"), "anchors")
    known = settle(sketches.select("doc_id", "seq", "n_words"), "rows")
    seq64 = F.xxhash64("seq")
    spread = sketches.select(F.explode("anchors").alias("anchor"), seq64.alias("seq64")).repartitionByRange("anchor", "seq64").sortWithinPartitions("anchor", "seq64")
    shared = spread.mapInArrow(shared_names, "seq64 long, anchor long").groupBy("seq64").agg(F.collect_set("anchor").alias("shared"))
    long_rows = known.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW))
    first = settle(long_rows.groupBy("seq").agg(F.min("doc_id").alias("doc_id")), "first")
    chosen = first.select("doc_id", "seq", seq64.alias("seq64")).join(shared, "seq64").select("doc_id", "seq", "shared")
    found = texts.where("doc_id is not null and text is not null").join(chosen, "doc_id").where(_right_text("seq", "text")).dropDuplicates(["doc_id", "seq"])
    candidates = settle(found.select("doc_id", F.monotonically_increasing_id().alias("cid"), "seq", "text", "shared"), "candidates", dense=True)
    release(sketches)
    contexts = settle(candidates.select("doc_id", "cid", "text", "shared").mapInArrow(_contexts, CONTEXT_SQL), "contexts")
    gone = earlier(contexts, candidates, _STRINGS).groupBy("cid").agg(F.collect_list(F.struct("low", "high")).alias("gone"))
    cut = candidates.join(gone, "cid").select("doc_id", "seq", "text", "gone").mapInArrow(_cut, "doc_id long, seq binary, removed long, kept_text binary, digest string").withColumn("kept_text", F.col("kept_text").cast("string"))
    rows = known.join(first.select("seq", F.col("doc_id").alias("first_id")), "seq", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)) & (F.col("n_words") >= WINDOW)
    out = rows.join(cut, ["doc_id", "seq"], "left")
    return out.select(
        "doc_id", "seq", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"), F.when(copy, F.lit(_NOTHING)).otherwise(F.coalesce("digest", F.lower(F.hex("seq")))).alias("kept_sha256"),
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
own AS (SELECT h, min(doc_id) AS owner FROM win GROUP BY h),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM win JOIN own USING (h) WHERE doc_id > owner),
per AS (SELECT r, list(p) AS ps FROM gone GROUP BY r),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS s FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) t ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN per USING (r) LEFT JOIN kept USING (r)
"""
