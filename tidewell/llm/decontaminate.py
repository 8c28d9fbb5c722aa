"""Benchmark decontamination: a broadcast hash set of the benchmark's windows.

The benchmark is cut into windows of 13 normalised words (an item of fewer words is one window).
Spark cuts them, drops repeats and writes them to the shared folder.  Up to ``MAX_WINDOWS`` of them and
``MAX_BYTES`` of their words are read back and broadcast as one hash set, and the tasks that scan the
texts verify each hit on the words.  A larger benchmark is never held by the driver or a task: what is
broadcast is a Bloom filter of at most ``MOST_BITS`` over the windows' hashes; one scan finds the places that
pass, and these are joined with the windows, by hash and then by the words themselves.  Both ways give the
same results.

Defined results: a null or wordless text has no words and no hits; an item with a null or wordless
text is no window; an item with a null id is one, and all such items are one null owner, the last in
the list of items; repeated items and ids count once; repeated documents each get a row; empty tables give
empty results or no hits; extra columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import binaries, cheap_hashes, chunked, numbered_rows, small_batches, table, windows
from tidewell.sources.settled import settle

N_WORDS = 13
#: Windows in a broadcast hash set: about 400 bytes each with their words, so 40 MB in a worker.
MAX_WINDOWS = 100_000
#: Bytes of words in a broadcast hash set.
MAX_BYTES = 32 << 20
#: The Bloom filter of a larger benchmark: bits a window, as a power of two, up to 16 MB in all, and probes.
WINDOW_BITS, MOST_BITS, PROBES = 32, 1 << 27, 3
#: Share of a document's words that must be hit: one in this many.
CONTAMINATED_ONE_IN = 20
#: A-Z become a-z; ASCII characters other than letters and digits separate words (fixed values).
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def item_windows(words: list[bytes], n: int) -> list[list[bytes]]:
    return [words[i : i + n] for i in range(max(1, len(words) - n + 1))] if words else []


class WindowSet:
    """The windows of some items by length: a bitmap over hash bits, then sorted hashes, then the words."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], n: int):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.items: dict[tuple[bytes, ...], dict[str | None, None]] = {}
        hashes: dict[int, set[int]] = {}
        for item, words in items:
            for window in item_windows(words, n):
                self.items.setdefault(tuple(window), {})[item] = None
                hashes.setdefault(len(window), set()).add(int(windows(cheap_hashes(window), len(window))[0]))
        for length, found in hashes.items():
            known = np.array(sorted(found), dtype=np.uint64)
            bitmap = np.zeros(1 << 22, dtype=bool)
            bitmap[known & np.uint64(len(bitmap) - 1)] = True
            self.by_length[length] = np.packbits(bitmap), known

    def unpacked(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        return {k: (np.unpackbits(bits).view(bool), known) for k, (bits, known) in self.by_length.items()}


def _hits(words: list[bytes], filters: dict, items: dict) -> tuple[list[tuple[int, int]], set[str | None]]:
    """Ranges [start, end) of the document's words inside windows that occur, and the items that own them."""
    ranges: list[tuple[int, int]] = []
    owners: set[str | None] = set()
    hashes = cheap_hashes(words)
    for length, (bitmap, known) in filters.items():
        at = windows(hashes, length)
        maybe = np.flatnonzero(bitmap[at & np.uint64(len(bitmap) - 1)])
        if len(maybe):
            place = np.minimum(np.searchsorted(known, at[maybe]), len(known) - 1)
            for i in maybe[known[place] == at[maybe]].tolist():
                if found := items.get(tuple(words[i : i + length])):
                    owners.update(found)
                    if ranges and ranges[-1][0] <= i <= ranges[-1][1]:
                        ranges[-1] = ranges[-1][0], max(ranges[-1][1], i + length)
                    else:
                        ranges.append((i, i + length))
    return ranges, owners


_SCHEMA = "doc_id long, n_words long, starts array<int>, ends array<int>, items array<string>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])


def scan(documents: DataFrame, shared: Broadcast) -> DataFrame:
    """The hits of a hash set of windows in every document."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, owned = shared.value.unpacked(), shared.value.items

        def rows(batch: pa.RecordBatch):
            for doc_id, text in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), strict=True):
                words = words_of(text)
                ranges, owners = _hits(words, filters, owned)
                yield doc_id, len(words), [a for a, _ in ranges], [b for _, b in ranges], sorted(owners, key=lambda x: (x is None, x or ""))

        for batch in batches:
            yield from chunked(rows(batch), _ARROW)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA)


_CUT = pa.schema([("item", pa.string()), ("words", pa.binary()), ("length", pa.int32()), ("hash", pa.int64())])


def cut_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """The distinct windows of a benchmark: item, words (joined by a space), their number and hash."""
    small_batches(benchmark.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch):
            for item, text in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), strict=True):
                words = words_of(text)
                length = min(n, len(words))
                hashes = windows(cheap_hashes(words), length).view(np.int64).tolist() if words else []
                for i, h in enumerate(hashes):
                    yield item, b" ".join(words[i : i + length]), length, h

        for batch in batches:
            yield from chunked(rows(batch), _CUT)

    texts = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return settle(texts.mapInArrow(cut, "item string, words binary, length int, hash long").distinct(), "windows")


def _in_one_set(found: DataFrame, n: int, most: int) -> Broadcast | None:
    """The windows as a broadcast hash set, if they are few and small enough."""
    size = found.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("words")), F.lit(0)).alias("bytes")).first()
    if size["n"] > most or size["bytes"] > MAX_BYTES:
        return None
    rows = found.select("item", "words").collect()
    return found.sparkSession.sparkContext.broadcast(WindowSet([(r["item"], bytes(r["words"]).split(b" ")) for r in rows], n))


def window_filter(found: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A Bloom filter of the windows' hashes, in words of 64 bits (a power of two), and the windows' lengths."""
    lengths = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bits = min(MOST_BITS, max(1 << 10, 1 << (WINDOW_BITS * sum(lengths.values()) - 1).bit_length()))
    step = f"((shiftrightunsigned(hash, 32) | 1) & {bits - 1})"
    slots = found.select(F.explode(F.array(*[F.expr(f"((hash & {bits - 1}) + {k} * {step}) & {bits - 1}") for k in range(PROBES)])).alias("slot"))
    words = slots.groupBy(F.expr("slot div 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits")).toArrow()  # at most MOST_BITS / 64 rows
    out = np.zeros(bits // 64, dtype=np.int64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64), sorted(lengths)


def passes(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    last = np.uint64(64 * len(bloom) - 1)
    step = ((hashes >> np.uint64(32)) | np.uint64(1)) & last
    out = np.ones(len(hashes), dtype=bool)
    for k in range(PROBES):
        slot = ((hashes & last) + np.uint64(k) * step) & last
        out &= (bloom[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0
    return out


_PLACE = pa.struct([("hash", pa.int64()), ("at", pa.int32()), ("length", pa.int32()), ("words", pa.binary())])
_PROBED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(_PLACE))])


def _joined(numbered: DataFrame, row: str, found: DataFrame) -> DataFrame:
    """The hits of more windows than a hash set holds, as scan() has them: one scan, then a join of the
    places that pass the filter with the windows.  A hot window's places are many rows of one side of a
    join, which Spark splits."""
    spark = numbered.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(window_filter(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, lengths = shared.value

        def places(words: list[bytes]) -> Iterator[dict]:
            hashes = cheap_hashes(words)
            for length in lengths:
                at = windows(hashes, length)
                for i in np.flatnonzero(passes(bloom, at)).tolist():
                    yield {"hash": int(at[i : i + 1].view(np.int64)[0]), "at": i, "length": length, "words": b" ".join(words[i : i + length])}

        def rows(batch: pa.RecordBatch):
            for at, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binaries(batch.column(2)), strict=True):
                words = words_of(text)
                yield at, doc_id, len(words), list(places(words))

        for batch in batches:
            yield from chunked(rows(batch), _PROBED, 256)

    texts = numbered.select(F.col(row).alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    probed = settle(texts.mapInArrow(run, "row long, doc_id long, n_words long, places array<struct<hash:long,at:int,length:int,words:binary>>"), "probed")
    asked = probed.select("row", F.explode("places").alias("p")).select("row", "p.*")
    hits = asked.join(found.select("item", F.col("hash").alias("_hash"), F.col("words").alias("_words")), (F.col("hash") == F.col("_hash")) & (F.col("words") == F.col("_words")))
    ranges = F.collect_set(F.struct("at", (F.col("at") + F.col("length")).alias("end")))
    nameless = F.when(F.bool_or(F.col("item").isNull()), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    per = hits.groupBy("row").agg(ranges.alias("ranges"), F.concat(F.array_sort(F.collect_set("item")), nameless).alias("items"))
    none = F.array().cast("array<int>")
    return probed.select("row", "doc_id", "n_words").join(per, "row", "left").select(
        "row", "doc_id", "n_words", F.coalesce("ranges.at", none).alias("starts"), F.coalesce("ranges.end", none).alias("ends"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def _decided(found: DataFrame) -> DataFrame:
    # words covered by the union of the ranges: sort them, then add what each reaches beyond those before
    ranges = F.array_sort(F.arrays_zip(F.col("starts").alias("a"), F.col("ends").alias("b")))
    covered = F.aggregate(
        ranges,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], acc["to"]))).alias("n"), F.greatest(acc["to"], x["b"]).alias("to")),
    )["n"].cast("long")
    return found.withColumn("n_hit", covered).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * CONTAMINATED_ONE_IN >= F.col("n_words")))


def contamination(documents: DataFrame, benchmark: DataFrame, n: int = N_WORDS, most: int = MAX_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, hit ranges (starts, ends), items, contaminated."""
    found = cut_windows(benchmark, n)
    if shared := _in_one_set(found, n, most):
        hits = scan(documents, shared)
    else:
        numbered, row = numbered_rows(documents.select("doc_id", "text"))
        hits = _joined(numbered, row, found)
    return _decided(hits).select("doc_id", "n_words", "n_hit", "starts", "ends", "items", "contaminated")


def clean_documents(documents: DataFrame, benchmark: DataFrame, n: int = N_WORDS, most: int = MAX_WINDOWS) -> DataFrame:
    """The documents that are not contaminated, with their own columns; each row is judged by itself.
    With one hash set, the tasks that scan the texts also filter the rows, and nothing is shuffled;
    else a row's hits are known only after the join, and the decision is joined back by a row id."""
    found = cut_windows(benchmark, n)
    shared = _in_one_set(found, n, most)
    if shared is None:
        numbered, row = numbered_rows(documents)
        bad = _decided(_joined(numbered, row, found)).where("contaminated").select(F.col("row").alias("_bad"))
        return numbered.join(bad, numbered[row] == bad["_bad"], "left_anti").drop(row)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, owned = shared.value.unpacked(), shared.value.items

        def fine(text: bytes | None) -> bool:
            words = words_of(text)
            covered = np.zeros(len(words), dtype=bool)
            for start, end in _hits(words, filters, owned)[0]:
                covered[start:end] = True
            hit = int(np.count_nonzero(covered))
            return not hit or CONTAMINATED_ONE_IN * hit < len(words)

        for batch in batches:
            yield batch.filter(pa.array([fine(t) for t in binaries(batch.column(at))], type=pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


ORACLE = r"""
WITH fold AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM item WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM fold, ks WHERE len(w) >= k)),
hit AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.k = iw.k),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT fold.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM fold LEFT JOIN cov USING (doc_id) LEFT JOIN own USING (doc_id)
"""
