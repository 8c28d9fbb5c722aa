"""Quality classifier: hashed word n-gram logistic regression with follow-the-regularised-leader.

A text's features are n-grams of its lower-cased words (1 and 2) and of its words' shapes (1 to 3;
a shape keeps punctuation and the kinds of characters, so shouting, tables and symbol noise show),
hashed into 2 ** BITS places with values sqrt(share of the group).  Training reads at most
``MAX_ROWS`` labelled rows (those with the smallest id hashes; the documented bound), splits those that
have a document into shards of about ``SHARD_ROWS`` rows and at most about ``SHARD_FEATURES`` features that
learn on their own, and averages their weights.  The model is one array of
2 ** BITS floats, so what is broadcast has a fixed size.  A score is the logistic function of a
sparse dot product.

Defined results: null and empty texts are scored by the bias and the empty-text feature; without
a usable label all weights are 0 and every score is 0.5; repeated rows get a row each; a document
labelled more than once counts once per label; null ids and null labels are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import binaries, cheap_hashes, chunked, held_out, mix, small_batches, table, windows
from tidewell.sources.settled import settle

BITS = 18
MAX_ROWS, SHARD_ROWS, SHARD_FEATURES, EPOCHS = 12_000, 1_500, 4_000_000, 4
#: Step size, its offset, and the weights of the absolute and squared penalties.
ALPHA, BETA, L1, L2 = 0.6, 1.0, 0.02, 0.01
THRESHOLD = 0.7
_BIAS, _EMPTY, _SAME, _SEEN = range(4)
_RESERVED = 8
#: Letters of either case, digits and other bytes become a, A, 9; spaces and punctuation stay (fixed values).
_SHAPE = bytes(0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x41 if 0x41 <= c <= 0x5A else 0x39 if 0x30 <= c <= 0x39 else c for c in range(256))


def shape(text: bytes) -> bytes:
    """The text's kinds of characters, each run of one kind as one character."""
    kinds = np.frombuffer(text.translate(_SHAPE), dtype=np.uint8)
    keep = np.ones(len(kinds), dtype=bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    return kinds[keep].tobytes()


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending within each group) and values of a text's features."""
    text = text or b""
    words = text.lower().split()
    if not words:
        return np.array([_BIAS, _EMPTY]), np.array([1.0, 1.0], dtype=np.float32)
    hashes = cheap_hashes(words)
    shapes = cheap_hashes(shape(text).split())
    pairs = windows(hashes, 2)
    place, value = [np.array([_BIAS])], [np.ones(1)]
    for salt, group in enumerate((mix(hashes), pairs, mix(shapes), windows(shapes, 2), windows(shapes, 3))):
        if len(group):
            at = (mix(group + np.uint64(salt)) >> np.uint64(64 - BITS)).astype(np.uint32)  # short numbers sort faster
            found, times = np.unique(at, return_counts=True)
            place.append(np.maximum(found.astype(np.int64), _RESERVED))
            value.append(np.sqrt(times / len(group)))
    if len(pairs):
        same, seen = np.mean(hashes[1:] == hashes[:-1]), 1 - len(np.unique(pairs)) / len(pairs)
        place.append(np.array([_SAME, _SEEN]))
        value.append(np.sqrt([same, seen]))
    return np.concatenate(place), np.concatenate(value).astype(np.float32)


_FEATURES = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("place", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        yield from chunked(((i, y, *features(t)) for i, y, t in zip(ids, labels, binaries(batch.column(2)), strict=True)), _FEATURES, 512)


def _learn(rows: pd.DataFrame) -> pd.DataFrame:
    """Follow the regularised leader over one bounded shard, in a fixed order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(at: np.ndarray) -> np.ndarray:
        pull = z[at]
        return np.where(np.abs(pull) <= L1, 0.0, -(pull - np.sign(pull) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    rows = rows.sort_values(["turn", "doc_id", "quality"])
    examples = [(np.asarray(p, dtype=np.int64), np.asarray(v, dtype=np.float64), y) for p, v, y in zip(rows["place"], rows["value"], rows["quality"], strict=True)]
    for _ in range(EPOCHS):
        for at, value, y in examples:
            w = weights(at)
            slope = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - y) * value
            square = slope * slope
            np.add.at(z, at, slope - (np.sqrt(n[at] + square) - np.sqrt(n[at])) / ALPHA * w)
            np.add.at(n, at, square)
    at = np.flatnonzero(np.abs(z) > L1)
    return pd.DataFrame({"place": np.append(at, -1).astype(np.int32), "weight": np.append(weights(at), 1.0)})  # place -1 counts the shards


def train(documents: DataFrame, labels: DataFrame, most: int = MAX_ROWS) -> np.ndarray:
    """Weights learned from at most ``most`` labelled rows that are not held out."""
    spark = documents.sparkSession
    small_batches(spark)
    chosen = (
        labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .select("doc_id", F.col("quality").cast("int"), F.xxhash64(F.col("doc_id").cast("long")).alias("turn"))
        .orderBy("turn", "doc_id", "quality").limit(most)
    )
    rows = documents.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen.select("doc_id", "quality")), "doc_id")
    rows = settle(rows.select(F.col("doc_id").cast("long"), "quality", "text").mapInArrow(_featurise, "doc_id long, quality int, place array<int>, value array<float>"), "features")
    size = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("place")), F.lit(0)).alias("features")).first()
    shards = max(1, -(-size["rows"] // SHARD_ROWS), -(-size["features"] // SHARD_FEATURES))
    rows = rows.withColumn("turn", F.xxhash64("doc_id")).withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(shards)))
    learned = rows.groupBy("shard").applyInPandas(_learn, "place int, weight double")
    total = learned.groupBy("place").agg(F.sum("weight").alias("weight")).toPandas()  # at most 2 ** BITS rows
    n_learned, mean = total.loc[total["place"] < 0, "weight"].sum(), total[total["place"] >= 0]
    out = np.zeros(1 << BITS, dtype=np.float32)
    out[mean["place"].to_numpy(dtype=np.int64)] = mean["weight"].to_numpy() / max(1, n_learned)
    return out


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every whole text."""
    spark = documents.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(weights)

    def one(text: bytes | None) -> float:
        at, value = features(text)
        return float(1 / (1 + np.exp(-np.clip(shared.value[at] @ value, -35, 35))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from chunked(((i, one(t)) for i, t in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), strict=True)), _SCORES)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score(documents, train(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
