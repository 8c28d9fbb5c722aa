"""Strings of a fixed width that also start in a document with a smaller id: what both passage dedups share.

A context is a stretch of strings side by side that chose the same sample, so one row stands for all of
them.  If a context stands in an earlier document, all its strings do.  Where samples of equal rank have
different contexts, at the ends of repeated passages, contexts are cut into parts at fixed distances from
the sample.  The rank of a part is what all its strings share, and parts are judged like contexts; where
parts of equal rank differ they are cut again, at last into single strings.

Contexts and parts are compared by 128-bit hashes; both are aggregated before they are shuffled, and the
joins back are joins of two plain exchanges, whose hot keys Spark can split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import binaries, chunked
from tidewell.sources.settled import release, scratch, settle

#: low, high and at: the first and the last start of a context's strings, and its sample's; a and b: its name.
CONTEXT = pa.schema([("doc_id", pa.int64()), ("cid", pa.int64()), ("rank", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("at", pa.int64())])
CONTEXT_SQL = "doc_id long, cid long, rank long, a long, b long, low long, high long, at long"
_SPAN = pa.schema([("doc_id", pa.int64()), ("cid", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("at", pa.int64()), ("content", pa.binary())])
_PART = pa.schema([("doc_id", pa.int64()), ("cid", pa.int64()), ("span", pa.int64()), ("rank", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])


def names_of(strings: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes as two signed numbers each."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, strings)), dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def context_batch(found: list[tuple[int, int, np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One batch of the contexts of several texts: doc_id, cid, ranks, contents, lows, highs and places of each."""
    sizes = [len(x[2]) for x in found]
    whole = lambda k: np.concatenate([np.empty(0, dtype=np.int64), *(x[k] for x in found)])
    each = lambda k: np.repeat(np.array([x[k] for x in found], dtype=np.int64), sizes)
    columns = [each(0), each(1), whole(2), *names_of(s for x in found for s in x[3]), whole(4), whole(5), whole(6)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=CONTEXT)


@dataclass(frozen=True)
class Strings:
    """What strings are made of: units of a text, how many make a string, and the starts in a part, of each round."""

    width: int
    steps: tuple[int, ...]
    units: Callable[[bytes], Sequence]
    join: Callable[[Sequence], bytes]


def _sql(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'long'}" for f in schema)


def _judge(contexts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contexts that an earlier document has, and those at the ends: the first documents' contexts whose rank has others in other documents."""
    with scratch() as kept:
        owners = settle(contexts.groupBy("a", "b").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.min("rank").alias("rank")), "owners")
        ends = owners.groupBy("rank").agg(F.count("*").alias("n"), F.min("owner").alias("low"), F.max("last").alias("high")).where("n > 1 and low < high")
        ends = settle(ends.select("rank", F.lit(True).alias("ends")), "ends")
        named = owners.join(ends, "rank", "left").where("owner < last or ends").select("a", "b", "owner", F.coalesce("ends", F.lit(False)).alias("ends"))
        met = contexts.drop("rank").join(settle(named, "named"), ["a", "b"]).where("doc_id > owner or ends")
        judged = settle(met.withColumn("gone", F.col("doc_id") > F.col("owner")).drop("a", "b", "owner", "ends"), "judged")
        kept.append(judged)
    return judged.where("gone").select("cid", "low", "high"), judged.where("not gone").drop("gone")


def earlier(contexts: DataFrame, candidates: DataFrame, of: Strings) -> DataFrame:
    """cid, low and high: first and last starts of strings that also start in a document with a smaller id.
    contexts: a settled table, which goes; candidates: doc_id, cid, text."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch):
            ids, cids, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for k, text in enumerate(binaries(batch.column(2))):
                units = of.units(text)
                for low, high, at in (x.values() for x in found[k].as_py()):
                    yield ids[k], cids[k], low, high, at, of.join(units[low : high + of.width])

        for batch in batches:
            yield from chunked(rows(batch), _SPAN, 1024)

    def parts(step: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def made(batch: pa.RecordBatch) -> pa.RecordBatch:
            owner, ranks, contents, lows, highs = [], [], [], [], []
            spans, places, found = batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(5)
            for i, content in enumerate(batch.column(4).to_pylist()):
                units, span, at = of.units(content), spans[i], places[i]
                low, high = (found[i].values.field(k).to_pylist() for k in (0, 1))
                for low_, high_ in zip(low, high, strict=True):
                    for k in range((at - high_) // step, (at - low_) // step + 1):
                        first, last = max(low_, at - (k + 1) * step + 1), min(high_, at - k * step)
                        # what all strings at this distance from the sample share, wherever their part ends
                        shared = of.join(units[at - k * step - span : at - (k + 1) * step + 1 - span + of.width])
                        owner.append(i)
                        ranks.append(xxhash.xxh3_64_intdigest(shared, k))
                        contents.append(of.join(units[first - span : last - span + of.width]))
                        lows.append(first)
                        highs.append(last)
            ids = [batch.column(k).to_numpy()[owner] if owner else np.empty(0, dtype=np.int64) for k in range(3)]
            columns = [*ids, np.array(ranks, dtype=np.uint64).view(np.int64), *names_of(contents), np.array(lows, dtype=np.int64), np.array(highs, dtype=np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_PART)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from map(made, batches)

        return run

    whole, ends = _judge(contexts)
    release(contexts)
    found = candidates.select("doc_id", "cid", "text").join(ends.groupBy("cid").agg(F.collect_list(F.struct("low", "high", "at")).alias("found")), "cid")
    contents = settle(found.select("doc_id", "cid", "text", "found").mapInArrow(spans, _sql(_SPAN)), "spans", dense=True).withColumnRenamed("low", "span")
    left = contents.withColumn("found", F.array(F.struct(F.col("span").alias("low"), "high")))
    for step in of.steps:
        made = settle(left.select("doc_id", "cid", "span", "at", "content", "found").mapInArrow(parts(step), _sql(_PART)), "parts")
        cut, ends = _judge(made)
        release(made)
        whole = whole.unionByName(cut)
        left = contents.join(ends.groupBy("cid", "span").agg(F.collect_list(F.struct("low", "high")).alias("found")), ["cid", "span"])
    return whole
