"""Language ID with language-bitmask n-gram filters.

Training counts character n-grams of lower-cased words per language on a bounded sample.  An
n-gram belongs to a language if it makes up at least ``MIN_SHARE`` of that language's n-grams of
its length (so there are at most 1 / MIN_SHARE of them per language and length) and its share
there is at least ``MIN_RATIO`` of its share in any other language.  The filter is a bit-sliced
Bloom filter: an array of positions, each holding one bit per language, so that one AND over the
probed positions returns all languages that contain an n-gram.  A text's hits are counted per
language, corrected for the filter's false positives, and the language with most of them wins.

Defined results: null texts and texts without a letter are ``und`` with score 0; ties go to the
first language by code point; with no labelled row every text is ``und``; repeated rows get a row
each; texts of any length are read whole, in pieces, and each n-gram once; lang, source and doc_id are never inputs.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import chunked, held_out, mix, small_batches, table
from tidewell.sources.settled import settle

LENGTHS = (1, 2, 3, 4)  # from 1 on, without gaps
#: Expected labelled rows that training reads per language (chosen by hash of the text).
SAMPLE_PER_LANGUAGE = 2_000
MIN_SHARE, MIN_RATIO = 1e-4, 0.3
PROBES, SLOTS = 2, 1 << 20
#: Characters worked on at once, and counts that a training task holds, about.
PIECE, HELD = 1 << 19, 200_000
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter, built from the character database once a worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def pieces(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Code points of the lower-cased text in pieces, each with how many of its first ones the piece
    before it has had: the overlap that the longest n-gram needs."""
    reach = max(LENGTHS) - 1
    table_ = letters()
    for start in range(0, max(1, len(text)), PIECE):
        again, fresh = text[max(0, start - reach) : start].lower(), text[start : start + PIECE].lower()
        # the text stands between two boundaries
        again, fresh = (" " if 0 < start < reach else "") + again, (" " if start == 0 else "") + fresh + (" " if start + PIECE >= len(text) else "")
        points = np.frombuffer((again + fresh).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        points = np.where(table_[points], points, 0x20)
        keep = np.ones(len(points), dtype=bool)
        keep[1:] = (points[1:] != 0x20) | (points[:-1] != 0x20)  # runs of other characters are one boundary
        yield points[keep].astype(np.uint64), int(np.count_nonzero(keep[: len(again)]))


def every_gram(points: np.ndarray, had: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """Each length with its packed n-grams of 16 bits a character (larger code points fold), but for those
    inside the first ``had`` points; boundaries only at the ends.  Each length is built on the one before."""
    folded = (points ^ (points >> np.uint64(16))) & np.uint64(0xFFFF)
    letter = points != 0x20
    out, fine = folded, letter
    for n in LENGTHS:
        if n > 1:
            out = (out[:-1] << np.uint64(16)) | folded[n - 1 :]
            fine = np.ones(len(out), dtype=bool) if n == 2 else fine[:-1] & letter[n - 2 : -1]
        first = max(0, had - n + 1)
        yield n, out[first:][fine[first:]]


def grams(points: np.ndarray, n: int, had: int = 0) -> np.ndarray:
    """The n-grams of one length."""
    return dict(every_gram(points, had))[n]


_COUNTS = pa.schema([("lang", pa.string()), ("length", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language, length and n-gram, added up before the shuffle, up to HELD of them at once."""
    counts: Counter = Counter()
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for points, had in pieces(text):
                for n, several in every_gram(points, had):
                    found, times = np.unique(several, return_counts=True)
                    for g, k in zip(found.view(np.int64).tolist(), times.tolist(), strict=True):
                        counts[lang, n, g] += k
                if len(counts) > HELD:
                    yield from chunked(((lang, n, g, k) for (lang, n, g), k in counts.items()), _COUNTS, 65_536)
                    counts = Counter()
    yield from chunked(((lang, n, g, k) for (lang, n, g), k in counts.items()), _COUNTS, 65_536)


@dataclass(frozen=True)
class Filter:
    """languages in code point order; planes[p][slot]: bits of languages 64 p and up (in words of fewer
    bits where one plane's suffice); share of slots set per language."""

    languages: tuple[str, ...]
    planes: np.ndarray
    false_positive: np.ndarray

    def probe(self, gram: np.ndarray) -> np.ndarray:
        """Per plane, the bits of all languages that hold each n-gram."""
        a = mix(gram + np.uint64(1))
        step = (a >> np.uint64(32)) | np.uint64(1)
        out = self.planes[:, a & np.uint64(SLOTS - 1)]
        for k in range(1, PROBES):
            out = out & self.planes[:, (a + np.uint64(k) * step) & np.uint64(SLOTS - 1)]
        return out


def train(documents: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Filter:
    """Learns from text and non-null lang of the rows that are not held out."""
    spark = documents.sparkSession
    small_batches(spark)
    labelled = documents.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("text").cast("string"), F.col("lang").cast("string"))
    # a hash of the text draws about per_language rows of every language, however large it is, and its first text
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    sizes = {r["lang"]: (r["n"], r["first"]) for r in labelled.groupBy("lang").agg(F.count("*").alias("n"), F.min(draw).alias("first")).collect()}
    if not sizes:
        return Filter((), np.zeros((1, SLOTS), dtype=np.uint64), np.zeros(0))
    rates = F.create_map(*[F.lit(x) for lang, (n, first) in sorted(sizes.items()) for x in (lang, max(first, min(1.0, per_language / n)))])
    sample = labelled.where(draw <= rates[F.col("lang")])
    counts = sample.mapInArrow(_count, "lang string, length int, gram long, n long").groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))
    counts = settle(counts, "grams")
    totals = counts.groupBy("lang", "length").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), ["lang", "length"]).select("lang", "length", "gram", (F.col("n") / F.col("total")).alias("share")).where(F.col("share") >= MIN_SHARE)
    best = shares.groupBy("length", "gram").agg(F.max("share").alias("best"))
    kept = shares.join(best, ["length", "gram"]).where(F.col("share") >= MIN_RATIO * F.col("best"))
    languages = tuple(sorted(sizes))
    planes = np.zeros(((len(languages) + 63) // 64, SLOTS), dtype=np.uint64)
    rows = kept.select("lang", "gram").toPandas()  # at most languages * lengths / MIN_SHARE rows
    for i, lang in enumerate(languages):
        a = mix(rows.loc[rows["lang"] == lang, "gram"].to_numpy(dtype=np.int64).view(np.uint64) + np.uint64(1))
        step = (a >> np.uint64(32)) | np.uint64(1)
        for k in range(PROBES):
            planes[i // 64, (a + np.uint64(k) * step) & np.uint64(SLOTS - 1)] |= np.uint64(1 << (i % 64))
    # one plane in the narrowest words that hold a bit per language, so that the probes stay in the cache
    narrow = next((k for k in (8, 16, 32) if len(languages) <= k), 64)
    filled = np.array([np.count_nonzero(planes[i // 64] & np.uint64(1 << (i % 64))) / SLOTS for i in range(len(languages))])
    return Filter(languages, planes.astype(f"uint{narrow}"), filled**PROBES)


@cache
def _patterns(n: int) -> np.ndarray:
    """Which languages each pattern of n bits has."""
    return (np.arange(1 << n)[:, None] >> np.arange(n)) & 1


def decide(text: str | None, model: Filter) -> tuple[str, float, list[float]]:
    """The language, its score and the corrected share of n-grams of every language."""
    n_languages = len(model.languages)
    hits, total = np.zeros(n_languages), 0
    for points, had in pieces(text or "") if n_languages else ():
        found = np.concatenate([g for _, g in every_gram(points, had)])
        total += len(found)
        bits = model.probe(found)
        if n_languages <= 12:  # popcounts per language from a histogram of the bit patterns
            hits += np.bincount(bits[0].astype(np.int64), minlength=1 << n_languages) @ _patterns(n_languages)
        else:
            hits += [np.count_nonzero(bits[i // 64] & np.uint64(1 << (i % 64))) for i in range(n_languages)]
    if not total:
        return "und", 0.0, [0.0] * n_languages
    shares = np.clip((hits / total - model.false_positive) / np.maximum(1e-9, 1 - model.false_positive), 0, 1)
    best = int(np.argmax(shares))
    odds = np.exp(20 * (shares - shares[best]))
    return model.languages[best], float(1 / odds.sum()), shares.tolist()


_ARROW = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("shares", pa.list_(pa.float64()))])


def predict(documents: DataFrame, model: Filter, key: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score and shares (in model.languages' order) of every document."""
    spark = documents.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from chunked(((i, *decide(t, shared.value)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)), _ARROW)

    return documents.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double, shares array<double>")


def keep_decided(documents: DataFrame, model: Filter, least: float) -> DataFrame:
    """The documents, columns as they are, whose language is decided with a score of ``least`` or
    more; the texts pass through the same tasks that score them, so nothing is shuffled."""
    spark = documents.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = [(d := decide(t, shared.value))[0] != "und" and d[1] >= least for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(fine, type=pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return predict(documents, train(documents)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
