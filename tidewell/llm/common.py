"""What the corpus operators share: words, hashes and batches.

A word is a run of bytes other than ``\\x20 \\x09-\\x0D``; ``bytes.split()`` cuts UTF-8 text
exactly so.  Word hashes have 64 bits.
"""

from __future__ import annotations

import atexit
import io
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tidewell
from tidewell.sources.settled import discard, settle, shared_folder

#: Odd multipliers of the 64-bit mixers (fixed values).
MIX_A, MIX_B, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: The held-out remainder of crc32(doc_id as text) mod 4.
HELD_OUT = 2


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows that no model may learn from; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once an application: an archive in the shared folder,
    so that workers need neither this machine's folders nor its PYTHONPATH."""
    context, root = spark.sparkContext, Path(tidewell.__file__).parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.writestr(str(path.relative_to(root.parent)), path.read_bytes())
    at = f"{shared_folder(spark)}/tidewell-code-{uuid.uuid4().hex}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(at)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(held.getvalue()))
    finally:
        out.close()
    context.addPyFile(at)
    atexit.register(discard, spark, at)
    _shipped.add(context.applicationId)


_RECORDS, _BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Gets Python workers ready: sends the code, and bounds what one Arrow batch of whole texts holds.
    All operators want the same bounds and plans run later, so they stay in the session."""
    ship_code(spark)
    spark.conf.set(_RECORDS, "256")
    spark.conf.set(_BYTES, str(8 << 20))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Larger batches, for steps over short rows that run inside."""
    before = spark.conf.get(_RECORDS)
    spark.conf.set(_RECORDS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_RECORDS, before)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalises 64-bit hashes so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_A
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_B
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def cheap_hashes(words: list[bytes]) -> np.ndarray:
    """32-bit hashes, for filters and features only."""
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP ** i and STEP ** -i modulo 2 ** 64 for i below n, kept between calls."""
    if not _powers or len(_powers[0]) < n:
        size = max(1024, 1 << n.bit_length())
        bases = STEP, np.uint64(pow(int(STEP), -1, 1 << 64))
        _powers[:] = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, x)])) for x in bases]
    return _powers[0][:n], _powers[1][:n]


def windows(hashes: np.ndarray, n: int, starts: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of the n consecutive words at each start (all starts by default), from prefix sums."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, dtype=np.uint64)
    up, down = powers(len(hashes))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * up)])
    if starts is None:
        return mix((sums[n:] - sums[:size]) * down[:size] + np.uint64(n))
    return mix((sums[starts + n] - sums[starts]) * down[starts] + np.uint64(n))


def binaries(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def rows_to_batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def chunked(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield rows_to_batch(held, schema)
            held = []
    if held:
        yield rows_to_batch(held, schema)


_SHARED = pa.schema([("seq64", pa.int64()), ("name", pa.int64())])


def shared_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (name, seq64), sorted, those whose name another sequence has too.  The first and
    the last row of a partition may have theirs in the next one, so they always count."""
    held, held_left = None, True
    for batch in batches:
        name, seq = (batch.column(k).to_numpy() for k in range(2))
        if not len(name):
            continue
        if held is not None:
            name, seq = np.concatenate([held[0], name]), np.concatenate([held[1], seq])
        fresh = np.ones(len(name), dtype=bool)
        fresh[1:] = (name[1:] != name[:-1]) | (seq[1:] != seq[:-1])
        name, seq = name[fresh], seq[fresh]
        left = np.empty(len(name), dtype=bool)
        left[0], left[1:] = held_left, name[1:] == name[:-1]
        out = left[:-1] | left[1:]
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(seq[:-1][out]), pa.array(name[:-1][out])], schema=_SHARED)
        held, held_left = (name[-1:], seq[-1:]), bool(left[-1])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(held[1]), pa.array(held[0])], schema=_SHARED)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered_rows(documents: DataFrame) -> tuple[DataFrame, str]:
    """The rows with an id of their own, written once so that every read agrees on it, and its column's name."""
    name, taken = "_row", {c.lower() for c in documents.columns}
    while name in taken:
        name += "_"
    return settle(documents.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


#: DuckDB: h, the crc32 of the text k, for every row of ``crc_keys`` (part of a WITH RECURSIVE list).
CRC_SQL = r"""
crc_table AS (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)),
crc_steps AS (SELECT k, hex(encode(k)) AS x, 0 AS j, CAST(4294967295 AS BIGINT) AS c FROM crc_keys
  UNION ALL SELECT k, x, j + 1, xor(c >> 8, v) FROM crc_steps JOIN crc_table ON i = xor(c & 255, 16 * (strpos('0123456789ABCDEF', x[2 * j + 1]) - 1) + strpos('0123456789ABCDEF', x[2 * j + 2]) - 1) WHERE 2 * j < length(x)),
crcs AS (SELECT k, xor(c, 4294967295) AS h FROM crc_steps WHERE 2 * j = length(x))"""
