"""Periodic run detection by recursive frequency splitting.

A run is a stretch of at least max(24, 3 * q) words whose smallest period is q, so each of its words
occurs at least three times in it.  An occurrence that lies in no three consecutive occurrences of its
word within one segment can be in no run: it splits the segment, and the parts are judged again until
nothing splits.  Then grams of 16 words, of which every word of a run lies in one that recurs, split
what is left in the same way.  Surviving segments are scanned lag by lag.

The lag scan cuts a segment into blocks of p words for every p up to a third of its length.  A run of
period p holds two whole neighbouring blocks, which are equal; hashes from prefix sums propose such
blocks (n / p comparisons for a p, n log n in all), and the words themselves confirm and extend them.

Each text is one task's work: no shuffle, and memory in proportion to the text.

Defined results: null, empty and wordless texts have no words, no runs and the hash of the empty text; a
null id plants nothing (see ``planted``); repeated rows and ids get a row each; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import CRC_SQL, binaries, chunked, mix, powers, small_batches, table, windows

LEAST, TIMES = 24, 3
#: A run's lag pairs span at least this many words in a row: LEAST - p for p up to LEAST / TIMES, else 2 * p.
GRAM = LEAST - LEAST // TIMES
#: Rounds of whole passes over the segments; what is not stable then is finished split by split.
PASSES = 24


def _triples(codes: np.ndarray) -> np.ndarray:
    """Positions of each three consecutive occurrences of a word, a row each, sorted by the first."""
    order = np.argsort(codes, kind="stable")
    same = codes[order[TIMES - 1 :]] == codes[order[: 1 - TIMES]]
    at = np.flatnonzero(same)
    found = np.stack([order[at + k] for k in range(TIMES)], axis=1) if len(at) else np.empty((0, TIMES), dtype=np.int64)
    return found[np.argsort(found[:, 0], kind="stable")]


def _finish(alive: np.ndarray, triples: np.ndarray) -> np.ndarray:
    """Splits on, one split at a time: a tree over the triples, by first position, finds those that a split cuts."""
    n, leaves = len(alive), 1 << max(1, (len(triples) - 1).bit_length())
    reach = [-1] * (2 * leaves)
    reach[leaves : leaves + len(triples)] = triples[:, -1].tolist()
    for k in range(leaves - 1, 0, -1):
        reach[k] = max(reach[2 * k], reach[2 * k + 1])
    starts, members = triples[:, 0], triples.tolist()
    held = np.bincount(triples.ravel(), minlength=n).tolist()
    todo = [i for i in range(n) if alive[i] and not held[i]]
    alive = alive.copy()
    while todo:
        split = todo.pop()
        alive[split] = False
        before, stack = int(np.searchsorted(starts, split, side="right")), [1]
        while stack:  # triples that start at or before the split and end at or behind it
            node = stack.pop()
            if reach[node] < split:
                continue
            if node < leaves:
                width = leaves >> (node.bit_length() - 1)
                left = (2 * node * width >> 1) - leaves
                if left < before:
                    stack += [2 * node, 2 * node + 1]
            elif node - leaves < before:
                for i in members[node - leaves]:
                    held[i] -= 1
                    if not held[i] and i != split and alive[i]:
                        todo.append(i)
                reach[node], up = -1, node >> 1
                while up:
                    reach[up], up = max(reach[2 * up], reach[2 * up + 1]), up >> 1
    return alive


def split_rare(codes: np.ndarray, passes: int = PASSES) -> np.ndarray:
    """True for the words that frequency splitting leaves in segments."""
    n = len(codes)
    alive, triples = np.ones(n, dtype=bool), _triples(codes)
    for _ in range(passes):
        now = np.zeros(n, dtype=bool)
        now[triples.ravel()] = True
        if not (alive & ~now).any():
            return alive
        alive = now
        dead = np.concatenate([[0], np.cumsum(~alive)])
        triples = triples[dead[triples[:, -1]] == dead[triples[:, 0]]]
        if not len(triples):
            return np.zeros(n, dtype=bool)
    return _finish(alive, triples)


def segments(alive: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of at least LEAST words that are left."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], alive, [False]]).astype(np.int8)))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= LEAST]


def split_grams(codes: np.ndarray, hashes: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Of the words left, those in a gram of GRAM words that occurs twice in one segment."""
    left = np.zeros(len(codes), dtype=bool)
    for a, b in segments(alive):
        grams = windows(hashes[codes[a:b]], GRAM)
        _, back, count = np.unique(grams, return_inverse=True, return_counts=True)
        at = np.flatnonzero(count[back] > 1)
        edges = np.zeros(b - a + 1, dtype=np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + GRAM, -1)
        left[a:b] = np.cumsum(edges[:-1]) > 0
    return left


def _reach(codes: np.ndarray, i: int, j: int, step: int, low: int, high: int) -> int:
    """How far the words from i and from j on (backwards for step -1) agree within [low, high)."""
    done, size = 0, 32
    while True:
        room = min(high - i, high - j) - done if step > 0 else min(i, j) - low + 1 - done
        take = min(size, room)
        if take <= 0:
            return done
        if step > 0:
            differ = codes[i + done : i + done + take] != codes[j + done : j + done + take]
        else:
            differ = (codes[i - done - take + 1 : i - done + 1] != codes[j - done - take + 1 : j - done + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, size = done + take, 2 * size


def _inside(starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether [low, high) lies in one of the runs of a period; two of these share less than a period."""
    last = np.searchsorted(starts, low, side="right") - 1
    return (last >= 0) & (high <= ends[last])


def lag_scan(codes: np.ndarray, hashes: np.ndarray) -> list[tuple[int, int, int]]:
    """start, length and period of the runs of one segment."""
    m = len(codes)
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # starts and ends by period
    up, _ = powers(m + 1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes[codes] * up[:m])])
    for p in range(1, m // TIMES + 1):
        parts = np.diff(sums[::p])
        hits = np.flatnonzero(parts[1:] == parts[:-1] * up[p]) * p
        if not len(hits):
            continue
        smaller = [found[q] for q in found if p % q == 0]
        for known in smaller:  # all that repeats in there at p repeats at the smaller period
            hits = hits[~_inside(*known, hits, hits + 2 * p)]
        done, fresh = -1, []
        for at in hits.tolist():
            if at + p <= done:
                continue
            right = _reach(codes, at, at + p, 1, 0, m)
            if right < p:  # equal hashes of other words
                continue
            start, done = at - _reach(codes, at - 1, at + p - 1, -1, 0, m), at + p + right
            if done - start >= max(LEAST, TIMES * p) and not any(_inside(*known, np.array([start]), np.array([done]))[0] for known in smaller):
                fresh.append((start, done))
        if fresh:
            found[p] = tuple(np.array(fresh).T)
    return [(s, e - s, p) for p, (starts, ends) in found.items() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """start, length and period of every run, by start, then period."""
    if len(words) < LEAST:
        return []
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    hashes = mix(np.arange(1, len(ids) + 1, dtype=np.uint64))
    alive = split_rare(codes)
    while True:  # grams may split what then holds rare words again
        left = split_grams(codes, hashes, alive)
        if left.sum() == alive.sum():
            break
        alive = left
    return sorted((a + s, n, p) for a, b in segments(alive) for s, n, p in lag_scan(codes[a:b], hashes))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words as the query reads them: a tenth of the ids get a periodic end."""
    n = len(words)
    h = zlib.crc32(b"%d" % doc_id) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * -(-(n - a) // p))[: n - a]


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words, without those that a run holds after its first period."""
    if not found:
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.array(found)
    np.add.at(edges, at[:, 0] + at[:, 2], 1)
    np.add.at(edges, at[:, 0] + at[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.list_(pa.int64()))), ("best", pa.list_(pa.int64())), ("runs_sha256", pa.string()), ("collapsed", pa.binary()),
])
_COLUMNS = "doc_id long, n_words long, runs array<array<long>>, best array<long>, runs_sha256 string, collapsed binary"


def find_runs(documents: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, n_words, runs (start, length, period each), best (the run of the greatest exponent, or null),
    runs_sha256 and the collapsed text as bytes, of every document."""
    small_batches(documents.sparkSession)

    def one(doc_id: int | None, text: bytes | None) -> tuple:
        words = (text or b"").split()
        words = planted(doc_id, words) if plant else words
        found = runs(words)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else None
        digest = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest()
        return doc_id, len(words), found, best, digest, b" ".join(collapse(words, found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from chunked((one(i, t) for i, t in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), strict=True)), _OUT, 256)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _COLUMNS)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = [F.col("best")[k].alias(name) for k, name in enumerate(("start", "length", "period"))]
    rows = find_runs(table(spark, sf_dir, "documents"), plant=True).select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


ORACLE = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
crc_keys AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS k FROM d WHERE doc_id IS NOT NULL),
{CRC_SQL},
g AS (SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g FROM d LEFT JOIN crcs ON k = CAST(doc_id AS VARCHAR)),
a AS (SELECT *, CASE WHEN planted THEN g % n ELSE n END AS a FROM g),
p AS (SELECT *, CASE WHEN planted THEN 1 + (n - a) // (3 + g % 8) ELSE 1 END AS p FROM a),
words AS (SELECT r, i, w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] AS x FROM (SELECT *, unnest(range(n)) AS i FROM p)),
coded AS (SELECT r, i, count(*) OVER (PARTITION BY r) AS n, dense_rank() OVER (ORDER BY x) AS x FROM words),
same AS (SELECT s.r, s.i, t.i - s.i AS p FROM coded s JOIN coded t ON s.r = t.r AND s.x = t.x AND t.i > s.i AND 3 * (t.i - s.i) <= s.n),
part AS (SELECT r, p, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island, i FROM same),
stretch AS (SELECT r, p, min(i) AS s, max(i) + 1 + p AS e FROM part GROUP BY r, p, island HAVING count(*) + p >= greatest(24, 3 * p)),
run AS (SELECT * FROM stretch x WHERE NOT EXISTS (SELECT 1 FROM stretch y WHERE y.r = x.r AND y.p < x.p AND y.s <= x.s AND y.e >= x.e)),
per AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || p || chr(10), '' ORDER BY s, p) AS listed FROM run GROUP BY r),
best AS (SELECT r, s, e - s AS length, p FROM run QUALIFY row_number() OVER (PARTITION BY r ORDER BY CAST(e - s AS DECIMAL(18, 0)) * 1000000000000 // p DESC, s, p) = 1),
gone AS (SELECT DISTINCT r, unnest(range(s + p, e)) AS i FROM run),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(s AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(best.p AS BIGINT) AS period,
CAST(1000 * length // best.p AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN per USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""
