"""MinHash near-dedup with SetSketch registers.

A document is the set of its 5-word shingles; documents are linked if their sets' Jaccard
similarity is 0.75 or more, and every component keeps its smallest id.

1. Registers: a text's set is sketched by 160 truncated minima on an exponential scale.  They merge
   by maximum and agree with a probability close to the similarity.  Equal sets become one node.
2. Candidates: the values of four registers side by side are a band's key.  Rows sorted by range of
   (key, node) show the keys that several nodes have, without a task that holds all rows of a key.
   A pair at 0.75 shares none of the 40 bands with probability 3e-7.
3. Shared counts: a shingle that only one of these nodes has can't be in any intersection.  What is
   left bounds every intersection exactly; nodes and pairs that can't reach 0.75 go.
4. Stars: in each bucket the nodes are compared with its first node only: pairs that are likely by
   their registers are verified on their full sets.  That links a group of near copies without its
   pairs.  Buckets that still hold several components get one more leader each, by hash.
5. The rest, exactly: below first nodes that still lead several components, every node gets an odd
   sketch (the parities of its shingles' counts in m places).  The places in which two odd sketches
   differ never outnumber the elements in which the sets differ, and with m at 32 times the largest
   difference that a link allows they come within a few percent of them.  Blocks of sketches are
   compared in the tasks, and only pairs of different components whose bound allows a link become
   rows; these few are estimated jointly by likelihood from their registers, and verified on their
   full sets unless six standard errors below the threshold.  No bucket, partner or candidate is capped.

Defined results: null and wordless texts have an empty set, are linked with nothing and kept; texts
of fewer than five words have one shingle; a null doc_id is linked with nothing, has no component
and is kept; rows that repeat an id are judged by their own sets; equal rows get equal results;
an empty table gives an empty result; of the input only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import batches_of, binaries, chunked, mix, numbered_rows, small_batches, table, windows, word_hashes
from tidewell.llm.components import components
from tidewell.sources.settled import scratch, settle

SHINGLE, LEAST_PERCENT = 5, 75
#: SetSketch: BANDS * ROWS registers of 16 bits, base and rate of the exponential spacing.
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
_MULTIPLIERS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_OFFSETS = mix(_MULTIPLIERS)
_SALTS = mix(np.arange(101, 101 + BANDS, dtype=np.uint64))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted 64-bit hashes of a text's set of shingles."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(windows(word_hashes(words), min(SHINGLE, len(words))))


def registers(found: np.ndarray) -> np.ndarray:
    """Truncated minima: register i is floor(1 - log_BASE of the least exponential of its hash function)."""
    least = np.full(REGISTERS, np.uint64(2**64 - 1))
    for at in range(0, len(found), 1024):
        np.minimum(least, (found[at : at + 1024, None] * _MULTIPLIERS + _OFFSETS).min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 1.0) / 2.0**64
    exponential = np.maximum(-np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE, 1e-300)
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def bands(regs: np.ndarray) -> np.ndarray:
    """A key for each band: its registers' values side by side, salted by the band's number."""
    packed = np.ascontiguousarray(regs.reshape(BANDS, ROWS)).view(np.uint64).ravel()
    return mix(packed ^ _SALTS)


def fingerprint(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


_SKETCH = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("print", pa.binary()), ("n", pa.int64()), ("registers", pa.binary())])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's set size and fingerprint, and the registers of each set once a task, on a numbered row."""
    seen: set[bytes] = set()

    def rows(batch: pa.RecordBatch):
        for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binaries(batch.column(2)), strict=True):
            found = shingles(text)
            mark = fingerprint(found)
            new = row is not None and len(found) > 0 and mark not in seen
            if new:
                seen.add(mark)
            yield row, doc_id, mark, len(found), registers(found).tobytes() if new else None

    for batch in batches:
        yield from chunked(rows(batch), _SKETCH, 1024)


_BAND = pa.schema([("key", pa.int64()), ("node", pa.int64())])


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.concatenate([bands(np.frombuffer(r, dtype=np.uint16)) for r in batch.column(1).to_pylist()]) if len(batch.column(0)) else np.empty(0, dtype=np.uint64)
        nodes = np.repeat(batch.column(0).to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(nodes)], schema=_BAND)


def _crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, node), those with a neighbour of the same key; the first and the last
    row of a partition always count, as their neighbours may be in the next one."""
    held, held_left = None, True
    for batch in batches:
        key, node = (batch.column(k).to_numpy() for k in range(2))
        if not len(key):
            continue
        if held is not None:
            key, node = np.concatenate([held[0], key]), np.concatenate([held[1], node])
        left = np.empty(len(key), dtype=bool)
        left[0], left[1:] = held_left, key[1:] == key[:-1]
        out = left[:-1] | left[1:]
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[:-1][out]), pa.array(node[:-1][out])], schema=_BAND)
        held, held_left = (key[-1:], node[-1:]), bool(left[-1])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], schema=_BAND)


_SETS = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("found", pa.list_(pa.int64()))])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full set of each node, from the row whose set has the node's fingerprint."""

    def rows(batch: pa.RecordBatch):
        for node, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binaries(batch.column(2)), strict=True):
            found = shingles(text)
            if fingerprint(found) == mark:
                yield node, len(found), found.view(np.int64)

    for batch in batches:
        yield from chunked(rows(batch), _SETS, 256)


_STAR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether two full sets are linked."""

    def rows(batch: pa.RecordBatch):
        a, b, left, right = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)
        for k in range(len(a)):
            x, y = (side[k].values.to_numpy().view(np.uint64) for side in (left, right))
            both = len(np.intersect1d(x, y, assume_unique=True))
            yield a[k], b[k], 100 * both >= LEAST_PERCENT * (len(x) + len(y) - both)

    for batch in batches:
        yield from chunked(rows(batch), _STAR, 1024)


def joint_estimate(first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray) -> np.ndarray:
    """The similarity that makes the registers' orders most likely, given both set sizes; a row a pair."""
    above, below = (first > second).sum(axis=1), (first < second).sum(axis=1)
    equal = REGISTERS - above - below
    u = n_first / (n_first + n_second)
    v = 1 - u
    drop = (BASE - 1) / BASE

    def chance(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.maximum(x, 0) * drop) / np.log(BASE), 1e-12, 1 - 1e-12)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = chance(u - v * j), chance(v - u * j)
        return above * np.log(up) + below * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(60):  # the likelihood has one peak
        a, b = low + (high - low) / 3, high - (high - low) / 3
        rises = likelihood(a) < likelihood(b)
        low, high = np.where(rises, a, low), np.where(rises, high, b)
    return (low + high) / 2


#: Estimates this far below the threshold are not verified: six standard errors.
MARGIN = 6 * (0.75 * 0.25 / REGISTERS) ** 0.5
#: Estimates from here on are verified before all the rest is compared: a standard error below the threshold.
CLOSE = 0.75 - (0.75 * 0.25 / REGISTERS) ** 0.5
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _likely(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose estimated similarity is ``least`` or more."""
    marks = nodes.select("node", "registers", "n")
    for side in ("a", "b"):
        pairs = pairs.join(marks.select(F.col("node").alias(side), F.col("registers").alias(f"r{side}"), F.col("n").alias(f"n{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch.column(0)):
                continue
            first, second = (np.stack([np.frombuffer(r, dtype=np.uint16) for r in batch.column(k).to_pylist()]) for k in (2, 3))
            sizes = [batch.column(k).to_numpy().astype(np.float64) for k in (4, 5)]
            keep = joint_estimate(first, second, *sizes) >= least
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(k).to_numpy()[keep]) for k in (0, 1)], schema=_PAIRS)

    return pairs.select("a", "b", "ra", "rb", "na", "nb").mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("found").alias("left")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("found").alias("right")), "b")
    found = both.select("a", "b", "left", "right").mapInArrow(_compare, "a long, b long, linked boolean")
    return settle(found.where("linked").select("a", "b").distinct(), "linked")


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with the component of their node, which is the node itself if nothing is linked with it."""
    return rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _second_leaders(members: DataFrame, labels: DataFrame) -> DataFrame:
    """In each bucket of several components, the pairs of a node, drawn by hash, with those of other components."""
    named = settle(_named(members.select("key", "node"), labels), "buckets")
    turn = F.xxhash64("key", "node")
    leaders = named.groupBy("key").agg(F.min_by(F.struct("node", "component"), turn).alias("leader"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    met = named.join(settle(leaders.select("key", "leader"), "leaders"), "key").where("component <> leader.component")
    return met.select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")).distinct()


#: Bytes of odd sketches and rows that a block holds, about, and the least and most places of a sketch.
BLOCK_BYTES, BLOCK_ROWS, LEAST_PLACES, MOST_PLACES = 1 << 20, 128, 1 << 10, 1 << 20


def odd_sketch(found: np.ndarray, places: int) -> bytes:
    """Whether each of the places (a power of two) has an odd number of the elements."""
    return np.packbits(np.bincount((found & np.uint64(places - 1)).view(np.int64), minlength=places).astype(np.uint8) & 1).tobytes()


_SKETCHED = pa.schema([("first", pa.int64()), ("block", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("component", pa.int64()), ("inside", pa.bool_()), ("odd", pa.binary())])


def _odd_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *kept, places, found = batch.columns
        odd = [odd_sketch(found[k].values.to_numpy().view(np.uint64), p) for k, p in enumerate(places.to_pylist())]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(odd, type=pa.binary())], schema=_SKETCHED)


def folded(sketches: np.ndarray) -> np.ndarray:
    """Odd sketches (a row each) of an eighth of the places: parities of places that become one add up."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), 8, -1), axis=1)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of two blocks below one first node, the pairs of different components, not both of the main one,
    whose shared counts and odd sketches (first folded, then whole) allow a link."""

    def close(one: np.ndarray, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        apart = np.bitwise_count(others ^ one).sum(axis=1, dtype=np.int64)
        return (100 + LEAST_PERCENT) * apart <= (100 - LEAST_PERCENT) * sizes

    def side(column: pa.Array, k: int) -> tuple:
        *numbers, odd = column[k].values.flatten()
        sketches = np.frombuffer(b"".join(odd.to_pylist()), dtype=np.uint64).reshape(len(odd), -1)
        return *[x.to_numpy(zero_copy_only=False) for x in numbers], sketches

    for batch in batches:
        for k in range(batch.num_rows):
            same = batch.column(0)[k].as_py()
            (node, n, shared, component, inside, odd), (others, m, their, parts, within, sketches) = (side(batch.column(c), k) for c in (1, 2))
            small, smaller = folded(odd), folded(sketches)
            for i in range(len(node)):
                fine = (parts != component[i]) & ~(within & inside[i])
                fine &= (100 + LEAST_PERCENT) * np.minimum(shared[i], their) >= LEAST_PERCENT * (n[i] + m)
                if same:
                    fine[: i + 1] = False
                at = np.flatnonzero(fine)
                at = at[close(small[i], smaller[at], n[i] + m[at])]
                at = at[close(odd[i], sketches[at], n[i] + m[at])]
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], others[at])), pa.array(np.maximum(node[i], others[at]))], schema=_PAIRS)


def _rest(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different components below one first node that the bounds allow.  Nodes of one bucket
    have the same first node, so blocks meet by it, once for all of its buckets."""
    named = settle(_named(members.select("first", "node", "n", "shared").distinct(), labels), "named")
    counts = named.groupBy("first", "component").agg(F.count("*").alias("size"), F.max("n").alias("most"))
    groups = counts.groupBy("first").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("parts"), F.sum("size").alias("size"), F.max("most").alias("most"))
    widest = F.expr(f"64D * {100 - LEAST_PERCENT} / {100 + LEAST_PERCENT} * most")  # 32 times the difference that a link of two such sets allows
    places = F.least(F.lit(MOST_PLACES), F.greatest(F.lit(LEAST_PLACES), F.pow(F.lit(2.0), F.ceil(F.log2(widest))))).cast("long")
    groups = groups.where("parts > 1").withColumn("places", places).withColumn("blocks", F.expr(f"cast(ceil(greatest(size * places / {8 * BLOCK_BYTES}D, size / {BLOCK_ROWS}D)) as bigint)"))
    rows = named.join(settle(groups.select("first", "main", "places", "blocks"), "groups"), "first")
    rows = settle(rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).withColumn("inside", F.expr("component = main")), "open")
    met = rows.join(sets.select("node", "found"), "node").select("first", "block", "node", "n", "shared", "component", "inside", "places", "found")
    odd = met.mapInArrow(_odd_sketches, "first long, block long, node long, n long, shared long, component long, inside boolean, odd binary").dropDuplicates(["first", "node"])
    packed = F.collect_list(F.struct("node", "n", "shared", "component", "inside", "odd")).alias("rows")
    blocks = settle(odd.groupBy("first", "block").agg(packed, F.bool_and("inside").alias("inside")), "blocks")
    x, y = blocks.alias("x"), blocks.alias("y")
    two = x.join(y, F.expr("x.first = y.first and x.block <= y.block and not (x.inside and y.inside)"))
    return two.selectExpr("x.block = y.block as same", "x.rows as left", "y.rows as right").mapInArrow(_near, "a long, b long").distinct()


def _labels(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and component of every node that has a link."""
    spark = texts.sparkSession
    with batches_of(spark, 8192):
        keys = nodes.select("node", "registers").mapInArrow(_band_rows, "key long, node long")
        crowded = keys.repartitionByRange("key", "node").sortWithinPartitions("key", "node").mapInArrow(_crowded, "key long, node long")
        crowded = settle(crowded, "crowded")
    wanted = nodes.join(crowded.select("node").distinct(), "node", "left_semi").select("node", "print", F.col("least.row").alias("row"))
    sets = settle(texts.join(wanted, "row").select("node", "print", "text").mapInArrow(_full_sets, "node long, n long, found array<long>"), "sets")
    # shingles of one node only: none of its links can use them
    alone = sets.select("node", F.explode("found").alias("h")).groupBy("h").agg(F.min("node").alias("node"), F.count("*").alias("times")).where("times = 1")
    lone = alone.groupBy("node").agg(F.count("*").alias("lone"))
    viable = sets.select("node", "n").distinct().join(lone, "node", "left").withColumn("shared", F.col("n") - F.coalesce("lone", F.lit(0))).where(f"100 * shared >= {LEAST_PERCENT} * n")
    rows = crowded.join(settle(viable.select("node", "n", "shared"), "viable"), "node")
    # a bucket's first node is the one with the least share of shingles of its own: near copies lie around it
    order = F.struct((F.col("n") - F.col("shared")) / F.col("n"), "node")
    firsts = rows.groupBy("key").agg(F.min_by("node", order).alias("first"), F.count("*").alias("size")).where("size > 1")
    members = settle(rows.join(settle(firsts.select("key", "first"), "firsts"), "key"), "members")
    stars = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = _linked(_likely(stars, nodes, CLOSE), sets)
    labels = components(links)
    more = _linked(_likely(_second_leaders(members, labels), nodes, CLOSE), sets)
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = components(links)
    rest = _linked(_likely(settle(_rest(members, labels, sets), "pairs"), nodes, LEAST_PERCENT / 100 - MARGIN), sets)
    if not rest.isEmpty():
        labels = components(links.unionByName(rest))
    return labels


def _judged(documents: DataFrame, row: Column) -> DataFrame:
    """row, doc_id, n_shingles, and the id and row of the first document (least_id, least_row) of the
    row's component, null without one.  Rows without a row number are linked with nothing; null ids are last."""
    spark = documents.sparkSession
    texts = documents.select(row.cast("long").alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    small_batches(spark)
    sketches = settle(texts.mapInArrow(_sketch, "row long, doc_id long, print binary, n long, registers binary"), "sketches")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("least")
    sets_of = sketches.where("row is not null and n > 0").groupBy("print").agg(least, F.max("n").alias("n"), F.max("registers").alias("registers"))
    nodes = settle(sets_of.withColumn("node", F.monotonically_increasing_id()), "nodes")
    with scratch() as kept:
        labels = settle(_labels(texts, nodes), "labels")
        kept.append(labels)
    # written before it is joined back, so that the join is one whose large components Spark can split
    smallest = settle(nodes.select("node", "least").join(labels, "node").groupBy("component").agg(F.min("least").alias("of_all")), "smallest")
    known = nodes.select("node", "print", "least").join(labels.join(smallest, "component").select("node", "of_all"), "node", "left")
    known = known.select("print", F.coalesce("of_all", "least").alias("least"))
    out = sketches.select("row", "doc_id", "print", F.col("n").alias("n_shingles")).join(known, "print", "left")
    linked = (F.col("n_shingles") > 0) & F.col("row").isNotNull()
    return out.select("row", "doc_id", "n_shingles", *[F.when(linked, F.col(f"least.{of}")).alias(f"least_{name}") for of, name in (("doc_id", "id"), ("row", "row"))])


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    component = F.coalesce("least_id", "doc_id")
    return _judged(documents, F.col("doc_id")).select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_first(documents: DataFrame) -> DataFrame:
    """The documents, columns as they are, that their components keep: the row with the smallest id,
    one of them if rows share it, and one without an id only where no row has one.  Decisions go by row,
    so copies without an id go as well."""
    numbered, row = numbered_rows(documents)
    gone = _judged(numbered, numbered[row]).where("row <> least_row").select(F.col("row").alias("_gone"))
    return numbered.join(gone, numbered[row] == gone["_gone"], "left_anti").drop(row)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + least(5, len(w)) - 1], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n, sum(h) AS mark FROM s GROUP BY doc_id),
rep AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY n, mark) AS r FROM n),
rs AS (SELECT s.* FROM s JOIN rep USING (doc_id) WHERE doc_id = r),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM rs x JOIN rs y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * c >= 75 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM rep WHERE doc_id = r UNION SELECT reach.x, both_ways.b FROM reach JOIN both_ways ON reach.y = both_ways.a),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_shingles, coalesce(comp.c, d.doc_id) AS component_id, coalesce(comp.c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN comp ON rep.r = comp.x
"""
