"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are put into a shuffled order (by MD5 of a seed and the id, or without an id the
text) and cut into blocks of equally many words.  Slots are numbered 0, 1, 2, ...; slot i's golden-ratio point
frac((i + 1) / phi) falls into one source's part of [0, 1), whose width is that source's share of
the slots, so every stretch of the schedule holds the sources near their weights.  Slots are
ranked within their source; rank r takes block r modulo the number of blocks, so a source is read
again once it is used up.  A source's last slot is cut so that its words equal its target.

Ranks and word offsets are prefix sums over a tree: inside a chunk of slots or a range of the order,
then over ``_FAN`` neighbours at a time, level by level.  Ranges end inside a source, an id or equal rows
as well, so no task holds a source's rows, nor those without an id, however large their share.  The plan alone, one row of a few numbers a source, is made in one task.  All
work is SQL functions in the JVM.

Defined results: null texts have size 0 and are never taken; null is a source of its own, the
last; repeated rows get a row each; rows that share id, source and size are interchangeable; an
empty table gives an empty result; of the input only doc_id, source and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.common import table
from tidewell.sources.settled import settle

SEED = "mix-1"
BLOCK_WORDS = 512
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
#: 1 / phi and frac(2 ** 20 / phi): two parts keep the points exact for long schedules.
_LOW, _HIGH, _PART = 0.6180339887498949, 0.8025870370864868, 1 << 20
#: Slots of a chunk, rows of a range, neighbours in a window, cells of the guide at least.
_CHUNK, _RANGE_ROWS, _FAN, _GUIDE = 4096, 32_768, 256, 1024


def n_words(text: Column) -> Column:
    """Number of runs of characters other than \\x20 and \\x09-\\x0D."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]++")).cast("long")


def offsets(sums: DataFrame, place: str, last: int) -> DataFrame:
    """sid, place and offset: what the places (0 to last) of the same sid before this one add up to in
    column n.  Places meet in windows of _FAN neighbours, and the sums of these in the next level's."""
    parent = f"{place}_above"
    inside = F.sum("n").over(Window.partitionBy("sid", parent).orderBy(place)) - F.col("n")
    local = sums.withColumn(parent, F.expr(f"{place} div {_FAN}")).withColumn("offset", inside)
    if last < _FAN:
        return local.select("sid", place, "offset")
    above = offsets(local.groupBy("sid", parent).agg(F.sum("n").alias("n")), parent, last // _FAN)
    joined = local.join(above.withColumnRenamed("offset", "before"), ["sid", parent])
    return joined.select("sid", place, (F.col("offset") + F.col("before")).alias("offset"))


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block: int = BLOCK_WORDS) -> DataFrame:
    """Per source: its number, size, target, quota, block length and slots; one row a source.

    A target is weight * level, at most ``most`` times the source's size.  The level is that at
    which all targets add up to all sizes: with sources in order of size / weight, it is what the
    capped ones leave, divided by the weights of the others.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int"))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sizes.select("source", "source_size", (F.row_number().over(every) - 1).cast("long").alias("sid"), weight.cast("long").alias("weight"), (F.col("source_size") * most).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ranked.select(
        "*",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weights_left"),
    )
    # the first source that stands below its cap at the level left by those before it sets the level of the rest
    free = F.col("cap") * F.col("weights_left") >= F.col("left") * F.col("weight")
    first = F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), "sid", "left", "weights_left"))).over(whole)
    below = F.col("cap") * first["weights_left"] <= first["left"] * F.col("weight")
    target = F.when(F.coalesce(below, F.lit(True)), F.col("cap").cast("double")).otherwise(F.col("weight").cast("double") * first["left"].cast("double") / first["weights_left"].cast("double"))
    quota = F.least(F.round("target").cast("long"), F.col("cap"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(block))).cast("long")
    return (
        level.withColumn("target", target).withColumn("quota", quota).withColumn("block_words", F.greatest(F.lit(1), F.ceil(F.col("source_size") / blocks)).cast("long"))
        .withColumn("n_blocks", F.expr("cast(ceil(source_size / block_words) as bigint)"))
        .withColumn("epochs", F.expr("if(source_size = 0, 0L, quota div source_size)"))
        .withColumn("rest", F.expr("quota - epochs * source_size"))
        .withColumn("n_slots", F.expr("epochs * n_blocks + cast(ceil(rest / block_words) as bigint)"))
        .select("source", "sid", "source_size", "target", "quota", "block_words", "n_blocks", "epochs", "rest", "n_slots")
    )


def schedule(sources: DataFrame, n_slots: int) -> DataFrame:
    """slot, sid, block, first and last word (exclusive) in the source, for every slot in use.  A point
    meets the sources of its cell; with as many cells as sources these are two on average."""
    spark = sources.sparkSession
    cells = max(_GUIDE, 1 << sources.count().bit_length())
    rows_before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    reach = sources.where("n_slots > 0").select("sid", "n_slots", F.coalesce(F.sum("n_slots").over(rows_before), F.lit(0)).alias("low"))
    reach = reach.select("sid", (F.col("low") / n_slots).alias("low"), ((F.col("low") + F.col("n_slots")) / n_slots).alias("high"))
    guide = reach.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * cells), F.least(F.lit(cells - 1), F.floor(F.col("high") * cells)))))
    point = F.expr(f"(cast((id + 1) div {_PART} as double) * {_HIGH}D + cast((id + 1) % {_PART} as double) * {_LOW}D) % 1D")
    points = spark.range(n_slots).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.floor(F.col("point") * cells))
    dealt = points.join(guide, "cell").where("point >= low and (point < high)").select("slot", "sid", F.expr(f"slot div {_CHUNK}").alias("chunk"))
    counts = dealt.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    local = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    ranked = dealt.withColumn("local", local).join(offsets(counts, "chunk", n_slots // _CHUNK), ["sid", "chunk"]).select("slot", "sid", (F.col("local") + F.col("offset")).alias("rank"))
    # the points give each source its number of slots but for a few: those over are left out, those missing follow at the end
    missing = sources.join(counts.groupBy("sid").agg(F.sum("n").alias("n")), "sid", "left").withColumn("n", F.coalesce("n", F.lit(0))).where("n < n_slots")
    tail = missing.select(F.col("sid"), F.explode(F.expr("sequence(n, n_slots - 1)")).alias("rank")).select((F.col("rank") + F.lit(n_slots)).alias("slot"), "sid", "rank")
    slots = ranked.unionByName(tail).join(sources.select("sid", "n_blocks", "block_words", "source_size", "epochs", "rest", "n_slots"), "sid").where("rank < n_slots")
    return slots.selectExpr(
        "slot", "sid", "rank % n_blocks as block", "(rank % n_blocks) * block_words as first",
        "least((rank % n_blocks + 1) * block_words, if(rank div n_blocks < epochs, source_size, rest)) as last",
    )


def stream(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block: int = BLOCK_WORDS, carry: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix itself, the sized documents (with carry: and all their columns, as doc) and the sources.

    The mix: slot, row, word_from and word_to (exclusive): in the order of slot and row's place,
    these are the pieces of documents that training reads.
    """
    whole = [F.struct("*").alias("doc")] if carry else []
    text = F.col("text").cast("string")
    turn = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.when(F.col("doc_id").isNull(), F.md5(text.cast("binary"))), F.lit(""))).cast("binary"))
    sized = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), turn.alias("turn"), *whole)
    sized = settle(sized, "sizes")
    sources = settle(plan(sized, weights, most, block), "sources")
    totals = sources.agg(F.coalesce(F.sum("n_slots"), F.lit(0)).alias("slots")).first()
    n_slots, n_rows = totals["slots"], sized.count()
    if not n_slots:
        empty = sized.where("false").selectExpr("0L as slot", "row", "0L as place", "0L as word_from", "0L as word_to")
        return empty, sized, sources
    known = sized.where("size > 0").join(sources.select(F.col("source").alias("_source"), "sid", "block_words"), F.col("source").eqNullSafe(F.col("_source")))
    order = ("sid", "turn", "doc_id", "size", "row")
    dealt = known.select(*order, "block_words").repartitionByRange(1 + n_rows // _RANGE_ROWS, *order)
    dealt = settle(dealt.withColumn("range", F.spark_partition_id()), "ranges")  # two reads of the ranges must agree
    sums = dealt.groupBy("sid", "range").agg(F.sum("size").alias("n"))
    running = F.sum("size").over(Window.partitionBy("sid", "range").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1))
    last = dealt.agg(F.max("range")).first()[0]
    placed = dealt.withColumn("local", F.coalesce(running, F.lit(0))).join(offsets(sums, "range", last), ["sid", "range"]).withColumn("start", F.col("local") + F.col("offset"))
    pieces = placed.withColumn("block", F.explode(F.expr("sequence(start div block_words, (start + size - 1) div block_words)")))
    mixed = schedule(sources, n_slots).join(pieces.select("sid", "block", "row", "start", "size"), ["sid", "block"])
    mixed = mixed.selectExpr("slot", "row", "start as place", "greatest(first, start) - start as word_from", "least(last, start + size) - start as word_to").where("word_to > word_from")
    return mixed, sized, sources


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, carry: bool = False) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target of the source, words taken; with carry, doc."""
    mixed, sized, sources = stream(documents, weights, most, carry=carry)
    taken = mixed.groupBy("row").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    known = sources.select(F.col("source").alias("_source"), "source_size", "target")
    out = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).join(taken, "row", "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), *(["doc"] if carry else []))


def mixed_documents(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """The documents that the mix takes words of, with size, source_size, target and taken (which
    replace columns of these names)."""
    found = mix(documents, weights, most, carry=True).where("taken > 0")
    added = ["size", "source_size", "target", "taken"]
    return found.select(*[F.col(f"doc.`{c}`").alias(c) for c in documents.columns if c not in added], *added)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: The level by repeated resharing is found here from the sorted ratios, and words taken in closed form.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(CAST(doc_id AS VARCHAR), md5(text), '') AS mark, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source),
w AS (SELECT *, sid % 3 + 1 AS weight, 3 * source_size AS cap FROM s),
l AS (SELECT *, CAST((SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER p, 0) AS BIGINT) AS remaining,
             CAST((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER p, 0) AS BIGINT) AS weights_left
      FROM w WINDOW p AS (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT remaining, weights_left FROM l WHERE cap * weights_left >= remaining * weight ORDER BY cap / weight, sid LIMIT 1),
t AS (SELECT w.source, source_size, cap, CASE WHEN cap * f.weights_left <= f.remaining * weight THEN CAST(cap AS DOUBLE)
             ELSE CAST(weight AS DOUBLE) * CAST(f.remaining AS DOUBLE) / CAST(f.weights_left AS DOUBLE) END AS target FROM w, f),
q AS (SELECT *, least(CAST(round(target) AS BIGINT), cap) AS quota FROM t),
c AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.quota,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('{SEED}:' || mark), doc_id, size, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE quota // source_size * size + greatest(0, least(a + size, quota % source_size) - a) END AS BIGINT) AS taken FROM c
"""
