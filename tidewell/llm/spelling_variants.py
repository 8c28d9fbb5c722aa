"""Spelling variant grouping by pivotal grams.

Two words are near if one inserted, deleted or replaced letter turns one into the other.  A word's
bigrams, rarest first, give its prefix: the first three, and all others that equal the third.  From the
prefix a dynamic programme takes the two disjoint bigrams (pivots) with the least total count.  One edit
breaks at most one of two disjoint bigrams, and of two words the one whose prefix reaches less far has
both pivots in the reach of the other's prefix; so of every near pair a pivot of one stands in the prefix
of the other, at the same place or moved by the difference of the lengths.  Pivots and prefixes are joined
on bigram, place and length; letter parities and then the edit distance verify pairs inside the join, so
only near pairs become rows.

Occurrences are counted in the tasks before they are shuffled.  The counts of the bigrams are the one
broadcast: at most 90 * 90 rows, for the alphabet has 90 letters.  The join is one of two plain exchanges,
so its hot places are split by skew.  A form is at least ten times as frequent as its word, so chains of forms have at
most 18 steps, and five rounds of pointer jumping end them all.

Defined results: null, empty and wordless texts have no words; a null id deletes no letter; repeated rows and ids
count again; of equally frequent near words the smallest is the form; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import CRC_SQL, binaries, chunked, small_batches, table
from tidewell.sources.settled import scratch, settle

LEAST_LENGTH, LEAST_COUNT, RATIO, DELETING = 7, 2, 10, 31
#: Bigrams in a prefix for one edit, and disjoint ones among them.
PREFIX, PIVOTS = 3, 2
#: Words that a task counts before it hands them on.
MOST_HELD = 200_000
_LOWER = bytes(range(256)).translate(bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))))
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
_COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])


def read_word(doc_id: int | None, run: str) -> str:
    """The run as the query reads it: about one in 31 loses a letter."""
    if doc_id is None:
        return run
    h = zlib.crc32(b"%d:%b" % (doc_id, run.encode()))
    at = h % len(run)
    return run if h % DELETING else run[:at] + run[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), strict=True):
            for run, n in Counter(_RUN.findall((text or b"").translate(_LOWER).decode())).items():
                word = read_word(doc_id, run)
                if len(word) >= LEAST_LENGTH:
                    held[word] += n
            if len(held) > MOST_HELD:
                yield from chunked(held.items(), _COUNTED)
                held.clear()
    yield from chunked(held.items(), _COUNTED)


def words_of(documents: DataFrame) -> DataFrame:
    """word and n, the occurrences over all documents, of the words that occur often enough."""
    small_batches(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def pivots(prefix: list[tuple[int, int]], wanted: int = PIVOTS) -> list[int]:
    """Of bigrams (place, count) by place, the places of the disjoint ones with the least total count."""
    # best[k]: the least total, and its places, of k disjoint bigrams among those seen so far; before[k]:
    # the same among those seen until two places ago, which do not overlap the next one.
    steps: list[tuple[int, list]] = [(-2, [(0, [])])]
    for place, count in prefix:
        best = list(steps[-1][1])
        base = next(b for p, b in reversed(steps) if p <= place - 2)
        for k, (total, places) in enumerate(base[:wanted], start=1):
            one = (total + count, [*places, place])
            if k == len(best):
                best.append(one)
            elif one < best[k]:
                best[k] = one
        steps.append((place, best))
    return steps[-1][1][-1][1]


_GRAMS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("parity", pa.int64()), ("prefix", pa.list_(pa.string())), ("places", pa.list_(pa.int32())), ("pivots", pa.list_(pa.int32()))])


def chosen(word: str, counts: dict[str, int]) -> tuple[list[str], list[int], list[int]]:
    """The bigrams of a word's prefix, their places, and the places of its pivots."""
    ranked = sorted((counts[word[i : i + 2]], word[i : i + 2], i) for i in range(len(word) - 1))
    last = ranked[PREFIX - 1][:2]
    prefix = [(gram, i) for n, gram, i in ranked if (n, gram) <= last]
    first = sorted((i, n) for n, _, i in ranked[:PREFIX])
    return [g for g, _ in prefix], [i for _, i in prefix], pivots(first)


def grams_of(words: DataFrame) -> DataFrame:
    """The words with letter parities (a bit is set for an odd number), prefix bigrams with places, and pivots."""
    places = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("gram")
    counts = {r["gram"]: r["count"] for r in words.select(places).groupBy("gram").count().collect()}  # 90 * 90 rows at most
    known = words.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch):
            for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parity = 0
                for letter in word:
                    parity ^= 1 << ord(letter) % 63
                yield word, n, parity, *chosen(word, known.value)

        for batch in batches:
            yield from chunked(rows(batch), _GRAMS)

    return words.mapInArrow(run, "word string, n long, parity long, prefix array<string>, places array<int>, pivots array<int>")


#: Of the other word: how much longer it is, and how far the bigram stands behind.
MOVES = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n of all near words, in both directions."""
    grams = settle(grams_of(words), "grams")
    size = F.length("word").cast("int")
    entry = F.explode(F.arrays_zip("prefix", "places")).alias("e")
    index = grams.select("word", "n", "parity", size.alias("size"), entry).select(
        F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("parity").alias("other_parity"), F.col("size").alias("other_size"), F.col("e.prefix").alias("gram"), F.col("e.places").alias("place")
    )
    moves = F.explode(F.array(*(F.struct(F.lit(longer).alias("longer"), F.lit(behind).alias("behind")) for longer, behind in MOVES))).alias("m")
    probes = grams.select("word", "n", "parity", size.alias("size"), F.explode("pivots").alias("p"), "prefix", "places").select("word", "n", "parity", "size", "p", F.expr("prefix[array_position(places, p) - 1]").alias("gram"), moves)
    probes = probes.select("word", "n", "parity", (F.col("size") + F.col("m.longer")).alias("other_size"), (F.col("p") + F.col("m.behind")).alias("place"), "gram").where(f"place >= 0 and other_size >= {LEAST_LENGTH}")
    met = probes.join(index, ["gram", "place", "other_size"]).where("bit_count(parity ^ other_parity) <= 2 and word <> other and levenshtein(word, other, 1) = 1")
    one_way = met.select(*(F.when(F.col("word") < F.col("other"), F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (("word", "other", "word"), ("n", "other_n", "n"), ("other", "word", "other"), ("other_n", "n", "other_n"))))
    pairs = settle(one_way.distinct(), "near")
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form, by pointer jumping; forms: word, form."""
    now = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if ahead.join(now, "root", "left_semi").isEmpty():
            return now
        with scratch() as kept:
            now = settle(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
            kept.append(now)


def variants(documents: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of the documents."""
    words = settle(words_of(documents), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("least"), F.col("other").alias("form"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.max("n").alias("n"), best)
    formed = F.col("best.least") <= -RATIO * F.col("n")
    near = settle(near.select("word", "n_near", F.when(formed, F.col("best.form")).alias("form"), F.when(formed, -F.col("best.least")).alias("form_n")), "forms")
    found = words.join(near, "word", "left").join(roots(near.where("form is not null")), "word", "left")
    return found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE = rf"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS x FROM documents)),
counted AS (SELECT doc_id, x, count(*) AS n, doc_id || ':' || x AS k FROM runs WHERE length(x) >= {LEAST_LENGTH} GROUP BY doc_id, x),
crc_keys AS (SELECT DISTINCT k FROM counted WHERE k IS NOT NULL),
{CRC_SQL},
cut AS (SELECT CASE WHEN h % {DELETING} = 0 THEN left(x, h % length(x)) || substr(x, h % length(x) + 2) ELSE x END AS word, n FROM counted LEFT JOIN crcs USING (k)),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
less AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS part FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
replaced AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b USING (part, i) WHERE a.word <> b.word),
longer AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM words a JOIN less b ON a.word = b.part),
pairs AS (SELECT word, n, other, other_n FROM replaced UNION SELECT word, n, other, other_n FROM longer UNION SELECT other, other_n, word, n FROM longer),
near AS (SELECT word, n, count(*) AS n_near, arg_min(other, (-other_n, hex(encode(other)))) AS form, max(other_n) AS form_n FROM pairs GROUP BY word, n),
forms AS (SELECT word, form, form_n FROM near WHERE form_n >= {RATIO} * n),
walk AS (SELECT word, form AS root, 1 AS steps FROM forms UNION ALL SELECT walk.word, forms.form, steps + 1 FROM walk JOIN forms ON forms.word = walk.root),
ends AS (SELECT word, arg_max(root, steps) AS root FROM walk GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, words.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n
FROM words LEFT JOIN (SELECT word, n_near FROM near) USING (word) LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)
"""
