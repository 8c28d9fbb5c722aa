"""URL filters by a temporal list join.

List entries are dated: from its date on, ``block`` or ``allow`` puts a pattern on a list with that
verdict, ``remove`` takes it off.  Per list and pattern, each entry is turned into a validity
interval that ends at the next entry.  A capture is cut into the patterns that could name it (the
host's suffixes and the host with each prefix of the path), and an as-of join finds the intervals
that hold at its fetch date.  Of the active entries, the longest pattern decides; of equally long
ones ``allow`` goes before ``block``, then the first list by name.

The join is on the pattern, and only a capture's row id, date and patterns take part in it; what it
finds (rows that an entry names) joins the captures back.  Spark broadcasts the intervals while they are
small and else sorts and merges, splitting hot hosts.  One number is collected: the longest pattern's length.

Defined results: a URL of any length is read in time in proportion to it; a null or hostless URL matches nothing and is kept; user names, ports, letter
case of the host and a final dot don't matter; repeated captures get a row each; repeated entries
count once, and of entries of one date the last of remove, block, allow holds; entries with null
fields are ignored; empty lists keep everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.common import numbered_rows, table

#: The production list (list name, pattern, date, action).
ENTRIES = (
    ("spam", "spam-farm.example.org", "2023-11-01", "block"),
    ("spam", "spam-farm.example.org", "2024-06-15", "remove"),
    ("spam", "spam-farm.example.org", "2024-09-01", "block"),
    ("pharma", "cheap-pills.example.com", "2024-01-20", "block"),
    ("adverts", "tionsh.example.net", "2024-03-01", "block"),
    ("adverts", "tionsh.example.net", "2024-05-01", "remove"),
    ("trusted", "tionsh.example.net/en", "2024-04-01", "allow"),
    ("adverts", "blog.tionble.example.com/de", "2024-02-10", "block"),
    ("adverts", "ththth.example.org", "2024-07-04", "block"),
    ("trusted", "blog.ththth.example.org", "2024-08-01", "allow"),
    ("trusted", "blog.ththth.example.org", "2024-10-01", "remove"),
    ("malware", "ththan.example.net/en/960", "2024-01-05", "block"),
)
#: The crawl's first day: pages carry no fetch time, so page_id modulo a year of days stands for it.
FIRST_DAY, DAYS = "2024-01-01", 366
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def entries(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(ENTRIES), "list string, pattern string, since string, action string")
    return rows.withColumn("since", F.to_date("since"))


def intervals(dated: DataFrame) -> DataFrame:
    """list, pattern, verdict, since, until (exclusive; null: still open) of every block and allow entry."""
    known = dated.where("list is not null and pattern is not null and since is not null and action in ('remove', 'block', 'allow')")
    rank = F.expr("array_position(array('remove', 'block', 'allow'), action)")
    last = known.groupBy("list", F.lower("pattern").alias("pattern"), "since").agg(F.max_by("action", rank).alias("action"))
    until = F.lead("since").over(Window.partitionBy("list", "pattern").orderBy("since"))
    return last.withColumn("until", until).where("action <> 'remove'").select("list", "pattern", F.col("action").alias("verdict"), "since", "until")


def host(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)), F.lit("."))


def patterns(url: Column, longest: int) -> Column:
    """All patterns of at most ``longest`` characters that could name a URL; empty without a host.  What is
    further from the host's end or the path's start than a list's longest pattern can't be in one, so it is cut off
    first: a URL costs time in proportion to its length, however many segments it has."""
    name = host(url)
    labels = F.split(F.when(F.length(name) > longest + 2, F.right(name, F.lit(longest + 2))).otherwise(name), r"\.")
    path = F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1), "/+", "/")
    segments = F.filter(F.split(F.left(path, F.lit(longest + 2)), "/"), lambda x: x != "")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    prefixes = F.transform(segments, lambda _, i: F.lower(F.concat(name, F.lit("/"), F.array_join(F.slice(segments, 1, i + 1), "/"))))
    paths = F.when(F.length(name) > longest, F.array().cast("array<string>")).otherwise(prefixes)
    fitting = F.filter(F.array_distinct(F.concat(suffixes, paths)), lambda x: F.length(x) <= longest)
    return F.when(name == "", F.array().cast("array<string>")).otherwise(fitting)


def judge(captures: DataFrame, dated: DataFrame, url: str = "url", fetched: str = "fetch_date") -> DataFrame:
    """The captures with host, n_active, the deciding list and entry, and blocked (which replace
    columns of these names)."""
    numbered, row = numbered_rows(captures)
    name = F.col(f"`{url}`").cast("string")
    longest = dated.agg(F.max(F.length(F.lower("pattern")))).first()[0] or 0
    asked = numbered.select(F.col(row).alias("_row"), F.explode(patterns(name, longest)).alias("_pattern"), F.col(f"`{fetched}`").cast("date").alias("_at"))
    valid = intervals(dated).select("list", F.col("pattern").alias("_entry"), "verdict", "since", "until")
    active = (F.col("_pattern") == F.col("_entry")) & (F.col("since") <= F.col("_at")) & (F.col("until").isNull() | (F.col("_at") < F.col("until")))
    # least by this order decides: longest pattern first, allow before block, then the list's name
    order = F.struct(-F.length("_entry"), F.col("verdict"), F.col("list"))
    first = F.min_by(F.struct("list", F.col("_entry").alias("entry"), "verdict"), order)
    found = asked.join(valid, active).groupBy("_row").agg(F.count("*").alias("_n"), first.alias("_first")).withColumnRenamed("_row", "_named")
    out = numbered.select(F.struct("*").alias("capture")).join(found, F.col(f"capture.{row}") == F.col("_named"), "left")
    added = {
        "host": host(F.col(f"capture.`{url}`").cast("string")), "n_active": F.coalesce("_n", F.lit(0).cast("long")), "list": F.col("_first.list"), "entry": F.col("_first.entry"),
        "blocked": F.coalesce(F.col("_first.verdict") == "block", F.lit(False)),
    }
    return out.select(*[F.col(f"capture.`{c}`").alias(c) for c in captures.columns if c not in added], *[v.alias(n) for n, v in added.items()])


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = F.expr(f"date_add(date'{FIRST_DAY}', cast(page_id % {DAYS} as int))")
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url", fetched.alias("fetch_date")), entries(spark))
    return judged.withColumn("fetch_date", F.col("fetch_date").cast("string"))


_VALUES = ", ".join(f"('{a}', '{b}', DATE '{c}', '{d}')" for a, b, c, d in ENTRIES)
ORACLE = f"""
WITH e AS (SELECT * FROM (VALUES {_VALUES}) v(list, pattern, since, action)),
iv AS (SELECT *, lead(since) OVER (PARTITION BY list, pattern ORDER BY since) AS until FROM e),
p AS (SELECT row_number() OVER () AS r, page_id, url, DATE '{FIRST_DAY}' + CAST(page_id % {DAYS} AS INT) AS fetch_date,
    rtrim(lower(regexp_extract(coalesce(url, ''), '{_HOST}', 1)), '.') AS host,
    list_filter(string_split(regexp_extract(coalesce(url, ''), '{_PATH}', 1), '/'), lambda x: x <> '') AS seg FROM pages),
k AS (SELECT r, fetch_date, unnest(list_concat(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string((string_split(host, '.'))[i:], '.')),
    list_transform(range(1, len(seg) + 1), lambda i: lower(host || '/' || array_to_string(seg[1:i], '/'))))) AS key FROM p WHERE host <> ''),
m AS (SELECT r, list, pattern, action, row_number() OVER (PARTITION BY r ORDER BY length(pattern) DESC, action, list) AS o, count(*) OVER (PARTITION BY r) AS n
    FROM k JOIN iv ON key = pattern AND since <= fetch_date AND (until IS NULL OR fetch_date < until) WHERE action <> 'remove')
SELECT page_id, url, CAST(CAST(fetch_date AS DATE) AS VARCHAR) AS fetch_date, host, coalesce(n, 0) AS n_active, list, pattern AS entry, coalesce(action = 'block', false) AS blocked
FROM p LEFT JOIN (SELECT * FROM m WHERE o = 1) m USING (r)
"""
