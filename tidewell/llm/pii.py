"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts scores.

All work is done by SQL functions in the JVM.  For each kind, ``regexp_extract_all`` gives the
matches and ``split`` the texts between them; a fold over both gives each match's position in code
points, its validity and its score, in parts of ``STEP`` matches so that no list is copied for each of
its entries.  Base kinds (email, ip, card, phone) are kept or dropped by their validators alone, and
their scores only tell how sure they are.  The added kinds also need a score of ``LEAST``: iban (a number
of its country's length that passes mod-97; words of orders and the like speak against it), account (13
to 15 digits that pass Luhn), local (a phone number without its country) and taxid, which all need a word
of their context.  A score, in hundredths, starts from the kind's prior, rises with a passed checksum and
with a context word in the ``NEAR`` characters before the span, and falls with a word against it there.
The patterns are written so that a match attempt never restarts inside a run it has already read (``\\G``,
look-behind, possessive repeats): the work is linear in the text, and no repeat recurses.

Defined results: null and empty texts have no spans; repeated rows get a row each; a null doc_id is
returned as such; texts are read whole; redaction leaves a null text null and all other columns
(clashing names included) as they are, but for n_chars, which follows the new text if it is there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import table

NEAR, STEP, LEAST = 40, 256, 60
SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


@dataclass(frozen=True)
class Kind:
    """needs: a cheap test that a text without matches fails; context and against: words that raise and
    lower a score; prior, checksum: parts of a score, in hundredths."""

    name: str
    pattern: str
    needs: str
    context: str
    prior: int
    checksum: int = 0
    least: int = 0
    against: str = ""


#: Countries by the length of their account numbers (ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """A number of its country's length, in groups of four or without spaces."""
    known = "|".join(
        rf"(?:{'|'.join(names.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, names in IBAN_LENGTHS.items()
    )
    return rf"(?<![A-Za-z0-9_])(?:{known})(?![A-Za-z0-9_])"


#: Words against an account number.
_ORDERS = r"order|invoice|ticket|tracking|isbn|serial"
#: Patterns and context words.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", r"mail|contact|write|address", 80),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", r"host|server|address|login", 60, 0, 0, r"version|release"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", r"card|credit|visa|master|payment", 30, 50, 0, _ORDERS),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", r"phone|call|mobile|fax|whatsapp", 70),
    Kind("iban", _iban(), r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", r"iban|bank|account|konto|cuenta|compte", 20, 50, LEAST, _ORDERS),
    Kind("account", r"(?<![A-Za-z0-9_+.])[0-9]{13,15}(?![A-Za-z0-9_]|\.[0-9])", r"[0-9]{13}", r"card|credit|amex|account|payment", 10, 30, LEAST, _ORDERS),
    Kind("local", r"(?<![A-Za-z0-9_-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![A-Za-z0-9_-])", r"[0-9]-[0-9]{3}-[0-9]{4}", r"phone|call|mobile|fax|whatsapp", 40, 0, LEAST, _ORDERS),
    Kind("taxid", r"(?<![A-Za-z0-9_-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_-])", r"[0-9]-[0-9]{2}-[0-9]{4}", r"social|ssn|taxpayer|tax id|passport", 40, 0, LEAST, _ORDERS),
)
BASE = ("email", "ip", "card", "phone")
CONTEXT_BONUS, AGAINST = 20, 30
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"


def luhn(digits: Column) -> Column:
    """True if the decimal digits pass the Luhn checksum."""
    value = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2).__mod__(F.lit(10)) + F.floor(c.cast("int") * 2 / 10).cast("int")),
    )
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """True if an account number without spaces leaves 1 when its rearranged digits are divided by 97."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    value = F.transform(F.split(turned, ""), lambda c: F.position(c, F.lit(_DIGITS)) - 1)
    return F.aggregate(value, F.lit(0), lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97) == 1


def valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(_OCTETS)
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(match, " ", ""))
    if kind == "account":
        return luhn(digits)
    return F.lit(True)


def _needs(kind: Kind, text: Column) -> Column:
    return F.contains(text, F.lit(kind.needs)) if len(kind.needs) == 1 else text.rlike(kind.needs)


def _parts(items: Column) -> Column:
    """The entries of a list that is not empty, STEP at a time, as structs of their first place and themselves."""
    last = F.floor((F.size(items) - 1) / STEP).cast("int")
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), last)), lambda c: F.struct((c * STEP).alias("first"), F.slice(items, c * STEP + 1, STEP).alias("items")))


def _before(totals: Column, zero: Column, plus, kind: str) -> Column:
    """For each entry, what the entries before it come to."""
    start = F.struct(zero.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.aggregate(totals, start, lambda a, x: F.struct(plus(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]


def _steps(kind: Kind, text: Column, matches: Column) -> Column:
    """Each match with the length of the text before it (from the last match on) and that text's end."""
    between = F.slice(F.split(text, kind.pattern, -1), 1, F.size(matches))
    return F.zip_with(between, matches, lambda b, m: F.struct(F.length(b).alias("skip"), F.right(b, F.lit(NEAR)).alias("near"), m.alias("m")))


_STEPS = "array<struct<skip:int,near:string,m:string>>"


def _fold(kind: Kind, steps: Column) -> Column:
    """The valid spans of one kind.  A part starts where the parts before it end, with the end of the
    text there: no match has fewer than five characters, so that of the last eight."""

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["skip"]
        end = start + F.length(x["m"])
        ahead = F.right(F.concat(acc["tail"], x["near"]), F.lit(NEAR))
        score = F.lit(kind.prior + kind.checksum) + F.when(F.lower(ahead).rlike(kind.context), CONTEXT_BONUS).otherwise(0)
        if kind.against:
            score = score - F.when(F.lower(ahead).rlike(kind.against), AGAINST).otherwise(0)
        span = F.struct(F.lit(kind.name).alias("kind"), start.cast("long").alias("start"), end.cast("long").alias("end"), (F.least(F.lit(100), score) / 100).alias("score"))
        keep = valid(kind.name, x["m"]) & (score >= kind.least)
        return F.struct(
            end.alias("at"), F.right(F.concat(ahead, x["m"]), F.lit(NEAR)).alias("tail"), F.when(keep, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans")
        )

    parts = _parts(steps)
    lengths = F.transform(parts, lambda p: F.aggregate(p["items"], F.lit(0), lambda a, x: a + x["skip"] + F.length(x["m"])))
    starts = _before(lengths, F.lit(0), lambda a, x: a + x, "int")

    def tail(first: Column) -> Column:
        last = F.slice(steps, F.greatest(F.lit(1), first - 7), F.least(F.lit(8), first))
        return F.aggregate(last, F.lit(""), lambda a, x: F.right(F.concat(a, x["near"], x["m"]), F.lit(NEAR)))

    def part(p: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), tail(p["first"]).alias("tail"), F.array().cast(SPAN).alias("spans"))
        return F.aggregate(p["items"], start, step)["spans"]

    return F.flatten(F.zip_with(parts, starts, part))


def detect(documents: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """The input with one more column (or one replaced): the spans of all kinds, by kind and then start."""
    found = _seen(documents, text)
    return found.select(*[F.col(f"doc.`{c}`").alias(c) for c in documents.columns if c != out], F.col("spans").alias(out))


def _seen(documents: DataFrame, text: str) -> DataFrame:
    """The input's columns as doc, its text as whole (empty where null), and the spans."""
    rows = documents.select(F.struct("*").alias("doc"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("whole"))
    whole, nothing = F.col("whole"), F.array().cast("array<string>")
    names = [f"found_{k.name}" for k in KINDS]
    found = rows.withColumns({n: F.when(_needs(k, whole), F.regexp_extract_all(whole, F.lit(k.pattern), F.lit(0))).otherwise(nothing) for n, k in zip(names, KINDS, strict=True)})
    found = found.select("doc", "whole", *[F.when(F.size(n) > 0, _steps(k, whole, F.col(n))).otherwise(F.array().cast(_STEPS)).alias(n) for n, k in zip(names, KINDS, strict=True)])
    spans = [F.when(F.size(n) > 0, _fold(k, F.col(n))).otherwise(F.array().cast(SPAN)) for n, k in zip(names, KINDS, strict=True)]
    return found.select("doc", "whole", F.concat(*spans).alias("spans"))


def redact(documents: DataFrame, text: str = "text") -> DataFrame:
    """Every detected span replaced by its kind in brackets; overlapping spans are replaced as one, by
    the first one's kind."""
    seen = _seen(documents, text)
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    seen = seen.select("doc", "whole", ordered.alias("spans"))
    parts = _parts(F.col("spans"))
    reached = _before(F.transform(parts, lambda p: F.array_max(F.transform(p["items"], lambda s: s["end"]))), F.lit(0).cast("long"), lambda a, x: F.greatest(a, x), "long")

    def step(acc: Column, s: Column) -> Column:
        cut = F.struct(acc["at"].alias("after"), s["start"].alias("start"), s["kind"].alias("kind"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], F.concat(acc["cuts"], F.array(cut))).otherwise(acc["cuts"]).alias("cuts"))

    empty = F.array().cast("array<struct<after:bigint,start:bigint,kind:string>>")
    cuts = F.flatten(F.zip_with(parts, reached, lambda p, at: F.aggregate(p["items"], F.struct(at.alias("at"), empty.alias("cuts")), step)["cuts"]))
    touched = F.size("spans") > 0
    end = F.array_max(F.transform("spans", lambda s: s["end"]))
    # four bytes a character, so that a piece is found by its place
    wide = F.when(touched, F.encode("whole", "UTF-32"))
    marked = seen.select("doc", touched.alias("touched"), wide.alias("wide"), F.when(touched, cuts).alias("cuts"), end.alias("end"))

    def piece(start: Column, length: Column) -> Column:
        return F.decode(F.substring("wide", (4 * start + 1).cast("int"), (4 * length).cast("int")), "UTF-32")

    pieces = F.transform("cuts", lambda c: F.concat(piece(c["after"], c["start"] - c["after"]), F.lit("["), F.upper(c["kind"]), F.lit("]")))
    fresh = F.concat(F.array_join(pieces, ""), piece(F.col("end"), F.octet_length("wide") / 4 - F.col("end")))
    clean = marked.select("doc", "touched", F.when(F.col("touched"), fresh).otherwise(F.col(f"doc.`{text}`")).alias("clean"))
    columns = {c: F.col(f"doc.`{c}`") for c in documents.columns}
    columns[text] = F.col("clean")
    if "n_chars" in columns and text != "n_chars":
        columns["n_chars"] = F.when(F.col("touched"), F.length("clean").cast(documents.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return clean.select(*[value.alias(name) for name, value in columns.items()])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = {f"n_{k}": F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)") for k in BASE}
    scores = F.array_join(F.transform("spans", lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",")
    return seen.select("doc_id", *[c.alias(n) for n, c in counts.items()], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), scores.alias("scores"))


#: Per kind: its number, a pattern, and what a match must pass; the numbers of accounts and countries are the
#: digit runs whose neighbours fit, as DuckDB's patterns can't look around.
_KIND_SQL = {
    "email": (1, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (2, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda x: CAST(coalesce(try_cast(x AS UBIGINT), 999) AS BIGINT))) <= 255"),
    "card": (3, r"[0-9]([\x20-]?[0-9])+", "length(d) BETWEEN 16 AND 19 AND luhn"),
    "phone": (4, r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 8 AND 15"),
    "account": (6, r"[0-9]+", r"length(m) BETWEEN 13 AND 15 AND luhn AND NOT regexp_matches(pre, '[A-Za-z0-9_+.]') AND NOT regexp_matches(post, '^([A-Za-z0-9_]|\.[0-9])')"),
    "local": (7, r"[0-9-]+", "regexp_full_match(m, '[0-9]{3}-[0-9]{3}-[0-9]{4}') AND NOT regexp_matches(pre, '[A-Za-z_]') AND NOT regexp_matches(post, '^[A-Za-z_]')"),
    "taxid": (8, r"[0-9-]+", "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND NOT regexp_matches(pre, '[A-Za-z_]') AND NOT regexp_matches(post, '^[A-Za-z_]')"),
}
_FOUND = " UNION ALL ".join(
    f"""SELECT r, {n} AS k, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(ps[1:len(ms)]) AS p
        FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS ps FROM d) WHERE len(ms) > 0"""
    for n, pattern, _ in _KIND_SQL.values()
)
_VALID = " ".join(f"WHEN k = {n} THEN {test}" for n, _, test in _KIND_SQL.values())
_LENGTHS = ", ".join(f"('{c}', {n})" for n, names in IBAN_LENGTHS.items() for c in names.split())
_RULES = ", ".join(f"({i}, '{k.name}', {k.prior + k.checksum}, {k.least}, '{k.context}', '{k.against or chr(0x24) + '^x'}')" for i, k in enumerate(KINDS, 1))
ORACLE = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
placed AS (SELECT *, CAST(sum(length(p) + length(m)) OVER (PARTITION BY r, k ORDER BY i) AS BIGINT) AS e, regexp_replace(m, '[^0-9]', '', 'g') AS d FROM found),
sums AS (SELECT placed.*, e - length(m) AS s, substr(t, e - length(m), 1) AS pre, substr(t, e + 1, 2) AS post,
    list_sum(list_transform(range(1, length(d) + 1), lambda j: CASE WHEN j % 2 = 1 THEN CAST(d[length(d) + 1 - j] AS INT)
        ELSE (CAST(d[length(d) + 1 - j] AS INT) * 2) % 10 + (CAST(d[length(d) + 1 - j] AS INT) * 2) // 10 END)) % 10 = 0 AS luhn FROM placed JOIN d USING (r)),
starts AS (SELECT d.r, t, CAST(sum(length(p) + 4) OVER (PARTITION BY d.r ORDER BY i) AS BIGINT) - 4 AS s, m FROM (
    SELECT r, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(ps[1:len(ms)]) AS p
    FROM (SELECT r, regexp_extract_all(t, '[A-Z]{{2}}[0-9]{{2}}') AS ms, regexp_split_to_array(t, '[A-Z]{{2}}[0-9]{{2}}') AS ps FROM d) WHERE len(ms) > 0) x JOIN d ON d.r = x.r),
sized AS (SELECT r, s, regexp_extract(substr(t, s + 1, 45), '^([A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{' || ((n - 4) // 4) || '}}' || CASE WHEN n % 4 > 0 THEN ' ?[A-Z0-9]{{' || (n % 4) || '}}' ELSE '' END || ')(?:[^A-Za-z0-9_]|$)', 1) AS m
    FROM starts JOIN (VALUES {_LENGTHS}) l(c, n) ON c = substr(m, 1, 2) WHERE s = 0 OR NOT regexp_matches(substr(t, s, 1), '[A-Za-z0-9_]')),
numbers AS (SELECT r, s, s + length(m) AS e, m FROM sized WHERE m <> ''),
apart AS (SELECT r, min(s) AS s FROM numbers GROUP BY r UNION ALL SELECT a.r, (SELECT min(n.s) FROM numbers n WHERE n.r = a.r AND n.s >= b.e) FROM apart a JOIN numbers b ON a.r = b.r AND a.s = b.s WHERE a.s IS NOT NULL),
iban AS (SELECT r, 5 AS k, s, e, list_reduce(list_prepend(0, list_transform(string_split(substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4), ''),
    lambda c: strpos('{_DIGITS}', c) - 1)), lambda a, x: (a * (CASE WHEN x > 9 THEN 100 ELSE 10 END) + x) % 97) = 1 AS fine FROM numbers JOIN apart USING (r, s)),
fine AS (SELECT r, k, s, e FROM sums WHERE CASE {_VALID} ELSE false END UNION ALL SELECT r, k, s, e FROM iban WHERE fine),
scored AS (SELECT r, k, kind, s, e, least, sure + CASE WHEN regexp_matches(lower(substr(t, greatest(1, s + 1 - {NEAR}), least({NEAR}, s))), context) THEN {CONTEXT_BONUS} ELSE 0 END
    - CASE WHEN regexp_matches(lower(substr(t, greatest(1, s + 1 - {NEAR}), least({NEAR}, s))), against) THEN {AGAINST} ELSE 0 END AS score
    FROM fine JOIN d USING (r) JOIN (VALUES {_RULES}) rules(k, kind, sure, least, context, against) USING (k)),
good AS (SELECT r, k, s, kind || ':' || s || ':' || e AS j, least(100, score) AS score FROM scored WHERE score >= least),
per AS (SELECT r, count(*) FILTER (WHERE k = 1) AS n_email, count(*) FILTER (WHERE k = 2) AS n_ip, count(*) FILTER (WHERE k = 3) AS n_card, count(*) FILTER (WHERE k = 4) AS n_phone,
    string_agg(j, ',' ORDER BY k, s) FILTER (WHERE k <= 4) AS base, string_agg(j, ',' ORDER BY k, s) AS spans, string_agg(CAST(score AS VARCHAR), ',' ORDER BY k, s) AS scores FROM good GROUP BY r)
SELECT doc_id, CAST(coalesce(n_email, 0) AS BIGINT) AS n_email, CAST(coalesce(n_ip, 0) AS BIGINT) AS n_ip, CAST(coalesce(n_card, 0) AS BIGINT) AS n_card,
    CAST(coalesce(n_phone, 0) AS BIGINT) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores FROM d LEFT JOIN per USING (r)
"""
