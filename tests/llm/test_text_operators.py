"""The operators that judge one text at a time: brute force, planted cases, held-out accuracy."""

from __future__ import annotations

import hashlib
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import SCHEMA, awkward, frame, prose
from tidewell.llm import decontaminate, html_text, language_id, pii, quality_classifier, quality_rules, url_filters

SMALL = "/root/testdata/sf0.01"


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# Benchmark decontamination.


def brute_hits(text, items, n=13):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, owners = fold(text), set(), set()
    for item, other in items:
        w = fold(other)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            for j in range(len(words) - k + 1):
                if words[j : j + k] == w[i : i + k]:
                    hit.update(range(j, j + k))
                    owners.add(str(item))
    return len(words), len(hit), tuple(sorted(owners)), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("most", [100_000, 3, 1])
def test_contamination(spark, most):
    """One broadcast set of windows, and a join; rows are judged alike, and items without an id are windows."""
    items = [(10, prose(2, 70)), (9, "One-TWO three"), (8, ""), (7, None), (6, prose(6, 40)), (6, prose(6, 40)), (5, "one"), (None, prose(1, 20))]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, row int")
    got = decontaminate.contamination(frame(spark), bench, most=most).collect()
    want = [(r[0], *brute_hits(r[1], items)) for r in awkward()]
    kept = decontaminate.clean_documents(frame(spark), bench, most=most)
    assert kept.columns == frame(spark).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((w[0] for w in want if not w[-1]), key=str)
    found = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(map(str, r["items"]))), r["contaminated"]) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str) and all(None not in r["items"][:-1] for r in got)


@pytest.mark.parametrize("most", [100_000, 60])
def test_clean_documents_judges_each_row(spark, most):
    """Null and repeated ids give the same with one block of windows and with many."""
    bench = spark.createDataFrame([(1, prose(2, 70)), (2, prose(3, 70))], "item_id long, text string")
    rows = [(7, prose(2, 70)), (7, prose(9, 90)), (None, prose(3, 70)), (None, prose(8, 50)), (4, prose(9, 90))]
    kept = decontaminate.clean_documents(spark.createDataFrame(rows, "doc_id long, text string"), bench, most=most).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


@pytest.mark.parametrize("most", [100_000, 40])
def test_long_and_nameless_items(spark, most):
    """One item has more windows than a set holds, and items without an id are windows too, as in the SQL."""
    items = [(1, prose(2, 110)), (1, prose(2, 110)), (2, prose(2, 30)), (None, prose(3, 40)), (None, "one two"), (3, None), (4, "")]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    rows = [(7, prose(2, 110)), (7, prose(3, 40)), (None, "x one two"), (8, prose(9, 90)), (9, prose(2, 110) + " " + prose(3, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.cut_windows(bench, 13)
    assert found.count() == 98 + 18 + 28 + 1
    assert (decontaminate._in_one_set(found, 13, most) is None) == (most < 1000)
    bloom, lengths = decontaminate.window_filter(found)
    hashes = np.array([r["hash"] for r in found.collect()]).view(np.uint64)
    assert lengths == [2, 13] and decontaminate.passes(bloom, hashes).all() and decontaminate.passes(bloom, hashes + np.uint64(1)).mean() < 0.1
    got = decontaminate.contamination(docs, bench, most=most).collect()
    found = sorted(((r["doc_id"], r["n_hit"], r["items"], r["contaminated"]) for r in got), key=str)
    assert found == sorted([(7, 110, ["1", "2"], True), (7, 40, [None], True), (None, 2, [None], True), (8, 0, [], False), (9, 150, ["1", "2", None], True)], key=str)
    assert [r["doc_id"] for r in decontaminate.clean_documents(docs, bench, most=most).collect()] == [8]


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(empty(spark), none).count() == 0
    assert decontaminate.contamination(frame(spark), none).where("n_hit > 0").count() == 0
    docs = frame(spark)
    assert decontaminate.clean_documents(docs, none).schema == docs.schema


# Quality rules.


def test_rule_measurements():
    text = "a b c d e f g h\nx a b c d e f g h y\n\nx y\nx y\n#$ É"
    words = text.split()
    wins = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {p for i, w in enumerate(wins) if wins.count(w) > 1 for p in range(i, i + 8)}
    got = quality_rules.measure(text.encode())
    assert got[:6] == (len(words), sum(map(len, words)), 2, 5, 1, len(covered))
    assert quality_rules.measure(None) == quality_rules.measure(b"") == (0,) * 8


def test_ledger_policies_and_ablation(spark):
    docs = frame(spark)
    entries = quality_rules.ledger(docs).cache()
    assert entries.count() == len(awkward()) and quality_rules.ledger(empty(spark)).count() == 0
    policy = quality_rules.POLICIES["v1"]
    rows = [r["fail_bits"] for r in entries.collect()]
    names = list(quality_rules.RULES)
    for r in quality_rules.ablation(entries, policy).collect():
        bit = 1 << names.index(r["rule"])
        used = quality_rules.mask(policy.fatal + policy.counted)
        assert r["n_fail"] == sum(bool(x & bit) for x in rows)
        assert r["n_fail_alone"] == sum((x & used) == bit for x in rows)


# Quality classifier.


def test_classifier_accuracy_on_held_out_rows(spark):
    scored = quality_classifier.op1(spark, SMALL).join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in scored)


def test_classifier_without_labels_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights = quality_classifier.train(frame(spark), none)
    assert not weights.any()
    assert {r["score"] for r in quality_classifier.score(frame(spark), weights).collect()} == {0.5}
    assert quality_classifier.score(empty(spark), weights).count() == 0


def test_labels_without_a_document_and_long_texts(spark, monkeypatch):
    """Shards are counted over rows that have a document, and split by their features; empty ones do not shrink weights."""
    rows = [(i, prose(i, 60) if i % 2 else "# $ % " * 30) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(5000)], "doc_id long, quality int, toxic int")
    few = quality_classifier.train(docs, labels)
    assert np.allclose(few, quality_classifier.train(docs, labels.where("doc_id < 200")), atol=1e-6) and np.abs(few).max() > 0.05
    monkeypatch.setattr(quality_classifier, "SHARD_FEATURES", 2000)
    split = quality_classifier.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, split).collect()}
    assert not np.allclose(few, split) and all((s > 0.5) == bool(i % 2) for i, s in scores.items())


def test_classifier_is_deterministic(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    first, again = quality_classifier.train(docs, labels), quality_classifier.train(docs.repartition(5), labels)
    assert np.allclose(first, again, atol=1e-6)


# Language ID.


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = language_id.op6(spark, SMALL).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.98


def test_language_of_awkward_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.train(docs)
    texts = [None, "", " 123 !!", "x", "日本語", "the of and " * 200_000]
    got = [language_id.decide(t, model)[0] for t in texts]
    assert got[:3] == ["und"] * 3 and got[-1] == "en" and set(got[3:5]) <= set(model.languages)
    nothing = language_id.train(empty(spark))
    assert nothing.languages == () and language_id.decide("the", nothing) == ("und", 0.0, [])
    kept = language_id.keep_decided(frame(spark), model, 0.0)
    assert kept.schema.fieldNames() == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert kept.where("text is null or trim(text) = ''").count() == 0


def test_each_ngram_counts_once_in_pieces(monkeypatch):
    """Pieces of any length give the n-grams of the whole text; letters beyond the lower planes are letters."""
    text = "Der  Hund -- läuft\n\n12 über die   Straße, \U00030001\U00030002 x " * 3
    whole = [np.sort(np.concatenate([language_id.grams(p, n, had) for p, had in language_id.pieces(text)])) for n in language_id.LENGTHS]
    for piece in (1, 3, 4, 7, 10, 50):
        monkeypatch.setattr(language_id, "PIECE", piece)
        for n, want in zip(language_id.LENGTHS, whole, strict=True):
            got = np.sort(np.concatenate([language_id.grams(p, n, had) for p, had in language_id.pieces(text)]))
            assert (got == want).all() and len(got) == len(want), (piece, n)
    monkeypatch.undo()
    model = language_id.Filter(("a",), np.zeros((1, language_id.SLOTS), dtype=np.uint64), np.zeros(1))
    assert language_id.decide("\U00030001", model)[0] == "a" and language_id.decide("1 2", model)[0] == "und"


def test_a_language_with_one_text_is_learned(spark):
    rows = [(i, f"the words of text number {i} are such", "en") for i in range(4000)] + [(i, "ein einziger deutscher satz steht hier", "de") for i in range(4000, 9000)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=5)
    assert language_id.decide("ein deutscher satz", model)[0] == "de" and language_id.decide("the words of", model)[0] == "en"


def test_language_filter_with_many_languages():
    draw = np.random.default_rng(1)
    names = tuple(f"l{i:02d}" for i in range(70))
    planes = np.zeros((2, language_id.SLOTS), dtype=np.uint64)
    grams = {i: draw.integers(0, 2**62, 50).astype(np.uint64) for i in range(70)}
    for i, g in grams.items():
        a = language_id.mix(g + np.uint64(1))
        step = (a >> np.uint64(32)) | np.uint64(1)
        for k in range(language_id.PROBES):
            planes[i // 64, (a + np.uint64(k) * step) & np.uint64(language_id.SLOTS - 1)] |= np.uint64(1 << (i % 64))
    model = language_id.Filter(names, planes, np.zeros(70))
    for i, g in grams.items():
        assert (model.probe(g)[i // 64] & np.uint64(1 << (i % 64)) != 0).all()


# PII.

_SEP = re.compile(r"[^0-9]")


def brute_spans(text):
    found = []
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(_SEP.sub("", m)) <= 19 and luhn(_SEP.sub("", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(_SEP.sub("", m)) <= 15),
    }
    for kind, (pattern, fine) in rules.items():
        found += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text or "") if fine(m[0])]
    return ",".join(found)


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


PII_TEXTS = [
    "mail a.b+c@x-y.co.uk, é@q.r a@b@c.d a@b.c_d@e.f x@y no@dots.", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4 999999999999.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1112 1 4111111111111111 5",
    "+1 (555) 123-4567. +12 +123456789012345678 +4 4 4 4 4 4 4 4 --", "日本 a@b.cd 4785380592391139 日 +44 20 7946 0958", "", None, "7" * 3000 + "@", "a@" * 500 + "b.c", "+1" + " ." * 2000,
]


def test_pii_spans(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(PII_TEXTS)], "doc_id long, text string, spans string, n_chars int")
    got = {r["doc_id"]: r["found"] for r in pii.detect(docs, out="found").collect()}
    for i, text in enumerate(PII_TEXTS):
        assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in got[i] if s["kind"] in pii.BASE) == brute_spans(text), text


def test_pii_added_kinds_and_redaction(spark):
    text = "pay to IBAN DE89 3704 0044 0532 0130 00 or card 378282246310005, not DE89 3704 0044 0532 0130 01 or 378282246310005; write a@b.cd now"
    docs = spark.createDataFrame([(1, text, "own", None), (2, None, None, 5), (3, "nothing here", None, 12)], "doc_id long, text string, _spans string, n_chars long")
    rows = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert rows[1]["text"].startswith("pay to IBAN [IBAN] or card [ACCOUNT], not DE89") and rows[1]["text"].endswith("write [EMAIL] now")
    assert rows[1]["_spans"] == "own" and rows[1]["n_chars"] == len(rows[1]["text"]) and rows[2]["text"] is None and rows[3]["text"] == "nothing here"
    assert pii.redact(frame(spark)).count() == len(awkward()) and pii.redact(empty(spark)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("IBAN ES9121000418450200051332 BIC CAIXESBB", ["ES9121000418450200051332"]),
        ("BE68 5390 0754 7034 BIC GKCCBEBB", ["BE68 5390 0754 7034"]),
        ("AT611904300234573201 BIC and SE45 5000 0000 0583 9825 7466 BIC X", ["AT611904300234573201", "SE45 5000 0000 0583 9825 7466"]),
        ("ES91 2100 0418 4502 0005 1332 ES91 2100 0418 4502 0005 1332", ["ES91 2100 0418 4502 0005 1332"] * 2),
        ("AB12 3456 7890 1234 ES91 2100 0418 4502 0005 1332 XES9121000418450200051332", ["ES91 2100 0418 4502 0005 1332"]),
        ("REF AB12 3456 7890 DE89 3704 0044 0532 0130 00 OK", ["DE89 3704 0044 0532 0130 00"]),
        ("NO93 8601 1117 947 BIC, MT84 MALT 0110 0001 2345 MTLC AST0 01S", ["NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]),
        ("ES91 2100 0418 4502 0005 1333 BIC", []),
    ],
)
def test_account_numbers_before_other_capitals(spark, text, want):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = [s for s in pii.detect(docs).first()["spans"] if s["kind"] == "iban"]
    assert [text[s["start"] : s["end"]] for s in spans] == want
    left = pii.redact(docs).first()["text"]
    assert left.count("[IBAN]") == len(want) and not any(w in left for w in want)


SCORED = [
    "call 555-123-4567 or 555-123-4568-1, order 555-123-4569", "my ssn 123-45-6789 and phone x123-45-6789", "order no. ES9121000418450200051332", "bank order ES9121000418450200051332 BIC CAIXESBB",
    "card 378282246310005 then invoice 378282246310005 and amex order 378282246310005", "+378282246310005 account 378282246310005.", "version 1.2.3.4 server 1.2.3.4", "phone 555-123-4567" + " x 555-123-4568" * 700, "IBAN \n ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332",
]


def test_pii_against_its_sql(spark, tmp_path):
    """Kinds that need context, words against them, many spans in one text, and all texts of the other tests."""
    import duckdb

    account_texts = [t for m in test_account_numbers_before_other_capitals.pytestmark for t, _ in m.args[1]]
    rows = [(i, t) for i, t in enumerate([*PII_TEXTS, *SCORED, *account_texts, *[r[1] for r in awkward()], "é é " * 3000 + "a@b.cd " * 900])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r[c] for c in sorted(r.asDict())) for r in pii.op7(spark, str(tmp_path)).collect()}
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    answer = connection.execute(pii.ORACLE)
    names = [c[0] for c in answer.description]
    assert got == {tuple(r[names.index(c)] for c in sorted(names)) for r in answer.fetchall()}
    scores = {r["doc_id"]: (r["spans"], r["scores"]) for r in pii.op7(spark, str(tmp_path)).collect()}
    first = len(PII_TEXTS)
    assert [scores[first + k] for k in range(7)] == [
        ("local:5:17", "60"), ("taxid:7:18", "60"), ("", ""), ("iban:11:35", "60"), ("account:5:20", "60"), ("phone:0:16,account:25:40", "70,60"), ("ip:8:15,ip:23:30", "30,50")
    ]
    # "phone" is within 40 characters of the first three
    assert len(scores[first + 7][0].split(",")) == 3 and len(scores[len(rows) - 1][0].split(",")) == 900


def test_redaction_of_many_and_overlapping_spans(spark):
    text = "日本 " + "a@b.cd é " * 700 + "call +44 555-123-4567 now"
    docs = spark.createDataFrame([(1, text, 0)], "doc_id long, text string, n_chars long")
    row = pii.redact(docs).first()
    assert row["text"] == "日本 " + "[EMAIL] é " * 700 + "call [PHONE] now" and row["n_chars"] == len(row["text"])


# HTML.


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header class="site-header"><h1>Site</h1></header><nav><a href=/>Home</a></nav>
    <div class="cookie-notice">We use cookies of the and for you</div><article><header><h1>Head &amp; line</h1></header><p>First&nbsp;para <b>bold<br>text</b>\n of it<p>Short.
    <div class="ad">Buy the best of it now and for all</div><ul><li>One<li>Two</ul><table><tr><td>Cell</td></tr></table><section id="comments"><p>The comment of a reader that is here</p></section></article>
    <aside>More of the same</aside><form>Name <input></form><footer>&copy; x</footer><script>var a = "<p>no</p>"</script></body></html>"""
    assert html_text.main_text(page) == "Head & line\n\nFirst para bold text of it\n\nShort.\n\nOne\n\nTwo\n\nCell"


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!-- open", "<script>var x", "&amp", "</p></div>", "<a href='x", "<p><p><p>", "\x00<b>"])
def test_broken_pages_do_not_crash(page):
    assert isinstance(html_text.main_text(page), str)


def test_page_without_containers():
    long = "The words of this text are such that the rules can tell it is the main text of the page and not a menu at all"
    page = f"<div><a href=a>Home</a> <a href=b>News</a></div><h2>Title</h2><p>{long}</p><p>Short part</p><p>{long}</p><div><a href=a>Next page of the list here</a></div>"
    assert html_text.main_text(page) == f"Title\n\n{long}\n\nShort part\n\n{long}"


def test_headings_with_inline_tags():
    page = "<article><h2><a href=x>Linked title</a></h2><p>Short <a href=y>link</a><h3><div><a href=z>Wrapped</a></div></h3><p><a href=w>More</a></p><h4>An <em>emphasis</em></h4></article>"
    found = {b.text: b.heading for b in html_text.blocks(page)}
    assert found == {"Linked title": True, "Short link": False, "Wrapped": True, "More": False, "An emphasis": True}
    assert html_text.main_text(page) == "Linked title\n\nShort link\n\nWrapped\n\nAn emphasis"


@pytest.mark.parametrize("attribute", ['class="has-sidebar"', 'class="no-sidebar"', 'class="page content-with-sidebar"', 'id="search-results"', 'class="sidebar"', 'class="widget"'])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_named_wrappers_around_the_text(attribute, tag):
    page = f"<nav>Menu</nav><div {attribute}><{tag}><h1>Head</h1><p>The text of the page</p></{tag}></div><aside>More</aside>"
    assert html_text.main_text(page) == "Head\n\nThe text of the page"


def test_names_inside_the_article():
    kept = '<h2 id="related-work">Related work</h2><section id="search-methods"><p>How to find it is shown here</p></section><p id="legal-basis">The basis in law</p><h2 id="comments">On comments</h2>'
    bad = "".join(f'<div class="{c}">Not a part of the text</div>' for c in ("ad", "ad-banner", "x Cookie-Notice", "social_share", "site-nav", "related-posts", "comments-area", "ad-1", "post-sidebar", "sponsored-content", "js-share-button"))
    teasers = '<div class="related"><article>A teaser of other text</article></div>'
    assert html_text.main_text(f"<article>{kept}{bad}</article>{teasers}") == "Related work\n\nHow to find it is shown here\n\nThe basis in law\n\nOn comments"


@pytest.mark.parametrize("skipped", ['<svg class="x"/>', "<math />", "<svg><svg/><svg><text>no</text></svg><text>no</text></svg>", "<button>", "<select>", "<object data='x'>", "<canvas>", "<template>", "<button>no</button>", "<svg><title/><style/><path/></svg>", "<!-- <svg> -->", "<script>'<button>'</script>"])
def test_skipped_tags_end_where_they_do(skipped):
    page = f"<article><p>Before it {skipped}is text</p><p>And after it</p><button>no</button><svg><path/></svg><p>Last</p></article>"
    assert html_text.main_text(page) == "Before it is text\n\nAnd after it\n\nLast"


def test_extract_keeps_every_row(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x"), (1, "u", "<p>x"), (None, None, None)], "page_id long, url string, html string")
    assert html_text.extract(pages).count() == 3 and html_text.extract(pages.where("false")).count() == 0


# URL filters.


def test_url_filters_at_every_date(spark):
    dated = [("a", "x.org", "2024-01-10", "block"), ("a", "x.org", "2024-02-10", "remove"), ("b", "x.org/ok", "2024-01-15", "allow"), ("a", "x.org", "2024-01-10", "remove"), (None, "y.org", "2024-01-01", "block"), ("c", "y.org", None, "block")]
    lists = spark.createDataFrame(dated, "list string, pattern string, since string, action string").selectExpr("list", "pattern", "cast(since as date) as since", "action")
    urls = [("http://X.org/a", "2024-01-09", False), ("http://me@sub.x.org.:80/a", "2024-01-10", True), ("https://x.org/ok/page?q", "2024-01-20", False), ("https://x.org/okay", "2024-01-20", True), ("http://x.org", "2024-02-10", False), (None, "2024-01-20", False), ("nothing", "2024-01-20", False), ("http://notx.org/", "2024-01-20", False), ("http://y.org/", "2024-01-20", False), ("http://x.org/", None, False)]
    captures = spark.createDataFrame([(i, u, d, "clash") for i, (u, d, _) in enumerate(urls)] * 2, "page_id long, url string, fetch_date string, _row string")
    got = sorted((r["page_id"], r["blocked"]) for r in url_filters.judge(captures, lists).collect())
    assert got == sorted([(i, b) for i, (_, _, b) in enumerate(urls)] * 2)
    assert url_filters.judge(captures, lists.where("false")).where("blocked").count() == 0
    assert url_filters.judge(captures.where("false"), lists).count() == 0


def test_digest_columns(spark):
    row = decontaminate.op10(spark, "/root/testdata/sf0.001").where("n_items = 0").first()
    assert row["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_very_long_urls(spark):
    """A megabyte of segments, labels or slashes takes no quadratic number of characters, and matches as it should."""
    lists = spark.createDataFrame([("l", p, "2024-01-01", "block") for p in ("h.org/a/b", "h.org/c/", "x.h.net", "h.org/a/" + "q" * 40)], "list string, pattern string, since string, action string")
    lists = lists.withColumn("since", F.to_date("since"))
    many = "/s" * 500_000
    urls = [f"http://h.org/a/b{many}", f"http://h.org//a//{'/' * 900_000}b", f"http://h.org/a/bb{many}", f"http://{'a.' * 500_000}x.h.net/y", f"http://{'a.' * 500_000}x.hh.net", "http://h.org/" + "z" * 1_000_000, "http://h.org/a/" + "q" * 41, "http://h.org/a/" + "Q" * 40 + "/r"]
    captures = spark.createDataFrame([(i, u, "2024-02-02") for i, u in enumerate(urls)], "page_id long, url string, fetch_date string").withColumn("fetch_date", F.to_date("fetch_date"))
    began = time.perf_counter()
    got = {r["page_id"]: r["entry"] for r in url_filters.judge(captures, lists).select("page_id", "entry").collect()}
    assert time.perf_counter() - began < 20
    assert got == {0: "h.org/a/b", 1: "h.org/a/b", 2: None, 3: "x.h.net", 4: None, 5: None, 6: None, 7: "h.org/a/" + "q" * 40}
