"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags.  The first pass classifies each block from the
containers it stands in and from its length, stop-word density and link density: good, bad,
or, if it is too short to tell, undecided.  The second pass gives an undecided block the label of
the nearest decided neighbours in its own section: the label of both if they agree, else of the
nearer one.  Headings start sections.  Good blocks are joined in page order.  Article and main decide where they
hold most of the text.  Names (class, id) and forms around a block make it
bad, but never reject a whole page: if no block is good, the passes decide again without them, and at last
all is text that is not bad for another reason.  Where
few stop words show that a page is in none of the known languages, their density decides nothing.

Defined results: null, empty or textless html gives an empty text; unclosed and stray tags,
comments and references are read as browsers do, in time linear in the page; an attribute without its
closing quote ends with its tag; an unclosed script, style, textarea, title, noscript, iframe or comment
swallows the rest, and of other skipped tags without an end only the tag goes; ``<br>`` is white space in
its block; references to no character are U+FFFD; repeated rows get a row each; pages of any length are
read whole; of the input only page_id, url and html are read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import chunked, small_batches, table

#: Frequent function words of the languages the crawl holds.
STOP_WORDS = frozenset(
    "the of and to in is it that for was on are as with be by this at from or an not have but which you he she they his her we all".split()
    + "de la le les et des en un une du que qui est pour dans sur au par pas plus avec ce il elle ne se aux ou son sa".split()
    + "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei".split()
    + "el los las y del se una por con no su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta".split()
)
#: Tags.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
SKIPPED_TAGS = frozenset("script style noscript template svg math iframe object canvas select option textarea button title head".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BAD_CONTAINERS = frozenset("nav footer aside menu".split())
FORM_CONTAINERS = frozenset("form dialog fieldset".split())
MAIN_CONTAINERS = frozenset("article main".split())
#: Words of class, id and role attributes that name parts around the main text.
BAD_NAMES = re.compile(
    r"ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navbox|navigation|navi|menu|menubar|menus|breadcrumbs?|sidebar|footer|masthead|cookie\w*|consent|notice|gdpr|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|comments?|commentlist|discussions?|disqus|respond|reply|replies|pagination|pager|widget|toolbar|legal|copyright|alert|search",
    re.IGNORECASE,
)
#: Those of them that name no layout, so what they name is never the main text.
FIRM_NAMES = re.compile(r"ad|ads|advert\w*|adsense|sponsor\w*|cookie|consent|gdpr|newsletter|subscribe|comments?|commentlist|disqus|respond|reply|replies", re.IGNORECASE)
#: Words that may stand beside such a word in a hyphenated name; with any other word the name is of something else.
PLAIN_NAMES = frozenset(
    "site page global top bottom left right main primary secondary sub mobile desktop sticky floating user post posts article articles entry stories story header head area bar block box btn button buttons card cards container count field form group holder icon icons inner input inline item items label leaderboard link links list message module outer overlay panel row section slot slots space text thread title unit wrap wrapper js wp widgets banners body meta author tools media follow this default fixed dark light toggle dropdown".split()
)
SITE_HEADERS = re.compile(r"(?:^|\s)(?:(?:site|page|global|top|main)[_-]?)?header(?:$|\s)", re.IGNORECASE)
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
#: Length in characters below which a block can't be judged alone, and the densities that decide.
SHORT, LINKS_MOST, LINKS_FEW, STOPS_LOW, STOPS_HIGH = 70, 0.5, 0.1, 0.1, 0.2

_STOP = re.compile(r">|=\s*[\"']")
_NAME = re.compile(r"[^\s/>]+")
_ATTRIBUTE = re.compile(r"([^\s=/>\"'][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]*)))?")
_RAW_TAGS = frozenset("script style textarea title noscript iframe".split())
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE) for tag in _RAW_TAGS}
#: Tags skipped up to their own end, if they have one; svg and math may also end in themselves.
_CLOSED_TAGS = frozenset("template svg math object canvas select button".split())
_SELF_CLOSED = frozenset("svg math".split())
_HEADING = re.compile("h[1-6]")
_NUMBER = re.compile(r"&#(?:([0-9]+)|[xX]([0-9a-fA-F]+));?")


@dataclass(slots=True)
class Token:
    """A tag of a page and its place; what is between tokens is text."""

    tag: str
    closing: bool
    attributes: str
    start: int
    end: int

    @property
    def self_closed(self) -> bool:
        return self.attributes.rstrip().endswith("/")


def tokens(page: str) -> list[Token]:
    """The tags of a page (comments and the like have the tag ""), from one pass that never goes back."""
    found: list[Token] = []
    last_quote = {q: page.rfind(q) for q in "\"'"}
    endless: set[str] = set()
    at, foreign = 0, 0

    def upto(mark: str, start: int) -> int:
        end = page.find(mark, start)
        return len(page) if end < 0 else end + len(mark)

    def end_of_tag(start: int) -> int:
        """Behind the > that no attribute's quotes hold.  A quote without its like, or whose like closes
        no value (more text follows at once, and a > is before it), holds nothing."""
        while True:
            stop = _STOP.search(page, start)
            if not stop:
                return len(page)
            start, quote = stop.end(), page[stop.end() - 1]
            if quote == ">":
                return start
            if last_quote[quote] < start:
                return upto(">", start)
            close = page.find(quote, start)
            if page[close + 1 : close + 2] not in ("", " ", "\t", "\n", "\f", "\r", "/", ">") and 0 <= page.find(">", start, close):
                return upto(">", start)
            start = close + 1

    while (start := page.find("<", at)) >= 0:
        sign = page[start + 1 : start + 2]
        if sign in ("!", "?"):
            if page.startswith("<!--", start):
                at = start + 5 if page.startswith(">", start + 4) else upto("-->", start + 4)
            elif page.startswith("<![CDATA[", start):
                at = upto("]]>", start + 9)
            else:
                at = upto(">", start + 2)
            found.append(Token("", False, "", start, at))
            continue
        closing = sign == "/"
        begin = start + 1 + closing
        if not (page[begin : begin + 1].isascii() and page[begin : begin + 1].isalpha()):
            at = start + 1
            if closing:
                at = upto(">", begin)
                found.append(Token("", False, "", start, at))
            continue
        name = _NAME.match(page, begin)
        tag = name.group().lower()
        at = upto(">", name.end()) if closing else end_of_tag(name.end())
        token = Token(tag, closing, page[name.end() : at - 1] if page[at - 1 : at] == ">" else page[name.end() : at], start, at)
        found.append(token)
        if tag in _SELF_CLOSED and not token.self_closed:
            foreign = max(0, foreign - 1) if closing else foreign + 1
        if tag in _RAW_TAGS and not closing and not (token.self_closed and foreign):
            end = None if tag in endless else _RAW_ENDS[tag].search(page, at)
            if not end:
                endless.add(tag)
            at = end.end() if end else at if token.self_closed else len(page)
            token.end = at
    return found


def ends_of_skipped(found: list[Token]) -> dict[int, int]:
    """By place in the list: where skipped tags that have an end of their own end."""
    ends: dict[int, int] = {}
    open_at: dict[str, list[int]] = {}
    for i, token in enumerate(found):
        if token.tag in _CLOSED_TAGS:
            if token.closing:
                if open_at.get(token.tag):
                    ends[open_at[token.tag].pop()] = i
            elif not (token.tag in _SELF_CLOSED and token.self_closed):
                open_at.setdefault(token.tag, []).append(i)
    return ends


def unescape(text: str) -> str:
    """Character references decoded; numbers of any length, which the library's function rejects."""
    if "&" not in text:
        return text

    def short(m: re.Match) -> str:
        digits = (m[1] or m[2]).lstrip("0") or "0"
        return "\ufffd" if len(digits) > 7 else f"&#{'x' if m[2] else ''}{digits};"

    return references.unescape(_NUMBER.sub(short, text))


@dataclass
class Block:
    text: str
    in_main: bool
    in_bad: bool
    heading: bool
    n_chars: int
    link_share: float
    stop_share: float
    #: The article or main that it stands in, if all that makes it bad are names of what is around that one.
    wrapped: int | None = None
    #: Bad for another reason than a form or a name of a layout.
    firm: bool = False
    #: Bad by its tag, its role or because it is hidden.
    hard: bool = False


def _is_bad_name(token: str) -> bool:
    """True for a bad word, alone or with numbers, other bad words and plain words around it."""
    words = [w for w in re.split("[-_]+", token) if w]
    bad = [bool(BAD_NAMES.fullmatch(w)) for w in words]
    if words and bad[0] and words[-1].lower() == "content" and words[0].lower() != "sidebar":  # not a layout
        words, bad = words[:-1], bad[:-1]
    return any(bad) and all(b or w.isdigit() or w.lower() in PLAIN_NAMES for b, w in zip(bad, words, strict=True))


def _names_bad_part(tag: str, attributes: str, in_main: bool) -> str:
    """Why a tag opens a bad part: "kind" (its tag, role or hidden), "form", "firm" or "name" (its class or id), or ""."""
    if tag in BAD_CONTAINERS or (tag == "header" and not in_main):
        return "kind"
    why = "form" if tag in FORM_CONTAINERS else ""
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes and not attributes.isspace() else ():
        value, name = next((v for v in values if v), ""), name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "kind"
        if name == "role" and value.lower() in BAD_ROLES:
            return "kind"
        if name in ("class", "id") and tag not in ("html", "body", "article", "main") and not (name == "id" and _HEADING.fullmatch(tag)):
            bad = [w for w in value.split() if _is_bad_name(w)]
            if any(FIRM_NAMES.fullmatch(part) for w in bad for part in re.split("[-_]+", w)):
                why = "firm"
            elif not why and (bad or (not in_main and SITE_HEADERS.search(value))):
                why = "name"
    return why


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, with what the rules need to know of each."""
    found: list[Block] = []
    #: The open tags and why they open bad parts; the places of each tag's, and of all block-level ones.
    open_tags: list[tuple[str, str]] = []
    places: dict[str, list[int]] = {}
    open_blocks: list[int] = []
    pieces: list[str] = []
    in_main = in_link = n_main = 0
    bad_parts = {"": 0, "kind": 0, "form": 0, "firm": 0, "name": 0}
    #: Bad names open now are those around the innermost article or main (of each open one), with its number,
    #: and around the innermost main, which are none for what it holds.
    around, passed = [(0, 0)], [0]
    link_chars, heading = 0, False
    marks = tokens(page)
    ends = ends_of_skipped(marks)

    def named() -> int:
        return bad_parts["firm"] + bad_parts["name"]

    def close_block() -> None:
        nonlocal pieces, link_chars
        if not pieces:
            return
        raw, pieces, links, link_chars = "".join(pieces), [], link_chars, 0
        text = " ".join(unescape(raw).split())
        if text:
            words = text.lower().split()
            stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words)
            hard = bad_parts["kind"] > 0
            bad = hard or bad_parts["form"] > 0 or named() > passed[-1]
            wrapped = around[-1][1] if bad and in_main and not hard and not bad_parts["form"] and named() == around[-1][0] else None
            found.append(Block(text, in_main > 0, bad, heading, len(text), min(1.0, links / max(1, len(raw.strip()))), stops / len(words), wrapped, hard or bad_parts["firm"] > 0, hard))

    def leave(k: int) -> None:
        nonlocal in_main, in_link
        for tag, why in reversed(open_tags[k:]):
            places[tag].pop()
            if tag in BLOCK_TAGS:
                open_blocks.pop()
            if tag in MAIN_CONTAINERS:
                in_main -= 1
                around.pop()
            if tag == "main":
                passed.pop()
            bad_parts[why] -= 1
            in_link -= tag == "a"
        del open_tags[k:]

    at, i = 0, 0
    while i <= len(marks):
        token = marks[i] if i < len(marks) else None
        if text := page[at : token.start if token else len(page)]:
            pieces.append(text)
            link_chars += len(text.strip()) if in_link else 0
        if not token:
            break
        at, tag, i = token.end, token.tag, i + 1
        if not tag:
            continue
        if tag in BLOCK_TAGS:
            close_block()
        elif tag == "br":
            pieces.append(" ")
        if token.closing:
            k = places[tag][-1] if places.get(tag) else None
            if k is not None and (tag in BLOCK_TAGS or not open_blocks or open_blocks[-1] < k):
                leave(k)
        elif tag in _CLOSED_TAGS:  # whatever is inside is no text
            if (end := ends.get(i - 1)) is not None:
                at, i = marks[end].end, end + 1
        elif tag in SKIPPED_TAGS and tag != "head":
            pass  # raw text belongs to the token
        elif tag not in VOID_TAGS and not token.self_closed:
            if tag in BLOCK_TAGS and tag != "li" and open_blocks and open_tags[open_blocks[-1]][0] == "p":
                leave(open_blocks[-1])  # an open paragraph ends where a block begins
            why = _names_bad_part(tag, token.attributes, in_main > 0)
            places.setdefault(tag, []).append(len(open_tags))
            if tag in BLOCK_TAGS:
                open_blocks.append(len(open_tags))
            open_tags.append((tag, why))
            bad_parts[why] += 1
            if tag in MAIN_CONTAINERS:
                in_main, n_main = in_main + 1, n_main + 1
                around.append((named(), n_main))
            if tag == "main":
                passed.append(named())
            in_link += tag == "a"
        if tag in BLOCK_TAGS and not (heading and tag == "div"):  # inline tags and wrappers leave a heading one
            heading = bool(_HEADING.fullmatch(tag)) and not token.closing
    close_block()
    return found


def first_pass(block: Block, has_main: bool, known_language: bool = True) -> bool | None:
    """True good, False bad, None undecided."""
    if block.in_bad or (has_main and not block.in_main):
        return False
    if block.link_share > LINKS_MOST and not (block.in_main and block.heading):
        return False
    if block.in_main and (block.n_chars >= SHORT or block.heading):
        return True
    if block.n_chars < SHORT:
        return None
    if block.stop_share >= STOPS_HIGH or not known_language:
        return True
    return None if block.stop_share >= STOPS_LOW or block.link_share <= LINKS_FEW else False


def second_pass(page_blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided neighbours; blocks of menus, adverts
    and the like are no neighbours, as they are of another section.  A heading starts a section, so a block
    above one is no neighbour of what is below it; what then has none, but a menu or the like before it, is
    part of the page's head."""
    n = len(labels)
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    for order, side in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[bool, tuple[int, bool]] = {}
        for i in order:
            section = page_blocks[i].in_main
            side[i] = last.get(section)
            if labels[i] is not None and not page_blocks[i].in_bad:
                last[section] = (i, labels[i])
            if side is after and page_blocks[i].heading and not page_blocks[i].in_bad:
                last.pop(section, None)
    out, headed = [], False
    for i, label in enumerate(labels):
        headed |= page_blocks[i].hard
        if label is None:
            near = [x for x in (before[i], after[i]) if x]
            if near:
                label = min(near, key=lambda x: (abs(x[0] - i), not x[1]))[1]
            else:
                label = page_blocks[i].in_main or (page_blocks[i].stop_share >= STOPS_LOW and not headed)
        out.append(label)
    return out


def unwrap(found: list[Block]) -> None:
    """A named wrapper around the page's only article is not bad for what is in it.  With several, the
    wrapper is a list of teasers or comments, unless the page has no other text."""
    wrapped = [b for b in found if b.wrapped is not None]
    if wrapped and not any(b.in_main and not b.in_bad for b in found) and (len({b.wrapped for b in wrapped}) == 1 or not _good(found)):
        for block in wrapped:
            block.in_bad = False


def _holds_most(found: list[Block]) -> bool:
    """Whether article and main hold at least as much text as stands in long blocks elsewhere: short articles
    beside it are teasers."""
    inside = sum(b.n_chars for b in found if b.in_main and not b.in_bad)
    outside = sum(b.n_chars for b in found if not b.in_main and not b.in_bad and b.n_chars >= SHORT and b.link_share <= LINKS_FEW)
    return inside > 0 and inside >= outside


def _good(found: list[Block]) -> list[Block]:
    has_main = _holds_most(found)
    judged = found if has_main else [replace(b, in_main=False) for b in found]
    prose = [b for b in judged if not b.in_bad and b.n_chars >= SHORT and b.link_share <= LINKS_MOST]
    known = not prose or sum(b.stop_share * b.n_chars for b in prose) >= STOPS_LOW * sum(b.n_chars for b in prose)
    labels = [first_pass(b, has_main, known) for b in judged]
    linked = [b.link_share > LINKS_MOST for b in judged]
    for i, b in enumerate(judged):  # in the article a lone link is undecided, and links in a row are a list of them
        if linked[i] and b.in_main and not b.in_bad and not any(linked[max(0, i - 1) : i] + linked[i + 1 : i + 2]):
            labels[i] = None
    labels = second_pass(judged, labels)
    return [b for b, good in zip(found, labels, strict=True) if good]


def main_text(page: str | None) -> str:
    """The good blocks; if there are none, those of the passes without names and forms; if these find none
    either, all blocks that no tag, role or firm name makes bad and that are not mostly links."""
    found = blocks(page or "")
    unwrap(found)
    good = _good(found)
    if not good:
        for block in found:
            block.in_bad = block.firm
        good = _good(found) or [b for b in found if not b.in_bad and b.link_share <= LINKS_MOST]
    return "\n\n".join(b.text for b in good)


_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and main text of every page."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, htmls = (batch.column(k).to_pylist() for k in range(3))
            yield from chunked(((i, u, main_text(h)) for i, u, h in zip(ids, urls, htmls, strict=True)), _ARROW, 256)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, url string, text string")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
