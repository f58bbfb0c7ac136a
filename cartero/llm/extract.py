"""Main text of web pages: two passes of rules over blocks of text.

A page is cut into blocks: text between the start or end of block elements.  Character
references are decoded and white space becomes one space.  Of a block the rules know its
length, the share of its characters inside links, the share of its words that are stop
words, whether it is a heading, and where it stands: in which article element, and whether
in a container that is never part of an article (menus, headers, footers, sidebars, forms,
hidden elements, and elements whose class or id names an advert, a notice, comments...).

1. Every block by itself is bad (in such a container, or too many links), good (long, dense in
   stop words), near good (shorter) or short.  Near good blocks in a row that together are long
   are good, and so are all of a page that has no good one.  Where no block of a page is
   dense in stop words, its language has none in the list, and length and links decide alone.  Markup is
   evidence too: inside an article element a block that would be bad for want of stop words is
   undecided, as a short one.
2. A block that is short or near good gets the label of its nearest decided neighbours: both
   good, it is good; both bad, it is bad; else a near good one is good, a short one only if it
   is a heading before a good block, or if the block next to it on the bad side is
   near good.  The edges of a page count as bad; an article element's neighbours are its own
   blocks and its edges count as good.

Good blocks are joined in page order by a line feed.

Null and empty pages give an empty text; broken markup is read as far as it goes, and an element
that is never closed ends with the one around it.  Repeated rows are each extracted, null ids are
carried.  Extra columns are ignored unless carried; an empty table gives an empty result.  A page is held whole in one task.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import partial
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartero.llm.common import slices

SHORT, LONG = 70, 200  # characters
DENSE, SPARSE = 0.32, 0.20  # share of stop words of a good and of a near good block
LINKED, LINKED_INSIDE = 0.25, 0.75  # largest share of linked characters, outside and inside an article element
HEADING_REACH = 200  # characters between a heading and the good block it belongs to

STOP_WORDS = frozenset("""
the of and to in a is that it was for on with as by at from are this be or an have not he his but they which you we their
der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei
le la les de des et du un une en est que qui dans pour par sur au plus ne pas ce se il elle avec sont ou aux sa
el los las y del que en un una es por con no para su al lo como más o pero sus le ya este se ha
""".split())

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea template iframe noframes noembed object svg math canvas audio video".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre section
select summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}  # a start tag that ends open elements of these names up to the next list, table or container
KEEPS = frozenset("ul ol dl table select menu div section article main body html tr".split())
ASIDE = frozenset("nav footer aside menu button select dialog noscript header form".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
HINTS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner cookie
cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login signin menu
menus navbar nav navigation breadcrumb breadcrumbs sidebar sidebars widget widgets related recommended share sharing social footer header
masthead pagination pager toolbar copyright skip""".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
NEGATED = frozenset("has no with without".split())

_TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?([a-zA-Z][^\s/>]*)"""
                    r"""((?:[^"'>]*(?:"[^"]*"|'[^']*'))*[^"'>]*|[^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_WORD = re.compile(r"[^\W\d_]+")
_NOTHING, _FORM, _HEADER, _OTHER, _COMMENT = range(5)


@dataclass
class Block:
    """A block of text and what the rules know of it."""

    text: str
    linked: int
    article: int  # 0 outside of article elements
    barred: bool
    heading: bool
    label: str = ""


def _names(value: str) -> set[str]:
    return {w.lower() for w in _NAME.findall(value)}


def _bar(name: str, attributes: str, article: int, inherited: int) -> int:
    """Whether what an element holds can be part of an article."""
    if name == "main":
        return _NOTHING
    if name in ("html", "body"):
        return inherited
    own = _FORM if name == "form" else _HEADER if name == "header" and article else _OTHER if name in ASIDE else _NOTHING
    if attributes:
        found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
        names = _names(found.get("class", "")) | _names(found.get("id", ""))
        if names & COMMENTS and not names & NEGATED:
            return _COMMENT
        style = found.get("style", "").replace(" ", "").lower()
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
            own = _OTHER
        elif name != "article" and not names & NEGATED and (found.get("role", "").lower() in ROLES or names & HINTS):
            own = max(own, _HEADER if article and names & HINTS == {"header"} else _OTHER)
    if name == "article" and inherited == _FORM:
        inherited = _NOTHING  # a form around the whole page
    return max(own, inherited)


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in its order; without those that have no text."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, int, bool]] = []  # every open element, and bar, article, links, heading before it
    opened: Counter = Counter()  # names of open elements
    bar = article = links = articles = breaks = 0
    parts: list[tuple[str, bool]] = []
    heading = False
    lower = None

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join(unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = len(" ".join(unescape("".join(p for p, link in parts if link)).split()))
                out.append(Block(text, linked, article, bar != _NOTHING and not (bar == _HEADER and heading), heading))
            parts = []

    def leave(depth: int) -> None:
        nonlocal bar, article, links, heading
        _, bar, article, links, heading = stack[depth]
        opened.subtract(s[0] for s in stack[depth:])
        del stack[depth:]

    at = 0
    while at < len(html):
        token = _TOKEN.search(html, at)
        piece = html[at:token.start() if token else len(html)]
        if piece:
            parts.append((piece, links > 0))
            if not piece.isspace():
                breaks = 0
        if not token:
            break
        at = token.end()
        name = token.group(1)
        if name is None:
            continue
        name, closing = name.lower(), html[token.start() + 1] == "/"
        if name == "br":
            breaks += 1
            parts.append((" ", links > 0))
            if breaks > 1:
                flush()
            continue
        if name in BLOCK or name in RAW:
            flush()
            breaks = 0
        if closing:
            if opened[name] > 0:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        leave(i)
                        break
                    if name not in BLOCK and stack[i][0] in BLOCK:
                        break  # an inline end tag does not close blocks
            if name == "a":
                links = 0
            continue
        attributes = token.group(2)
        if name in RAW:
            if not attributes.endswith("/") or name in ("script", "style", "title", "textarea"):
                lower = html.lower() if lower is None else lower
                end = lower.find("</" + name, at)
                if end < 0 and name in ("script", "style", "title", "textarea"):
                    end = len(html)
                if end >= 0:
                    at = html.find(">", end) + 1 or len(html)
            continue
        if name in VOID or attributes.endswith("/") and name not in BLOCK and name != "a":
            continue
        ends = CLOSES.get(name) or ({"p", *HEADINGS} if name in BLOCK else None)
        if ends and any(opened[e] > 0 for e in ends):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    leave(i)
                    break
                if stack[i][0] in KEEPS or stack[i][0] in ASIDE:
                    break
        stack.append((name, bar, article, links, heading))
        opened[name] += 1
        if name == "a":
            links = 1
        if name in BLOCK or attributes:
            if name == "article":
                new = _bar(name, attributes, article, bar)
                if new == _NOTHING and not article:
                    articles += 1
                    article = articles
                bar = new
            else:
                new = _bar(name, attributes, article, bar)
                if new != bar and name not in BLOCK:
                    flush()
                bar = new
            heading = heading or name in HEADINGS
    flush()
    return out


def density(text: str) -> float:
    """The share of stop words among the words of a block."""
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def first_pass(blocks: list[Block]) -> None:
    """Label every block by itself: good, near, short or bad."""
    shares = [0.0 if b.barred else density(b.text) for b in blocks]
    foreign = not any(s >= DENSE and len(b.text) > SHORT for s, b in zip(shares, blocks))
    for b, share in zip(blocks, shares):
        n = len(b.text)
        if b.barred or b.linked / n > (LINKED_INSIDE if b.article else LINKED):
            b.label = "bad"
        elif not b.article and n < LONG and "©" in b.text:
            b.label = "bad"
        elif n < SHORT:
            b.label = "bad" if b.linked and not b.article else "short"
        elif share >= DENSE or foreign and not b.linked:
            b.label = "good" if n > LONG else "near"
        elif share >= SPARSE:
            b.label = "near"
        else:
            b.label = "short" if b.article else "bad"
    _together(blocks)


def _together(blocks: list[Block]) -> None:
    """Near good blocks that follow each other and together are as long as a good one are good; so are all of a page without good ones."""
    i = 0
    while i < len(blocks):
        z = i
        while z < len(blocks) and blocks[z].label in ("near", "short") and blocks[z].article == blocks[i].article:
            z += 1
        near = [b for b in blocks[i:z] if b.label == "near"]
        if sum(len(b.text) for b in near) > LONG:
            for b in near:
                b.label = "good"
        i = max(z, i + 1)
    if not any(b.label == "good" for b in blocks):
        for b in blocks:
            b.label = "good" if b.label == "near" else b.label


def second_pass(blocks: list[Block]) -> list[bool]:
    """Whether each block is part of the main text: undecided ones follow their nearest decided neighbours."""
    out = []
    for i, (b, (before, near_before), (after, near_after)) in enumerate(zip(blocks, _sides(blocks), _sides(blocks[::-1])[::-1])):
        if b.label in ("good", "bad"):
            good = b.label == "good"
        elif before == after:
            good = before
        elif b.label == "near":
            good = True
        else:
            good = near_after if before else near_before
            good = good or b.heading and after and _reaches(blocks, i)
        out.append(good)
    return out


def _sides(blocks: list[Block]) -> list[tuple[bool, bool]]:
    """For each block: whether the nearest decided one before it is good, and whether a near good one stands between."""
    out, home, good, near = [], -1, False, False
    for b in blocks:
        if b.article != home:
            home, good, near = b.article, b.article > 0, False
        out.append((good, near))
        if b.label == "good" or b.label == "bad" and not home:
            good, near = b.label == "good", False
        else:
            near |= b.label == "near"
    return out


def _reaches(blocks: list[Block], i: int) -> bool:
    """Whether a good block begins soon after heading ``i``."""
    passed = 0
    for b in blocks[i + 1:]:
        if b.label == "good" or passed > HEADING_REACH:
            return passed <= HEADING_REACH
        passed += len(b.text)
    return False


def main_text(html: str | None) -> str:
    """The main text of one page, one block a line."""
    blocks = blocks_of(html or "")
    first_pass(blocks)
    return "\n".join(b.text for b, good in zip(blocks, second_pass(blocks)) if good)


def _extract(carry, batches):
    for b in slices(batches, "html"):
        texts = pa.array([main_text(h) for h in b.column("html").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carry), texts], [*carry, "text"])


def extract(pages: DataFrame, carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(carried columns, text, n_chars): the main text of every page."""
    source = pages.select(*[F.col(c) for c in dict.fromkeys([*carry, "html"])])
    kept = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in carry)
    found = source.mapInArrow(partial(_extract, carry), kept + "text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
