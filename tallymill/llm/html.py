"""Main text of web pages: the contiguous region with the highest score.

A page is read as a sequence of tags and texts. A word scores positive, a tag negative,
with weights that are log odds of standing in the article, counted over pages that label it
by an ``article`` or ``main`` element. Words inside elements that are no article by their
name, role or class (menus, forms, adverts, comments) score negative, or nothing within an
article. One scan finds the
region with the highest sum; its texts outside of such elements, block by block, are the
main text.

An element around the article is not set aside, whatever it is called: a form around the
whole page, a layout class, a menu that is never closed. The article is the labelled element
with the most words of its own, comments apart; labelled elements in something set aside
(teasers of related pages) are taken for it only if no other labelled element, and not most of the
unlabelled text, stands free. Without an article a class or id alone, or being a form, does not set aside
an element with most of the page's words.

Cases: null or empty html, and pages without a word that scores, give the empty text.
Of regions with the same score the first is taken. Unclosed and crossed elements end with
the element around them. Pages of any length are read whole. Repeated rows are each
answered; further columns are ignored. With no labelled page the default weights hold.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import hash_share, per_batch, texts

# Names of elements, and words of their roles, classes and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe textarea object audio video canvas math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s"
    " samp small span strike strong sub sup time tt u var wbr".split()
)
ASIDE = frozenset("head nav header footer aside form button select dialog menu fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie"
    " cookies consent disqus footer header masthead menu modal nav navbar navigation newsletter notice notices"
    " pagination popup promo promoted promotion recommended related replies reply respond share sharing sidebar"
    " signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
LAYOUT_WORDS = frozenset(
    "area bar block body bottom box button buttons column container content group holder inner item label left link"
    " links list main outer panel right row section slot space text title top unit wrap wrapper zone".split()
)
CONTAINERS = frozenset("div section ul ol dl span center ins".split())
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
FORMS = frozenset("form fieldset".split())
HEADER_WORDS = frozenset("header masthead".split())
STATE_BEGINS, STATE_ENDS = frozenset("has no with without".split()), frozenset("closed open".split())
CLOSED_BY = {"p": frozenset("p h1 h2 h3 h4 h5 h6 ul ol div table section article footer header nav aside form".split()), "li": frozenset(["li"])}
LABEL = frozenset(["article", "main"])
#: The border of a labelled element weighs as much as so many words.
BORDER_WORDS = 20

MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>?", re.DOTALL
)
ATTRIBUTE = re.compile(r"\b(role|class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(frozen=True)
class Weights:
    """Scores: of a word, of a word set aside, of tags by name (ends begin with /), of any other tag."""

    word: float = 3.0
    aside: float = -3.0
    tags: dict[str, float] = field(default_factory=dict)
    other: float = -1.0
    border: float = -60.0


@dataclass
class Element:
    name: str
    up: Element | None  # None for the page
    aside: str = ""  # what sets it aside: "name" (or role), "word" (or being a form), or nothing
    inner: bool = False  # an article or main element is open
    comments: bool = False  # within comments, and no main element since
    hidden: bool = False  # it or an element around it is set aside
    owner: Element | None = None  # the labelled element, or page, whose own words stand here
    words: int = 0
    own: int = 0  # without those of further labelled elements and of what is set aside


@dataclass
class Piece:
    text: str | None  # None for a tag
    tag: str = ""
    aside: bool = False
    inner: bool = False  # an article or main element is open
    nested: bool = False  # begin of the article, within another labelled element


def set_aside(name: str, attributes: str, inside: bool) -> tuple[str, bool]:
    """What sets the element aside, as in ``Element``, and whether it is comments.

    ``inside``: an article is open. Classes that tell a state (has-sidebar, comments-open) are no kind.
    Within an article only a container is set aside by a class or id, and only by one that says
    nothing else: adBox is an advert, share-prices or ad-hoc-committee tell of the story.
    """
    words: set[str] = set()
    role = False
    for m in ATTRIBUTE.finditer(attributes) if attributes else ():
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role":
            role |= value.strip().lower() in ASIDE_ROLES
            continue
        for part in value.split():
            found = [x for x in re.split(r"[^a-z]+", CAMEL.sub(" ", part).lower()) if x]
            if inside and not (name in CONTAINERS and all(x in ASIDE_WORDS or x in LAYOUT_WORDS for x in found)):
                continue
            if found and found[0] not in STATE_BEGINS and found[-1] not in STATE_ENDS:
                words.update(found)
    if name in ("html", "body", "main"):
        return "", False
    comments = not words.isdisjoint(COMMENT_WORDS)
    if name == "article":
        return "", comments
    if name in ASIDE:
        return "" if inside and name == "header" else "word" if name in FORMS else "name", comments
    if role:
        return "name", comments
    if inside:
        words -= HEADER_WORDS
    return "" if words.isdisjoint(ASIDE_WORDS) else "word", comments


def _article(elements: list[Element]) -> Element | None:
    """The labelled element with the most own words, the first of equals; None if there is none."""
    page, labelled, free = elements[0], [], 0
    around: dict[int, int] = {id(page): 0}  # labelled elements with own words that stand free, at or around each
    for e in elements[1:]:
        before = around[id(e.up)]
        counts = e.name in LABEL and e.own > 0 and not e.comments
        if counts:
            labelled.append((e, before))
        around[id(e)] = before + (counts and not e.hidden)
        free += counts and not e.hidden
    found = max((e for e, before in labelled if not e.hidden or free == before), key=lambda e: e.own, default=None)
    return None if found is None or found.hidden and found.own <= page.own else found


def _lift(elements: list[Element]) -> Element | None:
    """Take back what sets aside the article or most of the page's words; the article."""
    page, article = elements[0], _article(elements)
    if article:
        around = article.up
        while around:
            around.aside = ""
            around = around.up
    else:
        for e in elements:
            if e.aside == "word" and not e.comments and 2 * e.words > page.words:
                e.aside = ""
    for e in elements[1:]:
        e.hidden = e.up.hidden or bool(e.aside)
    return article


def _parsed(page: str) -> tuple[list[tuple[str | None, str, Element]], list[Element]]:
    """Texts and tags in page order with the element they stand in, and the elements, the page first.

    Raw elements and markup declarations are left out.
    """
    root = Element("", None)
    root.owner = root
    found, elements, opened = [], [root], [root]
    names: Counter = Counter()  # of the open elements, so that a stray end tag is known without a search
    at = words = 0
    length = len(page)

    def close(depth: int) -> None:
        for e in opened[depth:]:
            e.words = words - e.words
            names[e.name] -= 1
        del opened[depth:]

    while at < length:
        mark = MARK.search(page, at)
        if mark is None or mark.start() > at:
            end = mark.start() if mark else length
            text, top = html.unescape(page[at:end]), opened[-1]
            n = len(text.split())
            words += n
            if top.owner:
                top.owner.own += n
            found.append((text, "", top))
            at = end
            if mark is None:
                break
        at = mark.end()
        name = (mark[2] or "").lower()
        if not name:
            continue
        if mark[1]:
            if names[name] > 0:  # what the search passes is closed
                close(next(i for i in range(len(opened) - 1, 0, -1) if opened[i].name == name))
            found.append((None, f"/{name}", opened[-1]))
            continue
        if name in RAW and not mark[3].rstrip().endswith("/"):
            ending = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = ending.end() if ending else length
            continue
        if name == "title":
            ending = re.compile(r"</title\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = ending.end() if ending else at
            continue
        # a body ends the head; a block ends an open paragraph, an item the item before
        while name == "body" and opened[-1].name == "head" or name in CLOSED_BY.get(opened[-1].name, ()):
            close(len(opened) - 1)
        if name not in VOID:
            up = opened[-1]
            aside, comments = set_aside(name, mark[3], up.inner)
            e = Element(name, up, aside, up.inner or name in LABEL, name != "main" and (up.comments or comments))
            e.hidden, e.words = up.hidden or bool(aside), words
            e.owner = e if name in LABEL else None if aside else up.owner
            elements.append(e)
            opened.append(e)
            names[name] += 1
        found.append((None, name, opened[-1]))
    close(0)
    return found, elements


def pieces(page: str) -> Iterator[Piece]:
    """Tags and texts in page order; raw elements and markup declarations are left out."""
    found, elements = _parsed(page)
    article = _lift(elements)
    begun = article is None or not article.up.inner
    for text, tag, e in found:
        nested = not begun and e is article
        begun |= nested
        yield Piece(text, tag, e.hidden, e.inner, nested)


def _score(piece: Piece, weights: Weights) -> float:
    if piece.aside and piece.inner:
        return 0.0  # an advert or a comment within the article does not divide it
    if piece.text is not None:
        return len(piece.text.split()) * (weights.aside if piece.aside else weights.word)
    if piece.nested:
        return weights.other  # a heading before it belongs to it
    if piece.tag.lstrip("/") in LABEL:
        return weights.border
    return weights.tags.get(piece.tag, weights.other)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous part with the highest positive sum, the first of equals."""
    best, begin, end = 0.0, 0, 0
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0.0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, begin, end = total, start, i + 1
    return begin, end


def main_text(page: str, weights: Weights) -> str:
    found = list(pieces(page))
    begin, end = best_region([_score(p, weights) for p in found])
    blocks, block = [], []
    for piece in found[begin:end]:
        if piece.text is not None:
            if not piece.aside:
                block.append(piece.text)
        elif piece.tag == "br":
            block.append(" ")
        elif piece.tag.lstrip("/") not in INLINE:
            blocks.append(block)
            block = []
    lines = (" ".join("".join(b).split()) for b in [*blocks, block])
    return "\n".join(x for x in lines if x)


def _counts(page: str) -> Counter:
    """How often a word and each tag stands inside and outside of the labelled element; empty if none or many are labelled."""
    found = list(pieces(page))
    borders = [i for i, p in enumerate(found) if p.tag.lstrip("/") in LABEL]
    if len(borders) != 2 or found[borders[1]].tag != "/" + found[borders[0]].tag:
        return Counter()
    counts: Counter = Counter()
    for i, piece in enumerate(found):
        inside = borders[0] < i < borders[1]
        if piece.text is not None:
            counts["", inside] += len(piece.text.split())
        elif i not in borders:
            counts[piece.tag, inside] += 1
    return counts


def learn(pages: DataFrame, sample: int = 4_000, least_seen: int = 5) -> Weights:
    """Weights from about ``sample`` pages, picked by a hash of the id, of all tags that these have ``least_seen`` times."""
    total = pages.count()
    if not total:
        return Weights()

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = sum((_counts(x) for x in texts(batch, "html")), Counter())
        names, sides = zip(*counts) if counts else ((), ())
        columns = [pa.array(names, pa.string()), pa.array(sides, pa.bool_()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["tag", "inside", "n"])

    picked = pages.where(hash_share(F.col("page_id"), sample / total)).select("html")
    counts = per_batch(picked, counted, "tag string, inside boolean, n long")
    sides = counts.groupBy("tag").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("within"),
        F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("without"),
    )
    rows = sides.where((F.col("tag") == "") | (F.col("within") + F.col("without") >= least_seen)).collect()
    odds = {r["tag"]: math.log((r["within"] + 1) / (r["without"] + 1)) for r in rows}
    if "" not in odds:
        return Weights()
    word = min(6.0, max(0.5, odds.pop("")))
    return Weights(word, -word, {k: max(-2 * word, min(-0.05, v)) for k, v in odds.items()}, -word / 2, -BORDER_WORDS * word)


SCHEMA = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html). No shuffle."""

    def extracted(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(x, weights) for x in texts(batch, "html")]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(map(len, found), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return per_batch(pages.select("page_id", "url", "html"), extracted, SCHEMA)
