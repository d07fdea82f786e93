"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import over_texts

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset("""
a an and are as at be but by for from has have he in is it its not of on or that the their they this to was were which will with you
au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous on ou par pas pour que qui sa se son sur un une vous
als auch auf aus bei das dem den der des die ein eine einen er es für hat ich im ist man mit nach nicht noch oder sich sie sind so und von war werden wie wir zu zum
al como con del el ella entre era es esta este fue ha hay la las lo los más muy no o para pero por porque que se sin sobre son su sus un una y ya
""".split())
# Elements that hold no text of their own, elements outside the main text, and elements that end a block.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
OUTSIDE = {"head", "nav", "footer", "aside", "button", "select", "template", "svg", "math", "object", "audio", "video", "canvas", "dialog", "menu", "map"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
          "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
          "th", "thead", "tr", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Names in class, id or role that mark what is seldom the main text; of these, names of readers' comments; and
# words that add nothing to such a name, so site-nav and comment-list are marks, has-comments and search-results-page are not.
MARKS = frozenset("""
ad ads advert advertisement advertorial adverts adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus gdpr login masthead menu modal nav
navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup
skip social sponsor sponsored subscribe teaser toolbar widget widgets complementary contentinfo search alert alertdialog
""".split())
THREADS = frozenset("comment comments disqus replies reply respond".split())
PLAIN = frozenset("area bar block bottom box container content form inner item items left link links list outer right section site top wrap wrapper".split())
TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
OTHER = re.compile(r"<[!?/][^>]*+>?")
SPACES = re.compile(r"\s+")
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Limits:
    """The thresholds of the block rules: lengths in characters, densities as shares."""

    short: int = 70
    long: int = 200
    low: float = 0.30
    high: float = 0.32
    links: float = 0.2


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    main: int  # 2 in a main element, 1 in an article only
    place: int

    @cached_property
    def density(self) -> float:
        """Share of stop words."""
        words = WORD.findall(self.text.lower())
        return sum(w in STOP_WORDS for w in words) / max(1, len(words))

    def label(self, limits: Limits, region: bool) -> str:
        """First pass: good, near, short or bad, from stop-word density, length and link density of the block.

        In a trusted main region a block starts as text, so only short links without stop words are bad and what the rules
        would leave out elsewhere stays open; outside it every block is bad.
        """
        size = len(self.text)
        links = self.linked / size
        if region and not self.main:
            return "bad"
        if region and (links > limits.links or size < limits.short):
            return "bad" if links > 0.5 and size < limits.short and self.density < limits.low and not self.heading else "short"
        if links > limits.links or size <= limits.long and "\xa9" in self.text and not region:
            return "bad"
        if size < limits.short:
            return "bad" if self.linked else "short"
        if self.density >= limits.high:
            return "good" if size > limits.long else "near"
        if self.density >= limits.low:
            return "near"
        return "short" if region else "bad"


def attributes(text: str) -> dict[str, str]:
    return {name.lower(): a or b or c or "" for name, a, b, c in ATTRIBUTE.findall(text)}


@dataclass
class Place:
    """A container that is marked as not the main text: the one around it, and what it holds."""

    parent: int
    thread: bool
    mains: int = 0
    regions: int = 0
    good: int = 0


def outside(name: str, attrs: dict[str, str], in_main: bool) -> bool:
    """Whether an element opens a part that is not main text."""
    if name in OUTSIDE or name == "header" and not in_main:
        return True
    if not attrs or name in ("html", "body"):
        return False
    return "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none", attrs.get("style", "").lower()))


def marked(name: str, attrs: dict[str, str], in_main: bool) -> frozenset[str]:
    """The words by which an element is marked as not the main text; a form is marked by itself."""
    if name in ("html", "body", "article", "main") or attrs.get("role", "").lower() == "main":
        return frozenset()
    known = MARKS if in_main else MARKS | {"header"}
    words = {"form"} if name == "form" else set()
    for label in f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".lower().split():
        parts = set(re.split(r"[^a-z0-9]+", label)) - {""}
        if parts <= known | PLAIN:
            words |= parts & known
    return frozenset(words)


def without_marked(blocks: Sequence[Block], places: Sequence[Place], limits: Limits) -> list[Block]:
    """The blocks but those in marked containers, unless a container holds the main text.

    It does if it holds a main element, most of the good text of the first pass, or all articles and no less good text than
    the rest; readers' comments only by a main element.
    """
    page, *more = places
    if not more:
        return list(blocks)
    for block in blocks:
        if block.label(limits, False) in ("good", "near"):
            places[block.place].good += len(block.text)
    for place in reversed(more):  # a container comes after the one around it
        around = places[place.parent]
        around.mains += place.mains
        if place.mains or not place.thread:  # comments say nothing of where the main text is
            around.regions, around.good = around.regions + place.regions, around.good + place.good
    left = [True]
    for place in more:
        holds = place.mains > 0 or not place.thread and (2 * place.good > page.good or place.regions == page.regions > 0 and 2 * place.good >= page.good)
        left.append(holds and left[place.parent])
    return [b for b in blocks if left[b.place]]


def blocks_of(page: str) -> tuple[list[Block], list[Place]]:
    """The blocks of a page in order, without what lies outside the main text, and the marked containers; the first is the page."""
    found: list[Block] = []
    places = [Place(0, False)]
    opened: list[tuple[str, bool, int, int]] = []  # name, skipped, main, marked container
    parts: list[str] = []
    state = {"linked": 0, "heading": False, "main": 0, "place": 0, "breaks": 0}
    where: dict[str, list[int]] = {}  # places of the open elements of a name
    block_places: list[int] = []  # places of the open elements that end a block
    skip = False
    main = link_depth = place = 0
    skipped_from = -1  # place of the element that opened the skipped part

    def flush() -> None:
        text = SPACES.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            found.append(Block(text, min(state["linked"], len(text)), state["heading"], state["main"], state["place"]))
        parts.clear()
        state.update(linked=0, heading=False, breaks=0)

    def add(text: str) -> None:
        if text and not skip:
            if not text.isspace():
                state.update(breaks=0, main=main, place=place)
            parts.append(text)
            if link_depth:
                state["linked"] += len(SPACES.sub(" ", html.unescape(text)).strip())

    def close(index: int) -> None:
        nonlocal skip, main, place, link_depth, skipped_from
        for name, *_ in opened[index:]:
            where[name].pop()
            link_depth -= name == "a"
        while block_places and block_places[-1] >= index:
            block_places.pop()
        if skipped_from >= index:
            skipped_from = -1
        del opened[index:]
        skip, main, place = opened[-1][1:] if opened else (False, 0, 0)

    at, size, last = 0, len(page), page.rfind(">")
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        add(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        tag = TAG.match(page, lt) if lt < last else None
        if not tag:
            if (lt + 1 < size and page[lt + 1] in "!?/") or (lt + 1 < size and page[lt + 1].isalpha() and lt > last):
                other = OTHER.match(page, lt)
                at = other.end() if other else size  # a cut-off tag at the end of the page
            else:
                add("<")
                at = lt + 1
            continue
        at, ending, name = tag.end(), tag.group(1), tag.group(2).lower()
        if name in RAW and not ending:
            if not tag.group(3).endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*+>?", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if name == "br":
            state["breaks"] += 1
            parts.append(" ")
            if state["breaks"] >= 2:
                flush()
            continue
        if name in BLOCKS:
            flush()
        if ending:
            index = where[name][-1] if where.get(name) else -1
            # a stray end tag does not leave a skipped part
            if index >= skipped_from >= 0 or index >= 0 and (skipped_from < 0 or name in ("body", "html", "article", "main", "div", "section")):
                if opened[index][3] != (opened[index - 1][3] if index else 0):
                    flush()
                close(index)
            continue
        if name in VOID or tag.group(3).endswith("/") and name not in BLOCKS:
            continue
        if name in BLOCKS:
            while block_places and opened[block_places[-1]][0] == "p":  # an open paragraph ends here, also inside inline elements
                close(block_places[-1])
        if name in ("li", "dt", "dd", "tr", "td", "th") and opened and opened[-1][0] == name:
            close(len(opened) - 1)
        attrs = attributes(tag.group(3)) if tag.group(3) else {}
        named_main = name == "main" or attrs.get("role", "").lower() == "main"
        skip = skip or outside(name, attrs, main)
        if not skip:
            if marks := marked(name, attrs, main):
                places.append(Place(place, bool(marks & THREADS)))
                place = len(places) - 1
                if name not in BLOCKS:
                    flush()
            places[place].mains += named_main
            places[place].regions += not main and (named_main or name == "article")
        main = 0 if skip else 2 if named_main else max(main, int(name == "article"))
        if skip and skipped_from < 0:
            skipped_from = len(opened)
        where.setdefault(name, []).append(len(opened))
        if name in BLOCKS:
            block_places.append(len(opened))
        opened.append((name, skip, main, place))
        link_depth += name == "a"
        if name in HEADINGS and not skip:
            state["heading"] = True
    flush()
    return found, places


def trusted_region(blocks: Sequence[Block], limits: Limits) -> bool:
    """Whether the page marks where its text lies: by a main element, or by articles that are more than a teaser.

    Articles that hold less than a short block in all, beside good text outside them, are teasers.
    """
    if any(b.main == 2 for b in blocks):
        return True
    inside = sum(len(b.text) for b in blocks if b.main)
    return inside >= limits.short or inside > 0 and not any(b.label(limits, False) == "good" for b in blocks if not b.main)


def classify(blocks: Sequence[Block], limits: Limits) -> list[bool]:
    """Second pass: open blocks take the label of their nearest decided neighbours.

    Between two good neighbours a block is good, between two bad ones bad; between a good and a bad one it is good if it is
    near-good, or a heading with the good one after it.  The ends of a page count as bad.  In a trusted main region the ends
    of the region count as good, and an open block beside a good one is good.
    """
    region = trusted_region(blocks, limits)
    edge = "good" if region else "bad"
    labels = [b.label(limits, region) for b in blocks]
    decided = [label if label in ("good", "bad") and (b.main or not region) else None for b, label in zip(blocks, labels)]
    before, nearest = [], edge
    for label in decided:
        before.append(nearest)
        nearest = label or nearest
    after, nearest = [], edge
    for label in reversed(decided):
        after.append(nearest)
        nearest = label or nearest
    after.reverse()
    lone = "good" not in labels and "near" in labels  # no long block at all: near-good ones are the text
    kept = []
    for block, label, left, right in zip(blocks, labels, before, after):
        if label in ("good", "bad"):
            kept.append(label == "good")
        elif left == right:
            kept.append(left == "good" or label == "near" and lone)
        else:
            kept.append(region or label == "near" or block.heading and right == "good")
    return kept


def extract_page(page: str, limits: Limits) -> str:
    """The main text of one whole page."""
    blocks = without_marked(*blocks_of(page), limits)
    return "\n".join(b.text for b, kept in zip(blocks, classify(blocks, limits)) if kept)


def extract_pages(df: DataFrame, keep: Sequence[str] = ("page_id", "url"), page: str = "html", limits: Limits = Limits()) -> DataFrame:
    """The main text of every whole page and its length in code points.

    Menus, headers, footers, sidebars and scripts are known by their elements; notices, adverts, reader comments and the like by
    names in class, id or role, and forms, are left out unless they hold the main text.  What is left is cut into blocks;
    stop-word density, length and link density decide the clear ones, and open ones follow their nearest decided neighbours.
    Where a page marks its main region (a main element, or articles that are more than a teaser), that is the prior: outside
    it blocks are bad, inside it blocks without evidence stay open and its ends count as good.

    NULL and empty pages, and pages without main text, give an empty text of length 0; unclosed elements, comments and
    references are read as browsers read them; a page takes time linear in its length; empty tables give no rows; repeated
    rows give repeated results; other columns are not read.
    """
    def work(pages: pa.Array) -> dict[str, object]:
        texts = [extract_page(p, limits) for p in pages.to_pylist()]
        return {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    return over_texts(df, keep, page, "text string, n_chars long", work)
