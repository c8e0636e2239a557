"""Main text of web pages by tag-path ratios.

All text blocks of a page are grouped by the path of tags that leads to them. Text length and
punctuation per block of a path are smoothed over the page, fused into one score per path, and
paths that score well below the best one are left out, but for blocks that stand among kept ones.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from asterloom.llm.chunks import arrow_schema, by_position

#: Share of the best path's score that a path needs, and weight of a path's own ratios against
#: the smoothed ones, inside an article and on pages without one.
INSIDE, ELSEWHERE = (0.03, 0.0), (0.25, 0.5)
#: Weights of the blocks around a block.
KERNEL = np.array([0.1, 0.2, 0.4, 0.2, 0.1])

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are text or lists and tables of it, not containers of other blocks.
TEXTUAL = HEADINGS | frozenset(
    "p ul ol menu li dl dt dd table caption colgroup thead tbody tfoot tr td th blockquote pre figure figcaption hgroup address details summary".split()
)
#: Elements that hold the whole page.
PAGE = frozenset(["", "html", "body"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no main text, whatever is in them.
SKIPPED = frozenset(
    "script style noscript template iframe object svg math canvas audio video button select textarea input head title".split()
)
#: What can stand in a head; anything else closes one that was left open.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements that are left out unless they turn out to wrap the main text.
MARKED = frozenset("nav header footer aside form dialog menu".split())
#: Classes, ids and roles that mark what is not the main text: a word, a word with what it is a part of, or with the part.
DISCUSSION = r"comments?|commentlist|disqus|repl(?:y|ies)|respond"
WORDS = (
    r"ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:tion)?s?|banners?|cookies?|consent|gdpr|notices?|alerts?|navs?|navbar|"
    r"navigation|menus?|sidebars?|aside|footers?|breadcrumbs?|pagination|pager|share|sharing|social|related|recommended|newsletter|subscribe|"
    r"subscription|signup|login|popup|modal|overlay|widgets?|search|" + DISCUSSION
)
PLACES = r"site|page|main|top|bottom|left|right|primary|secondary|global|mobile|desktop|blog|post|entry|article|user|reader|social|google|cookie"
PARTS = (
    r"area|bars?|banners?|box|buttons?|columns?|consent|container|form|icons?|inner|items?|links?|lists?|menu|modal|nav|navigation|notice|overlay|panel|"
    r"popup|posts?|articles?|stories|section|share|sidebar|signup|slots?|threads?|toggle|units?|widgets?|wrap|wrapper"
)
BOILERPLATE = re.compile(
    rf"(?:(?:{PLACES})-)?(?:{WORDS})(?:-(?:{PARTS}))?|(?:(?:site|page|main|top|global|mobile|desktop)-)?header|header-(?:bars?|banners?|links?|menu|nav)|"
    r"masthead|topbar|toolbar|contentinfo|complementary|skip-link",
    re.IGNORECASE,
)
TALK = re.compile(rf"(?:(?:{PLACES})-)?(?:{DISCUSSION})(?:-(?:{PARTS}))?", re.IGNORECASE)
TAG_BEGINS = re.compile("<[A-Za-z/!?]")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：·¿¡]")
#: What an opening tag closes: paragraphs end where a block begins, items where the next begins.
CLOSES_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}


@lru_cache(maxsize=10_000)
def marked(values: tuple[str, ...]) -> str:
    """Whether a class, id or role marks an element as "talk" or "other" boilerplate."""
    tokens = [re.sub("[_-]+", "-", x).strip("-") for v in values for x in v.split()]
    if any(TALK.fullmatch(x) for x in tokens):
        return "talk"
    return "other" if any(BOILERPLATE.fullmatch(x) for x in tokens) else ""


class Open(NamedTuple):
    """An open element: its tag, the number of its path, whether it is skipped and in an article, its
    element, the place of the innermost open block up to it, and how many links are open."""

    tag: str = ""
    path: int = 0
    skipped: bool = False
    inside: bool = False
    element: int = 0
    block: int = -1
    links: int = 0


NOTHING = Open()


class Blocks(HTMLParser):
    """The text blocks of a page: path, text, characters in links, whether in an article, element.

    Paths are numbers, each known by that of its parent and its last tag, and where open elements
    are is kept by tag, so every tag takes the same time however deep it stands.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[Open] = []
        self.places: dict[str, list[int]] = {}
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int, bool, int]] = []
        #: Unskipped block elements after the page itself: parent, tag, mark, whether in an article.
        self.elements: list[tuple[int, str, str, bool]] = [(0, "", "", False)]
        self.text: list[str] = []
        self.linked = 0

    def state(self) -> Open:
        return self.stack[-1] if self.stack else NOTHING

    def block_state(self) -> Open:
        at = self.state().block
        return self.stack[at] if at >= 0 else NOTHING

    def place(self, tags) -> int:
        """Where the innermost open element with one of the tags is, -1 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def flush(self):
        if self.text:
            value = " ".join("".join(self.text).split())
            block = self.block_state()
            if value and not block.skipped:
                self.blocks.append((block.path, value, self.linked, block.inside, block.element))
        self.text, self.linked = [], 0

    def pop_to(self, place: int):
        if self.state().block >= place:
            self.flush()
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()

    def close_head(self):
        if self.state().tag == "head":
            self.pop_to(len(self.stack) - 1)

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD:
            self.close_head()
        if tag not in INLINE:
            self.flush()
            if tag not in VOID and self.block_state().tag == "p":
                self.pop_to(self.state().block)
            if tag in CLOSES_SAME:
                same = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
                at = self.place(same)
                if at > self.place(CLOSES_SAME[tag]):
                    self.pop_to(at)
        if tag in VOID:
            return
        around = self.block_state() if tag in ("article", "main", "h1") else self.state()
        skipped, inside, element, path = around.skipped, around.inside, around.element, around.path
        mark = ""
        if not skipped:
            # The id of a heading names its subject.
            names = ("class", "role") if tag in HEADINGS else ("class", "id", "role")
            mark = "" if tag in ("html", "body", "article", "main") else marked(tuple(v for k, v in attrs if v and k in names))
            hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)
            skipped = tag in SKIPPED or hidden or bool(mark and tag in INLINE)
        block, links = self.state().block, self.state().links + (tag == "a")
        if tag not in INLINE:
            if not skipped:
                self.elements.append((element, tag, mark, inside))
                element = len(self.elements) - 1
            path = self.paths.setdefault((path, tag), len(self.paths) + 1)
            block = len(self.stack)
        inside = inside or tag in ("article", "main")
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(Open(tag, path, skipped, inside, element, block, links))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = self.place((tag,))
        if tag in INLINE:
            if at > self.state().block:
                self.pop_to(at)
        elif at >= 0:
            self.pop_to(at)
        else:
            self.flush()

    def handle_data(self, data):
        if data.strip():
            self.close_head()
        if not self.state().skipped:
            self.text.append(data)
            if self.state().links:
                self.linked += len(data.strip())


def unmarked(elements: list[tuple[int, str, str, bool]], blocks: list[tuple[int, str, int, bool, int]]) -> list[tuple[int, str, int, bool, int]]:
    """The blocks in no element that is left out by its name or mark.

    What wraps the main text is never left out: by mark, what has a main, a h1, the page's
    longest article or more than half of its text in it. Readers' comments need a main, a h1 or the only
    articles of the page; forms count as marked. Other elements left out by name need a main or, as headers
    in an article, a h1.
    """
    if not any(mark or tag in MARKED for _, tag, mark, _ in elements):
        return blocks
    n = len(elements)
    size, articles, headings, mains = [0] * n, [0] * n, [0] * n, [0] * n
    for block in blocks:
        size[block[4]] += len(block[1])
    for i in range(n - 1, 0, -1):
        parent, tag = elements[i][:2]
        articles[i] += tag == "article"
        headings[i] += tag == "h1"
        mains[i] += tag == "main"
        for count in (size, articles, headings, mains):
            count[parent] += count[i]
    longest, at = max(((size[i], -i) for i in range(1, n) if elements[i][1] == "article"), default=(0, 0))
    wraps = set()
    while at:
        wraps.add(-at)
        at = -elements[-at][0]
    out = [False] * n
    for i in range(1, n):
        parent, tag, mark, inside = elements[i]
        if tag in MARKED and tag != "form":
            left = not mains[i] and not (tag == "header" and inside and headings[i])
        elif mark == "talk":
            left = not mains[i] and not headings[i] and (inside or mains[0] > 0 or articles[i] < max(1, articles[0]))
        elif mark or tag == "form":
            left = not mains[i] and not headings[i] and i not in wraps and 2 * size[i] <= size[0]
        else:
            left = False
        out[i] = left or out[parent]
    return [b for b in blocks if not out[b[4]]]


def smoothed(values: np.ndarray) -> np.ndarray:
    half = len(KERNEL) // 2
    weight = np.convolve(np.ones(len(values)), KERNEL)[half:-half]
    return np.convolve(values, KERNEL)[half:-half] / weight


def chosen(elements: list[tuple[int, str, str, bool]], blocks: list[tuple[int, str, int, bool, int]]) -> list[str]:
    """The texts of the blocks whose paths are content, and of those that belong to them."""
    inside = np.array([b[3] for b in blocks])
    share, own = ELSEWHERE
    plain = np.array([max(0, len(b[1]) - b[2]) for b in blocks], float)
    if not plain.any():
        plain = np.array([len(b[1]) for b in blocks], float)
    restricted = bool(2 * plain[inside].sum() > plain.sum())
    if restricted:
        blocks, (share, own) = [b for b in blocks if b[3]], INSIDE
    names = {p: j for j, p in enumerate(dict.fromkeys(b[0] for b in blocks))}
    path = np.array([names[b[0]] for b in blocks])
    n = np.bincount(path)
    plain = np.array([max(0, len(b[1]) - b[2]) for b in blocks], float)
    marks = np.array([len(PUNCTUATION.findall(b[1])) for b in blocks], float)
    fused = np.ones(len(blocks))
    for values, least in ((plain, 0.0), (marks, 0.5)):
        ratio = (np.bincount(path, values) / n)[path] + least
        fused *= ratio**own * smoothed(ratio) ** (1 - own)
    score = np.bincount(path, fused) / n
    keep = (score >= share * score.max())[path]
    if not keep.all():
        keep = with_company(elements, blocks, keep.tolist(), restricted)
    return [b[1] for b, kept in zip(blocks, keep) if kept]


def with_company(elements: list[tuple[int, str, str, bool]], blocks: list[tuple[int, str, int, bool, int]], keep: list[bool], restricted: bool) -> list[bool]:
    """Which blocks to keep if those of ``keep`` are: short ones of the main text have poor paths, too.

    The root is the innermost container with more than half of the kept text. Kept as well are all blocks
    that are not mostly links in an article or in the root (if the root is the page: between kept blocks or in a
    container that has some), blocks of links between kept ones or in a container that has some (if that
    is the page: between its kept ones or under a heading), any h1, and headings of kept blocks.
    """
    n = len(elements)
    size = [0] * n
    for b, kept in zip(blocks, keep):
        size[b[4]] += len(b[1]) * kept
    for i in range(n - 1, 0, -1):
        size[elements[i][0]] += size[i]
    home, within = list(range(n)), [False] * n
    for i in range(1, n):
        if elements[i][1] in TEXTUAL:
            home[i] = home[elements[i][0]]
    root = home[max(i for i in range(n) if 2 * size[i] > size[0])]
    for i in range(n):
        within[i] = i == root or i > 0 and within[elements[i][0]]
    whole_page = elements[root][1] in PAGE
    homes = [home[b[4]] for b in blocks]
    ends: dict[int, tuple[int, int]] = {}
    for i, kept in enumerate(keep):
        if kept:
            ends[homes[i]] = (ends.get(homes[i], (i, i))[0], i)
    at = [i for i, b in enumerate(blocks) if keep[i] and within[b[4]]]
    linked = [2 * b[2] > len(b[1]) for b in blocks]
    out = list(keep)
    for i, b in enumerate(blocks):
        if not linked[i]:
            near = within[b[4]] and (not whole_page or at[0] < i < at[-1] or homes[i] in ends)
            out[i] = out[i] or restricted or near or elements[b[4]][1] == "h1"
    company = {homes[i] for i, kept in enumerate(out) if kept}
    headed = -1
    for i, b in enumerate(blocks):
        if not linked[i] or homes[i] != headed:
            headed = homes[i] if out[i] and elements[b[4]][1] in HEADINGS else -1
        if linked[i] and not out[i]:
            between = within[b[4]] and at[0] < i < at[-1] and (restricted or not whole_page)
            if elements[homes[i]][1] in PAGE:
                near = homes[i] in ends and (ends[homes[i]][0] < i < ends[homes[i]][1] or headed >= 0)
            else:
                near = homes[i] in company
            out[i] = between or near or elements[b[4]][1] == "h1"
    for i in range(len(blocks) - 2, -1, -1):
        if elements[blocks[i][4]][1] in HEADINGS:
            out[i] = out[i] or out[i + 1]
    return out


def without_open_end(html: str) -> str:
    """The page without a comment or tag that is begun and never ends.

    Nothing behind the beginning of either is text. The parser would look for the end of each such
    beginning through the whole rest of the page.
    """
    unclosed = html.find("<!--", html.rfind("-->") + 1)
    html = html[:unclosed] if unclosed >= 0 else html
    begun = TAG_BEGINS.search(html, html.rfind(">") + 1)
    return html[: begun.start()] if begun else html


def main_text(html: str) -> str:
    """The main text of one page, blocks joined by one space; empty if there is none."""
    parser = Blocks()
    parser.feed(without_open_end(html))
    parser.close()
    parser.flush()
    blocks = unmarked(parser.elements, parser.blocks)
    return " ".join(chosen(parser.elements, blocks)) if blocks else ""


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """The pages with ``text`` and ``n_chars`` (code points) in place of the html.

    Menus, headers, footers, side columns, notices, adverts, forms, scripts, styles and reader
    comments are left out by element and by whole words of class, id and role, but not if they wrap
    the main text (see ``unmarked``); of the rest, blocks are chosen by their
    path's score; headings, lists, tables and other short blocks of the main text stay with it (see
    ``with_company``). If articles and mains hold most of its text (without links), only blocks
    in them are considered.
    Character references are decoded, white space in a block becomes one space, and blocks are
    joined by one space in page order. Null and empty pages, and pages without text, have an
    empty text; repeated rows stay; an empty table gives an empty table.
    """
    frame, names = by_position(pages)
    here = names.index(html)
    keep = [j for j in range(len(names)) if j != here]
    fields = [*[frame.schema.fields[j] for j in keep], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    out = arrow_schema(fields)

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), 200):
                batch = whole.slice(at, 200)
                texts = [main_text(x) if x else "" for x in batch.column(here).to_pylist()]
                columns = [*[batch.column(j) for j in keep], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    done = frame.mapInArrow(run, T.StructType(fields))
    return done.toDF(*[names[j] for j in keep], "text", "n_chars")
