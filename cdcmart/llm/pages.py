"""Main text of web pages by consensus of their host.

Every page scores its containers by the text they hold outside links and boilerplate and votes for the generalised
tag-class path of the best one. Spark adds the votes by host and path. Each page is then extracted again from its
containers on the winning path of its host, all of them; a page that lacks the path goes by its own best one. So a page
whose own scores mislead (a short article beside long comments) follows the layout of its site.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import map_batches, stored

# Most hosts whose winning path is sent to all executors; more are joined by shuffle.
BROADCAST_HOSTS = 500_000

# Elements whose content is no text of the page. An open script or style goes on to the end, the others do not.
RAW = "script|style|noscript|template|textarea|iframe|svg|title"
ATTRIBUTES = r"""(?:[^\s"'>=]++|=\s*+(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*+)?|["']|\s++)*+"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:{ATTRIBUTES})>.*?</\1\s*>|<(?:script|style)\b(?:{ATTRIBUTES})>.*\Z"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTES})>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"[0-9]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article main section div body td blockquote html".split())
ARTICLES = frozenset(("article", "main"))
# Start tags that end an open element of their own kind.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Controls hold a few words and no blocks: the next block ends one that was left open.
CONTROLS = ("button", "select", "label")
BOILER_TAGS = frozenset(("nav", "footer", "aside", "dialog", "menu", *CONTROLS))
COMMENT_WORDS = frozenset("comment comments disqus reply replies discussion".split())
BOILER_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice notices alert popup modal "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended share "
    "sharing social newsletter subscribe subscription signup login search "
    "pagination pager toolbar skip complementary contentinfo cookiebar cookiebanner adbanner teaser teasers".split()
)
# Words around a name of boilerplate that say what an element has, lacks or belongs to, not what it is.
BEFORE = frozenset("has with without no is layout category tag type format in".split())
BEHIND = frozenset("open opened closed enabled disabled on off allowed".split())
# The header of an article belongs to it.
HEADERS, OWN_HEADER = frozenset(("header", "masthead")), frozenset(("article", "entry", "post", "content", "story"))

# Why an element may be boilerplate: for its tag; by a name of its own, or of comments; by a word in a longer name; as a
# form or a header, which some pages put around everything.
TAG, COMMENTS, NAME, WORD, FORM = "tag", "comments", "name", "word", "form"


class Element(NamedTuple):
    """``path`` is a hash of the generalised tags and classes down to the element. ``container`` is the nearest
    container, ``article`` the nearest article or main part, counted from the element itself; 0 if there is none."""

    parent: int
    tag: str
    path: str
    doubt: str
    container: int
    article: int


class Block(NamedTuple):
    element: int
    text: str
    in_links: int


def _names(attributes: str) -> list[str]:
    return [n for m in NAMES.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").lower().split()]


def _doubt(tag: str, attributes: str, in_article: bool) -> str:
    """Why an element may be boilerplate, "" if nothing says so."""
    if tag in BOILER_TAGS:
        return TAG
    if tag == "form" or (tag == "header" and not in_article):
        return FORM
    if tag in ("body", "html", "main"):
        return ""
    names = _names(attributes)
    split = [[w for w in re.split(r"[^a-z0-9]+", n) if w] for n in names]
    own = any(w in OWN_HEADER for words in split for w in words)
    found = ""
    for name, words in zip(names, split):
        for k, word in enumerate(words):
            if word not in BOILER_WORDS or (own and word in HEADERS):
                continue
            if (k and words[k - 1] in BEFORE) or (k + 1 < len(words) and words[k + 1] in BEHIND):
                continue
            if len(words) == 1:
                return COMMENTS if word in COMMENT_WORDS else NAME
            # An article may be called after what belongs to it.
            if tag != "article":
                found = COMMENTS if word in COMMENT_WORDS else found or WORD
    return found


def _classes(attributes: str) -> str:
    """Classes with numbers generalised, as part of a path."""
    m = CLASS.search(attributes)
    return "".join(f".{DIGITS.sub('0', c)}" for c in sorted((m[1] or m[2] or m[3] or "").lower().split())) if m else ""


def parse(page: str) -> tuple[list[Element], list[Block]]:
    """Elements with their generalised paths, and the blocks of text in page order. Open elements are ended as
    browsers do in the usual cases: a block ends an open paragraph or control, an end tag ends what it encloses. Time
    and memory grow with the page, however deep it is."""
    elements = [Element(-1, "", "", "", 0, 0)]
    blocks: list[Block] = []
    stack = [0]
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            # References are decoded before white space is folded, so that encoded spaces count as such.
            whole = SPACE.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                blocks.append(Block(stack[-1], whole, linked))
            text.clear()
        linked = 0

    def close(tags: tuple[str, ...], within: frozenset[str]) -> None:
        """End the nearest open element of ``tags`` unless one of ``within`` lies nearer."""
        if not any(opened[t] for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            tag = elements[stack[k]].tag
            if tag in tags:
                flush()
                opened.subtract(elements[e].tag for e in stack[k:])
                del stack[k:]
                return
            if tag in within:
                return

    def said(part: str) -> None:
        nonlocal linked
        if part:
            text.append(part)
            if in_link:
                linked += len(part)

    at = 0
    for m in TOKEN.finditer(page):
        said(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        known = tag in BLOCKS or tag in BOILER_TAGS
        if m[2]:
            if tag == "a":
                in_link = 0
            if known:
                # Controls are ended by their own end tags only from inside.
                close((tag,), CONTAINERS if tag in CONTROLS else frozenset())
            continue
        if tag == "br":
            text.append(" ")
        if tag == "a":
            in_link = 1
        if not known:
            continue
        flush()
        if tag in BLOCKS:
            close(CONTROLS, CONTAINERS)
            close(("p",), CONTAINERS)
        if tag in CLOSES:
            close(CLOSES[tag], frozenset(("ul", "ol", "dl", "table")))
        if tag in VOID:
            continue
        up, here = elements[stack[-1]], len(elements)
        path = xxhash.xxh3_64_hexdigest(f"{up.path}/{tag}{_classes(m[4])}")
        container = here if tag in CONTAINERS else up.container
        article = here if tag in ARTICLES else up.article
        elements.append(Element(stack[-1], tag, path, _doubt(tag, m[4], up.article > 0), container, article))
        stack.append(here)
        opened[tag] += 1
    said(page[at:])
    flush()
    return elements, blocks


def boilerplate(elements: list[Element], blocks: list[Block], sure_only: bool = False) -> list[bool]:
    """Which elements are boilerplate, or lie in some. A name or a form counts as far as the element does not hold the
    page itself: more than half of the text outside links, and a heading, an article or a main part too where the name
    is its own. Comments are comments, however long. With ``sure_only``, forms and words in longer names do not count."""
    n = len(elements)
    held, main = [0] * n, [False] * n
    for b in blocks:
        held[b.element] += max(len(b.text) - 2 * b.in_links, 0)
    dropped = [0] * n
    for k in range(n - 1, 0, -1):
        e = elements[k]
        if e.doubt == TAG:
            dropped[0] += held[k]
            continue
        held[e.parent] += held[k]
        main[e.parent] = main[e.parent] or main[k] or e.tag in ("h1", "article", "main")
    out = [False] * n
    for k in range(1, n):
        e = elements[k]
        most = 2 * held[k] > held[0]
        if e.doubt == TAG:
            own = True
        elif e.doubt == COMMENTS:
            own = True
        elif e.doubt == NAME:
            own = not (most and main[k])
        else:
            own = not sure_only and e.doubt in (WORD, FORM) and not most
        out[k] = own or out[e.parent]
    return out


def scores(elements: list[Element], blocks: list[Block], boiler: list[bool]) -> dict[int, float]:
    """Text outside links that each container holds: all of what stands directly in it or in its paragraphs, half of
    what its inner containers hold directly. Articles and main parts count all that they hold, half as much again."""
    found: dict[int, float] = {}
    for block in blocks:
        e = elements[block.element]
        whole = weight = float(max(len(block.text) - 2 * block.in_links, 0))
        if boiler[block.element] or whole < 1:
            continue
        if e.article:
            found[e.article] = found.get(e.article, 0.0) + whole * 1.5
        at = e.container
        while at > 0 and at != e.article and weight >= 1:
            found[at] = found.get(at, 0.0) + weight
            weight /= 2
            at = elements[elements[at].parent].container
    return found


def best(found: dict[int, float]) -> int:
    return max(found, key=lambda e: (found[e], -e)) if found else 0


def text_of(elements: list[Element], blocks: list[Block], boiler: list[bool], containers: set[int]) -> str:
    """Blocks inside ``containers`` (0: the page) outside boilerplate, in page order, one a line."""
    inside = [k in containers for k in range(len(elements))]
    for k in range(1, len(elements)):
        inside[k] = inside[k] or inside[elements[k].parent]
    return "\n".join(b.text for b in blocks if inside[b.element] and not boiler[b.element])


def vote(page: str) -> tuple[str, float]:
    elements, blocks = parse(page)
    found = scores(elements, blocks, boilerplate(elements, blocks))
    top = best(found)
    return elements[top].path, math.log1p(found.get(top, 0.0))


def extract(page: str, path: str | None) -> str:
    elements, blocks = parse(page)
    for sure_only in (False, True):
        boiler = boilerplate(elements, blocks, sure_only)
        found = scores(elements, blocks, boiler)
        if not any(elements[e].path == path for e in found):
            path = elements[best(found)].path
        parts = {e for e in found if elements[e].path == path}
        # Sections and articles beside a part belong to the same text, whatever their classes.
        beside = {(elements[e].parent, elements[e].tag) for e in parts if elements[e].tag in ("section", "article")}
        parts |= {e for e in found if (elements[e].parent, elements[e].tag) in beside}
        text = text_of(elements, blocks, boiler, parts or {0})
        # A page that calls everything after what lies beside it is taken again by tags and plain names.
        if text:
            break
    return text


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` per row of ``pages``.

    A NULL or empty page gives the empty text. Pages without a readable host, NULL urls included, vote together.
    Repeated rows and NULL keys give a row each; other columns are not read. Equal votes go to the lesser path.
    """
    host = F.lower(F.coalesce(F.try_parse_url(F.col(f"`{url_col}`").cast("string"), F.lit("HOST")), F.lit("")))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"), host.alias("host"))

    def voting():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            votes = [vote(p or "") for p in batch.column("html").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("host"), pa.array([p for p, _ in votes], pa.string()), pa.array([w for _, w in votes], pa.float64())], ["host", "path", "weight"])

        return step

    def extracting():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [extract(p or "", w) for p, w in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

        return step

    votes = map_batches(rows.select("host", "html"), voting, "host string, path string, weight double").where("path <> ''")
    # Votes are rounded so that the order of adding cannot change the winner.
    totals = votes.groupBy("host", "path").agg(F.sum(F.round(F.col("weight") * 1000).cast("long")).alias("votes"))
    winners = totals.groupBy("host").agg(F.min_by("path", F.struct((-F.col("votes")).alias("v"), "path")).alias("path"))
    winners = stored(winners, "host_paths")
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    again = rows.join(winners, "host", "left").select("id", "url", "html", "path")
    out = map_batches(again, extracting, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars bigint")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
