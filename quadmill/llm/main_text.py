"""Main text of web pages by two passes over blocks.

The page is cut at block tags; scripts, styles, comments and form fields vanish. A block
knows its text, how much of it is in links and how many of its words are stop words. The
first pass classifies by these: blocks made of links are boilerplate, long blocks with
stop words are content, long ones without are boilerplate, and what is short, or a
heading, is ambiguous. In the second pass ambiguous blocks inherit the label of the nearest
decided neighbour; of two at equal distance, and at the ends of the page, boilerplate wins.

What a block stands in is one feature more. Containers that are named or tagged as menus,
headers, footers, sidebars, notices, adverts, forms or comments overrule prose, which
density can't tell from an article's, unless the container is a wrapper: one with all of
the page's articles in it, or where there is no article with all first headings, or where
there are none with most of the prose. Names of html, body, main and article say nothing,
and a header in an article is part of it. Inside an article or main part, blocks are judged
by density like others, but want of stop words makes them ambiguous rather than boilerplate,
and ambiguous blocks look for neighbours in the same article, where content wins.

Edge cases: null html is empty, and its text too; unclosed tags end with the page or
with the container around them; a page without any tag is one block; a page without any
decided block keeps its ambiguous ones; an empty table gives an empty result; repeated
rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_pieces, whole_texts

#: Frequent function words of the four languages.
STOP_WORDS = frozenset(
    """the of and to in is that it for was on are as with be by this at from or an have not they which you
    le la les de des du et un une en est que qui dans pour pas sur par au aux il elle avec ce se ne
    der die das und ist von zu den mit sich des auf für nicht ein eine als auch es an dem im er wird
    el los las y una del por con para su lo como más o sus al se no""".split()
)
#: Elements whose content is never text; a block goes on after them.
DROPPED = "script|style|noscript|template|svg|iframe|object|button|select|textarea|head"
BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul""".split()
)
BOILERPLATE_TAGS = frozenset("nav footer aside header menu dialog form".split())
CONTENT_TAGS = frozenset(("article", "main"))
#: Tags whose class, id and role are not looked at.
STRUCTURAL_TAGS = frozenset(("html", "body", "main", "article"))
#: Share of a page's prose by which a container is a wrapper.
WRAPPED = 0.8
#: Words of class, id and role that name boilerplate.
BOILERPLATE_NAMES = frozenset(
    """ad ads adv advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus
    footer header masthead menu nav navbar navigation newsletter notice notification popup promo related
    replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LINK_DENSITY = 0.5
LONG, SHORT = 140, 60
STOP_HIGH, STOP_LOW = 0.25, 0.12
GOOD, BAD, OPEN = 1, -1, 0

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({DROPPED})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    inside: int  # number of the container
    density: int = OPEN
    label: int = OPEN
    rule: str = ""  # what decided: links, density, container or neighbour


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    #: Of each container, the page itself being 0: the one around it, its tag, and whether it
    #: is named or tagged as boilerplate. Outer containers come before inner ones.
    around: list[int] = field(default_factory=lambda: [0])
    tags: list[str] = field(default_factory=lambda: [""])
    suspect: list[bool] = field(default_factory=lambda: [False])


def is_suspect(tag: str, attributes: str) -> bool:
    if tag in BOILERPLATE_TAGS:
        return True
    if tag in STRUCTURAL_TAGS or not attributes:
        return False
    values = ((found[1] or found[2] or found[3] or "").lower() for found in NAMES.finditer(attributes))
    return any(not BOILERPLATE_NAMES.isdisjoint(re.split(r"[^a-z0-9]+", v)) for v in values)


def blocks(html: str) -> Page:
    """The non-empty blocks of a page in their order, and its containers."""
    page = Page()
    stack: list[int] = [0]
    places: dict[str, list[int]] = defaultdict(list)  # of each tag, where it is on the stack
    parts: list[str] = []
    links: list[str] = []
    in_link = heading = False

    def end() -> None:
        nonlocal heading
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                linked = len(" ".join(entities.unescape("".join(links)).split()))
                page.blocks.append(Block(text, linked, heading, stack[-1]))
            parts.clear()
            links.clear()
        heading = False

    def close(depth: int) -> None:
        while len(stack) > depth:
            places[page.tags[stack.pop()]].pop()

    at = 0
    for token in TOKEN.finditer(html):
        if token.start() > at:
            parts.append(html[at : token.start()])
            if in_link:
                links.append(parts[-1])
        at = token.end()
        tag = (token[3] or "").lower()
        if not tag:
            if token[1] and token[1].lower() == "head":
                end()
            continue
        if tag == "a":
            in_link = not token[2]
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCKS:
            end()
            in_link = False
            if tag in VOID:
                continue
            if token[2]:
                if places[tag]:
                    close(places[tag][-1])
            else:
                if tag in ("p", "li", "td", "th", "dt", "dd", "tr") and page.tags[stack[-1]] == tag:
                    close(len(stack) - 1)  # their end tags may be left out
                page.around.append(stack[-1])
                page.tags.append(tag)
                page.suspect.append(is_suspect(tag, token[4] or ""))
                places[tag].append(len(stack))
                stack.append(len(page.tags) - 1)
                heading = tag[0] == "h" and tag[1:].isdigit()
    parts.append(html[at:])
    end()
    return page


def density(block: Block) -> int:
    """What length, links and stop words say."""
    size = len(block.text)
    if block.linked > LINK_DENSITY * size:
        return BAD
    if block.heading or size < SHORT:
        return OPEN
    words = WORD.findall(block.text.lower())
    share = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if share >= STOP_HIGH or size >= LONG and share >= STOP_LOW:
        return GOOD
    return BAD if share < STOP_LOW and (size >= LONG or block.linked) else OPEN


def containers(page: Page) -> tuple[list[bool], list[int]]:
    """Of each container: whether it, or one around it, is boilerplate; the article it is in, or 0."""
    n = len(page.tags)
    articles = [int(t in CONTENT_TAGS) for t in page.tags]
    firsts = [int(t == "h1") for t in page.tags]
    prose = [0] * n
    for b in page.blocks:
        prose[b.inside] += len(b.text) * (b.density == GOOD)
    for sums in (articles, firsts, prose):
        for c in range(n - 1, 0, -1):
            sums[page.around[c]] += sums[c]
    bad, home = [False] * n, [0] * n
    for c in range(1, n):
        up = page.around[c]
        home[c] = c if page.tags[c] in CONTENT_TAGS else home[up]
        if articles[0]:
            wrapper = articles[c] == articles[0]
        elif firsts[0]:
            wrapper = firsts[c] == firsts[0] and page.tags[c] != "header"
        else:
            wrapper = prose[c] > WRAPPED * prose[0]
        own = page.suspect[c] and not wrapper and not (page.tags[c] == "header" and home[up])
        bad[c] = bad[up] or own
    return bad, home


def first_pass(page: Page) -> list[int]:
    """Labels by density and container; returns the article of each block, or 0."""
    for b in page.blocks:
        b.density = density(b)
    bad, home = containers(page)
    for b in page.blocks:
        links = b.linked > LINK_DENSITY * len(b.text)
        if links or not bad[b.inside]:
            b.label = OPEN if b.density == BAD and not links and home[b.inside] else b.density
            b.rule = ("links" if links else "density") if b.label else ""
        else:
            b.label, b.rule = BAD, "container"
    return [home[b.inside] for b in page.blocks]


def second_pass(labels: list[int], headings: list[bool], inner: bool = False) -> list[int]:
    """Ambiguous blocks take the nearest decided label. Of two at equal distance, and at the
    ends, boilerplate wins; ``inner``, in an article, content does."""
    n, far, edge = len(labels), len(labels) + 1, GOOD if inner else BAD
    left, right = [(far, edge)] * n, [(far, edge)] * n
    for order, side in ((range(n), left), (range(n - 1, -1, -1), right)):
        distance, label = 0, edge
        for i in order:
            distance += 1
            if labels[i]:
                distance, label = 0, labels[i]
            side[i] = (distance, label)
    out = []
    for own, heading, (a, before), (b, after) in zip(labels, headings, left, right):
        if own:
            out.append(own)
        elif heading:
            out.append(after)  # a heading belongs to what follows
        else:
            out.append(before if a < b else after if b < a else (max if inner else min)(before, after))
    return out


def classified(html: str) -> list[Block]:
    """The blocks of a page with their labels and the rules that decided them."""
    found = blocks(html)
    homes = first_pass(found)
    apart = defaultdict(list)  # articles first by their own blocks, then the page by all
    for i, b in enumerate(found.blocks):
        if homes[i] and b.rule != "container":
            apart[homes[i]].append(b)
    for own, inner in [*((v, True) for v in apart.values()), (found.blocks, False)]:
        labels = [b.label for b in own]
        new = second_pass(labels, [b.heading for b in own], inner) if inner or any(b.rule != "container" and b.label for b in own) else [b.label or GOOD for b in own]
        for b, label in zip(own, new):
            if not b.label:
                b.label, b.rule = label, "neighbour"
    return found.blocks


def main_text(html: str | None) -> str:
    return "\n\n".join(b.text for b in classified(html or "") if b.label == GOOD)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in whole_texts(batches):
            texts = [main_text(h) for h in batch["_qm_text"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = text_pieces(pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html"), "html")
    out = rows.mapInPandas(each, "page_id string, url string, text string, n_chars bigint")
    return out.withColumn("page_id", F.col("page_id").cast("bigint"))
