"""Text blocks of a page and the element subtrees that hold them."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass
from itertools import accumulate

import xxhash

#: Elements without an end tag; elements whose content is not markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option "
    "p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Never part of the main text.
DROPPED = frozenset(
    "script style textarea title iframe noscript xmp noembed noframes head template nav footer aside form button "
    "select svg math object canvas dialog menu audio video map search datalist".split()
)
#: What inside an article can be a template of its own: what holds others, no heading, paragraph or item.
CONTAINERS = frozenset("aside center details dir div dl fieldset figure ol section table ul".split())
#: Words of a class, an id or a role that mark what is around the main text.
AROUND = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promotion "
    "banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar side sidenav rail footer foot masthead "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login search form comment comments commentlist disqus discussion respond reply replies related recommended "
    "recommendations teaser share sharing social pagination pager paging widget widgets toolbar skip copyright "
    "legal disclaimer hidden contentinfo complementary dialog alertdialog".split()
)
#: Like these, but kept inside an article, where they hold its heading.
HEADS = frozenset("header heading head topbar".split())
#: A start tag of a key ends an open element of the values, up to one that bounds it.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup", "datalist"])),
    "body": (frozenset(["head"]), frozenset()),
}
#: Start tags that end an open paragraph.
ENDS_P = BLOCKS - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attributes>(?>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*)|[^>]*)>",
    re.DOTALL,
)
_BEGUN = re.compile(r"<[!?/a-zA-Z]")
_MARK = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(
    r"(?<![\w-])(?:hidden(?![\w-])(?!\s*=\s*[\"']?until-found)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)",
    re.IGNORECASE,
)
_PART = re.compile(r"[a-z]+")
#: Hash of a run of blocks: a polynomial in BASE over their hashes, modulo a prime.
PRIME, BASE = (1 << 61) - 1, 0x1D2B3C4D5E6F7081 % ((1 << 61) - 1)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in RAW}


@dataclass(slots=True)
class Subtree:
    """Blocks ``start`` to ``stop`` of a page lie in it; ``hash`` tells equal subtrees."""

    start: int
    stop: int
    hash: int


@dataclass(slots=True)
class Page:
    blocks: list[str]
    within: list[int]  # 2 inside an article, 1 inside a main element, 0 elsewhere
    around: list[bool]  # marked as lying around the main text
    subtrees: list[Subtree]


@dataclass(slots=True)
class _Open:
    name: str
    dropped: bool
    within: int
    start: int
    block: str  # the name of the nearest element of BLOCKS, itself included


def marks(attributes: str) -> set[str]:
    """The lower-case words of an element's class, id and role."""
    out: set[str] = set()
    for found in _MARK.finditer(attributes):
        out.update(_PART.findall(html.unescape(found[2] or found[3] or found[4] or "").lower()))
    return out


def is_around(name: str, attributes: str, within: int) -> bool:
    """Whether an element lies around the main text rather than in it."""
    if name in DROPPED:
        return True
    if name in ("body", "html", "main"):
        return False
    if name == "header" and not within:
        return True
    if not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    words = marks(attributes)
    if words & AROUND:
        return True
    return not within and name != "article" and not words.isdisjoint(HEADS) and name in ("div", "section", "table")


def parse(text: str, host: str | None = "") -> Page:
    """Blocks of text, marked where they lie around, with the subtrees that hold them.

    Each element of BLOCKS is a subtree, and each block alone as one of its nearest such
    element; other elements lie in a block or hold whole ones.  Inside an article only
    CONTAINERS are, so that its headings and paragraphs go with a whole container or not at all.  What subtrees of different
    hosts hash to differs.  End tags may be missing or misplaced: an end tag closes what is
    open inside its element, one without its element means nothing, and what the text
    leaves open ends with it.
    """
    page = Page([], [], [], [])
    stack = [_Open("", False, 0, 0, "")]
    # Depths of the open elements of each name, and of all of BLOCKS, so that no search walks the stack.
    depths: defaultdict[str, list[int]] = defaultdict(list)
    blocks: list[int] = []
    # Text of elements that lie around is kept apart from the block they stand in.
    run: list[str] = []
    aside: list[str] = []
    sums, powers = [0], [1]

    def add(name: str, start: int) -> None:
        stop = len(page.blocks)
        held = (sums[stop] - sums[start] * powers[stop - start]) % PRIME
        value = xxhash.xxh3_64_intdigest(f"{host or ''}\n{name}\n{stop - start}\n{held}".encode("utf-8", "surrogatepass")) >> 1
        page.subtrees.append(Subtree(start, stop, value))

    def end(pieces: list[str], around: bool) -> None:
        words = html.unescape("".join(pieces)).split()
        pieces.clear()
        if words:
            block = " ".join(words)
            sums.append((sums[-1] * BASE + xxhash.xxh3_64_intdigest(block.encode("utf-8", "surrogatepass"))) % PRIME)
            powers.append(powers[-1] * BASE % PRIME)
            page.blocks.append(block)
            page.within.append(stack[-1].within)
            page.around.append(around)
            if stack[-1].within < 2:
                add(stack[-1].block, len(page.blocks) - 1)

    def flush() -> None:
        if run:
            end(run, False)
        if aside:
            end(aside, True)

    def close(depth: int) -> None:
        while len(stack) > depth:
            top = stack[-1]
            if top.name in BLOCKS:
                flush()
                if top.start < len(page.blocks) and (top.within < 2 or top.name == "article" or top.name in CONTAINERS):
                    add(top.name, top.start)
            elif top.dropped and not stack[-2].dropped and aside:
                end(aside, True)
            stack.pop()
            depths[top.name].pop()
            if top.name in BLOCKS:
                blocks.pop()

    # No tag ends behind the last ">"; what begins there is cut off.
    at, size = 0, len(text)
    closed = text.rfind(">") + 1
    if begun := _BEGUN.search(text, closed):
        size = begun.start()
    while at < size:
        found = _TOKEN.search(text, at, closed) if at < closed else None
        stop = found.start() if found else size
        if stop > at:
            (aside if stack[-1].dropped else run).append(text[at:stop])
        if not found:
            break
        at = found.end()
        name = found["name"]
        if name is None:
            if found[0].startswith("<!--") and not found[0].endswith("-->"):
                break
            continue
        name = name.lower()
        if found["end"]:
            if name in depths and depths[name]:
                close(depths[name][-1])
            continue
        attributes = found["attributes"] or ""
        if name in RAW:
            ended = _RAW_END[name].search(text, at)
            at = ended.end() if ended else size
            if name in BLOCKS:
                flush()
            continue
        if name == "br":
            (aside if stack[-1].dropped else run).append(" ")
            continue
        if name in ENDS_P and blocks and stack[blocks[-1]].name == "p":
            close(blocks[-1])
        if name in ENDS:
            ended_by, bounds = ENDS[name]
            bound = max((depths[other][-1] for other in bounds if depths[other]), default=0)
            inner = [d[i] for d in map(depths.__getitem__, ended_by) if (i := bisect_right(d, bound)) < len(d)]
            if inner:
                close(min(inner))
        if name in BLOCKS:
            flush()
        if name in VOID or attributes.endswith("/") and name not in BLOCKS:
            continue
        top = stack[-1]
        within = top.within
        dropped = top.dropped or is_around(name, attributes, within)
        if name == "article":
            within = 2
        elif name == "main" or "main" in attributes and "main" in marks(attributes) and "role" in attributes:
            within = max(within, 1)
        depths[name].append(len(stack))
        if name in BLOCKS:
            blocks.append(len(stack))
        stack.append(_Open(name, dropped, within, len(page.blocks), name if name in BLOCKS else top.block))
    close(1)
    flush()
    return page


def main_text(page: Page, templates: set[int] | frozenset[int]) -> str:
    """The blocks outside the given subtrees that do not lie around; of articles if there are any, else of main."""
    steps = [0] * (len(page.blocks) + 1)
    for tree in page.subtrees:
        if tree.hash in templates:
            steps[tree.start] += 1
            steps[tree.stop] -= 1
    left = [i for i, held in enumerate(accumulate(steps[:-1])) if not held and not page.around[i]]
    level = max((page.within[i] for i in left), default=0)
    return "\n\n".join(page.blocks[i] for i in left if page.within[i] == level)
