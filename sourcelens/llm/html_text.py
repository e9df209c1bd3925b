"""Main text of web pages by tree scoring.

A page becomes a tree of elements and, in page order, its blocks: runs of inline text that belong to one
element. Each block outside of page furniture gives points for its length and commas, discounted by its
share of link text, to the container around it, half of them to the next container, and less further up (nothing
beyond ``REACH`` containers, where it would be less than a hundredth). The container with the most points holds the article. If an article or main element encloses it, all of that
element's blocks outside of furniture that are not mostly links stay; else its siblings that are not mostly links.

A class or id word of furniture cuts an element out with all below it, unless the element also has a name
that speaks for text, or holds nearly all of the page's text outside of links; such an element only weighs
less. A page left without text is read again without regard to class and id words.

Time is in proportion to the page, however deep its elements lie in each other: open elements are found by name,
and sums and decisions go over the elements once, from the leaves up or from the root down.

Null and empty pages, and pages without text, give the empty text. Tags cut off at the end of a page are
markup. Repeated pages are read one by one; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
MARKS = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
SPACE = re.compile(r"\s+")
COMMAS = re.compile("[,،、，]")

# Element names and the words of class and id values that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select xmp noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split())
FURNITURE = frozenset("nav header footer aside form menu dialog button fieldset search head".split())
CONTAINERS = frozenset("article main section div body center td blockquote html dd li table tbody tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BAD_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notification notifications overlay pager pagination paywall popup promo promotion promotions recommended related "
    "replies respond share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription tags "
    "teaser toolbar topbar widget widgets".split())
BAD_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
GOOD_WORDS = frozenset("article body content entry main post story text page hentry".split())
#: Share of the page's text outside of links from which an element is no furniture by its names alone.
MOST = 0.8
#: What a word of furniture takes from the weight of an element that stays.
LOWER = 8.0
#: Words of furniture that do not count against an element that also has a good word.
EXCUSED = frozenset("header".split())
WEIGHT = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 3.0, "blockquote": 1.0, "td": 1.0}
#: Containers that a block gives points to, from the nearest up.
REACH = 40
#: Elements that end an open element of the same group.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
LIMITS = {"li": frozenset(("ul", "ol", "menu", "dir")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)),
          "tr": frozenset(("table",)), "td": frozenset(("table", "tr")), "th": frozenset(("table", "tr")),
          "option": frozenset(("select",))}


class Node:
    __slots__ = ("tag", "parent", "out", "bad", "link", "points", "weight", "chars", "linked", "order", "plain", "around")

    def __init__(self, tag, parent, out, link, weight, order):
        self.tag, self.parent, self.out, self.link = tag, parent, out, link
        self.points, self.weight, self.chars, self.linked, self.order = 0.0, weight, 0, 0, order
        self.bad, self.plain = False, 0
        #: The nearest container: itself, or the one around its parent.
        self.around = self if tag in CONTAINERS else parent.around if parent else None


class Open:
    """The open elements, root first, and their places by name."""

    def __init__(self, root: Node):
        self.stack, self.places, self.blocks = [root], {}, [0]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def cut(self, place: int) -> None:
        """Close the element at that place and all inside it."""
        for node in reversed(self.stack[place:]):
            self.places[node.tag].pop()
        del self.stack[place:]
        while self.blocks[-1] >= place:
            self.blocks.pop()

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of these names, 0 if there is none (the root does not count)."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)


def _judge(tag: str, attributes: str, inside: bool, names: bool) -> tuple[bool, bool, float]:
    """Whether an element is page furniture, whether its names say so, and its own weight. ``inside``: within an
    article or main; ``names``: whether class and id words of furniture count."""
    cut = False
    out = tag in FURNITURE and not (inside and tag == "header")
    weight = WEIGHT.get(tag, 0.0)
    if attributes and "=" in attributes or "hidden" in attributes:
        words: set = set()
        speaks = False  # a name with a good word and no bad one
        for name, a, b, c in MARKS.findall(attributes):
            value = html.unescape(a or b or c).lower()
            name = name.lower()
            if name == "role":
                out = out or bool(BAD_ROLES.intersection(value.split()))
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                out = True
            elif name == "style":
                out = out or "display:none" in value.replace(" ", "")
            elif name in ("class", "id"):
                for one in value.split():
                    own = set(re.split(r"[_\-:]+", one))
                    words |= own
                    speaks = speaks or bool(own & GOOD_WORDS) and not own & BAD_WORDS
        bad = words & BAD_WORDS
        good = words & GOOD_WORDS
        if bad and not (good and bad <= EXCUSED) and tag not in ("body", "html", "article", "main") and names:
            if speaks:
                weight -= LOWER
            else:
                cut = True
        if good:
            weight += 8.0
    return out, cut, weight


def blocks_of(page: str, names: bool = True) -> tuple[list[tuple[Node, str, int]], list[Node]]:
    """(element, text, linked characters) of every block in page order, and all elements."""
    root = Node("html", None, False, False, 0.0, 0)
    nodes, opened, blocks = [root], Open(root), []
    pieces: list[str] = []
    linked: list[str] = []
    owner = root

    def flush():
        nonlocal pieces, linked
        if pieces:
            text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                blocks.append((owner, text, len(SPACE.sub(" ", html.unescape("".join(linked))).strip())))
            pieces, linked = [], []

    def add(text: str):
        nonlocal owner
        top = opened.stack[-1]
        if not pieces:
            if not text.strip():
                return
            owner = opened.stack[opened.blocks[-1]]
        if top.out:
            return
        pieces.append(text)
        if top.link:
            linked.append(text)

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        found = TAG.match(page, start)
        if not found:
            add(page[at:start + 1])  # a lone "<" is text
            at = start + 1
            continue
        if start > at:
            add(page[at:start])
        at = found.end()
        close, name, rest = (found.group(1), found.group(2), found.group(3)) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        tag = name.lower()
        if close:
            place = opened.last(tag)
            if place:
                if tag in BLOCK:
                    flush()
                elif opened.blocks[-1] > place:
                    continue  # the end of an inline element does not end the blocks inside it
                opened.cut(place)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if tag in BLOCK:
                flush()
            if not rest.endswith("/") or tag not in ("svg", "math"):
                at = page.find(">", end.start()) + 1 or size if end else size
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag == "html" or tag == "body" and opened.last("body"):
            continue
        if tag in BLOCK:
            flush()
            if opened.last("p"):
                opened.cut(opened.last("p"))
            if tag in ("body", "article", "main", "section", "div", "p", "h1") and opened.last("head"):
                opened.cut(opened.last("head"))
        if tag in CLOSES and opened.last(*CLOSES[tag]) > opened.last(*LIMITS[tag]):
            flush()
            opened.cut(opened.last(*CLOSES[tag]))
        parent = opened.stack[-1]
        inside = bool(opened.last("article", "main"))
        out, cut, weight = _judge(tag, rest, inside, names)
        out = out or cut and tag not in BLOCK  # runs of inline text are not taken apart later
        node = Node(tag, parent, out or parent.out, parent.link or tag == "a", weight, len(nodes))
        node.bad = cut
        nodes.append(node)
        if not rest.endswith("/") or tag in BLOCK:
            opened.push(node)
    flush()
    for node, text, links in blocks:
        if not node.out:
            node.plain += max(0, len(text) - links)
    for node in reversed(nodes[1:]):
        node.parent.plain += node.plain
    for node in nodes[1:]:
        if node.bad and not node.out:
            if node.plain and node.plain >= MOST * root.plain:
                node.weight -= LOWER
            else:
                node.out = True
        node.out = node.out or node.parent.out
    return [b for b in blocks if not b[0].out], nodes


def _enclosing(node: Node) -> Node | None:
    """The nearest article around an element, else the nearest main."""
    found, up = None, node.parent
    while up is not None:
        if up.tag == "article":
            return up
        if up.tag == "main" and found is None:
            found = up
        up = up.parent
    return found


def main_text(page: str) -> str:
    """The article's blocks in page order, one per line."""
    blocks, nodes = blocks_of(page)
    if not blocks:
        blocks, nodes = blocks_of(page, names=False)
    if not blocks:
        return ""
    for node, text, links in blocks:
        density = min(1.0, links / len(text))
        points = (1 + len(COMMAS.findall(text)) + min(len(text) / 100, 3.0)) * (1 - density)
        up, rank = (node if node.tag in CONTAINERS else node.parent.around if node.parent else None), 1
        while up is not None and rank <= REACH:
            up.points += points * (1.0 if rank == 1 else 0.5 if rank == 2 else 1 / (rank * 3))
            rank += 1
            up = up.parent.around if up.parent else None
        node.chars += len(text)
        node.linked += links
    for node in reversed(nodes[1:]):  # elements come after those around them
        node.parent.chars += node.chars
        node.parent.linked += node.linked

    def score(n: Node) -> float:
        return (n.points + n.weight) * (1 - n.linked / n.chars) if n.chars else 0.0

    able = [n for n in nodes if n.chars and not n.out and n.tag in CONTAINERS]
    best = max(able, key=lambda n: (score(n), -n.order)) if able else nodes[0]
    least = max(10.0, 0.2 * score(best))
    named = best.tag in ("article", "main")
    whole = None if named else _enclosing(best)
    kept = {best.order}
    for n in nodes:
        if n.parent is best.parent and n is not best and n.chars and not n.out and best.parent is not None:
            density = n.linked / n.chars
            if n.tag in HEADINGS or (n.tag in ("p", "blockquote", "pre", "ul", "ol", "table") and density < 0.25):
                kept.add(n.order)
            elif n.tag in CONTAINERS and (score(n) - n.weight >= least or density < 0.25 and not named):
                kept.add(n.order)

    below_kept, below_whole = [False] * len(nodes), [False] * len(nodes)
    for n in nodes:
        up = n.parent.order if n.parent else None
        below_kept[n.order] = n.order in kept or up is not None and below_kept[up]
        below_whole[n.order] = n is whole or up is not None and below_whole[up]

    def inside(n: Node, links: float) -> bool:
        return below_kept[n.order] or below_whole[n.order] and links < 0.5

    own = best.parent is not None
    return "\n".join(t for n, t, x in blocks if inside(n, x / len(t)) or (own and n is best.parent and best.tag != "article"))


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def read(batches):
        for batch in batches:
            texts = [main_text(x) if x else "" for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col(page).cast("string").alias("page"))
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")
