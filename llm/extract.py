"""Main text of web pages by composite text density.

A page becomes a tree of elements. For every node, characters per tag are adjusted by how much of them is
link text; a node's sum is that of its children's densities. The node with the largest sum is the core; the
least density on the path from it to the body is the threshold for what belongs to the text around it. Menus,
forms, scripts and the like, known by element or by name, are not part of the tree's text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from llm.common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never main text.
DROPPED = frozenset("head title script style noscript template nav footer aside form button select option textarea label iframe object svg canvas audio video dialog menu datalist".split())
BLOCKS = frozenset((
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul").split())
#: End tags of these close whatever is open inside; any other end tag stays inside its block.
CONTAINERS = BLOCKS | DROPPED - {"label"}
#: What may stand in the head; anything else ends it, as both </head> and <body> may be left out.
HEAD_CONTENT = frozenset("base basefont bgsound head link meta noscript script style template title".split())
#: An element that opens closes those of the first set up to one of the second.
CLOSES = {
    **{t: (frozenset({"p"}), frozenset({"table", "td", "th", "button"})) for t in (BLOCKS | {"aside", "dialog", "footer", "form", "menu", "nav"}) - {"html", "body", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}},
    "li": (frozenset({"li", "p"}), frozenset({"ul", "ol"})),
    "dt": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th", "p"}), frozenset({"table"})),
    "td": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
}
#: Words of class, id and role that mark what surrounds an article.
_AROUND = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banners?|cookies?|consent|gdpr|"
    r"notices?|alerts?|popups?|modals?|overlays?|newsletters?|subscribe|subscription|signup|login|comments?|commentlist|"
    r"disqus|replies|respond|responses|user-posts|reader-posts|discussion|sidebars?|side-bar|widgets?|related|recommended|recommendations|more-stories|"
    r"nav|navbar|navigation|menus?|breadcrumbs?|pagination|pager|toolbar|masthead|footers?|foot|copyright|legal|"
    r"share|sharing|social|skip|search|complementary|contentinfo)(?:$|[\s_-]|s?\d)", re.I)
#: The same inside an article, where chapters and notes bear names like "discussion", "alert" or "related-work".
_APART = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?s?|cookies?|consent|gdpr|popups?|modals?|"
    r"newsletters?|subscribe|subscription|signup|login|comments?|commentlist|disqus|replies|respond|responses|user-posts|reader-posts|"
    r"sidebars?|side-bar|widgets?|related(?:-(?:posts?|articles?|links?|stories|news))?(?=$|\s)|recommended|recommendations|more-stories|"
    r"navbar|navigation|menus?|breadcrumbs?|pagination|pager|toolbar|share|sharing|contentinfo)(?:$|[\s_-]|s?\d)|"
    r"(?:^|\s)(?:notices?|alerts?|banners?|nav|masthead|footer|copyright|legal|skip|social|search)(?=$|\s)", re.I)
#: Text elements, which only the plainest names take out of an article.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li td th blockquote pre figcaption".split())
_COMMENT = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|sponsored|comments?|commentlist|replies|reply)(?:$|[\s_-])", re.I)
_ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|main|body|text)(?:$|[\s_-])", re.I)
_SPACE = re.compile(r"\s+")


class Said(NamedTuple):
    """What class, id and role of an element say of it."""

    around: bool
    apart: bool
    comment: bool
    article: bool


_NOTHING = Said(False, False, False, False)


@lru_cache(maxsize=10_000)
def _said(names: str) -> Said:
    return Said(*(pattern.search(names) is not None for pattern in (_AROUND, _APART, _COMMENT, _ARTICLE)))


class Node:
    __slots__ = ("tag", "around", "inside", "parent", "items", "chars", "link_chars", "tags", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, around: bool = False, inside: bool = False):
        self.tag, self.parent, self.around = tag, parent, around
        self.inside = inside or parent is not None and parent.inside
        self.items: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


class TreeBuilder(HTMLParser):
    """Elements and text of a page, with missing end tags supplied and stray ones ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.said = _NOTHING
        self.forms: list[Node] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html" or tag == "body" and any(n.tag == "body" for n in self._path()):
            return
        if self.at.tag == "head" and tag not in HEAD_CONTENT:
            self._leave_head(tag)
        if tag in CLOSES:
            closed, until = CLOSES[tag]
            node, last = self.at, None
            while node is not None and node.tag not in until:
                if node.tag in closed:
                    last = node
                node = node.parent
            if last is not None and last.parent is not None:
                self.at = last.parent
        self.said = self.stated(attrs) if attrs else _NOTHING
        is_article = tag in ("article", "main") or tag != "body" and self.said.article
        node = Node(tag, self.at, self.surrounds(tag, attrs), is_article)
        self.at.items.append(node)
        if tag == "form":
            self.forms.append(node)
        if tag not in VOID:
            self.at = node

    def _leave_head(self, tag: str | None = None) -> None:
        """Close the head; unless ``tag`` is the body itself, open the body that the page leaves out."""
        self.at = self.at.parent or self.root
        if tag != "body":
            body = Node("body", self.at)
            self.at.items.append(body)
            self.at = body

    def stated(self, attrs: list) -> Said:
        return _said(" ".join(v for k, v in attrs if v and k in ("class", "id", "role")))

    def surrounds(self, tag: str, attrs: list) -> bool:
        """Is this element around the main text, by its name or by what its attributes say?"""
        if tag in DROPPED or tag == "header" and not any(p.tag in ("article", "main") for p in self._path()):
            return True
        if not attrs:
            return False
        names = self.said
        if any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs):
            return True
        if tag in ("body", "article", "main"):
            return tag == "article" and names.comment
        if self.at.inside:
            return (names.comment if tag in _PROSE else names.apart) and not names.article
        return names.around and not names.article

    def _path(self) -> Iterator[Node]:
        node: Node | None = self.at
        while node is not None:
            yield node
            node = node.parent

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        node, inline = self.at, tag not in CONTAINERS
        while node is not None:
            if node.tag == tag and node.parent is not None:
                self.at = node.parent
                return
            if inline and node.tag in CONTAINERS:
                return  # an inline element is not closed from inside another block
            node = node.parent

    def updatepos(self, i: int, j: int) -> int:
        """Lines are not counted: nobody asks where in the page a tag stands."""
        return j

    def handle_data(self, data: str) -> None:
        if self.at.tag == "head" and data.strip():
            self._leave_head()
        self.at.items.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    for form in builder.forms:
        _open_if_page(form, builder.root)
    return builder.root


def _open_if_page(form: Node, root: Node) -> None:
    """A form around more than half of the page's text is a wrapper; what it asks for is left out as before."""
    form.around = False
    if 2 * _chars(form) <= _chars(root):
        form.around = True


def _chars(root: Node) -> int:
    return sum(len(_SPACE.sub(" ", item).strip()) for node, opens in _in_order(root) if opens for item in node.items if isinstance(item, str))


def _in_order(root: Node) -> Iterator[tuple[Node, bool]]:
    """Each element when it opens and when it closes; no recursion, whatever the depth."""
    stack: list[tuple[Node, bool]] = [(root, True)]
    while stack:
        node, opens = stack.pop()
        yield node, opens
        if opens:
            stack.append((node, False))
            stack.extend((c, True) for c in reversed(node.items) if isinstance(c, Node) and not c.around)


def measure(root: Node) -> Node:
    """Fill in counts, densities and density sums; gives the body, or the root where there is none."""
    body = root
    for node, opens in _in_order(root):
        if opens:
            if node.tag == "body" and body is root:
                body = node
            continue
        for item in node.items:
            if isinstance(item, str):
                node.chars += len(_SPACE.sub(" ", item).strip())
            elif not item.around:
                node.chars += item.chars
                node.tags += item.tags + 1
                node.link_chars += item.link_chars
                node.link_tags += item.link_tags + (item.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for node, opens in _in_order(body):
        if not opens:
            node.density = density(node, ratio)
            node.total = sum(c.density for c in node.items if isinstance(c, Node) and not c.around)
    return body


def density(node: Node, ratio: float) -> float:
    """Composite text density: characters per tag, dampened where they are link text; ``ratio`` is the body's share of it."""
    c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
    if not c:
        return 0.0
    plain = max(c - node.link_chars, 1)
    base = math.log(c / plain * node.link_chars + ratio * c + math.e)
    return c / t * math.log(c / lc * t / lt + 1) / base


def core(body: Node) -> tuple[Node, float]:
    """The node of the largest density sum, and the threshold: the least density from it up to the body."""
    best = body
    for node, opens in _in_order(body):
        if opens and node.total > best.total:
            best = node
    threshold, node = best.density, best
    while node is not body and node.parent is not None:
        node = node.parent
        threshold = min(threshold, node.density)
    return best, threshold


def _stated(body: Node) -> Node:
    """The one article or main element that holds a fair part of the text, else the body: where the core is looked for."""
    found = [node for node, opens in _in_order(body) if opens and node.tag in ("article", "main")
             and not any(n.tag in ("article", "main") for n in _ancestors(node))]
    return found[0] if len(found) == 1 and 4 * found[0].chars >= body.chars else body


def _ancestors(node: Node) -> Iterator[Node]:
    while node.parent is not None:
        node = node.parent
        yield node


def _title_of(node: Node) -> list[str]:
    """A heading right before the text, where the text has no first heading of its own."""
    if node.parent is None or any(n.tag == "h1" for n, opens in _in_order(node) if opens):
        return []
    before = [i for i in node.parent.items[:node.parent.items.index(node)] if isinstance(i, Node) and not i.around or isinstance(i, str) and i.strip()]
    last = before[-1] if before else None
    return blocks(last) if isinstance(last, Node) and last.tag in ("h1", "h2") and last.link_chars < last.chars else []


def article(body: Node) -> Node:
    """The subtree of the main text: from the core up through what an article wraps around it.

    A parent is taken along while it is an article, section or main element or a plain wrapper whose other
    children reach the threshold, so that paragraphs split over wrappers stay together.
    """
    best, threshold = core(_stated(body))
    node, found = best, best
    while node is not body and node.parent is not None:
        up = node.parent
        others = [c for c in up.items if isinstance(c, Node) and not c.around and c is not node and c.chars]
        wraps = up.tag in ("article", "main") or (up is not body and up.tag not in ("body",) and all(
            c.density >= threshold or c.tag in ("h1", "h2", "h3", "h4", "h5", "h6", "p", "ul", "ol", "blockquote", "pre", "table", "figure", "header") for c in others))
        if not wraps and not (up.tag in BLOCKS and node.tag not in BLOCKS):
            break
        node = found = up
    # the outermost article around the core, if any
    outer = found
    while outer is not None and outer is not body:
        if outer.tag == "article":
            found = outer
        outer = outer.parent
    return found


def blocks(node: Node) -> list[str]:
    """Text of a subtree by block, white space made single. The parser has decoded the references."""
    out: list[str] = []
    now: list[str] = []

    def flush() -> None:
        text = " ".join("".join(now).split())
        now.clear()
        if text:
            out.append(text)

    stack: list[Node | str | None] = [node]
    closing: list[bool] = []
    while stack:
        item = stack.pop()
        if item is None:
            if closing.pop():
                flush()
        elif isinstance(item, str):
            now.append(item)
        elif item.tag == "br":
            now.append(" ")
        elif not item.around or item is node:
            block = item.tag in BLOCKS
            if block:
                flush()
            closing.append(block)
            stack.append(None)
            stack.extend(reversed(item.items))
    flush()
    return out


def main_text(html: str | None) -> str:
    """Main text of a whole page; null and pages without text give an empty one."""
    if not html:
        return ""
    found = article(measure(parse(html)))
    return "\n".join(_title_of(found) + blocks(found))


@F.pandas_udf(StringType())
def _main_text(html: pd.Series) -> pd.Series:
    return html.map(main_text)


def with_main_text(pages: DataFrame) -> DataFrame:
    """``html`` and any other columns -> the same with ``text``. Each page is parsed once, by itself."""
    return pages.withColumn("text", _main_text.asNondeterministic()("html"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page. Repeated rows give repeated rows."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return with_main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
