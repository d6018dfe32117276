"""Main text of raw web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import texts_of

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
_CLOSES_P = _BLOCK - frozenset("td th tr tbody thead tfoot caption body html legend summary".split())
# an opening tag ends these open ones, up to the scope in the second place
_ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})), "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})), "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})), "body": (frozenset({"head"}), frozenset()),
}
_NOISE_TAGS = frozenset(
    "nav aside footer form button select option input label dialog menu template svg canvas object audio video map head datalist fieldset".split()) | _RAW
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner banners nav navbar navigation menu menus topbar breadcrumb breadcrumbs "
    "sidebar aside widget widgets rail footer foot header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup "
    "subscription comment comments commentlist discussion disqus replies respond share sharing social related recommended recommendations teaser teasers pager pagination "
    "paywall login search toolbar skip hidden legal copyright outbrain taboola".split())
# of these, names made up of nothing else hold the words of others, however long
_FOREIGN_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion cookie cookies consent gdpr popup modal newsletter subscribe signup comment "
    "comments commentlist discussion disqus replies respond related recommended recommendations teaser teasers paywall outbrain taboola".split())
_BOX_WORDS = frozenset("list section area box wrapper wrap container block thread form body items item slot unit bar notice banner".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FLOW = frozenset("p pre blockquote figure ul ol dl table".split())
_LISTS = frozenset("ul ol dl table".split())
_TITLE_WORDS = frozenset({"header", "banner"})
_OWN_WORDS = frozenset("article post entry story content".split())
_NO_SIGN = frozenset("has no not with without overflow".split())  # first parts of names that say nothing on the element itself
LARGE = 200  # characters of a text block that a class word does not outweigh
_NAME_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "parent", "children", "noise", "signs", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, noise: bool):
        self.tag, self.parent, self.noise = tag, parent, noise
        self.signs: list[list[str]] = []  # names of its class and id with a noise word
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _noisy(tag: str, attributes: str, inside: Node) -> tuple[bool, list[list[str]]]:
    """Whether the element is noise for certain, and the names of its class and id that may say so."""
    if tag in _NOISE_TAGS:
        return True, []
    signs: list[list[str]] = []
    own = False
    for name, a, b, c in _ATTRIBUTE.findall(attributes) if attributes and tag not in ("html", "body", "main", "article") else ():
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, []
        if name == "role" and value.lower() in _NOISE_ROLES:
            return True, []
        if name in ("class", "id"):
            for word in value.split():
                parts = [part.lower() for part in _NAME_PART.findall(word)]
                own = own or not _OWN_WORDS.isdisjoint(parts)
                if parts and parts[0] not in _NO_SIGN and not _NOISE_WORDS.isdisjoint(parts):
                    signs.append(parts)
    if tag == "header":  # of the page; an article's own header holds its title
        node: Node | None = inside
        while node is not None and node.tag not in ("article", "main"):
            node = node.parent
        if node is None and not own:
            return True, []
    return False, signs


def _settle(root: Node) -> None:
    """Decide which elements with a noise word are noise; what is inside of noise is noise.

    None is that contains the longest article or main, or, where there is none, over half of the text; nor a title's
    header; nor, inside the longest, one with a large text block or over half of the text, unless links fill half of it
    or its names say that others wrote it.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.children) if not isinstance(c, str)]
    chars, links, blocks = {}, {}, {}
    titles: set[int] = set()
    for node in reversed(order):
        if node.noise:
            chars[id(node)] = links[id(node)] = blocks[id(node)] = 0
            continue
        inner = [c for c in node.children if not isinstance(c, str)]
        n = sum(len(c) - c.count(" ") for c in node.children if isinstance(c, str) and not c.isspace()) + sum(chars[id(c)] for c in inner)
        chars[id(node)] = n
        links[id(node)] = n if node.tag == "a" else sum(links[id(c)] for c in inner)
        in_line = all(c.tag not in _BLOCK for c in inner)
        blocks[id(node)] = n - links[id(node)] if in_line else max(blocks[id(c)] for c in inner)
        if node.tag in _HEADINGS or any(id(c) in titles for c in inner):
            titles.add(id(node))
    longest = max((n for n in order if n.tag in ("article", "main") and chars[id(n)]), key=lambda n: chars[id(n)], default=None)
    around: set[int] = set()
    node = longest
    while node is not None:
        around.add(id(node))
        node = node.parent
    held: set[int] = set()  # inside the longest
    for node in order:
        if node is longest or node.parent is not None and id(node.parent) in held:
            held.add(id(node))
        if node.parent is not None and node.parent.noise:
            node.noise = True
        if node.noise or not node.signs or id(node) in around:
            continue
        words = [part for name in node.signs for part in name if part in _NOISE_WORDS]
        n, inside = chars[id(node)], id(node) in held
        if id(node) in titles and _TITLE_WORDS.issuperset(words) and (inside or longest is None and any(not _OWN_WORDS.isdisjoint(name) for name in node.signs)):
            continue
        foreign = any(name == ["hidden"] or _FOREIGN_WORDS.union(_BOX_WORDS).issuperset(name) and not _FOREIGN_WORDS.isdisjoint(name) for name in node.signs)
        most = (inside or longest is None) and n * 2 > chars[id(longest or root)]
        large = inside and blocks[id(node)] >= LARGE
        node.noise = foreign or not (most or large) or links[id(node)] * 2 > n


def parse(html: str) -> Node:
    """A forgiving tree: unclosed elements end where the next one, or their parent, demands it.

    Open elements are counted by tag: where none of those sought is open, nothing is climbed.
    """
    root = here = Node("html", None, False)
    at, opened = 0, Counter()

    def leave(node: Node, last: Node) -> Node:
        """Close ``last`` and all open elements inside it."""
        while node is not last.parent:
            opened[node.tag] -= 1
            node = node.parent
        return node

    for match in _TOKEN.finditer(html):
        if match.start() < at:
            continue
        if match.start() > at:
            here.children.append(html[at : match.start()])
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            if not opened[tag]:
                continue
            node = here
            while node is not root and node.tag != tag:
                if node.tag in ("td", "th", "table", "article") and tag not in _BLOCK:
                    node = root  # an inline end tag does not reach out of these
                    break
                node = node.parent
            if node is not root:
                here = leave(here, node)
            continue
        if tag == "html":
            continue
        if tag in _CLOSES_P or tag in _ENDS:
            ended, scope = _ENDS.get(tag, (frozenset(), frozenset()))
            if tag in _CLOSES_P:
                ended, scope = ended | {"p"}, scope | {"table", "td", "th", "article", "section", "div", "body", "button"}
            node, last = here if any(opened[t] for t in ended) else root, None
            while node is not root and node.tag not in scope:
                if node.tag in ended:
                    last = node
                node = node.parent
            if last is not None:
                here = leave(here, last)
        attributes = match[3]
        noise, signs = (True, []) if here.noise else _noisy(tag, attributes, here)
        node = Node(tag, here, noise)
        node.signs = signs
        here.children.append(node)
        if tag in _RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = close.end() if close else len(html)
        elif tag not in _VOID and not attributes.endswith("/"):
            here = node
            opened[tag] += 1
    if at < len(html):
        here.children.append(html[at:])
    return root


def measure(root: Node) -> list[Node]:
    """Counts, link-adjusted densities and sums of child densities of all nodes that are not noise, parents first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.children) if not isinstance(c, str) and not c.noise]
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child) - child.count(" ") if not child.isspace() else 0
            elif not child.noise:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    body_share = root.link_chars / max(1, root.chars)
    for node in order:
        if node.chars:
            tags, links, link_tags = max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
            base = math.log(node.chars / max(1, node.chars - node.link_chars) * node.link_chars + body_share * node.chars + math.e)
            node.density = node.chars / tags * math.log(node.chars / links * tags / link_tags + 1) / max(base, 1e-9)
    for node in order:
        node.total = sum(c.density for c in node.children if not isinstance(c, str) and not c.noise)
        if any(isinstance(c, str) and not c.isspace() for c in node.children):
            node.total += node.density if not node.total else 0.0
    return order


def _descendants(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in node.children if not isinstance(c, str) and not c.noise]


def content(root: Node) -> tuple[set[int], set[int]]:
    """ids of the nodes whose subtrees are the main text, and of those in them that are not.

    The node with the largest sum of child densities is chosen. The lowest density on its path up to the body (or
    its article) is the threshold. Below the body, every branch at or above it contributes its own largest-sum node.
    The node's article is text but for its branches below the threshold; so is every other article, unless it is below
    the lowest density on the path up to the body and links fill over a fifth of it.
    """
    order = measure(root)
    best = max(order, key=lambda n: n.total)
    if not best.chars:
        return set(), set()
    path, top = [best], best
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    for node in path:
        if node.tag in ("article", "main"):
            top = node  # the outermost of them
    if top.tag not in ("article", "main"):
        top = next((n for n in path if n.tag == "body"), path[-1])
    threshold = min(n.density for n in path[: path.index(top) + 1])
    marked: set[int] = set()
    dropped: set[int] = set()
    if top.tag in ("article", "main"):
        body = next((i for i, n in enumerate(path) if n.tag == "body"), len(path) - 1)
        least = min(n.density for n in path[: body + 1])
        stack = [root]
        while stack:
            node = stack.pop()
            if node.tag in ("article", "main"):
                if node is top or node.density >= least or node.link_chars * 5 <= node.chars:
                    marked.add(id(node))
                    dropped |= _sparse_branches(node, threshold)
                continue
            stack += [c for c in node.children if not isinstance(c, str) and not c.noise]
        return marked, dropped
    stack = [top]
    while stack:
        node = stack.pop()
        if node.density < threshold:
            continue
        chosen = max(_descendants(node), key=lambda n: n.total)
        marked.add(id(chosen))
        if chosen is not node:
            stack += [c for c in node.children if not isinstance(c, str) and not c.noise and not any(id(d) in marked for d in _descendants(c))]
    return marked, dropped


def _sparse_branches(top: Node, threshold: float) -> set[int]:
    """ids of the branches of an article beside its largest-sum node, and of its branches in turn, that are no text.

    Such a branch is below the threshold and over a fifth of it (over half of a paragraph, list or the like) are links; a branch with a title of the article (h1)
    and a branch that is itself a heading stay. Of the largest-sum node only a child div below the threshold goes, if
    three links and more fill over half of it and no list, table or heading is in it.
    """
    dropped: set[int] = set()
    stack = [top]
    while stack:
        node = stack.pop()
        chosen = max(_descendants(node), key=lambda n: n.total)
        for child in chosen.children:
            if isinstance(child, str) or child.noise or child.tag != "div" or child.density >= threshold:
                continue
            if child.link_tags >= 3 and child.link_chars * 2 > child.chars and all(d.tag not in _LISTS and d.tag not in _HEADINGS for d in _descendants(child)):
                dropped.add(id(child))
        while chosen is not node:
            parent = chosen.parent
            for child in parent.children:
                if isinstance(child, str) or child.noise or child is chosen:
                    continue
                if child.density >= threshold:
                    stack.append(child)
                elif child.link_chars * (2 if child.tag in _FLOW else 5) > child.chars and child.tag not in _HEADINGS and all(d.tag != "h1" for d in _descendants(child)):
                    dropped.add(id(child))
            chosen = parent
    return dropped


def _link_list(node: Node) -> bool:
    return node.tag in ("ul", "ol", "div", "section", "table", "p") and node.link_tags >= 3 and node.link_chars * 10 > node.chars * 8


def _in_article(node: Node | None) -> bool:
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node is not None


def _any_sign(root: Node) -> bool:
    stack = [root]
    while stack:
        node = stack.pop()
        if node.signs:
            return True
        stack += [c for c in node.children if not isinstance(c, str)]
    return False


def main_text(html: str) -> str:
    """Blocks of the main text in page order, joined by an empty line. Where class words leave none, they are not heeded."""
    root = parse(html)
    signs = _any_sign(root)
    if signs:
        _settle(root)
    text = _text(root)
    if signs and not text:
        root = parse(html)
        text = _text(root)
    return text


def _text(root: Node) -> str:
    marked, dropped = content(root)
    blocks: list[str] = []
    current: list[str] = []

    def flush() -> None:
        text = " ".join(unescape("".join(current)).split())
        if text:
            blocks.append(text)
        current.clear()

    stack: list[tuple[Node | str | None, bool]] = [(root, False)]
    while stack:
        item, wanted = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if wanted:
                current.append(item)
        elif not item.noise and id(item) not in dropped and not (wanted and _link_list(item) and not _in_article(item)):
            wanted = wanted or id(item) in marked
            if item.tag == "br":
                current.append(" ")
            if item.tag in _BLOCK:
                flush()
                stack.append((None, False))
            stack += [(c, wanted) for c in reversed(item.children)]
    flush()
    return "\n\n".join(blocks)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null or empty page, or one without main text, gives an empty text; repeated rows are kept each; broken and very
    long markup is read to its end; an empty table gives no rows; other columns are ignored. Each page is handled alone:
    no shuffle, and memory follows the longest page.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                texts = [main_text(html) if html else "" for html in texts_of(part.column(2))]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
