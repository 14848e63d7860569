"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, full to the parent, half
to its parent and less further up; an ancestor's sum is discounted by the share of its text that
lies in links.  The best container is kept, with those of its siblings that score near it or
have text that is not mostly links, and the bare text between them; where it lies in an article or main element, that element is the container.
Nodes marked by their class, id or role as something else, and forms, go before that, but a marked
node that wraps the article stays and only what is marked below it goes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from postlytics.llm.common import pick

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never text of an article.
DROP = frozenset("script style noscript template head title nav aside footer form button select option textarea "
                 "input iframe object embed applet svg canvas audio video map menu dialog datalist".split())
BLOCKS = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 "
                   "h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead "
                   "tr ul legend search".split())
#: A start tag of these ends an open <p>.
ENDS_P = BLOCKS - frozenset("body html caption tbody td tfoot th thead tr li dd dt figcaption summary legend".split()) | {
    "nav", "aside", "footer", "form", "menu", "dialog"}
#: A start tag ends these open tags, up to one of the second set.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
#: Words of class, id and role that mark what is not the article.
SIGNS = frozenset("""ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion
    promoted nav navbar navigation menu menubar topbar toolbar breadcrumb breadcrumbs sidebar sidebars aside rail widget
    widgets footer masthead dialog cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall
    newsletter subscribe subscription signup login comment comments commentlist discussion disqus replies reply respond
    feedback share sharing social related recommended recommendations trending popular pagination pager skip hidden
    complementary contentinfo search searchbox""".split())
#: Of these, words for text of others or about others: an article element below does not make it the page's own.
FOREIGN = frozenset("""ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion promoted
    cookie cookies consent gdpr newsletter comment comments commentlist discussion disqus replies reply respond feedback
    related recommended recommendations trending popular""".split())
#: First or last words of a class name that only says how the page is laid out.
LAYOUT = frozenset("has no with without enabled disabled".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []


class Tree(HTMLParser):
    """The page as a tree; unclosed and misplaced tags are mended in the usual ways."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def _close(self, tags, stops) -> None:
        node = self.at
        while node.parent is not None and node.tag not in stops:
            if node.tag in tags:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS_P:
            self._close({"p"}, {"td", "th", "button", "object", "table"})
        if tag in ENDS:
            self._close(*ENDS[tag])
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:  # a slash means nothing in HTML, but <div/> is mostly meant as empty
            self.at.children.append(Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        node = self.at
        while node.parent is not None and node.tag != tag:
            if node.tag in ("td", "th", "table") and tag not in BLOCKS | DROP:
                return  # an inline end tag doesn't end a cell
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def _signs(node: Node) -> set[str]:
    """The words of class, id and role (split at dashes and inner capitals)."""
    out: set[str] = set()
    for k in ("class", "id", "role"):
        for name in (node.attrs.get(k) or "").split():
            words = re.sub(r"([a-z0-9])([A-Z])", r"\1-\2", name).lower().replace("_", "-").split("-")
            if not {words[0], words[-1]} & LAYOUT:
                out.update(words)
    return out


def _dropped(node: Node, in_article: bool) -> bool:
    """Whether a node is no part of the article, whatever it holds."""
    if node.tag in DROP and node.tag != "form" or node.tag == "header" and not in_article:
        return True
    if not node.attrs or node.tag in ("html", "body", "article", "main"):
        return False
    a = node.attrs
    if "hidden" in a or a.get("aria-hidden") == "true":
        return True
    style = (a.get("style") or "").replace(" ", "").lower()
    return "display:none" in style or "visibility:hidden" in style


def _marks(node: Node, in_article: bool) -> set[str]:
    """What marks a node as not the article, unless it holds the article: its tag if a form, its signs."""
    out = {"form"} if node.tag == "form" else set()
    if node.attrs and node.tag not in ("html", "body", "article", "main"):
        signs = _signs(node)
        out |= signs & SIGNS
        if "header" in signs and not in_article:
            out.add("header")
    return out


def _remove(root: Node, dropped) -> None:
    """Take nodes out of the tree for which dropped(node, whether it lies in an article or main) holds."""
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or node.tag in ("article", "main")
        node.children = [c for c in node.children if isinstance(c, str) or not dropped(c, inside)]
        todo += [(c, inside) for c in node.children if not isinstance(c, str)]


def _wrappers(root: Node) -> tuple[dict[Node, set[str]], set[Node]]:
    """Marks of marked nodes, and those of the nodes that are wrappers of the article.

    A marked node is a wrapper if it holds a main element; or more than half of the page's paragraph
    points, links discounted; or, outside of articles, an article element and no fewer points
    than all that is not marked.  Points in foreign text count for foreign nodes only, and these
    are wrappers by their points only if no other article or main element has a paragraph.
    """
    nodes = _order(root)
    marks: dict[Node, set[str]] = {}
    within: dict[Node, tuple[bool, bool, bool]] = {}  # in an article or main, a marked node, a foreign node
    for node in nodes:
        inside, marked, foreign = within[node.parent] if node.parent is not None else (False, False, False)
        if m := _marks(node, inside):
            marks[node] = m
        within[node] = (inside or node.tag in ("article", "main"), marked or bool(m), foreign or bool(m & FOREIGN))
    if not marks:
        return marks, set()
    chars = _chars(nodes)
    every, firm = dict.fromkeys(nodes, 0.0), dict.fromkeys(nodes, 0.0)
    mains, articles = set(), set()
    plain, own_article = 0.0, False
    for node in reversed(nodes):
        inside, marked, foreign = within[node]
        if text := _paragraph(node):
            n, links = chars[node]
            w = _worth(text) * (1 - links / n)
            every[node] += w
            if not foreign:
                firm[node] += w
                own_article = own_article or inside
            if not marked:
                plain += w
        if node.parent is not None:
            every[node.parent] += every[node]
            firm[node.parent] += firm[node]
            if node.tag == "main" or node in mains:
                mains.add(node.parent)
            if node.tag == "article" or node in articles:
                articles.add(node.parent)
    out = set()
    for node, m in marks.items():
        if node in mains:
            out.add(node)
        elif m & FOREIGN or within[node][2]:
            if not own_article and every[node] > every[root] / 2:
                out.add(node)
        elif firm[node] > firm[root] / 2 or node in articles and not within[node][0] and firm[node] >= plain:
            out.add(node)
    return marks, out


def prune(root: Node) -> None:
    """Take dropped nodes out of the tree, then marked ones; of a wrapper only what is marked below it."""
    _remove(root, _dropped)
    marks, wrappers = _wrappers(root)
    if marks:
        _remove(root, lambda c, _: c in marks and c not in wrappers)


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, white space turned into single spaces, in page order."""
    out: list[str] = []
    held: list[str] = []

    def end() -> None:
        if text := " ".join("".join(held).split()):
            out.append(text)
        held.clear()

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            held.append(x)
        elif x.tag == "br":
            held.append(" ")
        elif x.tag in BLOCKS:
            end()
            todo.append(None)
            todo += reversed(x.children)
        else:
            todo += reversed(x.children)
    end()
    return out


def _own_text(node: Node) -> str:
    """Text of a node that lies in no block below it."""
    out, todo = [], list(reversed(node.children))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag == "br":
            out.append(" ")
        elif x.tag not in BLOCKS:
            todo += reversed(x.children)
    return " ".join("".join(out).split())


def _order(root: Node) -> list[Node]:
    """Nodes, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    return out


def _chars(nodes: list[Node]) -> dict[Node, tuple[int, int]]:
    """Characters and link characters of every node; parents come first in nodes."""
    chars: dict[Node, tuple[int, int]] = {}
    for node in reversed(nodes):
        n = sum(len(c.strip()) if isinstance(c, str) else chars[c][0] for c in node.children)
        links = n if node.tag == "a" else sum(chars[c][1] for c in node.children if not isinstance(c, str))
        chars[node] = (n, links)
    return chars


def _paragraph(node: Node) -> str:
    """Own text of a block that is no heading, else ''."""
    return _own_text(node) if node.tag in BLOCKS and node.tag not in HEADINGS else ""


def _worth(text: str) -> float:
    """Points of a paragraph."""
    return 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)


def scores(root: Node) -> tuple[dict[Node, float], dict[Node, tuple[int, int]]]:
    """Discounted points of every ancestor of a paragraph; characters and link characters of every node."""
    nodes = _order(root)
    chars = _chars(nodes)
    points: dict[Node, float] = {}
    for node in nodes:
        if not (text := _paragraph(node)):
            continue
        worth = _worth(text)
        up, level = node.parent if node.tag not in ("div", "section", "article", "main", "body") else node, 0
        while up is not None and level < 6:
            points[up] = points.get(up, 0) + worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.parent, level + 1
    return {n: p * (1 - chars[n][1] / chars[n][0] if chars[n][0] else 0) for n, p in points.items()}, chars


def main_text(html: str | None) -> str:
    """The article of a page: its blocks joined by an empty line; '' for null, empty and textless pages."""
    if not html:
        return ""
    root = parse(html)
    prune(root)
    got, chars = scores(root)
    if not got:
        return "\n\n".join(blocks(root))
    best = max(got, key=got.get)  # the first of equals, in page order of their paragraphs
    home = best
    while home is not None and home.tag not in ("article", "main"):
        home = home.parent
    if home is not None:
        outer = home.parent
        while outer is not None:  # the outermost article, without a list of them around it
            if outer.tag == "article":
                home = outer
            outer = outer.parent
        return "\n\n".join(blocks(home))
    if best.parent is None or best.tag in ("body", "html", "#root"):
        return "\n\n".join(blocks(best))
    out: list[str] = []
    run = Node("p", {}, None)  # text and inline nodes between the siblings that are blocks

    def end() -> None:
        n = sum(len(c.strip()) if isinstance(c, str) else chars[c][0] for c in run.children)
        if n and sum(chars[c][1] for c in run.children if not isinstance(c, str)) / n < 0.25:
            out.extend(blocks(run))
        run.children = []

    for c in best.parent.children:
        if isinstance(c, str) or c.tag not in BLOCKS and c is not best:
            run.children.append(c)
            continue
        end()
        n, links = chars[c]
        if c is best or got.get(c, 0) >= 0.2 * got[best] or n and links / n < 0.25:
            out += blocks(c)
    end()
    return "\n\n".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(h) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) per row of pages.

    Null and empty html give an empty text; of containers with equal scores the first is best;
    repeated rows give equal texts; page_id and url may be null and are passed on.
    """
    d = pick(pages, "page_id", "url", "html")
    k = dict(d.dtypes)
    return d.mapInArrow(_extract, f"page_id {k['page_id']}, url {k['url']}, text string, n_chars bigint")
