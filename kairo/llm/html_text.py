"""Operator 12: the main text of web pages, by tree scoring.

A page is cut into tags and text, from which a tree is built with the end tags
that HTML lets authors leave out.  Boilerplate elements (by tag, role, class or id)
go.  Every paragraph earns points for its length and commas, discounted by its link
density; it passes them to its parent whole and halved to each further ancestor.
The container with the most points, after its own link density, is the main one, but
an ``article`` or ``main`` with a twentieth of them comes first; one around it takes
its place, else an ancestor in which other containers earned a share of the points
too.  Kept are its blocks and, beside a container that is no ``article`` or ``main``,
those of its siblings that score well or are low-link paragraphs.

Plan: one Arrow map over the pages; no shuffle, no state between pages.  All walks
are loops, so nesting may be as deep as a page likes, and every step is linear in
the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
CLOSES_P = frozenset(
    "address article aside blockquote body center details dialog dd dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split())
BLOCK = CLOSES_P | frozenset("caption legend option search template button".split())
SCOPE = frozenset("html body table td th caption button object template".split())
TABLE = frozenset("html body table caption thead tbody tfoot tr td th".split())
#: A start tag ends the open elements of the first set, looked for up to the second.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
        "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
        "thead": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# What is never main text.
DROP_TAGS = frozenset(
    "head script style template noscript iframe object embed svg math canvas video audio map nav "
    "footer aside form button input select textarea dialog menu search title xmp noembed "
    "noframes".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                       "alertdialog menu menubar toolbar".split())
DROP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot adsense adsbygoogle adbox adunit "
    "banner sponsor sponsored dropdown responses feedback "
    "promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside "
    "footer masthead topbar comment comments commentlist disqus respond reply replies "
    "notice notices cookie cookies consent gdpr alert newsletter subscribe subscription signup "
    "login share sharing social related recommended popular trending popup modal overlay toolbar "
    "pagination pager widget disclaimer copyright hidden skip".split())
#: Never main text outside an ``article`` or ``main``; a part's own header keeps its headings.
OUTER_WORDS = frozenset("header discussion announcement".split())
PART_WORDS = frozenset("article content entry post story".split())
PLAIN_WORDS = frozenset("area block box container list reader section thread user wrap wrapper".split())
MAIN_TAGS = frozenset(["article", "main"])
ROOTS = frozenset(["#root", "html", "body"])
PARAGRAPHS = frozenset("p pre blockquote td th li dd dt figcaption".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NEXT = re.compile(r"<(?=[a-zA-Z/!?])")
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_COMMA = re.compile("[,،、，]")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "points", "length", "linked")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.points, self.length, self.linked = 0.0, 0, 0


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name, rest)`` with kind ``start`` (rest: attributes), ``end`` or
    ``text`` (rest: decoded).  Comments and declarations go; a tag or comment
    that the page's end cuts off goes with what follows it."""
    at, n = 0, len(html)
    while at < n:
        m = _NEXT.search(html, at)
        to = m.start() if m else n
        if to > at:
            yield "text", "", unescape(html[at:to])
        if not m:
            return
        if html.startswith("<!--", to):
            end = html.find("-->", to + 2)
            at = n if end < 0 else end + 3
        elif html[to + 1] in "!?" or html[to + 1] == "/" and not html[to + 2:to + 3].isalpha():
            end = html.find(">", to)
            at = n if end < 0 else end + 1
        else:
            m = _TAG.match(html, to)
            if not m:
                return
            name, at = m[2].lower(), m.end()
            if m[1]:
                yield "end", name, ""
                continue
            yield "start", name, m[3]
            if name in RAW and not m[3].endswith("/"):
                m = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(html, at)
                at = m.start() if m else n


def _pop(node: Node, names, stop) -> Node:
    """The parent of the outermost open element of ``names`` below ``stop``."""
    found, at = node, node
    while at.parent is not None and at.tag not in stop:
        if at.tag in names:
            found = at.parent
        at = at.parent
    return found


def tree(html: str) -> Node:
    root = node = Node("#root", "", None)
    open_: dict[str, int] = {}
    for kind, name, rest in tokens(html):
        if kind == "text":
            node.children.append(rest)
            continue
        before = node
        if kind == "start":
            if open_.get("p") and name in CLOSES_P:
                node = _pop(node, {"p"}, SCOPE)
            if name in HEADINGS and node.tag in HEADINGS:
                node = node.parent
            if name in ENDS and any(open_.get(x) for x in ENDS[name][0]):
                node = _pop(node, *ENDS[name])
        elif open_.get(name):
            # the end of a block or inline element reaches no table cell or block around it
            wall = () if name in TABLE else SCOPE if name in BLOCK else BLOCK
            at = node
            while at.tag != name and at.tag not in wall:
                at = at.parent
            if at.tag == name:
                node = at.parent
        while before is not node:
            open_[before.tag] -= 1
            before = before.parent
        if kind == "start":
            child = Node(name, rest, node)
            node.children.append(child)
            if name not in VOID and not (rest.endswith("/") and name not in BLOCK):
                node = child
                open_[name] = open_.get(name, 0) + 1
    return root


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _boilerplate(node: Node, in_main: bool) -> bool:
    if node.tag in DROP_TAGS:
        return True
    if node.tag == "header" and not in_main:
        return True
    if node.tag in MAIN_TAGS or node.tag in ROOTS:
        words = DROP_WORDS & {"comment", "comments", "reply"} if node.tag == "article" else ()
    else:
        words = DROP_WORDS
    if not node.attrs or not words:
        return False
    a = _attributes(node.attrs)
    style = a.get("style", "").replace(" ", "").lower()
    if ("hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in style
            or a.get("role", "").lower() in DROP_ROLES):
        return True
    if not in_main and node.tag not in MAIN_TAGS | ROOTS:
        words = words | OUTER_WORDS
    if {w.lower() for w in _WORD.findall(a.get("class", ""))} & words:
        return True
    ids = {w.lower() for w in _WORD.findall(a.get("id", ""))}
    if in_main:          # there an id is often a heading's words
        return node.tag not in HEADINGS and bool(ids & words) and ids <= words | PLAIN_WORDS
    return bool(ids & words)


def _part_header(node: Node, in_main: bool) -> bool:
    """The header of a part of the page: in it only headings are main text."""
    if node.tag == "header":
        return in_main
    if "header" not in node.attrs.lower():
        return False
    names = {w.lower() for w in _WORD.findall(_attributes(node.attrs).get("class", ""))}
    return "header" in names and bool(names & PART_WORDS)


def _headings(node: Node) -> list[Node]:
    return [n for n in _order(node) if n.tag in HEADINGS]


def _holds_main(root: Node) -> set[int]:
    """Elements around an ``article`` or ``main``: no class makes them boilerplate."""
    out, stack = set(), [root]
    while stack:
        node = stack.pop()
        if node.tag in MAIN_TAGS:
            at = node.parent
            while at is not None and id(at) not in out:
                out.add(id(at))
                at = at.parent
        stack += [c for c in node.children if not isinstance(c, str)]
    return out


def prune(root: Node) -> None:
    """Take boilerplate elements out of the tree; of a header in the main part
    the headings stay."""
    around = _holds_main(root)
    stack = [(root, False)]
    while stack:
        node, in_main = stack.pop()
        in_main = in_main or node.tag in MAIN_TAGS
        kept = []
        for c in node.children:
            if isinstance(c, str):
                kept.append(c)
            elif _part_header(c, in_main):
                kept += _headings(c)
            elif id(c) in around and c.tag not in DROP_TAGS or not _boilerplate(c, in_main):
                kept.append(c)
                stack.append((c, in_main))
        node.children = kept


def _order(root: Node) -> list[Node]:
    """Elements, parents before children, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in reversed(node.children) if not isinstance(c, str)]
    return out


def _direct(node: Node) -> str:
    """The text of a node outside the blocks within it."""
    out, stack = [], list(reversed(node.children))
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.tag in BLOCK or c.tag == "br":
            out.append(" ")
        else:
            stack += reversed(c.children)
    return "".join(out)


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def score(root: Node) -> list[Node]:
    """Measure text and links of every element, and pass the points of paragraphs
    up; returns the elements in page order."""
    nodes = _order(root)
    for node in reversed(nodes):
        node.length = sum(len(" ".join(c.split())) if isinstance(c, str) else c.length
                          for c in node.children)
        node.linked = node.length if node.tag == "a" else sum(
            c.linked for c in node.children if not isinstance(c, str))
    share: dict[int, float] = {}
    for node in nodes:
        if node.tag not in BLOCK and node.tag not in ROOTS:
            continue
        text = " ".join(_direct(node).split())
        if not text or node.tag in HEADINGS:
            continue
        points = (1 + len(_COMMA.findall(text)) + min(len(text) / 100, 3.0)) * (1 - _density(node))
        to = node.parent if node.tag in PARAGRAPHS and node.parent is not None else node
        share[id(to)] = share.get(id(to), 0.0) + points
    # a container's points: its own share whole, and half of what each child has
    for node in reversed(nodes):
        node.points += share.get(id(node), 0.0)
        if node.parent is not None:
            node.parent.points += node.points / 2
    for node in nodes:
        node.points *= 1 - _density(node)
    return nodes


def main_nodes(root: Node) -> list[Node]:
    """The best container and the siblings kept with it, in page order."""
    nodes = score(root)
    best = max((n for n in nodes if n.tag in BLOCK or n.tag in ROOTS), key=lambda n: n.points,
               default=root)
    named = max((n for n in nodes if n.tag in MAIN_TAGS), default=best,
                key=lambda n: (n.points, n.tag == "article"))
    if best.points <= 0 or named.points >= best.points / 20:
        best = named                     # marked as the main part, unless it is a mere teaser
    around, outer = {}, best
    while outer is not None:
        around[outer.tag], outer = outer, outer.parent
    top = around.get("article") or around.get("main") or best
    if top.tag not in MAIN_TAGS:
        # other containers beside it earned points too: their common parent is the main one
        while top.parent is not None and top.parent.tag not in ROOTS and any(
                c is not top and not isinstance(c, str) and c.points >= best.points / 5
                for c in top.parent.children):
            top = top.parent
    if top.parent is None or top.tag in ROOTS or top.tag in MAIN_TAGS:
        return [top]
    keep = []
    for c in top.parent.children:
        if isinstance(c, str):
            continue
        plain = c.length > 0 and _density(c) < 0.25
        if c is top or (plain and c.points >= max(10.0, best.points / 5)) or (
                plain and c.tag in PARAGRAPHS | HEADINGS):
            keep.append(c)
    return keep


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks, white space within one made one space."""
    out, now = [], []

    def flush():
        text = " ".join("".join(now).split())
        now.clear()
        if text:
            out.append(text)

    for top in nodes:
        stack: list = [top]
        while stack:
            c = stack.pop()
            if c is None:
                flush()
            elif isinstance(c, str):
                now.append(c)
            elif c.tag == "br":
                now.append(" ")
            elif c.tag in ("ul", "ol", "dl", "table") and c.linked and _density(c) > 0.8:
                flush()                              # a list of links is a menu
            elif c.tag in BLOCK or c.tag in ROOTS:
                flush()
                stack.append(None)
                stack += reversed(c.children)
            else:
                stack += reversed(c.children)
        flush()
    return out


def main_text(html: str | None) -> str:
    """Main text of one page; empty for null, empty and textless pages."""
    if not html:
        return ""
    root = tree(html)
    prune(root)
    return "\n\n".join(blocks(main_nodes(root)))


def extract_text(pages: DataFrame, *, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")
                 ) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` (code points) of every row.

    Null, empty or textless pages have the empty text; repeated rows stay, each
    with its text; an empty table gives none; columns other than ``keep`` are left
    aside, whatever their names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, "text", "n_chars"])

    df = pages.select(*keep, F.col(html).alias("_html"))
    schema = T.StructType([*df.schema.fields[:-1], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    return df.mapInArrow(run, schema)
