"""A small, forgiving HTML tree for text extraction, in time linear in the page.

Block elements are nodes; inline elements are not, but links are counted.  A node
keeps its own text in runs, so text before and after a child stays apart.
Scripts, styles and other elements without readable text leave nothing.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                     "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: An opening tag ends open elements of these kinds, up to the boundary.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
#: A tag by the rules of the standard: quotes count only right after ``=``, and what
#: is open at the page's end takes the rest.  Nothing is given back (``*+``), so a
#: page is read once, however its tags are broken.
_ATTRIBUTE = r"[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+"
TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)(>|\Z)|<(?:[!?]|/(?=[^a-zA-Z]))[^>]*+(?:>|\Z)", re.S | re.A)
ATTRIBUTES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


class Node:
    __slots__ = ("tag", "tokens", "parent", "children", "runs", "linked", "tags", "keep")

    def __init__(self, tag, tokens, parent):
        self.tag, self.tokens, self.parent = tag, tokens, parent
        self.children: list[Node] = []
        #: Own text: (characters' place in the page's order, text).
        self.runs: list[list] = []
        self.linked = self.tags = 0
        self.keep = True


def parse(html: str) -> tuple[Node, list[Node]]:
    """(root, nodes in page order)."""
    root = Node("body", "", None)
    nodes, stack, links, order = [root], [root], 0, 0
    at, end, fresh = 0, len(html), True
    #: Places of the open elements of each kind, so that none is searched for in the stack.
    places: dict[str, list[int]] = {}

    def text(raw: str):
        nonlocal fresh, order
        if not raw:
            return
        node = stack[-1]
        if "&" in raw:
            raw = unescape(raw)
        if fresh or not node.runs:
            order += 1
            node.runs.append([order, [raw]])
            fresh = False
        else:
            node.runs[-1][1].append(raw)
        if links:
            node.linked += len(raw)

    def close(index: int):
        nonlocal fresh
        for node in stack[index:]:
            places[node.tag].pop()
        del stack[index:]
        fresh = True

    while at < end:
        m = TOKEN.search(html, at)
        if m is None:
            text(html[at:])
            break
        if m.start() > at:
            text(html[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None or not m.group(4):        # a comment, or a tag that never ends
            continue
        tag, closing = tag.lower(), m.group(1)
        if tag in RAW:
            if not closing and not m.group(3).endswith("/"):
                done = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
                at = html.find(">", done.start()) + 1 if done else end
                at = at or end
            continue
        if tag in INLINE:
            stack[-1].tags += 1
            if tag == "a":
                links = 0 if closing else 1
            continue
        if tag in VOID:
            if tag in ("br", "hr", "img"):
                text(" ")
            continue
        if tag in ("html", "head", "body"):
            if tag == "body" and not closing:
                root.tokens = _tokens(m.group(3))
            continue
        if closing:
            if places.get(tag):
                close(places[tag][-1])
            links = 0
            continue
        links = 0
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag not in ("li", "dd", "dt"):
                    break
        elif tag in ENDS:
            kinds, limits = ENDS[tag]
            limit = max((places[t][-1] for t in limits if places.get(t)), default=0)
            inside = [places[t][i] for t in kinds if (i := bisect_right(places.get(t, ()), limit)) < len(places.get(t, ()))]
            if inside:
                close(min(inside))
        node = Node(tag, _tokens(m.group(3)), stack[-1])
        stack[-1].children.append(node)
        nodes.append(node)
        fresh = True
        if not m.group(3).endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
    for node in nodes:
        for run in node.runs:
            run[1] = "".join(run[1])
    return root, nodes


def _tokens(raw: str) -> str:
    if not raw:
        return ""
    found = [a or b or c for a, b, c in ATTRIBUTES.findall(raw)]
    return re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(found)).lower() if found else ""


def block_texts(nodes: list[Node]) -> str:
    """The kept nodes' runs in page order: white space is one space, blocks are
    two line feeds apart."""
    runs = sorted((order, " ".join(text.split())) for n in nodes if n.keep for order, text in n.runs)
    return "\n\n".join(t for _, t in runs if t)
