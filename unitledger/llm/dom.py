"""A small tolerant HTML tree, its text blocks, and simple tree matching of two trees."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:>|\Z)|[^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")

# Element names by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in "script style textarea title xmp iframe noembed noframes".split()}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCKS - set("caption dd dt legend li option td th tr tbody thead tfoot title head html body".split())
CLOSED_BY = {  # a start tag closes an open element of these, unless one of the others lies between
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
_P_LIMITS = {"table", "td", "th", "caption", "button", "object", "template", "html"}


class Node:
    __slots__ = ("tag", "attrs", "children", "label", "sign", "order")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []
        self.label = tag + "." + re.sub(r"[0-9]+", "", attrs.get("class", "")) if "class" in attrs else tag
        self.sign = -1
        self.order = -1

    def elements(self) -> list[Node]:
        return [c for c in self.children if c.__class__ is Node]

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += reversed(node.elements())

    def own_text(self) -> str:
        return " ".join(" ".join(c for c in self.children if c.__class__ is str).split())


def _close(stack: list[Node], tags: set[str], limits: set[str]) -> None:
    """Closes the outermost open element of `tags` that no element of `limits` encloses more closely."""
    found = 0
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in limits:
            break
        if stack[i].tag in tags:
            found = i
    if found:
        del stack[found:]


def parse(html: str) -> Node:
    """The tree of a page. Unclosed elements end where HTML implies it, stray end tags are skipped,
    comments and the content of scripts and the like are left out, character references decoded."""
    root = Node("#root", {})
    stack = [root]
    at = 0
    size = len(html)
    while at < size:
        token = _TOKEN.search(html, at)
        start = token.start() if token else size
        if start > at:
            stack[-1].children.append(unescape(html[at:start]))
        if token is None:
            break
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name = name.lower()
        if token[1]:
            if name == "br":
                stack[-1].children.append(" ")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    del stack[i:]
                    break
                if stack[i].tag in ("td", "th", "table") and name not in ("tr", "table", "tbody", "thead", "tfoot", "html", "body"):
                    break
            continue
        if name in CLOSES_P:
            _close(stack, {"p"}, _P_LIMITS)
        if name in CLOSED_BY:
            _close(stack, *CLOSED_BY[name])
        rest = token[3].rstrip("/>")
        attrs = {}
        if rest and not rest.isspace():
            for m in _ATTRIBUTE.finditer(rest):
                attrs.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
        node = Node(name, attrs)
        stack[-1].children.append(node)
        if name in RAW:
            end = RAW[name].search(html, at)
            if end is None:
                break
            close = html.find(">", end.end())
            at = close + 1 if close >= 0 else size
        elif name not in VOID:
            stack.append(node)
    return root


class Shapes:
    """Numbers equal shapes of subtrees alike, and remembers how well two shapes match."""

    LIMIT = 200_000

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.nodes: dict[int, tuple[str, tuple[int, ...]]] = {}
        self.known: dict[tuple[int, int], int] = {}

    def sign(self, root: Node) -> None:
        if len(self.numbers) > self.LIMIT or len(self.known) > 10 * self.LIMIT:
            self.__init__()
        order = list(root.walk())
        for i, node in enumerate(order):
            node.order = i
        for node in reversed(order):
            own = []
            for child in node.elements():
                if not own or own[-1] != child.sign:  # repeated siblings count as one
                    own.append(child.sign)
            key = (node.label, tuple(own))
            node.sign = self.numbers.setdefault(key, len(self.numbers))
            self.nodes[node.sign] = key

    def match(self, a: int, b: int) -> int:
        """Most nodes that a top-down order-keeping mapping of two trees pairs up."""
        if a == b:
            return self._size(a)
        found = self.known.get((a, b))
        if found is None:
            (x, left), (y, right) = self.nodes[a], self.nodes[b]
            found = 0 if x != y else 1 + self._table(left, right)[-1][-1]
            self.known[a, b] = found
        return found

    def _size(self, a: int) -> int:
        found = self.known.get((a, a))
        if found is None:
            found = self.known[a, a] = 1 + sum(map(self._size, self.nodes[a][1]))
        return found

    def _table(self, left: tuple[int, ...], right: tuple[int, ...]) -> list[list[int]]:
        rows = [[0] * (len(right) + 1)]
        for a in left:
            above = rows[-1]
            row = [0]
            for j, b in enumerate(right):
                pair = self.match(a, b)
                row.append(max(above[j + 1], row[-1], above[j] + pair if pair else 0))
            rows.append(row)
        return rows

    def align(self, a: Node, b: Node) -> Iterator[tuple[Node, Node]]:
        """Pairs of nodes that the best mapping of two signed trees pairs up."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if a.label != b.label:
                continue
            yield a, b
            left, right = _runs(a), _runs(b)
            if a.sign == b.sign:
                pairs = list(zip(left, right))
            else:
                pairs = self._best(left, right)
            for x, y in pairs:
                stack += zip(x, y)

    def _best(self, left: list[list[Node]], right: list[list[Node]]) -> list[tuple[list[Node], list[Node]]]:
        head = 0
        while head < min(len(left), len(right)) and left[head][0].sign == right[head][0].sign:
            head += 1
        tail = 0
        while tail < min(len(left), len(right)) - head and left[-1 - tail][0].sign == right[-1 - tail][0].sign:
            tail += 1
        pairs = list(zip(left[:head], right[:head])) + (list(zip(left[-tail:], right[-tail:])) if tail else [])
        left, right = left[head : len(left) - tail], right[head : len(right) - tail]
        if left and right:
            table = self._table(tuple(x[0].sign for x in left), tuple(x[0].sign for x in right))
            i, j = len(left), len(right)
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((left[i], right[j]))
        return pairs


def _runs(node: Node) -> list[list[Node]]:
    """Child elements, with neighbours of one shape together."""
    out: list[list[Node]] = []
    for child in node.elements():
        if out and out[-1][0].sign == child.sign:
            out[-1].append(child)
        else:
            out.append([child])
    return out
