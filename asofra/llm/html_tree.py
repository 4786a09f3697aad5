"""A small HTML parser that keeps what main-text extraction needs: the tree,
tag names, class and id words, and text with its block."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Fixed sets of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RAW_TEXT = frozenset("title textarea".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body button caption dd dt head html legend li optgroup option select tbody td tfoot th thead title tr".split())
#: A start tag ends an open element of these names, but none beyond the scope.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)), "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist")), "body": (("head",), ("html",)),
}
P_SCOPE = ("button", "table", "td", "th", "caption", "html")

TOKEN = re.compile(
    r"<!--(?:-?>|(?>.*?(?:--!?>|\Z)))"
    r"|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|</>"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?>"[^"]*+"|'[^']*+'|[^>"'])*+)(>|\Z)"""
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(>|\Z)"
    r"|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|data-gold)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z]+")


@dataclass
class Tree:
    """Nodes in page order, the root first. A text node has tag "#text"."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    words: list[tuple[str, ...]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    block: list[int] = field(default_factory=list)
    gold: list[int | None] = field(default_factory=list)

    def add(self, parent: int, tag: str, words: tuple[str, ...] = (), text: str = "", block: int = 0, gold: int | None = None) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.words.append(words)
        self.text.append(text)
        self.block.append(block)
        self.gold.append(gold)
        return len(self.parent) - 1


def parse(html: str) -> Tree:
    """The tree of a page. Anything is accepted: unclosed and misnested
    elements end where their ancestors do, a stray end tag is ignored, an
    unfinished tag at the end is dropped. The time is linear in the page."""
    tree = Tree()
    stack = [tree.add(-1, "#root")]
    #: Where in the stack elements of a name stand, and block elements.
    places: dict[str, list[int]] = {}
    blocks = [0]
    at, block, size = 0, 0, len(html)

    def last(names: tuple[str, ...]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def cut(k: int) -> None:
        for node in stack[k:]:
            places[tree.tag[node]].pop()
        while blocks[-1] >= k:
            blocks.pop()
        del stack[k:]

    def close(names: tuple[str, ...], scope: tuple[str, ...]) -> None:
        if (k := last(names)) > last(scope):
            cut(k)

    while at < size:
        token = TOKEN.match(html, at)
        begin, at = at, token.end()
        name = token[2] or token[6]
        if name is None:
            piece = token[0]
            if piece[0] != "<" or piece == "<":
                tree.add(stack[-1], "#text", text=unescape(piece) if "&" in piece else piece, block=block)
            continue
        if not (token[4] or token[8]):
            break
        name = name.lower()
        if name in BLOCK or name == "br":
            block += 1
        if token[1] or token[5]:
            k = last((name,))
            if k and (name in BLOCK or k > blocks[-1]):
                cut(k)
            continue
        if name in CLOSES_P:
            close(("p",), P_SCOPE)
        if name in ENDS:
            close(*ENDS[name])
        attributes = token[3] or token[7] or ""
        words, gold = [], None
        if "=" in attributes:
            for key, value in ATTRIBUTE.findall(attributes):
                if key == "data-gold":
                    gold = int(value.strip("\"'"))
                else:
                    words += WORD.findall(value.lower())
        node = tree.add(stack[-1], name, tuple(words), gold=gold)
        if name in RAW or name in RAW_TEXT:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(html, at)
            stop = end.start() if end else size
            if name in RAW_TEXT and stop > at:
                tree.add(node, "#text", text=unescape(html[at:stop]), block=block)
            at = stop
            if end:
                at = TOKEN.match(html, at).end()
            block += name in BLOCK
        elif name not in VOID:
            places.setdefault(name, []).append(len(stack))
            if name in BLOCK:
                blocks.append(len(stack))
            stack.append(node)
    return tree


def joined(tree: Tree, chosen: list[int]) -> str:
    """The text of the chosen text nodes, in page order: white space inside a
    block made one space, trimmed, blocks joined by one space."""
    blocks: dict[int, list[str]] = {}
    for k in chosen:
        blocks.setdefault(tree.block[k], []).append(tree.text[k])
    clean = (" ".join("".join(parts).split()) for parts in blocks.values())
    return " ".join(x for x in clean if x)
