"""A page's text blocks and its tree, for the wrapper induction: a small tolerant reader of HTML.

``read`` gives the blocks of a page in order and its tree. Elements that are never part of an article (by tag, role or the words of
their class and id) carry their kind. In the tree, siblings of one label (tag, class and id, with digits made alike) are one node, so
repeated items have one place whatever their number; inline elements have none. Nodes deeper than ``DEPTH`` levels count to their
ancestor there, and beyond ``LABELS`` different siblings classes and ids are left aside; no text is lost by that.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

DEPTH, LABELS = 40, 64

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TELLING = re.compile(r"class|id|role|hidden|style", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img br picture source track video audio map area".split()
)
BLOCK = frozenset(
    "address article aside blockquote body button canvas caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noframes noscript object ol optgroup option "
    "p pre script search section select style summary svg table tbody td template textarea tfoot th thead title tr ul xmp".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in ("script", "style", "textarea", "title", "iframe", "noframes", "noscript", "xmp")}
#: an element of the first kind ends at the start of one of the second, up to one of the third
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dd": {"dl"}, "dt": {"dl"}}

#: never part of an article
DROP_TAGS = frozenset(
    "aside button canvas dialog footer form head iframe menu nav noframes noscript object option optgroup script search select style svg template textarea title".split()
)
DROP_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot banner banners sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus menubar breadcrumb breadcrumbs sidebar sidebars footer header masthead cookie cookies consent gdpr "
    "notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "comment comments commentlist disqus replies respond pagination pager toolbar topbar widget widgets".split()
)
REMARKS = frozenset("comment comments commentlist disqus replies respond".split())
#: words before one of those that turn its meaning: an element beside a sidebar is none
BESIDE = frozenset("no has with without is".split())


@dataclass
class Node:
    """A place in the tree of a page."""

    label: str
    children: dict[str, Node] = field(default_factory=dict)
    used: bool = False
    number: int = -1


@dataclass
class Block:
    """A run of text between the borders of block elements. ``drop``: '' (kept), 'soft' (by its names or a form) or 'hard'."""

    node: Node
    text: str
    links: int
    linked: int
    drop: str
    region: int
    listed: bool


def named(tag: str, attributes: str) -> tuple[str, str, bool]:
    """(label, drop, whether it is named as reader comments)."""
    return _named(tag, attributes) if _TELLING.search(attributes) else (tag, "", False)


@lru_cache(maxsize=8192)
def _named(tag: str, attributes: str) -> tuple[str, str, bool]:
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), a or b or c)
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    label = _DIGITS.sub("0", ".".join([tag, *names]))
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return label, "hard", False
    drop = "soft" if found.get("role", "").lower() in DROP_ROLES else ""
    remarks = False
    if tag not in ("html", "body", "main"):
        for name in names:
            words = [w.lower() for w in _WORD.findall(name)]
            for i, word in enumerate(words):
                if word in DROP_WORDS and not (i and words[i - 1] in BESIDE):
                    drop, remarks = drop or "soft", remarks or word in REMARKS
    return label, drop, remarks


class _Reader:
    def __init__(self):
        self.root = Node("")
        self.stack: list[tuple[str, Node, str, int, bool]] = []  # tag, node, drop, region, in a list
        self.open: dict[str, int] = {}
        self.blocks: list[Block] = []
        self.regions: list[str] = []
        self.text: list[str] = []
        self.links = self.linked = self.in_link = 0

    def top(self) -> tuple[str, Node, str, int, bool]:
        return self.stack[-1] if self.stack else ("", self.root, "", -1, False)

    def say(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        self.text.append(text)
        if self.in_link:
            self.linked += len("".join(text.split()))

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                _, node, drop, region, listed = self.top()
                self.blocks.append(Block(node, text, self.links, self.linked, drop, region, listed))
            self.text = []
        self.links = self.linked = 0

    def pop(self) -> None:
        tag = self.stack.pop()[0]
        self.open[tag] -= 1
        if tag == "a":
            self.in_link -= 1

    def pop_to(self, at: int) -> None:
        self.flush()
        while len(self.stack) > at:
            self.pop()

    def close_within(self, tags: set[str], border: set[str] | None) -> None:
        """End the innermost open element of these tags, if no border (null: any other block) lies above it."""
        found = None
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag in tags:
                found = i
                if border is None or tag not in ("td", "th"):
                    break
            elif (tag not in INLINE) if border is None else (tag in border):
                break
        if found is not None:
            self.pop_to(found)

    def start(self, tag: str, attributes: str) -> None:
        inline = tag not in BLOCK
        if tag in ("br", "hr") or (tag in VOID and not inline):
            if tag == "br":
                self.text.append(" ")
            else:
                self.flush()
            return
        if tag in VOID:
            return
        _, node, drop, region, listed = self.top()
        if inline:
            own = ""
            if attributes and not drop:
                _, own, _ = named(tag, attributes)
            if tag == "a":
                if self.open.get("a"):
                    self.close_within({"a"}, None)
                self.links += 1
                self.in_link += 1
            if own:  # an advert in a line, say: a block of its own
                self.flush()
                _, node, drop, region, listed = self.top()
            self.push(tag, node, drop or own, region, listed)
            return
        self.flush()
        if self.open.get("p"):
            self.close_within({"p"}, None)
        if tag in ENDS and any(map(self.open.get, ENDS[tag][0])):
            self.close_within(*ENDS[tag])
        _, node, drop, region, listed = self.top()
        label, own, remarks = named(tag, attributes) if attributes else (tag, "", False)
        if tag in DROP_TAGS:
            own = "soft" if tag == "form" else "hard"
        elif tag == "header" and region < 0:
            own = "hard"
        elif own == "soft" and not remarks and (region >= 0 and {"header"} >= self.words(label)):
            own = ""  # an article's own header
        if remarks:
            own = "hard"
        drop = "hard" if "hard" in (drop, own) else drop or own
        if region < 0 and drop != "hard" and (tag in ("article", "main") or "articleBody" in attributes):
            region = len(self.regions)
            self.regions.append(tag)
        elif region >= 0 and tag == "article" and self.regions[region] == "main" and drop != "hard":
            region = len(self.regions)
            self.regions.append(tag)
        if len(self.stack) < DEPTH:
            if label not in node.children and len(node.children) >= LABELS:
                label = tag
            node = node.children.setdefault(label, Node(label))
        self.push(tag, node, drop, region, listed or tag in ("ul", "ol", "dl"))

    @staticmethod
    def words(label: str) -> set[str]:
        return {w.lower() for name in label.split(".")[1:] for w in _WORD.findall(name)} & DROP_WORDS

    def push(self, tag: str, node: Node, drop: str, region: int, listed: bool) -> None:
        self.stack.append((tag, node, drop, region, listed))
        self.open[tag] = self.open.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if not self.open.get(tag) or tag in ("html", "body"):
            return
        if tag in BLOCK:
            if tag == "p":
                self.close_within({"p"}, None)
                return
            border = SCOPE.get(tag, set())
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == tag:
                    self.pop_to(i)
                    return
                if self.stack[i][0] in border:
                    return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if self.stack[i][2] != (self.stack[i - 1][2] if i else ""):
                    self.flush()  # a dropped element in a line ends
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i][0] in BLOCK:
                return


def read(html: str) -> tuple[Node, list[Block], list[str]]:
    """(the root of the tree, the blocks, the tags of regions) of a page."""
    reader = _Reader()
    at, n = 0, len(html)
    find = _TOKEN.search
    while at < n:
        token = find(html, at)
        if token is None:
            reader.say(html[at:])
            break
        if token.start() > at:
            reader.say(html[at : token.start()])
        at = token.end()
        kind = token.lastindex
        if kind is None:
            continue
        slash, name, attributes = token.group(kind - 2, kind - 1, kind)
        name = name.lower()
        if slash:
            reader.end(name)
            continue
        if name in RAW:
            close = RAW[name].search(html, at)
            if close is not None:
                at = close.end()
                reader.flush()
                continue
            if name in ("script", "style"):
                break
            continue
        reader.start(name, attributes)
    reader.flush()
    return reader.root, reader.blocks, reader.regions
