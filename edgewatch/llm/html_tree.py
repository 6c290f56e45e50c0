"""A small HTML parser: nodes with labels, and the text of each node.

Only elements that shape a page are nodes: blocks, and inline elements with a class or id. Other inline
elements are part of the text around them. Unclosed and misnested elements are closed where the next
block starts or their parent ends; nothing is ever an error.
"""

from __future__ import annotations

import html
import re
from collections import Counter

#: Elements deeper than this are part of the text around them.
MAX_DEPTH = 400

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe template svg math textarea select title".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr acronym nobr".split()
)
NO_PARAGRAPH_INSIDE = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]), "body": frozenset(["head"]),
}
SCOPE = frozenset("html body table td th ul ol dl article section main div aside nav header footer form".split())
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMES = frozenset(["class", "id", "role", "hidden", "style", "aria-hidden"])


class Node:
    __slots__ = ("attributes", "children", "label", "links", "tag")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []
        self.links = 0
        names = f"{attributes.get('class', '')}#{attributes.get('id', '')}"
        self.label = f"{tag}.{re.sub(r'[0-9]+', '', names)}" if len(names) > 1 else tag

    def nodes(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    def raw(self, dropped=lambda node: False) -> str:
        """The text with a space at each block's edges; ``dropped`` nodes are left out."""
        parts, stack = [], [(self, iter(self.children))]
        while stack:
            node, rest = stack[-1]
            for child in rest:
                if isinstance(child, str):
                    parts.append(child)
                elif not dropped(child):
                    if child.tag not in INLINE:
                        parts.append(" ")
                    stack.append((child, iter(child.children)))
                    break
                elif child.tag not in INLINE:
                    parts.append(" ")
            else:
                stack.pop()
                if node.tag not in INLINE:
                    parts.append(" ")
        return "".join(parts)


def tidy(raw: str) -> str:
    return " ".join(raw.split())


def _attributes(text: str) -> dict[str, str]:
    if not text.strip(" /"):
        return {}
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        if name.lower() in _NAMES:
            found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def parse(page: str) -> Node:
    root = Node("root", {})
    stack, at, in_link = [root], 0, False
    opened: Counter[str] = Counter()

    def close_to(index: int) -> None:
        opened.subtract(n.tag for n in stack[index:])
        del stack[index:]

    def text(part: str) -> None:
        if part:
            part = html.unescape(part) if "&" in part else part
            stack[-1].children.append(part)
            if in_link:
                stack[-1].links += len(part)

    while True:
        start = page.find("<", at)
        if start < 0:
            text(page[at:])
            break
        text(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = len(page) if end < 0 else end + 1
            continue
        m = _TAG.match(page, start) or _LOOSE.match(page, start)
        if not m:
            text("<")
            at = start + 1
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:  # an end tag
            if tag == "a":
                in_link = False
            for index in range(len(stack) - 1, 0, -1) if opened[tag] > 0 else ():
                if stack[index].tag == tag:
                    close_to(index)
                    break
                if tag in INLINE and stack[index].tag not in INLINE or tag == "p" and stack[index].tag in SCOPE:
                    break
            else:
                if tag == "br":
                    text(" ")
            continue
        if tag in VOID:
            text(" " if tag in ("br", "hr") else "")
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                ends = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                # without an end a script or style is the rest of the page, others are only a stray tag
                at = ends.end() if ends else len(page) if tag in ("script", "style") else at
            continue
        if tag == "a":
            in_link = True
        attributes = _attributes(m[3])
        if tag in INLINE and not attributes or len(stack) > MAX_DEPTH:
            text(" " if tag not in INLINE else "")
            continue
        if tag in NO_PARAGRAPH_INSIDE:
            for index in range(len(stack) - 1, 0, -1):
                if stack[index].tag == "p":
                    close_to(index)
                    break
                if stack[index].tag not in INLINE:
                    break
        if tag in CLOSES:
            for index in range(len(stack) - 1, 0, -1):
                if stack[index].tag in CLOSES[tag]:
                    close_to(index)
                    if tag != "tr":
                        break
                elif stack[index].tag in SCOPE and tag != "body":
                    break
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        stack.append(node)
        opened[tag] += 1
    return root
