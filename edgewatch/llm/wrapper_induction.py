"""Main text of pages by wrapper induction per host.

The pages of a host are aligned with a template tree, one after another, by simple tree matching: the
alignment of two sequences of children that maximises the number of matched nodes below. Neighbouring
siblings of one label are one template node (a list). Each template node counts its pages, the text that
is not in links, and how constant its text is. Constant nodes are template. Of the rest, the container
that holds the varying text of the host's pages is the content; what it holds is the page's text, in
order, without template nodes and without parts whose element says that they are boilerplate. A name is
only a hint: outside the content its node does not count, inside it goes if the template has it as a small
or constant part. A form that holds most of a page's text is a frame and not a form.

Templates are induced from all pages: every task folds its pages into partial templates, which are merged
per host in two salted steps. No run is ever refused a slot. Whenever ``MAX_NODES`` slots are new, those
go that at most a share ``RARE`` of the host's pages can have had, what was lost of them before included
(lossy counting); so at any size and in any order a slot of a greater share stays, and its counts lack at
most that share.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewatch.llm.html_tree import INLINE, MAX_DEPTH, Node, parse, tidy
from edgewatch.llm.rows import column, pieces
from edgewatch.session import materialize

MAX_NODES = 3_000
RARE = 0.02
MAX_HOSTS = 500
SALTS = 32
BROADCAST_BYTES = 16 << 20
MIN_PAGES = 5
CONSTANT = 0.6
SMALL_PART = 0.2
MOST = 0.8
#: Elements and parts of names that mark boilerplate.
DROP_TAGS = frozenset("nav footer aside form head button dialog menu object canvas audio video map".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disqus footer masthead menu modal nav navbar navigation newsletter notice notices pagination pager "
    "popup promo promotion recommended related replies reply respond share sharing sidebar social sponsor sponsored "
    "subscribe subscription toolbar widget widgets".split()
)
NOT_THE_PART = frozenset("has with no without hide".split())
HEADER_WORDS = frozenset(["header", "topbar"])
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
CONTAINERS = frozenset("root html body div section main article table tbody tr td center dl".split())
WHOLE = frozenset(["article", "main"])
FRAMES = frozenset(["root", "html", "body"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CODE = frozenset(["pre", "code", "samp", "kbd"])


def _words(name: str) -> set[str]:
    spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", name)
    return set(re.split(r"[^a-z]+", spaced.lower()))


_ROLES: dict[tuple, str] = {}


def _role(node: Node) -> str:
    """``drop``, ``header``, the kind of a name after a colon (its element and words, # for an id), or nothing."""
    a = node.attributes
    key = (node.tag, a.get("class"), a.get("id"), a.get("role"), a.get("style"), a.get("aria-hidden"), "hidden" in a)
    found = _ROLES.get(key)
    if found is None:
        of_class, names = _words(a.get("class", "")), _words(f"{a.get('class', '')} {a.get('id', '')}")
        words = names if node.tag not in (*FRAMES, *WHOLE) and not names & NOT_THE_PART else set()
        style = a.get("style", "").replace(" ", "").lower()
        hidden = "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in style
        if hidden or node.tag in DROP_TAGS or a.get("role") in DROP_ROLES:
            found = "drop"
        elif words & DROP_WORDS:
            marked = words & of_class & DROP_WORDS
            found = " ".join([f":{node.tag}", *(sorted(marked) or ["#", *sorted(words & DROP_WORDS)])])
        else:
            found = "header" if node.tag == "header" or words & HEADER_WORDS else ""
        if len(_ROLES) > 10_000:
            _ROLES.clear()
        _ROLES[key] = found
    return found


def marked(node: Node, inside: bool) -> bool:
    """Whether element or role mark the node as boilerplate; page headers only outside an article."""
    role = _role(node)
    return role == "drop" or role == "header" and not inside


def named(node: Node) -> str:
    """The kind of a boilerplate name; a page's frame can have such a name and hold the article."""
    role = _role(node)
    return role if role.startswith(":") and not _find_whole(node) else ""


def boilerplate(node: Node, inside: bool) -> bool:
    """Whether element, role or name mark the node."""
    return marked(node, inside) or bool(named(node))


def page_tree(page: str) -> Node:
    """The parsed page; forms that hold most of its text are plain containers."""
    root = parse(page)
    if not _FORM.search(page):
        return root
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [n for n in node.nodes() if n.tag == "form" or n.tag not in DROP_TAGS]
    sizes: dict[int, int] = {}
    for node in reversed(order):
        own = sum(len(tidy(c)) for c in node.children if isinstance(c, str))
        sizes[id(node)] = own + sum(sizes.get(id(n), 0) for n in node.nodes())
    for node in order:
        if node.tag == "form" and 2 * sizes[id(node)] > sizes[id(root)]:
            node.tag, node.label = "div", f"div{node.label[len('form') :]}"
            node.attributes = {k: v for k, v in node.attributes.items() if k != "role" or v != "form"}
    return root


_FORM = re.compile("<form", re.I)


def _find_whole(root: Node) -> list[Node]:
    """The outermost articles and mains below a node, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag in WHOLE:
            out.append(node)
        else:
            stack += [n for n in reversed(node.nodes()) if n.tag not in DROP_TAGS]
    return out


# two calls for each level of a tree
sys.setrecursionlimit(max(sys.getrecursionlimit(), 10 * MAX_DEPTH))


class Slot:
    """A template node. ``kept`` is the candidate for a constant text, ``margin`` its lead over others.

    ``named`` has a leaf for each kind of boilerplate name below it, counted but not aligned. ``lost`` of the
    root bounds the pages that a slot can have lost by pruning; ``early`` is what an older slot has not lost.
    """

    __slots__ = ("children", "early", "kept", "label", "lost", "margin", "mass", "named", "pages")

    def __init__(self, label: str):
        self.label, self.children = label, []
        self.named: dict[str, Slot] = {}
        self.pages = self.mass = self.margin = self.kept = self.lost = self.early = 0

    def vote(self, text_hash: int, weight: int) -> None:
        if text_hash == self.kept:
            self.margin += weight
        elif weight > self.margin:
            self.kept, self.margin = text_hash, weight - self.margin
        else:
            self.margin -= weight

    def dump(self) -> list:
        below = [[c.dump() for c in own] for own in (self.children, self.named.values())]
        return [self.label, self.pages, self.mass, self.kept, self.margin, *below, self.lost, self.early]

    @classmethod
    def load(cls, row: list) -> Slot:
        slot = cls(row[0])
        slot.pages, slot.mass, slot.kept, slot.margin = row[1:5]
        slot.children = [cls.load(c) for c in row[5]]
        slot.named = {c[0]: cls.load(c) for c in row[6]}
        slot.lost, slot.early = row[7:9]
        return slot


# --- simple tree matching -----------------------------------------------------------------------


def _runs(children: list) -> list[tuple[str, list]]:
    """Neighbours of one label together."""
    runs: list[tuple[str, list]] = []
    for child in children:
        if runs and runs[-1][0] == child.label:
            runs[-1][1].append(child)
        else:
            runs.append((child.label, [child]))
    return runs


def _below(node) -> list:
    return node.children if isinstance(node, Slot) else node.nodes()


def _weight(slot: Slot, node, memo: dict) -> int:
    """Size of the greatest matching of the two trees, roots matched."""
    key = (id(slot), id(node))
    if key not in memo:
        memo[key] = 1 + _table(slot.children, _runs(_below(node)), memo)[-1][-1]
    return memo[key]


def _table(slots: list[Slot], runs: list, memo: dict) -> list[list[int]]:
    rows = [[0] * (len(runs) + 1)]
    for slot in slots:
        last, row = rows[-1], [0]
        for j, (label, nodes) in enumerate(runs):
            best = max(row[j], last[j + 1])
            if label == slot.label:
                best = max(best, last[j] + _weight(slot, nodes[0], memo))
            row.append(best)
        rows.append(row)
    return rows


def align(slots: list[Slot], runs: list) -> list[int | None]:
    """For each run the number of the slot that it is matched with, ascending."""
    if [s.label for s in slots] == [label for label, _ in runs]:
        return list(range(len(runs)))
    memo: dict = {}
    rows, i, j = _table(slots, runs, memo), len(slots), len(runs)
    out: list[int | None] = [None] * len(runs)
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out[j] = i
    return out


def _slots_for(template: Slot, runs: list, room: list[int]) -> list[Slot]:
    """The template's slots of the runs; runs without one get a new slot, which takes from the room."""
    matched = align(template.children, runs)
    found: list[Slot | None] = [None if i is None else template.children[i] for i in matched]
    at = len(template.children)
    for number in range(len(runs) - 1, -1, -1):
        if matched[number] is not None:
            at = matched[number]
        else:
            room[0] -= 1
            found[number] = Slot(runs[number][0])
            template.children.insert(at, found[number])
    return found


def prune(template: Slot, room: list[int]) -> None:
    """Take out what a share of at most ``RARE`` of the pages can have had; new room for as many as stay."""
    limit, left = max(int(RARE * template.pages), template.lost), 0
    more, stack = limit - template.lost, [template]
    while stack:
        slot = stack.pop()
        slot.children = [c for c in slot.children if c.pages + template.lost - c.early > limit]
        for child in slot.children:
            child.early += more
        left += len(slot.children)
        stack += slot.children
    template.lost = limit
    room[0] = max(MAX_NODES, left)


def settle(template: Slot) -> Slot:
    """The text that slots can have lost is added to them."""
    stack = list(template.children)
    while stack:
        slot = stack.pop()
        slot.mass += slot.mass * (template.lost - slot.early) // max(slot.pages, 1)
        stack += slot.children
    return template


def add_page(template: Slot, root: Node, room: list[int]) -> None:
    """Align a page with the template and count it."""
    touched: dict[int, list] = {id(template): [template, 0, []]}
    apart: list[tuple[Node, bool]] = []
    stack = [(template, root, False)]
    while stack:
        slot, node, inside = stack.pop()
        inside = inside or node.tag in WHOLE
        below = []
        for n in node.nodes():
            kind = "" if marked(n, inside) else named(n)
            if kind:
                leaf = slot.named.setdefault(kind, Slot(kind))
                touched.setdefault(id(leaf), [leaf, 0, []])[2].append(n)
                apart.append((n, inside))
            elif not marked(n, inside):
                below.append(n)
        runs = _runs(below)
        for found, (_, nodes) in zip(_slots_for(slot, runs, room), runs, strict=True):
            entry = touched.setdefault(id(found), [found, 0, []])
            for n in nodes:
                entry[2].append(n)
                stack.append((found, n, inside))
    texts: dict[int, tuple[str, int]] = {}

    def text_of(node: Node, inside: bool) -> tuple[str, int]:
        """Kept text and how much of it is in links; a node's children first."""
        order, todo = [], [(node, inside)]
        while todo:
            n, deep = todo.pop()
            if id(n) in texts:
                continue
            deep = deep or n.tag in WHOLE
            own = [c for c in n.nodes() if not boilerplate(c, deep)]
            order.append((n, own))
            todo += [(c, deep) for c in own]
        for n, own in reversed(order):
            kept = set(map(id, own))
            parts = [c if isinstance(c, str) else f" {texts[id(c)][0]} " for c in n.children if isinstance(c, str) or id(c) in kept]
            texts[id(n)] = "".join(parts), n.links + sum(texts[id(c)][1] for c in own)
        return texts[id(node)]

    for node, inside in ((root, False), *apart):
        text_of(node, inside)
    touched[id(template)][2].append(root)
    for slot, _, nodes in touched.values():
        raw = " ".join(texts[id(n)][0] for n in nodes if id(n) in texts)
        links = sum(texts[id(n)][1] for n in nodes if id(n) in texts)
        text = tidy(raw)
        slot.pages += 1
        slot.mass += max(len(text) - links, 0)
        slot.vote(xxhash.xxh3_64_intdigest(text) >> 1, 1)
    if room[0] <= 0:
        prune(template, room)


def merge(into: Slot, other: Slot, room: list[int]) -> None:
    """Align two templates of a host and add up what they have counted."""
    stack = [(into, other)]
    while stack:
        a, b = stack.pop()
        a.pages, a.mass = a.pages + b.pages, a.mass + b.mass
        a.lost, a.early = a.lost + b.lost, a.early + b.early
        a.vote(b.kept, b.margin)
        for kind, leaf in b.named.items():
            own = a.named.setdefault(kind, Slot(kind))
            own.pages, own.mass = own.pages + leaf.pages, own.mass + leaf.mass
            own.vote(leaf.kept, leaf.margin)
        runs = [(c.label, [c]) for c in b.children]
        for slot, (_, nodes) in zip(_slots_for(a, runs, room), runs, strict=True):
            stack.append((slot, nodes[0]))
    if room[0] <= 0:
        prune(into, room)


# --- from template to text ----------------------------------------------------------------------


def content_slot(template: Slot) -> Slot:
    """Down to the container that holds most of the text; articles are not split up."""
    slot = template
    while True:
        heavy = [c for c in slot.children if c.mass >= MOST * slot.mass and c.mass]
        heavy = [c for c in heavy if c.label.split(".")[0] in CONTAINERS]
        tag = slot.label.split(".")[0]
        rest = [c for c in slot.children if c not in heavy]
        titled = any(re.match(r"h[1-6]\b", c.label) for c in rest)
        if len(heavy) != 1 or tag in WHOLE or titled:
            whole = [c for c in slot.children if c.label.split(".")[0] in WHOLE and c.mass]
            return whole[0] if len(whole) == 1 and tag not in WHOLE else slot
        slot = heavy[0]


def constant(slot: Slot, content: Slot) -> bool:
    """The same small text on most of a host's pages whose contents differ: template."""
    copies = content.margin >= CONSTANT / 2 * content.pages
    same = slot.pages >= MIN_PAGES and slot.margin >= CONSTANT * slot.pages
    return same and not copies and slot.mass <= SMALL_PART * content.mass


def template_part(node: Node, leaf: Slot, content: Slot) -> bool:
    """Whether the host's pages confirm the name of a node in the content: constant, or small and recurring.

    Headings and inline elements stay, whatever their names; an id can be an anchor, only a class says
    what a small varying part is.
    """
    if node.tag in HEADINGS or node.tag in INLINE or node.tag in CODE:
        return False
    if constant(leaf, content):
        return True
    recurs = leaf.pages >= min(MIN_PAGES, content.pages)
    small = leaf.mass * content.pages <= SMALL_PART * content.mass * leaf.pages
    return recurs and small and " # " not in leaf.label


def _named_blocks(root: Node) -> set[int]:
    """In a whole page, where the content has no container of its own: what has a boilerplate name."""
    found, stack = set(), [root]
    while stack:
        for n in stack.pop().nodes():
            if n.tag not in HEADINGS and n.tag not in CODE and named(n):
                found.add(id(n))
            elif n.tag not in CODE and n.tag not in WHOLE:
                stack.append(n)
    return found


def extract(root: Node, template: Slot, content: Slot) -> str:
    """The text of the page's nodes that are aligned with the content slot."""
    chosen: list[tuple[Node, bool]] = []
    gone: set[int] = set()
    framed = content.label.split(".")[0] in FRAMES
    stack = [(template, root, False, template is content)]
    if template is content:
        chosen.append((root, False))
    while stack:
        slot, node, inside, within = stack.pop()
        inside = inside or node.tag in WHOLE
        below = [n for n in node.nodes() if not marked(n, inside)]
        kinds = [named(n) for n in below]
        if within and (not framed or inside):
            for n, kind in zip(below, kinds, strict=True):
                if kind in slot.named and template_part(n, slot.named[kind], content):
                    gone.add(id(n))
        runs = _runs([n for n, kind in zip(below, kinds, strict=True) if not kind])
        for i, (_, nodes) in zip(align(slot.children, runs), runs, strict=True):
            if i is None:
                continue
            found = slot.children[i]
            deeper = within or found is content
            if found is content:
                chosen += [(n, inside) for n in nodes]
            elif within and constant(found, content):
                text = tidy(" ".join(n.raw(lambda c, deep=inside: boilerplate(c, deep)) for n in nodes))
                if xxhash.xxh3_64_intdigest(text) >> 1 == found.kept:
                    gone.update(map(id, nodes))
            stack += [(found, n, inside, deeper) for n in nodes]
    if not chosen:  # a page unlike its host's: its own article, or all that is not boilerplate
        chosen = [(n, True) for n in _find_whole(root)] or [(root, False)]
    blocks = set()
    for n, _ in chosen:
        if n.tag in FRAMES:
            blocks |= _named_blocks(n)
    for out in (gone | blocks, gone) if blocks else (gone,):  # a page that is all in named blocks keeps them
        parts = [
            n.raw(lambda c, deep=inside or n.tag in WHOLE, out=out: id(c) in out or marked(c, deep)) for n, inside in chosen
        ]
        text = tidy(" ".join(parts))
        if text:
            break
    return text


# --- jobs ---------------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; null and other texts are one host without a name."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


PARTIAL = "host string, salt int, template string"


def _packed(slot: Slot) -> str:
    return json.dumps(slot.dump(), separators=(",", ":"))


def induce(pages: DataFrame) -> DataFrame:
    """``host, template`` from ``host, html`` of all pages."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Slot, list[int]]] = {}

        def flush() -> pa.RecordBatch:
            rows = list(held.items())
            out = [pa.array([h for h, _ in rows]), pa.array([_packed(t) for _, (t, _) in rows])]
            held.clear()
            return pa.RecordBatch.from_arrays([out[0], pa.nulls(len(rows), pa.int32()).fill_null(0), out[1]], ["host", "salt", "template"])

        for piece in pieces(batches, "html"):
            for host, page in zip(piece["host"].to_pylist(), piece["html"].to_pylist(), strict=True):
                if len(held) >= MAX_HOSTS and host not in held:
                    yield flush()
                template, room = held.setdefault(host, (Slot("root"), [MAX_NODES]))
                add_page(template, page_tree(page or ""), room)
        if held:
            yield flush()

    def union(frame: pd.DataFrame) -> pd.DataFrame:
        total, room = Slot("root"), [MAX_NODES]
        for packed in frame["template"].sort_values():
            merge(total, Slot.load(json.loads(packed)), room)
        row = frame.iloc[[0]].copy()
        row["template"] = _packed(total)
        return row

    partial = pages.select("host", "html").mapInArrow(fold, PARTIAL)
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("template"), F.lit(SALTS)).cast("int"))
    once = salted.groupBy("host", "salt").applyInPandas(union, PARTIAL)
    return once.groupBy("host").applyInPandas(union, PARTIAL).select("host", "template")


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``page_id, url, text``: the main text of every page, empty where a page has none.

    Null pages are empty; pages without a host are one group; repeated rows give repeated results.
    Character references are decoded, white space becomes single spaces, blocks are joined by a space.
    """
    rows = pages.select(
        column(pages, id_col).cast("long").alias("page_id"),
        column(pages, url_col).alias("url"),
        F.coalesce(column(pages, html_col), F.lit("")).alias("html"),
        host_of(column(pages, url_col)).alias("host"),
    )
    templates = materialize(induce(rows), "templates")
    size = templates.agg(F.sum(F.octet_length("template") + F.octet_length("host"))).first()[0] or 0
    shared = None
    if size <= broadcast_bytes:
        shared = pages.sparkSession.sparkContext.broadcast({r["host"]: r["template"] for r in templates.collect()})
    else:
        rows = rows.join(templates, "host", "left").select("page_id", "url", "html", "host", "template")

    def extract_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, tuple[Slot, Slot]] = {}
        for piece in pieces(batches, "html"):
            packed = None if shared else piece["template"].to_pylist()
            texts = []
            for i, (host, page) in enumerate(zip(piece["host"].to_pylist(), piece["html"].to_pylist(), strict=True)):
                if host not in ready:
                    if len(ready) >= MAX_HOSTS:
                        ready.clear()
                    template = settle(Slot.load(json.loads(shared.value[host] if shared else packed[i])))
                    ready[host] = template, content_slot(template)
                texts.append(extract(page_tree(page), *ready[host]))
            yield pa.RecordBatch.from_arrays([piece["page_id"], piece["url"], pa.array(texts)], ["page_id", "url", "text"])

    return rows.mapInArrow(extract_pages, "page_id long, url string, text string")
