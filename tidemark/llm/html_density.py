"""Main text of web pages by composite text density.

A page becomes a tree of elements: tags by HTML's rules for void, raw and implied
end tags, character references decoded. Elements that are never part of an article
(scripts, forms, menus, page headers and footers, sidebars, and what class, id or
role name as such: adverts, notices, comments ...) are cut off first. Then, for
every node,

    density = C/T * log_b(C/LC * T/LT),  b = ln(C/(C - LC) * LC + LC_root/C_root * C + e)

with C characters and T tags of its subtree, LC and LT those inside links (zeros
count as one). A node's sum is that of its child blocks' densities. The subtree of
the greatest sum is the text, looked for in the articles of the page if it has any,
else in its main element, else in the body. The least density on the path from it
to the root is the threshold: siblings beside that path which reach it, and headings
before it, belong to the text as well. Inside an article, the whole article does.

Text of a block is joined with single blanks for white space (as ``str.split`` knows
it) and trimmed; a line break is white space; blocks are joined by two line feeds.

Defined results: null or empty html, and pages without text, give an empty string.
Repeated rows are extracted each; a null page_id or url is kept. Unclosed tags,
comments and scripts end with the page. Only page_id, url and html are read, so
further columns of any name are harmless. There is no shuffle: a page is read and
written by one task, batches are cut by characters.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import small_batches

# Quotes count behind "=" only; possessive, so that broken tags are read once.
MARKUP = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)(?:>|\Z)"""
                    r"""|<[!?/][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
HINT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul caption legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What a start tag ends, and where looking for it stops.
LIST, ROWS = frozenset(["ul", "ol", "menu", "dir"]), frozenset("tr td th".split())
IMPLIED = {
    "li": (frozenset(["li"]), LIST), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])), "tr": (ROWS, frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])), "a": (frozenset(["a"]), frozenset(["block"])),
}
IMPLIED |= dict.fromkeys(["tbody", "thead", "tfoot"], (ROWS | {"tbody", "thead", "tfoot"}, frozenset(["table"])))
P_SCOPE = frozenset("td th table caption button object".split())

NEVER = frozenset(
    "script style title textarea iframe xmp noembed noframes noscript template svg canvas object audio video button input "
    "select datalist nav menu dialog search".split())
# Cut off unless an article or a main element lies inside.
UNLESS_ARTICLE = frozenset("form aside footer".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
COMMENTS = frozenset("comment comments disqus reply replies respond discussion".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer masthead cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations pagination pager toolbar search copyright disclaimer".split())
PAGE_HEADER = frozenset(["header", "topbar"])


class Tree:
    """Elements of a page in document order, and its texts and block breaks in the order met."""

    def __init__(self, html: str):
        self.name, self.parent, self.cut = ["body"], [-1], [0]   # cut: 2 always, 1 unless an article lies inside
        self.events: list[tuple[int, str] | None] = []           # None: a block starts or ends
        self.open = [0]
        self.where = {"body": [0], "block": [0]}                 # places in ``open`` by name, and of all blocks
        at = 0
        while m := MARKUP.search(html, at):
            if m.start() > at:
                self.text(html[at:m.start()])
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                if m[1]:
                    self.end(tag)
                else:
                    self.start(tag, m[3])
                    if tag in RAW:  # nothing in it is markup, and no article's text
                        close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                        at = close.end() if close else len(html)
                        self.end(tag)
        if at < len(html):
            self.text(html[at:])

    def text(self, s: str) -> None:
        self.events.append((self.open[-1], unescape(s) if "&" in s else s))

    def pop(self) -> None:
        name = self.name[self.open.pop()]
        self.where[name].pop()
        if name in BLOCK:
            self.where["block"].pop()
            self.events.append(None)

    def close_up_to(self, names: frozenset, stop: frozenset) -> None:
        """End what is open of ``names`` above the innermost of ``stop``, from the outermost on."""
        floor = max((self.where[s][-1] for s in stop if self.where.get(s)), default=0)
        found = [at[i] for n in names if (at := self.where.get(n)) and (i := bisect_right(at, floor)) < len(at)]
        while found and len(self.open) > min(found):
            self.pop()

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "head", "body"):
            return
        if tag in ("br", "hr"):
            self.events.append(None if tag == "hr" else (self.open[-1], " "))
        if tag in BLOCK and self.where.get("p"):
            self.close_up_to(frozenset(["p"]), P_SCOPE)
        if tag in IMPLIED:
            self.close_up_to(*IMPLIED[tag])
        node = len(self.name)
        self.name.append(tag)
        self.parent.append(self.open[-1])
        self.cut.append(self.unwanted(tag, attributes))
        if tag not in VOID:
            self.where.setdefault(tag, []).append(len(self.open))
            if tag in BLOCK:
                self.where["block"].append(len(self.open))
                self.events.append(None)
            self.open.append(node)

    def end(self, tag: str) -> None:
        at = self.where.get(tag)
        # The end of an inline element ends no block around which it was opened.
        if tag != "body" and at and (tag in BLOCK or at[-1] > self.where["block"][-1]):
            keep = at[-1]
            while len(self.open) > keep:
                self.pop()

    def unwanted(self, tag: str, attributes: str) -> int:
        if tag in NEVER:
            return 2
        found = 1 if tag in UNLESS_ARTICLE else 0
        in_article = self.where.get("article") or self.where.get("main")
        if tag == "header" and not in_article:
            found = 1
        if attributes:
            for key, *values in ATTRIBUTE.findall(attributes):
                key, value = key.lower(), "".join(values)
                if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                    return 2
                if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    return 2
                if key == "role" and value.lower() in ROLES:
                    found = 1
                if key in ("class", "id"):
                    hints = {h.lower() for h in HINT.findall(value)}
                    if hints & COMMENTS and tag != "main":
                        return 2
                    if hints & HINTS and tag not in ("article", "main") or hints & PAGE_HEADER and not in_article:
                        found = 1
        return found


def densities(parent: list[int], name: list[str], own: list[int], alive: list[bool]) -> tuple[list[float], list[float]]:
    """Composite density of every node, and the sum over its child blocks; zero for nodes cut off."""
    n = len(parent)
    chars, tags, link_chars, link_tags = own[:], [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = name[i] == "a" or linked[parent[i]]
        if linked[i]:
            link_chars[i] = own[i]
    for i in range(n - 1, 0, -1):  # children come behind their parents
        if alive[i]:
            p = parent[i]
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i] + (name[i] == "a")
    share = link_chars[0] / max(chars[0], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c = chars[i]
        if alive[i] and c:
            t, lc = max(tags[i], 1), max(link_chars[i], 1)
            base = log(c / max(c - link_chars[i], 1) * lc + share * c + e)
            density[i] = c / t * log(max(c / lc * t / max(link_tags[i], 1), 1)) / log(base)
            if i and name[i] in BLOCK:
                sums[parent[i]] += density[i]
    return density, sums


def chosen(tree: Tree, own: list[int]) -> list[bool]:
    """Which nodes' texts belong to the main text."""
    name, parent, n = tree.name, tree.parent, len(tree.name)
    holds = [False] * n   # an article or main element that is not cut off itself
    for i in range(n - 1, 0, -1):
        holds[i] = holds[i] or name[i] in ("article", "main") and not tree.cut[i]
        if holds[i] and tree.cut[i] < 2:
            holds[parent[i]] = True
    alive, article, main = [True] * n, [-1] * n, [-1] * n   # outermost article and main around a node
    for i in range(1, n):
        p = parent[i]
        alive[i] = alive[p] and (tree.cut[i] == 0 or tree.cut[i] == 1 and holds[i])
        article[i] = article[p] if article[p] >= 0 else i if name[i] == "article" and alive[i] else -1
        main[i] = main[p] if main[p] >= 0 else i if name[i] == "main" and alive[i] else -1
    own = [c if a else 0 for c, a in zip(own, alive)]
    density, sums = densities(parent, name, own, alive)
    region = next((r for r in (article, main) if any(r[i] >= 0 and own[i] for i in range(n))), None)
    # Ancestors come first, so they win ties.
    best = max((i for i in range(n) if alive[i] and (i == 0 or name[i] in BLOCK)
                and (region is None or region[i] >= 0)), key=sums.__getitem__, default=0)
    if region is article and region is not None:
        best = article[best]
    path = [best]
    while path[-1] > 0:
        path.append(parent[path[-1]])
    threshold, on_path = min(density[i] for i in path), set(path)
    taken = [False] * n
    for i in range(n):
        p = parent[i]
        if i == best or i and taken[p]:
            taken[i] = alive[i]
        elif i and alive[i] and p in on_path and i not in on_path and name[i] in BLOCK:
            if region is article:
                taken[i] = article[i] == i and 0 < threshold <= density[i]
            elif region is None or region[i] >= 0 and region[p] >= 0:
                taken[i] = 0 < threshold <= density[i] or name[i] in HEADINGS and i < best
        if region is article and article[i] == i and i != best and not taken[i]:
            taken[i] = 0 < threshold <= density[i]
    return taken


def main_text(html: str) -> str:
    """The main text of a page."""
    tree = Tree(html)
    own = [0] * len(tree.name)
    for event in tree.events:
        if event:
            own[event[0]] += len("".join(event[1].split()))
    taken = chosen(tree, own)
    blocks, parts = [], []
    for event in [*tree.events, None]:
        if event is None:
            if parts and (block := " ".join("".join(parts).split())):
                blocks.append(block)
            parts = []
        elif taken[event[0]]:
            parts.append(event[1])
    return "\n\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in small_batches(whole, "html"):
                texts = [main_text(h.as_py() or "") for h in b["html"]]
                yield pa.RecordBatch.from_arrays(
                    [b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
