"""Leaf blocks of a page's element tree: the text between block-level tags, with what encloses it.

One forward pass in linear time; the open elements are a stack, and a block keeps a link to the innermost. Broken markup never fails: a new paragraph or list item
closes the open one, an end tag without its start is passed over, and what is left open ends with the page.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names of the HTML standard, by the part they play here.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark nobr q ruby rb rp rt rtc s samp "
    "small span strike strong sub sup time tt u var wbr object audio video canvas math mi mo mn ms mtext mrow mfrac msqrt mroot msub msup "
    "msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd mspace mpadded mphantom mstyle merror menclose semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg".split())
UNSEEN = frozenset("head script style title noscript template iframe xmp noembed noframes svg "
                   "annotation annotation-xml textarea select option button datalist optgroup".split())
FLOWING = INLINE | RAW | UNSEEN - {"head"}  # these do not end the block around them
CLOSED_BY = {
    "p": frozenset("p li dt dd menu center summary hgroup h1 h2 h3 h4 h5 h6 div ul ol dl table form section article aside header footer nav main blockquote pre hr "
                   "figure figcaption address fieldset details".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "head": frozenset(["body"]),
}
BARRIER = {"li": ("table", "ul", "ol", "menu"), "dt": ("table", "dl"), "dd": ("table", "dl")}
CLOSES = {tag: [t for t, by in CLOSED_BY.items() if tag in by] for tag in frozenset().union(*CLOSED_BY.values())}

_RAW_END = {tag: re.compile("</" + tag, re.I | re.A) for tag in RAW}
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>\x00]*)")
_ATTR = re.compile(r"""[\s/]*([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""")


@dataclass
class Scope:
    """An open element. Blocks refer to the innermost and reach the others through ``parent``, so depth costs nothing twice."""

    tag: str
    names: tuple[str, ...]  # words of class, id and role
    parent: Scope | None
    hidden: bool
    weight: str | None  # "a" or "b" where text right here is linked or bold
    facts: tuple | None = None  # what a reader of blocks works out once for each element


@dataclass
class Block:
    text: str
    scope: Scope | None
    linked: int  # characters inside links
    bold: int


@dataclass
class _Reader:
    page: str
    stack: list[Scope] = field(default_factory=list)
    depths: dict[str, list[int]] = field(default_factory=dict)  # of the open elements of each tag
    solid: list[int] = field(default_factory=list)  # depths of elements that are not inline,
    parted: list[int] = field(default_factory=list)  # and of those that end the block around them
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    bold: int = 0
    unseen: int = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                self.blocks.append(Block(text, self.stack[-1] if self.stack else None, self.linked, self.bold))
            self.parts.clear()
        self.linked = self.bold = 0

    def text(self, raw: str) -> None:
        if raw and not self.unseen:
            self.parts.append(raw)
            weight = self.stack[-1].weight if self.stack else None
            if weight == "a":
                self.linked += len(raw)
            elif weight == "b":
                self.bold += len(raw)

    def push(self, tag: str, names: tuple[str, ...], hidden: bool) -> None:
        parent, depth = self.stack[-1] if self.stack else None, len(self.stack)
        weight = "a" if tag == "a" else "b" if tag in ("b", "strong") else parent.weight if parent and tag in INLINE else None
        self.stack.append(Scope(tag, names, parent, hidden, weight))
        self.depths.setdefault(tag, []).append(depth)
        if tag not in INLINE:
            self.solid.append(depth)
        if tag not in FLOWING:
            self.parted.append(depth)
        self.unseen += hidden

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            scope = self.stack.pop()
            self.depths[scope.tag].pop()
            for kept in (self.solid, self.parted):
                if kept and kept[-1] == len(self.stack):
                    kept.pop()
            self.unseen -= scope.hidden

    def deepest(self, tags) -> int:
        return max([self.depths[t][-1] for t in tags if self.depths.get(t)], default=-1)

    def start(self, tag: str, names: tuple[str, ...], hidden: bool, closed: bool) -> None:
        if tag == "br" or tag == "wbr":
            if tag == "br":
                self.text(" ")
            return
        if tag not in FLOWING:
            self.flush()
            while (at := self.deepest(CLOSES.get(tag, ()))) >= 0:
                barrier = self.deepest(BARRIER.get(tag, ("table",)))
                if at < barrier or tag == "p" and at < self.solid[-1]:
                    break
                open_tag = self.stack[at].tag
                self.pop_to(at)
                if open_tag not in ("td", "th"):
                    break
        if not closed and tag not in VOID:
            self.push(tag, names, hidden or tag in UNSEEN)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        inline = tag in FLOWING
        if not inline:
            self.flush()
        at = self.deepest((tag,))
        # A link or emphasis does not end the block around it.
        if at >= 0 and not (inline and self.parted and at < self.parted[-1]):
            self.pop_to(at)

    def run(self) -> list[Block]:
        page, at, size = self.page, 0, len(self.page)
        while at < size:
            mark = page.find("<", at)
            if mark < 0:
                self.text(page[at:])
                break
            self.text(page[at:mark])
            if page.startswith("<!--", mark):
                stop = page.find("-->", mark + 2)
                at = size if stop < 0 else stop + 3
                continue
            m = _TAG.match(page, mark + 1)
            if not m:
                if page[mark + 1:mark + 2] in ("!", "?", "/"):
                    stop = page.find(">", mark)
                    at = size if stop < 0 else stop + 1
                else:
                    self.text("&lt;")
                    at = mark + 1
                continue
            tag, at = m[2].lower(), m.end()
            names, hidden, closed = [], False, False
            while at < size and page[at] != ">":
                a = _ATTR.match(page, at)
                if not a or a.end() == at:
                    closed = page[at] == "/"
                    at += 1
                    continue
                name, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                if name in ("class", "id", "role"):
                    names += value.lower().split()
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                    hidden = True
                at = a.end()
                closed = False
            closed = closed or page[at - 1:at] == "/"
            at += 1
            if m[1]:
                self.end(tag)
                continue
            self.start(tag, tuple(names), hidden, closed and tag in ("svg", "math"))
            if tag in RAW and not (closed and tag == "svg"):
                stop = _RAW_END[tag].search(page, at)
                at = stop.start() if stop else size
        self.flush()
        return self.blocks


def leaf_blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order, those with visible text only."""
    return _Reader(page or "").run()
