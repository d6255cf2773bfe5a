"""Main text of web pages by wrapper induction.

*Induction.* All pages of a host are parsed to DOM trees, copies taken once,
children of one name folded into one. The trees are aligned by simple tree
matching: two nodes match if their names (tag, classes, id without digits) do,
and their children are aligned in order so that, all the way down, most nodes
match. Every page is in a group of ``GROUP`` pages or a few more (a host's only
one may have fewer). A text found at a node in all pages of a group, at least
four, is constant there; a text constant in groups that hold more than half of
the host's pages is template, anything else fills a slot. So one odd page
spoils its group only. The content region is found from the root on: the container with
more than half of the varying text is followed, containers beside it go, but
for one before it with a varying title. Landmarks of another kind (menu,
header, footer, side bar, form, advert, notice, reader comments: by tag, role
or class) go too, and blocks whose text is mostly links. The wrapper is the
merged tree with these marks.

*Extraction.* A page is parsed the same way and aligned with its host's
wrapper; what meets template or a region of another kind goes, the text of
content slots is kept, block by block in page order. A page that has an
``article`` or ``main`` keeps to it, whatever the region; in it, and in lists
and tables, a constant text goes only if nothing varies at its node. Blocks
beside the region go only from pages that have it. Nodes the wrapper doesn't know follow
their parent, and hosts without enough pages have no template, so only the
landmarks speak.

*At scale.* A host's pages are dealt into blocks of about ``BLOCK`` by a hash
of the tree, so the result does not depend on partitions. A task builds a
block's wrapper group by group and keeps counts and the constant texts, not
the others; a host's few block wrappers are then aligned into one by the same
matching. A wrapper grows with the different names of nodes on its host, not
with its pages.

Null, empty or broken html gives what text it holds, or none. Very long pages
are parsed in one pass, nested to any depth. Repeated rows come back once each. NULL urls share a
wrapper. Columns other than ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map, written

#: Pages that decide together what is constant, the fewest that do, and pages of a host dealt to one block.
GROUP, ENOUGH, BLOCK = 8, 4, 256
#: What a slot counts.
COUNTS = ("pages", "letters", "linked", "seen", "held", "varying")

# Names of HTML elements and of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas xmp noembed noframes select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                           "header hgroup hr main menu nav ol p pre section table ul".split())
#: An implied end does not reach beyond these.
SCOPES = frozenset("body article aside section main div table ul ol dl td th nav header footer form blockquote figure".split())
OTHER_TAGS = frozenset("nav header footer aside form button head dialog menu fieldset legend figcaption".split()) - {"figcaption"}
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar tablist".split())
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright "
    "disqus dialog footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination "
    "paywall popup promo promoted promotion recommend recommended related replies responses share sharing sidebar sidenav signup skip social sponsor "
    "sponsored subscribe subscription toolbar topbar widget widgets".split())
#: Blocks of running text, and parts of lists and tables.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote figure hgroup hr address details table".split())
ITEMS = frozenset("li dt dd tr td th".split())
MAIN_TAGS, MAIN_ROLES = frozenset({"article", "main"}), frozenset({"main", "article"})

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
RAW_END = {tag: re.compile(rf"</{tag}\s*>?", re.I) for tag in RAW}
PART = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


class Node:
    """An element: its name (tag and classes), whether it is a landmark of
    another kind, and its children, elements and text strings in order."""

    __slots__ = ("tag", "name", "other", "main", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children = tag, []
        classes, role, ident, hidden = "", "", "", False
        if attributes.strip():
            for key, *values in ATTRIBUTE.findall(attributes):
                value = next((v for v in values if v), "")
                key = key.lower()
                if key == "class":
                    classes = value
                elif key == "role":
                    role = value.lower()
                elif key == "id":
                    ident = value
                elif key == "hidden" or value.lower() == "true":
                    hidden = True
        self.name = f"{tag}.{' '.join(sorted(classes.lower().split()))}" if classes else tag
        parts = {p for p in PART.split(f"{classes} {ident}".lower()) if p} | {p for p in re.split(r"[\s_-]+", f"{classes} {ident}".lower()) if p}
        self.other = tag not in ("body", "html") and (tag in OTHER_TAGS or role in OTHER_ROLES or hidden or bool(parts & OTHER_WORDS))
        self.main = not self.other and (tag in MAIN_TAGS or role in MAIN_ROLES)
        if ident and not any(c.isdigit() for c in ident):
            self.name += f"#{ident}"
        if self.other:
            self.name += "!"


def parse(page: str) -> Node:
    """The DOM tree of a page, leniently: unclosed elements are closed where
    HTML implies it, end tags without a start are ignored."""
    root = Node("html")
    stack, at = [root], 0
    while True:
        found = TOKEN.search(page, at)
        text = page[at:found.start() if found else len(page)]
        if text and not text.isspace():
            stack[-1].children.append(entities.unescape(text) if "&" in text else text)
        elif text:
            stack[-1].children.append(" ")
        if not found:
            return root
        at = found.end()
        tag = found[2]
        if tag is None:
            if found[0].startswith("<![CDATA["):
                stack[-1].children.append(found[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            else:
                if tag in ("p", "br"):
                    stack[-1].children.append(Node(tag))
            continue
        if tag in ("html", "body") and (tag == "html" or any(n.tag == "body" for n in stack)):
            continue
        if tag in ENDS_PARAGRAPH:
            _close(stack, {"p"})
        if tag in CLOSES:
            _close(stack, CLOSES[tag])
        if tag == "body":
            del stack[1:]
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        node = Node(tag, found[3])
        stack[-1].children.append(node)
        if tag not in VOID and not found[3].endswith("/"):
            stack.append(node)
        elif tag not in VOID and tag not in INLINE:
            stack.append(node)


def _close(stack: list[Node], tags: set[str]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in SCOPES:
            return


def inline(node: Node) -> Iterator[str | Node]:
    """A node's text strings and blocks in order, inline elements opened; a
    line break is a space."""
    stack = [iter(node.children)]
    while stack:
        for c in stack[-1]:
            if isinstance(c, str):
                yield c
            elif c.tag in VOID:
                yield " " if c.tag == "br" else ""
            elif c.tag in INLINE and not c.other:
                stack.append(iter(c.children))
                break
            else:
                yield c
        else:
            stack.pop()


def own_text(node: Node) -> str:
    """The text of a node's inline content, white space joined."""
    return " ".join("".join(c for c in inline(node) if isinstance(c, str)).split())


def linked_letters(node: Node) -> int:
    """Letters of a node's inline content inside links."""
    total, stack = 0, list(node.children)
    while stack:
        c = stack.pop()
        if isinstance(c, Node) and c.tag == "a" and not c.other:
            total += len(own_text(c))
        elif isinstance(c, Node) and c.tag in INLINE and not c.other:
            stack += c.children
    return total


class Group:
    """The blocks of one name below a group, folded into one node."""

    __slots__ = ("name", "members", "children")

    def __init__(self, node: Node):
        self.name, self.members = node.name, [node]
        self.children: list[Group] = []


def folded(tree: Node) -> Group:
    """The tree with blocks of one name under one parent folded, in order of
    first appearance. Landmarks of another kind keep nothing below them."""
    root = Group(tree)
    stack = [root]
    while stack:
        group = stack.pop()
        if group.members[0].other:
            continue
        kinds: dict[str, Group] = {}
        for node in group.members:
            for c in inline(node):
                if isinstance(c, Node):
                    if c.name in kinds:
                        kinds[c.name].members.append(c)
                    else:
                        kinds[c.name] = Group(c)
        group.children = list(kinds.values())
        stack += group.children
    return root


class Slot:
    """A node of the wrapper: pages that have it, letters seen, inside links
    and in all (``seen``: a text once a page); in the group of pages being
    aligned, the texts all pages have there and whether there are others
    (``mixed``). Of whole groups: ``votes``, the pages of the groups in which a
    text is constant, ``held``, those of the groups that have the node, and
    ``varying``, those where it varies. ``template``: texts of the site;
    ``varies``: whether there are others; ``region``: ``+`` on the path of the
    content region, ``-`` beside it."""

    __slots__ = ("name", "common", "mixed", "pages", "letters", "linked", "seen", "votes", "held", "varying",
                 "children", "places", "other", "template", "varies", "region")

    def __init__(self, name: str, other: bool = False):
        self.name, self.other = name, other
        self.common: set[str] = set()
        self.votes: dict[str, int] = {}
        self.pages = self.letters = self.linked = self.seen = self.held = self.varying = 0
        self.children: list[Slot] = []
        self.places: dict[str, list[int]] | None = None
        self.template: frozenset[str] = frozenset()
        self.mixed, self.varies, self.region = False, False, ""

    def place(self) -> dict[str, list[int]]:
        """Where the children of each name are."""
        if self.places is None:
            self.places = {}
            for j, c in enumerate(self.children):
                self.places.setdefault(c.name, []).append(j)
        return self.places

    @property
    def tag(self) -> str:
        return re.split(r"[.#!]", self.name, maxsplit=1)[0]


def heaviest(links: list[tuple[int, int, int]], weight: list[int]) -> tuple[int, list[int]]:
    """The order-keeping matching of most weight among the links (place left,
    place right, pair), sorted by left, then by right downwards: an increasing
    subsequence of the right places, by a tree of prefix maxima."""
    if all(x[1] < y[1] for x, y in zip(links, links[1:])):
        return sum(weight[k] for _, _, k in links), [k for _, _, k in links]
    size = 1 + max(j for _, j, _ in links)
    top, before = [(0, -1)] * (size + 1), []
    for n, (_, j, k) in enumerate(links):
        best, at = (0, -1), j
        while at:
            best = max(best, top[at])
            at &= at - 1
        before.append(best[1])
        value, at = (best[0] + weight[k], n), j + 1
        while at <= size:
            top[at] = max(top[at], value)
            at += at & -at
    best, at = (0, -1), size
    while at:
        best = max(best, top[at])
        at &= at - 1
    out, n = [], best[1]
    while n >= 0:
        out.append(links[n][2])
        n = before[n]
    return best[0], out[::-1]


def matched(tree: Group | Slot, wrapper: Slot) -> tuple[int, list[tuple[Group | Slot, Slot]]]:
    """Simple tree matching: nodes match if their names and parents do, and
    siblings keep their order; as many nodes as can be. Names of a group's
    children differ, so a slot meets one group at most and the pairs are no
    more than the slots; their weights are found from the leaves up. Slots of
    one name beside each other (siblings in another order on other pages) are
    all tried against those of another wrapper."""
    pairs, links = [(tree, wrapper)], []
    for group, slot in pairs:  # grows as it goes
        place, own = slot.place(), []
        for i, c in enumerate(group.children):
            for j in reversed(place.get(c.name, ())):
                own.append((i, j, len(pairs)))
                pairs.append((c, slot.children[j]))
        links.append(own)
    weight, chosen = [0] * len(pairs), [[]] * len(pairs)
    for k in range(len(pairs) - 1, -1, -1):
        below, chosen[k] = heaviest(links[k], weight)
        weight[k] = 1 + below
    out, stack = [], [0]
    while stack:
        k = stack.pop()
        out.append(pairs[k])
        stack += chosen[k]
    return weight[0], out


def _aligned(slot: Slot, others: list, match: dict[int, Slot], made: Callable) -> list[tuple]:
    """Each of ``others`` with its child of ``slot``; those without a match
    get one, ``made`` of them, in its place."""
    pairs = [(c, match.get(id(c)) or made(c)) for c in others]
    if any(id(c) not in match for c in others):
        place = {id(c): j for j, c in enumerate(slot.children)}
        out, at = [], 0
        for _, child in pairs:
            if id(child) in place:
                out += slot.children[at:place[id(child)]]
                at = place[id(child)] + 1
            out.append(child)
        slot.children, slot.places = out + slot.children[at:], None
    return pairs


def merge(wrapper: Slot, tree: Group) -> None:
    """Align a page's folded tree into its group's wrapper; what is new gets a slot."""
    match = {id(group): slot for group, slot in matched(tree, wrapper)[1]}
    stack = [(tree, wrapper)]
    while stack:
        group, slot = stack.pop()
        texts = [own_text(node) for node in group.members]
        own = set(texts) - {""}
        slot.mixed |= slot.pages > 0 and own != slot.common
        slot.common = slot.common & own if slot.pages else own
        slot.pages += 1
        slot.letters += sum(map(len, texts))
        slot.linked += sum(map(linked_letters, group.members))
        slot.seen += sum(map(len, own))
        stack += _aligned(slot, group.children, match, lambda c: Slot(c.name, c.members[0].other))


def join(wrapper: Slot, other: Slot) -> None:
    """Align another wrapper, of other groups of pages, into a wrapper."""
    match = {id(theirs): slot for theirs, slot in matched(other, wrapper)[1]}
    stack = [(other, wrapper)]
    while stack:
        theirs, slot = stack.pop()
        for field in COUNTS:
            setattr(slot, field, getattr(slot, field) + getattr(theirs, field))
        for text, n in theirs.votes.items():
            slot.votes[text] = slot.votes.get(text, 0) + n
        # what is new is taken as it is, with all below it
        stack += [(c, child) for c, child in _aligned(slot, theirs.children, match, lambda c: c) if c is not child]


def in_order(wrapper: Slot) -> list[Slot]:
    """All slots, parents before their children."""
    out = [wrapper]
    for slot in out:
        out += slot.children
    return out


def grouped(trees: Iterable[str], size: int = GROUP) -> Iterator[list[str]]:
    """Groups of ``size``, the last of up to twice as many but one."""
    held: list[str] = []
    for tree in trees:
        held.append(tree)
        if len(held) == 2 * size:
            yield held[:size]
            del held[:size]
    if held:
        yield held


def of_group(trees: list[str], enough: int = ENOUGH) -> Slot:
    """The wrapper of a group of different pages (see ``flat``); fewer than
    ``enough`` say nothing about what is constant."""
    root, n = Slot("html"), len(trees)
    for tree in trees:
        merge(root, folded(unflat(tree)))
    for slot in in_order(root):
        if n >= enough:
            everywhere = slot.pages == n
            slot.held = n
            slot.votes = dict.fromkeys(slot.common, n) if everywhere else {}
            slot.varying = n if slot.mixed or slot.common and not everywhere else 0
        slot.common, slot.mixed = set(), False
    return root


def joined(wrappers: Iterable[Slot]) -> Slot | None:
    """One wrapper of several, in their order."""
    root = None
    for wrapper in wrappers:
        if root is None:
            root = wrapper
        else:
            join(root, wrapper)
    return root


def induce(pages: list[str], enough: int = ENOUGH) -> list:
    """The wrapper of one host's pages, as plain data."""
    # copies of a page would make everything constant
    return finished(joined(of_group(g, enough) for g in grouped(dict.fromkeys(flat(parse(p)) for p in pages))) or Slot("html"), enough)


def finished(root: Slot, enough: int = ENOUGH) -> list:
    """A wrapper with its marks, as plain data."""
    slots, pages = in_order(root), root.held
    if pages:
        for slot in slots:
            slot.template = frozenset(t for t, n in slot.votes.items() if 2 * n > pages)
            slot.varies = slot.held > 0 and 2 * slot.varying >= slot.held
        _mark_region(slots, enough)
    for slot in slots:
        if slot.letters and slot.linked > 0.6 * slot.letters and slot.tag in ("ul", "ol", "div", "li", "section"):
            slot.other = True
    return [[parent, s.name, int(s.other), int(s.varies), s.region, sorted(s.template)] for parent, s in zip(_parents(slots), slots, strict=True)]


def _parents(slots: list[Slot]) -> list[int]:
    number = {id(c): k for k, slot in enumerate(slots) for c in slot.children}
    return [number.get(id(s), -1) for s in slots]


def packed(root: Slot) -> str:
    """A wrapper without marks as JSON."""
    slots = in_order(root)
    return json.dumps([[parent, s.name, int(s.other), s.votes, *(getattr(s, f) for f in COUNTS)]
                       for parent, s in zip(_parents(slots), slots, strict=True)])


def unpacked(data: str) -> Slot:
    slots: list[Slot] = []
    for parent, name, other, votes, *counts in json.loads(data):
        slot = Slot(name, bool(other))
        slot.votes = votes
        for field, n in zip(COUNTS, counts, strict=True):
            setattr(slot, field, n)
        slots.append(slot)
        if parent >= 0:
            slots[parent].children.append(slot)
    return slots[0]


def _mark_region(slots: list[Slot], enough: int) -> None:
    """Follow the container with more than half of the varying letters from
    the root on; containers beside the path that bring no varying title before
    it are marked as such."""
    weight = {id(s): s.seen - sum(len(t) * s.votes[t] for t in s.template) for s in slots}
    title = {id(s): s.tag in ("h1", "h2") and s.varies for s in slots}
    for slot in reversed(slots):
        for c in slot.children:
            if not c.other:
                weight[id(slot)] += weight[id(c)]
                title[id(slot)] |= title[id(c)]
    at = slots[0]
    while True:
        inner = [c for c in at.children if c.tag not in FLOW and not c.other]
        best = max(inner, key=lambda c: weight[id(c)], default=None)
        if best is None or best.pages < enough or 2 * weight[id(best)] <= weight[id(at)]:
            return
        best.region, before = "+", True
        for c in inner:
            if c is best:
                before = False
            elif not (before and title[id(c)]):
                c.region = "-"
        at = best


def flat(tree: Node) -> str:
    """A tree as JSON: names, texts and ends (0) in page order, without the
    attributes and scripts of the page."""
    out: list = []
    stack: list = [tree]
    while stack:
        n = stack.pop()
        if isinstance(n, Node):
            out.append([n.tag, n.name[len(n.tag):], 1] if n.other else [n.tag, n.name[len(n.tag):]])
            stack += [0, *reversed(n.children)]
        else:
            out.append(n)
    return json.dumps(out)


def unflat(data: str) -> Node:
    """The tree of ``flat``, as far as wrappers see it."""
    stack: list[Node] = []
    for item in json.loads(data):
        if item == 0:
            last = stack.pop()
        elif isinstance(item, str):
            stack[-1].children.append(item)
        else:
            node = Node(item[0])
            node.name, node.other = item[0] + item[1], len(item) > 2
            if stack:
                stack[-1].children.append(node)
            stack.append(node)
    return last


def extract(page: str, wrapper: list | Slot | None = None) -> str:
    """The main text of a page."""
    tree = parse(page)
    slot_of: dict[int, Slot] = {}
    aside: set[int] = set()  # blocks beside the content region, where the page has one
    if wrapper is not None:
        for group, slot in matched(folded(tree), wrapper if isinstance(wrapper, Slot) else _slots(wrapper))[1]:
            slot_of.update((id(node), slot) for node in group.members)
        for node in _nodes(tree):
            kids = [c for c in inline(node) if isinstance(c, Node)] if id(node) in slot_of else []
            if any(id(c) in slot_of and slot_of[id(c)].region == "+" for c in kids):
                aside.update(id(c) for c in kids if id(c) in slot_of and slot_of[id(c)].region == "-")
    mains = any(n.main for n in _nodes(tree))
    out: list[str] = []
    run: list[str] = []

    def flush(node: Node, inside: bool) -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if not text or mains and not inside:
            return
        slot = slot_of.get(id(node))
        # an item belongs to its list, and what is in an article or main to that, while anything varies there
        whole = slot is not None and slot.varies and (inside or slot.tag in ITEMS)
        if slot is None or whole or text not in slot.template:
            out.append(text)

    # (open block, its content still to come, whether it is in an article or main)
    stack = [(tree, inline(tree), False)]
    while stack:
        node, content, inside = stack[-1]
        for c in content:
            if isinstance(c, str):
                run.append(c)
                continue
            flush(node, inside)
            slot = slot_of.get(id(c))
            if c.other or not (inside or c.main) and (id(c) in aside and not mains or slot is not None and slot.other and not mains):
                continue
            stack.append((c, inline(c), inside or c.main))
            break
        else:
            flush(node, inside)
            stack.pop()
    return " ".join(out)


def _nodes(tree: Node) -> Iterator[Node]:
    """The nodes that are not inside landmarks of another kind."""
    stack = [tree]
    while stack:
        n = stack.pop()
        yield n
        if not n.other:
            stack += [c for c in n.children if isinstance(c, Node)]


def _slots(marks: list) -> Slot:
    slots = []
    for parent, name, other, varies, region, template in marks:
        slot = Slot(name, bool(other))
        slot.varies, slot.region, slot.template = bool(varies), region, frozenset(template)
        slots.append(slot)
        if parent >= 0:
            slots[parent].children.append(slot)
    return slots[0]


def host_of(url: str = "url") -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def host_wrappers(pages: DataFrame, block: int = BLOCK) -> DataFrame:
    """``host`` and its ``wrapper`` (JSON) for every host, of all its pages."""
    rows = pages.select(host_of().alias("host"), F.col("html").cast("string").alias("html"))
    # A small table: of any number of pages at most one in ``block`` has a host here.
    large = rows.groupBy("host").agg(F.ceil(F.count("*") / block).alias("blocks")).where("blocks > 1")

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Copies leave here, so that a page that is everywhere is not gathered; those of other tasks meet in their block.
        known: set[bytes] = set()
        schema = pa.schema([("host", pa.string()), ("blocks", pa.int64()), ("tree", pa.string())])
        for batch in batches:
            out = []
            for host, blocks, html in zip(*(batch.column(c).to_pylist() for c in ("host", "blocks", "html")), strict=True):
                name = blake2b(f"{host}\0{html}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
                if name not in known:
                    known.add(name)
                    tree = flat(parse(html))
                    shape = blake2b(f"{host}\0{tree}".encode(), digest_size=16, person=b"tree").digest()
                    if shape not in known:
                        known.add(shape)
                        out.append((host, blocks, tree))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    dealt = (arrow_map(rows.where("html <> ''").join(F.broadcast(large), "host", "left").select("host", F.coalesce("blocks", F.lit(1)).alias("blocks"), "html"),
                       trees, "host string, blocks long, tree string")
             .withColumn("h", F.xxhash64("tree")).withColumn("block", F.pmod("h", "blocks"))
             .withColumn("key", F.xxhash64("host", "block")).select("key", "host", "block", "h", "tree"))

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("host", pa.string()), ("block", pa.int64()), ("wrapper", pa.string()), ("trees", pa.list_(pa.string()))])
        for (_, host, number), members in groupby(_rows(batches, "key", "host", "block", "tree"), key=lambda r: r[:3]):
            found = grouped(tree for tree, _ in groupby(r[3] for r in members))
            first = next(found)
            few = len(first) < GROUP  # they wait for others of their host
            wrapper = None if few else joined(of_group(g) for g in (g for part in ((first,), found) for g in part))
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(
                (host, number, wrapper and packed(wrapper), first if few else []), schema, strict=True)], schema=schema)

    def hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("host", pa.string()), ("wrapper", pa.string())])
        for (_, host), members in groupby(_rows(batches, "key", "host", "wrapper", "trees"), key=lambda r: r[:2]):
            root, spare = None, []
            for _, _, wrapper, few in members:
                if wrapper is not None:
                    root = joined(w for w in (root, unpacked(wrapper)) if w)
                spare += few
                if len(spare) >= 2 * GROUP:
                    root = joined(w for w in (root, of_group(spare[:GROUP])) if w)
                    del spare[:GROUP]
            if spare:
                root = joined(w for w in (root, of_group(spare)) if w)
            yield pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([json.dumps(finished(root))], pa.string())], schema=schema)

    parts = arrow_map(dealt.repartition("key").sortWithinPartitions("key", "host", "block", "h", "tree"), blocks_of,
                      "host string, block long, wrapper string, trees array<string>").withColumn("key", F.xxhash64("host"))
    return written(arrow_map(parts.repartition("key").sortWithinPartitions("key", "host", "block"), hosts, "host string, wrapper string"), "wrappers")


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def main_text(pages: DataFrame, broadcast_bytes: int = 16 << 20) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row."""
    wrappers = host_wrappers(pages)
    size = wrappers.agg(F.coalesce(F.sum(F.length("wrapper") + F.length("host") + 64), F.lit(0))).first()[0]
    side = F.broadcast(wrappers) if size <= broadcast_bytes else wrappers
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), host_of().alias("host")).join(side, "host", "left")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Slot] = {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                if wrapper is not None and wrapper not in known:
                    if len(known) >= 500:
                        known.clear()
                    known[wrapper] = _slots(json.loads(wrapper))
                texts.append(extract(page or "", known.get(wrapper)))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                             schema=schema)

    return arrow_map(rows.select("page_id", "url", "html", "wrapper"), run, "page_id long, url string, text string, n_chars long")
