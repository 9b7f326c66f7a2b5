"""HTML main-text extraction by wrapper induction.

The pages of a host are folded into one template: their trees are aligned by simple tree
matching, and every template node learns whether its text is the same on all pages or
varies, and how much of it is repeated from page to page.  Constant nodes are template,
varying slots are content; where most of a body is repeated, the pages are versions of
one text, and all of it is content.  What is marked as menu, header, footer, sidebar,
notice, advert, form or comments is never content.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlens.llm.common import attach
from scanlens.session import written

# Element classes of HTML.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg math object canvas video audio select".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = set("ul ol dl table article section div main body aside nav".split())
# Elements and words of class, id and role that mark what is not the article.
ASIDE = set("nav header footer aside form button menu dialog head fieldset".split())
MARKS = set(
    "ad ads advert advertisement adverts advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "header masthead footer sidebar side rail widget cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login form search "
    "share sharing social comment comments respond discussion replies disqus related recommended complementary contentinfo pagination pager toolbar copyright".split()
)
# An article element is marked only by a class that begins with one of these.
NO_ARTICLE = set("comment comments reply replies respond ad ads advert advertisement adverts advertising sponsor sponsored promo promotion related recommended".split())
# The header of a part of the article is no page header.
PARTS = set("article entry post story content section".split())
WHOLE = set("html body main article".split())
CONTENT = set("article content post entry story main".split())
#: Levels of the tree; what is deeper hangs on the element at this level, with the marks of all elements it is in.
DEPTH = 60
#: Smallest block hashes that a slot keeps to estimate its different blocks.
SKETCH = 16
#: Share of characters or of blocks that differ from which what is constant in a body is template.
VARIES = 0.4
#: Child pairs beyond which two child lists are aligned by their labels alone.
PAIRS = 10_000
#: Hosts whose templates a task holds before it hands them on.
HOSTS = 500
#: Share of link text from which an unmarked slot outside an article is a menu.
LINKED = 0.5

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|[\s\"'])hidden(?=\s|=|/|$)", re.I)


@dataclass
class Node:
    """An element, or a text block (``tag`` #text).  ``ref`` numbers text blocks in page order."""

    label: str
    tag: str
    marked: bool = False
    children: list[Node] = field(default_factory=list)
    text: str = ""
    links: int = 0
    ref: int = -1


def _element(tag: str, attributes: str) -> Node:
    kinds: set[str] = set()
    leads: set[str] = set()
    label = tag
    for name, *values in _ATTRIBUTE.findall(attributes):
        for token in "".join(values).lower().split():
            words = [w for w in re.split(r"[^a-z]+", token) if w]
            leads.update(words[:1])
            kinds.update(words[:-1] if words[-1:] == ["header"] and PARTS & set(words[:-1]) else words)
        words = [w for w in re.split(r"[^a-z]+", "".join(values).lower()) if w]
        if name.lower() == "class" and words:
            label = f"{tag}.{'.'.join(sorted(set(words)))}"
    named = leads & NO_ARTICLE if tag == "article" else tag not in WHOLE and kinds & MARKS
    return Node(label, tag, tag in ASIDE or bool(named) or bool(_HIDDEN.search(attributes)))


def parse(page: str) -> tuple[Node, list[Node]]:
    """Tree of block elements, and its text blocks in page order."""
    root = Node("#root", "#root")
    stack, blocks, run = [root], [], []
    inside = [False]  # for every open element: it, or one around it, is marked
    linked = 0

    def flush() -> None:
        nonlocal run
        if run:
            text = " ".join(html.unescape("".join(t for t, _ in run)).split())
            if text:
                block = Node("#text", "#text", len(stack) > DEPTH and inside[-1], text=text, links=sum(len(t) for t, in_link in run if in_link), ref=len(blocks))
                stack[min(len(stack), DEPTH) - 1].children.append(block)
                blocks.append(block)
            run = []

    def close(k: int) -> None:
        flush()
        del stack[k:], inside[k:]

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            run.append((page[at:], linked > 0))
            break
        if m.start() > at:
            run.append((page[at : m.start()], linked > 0))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                linked = max(0, linked - 1)
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if k:
                close(k)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            if tag not in INLINE:
                flush()
            continue
        if tag == "br":
            run.append((" ", False))
            continue
        node = _element(tag, m[3])
        if tag in INLINE and not (node.marked and tag not in VOID):
            linked += tag == "a" and not m[3].endswith("/")
            continue
        flush()
        linked = 0
        if tag in CLOSES_P and (k := next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)):
            close(k)
        if tag in SAME:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SAME[tag]:
                    close(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        if len(stack) > DEPTH:
            node.marked |= inside[-1]
        stack[min(len(stack), DEPTH) - 1].children.append(node)
        if tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
            inside.append(inside[-1] or node.marked)
    flush()
    return root, blocks


class Slot:
    """A template node: on how many pages, with how much text, and its text if that never changes.

    ``blocks`` counts its text blocks, ``sketch`` holds the smallest hashes of different ones.
    """

    __slots__ = ("label", "marked", "pages", "chars", "links", "same", "children", "blocks", "sketch", "refs")

    def __init__(self, label, marked, pages, chars, links, same, children, blocks=0, sketch=(), refs=()):
        self.label, self.marked, self.pages, self.chars = label, marked, pages, chars
        self.links, self.same, self.children = links, same, children
        self.blocks, self.sketch, self.refs = blocks, sketch, refs

    def dump(self) -> list:
        return [self.label, int(self.marked), self.pages, self.chars, self.links, self.same, [c.dump() for c in self.children], self.blocks, list(self.sketch)]

    @staticmethod
    def load(row: list) -> Slot:
        return Slot(row[0], bool(row[1]), row[2], row[3], row[4], row[5], [Slot.load(c) for c in row[6]], row[7], tuple(row[8]))

    def different(self) -> float:
        """How much its blocks differ from page to page, about: 0 always the same, 1 never."""
        if self.pages < 2 or not self.blocks:
            return 1.0
        n = len(self.sketch)
        found = n if n < SKETCH else (SKETCH - 1) * 2**32 / max(1, self.sketch[-1])
        return min(1.0, max(0.0, (found / self.blocks - 1 / self.pages) / (1 - 1 / self.pages)))


def fold(nodes: list[Node]) -> Slot:
    """Template of one page: neighbours of one label become one repeating slot."""
    first = nodes[0]
    if first.tag == "#text":
        text = "\n".join(n.text for n in nodes)
        sketch = sorted({xxhash.xxh32_intdigest(n.text) for n in nodes})[:SKETCH]
        same = hashlib.md5(text.encode()).hexdigest()[:16]
        return Slot("#text", first.marked, 1, len(text), sum(n.links for n in nodes), same, [], len(nodes), tuple(sketch), tuple(n.ref for n in nodes))
    groups: list[list[Node]] = []
    for n in nodes:
        for c in n.children:
            if groups and (groups[-1][0].label, groups[-1][0].marked) == (c.label, c.marked):
                groups[-1].append(c)
            else:
                groups.append([c])
    return Slot(first.label, first.marked, 1, 0, 0, None, [fold(g) for g in groups])


def matching(a: Slot, b: Slot, known: dict) -> int:
    """Simple tree matching: nodes in the largest ordered matching of two trees with equal roots."""
    if a.label != b.label:
        return 0
    key = id(a), id(b)
    if key not in known:
        known[key] = 1 + sum(matching(x, y, known) for x, y in aligned(a.children, b.children, known) if x and y)
    return known[key]


def aligned(left: list[Slot], right: list[Slot], known: dict) -> list[tuple[Slot | None, Slot | None]]:
    """Ordered alignment of two child lists that matches the most nodes."""
    n = min(len(left), len(right))
    head = next((i for i in range(n) if left[i].label != right[i].label), n)
    tail = next((i for i in range(n - head) if left[-1 - i].label != right[-1 - i].label), n - head)
    a, b = left[head : len(left) - tail], right[head : len(right) - tail]
    ends = list(zip(left[len(left) - tail :], right[len(right) - tail :], strict=True)) if tail else []
    weigh = matching if len(a) * len(b) <= PAIRS else lambda x, y, _: int(x.label == y.label)
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            w = weigh(a[i], b[j], known)
            best[i][j] = max(best[i + 1][j], best[i][j + 1], w + best[i + 1][j + 1] if w else 0)
    out, i, j = list(zip(left[:head], right[:head], strict=True)), 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and (w := weigh(a[i], b[j], known)) and best[i][j] == w + best[i + 1][j + 1]:
            out.append((a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i][j] == best[i + 1][j]:
            out.append((a[i], None))
            i += 1
        else:
            out.append((None, b[j]))
            j += 1
    return out + ends


def merged(a: Slot, b: Slot, known: dict | None = None) -> Slot:
    """Template of two templates with one root label."""
    known = {} if known is None else known
    children = [merged(x, y, known) if x and y else x or y for x, y in aligned(a.children, b.children, known)]
    same = a.same if a.same == b.same else ""
    sketch = tuple(sorted({*a.sketch, *b.sketch})[:SKETCH])
    return Slot(a.label, a.marked or b.marked, a.pages + b.pages, a.chars + b.chars, a.links + b.links, same, children, a.blocks + b.blocks, sketch)


def _text_of(slot: Slot) -> list[float]:
    """Of the unmarked text below: characters, blocks, and of each what differs from page to page."""
    if slot.marked:
        return [0, 0, 0, 0]
    share = slot.different()
    parts = [[slot.chars, slot.blocks, slot.chars * share, slot.blocks * share], *map(_text_of, slot.children)]
    return [sum(x) for x in zip(*parts, strict=True)]


def _bodies(page: Slot) -> list[Slot]:
    """The slots of a page that hold its article: every outermost article (else main, else content) element with text."""
    found: list[Slot] = []

    def walk(s: Slot, wanted: set[str]) -> None:
        if s.marked:
            return
        if set(re.split(r"[^a-z]+", s.label)) & wanted:
            if _text_of(s)[0]:
                found.append(s)
            return
        for c in s.children:
            walk(c, wanted)

    for wanted in ({"article"}, {"main"}, CONTENT):
        walk(page, wanted)
        if found:
            return found
    return [page]


def extract(page: str, template: Slot | None) -> str:
    """Main text of a page: its blocks in content slots of the template, joined by two line feeds.

    A slot is content if it is inside a body of the page, not marked, and varies.  If
    less than ``VARIES`` of the bodies' text differs from page to page (one page, copies
    or versions of one article) all their slots are content, as are those of a body that no
    other page of the host has.
    """
    root, blocks = parse(page)
    own = fold([root])
    bodies = _bodies(own)
    whole = bodies[0] is own
    held: list[tuple[Slot | None, Slot]] = []
    known: dict = {}

    def find(t: Slot | None, p: Slot) -> None:
        if p.marked or t is not None and t.marked:
            return
        if any(p is x for x in bodies):
            held.append((t, p))
            return
        for x, y in aligned(t.children, p.children, known) if t is not None else ((None, c) for c in p.children):
            if y is not None:
                find(x, y)

    find(template or own, own)
    chars, count, chars_own, count_own = (sum(x) for x in zip([0, 0, 0, 0], *(_text_of(t) for t, _ in held if t is not None and t.pages > 1), strict=True))
    fixed = chars_own < VARIES * chars and count_own < VARIES * count
    chosen: list[int] = []

    def walk(t: Slot | None, p: Slot, free: bool) -> None:
        if p.marked or t is not None and t.marked:
            return
        if p.label == "#text":
            constant = t is not None and t.pages > 1 and t.same != "" and not free
            menu = whole and t is not None and t.links > LINKED * t.chars
            if not constant and not menu:
                chosen.extend(p.refs)
            return
        for x, y in aligned(t.children, p.children, known) if t is not None else ((None, c) for c in p.children):
            if y is not None:
                walk(x, y, free)

    for t, p in held:
        walk(t, p, fixed or t is None or t.pages == 1)
    return "\n\n".join(blocks[i].text for i in sorted(chosen))


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)", 1)), F.lit(""))


def templates(pages: DataFrame, url: str = "url", text: str = "html") -> DataFrame:
    """``(host, template)``, one row per host.

    Every task folds its pages into one template per host, so what is exchanged has a
    row for each host and task.  They are merged in two steps, dealt out by a salt first.
    """

    def induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Slot] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array([json.dumps(s.dump()) for s in held.values()], pa.string())], names=["host", "template"])

        for b in batches:
            for host, page in zip(b.column("host").to_pylist(), b.column("page").to_pylist(), strict=True):
                slot = fold([parse(page)[0]])
                held[host] = merged(held[host], slot) if host in held else slot
                if len(held) > HOSTS:
                    yield out()
                    held.clear()
        yield out()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, slot = None, None  # rows come sorted by host
        done: list[tuple[str, str]] = []
        for b in batches:
            for h, t in zip(b.column("host").to_pylist(), b.column("template").to_pylist(), strict=True):
                if h != host:
                    if slot is not None:
                        done.append((host, json.dumps(slot.dump())))
                    host, slot = h, Slot.load(json.loads(t))
                else:
                    slot = merged(slot, Slot.load(json.loads(t)))
            if done:
                yield pa.RecordBatch.from_pylist([{"host": h, "template": t} for h, t in done], schema=pa.schema([("host", pa.string()), ("template", pa.string())]))
                done = []
        if slot is not None:
            yield pa.RecordBatch.from_arrays([pa.array([host]), pa.array([json.dumps(slot.dump())])], names=["host", "template"])

    schema = "host string, template string"
    parts = pages.select(_host(F.col(url)).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("page")).where("page <> ''").mapInArrow(induce, schema)
    salted = parts.withColumn("salt", F.spark_partition_id() % 64)
    some = salted.repartition("host", "salt").sortWithinPartitions("host").select("host", "template").mapInArrow(combine, schema)
    return some.repartition("host").sortWithinPartitions("host").mapInArrow(combine, schema)


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """One row per input row: key, url, text, n_chars (code points).

    A null or empty page has the empty text.  A null url belongs to the host ''.  On a host
    with one page, or with copies or versions of one page, all of the body is content.  Rows are independent once templates are known, so repeated rows get
    equal results; columns other than the three named are not read.
    """
    table = written(templates(pages, url, text), "templates")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(text).alias("page"), _host(F.col(url)).alias("host"))
    joined = attach(rows, table, ["host"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict[str, Slot] = {}
        for b in batches:
            out = []
            for page, template in zip(b.column("page").to_pylist(), b.column("template").to_pylist(), strict=True):
                if template and template not in loaded:
                    if len(loaded) > HOSTS:
                        loaded.clear()
                    loaded[template] = Slot.load(json.loads(template))
                out.append(extract(page, loaded.get(template)) if page else "")
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=[key, "url", "text", "n_chars"])

    kind = dict(rows.dtypes)["key"]
    return joined.mapInArrow(run, f"`{key}` {kind}, url string, text string, n_chars long")
