"""Main text of pages by wrapper induction over the pages of one host.

Each host has a reference page (of its pages, the one with the least hash).
Every page's tree is aligned with the reference's by simple tree matching:
equal labels match if their parents do, and siblings are aligned in order for the
largest number of matched nodes. Siblings of one label are one node of the tree
that is aligned, since their number varies from page to page. So each element of
a page has a slot: the reference's node, or a place of its own below one.

What a slot holds is counted over all distinct pages of the host (pages whose
texts are equal throughout are one page, so copies make no layout): a text that
at least `SAME_SHARE` of the pages with this slot have there, `MIN_PAGES` at
least, is template; what varies is content. The counts are grouped and combined
by host, slot and text, so a host with a third of all pages is many tasks, and
a page's text depends on neither its task nor its neighbours.

The main text is the content of the page's own article or main element where
it has one, else of the smallest element that holds most of the page's
content. Containers that name themselves as something else (navigation, header,
footer, sidebar, notice, advert, form, comments) are left out, as are scripts,
styles and the like. A page whose text is template for the most part is a copy
of other pages rather than a layout, and keeps all of it.

Defined cases: null or empty html gives an empty text; a null url is a host of
its own; a host with fewer than MIN_PAGES distinct pages has no template;
repeated pages are extracted alike; unclosed and stray tags are repaired as
browsers do for paragraphs, list items and cells; the text of formulas, object
and noscript elements counts, that of svg, template and iframe elements does
not, and one that is never closed is no element; there is no limit of depth or of
siblings; an empty table yields no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import map_arrow, materialize, read

MIN_PAGES = 3
SAME_SHARE = 0.9
MAIN_SHARE = 0.7
COPY_SHARE = 0.5          # of an article's characters: with more template than this, a page is a copy
TREES = 256               # reference trees that a task keeps parsed

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?a-zA-Z][^>]*(?:>|\Z)""", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
SPACE = re.compile(r"\s+")

# content is no markup; never closed, it is the rest of the page
RAW = {"script", "style", "textarea", "title"}
# left out up to the end tag that belongs to them; never closed, only the tag is
OMIT = {"svg", "template", "iframe", "annotation", "annotation-xml"}
FOREIGN = {"svg", "math", "annotation", "annotation-xml"}          # '/>' closes these
UNQUOTED_END = re.compile(r"""=\s*[^\s"'>]+/\Z""")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "object", "noscript", "math", "menclose", "mfenced", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover",
          "mpadded", "mphantom", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtable", "mtd", "mtext", "mtr",
          "munder", "munderover", "semantics"}
# a start tag closes these open elements, up to the nearest of the second set
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "option": ({"option"}, {"select"})}
BOILER_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head"}
BOILER_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "contentinfo",
    "cookie", "cookies", "disqus", "footer", "header", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup",
    "promo", "related", "search", "share", "sharing", "sidebar", "sponsor", "sponsored", "subscribe", "toolbar", "complementary",
}
MAIN_TAGS = ("article", "main")


class Node:
    """A block element: its kids are block elements and stretches of text."""

    __slots__ = ("tag", "label", "boiler", "kids")

    def __init__(self, tag: str, names: str = ""):
        words = [w for w in re.split(r"[\s_-]+", names.lower()) if w]
        self.tag, self.label = tag, f"{tag}.{'.'.join(words)}" if words else tag
        self.boiler = tag in BOILER_TAGS or (tag not in ("html", "body") and any(w in BOILER_NAMES for w in words))
        self.kids: list = []


def closed_itself(tag: str, attributes: str) -> bool:
    return tag in FOREIGN and attributes.endswith("/") and not UNQUOTED_END.search(attributes)


def omitted(source: str) -> dict[int, int]:
    """Where the content of each omitted element begins, and where its end tag ends; those never closed are not in it."""
    out: dict[int, int] = {}
    open_at: dict[str, list[int]] = {t: [] for t in OMIT}
    for m in TOKEN.finditer(source):
        tag = (m[2] or "").lower()
        if tag not in OMIT:
            continue
        if not m[1]:
            if not closed_itself(tag, m[3]):
                open_at[tag].append(m.end())
        elif open_at[tag]:
            out[open_at[tag].pop()] = m.end()
    return out


def parse(source: str) -> Node:
    """A tolerant block tree of a page."""
    root = Node("#root")
    stack = [root]
    is_open: Counter = Counter()
    text: list[str] = []
    ends: dict[int, int] | None = None

    def end_text() -> None:
        if text:
            block = SPACE.sub(" ", html.unescape("".join(text))).strip()
            if block:
                stack[-1].kids.append(block)
            text.clear()

    def close(upto: int) -> None:
        end_text()
        is_open.subtract(n.tag for n in stack[upto:])
        del stack[upto:]

    at, lower = 0, None
    while m := TOKEN.search(source, at):
        if m.start() > at:
            text.append(source[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in INLINE:
                continue
            if is_open[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            elif tag not in OMIT:
                end_text()
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in OMIT:
            if not closed_itself(tag, m[3] or ""):
                ends = omitted(source) if ends is None else ends
                at = ends.get(at, at)
            text.append(" ")
            continue
        if tag in RAW or tag == "xmp":
            if lower is None:
                lower = source.lower() if len(source.lower()) == len(source) else source
            end = lower.find(f"</{tag}", at)
            if end < 0 and tag == "xmp":
                continue
            if end < 0:                                  # never closed: the rest is its content
                at = len(source)
                break
            stop = source.find(">", end)
            if tag == "xmp":                             # shown as it stands
                end_text()
                text.append(html.escape(source[at:end]))
                end_text()
            at = stop + 1 if stop >= 0 else len(source)
            text.append(" ")
            continue
        if tag in INLINE:
            continue
        end_text()
        if tag in VOID:
            continue
        closed, until = CLOSES.get(tag, ((), ()))
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                close(i)
            elif stack[i].tag in closed:
                close(i)
            elif stack[i].tag in until or not closed or stack[i].tag not in ("thead", "tbody", "tfoot", "td", "th"):
                break
        names = " ".join(a or b or c for a, b, c in NAMES.findall(m[3] or ""))
        node = Node(tag, names)
        stack[-1].kids.append(node)
        stack.append(node)
        is_open[tag] += 1
    text.append(source[at:])
    close(1)
    return root


class Shape:
    """Sibling elements of one label, with their children joined: the node that is aligned. Kids are in order of first occurrence."""

    __slots__ = ("label", "members", "kids")

    def __init__(self, members: list[Node]):
        self.label, self.members, self.kids = members[0].label, members, []
        todo = [self]
        while todo:
            shape = todo.pop()
            groups: dict[str, list[Node]] = {}
            for n in shape.members:
                for k in n.kids:
                    if not isinstance(k, str):
                        groups.setdefault(k.label, []).append(k)
            for label, own in groups.items():
                kid = Shape.__new__(Shape)
                kid.label, kid.members, kid.kids = label, own, []
                shape.kids.append(kid)
                todo.append(kid)


def in_order(pairs: list[tuple[int, int, int]]) -> tuple[int, list[int]]:
    """Of (left, right, weight), each left and right once, the heaviest choice that ascends in both: its weight and the pairs' numbers."""
    order = sorted(range(len(pairs)), key=lambda i: pairs[i][0])
    places = {j: r + 1 for r, j in enumerate(sorted(p[1] for p in pairs))}
    top = [(0, -1)] * (len(pairs) + 1)               # heaviest chain that ends at a right place, by binary indexed prefixes
    before = [-1] * len(pairs)
    best = (0, -1)
    for i in order:
        r = places[pairs[i][1]]
        at, found = r - 1, (0, -1)
        while at > 0:
            found = max(found, top[at])
            at -= at & -at
        before[i] = found[1]
        mine = (found[0] + pairs[i][2], i)
        best = max(best, mine)
        at = r
        while at < len(top):
            top[at] = max(top[at], mine)
            at += at & -at
    out, i = [], best[1]
    while i >= 0:
        out.append(i)
        i = before[i]
    return best[0], out[::-1]


def match(a: Shape, b: Shape) -> tuple[int, set[tuple[int, int]]]:
    """Simple tree matching: the largest number of node pairs that keep labels, parents and the order of siblings,
    and the pairs (by identity) of one such matching."""
    if a.label != b.label:
        return 0, set()
    met, todo = [], [(a, b, -1)]                     # pairs of equal labels under equal labels, parents first
    while todo:
        x, y, parent = todo.pop()
        at = len(met)
        met.append((x, y, parent))
        right = {k.label: j for j, k in enumerate(y.kids)}
        todo += [(k, y.kids[right[k.label]], at) for k in x.kids if k.label in right]
    weight, chosen = [0] * len(met), [[]] * len(met)
    below: list[list[int]] = [[] for _ in met]
    for i, (_, _, parent) in enumerate(met):
        if parent >= 0:
            below[parent].append(i)
    for i in range(len(met) - 1, -1, -1):
        x, y, _ = met[i]
        left, right = {id(k): n for n, k in enumerate(x.kids)}, {id(k): n for n, k in enumerate(y.kids)}
        total, picked = in_order([(left[id(met[c][0])], right[id(met[c][1])], weight[c]) for c in below[i]])
        weight[i], chosen[i] = 1 + total, [below[i][c] for c in picked]
    pairs, todo = set(), [0]
    while todo:
        i = todo.pop()
        pairs.add((id(met[i][0]), id(met[i][1])))
        todo += chosen[i]
    return weight[0], pairs


def _hash(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)


def slots(page: Node, reference: Shape | None) -> dict[int, int]:
    """Each element's slot: a hash of the labels on the way to it, where an element without a partner in the reference starts a way of its own."""
    shape = Shape([page])
    matched = {x for x, _ in match(shape, reference)[1]} if reference is not None else set()
    out, todo = {}, [(shape, 0)]
    while todo:
        s, above = todo.pop()
        own = _hash(above.to_bytes(8, "little", signed=True), b"=" if id(s) in matched else b"~", s.label.encode("utf-8", "surrogatepass"))
        for n in s.members:
            out[id(n)] = own
        todo += [(k, own) for k in s.kids]
    return out


class Page:
    """What is counted and chosen from: the text blocks outside boilerplate, in page order, and the elements around them."""

    __slots__ = ("main", "slot", "text", "node", "parent")

    def __init__(self, root: Node, reference: Shape | None):
        chosen = self._mains(root)
        self.main = bool(chosen)
        place = slots(root, reference)
        self.slot: list[int] = []
        self.text: list[str] = []
        self.node: list[int] = []            # the element of each block
        self.parent: list[int] = []          # of each element, parents first
        own_slot: list[int] = []             # and its slot
        todo: list[tuple] = [(n, -1) for n in reversed(chosen or [root])]
        while todo:
            k, up = todo.pop()
            if isinstance(k, str):
                self.text.append(k)
                self.node.append(up)
                self.slot.append(own_slot[up])
                continue
            own_slot.append(place[id(k)])
            self.parent.append(up)
            at = len(self.parent) - 1
            todo += [(x, at) for x in reversed(k.kids) if isinstance(x, str) or not x.boiler]

    @staticmethod
    def _mains(root: Node) -> list[Node]:
        """The page's article elements inside main elements or alone, else its main elements."""
        def outermost(start: Node) -> list[Node]:
            out, todo = [], [k for k in reversed(start.kids) if not isinstance(k, str)]
            while todo:
                k = todo.pop()
                if k.boiler:
                    continue
                if k.tag in MAIN_TAGS:
                    out.append(k)
                else:
                    todo += [x for x in reversed(k.kids) if not isinstance(x, str)]
            return out

        own = outermost(root)
        articles = [a for n in own for a in ([n] if n.tag == "article" else outermost(n)) if a.tag == "article"]
        return articles or own

    def marks(self) -> list[tuple[int, int]]:
        """(slot, hash of the text) of each block."""
        return [(s, _hash(t.encode("utf-8", "surrogatepass"))) for s, t in zip(self.slot, self.text, strict=True)]


def chosen_text(main: bool, text: list[str], node: list[int], parent: list[int], template: list[bool]) -> str:
    """The main text, given which blocks are template."""
    total = sum(map(len, text))
    gone = sum(len(t) for t, x in zip(text, template, strict=True) if x)
    kept = [True] * len(text) if main and gone > COPY_SHARE * total else [not x for x in template]
    if main:
        return "\n".join(t for t, k in zip(text, kept, strict=True) if k)
    mass, kids = [0] * len(parent), [[] for _ in parent]
    for t, n, k in zip(text, node, kept, strict=True):
        mass[n] += len(t) if k else 0
    for i in range(len(parent) - 1, 0, -1):
        if parent[i] >= 0:
            mass[parent[i]] += mass[i]
            kids[parent[i]].append(i)
    centre, all_mass = 0, mass[0] if mass else 0
    while inner := [k for k in reversed(kids[centre]) if kids[k] and mass[k] > 0 and mass[k] >= MAIN_SHARE * all_mass] if kids else []:
        centre = inner[0]
    inside = [False] * len(parent)
    for i in range(len(parent)):
        inside[i] = i == centre or parent[i] >= 0 and inside[parent[i]]
    return "\n".join(t for t, n, k in zip(text, node, kept, strict=True) if k and inside[n])


def extract(pages: list[Node]) -> list[str]:
    """Main texts of a few pages of one host, the first one the reference: what `main_texts` does for all hosts."""
    reference = Shape([pages[0]])
    own = [Page(p, reference) for p in pages]
    marks = [p.marks() for p in own]
    having, slot_pages = Counter(), Counter()
    for m in {tuple(h for _, h in m): set(m) for m in marks}.values():
        having.update(m)
        slot_pages.update({s for s, _ in m})
    template = {m for m, n in having.items() if n >= MIN_PAGES and n >= SAME_SHARE * slot_pages[m[0]]}
    return [chosen_text(p.main, p.text, p.node, p.parent, [x in template for x in m]) for p, m in zip(own, marks, strict=True)]


BLOCKS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("content", pa.int64()), ("main", pa.bool_()),
                    ("slot", pa.list_(pa.int64())), ("hash", pa.list_(pa.int64())), ("text", pa.list_(pa.string())),
                    ("node", pa.list_(pa.int32())), ("parent", pa.list_(pa.int32()))])
BLOCKS_DDL = ("page_id long, url string, host string, content long, main boolean, slot array<long>, hash array<long>, text array<string>, "
              "node array<int>, parent array<int>")
ROWS = 256


def references(pages: DataFrame) -> DataFrame:
    """(host, reference): one page of every host, the one with the least hash of its html. The least hashes are written
    first, so that Spark knows their size and need not shuffle the pages to meet them."""
    least = materialize(pages.groupBy("host").agg(F.min("h").alias("h")), "page-least")
    return pages.join(least, ["host", "h"]).groupBy("host").agg(F.min("html").alias("reference"))


def page_blocks(pages: DataFrame) -> DataFrame:
    """The text blocks of every page (page_id, url, host, html) with the slots that its host's reference gives them."""
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, Shape] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                out = []
                for r in batch.slice(i, ROWS).to_pylist():
                    if r["host"] not in trees:
                        if len(trees) >= TREES:
                            trees.pop(next(iter(trees)))
                        trees[r["host"]] = Shape([parse(r["reference"])])
                    p = Page(parse(r["html"]), trees[r["host"]])
                    hashes = [h for _, h in p.marks()]
                    content = _hash(b"".join(h.to_bytes(8, "little", signed=True) for h in hashes))
                    out.append((r["page_id"], r["url"], r["host"], content, p.main, p.slot, hashes, p.text, p.node, p.parent))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), BLOCKS, strict=True)], schema=BLOCKS)

    return map_arrow(pages.select("page_id", "url", "host", "html", "reference"), tasks, BLOCKS_DDL)


def templates(blocks: DataFrame) -> DataFrame:
    """(host, marks): the slots and texts that are template. A page has few of them, so a host's list is as short as a page."""
    distinct = blocks.groupBy("host", "content").agg(F.min(F.arrays_zip("slot", "hash")).alias("b"))
    each = distinct.select("host", F.explode(F.array_distinct("b")).alias("x")).groupBy("host", "x.slot", "x.hash").agg(F.count("*").alias("n"))
    pages = distinct.select("host", F.explode(F.array_distinct(F.transform("b", lambda x: x["slot"]))).alias("slot")).groupBy("host", "slot").agg(
        F.count("*").alias("pages"))
    marked = each.where(F.col("n") >= MIN_PAGES).join(pages, ["host", "slot"]).where(F.col("n") >= SAME_SHARE * F.col("pages"))
    return marked.groupBy("host").agg(F.collect_list(F.struct("slot", "hash")).alias("marks"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"://([^/?#]*)", 1))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))
    known = materialize(references(own.withColumn("h", F.xxhash64("html"))), "page-references")
    blocks = materialize(page_blocks(own.join(known, "host")), "page-blocks")
    marks = materialize(templates(blocks), "page-templates")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                texts = []
                for r in part.to_pylist():
                    marked = {(m["slot"], m["hash"]) for m in r["marks"] or ()}
                    template = [x in marked for x in zip(r["slot"], r["hash"], strict=True)]
                    texts.append(chosen_text(r["main"], r["text"], r["node"], r["parent"], template))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return map_arrow(blocks.join(marks, "host", "left").drop("host", "content"), tasks, "page_id long, url string, text string")


def op10_tree_wrapper(spark, sf_dir: str) -> DataFrame:
    return main_texts(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
