r"""Main text of web pages by wrapper induction (list item 11).

Every page is parsed once into a DOM tree and its text blocks.  A page's
*shape* is its tree without text, in which siblings of one role (same tag,
first class word and kind) are one node, while the first ``PLACES`` bare
containers of a parent keep their places.  Shapes of a host are aligned by
simple tree matching (the order-keeping pairing of equal nodes that pairs
most nodes) and merged into the host's wrapper; unpaired nodes are added in
place.  Aligning a shape with its wrapper once more gives every node of every
page its slot in the wrapper.

Slots and blocks are then told apart over all pages of the host:

* template: a text that stands in one slot on at least ``CONSTANT_SHARE`` of
  the different articles that fill the slot (three at least).  Pages whose longest
  block agrees are one article, so copies of a page are no evidence;
* menu: a slot whose characters are mostly those of links;
* furniture: nodes that their tag, role or class words name as menus,
  headers, footers, sidebars, notices, adverts, forms or comments, scripts
  and hidden parts (a varying slot is not content if its name says so);
* content: all other blocks inside the page's article or main nodes; where
  there are none, inside the deepest container with most of the text.

On Spark: only distinct shapes of a host are merged, in groups of at most
about ``FAN_IN`` by bits of the shape's digest, level by level, so neither a
host with a third of all pages nor the split of the input changes the wrapper
or loads one task.  Texts are counted by (host, slot, hash, article) with
map-side sums and do not move; the wrapper's findings, one short row a shape
and a host, come to the written pages by joins, broadcast if measured small.

Edge cases: null html is an empty text; a null or odd url belongs to the host
with the empty name; repeated rows are each returned, and are one article;
cut-off markup ends at the end of the page; a page without any block left
has an empty text, unless every block was a template, when the host's pages
tell nothing apart and the blocks stay; nesting below ``MAX_DEPTH`` is flat;
clashing input columns are replaced; an empty table gives no rows.  A long
page is one row and is held whole in its task.
"""

from __future__ import annotations

import hashlib
import html
import json
import math
import re
from typing import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from .common import blocks, keep_others, quoted, written

MAX_DEPTH = 200
PLACES = 8
FAN_IN = 64
CONSTANT_SHARE = 0.5
MIN_ARTICLES = 3
LINK_SHARE = 0.5
MAIN_SHARE = 0.25
CONTAINER_SHARE = 0.6
BROADCAST_BYTES = 32 << 20
OUT = ["text", "n_chars", "__host", "__shape", "__tree", "__article", "__blocks", "__slots", "__dense", "__fixed"]


def _words(text: str) -> frozenset:
    return frozenset(text.split())


# fixed values: tags and the class, id and role words that name a part of a page
VOID = _words("area base br col embed hr img input link meta param source track wbr")
RAW = _words("script style iframe noembed noframes xmp textarea title")
INLINE = _words("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
                "small span strike strong sub sup time tt u var wbr")
CONTAINERS = _words("html body div section table tbody thead tfoot tr td center main article header blockquote figure")
BARE = _words("div section table td ul ol dl center")
FURNITURE_TAGS = _words("nav aside footer form script style noscript template head title iframe svg canvas object audio video map "
                        "select option optgroup datalist button textarea menu dialog fieldset legend noembed noframes")
CLOSES_P = _words("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 "
                  "h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul")
#: start tag: the open tags it ends, and those that shield them
ENDS = {"li": (_words("li"), _words("ul ol menu")), "dt": (_words("dt dd"), _words("dl")), "dd": (_words("dt dd"), _words("dl")),
        "tr": (_words("tr td th"), _words("table")), "td": (_words("td th"), _words("tr table")),
        "th": (_words("td th"), _words("tr table")), "tbody": (_words("tbody thead tfoot tr td th"), _words("table")),
        "tfoot": (_words("tbody thead tfoot tr td th"), _words("table")), "option": (_words("option"), _words("select")),
        "optgroup": (_words("option optgroup"), _words("select"))}
SHIELDS = _words("table td th")
PARAGRAPH, SHIELDS_P = _words("p"), _words("table td th button")
COMMENT_WORDS = _words("comment comments commentlist disqus respond reply replies discussion responses review reviews guestbook")
ASIDE_WORDS = _words("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted "
                     "related recommended recommendations trending teaser teasers outbrain taboola")
PART_WORDS = _words(
    "nav navbar navigation menu menus breadcrumb breadcrumbs crumbs topbar toolbar tabs pager pagination skip masthead banner footer "
    "copyright colophon legal sidebar aside rail popular widget widgets cookie cookies consent gdpr notice notices notification alert "
    "alerts disclaimer popup modal overlay paywall toast announcement form search login signin signup register subscribe subscription "
    "newsletter feedback survey poll share sharing social follow hidden invisible")
HEADER_WORDS = _words("header")
ARTICLE_WORDS = _words("article entry post story content")
NEGATIONS = _words("has with no without")
FURNITURE_ROLES = _words("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist "
                         "status")

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}


# ---- pages

def named_kind(tag: str, attributes: str) -> tuple[str, str]:
    """(first class or id word without digits, kind): x furniture by tag or role, z or y by name, h header, m article or main, or empty."""
    name, kind, words = "", "", []
    if attributes:
        found: dict[str, str] = {}
        for key, *values in _ATTRIBUTE.findall(attributes):
            found.setdefault(key.lower(), next((v for v in values if v), ""))
        tokens = f"{found.get('class', '')} {found.get('id', '')}".split()
        for token in tokens:
            parts = [w.lower() for w in _WORD.findall(token)]
            if not name and parts and not any(p.isdigit() for p in parts):
                name = "-".join(parts)
            words.extend(p for k, p in enumerate(parts) if not (k and parts[k - 1] in NEGATIONS))
        role = found.get("role", "").lower()
        style = found.get("style", "").replace(" ", "").lower()
        if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or role in FURNITURE_ROLES:
            kind = "x"
        elif role in ("main", "article") or "articleBody" in found.get("itemprop", ""):
            kind = "m"
    held = set(words)
    if tag in FURNITURE_TAGS:
        kind = "x"
    elif tag in ("html", "body", "main"):
        kind = "m" if tag == "main" else ""
    elif not kind:
        if held & (COMMENT_WORDS | ASIDE_WORDS):
            kind = "z"
        elif held & PART_WORDS and tag != "article":
            kind = "y"
        elif tag == "article":
            kind = "m"
        elif tag == "header" or held & HEADER_WORDS and not held & ARTICLE_WORDS:
            kind = "h"
    return name, kind


class Page:
    """Shape and text blocks of one page."""

    def __init__(self, text: str):
        self.labels, self.parents, self.tags, self.kinds = ["#"], [-1], ["#"], [""]
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters inside links
        self._places: dict[tuple[int, str, int], int] = {}
        self._seen: dict[tuple[str, str], tuple[str, str]] = {}
        self._stack: list[tuple[str, int, dict]] = [("#", 0, {})]
        self._run: list[str] = []
        self._links = 0
        self._link_at = 0  # depth at which a link is open
        self._parse(text)

    def _parse(self, text: str) -> None:
        at, end = 0, len(text)
        while at < end:
            m = _TOKEN.search(text, at)
            if m is None:
                self._text(text[at:])
                break
            if m.start() > at:
                self._text(text[at:m.start()])
            at = m.end()
            tag = (m.group(2) or m.group(5) or "").lower()
            if not tag:
                continue
            if m.group(1) or m.group(4):
                self._end(tag)
                continue
            attributes = m.group(3) or m.group(6) or ""
            self._start(tag, attributes)
            if tag in RAW:
                close = _RAW_END[tag].search(text, at)
                at = close.start() if close else end
        self._flush()

    def _text(self, raw: str) -> None:
        if "&" in raw:
            raw = html.unescape(raw)
        self._run.append(raw)
        if self._link_at:
            self._links += len("".join(raw.split()))

    def _flush(self) -> None:
        if self._run:
            text = " ".join("".join(self._run).split())
            if text:
                self.blocks.append((self._stack[-1][1], text, self._links))
            self._run = []
        self._links = 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("br", "hr"):
            self._run.append(" ")
            return
        key = (tag, attributes)
        if key not in self._seen:
            self._seen[key] = named_kind(tag, attributes)
        name, kind = self._seen[key]
        if tag == "a" and "href" in attributes:
            self._link_at = len(self._stack)
        if tag in INLINE and not kind or tag in VOID:
            return
        self._flush()
        if tag in CLOSES_P:
            self._end_open(PARAGRAPH, SHIELDS_P)
        if tag in ENDS:
            self._end_open(*ENDS[tag])
        _, parent, count = self._stack[-1]
        label = f"{tag}.{name}/{kind}"
        place = 0
        if tag in BARE and not name:
            place = min(count.get(label, 0), PLACES - 1)
            count[label] = place + 1
        node = self._places.get((parent, label, place))
        if node is None:
            node = self._places[parent, label, place] = len(self.labels)
            self.labels.append(label)
            self.parents.append(parent)
            self.tags.append(tag)
            self.kinds.append(kind)
        if len(self._stack) < MAX_DEPTH:
            self._stack.append((tag, node, {}))

    def _close_to(self, depth: int) -> None:
        self._flush()
        del self._stack[depth:]
        if self._link_at > depth:
            self._link_at = 0

    def _end_open(self, ended: frozenset, shields: frozenset) -> None:
        """Close the open elements of ``ended`` above the innermost of ``shields``."""
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self._stack[depth][0]
            if tag in shields:
                return
            if tag in ended:
                self._close_to(depth)

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._link_at = 0
        for depth in range(len(self._stack) - 1, 0, -1):
            open_tag = self._stack[depth][0]
            if open_tag == tag:
                self._close_to(depth)
                return
            if tag in INLINE or open_tag in SHIELDS and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                return


def furniture(parents: list[int], kinds: list[str], wrong: set[int] = frozenset()) -> list[str]:
    """Kind x, y or z handed down the shape, or empty; a header is furniture outside articles; ``wrong``: nodes whose kind does not count."""
    out, main = [""], [False]
    for k in range(1, len(parents)):
        up, kind = parents[k], "" if k in wrong else kinds[k]
        main.append(main[up] or kind == "m")
        own = "y" if kind == "h" and not main[up] else kind if kind in ("x", "y", "z") else ""
        out.append(out[up] or own)
    return out


def misnamed(tags: list[str], parents: list[int], kinds: list[str]) -> set[int]:
    """Named wrappers ("page popup-ready") of the only article there is: their names say nothing."""
    part = furniture(parents, kinds)
    articles = [n for n, kind in enumerate(kinds) if kind == "m"]
    if any(not part[n] for n in articles):
        return set()
    out = set()
    for n in articles:
        path = []
        while n > 0:
            path.append(n)
            n = parents[n]
        if not any(kinds[k] in ("x", "z") for k in path):
            out |= {k for k in path if kinds[k] in ("y", "h") and tags[k] in ("div", "section")}
    return out


# ---- simple tree matching

def tree_of(tree: str) -> list:
    """The written shape (labels and parents in order of appearance) as nodes [label, children, number]."""
    labels, parents = json.loads(tree)
    nodes = [[label, [], k] for k, label in enumerate(labels)]
    for k in range(1, len(nodes)):
        nodes[parents[k]][1].append(nodes[k])
    return nodes[0]


def written_tree(root: list) -> str:
    labels, parents = [], []

    def walk(node: list, parent: int) -> None:
        k = len(labels)
        labels.append(node[0])
        parents.append(parent)
        for child in node[1]:
            walk(child, k)

    walk(root, -1)
    return json.dumps([labels, parents], separators=(",", ":"))


def match(a: list, b: list) -> tuple[int, list]:
    """Simple tree matching of two nodes with equal labels: number of paired nodes, pairs of children with their own pairs."""
    left, right = a[1], b[1]
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    found: dict[tuple[int, int], tuple[int, list]] = {}
    for i, x in enumerate(left, 1):
        row, above = best[i], best[i - 1]
        for j, y in enumerate(right, 1):
            row[j] = max(above[j], row[j - 1])
            if x[0] == y[0]:
                found[i, j] = match(x, y)
                row[j] = max(row[j], above[j - 1] + found[i, j][0])
    pairs, i, j = [], len(left), len(right)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs.append((i - 1, j - 1, found[i, j][1]))
            i, j = i - 1, j - 1
    return 1 + best[-1][-1], pairs[::-1]


def merge(wrapper: list, shape: list, pairs: list | None = None) -> None:
    """Add to ``wrapper`` the nodes of ``shape`` that simple tree matching leaves unpaired, after the pair before them."""
    pairs = match(wrapper, shape)[1] if pairs is None else pairs
    children, out, at, k = wrapper[1], [], 0, 0
    for i, j, inner in pairs:
        out.extend(children[at:i])
        out.extend(shape[1][k:j])
        merge(children[i], shape[1][j], inner)
        out.append(children[i])
        at, k = i + 1, j + 1
    wrapper[1] = out + children[at:] + shape[1][k:]


def slots_of(wrapper: list, shape: list, n: int) -> list[int]:
    """Slot of every node of the shape: its partner's number in the wrapper, -1 without one."""
    out = [-1] * n
    out[shape[2]] = wrapper[2]

    def walk(a: list, b: list, pairs: list) -> None:
        for i, j, inner in pairs:
            out[b[1][j][2]] = a[1][i][2]
            walk(a[1][i], b[1][j], inner)

    walk(wrapper, shape, match(wrapper, shape)[1])
    return out


# ---- the wrapper's findings on Spark

_BLOCK = pa.struct([("node", pa.int32()), ("hash", pa.int64()), ("chars", pa.int32()), ("links", pa.int32()), ("text", pa.string())])
_PARSED = pa.schema([("__host", pa.string()), ("__shape", pa.string()), ("__tree", pa.string()), ("__article", pa.int64()),
                     ("__blocks", pa.list_(_BLOCK))])
_HOST = re.compile(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def _signed(data: str) -> int:
    h = xxhash.xxh64_intdigest(data.encode("utf-8", "surrogatepass"))
    return h - ((h >> 63) << 64)


def parsed(pages: DataFrame, carry: list[str], url_col: str, html_col: str) -> DataFrame:
    """carry and the columns of _PARSED for every page."""
    src = pages.select(*[quoted(c) for c in carry], quoted(url_col).cast("string").alias("__url"), quoted(html_col).cast("string").alias("__html"))
    n = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in blocks(batches, n + 1):
            cols: list[list] = [[], [], [], [], []]
            for url, text in zip(b.column(n).to_pylist(), texts):
                page = Page(text.decode("utf-8", "replace"))
                tree = json.dumps([page.labels, page.parents], separators=(",", ":"))
                part = furniture(page.parents, page.kinds)
                longest = max((t for k, t, _ in page.blocks if not part[k]), key=len, default="")
                m = _HOST.match(url or "")
                row = (m.group(1).lower() if m else "", hashlib.md5(tree.encode()).hexdigest(), tree, _signed(longest),
                       [(k, _signed(t), len(t), links, t) for k, t, links in page.blocks])
                for col, value in zip(cols, row):
                    col.append(value)
            cols[4] = [[dict(zip(("node", "hash", "chars", "links", "text"), x)) for x in page] for page in cols[4]]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *[pa.array(c, f.type) for c, f in zip(cols, _PARSED)]],
                                             names=[*carry, *_PARSED.names])

    return src.mapInArrow(run, T.StructType([*src.schema.fields[:n], *from_arrow_schema(_PARSED).fields]))


_WRAPPER = pa.schema([("__host", pa.string()), ("bits", pa.int64()), ("tree", pa.string())])


def _merge_group(rows: pa.Table) -> pa.Table:
    """One host's shapes of a group into one, in order of their digests' bits and text."""
    shapes = sorted(zip(rows["bits"].to_pylist(), rows["tree"].to_pylist()))
    wrapper = tree_of(shapes[0][1])
    for _, tree in shapes[1:]:
        merge(wrapper, tree_of(tree))
    return pa.table([[rows["__host"][0].as_py()], [rows["next"][0].as_py()], [written_tree(wrapper)]], schema=_WRAPPER)


def wrappers(shapes: DataFrame) -> DataFrame:
    """__host, tree: the merged shapes of every host; ``shapes``: __host, __shape, __tree, each once."""
    most = shapes.groupBy("__host").count().agg(F.max("count")).first()[0] or 1
    level = max(0, math.ceil(math.log(most, FAN_IN)) - 1)
    rows = shapes.select("__host", F.conv(F.substring("__shape", 1, 15), 16, 10).cast("long").alias("bits"), F.col("__tree").alias("tree"))
    for k in range(level, -1, -1):  # FAN_IN ** k groups a host, the next level's groups are made of whole ones
        rows = written(rows.withColumn("next", F.col("bits") % F.lit(FAN_IN ** k)).groupBy("__host", "next")
                       .applyInArrow(_merge_group, from_arrow_schema(_WRAPPER)), "wrappers")
    return rows.select("__host", "tree")


def _slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def numbered(node: list, at: list[int]) -> list:
        node[2] = at[0]
        at[0] += 1
        for child in node[1]:
            numbered(child, at)
        return node

    for b in batches:
        out = []
        held: tuple = (None, None)
        for tree, wrapper in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            if held[0] != wrapper:
                held = (wrapper, numbered(tree_of(wrapper), [0]))
            out.append(slots_of(held[1], tree_of(tree), len(json.loads(tree)[0])))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int32()))],
                                         names=["__host", "__shape", "__slots"])


def _small(df: DataFrame, size) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows it."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def slot_findings(pages: DataFrame, slots: DataFrame) -> DataFrame:
    """__host, __dense (slots of links), __fixed (hashes of slot and template text)."""
    found = (pages.select("__host", "__shape", "__article", F.explode(F.transform("__blocks", lambda x: F.struct(
                x["node"].alias("node"), x["hash"].alias("hash"), x["chars"].alias("chars"), x["links"].alias("links")))).alias("b"))
             .join(slots, ["__host", "__shape"])
             .select("__host", "__article", F.element_at("__slots", F.col("b.node") + 1).alias("slot"), "b.hash", "b.chars", "b.links"))
    once = written(found.groupBy("__host", "slot", "hash", "__article").agg(F.sum("chars").alias("chars"), F.sum("links").alias("links")), "block_counts")
    per_slot = once.groupBy("__host", "slot").agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    dense = (per_slot.filter(F.col("links") > LINK_SHARE * F.col("chars")).groupBy("__host").agg(F.collect_set("slot").alias("__dense")))
    filled = once.select("__host", "slot", "__article").distinct().groupBy("__host", "slot").agg(F.count(F.lit(1)).alias("of"))
    often = once.groupBy("__host", "slot", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_ARTICLES)
    fixed = (often.join(filled, ["__host", "slot"]).filter(F.col("n") >= CONSTANT_SHARE * F.col("of"))
             .groupBy("__host").agg(F.collect_set(F.struct("slot", "hash")).alias("__fixed")))
    return dense.join(fixed, "__host", "full").select("__host", "__dense", "__fixed")


def main_text(labels: list[str], parents: list[int], found: list[tuple[int, str]], slots: list[int], dense: set, fixed: set,
              hashes: list[int]) -> str:
    """The content blocks of one page; ``found``: (node, text) in page order."""
    tags = [x.split(".", 1)[0] for x in labels]
    kinds = [x.rsplit("/", 1)[-1] for x in labels]
    part = furniture(parents, kinds, misnamed(tags, parents, kinds))
    open_blocks = [k for k, (node, _) in enumerate(found) if not part[node] and slots[node] not in dense]
    kept = [k for k in open_blocks if (slots[found[k][0]], hashes[k]) not in fixed] or open_blocks
    total = sum(len(found[k][1]) for k in kept)

    def under(roots: set[int]) -> list[int]:
        inside = [False] * len(labels)
        for n in range(len(labels)):
            inside[n] = n in roots or n > 0 and inside[parents[n]]
        return [k for k in kept if inside[found[k][0]]]

    for of in ("article", None):
        roots = {n for n in range(len(labels)) if kinds[n] == "m" and (of is None or tags[n] == of)}
        some = under(roots) if roots else []
        if some and sum(len(found[k][1]) for k in some) >= MAIN_SHARE * total:
            return " ".join(found[k][1] for k in some)
    held = [0] * len(labels)
    for k in kept:
        n = found[k][0]
        while n >= 0:
            held[n] += len(found[k][1])
            n = parents[n]
    root = 0
    for n in range(1, len(labels)):  # children come after their parents
        if parents[n] == root and tags[n] in CONTAINERS and held[n] >= CONTAINER_SHARE * total:
            root = n
    chosen = set(under({root}))
    return " ".join(found[k][1] for k in kept if k in chosen or tags[found[k][0]] == "h1")


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The columns of ``pages`` without the html, plus text and n_chars."""
    carry = keep_others(pages, [*OUT, html_col])
    read = written(parsed(pages, carry, url_col, html_col), "page_blocks")
    shapes = written(read.groupBy("__host", "__shape").agg(F.first("__tree").alias("__tree")), "shapes")
    slots = written(shapes.join(wrappers(shapes), "__host").mapInArrow(
        _slot_rows, "__host string, __shape string, __slots array<int>"), "slots")
    slots = _small(slots, F.length("__shape") + 4 * F.size("__slots"))
    findings = written(slot_findings(read, slots), "findings")
    findings = _small(findings, 12 * F.coalesce(F.size("__fixed"), F.lit(0)) + 4 * F.coalesce(F.size("__dense"), F.lit(0)) + 64)
    n = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["__tree", "__blocks", "__slots", "__dense", "__fixed"]
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                texts = []
                for tree, found, slots, dense, fixed in zip(*(some.column(k).to_pylist() for k in names)):
                    labels, parents = json.loads(tree)
                    texts.append(main_text(labels, parents, [(x["node"], x["text"]) for x in found], slots, set(dense or ()),
                                           {(x["slot"], x["hash"]) for x in fixed or ()}, [x["hash"] for x in found]))
                yield pa.RecordBatch.from_arrays([*some.columns[:n], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=[*carry, "text", "n_chars"])

    joined = read.join(slots, ["__host", "__shape"]).join(findings, "__host", "left").select(
        *[quoted(c) for c in carry], "__tree", "__blocks", "__slots", "__dense", "__fixed")
    schema = T.StructType([*pages.select(*[quoted(c) for c in carry]).schema.fields, T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    return joined.mapInArrow(run, schema)
