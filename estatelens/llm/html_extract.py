"""Main-text extraction by wrapper induction.

A page is a tree of block elements, labelled by tag; a node's id is the way
to it, by tag and number among its siblings of that tag.  Of the pages with
a host's most frequent set of nested tags the largest is the host's
reference, and every page is aligned with it by simple tree matching, which
gives its nodes the ids of the reference's.  Nodes that carry the same text
on nearly all different pages that have the node are template, the other
text is in varying slots and is content.  Of the content, what stands in an
article is the main text, but for elements that say by tag, role, class or id
that they are something else.  Inside an article much more is asked of a
template: ``ARTICLES`` pages that have no longest text in common, so that
copies and near copies of an article never make its text a template.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.shared import UPPER, columns_of, cut, small_or_shuffled

#: A text is template if it stands at one node on this share of the host's
#: different pages that have the node, and on so many.
SHARE = 0.9
MIN_PAGES = 2
#: Pages with different longest texts that a template inside articles needs.
ARTICLES = 20
#: Elements nested deeper belong to their ancestor of this depth.
DEPTH = 40
#: Open elements that an opening tag looks through for one that it closes.
LOOK = 64
#: Larger tables of a tree matching are split in half.
CELLS = 1 << 22
#: Nodes whose alignment a task remembers.
KNOWN = 200_000

# Names of HTML; fixed values.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
OTHER_TAGS = frozenset(
    "nav header footer aside form menu dialog button select head svg math object template audio video canvas".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu menus "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent gdpr notice notices alert popup modal "
    "overlay banner newsletter subscribe subscription signup login comment comments commentlist disqus reply replies respond social "
    "share sharing related recommended pagination pager toolbar search skip".split())
#: Words that go with those above in a name, as in "ad-box"; a name with any
#: other word, as "share-price", says nothing.
NEUTRAL_WORDS = frozenset(
    "area bar block bottom box btn button buttons container content group icon icons inner item items left link links list main module "
    "outer page panel right row section site slot top unit wrap wrapper".split())
#: Elements of running text, and articles: their names say nothing.
TEXT_TAGS = frozenset("html body main article p h1 h2 h3 h4 h5 h6 li td th dt dd pre blockquote figcaption".split())
#: Names of articles that are readers' comments, if the page has another one.
COMMENT_WORDS = frozenset("comment comments reply replies".split())
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"})}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_WORD = re.compile(r"[a-z]+|[0-9]+")


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(text)} if "=" in text else {}


def _names(given: dict[str, str]) -> list[set[str]]:
    """The words of each of an element's classes and of its id."""
    names = (given.get("class", "") + " " + given.get("id", "")).split()
    return [set(_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", n).lower())) for n in names]


def _other(names: list[set[str]]) -> bool:
    """Whether a name is made of words for other things than the text."""
    return any(w & OTHER_WORDS and w <= OTHER_WORDS | NEUTRAL_WORDS for w in names)


class _Open:
    """The open elements of a page: (tag, path, excluded, place).

    ``place`` is 3 in an article, 2 in one that is named a comment, 1 in
    main.  ``inner`` counts the open inline tags since the last block, and
    ``blocks`` says where in the stack blocks are, so an end tag that closes
    nothing costs nothing."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str, bool, int]] = [("", "", False, 0)]
        self.blocks = [0]
        self.inner: list[dict[str, int]] = [{}]
        self.named: dict[str, list[int]] = {}

    def push(self, tag: str, path: str, excluded: bool, place: int) -> None:
        if tag in BLOCKS:
            self.named.setdefault(tag, []).append(len(self.stack))
            self.blocks.append(len(self.stack))
            self.inner.append({})
        else:
            self.inner[-1][tag] = self.inner[-1].get(tag, 0) + 1
        self.stack.append((tag, path, excluded, place))

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.stack.pop()[0]
            if tag in BLOCKS:
                self.named[tag].pop()
                self.blocks.pop()
                self.inner.pop()
            else:
                self.inner[-1][tag] -= 1

    def closed_by_end(self, tag: str) -> int | None:
        """Where the element that ``</tag>`` closes is; inline end tags do
        not close blocks."""
        if tag in BLOCKS:
            at = self.named.get(tag)
            return at[-1] if at else None
        if not self.inner[-1].get(tag):
            return None
        return next(i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i][0] == tag)

    def closed_by_start(self, tag: str) -> int | None:
        """Where the element is whose end tag ``<tag>`` makes unnecessary,
        looked for in the last ``LOOK`` blocks."""
        if self.stack[self.blocks[-1]][0] == "p":
            return self.blocks[-1]
        if tag in _CLOSES:
            same, until = _CLOSES[tag]
            for i in self.blocks[:-LOOK - 1:-1]:
                if self.stack[i][0] in same:
                    return i
                if self.stack[i][0] in until:
                    return None
        return None


def parse(page: str) -> tuple[list[str], list[tuple[str, str]], int]:
    """The shape of a page, as its node ids in page order; the blocks (node
    id, text) of its main part; and the place these have.

    One pass, in time proportional to the page."""
    shape: list[str] = []
    numbers: dict[str, int] = {}
    found: list[tuple[str, str, int]] = []
    opened = _Open()
    text: list[str] = []

    def flush() -> None:
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            text.clear()
            _, path, excluded, place = opened.stack[-1]
            if line and not excluded:
                found.append((path, line, place))

    def close(depth: int | None) -> None:
        if depth is not None:
            if opened.blocks[-1] >= depth:
                flush()
            opened.cut(depth)

    at, n = 0, len(page)
    while at < n:
        m = _MARKUP.search(page, at)
        if not m:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at:m.start()])
        at = max(m.end(), at + 1)
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            close(opened.closed_by_end(tag))
            continue
        if tag in RAW:
            end = re.compile("</" + re.escape(tag) + r"(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCKS:
            close(opened.closed_by_start(tag))
            flush()
        if tag in VOID:
            continue
        given = _attributes(m.group(3))
        _, path, excluded, place = opened.stack[-1]
        names = _names(given) if given else []
        role = given.get("role", "").lower()
        excluded = excluded or tag in OTHER_TAGS or role in OTHER_ROLES or (tag not in TEXT_TAGS and bool(names) and _other(names))
        if tag == "article":
            comment = any(w & COMMENT_WORDS for w in names)
            excluded = excluded or (comment and place == 3)
            place = max(place, 2 if comment else 3)
        elif tag == "main" or role == "main":
            place = max(place, 1)
        if tag in BLOCKS:
            if path.count("/") < DEPTH:
                path = f"{path}/{tag}"
                numbers[path] = k = numbers.get(path, 0) + 1
                path = f"{path}[{k}]"
                shape.append(path)
        if not m.group(3).rstrip().endswith("/") or tag in BLOCKS:
            opened.push(tag, path, excluded, place)
    flush()
    best = max((p for *_, p in found), default=0)
    return shape, [(path, line) for path, line, p in found if p == best], best


class Node:
    def __init__(self, label: str, path: str):
        self.label, self.path, self.children = label, path, []
        self.size, self.like = 1, b""


def tree(shape: list[str]) -> Node:
    """The tree of a page's node ids.  ``size`` counts the nodes of a
    subtree, ``like`` is the same for subtrees of the same form."""
    root = Node("", "")
    nodes = {"": root}
    for path in shape:
        up, _, name = path.rpartition("/")
        nodes[path] = node = Node(name.partition("[")[0], path)
        nodes[up].children.append(node)
    for node in reversed(nodes.values()):  # a node comes after its parent
        node.size += sum(x.size for x in node.children)
        node.like = hashlib.blake2b(node.label.encode() + b"\0" + b"".join(x.like for x in node.children), digest_size=16).digest()
    return root


def _ends(a: Node, b: Node) -> tuple[int, int]:
    """How many children at the start and at the end are of the same form.
    Some largest match has these in pairs."""
    x, y = a.children, b.children
    n = min(len(x), len(y))
    lo = next((i for i in range(n) if x[i].like != y[i].like), n)
    hi = next((i for i in range(n - lo) if x[-1 - i].like != y[-1 - i].like), n - lo)
    return lo, hi


def _weights(x: list[Node], y: list[Node], known: dict) -> tuple[np.ndarray, list[int], np.ndarray]:
    """The sizes of the largest matches of the forms in ``x`` with those in
    ``y``, and the numbers of the forms of each."""
    kinds_x, kinds_y = {n.like: n for n in x}, {n.like: n for n in y}
    at_x, at_y = {k: i for i, k in enumerate(kinds_x)}, {k: i for i, k in enumerate(kinds_y)}
    w = np.array([[_largest(p, q, known) for q in kinds_y.values()] for p in kinds_x.values()], np.int64)
    return w, [at_x[n.like] for n in x], np.array([at_y[n.like] for n in y], np.int64)


def _rows(weights: np.ndarray, x: list[int], y: np.ndarray) -> Iterator[np.ndarray]:
    """The rows of the table of largest order-preserving matches."""
    row = np.zeros(len(y) + 1, np.int64)
    yield row
    for i in x:
        row = np.maximum.accumulate(np.concatenate([row[:1], np.maximum(row[1:], row[:-1] + weights[i][y])]))
        yield row


def _last(rows: Iterator[np.ndarray]) -> np.ndarray:
    for row in rows:
        pass
    return row


def _paired(weights: np.ndarray, x: list[int], y: np.ndarray) -> list[tuple[int, int]]:
    """The pairs of a largest order-preserving match."""
    if not x or not len(y):
        return []
    if len(x) > 1 and len(x) * len(y) > CELLS:
        half = len(x) // 2
        k = int(np.argmax(_last(_rows(weights, x[:half], y)) + _last(_rows(weights, x[:half - 1:-1], y[::-1]))[::-1]))
        return _paired(weights, x[:half], y[:k]) + [(i + half, j + k) for i, j in _paired(weights, x[half:], y[k:])]
    best = list(_rows(weights, x, y))
    pairs = []
    i, j = len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def _largest(a: Node, b: Node, known: dict) -> int:
    if a.label != b.label:
        return 0
    if a.like == b.like:
        return a.size
    if (a.like, b.like) not in known:
        lo, hi = _ends(a, b)
        x, y = a.children[lo:len(a.children) - hi], b.children[lo:len(b.children) - hi]
        ends = sum(n.size for n in a.children) - sum(n.size for n in x)
        known[a.like, b.like] = 1 + ends + (int(_last(_rows(*_weights(x, y, known)))[-1]) if x and y else 0)
    return known[a.like, b.like]


def match(a: Node, b: Node, known: dict | None = None) -> tuple[int, list[tuple[str, str]]]:
    """Simple tree matching: the largest order-preserving match of two trees
    whose roots have the same label, and the pairs of node ids in it."""
    if a.label != b.label:
        return 0, []
    known = {} if known is None else known
    lo, hi = _ends(a, b)
    n, m = len(a.children), len(b.children)
    x, y = a.children[lo:n - hi], b.children[lo:m - hi]
    below = [(i, i) for i in range(lo)] + [(n - i, m - i) for i in range(hi, 0, -1)]
    if x and y:
        below += [(i + lo, j + lo) for i, j in _paired(*_weights(x, y, known))]
    pairs = [(a.path, b.path)]
    for i, j in sorted(below):
        pairs += match(a.children[i], b.children[j], known)[1]
    return len(pairs), pairs


def aligned(shape: list[str], reference: Node, there: set[str]) -> dict[str, tuple[str, str]]:
    """For each node of a page: its id in the reference, whose ids are
    ``there``, and the id that says which pages have the node.

    That is its own if the reference has no sibling of the same tag.  Of
    several, as the paragraphs of an article, a page may have fewer, so there
    it is the parent's, as it is of a node without a partner, which is named
    by its parent's id and its tag."""
    pairs = dict(match(tree(shape), reference)[1])
    out = {"": ("", "")}
    for path in shape:
        up, _, name = path.rpartition("/")
        own = pairs.get(path)
        if own is None:
            out[path] = (f"{out[up][0]}/+{name.partition('[')[0]}", out[up][0])
        else:
            single = own.endswith("[1]") and own[:-3] + "[2]" not in there
            out[path] = (own, own if single else own.rpartition("/")[0])
    return out


def _form(shape: list[str]) -> int:
    """A number for the set of nested tags of a page."""
    text = "\n".join(sorted({re.sub(r"\[[0-9]+\]", "", x) for x in shape}))
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def _parsed(pages: DataFrame) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = pa.list_(pa.string())
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                got = [parse(x or "") for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(["\n".join(s) for s, _, _ in got], pa.string()),
                     pa.array([_form(s) for s, _, _ in got], pa.int64()), pa.array([len(s) for s, _, _ in got], pa.int64()),
                     pa.array([[p for p, _ in b] for _, b, _ in got], text), pa.array([[t for _, t in b] for _, b, _ in got], text),
                     pa.array([place > 0 for *_, place in got], pa.bool_())],
                    names=["page_id", "url", "shape", "form", "size", "paths", "texts", "inside"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(task, f"page_id {kind}, url string, shape string, form long, size long, paths array<string>, texts array<string>, inside boolean")


def _aligned(parsed: DataFrame) -> DataFrame:
    """(page_id, url, host, page, texts, inside, nodes, owners): for each text of a
    page its node's two ids of :func:`aligned`."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = pa.list_(pa.string())
        trees: dict[str, tuple[Node, set[str]]] = {}
        known: dict[tuple[str, str], dict[str, tuple[str, str]]] = {}
        n_known = 0
        for batch in batches:
            nodes, owners = [], []
            for shape, reference, paths in zip(*(batch.column(i).to_pylist() for i in (6, 7, 8))):
                if (shape, reference) not in known:
                    if n_known > KNOWN:
                        trees, known, n_known = {}, {}, 0
                    if reference not in trees:
                        ids_there = reference.split("\n") if reference else []
                        trees[reference] = tree(ids_there), set(ids_there)
                        n_known += len(ids_there)
                    ids_here = shape.split("\n") if shape else []
                    known[shape, reference] = aligned(ids_here, *trees[reference])
                    n_known += len(ids_here)
                to = known[shape, reference]
                nodes.append([to[p][0] for p in paths])
                owners.append([to[p][1] for p in paths])
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(nodes, ids), pa.array(owners, ids)],
                                             names=["page_id", "url", "host", "page", "texts", "inside", "nodes", "owners"])

    forms = parsed.groupBy("host", "form").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("size", "shape")).alias("largest"))
    reference = cut(forms.groupBy(F.col("host").alias("h")).agg(F.max(F.struct("n", "largest")).alias("most"))
                    .select("h", F.col("most.largest.shape").alias("reference")))
    both = parsed.join(small_or_shuffled(reference, 4000), F.col("host") == F.col("h")).select(
        "page_id", "url", "host", "page", "texts", "inside", "shape", "reference", "paths")
    kind = parsed.schema["page_id"].dataType.simpleString()
    return both.mapInArrow(task, f"page_id {kind}, url string, host string, page long, texts array<string>, inside boolean, nodes array<string>, owners array<string>")


def extract(pages: DataFrame, share: float = SHARE, min_pages: int = MIN_PAGES, articles: int = ARTICLES) -> DataFrame:
    """Per row of ``pages``: page_id, url and text, the main text.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by a line feed.  The main text is that of the
    articles of a page, without one of its main element, without either of
    the body; comments, menus, headers, footers, sidebars, notices, adverts,
    forms, scripts and styles are left out.  Null, empty and unparsable html
    give an empty text; repeated rows are repeated; a null url is a host of
    its own, which is empty.  Copies of a page count once when the template
    of a host is found, in articles and main elements also pages that share
    their longest text.  Very long pages are parsed in time proportional to
    their length; nothing is cut.  An empty table gives an empty result.
    """
    host = F.translate(F.coalesce(F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())
    longest = F.array_max(F.transform("texts", lambda t: F.struct(F.length(t).alias("n"), F.xxhash64(t).alias("h"))))["h"]
    parsed = cut(_parsed(columns_of(pages, "page_id", "url", "html"))
                 .withColumns({"host": host, "page": F.when(F.col("inside"), longest).otherwise(F.xxhash64("texts"))}))
    found = _aligned(parsed)
    least = F.when(F.col("inside"), articles).otherwise(min_pages)
    blocks = F.zip_with("nodes", "owners", lambda n, o: F.struct(F.xxhash64(n).alias("node"), F.xxhash64(o).alias("owner")))
    slots = cut(found.select("host", "inside", "page", F.explode(F.array_distinct(F.zip_with(blocks, "texts", lambda b, t: F.struct(
        b["node"].alias("node"), b["owner"].alias("owner"), F.xxhash64(t).alias("said"))))).alias("b"))
        .select("host", "inside", "page", "b.*").distinct())
    # a page has the nodes of its texts and those that own them
    has = slots.select("host", "inside", "page", F.explode(F.array_distinct(F.array("node", "owner"))).alias("owner"))
    pages_of = has.distinct().groupBy("host", "inside", "owner").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least)
    spread = slots.groupBy("host", "inside", "node", "owner", "said").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    constant = cut(spread.join(pages_of, ["host", "inside", "owner"]).where(F.col("n") >= share * F.col("pages")).groupBy("host", "inside")
                   .agg(F.collect_set(F.xxhash64("said", "node")).alias("template")))
    templates = small_or_shuffled(constant.select(F.col("host").alias("t"), F.col("inside").alias("__inside"), "template"), 4000)
    judged = found.join(templates, (F.col("host") == F.col("t")) & (F.col("inside") == F.col("__inside")), "left")
    kept = F.filter(F.zip_with("nodes", "texts", lambda n, t: F.struct(
        t.alias("text"), F.xxhash64(F.xxhash64(t), F.xxhash64(n)).alias("slot"))),
        lambda b: ~F.coalesce(F.array_contains("template", b["slot"]), F.lit(False)))
    return judged.select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text"))
