"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: a node is the path of element names (with their classes and ids) from the
root, its presentations are the sequences of child elements it is seen with, and its contents are the texts it holds.
Nodes whose presentations and contents hardly vary over a host's pages are its template. Importance is entropy: of the
presentations for an element with block children, of the contents for a leaf, weighed together from the leaves upwards. A
branch is template when it and all below it have low importance beside the host's weightiest texts, and so is a text that stands
at its place on many of the host's pages; template goes, next to parts that say by their name that they are not the article.
As a host is measured by itself, nothing depends on a least number of pages.

Counts per host and node are grouped by Spark with partial sums, so that a host of any number of pages is only ever a few
hundred counters a task; the importances of a host come back to its pages as one small map.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import compact, joined, written

#: How much less a node's own presentation counts with each child (the share of the children is DECAY ** children).
DECAY = 0.9
#: A branch is template where its importance is further below 1 than so many times that of the host's weightiest texts, and a
#: floor. What lies beside important texts in one element is kept.
TIMES, FLOOR = 3.0, 0.015
#: What a place on two pages shows is chance; this much over the square of its pages is added to its importance.
DOUBT = 1.2
#: A text is template at its place if it stands there on all but a few pages: this is log(its pages) / log(all pages).
USUAL = 0.7
#: Inside an article the bar is lower, and only where the article itself varies.
INSIDE, VARIES = 0.1, 0.5
#: Levels of a path that have nodes of their own; deeper elements count to the node above.
MAX_DEPTH = 24

# HTML's element kinds, and names of parts that are not the article.
RAW = frozenset("script style textarea title xmp noscript iframe template svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split())
BOILERPLATE = frozenset(
    "head nav header footer aside form button select option input label menu dialog script style noscript template iframe "
    "svg math textarea object embed canvas audio video fieldset search".split())
ARTICLE = frozenset("article main".split())
OWN = frozenset("article post entry story".split())
PART_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion sidebar side-bar widget nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup social share sharing related recommended comment comments "
    "comment-list commentlist respond reply replies disqus toolbar pagination pager skip-link copyright".split())
#: In a compound name these say that the element holds such parts, or lacks them.
HOLDERS = frozenset("with has no without layout wrapper container".split())
PART_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu menubar toolbar note".split())
#: Elements that end an open element of the same row of a list, table or paragraph.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = frozenset("ul ol dl table select body article section div main aside nav header footer form html".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_OPENED = re.compile(r"<[A-Za-z/!?]")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_SPACES = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Node:
    """An element of a page. ``path`` names its place in the style tree."""

    tag: str
    path: str
    parent: Node | None
    boilerplate: bool
    children: list[str] = field(default_factory=list)
    article: Node | None = None
    depth: int = 0


@dataclass
class Block:
    """A run of text without a block boundary."""

    node: Node
    text: str


def _named_boilerplate(tag: str, named: dict[str, str], in_article: bool) -> bool:
    """Does a class, an id or a role say that this is not the article? A compound name counts by its first and last word,
    unless it names a holder of such parts; an article's own header is part of it."""
    if tag in ("html", "body", "article", "main"):
        return False
    if named.get("role", "").strip().lower() in PART_ROLES:
        return True
    for value in (named.get("class", ""), named.get("id", "")):
        for name in value.lower().replace("_", "-").split():
            words = name.split("-")
            if "header" in words and (in_article or OWN & set(words)) or HOLDERS & set(words):
                continue
            if name in PART_NAMES or words[0] in PART_NAMES or words[-1] in PART_NAMES:
                return True
    return False


def _clean(text: str) -> str:
    if "&" in text:
        text = entities.unescape(text)
    return _SPACES.sub(" ", text).strip()


def blocks_of(page: str) -> tuple[list[Block], list[Node]]:
    """The text blocks of a page in its order, and its elements. Anything is accepted: unclosed elements end with the one
    around them, stray end tags are skipped, ``<`` that opens no tag is text."""
    root = Node("", "", None, False)
    at, nodes, blocks, run, open_ = root, [root], [], [], Counter()

    def put(text: str) -> None:
        if not at.boilerplate:  # a part inside a paragraph leaves the paragraph whole
            run.append(text)

    def leave(node: Node) -> None:
        nonlocal at
        while at is not node:
            open_[at.tag] -= 1
            at = at.parent

    def flush() -> None:
        if run:
            text = _clean("".join(run))
            if text:
                blocks.append(Block(at, text))
            run.clear()

    last = 0
    for m in _TAG.finditer(page):
        if m.start() < last:
            continue
        if m.start() > last:
            put(page[last: m.start()])
        last = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_[tag]:
                node = at
                while node.tag != tag:
                    node = node.parent
                if tag in BLOCK or any(n.tag in BLOCK for n in _between(at, node)):
                    flush()
                leave(node.parent)
            continue
        if tag == "br" or tag == "wbr":
            put(" " if tag == "br" else "")
            continue
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, last)
            last = end.end() if end else len(page)
            continue
        if tag in BLOCK:
            node = at  # an open paragraph ends where a block begins
            while node is not root and node.tag not in SCOPES:
                above = node.parent
                if node.tag == "p" or node.tag in CLOSES.get(tag, ()):
                    leave(above)
                node = above
        named = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTRIBUTE.findall(m[3])} if "=" in m[3] else {}
        kind = tag + "".join(f"{mark}{_DIGITS.sub('0', named[n])}" for n, mark in (("class", "."), ("id", "#")) if n in named)
        deep = at.depth >= MAX_DEPTH
        in_article = at.article is not None
        apart = tag in BOILERPLATE and not (tag == "header" and in_article) or _named_boilerplate(tag, named, in_article)
        node = Node(tag, at.path if deep else f"{at.path}>{kind}", at, at.boilerplate or apart, depth=at.depth + 1)
        node.article = node if tag in ARTICLE and at.article is None else at.article
        if tag in BLOCK:
            at.children.append(kind)
            nodes.append(node)
        open_[tag] += 1
        at = node
    rest = page[last:]
    unfinished = _OPENED.search(rest, rest.rfind(">") + 1)  # a tag that the page ends in is no text
    put(rest[: unfinished.start()] if unfinished else rest)
    flush()
    return blocks, nodes


def _between(low: Node, high: Node):
    while low is not high:
        yield low
        low = low.parent


def host_of(url: Column) -> Column:
    """The lower-case host of an address, without a port; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


_COUNTS = "host bigint, path bigint, parent bigint, what int, value bigint, children bigint, n bigint"


#: The key of a host's bar among its importances: no path has it, as paths are empty or begin with ``>``.
_BAR = 0


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) - (1 << 63)


def observed(pages: DataFrame) -> DataFrame:
    """Counted over pages: ``host``, ``path`` and its ``parent``, and what was seen there (0: a presentation, with its
    number of ``children``; 1: a text, with its length), all as 64-bit hashes, and on how many pages."""
    schema = pa.schema([(c.split()[0], pa.int32() if c.split()[1] == "int" else pa.int64()) for c in _COUNTS.split(", ")])

    def count(batches):
        for batch in batches:
            seen: Counter = Counter()
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                blocks, nodes = blocks_of(page.as_py() or "")
                mine = {(_hash(n.path), _hash(n.parent.path if n.parent else ""), 0, _hash("|".join(n.children)), len(n.children))
                        for n in nodes}
                mine |= {(_hash(b.node.path), _hash(b.node.parent.path if b.node.parent else ""), 1, _hash(b.text), len(b.text))
                         for b in blocks}
                seen.update((host, *m) for m in mine)
            rows = [(*k, n) for k, n in seen.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, schema.types)], schema=schema)

    keys = ["host", "path", "parent", "what", "value", "children"]
    return pages.select(F.xxhash64("host").alias("host"), "html").mapInArrow(count, _COUNTS).groupBy(*keys).agg(
        F.sum("n").alias("n"))


def importance(pages: DataFrame) -> DataFrame:
    """``host`` (hashed), ``important``: the importance of each of its nodes by path, and of its common texts by path and text.

    A leaf's is 1 minus the mean entropy of its texts (a text on every page has entropy 1, one on a single page 0); an
    element's is ``(1 - DECAY ** children)`` of the entropy of its presentations and the rest of its children's mean, with the
    mean number of its block children. Every branch has the largest importance in it. Repeated pages count as often as they
    come; an empty table has no hosts.
    """
    seen = written(compact(observed(pages), pages.count()), "observed")
    pages_of = F.max(F.when(F.col("path") == _hash(""), F.col("of_path"))).alias("pages")
    of_path = seen.where("what = 0").groupBy("host", "path", "parent").agg(
        F.sum("n").alias("of_path"), (F.sum(F.col("n") * F.col("children")) / F.sum("n")).alias("children"),
        F.sum(-F.col("n") * F.log("n")).alias("s"))
    sizes = of_path.groupBy("host").agg(pages_of)

    # Entropy to the base of the node's pages: log(total) - sum(n log n) / total, over log(total).
    shape = of_path.join(sizes, "host").withColumn("presentation", F.when(
        F.col("of_path") > 1, (F.log("of_path") + F.col("s") / F.col("of_path")) / F.log("of_path")).otherwise(1.0))
    texts = seen.where("what = 1").groupBy("host", "path").agg(
        F.sum(F.log("n")).alias("logs"), F.count(F.lit(1)).alias("texts"), F.sum("children").alias("weight"))
    nodes = shape.join(texts, ["host", "path"], "left").select(
        "host", "path", "parent", "children", "presentation", "weight", "of_path",
        F.when(F.col("texts").isNotNull() & (F.col("of_path") > 1), F.least(F.lit(1.0), F.greatest(
            F.lit(0.0), 1 - F.col("logs") / F.col("texts") / F.log("pages")) + DOUBT / F.col("of_path") / F.col("of_path"))).alias("content"))
    # A node on one page, and so all below it, has importance 1: those of a parent are one number.
    once = nodes.where("of_path = 1 AND path <> parent").groupBy("host", F.col("parent").alias("path")).agg(
        F.count(F.lit(1)).alias("once"))
    node = F.struct("path", "parent", "children", "presentation", "content", "weight", F.coalesce("once", F.lit(0)).alias("once"))
    nodes = nodes.where(f"of_path > 1 OR path = {_hash('')}L").join(once, ["host", "path"], "left").groupBy("host").agg(
        F.collect_list(node).alias("tree"))
    # Others are no template, so that they need no entry. Each stands on pages ** USUAL pages: a host has at most
    # pages ** (1 - USUAL) times the texts of a mean page.
    worth = 1 - F.log("n") / F.log("pages")
    alike = seen.where("what = 1 AND n > 1").join(sizes, "host").where(worth < max(1 - USUAL, INSIDE)).select(
        "host", F.struct(F.col("path").bitwiseXOR(F.col("value")).alias("key"), worth.alias("worth")).alias("text"))
    alike = alike.groupBy("host").agg(F.collect_list("text").alias("texts"))
    out = pa.map_(pa.int64(), pa.float64())

    @F.arrow_udf("map<bigint, double>")
    def composite(trees: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([list(({t["key"]: t["worth"] for t in x or ()} | _composite(t)).items())
                         for t, x in zip(trees.to_pylist(), texts.to_pylist())], out)

    return nodes.join(alike, "host", "left").select("host", composite("tree", "texts").alias("important"))


def _composite(tree: list[dict]) -> dict[int, float]:
    """The largest importance in each branch, and the host's bar. ``once``: how many of a node's children stand on one page, whose
    importance is 1; a style tree has the others only. Branches that can't be template, whatever stands beside them, have no entry."""
    below: dict[int, list[dict]] = {}
    for node in tree:
        if node["path"] != node["parent"]:
            below.setdefault(node["parent"], []).append(node)
    done: dict[int, float] = {}
    largest: dict[int, float] = {}
    stack = [(n, False) for n in tree]
    while stack:
        node, ready = stack.pop()
        if node["path"] in done:
            continue
        children = below.get(node["path"], [])
        if not ready:
            stack.append((node, True))
            stack += [(c, False) for c in children if c["path"] not in done]
            continue
        known = [done[c["path"]] for c in children if c["path"] in done]
        if node["content"] is not None:
            known.append(node["content"])
        known += [1.0] * bool(node["once"])
        share = DECAY ** node["children"]
        more = max(0, node["once"] - 1)
        mean = (sum(known) + more) / (len(known) + more) if known else node["presentation"]
        done[node["path"]] = (1 - share) * node["presentation"] + share * mean
        # Importance may lie below: an element whose presentation hardly varies is kept for its leaves.
        own = done[node["path"]] if not known else max(known)
        largest[node["path"]] = max([own, *(largest[c["path"]] for c in children if c["path"] in largest)])
    heaviest = max((n for n in tree if n["content"] is not None), key=lambda n: (n["weight"], n["path"]), default=None)
    bar = {} if heaviest is None else {_BAR: 1 - FLOOR - TIMES * (1 - heaviest["content"])}
    return {path: v for path, v in largest.items() if v < bar.get(_BAR, -1.0) or v <= VARIES} | bar


def main_text(page: str, important: dict[int, float] | None) -> str:
    """The article's blocks, joined by an empty line."""
    blocks, nodes = blocks_of(page)
    inside = any(n.article is not None and not n.boilerplate for n in nodes)
    known = important or {}

    def template(block: Block) -> bool:
        node, article = block.node, block.node.article
        path = _hash(node.path)
        branch, text = known.get(path, 1.0), known.get(path ^ _hash(block.text), 1.0)
        if article is not None:
            return known.get(_hash(article.path), 1.0) > VARIES and min(branch, text) < INSIDE
        if node.parent is not None and node.parent.tag not in ("", "html", "body"):
            branch = max(branch, known.get(_hash(node.parent.path), 1.0))
        bar = known.get(_BAR, -1.0)
        return branch < bar or text < 1 - USUAL and bar > 0  # where all pages are alike nothing is template

    kept = [b.text for b in blocks if not b.node.boilerplate and (not inside or b.node.article is not None) and not (known and template(b))]
    return "\n\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every row of ``pages``.

    Null and empty pages have an empty text; null addresses and those without a host are pages of one nameless host; null
    and repeated ids and repeated rows stay rows; other columns aren't read; an empty table gives an empty result.
    """
    lean = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    trees = written(compact(importance(lean.select("host", "html")), 0), "importance")
    measured = trees.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("important")), F.lit(0)).alias("most")).first()
    rows = joined(lean.withColumn("host", F.xxhash64("host")), trees, "host", "left", measured["n"], 24 * measured["most"] + 64)

    @F.arrow_udf("string")
    def text_of(page: pa.Array, important: pa.Array) -> pa.Array:
        held, last, known = [], None, None
        for p, tree in zip(page, important):
            if not tree.is_valid:
                known = None
            elif last is None or not tree.equals(last):  # the pages of a host share one map
                last, known = tree, dict(tree.as_py())
            else:
                known = dict(last.as_py()) if known is None else known
            held.append(main_text(p.as_py() or "", known))
        return pa.array(held, pa.string())

    done = rows.select("page_id", "url", text_of("html", "important").alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("bigint"))
