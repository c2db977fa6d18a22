"""Main text of web pages by site style trees.

The pages of a host are merged into one tree (Yi, Liu and Li 2003).  An element
node is a path of elements with their classes; its style nodes are the ordered
labels of the children that a page shows there, inline elements left out.  Equal
labels meet in one node whatever the style around them, so a note after any
number of paragraphs is one.  From the leaves up, a node's importance mixes the
entropy of its styles with the importance of what they hold: of a child its own,
of a text its content's, where one that many pages repeat is worth little and one
of a single page 1.  A branch is noise if its element and all elements below are
of low importance.  Of such a branch go the contents that pages repeat, from
every page of the host; a content of one page stays.  Pages with the same main
text are copies and count as one.

Entropy alone can't tell an advert that changes with every page from an
article, so a page's own structure is read too: the role of elements (menus,
footers, forms, named areas) removes branches, and an article or main area,
where a page has one, bounds the text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import BODY, OTHER, TEXT, Page, hashed
from .staging import staged

_BLOCK = pa.list_(pa.struct([("content", pa.int64()), ("text", pa.string())]))
_NODE = pa.list_(
    pa.struct(
        [("path", pa.int64()), ("parent", pa.int64()), ("level", pa.int32()), ("style", pa.int64()),
         ("share", pa.float64()), ("held", pa.float64()), ("contents", pa.list_(pa.int64()))]
    )
)
_KINDS = (
    "key string, page_id long, url string, page long, blocks array<struct<content:long,text:string>>, "
    "nodes array<struct<path:long,parent:long,level:int,style:long,share:double,held:double,contents:array<long>>>"
)


#: Contents of low importance that are still sent to every task: some megabytes.
SMALL_LIST = 20_000


def element_nodes(page: Page) -> dict[int, dict]:
    """The page's element nodes by path.

    style: a hash of the different sequences of child labels that the page
    shows there, null if nothing but texts.  Of what its elements hold, ``held``
    is the share of texts, and ``share`` this node's share of its parent's.
    """
    groups: dict[int, list] = {}
    for e in page.elements:
        groups.setdefault(e.path, []).append(e)
    filled = {path: sum(bool(e.children) for e in some) for path, some in groups.items()}
    nodes = {}
    for path, some in groups.items():
        up = some[0].up
        shown = dict.fromkeys(",".join(e.children) for e in some)
        held = sum(e.children.count(TEXT) / len(e.children) for e in some if e.children)
        nodes[path] = {
            "path": path, "parent": up and up.path, "level": some[0].level,
            "style": hashed(";".join(shown)) if shown.keys() - {TEXT, ""} else None,
            "share": sum(1 / len(e.up.children) for e in some) / filled[up.path] if up else 1.0,
            "held": held / max(filled[path], 1), "contents": set(),
        }
    return nodes


def read_page(html: str | None) -> tuple[list[dict], list[dict], int]:
    """Blocks that may be main text, the page's part of the style tree, and a hash of the blocks, which copies share."""
    page = Page(html or "")
    blocks, nodes = [], element_nodes(page)
    for (path, text, *_), state in zip(page.blocks, page.states()):
        content = hashed(f"{path}\n{text}")
        nodes[path]["contents"].add(content)
        if state in (BODY, OTHER):
            blocks.append({"content": content, "text": text})
    own = hashed(" ".join(str(b["content"]) for b in blocks))
    return blocks, [{**n, "contents": sorted(n["contents"])} for n in nodes.values()], own


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            pages = [read_page(h) for h in part.column(2).to_pylist()]
            keys = pa.array([uuid.uuid4().hex for _ in pages], pa.string())
            blocks, nodes, own = ([p[i] for p in pages] for i in range(3))
            arrays = [keys, part.column(0), part.column(1), pa.array(own, pa.int64()), pa.array(blocks, _BLOCK), pa.array(nodes, _NODE)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "page_id", "url", "page", "blocks", "nodes"])


def _content_counts(nodes: DataFrame) -> DataFrame:
    """Pages of each (host, path, content); rows with the same ``page``, if there is one, count once."""
    by = ["host", "path"]
    contents = nodes.select(*by, *(["page"] if "page" in nodes.columns else []), F.explode("contents").alias("content"))
    if "page" in nodes.columns:
        contents = contents.distinct()
    return contents.groupBy(*by, "content").agg(F.count("*").alias("n"))


def style_tree(nodes: DataFrame, gamma: float = 0.9) -> DataFrame:
    """(host, path, pages, importance, highest) from rows (host, path, style, contents), one for each page and element node.

    With m pages at a node: presentation is the entropy of its l styles to the
    base m; a content that n of the pages have is worth 1 - log n / log m; the
    importance is (1 - gamma**l) * presentation + gamma**l * inner, inner being
    the mean over what the styles hold: children by their own importance, texts
    by that of the node's contents.  A node that only one page has is worth 1.
    Where all styles are null the node holds nothing but text and l is 0.

    Columns parent, level (of the root 0), share (this node's part of what its
    parent holds) and held (the part of texts in what the node holds) make it
    a tree; without them every node holds texts alone.  highest: the largest
    importance of the node and all below it.  With a column page, rows of the
    same page count once.
    """
    by, own = ["host", "path"], {"parent": "cast(null as long)", "level": "0", "style": "cast(null as long)", "share": "1D", "held": "1D"}
    rows = nodes.select(*by, *(c for c in ["page"] if c in nodes.columns), *(c if c in nodes.columns else F.expr(v).alias(c) for c, v in own.items()))
    if "page" in nodes.columns:
        rows = rows.groupBy(*by, "page", "parent", "level").agg(*(F.min(c).alias(c) for c in ("style", "share", "held")))
    sums = [F.sum(c).alias(c) for c in ("share", "held")]
    styles = rows.groupBy(*by, "parent", "level", "style").agg(F.count("*").alias("n"), *sums)
    tree = styles.groupBy(*by, "parent", "level").agg(
        F.sum("n").alias("pages"), F.when(F.count("style") > 0, F.count("*")).otherwise(0).alias("styles"), F.sum(F.expr("n * ln(n)")).alias("spread"), *sums
    )
    contents = _content_counts(nodes).groupBy(*by).agg(F.sum("n").alias("shown"), F.sum(F.expr("n * ln(n)")).alias("common"))
    weight = F.pow(F.lit(gamma), "styles")
    tree = tree.join(contents, by, "left").select(
        *by, "parent", "level", "pages", "share", "held", weight.alias("weight"),
        F.expr("1 - spread / (pages * ln(greatest(pages, 2)))").alias("presentation"),
        F.expr("coalesce(1 - common / (shown * ln(greatest(pages, 2))), 0)").alias("content"),
    )
    return _from_the_leaves(tree if "level" not in nodes.columns else staged(tree, "tree"), "level" in nodes.columns)


def _from_the_leaves(tree: DataFrame, deep: bool) -> DataFrame:
    """The importance of every node, level by level; what lies below a node of one page doesn't matter."""
    # no node with more than one page lies deeper, so those of one page just below are the deepest that matter
    deepest = (tree.where("pages > 1").agg(F.max("level")).first()[0] or 0) + 1 if deep else 0
    levels: list[DataFrame] = []
    for level in range(deepest, -1, -1):
        at = tree.where(F.col("level") == level)
        if levels:
            held = levels[-1].groupBy("host", F.col("parent").alias("path")).agg(
                F.sum("share").alias("parts"), F.sum(F.expr("share * importance")).alias("worth"), F.max("highest").alias("below")
            )
            at = at.join(held, ["host", "path"], "left")
        else:
            at = at.selectExpr("*", "0D as parts", "0D as worth", "0D as below")
        inner = F.expr("(held * content + coalesce(worth, 0)) / greatest(held + coalesce(parts, 0), 1e-9)")
        mixed = F.expr("1 - weight") * F.col("presentation") + F.col("weight") * inner
        at = at.withColumn("importance", F.when(F.col("pages") > 1, mixed).otherwise(1.0))
        at = at.select("host", "path", "parent", "share", "pages", "importance", F.greatest("importance", "below").alias("highest"))
        levels.append(staged(at, "level") if deep else at)
    out = levels[0]
    for at in levels[1:]:
        out = out.union(at)
    return out.select("host", "path", "pages", "importance", "highest")


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_pages: int = 20,
    threshold: float = 0.2,
) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``: the main text of its html.

    Blocks are joined in page order by a line break; white space inside a block
    is one space, character references are decoded.  Of nodes of the host's style
    tree that at least ``least_pages`` different pages share and whose importance
    is below ``threshold``, as is that of all nodes below them, the contents that
    are worth less than that themselves are removed.  Pages whose blocks are all equal are one page there.  Null, empty and textless pages give an
    empty text; pages without a host form one site.  Ids and urls may be null
    or repeat; every row comes back.  Other columns are ignored.
    """
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    parsed = staged(source.mapInArrow(_parsed, _KINDS), "parsed")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))
    parsed = parsed.withColumn("host", host)
    nodes = parsed.select("host", "page", F.explode("nodes").alias("node")).select("host", "page", "node.*")
    tree = style_tree(nodes).where((F.col("pages") >= least_pages) & (F.col("highest") < threshold))
    # a content of fewer pages can't be low; left out, one large node's contents don't meet in one task
    often = _content_counts(nodes).where(F.col("n") >= int(least_pages ** (1 - threshold)))
    low = often.join(tree, ["host", "path"]).where(1 - F.ln("n") / F.ln("pages") < threshold)
    low = staged(low.select("host", "content"), "low")
    pages_ = parsed.select("key", "page_id", "url", "host", "blocks")
    if low.count() <= SMALL_LIST:  # a list of checked size goes to the pages, a longer one meets them by key
        by_host = low.groupBy("host").agg(F.collect_set("content").alias("low"))
        marked = pages_.join(F.broadcast(by_host), "host", "left")
    else:
        shown = pages_.select("key", "host", F.explode("blocks.content").alias("content"))
        hit = shown.join(low, ["host", "content"]).groupBy("key").agg(F.collect_set("content").alias("low"))
        marked = pages_.join(hit, "key", "left")
    kept = F.expr("filter(blocks, b -> low is null or not array_contains(low, b.content))")
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return marked.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
