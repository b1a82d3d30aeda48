"""Main text of web pages by site style trees.

The pages of a host are merged into one tree of styles: block elements by the path of their tags and classes. A style
whose pages all say the same, or that only ever holds few different things, is furniture of the site; its importance
comes from the entropy of its presentation (which child styles it has) and of its content (how a block's text spreads
over the pages). Branches of low importance are cut out of every page; what remains of the article is its text. Trees are
sums of rows (host, style, what was seen), so no host is ever gathered in one place.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.llm.frames import only, plain, slices, with_text_columns

#: Weight of a node's content against its presentation, importance below which a branch goes, pages that make a style known.
GAMMA = 0.9
LEAST_IMPORTANCE = 0.2
LEAST_PAGES = 10
#: Tasks that the pages of one host are spread over.
LANES = 64

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style template noscript textarea title iframe object svg math canvas audio video".split())
CLOSED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option"]),
}
#: What an automatic end of p, li … does not reach beyond.
SCOPE = frozenset("article aside body div footer header main nav section table td th ul ol dl form html".split())

#: Elements that never belong to an article, and words in class, id or role that say the same of any element.
FURNITURE = frozenset("nav header footer aside form button select dialog menu head".split())
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "sidebar footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup "
    "comment comments commentlist disqus reply replies respond share sharing social related recommended widget toolbar pagination pager search login complementary contentinfo".split()
)
KEPT = frozenset("html body main article".split())
#: A name that begins so tells what stands beside a box or not in it (with-sidebar, no-comments), not what the box is.
BESIDE = frozenset("no non not with without has have".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: How sure it is that an element is furniture: not at all, by its names, by its tag.
BY_NAME, BY_TAG = 1, 2

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>|</([a-zA-Z][^\s/>]*+)[^>]*+>|<[!?][^>]*+>",
    re.S,
)
NAME = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Za-z]+|\d+")


class Node:
    __slots__ = ("tag", "style", "kids", "text", "furniture")

    def __init__(self, tag: str, style: str, furniture: int):
        self.tag, self.style, self.furniture = tag, style, furniture
        #: Blocks in page order: text or Node.
        self.kids: list = []
        self.text: list[str] = []

    def end_block(self) -> None:
        """What was said so far is a block."""
        if self.text:
            block = " ".join(entities.unescape("".join(self.text)).split())
            self.text = []
            if block:
                self.kids.append(block)


def parse(page: str) -> Node:
    """The block elements of a page; inline elements belong to the text of the block they stand in."""
    root = Node("html", "", 0)
    stack = [root]
    at, n = 0, len(page)

    def close(tag: str, scope: frozenset | None) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                while len(stack) > k:
                    stack.pop().end_block()
                return
            if scope and stack[k].tag in scope:
                return

    while at < n:
        found = TOKEN.search(page, at)
        if found is None:
            stack[-1].text.append(page[at:])
            break
        if found.start() > at:
            stack[-1].text.append(page[at : found.start()])
        at = found.end()
        opening, attributes, closing = found[1], found[2], found[3]
        if opening:
            tag = opening.lower()
            if tag in RAW:
                # an element whose content is no article text; it ends at its end tag only
                if not attributes.rstrip().endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
                    at = end.end() if end else n
                continue
            if tag in INLINE:
                continue
            for open_tag, enders in CLOSED_BY.items():
                if tag in enders:
                    close(open_tag, SCOPE - {open_tag})
            if tag in VOID:
                if tag in ("br", "hr"):
                    stack[-1].text.append("\n")
                continue
            stack[-1].end_block()
            names, named = [], False
            for m in NAME.finditer(attributes) if attributes.strip() else ():
                for word in (m[2] or m[3] or m[4] or "").lower().split():
                    parts = [x for x in PART.findall(word) if not x.isdigit()]
                    names += parts
                    named = named or bool(NAMED.intersection(parts)) and parts[0] not in BESIDE
            furniture = BY_TAG if tag in FURNITURE else BY_NAME if named and tag not in KEPT else 0
            node = Node(tag, f"{stack[-1].style}/{tag}" + "".join(f".{x}" for x in names), furniture)
            stack[-1].kids.append(node)
            stack.append(node)
        elif closing:
            tag = closing.lower()
            if tag not in INLINE and tag not in VOID:
                close(tag, SCOPE - {tag} if tag in CLOSED_BY else None)
    while stack:
        stack.pop().end_block()
    return root


def value(text: str) -> int:
    """64 bits of a text, signed."""
    from xxhash import xxh64_intdigest

    x = xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return x - (1 << 64) if x >> 63 else x


#: What a row of a style tree says: a page has the style, it has this sequence of child styles, it has this block of text.
PAGE, SHAPE, BLOCK = 0, 1, 2


def features(page: str) -> set[tuple[int, int, int]]:
    """(style, kind, value) of all nodes of a page, each once."""
    out = set()
    todo = [parse(page)]
    while todo:
        node = todo.pop()
        style = value(node.style)
        shape: list[str] = []
        for kid in node.kids:
            if isinstance(kid, str):
                out.add((style, BLOCK, value(kid)))
                name = "#text"
            else:
                todo.append(kid)
                name = kid.style[len(node.style) :]
            if not shape or shape[-1] != name:
                shape.append(name)  # a list of ten items has the shape of one of three
        out.add((style, PAGE, 0))
        out.add((style, SHAPE, value(" ".join(shape))))
    return out


def blocks(nodes: list[Node], low: set[int], sure: int, but: frozenset[Node] = frozenset()) -> list[tuple[str, str]]:
    """(tag, text) of the blocks under `nodes` in page order, without those under `but`, furniture of at least `sure` and styles in `low`."""
    out: list[tuple[str, str]] = []
    todo: list = list(reversed(nodes))
    while todo:
        node = todo.pop()
        if isinstance(node, tuple):
            out.append(node)
        elif node not in but and node.furniture < sure:
            cut = value(node.style) in low
            todo += [(node.tag, k) if isinstance(k, str) else k for k in reversed(node.kids) if not (cut and isinstance(k, str))]
    return out


def outermost(root: Node, tag: str, sure: int) -> list[Node]:
    """The elements of a tag that stand in no other one and in no furniture."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.furniture >= sure:
            continue
        if x.tag == tag:
            out.append(x)
        else:
            todo += [k for k in reversed(x.kids) if not isinstance(k, str)]
    return out


def main_text(page: str, low: set[int]) -> str:
    """The article of a page without furniture and without text that stands in a style of `low`.

    Article elements hold it if one of them has a first-level heading, or if they have at least as much text as main (or the page,
    where there is no main) has outside them; otherwise they are teasers, and it is what stands outside them. Where names leave
    a page without article and main nothing but headings, a named box that has paragraphs is no furniture: the one
    with most text counts.
    """
    root = parse(page)
    articles, mains = outermost(root, "article", BY_NAME), outermost(root, "main", BY_NAME)
    around = mains[:1] or [root]
    found = blocks(articles, low, BY_NAME)
    size = lambda rows: sum(len(text) for _, text in rows)
    if not any(tag == "h1" for tag, _ in found):
        outside = blocks(around, low, BY_NAME, frozenset(articles))
        if not articles or size(outside) > size(found):
            found = outside
    if not articles and not mains and all(tag in HEADINGS for tag, _ in found):
        named, todo = [], [root]
        while todo:
            x = todo.pop()
            if x.furniture == BY_NAME:
                x.furniture = 0
                named.append((x, blocks([x], low, BY_NAME)))
                x.furniture = BY_NAME
            elif not x.furniture:
                todo += [k for k in reversed(x.kids) if not isinstance(k, str)]
        named = [(x, rows) for x, rows in named if any(tag == "p" for tag, _ in rows)]
        if named:
            max(named, key=lambda n: size(n[1]))[0].furniture = 0
            found = blocks([root], low, BY_NAME)
    return " ".join(text for _, text in found)


# Spark ----------------------------------------------------------------------------------------


def host(url: Column) -> Column:
    """The host of a url in lower case, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, style, pages, importance) of all styles of all hosts; `pages` has host and html.

    A node's presentation importance is the entropy of its shapes over the pages that have it, with their number as base;
    its content importance is one less the mean entropy of its blocks, of which one on every page says nothing (entropy 1)
    and one on a single page everything (0). They are weighed by GAMMA to the number of shapes. On one page both are 1.
    """

    def make():
        def compute(texts: pa.Array) -> dict[str, pa.Array]:
            rows = [[{"style": s, "kind": k, "value": v} for s, k, v in sorted(features(t or ""))] for t in texts.to_pylist()]
            kind = pa.list_(pa.struct([("style", pa.int64()), ("kind", pa.int32()), ("value", pa.int64())]))
            return {"seen": pa.array(rows, kind)}

        return compute

    seen = with_text_columns(pages.select("host", "html"), "html", make, {"seen": "array<struct<style:long,kind:int,value:long>>"})
    counted = seen.select("host", F.explode("seen").alias("s")).groupBy("host", "s.style", "s.kind", "s.value").agg(F.count("*").alias("n"))
    of = lambda kind, x: F.when(F.col("kind") == kind, x)
    nodes = counted.groupBy("host", "style").agg(
        F.sum(of(PAGE, F.col("n"))).alias("pages"),
        F.count(of(SHAPE, F.col("n"))).alias("shapes"),
        F.sum(of(SHAPE, F.col("n") * F.log("n"))).alias("shape_logs"),
        F.count(of(BLOCK, F.col("n"))).alias("blocks"),
        F.sum(of(BLOCK, F.log("n"))).alias("block_logs"),
    )
    base = F.log("pages")
    presentation = 1 - F.col("shape_logs") / F.col("pages") / base  # the sum of -p log p over shapes, base `pages`
    content = F.when(F.col("blocks") == 0, 0.0).otherwise(1 - F.col("block_logs") / F.col("blocks") / base)
    weight = F.pow(F.lit(GAMMA), F.col("shapes"))
    importance = F.when(F.col("pages") <= 1, 1.0).when(F.col("blocks") == 0, presentation).otherwise((1 - weight) * presentation + weight * content)
    return nodes.select("host", "style", "pages", importance.alias("importance"))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: float = LEAST_IMPORTANCE, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """page_id, url and text of every row of `pages`.

    The text is that of the article elements (of main or the whole page, where these hold no article, see `main_text`) without
    furniture: menus, headers, footers, sidebars, notices, adverts, forms, comments of readers, as tags and names tell, and without the styles that
    at least `least_pages` pages of the host have and whose importance is below `least`. Character references are decoded, white space in a
    block becomes one space, blocks are joined by one space. Null or empty markup has no text; a null url is of a host of
    its own; repeated pages count as often as they are there. Rows are neither dropped nor merged, other columns not read.
    """
    rows = only(pages, page_id=id_col, url=url_col, html=html_col).withColumn("host", host(F.col("url")))
    low = style_tree(rows).filter((F.col("pages") >= least_pages) & (F.col("importance") < least)).groupBy("host").agg(F.collect_list("style").alias("low"))
    # the pages of a host are dealt out to lanes, and its few styles go to each
    low = low.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("page_id", "url", F.octet_length("html")), F.lit(LANES)).cast("int"))
    joined = rows.join(low, ["host", "lane"], "left")
    fields = "page_id " + rows.schema["page_id"].dataType.simpleString() + ", url string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = plain(batch.column("html"))
            for i, j in slices(texts):
                lows = batch.column("low").slice(i, j - i).to_pylist()
                got = [main_text(t or "", set(low or ())) for t, low in zip(texts.slice(i, j - i).to_pylist(), lows)]
                columns = [batch.column("page_id").slice(i, j - i), plain(batch.column("url")).slice(i, j - i), pa.array(got, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    return joined.select("page_id", "url", "html", "low").mapInArrow(run, fields)
