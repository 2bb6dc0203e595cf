"""Main text of web pages by wrapper induction over the pages of a host.

Each layout of a host has a reference page. Simple tree matching aligns every page of the layout
with it; the nodes of the reference whose text is the same on nearly all pages are the template, and
varying slots are content. Layouts of too few pages are taken together, or use the template of the
host's most frequent layout. Element names, roles and class names that mark menus, notices, adverts
and the like settle what varies from page to page and still is no content. Inside articles the
template is small or absent (else the pages are captures of one article), and a class name does not
remove a slot that holds most of the layout's main text.

Only counts per layout and node leave the tasks that align, so a host with a third of all pages
needs no task of its own. References are broadcast up to a checked size; beyond it they are
joined by host, with hot hosts split.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.llm.common import batch_of, in_batches, prepare, text_values, written
from unitledger.llm.dom import BLOCKS, Node, Shapes, parse
from unitledger.operators.skew import keyed_join

#: Pages a host needs before it has a template, and the share of pages that must agree in a node.
LEAST_PAGES, CONSTANT = 5, 0.9
#: Template text below an article or main element is at most this share of its text; where more
#: agrees, the pages are captures of one text.
MAIN_CONSTANT = 0.2
#: A slot below such an element that holds more than this share of its text stays whatever its name.
NAMED_SHARE = 0.5
#: A page longer than this is a host's reference only if all its pages are.
REFERENCE_CHARS = 1 << 16
#: References of all hosts are broadcast up to so many characters.
BROADCAST_CHARS = 8 << 20
#: Containers so deep below the body tell layouts of a host apart.
LAYOUT_DEPTH = 4
#: Counts of copies are broadcast up to so many repeated pages.
BROADCAST_COPIES = 1 << 18

#: Places of the reference's template nodes, and of nodes that stay whatever their names.
DECIDED = ["_template", "_stay"]

# Elements, roles and words in class names or ids that mark what is no main text.
DROPPED = set(
    "head script style noscript template nav footer aside form iframe svg button select input textarea menu dialog "
    "object audio video canvas map math".split()
)
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice popup modal overlay newsletter subscribe subscription signup paywall sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead topbar footer comment comments commentlist respond disqus discussion replies share "
    "sharing social related recommended recommendations pagination pager widget toolbar login search skip".split()
)
#: Names that begin with one of these mark replies and teasers even where they hold whole articles.
OTHERS = set("comment comments commentlist respond disqus discussion replies related recommended".split())
HEADER_WORDS = {"header"}
MAIN_WORDS = set("content main article post entry story".split())
CONTAINERS = set("html body div section main article header center table tbody tr td".split())
NAMED = set("div section td h1 h2 h3 h4 h5 h6".split())
_PART = re.compile(r"[^a-z0-9]+")


def _words(node: Node) -> set[str]:
    names = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}"
    return set(_PART.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", names).lower())) if names.strip() else set()


def _others(node: Node) -> bool:
    """Whether an element is named after replies or teasers."""
    if not node.attrs or node.tag in ("#root", "html", "body", "main"):
        return False
    names = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower().split()
    return any(_PART.split(n)[0] in OTHERS for n in names)


def _marked(node: Node) -> bool:
    """Whether an element's names or role say that it is no main text.

    Names like `has-sidebar` also stand on elements around the main text, so an element that
    encloses it only counts if it is named after replies or teasers.
    """
    if not node.attrs or node.tag in ("#root", "html", "body", "main"):
        return False
    if _others(node):
        return True
    if node.tag == "article":
        return False
    if not (_words(node) & WORDS or node.attrs.get("role", "").lower() in ROLES):
        return False
    return not any(n.tag in ("article", "main") and not _marked(n) for n in node.walk() if n is not node)


def _hidden(node: Node) -> bool:
    return (
        "hidden" in node.attrs
        or node.attrs.get("aria-hidden", "").lower() == "true"
        or re.sub(r"\s", "", node.attrs.get("style", "")).lower().find("display:none") >= 0
    )


def _encloses_main(root: Node) -> bool:
    """Whether a root is main text by its markup."""
    return root.tag in ("article", "main") or root.attrs.get("role") == "main"


class Page:
    """A parsed page with the nodes that hold its main text."""

    def __init__(self, html: str):
        self.root = parse(html)

    def roots(self) -> list[Node]:
        """The elements that enclose the main text, in page order: articles, else main elements,
        else all blocks and headings that are named so, else the whole page."""
        articles, mains, named = [], [], []
        # Entries: a node, and whether it lies in a main element or in a named block.
        stack: list[tuple[Node, bool, bool]] = [(self.root, False, False)]
        while stack:
            node, in_main, in_named = stack.pop()
            words = _words(node) if node.attrs else set()
            if node.tag in DROPPED or _hidden(node) or _marked(node):
                continue
            if node.tag == "article":
                articles.append(node)
                continue
            if node.tag == "main" or node.attrs.get("role") == "main":
                if not in_main:
                    mains.append(node)
                in_main = True
            elif words & MAIN_WORDS and not in_named and node.tag in NAMED:
                named.append(node)
                in_named = True
            stack += [(c, in_main, in_named) for c in reversed(node.elements())]
        return articles or mains or named or [self.root]

    def layout(self) -> int:
        """Pages of a host with equal numbers have the same layout.

        It is the set of label paths of the containers that may hold main text, down to
        `LAYOUT_DEPTH` below the body. Main text itself and what markup or names settle are left
        out, so that longer articles or an advert more make no new layout.
        """
        paths: set[str] = set()
        stack = [(self.root, "", 0)]
        while stack:
            node, path, depth = stack.pop()
            for child in node.elements():
                if child.tag not in CONTAINERS or child.tag in DROPPED or _hidden(child) or _marked(child):
                    continue
                if _encloses_main(child) or child.tag in NAMED and child.attrs and _words(child) & MAIN_WORDS:
                    paths.add(f"{path}>{child.tag}")
                    continue
                below = f"{path}>{child.label}"
                paths.add(below)
                deeper = depth + (child.tag not in ("html", "body"))
                if deeper < LAYOUT_DEPTH:
                    stack.append((child, below, deeper))
        digest = hashlib.blake2b("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"), digest_size=8).digest()
        return int.from_bytes(digest, "little", signed=True) or 1

    def main_nodes(self) -> Iterator[tuple[Node, bool]]:
        """Nodes below article and main elements, and whether their class names or role would
        remove them; what lies below a node that goes is left out."""
        for top in filter(_encloses_main, self.roots()):
            stack = [top]
            while stack:
                node = stack.pop()
                if node is not top:
                    if node.tag in DROPPED or _hidden(node) or _others(node):
                        continue
                    if _marked(node):
                        yield node, True
                        continue
                yield node, False
                stack += reversed(node.elements())

    def named_slots(self) -> list[tuple[int, int, int]]:
        """(node, its characters, characters of all main text) of nodes there that go by their names."""
        if not any(named for _, named in self.main_nodes()):
            return []
        parts, rest = [], 0
        for node, named in self.main_nodes():
            if named:
                parts.append((node.order, sum(len(n.own_text()) for n in node.walk())))
            else:
                rest += len(node.own_text())
        whole = rest + sum(n for _, n in parts)
        return [(order, n, whole) for order, n in parts]

    def text(self, template: set[int], stay: set[int] = frozenset()) -> str:
        """Blocks of the main text. `template` holds the places (in page order) of template nodes,
        `stay` those of nodes that stay though their names mark them."""
        blocks: list[str] = []
        inline: list[str] = []

        def flush() -> None:
            block = " ".join("".join(inline).split())
            if block:
                blocks.append(block)
            inline.clear()

        for top in self.roots():
            # Entries: a node to enter, a text, or None at the end of a block; and whether only
            # headings count, as in the header of an article.
            stack: list[tuple[Node | str | None, bool]] = [(top, False)]
            while stack:
                item, headings = stack.pop()
                if item is None:
                    flush()
                    continue
                if item.__class__ is str:
                    if not headings:
                        inline.append(item)
                    continue
                node = item
                if node.tag == "br":
                    inline.append(" ")
                    continue
                if node is not top:
                    if node.tag in DROPPED or _hidden(node) or _marked(node) and node.order not in stay:
                        continue
                    if node.tag == "header" or node.attrs and _words(node) & HEADER_WORDS and node.tag != "body":
                        if top.tag != "article":
                            continue
                        headings = True
                if re.fullmatch("h[1-6]", node.tag):
                    headings = False
                block = node.tag in BLOCKS
                if block:
                    flush()
                    stack.append((None, False))
                bare = node.order in template
                for child in reversed(node.children):
                    if not (bare and child.__class__ is str):
                        stack.append((child, headings))
            flush()
        return "\n".join(blocks)


class Wrapper:
    """A host's reference page, and alignment of other pages with it."""

    def __init__(self, shapes: Shapes, html: str, template: list[int] | None = None, stay: list[int] | None = None):
        self.shapes = shapes
        page = Page(html)
        self.root = page.root
        self.template, self.stay = set(template or ()), set(stay or ())
        shapes.sign(self.root)
        #: Characters of the reference's slots below article and main elements.
        self.main = {node.order: len(node.own_text()) for node, named in page.main_nodes() if not named}

    def pairs(self, page: Page) -> Iterator[tuple[Node, Node]]:
        """Aligned nodes of a page and the reference."""
        self.shapes.sign(self.root)
        self.shapes.sign(page.root)
        return self.shapes.align(page.root, self.root)

    def decided(self, page: Page) -> tuple[set[int], set[int]]:
        """Nodes of a page that lie on template nodes and have their text, and those that stay
        whatever their names."""
        template: set[int] = set()
        stay: set[int] = set()
        if self.template or self.stay:
            for a, b in self.pairs(page):
                if b.order in self.stay:
                    stay.add(a.order)
                if b.order in self.template and a.own_text() == b.own_text():
                    template.add(a.order)
        return template, stay


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _described(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(host, content, layout, whether it fits as a reference) of each page."""
    pages = [Page(html) for html in text_values(batch.column("_html"))]
    return batch_of(
        ["_host", "_content", "_layout", "fits"],
        [
            batch.column("_host"),
            batch.column("_content"),
            pa.array([p.layout() for p in pages], pa.int64()),
            batch.column("fits"),
        ],
    )


class Wrappers:
    """The wrappers a task holds, by host and layout."""

    def __init__(self, lookup):
        self.lookup = lookup
        self.shapes = Shapes()
        self.held: dict[tuple[str, int], Wrapper] = {}

    def pages(self, batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], Page, Wrapper | None]]:
        """(host and layout, page, wrapper if there is one) of a batch's rows."""
        for page, key, found in self.lookup(batch):
            wrapper = None
            if found is not None:
                wrapper = self.held.get(key)
                if wrapper is None:
                    if len(self.held) > 500:
                        self.held.clear()
                    wrapper = self.held[key] = Wrapper(self.shapes, *found)
            yield key, page, wrapper


SUPPORT = "_host string, _layout long, slot int, inside int, n double, same double, named double, whole double"


def _support(lookup, copies):
    """What the pages of a task say of each slot, a node of their layout's reference: its characters
    of main text, pages aligned there, pages with its text, characters that names would remove
    there, and characters of the main text around these.

    Pages with equal content count as one: each of n copies adds 1 / n.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrappers = Wrappers(lookup)
        sums: dict[tuple[str, int, int, int], list[float]] = {}
        for batch in batches:
            for (key, page, wrapper), n in zip(wrappers.pages(batch), copies(batch)):
                if wrapper is None:
                    continue
                slots = {}
                for a, b in wrapper.pairs(page):
                    slots[a.order] = b.order
                    text = b.own_text()
                    if text:
                        of_slot = sums.setdefault((*key, b.order, wrapper.main.get(b.order, 0)), [0.0] * 4)
                        of_slot[0] += 1 / n
                        of_slot[1] += (a.own_text() == text) / n
                for order, chars, whole in page.named_slots():
                    if order in slots:
                        slot = slots[order]
                        of_slot = sums.setdefault((*key, slot, wrapper.main.get(slot, 0)), [0.0] * 4)
                        of_slot[2] += chars / n
                        of_slot[3] += whole / n
            if len(sums) > 200_000:
                yield rows(sums)
                sums.clear()
        if sums:
            yield rows(sums)

    def rows(sums) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int32(), pa.int32()] + [pa.float64()] * 4
        names = ["_host", "_layout", "slot", "inside", "n", "same", "named", "whole"]
        columns = [*zip(*sums), *zip(*sums.values())]
        return batch_of(names, [pa.array(c, t) for c, t in zip(columns, types)])

    return run


def _extract(lookup, kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrappers = Wrappers(lookup)
        for batch in batches:
            texts = [
                page.text(*wrapper.decided(page)) if wrapper is not None else page.text(set())
                for _, page, wrapper in wrappers.pages(batch)
            ]
            yield batch_of(
                [*batch.schema.names[:kept], "text", "n_chars"],
                [*batch.columns[:kept], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            )

    return run


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every input row: id, url, `text` and `n_chars` (its code points).

    Blocks are joined by line feeds, white space inside one is a single blank. Null and empty html
    and pages without main text give the empty text; pages without a host share the empty one.
    Pages of a host with equal html count as one. A layout with `LEAST_PAGES` different pages has a
    template: the nodes whose text is the same on `CONSTANT` of them, if they differ elsewhere.
    Pages of rarer layouts share a layout, or take the template of the host's most frequent one.
    Where more than `MAIN_CONSTANT` of the text below an article or main element is the same, the
    pages are captures of one text and nothing of it is template. A slot there that class names
    mark stays if it holds more than `NAMED_SHARE` of the text. Repeated rows are kept; other
    columns are not looked at.
    """
    spark = prepare(pages.sparkSession)
    html = F.coalesce(F.col(html_col), F.lit(""))
    source = pages.select(F.col(id_col), F.col(url_col), host_of(F.col(url_col)).alias("_host"), html.alias("_html"))
    source = source.withColumn("_content", F.xxhash64("_host", "_html"))
    described = source.select("_host", "_content", "_html", (F.length("_html") <= REFERENCE_CHARS).alias("fits"))
    contents = written(
        described.mapInArrow(in_batches(_described), "_host string, _content long, _layout long, fits boolean")
        .groupBy("_host", "_content", "_layout")
        .agg(F.count("*").alias("copies"), F.max("fits").alias("fits"))
    )
    # Layouts with enough different pages; layout 0 has the other pages of a host.
    first = F.min_by("_content", F.struct(~F.col("fits"), "_content")).alias("_content")
    sizes = written(
        contents.groupBy("_host", "_layout").agg(F.count("*").alias("pages"), first)
    )
    frequent = sizes.filter(F.col("pages") >= LEAST_PAGES)
    rest = contents.join(frequent.select("_host", "_layout"), ["_host", "_layout"], "left_anti")
    rest = (
        rest.groupBy("_host")
        .agg(F.count("*").alias("pages"), first)
        .filter(F.col("pages") >= LEAST_PAGES)
        .join(frequent.select("_host"), "_host", "left_anti")
    )
    layouts = written(
        frequent.select("_host", "_layout", "pages", "_content")
        .unionByName(rest.select("_host", F.lit(0).cast("long").alias("_layout"), "pages", "_content"))
    )
    references = written(
        keyed_join(source.select("_content", "_html"), layouts.select("_content").distinct(), ["_content"], "inner")
        .groupBy("_content")
        .agg(F.first("_html").alias("_reference"))
        .join(layouts, "_content")
        .select("_host", "_layout", "pages", "_reference", *[F.array().cast("array<int>").alias(c) for c in DECIDED])
    )

    def with_wrappers(rows: DataFrame, wrappers: DataFrame):
        """Pages with what their lookup needs, and the lookup: (page, host and layout, reference with
        template and slots that stay) of a batch's rows."""
        wrappers = wrappers.select("_host", "_layout", "_reference", *DECIDED)
        chars = wrappers.agg(F.sum(F.length("_reference") + 100)).first()[0] or 0
        if chars <= BROADCAST_CHARS:
            shared = spark.sparkContext.broadcast({(r[0], r[1]): tuple(r[2:]) for r in wrappers.collect()})

            def lookup(batch: pa.RecordBatch):
                known = shared.value
                for host, html in zip(batch.column("_host").to_pylist(), text_values(batch.column("_html"))):
                    page = Page(html)
                    key = host, page.layout()
                    if key not in known:
                        key = host, 0
                    yield page, key, known.get(key)

            return rows, lookup

        def lookup(batch: pa.RecordBatch):
            columns = (batch.column(c).to_pylist() for c in ("_host", "_layout", "_html", "_reference", *DECIDED))
            for host, layout, html, reference, *decided in zip(*columns):
                yield Page(html), (host, layout), None if reference is None else (reference, *decided)

        def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [Page(html).layout() for html in text_values(batch.column("_html"))]
            return batch_of([*batch.schema.names, "_layout"], [*batch.columns, pa.array(found, pa.int64())])

        schema = T.StructType([*rows.schema.fields, T.StructField("_layout", T.LongType())])
        keys = wrappers.filter("_layout <> 0").select("_host", "_layout", F.lit(True).alias("_own"))
        rows = keyed_join(rows.mapInArrow(in_batches(placed), schema), keys, ["_host", "_layout"], "left")
        rows = rows.withColumn("_layout", F.when(F.col("_own"), F.col("_layout")).otherwise(F.lit(0).cast("long"))).drop("_own")
        return keyed_join(rows, wrappers, ["_host", "_layout"], "left"), lookup

    repeated = contents.filter("copies > 1").select("_content", "copies")
    counted = source
    if repeated.count() <= BROADCAST_COPIES:
        copied = spark.sparkContext.broadcast(dict(map(tuple, repeated.collect())))

        def copies(batch: pa.RecordBatch) -> list[int]:
            return [copied.value.get(c, 1) for c in batch.column("_content").to_pylist()]

    else:
        counted = keyed_join(source, repeated, ["_content"], "left")

        def copies(batch: pa.RecordBatch) -> list[int]:
            return [n or 1 for n in batch.column("copies").to_pylist()]

    rows, lookup = with_wrappers(counted, references)
    # Sums of 1 / n are whole numbers but for rounding.
    support = (
        rows.mapInArrow(_support(lookup, copies), SUPPORT)
        .groupBy("_host", "_layout", "slot", "inside")
        .agg(*[F.round(F.sum(c), 3).alias(c) for c in ("n", "same", "named", "whole")])
        .join(layouts.select("_host", "_layout", "pages"), ["_host", "_layout"])
    )
    often = F.col("same") >= CONSTANT * F.col("pages")
    differs = F.max((F.col("n") >= LEAST_PAGES) & (F.col("same") < 0.5 * F.col("n")))
    learnt = (
        support.groupBy("_host", "_layout")
        .agg(
            differs.alias("differs"),
            F.sum(F.when(often, F.col("inside")).otherwise(0)).alias("constant"),
            F.sum("inside").alias("inside"),
            F.collect_list(F.when(often & (F.col("inside") == 0), F.col("slot"))).alias("outer"),
            F.collect_list(F.when(often & (F.col("inside") > 0), F.col("slot"))).alias("inner"),
            F.collect_list(F.when(F.col("named") > NAMED_SHARE * F.col("whole"), F.col("slot"))).alias("_stay"),
        )
        .withColumn("inner", F.when(F.col("constant") <= MAIN_CONSTANT * F.col("inside"), F.col("inner")).otherwise(F.array()))
        .withColumn("_template", F.when(F.col("differs"), F.concat("outer", "inner")).otherwise(F.array()))
        .filter("size(_template) + size(_stay) > 0")
        .select("_host", "_layout", *DECIDED)
    )
    learnt = references.drop(*DECIDED).join(learnt, ["_host", "_layout"])
    # The template of a host's most frequent layout also serves its rare ones.
    common = F.struct("pages", "_layout")
    served = learnt.filter("_layout <> 0").groupBy("_host").agg(
        F.lit(0).cast("long").alias("_layout"),
        F.max_by("_reference", common).alias("_reference"),
        *[F.max_by(c, common).alias(c) for c in DECIDED],
    )
    wrappers = written(learnt.drop("pages").unionByName(served))
    rows, lookup = with_wrappers(source, wrappers)
    schema = T.StructType(
        [source.schema[id_col], source.schema[url_col], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )
    return rows.select(id_col, url_col, *[c for c in rows.columns if c not in (id_col, url_col)]).mapInArrow(_extract(lookup, 2), schema)
