"""HTML as a table of nodes.

The standard library's event parser is the only Python in page extraction: it runs once a page, in
Arrow batches. It yields the page's pieces of text, once, and its elements in document order. An element
knows the interval of elements below it (`idx` to `last`) and of its pieces (`p0` up to `p1`), so that
"inside this widget", "between these headings" and the text of any element are range tests and slices,
and no text is stored with its ancestors. What follows are column expressions.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, functions as F

from civitas.functions import text as T
from civitas.functions.text import bound
from civitas.sources.shared import small_batches

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SKIPPED = {"script", "style"}
FIELDS = {"idx": "int", "last": "int", "depth": "int", "parent": "int", "tag": "string", "id": "string", "cls": "string", "href": "string", "name": "string", "content": "string", "p0": "int", "p1": "int"}
NODE = f"array<struct<{','.join(f'{k}:{v}' for k, v in FIELDS.items())}>>"
PAGE = f"struct<nodes:{NODE},pieces:array<string>,parse_error:string>"


class _Builder(HTMLParser):
    """Elements (as lists in the order of FIELDS) and pieces of text in document order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = []
        self.pieces: list[str] = []
        self.open: list[int] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        at = {k: v or "" for k, v in attrs}
        named = at.get("name") or at.get("property") or (at.get("rel") if tag == "link" else None) or at.get("hreflang")
        i, n = len(self.nodes), len(self.pieces)
        self.nodes.append([i, i, len(self.open), self.open[-1] if self.open else -1, tag, at.get("id"), at.get("class"), at.get("href"), named, at.get("content"), n, n])
        if tag in SKIPPED:
            self.skip += 1
        if tag == "br":
            self.pieces.append(" ")
        if tag not in VOID:
            self.open.append(i)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if any(self.nodes[i][4] == tag for i in self.open):
            while self._shut() != tag:
                pass

    def handle_data(self, data):
        if not self.skip:
            self.pieces.append(data)

    def _shut(self) -> str:
        node = self.nodes[self.open.pop()]
        node[1], node[-1] = len(self.nodes) - 1, len(self.pieces)
        self.skip -= node[4] in SKIPPED
        return node[4]

    def close(self):
        super().close()
        while self.open:
            self._shut()


def parse(html: str) -> tuple[list[list], list[str]]:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.nodes, builder.pieces


#: Bytes of pages whose elements are Python objects at the same time.
PART = 1 << 20


def _parsed(pages):
    """An Arrow array of pages as an array of PAGE, part by part: only one part's elements are Python objects at a time."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(lengths) - lengths) // PART
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(pages)]
    out = pa.concat_arrays([_parsed_part(pages.slice(a, b - a)) for a, b in zip(starts, starts[1:], strict=False)])
    pa.default_memory_pool().release_unused()
    return out


def _parsed_part(pages):
    """One bad page does not fail the others."""
    import pyarrow as pa

    nodes, pieces, errors = [], [], []
    for html in pages.to_pylist():
        try:
            own, text = parse(html or "")
            error = None
        except Exception as e:
            own, text, error = [], [], f"{type(e).__name__}: {e}"
        nodes.append(own)
        pieces.append(text)
        errors.append(error)
    ends = [0]
    for own in nodes:
        ends.append(ends[-1] + len(own))
    flat = list(zip(*(n for own in nodes for n in own), strict=True)) or [()] * len(FIELDS)
    kinds = {"int": pa.int32(), "string": pa.string()}
    fields = pa.StructArray.from_arrays([pa.array(v, kinds[k]) for v, k in zip(flat, FIELDS.values(), strict=True)], list(FIELDS))
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields), pa.array(pieces, pa.list_(pa.string())), pa.array(errors, pa.string())], ["nodes", "pieces", "parse_error"])


def with_nodes(pages: DataFrame, html: str = "html", texts: bool = True) -> DataFrame:
    """The pages with the columns `nodes`, `pieces` and `parse_error`.

    Null pages have no nodes; a page that cannot be parsed has a `parse_error`. With `texts`, a node has
    its normalised text as a field, too.
    """
    small_batches(pages)
    p = F.col("_p")
    nodes = F.transform(p["nodes"], lambda n: F.struct(*(n[k].alias(k) for k in FIELDS), T.normalized(raw(p["pieces"], n)).alias("text"))) if texts else p["nodes"]
    # called nondeterministic so that no filter on what pages tell is pushed below, where pages would be parsed for the filter and again for the rows
    parsed = F.arrow_udf(_parsed, PAGE).asNondeterministic()
    return pages.withColumn("_p", parsed(F.col(html))).select("*", nodes.alias("nodes"), "_p.pieces", "_p.parse_error").drop("_p")


# Texts of an element: from the slice of its pieces.


def own_pieces(pieces: Column, n: Column) -> Column:
    return F.slice(pieces, n["p0"] + 1, n["p1"] - n["p0"])


def stripped(parts: Column) -> Column:
    """Pieces without white space at their ends, empty ones left out."""
    return F.filter(F.transform(parts, T.stripped), lambda x: x != "")


def raw(pieces: Column, n: Column) -> Column:
    """The text as it stands."""
    return F.array_join(own_pieces(pieces, n), "")


def spaced(pieces: Column, n: Column) -> Column:
    """Stripped pieces with a blank between."""
    return F.array_join(stripped(own_pieces(pieces, n)), " ")


def tight(pieces: Column, n: Column) -> Column:
    """Stripped pieces with nothing between."""
    return F.array_join(stripped(own_pieces(pieces, n)), "")


def _spliced(pieces: Column, n: Column, marks: Column) -> Column:
    """The element's stripped pieces, with each mark (struct<at, to, text>, in order) in place of the pieces from `at` up to `to`."""
    start = F.struct(n["p0"].alias("at"), F.array().cast("array<string>").alias("out"))
    between = lambda a, b: F.slice(pieces, a + 1, F.greatest(b - a, F.lit(0)))
    step = lambda acc, m: F.struct(m["to"].alias("at"), F.concat(acc["out"], between(acc["at"], m["at"]), F.array(m["text"])).alias("out"))
    return F.aggregate(marks, start, step, lambda acc: stripped(F.concat(acc["out"], between(acc["at"], n["p1"]))))


def _anchors(nodes: Column, n: Column) -> Column:
    return F.filter(inside(nodes, n), lambda a: a["tag"] == "a")


def marked(pieces: Column, a: Column) -> Column:
    return F.concat(F.lit("["), tight(pieces, a), F.lit("]("), F.coalesce(a["href"], F.lit("")), F.lit(")"))


def with_targets(nodes: Column, pieces: Column, n: Column, *hidden: str) -> Column:
    """Spaced text with `[text](target)` in place of every link that has a target, and nothing in place of some kinds of elements."""
    is_mark = lambda a: (a["tag"] == "a") & a["href"].isNotNull() | a["tag"].isin(*hidden)
    out = lambda below: F.filter(below, lambda a: a["tag"].isin(*hidden))
    shown_of = lambda below: bound(out(below), lambda o: F.filter(below, lambda a: is_mark(a) & ~is_inside(a, o)))
    marks = bound(inside(nodes, n), shown_of) if hidden else F.filter(_anchors(nodes, n), lambda a: a["href"].isNotNull())
    shown = lambda a: F.when(a["tag"] == "a", marked(pieces, a)).otherwise("")
    return F.array_join(_spliced(pieces, n, F.transform(marks, lambda a: F.struct(a["p0"].alias("at"), a["p1"].alias("to"), shown(a).alias("text")))), " ")


def with_targets_before(nodes: Column, pieces: Column, n: Column) -> Column:
    """Spaced text with `[text](target)` before every link that has a text; without links, the tight text."""
    marks = lambda links: F.transform(F.filter(links, lambda a: tight(pieces, a) != ""), lambda a: F.struct(a["p0"].alias("at"), a["p0"].alias("to"), marked(pieces, a).alias("text")))
    return bound(_anchors(nodes, n), lambda links: F.when(F.size(links) > 0, F.array_join(_spliced(pieces, n, marks(links)), " ")).otherwise(tight(pieces, n)))


def item_with_targets(nodes: Column, pieces: Column, n: Column) -> Column:
    """A list item: its own links as `[text](target)`, its other children tight, its own pieces stripped, a blank between."""
    return F.array_join(_children(nodes, pieces, n, lambda a: marked(pieces, a), lambda c: tight(pieces, c)), " ")


def linked(nodes: Column, pieces: Column, n: Column) -> Column:
    """Own links as `text (target)`, inline children tight, other children spaced, own pieces stripped, a blank between."""
    link = lambda a, t: F.when((t != "") & (F.coalesce(a["href"], F.lit("")) != ""), F.concat(t, F.lit(" ("), a["href"], F.lit(")"))).otherwise(t)
    shown = lambda a: bound(tight(pieces, a), lambda t: link(a, t))
    other = lambda c: F.when(c["tag"].isin("strong", "em", "span", "b", "i"), tight(pieces, c)).otherwise(spaced(pieces, c))
    return F.array_join(_children(nodes, pieces, n, shown, other), " ")


def _children(nodes: Column, pieces: Column, n: Column, link, other) -> Column:
    own = F.filter(nodes, lambda c: (c["parent"] == n["idx"]) & (c["p1"] > c["p0"]))
    return _spliced(pieces, n, F.transform(own, lambda c: F.struct(c["p0"].alias("at"), c["p1"].alias("to"), F.when(c["tag"] == "a", link(c)).otherwise(other(c)).alias("text"))))


# Places: intervals of the document.


def inside(nodes: Column, n: Column) -> Column:
    """The elements below one."""
    return bound(n, lambda own: F.slice(nodes, own["idx"] + 2, own["last"] - own["idx"]))


def is_inside(n: Column, others: Column) -> Column:
    """Whether an element lies below one of the others."""
    return F.exists(others, lambda o: (n["idx"] > o["idx"]) & (n["idx"] <= o["last"]))


def siblings(nodes: Column, n: Column) -> Column:
    """The elements after one on its own level."""
    return bound(n, lambda own: F.filter(nodes, lambda s: (s["parent"] == own["parent"]) & (s["idx"] > own["idx"])))


def until(elements: Column, stop) -> Column:
    """The elements before the first of which stop holds."""
    first = lambda own: F.array_min(F.transform(F.filter(own, stop), lambda s: s["idx"]))
    return bound(elements, lambda own: bound(first(own), lambda end: F.filter(own, lambda s: end.isNull() | (s["idx"] < end))))


def first(elements: Column, *tests) -> Column:
    """The first element of which the first test holds; failing that, the second, and so on."""
    return bound(elements, lambda own: F.coalesce(*(F.try_element_at(F.filter(own, t), F.lit(1)) for t in tests)))


def has_token(n: Column, name: str) -> Column:
    """Whether a class is among an element's; classes are split only where they hold the name."""
    return F.coalesce(F.contains(n["cls"], F.lit(name)) & F.array_contains(F.split(n["cls"], r"\s+"), name), F.lit(False))


def tagged(nodes: Column, *tags: str) -> Column:
    return F.filter(nodes, lambda n: n["tag"].isin(*tags))


def texts_of(nodes: Column) -> Column:
    return F.transform(nodes, lambda n: n["text"])


def first_text(nodes: Column, *tags: str) -> Column:
    return F.try_element_at(texts_of(tagged(nodes, *tags)), F.lit(1))


def meta(nodes: Column, name: str) -> Column:
    return F.try_element_at(F.filter(nodes, lambda n: (n["tag"] == "meta") & (n["name"] == name)), F.lit(1))["content"]


def section(nodes: Column, heading: Column, stops: tuple[str, ...] = ("h2",)) -> Column:
    """Nodes after the first heading (by text pattern or id pattern, case-blind) up to the next stop tag."""
    at = F.try_element_at(F.filter(nodes, lambda n: n["tag"].isin("h1", "h2", "h3", "h4") & (F.rlike(F.coalesce(n["text"], F.lit("")), heading) | F.rlike(F.coalesce(n["id"], F.lit("")), heading))), F.lit(1))["idx"]
    end = lambda start: F.array_min(F.transform(F.filter(nodes, lambda n: n["tag"].isin(*stops) & (n["idx"] > start)), lambda n: n["idx"]))
    # both places are worked out once, not for every node
    return bound(at, lambda start: bound(end(start), lambda stop: F.filter(nodes, lambda n: (n["idx"] > start) & (stop.isNull() | (n["idx"] < stop)))))


def links(nodes: Column, text: str | None = None, href: str | None = None) -> Column:
    """Targets of links whose text and target match patterns (case-blind)."""
    some = F.filter(
        nodes,
        lambda n: (n["tag"] == "a") & n["href"].isNotNull() & (F.rlike(n["text"], F.lit(f"(?i){text}")) if text else F.lit(True)) & (F.rlike(n["href"], F.lit(f"(?i){href}")) if href else F.lit(True)),
    )
    return F.transform(some, lambda n: n["href"])


def link_map(nodes: Column, lower: bool = True) -> Column:
    """(lower-cased) link text -> target; of repeated texts the last stays."""
    text = lambda n: F.lower(n["text"]) if lower else n["text"]
    some = F.transform(F.filter(nodes, lambda n: (n["tag"] == "a") & n["href"].isNotNull()), lambda n: F.struct(text(n).alias("text"), n["href"].alias("href")))

    def last(pairs: Column) -> Column:
        names = F.array_distinct(F.transform(pairs, lambda n: n["text"]))
        return F.map_from_entries(F.transform(names, lambda t: F.struct(t, F.element_at(F.filter(pairs, lambda n: n["text"] == t), -1)["href"])))

    return bound(some, last)


def named_links(pieces: Column, anchors: Column) -> Column:
    """array<struct<text, url>> of links that have both; of equal texts the last target at the first place."""
    pairs = F.filter(F.transform(anchors, lambda a: F.struct(tight(pieces, a).alias("text"), a["href"].alias("url"))), lambda a: (a["text"] != "") & (a["url"] != ""))

    def last(own: Column) -> Column:
        names = F.array_distinct(F.transform(own, lambda a: a["text"]))
        return F.transform(names, lambda t: F.element_at(F.filter(own, lambda a: a["text"] == t), -1))

    return bound(pairs, last)


def kept_first(items: Column, key) -> Column:
    """Of items with equal keys the first."""
    keys = F.transform(items, key)
    return bound(keys, lambda own: F.filter(items, lambda x, i: F.array_position(own, key(x)) == i + 1))


def table_rows(nodes: Column, cells: int) -> Column:
    """Texts of the cells of all table rows that have exactly so many."""
    rows = lambda inner: F.transform(tagged(nodes, "tr"), lambda r: texts_of(F.filter(inner, lambda n: n["parent"] == r["idx"])))
    return F.filter(bound(tagged(nodes, "td", "th"), rows), lambda r: F.size(r) == cells)


#: Character references that a title is read with; `&amp;` is the last, so that nothing is read twice.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def raw_title(html: Column, element: str = r"(?is)<title[^>]*>(.*?)</title>", entities: dict[str, str] = ENTITIES) -> Column:
    """The title of a page straight from its text, without its node table; null where it has none.

    Blanks are collapsed before references are read: one that means a blank stays.
    """
    title = F.trim(F.regexp_replace(F.regexp_extract(html, element, 1), r"[\t\n\f\r ]+", " "))
    for entity, char in entities.items():
        title = F.replace(title, F.lit(entity), F.lit(char))
    return F.nullif(title, F.lit(""))
