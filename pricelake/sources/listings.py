"""Product rows out of listing pages.

Pages without a product are dropped inside the JVM; the rest is parsed in Arrow batches. A page of well-formed tags is cut into tags and texts by one
expression, and each distinct tag is looked at once a worker; elements are ranges of that list. Any other page goes through Python's HTML parser.
Both give the same rows, which the tests compare.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions import clean_url

# What a product element is called in each layout.
MARKERS = {"merc": "product-cell", "carr": "product-card__parent"}
# Elements that never have content.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Pages parsed before their rows are sent on; distinct tags that a worker remembers.
PAGES_AT_ONCE = 512
REMEMBERED_TAGS = 1 << 14


class _Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(_Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def _has_class(name: str) -> Callable[[dict], bool]:
    return lambda attrs: name in (attrs.get("class") or "").split()


def _test_id(name: str) -> Callable[[dict], bool]:
    return lambda attrs: attrs.get("data-testid") == name


#: Layout -> the elements that are looked for: role -> (tag, test of the attributes).
_ROLES = {
    "merc": {
        "product": ("div", _test_id("product-cell")),
        "price": ("p", _test_id("product-price")),
        "name": ("h4", _test_id("product-cell-name")),
        "size": ("div", _has_class("product-format")),
        "image": ("img", lambda attrs: True),
    },
    "carr": {
        "product": ("div", _has_class("product-card__parent")),
        "head": ("h2", _has_class("product-card__title")),
        "link": ("a", _has_class("product-card__title-link")),
        "struck": ("span", _has_class("product-card__price--strikethrough")),
        "current": ("span", _has_class("product-card__price--current")),
        "price": ("span", _has_class("product-card__price")),
        "unit": ("span", _has_class("product-card__price-per-unit")),
        "image": ("img", _has_class("product-card__image")),
    },
}


class _Found(NamedTuple):
    """An element with a role: the tags and texts of a page from ``start`` up to ``end`` are its own, ``start`` is its tag."""

    roles: tuple[str, ...]
    attrs: dict[str, str | None]
    start: int
    end: int


# Comments and tags with balanced quotes; any other "<" stands alone and sends the page to the parser. No part of it can pass a "<" but a comment's.
_CUT = re.compile(r"""(<!--(?![->])(?:[^-]|-(?!-))*+-->|<[a-zA-Z/!][^<>"']*+(?:(?:"[^"<]*+"|'[^'<]*+')[^<>"']*+)*+>|<)""")
_BLANK = r"[ \t\n\r\f]"
_VALUE = r"""\"[^"]*+\"|'[^']*+'|[^\s"'<>=`][^\s"'<>`]*+(?=[ \t\n\r\f>])"""
_ATTR = rf"([a-zA-Z_:@][-a-zA-Z0-9_:.@]*+)(?:{_BLANK}*+={_BLANK}*+({_VALUE}))?"
_START = re.compile(rf"<([a-zA-Z][-a-zA-Z0-9:_.]*+)((?:{_BLANK}++{_ATTR})*+){_BLANK}*+(?P<empty>/?)>")
_END = re.compile(rf"</([a-zA-Z][-a-zA-Z0-9:_.]*+){_BLANK}*+>")
_SILENT = re.compile(r"<!doctype[^<>]*>|<!--.*-->", re.I | re.S)
_ATTRS = re.compile(_ATTR)
# Elements whose content is no markup, for this version of the parser; that of the first two is read here.
_RAW = frozenset(("script", "style"))
_OTHER_RAW = {*HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext"} - _RAW
_UNKNOWN, _NOTHING, _OPEN, _EMPTY, _CLOSE, _OPEN_RAW = range(6)


#: Layout -> text -> what ``_tag`` says of it.
_known: dict[str, dict[str, tuple]] = {layout: {} for layout in _ROLES}


def _tag(layout: str, text: str) -> tuple[int, str, tuple[str, ...], dict[str, str | None]]:
    """(kind, name, roles, attributes) of one tag or comment, remembered."""
    known = _known[layout]
    if len(known) >= REMEMBERED_TAGS:
        known.clear()
    known[text] = made = _read_tag(layout, text)
    return made


def _read_tag(layout: str, text: str) -> tuple[int, str, tuple[str, ...], dict[str, str | None]]:
    m = _START.fullmatch(text)
    if m is None:
        m = _END.fullmatch(text)
        return (_CLOSE, m[1].lower(), (), {}) if m else (_NOTHING if _SILENT.fullmatch(text) else _UNKNOWN, "", (), {})
    name = m[1].lower()
    if name in _OTHER_RAW:
        return _UNKNOWN, "", (), {}
    attrs = {}
    for key, value in _ATTRS.findall(text, m.end(1)) if m[2] else ():
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        elif not value:
            value = None
        attrs[key.lower()] = unescape(value) if value else value
    roles = tuple(role for role, (tag, test) in _ROLES[layout].items() if tag == name and test(attrs))
    kind = _EMPTY if m["empty"] or name in VOID else _OPEN_RAW if name in _RAW else _OPEN
    return kind, name, roles, attrs


def _scan(layout: str, page: str) -> tuple[list[str], list[_Found]] | None:
    """(tags at odd places and texts at even ones, the elements with a role in document order); None for pages that need the parser."""
    parts = _CUT.split(page)
    total, until = len(parts), 0
    names: list[str] = []
    places: list[int] = []  # of the open elements in ``found``, or -1
    found: list[list] = []
    known = _known[layout]
    for i in range(1, total, 2):
        if i < until:
            continue
        tag = known.get(parts[i])
        kind, name, roles, attrs = tag or _tag(layout, parts[i])
        if kind == _OPEN or kind == _EMPTY or kind == _OPEN_RAW:
            place = -1
            if roles:
                place = len(found)
                found.append([roles, attrs, i, i if kind == _EMPTY else total])
            if kind != _EMPTY:
                names.append(name)
                places.append(place)
            if kind == _OPEN_RAW:
                until = _raw_end(parts, i, name)
                if not until:
                    return None
        elif kind == _CLOSE:
            if names and names[-1] == name:
                depth = len(names) - 1
            elif name in names:
                depth = len(names) - 1 - names[::-1].index(name)
            else:
                continue
            for place in places[depth:]:
                if place >= 0:
                    found[place][3] = i
            del names[depth:], places[depth:]
        elif kind == _UNKNOWN:
            return None
    return parts, [_Found(*f) for f in found]


def _raw_end(parts: list[str], at: int, name: str) -> int:
    """Makes the content of a script or style one text; returns the place of its closing tag, 0 if that takes a parser."""
    for end in range(at + 2, len(parts), 2):
        if _END.fullmatch(parts[end]) and parts[end][2:].rstrip("> \t\n\r\f").lower() == name:
            content = "".join(parts[at + 1 : end])
            if "<!--" in content or re.search(rf"</\s*{name}", content, re.I):
                return 0
            parts[at + 1 : end] = [content.replace("&", "&amp;"), *[""] * (end - at - 2)]  # texts are unescaped when they are read
            return end
    return 0


def _scan_tree(layout: str, page: str) -> tuple[list[str], list[_Found]]:
    """The same of any page, by way of the parser's tree."""
    tree = _Tree()
    tree.feed(page)
    tree.close()
    parts, found = [""], []
    todo: list = [tree.root]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            parts[-1] += node.replace("&", "&amp;")
        elif isinstance(node, list):  # the end of an element
            node[3] = len(parts)
            parts += ["", ""]
        else:
            roles = tuple(role for role, (tag, test) in _ROLES[layout].items() if tag == node.tag and test(node.attrs))
            ends = [roles, node.attrs, len(parts), 0]
            if roles:
                found.append(ends)
            parts += ["", ""]
            todo += [ends, *reversed(node.children)]
    return parts, [_Found(*f) for f in found]


def _text(parts: list[str], element: _Found | None) -> str | None:
    if element is None:
        return None
    texts = parts[element.start + 1 : element.end : 2]
    if len(texts) == 1:
        return (unescape(texts[0]) if "&" in texts[0] else texts[0]).strip()
    return "".join([unescape(t) if "&" in t else t for t in texts]).strip()


def _inside(found: list[_Found], at: int) -> Iterator[_Found]:
    """The elements below the one at a place, in document order."""
    end = found[at].end
    for k in range(at + 1, len(found)):
        element = found[k]
        if element.start >= end:
            return
        yield element


def _merc_rows(parts: list[str], found: list[_Found]) -> Iterator[tuple]:
    """Cells with at least one price; the second price is the discount."""
    for at, cell in enumerate(found):
        if "product" not in cell.roles:
            continue
        prices, first = [], {}
        for element in _inside(found, at):
            for role in element.roles:
                if role == "price":
                    prices.append(element)
                elif role not in first:
                    first[role] = element
        if prices:
            image = first.get("image")
            yield (
                _text(parts, first.get("name")),
                _text(parts, prices[0]),
                _text(parts, prices[1]) if len(prices) > 1 else None,
                _text(parts, first.get("size")),
                None,
                image.attrs.get("src") if image else None,
                None,
            )


def _carr_rows(parts: list[str], found: list[_Found]) -> Iterator[tuple]:
    """Titled cards; a struck-out price next to a current one makes a discount."""
    for at, card in enumerate(found):
        if "product" not in card.roles:
            continue
        first, head_end = {}, 0
        for element in _inside(found, at):
            for role in element.roles:
                if role == "head":
                    head_end = max(head_end, element.end)
                elif role not in first and (role != "link" or element.start < head_end):
                    first[role] = element
        title = first.get("link")
        if title is None:
            continue
        struck, current = first.get("struck"), first.get("current")
        if struck is not None and current is not None:
            original, discount = _text(parts, struck), _text(parts, current)
        else:
            original, discount = _text(parts, first.get("price")), None
        image = first.get("image")
        yield (
            _text(parts, title),
            original,
            discount,
            None,
            _text(parts, first.get("unit")),
            image.attrs.get("src") if image else None,
            title.attrs.get("href"),
        )


_ROWS = {"merc": _merc_rows, "carr": _carr_rows}
_FOUND = ["name", "original_price", "discount_price", "size", "price_per_unit", "src", "href"]


def _page_rows(layout: str, page: str) -> list[tuple]:
    return list(_ROWS[layout](*(_scan(layout, page) or _scan_tree(layout, page))))


def extract_listings(
    pages: DataFrame,
    layout: str,
    category: Column | str = "category",
    base_url: str = "",
    html: str = "html",
    url: str = "url",
) -> DataFrame:
    """One row per product on the pages, in the raw columns of the layout.

    `category` is a column of `pages` (or an expression); `url` is the page a row came from.
    """
    category = F.col(category) if isinstance(category, str) else category
    wanted = pages.filter(F.contains(F.col(html), F.lit(MARKERS[layout]))).select(
        F.col(html).alias("_html"), category.cast("string").alias("category"), F.col(url).alias("source_page")
    )

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PAGES_AT_ONCE):
                batch = whole.slice(at, PAGES_AT_ONCE)
                rows, places = [], []
                for k, page in enumerate(batch.column(0).to_pylist()):
                    made = _page_rows(layout, page)
                    rows += made
                    places += [k] * len(made)
                values = [pa.array(v, pa.string()) for v in zip(*rows)] or [pa.array([], pa.string())] * len(_FOUND)
                passed = [batch.column(c).take(pa.array(places, pa.int32())) for c in (1, 2)]
                yield pa.RecordBatch.from_arrays([*values, *passed], [*_FOUND, "category", "source_page"])

    found = wanted.mapInArrow(products, ", ".join(f"{c} string" for c in (*_FOUND, "category", "source_page")))
    image = clean_url("src", drop_fragment=layout == "carr").alias("image_url")
    if layout == "merc":
        return found.select("name", "original_price", "discount_price", "size", "category", image)
    address = F.when(F.col("href") != "", F.concat(F.lit(base_url), "href")).alias("product_url")
    return found.select(
        "name", "original_price", "discount_price", "price_per_unit", "category", image, address, "source_page"
    )
