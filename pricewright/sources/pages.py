"""Items from stored HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

ITEMS_PER_PAGE = 5

# Class fragments that mark an item, its name and its price.
ITEM_CLASS = "product-item"
ITEM_FRAGMENTS = ("package", "diamond")
NAME_FRAGMENTS = ("name", "title")
PRICE_FRAGMENTS = ("price", "amount")

# Elements that never have a closing tag in HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

# Elements whose end tag may be left out (HTML, "optional tags"): a start tag on the right ends an open element on the
# left, looked for up to the nearest element that encloses such a list.
_BLOCKS = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
IMPLIED_ENDS = {
    "p": _BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"},
    "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"},
}
ENCLOSING = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}, "optgroup": {"select"},
    "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}, "p": {"button", "table", "td", "th", "caption"},
}
# No end tag inside one of these ends an element outside, but for their own and those of tables.
BARRIERS = frozenset("td th caption table template".split())
INLINE = frozenset("a b big code em font i small span strong u".split())  # their end tags leave blocks inside open


def extract_items(
    pages: DataFrame, html: str, item: str, name: str, price: str, first: int = ITEMS_PER_PAGE
) -> DataFrame:
    """First `first` items per page by regular expression, those with both a name and a price.

    `item` matches one whole item; `name` and `price` have one group each and look inside it.  The cut
    comes before the check, so an incomplete item among the first still uses up its place.
    """
    rest = [c for c in pages.columns if c != html]
    items = pages.select(*rest, F.posexplode(F.regexp_extract_all(html, F.lit(item), F.lit(0))).alias("_pos", "_item"))
    items = items.filter(F.col("_pos") < first)
    found = items.select(
        *rest,
        (F.col("_pos") + 1).alias("item_no"),
        F.trim(F.regexp_extract("_item", name, 1)).alias("label"),
        F.trim(F.regexp_extract("_item", price, 1)).alias("price"),
    )
    return found.filter((F.col("label") != "") & (F.col("price") != ""))


class _ItemParser(HTMLParser):
    """Collects item elements, in document order, with the text of their first name and price element."""

    def __init__(self, limit: int) -> None:
        super().__init__(convert_charrefs=True)
        self.limit = limit
        self.items: list[dict] = []
        self.open: list[tuple[str, list[tuple[dict, str]], dict | None]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_implied(tag)
        classes = dict(attrs).get("class") or ""
        enclosing = [item for _, _, item in self.open if item is not None]
        claims = []
        for field, fragments in (("label", NAME_FRAGMENTS), ("price", PRICE_FRAGMENTS)):
            if any(f in classes for f in fragments):
                claims += [(item, field) for item in enclosing if item[field] is None]
        for item, field in claims:
            item[field] = ""
        item = None
        if ITEM_CLASS in classes.split() or any(f in classes for f in ITEM_FRAGMENTS):
            if len(self.items) < self.limit:
                item = {"label": None, "price": None}
                self.items.append(item)
        if tag not in VOID:
            self.open.append((tag, claims, item))

    def _end_implied(self, tag: str) -> None:
        """End the elements that may not contain a `tag`."""
        again = True
        while again:
            again = False
            for place in range(len(self.open) - 1, -1, -1):
                name = self.open[place][0]
                if tag in IMPLIED_ENDS.get(name, ()):
                    del self.open[place:]
                    again = True
                    break
                if any(name in enclosing and tag in IMPLIED_ENDS[inner] for inner, enclosing in ENCLOSING.items()):
                    break

    def handle_endtag(self, tag: str) -> None:
        for place in range(len(self.open) - 1, -1, -1):
            name = self.open[place][0]
            if name == tag:
                if tag in INLINE and any(inner in _BLOCKS for inner, _, _ in self.open[place:]):
                    del self.open[place]
                else:
                    del self.open[place:]
                return
            if name in BARRIERS and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th"):
                return
            if name == "table" and tag != "table":
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        for _, claims, _ in self.open:
            for item, field in claims:
                item[field] += data.strip()


def _parse(html: str | None, limit: int) -> list[dict]:
    parser = _ItemParser(limit)
    parser.feed(html or "")
    parser.close()
    return [
        {"item_no": i, **item}
        for i, item in enumerate(parser.items, start=1)
        if item["label"] is not None and item["price"] is not None
    ]


def extract_product_items(pages: DataFrame, html: str, first: int = ITEMS_PER_PAGE) -> DataFrame:
    """First `first` product elements per page, nested markup included.

    Elements nest, which no expression over text can follow, so whole pages go through a parser in
    Arrow batches; every page is on its own and nothing is shuffled.
    """
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda text: _parse(text, first))

    items = F.pandas_udf(parse, "array<struct<item_no:int,label:string,price:string>>")
    rest = [c for c in pages.columns if c != html]
    return pages.select(*rest, F.inline(items(html)))
