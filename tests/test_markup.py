"""Items from markup with end tags left out, unclosed or in the wrong order, against the same items from a tree."""

from __future__ import annotations

import random

from pricewright.sources.pages import _parse

CLASSES = [None, "product-item", "box package", "name", "title big", "price", "amount", "plain"]


def texts(node):
    tag, _, children = node
    for child in children:
        if isinstance(child, str):
            yield child
        else:
            yield from texts(child)


def elements(node, inside=()):
    yield node, inside
    for child in node[2]:
        if not isinstance(child, str):
            yield from elements(child, (*inside, node))


def from_tree(root, limit=5):
    """Items in document order, each with the text of the first name and price element inside it."""
    found = []
    for node, _ in elements(root):
        cls = node[1] or ""
        if "product-item" in cls.split() or "package" in cls:
            own = {"label": None, "price": None}
            for inner, around in elements(node):
                if inner is not node:
                    for field, marks in (("label", ("name", "title")), ("price", ("price", "amount"))):
                        if own[field] is None and any(m in (inner[1] or "") for m in marks):
                            own[field] = "".join(t.strip() for t in texts(inner))
            found.append(own)
    return [{"item_no": i, **own} for i, own in enumerate(found[:limit], 1) if own["label"] is not None and own["price"] is not None]


def make(draw, tag, depth):
    cls = draw.choice(CLASSES)
    text = [draw.choice(["x", " y ", "12"])]
    if depth == 0 or tag in ("p", "b", "i"):
        return (tag, cls, text + ([("b", draw.choice(CLASSES), ["w"])] if tag == "p" and draw.random() < 0.4 else []))
    inner = {"ul": ["li"], "table": ["tr"], "tr": ["td"]}.get(tag, ["div", "p", "ul", "table", "b", "i"])
    children = [make(draw, draw.choice(inner), depth - 1) for _ in range(draw.randrange(1, 4))]
    return (tag, cls, children if tag in ("ul", "table", "tr") else text + children)


OPTIONAL = {"li": ("li",), "td": ("td",), "tr": ("tr",), "p": ("p", "div", "ul", "table")}


def written(draw, node, following, last):
    """`following`: tag of the next sibling element; `last`: nothing but the parent's end comes after."""
    tag, cls, children = node
    out = f"<{tag}" + (f' class="{cls}"' if cls else "") + ">"
    for i, child in enumerate(children):
        if isinstance(child, str):
            out += child
        else:
            after = children[i + 1] if i + 1 < len(children) else None
            out += written(draw, child, after[0] if after is not None and not isinstance(after, str) else None, after is None)
    may_be_left_out = tag in OPTIONAL and (last or following in OPTIONAL[tag])
    return out if may_be_left_out and draw.random() < 0.7 else f"{out}</{tag}>"


def test_end_tags_left_out():
    draw = random.Random(12)
    some = 0
    for _ in range(400):
        root = ("div", None, [make(draw, draw.choice(["div", "ul", "table"]), 4) for _ in range(2)])
        expected = from_tree(root)
        some += bool(expected)
        assert _parse(written(draw, root, None, False), 5) == expected
    assert some > 100


def test_strays_and_unclosed_elements():
    item = '<div class="product-item"><b class="name">A</b><i class="price">1</i></div>'
    one = [{"item_no": 1, "label": "A", "price": "1"}]
    for before in ("</div></p></li>", "<p>open", "<b><i>open", "<table><tr><td></div></b>", "<ul><li><li>", "<!-- </div> -->", "<script>'<div class=\"package\">'</script>", "<br><img>"):
        for after in ("", "</div></div>", "<p>open<div>", "</body></html>"):
            assert _parse(before + item + after, 5) == one
    assert _parse('<div class="product-item"><span class="name">A<span class="price">1', 5) == [{"item_no": 1, "label": "A1", "price": "1"}]
    assert _parse('<div class="product-item"><b class="name">A<div>B</b>C</div></div><p class="price">no', 5) == []
    assert _parse('<div class="product-item"><b class="name">A<div>B</b>C</div><p class="price">2', 5) == [{"item_no": 1, "label": "AB", "price": "2"}]
    assert _parse(None, 5) == [] and _parse("", 5) == [] and _parse("<", 5) == []


def test_very_deep_markup():
    deep = "<div>" * 3000 + '<div class="product-item"><b class="name">A</b><i class="price">1</i>'
    assert _parse(deep, 5) == [{"item_no": 1, "label": "A", "price": "1"}]
