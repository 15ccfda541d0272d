"""Ranked lists and specification tables out of HTML: a small selector engine, applied per page in Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import Any

from pyspark.sql import DataFrame

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "p": {"p"}}
SCOPES = {"ul", "ol", "table", "dl", "tbody", "thead", "div", "select"}


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def text(self) -> str:
        """All text below, its pieces trimmed and joined by spaces, NFKC, white space folded."""
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag not in ("script", "style"):
                stack.extend(reversed(n.children))
        return folded(" ".join(out))

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()


def folded(text: str | None) -> str:
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text or "")).strip()


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            n = self.at
            while n.parent is not None and n.tag not in SCOPES:
                if n.tag in CLOSES[tag]:
                    self.at = n.parent
                    break
                n = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str | None) -> Node:
    t = _Tree()
    t.feed(html or "")
    t.close()
    return t.root


STEP = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:#[\w-]+|\.[\w-]+|\[[^\]]+\])*)")


def _compound(step: str):
    m = STEP.fullmatch(step)
    if not m or not step:
        raise ValueError(f"cannot read the selector {step!r}")
    tag, tests = m[1], re.findall(r"#[\w-]+|\.[\w-]+|\[[^\]]+\]", m[2])

    def ok(n: Node) -> bool:
        if tag and tag != "*" and n.tag != tag.lower():
            return False
        for t in tests:
            if t[0] == "#" and n.attrs.get("id") != t[1:] or t[0] == "." and t[1:] not in n.classes():
                return False
            if t[0] == "[":
                name, op, value = re.fullmatch(r"\[([\w-]+)(?:([*^$]?=)['\"]?([^'\"\]]*)['\"]?)?\]", t).groups()
                have = n.attrs.get(name)
                if have is None or op and not {"=": have == value, "*=": value in have, "^=": have.startswith(value), "$=": have.endswith(value)}[op]:
                    return False
        return True

    return ok


def _compiled(selector: str) -> list[list[tuple[str, Any]]]:
    out = []
    for path in selector.split(","):
        steps, way = [], " "
        for word in path.replace(">", " > ").split():
            if word == ">":
                way = ">"
            else:
                steps.append((way, _compound(word)))
                way = " "
        out.append(steps[::-1])
    return out


def _matches(n: Node, steps, k: int = 0) -> bool:
    way, ok = steps[k]
    if not ok(n):
        return False
    if k + 1 == len(steps):
        return True
    p = n.parent
    while p is not None and p.tag != "#root":
        if _matches(p, steps, k + 1):
            return True
        if way == ">":
            return False
        p = p.parent
    return False


def select(root: Node, selector: str) -> list[Node]:
    """The nodes below ``root`` that match, in page order. Tags, ids, classes, attributes (= *= ^= $=), descendants, children and lists of these."""
    paths = _compiled(selector)
    return [n for n in root.walk() if any(_matches(n, p) for p in paths)]


def first(root: Node, *selectors: str) -> Node | None:
    """The first node of the first selector that has one."""
    for s in selectors:
        if hit := select(root, s):
            return hit[0]
    return None


def ranked_cards(html: str | None, page: int, spec: dict[str, Any]) -> list[dict[str, Any]]:
    """The cards of one list page in order.

    spec: ``card`` selector; ``link`` selectors in order of trust; ``price`` selectors; ``page_size``; ``id`` = list of ("attr", selector
    or None for the card, attribute) and ("href", regular expression); ``title_first`` prefers the link's title attribute; ``need_id``
    skips cards without an id; ``shop`` selector. Rank is (page - 1) * page_size + the card's place, counted over skipped cards too.
    """
    out = []
    for place, card in enumerate(select(tree(html), spec["card"]), 1):
        link = first(card, *spec["link"])
        if link is None and not spec.get("need_id"):
            continue
        said = [link.text(), folded(link.attrs.get("title"))] if link is not None else [""]
        title = next((x for x in (said[::-1] if spec.get("title_first") else said) if x), "")
        href, product = (link.attrs.get("href", "").strip() if link is not None else ""), ""
        for kind, where, *what in spec["id"]:
            if kind == "attr":
                at = card if where is None else first(card, where)
                product = folded(at.attrs.get(what[0])).lstrip(spec.get("id_strip", "")) if at is not None else ""
            elif kind == "href":
                product = m[1] if (m := re.search(where, href)) else ""
            else:
                product = re.sub(r"\W+", "-", href).strip("-")
            if product:
                break
        if not title or spec.get("need_id") and not product:
            continue
        price, shop = first(card, *spec.get("price", ())), first(card, *spec.get("shop", ()))
        figure = re.search(r"\d[\d,]*(?:\.\d+)?", price.text()) if price is not None else None
        out.append({"source_rank": (max(1, page) - 1) * spec["page_size"] + place, "source_product_id": product, "title": title, "href": href,
                    "price": float(figure[0].replace(",", "")) if figure else None, "merchant": shop.text() if shop is not None else ""})
    return out


def spec_pairs(html: str | None, layout: str = "rows", most_key: int = 24, last_wins: bool = True) -> dict[str, str]:
    """Specifications of a page: ``rows`` of a table, ``dl`` lists and items, or table rows and then parameter ``items``; the last or the first of a repeated key wins."""
    root, out = tree(html), {}

    def put(k: str, v: str) -> None:
        if k and v and len(k) <= most_key and (last_wins or k not in out):
            out[k] = v

    if layout in ("rows", "items"):
        for row in select(root, "tr"):
            cells = select(row, "th, td")
            if len(cells) >= 2:
                k, v = (c.text().replace("纠错", "") for c in cells[:2])
                put(k.rstrip(":：") if layout == "items" else k, v if layout == "items" else re.sub(r"(更多.*|进入官网.*)$", "", v).strip())
    if layout == "items":
        for item in select(root, "li.param-item, .parameter-item, .product-parameter-item"):
            if m := re.match(r"^(.{1,32}?)[:：]\s*(.+)$", item.text()):
                put(folded(m[1]), folded(m[2]))
    if layout == "dl":
        for item in select(root, ".Ptable-item, .parameter2 li"):
            if item.tag == "li":
                k, colon, v = item.text().replace("：", ":").partition(":")
                if colon:
                    out[folded(k)] = folded(v)
            for row in select(item, "dl") if item.tag != "li" else []:
                k, v = first(row, "dt"), first(row, "dd")
                if k is not None and v is not None:
                    out[k.text()] = v.text()
    return out


# The three list layouts.
LAYOUTS: dict[str, dict[str, Any]] = {
    "follow": {"card": "#J_PicMode > li[data-follow-id]", "link": ["h3 .title-black a[href]", "a.pic[href]"], "price": [".price-type", ".price"], "page_size": 48,
               "id": [("attr", None, "data-follow-id")], "id_strip": "p"},
    "sku": {"card": "li.sku-detail", "link": [".p-name a[href]"], "title_first": True, "price": [".p-price strong"], "shop": [".p-merchant"], "page_size": 60, "need_id": True,
            "id": [("attr", ".p-price[data-skuid]", "data-skuid"), ("href", r"/(\d+)\.html")]},
    "product": {"card": "#productList li, ul#J_ProductList li, .product-list li, .product_list li, ul.plist li, ul.prolist li, .rank-list li, .item-title",
                "link": ["a.item-title-name[href]", "h3 a[href]", ".p-name a[href]", "a.product-title[href]", "a[href*='/notebook/']", "a[href]"],
                "price": [".price, .p-price, .price-type, [class*='price']"], "page_size": 25, "id": [("href", r"/(\d{3,})(?:[._/]|$)"), ("attr", "[data-id]", "data-id"), ("attr", None, "data-id"), ("slug", None)]},
}

CARD = "source_rank int, source_product_id string, title string, href string, price double, merchant string"


def read_cards(pages: DataFrame, spec: dict[str, Any], key: str = "page_no", html: str = "html") -> DataFrame:
    """The cards of all list pages, one row each: (key, rank, id, title, href, price, merchant). No shuffle; a page is parsed in the task that read it."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = [{key: k, **c} for k, h in zip(b[key], b[html], strict=True) for c in ranked_cards(h, int(k), spec)]
            yield pd.DataFrame(rows, columns=[key, *(x.split()[0] for x in CARD.split(", "))])

    return pages.select(key, html).mapInPandas(run, f"`{key}` {kind}, {CARD}")


def read_specs(pages: DataFrame, key: str, html: str = "html", layout: str = "rows", most_key: int = 24, last_wins: bool = True) -> DataFrame:
    """(key, specs map) of all detail pages."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        import pandas as pd

        for b in batches:
            yield pd.DataFrame({key: b[key], "specs": [spec_pairs(h, layout, most_key, last_wins) for h in b[html]]})

    return pages.select(key, html).mapInPandas(run, f"`{key}` {kind}, specs map<string,string>")


def is_risk_page(html: str | None, url: str, url_marks=("risk_handler", "passport.jd.com"), title_mark="京东安全", text_mark="访问验证") -> bool:
    """Whether a page is a site's check for robots: by its address, its title, or the first 500 characters of its text."""
    root = tree(html)
    title = first(root, "title")
    return any(m in url for m in url_marks) or (title is not None and title_mark in title.text()) or text_mark in root.text()[:500]
