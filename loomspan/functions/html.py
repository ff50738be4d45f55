"""HTML to text and elements, with the standard library's parser in Arrow batches."""

from __future__ import annotations

import html as html_lib
import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self):
        """This element and all below it, in page order."""
        stack: list[Node] = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(x for x in reversed(node.children) if isinstance(x, Node))

    def strings(self):
        stack: list[Node | str] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            elif item.tag not in ("script", "style") or item is self:
                stack.extend(reversed(item.children))

    def text(self, separator: str = "") -> str:
        """The stripped pieces of text below, joined by the separator."""
        return separator.join(s for s in (x.strip() for x in self.strings()) if s)

    def raw(self) -> str:
        return "".join(self.strings())

    def find_all(self, *tags: str, **attrs: str | None):
        for node in self.walk():
            if (not tags or node.tag in tags) and all(k in node.attrs and (v is None or node.attrs[k] == v) for k, v in attrs.items()):
                yield node

    def find(self, *tags: str, **attrs: str | None) -> Node | None:
        return next(self.find_all(*tags, **attrs), None)

    def has_class(self, name: str) -> bool:
        return name in (self.attrs.get("class") or "").split()


# Tags whose start ends an open paragraph, and tags inside which an outer paragraph is not seen.
_ENDS_PARAGRAPH = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "ul",
}
_PARAGRAPH_SCOPE = {"", "applet", "button", "caption", "html", "marquee", "object", "table", "td", "template", "th"}


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.open_p = 0

    def _end_paragraph(self):
        node = self.at
        while node.tag not in _PARAGRAPH_SCOPE:
            if node.tag == "p":
                self.at, self.open_p = node.parent, self.open_p - 1
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_PARAGRAPH and self.open_p:
            self._end_paragraph()
        if tag == "li" and self.at.tag == tag:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node
            self.open_p += tag == "p"

    def handle_endtag(self, tag):
        node, passed = self.at, 0
        while node is not None and node.tag != tag:
            passed += node.tag == "p"
            node = node.parent
        if node is not None and node.parent is not None:
            self.open_p -= passed + (tag == "p")
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(page: str | None) -> Node:
    builder = _Builder()
    builder.feed(page or "")
    builder.close()
    return builder.root


def text_udf(separator: str):
    """A pandas UDF: html -> its stripped pieces of text joined by the separator; null stays null."""

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: None if p is None else parse(p).text(separator))

    return run


def html_text(col: Column, separator: str = "\n") -> Column:
    return text_udf(separator)(col)


def unescape_all(col: Column) -> Column:
    """Every character reference decoded."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else html_lib.unescape(t))

    return run(col)


# Where each site keeps an article's paragraphs, in the order in which they are tried. "class" is one of an
# element's class names, "class part" any part of its class attribute.
ARTICLE_CONTAINERS = {
    "techcrunch": [("div", "class", "entry-content")],
    "theverge": [("div", "class part", "entry-content", "duet--article"), ("article", None)],
    "mit": [("div", "class", "news-article--content"), ("article", None)],
    "arstechnica": [("div", "class", "article-content"), ("div", "itemprop", "articleBody"), ("article", None)],
    "wired": [("div", "data-testid", "BodyWrapper"), ("div", "class part", "body__inner-container"), ("article", None)],
}
# Where a site names an article's author.
AUTHOR_TAGS = {"mit": ("span", "class", "news-article--author")}
#: Paragraphs of more characters count; articles with fewer in all are summaries.
MIN_PARAGRAPH, MIN_ARTICLE = 20, 100


def _fits(node: Node, attribute: str | None, *values: str) -> bool:
    if attribute is None:
        return True
    if attribute == "class":
        return any(node.has_class(v) or node.attrs.get("class") == v for v in values)
    if attribute == "class part":
        return any(v in (node.attrs.get("class") or "") for v in values)
    return node.attrs.get(attribute) in values


def article_body(page: str | None, site: str) -> str:
    """The paragraphs of the site's article container, joined by empty lines; '' without a container.

    A paragraph is its pieces of text, each without the white space around it, joined by nothing.
    """
    root = parse(page)
    for tag, *test in ARTICLE_CONTAINERS[site]:
        for node in root.find_all(tag):
            if _fits(node, *test):
                parts = [p.text() for p in node.find_all("p")]
                return "\n\n".join(p for p in parts if len(p) > MIN_PARAGRAPH)
    return ""


def article_author(page: str | None, site: str) -> str | None:
    """The author that the article's page names, where the site does so."""
    if site not in AUTHOR_TAGS or not page:
        return None
    tag, *test = AUTHOR_TAGS[site]
    return next((n.text() for n in parse(page).find_all(tag) if _fits(n, *test)), None)


def article_author_udf(site: str):
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: article_author(p, site))

    return run


def article_body_udf(site: str):
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: article_body(p, site))

    return run


PAPER = "title string, authors array<string>, paper_url string, published_date string, github_url string"


def _first_article(value) -> dict | None:
    if isinstance(value, dict):
        graph = value.get("@graph", [value])
        for item in graph if isinstance(graph, list) else []:
            if isinstance(item, dict) and item.get("@type") == "ScholarlyArticle":
                return item
    return None


def _strings(value) -> list[str]:
    return [x for x in value if isinstance(x, str)] if isinstance(value, list) else []


def paper_from_linked_data(root: Node) -> dict | None:
    """The first scholarly article of the page's linked data; scripts that are no JSON objects are passed over."""
    for script in root.find_all("script", type="application/ld+json"):
        try:
            item = _first_article(json.loads(script.raw()))
        except ValueError:
            continue
        if item is None:
            continue
        people = item.get("author", [])
        names = [a.get("name") if isinstance(a, dict) else a for a in (people if isinstance(people, list) else [people])]
        names = [n for n in names if isinstance(n, str) and n]
        return {
            "title": item.get("headline"),
            "authors": names or None,
            "paper_url": next((u for u in _strings(item.get("sameAs")) if "arxiv.org" in u), item.get("url")),
            "published_date": item.get("datePublished"),
            "github_url": next((u for u in _strings(item.get("codeRepository")) if "github.com" in u.lower()), None),
        }
    return None


def paper_from_meta(root: Node) -> dict | None:
    """From citation tags, title, canonical link and repository links; nothing without a title or an address."""
    metas = {}
    for meta in root.find_all("meta"):
        metas.setdefault(meta.attrs.get("name"), []).append(meta.attrs.get("content") or "")
    title = next(iter(metas.get("citation_title", [])), None)
    if not title and (tag := root.find("title")) is not None:
        title = re.sub(r"\s*\|\s*Papers with Code\s*$", "", tag.raw().strip())
    link = root.find("link", rel="canonical")
    url = link.attrs.get("href") if link is not None else None
    if not title and not url:
        return None
    date = next(iter(metas.get("citation_publication_date", [])), None)
    repos = (a.attrs["href"] for a in root.find_all("a", href=None))
    return {
        "title": title,
        "authors": [a for a in metas.get("citation_author", []) if a] or None,
        "paper_url": url,
        "published_date": None if date is None else date.replace("/", "-"),
        "github_url": next((h for h in repos if "github.com" in h and "/issues" not in h), None),
    }


_HEAD_END = re.compile("</head>", re.I)
_NOT_ONLY_IN_HEAD = re.compile(r"github\.com|ld\+json|<meta|<link|<title", re.I)


def _head_if_enough(page: str | None) -> str:
    """The page up to the end of its head, where nothing behind that could count for a paper's record; else the whole page."""
    m = _HEAD_END.search(page or "")
    return page[: m.end()] if m and not _NOT_ONLY_IN_HEAD.search(page, m.end()) else page or ""


def paper_page(col: Column) -> Column:
    """A paper's record: linked data first, citation tags otherwise; all null where a page has neither."""
    names = [x.split()[0] for x in PAPER.split(", ")]

    @F.pandas_udf(PAPER)
    def run(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            root = parse(_head_if_enough(page))
            found = paper_from_linked_data(root) or paper_from_meta(root) or {}
            rows.append([found.get(n) for n in names])
        return pd.DataFrame(rows, columns=names)

    return run(col)


PRODUCT = "product_name string, labels array<string>, offer string"


def product_fields(page: str | None) -> list:
    root = parse(page)
    title = root.find("title")
    m = re.match(r"^(.+?)\s+(?:reviews|alternatives)", title.raw().strip(), re.I) if title is not None else None
    name = m[1].strip() if m else next((d.text() for d in root.find_all("div") if d.has_class("font-bold") and d.text()), None)
    labels: list[str] = []
    for span in root.find_all("span"):
        if re.search("Pricing:", span.raw(), re.I) and all(isinstance(c, str) for c in span.children):
            labels = [b.text() for b in span.parent.find_all("span", "a", "div") if b is not span.parent]
            break
    offer = root.find(itemtype="http://schema.org/Offer")
    price = offer.find(itemprop="price") if offer is not None else None
    return [name or None, labels, None if price is None else price.text()]


def product_page(col: Column) -> Column:
    """A product page's name (title, else the bold heading), the labels beside 'Pricing:', and the offer's price text."""

    @F.pandas_udf(PRODUCT)
    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([product_fields(p) for p in pages], columns=["product_name", "labels", "offer"])

    return run(col)
