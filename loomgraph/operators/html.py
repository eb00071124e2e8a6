"""Web pages to markdown: title, main content, and images found on the way.

HTML can't be taken apart with column expressions (raw text in scripts, tags left open), so a small tree built on
the standard parser runs inside an Arrow function, a batch of pages at a time; nothing is shuffled. A page that
can't be parsed keeps its HTML and tells why.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import chunking, markdown

# What is no content, where content is, how titles are named, files that are images.
NOT_CONTENT = """nav .nav .navigation .navbar .menu header .header .site-header footer .footer .site-footer .sidebar .widget
.advertisement .ads .breadcrumb .pagination .social-share script style noscript""".split()
MAIN = "main [role=main] article .article .post .entry .main-content .content .post-content #content #main-content".split()
TITLE_CLASSES = ["article-title", "post-title", "entry-title", "title"]
IMAGE_FILES = (".png", ".jpg", ".jpeg", ".gif", ".bmp", ".svg", ".webp")
SITE_SUFFIX = r"\s*[|\-–—]\s*.+$"
NO_TITLES = [r"^(home|index|main|default)$", r"^(页面|page)\s*\d*$", r"^(untitled|无标题)$"]

_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_ENDS_P = set("p div ul ol table h1 h2 h3 h4 h5 h6 article section pre blockquote nav footer header main aside form hr".split())
_SAME = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}}
_FENCES = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}


def clean_title(title: Column) -> Column:
    """Without a site's name after the first bar or dash; null unless 5 to 200 characters that mean something."""
    bare = F.regexp_replace(F.regexp_replace(title, SITE_SUFFIX, ""), r"\s+", " ")
    bare = F.regexp_replace(bare, "^ | $", "")
    dull = F.lit(False)
    for pattern in NO_TITLES:
        dull = dull | bare.rlike("(?i)" + pattern)
    return F.when((F.length(bare) >= 5) & (F.length(bare) <= 200) & ~dull, bare)


def _clean_title(title: str) -> str:
    title = " ".join(re.sub(SITE_SUFFIX, "", title).split())
    dull = any(re.match(p, title, re.IGNORECASE) for p in NO_TITLES)
    return title if 5 <= len(title) <= 200 and not dull else ""


class Node:
    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self) -> str:
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                out.append(node)
            else:
                todo.extend(reversed(node.children))
        return "".join(out)

    def has(self, selector: str) -> bool:
        if selector[0] == ".":
            return selector[1:] in self.attrs.get("class", "").split()
        if selector[0] == "#":
            return self.attrs.get("id") == selector[1:]
        if selector[0] == "[":
            key, _, value = selector[1:-1].partition("=")
            return self.attrs.get(key) == value
        return self.name == selector

    def first(self, selector: str) -> Node | None:
        return next((n for n in self.walk() if n is not self and n.has(selector)), None)

    def all(self, *names: str) -> list[Node]:
        return [n for n in self.walk() if n.name in names]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def _close(self, names: set[str], fences: set[str]) -> None:
        node = self.at
        while node.parent and node.name not in fences:
            if node.name in names:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _ENDS_P:
            self._close({"p"}, {"table", "td", "th", "li", "button"})
        if tag in _SAME:
            self._close(_SAME[tag], _FENCES.get(tag, set()))
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent and node.name != tag:
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def find_title(root: Node) -> str:
    """The first source that gives a title of over five characters which survives cleaning."""
    metas = root.all("meta")
    named = [next((m for m in metas if m.attrs.get(k) == v), None) for k, v in (("property", "og:title"), ("name", "title"), ("name", "dc.title"))]
    main = next((h for s in MAIN if (m := root.first(s)) and (h := m.first("h1"))), None)
    marked = next((n for n in root.walk() if set(n.attrs.get("class", "").split()) & set(TITLE_CLASSES)), None)
    for node in (*named, main, root.first("h1"), root.first("title"), marked):
        if node:
            text = (node.attrs.get("content", "") if node.name == "meta" else node.text()).strip()
            if len(text) > 5 and (title := _clean_title(text)):
                return title
    return ""


def strip_page(root: Node) -> None:
    """Take out what is no content, and turn tables that only lay things out into plain blocks."""
    for node in list(root.walk()):
        if node.parent and any(node.has(s) for s in NOT_CONTENT):
            node.parent.children.remove(node)
    for table in root.all("table"):
        cells = table.all("td", "th")
        words = sum(len(c.text().strip()) for c in cells) / max(len(cells), 1)
        layout = len(table.all("tr")) < 2 or len(cells) < 4 or len(table.all("a")) > 0.6 * len(cells) or words < 15
        if layout and not table.all("th", "thead"):
            for node in table.walk():
                if node.name in ("table", "thead", "tbody", "tr", "td", "th"):
                    node.name = "div"


def main_area(root: Node) -> Node:
    return next((m for s in MAIN if (m := root.first(s))), None) or root.first("body") or root


class Renderer:
    """Markdown of a tree; images are gathered, not shown."""

    def __init__(self, with_images: bool = True):
        self.with_images, self.images = with_images, []

    def image(self, src: str, node: Node, placement: str, alt: str) -> str:
        if self.with_images and src:
            a = node.attrs
            record = (f"img_{len(self.images) + 1}", src, alt, a.get("title", ""), a.get("width", ""), a.get("height", ""), placement, a)
            self.images.append(record)
        return ""

    def inline(self, node: Node | str) -> str:
        if isinstance(node, str):
            return re.sub(r"\s+", " ", node)
        if node.name in ("br", "hr"):
            return "  \n" if node.name == "br" else ""
        if node.name == "img":
            return self.image(node.attrs.get("src", ""), node, "block", node.attrs.get("alt", ""))
        body = "".join(map(self.inline, node.children))
        bare = body.strip()
        if node.name == "a":
            href = node.attrs.get("href", "")
            if href.lower().endswith(IMAGE_FILES):
                return self.image(href, node, "link", bare)
            return f"[{bare}]({href})" if bare and href else body
        mark = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}.get(node.name)
        if mark and bare:
            lead, tail = body[: len(body) - len(body.lstrip())], body[len(body.rstrip()) :]
            return f"{lead}{mark}{bare}{mark}{tail}"
        return body

    def table(self, node: Node) -> str:
        rows = [[re.sub(r"\s+", " ", self.inline(c)).strip().replace("|", "\\|") for c in r.children if isinstance(c, Node) and c.name in ("td", "th")] for r in node.all("tr")]
        rows = [r for r in rows if r]
        if len(rows) < 2 or sum(map(len, rows)) < 4 or len(node.text().strip()) < 50:
            return self.blocks(node)
        lines = ["| " + " | ".join(r) + " |" for r in rows]
        return "\n".join([lines[0], "| " + " | ".join("---" for _ in rows[0]) + " |", *lines[1:]])

    def blocks(self, node: Node, depth: int = 0) -> str:
        out, text = [], []

        def flush() -> None:
            if joined := re.sub(r"[ \t]+\n[ \t]*", lambda m: "  \n" if m[0].startswith("  ") else "\n", "".join(text)).strip():
                out.append(joined)
            text.clear()

        for child in node.children:
            name = "" if isinstance(child, str) else child.name
            if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
                flush()
                if title := re.sub(r"\s+", " ", self.inline(child)).strip():
                    out.append({"h1": f"{title}\n{'=' * len(title)}", "h2": f"{title}\n{'-' * max(len(title), 3)}"}.get(name, "#" * int(name[1]) + " " + title))
            elif name in ("ul", "ol"):
                flush()
                items = [c for c in child.children if isinstance(c, Node) and c.name == "li"]
                lines = [("* " if name == "ul" else f"{n}. ") + self.blocks(c, depth + 1).replace("\n", "\n  ") for n, c in enumerate(items, 1)]
                out.append("\n".join(lines))
            elif name == "table":
                flush()
                out.append(self.table(child))
            elif name == "pre":
                flush()
                out.append("```\n" + child.text().strip("\n") + "\n```")
            elif name == "blockquote":
                flush()
                out.append("\n".join("> " + x for x in self.blocks(child, depth).split("\n")))
            elif name in _ENDS_P or name in ("body", "html", "center", "figure", "dl", "dd", "dt", "tr", "td", "th", "tbody", "thead", "li"):
                flush()
                out.append(self.blocks(child, depth))
            elif name not in ("head", "title", "meta", "link"):
                text.append(self.inline(child))
        flush()
        return ("\n" if depth else "\n\n").join(x for x in out if x)


def to_markdown(html: str, with_images: bool = True) -> tuple[str, str, list]:
    root = parse(html)
    title = find_title(root)
    strip_page(root)
    renderer = Renderer(with_images)
    body = renderer.blocks(main_area(root))
    return title, f"{title}\n{'=' * len(title)}\n\n{body}" if title else body, renderer.images


IMAGE = T.StructType([*(T.StructField(n, T.StringType()) for n in "id src alt title width height placement".split()), T.StructField("attributes", T.MapType(T.StringType(), T.StringType()))])
PAGE = T.StructType([T.StructField("title", T.StringType()), T.StructField("markdown", T.StringType()), T.StructField("images", T.ArrayType(IMAGE)), T.StructField("error", T.StringType())])


def markdown_of(html: Column, with_images: bool = True, cleaned: bool = True) -> Column:
    """title, markdown, images, error of a column of HTML; null for null."""

    @F.pandas_udf(PAGE)
    def convert(pages: pd.Series) -> pd.DataFrame:
        out = []
        for page in pages:
            if page is None:
                out.append((None, None, None, None))
                continue
            try:
                title, text, images = to_markdown(page, with_images)
                out.append((title, markdown.clean(text) if cleaned else text, images, None))
            except Exception as e:  # a page that breaks the parser keeps its HTML
                out.append(("", page, [], type(e).__name__))
        return pd.DataFrame(out, columns=PAGE.names)

    return convert(html)


CHUNK = T.ArrayType(
    T.StructType([T.StructField("content", T.StringType()), T.StructField("content_type", T.StringType()), *(T.StructField(f"h{k}", T.StringType()) for k in range(1, 5))])
)


def chunks_of(text: Column, most: int = 500, overlap: int = 50) -> Column:
    """Chunks of a column of markdown, in order."""

    @F.pandas_udf(CHUNK)
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else [(c.content, c.content_type, *(h or None for h in c.headings)) for c in chunking.chunk(t, None, most, overlap)] for t in texts])

    return cut(text)


def page_chunks(pages: DataFrame, most: int = 500, overlap: int = 50) -> DataFrame:
    """page_id, chunk_id, total_chunks, content, content_type, h1 ... h4, tokens, document_title of each page's chunks."""
    page = pages.select("page_id", markdown_of(F.col("html")).alias("page"))
    cut = page.select("page_id", F.col("page.title").alias("document_title"), chunks_of(F.col("page.markdown"), most, overlap).alias("chunks"))
    rows = cut.select("page_id", "document_title", F.size("chunks").cast("long").alias("total_chunks"), F.posexplode("chunks").alias("chunk_id", "c"))
    return rows.select("page_id", F.col("chunk_id").cast("long").alias("chunk_id"), "total_chunks", "document_title", "c.*", chunking.tokens(F.col("c.content")).alias("tokens"))
