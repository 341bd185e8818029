"""HTML extraction by building the tree and rendering what a reader sees.

The tree builder supplies end tags that HTML lets authors leave out and ignores stray ones. Elements
that are never shown, or hidden by an attribute, an inline style or a simple rule of the page's own
style sheets, are left out. All other text comes out: blocks on lines of their own, paragraphs apart
by a blank line, list items with their marker, table cells in aligned columns, preformatted text as it
is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import free_name

MOST_DEPTH = 200  # deeper elements become siblings; their text is kept
SCREEN = {"width": 1280, "height": 800}  # pixels, for the conditions of style sheets

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
UNSEEN = frozenset(
    ("head", "script", "style", "template", "title", "noscript", "noembed", "noframes", "iframe", "object", "audio",
     "video", "canvas", "svg", "math", "datalist", "meta", "link", "base", "area", "param", "source", "track")
)
APART = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "pre", "blockquote", "figure", "hr", "menu"))
BLOCK = APART | frozenset(
    ("address", "article", "aside", "body", "center", "details", "dialog", "dir", "div", "dd", "dt", "fieldset",
     "figcaption", "footer", "form", "header", "hgroup", "html", "legend", "li", "main", "nav", "optgroup", "option",
     "search", "section", "summary", "caption", "tr", "td", "th", "thead", "tbody", "tfoot", "xmp")
)
# Start tag -> open elements that it ends, and elements that it does not look beyond.
_CELL, _ROW = frozenset(("td", "th")), frozenset(("tr",))
_GROUP = frozenset(("thead", "tbody", "tfoot", "caption", "colgroup"))
_TABLE = frozenset(("table", "template", "html"))
ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir")) | _TABLE | _CELL),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",)) | _TABLE | _CELL),
    "option": (frozenset(("option",)), frozenset(("select", "datalist", "optgroup")) | _TABLE),
    "optgroup": (frozenset(("optgroup", "option")), frozenset(("select",)) | _TABLE),
    "td": (_CELL | frozenset(("caption", "colgroup")), _TABLE | _ROW),
    "tr": (_CELL | _ROW | frozenset(("caption", "colgroup")), _TABLE),
    "tbody": (_CELL | _ROW | _GROUP, _TABLE),
    "body": (frozenset(("head",)), frozenset(("body",))),
}
ENDS |= {"dd": ENDS["dt"], "th": ENDS["td"]} | dict.fromkeys(("thead", "tfoot", "caption", "colgroup"), ENDS["tbody"])
_TABLE_PARTS = _CELL | _ROW | _GROUP | frozenset(("table",))
_END_LIMIT = frozenset(("table", "td", "th"))
_P_SCOPE = _TABLE | _CELL | frozenset(("caption", "button", "object"))
ENDS_P = BLOCK - frozenset(("html", "body", "option", "optgroup", "legend", "caption", "tr", "td", "th", "thead", "tbody", "tfoot"))
IN_HEAD = frozenset(("base", "link", "meta", "noscript", "script", "style", "template", "title"))

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(\s*+=\s*+)?")
_BETWEEN = re.compile(r"[\s/]*+")
_UNQUOTED = re.compile(r"[^\s>]*+")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_ODD_SPACE = re.compile(r"[\t\n\r\f]|  ")
_STYLE = re.compile(r"/\*(?:.*?\*/|.*)|\"(?:[^\"\\\n]|\\.)*+\"?|'(?:[^'\\\n]|\\.)*+'?|[{};]|[^{};\"'/]++|/", re.S)
_AT_RULE = re.compile(r"@([\w-]+)(.*)", re.S)
_LENGTH = r"(\d*\.?\d+)(px|r?em)?"
_BOUND = re.compile(rf"(min-|max-)?(?:device-)?(width|height)\s*:\s*{_LENGTH}")
_RANGE = re.compile(rf"(?:{_LENGTH}\s*([<>]=?)\s*)?(width|height)(?:\s*([<>]=?|=)\s*{_LENGTH})?")
_FEATURES = {
    "orientation": "landscape", "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "hover": "hover",
    "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "scripting": "enabled", "forced-colors": "none",
}
_HIDES = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
_SELECTOR = re.compile(r"(?:[a-zA-Z][\w-]*)?(?:[.#][\w-]+)?")


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


class _Tags:
    """The tags of a page. A quote opens a value only behind an equals sign and if it is closed again."""

    def __init__(self, html: str):
        self.html = html
        self.last = {q: html.rfind(q) for q in "\"'>"}
        self.open: set[int] = set()  # places between attributes from where no tag ends

    def read(self, lt: int) -> tuple[bool, str, dict[str, str], bool, int] | None:
        """End tag or not, name, attributes, whether a slash ends it, and the place behind it."""
        html, found = self.html, _NAME.match(self.html, lt)
        if not found or self.last[">"] < lt:
            return None
        values: dict[str, str] = {}
        at, passed, slash = found.end(), [], False
        while at not in self.open:
            passed.append(at)
            gap = _BETWEEN.match(html, at)
            at = gap.end()
            if html.startswith(">", at):
                return bool(found[1]), found[2].lower(), values, slash or gap[0].endswith("/"), at + 1
            name = _ATTRIBUTE.match(html, at)
            if not name:
                break
            at, value, slash = name.end(), "", False
            if name[2]:
                quote = html[at : at + 1]
                if quote in ("'", '"') and self.last[quote] > at:
                    end = html.find(quote, at + 1)
                    value, at = html[at + 1 : end], end + 1
                else:
                    value = _UNQUOTED.match(html, at)[0]
                    at, slash = at + len(value), value.endswith("/")
            values.setdefault(name[1].lower(), unescape(value) if "&" in value else value)
        self.open.update(passed)
        return None


def parse(html: str) -> tuple[Element, list[str]]:
    """The tree, and the style sheets found on the way."""
    root, styles = Element("html", {}), []
    stack = [root]
    at, n = 0, len(html)
    tags = _Tags(html)

    def add(text: str) -> None:
        if text:
            if stack[-1].tag == "head" and not text.isspace():
                stack.pop()
            stack[-1].children.append(unescape(text) if "&" in text else text)

    def close(ended: frozenset, beyond: frozenset) -> None:
        """End the outermost open element among ``ended`` that lies within ``beyond``."""
        cut = 0
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in beyond:
                break
            if stack[k].tag in ended:
                cut = k
        if cut:
            del stack[cut:]

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        if html.startswith("<!--", lt):
            add(html[at:lt])
            end = html.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), lt):
            add(html[at:lt])
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        found = tags.read(lt)
        if not found:
            add(html[at : lt + 1])
            at = lt + 1
            continue
        add(html[at:lt])
        ends, tag, attributes, slash, at = found
        if ends:
            if tag == "br":
                stack[-1].children.append(Element("br", {}))
            elif tag == "p" and not any(e.tag == "p" for e in stack):
                stack[-1].children.append(Element("p", {}))
            elif tag not in ("html", "body"):
                limit = _END_LIMIT if tag not in _TABLE_PARTS else frozenset() if tag == "table" else _TABLE
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
                    if stack[k].tag in limit:
                        break
            continue
        if tag in ("html", "body") and any(e.tag == tag for e in stack[1:] if tag == "body"):
            continue
        if tag == "html":
            root.attributes = attributes | root.attributes
            continue
        if tag not in IN_HEAD and stack[-1].tag == "head":
            stack.pop()
        if tag in ENDS_P:
            close(frozenset(("p",)), _P_SCOPE)
        if tag in ENDS:
            close(*ENDS[tag])
        if tag[0] == "h" and tag[1:].isdigit() and stack[-1].tag[0] == "h" and stack[-1].tag[1:].isdigit():
            stack.pop()
        element = Element(tag, attributes)
        stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            stop = end.start() if end else n
            body = html[at:stop]
            if tag == "style":
                if _on_screen(attributes.get("media", "")):
                    styles.append(body)
            elif tag in ("textarea", "title"):
                body = unescape(body)
            element.children.append(body)
            close_at = html.find(">", stop)
            at = n if not end or close_at < 0 else close_at + 1
        elif tag not in VOID and not slash | (len(stack) > MOST_DEPTH):
            stack.append(element)
        elif tag not in VOID and tag in BLOCK | {"a", "b", "i", "span", "em", "strong"} and len(stack) <= MOST_DEPTH:
            stack.append(element)  # a slash does not end an element of HTML
    return root, styles


def _feature(text: str) -> bool | None:
    """Whether a condition in parentheses holds on ``SCREEN``; None if that is not known."""
    text = text.strip()
    pixels = lambda number, unit: float(number) * (1 if unit == "px" or not unit else 16)
    if bound := _BOUND.fullmatch(text):
        size, limit = SCREEN[bound[2]], pixels(bound[3], bound[4])
        return size >= limit if bound[1] == "min-" else size <= limit if bound[1] else size == limit
    if within := _RANGE.fullmatch(text):
        size, holds = SCREEN[within[4]], True
        low, high = within[1] and pixels(within[1], within[2]), within[6] and pixels(within[6], within[7])
        for a, sign, b in ((low, within[3], size), (size, within[5], high)):
            if sign:
                holds = holds and (a < b if sign == "<" else a <= b if sign == "<=" else a > b if sign == ">" else a >= b if sign == ">=" else a == b)
        return holds
    name, _, value = (part.strip() for part in text.partition(":"))
    if name not in _FEATURES:
        return None
    return _FEATURES[name] == value if value else _FEATURES[name] != "none"


def _on_screen(queries: str) -> bool:
    """Whether a list of media queries surely holds on a screen; an empty one does."""

    def holds(query: str) -> bool | None:
        query = query.strip()
        if query.startswith("not ") or query.startswith("not("):
            own = holds(query[3:])
            return None if own is None else not own
        every: bool | None = True
        for part in re.split(r"\band\b", query.removeprefix("only ")):
            part = part.strip()
            if part.startswith("(") and part.endswith(")"):
                own = _feature(part[1:-1])
            else:
                own = part in ("all", "screen") if re.fullmatch(r"[a-z-]+", part) else None
            if own is False:
                return False
            every = every and own
        return every

    plain = queries.lower().strip()
    return not plain or any(holds(query) for query in re.split(r",|\bor\b", plain))


def _declarations(sheet: str) -> Iterator[tuple[str, str]]:
    """Selectors and one declaration each, of the rules that hold on a screen.

    Rules inside other rules are relative to these, hence not simple, and are left out. So are at-rules
    whose condition is not known to hold.
    """
    blocks: list[tuple[bool, str]] = [(True, "")]  # whether it holds, and its selectors
    text: list[str] = []
    for token in _STYLE.findall(sheet):
        if token == "{":
            before = "".join(text).strip()
            holds, selectors = blocks[-1]
            if rule := _AT_RULE.fullmatch(before):
                name, condition = rule[1].lower(), rule[2]
                if name == "media":
                    holds = holds and _on_screen(condition)
                elif name == "supports":
                    holds = holds and not re.search(r"\bnot\b(?!-)", condition, re.I)
                else:
                    holds = holds and name == "layer"
            else:
                holds, selectors = holds and not selectors, before
            blocks.append((holds, selectors))
            text = []
        elif token in (";", "}"):
            if blocks[-1][0] and blocks[-1][1]:
                yield blocks[-1][1], "".join(text)
            if token == "}" and len(blocks) > 1:
                blocks.pop()
            text = []
        else:
            text.append(" " if token.startswith("/*") else token)
    if blocks[-1][0] and blocks[-1][1]:
        yield blocks[-1][1], "".join(text)


def _hidden_selectors(styles: list[str]) -> frozenset[str]:
    """Simple selectors (tag, class, id or a tag with one of them) whose rules hide."""
    hidden = set()
    for sheet in styles:
        for selectors, declaration in _declarations(sheet):
            if _HIDES.search(declaration):
                hidden.update(s.strip() for s in selectors.split(",") if s.strip() and _SELECTOR.fullmatch(s.strip()))
    return frozenset(hidden)


def _hidden(element: Element, selectors: frozenset[str]) -> bool:
    if element.tag in UNSEEN:
        return True
    own = element.attributes
    if own:
        if "hidden" in own or element.tag == "dialog" and "open" not in own:
            return True
        if element.tag == "input" and own.get("type", "").lower() == "hidden":
            return True
        if "style" in own and _HIDES.search(own["style"]):
            return True
    elif element.tag == "dialog":
        return True
    if selectors:
        if element.tag in selectors:
            return True
        names = ["." + c for c in own.get("class", "").split()] + (["#" + own["id"]] if own.get("id") else [])
        return any(n in selectors or element.tag + n in selectors for n in names)
    return False


class _Page:
    """Lines written so far, the line being written, and the space or blank line still owed."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.blank = False

    def text(self, text: str, kept: bool = False) -> None:
        if kept:
            first, *rest = text.split("\n")
            self.put(first)
            for line in rest:
                self.end(keep=True)
                self.put(line)
            return
        if not text:
            return
        body = _SPACE.sub(" ", text) if _ODD_SPACE.search(text) else text
        if body[0] == " ":
            self.space = True
        inner = body.strip(" ")
        if inner:
            self.put((" " if self.space and self.line else "") + inner)
            self.space = body[-1] == " "

    def put(self, text: str) -> None:
        if text:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.line.append(text)

    def end(self, keep: bool = False) -> None:
        if self.line or keep:
            self.lines.append("".join(self.line))
        self.line, self.space = [], False

    def apart(self) -> None:
        self.end()
        self.blank = True

    def add(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Finished lines below one another, behind a prefix."""
        self.end()
        for k, line in enumerate(lines):
            prefix = first if k == 0 else rest
            self.put((prefix + line) if line else prefix.rstrip() or "")
            self.end(keep=not line)

    def done(self) -> list[str]:
        self.end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _lines(children: list, selectors: frozenset[str], kept: bool = False) -> list[str]:
    page = _Page()
    _render(children, page, selectors, kept)
    return page.done()


def _render(children: list, page: _Page, selectors: frozenset[str], kept: bool = False) -> None:
    number = 0
    for child in children:
        if isinstance(child, str):
            page.text(child, kept)
            continue
        if _hidden(child, selectors):
            continue
        tag = child.tag
        if tag == "br":
            page.end(keep=True)
        elif tag == "hr":
            page.apart()
        elif tag == "img":
            page.text(child.attributes.get("alt", ""))
        elif tag == "input":
            if child.attributes.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number"):
                page.text(child.attributes.get("value", ""))
        elif tag == "table":
            page.apart()
            page.add(_table(child, selectors))
            page.apart()
        elif tag in ("ul", "ol", "menu", "dir"):
            nested = bool(page.line) or page.lines == []
            page.end() if nested else page.apart()
            page.add(_list(child, selectors))
            page.blank = page.blank or not nested
        elif tag in ("pre", "xmp", "textarea"):
            page.apart()
            lines = _lines(child.children, selectors, kept=True)
            page.add(lines[1:] if lines and not lines[0] else lines)
            page.apart()
        elif tag == "blockquote":
            page.apart()
            page.add(_lines(child.children, selectors), "> ", "> ")
            page.apart()
        elif tag == "dd":
            page.add(_lines(child.children, selectors), "  ", "  ")
        elif tag == "li":
            number += 1
            page.add(_lines(child.children, selectors), "- ", "  ")
        elif tag in APART:
            page.apart()
            _render(child.children, page, selectors, kept)
            page.apart()
        elif tag in BLOCK:
            page.end()
            _render(child.children, page, selectors, kept)
            page.end()
        else:
            _render(child.children, page, selectors, kept)


def _list(element: Element, selectors: frozenset[str]) -> list[str]:
    page = _Page()
    ordered, start = element.tag == "ol", element.attributes.get("start", "1")
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    for child in element.children:
        if isinstance(child, Element) and child.tag == "li":
            if not _hidden(child, selectors):
                mark = f"{number}. " if ordered else "- "
                page.add(_lines(child.children, selectors) or [""], mark, " " * len(mark))
            number += 1
        else:
            _render([child], page, selectors)
    return page.done()


def _span(element: Element, name: str) -> int:
    value = element.attributes.get(name, "1")
    return min(1000, max(1, int(value))) if re.fullmatch(r"\d{1,6}", value) else 1


def _table(table: Element, selectors: frozenset[str]) -> list[str]:
    """Rows of cells in columns as wide as their widest line; other content first, in its own lines."""
    before, rows = _Page(), []

    def gather(children: list) -> None:
        for child in children:
            if isinstance(child, str):
                before.text(child)
            elif _hidden(child, selectors) or child.tag in ("col", "colgroup"):
                continue
            elif child.tag in ("thead", "tbody", "tfoot"):
                gather(child.children)
            elif child.tag == "tr":
                rows.append(child.children)
            elif child.tag in _CELL:
                rows.append([child])
            else:
                _render([child], before, selectors)

    gather(table.children)
    grid: list[dict[int, list[str]]] = []
    taken: dict[int, int] = {}  # column -> rows that a cell above still covers
    wide: dict[int, int] = {}
    for cells in rows:
        row, column = {}, 0
        below: dict[int, int] = {}
        for cell in cells:
            if isinstance(cell, str) or cell.tag not in _CELL:
                _render([cell], before, selectors)
                continue
            if _hidden(cell, selectors):
                continue
            while taken.get(column, 0):
                column += 1
            lines, across, down = _lines(cell.children, selectors), _span(cell, "colspan"), _span(cell, "rowspan")
            row[column] = lines
            if across == 1:
                wide[column] = max(wide.get(column, 0), *map(len, lines), 0)
            for k in range(column, column + across):
                wide.setdefault(k, 0)
                if down > 1:
                    below[k] = down - 1
            column += across
        taken = {k: v - 1 for k, v in taken.items() if v > 1} | below
        if any(row.values()):
            grid.append(row)
    columns = sorted(k for k in wide if wide[k] or any(row.get(k) for row in grid))
    out = before.done()
    for row in grid:
        for k in range(max(map(len, row.values()))):
            line = "  ".join((row[c][k] if c in row and k < len(row[c]) else "").ljust(wide[c]) for c in columns)
            out.append(line.rstrip())
    return out


def visible_text(html: str) -> str:
    """What a reader of the page sees, as lines. Collapsed ``details`` count as seen."""
    root, styles = parse(html)
    return "\n".join(_lines(root.children, _hidden_selectors(styles)))


def with_visible_text(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """All columns of ``pages`` but the page source, and its visible text.

    Null and empty sources give an empty text; repeated rows stay; the name must be free.
    """
    others = [c for c in pages.columns if c != html]
    if name.lower() in {c.lower() for c in others}:
        raise ValueError(f"there is a column {name} already")
    body = free_name([*others, name], "body")
    source = pages.select(*[F.col(f"`{c}`") for c in others], F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias(body))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([visible_text(t.as_py()) for t in batch.column(batch.num_columns - 1)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*batch.schema.names[:-1], name])

    return source.mapInArrow(render, source.drop(body).withColumn(name, F.lit("")).schema)
