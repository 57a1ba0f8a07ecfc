"""HTML to text by layout: all visible text, with block spacing, lists and tables.

A tokenizer feeds a tree builder that closes elements implicitly as browsers do
(a ``li`` ends the ``li`` before it, a block ends a paragraph, a row ends a cell, what
cannot stand in the head ends the head). A closing slash counts on ``svg`` and ``math``
and in them only.
The builder's open elements carry the visibility rules, and the renderer writes
text as elements open and close, so nesting of any depth needs no recursion.

Defined results: a NULL page counts as empty, an empty page gives empty text; an
unfinished tag or comment at the end is dropped; elements left open end with the
page; rows are independent; other columns are dropped. Cells are padded to their
column's width up to ``PAD`` characters, so padding stays in proportion to the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import slices, text_or_empty

# Fixed values from the HTML standard: element classes.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head title script style template noscript iframe object video audio canvas svg math datalist".split()
)
RAW = frozenset("script style textarea title iframe noscript xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre section "
    "summary table caption tr ul".split()
)
SPACED = frozenset("h1 h2 h3 h4 h5 h6 p ul ol dl table blockquote pre figure".split())
ENDS_P = BLOCK - frozenset("body html option optgroup tr caption legend".split()) | {"hr"}
# What a start tag ends, and the elements that this does not reach beyond.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
}
PAD = 60

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']|"[^"]*"|'[^']*')*+)>""")
_SPACE = re.compile(r"[ \t\n\f\r]+")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_UNQUOTED_END = re.compile(r"=\s*[^\s\"]*/$")
_HIDDEN_ATTRIBUTE = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)""", re.I)
_STYLE = re.compile(r"""(?:^|\s)style\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NONE = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)


class _Element:
    __slots__ = ("tag", "gone", "unseen", "pre", "count")

    def __init__(self, tag: str, attributes: str, parent: _Element | None):
        style = ""
        if attributes:
            found = _STYLE.search(attributes)
            style = html.unescape(found[1].strip("\"'")) if found else ""
        bare = _STYLE.sub(" ", attributes) if attributes else ""
        self.tag = tag
        self.gone = (
            (parent is not None and parent.gone)
            or tag in HIDDEN
            or bool(bare and _HIDDEN_ATTRIBUTE.search(re.sub(r"\"[^\"]*\"|'[^']*'", "", bare)))
            or (tag == "dialog" and not re.search(r"\bopen\b", bare))
            or bool(style and _NONE.search(style))
        )
        own = _VISIBILITY.search(style) if style else None
        self.unseen = own[1].lower() != "visible" if own else parent is not None and parent.unseen
        self.pre = tag in ("pre", "textarea", "xmp") or (parent is not None and parent.pre)
        self.count = 0


class _Flow:
    """Lines of a page or a cell; text collects in ``line`` until a block ends it."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.prefix, self.gap = "", False

    def text(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.split("\n")
            self.line.append(first)
            for part in rest:
                self.close(keep=True)
                self.line.append(part)
            return
        text = _SPACE.sub(" ", text)
        if text == " " and not self.line:
            return
        if text and text[0] == " " and (not self.line or self.line[-1].endswith(" ")):
            text = text[1:]
        if text:
            self.line.append(text)

    def close(self, keep: bool = False, indent: str = "") -> None:
        text = "".join(self.line).rstrip(" ")
        self.line = []
        if text or keep:
            if self.gap and self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap = False
            self.lines.append(indent + self.prefix + text if text else "")
            self.prefix = ""

    def space(self) -> None:
        self.gap = True

    def done(self) -> str:
        self.close()
        return "\n".join(self.lines).strip("\n")


class _Table:
    def __init__(self):
        self.rows: list[list[str]] = []

    def lines(self) -> list[str]:
        widths: list[int] = []
        for row in self.rows:
            for i, cell in enumerate(row):
                if i == len(widths):
                    widths.append(0)
                widths[i] = max(widths[i], min(len(cell), PAD))
        aligned = ("  ".join(c.ljust(w) for c, w in zip(row, widths, strict=False)).rstrip() for row in self.rows)
        return [line for line in aligned if line]


class Page:
    """Builds the tree of one page and renders it."""

    def __init__(self):
        self._open: list[_Element] = []
        self._counts: dict[str, int] = {}
        self._flows, self._tables = [_Flow()], []
        self.blocks = self.tables = 0

    # Tree builder

    def feed(self, source: str) -> str:
        at, size = 0, len(source)
        while at < size:
            lt = source.find("<", at)
            if lt < 0:
                self._text(source[at:])
                break
            if lt > at:
                self._text(source[at:lt])
            after = source[lt + 1 : lt + 2]
            if source.startswith("<!--", lt):
                end = source.find("-->", lt + 4)
                at = size if end < 0 else end + 3
            elif after in ("!", "?"):
                end = source.find(">", lt)
                at = size if end < 0 else end + 1
            elif (found := _TAG.match(source, lt)) is not None:
                at = found.end()
                tag = found[2].lower()
                if found[1]:
                    self._end(tag)
                    continue
                if self._start(tag, found[3]):
                    continue
                if tag in RAW:
                    close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                    stop = close.start() if close else size
                    self._text(source[at:stop])
                    at = stop
                    if not close:
                        break
            elif re.match(r"</?[a-zA-Z]", source[lt : lt + 3]):
                end = source.find(">", lt)
                at = size if end < 0 else end + 1
            elif after == "/":
                end = source.find(">", lt)
                at = size if end < 0 else end + 1
            else:
                self._text("<")
                at = lt + 1
        while self._open:
            self._close()
        return self._flows[0].done()

    def _end_implied(self, ends: set[str], bounds: set[str]) -> None:
        """Closes the open elements up to the outermost of ``ends`` within the bounds."""
        depth = None
        for i in range(len(self._open) - 1, -1, -1):
            tag = self._open[i].tag
            if tag in bounds:
                break
            if tag in ends:
                depth = i
        if depth is not None:
            while len(self._open) > depth:
                self._close()

    def _foreign(self, tag: str) -> bool:
        """Whether an element that begins here is of a drawing or formula, not of the page."""
        if tag in ("svg", "math"):
            return True
        if not (self._counts.get("svg") or self._counts.get("math")):
            return False
        bounds = ("svg", "math", "foreignobject", "annotation-xml", "desc")
        return next(e.tag for e in reversed(self._open) if e.tag in bounds) in ("svg", "math")

    def _start(self, tag: str, attributes: str) -> bool:
        """Opens an element; true if its own tag closes it."""
        if tag in ("html", "body") and self._counts.get(tag):
            return False
        if tag not in IN_HEAD and tag not in ("html", "head") and self._open and self._open[-1].tag == "head":
            self._close()
        if attributes.endswith("/") and self._foreign(tag) and not _UNQUOTED_END.search(_QUOTED.sub('""', attributes)):
            return True
        if tag in ENDS_P and self._counts.get("p"):
            self._end_implied({"p"}, {"table", "td", "th", "caption", "button", "object"})
        if tag in IMPLIED and any(self._counts.get(t) for t in IMPLIED[tag][0]):
            self._end_implied(*IMPLIED[tag])
        element = _Element(tag, attributes, self._open[-1] if self._open else None)
        if tag == "body" and self._counts.get("head"):
            self._end("head")
            element = _Element(tag, attributes, self._open[-1] if self._open else None)
        if tag in VOID:
            if not (element.gone or element.unseen):
                self._void(tag)
            return False
        self._open.append(element)
        self._counts[tag] = self._counts.get(tag, 0) + 1
        self._opened(element)
        return False

    def _end(self, tag: str) -> None:
        if tag in VOID or not self._counts.get(tag):
            if tag == "br":
                self._void("br")
            return
        in_cell = tag not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "html", "body")
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i].tag == tag:
                while len(self._open) > i:
                    self._close()
                return
            if in_cell and self._open[i].tag in ("td", "th", "caption"):
                return  # an end tag does not close what contains its cell

    def _close(self) -> None:
        element = self._open.pop()
        self._counts[element.tag] -= 1
        self._closed(element)

    # Renderer

    def _text(self, raw: str) -> None:
        top = self._open[-1] if self._open else None
        if top is not None and top.tag == "head" and _SPACE.sub("", raw):
            self._close()
            top = self._open[-1] if self._open else None
        if top is not None and (top.gone or top.unseen):
            return
        text = raw if top is not None and top.tag == "xmp" else html.unescape(raw) if "&" in raw else raw
        self._flows[-1].text(text, top is not None and top.pre)

    def _indent(self) -> str:
        return "  " * max(0, self._counts.get("ul", 0) + self._counts.get("ol", 0) - 1)

    def _void(self, tag: str) -> None:
        flow = self._flows[-1]
        if tag == "br":
            flow.close(keep=True)
        elif tag == "hr":
            flow.close()
            flow.space()

    def _opened(self, element: _Element) -> None:
        if element.gone:
            return
        tag, flow = element.tag, self._flows[-1]
        if tag == "table":
            flow.close()
            flow.space()
            self._tables.append(_Table())
            self.tables += 1
        elif tag == "tr" and self._tables:
            self._tables[-1].rows.append([])
        elif tag in ("td", "th") and self._tables:
            self._flows.append(_Flow())
        elif tag in BLOCK:
            flow.close()
            if tag in SPACED and not (tag in ("ul", "ol") and self._counts.get("li")):
                flow.space()
            if tag == "li":
                owner = next((e for e in reversed(self._open[:-1]) if e.tag in ("ul", "ol", "menu", "dir")), None)
                if owner is not None and owner.tag == "ol":
                    owner.count += 1
                    flow.prefix = f"{self._indent()}{owner.count}. "
                else:
                    flow.prefix = f"{self._indent()}- "
            self.blocks += 1

    def _closed(self, element: _Element) -> None:
        if element.gone:
            return
        tag = element.tag
        if tag in ("td", "th") and self._tables and len(self._flows) > 1:
            cell = _SPACE.sub(" ", self._flows.pop().done()).strip()
            table = self._tables[-1]
            if not table.rows:
                table.rows.append([])
            table.rows[-1].append(cell)
        elif tag == "table" and self._tables:
            flow, lines = self._flows[-1], self._tables.pop().lines()
            flow.close()
            for line in lines:
                flow.line.append(line)
                flow.close()
            flow.space()
        elif tag in BLOCK and tag != "tr":
            flow = self._flows[-1]
            flow.close()
            if tag == "li":
                flow.prefix = ""
            if tag in SPACED and not (tag in ("ul", "ol") and self._counts.get("li")):
                flow.space()


def render(source: str) -> tuple[str, int, int]:
    """The visible text of a page, its number of blocks and of tables."""
    page = Page()
    text = page.feed(source)
    return text, page.blocks, page.tables


def extract(pages: DataFrame) -> DataFrame:
    """Per page its text, characters, blocks and tables."""
    rows = pages.select(F.col("page_id").cast("long"), text_or_empty("html").alias("_html"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "_html"):
            made = [render(h) for h in frame["_html"]]
            yield pd.DataFrame(
                {
                    "page_id": frame["page_id"].astype("Int64"),
                    "text": pd.Series([m[0] for m in made], index=frame.index, dtype=object),
                    "n_chars": [len(m[0]) for m in made],
                    "n_blocks": [m[1] for m in made],
                    "n_tables": [m[2] for m in made],
                }
            )

    return rows.mapInPandas(run, "page_id long, text string, n_chars long, n_blocks long, n_tables long")
