"""HTML extraction by layout-aware rendering.

Method. A tree builder turns a page's tags into elements, with the end tags that HTML leaves out
(paragraphs, list items, table parts, options) and without invisible parts (scripts, styles, the head,
``hidden``, ``display:none``, ``visibility:hidden``, closed dialogs). All other text is rendered:
white space collapses except in preformatted text; blocks begin on new lines, paragraphs and
headings after an empty line; list items have a mark and an indent; the cells of a table
row stand in columns of equal width, preformatted lines of a cell below each other. No text is dropped for its length or place (no boilerplate rules).

Both steps are loops over explicit stacks, so deep nesting is no problem. A page is one row; pages
are independent, so this is one pass without a shuffle.

Cases: NULL html gives NULL text, empty html empty text. Malformed markup is read to the end of
the page; unclosed elements end with it, and so do, as in HTML, a comment or an end tag that never ends. Repeated rows give equal texts; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import by_value

by_value(__name__)

#: Element names of HTML by their part in layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INVISIBLE = frozenset("head title script style template noscript iframe object canvas svg audio video datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl table pre figure".split())
BLOCKS = SPACED | frozenset("address article aside body caption center dd details dialog div dt fieldset figcaption footer form "
                            "header hgroup hr html legend li main menu nav option optgroup search section summary tr".split())
#: A start tag ends an open element of the listed names, up to a boundary element.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"),
        "optgroup": ("option optgroup", "select"), "tr": ("tr td th caption colgroup", "table"), "td": ("td th", "table tr"), "th": ("td th", "table tr"),
        **{t: ("thead tbody tfoot tr td th caption colgroup", "table") for t in ("thead", "tbody", "tfoot")}}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
#: Block elements inside which a new block does not end an outer paragraph.
PARAGRAPH_SCOPE = frozenset("td th table button li dd dt div article section body".split())
#: What may stand in the head; anything else ends one that is still open.
HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
#: Elements of other languages, in which a slash ends an element, and those in them that hold HTML again.
FOREIGN = frozenset(["svg", "math"])
HTML_AGAIN = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
#: Elements whose content is text up to their end tag; in the first two, character references count.
TEXT_ONLY = {"textarea": True, "title": True, "xmp": False, "iframe": False, "noembed": False, "noframes": False}
PAD = 40
COMMENT_END = re.compile(r"--!?>")
#: The end of a tag, or a quoted value, in which ``>`` ends nothing.
TAG_END = re.compile(r""">|=[ \t\n\r\f]*(?:"[^"]*"|'[^']*')""")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


class Element:
    __slots__ = ("tag", "attrs", "children", "foreign")

    def __init__(self, tag: str, attrs: dict, foreign: bool = False) -> None:
        self.tag, self.attrs, self.children, self.foreign = tag, attrs, [], foreign

    def hidden(self) -> bool:
        a = self.attrs
        return (self.tag in INVISIBLE or "hidden" in a or self.tag == "dialog" and "open" not in a
                or bool(HIDDEN_STYLE.search(a.get("style") or "")))


class TreeBuilder(HTMLParser):
    """Elements and texts of a page, with implied end tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.open = [self.root]

    def close_to(self, names: frozenset, scope: frozenset) -> None:
        """End the open elements down to the outermost of ``names`` above the next ``scope`` element."""
        last = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in scope:
                break
            if self.open[i].tag in names:
                last = i
        if last is not None:
            del self.open[last:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body":
            self.close_to(frozenset(["head"]), frozenset(["template"]))
        if tag in ("html", "body"):
            return
        if tag in ENDS:
            self.close_to(*ENDS[tag])
        elif tag in BLOCKS:
            self.close_to(frozenset(["p"]), PARAGRAPH_SCOPE)
        if self.open[-1].tag == "head" and tag not in HEAD:
            self.open.pop()
        parent = self.open[-1]
        element = Element(tag, dict(attrs), tag in FOREIGN or parent.foreign and parent.tag not in HTML_AGAIN)
        self.open[-1].children.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash
        if tag not in VOID and self.open[-1].tag == tag and self.open[-1].foreign:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip(" \t\n\r\f"):
            self.open.pop()
        self.open[-1].children.append(data)

    def parse_comment(self, i: int, report: bool = True) -> int:
        """``<!-->`` and ``<!--->`` are empty comments, ``--!>`` ends one too, and an open one holds the rest."""
        for empty in ("<!-->", "<!--->"):
            if self.rawdata.startswith(empty, i):
                return i + len(empty)
        end = COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def parse_bogus_comment(self, i: int, report: bool = True) -> int:
        end = self.rawdata.find(">", i + 2)
        return end + 1 if end >= 0 else len(self.rawdata)

    def parse_pi(self, i: int) -> int:
        return self.parse_bogus_comment(i)

    def parse_endtag(self, i: int) -> int:
        """End tags may hold attributes with ``>`` in quotes; one that never ends holds the rest."""
        if self.cdata_elem is not None or not self.rawdata[i + 2: i + 3].isascii() or not self.rawdata[i + 2: i + 3].isalpha():
            return super().parse_endtag(i)
        for part in TAG_END.finditer(self.rawdata, i):
            if part.group() == ">":
                self.handle_endtag(re.match(r"[^ \t\n\r\f/>]+", self.rawdata[i + 2: part.start()]).group().lower())
                return part.end()
        return len(self.rawdata)

    def parse_starttag(self, i: int) -> int:
        end = super().parse_starttag(i)
        if end < 0 or self.lasttag not in TEXT_ONLY or self.open[-1].tag != self.lasttag or self.open[-1].foreign:
            return end
        close = re.compile(f"</{self.lasttag}(?=[ \\t\\n\\r\\f/>])", re.I).search(self.rawdata, end)
        stop = close.start() if close else len(self.rawdata)
        text = self.rawdata[end:stop]
        self.handle_data(unescape(text) if TEXT_ONLY[self.lasttag] else text)
        return stop

    def parse_html_declaration(self, i: int) -> int:
        """``<![`` begins a comment up to the next ``>``, and a CDATA section in other languages only."""
        if not self.rawdata.startswith("<![", i):
            return super().parse_html_declaration(i)
        if self.open[-1].foreign and self.rawdata.startswith("<![CDATA[", i):
            end = self.rawdata.find("]]>", i)
            self.handle_data(self.rawdata[i + 9: end if end >= 0 else None])
            return end + 3 if end >= 0 else len(self.rawdata)
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)


class Page:
    """Lines of rendered text; inline text gathers until a block begins or ends."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.indent, self.mark, self.blank = 0, "", False

    def flush(self) -> None:
        text = "".join(self.inline)
        self.inline = []
        # Form feeds stand for forced line breaks while white space collapses.
        for part in text.split("\f") if text.strip(" \f") else []:
            self.put(re.sub(r"[ \t\n\r\v]+", " ", part).strip(" "))

    def put(self, line: str) -> None:
        if not line and not self.mark:
            return
        if self.blank and self.lines and not self.mark_only():
            self.lines.append("")
        self.blank = False
        self.lines.append(" " * max(0, self.indent - len(self.mark)) + self.mark + line)
        self.mark = ""

    def mark_only(self) -> bool:
        return self.lines[-1] == ""

    def block(self, spaced: bool) -> None:
        self.flush()
        if spaced and not self.indent:
            self.blank = True


def cell_lines(cell: Element) -> list[str]:
    """A table cell: one line, and one more for each line of preformatted text in it."""
    lines, out, stack = [], [], [cell]

    def end_line() -> None:
        text = " ".join("".join(out).split())
        out.clear()
        if text:
            lines.append(text)

    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out.append(node)
        elif not node.hidden():
            if node.tag == "pre":
                end_line()
                kept = [line.rstrip() for line in re.split(r"\r\n?|\n", plain_text(node))]
                lines.extend(line for line in kept if line)
                continue
            out.append(" " if node.tag in BLOCKS or node.tag in ("br", "td", "th") else "")
            if node.tag in BLOCKS or node.tag in ("td", "th"):
                stack.append(" ")
            stack.extend(reversed(node.children))
    end_line()
    return lines


def plain_text(element: Element) -> str:
    """The visible text in an element as it stands."""
    out, stack = [], list(reversed(element.children))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out.append(node)
        elif node.tag == "br":
            out.append("\n")
        elif not node.hidden():
            stack.extend(reversed(node.children))
    return "".join(out)


def table_lines(table: Element) -> tuple[list[str], list]:
    """(aligned rows of a table, its children that are no rows or cells)."""
    rows, rest, stack = [], [], list(reversed(table.children))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            if node.strip():
                rest.append(node)
        elif node.hidden() or node.tag in ("colgroup", "col"):
            continue
        elif node.tag in ("thead", "tbody", "tfoot"):
            stack.extend(reversed(node.children))
        elif node.tag == "tr":
            cells = []
            for c in node.children:
                if isinstance(c, str):
                    cells += [[c.strip()]] if c.strip() else []
                elif not c.hidden():
                    span = c.attrs.get("colspan") or "1"
                    cells += [cell_lines(c)] + [[]] * (min(100, int(span)) - 1 if span.isdecimal() else 0)
            rows.append(cells)
        else:
            rest.append(node)
    width: dict[int, int] = {}
    for cells in rows:
        for i, c in enumerate(cells):
            width[i] = max([width.get(i, 0)] + [min(PAD, len(line)) for line in c])
    return ["  ".join((c[n] if n < len(c) else "").ljust(width[i]) for i, c in enumerate(cells)).rstrip()
            for cells in rows for n in range(max([1] + [len(c) for c in cells]))], rest


def render(root: Element) -> str:
    """The visible text of a tree."""
    page = Page()
    lists: list[list] = []
    stack: list[tuple[str, object]] = [("in", root)]
    preformatted = 0
    while stack:
        step, node = stack.pop()
        if isinstance(node, str):
            if preformatted:
                page.inline.append(re.sub(r"\r\n?|\n", "\f", node).replace(" ", "\xa0"))
            else:
                page.inline.append(node.replace("\f", " "))
            continue
        tag = node.tag
        if step == "out":
            page.block(tag in SPACED)
            if tag in ("ul", "ol", "menu"):
                lists.pop()
                page.indent -= 2
                page.mark = ""
            elif tag == "pre":
                preformatted -= 1
            continue
        if node.hidden():
            continue
        if tag == "br":
            page.inline.append("\f")
            continue
        if tag == "table":
            page.block(True)
            lines, rest = table_lines(node)
            for child in rest:
                for line in [child] if isinstance(child, str) else cell_lines(child):
                    page.inline.append(line)
                    page.flush()
            for line in lines:
                page.put(line)
            page.block(True)
            continue
        if tag in BLOCKS:
            page.block(tag in SPACED)
            stack.append(("out", node))
            if tag in ("ul", "ol", "menu"):
                lists.append([tag, 0])
                page.indent += 2
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 0]
                kind[1] += 1
                page.mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
            elif tag == "pre":
                preformatted += 1
        elif tag in ("td", "th"):
            page.inline.append(" ")
        stack.extend(("in", c) for c in reversed(node.children))
    page.flush()
    return "\n".join(page.lines).replace("\xa0", " ")


def html_to_text(html: str | None) -> str | None:
    if html is None:
        return None
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return render(builder.root)


def text_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(0, whole.num_rows, 200):
            batch = whole.slice(i, 200)
            texts = [html_to_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(texts, pa.string())], ["page_id", "text"])


def page_texts(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, text."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"))
    return rows.mapInArrow(text_task, "page_id long, text string")
