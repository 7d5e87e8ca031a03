"""Visible text of web pages by a layout-aware rendering.

Tags are read into an open-element stack with implied tags (a new list item, table
row, cell, option, definition or block closes what it must; end tags close what they
match, unmatched ones are ignored; an open head ends at the first tag or text that cannot
stand in it, so a missing body is no matter). Invisible subtrees
are skipped: head matter, scripts, styles, templates, form controls without text,
elements with the attribute ``hidden`` or a style that ends up as ``display: none``; what a style makes
``visibility: hidden`` is skipped up to a descendant that is ``visible`` again. Attributes are read as browsers do: a quote opens a
value only after ``=``. Of a drop-down the option that it shows is emitted, of a list box
all that are not hidden. What remains is emitted in order: blocks start lines and paragraphs-like blocks leave one blank line, ``br``
breaks, ``pre`` keeps its white space, lists are indented with bullets or numbers,
and the cells of a table stand in the columns that their spans leave them, padded to common widths.

Elements are kept on a list with the places of every name, so any depth of nesting takes linear time. Lines over 80
characters widen no column, spanning cells widen none in tables of over 1000 columns, indentation ends at 80 characters and a table that would be over sixteen
times its text is not padded, so a page's text is bounded by its size.

Defined results: a null page gives null text; an empty page or one without visible
text gives an empty text; text outside any tag is visible; an unclosed tag or comment
runs to the end of the page; repeated rows give equal results; an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from salesflow.llm.common import text_slices

# fixed values: kinds of HTML elements
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style template noscript iframe object svg math canvas audio video datalist".split())
HEAD = frozenset("base link meta title style script noscript template".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr fieldset".split())
BLOCK = SPACED | frozenset("address article aside body center dd details dialog div dt fieldset figcaption footer form header hgroup html "
                           "legend li main nav search section summary tbody td tfoot th thead tr caption option".split())
#: a start tag closes an open element of these, up to (not beyond) the given scope
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
          "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
          "body": ({"head"}, set())}
_SCOPE = frozenset("table td th caption button template".split())

# names, each perhaps with a value: in quotes that stand right after the equals sign, else up to white space
_ATTRS = r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+)*+"
_MARKUP = re.compile(r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<other>[!?][^>]*)(?:>|\Z)|/(?P<end>[a-zA-Z][^\s/>]*)" + _ATTRS + r"(?:>|\Z)"
                     rf"|(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>{_ATTRS})(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?")
_MAY_HIDE = re.compile("hidden|style", re.I)
_CSS_NOISE = re.compile(r"/\*.*?(?:\*/|\Z)|\"[^\"]*\"|'[^']*'|\([^)]*\)", re.S)
_START = re.compile(r"start\s*=\s*[\"']?(-?\d{1,9})", re.I)
_WHITE = re.compile(r"[ \t\n\r\f]+")
_NUMBERED = re.compile(r"&#(?:([0-9]{8,});?|[xX]([0-9a-fA-F]{8,});?)")
_SPAN = re.compile(r"\s*\+?0*([0-9]{1,6})")
#: longest indentation, longest line that widens its column, columns in which cells can span rows
INDENT, SHORT, COLUMNS = 80, 80, 1000


def _reference(m: re.Match) -> str:
    digits = (m[1] or m[2]).lstrip("0")
    return "\ufffd" if len(digits) > 7 else f"&#{'' if m[1] else 'x'}{digits or '0'};"


def _unescape(text: str) -> str:
    """Character references; numbers beyond Unicode give U+FFFD, however many digits they have."""
    return html.unescape(_NUMBERED.sub(_reference, text) if "&#" in text else text) if "&" in text else text


def _span(held: dict[str, str], name: str, most: int) -> int:
    """A cell's colspan or rowspan; fixed limits of HTML."""
    found = _SPAN.match(held.get(name, ""))
    return min(max(int(found[1]), 1), most) if found else 1


def _attributes(attrs: str) -> dict[str, str]:
    """Values by lower-case name; the first of equal names counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attrs):
        out.setdefault(name.lower(), _unescape("".join(values)))
    return out


def _look(attrs: str) -> tuple[bool, bool | None]:
    """(not displayed, visible or not where its style says so)."""
    if not _MAY_HIDE.search(attrs):
        return False, None
    held = _attributes(attrs)
    # the last declaration of a property counts, an important one before others
    style: dict[str, tuple[bool, str]] = {}
    for declaration in _CSS_NOISE.sub(" ", held.get("style", "")).lower().split(";"):
        name, _, value = declaration.partition(":")
        value, _, important = (x.strip() for x in value.partition("!"))
        if value and (important == "important") >= style.get(name.strip(), (False, ""))[0]:
            style[name.strip()] = (important == "important", value)
    seen = style.get("visibility", (False, ""))[1]
    return "hidden" in held or style.get("display", (False, ""))[1] == "none", \
        True if seen == "visible" else False if seen in ("hidden", "collapse") else None


def _invisible(attrs: str) -> bool:
    gone, seen = _look(attrs)
    return gone or seen is False


def _shown(options: list[tuple[dict[str, str], bool, bool, str]], held: dict[str, str]) -> list[str]:
    """Texts that a select with attributes ``held`` shows; options: (attributes, disabled, invisible, text)."""
    rows = held.get("size", "").strip()
    if "multiple" in held or re.fullmatch("[0-9]+", rows) and rows.lstrip("0") not in ("", "1"):
        return [text for _, _, invisible, text in options if not invisible]
    chosen = [o for o in options if "selected" in o[0]][-1:] or [o for o in options if not o[1]][:1]
    return [o[3] for o in chosen]


class _Box:
    """Text under way: finished lines, the parts of the open line, and how many line ends are owed before more text."""

    __slots__ = ("lines", "line", "owed", "gap", "indent", "mark")

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.owed, self.gap, self.indent, self.mark = 0, False, "", ""

    def end_line(self, blank: bool) -> None:
        if self.line:
            self.lines.append(self.indent + "".join(self.line).rstrip(" "))
            self.line = []
        self.gap = False
        self.owed = max(self.owed, 2 if blank else 1)

    def _open(self) -> None:
        if not self.line:
            if self.owed > 1 and self.lines and self.lines[-1]:
                self.lines.append("")
            self.owed = 0
            if self.mark:
                self.line, self.mark = [self.mark], ""

    def inline(self, text: str) -> None:
        for i, word in enumerate(_WHITE.split(text)):
            if i:
                self.gap = True
            if word:
                fresh = not self.line
                self._open()
                if self.gap and not fresh:
                    self.line.append(" ")
                self.line.append(word)
                self.gap = False

    def preformatted(self, text: str) -> None:
        for i, row in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if i:
                self.lines.append(self.indent + "".join(self.line) if self.line else "")
                self.line, self.owed = [], 0
            if row:
                self._open()
                self.line.append(row)

    def break_line(self) -> None:
        self._open()
        self.lines.append(self.indent + "".join(self.line).rstrip(" ") if self.line else "")
        self.line, self.gap, self.owed = [], False, 0

    def block(self, rows: list[str]) -> None:
        for row in rows:
            self._open()
            self.lines.append(self.indent + "".join(self.line) + row)
            self.line = []

    def done(self) -> list[str]:
        self.end_line(False)
        out = self.lines
        while out and not out[-1].strip():
            out.pop()
        i = 0
        while i < len(out) and not out[i].strip():
            i += 1
        return out[i:]


def _table_lines(rows: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Rows of cells (columns and rows spanned, lines): each in its column, which is as wide as its widest line of at most ``SHORT``."""
    until = [0] * COLUMNS  # first row that a cell from above leaves free
    placed = []
    for r, row in enumerate(rows):
        at, line = 0, []
        for columns, down, cell in row:
            while at < COLUMNS and until[at] > r:
                at += 1
            line.append((at, at + columns, cell))
            if down > 1 and at < COLUMNS:
                end = min(at + columns, COLUMNS)
                until[at:end] = [r + down] * (end - at)
            at += columns
        placed.append(line)
    starts = sorted({a for line in placed for a, _, _ in line})
    place = {a: i for i, a in enumerate(starts)}
    width = [0] * len(starts)
    wide = []  # cells over several columns: the last one is widened until they fit
    for line in placed:
        for a, b, cell in line:
            i, j, need = place[a], bisect_left(starts, b) - 1, max((len(x) for x in cell if len(x) <= SHORT), default=0)
            if i == j:
                width[i] = max(width[i], need)
            elif need and len(starts) <= COLUMNS:
                wide.append((j - i, i, j, need))
    for _, i, j, need in sorted(wide):
        width[j] += max(need - sum(width[i:j + 1]) - 2 * (j - i), 0)
    left = [0]
    for w in width:
        left.append(left[-1] + w + 2)
    plain = sum(len(x) + 2 for line in placed for _, _, cell in line for x in ("", *cell))
    height = [max((len(cell) for _, _, cell in line), default=0) for line in placed]
    if sum(h * left[place[line[-1][0]]] for h, line in zip(height, placed, strict=True) if line) > 16 * plain:
        left = [0] * len(left)
    out = []
    for line, h in zip(placed, height, strict=True):
        for k in range(h):
            text, size = [], 0
            for a, _, cell in line:
                if k < len(cell) and cell[k]:
                    gap = max(left[place[a]] - size, 2 if size else 0)
                    text += [" " * gap, cell[k]]
                    size += gap + len(cell[k])
            if text:
                out.append("".join(text).rstrip())
    return out


def render(page: str) -> str:
    """The visible text of one page."""
    box = _Box()
    stack: list[tuple] = []  # (name, what to undo: kind, saved)
    hidden = 0
    pre = 0
    lists: list[list] = []    # [ordered, next number]
    tables: list[tuple] = []  # (outer box, rows, outer state of pre)
    selects: list[tuple] = []  # (outer box, attributes, options)
    places: dict[str, list[int]] = {}  # where on the stack the elements of a name are
    visible = True

    def push(name: str, kind: str, saved, seen: bool | None = None) -> None:
        nonlocal visible
        places.setdefault(name, []).append(len(stack))
        stack.append((name, kind, saved, visible))
        visible = visible if seen is None else seen

    def last(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def close_top() -> None:
        nonlocal box, hidden, pre, visible
        name, kind, saved, visible = stack.pop()
        places[name].pop()
        if kind == "hidden":
            hidden -= 1
            return
        if hidden:
            return
        if name == "pre":
            pre -= 1
        if kind == "list":
            lists.pop()
            box.end_line(not lists)
        elif kind == "item":
            box.end_line(False)
            box.mark = ""
            box.indent = saved
        elif kind == "indent":
            box.end_line(name in SPACED)
            box.indent = saved
        elif kind == "cell":
            box, columns, down, inner = (*saved, box)
            tables[-1][1][-1].append((columns, down, inner.done()))
        elif kind == "option":
            box, held, disabled, invisible, inner = (*saved, box)
            text = held.get("label", "").strip() or " ".join(" ".join(inner.done()).split())
            selects[-1][2].append((held, disabled, invisible, text))
        elif kind == "select":
            outer, held, options = selects.pop()
            box = outer
            into = tables[-1][0] if tables and box is tables[-1][2] else box
            shown = [text for text in _shown(options, held) if text] if saved else []
            for text in shown:
                if len(shown) > 1:
                    into.end_line(False)
                into.inline(f" {text} ")
            if len(shown) > 1:
                into.end_line(False)
        elif kind == "table":
            outer, rows, _ = tables.pop()
            box.end_line(False)
            caption = box.done()
            box = outer
            box.end_line(True)
            box.block(caption + _table_lines(rows))
            box.end_line(True)
        elif name in BLOCK:
            box.end_line(name in SPACED)

    def close_to(names: set, scope) -> None:
        # what it closes may itself stand in another one to close (a cell in a row)
        while (i := last(names)) > last(scope):
            while len(stack) > i:
                close_top()

    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        text = page[at:m.start() if m else size]
        if hidden and stack[-1][0] == "head" and text.strip(" \t\n\r\f"):
            close_top()
        if text and not hidden:
            text = _unescape(text)
            if not visible:
                pass
            elif tables and box is tables[-1][2]:
                tables[-1][0].inline(text) if text.strip() else None  # text of a table outside its cells goes before it
            elif pre:
                box.preformatted(text)
            else:
                box.inline(text)
        if not m:
            break
        at = m.end()
        if end := m["end"]:
            end = end.lower()
            if end == "br":
                if not hidden:
                    box.break_line()
                continue
            if end == "p" and not hidden and not places.get("p"):
                box.end_line(True)
                continue
            scope = {"table"} if end in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else () if end in _SCOPE else _SCOPE - {end}
            if (i := last((end,))) > last(scope):
                while len(stack) > i:
                    close_top()
            continue
        name = m["start"]
        if not name:
            continue
        name, attrs = name.lower(), m["attrs"]
        if hidden and stack[-1][0] == "head":
            if name in ("head", "html"):
                continue
            if name not in HEAD:
                close_top()
        if name in CLOSES:
            close_to(*CLOSES[name])
        if name in BLOCK and name not in CLOSES:
            close_to({"p"}, _SCOPE)
        if name in VOID:
            if not hidden and not (attrs and _look(attrs)[0]):
                if name == "br":
                    box.break_line()
                elif name == "hr":
                    box.end_line(True)
            continue
        gone, seen = _look(attrs) if attrs else (False, None)
        if name == "option" and not hidden and selects:
            # a drop-down shows its chosen option even if that one is hidden in the open list
            held = _attributes(attrs)
            group = last(("optgroup",))
            disabled = "disabled" in held or group >= 0 and bool(stack[group][2])
            push(name, "option", (box, held, disabled, bool(attrs) and _invisible(attrs)), True)
            box = _Box()
        elif hidden or name in HIDDEN or gone:
            if attrs.endswith("/") and name in ("svg", "math", "iframe"):
                continue
            push(name, "hidden", None)
            hidden += 1
        elif name == "select":
            selects.append((box, _attributes(attrs), []))
            push(name, "select", visible if seen is None else seen, True)
            box = _Box()
        elif name == "optgroup":
            push(name, "optgroup", "disabled" in _attributes(attrs), seen)
        elif name in ("td", "th"):
            if not tables:
                box.end_line(False)
                push(name, "", None, seen)
            else:
                if last(("tr",)) < last(("table",)):
                    push("tr", "", None)
                    tables[-1][1].append([])
                held = _attributes(attrs) if "span" in attrs.lower() else {}
                push(name, "cell", (box, _span(held, "colspan", 1000), _span(held, "rowspan", 65534)), seen)
                box = _Box()
        elif name == "tr" and tables:
            tables[-1][1].append([])
            push(name, "", None, seen)
        elif name == "table":
            inner = _Box()
            tables.append((box, [], inner))
            push(name, "table", None, seen)
            box = inner
        elif name == "caption" and tables:
            push(name, "cell", (box, 1, 1), seen)
            tables[-1][1].append([])
            box = _Box()
        elif name in ("ul", "ol", "menu"):
            box.end_line(not lists)
            first = _START.search(attrs) if name == "ol" and attrs else None
            lists.append([name == "ol", int(first[1]) if first else 1])
            push(name, "list", None, seen)
        elif name == "li":
            box.end_line(False)
            push(name, "item", box.indent, seen)
            ordered, number = lists[-1] if lists else (False, 0)
            if ordered:
                lists[-1][1] += 1
            box.indent = "  " * min(max(len(lists) - 1, 0), INDENT // 2)
            box.mark = f"{number}. " if ordered else "- "
        elif name in ("dd", "blockquote"):
            box.end_line(name in SPACED)
            push(name, "indent", box.indent, seen)
            box.indent = (box.indent + "  ")[:INDENT]
        else:
            if name in BLOCK:
                box.end_line(name in SPACED)
            if name == "pre":
                pre += 1
            if name in ("pre", "textarea") and page.startswith("\n", at):
                at += 1
            push(name, "", None, seen)
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            end = stop.start() if stop else size
            if name == "textarea" and visible and not hidden:
                box.preformatted(_unescape(page[at:end]))
            at = end
    while stack:
        close_top()
    return "\n".join(box.done())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (visible text), n_chars and n_lines of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "html"):
                texts = [None if p is None else render(p) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t or "") for t in texts], pa.int64()),
                     pa.array([len((t or "").splitlines()) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars", "n_lines"])

    key = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {key}, url string, text string, n_chars long, n_lines long")
