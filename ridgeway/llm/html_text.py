"""Visible text of HTML pages, laid out the way a page shows it.

A tree builder follows the tags with the usual implied ones (a paragraph ends
where a block begins, a list item where the next begins, cells and rows close
each other, unclosed elements end with their parent), so that every page gives
a balanced tree; its elements are laid out as they open and close. Hidden
elements add nothing. Blocks stand on lines of their own, paragraphs and
headings between empty lines, list items behind a mark and indented by depth,
and table cells in columns of equal width, long cells wrapped within theirs.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "area audio base canvas datalist embed frameset head iframe link meta noembed noframes noscript object param rp script "
    "source style svg template title track video".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section select "
    "summary table tbody td textarea tfoot th thead tr ul xmp caption".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr listing ol p pre table ul menu dir".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr li listing main menu nav ol p pre search section summary table ul xmp plaintext".split()
)
LISTS = frozenset("ul ol menu dir".split())
ROW_GROUPS = frozenset("thead tbody tfoot".split())
#: An opening tag closes the nearest open element of the first set, unless one of the second lies between.
CLOSES = {
    "li": (frozenset(["li"]), LISTS), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["optgroup"]), frozenset(["select", "datalist"])),
    "tr": (frozenset(["tr", "caption"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    **{g: (ROW_GROUPS | {"caption"}, frozenset(["table"])) for g in ROW_GROUPS},
}
#: An end tag looks no further than these for its start tag.
SCOPE = {"p": frozenset(["td", "th", "table", "caption", "button"]), "li": LISTS | {"table"}, "td": frozenset(["table"]), "th": frozenset(["table"]),
         "tr": frozenset(["table"])}
CELL_SCOPE = frozenset(["table", "td", "th", "caption"])

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>=]|=)*)(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
NOT_SHOWN = re.compile(r"(?<![\w-])(?:display\s*:\s*none|content-visibility\s*:\s*hidden)")
VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(hidden|collapse|visible|initial)")
SPACES = re.compile(r"[ \t\n\r\f]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PREFORMATTED = frozenset("pre listing xmp textarea".split())
IN_HEAD = frozenset("base link meta title style script noscript template head".split())
TABLE_PARTS = ROW_GROUPS | {"tr", "td", "th", "caption", "col", "colgroup"}
CELL_WIDTH, NARROW_CELL, WIDE_TABLE, MAX_INDENT = 80, 12, 2000, 40


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape(value.strip("\"'")) if value else "")
    return out


def _hidden(tag: str, attrs: dict[str, str]) -> bool:
    if "hidden" in attrs and attrs["hidden"].lower() != "until-found" or tag == "dialog" and "open" not in attrs:
        return True
    return bool(NOT_SHOWN.search(attrs.get("style", "").lower()))


def _unseen(attrs: dict[str, str], inherited: bool) -> bool:
    """Whether an element keeps its place without showing its text; its own visibility outranks its parent's."""
    found = VISIBILITY.findall(attrs["style"].lower()) if "style" in attrs else ()
    return found[-1] in ("hidden", "collapse") if found else inherited


def _wrapped(line: str, width: int) -> list[str]:
    """A line cut at spaces into lines of at most ``width``; a longer word is a line of its own. The indent is kept."""
    if len(line) <= width or isinstance(line, _Fixed):
        return [line]
    indent = line[: len(line) - len(line.lstrip(" "))]
    indent = indent if len(indent) < width // 2 else ""
    out, parts, held = [], [], 0
    for word in line.split(" "):
        if not word:
            continue
        if parts and held + 1 + len(word) > width:
            out.append(indent + " ".join(parts))
            parts, held = [], 0
        held = held + 1 + len(word) if parts else len(indent) + len(word)
        parts.append(word)
    return [*out, indent + " ".join(parts)]


class _Fixed(str):
    """A line that isn't wrapped."""


class _Box:
    """Lines laid out so far on the page or in one table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the open line
        self.space = False  # white space is due before the next text
        self.gap = 0  # empty lines due before the next line: 1 or more from spaced blocks
        self.mark = ""  # list mark due before the next line
        self.indent = ""

    def text(self, s: str) -> None:
        words = SPACES.sub(" ", s)
        if not words:
            return
        if words[0] == " ":
            self.space = True
            words = words[1:]
        if not words:
            return
        end = words[-1] == " "
        if self.space and self.parts:
            self.parts.append(" ")
        self.parts.append(words[:-1] if end else words)
        self.space = end

    def flush(self) -> None:
        if self.parts:
            self.put("".join(self.parts))
            self.parts.clear()
        self.space = False

    def put(self, line: str, fixed: bool = False) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = 0
        prefix = self.indent
        if self.mark:
            prefix = self.indent[: len(self.indent) - len(self.mark)] + self.mark
            self.mark = ""
        line = (prefix + line).rstrip()
        self.lines.append(_Fixed(line) if fixed else line)

    def line_break(self) -> None:
        if self.parts:
            self.flush()
        else:
            self.put("")


class _Table:
    """Cells of one table by row."""

    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []  # per row (column, span, lines)
        self.below: dict[int, int] = {}  # column -> rows below the open one that a cell still takes
        self.taken: set[int] = set()  # columns of the open row that a cell from above takes

    def row(self) -> None:
        self.taken = set(self.below)
        self.below = {c: n - 1 for c, n in self.below.items() if n > 1}
        self.rows.append([])

    def cell(self, span: int, down: int, lines: list[str]) -> None:
        if not self.rows:
            self.row()
        row = self.rows[-1]
        at = row[-1][0] + row[-1][1] if row else 0
        while at in self.taken:
            at += 1
        row.append((at, span, lines))
        if down > 1:
            self.below.update(dict.fromkeys(range(at, at + span), down - 1))

    def layout(self) -> list[str]:
        """Lines with cells in columns.

        Cells wrap at CELL_WIDTH, and in tables of many columns at less, so that
        all columns fit into WIDE_TABLE. Where a word is longer than its column,
        and where a line of a nested table or of preformatted text is, which
        aren't cut, the cells behind it go on below. A table whose columns
        would have to be narrower than NARROW_CELL has its cells two spaces apart.
        """
        count = 1 + max((at for row in self.rows for at, *_ in row), default=0)
        limit = min(CELL_WIDTH, WIDE_TABLE // count - 2)
        aligned = limit >= NARROW_CELL
        width: dict[int, int] = {}
        rows = self.rows
        if aligned:
            rows = [[(at, span, [x for line in lines for x in _wrapped(line, limit * span)]) for at, span, lines in row] for row in rows]
            for row in rows:
                for at, span, lines in row:
                    if span == 1:
                        longest = max((len(x) for x in lines if len(x) <= limit), default=0)
                        width[at] = max(width.get(at, 0), longest)
        columns = sorted(width)
        out = []
        for row in rows:
            left = [(at, span, deque(lines)) for at, span, lines in row]
            while any(lines for *_, lines in left):
                line, done = [], 0  # done: columns already passed
                long = (i for i, (_, span, lines) in enumerate(left) if aligned and span == 1 and lines and len(lines[0]) > limit)
                alone = next(long, -1)  # the cells behind it wait
                for i, (at, span, lines) in enumerate(left):
                    first, last = bisect_left(columns, at), bisect_left(columns, at + span)
                    line += [" " * (width[c] + 2) for c in columns[done:first]]
                    room = sum(width[c] + 2 for c in columns[first:last]) - 2
                    shown = lines.popleft() if lines and (alone < 0 or i <= alone) else ""
                    line.append(shown.ljust(max(room, 0)) + "  ")
                    done = max(done, last)
                out.append("".join(line).rstrip())
        return out


def _number(text: str | None, default: int, low: int, high: int) -> int:
    m = re.match(r"\s*(-?[0-9]{1,9})", text or "")
    return min(max(int(m[1]), low), high) if m else default


class _Layout:
    """Lays out elements as the tree builder opens and closes them."""

    def __init__(self):
        self.boxes = [_Box()]
        self.tables: list[_Table] = []
        self.lists: list[list] = []  # [kind, number of the next item]
        self.pre = 0

    def open(self, tag: str, attrs: dict[str, str]):
        """Lay out a start tag; returns what ``close`` needs."""
        box = self.boxes[-1]
        if tag == "br":
            box.line_break()
        if tag not in BLOCK:
            return None
        box.flush()
        if tag in SPACED and not box.mark and not (tag in LISTS and self.lists):
            box.gap = 1
        before = box.indent
        if tag in LISTS:
            self.lists.append([tag, _number(attrs.get("start"), 1, -(10**9), 10**9)])
        elif tag == "li":
            own = self.lists[-1] if self.lists else ["ul", 1]
            own[1] = _number(attrs.get("value"), own[1], -(10**9), 10**9) if own[0] == "ol" else own[1]
            box.mark = f"{own[1]}. " if own[0] == "ol" else "- "
            own[1] += 1
            deep = len(before) < MAX_INDENT
            box.indent = before + " " * len(box.mark) if deep else " " * (MAX_INDENT + len(box.mark))
        elif tag in ("blockquote", "dd"):
            box.indent = before + "    " if len(before) < MAX_INDENT else before
        elif tag in PREFORMATTED:
            self.pre += 1
        elif tag == "table":
            self.tables.append(_Table())
        elif tag == "tr":
            self.tables[-1].row()
        elif tag in ("td", "th"):
            self.boxes.append(_Box())
            outer, self.lists, pre, self.pre = self.lists, [], self.pre, 0
            return outer, pre, _number(attrs.get("colspan"), 1, 1, 1000), _number(attrs.get("rowspan"), 1, 1, 65534)
        return before

    def close(self, tag: str, kept) -> None:
        if tag not in BLOCK:
            return
        box = self.boxes[-1]
        box.flush()
        if tag in ("td", "th"):
            self.boxes.pop()
            self.lists, self.pre = kept[0], kept[1]
            self.tables[-1].cell(kept[2], kept[3], _trimmed(box.lines))
            return
        if tag in LISTS:
            self.lists.pop()
        elif tag == "li":
            box.mark = ""
        elif tag in PREFORMATTED:
            self.pre -= 1
        elif tag == "table":
            for line in self.tables.pop().layout():
                box.put(line, fixed=True)
        box.indent = kept
        if tag in SPACED and not (tag in LISTS and self.lists):
            box.gap = 1

    def text(self, s: str) -> None:
        s = s.replace("\xa0", " ") if self.pre else s
        box = self.boxes[-1]
        if not self.pre:
            box.text(s)
            return
        first, *more = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        box.parts.append(first)
        for line in more:
            box.put("".join(box.parts), fixed=True)
            box.parts = [line]
        if box.parts == [""]:
            box.parts = []

    def result(self) -> str:
        box = self.boxes[0]
        box.flush()
        return "\n".join(_trimmed(box.lines)).replace("\xa0", " ")


def _trimmed(lines: list[str]) -> list[str]:
    """Without empty lines at the ends, and no two in a row."""
    out: list[str] = []
    for line in lines:
        if line.strip() or (out and out[-1]):
            out.append(line if line.strip() else "")
    while out and not out[-1]:
        out.pop()
    return out


class _Tree:
    """Tree builder: the stack of open elements, with implied end tags."""

    def __init__(self):
        self.layout = _Layout()
        self.stack: list[tuple] = []  # (tag, hidden, closed details, what the layout kept, unseen)
        self.count: dict[str, int] = {}

    def _pop(self) -> None:
        tag, hidden, _, kept, _ = self.stack.pop()
        self.count[tag] -= 1
        if not hidden:
            self.layout.close(tag, kept)

    def _close(self, tags, bounds) -> bool:
        """Pop through the nearest open element of ``tags``, unless one of ``bounds`` lies nearer."""
        if not any(self.count.get(t) for t in tags):
            return False
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                while len(self.stack) > i:
                    self._pop()
                return True
            if self.stack[i][0] in bounds:
                return False
        return False

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("html", "body"):
            self._close(("head",), ())
            if self.count.get(tag):
                return
        elif self.count.get("head") and tag not in IN_HEAD and not self.hidden_head_child():
            self._close(("head",), ())
        if tag in ENDS_P:
            self._close(("p",), SCOPE["p"])
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        inside = self.count.get("table")
        if tag in TABLE_PARTS and not inside:
            return
        if tag in ("td", "th"):
            if not self._row_open():
                self.start("tr", {})
        _, hidden, closed, _, unseen = self.stack[-1] if self.stack else ("", False, False, None, False)
        hidden = hidden or closed and tag != "summary" or tag in HIDDEN or _hidden(tag, attrs)
        if tag in VOID:
            if not hidden:
                self.layout.close(tag, self.layout.open(tag, attrs))
            return
        kept = None if hidden else self.layout.open(tag, attrs)
        self.stack.append((tag, hidden, tag == "details" and "open" not in attrs, kept, _unseen(attrs, unseen)))
        self.count[tag] = self.count.get(tag, 0) + 1

    def hidden_head_child(self) -> bool:
        return bool(self.stack) and self.stack[-1][0] in ("noscript", "template")

    def _row_open(self) -> bool:
        for tag, *_ in reversed(self.stack):
            if tag == "tr":
                return True
            if tag == "table":
                return False
        return False

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag == "p" and not self.count.get("p"):
            self.start("p", {})
            self._pop()
        elif tag in HEADINGS:
            self._close(HEADINGS, CELL_SCOPE)
        elif tag == "table":
            self._close(("table",), ())
        elif tag not in ("html", "body"):
            self._close((tag,), SCOPE.get(tag, CELL_SCOPE - {tag}))

    def text(self, s: str, raw: bool = False) -> None:
        if self.stack and self.stack[-1][0] == "head" and s.strip():
            self._close(("head",), ())
        if self.stack and (self.stack[-1][1] or self.stack[-1][2] or self.stack[-1][4]):
            return
        self.layout.text(s if raw else unescape(s))

    def finish(self) -> str:
        while self.stack:
            self._pop()
        return self.layout.result()


def visible_text(html: str | None) -> str:
    """The laid-out visible text of one page; '' for none."""
    if not html:
        return ""
    tree, at, skip_newline = _Tree(), 0, False
    while True:
        m = TOKEN.search(html, at)
        piece = html[at : m.start()] if m else html[at:]
        if piece:
            if skip_newline:  # the line break right after <pre> is not shown
                piece = piece[1:] if piece[0] == "\n" else piece[2:] if piece[:2] == "\r\n" else piece
            tree.text(piece)
            skip_newline = False
        if not m:
            return tree.finish()
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            tree.end(name)
            continue
        tree.start(name, attributes(m[3]) if m[3].strip(" /\t\n\r\f") else {})
        skip_newline = name in PREFORMATTED
        if name in RAW:
            end = _raw_end(name).search(html, at)
            stop = end.start() if end else len(html)
            tree.text(html[at:stop], raw=name not in ("textarea", "title"))
            at = stop


def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text) for every page, whole, however long; a page is laid out in one task, in time linear in it.

    Null and empty pages give ''; repeated rows give repeated rows; an empty table gives none; no other column is read.
    """
    import pyarrow as pa

    def run(batches):
        for b in batches:
            ids, texts, held = [], [], 0
            for id_, html in zip(b.column(0), b.column(1)):
                ids.append(id_.as_py())
                texts.append(visible_text(html.as_py()))
                held += len(texts[-1])
                if held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["page_id", "text"])
                    ids, texts, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["page_id", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, text string")
