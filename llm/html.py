"""Layout-aware HTML rendering: a tree builder with implied tags and visibility rules, then text.

All visible text is emitted: blocks start on their own lines and paragraphs are set off by an empty
line, list items carry bullets or numbers and their depth, cells of a table are aligned in columns (spans
of columns and rows are laid out on its grid), ``br`` breaks a line and a further one leaves it empty,
``pre`` keeps its spacing. Comments, scripts, styles, heads, templates and hidden elements (attribute
``hidden``, ``display:none``, ``visibility:hidden``) are left out.

Defined cases: null and empty pages render to the empty text; unclosed and misnested tags close as
the tree builder implies; any end tag without its start is ignored; a tag that is never closed by ``>`` is
text, and so is all after it; a quote that is never closed is an ordinary character; repeated rows render
equally; elements may nest as deep as the page has them (Python's limit of recursion follows the page). Reading a page takes
time in proportion to its length; writing it, in proportion to the text with its indents and aligned columns.
"""

from __future__ import annotations

import html
import re
import sys
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import per_batch

OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
ENDS = re.compile("[>\"']")
#: Columns that a cell may span, and rows.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
SPAN = {k: re.compile(rf"""(?i)(?:^|\s){k}\s*=\s*["']?\s*(\d{{1,6}})""") for k in ("colspan", "rowspan")}
STYLE = re.compile(r"(?i)(?:display\s*:\s*none|visibility\s*:\s*hidden)")
HIDDEN = re.compile(r"(?i)(?:^|\s)hidden(?=[\s=/]|$)")
ATTRIBUTE = re.compile(r"""(?i)(?:^|\s)style\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
START = re.compile(r"""(?i)(?:^|\s)start\s*=\s*["']?(-?\d+)""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe".split())
UNSEEN = frozenset("head script style template noscript iframe title object datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure article section".split())
#: What a start tag closes, and where the search for it ends.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr", "td", "th"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr"), ("table",)), "thead": (("thead", "tbody", "tfoot", "tr"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr"), ("table",)), "option": (("option",), ("select",)), "body": (("head",), ("html",)),
}
CLOSES_P = BLOCK - {"body", "html", "li", "td", "th", "tr", "tbody", "thead", "tfoot", "dt", "dd", "caption"}
BARRIERS = frozenset("table td th caption html body button".split())


class Node:
    __slots__ = ("children", "rest", "tag")

    def __init__(self, tag: str, rest: str = ""):
        self.tag, self.rest, self.children = tag, rest, []

    def unseen(self) -> bool:
        if self.tag in UNSEEN:
            return True
        if not self.rest:
            return False
        style = ATTRIBUTE.search(self.rest)
        return bool(style and STYLE.search(style[1])) or bool(HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", '""', self.rest)))


def tokens(page: str):
    """(text before, kind, name, attributes, position after) of each tag, with kind "" for a start and "/" for an end;
    at last (text, None, "", "", length)."""
    at, done, last = 0, 0, {q: page.rfind(q) for q in "\"'"}
    while m := OPEN.search(page, at):
        i = m.end()
        if m[1]:
            end = page.find("-->", m.start() + 2)
            end = len(page) if end < 0 else end + 3
        elif m[2]:
            end = page.find(">", i) + 1
        else:
            while (c := ENDS.search(page, i)) and c[0] != ">":
                i = page.find(c[0], c.end()) + 1 if c.start() < last[c[0]] else c.end()
            end = c.end() if c else 0
        if not end:
            break
        kind = None if m[1] or m[2] else m[3]
        skip = yield page[done : m.start()], kind, (m[4] or "").lower(), "" if kind is None else page[m.end() : end - 1], end
        at = done = skip or end
    yield page[done:], None, "", "", len(page)


def tree(page: str) -> tuple[Node, int]:
    """(root, depth of the deepest element)."""
    root = Node("html")
    stack, tags, skip, deepest = [root], tokens(page), None, 1
    #: Places in the stack of the open elements by tag, so that none is searched for that isn't open.
    places: dict[str, list[int]] = {"html": [0]}

    def cut(k: int) -> None:
        """Closes the elements from place k on."""
        for node in stack[k:]:
            places[node.tag].pop()
        del stack[k:]

    def last(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def close(names, barriers) -> None:
        """Closes the open elements of these names above the last barrier, and what is in them."""
        barrier = max(0, last(barriers))
        found = [places[n][bisect_right(places[n], barrier)] for n in names if places.get(n) and places[n][-1] > barrier]
        if found:
            cut(min(found))

    def text(piece: str) -> None:
        if piece:
            if stack[-1].tag == "head" and piece.strip():
                cut(len(stack) - 1)
            stack[-1].children.append(html.unescape(piece))

    while True:
        try:
            before, kind, tag, rest, at = tags.send(skip)
        except StopIteration:
            return root, deepest
        skip = None
        text(before)
        if kind is None:
            continue
        raw = None
        if not kind and tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            raw, skip = page[at : end.start() if end else len(page)], end.end() if end else len(page)
        if kind:
            k = last((tag,))
            if k > 0 and (tag in ("table", "tr", "tbody", "thead", "tfoot", "body", "html") or k >= last(("table", "td", "th"))):
                cut(k)
            continue
        if tag in ("html", "body") and places.get(tag):
            continue
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag in CLOSES_P:
            close(("p",), BARRIERS)
        node = Node(tag, rest)
        if raw is not None:
            node.children.append(html.unescape(raw) if tag in ("textarea", "title") else raw)
        elif tag not in VOID and not rest.endswith("/"):
            stack[-1].children.append(node)
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
            deepest = max(deepest, len(stack))
            continue
        stack[-1].children.append(node)


class Lines:
    """Lines under construction: text goes to the last one, ``gap`` asks for empty lines before the next."""

    def __init__(self):
        self.done, self.parts, self.seen, self.gap = [], [], False, 0

    def put(self, text: str) -> None:
        """Text as it is; ``seen`` says whether the line has more than white space."""
        if text:
            self.parts.append(text)
            self.seen = self.seen or bool(text.strip())

    def end(self) -> None:
        """Ends the line, empty or not."""
        self.done.append("".join(self.parts).rstrip(" "))
        self.parts, self.seen = [], False

    def inline(self, text: str) -> None:
        text = re.sub(r"[ \t\n\r\f]+", " ", text)
        if not self.parts or self.parts[-1].endswith(" "):
            text = text.lstrip(" ")
        if text:
            if not self.parts and self.gap and self.done:
                self.done += [""] * (self.gap - 1)
                self.gap = 0
            self.put(text)

    def line(self, gap: int = 1) -> None:
        if self.seen:
            self.end()
            self.gap = 0
        self.parts, self.seen = [], False
        self.gap = max(self.gap, gap)

    def add(self, lines: list[str]) -> None:
        self.line()
        if lines:
            if self.done and self.gap > 1:
                self.done.append("")
            self.done += lines
            self.gap = 1

    def result(self) -> list[str]:
        self.line()
        return self.done


def _render(node: Node, out: Lines, preformatted: bool = False) -> None:
    for child in node.children:
        if isinstance(child, str):
            if preformatted:
                first, *more = child.split("\n")
                out.put(first)
                for x in more:
                    out.end()
                    out.put(x)
            else:
                out.inline(child)
        elif child.unseen():
            continue
        elif child.tag == "br":
            if out.seen:
                out.line()
            elif out.done:
                out.gap += 1
        elif child.tag == "table":
            out.line(2)
            out.add(_table(child))
            out.line(2)
        elif child.tag in ("ul", "ol", "menu"):
            gap = 1 if node.tag == "li" else 2
            out.line(gap)
            out.add(_list(child))
            out.line(gap)
        elif child.tag in BLOCK:
            gap = 2 if child.tag in SPACED else 1
            out.line(gap)
            if child.tag in ("pre", "blockquote", "dd"):
                inner = Lines()
                _render(child, inner, preformatted or child.tag == "pre")
                lines = inner.result()
                out.add(lines if child.tag == "pre" else ["  " + x if x else x for x in lines])
            else:
                _render(child, out, preformatted)
            out.line(gap)
        else:
            _render(child, out, preformatted)


def _list(node: Node) -> list[str]:
    out, number = [], int(m[1]) if (m := START.search(node.rest)) else 1
    for child in node.children:
        inner = Lines()
        if isinstance(child, str):
            inner.inline(child)
            out += inner.result()
        elif not child.unseen():
            if child.tag == "li":
                _render(child, inner)
                mark = f"{number}. " if node.tag == "ol" else "- "
                number += 1
                lines = inner.result() or [""]
                out += [(mark if k == 0 else " " * len(mark)) + x if x or k == 0 else x for k, x in enumerate(lines)]
            else:
                holder = Node("div")
                holder.children = [child]
                _render(holder, inner)
                out += inner.result()
    return out


def _table(node: Node) -> list[str]:
    rows, loose = [], Lines()

    def walk(part: Node) -> None:
        for child in part.children:
            if isinstance(child, str):
                loose.inline(child)
            elif child.unseen():
                continue
            elif child.tag in ("thead", "tbody", "tfoot"):
                walk(child)
            elif child.tag in ("tr", "td", "th"):
                cells = [child] if child.tag != "tr" else child.children
                if child.tag != "tr" and rows and rows[-1][0] is part:
                    target = rows[-1][1]
                else:
                    target = []
                    rows.append((part if child.tag != "tr" else child, target))
                for c in cells:
                    if isinstance(c, str):
                        loose.inline(c)
                    elif not c.unseen():
                        inner = Lines()
                        _render(c, inner)
                        target.append((inner.result(), _span(c, "colspan", MOST_COLUMNS), _span(c, "rowspan", MOST_ROWS)))
            else:
                holder = Node("div")
                holder.children = [child]
                _render(holder, loose)

    walk(node)
    return loose.result() + _aligned([cells for _, cells in rows])


def _span(cell: Node, kind: str, most: int) -> int:
    found = SPAN[kind].search(cell.rest) if cell.rest else None
    return min(max(1, int(found[1])) if found else 1, most)


def _aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table from its rows of (lines, columns, rows spanned) cells: each cell takes the next free place of
    the grid; a column is as wide as its widest cell of one column, and a wider span widens its last one."""
    placed, busy = [], []  # busy: [first column, column after, row after] that cells of rows above take, in order
    for y, cells in enumerate(rows):
        busy = [b for b in busy if b[2] > y]
        at, k, here, new = 0, 0, [], []
        for lines, columns, down in cells:
            while k < len(busy) and busy[k][0] < at + 1:
                at, k = max(at, busy[k][1]), k + 1
            here.append((at, at + columns, lines))
            if down > 1:
                new.append([at, at + columns, min(y + down, len(rows))])
            at += columns
        placed.append(here)
        merged: list[list[int]] = []
        for b in sorted(busy + new):
            if merged and merged[-1][1] == b[0] and merged[-1][2] == b[2]:
                merged[-1][1] = b[1]
            else:
                merged.append(b)
        busy = merged
    starts = sorted({a for row in placed for a, _, _ in row})
    index = {a: i for i, a in enumerate(starts)}
    widths = [0] * len(starts)
    spans = [(index[a], bisect_left(starts, b), max(map(len, lines), default=0)) for row in placed for a, b, lines in row]
    for i, j, n in spans:
        if j - i == 1:
            widths[i] = max(widths[i], n)
    for i, j, n in sorted(s for s in spans if s[1] - s[0] > 1):
        widths[j - 1] += max(0, n - sum(widths[i:j]) - 2 * (j - i - 1))
    left = [0]
    for w in widths:
        left.append(left[-1] + w + 2)
    out = []
    for row in placed:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for a, _, lines in row:
                if k < len(lines):
                    line = line.ljust(left[index[a]]) + lines[k]
            out.append(line.rstrip())
    return out


def render(page: str | None) -> str:
    root, depth = tree(page or "")
    limit, needed = sys.getrecursionlimit(), 6 * depth + 200
    sys.setrecursionlimit(max(limit, needed))
    try:
        out = Lines()
        _render(root, out)
        return "\n".join(out.result())
    finally:
        sys.setrecursionlimit(limit)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_chars, n_lines) of every row of ``pages`` (page_id, html)."""

    def extract(batch: pa.RecordBatch):
        texts = [render(x.as_py()) for x in batch.column("html")]
        yield {"page_id": batch.column("page_id"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64()), "n_lines": pa.array([t.count("\n") + bool(t) for t in texts], pa.int64())}

    return per_batch(pages.select(F.col("page_id").cast("long").alias("page_id"), "html"), "page_id long, text string, n_chars long, n_lines long", extract)
