"""Stored HTML in one pass, whatever its state: tokens, elements and repeated parts.

Time and memory are linear in the page. What never closes has a defined result: a tag without ``>`` is text to the
page's end, a comment or a script without its end takes the rest of the page, and elements left open end with the page.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAME = re.compile(r"[A-Za-z][^\s/>]*")
#: The end of a tag, or the start of a quoted value.
STOP = re.compile(r""">|=\s{0,64}["']""")
CLASS = re.compile(r"""(?i)(?:^|\s)class\s{0,64}=\s{0,64}(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
#: Elements that have no end tag, and elements whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = {name: re.compile(rf"(?i)</{name}(?=[\s/>])") for name in ("script", "style", "noscript", "template", "textarea", "title")}
HIDDEN = frozenset(("script", "style", "noscript", "template"))
#: Elements whose text is a chapter, an item or a value, and elements that end a row.
CELLS, ROWS = frozenset(("th", "dt", "td", "dd", "h2", "h3", "caption")), frozenset(("tr", "table", "dl"))


def tokens(html: str) -> Iterator[tuple[str, str, str, int, int]]:
    """(kind, name, value, start, end): ``text`` with its text, ``start`` with its attributes, ``end``; in order, without gaps but for comments."""
    at, size, text_from = 0, len(html), 0
    while True:
        open_ = html.find("<", at)
        if open_ < 0 or open_ + 1 >= size:
            break
        sign = html[open_ + 1]
        if sign in "!?":
            if open_ > text_from:
                yield "text", "", html[text_from:open_], text_from, open_
            close = html.find("-->", open_ + 4) + 3 if html.startswith("<!--", open_) else html.find(">", open_) + 1
            if close < 3:
                return
            at = text_from = close
            continue
        found = NAME.match(html, open_ + 1 + (sign == "/"))
        if not found:
            at = open_ + 1
            continue
        close = found.end()
        while True:
            stop = STOP.search(html, close)
            if not stop:
                close = -1
                break
            if stop[0] == ">":
                close = stop.end()
                break
            quote = html.find(stop[0][-1], stop.end())
            if quote < 0:
                close = html.find(">", stop.end()) + 1 or -1
                break
            close = quote + 1
        if close < 0:
            break
        if open_ > text_from:
            yield "text", "", html[text_from:open_], text_from, open_
        name = found[0].lower()
        at = text_from = close
        if sign == "/":
            yield "end", name, "", open_, close
            continue
        yield "start", name, html[found.end() : close - 1], open_, close
        if name in RAW and html[close - 2] != "/":
            end = RAW[name].search(html, close)
            until = end.start() if end else size
            if until > close:
                yield "text", "", html[close:until], close, until
            at = text_from = until
    if size > text_from:
        yield "text", "", html[text_from:], text_from, size


def words(html: str | None) -> list[str]:
    """Visible pieces of text in order, entities undone."""
    out, hidden = [], ""
    for kind, name, value, _, _ in tokens(html or ""):
        if kind == "start" and name in HIDDEN:
            hidden = name
        elif kind == "end" and name == hidden:
            hidden = ""
        elif kind == "text" and not hidden and (piece := " ".join(unescape(value).split())):
            out.append(piece)
    return out


def triples(html: str | None) -> Iterator[tuple[str, str, str]]:
    """Chapter, item and value of the rows of tables and definition lists; headings and captions name chapters."""
    chapter, item, cell, held, hidden = "", None, "", [], ""

    def closed():
        nonlocal chapter, item, cell
        tag, text, cell = cell, " ".join(held), ""
        held.clear()
        if tag in ("h2", "h3", "caption"):
            chapter, item = text, None
        elif tag in ("th", "dt") or tag and item is None:
            item = text
        elif tag:
            row, item = (chapter, item, text), None
            return row
        return None

    for kind, name, value, _, _ in tokens(html or ""):
        row = None
        if kind == "text":
            if cell and not hidden and (piece := " ".join(unescape(value).split())):
                held.append(piece)
            continue
        if name in HIDDEN:
            hidden = name if kind == "start" else "" if name == hidden else hidden
        elif name in ROWS:
            row, item = closed(), None
        elif kind == "start" and name in CELLS:
            row, cell = closed(), name
        elif name == cell:
            row = closed()
        if row:
            yield row
    row = closed()
    if row:
        yield row


def elements(html: str) -> Iterator[tuple[int, int, int, int, str, str, str]]:
    """start, end, depth, number of elements in it, tag, class and text hash of every element with text, children before parents.

    An end tag closes all that stands open within its element, and none that matches is left out. The hash is built
    bottom-up from the hashes of what the element holds, so that no text is read twice.
    """
    stack: list[list] = []  # tag, class, start, hash, has text, elements
    counts: dict[str, int] = {}

    def close(end: int) -> tuple[int, int, int, int, str, str, str] | None:
        tag, css, start, state, full, inner = stack.pop()
        counts[tag] -= 1
        if not full:
            return None
        text = state.hexdigest()[:32]
        if stack:
            stack[-1][3].update(b"\x00" + text.encode())
            stack[-1][4] = True
            stack[-1][5] += 1
        return start, end, len(stack), inner, tag, css, text

    for kind, name, value, start, end in tokens(html):
        if kind == "text":
            piece = "" if stack and stack[-1][0] in HIDDEN else " ".join(unescape(value).split())
            if stack and piece:
                stack[-1][3].update(b"\x01" + piece.encode("utf-8", "surrogatepass"))
                stack[-1][4] = True
        elif kind == "start":
            if name not in VOID and not value.endswith("/"):
                found = CLASS.search(value)
                css = " ".join(sorted((found[1] or found[2] or found[3] or "").split())) if found else ""
                stack.append([name, css, start, hashlib.blake2b(digest_size=16), False, 0])
                counts[name] = counts.get(name, 0) + 1
        elif counts.get(name):
            while True:
                last = stack[-1][0]
                row = close(end if last == name else start)
                if row:
                    yield row
                if last == name:
                    break
    while stack:
        row = close(len(html))
        if row:
            yield row


def page_rows(pages: DataFrame, page_id: str, html: str, read, schema: str) -> DataFrame:
    """Rows that ``read`` makes of each page's html, the page's id before them; schema: their columns, of text and whole numbers."""
    names = ["page_id", *[field.split()[0] for field in schema.split(", ")]]
    kinds = [pa.int64(), *[{"long": pa.int64(), "int": pa.int32()}.get(field.split()[1], pa.string()) for field in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = read(text.as_py() or "")
                while rows := [(page, *row) for row in itertools.islice(found, 8192)]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return pages.select(F.col(page_id).cast("long").alias("page_id"), html).mapInArrow(run, f"page_id long, {schema}")


def page_elements(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """Every element with text of every page, its place and its key: tag, class and hash of its text."""
    return page_rows(pages, page_id, html, elements, "start long, end long, depth int, inner int, tag string, css string, text_hash string")


def page_triples(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """page_id, chapter, item and value of every row of every page's tables and definition lists."""
    return page_rows(pages, page_id, html, triples, "chapter string, item string, value string")


def repeated_cards(html: str) -> list[tuple[int, int]]:
    """start and end of the outermost cards that repeat an earlier one: same tag, class and text.

    A card is an element that holds others with text, so the words in one card are no repeats of those in another. A
    part of a removed card goes with it and is no first place of anything.
    """
    seen, gone, until = set(), [], 0
    for start, end, _, inner, *key in sorted(elements(html), key=lambda e: (e[0], -e[1])):
        if inner and start >= until:
            if (key := tuple(key)) in seen:
                gone.append((start, end))
                until = end
            seen.add(key)
    return gone


def without_repeats(html: str) -> Iterator[tuple[str, int, int, int]]:
    """The page without its repeated cards, how many there were, and characters before and after."""
    gone = repeated_cards(html)
    edges = [0, *(end for _, end in gone)]
    kept = "".join(html[a:b] for a, b in zip(edges, [*(start for start, _ in gone), len(html)]))
    yield kept, len(gone), len(html), len(kept)


def pruned(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """page_id, html without its repeated cards, removed, and characters before and after, a row for each page.

    Pages are independent: nothing is shuffled. A null page is an empty one; pages that share an id keep a row each.
    """
    return page_rows(pages, page_id, html, without_repeats, "html string, removed int, before long, after long")
