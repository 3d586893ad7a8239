"""Source HTML to ordered blocks and notes: a scanner on the standard parser, one document a row.

Top-level elements of the body become blocks; text outside any becomes a
paragraph of its own; comments give nothing. A heading h2 (or a second h1)
opens a page. Elements of class footnote, and the items of a list of class
footnotes, are lifted out as notes, numbered by the mark that points at them.
Unclosed p, li, td, tr close where the next one opens, a p before any block. Null or empty source:
no blocks.
"""

from __future__ import annotations

import html as _html
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that close an open paragraph.
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES = {tag: {"p"} for tag in BLOCKS} | {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCHEMA = "chapter_id string, pos int, page_idx int, id string, tag string, css string, html string, is_note boolean"


class Blocks(HTMLParser):
    """Collects top-level elements as (tag, attributes, outer html, inner html)."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.open: list[str] = []
        self.found: list[list] = []
        self.loose = ""

    def flush(self):
        if self.loose.strip():
            self.found.append(["p", {}, self.loose.strip()])
        self.loose = ""

    def text(self, raw: str):
        if self.open:
            self.found[-1][2] += raw
        else:
            self.loose += raw

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body", "article", "main"):
            return
        while self.open and tag in CLOSES and self.open[-1] in CLOSES[tag]:
            self.handle_endtag(self.open[-1])
        raw = self.get_starttag_text() or f"<{tag}>"
        if self.open:
            self.found[-1][2] += raw
            if tag not in VOID:
                self.open.append(tag)
        elif tag in VOID and tag != "hr":
            self.loose += raw
        else:
            self.flush()
            self.found.append([tag, dict(attrs), ""])
            if tag not in VOID:
                self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        if self.open:
            self.found[-1][2] += self.get_starttag_text() or ""
        else:
            self.handle_starttag(tag, attrs)
            if self.open:
                self.open.pop()

    def handle_endtag(self, tag):
        if tag not in self.open:
            return
        while self.open:
            last = self.open.pop()
            if self.open:
                self.found[-1][2] += f"</{last}>"
            if last == tag:
                break

    def handle_data(self, data):
        self.text(data)

    def handle_entityref(self, name):
        self.text(f"&{name};")

    def handle_charref(self, name):
        self.text(f"&#{name};")

    def done(self) -> list[list]:
        self.close()
        while self.open:
            self.handle_endtag(self.open[-1])
        self.flush()
        return self.found


def blocks_of(source: str) -> list[list]:
    start = source.lower().find("<body")
    body = source[source.find(">", start) + 1 :] if start >= 0 else source
    parser = Blocks()
    parser.feed(body)
    return parser.done()


def notes_of(tag: str, attrs: dict, inner: str) -> list[tuple[str | None, str]]:
    """(id, html) of each note that an element holds."""
    css = (attrs.get("class") or "").split()
    if "footnotes" in css:
        parser = Blocks()
        parser.feed(inner)
        items = parser.done()
        if len(items) == 1 and items[0][0] in ("ol", "ul"):
            parser = Blocks()
            parser.feed(items[0][2])
            items = parser.done()
        return [(a.get("id"), h.strip()) for _, a, h in items]
    return [(attrs.get("id"), inner.strip())] if "footnote" in css or tag == "aside" else []


def parsed(chapter: str, source: str | None) -> list[dict]:
    rows, page, ones, unnamed = [], 0, 0, 0
    found = blocks_of(source or "")
    is_note = [bool(notes_of(*f)) for f in found]
    for k, (tag, attrs, inner) in enumerate(found):
        if tag == "hr" and k + 1 < len(found) and is_note[k + 1]:
            continue  # the rule before notes
        ones += tag == "h1"
        page += tag == "h2" or tag == "h1" and ones > 1
        if is_note[k]:
            for own, text in notes_of(tag, attrs, inner):
                unnamed += own is None
                rows.append({"page_idx": page, "id": own or f"fn-x{unnamed}", "tag": "note", "css": "", "html": text, "is_note": True})
        else:
            rows.append({"page_idx": page, "id": attrs.get("id"), "tag": tag, "css": attrs.get("class") or "", "html": inner.strip(), "is_note": False})
    return [{"chapter_id": chapter, "pos": k, **r} for k, r in enumerate(rows)]


COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def parse(sources: DataFrame, id_column: str = "chapter_id", source_column: str = "src") -> DataFrame:
    """Rows (chapter_id, pos, page_idx, id, tag, css, html, is_note) of each source."""

    def run(frames):
        for frame in frames:
            rows = [r for chapter, source in zip(frame.iloc[:, 0], frame.iloc[:, 1], strict=True) for r in parsed(chapter, source)]
            yield pd.DataFrame(rows, columns=COLUMNS)

    return sources.selectExpr(f"cast({id_column} as string)", source_column).mapInPandas(run, SCHEMA)


def plain_text(inner: str) -> str:
    """An element's text with entities resolved and blanks squeezed."""
    import re

    return " ".join(_html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
