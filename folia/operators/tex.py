"""TeX sources: macros, top-level events, slugs. Macros found in a source apply to that source only."""


import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_PASSES = 10
SECTION = re.compile(r"\\(chapter|section|subsection|subsubsection)\*?\{")
NEWCOMMAND = re.compile(r"\\(?:re)?newcommand\*?\s*\{?\\([a-zA-Z]+)\}?\s*(?:\[([0-9])\])?\s*\{")
DEF = re.compile(r"\\def\\([a-zA-Z]+)\s*\{")


def group(text: str, at: int) -> int:
    """The place after the brace that closes the one before `at`; escaped braces don't count."""
    level = 1
    while at < len(text) and level:
        if text[at] == "\\":
            at += 2
            continue
        level += (text[at] == "{") - (text[at] == "}")
        at += 1
    return min(at, len(text))


def macros(text: str) -> tuple[str, dict[str, tuple[int, str]]]:
    """The text without its definitions, and them: name to (number of arguments, body)."""
    found: dict[str, tuple[int, str]] = {}
    for pattern in (NEWCOMMAND, DEF):
        while m := pattern.search(text):
            end = group(text, m.end())
            body = text[m.end() : end - 1]
            n = int(m[2] or 0) if pattern is NEWCOMMAND else 0
            if pattern is NEWCOMMAND or "#" not in body:
                found[m[1]] = (n, body)
            text = text[: m.start()] + text[end:]
    return text, found


def expand(text: str, known: dict[str, tuple[int, str]], most: int = MOST_PASSES) -> str:
    """Macros replaced until nothing changes or `most` passes are done; a double backslash is no start of a command."""
    names = re.compile(r"\\\\|\\([a-zA-Z]+)")
    for _ in range(most):
        out, k, changed = [], 0, False
        while m := names.search(text, k):
            out.append(text[k : m.start()])
            k = m.end()
            if m[1] not in known:
                out.append(m[0])
                continue
            n, body = known[m[1]]
            values = []
            while len(values) < n and k < len(text) and text[k] == "{":
                end = group(text, k + 1)
                values.append(text[k + 1 : end - 1])
                k = end
            for i, value in enumerate(values, 1):
                body = body.replace(f"#{i}", value)
            out.append(body)
            changed = True
        text = "".join(out) + text[k:]
        if not changed:
            break
    return text


def events(text: str) -> list[tuple[str, str, str]]:
    """(kind, name, body) at the top level: sections, environments, displayed math and the text between."""
    out: list[tuple[str, str, str]] = []
    start = re.compile(r"\\(chapter|section|subsection|subsubsection)\*?\{|\\begin\{([a-zA-Z*]+)\}|\\\[|\$\$")
    k = 0
    while m := start.search(text, k):
        if text[k : m.start()].strip():
            out.append(("text", "", text[k : m.start()].strip()))
        if m[1]:
            end = group(text, m.end())
            out.append(("sec", m[1], text[m.end() : end - 1]))
        elif m[2]:
            level, end, pair = 1, m.end(), re.compile(r"\\(begin|end)\{" + re.escape(m[2]) + r"\}")
            stop = len(text)
            while level and (n := pair.search(text, end)):
                level += 1 if n[1] == "begin" else -1
                end, stop = n.end(), n.start()
            end = end if not level else len(text)
            out.append(("env", m[2], text[m.end() : stop if not level else len(text)].strip()))
        else:
            close = "\\]" if m[0] == "\\[" else "$$"
            stop = text.find(close, m.end())
            stop = len(text) if stop < 0 else stop
            end = min(len(text), stop + 2)
            out.append(("dmath", "", text[m.end() : stop].strip()))
        k = end
    if text[k:].strip():
        out.append(("text", "", text[k:].strip()))
    return out


def slug(title: str) -> str:
    plain = unicodedata.normalize("NFKD", title).encode("ascii", "ignore").decode().lower()
    return re.sub(r"[^a-z0-9]+", "-", plain).strip("-")


def event_rows(sources: DataFrame, id_column: str = "chapter_id", source_column: str = "src") -> DataFrame:
    """A row for each top-level event of each source, macros expanded."""

    def run(frames):
        for frame in frames:
            rows = []
            for chapter, source in zip(frame.iloc[:, 0], frame.iloc[:, 1], strict=True):
                bare = "\n".join(re.sub(r"^((?:[^%\\]|\\.)*)%.*$", r"\1", line) for line in (source or "").split("\n"))
                text, known = macros(bare)
                rows += [(chapter, k, *e) for k, e in enumerate(events(expand(text, known)))]
            yield pd.DataFrame(rows, columns=["chapter_id", "pos", "kind", "name", "body"])

    return sources.selectExpr(f"cast({id_column} as string)", source_column).mapInPandas(run, "chapter_id string, pos int, kind string, name string, body string")


def slugs(titles):
    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda t: None if t is None else slug(t))

    return run(titles)


def braced(text: str, at: int) -> int:
    """The place after the brace that closes the one at `at`; -1 if none does. Escaped braces don't count."""
    depth, i = 0, at
    while i < len(text):
        c = text[i]
        if c == "\\":
            i += 2
            continue
        depth += (c == "{") - (c == "}")
        i += 1
        if not depth:
            return i
    return -1


def chosen(text: str, command: str, variant: int) -> str:
    """Each \\command{first}{second} replaced by one of the two, variants inside it as well. A command without two closed arguments stays."""
    start = re.compile(re.escape("\\" + command) + r"(?![A-Za-z])\s*\{")
    out, done, ends = [], 0, []  # ends: where the arguments that are being read out end, and where the text goes on
    at = 0
    while True:
        m = start.search(text, at)
        while ends and (m is None or m.start() >= ends[-1][0]):
            stop, after = ends.pop()
            out.append(text[done:stop])
            done = at = after
            m = start.search(text, at)
        if m is None:
            return "".join(out) + text[done:]
        first = m.end() - 1
        middle = braced(text, first)
        gap = re.compile(r"\s*\{").match(text, middle) if middle > 0 else None
        end = braced(text, gap.end() - 1) if gap else -1
        if end < 0:
            at = m.end()
            continue
        begin, stop = (first + 1, middle - 1) if variant == 0 else (gap.end(), end - 1)
        out.append(text[done : m.start()])
        done = at = begin
        ends.append((stop, end))


def variants(c, command: str, variant: int = 1):
    """The column with its variants resolved: 0 keeps the original, 1 the new reading."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else chosen(t, command, variant))

    return run(c)
