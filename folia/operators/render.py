"""TeX to HTML: inline text, formulas, environments, and chapters of pages and blocks.

A source is one row; its macros, labels and numbering hold for that source
only. Labels and citation marks come as a relation and meet a source by a join
on the keys that it names, so no table of labels is broadcast. Null source: no
chapter. Groups and environments that never close run to the end of the text.
Environments and notes nested deeper than MOST_LEVELS are shown as plain text.
"""

from __future__ import annotations

import html
import re
import unicodedata
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.operators.tex import expand, macros
from folia.sources.readers import CHAPTER

MOST_LEVELS = 40

# What commands stand for, and the marks and classes of the output.
NARROW, TIE, EN, EM = "\u202f", "\u00a0", "\u2002", "\u2003"
WORDS = {
    "cf": f"cf.{TIE}", "Cf": f"Cf.{TIE}", "ie": f"i.e.{TIE}", "iev": "i.e., ", "loccit": f"loc.{TIE}cit.{TIE}", "resp": f"resp.{TIE}", "Exp": f"Exp.{TIE}",
    "numero": f"nº{TIE}", "og": f"«{NARROW}", "fg": f"{NARROW}»", "S": "§", "oldS": "§", "afortiori": "a fortiori ", "ldots": "…", "dots": "…", "cdots": "⋯",
    "TeX": "TeX", "LaTeX": "LaTeX", "pointrait": f".{EN}", "danger": "<strong>!</strong>", "CQFD": "C.Q.F.D.", "cqfd": "C.Q.F.D.", "qed": "C.Q.F.D.",
    "SSI": r" \(\Longleftrightarrow\) ", "ALORS": r" \(\Longrightarrow\) ", "par": "\n\n", "smfbreak": "\n\n", "thinspace": "\u2009", "enspace": EN, "quad": EM, "qquad": EM + EM,
    "oe": "œ", "OE": "Œ", "ae": "æ", "AE": "Æ", "o": "ø", "O": "Ø", "ss": "ß", "aa": "å", "AA": "Å", "l": "ł", "L": "Ł", "i": "ı", "j": "ȷ", "dh": "ð", "P": "¶",
    "copyright": "©", "dag": "†", "ddag": "‡", "pounds": "£", "guillemotleft": "«", "guillemotright": "»", "textbackslash": "\\", "textbar": "|", "textasciitilde": "~",
    "textless": "<", "textgreater": ">", "textendash": "–", "textemdash": "—", "textquotedblleft": "“", "textquotedblright": "”", "textquoteleft": "‘",
    "textquoteright": "’", "textbullet": "•", "textperiodcentered": "·", "textdegree": "°", "degree": "°",
}
SYMBOLS = {",": NARROW, ";": EN, ":": EN, "!": "", " ": " ", "\n": " ", "%": "%", "&": "&amp;", "#": "#", "_": "_", "$": "$", "{": "{", "}": "}", "|": "∥", "-": "\u00ad", "/": "", "@": "", "\\": "<br/>"}
#: Commands that say nothing: how many optional and how many braced arguments go with them.
SILENT = {
    "index": (0, 1), "refstepcounter": (0, 1), "stepcounter": (0, 1), "setcounter": (0, 2), "addtocounter": (0, 2), "renewcommand": (0, 2), "newcommand": (1, 2),
    "providecommand": (1, 2), "thispagestyle": (0, 1), "pagestyle": (0, 1), "chapterspace": (0, 1), "vspace": (1, 1), "hspace": (1, 1), "setlength": (0, 2), "nde": (0, 1),
    "ndetext": (0, 1), "markboth": (0, 2), "markright": (0, 1), "phantom": (0, 1), "hphantom": (0, 1), "vphantom": (0, 1), "caption": (0, 1), "addcontentsline": (0, 3),
    "addtocontents": (0, 2), "value": (0, 1), "pageref": (0, 1),
}
FONTS = {
    "textit": ("<i>", "</i>"), "textsl": ("<i>", "</i>"), "emph": ("<em>", "</em>"), "textbf": ("<strong>", "</strong>"), "textmd": ("", ""),
    "textup": ('<span class="upshape">', "</span>"), "textsc": ('<span class="smallcaps">', "</span>"), "texttt": ("<code>", "</code>"),
    "textsf": ('<span class="sf">', "</span>"), "underline": ("<u>", "</u>"), "uline": ("<u>", "</u>"), "textsuperscript": ("<sup>", "</sup>"),
    "textsubscript": ("<sub>", "</sub>"), "sout": ("<s>", "</s>"),
}
SWITCHES = {
    "it": ("<i>", "</i>"), "sl": ("<i>", "</i>"), "em": ("<em>", "</em>"), "bf": ("<strong>", "</strong>"), "bfseries": ("<strong>", "</strong>"),
    "itshape": ("<i>", "</i>"), "slshape": ("<i>", "</i>"), "scshape": ('<span class="smallcaps">', "</span>"), "sc": ('<span class="smallcaps">', "</span>"),
    "tt": ("<code>", "</code>"), "ttfamily": ("<code>", "</code>"), "rm": ("", ""), "rmfamily": ("", ""), "sf": ('<span class="sf">', "</span>"),
    "sffamily": ('<span class="sf">', "</span>"), "upshape": ('<span class="upshape">', "</span>"), "small": ('<span class="small">', "</span>"),
    "footnotesize": ('<span class="small">', "</span>"), "scriptsize": ('<span class="small">', "</span>"), "large": ('<span class="large">', "</span>"),
    "Large": ('<span class="large">', "</span>"), "huge": ('<span class="large">', "</span>"), "normalsize": ("", ""), "normalfont": ("", ""), "mdseries": ("", ""),
}
#: The combining mark of each accent.
ACCENTS = {"'": "\u0301", "`": "\u0300", "^": "\u0302", '"': "\u0308", "~": "\u0303", "=": "\u0304", ".": "\u0307", "c": "\u0327", "v": "\u030c", "u": "\u0306", "H": "\u030b", "r": "\u030a", "k": "\u0328"}
NUMBERED = ("equation", "align", "gather", "multline", "eqnarray", "flalign")
ROWS = ("align", "gather", "multline", "eqnarray", "flalign")
FORMULAS = {*NUMBERED, *(n + "*" for n in NUMBERED), "displaymath"}
THEOREMS = {
    "theoreme": "Théorème", "proposition": "Proposition", "lemme": "Lemme", "corollaire": "Corollaire", "corollaires": "Corollaires", "conjecture": "Conjecture",
    "probleme": "Problème", "theoremedefinition": "Théorème et définition", "subproposition": "Proposition", "sublemme": "Lemme", "subsublemme": "Lemme",
    "supproposition": "Proposition", "suplemme": "Lemme", "suptheoreme": "Théorème", "supcorollaire": "Corollaire", "aconjecture": "Conjecture", "definition": "Définition",
    "remarque": "Remarque", "remarques": "Remarques", "exemple": "Exemple", "subremarque": "Remarque", "supdefinition": "Définition", "remarquestar": "Remarque",
    "theorem": "Théorème", "theorem_": "Théorème", "theorem*": "Théorème", "lemma": "Lemme", "lemma_": "Lemme", "corollary": "Corollaire", "corollary_": "Corollaire",
    "proposition_": "Proposition", "definition_": "Définition", "prop-def_": "Proposition-définition", "propositionblah": "Proposition",
    "criteredenormalitedeserre": "Critère de normalité de Serre",
}
REMARKS = {"definition", "remarque", "remarques", "exemple", "subremarque", "supdefinition", "remarquestar"}
LISTS = {"enumerate": '<ol class="enumerate">', "enumeratei": '<ol class="enumerate-i" type="i">', "enumeratea": '<ol class="enumerate-a" type="a">', "itemize": '<ul class="itemize">'}
TABLES = {"tabular", "tabularx", "array", "longtable"}
AROUND = {
    "center": ('<div class="center">', "</div>"), "flushright": ('<div class="flushright">', "</div>"), "flushleft": ('<div class="flushleft">', "</div>"),
    "quote": ("<blockquote>", "</blockquote>"), "quotation": ("<blockquote>", "</blockquote>"), "footnotesize": ('<div class="small">', "</div>"),
    "small": ('<div class="small">', "</div>"), "abstract": ('<div class="abstract">', "</div>"),
}

TOKEN = re.compile(r"\\([a-zA-Z]+)|\\(.)|([{}$~&<>])|(-{2,3}|``|''|`)|[^\\{}$~&<>\-`']+|.", re.S)
SIGNS = {"~": TIE, "&": "&amp;", "<": "&lt;", ">": "&gt;", "---": "—", "--": "–", "``": "“", "''": "”", "`": "‘"}
TOP = re.compile(r"\\(chapter|section|subsection|subsubsection|paragraph)(\*?)(?![a-zA-Z])|\\begin\{([^{}]*)\}|(\\\[|\$\$)|\\.|[{$]", re.S)
LABEL = re.compile(r"\\label\{([^}]*)\}")
KEYS = r"\\(?:ref|Ref|eqref|pageref|cite|label)\s*(?:\[[^\]]*\])?\s*\{([^}]*)\}|\\bibitem\s*(?:\[[^\]]*\])?\s*\{([^}]*)\}"


def pairs(text: str) -> dict[int, int]:
    """For each opening brace, the place after the one that closes it; escaped braces don't count."""
    out, still = {}, []
    for m in re.finditer(r"\\.|[{}]", text, re.S):
        if m[0] == "{":
            still.append(m.start())
        elif m[0] == "}" and still:
            out[still.pop()] = m.end()
    return out


def blanks(text: str, at: int, which: str = " \t") -> int:
    while at < len(text) and text[at] in which:
        at += 1
    return at


def argument(text: str, at: int, ends: dict[int, int]) -> tuple[str, int]:
    """The group, command or letter that follows blanks, and the place after it."""
    at = blanks(text, at)
    if text[at : at + 1] == "{":
        return (text[at + 1 : ends[at] - 1], ends[at]) if at in ends else (text[at + 1 :], len(text))
    m = re.compile(r"\\(?:[a-zA-Z]+|.)|.", re.S).match(text, at)
    return (m[0], m.end()) if m else ("", at)


def option(text: str, at: int) -> tuple[str | None, int]:
    """What stands in square brackets at a place, brackets inside it in pairs."""
    if text[at : at + 1] != "[":
        return None, at
    depth = 0
    for m in re.compile(r"[\[\]]").finditer(text, at):
        depth += 1 if m[0] == "[" else -1
        if not depth:
            return text[at + 1 : m.start()], m.end()
    return None, at


@dataclass
class Page:
    """What one page gathers while it is rendered."""

    labels: dict[str, str]
    cites: dict[str, str]
    known: dict[str, tuple[int, str]] = field(default_factory=dict)
    id: str = "p"
    notes: list = field(default_factory=list)
    entries: list = field(default_factory=list)
    missing: list = field(default_factory=list)
    cited: dict[str, int] = field(default_factory=dict)
    made: int = 0
    pending: str | None = None

    def turned(self, id: str) -> Page:
        """The next page of the same source."""
        return Page(self.labels, self.cites, self.known, id, missing=self.missing, cited=self.cited)

    def new_id(self, prefix: str) -> str:
        self.made += 1
        return f"{prefix}-{self.id}-{self.made}"

    def number(self, key: str, kind: str, otherwise: str) -> str:
        if not (found := self.labels.get(key)):
            self.missing.append((key, kind))
        return found or otherwise


def formula(tex: str, page: Page) -> str:
    """A formula without its signs: dollar parts of texts lifted out, accents braced, macros expanded, numbers for references, escaped."""
    tex = lifted(tex)
    tex = re.sub(r"\\(widehat|widetilde|overline|underline|xrightarrow|xleftarrow)\s*(\\[A-Za-z]+)", r"\\\1{\2}", tex)
    tex = expand(tex, page.known)
    tex = re.sub(r"\\tag\{\\ast([^}]*)\}", lambda m: "\\tag{*" + m[1].replace("_", "") + "}", tex)
    tex = diagrams(tex)
    tex = re.sub(r"\\(eq|page)?ref\{([^}]*)\}", lambda m: ("({})" if m[1] == "eq" else "{}").format(page.number(m[2].strip(), "math-ref", "?")), tex)
    tex = re.sub(r"\\cite\{([^}]*)\}", lambda m: f"[{page.cites.get(m[1].strip(), '?')}]", tex)
    return html.escape(tex, quote=False)


def lifted(tex: str) -> str:
    """\\text{for $i>0$} as \\text{for } i>0."""
    if "$" not in tex:
        return tex
    out, at, ends = [], 0, pairs(tex)
    for m in re.finditer(r"\\(text|textnormal|textrm|mbox)\s*\{", tex):
        stop = ends.get(m.end() - 1)
        if m.start() < at or stop is None or "$" not in tex[m.end() : stop]:
            continue
        parts = tex[m.end() : stop - 1].split("$")
        out += [tex[at : m.start()], " ".join(p if k % 2 else f"\\{m[1]}{{{p}}}" for k, p in enumerate(parts) if p)]
        at = stop
    return "".join(out) + tex[at:]


_GROUP = r"\{(?:[^{}]|\{[^{}]*\})*+\}"
ARROWS = re.compile(rf"(\s*+)((?:\\ar(?![a-zA-Z])(?:\s|@{_GROUP}|@<[^>]*>|@[^\[{{<\s_^\\]*+|\[[^\]]*\]|[_^][-+|]*+(?:{_GROUP}|\\[A-Za-z]+|\\.|[^\s\\{{]))*+)++)(.*)", re.S)


def diagrams(tex: str) -> str:
    """Cells of xy matrices with their object before their arrows."""
    if "\\xymatrix" not in tex:
        return tex
    out, at, ends = [], 0, pairs(tex)
    for m in re.finditer(r"\\xymatrix(?:@[^{\s]*)?\s*\{", tex):
        if m.start() < at or (stop := ends.get(m.end() - 1)) is None:
            continue
        body = re.sub(r"\\(?:mbox|text)\{([.,;:])\}", r"\1", tex[m.end() : stop - 1])
        body = re.sub(r"([_^]-?)(\\[A-Za-z]+\{[^{}]*\})", r"\1{\2}", body)
        cells = split(body, r"&|\\\\")
        out += [tex[at : m.end()], *(moved(c) if k % 2 == 0 else c for k, c in enumerate(cells)), "}"]
        at = stop
    return "".join(out) + tex[at:]


def moved(cell: str) -> str:
    m = ARROWS.fullmatch(cell)
    return f"{m[1]}{m[3].strip()} {m[2].strip()}" if m and m[3].strip() else cell


def split(text: str, at: str) -> list[str]:
    """A text split where a pattern matches outside groups and dollar signs; what matched stands between."""
    out, begin, k, ends = [], 0, 0, pairs(text)
    scan = re.compile(rf"({at})|\\.|[{{$]", re.S)
    while m := scan.search(text, k):
        k = m.end()
        if m[1] is not None:
            out += [text[begin : m.start()], m[1]]
            begin = k
        elif m[0] == "{":
            k = ends.get(m.start(), k)
        elif m[0] == "$":
            close = text.find("$", k)
            k = close + 1 if close >= 0 else k
    return [*out, text[begin:]]


def closing_dollar(text: str, at: int, ends: dict[int, int]) -> int:
    """The dollar sign that closes a formula, outside groups; the text's end if none does."""
    scan = re.compile(r"\\.|[{$]", re.S)
    while m := scan.search(text, at):
        if m[0] == "$":
            return m.start()
        at = ends.get(m.start(), m.end()) if m[0] == "{" else m.end()
    return len(text)


def quoted(text: str) -> str:
    return html.escape(text, quote=True)


def reference(key: str, page: Page, kind: str) -> str:
    number = page.number(key, kind, "??")
    shown = f"\\({formula(number, page)}\\)" if re.search(r"[\\_^]", number) else quoted(number)
    return f'<a class="{"eqref" if key.startswith("eq:") else "ref"}" href="#{quoted(key)}">{shown}</a>'


def citation(keys: str, page: Page) -> str:
    parts = []
    for key in filter(None, map(str.strip, keys.split(","))):
        number = page.cites.get(key) or page.number(key, "cite", "?")
        page.cited[key] = page.cited.get(key, 0) + 1
        parts.append(f'<a class="cite-src" id="{quoted(key)}-cite-{page.cited[key]}" href="#{quoted(key)}">{html.escape(number)}</a>')
    return f'<span class="cite">[{", ".join(parts)}]</span>'


def note(body: str, page: Page, level: int) -> str:
    n = len(page.notes) + 1
    id = f"fn-{page.id}-{n}"
    page.notes.append([id, str(n), ""])
    page.notes[n - 1][2] = flow(body, page, level + 1, False).strip()
    return f'<a class="footnote-ref" id="{quoted(id)}ref" href="#{quoted(id)}"><sup>{n}</sup></a>'


def accented(mark: str, base: str) -> str:
    """The letter with its accent, or the letter alone where no such character exists."""
    base = base.strip()
    base = base[1:2] if base[:2] in ("\\i", "\\j") else base[:1]
    whole = unicodedata.normalize("NFC", base + ACCENTS[mark]) if base else ""
    return whole if len(whole) == 1 else html.escape(base, quote=False)


def inline(text: str, page: Page, level: int = 0) -> str:
    """Text without environments. Groups are kept on a stack of what closes them, so any depth of them will do."""
    out: list[str] = []
    closers: list[str] = []
    k, ends = 0, pairs(text)
    while m := TOKEN.match(text, k):
        k = m.end()
        name, symbol, char, sign = m.groups()
        if name:
            if name in ACCENTS:
                base, k = argument(text, k, ends)
                out.append(accented(name, base))
            elif name in ("ref", "Ref", "eqref"):
                key, k = argument(text, k, ends)
                link = reference(key.strip(), page, "eqref" if name == "eqref" else "ref")
                out.append(f"({link})" if name == "eqref" else link)
            elif name == "cite":
                keys, k = argument(text, option(text, k)[1], ends)
                out.append(citation(keys, page))
            elif name in ("footnote", "sfootnote"):
                body, k = argument(text, k, ends)
                out.append(note(body, page, level))
            elif name == "label":
                key, k = argument(text, k, ends)
                out.append(f'<span class="label-anchor" id="{quoted(key.strip())}"></span>' if key.strip() else "")
            elif name in SILENT:
                for _ in range(SILENT[name][0]):
                    _, k = option(text, blanks(text, k))
                for _ in range(SILENT[name][1]):
                    _, k = argument(text, k, ends)
            elif name in FONTS:
                before, after = FONTS[name]
                out.append(before)
                begin = blanks(text, k)
                if begin in ends:
                    closers.append(after)
                    k = begin + 1
                else:
                    body, k = argument(text, k, ends)
                    out.append((inline(body, page, level + 1) if level < MOST_LEVELS else html.escape(body)) + after)
            elif name == "texorpdfstring":
                begin = blanks(text, k)
                if begin in ends:  # the first argument goes on, the second is blanked out
                    second = blanks(text, ends[begin])
                    body = text[begin + 1 : ends[begin] - 1]
                    k = ends.get(second, ends[begin])
                    out.append(inline(body, page, level + 1) if level < MOST_LEVELS else html.escape(body))
            elif name in WORDS:
                out.append(WORDS[name])
                k += name != "fg" and text[k : k + 1] == " "
            elif name not in SWITCHES and name not in ("hbox", "mbox", "text", "textnormal", "textrm", "ensuremath", "centerline", "footnotemark", "item"):
                k += text[k : k + 1] == " "  # says nothing; a group after it is shown
        elif symbol:
            if symbol in ACCENTS:
                base, k = argument(text, k, ends)
                out.append(accented(symbol, base))
            else:
                out.append(SYMBOLS.get(symbol, html.escape(symbol, quote=False)))
        elif char == "$":
            stop = closing_dollar(text, k, ends)
            out.append(f"\\({formula(text[k:stop], page)}\\)")
            k = stop + 1
        elif char == "{":
            switch = re.compile(r"\s*\\([a-zA-Z]+)").match(text, k)
            before, after = SWITCHES.get(switch[1], ("", "")) if switch else ("", "")
            if switch and switch[1] in SWITCHES:
                k = switch.end()
            out.append(before)
            closers.append(after)
        elif char == "}":
            out.append(closers.pop() if closers else "")
        elif char or sign:
            out.append(SIGNS[char or sign])
        else:
            out.append(html.escape(m[0], quote=False))
    return "".join([*out, *reversed(closers)])


def top(text: str) -> list[tuple]:
    """What stands outside groups and formulas, in order: ("text", text), ("env", name, body), ("dmath", sign, body), ("sec", name, star, short, title, label)."""
    out: list[tuple] = []
    begin = k = 0
    ends = pairs(text)

    def plain(stop: int) -> None:
        if text[begin:stop].strip():
            out.append(("text", text[begin:stop]))

    while m := TOP.search(text, k):
        k = m.end()
        if m[0] == "{":
            k = ends.get(m.start(), k)
        elif m[0] == "$":
            k = min(closing_dollar(text, k, ends) + 1, len(text))
        elif m[1]:
            short, after = option(text, blanks(text, k))
            title, after = argument(text, after, ends)
            mark = LABEL.match(text, blanks(text, after, " \t\r\n"))
            plain(m.start())
            out.append(("sec", m[1], bool(m[2]), short, title, mark[1] if mark else None))
            begin = k = mark.end() if mark else after
        elif m[3] is not None:
            plain(m.start())
            depth, stop, k = 1, len(text), len(text)
            for n in re.compile(r"\\(begin|end)\{" + re.escape(m[3]) + r"\}").finditer(text, m.end()):
                depth += 1 if n[1] == "begin" else -1
                if not depth:
                    stop, k = n.start(), n.end()
                    break
            out.append(("env", m[3], text[m.end() : stop]))
            begin = k
        elif m[4]:
            plain(m.start())
            stop = text.find("\\]" if m[4] == "\\[" else "$$", k)
            stop = len(text) if stop < 0 else stop
            out.append(("dmath", m[4], text[k:stop]))
            begin = k = min(stop + 2, len(text))
    plain(len(text))
    return out


def paragraphs(text: str, page: Page, level: int) -> list[str]:
    parts = re.split(r"\n[ \t]*\n|\\par(?![a-zA-Z])", text)
    shown = (inline(p, page, level).strip() for p in parts if p.strip())
    return [f"<p>{p}</p>" for p in shown if p]


def flow(text: str, page: Page, level: int = 0, split_paragraphs: bool = True) -> str:
    """Text with environments and displayed formulas."""
    if level > MOST_LEVELS:
        return html.escape(text, quote=False)
    out = []
    for event in top(text):
        if event[0] == "text":
            out += paragraphs(event[1], page, level) if split_paragraphs else [inline(event[1].replace("\\par ", " "), page, level).strip()]
        elif event[0] == "sec":
            out.append(f"<h4{f' id={chr(34)}{quoted(event[5])}{chr(34)}' if event[5] else ''}>{inline(event[4], page, level)}</h4>")
        else:
            out.append(block(event[1], event[2], page, level)[4])
    return "\n".join(filter(None, out))


def block(name: str, body: str, page: Page, level: int = 0) -> tuple:
    """(id, type, label, title, html) of an environment or a displayed formula."""
    if name in FORMULAS or name in ("\\[", "$$"):
        return display(name, body, page)
    if name in THEOREMS or name == "enonce*":
        return theorem(name, body, page, level)
    if name == "proof":
        title, body = leading(body)
        id, shown = page.new_id("proof"), inline(title, page) if title else "Démonstration"
        return id, "proof", None, shown, f'<div class="proof" id="{quoted(id)}">\n  <div class="proof-head"><span class="proof-name">{shown}</span><span class="proof-toggle">▾</span></div>\n  <div class="proof-body">{flow(body, page, level + 1)}<span class="qed">C.Q.F.D.</span></div>\n</div>'
    if name in LISTS:
        rows = (f"<li>{f'<span class={chr(34)}item-label{chr(34)}>{inline(mark, page)}</span> ' if mark is not None else ''}{flow(text, page, level + 1)}</li>" for mark, text in items(body))
        return None, "list", None, None, "\n".join([LISTS[name], *rows, f"</{LISTS[name][1:3]}>"])
    if name == "thebibliography":
        return bibliography(body, page, level)
    if name in TABLES:
        return table(body, page)
    before, after = AROUND.get(name, ("", ""))
    return None, "paragraph", None, None, before + flow(body, page, level + 1) + after


def display(name: str, body: str, page: Page) -> tuple:
    """A displayed formula; a row's first label becomes its tag where the environment numbers rows and the row has none."""
    keys = LABEL.findall(body)
    body = re.sub(r"\\tag\{\$([^$]*)\$\}", r"\\tag{\1}", body)
    shown = {key: page.labels.get(key, "").replace("$", "") for key in keys}

    def row(tex: str) -> str:
        tags = [f"\\tag{{{shown[key]}}}" for key in LABEL.findall(tex) if shown.get(key)]
        places = iter(tags[:1] if name in NUMBERED and "\\tag" not in tex else ())
        return LABEL.sub(lambda m: next(places, "") if shown.get(m[1]) else "", tex)

    tex = formula("\\\\".join(map(row, body.split("\\\\"))), page).strip()
    whole = name.rstrip("*") + "*"
    tex = f"\\begin{{{whole}}}\n{tex}\n\\end{{{whole}}}" if whole[:-1] in ROWS else f"\\[\n{tex}\n\\]"
    kind = "equation" if keys and (name in NUMBERED or "\\tag" in body) else "displaymath"
    id = (keys[0] if keys else "") or page.new_id("eq" if kind == "equation" else "disp")
    others = "".join(f'<span class="label-anchor" id="{quoted(key)}"></span>' for key in keys[1:] if key and key != id)
    label = ", ".join(filter(None, (shown[key] for key in keys))) or None
    return id, kind, label if kind == "equation" else None, None, f'<div class="{kind}" id="{quoted(id)}">\n{others}{tex}\n</div>'


def leading(body: str) -> tuple[str | None, str]:
    """A title in brackets at the head of a body, and the rest."""
    at = blanks(body, 0, " \t\r\n")
    title, after = option(body, at)
    return title, body[after:] if title is not None else body


def theorem(name: str, body: str, page: Page, level: int) -> tuple:
    """A statement: its id is its first label, else the label that ended the text before it, else a new one."""
    title, body = leading(body)
    free = name == "enonce*"
    own = None if free else LABEL.search(body)
    key = own[1] if own else page.pending
    page.pending = None
    number = page.labels.get(key) if key else None
    id = key or page.new_id("enonce" if free else "thm")
    if free:
        at = blanks(body, 0, " \t\r\n")
        heading, at = argument(body, at, pairs(body)) if body[at : at + 1] == "{" else ("", at)
        caption, style, body = inline(heading, page), "remark" if "rem" in (title or "") else "plain", body[at:]
        head = f'<span class="thm-name">{caption}</span>'
    else:
        caption, style = THEOREMS[name], "remark" if name in REMARKS else "plain"
        head = f'<span class="thm-name">{html.escape(caption)}</span>'
        head += f' <span class="thm-num">{html.escape(number)}</span>' if number else ""
    inside = flow(body, page, level + 1)
    if title and not free:
        head += f' <span class="thm-title">({inline(title, page)})</span>'
    kind = "enonce" if free else name
    return id, kind, number, caption, f'<div class="thm thm-{style} {kind}" id="{quoted(id)}">\n  <div class="thm-head">{head}</div>\n  <div class="thm-body">{inside}</div>\n</div>'


def items(body: str) -> list[tuple[str | None, str]]:
    """(mark, text) of each item outside groups and inner environments; a body without items is one."""
    scan, depth, k, ends, starts = re.compile(r"\\(begin|end)(?![a-zA-Z])|\\(item)(?![a-zA-Z])|\\.|\{", re.S), 0, 0, pairs(body), []
    while m := scan.search(body, k):
        k = ends.get(m.start(), m.end()) if m[0] == "{" else m.end()
        if m[1]:
            depth += 1 if m[1] == "begin" else -1
        elif m[2] and not depth:
            starts.append((m.start(), m.end()))
    if not starts:
        return [(None, body)] if body.strip() else []
    out = []
    for (_, begin), stop in zip(starts, [s for s, _ in starts[1:]] + [len(body)], strict=True):
        text = body[begin:stop]
        mark, at = option(text, blanks(text, 0))
        out.append((mark, text[at:]))
    return out


def bibliography(body: str, page: Page, level: int) -> tuple:
    rows = []
    for part in re.split(r"\\bibitem(?![a-zA-Z])", body)[1:]:
        mark, at = option(part, blanks(part, 0))
        key, at = argument(part, at, pairs(part))
        key, mark = key.strip(), (page.cites.get(key.strip(), "") if mark is None else mark).strip()
        text = flow(part[at:].lstrip("%").strip(), page, level + 1, False).strip()
        plain = " ".join(html.unescape(re.sub(r"<[^>]+>", "", text)).split())
        page.entries.append((key, mark, text, plain))
        rows.append(f'<dt id="{quoted(key)}">[{html.escape(mark)}]</dt><dd>{text}</dd>')
    return None, "bibliography", None, "Bibliographie", "\n".join(['<dl class="bibliography">', *rows, "</dl>"])


def table(body: str, page: Page) -> tuple:
    at = blanks(body, 0, " \t\r\n")
    _, at = option(body, at)
    at = blanks(body, at, " \t\r\n")
    at = pairs(body).get(at, at)
    body = re.sub(r"\\hline(?![a-zA-Z])", "", body[at:])
    rows = []
    for row in split(body, r"\\\\")[::2]:
        if row.strip():
            cells = (re.sub(r"\\(dotfill|hfill)(?![a-zA-Z])", lambda m: " … " if m[1] == "dotfill" else " ", c).strip() for c in split(row, "&")[::2])
            rows.append("<tr>" + "".join(f"<td>{inline(c, page)}</td>" for c in cells) + "</tr>")
    return None, "table", None, None, "\n".join(['<table class="tabular">', *rows, "</table>"])


def uncommented(source: str) -> str:
    return "\n".join(re.sub(r"^((?:[^%\\]++|\\.)*+)%.*$", r"\1", line) for line in source.split("\n"))


def chapters_of(name: str, source: str, labels: dict[str, str], cites: dict[str, str], title: str | None = None) -> tuple[list[dict], list[tuple[str, str]]]:
    """The chapters of one source (id, title, number, pages as in CHAPTER), and the keys that no label answers. What comes before a chapter's heading makes one named after the source."""
    text, known = macros(uncommented(source))
    page = Page(labels, cites, known)
    out: list[dict] = []

    def open_page(id: str, heading: str | None) -> None:
        nonlocal page
        page = page.turned(id)
        out[-1]["pages"].append({"page": page, "title": heading, "blocks": []})

    def open_chapter(id: str, heading: str | None, number: str | None) -> None:
        out.append({"id": id, "title": heading, "number": number, "pages": []})

    def add(*made) -> None:
        out[-1]["pages"][-1]["blocks"].append(made)

    for event in top(text):
        if event[0] == "sec":
            _, kind, _, short, heading, label = event
            number = labels.get(label) if label else None
            prefix = f"{number} " if number else ""
            if kind == "chapter":
                brief = inline(short or heading, Page(labels, cites, known, page.id))
                id = label.replace(".", "-") if label else name
                open_chapter(id, brief, number)
                open_page(id, brief)
                add(label or id, "heading", number, None, f'<h1 id="{quoted(label or id)}">{prefix}{inline(heading, page)}</h1>')
                continue
            if not out:
                open_chapter(name, title, None)
            if kind == "section":
                id = label.replace(".", "-") if label else f"{out[-1]['id']}-s{len(out[-1]['pages']) + 1}"
                open_page(id, None)
                shown = out[-1]["pages"][-1]["title"] = inline(heading, page)
                add(label or id, "heading", number, None, f'<h2 id="{quoted(label or id)}">{prefix}{shown}</h2>')
                continue
            if not out[-1]["pages"]:
                open_page(out[-1]["id"], out[-1]["title"])
            id, shown = label or page.new_id("sub"), inline(heading, page).strip()
            if shown or number:
                add(id, "heading", number, None, f'<h3 id="{quoted(id)}">{prefix}{shown}</h3>')
            else:
                add(id, "anchor", None, None, f'<span class="anchor" id="{quoted(id)}"></span>')
            continue
        if not out:
            open_chapter(name, title, None)
        if not out[-1]["pages"]:
            open_page(out[-1]["id"], out[-1]["title"])
        if event[0] == "text":
            for part in paragraphs(event[1], page, 0):
                add(None, "paragraph", None, None, part)
            marks = list(LABEL.finditer(event[1]))
            if marks and not event[1][marks[-1].end() :].strip():
                page.pending = marks[-1][1]
        else:
            made = block(event[1], event[2], page)
            if made[4].strip():
                add(*made)
            page.pending = page.pending if event[0] == "dmath" else None
    names = ("id", "type", "label", "title", "html"), ("id", "number", "html"), ("id", "label", "html", "text")
    for chapter in out:
        for k, p in enumerate(chapter["pages"]):
            own = (p["blocks"], p["page"].notes, p["page"].entries)
            blocks, notes, entries = ([dict(zip(n, row, strict=True)) for row in rows] for n, rows in zip(names, own, strict=True))
            chapter["pages"][k] = {"id": p["page"].id, "title": p["title"], "html": "\n".join(b["html"] for b in blocks), "blocks": blocks, "footnotes": notes, "bibliography": entries}
    return out, page.missing


def keys_named(source):
    """The keys that a source refers to or defines."""
    return F.array_distinct(F.filter(F.transform(F.split(F.array_join(F.concat(*(F.regexp_extract_all(source, F.lit(KEYS), F.lit(k)) for k in (1, 2))), ","), ","), lambda k: F.trim(k)), lambda k: k != ""))


def rendered(sources: DataFrame, labels: DataFrame, id_column: str = "chapter_id", source_column: str = "src") -> DataFrame:
    """A row for each chapter of each source: source, pos, the columns of CHAPTER, and, with the first chapter, unresolved: (key, kind) of what no label answers.

    labels: (entry, key, display) as operators.labels makes them, a key once for each entry. A source's labels are those that it names."""
    rows = sources.select(F.col(id_column).cast("string").alias("source"), F.coalesce(source_column, F.lit("")).alias("src"))
    named = rows.select("src", F.explode(keys_named(F.col("src"))).alias("key")).select(F.xxhash64("src").alias("_at"), F.sha2("src", 256).alias("_row"), "key").distinct()
    shown = labels.where("display != ''").select("key", "entry", "display")
    answers = named.join(shown, "key").groupBy("_at", "_row").agg(F.collect_set(F.struct("entry", "key", "display")).alias("answers"))
    joined = rows.withColumn("_at", F.xxhash64("src")).withColumn("_row", F.sha2("src", 256)).join(answers, ["_at", "_row"], "left").select("source", "src", "answers")
    columns = ["source", "pos", *(c.split()[0] for c in CHAPTER.partition(", pages")[0].split(", ")), "pages", "unresolved"]

    def run(frames):
        for frame in frames:
            out = []
            for source, src, found in frame.itertuples(index=False):
                known = {kind: {a["key"]: a["display"] for a in ([] if found is None else found) if a["entry"] == kind} for kind in ("label", "cite")}
                chapters, missing = chapters_of(source or "", src, known["label"], known["cite"])
                out += [(source, k, c["id"], c["title"], c["number"], None, None, c["pages"], [{"key": key, "kind": kind} for key, kind in missing] if not k else []) for k, c in enumerate(chapters)]
            yield pd.DataFrame(out, columns=columns)

    return joined.mapInPandas(run, f"source string, pos int, {CHAPTER}, unresolved array<struct<key string, kind string>>")


def inline_html(c):
    """A column of inline TeX as HTML; references that need labels show as ??."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else inline(t, Page({}, {})))

    return run(c)


def leaked(chapters: DataFrame) -> DataFrame:
    """Counts of commands left in blocks that aren't formulas: (command, n)."""
    blocks = chapters.select(F.explode("pages").alias("p")).select(F.explode("p.blocks").alias("b")).select("b.*")
    bare = F.regexp_replace("html", r"(?s)\\\(.*?\\\)|\\\[.*?\\\]|\\begin\{([a-z]+\*?)\}.*?\\end\{\1\}", "")
    shown = blocks.where(~F.col("type").isin("equation", "displaymath")).select(F.explode(F.regexp_extract_all(bare, F.lit(r"(\\[a-zA-Z]+)"), F.lit(1))).alias("command"))
    return shown.groupBy("command").agg(F.count(F.lit(1)).alias("n"))
