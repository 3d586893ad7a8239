"""TeX to HTML on hand-made cases: inline text, formulas, environments, chapters."""

import json

import pytest
from pyspark.sql import functions as F

from folia.operators import chapters, render
from folia.operators.render import Page

INLINE = {
    r"caf\'e \c{c}a \^{\i}le na\"{\i}ve \'{g}": "café ça île naïve ǵ",
    r"\emph{a {\bf b} c} d}": "<em>a <strong> b</strong> c</em> d",
    r"{\it x": "<i> x</i>",
    r"a--b---c ``q'' `r' x~y": "a–b—c “q” ‘r' x y",
    r"5 \% \& < > & \$ \{z\}": "5 % &amp; &lt; &gt; &amp; $ {z}",
    r"\og mot\fg fin": "«\u202fmot\u202f» fin",
    r"voir \ldots \oe uvre": "voir …œuvre",
    r"$a<b$ et $\text{si $i>0$ ou}$": r"\(a&lt;b\) et \(\text{si } i&gt;0 \text{ ou}\)",
    r"\foo{bar} \foo baz": "bar baz",
    r"x\index{mot}y\vspace[1]{2}z\setcounter{a}{b}": "xyz",
    r"\texorpdfstring{$L$}{L} d": r"\(L\) d",
    r"a\\b\,c": "a<br/>b c",
    r"\label{k}t": '<span class="label-anchor" id="k"></span>t',
    r"\hbox{\emph x}": "<em>x</em>",
    r"a\'": "a",
    r"\texttt": "<code></code>",
    "": "",
    "$open": r"\(open\)",
}


@pytest.mark.parametrize("tex", INLINE)
def test_inline(tex):
    assert render.inline(tex, Page({}, {})) == INLINE[tex]


def test_references():
    page = Page({"a.1": "1.2", "eq:x": "$X_1$".replace("$", "")}, {"EGA": "3"}, id="I-1")
    got = render.inline(r"\ref{a.1} \eqref{eq:x} \ref{no} \cite[p.1]{EGA, Z} \cite{EGA}\footnote{un \emph{mot}\footnote{deux}}", page)
    assert got == (
        '<a class="ref" href="#a.1">1.2</a> (<a class="eqref" href="#eq:x">\\(X_1\\)</a>) <a class="ref" href="#no">??</a> '
        '<span class="cite">[<a class="cite-src" id="EGA-cite-1" href="#EGA">3</a>, <a class="cite-src" id="Z-cite-1" href="#Z">?</a>]</span> '
        '<span class="cite">[<a class="cite-src" id="EGA-cite-2" href="#EGA">3</a>]</span><a class="footnote-ref" id="fn-I-1-1ref" href="#fn-I-1-1"><sup>1</sup></a>'
    )
    assert page.missing == [("no", "ref"), ("Z", "cite")]
    assert [n[:2] for n in page.notes] == [["fn-I-1-1", "1"], ["fn-I-1-2", "2"]] and page.notes[1][2] == "deux" and page.notes[0][2].startswith("un <em>mot</em><a ")


def test_formulas():
    page = Page({"k": "4"}, {"B": "7"}, {"Z": (0, r"\mathbf{Z}"), "p": (1, "(#1)")})
    cases = {
        r"\widehat\Z": r"\widehat{\mathbf{Z}}",
        r"\p{x} \tag{\ast_1}": r"(x) \tag{*1}",
        r"\ref{k} \eqref{k} \cite{B} \ref{no}": "4 (4) [7] ?",
        r"\xymatrix{\ar[r]^-f X & Y \\ \ar[u] Z}": r"\xymatrix{X \ar[r]^-f&amp; Y \\Z \ar[u]}".replace("-f&", "-f &").replace(r"\\Z", r"\\ Z"),
        r"\mbox{a} $": r"\mbox{a} $",
    }
    squeezed = lambda t: t.replace(" ", "")
    for tex, want in cases.items():
        assert squeezed(render.formula(tex, page)) == squeezed(want)


def test_blocks():
    page = Page({"t": "2.1", "e": "3", "f": "4"}, {"B": "1"}, id="p")
    id, kind, label, title, html = render.block("theoreme", "[Nom]\\label{t}\nSoit $x$.\n\nFin.", page)
    assert (id, kind, label, title) == ("t", "theoreme", "2.1", "Théorème")
    assert html.startswith('<div class="thm thm-plain theoreme" id="t">') and '<span class="thm-num">2.1</span> <span class="thm-title">(Nom)</span>' in html and "<p>Fin.</p>" in html
    id, kind, label, _, html = render.block("align", r"a &= b \label{e} \\ c \tag{9} \\ d \label{f}", page)
    assert (id, kind, label) == ("e", "equation", "3, 4") and r"\tag{3}" in html and r"\tag{9}" in html and r"\tag{4}" in html and '<span class="label-anchor" id="f">' in html and "\\begin{align*}" in html
    assert render.block("$$", " x ", page)[1:] == ("displaymath", None, None, '<div class="displaymath" id="disp-p-1">\n\\[\nx\n\\]\n</div>')
    assert render.block("enumerate", r"\item[a)] un \item deux \begin{itemize}\item y\end{itemize}", page)[4] == (
        '<ol class="enumerate">\n<li><span class="item-label">a)</span> <p>un</p></li>\n<li><p>deux</p>\n<ul class="itemize">\n<li><p>y</p></li>\n</ul></li>\n</ol>'
    )
    assert render.block("tabular", r"{cc} a & $b & c$ \\ \hline \emph{d & e} & f \\", page)[4] == '<table class="tabular">\n<tr><td>a</td><td>\\(b &amp; c\\)</td></tr>\n<tr><td><em>d &amp; e</em></td><td>f</td></tr>\n</table>'
    assert render.block("thebibliography", r"{9}\bibitem{B} \emph{Livre}, 1960. \bibitem[X]{C} Autre", page)[4] == '<dl class="bibliography">\n<dt id="B">[1]</dt><dd><em>Livre</em>, 1960.</dd>\n<dt id="C">[X]</dt><dd>Autre</dd>\n</dl>'
    assert page.entries[0] == ("B", "1", "<em>Livre</em>, 1960.", "Livre, 1960.")
    assert render.block("proof", "[Preuve de 1] ok", page)[:4] == ("proof-p-2", "proof", None, "Preuve de 1")
    assert render.block("center", "x", page)[4] == '<div class="center"><p>x</p></div>' and render.block("autre", "x", page)[4] == "<p>x</p>"
    got = render.block("enonce*", "[remark]{Exemple 3} ici", page)
    assert got[:4] == ("enonce-p-3", "enonce", None, "Exemple 3") and 'class="thm thm-remark enonce"' in got[4]


SOURCE = r"""
% a comment \chapter{no}
\newcommand{\A}{\mathscr{A}}
\chapter[Court]{Long titre}\label{II}
Un texte avec $\A$.

Deux.\footnote{note}
\section{Premier} \label{II.1}
\subsection{}\label{II.1.1}
Avant. \label{II.1.2}
\begin{lemme} Corps \eqref{eq:a}. \end{lemme}
\begin{equation}\label{eq:a} x \end{equation}
\section{Second}
\[ y \]
"""


def test_chapters(spark):
    labels = spark.createDataFrame([("label", k, d) for k, d in (("II", "II"), ("II.1", "1"), ("II.1.1", "1.1"), ("II.1.2", "1.2"), ("eq:a", "7"), ("other", "x"))] + [("cite", "II", "99")], "entry string, key string, display string")
    sources = spark.createDataFrame([("a", SOURCE), ("b", "orphan \\ref{zz}"), ("c", None), ("d", ""), ("b", "orphan \\ref{zz}")], "chapter_id string, src string")
    got = render.rendered(sources, labels).orderBy("source", "pos").collect()
    assert [r.source for r in got] == ["a", "b", "b"]
    first = got[0]
    assert (first.chapter_id, first.title, first.number, first.unresolved) == ("II", "Court", "II", [])
    assert [(p.id, p.title) for p in first.pages] == [("II", "Court"), ("II-1", "Premier"), ("II-s3", "Second")]
    assert [(b.id, b.type, b.label) for p in first.pages for b in p.blocks] == [
        ("II", "heading", "II"), (None, "paragraph", None), (None, "paragraph", None), ("II.1", "heading", "1"), ("II.1.1", "heading", "1.1"), (None, "paragraph", None),
        ("II.1.2", "lemme", "1.2"), ("eq:a", "equation", "7"), ("II-s3", "heading", None), ("disp-II-s3-1", "displaymath", None),
    ]
    assert first.pages[0].blocks[0].html == '<h1 id="II">II Long titre</h1>' and first.pages[0].blocks[1].html == r"<p>Un texte avec \(\mathscr{A}\).</p>"
    assert [(n.id, n.number, n.html) for n in first.pages[0].footnotes] == [("fn-II-1", "1", "note")]
    assert all(p.html == "\n".join(b.html for b in p.blocks) for p in first.pages)
    assert (got[1].chapter_id, [tuple(u) for u in got[1].unresolved]) == ("b", [("zz", "ref")])
    nested = render.rendered(sources, labels).drop("source", "pos", "unresolved").where("chapter_id = 'II'")
    assert chapters.compare(nested, nested, ["un"]).count() == 0
    assert render.rendered(sources.limit(0), labels).count() == 0 and render.rendered(sources, labels.limit(0)).count() == 3
    bad = spark.createDataFrame([("II", [{"id": None, "blocks": [("x", "paragraph", r"\foo a \(\bar\) \foo"), ("y", "equation", r"\baz")]}])], "chapter_id string, pages array<struct<id string, blocks array<struct<id string, type string, html string>>>>")
    assert [tuple(r) for r in render.leaked(bad).collect()] == [(r"\foo", 2)]


def test_long_and_odd_texts():
    for text in ("{" * 20_000, "}" * 20_000, "{a" * 20_000 + "}" * 20_000, r"\emph{" * 5_000, r"\[" * 5_000, "$" * 20_001, r"\footnote{" * 500, r"\begin{center}" * 300, r"\item[" * 3_000, "\\", r"\begin{", r"\xymatrix{" + r"\ar[" * 3_000 + "}"):
        blocks, _ = render.chapters_of("s", text, {}, {})
        assert isinstance(blocks, list)
        render.inline(text, Page({}, {}))
    assert render.inline("{\\it " * 20_000 + "x", Page({}, {})).count("</i>") == 20_000


def test_column(spark):
    rows = spark.createDataFrame([(r"\emph{a}",), (None,)], "t string").select(render.inline_html(F.col("t")).alias("h")).collect()
    assert json.dumps([r.h for r in rows]) == '["<em>a</em>", null]'
