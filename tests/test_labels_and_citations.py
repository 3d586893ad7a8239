"""Auxiliary labels, input closure and citations on small hand-made rows."""

import pytest

from folia.operators import citations, labels, translate

MAIN = "\\newlabel{a}{{1.2}{7}{Title {x}}{section.1.2}{}}\n\\@input{sub/b.aux}\n\\bibcite{K}{{16~bis}}\n\\newlabel{open}{{3}{4}"
FILES = [("r/main.aux", MAIN), ("r/sub/b.aux", "\\newlabel{b}{{{$8'$}}{9}{}{equation.3}{}}\n\\@input{../r.aux}"), ("r/other.aux", "\\newlabel{c}{{1}{1}{}{}{}}"), ("r/none.aux", None)]


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame(FILES, "path string, text string")


def test_entries(files):
    got = {r.key: (r.entry, r.num, r.display, r.anchor, r.kind) for r in labels.labels(files).collect()}
    assert got == {
        "a": ("label", "1.2", "1.2", "section.1.2", "section"),
        "K": ("cite", "{16~bis}", "16 bis", "", ""),
        "b": ("label", "{$8'$}", "8'", "equation.3", "equation"),
        "c": ("label", "1", "1", "", ""),
    }


def test_reachable(files, spark):
    roots = spark.createDataFrame([("r/main.aux",)], "path string")
    assert {r.path for r in labels.reachable(files, roots).collect()} == {"r/main.aux", "r/sub/b.aux"}
    ring = spark.createDataFrame([("x", "\\@input{y}"), ("y", "\\@input{x}")], "path string, text string")
    assert labels.reachable(ring, ring.where("path = 'x'")).count() == 2


def test_citations(spark):
    rows = [
        ("c", 0, 0, None, "<p>See EGA IV and EGA, not \\(EGA\\) or EGA-like.</p>"),
        ("c", 0, 1, None, "<p>Elements (cité: EGA)</p>"),
        ("c", 0, 2, None, "<p>Fourth part, (cité: EGA IV)</p>"),
        ("c", 1, 0, None, "<p>EGA again <b title='EGA'>x</b></p>"),
        ("d", 0, 0, None, "<p>EGA elsewhere</p>"),
        ("d", 0, 1, "k", None),
        ("d", 0, 2, None, "<p>Never mentioned (cité: QRS)</p>"),
    ]
    out = citations.wired(spark.createDataFrame(rows, "chapter_id string, page_idx int, block_idx int, id string, html string"))
    got = {(r.chapter_id, r.page_idx, r.block_idx): (r.id, r.html) for r in out.collect()}
    assert len(got) == len(rows)
    link = lambda key, n, text: f'<a class="bibref cite-src" id="{key}-cite-{n}" href="#{key}">{text}</a>'
    assert got["c", 0, 0][1] == f"<p>See {link('bib-EGA-IV', 1, 'EGA IV')} and {link('bib-EGA', 1, 'EGA')}, not \\(EGA\\) or EGA-like.</p>"
    assert got["c", 1, 0][1] == f"<p>{link('bib-EGA', 2, 'EGA')} again <b title='EGA'>x</b></p>"
    back = '<a class="bibref-back" data-bib="bib-EGA" href="#bib-EGA-cite-1" title="retour">↩</a>'
    assert got["c", 0, 1] == ("bib-EGA", f'<p><span class="bib-anchor" id="bib-EGA"></span>Elements {back}</p>')
    assert got["d", 0, 0] == (None, "<p>EGA elsewhere</p>") and got["d", 0, 1] == ("k", None)
    assert got["d", 0, 2] == ("bib-QRS", '<p><span class="bib-anchor" id="bib-QRS"></span>Never mentioned</p>')
    assert {r.key for r in citations.cited_keys(out).collect()} == {"bib-EGA", "bib-EGA-IV"}


def test_chunks(spark):
    size = lambda t: len(t.split())
    assert translate.chunks("One two. Three four five. Six", size, 5) == ["One two. Three four five.", "Six"]
    assert translate.chunks("a b c d e f. g", size, 3) == ["a b c", "d e f.", "g"]
    assert translate.chunks("", size) == []
    rows = spark.createDataFrame([(1, "a b. c d"), (2, None), (3, "")], "key int, src string")
    assert sorted(map(tuple, translate.chunked(rows, size, 2).collect())) == [(1, 0, "a b."), (1, 1, "c d")]
