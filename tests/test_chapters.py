"""Operators over nested chapters, repairs, translation around formulas, sources and sinks, on hand-made cases."""

import json

import pytest
from pyspark.sql import functions as F

from folia.operators import chapters, ordered, repair, tex, translate
from folia.sources import readers, writers


def block(html, id=None, type="paragraph", label=None, title=None):
    return (id, type, label, title, html)


def chapter(spark, *pages, number="II", title="Titre", name="II"):
    return spark.createDataFrame([(name, title, number, None, None, [(i, t, None, b, n, None) for i, t, b, n in pages])], readers.CHAPTER)


@pytest.fixture(scope="module")
def french(spark):
    return chapter(spark, ("II", "Début", [block("<p>un</p>", title="Lemme 2.1."), block("", id="x")], [("f1", "1", "note")]), ("II-1", None, [], []))


def test_fragments_and_back(spark, french):
    rows = {r.key: r.text for r in chapters.fragments(french).collect()}
    assert rows == {"title": "Titre", "p0.title": "Début", "p0.b0.title": "Lemme 2.1.", "p0.b0.html": "<p>un</p>", "p0.f0.html": "note"}
    new = spark.createDataFrame([("II", k, t.upper()) for k, t in rows.items() if k != "title"] + [("II", "p9.title", "no"), ("V", "title", "no")], "chapter_id string, key string, text string")
    got = chapters.put_back(french, new).first()
    assert got.title == "Titre" and got.pages[0].blocks[0].html == "<P>UN</P>" and got.pages[0].blocks[0].title == "LEMME 2.1." and got.pages[0].footnotes[0].html == "NOTE"
    assert got.pages[0].blocks[1].html == "" and got.pages[1].title is None and got.pages[1].blocks == []
    assert [r.key for r in chapters.unanswered(chapters.fragments(french), new).collect()] == ["title"]
    assert chapters.put_back(french, new.limit(0)).first() == french.first()
    null = spark.createDataFrame([("n", None, None, None, None, None)], readers.CHAPTER)
    assert chapters.fragments(null).count() == 0 and chapters.totals(null).first()[1:] == (0, 0, 0) and chapters.put_back(null, new).first().pages is None
    assert chapters.totals(french).first()[1:] == (2, 2, 1)


def test_titles_and_order(spark):
    cases = {"Lemme 2.1.": "Lemma 2.1.", "REMARQUES": "REMARKS", " théorème ": "Theorem", "Lemme": "Lemma", "Chose 1": None, "Lemme de Nakayama": None, "": None, "Définition 1.2": "Definition 1.2"}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", chapters.mapped_title(F.col("t")).alias("m")).collect()
    assert {r.t: r.m for r in rows} == cases
    stems = spark.createDataFrame([(s,) for s in ("10", "2", "XI", "avant", "02")], "s string")
    assert [r.s for r in stems.orderBy(*chapters.reading_order(F.col("s"))).collect()] == ["02", "2", "10", "XI", "avant"]


def test_compare(spark, french):
    assert [(r.severity, r.code) for r in chapters.compare(french, french, ["un"]).collect()] == []
    other = chapter(spark, ("II", "x", [block('<p id="q">un</p>', type="list"), block('\\(a\\)<span class="thm-name"> Preuve </span><span class="author">par A', id="y", title="t")], [("f1", "2", "n")]), ("II-1", None, [block("more")], []), number="III", title="")
    got = {(r.page_id, r.idx, r.code) for r in chapters.compare(french, other, []).collect()}
    assert got == {(None, None, "number"), (None, None, "title"), ("II", None, "footnotes"), ("II", 0, "type"), ("II", 0, "ids"), ("II", 0, "title_null"), ("II", 1, "id"), ("II", 1, "title_null"), ("II", 1, "math"), ("II", 1, "french_spans"), ("II-1", None, "block_count")}
    swapped = chapter(spark, ("II-1", None, [], []), ("II", None, [], []))
    assert [r.code for r in chapters.compare(french, swapped, []).collect()] == ["page_ids"]
    assert [r.code for r in chapters.compare(french, french.limit(0), []).collect()] == ["missing_en"] and [r.code for r in chapters.compare(french.limit(0), french, []).collect()] == ["missing_fr"]
    wordy = chapter(spark, ("II", "t", [block("de la le et les des un une que qui")], []))
    assert [r.code for r in chapters.compare(wordy, wordy, "de la le et les des un une que qui".split()).collect()] == ["french_words"]


def test_interleaved(spark):
    rows = [(1, ["a", "b"], ["a", "X", "b", "Y"], ["1", "2"]), (2, ["a", "b"], ["b"], ["1", "2"]), (3, ["a"], ["a", "c"], []), (4, [], ["a"], []), (5, ["a", "a"], ["a", "a"], ["1", "2"])]
    df = spark.createDataFrame(rows, "k int, old array<string>, new array<string>, other array<string>")
    n, chars = chapters.insertion_totals(F.col("old"), F.col("new"))
    got = {r.k: (r.i, r.n, r.c) for r in df.select("k", chapters.interleaved(F.col("old"), F.col("new"), F.col("other")).alias("i"), n.alias("n"), chars.alias("c")).collect()}
    assert got[1] == (["1", "X", "2", "Y"], 2, 2) and got[2][0] is None and got[3][0] is None and got[4] == (["a"], 1, 1) and got[5] == (["1", "2"], 0, 0)


def test_lookups(spark):
    cites = spark.createDataFrame([("k1",), ("k2",), ("k3",), ("k1",)], "key string")
    numbers, labels = spark.createDataFrame([("k1", "7")], "key string, num string"), spark.createDataFrame([("k1", "x"), ("k2", "Th. 2")], "key string, display string")
    assert sorted((r.key, r.shown, r.is_found) for r in chapters.cited(cites, numbers, labels).collect()) == [("k1", "7", True), ("k1", "7", True), ("k2", "Th. 2", True), ("k3", "?", False)]
    entries = spark.createDataFrame([("I", ["p1", "p2"]), ("II", []), ("III", None)], "id string, page_ids array<string>")
    toc = spark.createDataFrame([("p1", "t")], "page_id string, title string")
    assert {r.id: r.toc and r.toc.title for r in chapters.contents_of(entries, toc).collect()} == {"I": "t", "II": None, "III": None}
    heads = spark.createDataFrame([("a", "VI B", "VIB"), ("b", "VI", "VII"), ("c", None, "I"), ("d", "", "I"), ("e", "I", None)], "chapter_id string, n string, number string")
    assert sorted(r.chapter_id for r in chapters.numeral_warnings(heads, F.col("n")).collect()) == ["b", "e"]
    blocks = spark.createDataFrame([("c", "b1"), ("c", "b2")], "chapter_id string, id string")
    comments = spark.createDataFrame([("c", "b1", 2, "two"), ("c", "b1", 1, "one"), ("c", "gone", 1, "z")], "chapter_id string, block_id string, ord int, body string")
    assert {r.id: r.comments for r in chapters.commented(blocks, comments).collect()} == {"b1": ["one", "two"], "b2": []}
    kinds = spark.createDataFrame([("MathJax: Undefined control sequence",), ("dangling ref #x",), ("404",)], "m string").select(chapters.error_category(F.col("m")).alias("c"))
    assert [r.c for r in kinds.collect()] == ["mathjax", "crossref", "other"]


def test_markers(spark):
    html = '<p>a<a class="r" href="#fn1"><sup>*</sup></a> b <a href="#other">o</a><a id="old" href="#fn2"> </a></p>'
    new, marks = chapters.renamed_markers(F.col("h"), F.lit("IV"), F.array(F.lit("fn1"), F.lit("fn2")))
    row = spark.createDataFrame([(html,), ("",)], "h string").select(new.alias("n"), marks.alias("m")).collect()
    assert row[0].n == '<p>a<a class="r" href="#IV-fn1" id="IV-fn1ref"><sup>*</sup></a> b <a href="#other">o</a><a href="#IV-fn2" id="IV-fn2ref"> </a></p>'
    assert [tuple(m) for m in row[0].m] == [("fn1", "*"), ("fn2", "")] and row[1].n == "" and row[1].m == []
    notes = spark.createDataFrame([("IV", "fn1", "1", 1), ("IV", "fn2", "", 2), ("IV", "fn3", "(3)", 3), ("IV", "fn4", None, 4)], "chapter_id string, id string, printed string, seq int")
    marked = spark.createDataFrame([("IV", "fn1", 0, "*"), ("IV", "fn2", 1, "")], "chapter_id string, id string, ord int, number string")
    assert [r.number for r in chapters.numbered_notes(notes, marked).orderBy("id").collect()] == ["*", "2", "(3)", "4"]
    assert [r.number for r in chapters.numbered_notes(notes, marked, True).orderBy("id").collect()] == ["*", "", "(3)", "4"]


def test_text_in_math(spark):
    html = r"\(\text{ si } x \textrm{ou} y \text{pour tout} \text{finite} A\text{-module libre}\)"
    out, left = chapters.text_in_math(F.col("h"), [(r"A\text{-module libre}", r"\text{free }A\text{-module}")], {"si": "if", "ou": "or"})
    got = spark.createDataFrame([(html,), (r"\text{ si }",), ("none",)], "h string").select(out.alias("o"), left.alias("l")).collect()
    assert got[0].o == r"\(\text{ if } x \textrm{or} y \text{pour tout} \text{finite} \text{free }A\text{-module}\)" and got[0].l == ["pour tout"]
    assert got[1].o == r"\text{ if }" and got[2].o == "none" and got[2].l == []


def test_verified(spark):
    volume = chapter(spark, ("II", "t", [block(r"\foo \(\bar\) \foo"), block(r"\baz", type="equation")], [("f", "1", "n")])).withColumn("pages", F.transform("pages", lambda p: p.withField("html", F.lit("other"))))
    got = {(r.kind, r.name): r.n for r in chapters.verified(volume, spark.createDataFrame([("k",), ("k",)], "key string")).collect()}
    assert got == {("total", "pages"): 1, ("total", "blocks"): 2, ("total", "footnotes"): 1, ("total", "bibliography"): 0, ("block_type", "paragraph"): 1, ("block_type", "equation"): 1, ("leak", r"\foo"): 2, ("unresolved", "k"): 2, ("page_html", "II"): 1}
    assert chapters.verified(chapters.with_page_html(volume), spark.createDataFrame([], "key string")).where("kind = 'page_html'").count() == 0


def test_mixed_and_swapped_groups():
    assert repair.wrap_bare(r"(B\mapsto\operatorname{Der}_R\(B,M\))", merge=True)[0] == r"\(B\mapsto\operatorname{Der}_R(B,M)\)"
    assert repair.wrap_bare(r"(see \(x\) and y_1)", merge=True)[0] == r"(see \(x\) and y_1)"
    assert repair.wrap_bare(r"(B_1\(x\))")[0] == r"(B_1\(x\))"
    cases = {
        r"a (f\(x\)) b": r"a \(f(x)\) b", r"(\(f^*\)^{-1}(\mathfrak L))": r"\((f^*)^{-1}(\mathfrak L)\)", r"(voir \(x\))": r"(voir \(x\))", r"(\(x\))": r"(\(x\))",
        r"\(a (b\(c\)) d\)": r"\(a \(b(c)\) d\)", "(x)": "(x)", "": "", r"(dans f\(x\))": r"(dans f\(x\))", "(" * 5000: "(" * 5000,
    }
    for text, want in cases.items():
        assert repair.swap_delimiters(text)[0] == want


def test_point_fixes(spark):
    rows = spark.createDataFrame([("X", "a-a-b"), ("XI", "a"), ("XII", None)], "chapter_id string, src string")
    fixes = spark.createDataFrame([("X", 1, "a", "bb"), ("X", 2, "b", "c"), ("X", 3, "q", "r")], "chapter_id string, ord int, old string, new string")
    got = {r.chapter_id: (r.src, r.hits) for r in repair.point_fixed(rows, fixes).collect()}
    assert got["X"] == ("cc-cc-c", [2, 5, 0]) and got["XI"] == ("a", []) and got["XII"][0] is None


def test_translation_around_formulas(spark):
    def engine(texts):
        return [None if "no answer" in t else t.replace("[[M0]]", "").upper() if "lost" in t else t.upper() for t in texts]

    cache = spark.createDataFrame([("cached ", "from cache ")], "src string, dst string")
    rows = spark.createDataFrame([(1, r"say \(x\) twice"), (2, r"lost \(y\) here"), (3, "no answer"), (4, ""), (5, None), (6, r"\(z\)")], "key int, src string")
    got, grown = translate.with_formulas(rows, cache, engine)
    assert {r.key: r.dst for r in got.collect()} == {1: r"SAY \(x\) TWICE", 2: r"LOST \(y\) HERE", 3: "no answer", 4: "", 5: None, 6: r"\(z\)"}
    assert grown.where("src = 'cached '").count() == 1
    pairs = spark.createDataFrame([("a", '<p id="i">cached \\(x\\) b</p>', "<p>wrong</p>"), ("b", "<p>x</p>", "<p>fine</p>"), ("c", "<p>y</p>", None), ("d", None, "z")], "key string, fr_html string, en_html string")
    done, _ = translate.repaired(pairs, cache, engine)
    assert {r.key: (r.en_html, r.is_repaired) for r in done.collect()} == {"a": ('<p id="i">from cache \\(x\\) B</p>', True), "b": ("<p>fine</p>", False), "c": (None, False), "d": ("z", False)}


def test_variants_and_volumes(spark):
    cases = {r"a \v{x}{y} b": "a y b", r"\v{a{b}}{c \v{d}{e}}": "c e", r"\v {o}{\}n}": r"\}n", r"\v{x}": r"\v{x}", r"\vec{x}{y}": r"\vec{x}{y}", r"\v{x}{y": r"\v{x}{y", "": "", r"\v{a}{}\v{b}{c}.": "c."}
    for text, want in cases.items():
        assert tex.chosen(text, "v", 1) == want
    assert tex.chosen(r"\v{a{b}}{c}\v{\v{d}{e}}{f}", "v", 0) == "a{b}d"
    df = spark.createDataFrame([("s", "pre\n\\chapter{A}x\\chapter{B}y"), ("t", "none")], "k string, src string")
    got = {(r.k, r.file): r.src for r in ordered.volume_files(df, "k", "src").collect()}
    assert got == {("s", "main"): "pre\n\\input{chapter-001}\n\\input{chapter-002}\n", ("s", "chapter-001"): "\\chapter{A}x", ("s", "chapter-002"): "\\chapter{B}y", ("t", "main"): "none"}
    assert spark.createDataFrame([(r"\v{x}{y}",), (None,)], "t string").select(tex.variants(F.col("t"), "v").alias("t")).collect() == [("y",), (None,)]


def test_sources(spark, tmp_path, french):
    for name, text in (("b.tex", "B"), ("a.tex", "A"), ("x.bbl", "bib")):
        (tmp_path / name).write_text(text)
    assert [(r.file, r.src) for r in readers.listed(spark, str(tmp_path), ["b.tex", "gone.tex", "a.tex"], "x.bbl").collect()] == [("b.tex", "B"), ("a.tex", "A"), ("x.bbl", "bib")]
    order = spark.createDataFrame([("b", 1), ("gone", 2), ("a", 3)], "chapter_id string, ord int")
    assert [(r.chapter_id, r.src) for r in readers.in_order(order, readers.texts(spark, f"{tmp_path}/*.tex")).collect()] == [("b", "B"), ("gone", None), ("a", "A")]
    for place, text in (("parts/II/p1.json", json.dumps({"id": "p1", "blocks": [{"html": "x"}]})), ("parts/II/p2.json", "{broken")):
        (tmp_path / place).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / place).write_text(text)
    got = {r.page_id: (r.chapter_id, r.id, bool(r["_bad"])) for r in readers.parts(spark, f"{tmp_path}/parts").collect()}
    assert got == {"p1": ("II", "p1", False), "p2": ("II", None, True)}
    for state, title in (("old", "one"), ("new", "two")):
        (tmp_path / state).mkdir()
        (tmp_path / state / "II.json").write_text(json.dumps({"chapter_id": "II", "title": title, "pages": []}))
    (tmp_path / "new" / "III.json").write_text(json.dumps({"chapter_id": "III", "title": "only new", "pages": []}))
    assert [(r.chapter_id, r.old.title, r.new.title) for r in readers.snapshots(spark, f"{tmp_path}/old", f"{tmp_path}/new").collect()] == [("II", "one", "two")]


def test_sinks(spark, tmp_path, french):
    path = f"file://{tmp_path}/cache"
    for rows in ([("b", "B"), ("a", "A")], [("b", "B"), ("c", "C")]):
        writers.save_cache(spark.createDataFrame(rows, "src string, dst string"), path)
    both = spark.read.parquet(path).unionByName(spark.createDataFrame([("d", "D")], "src string, dst string"))
    writers.save_cache(both, path)
    assert [r.src for r in spark.read.parquet(path).orderBy("src").collect()] == ["b", "c", "d"] and len(list(tmp_path.iterdir())) == 1
    listing = writers.split_pages(french, f"{tmp_path}/pages").collect()
    assert {(r.page_id, r.n_blocks, r.n_chars) for r in listing} == {("II", 2, 9), ("II-1", 0, 0)} and (tmp_path / "pages/chapter_id=II/page_id=II-1").exists()
    writers.written(french, f"{tmp_path}/dry", False)
    assert not (tmp_path / "dry").exists()
    anchors = spark.createDataFrame([("x", "II-1", 2), ("x", "II", 1)], "anchor string, page_id string, ord int")
    frames = writers.manifest(french.withColumn("ord", F.lit(0)), anchors)
    assert frames[0].first().page_ids == ["II", "II-1"] and [(r.page_id, r.level, r.is_numbered_chapter) for r in frames[1].collect()] == [("II", 1, True), ("II-1", 2, False)] and frames[2].first().page_id == "II"
    assert writers.write_manifest(frames, f"{tmp_path}/m", "fr", "fr") and not writers.write_manifest(frames, f"{tmp_path}/n", "en", "fr") and not (tmp_path / "n").exists()
    writers.write_config(spark, {"b": 1, "a": "é"}, f"{tmp_path}/config")
    assert json.loads(spark.read.text(f"{tmp_path}/config").first().value) == {"a": "é", "b": 1}
