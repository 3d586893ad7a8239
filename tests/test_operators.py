"""Fixtures for the document operators; the SQL comparisons cover the driver's tables."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from folia.functions import text as T
from folia.operators import links, ordered, parse, repair, tex, translate, validate
from folia.plans import registry
from folia.sources import readers, writers

DATA = "/root/testdata/sf0.001"


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items())).select(column).first()[0]


@pytest.mark.parametrize("name", ["page_profile", "page_split", "greedy_batches", "violations", "dangling_refs", "protect_restore_all", "fragments_put_back", "compared_chapters", "verified_volume", "interleaved_blocks"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark", "conversations", "labels", "events"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = registry.queries()[name](spark, DATA).toPandas()
    want = con.sql(registry.oracles()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(map(repr, got[cols].astype(str).itertuples(index=False))) == sorted(map(repr, want[cols].astype(str).itertuples(index=False)))


def test_titles(spark):
    got = one(spark, T.title_parts(F.col("h")), h='EXPOSÉ XIV<br/>Les  foncteurs<sup>1</sup> <span class="author">A. <i>B</i></span>')
    assert (got.title, got.numeral, got.author) == ("Les foncteurs", "XIV", "A. B")


def test_comment_and_leaks(spark):
    assert one(spark, T.strip_comment(F.col("c")), c=r"a \% b % c") == r"a \% b "
    assert one(spark, T.leaked_commands(F.col("c")), c=r"\(\alpha\) <b>\leak</b>") == [r"\leak"]


def test_block_types(spark):
    got = [one(spark, T.block_type(F.col("t"), F.col("c")), t=t, c=c) for t, c in (("h2", ""), ("div", "thm thm-plain lemme"), ("div", "thm"), ("p", ""), ("ul", ""), ("div", "proof"))]
    assert got == ["heading", "lemme", "theoreme", "paragraph", "list", "proof"]


def test_parse_pages_and_notes():
    source = '<body>loose<!-- no --><h1>T</h1><p>a <a id="fn1ref" href="#fn1">1</a><p>b<h2 id="1.2">S</h2><hr><ol class="footnotes"><li id="fn1">n</li></ol></body>'
    rows = parse.parsed("c", source)
    assert [(r["tag"], r["page_idx"], r["is_note"]) for r in rows] == [("p", 0, False), ("h1", 0, False), ("p", 0, False), ("p", 0, False), ("h2", 1, False), ("note", 1, True)]
    assert rows[-1]["id"] == "fn1" and rows[-1]["html"] == "n"
    assert parse.parsed("c", None) == []


def test_notes_find_their_page(spark):
    notes = spark.createDataFrame([("c", "fn1"), ("c", "fn2")], "chapter_id string, id string")
    blocks = spark.createDataFrame([("c", 0, "x"), ("c", 1, '<a id="fn1ref">')], "chapter_id string, page_idx int, html string")
    assert sorted(map(tuple, links.attached(notes, blocks, F.lit(9)).select("id", "page_idx").collect())) == [("fn1", 1), ("fn2", 9)]


def test_repairs():
    assert repair.delimiters(r"\(a\) ok")[0] == r"\(a\) ok"
    assert repair.delimiters(r"a\) b")[0] == "a) b"
    assert repair.delimiters(r"\(f \(x\) = 1\)")[0] == r"\(f (x) = 1\)"
    assert "unclosed" in repair.delimiters(r"\(a")[1]
    assert repair.wrap_bare("(x=1) (i) (see (A))")[0] == r"\(x=1\) (i) (see \(A\))"


def test_tex():
    text, known = tex.macros(r"\newcommand{\R}[1]{\mathbf{#1}}\def\a{b}x \R{y} \a \\a")
    assert tex.expand(text, known) == r"x \mathbf{y} b \\a"
    assert [e[:2] for e in tex.events(r"t \section{S} \begin{thm}a\begin{thm}b\end{thm}\end{thm} \[x\]")] == [("text", ""), ("sec", "section"), ("env", "thm"), ("dmath", "")]
    assert tex.slug("Théorie  des X!") == "theorie-des-x"


def test_subsequence_and_batches(spark):
    df = spark.createDataFrame([(["a", "b"], ["a", "n", "b"], [5, 20, 1])], "o array<string>, n array<string>, s array<int>")
    got = df.select(ordered.inserted(F.col("o"), F.col("n")), ordered.inserted(F.col("n"), F.col("o")), ordered.greedy_batches(F.col("s"), 10, True), ordered.greedy_batches(F.col("s"), 10, False)).first()
    assert list(got) == [[1], None, [0, 1, 2], [0, 0, 1]]


def test_fragments(spark):
    cases = [("<b>[[M0]]</b>", "<b>[[M0]]</b>", None), ("<b>x</b>", "<i>x</i>", "tags"), ("[[M0]]", "x", "placeholders"), ("a", None, "missing")]
    for s, t, want in cases:
        df = spark.createDataFrame([(s, t)], "s string, t string")
        assert df.select(validate.fragment_problem(F.col("s"), F.col("t"))).first()[0] == want


def test_engine_is_asked_once(spark):
    fragments = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("4", " ")], "key string, src string")
    cache = spark.createDataFrame([("b", "B!")], "src string, dst string")
    out, grown = translate.translated(fragments, cache, lambda ts: [t.upper() for t in ts])
    assert {r.key: r.dst for r in out.collect()} == {"1": "A", "2": "A", "3": "B!", "4": " "}
    assert grown.count() == 2


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k":"1","t":"x"}\n\nbroken\n')
    rows = readers.json_lines(spark, str(tmp_path / "a.jsonl"), "k string, t string").collect()
    assert sorted((r.k or "", r["_bad"] or "") for r in rows) == [("", "broken"), ("1", "")]
    assert [(r.file, r.line, r.raw) for r in readers.bad_lines(spark, str(tmp_path), "k string, t string").collect()] == [("a.jsonl", 3, "broken")]
    (tmp_path / "II.html").write_text("<p>x")
    assert readers.texts(spark, str(tmp_path / "II.html")).first().chapter_id == "II"
    ch = spark.createDataFrame([("c", None, None, None, None, [("p", "t", None, [("b", "paragraph", None, None, "x")], [], None)])], readers.CHAPTER)
    assert writers.round_trips(ch, "pages").count() == 0
    assert writers.guarded(ch, ch).count() == 0


@pytest.mark.parametrize("name", ["html_blocks", "repaired_math", "wrapped_math", "tex_events", "title_slugs"])
def test_scanner_queries_run(spark, name):
    assert registry.queries()[name](spark, DATA).count() > 0


def round_trip(text):
    """By brute force: spans to placeholders by number, each placeholder back to its span from the first to the last."""
    spans = re.findall(r"\$[^$]*\$", text)
    numbers = iter(range(len(spans)))
    safe = back = re.sub(r"\$[^$]*\$", lambda m: f"[[M{next(numbers)}]]", text)
    for k, span in enumerate(spans):
        back = back.replace(f"[[M{k}]]", span)
    return back == text and sorted(map(int, re.findall(r"\[\[M([0-9]+)\]\]", safe))) == list(range(len(spans)))


def test_protect_restore_covers_every_document(spark, tmp_path):
    texts = ["", "plain", "$a$ b $c$", "a $ b", "[[M0]]", "[[M0]] $x$", "$[[M0]]$", "$[[M1]]$ $y$", "[[M7]] x", "$$ \n$p\nq$", "$a$" * 12]
    spark.createDataFrame([(k + 1, t) for k, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for folder in (str(tmp_path), DATA):
        want = {r.doc_id: round_trip(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
        assert {r.doc_id: r.round_trip for r in registry.queries()["protect_restore_all"](spark, folder).collect()} == want


EN_WORDS = "the a an and or of to in is are was were for with that this from by on as be it its may most any used using should".split()
FR_WORDS = "le la les un une des du de et ou dans est sont pour avec que qui par sur comme ce cette ces on il elle nous soit être tout".split()


def english(text):
    words = re.findall(r"[A-Za-zÀ-ÿ']+", text.lower())
    en, fr = (sum(w in known for w in words) for known in (EN_WORDS, FR_WORDS))
    return len(words) >= 5 and en >= 3 and en > 2 * fr


def degenerate(source, target):
    words = re.findall(r"[A-Za-z']+", target.lower())
    grams = [tuple(words[i : i + 4]) for i in range(len(words) - 3)]
    return len(target) > max(600, 4 * len(source)) or bool(re.search("[\u0400-\u04ff\u3400-\u9fff]", target)) or (len(words) >= 30 and max(map(grams.count, set(grams))) >= 5)


@pytest.mark.parametrize("name", ["already_english_all_words", "degenerate_translation_all_rules"])
def test_whole_rules_of_the_reference(spark, tmp_path, name):
    texts = ["", "it may be used by any", "dans ce cas il sont nous the of and", "it's on a l'on by an x'y", "a \u0416 b", "\u3400", "\u4dff", "\u9fff", "\ua000 a", "x" * 601, "x" * 200 + "\n" + "y" * 500, "x" * 100 + "\n" + "y" * 510]
    texts += [" ".join(["one two three four"] * n + [f"{'abcdefghij'[k]}z" for k in range(10)]) for n in (4, 5, 6)] + ["a b c d " * 7, "a b c d " * 8, "un deux à trois " * 9, "it's a dog's life " * 9, " ".join(f"w{'abcdefghijklmnopqrstuvwxyz'[k]}" for k in range(26)) + " p q r s"]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for folder in (str(tmp_path), DATA):
        rule = english if name.startswith("already") else lambda t: degenerate(t.split("\n")[0], t)
        want = {r.doc_id: rule(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
        assert len(set(want.values())) == 2
        got = registry.queries()[name](spark, folder)
        assert {r[0]: r[-1] for r in got.collect()} == want
        con = duckdb.connect()
        con.sql(f"create view documents as select * from read_parquet('{folder}/documents.parquet{'/*.parquet' if folder != DATA else ''}')")
        assert sorted(map(tuple, got.collect())) == sorted(con.sql(registry.oracles()[name]).fetchall())


def test_delimiters_of_both_kinds():
    cases = {
        r"\(\mathcal O\(C)\simeq x\) b": r"\(\mathcal O(C)\simeq x\) b", r"\(\dim u_s\(G_s\)\)": r"\(\dim u_s(G_s)\)", r"\(a \(b \(c\) d\) e\)": r"\(a (b (c) d) e\)",
        r"\(k) text": r"\(k\) text", r"\(2n;2) and": "(2n;2) and", r"\(i) x": "(i) x", r"\(X') x": r"\(X'\) x", r"\(\operatorname{Pic}_{C/k}^o) x": r"\(\operatorname{Pic}_{C/k}^o\) x", r"\(f(x)_n) y": r"\(f(x)_n\) y",
        r"\(\alpha)\) x": r"\(\alpha)\) x", r"\[x^2] y": r"\[x^2\] y", r"\[12] y": "[12] y", r"\[a \[b\] c\]": r"\[a [b] c\]", r"\[\alpha] \] y": r"\[\alpha] \] y", r"\\(a) \\[2pt]": r"\\(a) \\[2pt]", r"a\] b": r"a\] b",
    }
    for text, want in cases.items():
        assert repair.delimiters(text)[0] == want and repair.delimiters(want)[0] == want
        assert bool(repair.delimiters(text)[1]) == (text != want)
    for text in (r"\(a", r"\[a"):
        assert repair.delimiters(text) == (text, ["unclosed"])
    assert repair.delimiters(r"\(x \(y")[0] == r"\(x (y"
    assert repair.delimiters(r"\(x " + r"\(y\) " * 20000)[0] == r"\(x " + "(y) " * 20000


def test_bare_parentheses():
    math = ["I", "x", "X'", "x'", "f(x)", "a/b", "X", "u,v,w", r"X\longrightarrow S", "a_2^{-1}(y)=s", "a&lt;b"]
    prose = ["i", "ML", "2.2.4", "1965", "iv", "II", "O", "", "[12] 1.3.6", "x (ii) y", "un mot", "resp. a/b", "le x=1"]
    for inner in math + prose:
        assert repair.wrap_bare(f"a ({inner}) b")[0] == (rf"a \({inner}\) b" if inner in math else f"a ({inner}) b")
    assert repair.wrap_bare("(resp. (b/a))")[0] == r"(resp. \(b/a\))"
    assert repair.wrap_bare(r"<a t='(x)'>\(f(x)\)</a><!-- (x) --> ( (x) \[(y)\]")[0] == r"<a t='(x)'>\(f(x)\)</a><!-- (x) --> ( \(x\) \[(y)\]"
    assert repair.wrap_bare("(" * 3000)[1] == []
