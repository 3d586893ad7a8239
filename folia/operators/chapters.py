"""Operators over chapters nested as pages, blocks and footnotes (schema: sources.readers.CHAPTER).

Arrays are walked and rebuilt inside the row, so nothing is shuffled but where
values come from another table. Null arrays count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.functions import text as T
from folia.operators import ordered

#: Headings with one translation.
TITLES = {
    "proposition": "Proposition", "théorème": "Theorem", "theoreme": "Theorem", "définition": "Definition", "lemme": "Lemma", "corollaire": "Corollary",
    "démonstration": "Proof", "preuve": "Proof", "remarque": "Remark", "remarques": "Remarks", "exemple": "Example", "exemples": "Examples",
    "conjecture": "Conjecture", "bibliographie": "Bibliography", "introduction": "Introduction", "variante": "Variant", "scholie": "Scholium",
}
#: Names of theorem-like blocks that a translation must not keep.
FRENCH_NAMES = "Corollaire Corollaires Remarque Remarques Exemple Exemples Scholie Démonstration Preuve Variante Variantes Exercice Exercices Problème Problèmes Convention".split()
#: More stop words than this in a translated chapter are worth a warning.
MOST_FRENCH = 8
BLANKS = r"[ \t\n\r]*"


def _list(c: Column) -> Column:
    return F.coalesce(c, F.filter(c, lambda x: F.lit(False)), F.array())


def fragments(chapters: DataFrame) -> DataFrame:
    """(chapter_id, key, text): a row for each string that can be translated, under its path: title, pN.title, pN.bM.title, pN.bM.html, pN.fM.html. Null and empty strings have no row."""
    entry = lambda key, text: F.struct(key.alias("key"), text.alias("text"))
    number = lambda letter, i: F.concat(F.lit(letter), i.cast("string"))

    def of_page(p: Column, i: Column) -> Column:
        at = lambda letter, j, field: F.concat(number("p", i), F.lit("."), number(letter, j), F.lit(f".{field}"))
        blocks = F.transform(_list(p["blocks"]), lambda b, j: F.array(entry(at("b", j, "title"), b["title"]), entry(at("b", j, "html"), b["html"])))
        notes = F.transform(_list(p["footnotes"]), lambda n, j: entry(at("f", j, "html"), n["html"]))
        return F.concat(F.array(entry(F.concat(number("p", i), F.lit(".title")), p["title"])), F.flatten(blocks), notes)

    every = F.concat(F.array(entry(F.lit("title"), F.col("title"))), F.flatten(F.transform(_list(F.col("pages")), of_page)))
    return chapters.select("chapter_id", F.inline(every)).where(F.col("text") != "")


def put_back(chapters: DataFrame, values: DataFrame) -> DataFrame:
    """Chapters with the strings of values (chapter_id, key, text) in their places; others stay. Of a key given twice the smallest text counts."""
    given = values.where(F.col("text").isNotNull()).groupBy("chapter_id", "key").agg(F.min("text").alias("text"))
    given = given.groupBy("chapter_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "text"))).alias("_given"))
    new = lambda key, old: F.coalesce(F.try_element_at(F.col("_given"), key), old)
    path = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    def of_page(p: Column, i: Column) -> Column:
        blocks = F.transform(p["blocks"], lambda b, j: b.withField("title", new(path("p", i, ".b", j, ".title"), b["title"])).withField("html", new(path("p", i, ".b", j, ".html"), b["html"])))
        notes = F.transform(p["footnotes"], lambda n, j: n.withField("html", new(path("p", i, ".f", j, ".html"), n["html"])))
        return p.withField("title", new(path("p", i, ".title"), p["title"])).withField("blocks", blocks).withField("footnotes", notes)

    out = chapters.join(given, "chapter_id", "left")
    return out.withColumn("title", new(F.lit("title"), F.col("title"))).withColumn("pages", F.transform("pages", of_page)).drop("_given").select(*chapters.columns)


def unanswered(wanted: DataFrame, values: DataFrame) -> DataFrame:
    """Fragments (chapter_id, key) without a value, or whose value still holds a placeholder: put_back needs this to be empty."""
    found = wanted.select("chapter_id", "key").join(values.select("chapter_id", "key", "text"), ["chapter_id", "key"], "left")
    return found.where(F.col("text").isNull() | F.col("text").rlike(r"\[\[M[0-9]+\]\]")).select("chapter_id", "key")


def mapped_title(title) -> Column:
    """A heading of one known word, a number and a stop in the other language, in capitals if it was; null if it isn't known."""
    bare = F.trim(title)
    word = F.regexp_extract(bare, r"^([A-Za-zÉÀÈéàè]+)((?:\s+[0-9.]+)?\.?\s*)$", 1)
    rest = F.regexp_extract(bare, r"^([A-Za-zÉÀÈéàè]+)((?:\s+[0-9.]+)?\.?\s*)$", 2)
    known = F.create_map(*[F.lit(x) for pair in TITLES.items() for x in pair])
    found = F.concat(F.try_element_at(known, F.lower(word)), rest)
    return F.when((bare == F.upper(bare)) & (bare != F.lower(bare)), F.upper(found)).otherwise(found)


def totals(chapters: DataFrame) -> DataFrame:
    """Pages, blocks and footnotes of each chapter."""
    count = lambda field: F.aggregate(_list(F.col("pages")), F.lit(0).cast("long"), lambda a, p: a + F.size(_list(p[field])))
    return chapters.select("chapter_id", F.size(_list(F.col("pages"))).cast("long").alias("n_pages"), count("blocks").alias("n_blocks"), count("footnotes").alias("n_footnotes"))


def with_page_html(chapters: DataFrame) -> DataFrame:
    """Each page's html set to its blocks' html, joined by line ends."""
    return chapters.withColumn("pages", F.transform("pages", lambda p: p.withField("html", F.array_join(F.transform(_list(p["blocks"]), lambda b: F.coalesce(b["html"], F.lit(""))), "\n"))))


def is_transcribed(src, front_matter=False, theorems: bool = True) -> Column:
    """Whether a source has been marked up: headings with ids, and theorem blocks where the volume has them; front matter needs only a heading."""
    front = F.lit(front_matter) if isinstance(front_matter, bool) else front_matter
    body = F.contains(src, F.lit("<h2 id="))
    if theorems:
        body = body & F.contains(src, F.lit('class="thm'))
    return F.when(front, F.contains(src, F.lit("<h1 id="))).otherwise(body)


def french_leftovers(html) -> Column:
    """Spans that a translation must not have kept: names of theorem-like blocks, and an author span that opens with "par"."""
    names = F.regexp_extract_all(html, F.lit(rf'class="thm-name">{BLANKS}([^<]*?){BLANKS}</span>'), F.lit(1))
    kept = F.transform(F.filter(names, lambda n: n.isin(FRENCH_NAMES)), lambda n: F.concat(F.lit("thm-name:"), n))
    return F.concat(kept, F.when(html.rlike(rf'class="author">{BLANKS}par\b'), F.array(F.lit("author:par"))).otherwise(F.array().cast("array<string>")))


def stop_word_hits(html, vocabulary: list[str]) -> Column:
    words = F.regexp_extract_all(F.lower(T.visible_text(html)), F.lit("([A-Za-zÀ-ÿ']+)"), F.lit(1))
    return F.size(F.filter(words, lambda w: w.isin(vocabulary))).cast("long")


def compare(sources: DataFrame, targets: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(chapter_id, page_id, idx, severity, code): what a translated chapter has otherwise than its source. Chapters: missing_en, missing_fr, number, title, page_ids (nothing below a chapter is compared then), french_words. Pages: footnotes, block_count (its blocks aren't compared then). Blocks: id, type, label, title_null, ids, math, french_spans."""
    both = sources.select("chapter_id", F.struct("number", "title", "pages").alias("s")).join(targets.select("chapter_id", F.struct("number", "title", "pages").alias("t")), "chapter_id", "full")
    ids = lambda pages: F.transform(_list(pages), lambda p: p["id"])
    s, t = F.col("s"), F.col("t")
    present = s.isNotNull() & t.isNotNull()
    alike = present & ids(s["pages"]).eqNullSafe(ids(t["pages"]))
    nothing = F.lit(None).cast("string")
    found = lambda severity, code, page=nothing, at=F.lit(None).cast("int"): F.struct(page.alias("page_id"), at.alias("idx"), F.lit(severity).alias("severity"), F.lit(code).alias("code"))
    hits = F.aggregate(F.flatten(F.transform(_list(t["pages"]), lambda p: F.transform(_list(p["blocks"]), lambda b: stop_word_hits(F.coalesce(b["html"], F.lit("")), vocabulary)))), F.lit(0).cast("long"), lambda a, n: a + n)
    of_chapter = [
        (t.isNull(), found("error", "missing_en")), (s.isNull(), found("error", "missing_fr")), (present & ~s["number"].eqNullSafe(t["number"]), found("error", "number")),
        (present & (F.coalesce(t["title"], F.lit("")) == ""), found("warning", "title")), (present & ~alike, found("error", "page_ids")), (alike & (hits > MOST_FRENCH), found("warning", "french_words")),
    ]
    out = both.select("chapter_id", F.inline(F.array_compact(F.array(*[F.when(bad, row) for bad, row in of_chapter]))))
    pages = both.where(alike).select("chapter_id", F.inline(F.arrays_zip(F.transform(s["pages"], lambda p: p).alias("a"), F.transform(t["pages"], lambda p: p).alias("b"))))
    pages = pages.toDF("chapter_id", "a", "b").select("chapter_id", F.col("a.id").alias("page_id"), *[_list(F.col(f"{x}.{f}")).alias(f"{x}_{f}") for x in "ab" for f in ("blocks", "footnotes")])
    notes = lambda c: F.transform(c, lambda n: F.struct(n["id"], n["number"]))
    of_page = [(~notes("a_footnotes").eqNullSafe(notes("b_footnotes")), "footnotes"), (F.size("a_blocks") != F.size("b_blocks"), "block_count")]
    page_rows = pages.select("chapter_id", F.inline(F.array_compact(F.array(*[F.when(bad, found("error", code, F.col("page_id"))) for bad, code in of_page]))))
    blocks = pages.where(F.size("a_blocks") == F.size("b_blocks")).select("chapter_id", "page_id", F.posexplode(F.arrays_zip("a_blocks", "b_blocks")).alias("idx", "z"))
    a, b = F.col("z.a_blocks"), F.col("z.b_blocks")
    html = lambda x: F.coalesce(x["html"], F.lit(""))
    named = lambda c: F.array_sort(F.concat(T.attribute_values(c, "id"), F.transform(T.attribute_values(c, "href"), lambda h: F.concat(F.lit("->"), h))))
    of_block = [(~a[f].eqNullSafe(b[f]), f) for f in ("id", "type", "label")] + [
        (a["title"].isNull() != b["title"].isNull(), "title_null"), (~named(html(a)).eqNullSafe(named(html(b))), "ids"),
        (~T.math_signature(html(a)).eqNullSafe(T.math_signature(html(b))), "math"), (F.size(french_leftovers(html(b))) > 0, "french_spans"),
    ]
    block_rows = blocks.select("chapter_id", F.inline(F.array_compact(F.array(*[F.when(bad, found("error", code, F.col("page_id"), F.col("idx"))) for bad, code in of_block]))))
    return out.unionByName(page_rows).unionByName(block_rows)


def interleaved(old: Column, new: Column, other: Column) -> Column:
    """The other version of `old` brought up to `new`: what was inserted stands at its place, all else is the other version's. Null where `old` isn't a subsequence of `new`, or the other version has not as many items."""
    places = ordered.inserted(old, new)
    both = F.transform(new, lambda x, j: F.when(F.array_contains(places, j), x).otherwise(F.get(other, j - F.size(F.filter(places, lambda i: i < j)))))
    return F.when(places.isNotNull() & (F.size(old) == F.size(other)), both)


def insertion_totals(old: Column, new: Column) -> tuple[Column, Column]:
    """How many items were inserted, and how many characters they have."""
    places = ordered.inserted(old, new)
    return F.size(places).cast("long"), F.aggregate(places, F.lit(0).cast("long"), lambda a, i: a + F.length(F.get(new, i)))


def cited(citations: DataFrame, numbers: DataFrame, labels: DataFrame) -> DataFrame:
    """Citations (key, ...) with the number they show: the bibliography's (key, num), else the label's (key, display), else a question mark; and whether it was found."""
    shown = citations.join(numbers.select("key", "num"), "key", "left").join(labels.select("key", "display"), "key", "left")
    found = F.coalesce("num", "display")
    return shown.withColumn("shown", F.coalesce(found, F.lit("?"))).withColumn("is_found", found.isNotNull()).drop("num", "display")


def contents_of(entries: DataFrame, toc: DataFrame) -> DataFrame:
    """Chapter entries (..., page_ids) with the contents line (page_id, ...) of their landing page; null where there is none."""
    lines = toc.select(F.col("page_id").alias("_landing"), F.struct(*toc.columns).alias("toc"))
    return entries.withColumn("_landing", F.get("page_ids", F.lit(0))).join(lines, "_landing", "left").drop("_landing")


def numeral_warnings(chapters: DataFrame, numeral: Column) -> DataFrame:
    """Chapters whose heading has another numeral than their number, blanks aside."""
    shown = F.replace(numeral, F.lit(" "), F.lit(""))
    return chapters.withColumn("numeral", numeral).where((shown != "") & ~shown.eqNullSafe(F.col("number")))


def renamed_markers(html, stem, known) -> tuple[Column, Column]:
    """The html with its footnote markers renamed, and (id, number) of each: a link to one of the known ids points at <stem>-<id> and is named <stem>-<id>ref. Other links stay. Markers hold no tag that isn't closed inside them."""
    token = r'(?s)<a\b[^>]*\bhref="#[^"]*"[^>]*>.*?</a>'
    target = lambda a: F.regexp_extract(a, r'\bhref="#([^"]*)"', 1)
    is_marker = lambda a: F.array_contains(known, target(a))
    links = F.regexp_extract_all(html, F.lit(f"({token})"), F.lit(1))

    def renamed(a: Column) -> Column:
        opening = F.regexp_replace(F.regexp_extract(a, r"(?s)^(<a\b[^>]*)>", 1), r'\s+id="[^"]*"', "")
        opening = F.replace(opening, F.concat(F.lit('href="#'), target(a), F.lit('"')), F.concat(F.lit('href="#'), stem, F.lit("-"), target(a), F.lit('"')))
        return F.concat(opening, F.lit(' id="'), stem, F.lit("-"), target(a), F.lit('ref">'), F.regexp_extract(a, r"(?s)^<a\b[^>]*>(.*)$", 1))

    between = F.split(html, token, -1)
    joined = F.array_join(F.transform(between, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.when(is_marker(F.get(links, i - 1)), renamed(F.get(links, i - 1))).otherwise(F.get(links, i - 1)), p))), "")
    markers = F.transform(F.filter(links, is_marker), lambda a: F.struct(target(a).alias("id"), T.squeeze(F.regexp_replace(a, "<[^>]*>", "")).alias("number")))
    return joined, markers


def numbered_notes(notes: DataFrame, markers: DataFrame, empty_counts: bool = False) -> DataFrame:
    """Footnotes (chapter_id, id, printed, seq) with the number they show: their marker's, else the printed mark, else their place. With empty_counts an empty marker counts as one."""
    last = markers.groupBy("chapter_id", "id").agg(F.max_by("number", "ord").alias("number"))
    own = F.col("number") if empty_counts else F.nullif(F.col("number"), F.lit(""))
    shown = F.coalesce(own, F.nullif(F.col("printed"), F.lit("")), F.col("seq").cast("string"))
    return notes.join(last, ["chapter_id", "id"], "left").withColumn("number", shown)


def reading_order(stem) -> list[Column]:
    """Sort keys of file stems: numbers by value before all others, which go by their letters."""
    number = F.try_to_number(F.when(stem.rlike("^[0-9]{1,18}$"), stem), F.lit("9" * 18)).cast("long")
    return [number.asc_nulls_last(), stem.asc()]


def text_in_math(html, phrases: list[tuple[str, str]], words: dict[str, str]) -> tuple[Column, Column]:
    r"""The html with whole phrases replaced first, then the content of each \text group that the words know, blanks kept; and the French-looking contents they don't know, distinct and sorted."""
    for old, new in phrases:
        html = F.replace(html, F.lit(old), F.lit(new))
    group = r"\\text(?:normal|rm)?\{[^{}]*\}"
    groups, between = F.regexp_extract_all(html, F.lit(f"({group})"), F.lit(1)), F.split(html, group, -1)
    core = lambda g: F.regexp_extract(g, r"(?s)\{\s*(.*?)\s*\}$", 1)
    known = F.create_map(*[F.lit(x) for pair in words.items() for x in pair]) if words else F.create_map().cast("map<string,string>")
    new = lambda g: F.concat(F.regexp_extract(g, r"^(\\text[a-z]*\{\s*)", 1), F.try_element_at(known, core(g)), F.regexp_extract(g, r"(\s*\})$", 1))
    out = F.array_join(F.transform(between, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.coalesce(new(F.get(groups, i - 1)), F.get(groups, i - 1)), p))), "")
    french = r"[àâçèêëîïôùûœ]|\b(?:si|et|ou|où|de|des|du|la|le|les|une?|pour|avec|dans|que|qui|est|sont|donc|soit|tout|tous|par|sur)\b"
    left = F.filter(F.transform(groups, core), lambda c: F.try_element_at(known, c).isNull() & c.rlike(french))
    return out, F.array_sort(F.array_distinct(left))


def verified(chapters: DataFrame, unresolved: DataFrame) -> DataFrame:
    """(kind, name, n): totals of a converted volume, commands leaked outside math, keys (key) that weren't resolved, pages whose html isn't their blocks'."""
    pages = chapters.select("chapter_id", F.explode("pages").alias("p"))
    blocks = pages.select(F.explode(F.col("p.blocks")).alias("b")).select("b.type", "b.html")
    count = lambda field: F.coalesce(F.sum(F.size(_list(F.col(f"p.{field}")))), F.lit(0)).cast("long")
    sums = pages.agg(F.count(F.lit(1)).alias("pages"), count("blocks").alias("blocks"), count("footnotes").alias("footnotes"), count("bibliography").alias("bibliography"))
    broken = F.col("p.html").isNotNull() & (F.col("p.html") != F.array_join(F.transform(_list(F.col("p.blocks")), lambda b: F.coalesce(b["html"], F.lit(""))), "\n"))
    leaks = blocks.where(~F.coalesce("type", F.lit("")).isin("equation", "displaymath")).select(F.explode(T.leaked_commands("html")).alias("name"))
    counted = lambda rows, kind, name: rows.groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "name", "n")
    out = sums.select(F.inline(F.array(*[F.struct(F.lit("total").alias("kind"), F.lit(c).alias("name"), F.col(c).alias("n")) for c in sums.columns])))
    for rows, kind, name in ((blocks.where(F.col("type").isNotNull()), "block_type", "type"), (leaks, "leak", "name"), (unresolved, "unresolved", "key"), (pages.where(broken).select(F.col("p.id").alias("id")), "page_html", "id")):
        out = out.unionByName(counted(rows, kind, name))
    return out


def error_category(message) -> Column:
    """Rendering errors by kind: of the mathematics, of a cross-reference, or other."""
    low = F.lower(message)
    return F.when(low.rlike("mathjax|merror|math input|undefined control sequence"), "mathjax").when(low.rlike(r"crossref|cross-reference|dangling|unresolved|\?\?"), "crossref").otherwise("other")


def commented(blocks: DataFrame, comments: DataFrame) -> DataFrame:
    """Blocks (chapter_id, id, ...) with their review comments (chapter_id, block_id, ord, body) in order; an empty list where there is none."""
    lists = comments.groupBy("chapter_id", F.col("block_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "body"))), lambda c: c["body"]).alias("comments"))
    return blocks.join(lists, ["chapter_id", "id"], "left").withColumn("comments", F.coalesce("comments", F.array().cast("array<string>")))
