"""Queries over nested chapters, made of documents: a document is a chapter, its lines are blocks, eight to a page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions import text as T
from folia.operators import chapters, ordered
from folia.plans.registry import FRENCH, LINES, VISIBLE, query, table
from folia.sources.readers import PAGE

BLOCKS = 8
PLACED = f"{LINES}, b AS (SELECT doc_id, pos, line, 'p' || (pos // {BLOCKS}) AS page_id, (pos % {BLOCKS})::INT AS idx FROM l)"


def chapters_of(docs: DataFrame, number="lang", block_type=None, html=None) -> DataFrame:
    """Chapters of documents (doc_id, text); number is a column, block_type and html are functions of a line."""
    nothing = F.lit(None).cast("string")
    block_type, html = block_type or (lambda line: F.lit("paragraph")), html or (lambda line: line)
    lines = F.split("text", "\n")
    block = lambda line: F.struct(nothing.alias("id"), block_type(line).alias("type"), nothing.alias("label"), nothing.alias("title"), html(line).alias("html"))
    notes, entries = F.array().cast("array<struct<id:string,number:string,html:string>>"), F.lit(None).cast("array<struct<id:string,label:string,html:string,text:string>>")
    page = lambda p: F.struct(F.concat(F.lit("p"), p.cast("string")).alias("id"), nothing.alias("title"), nothing.alias("html"), F.transform(F.slice("_lines", p * BLOCKS + 1, F.lit(BLOCKS)), block).alias("blocks"), notes.alias("footnotes"), entries.alias("bibliography"))
    pages = F.transform(F.sequence(F.lit(0), ((F.size("_lines") - 1) / BLOCKS).cast("int")), page).cast(f"array<{PAGE}>")
    out = docs.withColumn("_lines", lines).where(F.col("text").isNotNull())
    return out.select(F.col("doc_id").alias("chapter_id"), nothing.alias("title"), F.col(number).alias("number"), nothing.alias("alias"), nothing.alias("author"), pages.alias("pages"))


@query(f"WITH {PLACED} SELECT doc_id, page_id || '.b' || idx || '.html' AS key, md5(line) AS text_md5 FROM b WHERE line <> ''")
def chapter_fragments(spark, sf_dir):
    rows = chapters.fragments(chapters_of(table(spark, sf_dir, "documents")))
    return rows.select(F.col("chapter_id").alias("doc_id"), "key", F.md5("text").alias("text_md5"))


@query("SELECT doc_id, md5(replace(text, 'e', 'E')) AS text_md5 FROM documents")
def fragments_put_back(spark, sf_dir):
    """Every fragment changed and put back under its path."""
    whole = chapters_of(table(spark, sf_dir, "documents"))
    changed = chapters.fragments(whole).withColumn("text", F.replace("text", F.lit("e"), F.lit("E")))
    done = chapters.with_page_html(chapters.put_back(whole, changed))
    return done.select(F.col("chapter_id").alias("doc_id"), F.md5(F.array_join(F.transform("pages", lambda p: p["html"]), "\n")).alias("text_md5"))


@query(f"WITH {PLACED} SELECT doc_id, count(DISTINCT page_id) AS n_pages, count(*) AS n_blocks, 0::BIGINT AS n_footnotes FROM b GROUP BY doc_id")
def chapter_totals(spark, sf_dir):
    return chapters.totals(chapters_of(table(spark, sf_dir, "documents"))).withColumnRenamed("chapter_id", "doc_id")


@query(f"WITH {LINES} SELECT doc_id, md5(string_agg(CASE WHEN contains(line, ',') THEN line ELSE '<' || line || '>' END, chr(10) ORDER BY pos)) AS text_md5, count(*) FILTER (contains(line, ',')) AS n_inserted, coalesce(sum(length(line)) FILTER (contains(line, ',')), 0)::BIGINT AS n_chars FROM l GROUP BY doc_id")
def interleaved_blocks(spark, sf_dir):
    """Lines with a comma are new; the other version has all others, marked."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("new"))
    docs = docs.withColumn("old", F.filter("new", lambda x: ~F.contains(x, F.lit(",")))).withColumn("other", F.transform("old", lambda x: F.concat(F.lit("<"), x, F.lit(">"))))
    n, chars = chapters.insertion_totals(F.col("old"), F.col("new"))
    return docs.select("doc_id", F.md5(F.array_join(chapters.interleaved(F.col("old"), F.col("new"), F.col("other")), "\n")).alias("text_md5"), n.alias("n_inserted"), chars.alias("n_chars"))


@query("SELECT page_id, contains(html, '<h2 id=') AND contains(html, 'class=\"thm') AS with_theorems, contains(html, '<h2 id=') AS by_headings, contains(html, '<h1 id=') AS front_matter FROM pages")
def transcribed_sources(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", chapters.is_transcribed(html).alias("with_theorems"), chapters.is_transcribed(html, theorems=False).alias("by_headings"), chapters.is_transcribed(html, True).alias("front_matter"))


@query(f"""SELECT page_id, len(list_filter(regexp_extract_all(lower({VISIBLE}), '([A-Za-zÀ-ÿ'']+)', 1), lambda w: w IN ({", ".join(f"'{w}'" for w in sorted(set(FRENCH)))})))::BIGINT AS n_french, CASE WHEN regexp_matches(html, 'class="author">[ \\t\\n\\r]*par\\b') THEN 1 ELSE 0 END AS n_spans FROM pages""")
def french_left(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", chapters.stop_word_hits(F.col("html"), FRENCH).alias("n_french"), F.size(chapters.french_leftovers(F.col("html"))).alias("n_spans"))


WORDS = "unnest(regexp_extract_all(lower(text), '([a-zà-ÿ]+)', 1))"


@query(f"""WITH c AS (SELECT {WORDS} AS key FROM benchmark), n AS (SELECT key, min(page_id) AS num FROM (SELECT page_id, unnest(regexp_extract_all(lower(regexp_extract(html, '<title>([^<]*)</title>', 1)), '([a-zà-ÿ]+)', 1)) AS key FROM pages) GROUP BY key), d AS (SELECT key, min(conv_id) AS display FROM (SELECT conv_id, {WORDS} AS key FROM conversations) GROUP BY key)
SELECT key, coalesce('[' || num || ']', 'label ' || display, '?') AS shown, num IS NOT NULL OR display IS NOT NULL AS is_found, count(*) AS n FROM c LEFT JOIN n USING (key) LEFT JOIN d USING (key) GROUP BY ALL""")
def two_level_citations(spark, sf_dir):
    """Words of the benchmark as citations: numbered by page titles, else labelled by conversations, else unresolved."""
    words = lambda name, column: table(spark, sf_dir, name).select("*", F.explode(T.words(column)).alias("key"))
    citations = words("benchmark", F.col("text")).select("key")
    numbers = words("pages", F.regexp_extract("html", "<title>([^<]*)</title>", 1)).groupBy("key").agg(F.concat(F.lit("["), F.min("page_id").cast("string"), F.lit("]")).alias("num"))
    labels = words("conversations", F.col("text")).groupBy("key").agg(F.concat(F.lit("label "), F.min("conv_id").cast("string")).alias("display"))
    return chapters.cited(citations, numbers, labels).groupBy("key", "shown", "is_found").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {PLACED} SELECT doc_id, '' AS page_id, -1 AS idx, 'error' AS severity, 'number' AS code FROM documents WHERE lang = 'de'
UNION ALL SELECT doc_id, '', -1, 'warning', 'title' FROM documents
UNION ALL SELECT doc_id, page_id, idx, 'error', 'type' FROM b WHERE contains(line, '%')
UNION ALL SELECT doc_id, page_id, idx, 'error', 'ids' FROM b WHERE contains(line, '#')
UNION ALL SELECT doc_id, page_id, idx, 'error', 'math' FROM b WHERE contains(line, '&')""")
def compared_chapters(spark, sf_dir):
    """A second version with another number for German chapters, another type for lines with %, an id more in lines with #, a formula more in lines with &."""
    docs = table(spark, sf_dir, "documents")
    has = lambda line, sign: F.contains(line, F.lit(sign))
    html = lambda line: F.concat(line, F.when(has(line, "#"), ' id="more"').otherwise(""), F.when(has(line, "&"), " \\(x\\)").otherwise(""))
    other = chapters_of(docs.withColumn("lang", F.when(F.col("lang") == "de", "other").otherwise(F.col("lang"))), block_type=lambda line: F.when(has(line, "%"), "list").otherwise("paragraph"), html=html)
    return chapters.compare(chapters_of(docs), other, []).withColumnRenamed("chapter_id", "doc_id").fillna({"page_id": "", "idx": -1})


@query(f"""WITH {PLACED}, t AS (SELECT count(DISTINCT (doc_id, page_id)) AS pages, count(*) AS blocks FROM b)
SELECT 'total' AS kind, 'pages' AS name, pages AS n FROM t UNION ALL SELECT 'total', 'blocks', blocks FROM t UNION ALL SELECT 'total', 'footnotes', 0 UNION ALL SELECT 'total', 'bibliography', 0
UNION ALL SELECT 'block_type', CASE WHEN contains(line, '%') THEN 'list' ELSE 'paragraph' END, count(*) FROM b GROUP BY ALL
UNION ALL SELECT 'unresolved', lang, count(*) FROM documents GROUP BY ALL
UNION ALL SELECT 'leak', '\\section', count(*) FROM b WHERE contains(line, '#') GROUP BY ALL""")
def verified_volume(spark, sf_dir):
    """Lines with % are lists; lines with # have leaked a command; languages stand for references that weren't resolved."""
    docs = table(spark, sf_dir, "documents")
    has = lambda line, sign: F.contains(line, F.lit(sign))
    whole = chapters_of(docs, block_type=lambda line: F.when(has(line, "%"), "list").otherwise("paragraph"), html=lambda line: F.when(has(line, "#"), "a \\section of \\(\\alpha\\)").otherwise("x"))
    return chapters.verified(whole, docs.select(F.col("lang").alias("key")))


@query("""WITH p AS (SELECT page_id, string_split(replace(html, '<p', chr(1) || '<p'), chr(1)) AS p FROM pages) SELECT page_id, generate_subscripts(p, 1) - 1 AS page_idx, md5(unnest(p)) AS html_md5 FROM p""")
def heading_split(spark, sf_dir):
    """Pages cut before their paragraphs; the first piece holds what stands before the first."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.posexplode(ordered.split_at(F.col("html"), "<p")).alias("page_idx", "html"))
    return pages.select("page_id", F.col("page_idx").cast("long").alias("page_idx"), F.md5("html").alias("html_md5"))
