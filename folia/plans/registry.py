"""All registered queries and their SQL: each query beside the statement it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folia.functions import text as T
from folia.operators import links, ordered, validate

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

GLOSSARY = [("the", "le"), ("of", "de"), ("and", "et"), ("der", "le"), ("und", "et")]
#: Function words of the two languages.
ENGLISH = "the a an and or of to in is are was were for with that this from by on as be it its may most any used using should".split()
FRENCH = "le la les un une des du de et ou dans est sont pour avec que qui par sur comme ce cette ces on il elle nous soit être tout".split()


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from folia.plans import chapters, scanners  # noqa: F401  (chapters registers itself)

    return _QUERIES | scanners.QUERIES


def oracles() -> dict[str, str]:
    from folia.plans import chapters  # noqa: F401  (registers itself)

    return dict(_ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


VISIBLE = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gis'), '<!--.*?-->', ' ', 'gs'), '<[^>]*>', ' ', 'g'), '&(?:[a-z]+|#x?[0-9a-fA-F]+);', ' ', 'g'), '[ \t\n\r]+', ' ', 'g'))"""


@query(rf"""SELECT page_id, len(regexp_extract_all(html, '<[^>]*>'))::BIGINT AS n_tags, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, md5({VISIBLE}) AS text_md5, length({VISIBLE})::BIGINT AS n_visible FROM pages""")
def page_profile(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("visible", T.visible_text("html"))
    return pages.select("page_id", F.size(F.regexp_extract_all("html", F.lit("<[^>]*>"), F.lit(0))).cast("long").alias("n_tags"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.md5("visible").alias("text_md5"), F.length("visible").cast("long").alias("n_visible"))


@query(r"""SELECT page_id, list_sort(regexp_extract_all(html, '\bhref="([^"]*)"', 1)) AS hrefs, len(regexp_extract_all(html, '\bid="([^"]*)"', 1))::BIGINT AS n_ids FROM pages""")
def attribute_lists(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.array_sort(T.attribute_values("html", "href")).alias("hrefs"), F.size(T.attribute_values("html", "id")).cast("long").alias("n_ids"))


@query(r"""SELECT doc_id, md5(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g'))) AS squeezed, ((length(text) - length(replace(text, '$', ''))))::BIGINT AS n_dollar, ((length(text) - length(replace(text, '. ', ''))) / 2)::BIGINT AS n_stops,
 md5(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')) AS escaped, regexp_matches(text, '[A-Za-zÀ-ÿ]') AS has_letters FROM documents""")
def scalar_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(T.squeeze("text")).alias("squeezed"), T.count_of(F.col("text"), "$").alias("n_dollar"), T.count_of(F.col("text"), ". ").alias("n_stops"), F.md5(T.escape_html(F.col("text"))).alias("escaped"), T.needs_translation("text").alias("has_letters"))


@query(r"""WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, pos::INT AS pos, md5(regexp_extract(line, '^((?:[^%\\]|\\.)*)', 1)) AS bare FROM l WHERE contains(line, '%')""")
def comment_strip(spark, sf_dir):
    rows = ordered.lines(table(spark, sf_dir, "documents")).where(F.contains("line", F.lit("%")))
    return rows.select("doc_id", "pos", F.md5(T.strip_comment("line")).alias("bare"))


_list = lambda ws: ", ".join(f"'{w}'" for w in ws)
TOKENS = "regexp_extract_all(lower(text), '([a-zà-ÿ]+)', 1)"


@query(f"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '([a-zà-ÿ'']+)', 1) AS w FROM documents), c AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: x IN ({_list(ENGLISH)}))) AS en, len(list_filter(w, lambda x: x IN ({_list(FRENCH)}))) AS fr FROM t)
SELECT doc_id, n::BIGINT AS n_words, en::BIGINT AS n_en, fr::BIGINT AS n_fr, n >= 5 AND en >= 3 AND en > 2 * fr AS already_english FROM c""")
def already_english_all_words(spark, sf_dir):
    """already_english by the reference's whole word sets and its words, which keep apostrophes."""
    docs = table(spark, sf_dir, "documents").withColumn("w", F.regexp_extract_all(F.lower("text"), F.lit("([a-zà-ÿ']+)"), F.lit(1)))
    n, en, fr = F.size("w"), T.share_of(F.col("w"), ENGLISH), T.share_of(F.col("w"), FRENCH)
    return docs.select("doc_id", n.cast("long").alias("n_words"), en.cast("long").alias("n_en"), fr.cast("long").alias("n_fr"), ((n >= 5) & (en >= 3) & (en > 2 * fr)).alias("already_english"))


@query(f"""WITH t AS (SELECT doc_id, text, {TOKENS} AS w FROM documents), g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) AS g FROM t WHERE len(w) >= 4), m AS (SELECT doc_id, max(n) AS most FROM (SELECT doc_id, g, count(*) AS n FROM g GROUP BY 1, 2) GROUP BY 1)
SELECT t.doc_id, coalesce(most, 0)::BIGINT AS most_repeated FROM t LEFT JOIN m USING (doc_id)""")
def most_repeated_ngram(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("w", T.words("text"))
    grams = docs.select("doc_id", F.explode(T.ngrams(F.col("w"), 4)).alias("g")).groupBy("doc_id", "g").count().groupBy("doc_id").agg(F.max("count").alias("most"))
    out = docs.join(grams, "doc_id", "left").withColumn("most", F.coalesce("most", F.lit(0)).cast("long"))
    return out.select("doc_id", F.col("most").alias("most_repeated"))


@query(r"""WITH t AS (SELECT doc_id, text, string_split(text, chr(10))[1] AS source, regexp_extract_all(lower(text), '([a-z'']+)', 1) AS w FROM documents), g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) AS g FROM t WHERE len(w) >= 30), m AS (SELECT doc_id, max(n) AS most FROM (SELECT doc_id, g, count(*) AS n FROM g GROUP BY 1, 2) GROUP BY 1)
SELECT t.doc_id, length(text) > greatest(600, 4 * length(source)) OR regexp_matches(text, '[\x{0400}-\x{04ff}\x{3400}-\x{9fff}]') OR coalesce(most, 0) >= 5 AS degenerate FROM t LEFT JOIN m USING (doc_id)""")
def degenerate_translation_all_rules(spark, sf_dir):
    """Every rule of the reference, with a document's first line for the source and the whole of it for the translation."""
    source = F.substring_index("text", "\n", 1)
    return table(spark, sf_dir, "documents").select("doc_id", validate.degenerate(source, F.col("text")).alias("degenerate"))


BREAK = "length(line) % 7 = 0"


@query(f"""WITH l AS (SELECT doc_id, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INT AS pos, unnest(string_split(text, chr(10))) AS line FROM documents), p AS (SELECT *, sum(CASE WHEN {BREAK} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS page_idx FROM l)
SELECT doc_id, pos, page_idx, (row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY pos) - 1)::BIGINT AS block_idx, page_idx = 0 AS landing FROM p""")
def page_split(spark, sf_dir):
    rows = ordered.paged(ordered.lines(table(spark, sf_dir, "documents")), "doc_id", "pos", F.length("line") % 7 == 0)
    return rows.select("doc_id", "pos", "page_idx", "block_idx", (F.col("page_idx") == 0).alias("landing"))


@query("""WITH RECURSIVE s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, turn, length(text) AS n FROM conversations),
r AS (SELECT conv_id, i, turn, n AS size, 0::BIGINT AS batch FROM s WHERE i = 1 UNION ALL SELECT s.conv_id, s.i, s.turn, CASE WHEN r.size > 300 THEN s.n ELSE r.size + s.n END, r.batch + CASE WHEN r.size > 300 THEN 1 ELSE 0 END FROM r JOIN s ON s.conv_id = r.conv_id AND s.i = r.i + 1)
SELECT conv_id, turn, batch FROM r""")
def greedy_batches(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    turns = turns.withColumn("b", ordered.greedy_batches(F.transform("t", lambda x: F.length(x["text"])), 300, False))
    return turns.select("conv_id", F.explode(F.arrays_zip(F.col("t.turn").alias("turn"), F.col("b").alias("batch"))).alias("x")).select("conv_id", "x.turn", "x.batch")


LINES = "l AS (SELECT doc_id, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INT AS pos, unnest(string_split(text, chr(10))) AS line FROM documents)"


@query(f"WITH {LINES} SELECT line, arg_min(doc_id, (doc_id, pos)) AS first_doc, arg_max(doc_id, (doc_id, pos)) AS last_doc, count(*) AS n, count(*) > 1 AS repeated FROM l WHERE line <> '' GROUP BY line")
def first_and_last_wins(spark, sf_dir):
    rows = ordered.lines(table(spark, sf_dir, "documents")).where("line <> ''")
    by = F.struct("doc_id", "pos")
    return rows.groupBy("line").agg(F.min_by("doc_id", by).alias("first_doc"), F.max_by("doc_id", by).alias("last_doc"), F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) > 1).alias("repeated"))


@query(r"""WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS target FROM pages), d AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '([a-zà-ÿ]+)', 1)) AS target FROM benchmark)
SELECT target, count(*) AS n FROM r WHERE target NOT IN (SELECT target FROM d) GROUP BY target""")
def dangling_refs(spark, sf_dir):
    refs = table(spark, sf_dir, "pages").select(F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))).alias("target"))
    defined = table(spark, sf_dir, "benchmark").select(F.explode(T.words("text")).alias("target"))
    return links.dangling(refs, defined, "target")


@query(r"""WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS target FROM pages), d AS (SELECT target, min(item_id) AS item FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '([a-zà-ÿ]+)', 1)) AS target FROM benchmark) GROUP BY 1)
SELECT page_id, target, coalesce(item::VARCHAR, '??') AS shown, count(*) AS n FROM r LEFT JOIN d USING (target) GROUP BY ALL""")
def resolved_refs(spark, sf_dir):
    refs = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))).alias("target"))
    labels = table(spark, sf_dir, "benchmark").select("item_id", F.explode(T.words("text")).alias("target")).groupBy("target").agg(F.min("item_id").alias("item"))
    return links.resolved(refs, labels, "target", F.col("item").cast("string")).groupBy("page_id", "target", "shown").agg(F.count(F.lit(1)).alias("n"))


ALIGN = """a AS (SELECT conv_id, turn // 2 AS idx, any_value(text) AS fr FROM conversations WHERE turn % 2 = 0 GROUP BY 1, 2), b AS (SELECT conv_id, turn // 2 AS idx, any_value(text) AS en FROM conversations WHERE turn % 2 = 1 GROUP BY 1, 2)"""


@query(f"WITH {ALIGN} SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.idx, b.idx) AS idx, CASE WHEN en IS NULL THEN 'missing_en' WHEN fr IS NULL THEN 'missing_fr' ELSE 'aligned' END AS state FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.idx = b.idx")
def positional_alignment(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn("idx", F.expr("turn div 2"))
    sides = [turns.where(F.col("turn") % 2 == k).groupBy("conv_id", "idx").agg(F.any_value("text").alias(n)) for k, n in ((0, "fr"), (1, "en"))]
    out = links.aligned(*sides, ["conv_id", "idx"])
    return out.select("conv_id", "idx", F.when(F.col("en").isNull(), "missing_en").when(F.col("fr").isNull(), "missing_fr").otherwise("aligned").alias("state"))


@query("""WITH v AS (SELECT page_id, html AS fr, CASE page_id % 5 WHEN 0 THEN html WHEN 1 THEN replace(html, '<b>', '<i>') WHEN 2 THEN replace(html, 'href="/', 'href="/x') WHEN 3 THEN NULL ELSE concat(html, '\\(x\\)') END AS en FROM pages),
c AS (SELECT page_id, fr, en, list_sort(regexp_extract_all(fr, '</?([a-zA-Z][a-zA-Z0-9]*)', 1)) IS DISTINCT FROM list_sort(regexp_extract_all(en, '</?([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tags, list_sort(regexp_extract_all(fr, '\\bhref="([^"]*)"', 1)) IS DISTINCT FROM list_sort(regexp_extract_all(en, '\\bhref="([^"]*)"', 1)) AS hrefs FROM v)
SELECT page_id, 'missing_en' AS code FROM c WHERE en IS NULL UNION ALL SELECT page_id, 'hrefs' FROM c WHERE en IS NOT NULL AND hrefs UNION ALL SELECT page_id, 'tags' FROM c WHERE en IS NOT NULL AND tags UNION ALL SELECT page_id, 'math' FROM c WHERE page_id % 5 = 4""".replace("\\\\", "\\"))
def violations(spark, sf_dir):
    html, k = F.col("html"), F.col("page_id") % 5
    en = F.when(k == 0, html).when(k == 1, F.replace(html, F.lit("<b>"), F.lit("<i>"))).when(k == 2, F.replace(html, F.lit('href="/'), F.lit('href="/x'))).when(k == 4, F.concat(html, F.lit("\\(x\\)")))
    pairs = table(spark, sf_dir, "pages").select("page_id", html.alias("fr_html"), en.alias("en_html"), F.lit(None).cast("string").alias("fr_title"), F.lit(None).cast("string").alias("en_title"))
    return validate.violations(pairs, ["page_id"]).drop("severity")


@query("""SELECT coalesce(lang, '?') AS lang, count(*) AS n_docs, sum(len(string_split(text, chr(10))))::BIGINT AS n_lines, count(*) FILTER (WHERE contains(text, '$'))::BIGINT AS n_math, max(length(text))::BIGINT AS longest FROM documents GROUP BY 1""")
def corpus_totals(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy(F.coalesce("lang", F.lit("?")).alias("lang")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"), F.count_if(F.contains("text", F.lit("$"))).alias("n_math"), F.max(F.length("text")).cast("long").alias("longest"))


@query(r"""SELECT coalesce(nullif(regexp_extract(source, '^([a-z]+)', 1), ''), '?') AS prefix, count(*) AS n FROM documents GROUP BY 1""")
def count_by_prefix(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.coalesce(F.nullif(F.regexp_extract("source", "^([a-z]+)", 1), F.lit("")), F.lit("?")).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {LINES} SELECT line, count(*) AS n FROM l WHERE line <> '' GROUP BY line ORDER BY n DESC, line LIMIT 30")
def top_lines(spark, sf_dir):
    rows = ordered.lines(table(spark, sf_dir, "documents")).where("line <> ''")
    return rows.groupBy("line").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "line").limit(30)


@query(f"WITH {LINES}, c AS (SELECT DISTINCT line FROM l WHERE doc_id % 2 = 0 AND line <> '') SELECT l.doc_id, count(*) AS n_lines, count(c.line) AS n_hits FROM l LEFT JOIN c USING (line) WHERE l.line <> '' GROUP BY 1")
def cache_probe(spark, sf_dir):
    """Lines looked up in a cache that the even documents filled; misses are what an engine would be asked once each."""
    rows = ordered.lines(table(spark, sf_dir, "documents")).where("line <> ''")
    cache = rows.where("doc_id % 2 = 0").select("line").distinct().withColumn("hit", F.lit(1))
    return rows.join(cache, "line", "left").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count("hit").alias("n_hits"))


@query(r"""WITH t AS (SELECT doc_id, generate_subscripts(regexp_extract_all(text, '[().]'), 1) AS i, unnest(regexp_extract_all(text, '[().]')) AS tok FROM documents) SELECT doc_id, i::INT AS i, sum(CASE tok WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS depth FROM t""")
def paren_depth(spark, sf_dir):
    tokens = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit("[().]"), F.lit(0))).alias("p", "tok")).withColumn("i", F.col("p") + 1)
    return ordered.depth(tokens, "doc_id", "i", F.col("tok") == "(", F.col("tok") == ")").select("doc_id", "i", "depth")


@query("""WITH e AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events) SELECT user_id, event_id, seq::INT AS seq, CASE WHEN before = 'click' THEN 'labelled' END AS pending FROM e""")
def pending_label(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.row_number().over(w).alias("seq"), F.when(F.lag("event_type").over(w) == "click", "labelled").alias("pending"))


@query("""SELECT doc_id, list_transform(list_filter(list_zip(range(0, len(new)), new), lambda x: x[2] = 'NEW'), lambda x: x[1]::INT) AS places FROM (SELECT doc_id, flatten([[line] FOR line IN string_split(text, chr(10))]) AS old, list_concat(['NEW'], string_split(text, chr(10)), ['NEW']) AS new FROM documents) WHERE NOT list_contains(old, 'NEW')""")
def inserted_blocks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("old", F.split("text", "\n"))
    new = F.concat(F.array(F.lit("NEW")), F.col("old"), F.array(F.lit("NEW")))
    return docs.where(~F.array_contains("old", "NEW")).withColumn("new", new).select("doc_id", ordered.inserted(F.col("old"), F.col("new")).alias("places"))


@query("""SELECT doc_id, substr(text, greatest(1, p - 59)::BIGINT, (60 + least(p, 60))::BIGINT) AS context FROM (SELECT doc_id, text, strpos(text, '$') - 1 AS p FROM documents) WHERE p >= 0""")
def context_slice(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("p", F.instr("text", "$") - 1).where("p >= 0")
    return docs.select("doc_id", ordered.slice_around(F.col("text"), F.col("p")).alias("context"))


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, props IS NOT NULL AND NOT json_valid(props) AS bad FROM events""")
def tolerant_json(spark, sf_dir):
    parsed = F.from_json("props", "k long, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return table(spark, sf_dir, "events").withColumn("j", parsed).select("event_id", F.col("j.k").alias("k"), F.coalesce(F.col("j._bad").isNotNull(), F.lit(False)).alias("bad"))


@query("""SELECT json_extract_string(props, '$.k')::BIGINT AS k, arg_max(event_id, (ts, event_id)) AS event_id, count(*) AS n FROM events GROUP BY 1""")
def last_write_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k long")["k"])
    return rows.groupBy("k").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.count(F.lit(1)).alias("n"))


@query("""SELECT conv_id, to_json(list({'turn': turn, 'role': role} ORDER BY turn, role)) AS children, bool_or(role = 'user') AS any_user, bool_and(length(text) > 0) AS all_text FROM conversations GROUP BY conv_id""")
def nested_children(spark, sf_dir):
    kids = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: F.struct(x["turn"].alias("turn"), x["role"].alias("role")))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(kids).alias("children"), F.bool_or(F.col("role") == "user").alias("any_user"), F.bool_and(F.length("text") > 0).alias("all_text"))


@query("""SELECT d.doc_id, count(DISTINCT w) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '([a-zà-ÿ]+)', 1)) AS w FROM documents) d WHERE w IN (SELECT unnest(regexp_extract_all(lower(text), '([a-zà-ÿ]+)', 1)) FROM benchmark) GROUP BY 1""")
def vocabulary_semi_join(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(T.words("text"))).alias("w"))
    known = table(spark, sf_dir, "benchmark").select(F.explode(T.words("text")).alias("w")).distinct()
    return rows.join(known, "w", "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, lang, source FROM documents WHERE lang IN ('fr', 'de') AND contains(source, '1')""")
def selection(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("lang").isin("fr", "de") & F.contains("source", F.lit("1"))).select("doc_id", "lang", "source")


@query("""WITH have AS (SELECT doc_id FROM documents WHERE lang = 'en'), want AS (SELECT doc_id, quality FROM labels) SELECT want.doc_id, quality FROM want WHERE doc_id NOT IN (SELECT doc_id FROM have) UNION ALL SELECT doc_id, -1 FROM have""")
def guarded_stubs(spark, sf_dir):
    """Stubs are written only where nothing is there yet."""
    have = table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id")
    stubs = table(spark, sf_dir, "labels").select("doc_id", "quality").join(have, "doc_id", "left_anti")
    return stubs.unionByName(have.withColumn("quality", F.lit(-1)))


@query("""SELECT w AS term, list_sort(list(DISTINCT item_id)) AS items FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '([a-zà-ÿ]+)', 1)) AS w FROM benchmark) GROUP BY w""")
def term_index(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.explode(T.words("text")).alias("term"))
    return rows.groupBy("term").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


@query("""WITH s AS (SELECT doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 40 AS chunk, source FROM documents WHERE contains(text, '|')) SELECT source, chunk, count(*) AS n, min(doc_id) AS first_doc FROM s GROUP BY 1, 2""")
def retry_chunks(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where(F.contains("text", F.lit("|")))
    rows = rows.withColumn("chunk", F.expr("(row_number() over (partition by source order by doc_id) - 1) div 40"))
    return rows.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))


@query(r"""SELECT doc_id, NOT regexp_matches(text, '\[\[M[0-9]+\]\]') AS round_trip FROM documents""")
def protect_restore_all(spark, sf_dir):
    """The same over every document; a test holds it to brute force."""
    return round_trips(table(spark, sf_dir, "documents"))


def round_trips(docs: DataFrame) -> DataFrame:
    """Whether each text comes back unchanged and its placeholders can't be taken for others; false where the text itself holds a placeholder."""
    safe, kept = T.protect(F.col("text"), r"\$[^$]*\$")
    docs = docs.withColumn("safe", safe).withColumn("kept", kept)
    return docs.select("doc_id", ((T.restore(F.col("safe"), F.col("kept")) == F.col("text")) & T.once_each(F.col("safe"), F.size("kept"))).alias("round_trip"))


@query(r"""SELECT doc_id, md5(regexp_replace(regexp_replace(text, '^[ \t\n\r]+', ''), '[ \t\n\r]+$', '')) AS core FROM documents""")
def blank_preserving_core(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.core(F.col("text"))["core"]).alias("core"))
