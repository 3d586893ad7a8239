"""Citations: names announced in prose become anchors, their mentions links, and cited entries get a way back.

Blocks are rows (chapter_id, page_idx, block_idx, id, html). A mention is a whole
word outside tags and math; of names that overlap the longest is linked. Names
hold in their own chapter. Null html has no mention.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed value: the mark that announces a name in the source.
MARKER = r"\s*,?\s*\(cité:\s*([^)]+?)\s*\)"
PLACE = ["chapter_id", "page_idx", "block_idx"]


def anchor_id(name: Column) -> Column:
    return F.concat(F.lit("bib-"), F.regexp_replace(F.regexp_replace(name, r"(?U)[^\w]+", "-"), r"^-+|-+$", ""))


def announced(blocks: DataFrame) -> DataFrame:
    """The blocks with `name` (null where none is announced); an announcing block loses its mark, gets the anchor and takes its id."""
    found = F.trim(F.regexp_extract("html", MARKER, 1))
    out = blocks.withColumn("name", F.when(found != "", found))
    out = out.withColumn("_mark", F.regexp_extract("html", MARKER, 0)).withColumn("_at", F.expr("locate(_mark, html)"))
    out = out.withColumn("_cut", F.expr("concat(substring(html, 1, _at - 1), substring(html, _at + length(_mark)))"))
    anchor = F.concat(F.lit('<span class="bib-anchor" id="'), anchor_id(F.col("name")), F.lit('"></span>'))
    at = F.locate("<p>", F.col("_cut"))
    placed = F.when(at > 0, F.concat(F.expr("substring(_cut, 1, locate('<p>', _cut) + 2)"), anchor, F.expr("substring(_cut, locate('<p>', _cut) + 3)"))).otherwise(F.concat(anchor, "_cut"))
    named = F.col("name").isNotNull()
    return out.withColumns({"html": F.when(named, placed).otherwise(F.col("html")), "id": F.when(named, anchor_id(F.col("name"))).otherwise(F.col("id"))}).drop("_mark", "_at", "_cut")


def cut_at_names(html: pd.Series, names: pd.Series) -> pd.Series:
    """Each text as pieces, every second one a name's mention."""
    compiled: dict[tuple, re.Pattern] = {}
    out = []
    for text, own in zip(html, names, strict=True):
        if text is None or own is None or not len(own):
            out.append([text])
            continue
        key = tuple(sorted(own, key=lambda n: (-len(n), n)))
        if key not in compiled:
            compiled[key] = re.compile(r"<[^>]+>|\\\(.*?\\\)|\\\[.*?\\\]|(?<![\w-])(" + "|".join(map(re.escape, key)) + r")(?![\w-])", re.S)
        pieces, at = [], 0
        for m in compiled[key].finditer(text):
            if m[1]:
                pieces += [text[at : m.start()], m[1]]
                at = m.end()
        out.append([*pieces, text[at:]])
    return pd.Series(out)


def wired(blocks: DataFrame) -> DataFrame:
    """Blocks with anchors, numbered links and ways back.

    Mentions are numbered for each name in reading order by one window over mentions alone, whose rows are few; texts stay in their rows."""
    blocks = announced(blocks)
    names = blocks.where(F.col("name").isNotNull()).groupBy("chapter_id").agg(F.collect_set("name").alias("names"))
    cut = F.pandas_udf(cut_at_names, "array<string>")
    pieces = blocks.join(names, "chapter_id", "left").withColumn("pieces", cut("html", F.when(F.col("name").isNull(), F.col("names"))))
    mentions = pieces.where(F.size("pieces") > 1).select(*PLACE, F.posexplode("pieces").alias("pos", "mention")).where("pos % 2 = 1")
    order = Window.partitionBy("chapter_id", "mention").orderBy("page_idx", "block_idx", "pos")
    numbered = mentions.withColumn("n", F.row_number().over(order))
    of_block = numbered.groupBy(*PLACE).agg(F.map_from_entries(F.collect_list(F.struct("pos", "n"))).alias("numbers"))
    cited = numbered.select("chapter_id", F.col("mention").alias("name")).distinct().withColumn("cited", F.lit(True))
    link = lambda piece, n: F.concat(F.lit('<a class="bibref cite-src" id="'), anchor_id(piece), F.lit("-cite-"), n, F.lit('" href="#'), anchor_id(piece), F.lit('">'), piece, F.lit("</a>"))
    linked = F.array_join(F.transform("pieces", lambda piece, k: F.when(k % 2 == 1, link(piece, F.element_at("numbers", k).cast("string"))).otherwise(piece)), "")
    out = pieces.join(of_block, PLACE, "left").join(cited, ["chapter_id", "name"], "left")
    out = out.withColumn("html", F.when(F.col("numbers").isNotNull(), linked).otherwise(F.col("html")))
    return out.withColumn("html", F.when(F.col("cited"), with_return(F.col("html"), F.col("id"))).otherwise(F.col("html"))).drop("names", "pieces", "numbers", "cited")


def with_return(html: Column, key: Column) -> Column:
    """A link back to the first mention, before the last paragraph's end or at the end."""
    back = F.concat(F.lit(' <a class="bibref-back" data-bib="'), key, F.lit('" href="#'), key, F.lit('-cite-1" title="retour">↩</a>'))
    before, after = F.regexp_extract(html, r"(?s)^(.*)</p>", 1), F.substring_index(html, "</p>", -1)
    return F.when(F.contains(html, F.lit("</p>")), F.concat(before, back, F.lit("</p>"), after)).otherwise(F.concat(html, back))


def cited_keys(blocks: DataFrame) -> DataFrame:
    """The keys (key) that some link in the blocks cites."""
    return blocks.select(F.explode(F.regexp_extract_all("html", F.lit(r'id="([^"]+)-cite-\d+"'), F.lit(1))).alias("key")).distinct()
