"""Operator 6: quality rules compiled into one projection.

A threshold table of (name, measure, lower, upper) becomes one Spark
projection without user functions and without a shuffle. Measures are built
from the text alone: lengths, symbol, stop-word and line ratios, repeats.

Null or empty text, and text of white space: no words, so it fails. A measure
whose divisor is 0 is 0. Ties and repeated rows are each answered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.llm.common import numbered, place

#: Frequent function words of the four languages.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with be as by this at are from an not or have had but his they which you".split(),
    "fr": "de la le et les des en un du une est que pour qui dans sur au pas par avec ce il ne se plus son sont aux mais ou".split(),
    "de": "der die und in den von zu das mit sich des auf für ist dem im nicht eine ein als auch es an werden aus er hat dass sie nach".split(),
    "es": "de la que el en y los se del un las por con una no para su es al lo como más o pero sus le ha me si sin".split(),
}

#: Measure, smallest and largest value that passes (None: no bound).
THRESHOLDS = [
    ("mean_word_chars", "mean_word_chars", 2, 20),
    ("symbols_per_word", "symbol_ratio", None, 0.3),
    ("stop_words", "stop_word_ratio", 0.02, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.5),
    ("bullet_lines", "bullet_line_ratio", None, 0.9),
    ("upper_case", "upper_ratio", None, 0.35),
]

SYMBOLS = "#*$%&|<>"
SPLIT = r"[\x20\x09-\x0D]+"
WINDOW = 5


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPLIT), lambda w: w != "")


def windows_of(hashed: Column) -> Column:
    """A 64-bit hash of each window of five, from the words' hashes (a column, so that no lambda computes them anew)."""
    n = F.size(hashed)
    return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashed, i, F.lit(WINDOW))))).otherwise(F.array().cast("array<bigint>"))


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds the counts and the ratios as columns that start with an underscore.

    Words inside windows that occur twice or more: only texts with equal window hashes are sorted by (hash, place); each repeated window adds the words that the one before it hadn't covered."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    out = docs.withColumn("_text", text).withColumn("_words", words_of(F.col("_text")))
    out = out.withColumn("_hashed", F.transform("_words", lambda w: F.xxhash64(w)))
    out = out.withColumn("_windows", windows_of(F.col("_hashed")))
    size = F.size("_windows")
    by_place = F.sort_array(F.transform(F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < size, by_place))
    same = lambda i, d: F.get(F.col("_sorted"), i + d)["h"]
    repeated = F.transform(F.filter(F.col("_sorted"), lambda x, i: same(i, 1).eqNullSafe(x["h"]) | same(i, -1).eqNullSafe(x["h"])), lambda x: x["i"])
    out = out.withColumn("_places", F.sort_array(repeated))
    covered = F.aggregate("_places", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("_lines", lines)
    n_words = F.size("_words").cast("long")
    n_lines = F.size("_lines").cast("long")
    bare = F.length(F.array_join("_words", "")).cast("long")
    stop = sorted({form for words in STOP_WORDS.values() for w in words for form in (w, w.capitalize())})
    n_stop = F.size(F.filter("_words", lambda w: w.isin(stop))).cast("long")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    plain = F.col("_text")
    for c in SYMBOLS:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    symbols = (F.length("_text") - F.length(plain)).cast("long")
    bullets = F.size(F.filter("_lines", lambda line: F.ltrim(line).rlike(r"^[-*•]"))).cast("long")
    upper = F.length("_text") - F.length(F.regexp_replace("_text", r"\p{Lu}+", ""))
    measures = {
        "_n_words": n_words, "_word_chars": bare, "_n_symbols": symbols,
        "_n_dup_lines": n_lines - F.size(F.array_distinct("_lines")),
        "_n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "_mean_word_chars": ratio(bare, n_words), "_symbol_ratio": ratio(symbols, n_words), "_stop_word_ratio": ratio(n_stop, n_words),
        "_dup_line_ratio": ratio(n_lines - F.size(F.array_distinct("_lines")), n_lines), "_bullet_line_ratio": ratio(bullets, n_lines), "_upper_ratio": ratio(upper, bare),
    }
    # one struct, inlined again: a filter on a measure stays above it, where it would otherwise be pushed to the scan with the whole derivation inside its lambdas
    return out.select(*docs.columns, F.inline(F.array(F.struct(*[c.alias(name) for name, c in measures.items()]))))


def verdict(thresholds: list[tuple]) -> Column:
    """The table as one boolean: every measure within its bounds."""
    passes = F.lit(True)
    for _, measure, low, high in thresholds:
        if low is not None:
            passes = passes & (F.col(f"_{measure}") >= low)
        if high is not None:
            passes = passes & (F.col(f"_{measure}") <= high)
    return passes


def failed_rules(thresholds: list[tuple]) -> Column:
    """Names of the rules a text fails."""
    each = [F.when(~verdict([rule]), F.lit(rule[0])) for rule in thresholds]
    return F.array_compact(F.array(*each))


def base_failed() -> Column:
    return (F.col("_n_words") < 10) | (100 * F.col("_n_repeat_words") > 20 * F.col("_n_words"))


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """The counts, the base verdict, the verdict with the table, and the rules failed."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return measured(docs.select(id_column, text_column), text_column).select(
        id_column, *[F.col(f"_{c}").alias(c) for c in counts], base_failed().alias("base_failed"),
        (~base_failed() & verdict(thresholds)).alias("kept"), failed_rules(thresholds).alias("failed_rules"),
    )


def keep(docs: DataFrame, text_column: str = "text", thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """The rows that pass, with their own columns."""
    out = measured(numbered(docs), place(docs, text_column)).where(~base_failed() & verdict(thresholds))
    return out.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def oracle_sql(thresholds: list[tuple] = THRESHOLDS) -> str:
    """The same counts and verdict in DuckDB's SQL."""
    stop = sorted({form for words in STOP_WORDS.values() for w in words for form in (w, w.capitalize())})
    bounds = [f"{m} >= {low}" for _, m, low, _ in thresholds if low is not None] + [f"{m} <= {high}" for _, m, _, high in thresholds if high is not None]
    return ORACLE.replace("{stop}", ", ".join(f"'{w}'" for w in stop)).replace("{bounds}", " AND ".join(bounds))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(translate(x, E' \t\n\x0b\x0c\r', '      ')) <> '') AS lines
  FROM documents),
m AS (
  SELECT doc_id, t, words, lines, len(words)::BIGINT AS n_words,
    length(translate(t, E' \t\n\x0b\x0c\r', ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines
  FROM w),
p AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i+1], words[i+2], words[i+3], words[i+4]) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM g, (SELECT unnest(range(0, 5)) AS k) WHERE g.n >= 2 GROUP BY doc_id),
x AS (
  SELECT m.*, coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
    length(t) - length(regexp_replace(t, '\p{Lu}+', '', 'g')) AS n_upper,
    len(list_filter(words, lambda w: w IN ({stop}))) AS n_stop,
    len(list_filter(lines, lambda l: regexp_matches(l, '^ *[-*•]'))) AS n_bullets
  FROM m LEFT JOIN r USING (doc_id)),
y AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
    CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_word_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
    CASE WHEN n_lines > 0 THEN n_bullets / n_lines ELSE 0 END AS bullet_line_ratio,
    CASE WHEN word_chars > 0 THEN n_upper / word_chars ELSE 0 END AS upper_ratio
  FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {bounds} AS kept FROM y
"""
