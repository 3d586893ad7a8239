"""Structural validation of two language versions as one table of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.functions import text as T


def tags(html) -> Column:
    return F.regexp_extract_all(html, F.lit(r"</?([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1))


def rules(level: int) -> list[tuple[str, Column]]:
    """(code, violated) over rows with fr_* and en_* columns. Level 1: ids, targets and math as multisets; 2: tags as a multiset as well; 3: tags in sequence."""
    same = lambda f: ~f(F.col("fr_html")).eqNullSafe(f(F.col("en_html")))
    both = F.col("fr_html").isNotNull() & F.col("en_html").isNotNull()
    out = [
        ("missing_en", F.col("en_html").isNull()), ("missing_fr", F.col("fr_html").isNull()),
        ("ids", both & same(lambda c: F.array_sort(T.attribute_values(c, "id")))), ("hrefs", both & same(lambda c: F.array_sort(T.attribute_values(c, "href")))),
        ("math", both & same(T.math_signature)), ("title_null", both & (F.col("fr_title").isNull() != F.col("en_title").isNull())),
    ]
    if level >= 2:
        out += [("tags", both & same(lambda c: F.array_sort(tags(c)))), ("data_bib", both & same(lambda c: F.array_sort(T.attribute_values(c, "data-bib"))))]
    if level >= 3:
        out.append(("tag_sequence", both & same(tags)))
    return out


def violations(pairs: DataFrame, keys: list[str], level: int = 2) -> DataFrame:
    """A row for each violated rule of each aligned pair."""
    codes = F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in rules(level)]))
    return pairs.select(*keys, F.explode(codes).alias("code")).withColumn("severity", F.lit("error"))


def degenerate(source: Column, target: Column) -> Column:
    """A translation gone wrong: far too long, in another script, or with a four-gram said five times over."""
    tokens = F.regexp_extract_all(F.lower(target), F.lit("([a-z']+)"), F.lit(1))
    # each array is bound to a lambda's variable, as an expression inside a lambda is worked out again for each element
    bound = lambda c, f: F.get(F.transform(F.array(c), f), F.lit(0))
    often = lambda g: F.exists(F.transform(g, lambda x, i: x.eqNullSafe(F.get(g, i + 4))), lambda same: same)
    repeats = bound(tokens, lambda w: F.when(F.size(w) >= 30, bound(F.sort_array(T.ngrams(w, 4)), often)).otherwise(False))
    return (F.length(target) > F.greatest(F.lit(600), 4 * F.length(source))) | target.rlike(r"[\u0400-\u04ff\u3400-\u9fff]") | repeats


def fragment_problem(source: Column, target: Column) -> Column:
    """What is wrong with a translated fragment, null if nothing: its tags in sequence, then its placeholders."""
    marks = lambda c: F.array_sort(F.regexp_extract_all(c, F.lit(r"(\[\[M[0-9]+\]\])"), F.lit(1)))
    full = lambda c: F.regexp_extract_all(c, F.lit("(<[^>]*>)"), F.lit(1))
    return F.when(target.isNull(), "missing").when(~full(source).eqNullSafe(full(target)), "tags").when(~marks(source).eqNullSafe(marks(target)), "placeholders")
