"""Keyed operators: defined and referenced names, first and last definitions, lookups, alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    return rows.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value))


def last_wins(rows: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def dangling(refs: DataFrame, defined: DataFrame, key: str) -> DataFrame:
    """References without a definition, with their counts."""
    return refs.join(defined.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def resolved(refs: DataFrame, labels: DataFrame, key: str, display: Column, missing: str = "??") -> DataFrame:
    """Each reference with its label's display, or the mark for unresolved ones."""
    return refs.join(labels, key, "left").withColumn("shown", F.coalesce(display, F.lit(missing)))


def aligned(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Two versions side by side by position; a missing side stays null."""
    return left.join(right, keys, "full")


def attached(notes: DataFrame, blocks: DataFrame, fallback: Column) -> DataFrame:
    """Each note to the first page whose html names its marker: ids are drawn from the html and joined by equality, no text is searched for each note."""
    marks = blocks.select("chapter_id", "page_idx", F.explode(F.regexp_extract_all("html", F.lit(r'\bid="([^"]*)"'), F.lit(1))).alias("mark"))
    first = marks.groupBy("chapter_id", "mark").agg(F.min("page_idx").alias("found"))
    return notes.withColumn("mark", F.concat("id", F.lit("ref"))).join(first, ["chapter_id", "mark"], "left").withColumn("page_idx", F.coalesce("found", fallback)).drop("found", "mark")


def ordered_children(rows: DataFrame, keys: list[str], order: str, fields: list[str], name: str) -> DataFrame:
    """Children collected into their parent in order."""
    got = F.array_sort(F.collect_list(F.struct(order, *fields)))
    return rows.groupBy(*keys).agg(F.transform(got, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name))
