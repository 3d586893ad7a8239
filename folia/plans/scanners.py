"""Queries over the stateful scanners; SQL can't express these, tests hold them to fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions import text as T
from folia.operators import parse, render, repair, tex


def html_blocks(spark, sf_dir) -> DataFrame:
    """Blocks of each page with their type."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return parse.parse(pages, "page_id", "html").withColumn("type", T.block_type(F.col("tag"), F.col("css")))


def repaired_math(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", repair.repaired_delimiters(F.col("text")).alias("d")).select("doc_id", F.md5("d.text").alias("text_md5"), F.size("d.log").alias("n_repairs"))


def wrapped_math(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", repair.wrapped_math(F.col("text")).alias("d")).select("doc_id", F.md5("d.text").alias("text_md5"), F.size("d.log").alias("n_wrapped"))


def swapped_math(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", repair.swapped_delimiters(F.col("text")).alias("d")).select("doc_id", F.md5("d.text").alias("text_md5"), F.size("d.log").alias("n_swapped"))


def merged_math(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", repair.merged_math(F.col("text")).alias("d")).select("doc_id", F.md5("d.text").alias("text_md5"), F.size("d.log").alias("n_repairs"))


def tex_events(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return tex.event_rows(docs, "doc_id", "text")


def title_slugs(spark, sf_dir) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", tex.slugs(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("slug"))


def inline_html(spark, sf_dir) -> DataFrame:
    """Each document as inline TeX."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", F.md5(render.inline_html(F.col("text"))).alias("html_md5"))


def tex_chapters(spark, sf_dir) -> DataFrame:
    """Each document as a TeX source without labels: its blocks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    none = spark.createDataFrame([], "entry string, key string, display string")
    pages = render.rendered(docs, none, "doc_id", "text").select("source", "pos", F.posexplode("pages").alias("page", "p"))
    return pages.select("source", "pos", "page", F.size("p.blocks").alias("n_blocks"), F.size("p.footnotes").alias("n_notes"), F.md5("p.html").alias("html_md5"))


QUERIES = {f.__name__: f for f in (html_blocks, repaired_math, wrapped_math, swapped_math, merged_math, tex_events, title_slugs, inline_html, tex_chapters)}
