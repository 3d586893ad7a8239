"""Sinks: nested JSON partitioned by volume and language, guarded and staged writes."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def guarded(stubs: DataFrame, existing: DataFrame) -> DataFrame:
    """Stubs whose chapter isn't populated yet: some page of it has blocks."""
    populated = existing.where(F.exists("pages", lambda p: F.size(p["blocks"]) > 0)).select("chapter_id").distinct()
    return stubs.join(populated, "chapter_id", "left_anti")


def write_chapters(chapters: DataFrame, path: str, by: list[str], mode: str = "errorifexists") -> None:
    chapters.write.mode(mode).partitionBy(*by).json(path)


def round_trips(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose JSON doesn't read back as the same value."""
    kind = rows.schema[column].dataType
    return rows.where(~F.from_json(F.to_json(column), kind).eqNullSafe(F.col(column)))


def assembled(pages: DataFrame, parts: DataFrame) -> DataFrame:
    """A row for each chapter: whether all parts are there with as many blocks, and the pages that aren't."""
    both = pages.join(parts.select("chapter_id", "page_id", F.col("n_blocks").alias("got")), ["chapter_id", "page_id"], "left")
    bad = F.when(F.col("got").isNull(), F.concat(F.lit("missing "), "page_id")).when(F.col("got") != F.col("n_blocks"), F.concat(F.lit("bad "), "page_id"))
    return both.groupBy("chapter_id").agg(F.bool_and(F.coalesce(F.col("got") == F.col("n_blocks"), F.lit(False))).alias("complete"), F.array_sort(F.collect_list(bad)).alias("problems"))


def settled(df: DataFrame, name: str) -> DataFrame:
    """Written once in the folder that driver and executors share (spark.checkpoint.dir, the warehouse where it is unset) and read back."""
    spark = df.sparkSession
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{at.rstrip('/')}/folia-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame, path: str, really: bool, form: str = "json", by: list[str] | None = None) -> DataFrame:
    """The dry-run switch: only with `really` anything is written. Gives what it was given."""
    if really:
        df.write.mode("overwrite").partitionBy(*by or []).format(form).save(path)
    return df


def save_cache(cache: DataFrame, path: str) -> None:
    """Replaces a cache (src, dst) by a new one, sorted by source: written beside it first and then renamed, so that a write that fails leaves the old one. The cache may be read from the same path."""
    spark = cache.sparkSession
    staged, held = f"{path}.{uuid.uuid4().hex[:8]}.new", f"{path}.{uuid.uuid4().hex[:8]}.old"
    cache.groupBy("src").agg(F.max("dst").alias("dst")).orderBy("src").write.parquet(staged)
    new, fs = _files(spark, staged)
    old, _ = _files(spark, path)
    aside, _ = _files(spark, held)
    if fs.exists(old) and not fs.rename(old, aside):
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(new, old):
        fs.rename(aside, old)
        raise OSError(f"{staged} could not be renamed")
    fs.delete(aside, True)


def split_pages(chapters: DataFrame, path: str) -> DataFrame:
    """Each page as JSON under its chapter and page; gives the listing (chapter_id, page_id, n_blocks, n_chars)."""
    pages = chapters.select("chapter_id", F.posexplode("pages").alias("page_idx", "p")).select("chapter_id", F.col("p.id").alias("page_id"), "page_idx", "p")
    pages.write.mode("overwrite").partitionBy("chapter_id", "page_id").json(path)
    size = F.aggregate(F.col("p.blocks"), F.lit(0).cast("long"), lambda a, b: a + F.length(F.coalesce(b["html"], F.lit(""))))
    return pages.select("chapter_id", "page_id", F.size("p.blocks").cast("long").alias("n_blocks"), size.alias("n_chars"))


def manifest(chapters: DataFrame, anchors: DataFrame, order: str = "ord") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chapter entries, contents lines and the anchor index (first place wins) of chapters (chapter_id, ord, ...) and anchors (anchor, page_id, ord)."""
    entries = chapters.select(order, F.col("chapter_id").alias("id"), "title", "number", "alias", "author", F.transform("pages", lambda p: p["id"]).alias("page_ids"))
    lines = chapters.select(order, "number", F.posexplode("pages").alias("at", "p"))
    toc = lines.select(F.col("p.id").alias("page_id"), F.col("p.title").alias("title"), F.when(F.col("at") == 0, 1).otherwise(2).alias("level"), order, "at", ((F.col("at") == 0) & F.col("number").isNotNull()).alias("is_numbered_chapter"), F.when(F.col("at") == 0, F.col("number")).alias("chapter_number"))
    index = anchors.groupBy("anchor").agg(F.min_by("page_id", "ord").alias("page_id"))
    return entries, toc, index


def write_manifest(frames: tuple[DataFrame, DataFrame, DataFrame], path: str, language: str, base: str) -> bool:
    """Always written anew, and for the base language only."""
    if language != base:
        return False
    for name, df in zip(("chapters", "toc", "anchor_index"), frames, strict=True):
        df.write.mode("overwrite").json(f"{path}/{name}")
    return True


def write_config(spark: SparkSession, config: dict, path: str) -> None:
    """A constant configuration as one JSON row."""
    spark.createDataFrame([(json.dumps(config, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)
