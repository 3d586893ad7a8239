"""Scans: whole-text files, chapter JSON, JSON lines, encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = "struct<id string, type string, label string, title string, html string>"
NOTE = "struct<id string, number string, html string>"
ENTRY = "struct<id string, label string, html string, text string>"
PAGE = f"struct<id string, title string, html string, blocks array<{BLOCK}>, footnotes array<{NOTE}>, bibliography array<{ENTRY}>>"
CHAPTER = f"chapter_id string, title string, number string, alias string, author string, pages array<{PAGE}>"


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(chapter_id, src): a row for each file, named by its stem."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)
    return spark.read.text(path, wholetext=True).select(stem.alias("chapter_id"), F.col("value").alias("src"))


def decoded(spark: SparkSession, path: str, charset: str = "windows-1252") -> DataFrame:
    """Files of another encoding, as (chapter_id, src)."""
    stem = F.regexp_extract(F.col("path"), r"([^/]*?)(?:\.[^./]*)?$", 1)
    return spark.read.format("binaryFile").load(path).select(stem.alias("chapter_id"), F.decode("content", charset).alias("src"))


def chapters(spark: SparkSession, path: str) -> DataFrame:
    """Chapter JSON of either dialect; a broken file is a row with _bad set."""
    return spark.read.schema(f"{CHAPTER}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path, multiLine=True)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with their file and the text of lines that don't parse; blank lines give nothing. Files are split at line ends, so their size doesn't matter; bad_lines() has numbers."""
    rows = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("raw"))
    parsed = F.from_json("raw", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return rows.where(F.trim("raw") != "").withColumn("j", parsed).select("file", "j.*")


def bad_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, line, raw) of lines that don't parse, numbered from 1; reads only files that have one, each whole."""
    files = [r.path for r in json_lines_paths(spark, path, schema).collect()]  # files with faults
    if not files:
        return spark.createDataFrame([], "file string, line int, raw string")
    rows = spark.read.text(files, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\n")).alias("line", "raw"))
    return rows.where((F.trim("raw") != "") & faulty(schema)).select("file", (F.col("line") + 1).alias("line"), "raw")


def faulty(schema: str):
    """Whether the column raw isn't JSON of the schema."""
    return F.from_json("raw", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})["_bad"].isNotNull()


def json_lines_paths(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Paths of the files that have a line that doesn't parse."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    return rows.where((F.trim("raw") != "") & faulty(schema)).select("path").distinct()


def in_order(order: DataFrame, files: DataFrame) -> DataFrame:
    """Files in reading order (chapter_id, ord), sorted by ord; a null src tells of a missing file."""
    return order.join(files, "chapter_id", "left").orderBy("ord", "chapter_id")


def listed(spark: SparkSession, path: str, wanted: list[str], extra: str | None = None) -> DataFrame:
    """(ord, file, src): the wanted files that are there, in the given order, and then the extra one."""
    names = [*wanted, *([extra] if extra else [])]
    order = spark.createDataFrame(list(enumerate(names)), "ord int, file string")
    found = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("src"))
    return found.join(F.broadcast(order), "file").select("ord", "file", "src").orderBy("ord")


def parts(spark: SparkSession, path: str) -> DataFrame:
    """Translated pages laid out as <chapter>/<page>.json: chapter_id, page_id and the page; _bad holds the text of a file that doesn't parse."""
    at = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    page = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.json$", 1)
    fields = PAGE.removeprefix("struct<").removesuffix(">")
    rows = spark.read.schema(f"{fields}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("recursiveFileLookup", "true").json(path, multiLine=True)
    return rows.select(at.alias("chapter_id"), page.alias("page_id"), "*")


def snapshots(spark: SparkSession, old: str, new: str) -> DataFrame:
    """Two states of the same chapters side by side (chapter_id, old, new); a chapter that the old state hasn't is skipped."""
    read = lambda path, name: chapters(spark, path).where(F.col("_bad").isNull()).select("chapter_id", F.struct("title", "number", "pages").alias(name))
    return read(new, "new").join(read(old, "old"), "chapter_id")
