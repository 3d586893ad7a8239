"""Helpers that the operators of this subpackage share.

Conventions for all operators here: a null text counts as empty text, a null
id is carried through as null, repeated rows are each answered, and columns
beyond the ones an operator names are ignored by queries and kept by stages.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that end a word in the contracts: space and U+0009 to U+000D.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by the path Spark was given; only Spark's readers open it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_folia"
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/folia-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: a Parquet table in the shared folder, read back. A lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folia_path = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Deletes tables made by written() once nothing reads them any more."""
    for df in frames:
        remove(df.sparkSession, df._folia_path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def numbered(docs: DataFrame) -> DataFrame:
    """The same rows with columns c0, c1, ..., so that a stage's own names can't clash with theirs."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def place(docs: DataFrame, name: str) -> str:
    """What numbered() calls a column."""
    return f"c{docs.columns.index(name)}"


def remainder(column: str, n: int):
    """crc32 of the id as text, mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column without a copy; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, most: int):
    """Row ranges of about `most` bytes each, so that working memory doesn't depend on the batch; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Cache(dict):
    """A bounded memo: emptied when full, so results never depend on it."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most

    def room(self, more: int) -> None:
        if len(self) + more > self.most:
            self.clear()
