"""A bounded, reproducible sample of labelled rows, the same for any cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Label values that a sample is drawn for.
MOST_VALUES = 64


def sample(docs: DataFrame, labels: DataFrame, label_column: str, most: int, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """At most `most` rows for each label value, those with the smallest id hash: (id, text, label), and how many rows each value has in all.

    Rows without a label or id are left out; an id with several labels takes the largest, one with several texts the smallest text. The sample's ids are at most `most` times the number of label values, so they are broadcast; more than MOST_VALUES label values are refused."""
    known = labels.select(id_column, F.col(label_column).cast("int").alias("label")).dropna().groupBy(id_column).agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().limit(MOST_VALUES + 1).collect()}
    if len(counts) > MOST_VALUES:
        raise ValueError(f"{label_column} has more than {MOST_VALUES} values")
    chosen = None
    for value in sorted(counts):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64(id_column), id_column).limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        chosen = known.limit(0)
    spark = docs.sparkSession
    ids = spark.createDataFrame(chosen.collect(), chosen.schema)  # bounded by `most`
    rows = docs.select(id_column, F.coalesce(text_column, F.lit("")).alias("text")).join(F.broadcast(ids), id_column)
    return rows.groupBy(id_column, "label").agg(F.min("text").alias("text")).select(id_column, "text", "label"), counts
