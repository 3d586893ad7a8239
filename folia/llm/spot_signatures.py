"""Operator 10: document fingerprints from spot signatures.

Each anchor (a common word) starts a chain of the next content words; the
distinct hashes of these chains are the document's signature set, and its
fingerprint is the sorted set in hexadecimal. Sets are compared by Jaccard
similarity, pruned by set length: two sets can't be more alike than the
smaller is long in units of the larger, so only neighbouring length partitions
meet. DataFrame functions only.

A text without a chain (null, empty, or short of common words) has one
signature, the hash of the whole text, so equal texts always have equal
fingerprints. Repeated rows are each answered.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folia.llm.quality_rules import STOP_WORDS

#: Content words in a chain; likeness below which the set lengths alone decide that two documents aren't alike (0).
CHAIN, LEAST_LIKENESS = 3, 0.1
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FIRST_ID = -(1 << 63)


def with_signatures(docs: DataFrame, text_column: str, name: str, chain: int = CHAIN) -> DataFrame:
    """Adds the sorted set of signatures of a text that isn't null."""
    stop = sorted({w for words in STOP_WORDS.values() for w in words})
    words, common, content = f"{name}_words", f"{name}_common", f"{name}_content"
    out = docs.withColumn(words, F.filter(F.split(F.lower(text_column), SEPARATORS), lambda w: w != ""))
    out = out.withColumn(common, F.filter(F.transform(words, lambda w, i: F.when(w.isin(stop), i)), lambda i: i.isNotNull()))
    out = out.withColumn(content, F.filter(words, lambda w: ~w.isin(stop)))
    size = F.size(content)
    # before the k-th common word, at place p, stand p - k content words
    chains = F.transform(common, lambda p, k: F.when(p - k + chain <= size, F.xxhash64(F.get(F.col(words), p), F.slice(F.col(content), p - k + 1, F.lit(chain)))))
    out = out.withColumn(name, F.array_sort(F.array_distinct(F.filter(chains, lambda h: h.isNotNull()))))
    return out.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(F.array(F.xxhash64(text_column)))).drop(words, common, content)


def fingerprint(signatures: Column) -> Column:
    return F.array_join(F.transform(signatures, lambda h: F.hex(h)), " ")


def likeness(a: Column, b: Column, floor: float = 0.0) -> Column:
    """Jaccard similarity; 0 without intersecting where the lengths alone keep it below the floor, and 0 where one set ends before the other begins."""
    m, n = F.size(a), F.size(b)
    apart = (F.least(m, n) / F.greatest(m, n) < floor) | (F.get(a, m - 1) < F.get(b, F.lit(0))) | (F.get(b, n - 1) < F.get(a, F.lit(0)))
    both = F.size(F.array_intersect(a, b))
    return F.when(apart, F.lit(0.0)).otherwise(both / (m + n - both))


def length_partition(n: Column, threshold: float) -> Column:
    """Sets whose lengths can reach the threshold lie in the same partition or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1 / threshold))).cast("int")


def similar(docs: DataFrame, threshold: float = 0.75, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Membership of each row in a class of equal sets (its smallest id), and the pairs of classes at or above the threshold.

    A pair shares one of the rarest signatures of each set: all but the last ceil(threshold * n) - 1 in the order of document frequency. Those are joined within a length partition and its upper neighbour."""
    rows = with_signatures(docs.select(id_column, F.coalesce(text_column, F.lit("")).alias("_text")), "_text", "signatures").drop("_text")
    rows = rows.withColumn("set_hash", F.xxhash64("signatures"))
    classes = rows.groupBy("set_hash").agg(F.min(id_column).alias("class_id"), F.first("signatures").alias("signatures"))
    members = rows.select(id_column, "set_hash").join(classes.select("set_hash", "class_id"), "set_hash").select(id_column, "class_id")
    spots = classes.select("class_id", F.explode("signatures").alias("spot"))
    ranked = spots.join(spots.groupBy("spot").count(), "spot").groupBy("class_id").agg(F.sort_array(F.collect_list(F.struct("count", "spot"))).alias("by_count"))
    n = F.size("by_count")
    kept = ranked.select("class_id", n.alias("n"), F.explode(F.slice("by_count", F.lit(1), n - F.ceil(n * threshold).cast("int") + 1)).alias("x"))
    kept = kept.select("class_id", "n", F.col("x.spot").alias("spot"), length_partition(F.col("n"), threshold).alias("part"))
    left = kept.select(F.col("class_id").alias("a"), F.col("n").alias("m"), "spot", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = kept.select(F.col("class_id").alias("b"), F.col("n").alias("k"), "spot", "part")
    close = (F.col("m") <= F.col("k")) & (F.col("m") >= threshold * F.col("k")) & ((F.col("m") < F.col("k")) | (F.col("a") < F.col("b")))
    pairs = left.join(right, ["spot", "part"]).where(close).select("a", "b").distinct()
    sets = classes.select("class_id", "signatures")
    pairs = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", likeness(F.col("sa"), F.col("sb"), threshold).alias("likeness"))
    return members, pairs.where(F.col("likeness") >= threshold)


def slice_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds a key reaches: whole runs of them first, then those of one run."""
    if len(bounds) < 32:
        return reduce(lambda a, b: a + b, [(key >= b).cast("int") for b in bounds], F.lit(0))
    width = math.isqrt(len(bounds))
    runs = [bounds[k : k + width] for k in range(0, len(bounds), width)]
    at = F.size(F.filter(F.array(*[F.lit(r[0]) for r in runs]), lambda b: b <= key))
    run = F.get(F.array(*[F.array(*map(F.lit, r)) for r in runs]), at - 1)
    return F.when(at == 0, F.lit(0)).otherwise((at - 1) * width + F.size(F.filter(run, lambda b: b <= key)))


def with_next(rows: DataFrame, id_column: str, columns: list[str]) -> DataFrame:
    """Adds next_<column>: the values of the following row in descending id, of the first row after the last.

    Ids are cut into slices of about equal counts at quantiles, as many as there are shuffle partitions; each slice is sorted on its own and ends with a copy of the first row of the slice after it. Ties of an id follow the hash of the row's text; null ids come last."""
    spark = rows.sparkSession
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(FIRST_ID))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.select(F.percentile_approx(key, [k / n for k in range(1, n)] or [0.5], max(10_000, 8 * n)).alias("q")).first()["q"] or []
    rows = rows.withColumn("_key", key).withColumn("_slice", slice_of(F.col("_key"), sorted(set(cuts)))).withColumn("_copy", F.lit(False))
    tops = sorted(rows.groupBy("_slice").agg(F.max("_key").alias("top")).collect())  # a row for each slice
    if not tops:
        return rows.drop("_key", "_slice", "_copy").withColumns({f"next_{c}": F.col(c) for c in columns})
    upper = {t["top"]: tops[(i + 1) % len(tops)]["_slice"] for i, t in enumerate(tops)}
    to = F.create_map(*[F.lit(x) for pair in upper.items() for x in pair])
    copies = rows.where(F.col("_key").isin(list(upper))).withColumn("_slice", to[F.col("_key")]).withColumn("_copy", F.lit(True))
    order = Window.partitionBy("_slice").orderBy("_copy", F.desc("_key"), "_tie")
    out = rows.unionByName(copies).withColumn("_tie", F.xxhash64(*columns))
    out = out.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return out.where(~F.col("_copy")).drop("_key", "_slice", "_copy", "_tie")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text and of the text with its last third replaced by the next document's beginning, and their likeness."""
    rows = docs.select(id_column, F.coalesce(text_column, F.lit("")).alias("text"))
    out = with_next(rows, id_column, ["text"])
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    out = out.withColumn("edited", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 3) as int))"), F.expr("left(next_text, cast(floor(length(text) / 3) as int))")))
    for text, name in (("text", "own"), ("edited", "changed"), ("next_text", "following")):
        out = with_signatures(out, text, name)
    return out.select(
        id_column, n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), LEAST_LIKENESS).alias("near_edited"), likeness(F.col("own"), F.col("following"), LEAST_LIKENESS).alias("near_next"), third.cast("long").alias("n_replaced"),
    )
