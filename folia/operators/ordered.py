"""Ordered operators: windows within a document, and folds where a window can't carry the state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each line, numbered from 0."""
    return docs.select(id_column, F.posexplode(F.split(text_column, "\n")).alias("pos", "line"))


def paged(rows: DataFrame, key: str, order: str, is_break: Column) -> DataFrame:
    """Islands that begin at breaks: page 0 before the first. Adds page_idx, and the row's place in its page."""
    within = Window.partitionBy(key).orderBy(order)
    out = rows.withColumn("page_idx", F.sum(is_break.cast("int")).over(within.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    return out.withColumn("block_idx", (F.row_number().over(Window.partitionBy(key, "page_idx").orderBy(order)) - 1).cast("long"))


def greedy_batches(sizes: Column, limit: int, ahead: bool) -> Column:
    """Batch numbers of sizes in order, in one pass. Looking ahead, an item that would pass the limit opens a batch; else a batch closes once it is over the limit, so it overshoots by one item."""
    zero = F.struct(F.lit(0).cast("long").alias("batch"), F.lit(0).cast("long").alias("size"), F.array().cast("array<long>").alias("out"))

    def step(a, s):
        s = s.cast("long")
        opens = ((a["size"] > 0) & (a["size"] + s > limit)) if ahead else a["size"] > limit
        batch = a["batch"] + opens.cast("long")
        return F.struct(batch.alias("batch"), F.when(opens, s).otherwise(a["size"] + s).alias("size"), F.concat(a["out"], F.array(batch)).alias("out"))

    return F.aggregate(sizes, zero, step, lambda a: a["out"])


def depth(tokens: DataFrame, key: str, order: str, opens: Column, closes: Column) -> DataFrame:
    """Nesting depth after each token."""
    return tokens.withColumn("depth", F.sum(opens.cast("int") - closes.cast("int")).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)).cast("long"))


def inserted(old: Column, new: Column) -> Column:
    """Places in `new` that aren't in `old`, if `old` is a subsequence of it; null else."""
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("out"))

    def step(a, x):
        same = x.eqNullSafe(F.get(old, a["at"])) & (a["at"] < F.size(old))
        return F.struct((a["at"] + same.cast("int")).alias("at"), (a["i"] + 1).alias("i"), F.when(same, a["out"]).otherwise(F.concat(a["out"], F.array(a["i"]))).alias("out"))

    return F.aggregate(new, zero, step, lambda a: F.when(a["at"] == F.size(old), a["out"]))


def slice_around(text: Column, at: Column, width: int = 60) -> Column:
    """The characters within `width` of a 0-based place."""
    return F.substring(text, F.greatest(F.lit(1), at - (width - 1)), F.lit(width) + F.least(at, F.lit(width)))


def split_at(text: Column, marker: str) -> Column:
    """The text cut before each marker; the first piece is what stands before the first, empty if nothing does."""
    return F.split(F.replace(text, F.lit(marker), F.lit("\1" + marker)), "\1")


def volume_files(volumes: DataFrame, key: str, text: str, marker: str = "\\chapter") -> DataFrame:
    """(key, file, src): a source cut at its chapters, chapter-001 and so on, and main, which holds what stands before the first and inputs each."""
    name = lambda i: F.concat(F.lit("chapter-"), F.lpad(i.cast("string"), 3, "0"))
    pieces = volumes.select(key, split_at(F.col(text), marker).alias("p"))
    inputs = F.transform(F.when(F.size("p") > 1, F.sequence(F.lit(1), F.size("p") - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit("\\input{"), name(i), F.lit("}\n")))
    main = F.array(F.struct(F.lit("main").alias("file"), F.concat(F.get("p", F.lit(0)), F.array_join(inputs, "")).alias("src")))
    rest = F.transform(F.slice("p", F.lit(2), F.size("p")), lambda c, i: F.struct(name(i + 1).alias("file"), c.alias("src")))
    return pieces.select(key, F.inline(F.concat(main, rest)))
