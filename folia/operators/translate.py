"""Translation around a pluggable engine: each distinct text is asked once, answers come back by join."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions import text as T
from folia.sources.writers import settled

ATTEMPTS, PAUSE = 5, 1.5


def asked(texts: DataFrame, engine: Callable[[list[str]], list[str | None]], attempts: int = ATTEMPTS, pause: float = PAUSE, batch: int = 8) -> DataFrame:
    """(src, dst) for rows (src): the engine gets small batches, again after a growing pause when it fails; null where it never answers."""

    def run(frames):
        for frame in frames:
            out: list[str | None] = []
            items = frame["src"].tolist()
            for k in range(0, len(items), batch):
                for n in range(attempts):
                    try:
                        out += engine(items[k : k + batch])
                        break
                    except Exception:  # an engine may fail in any way; the last failure leaves nulls
                        if n + 1 == attempts:
                            out += [None] * len(items[k : k + batch])
                        else:
                            time.sleep(pause * (n + 1))
            yield pd.DataFrame({"src": items, "dst": out})

    return texts.select("src").mapInPandas(run, "src string, dst string")


def translated(fragments: DataFrame, cache: DataFrame, engine, **options) -> tuple[DataFrame, DataFrame]:
    """Fragments (key, src) with dst, and the cache with what was new. Null and blank texts stay as they are. The answers are written first, so that the engine is asked once whatever is read of the two."""
    wanted = fragments.where(F.trim("src") != "").select("src").distinct().join(cache.select("src"), "src", "left_anti")
    grown = cache.select("src", "dst").unionByName(settled(asked(wanted, engine, **options).where(F.col("dst").isNotNull()), "answers"))
    return fragments.join(grown, "src", "left").withColumn("dst", F.when(F.trim("src") == "", F.col("src")).otherwise(F.col("dst"))), grown


#: Tags and formulas, which no engine may see.
KEPT = r"<[^>]+>|\\\(.*?\\\)|\\\[.*?\\\]"


def around(texts: DataFrame, cache: DataFrame, engine, **options) -> tuple[DataFrame, DataFrame]:
    """(key, dst) for rows (key, src), with the cache: only what stands between tags and formulas is translated, so none of them can be lost. A formula in an answer is dropped; a piece without an answer stays as it is."""
    pieces = F.regexp_extract_all("src", F.lit(f"(?s)({KEPT})|(?:(?!{KEPT}).)+"), F.lit(0))
    cut = texts.select("key", F.posexplode(pieces).alias("pos", "src"))
    is_kept = F.col("src").rlike(f"^(?s:{KEPT})$")
    parts = cut.where(~is_kept).select(F.struct("key", "pos").alias("key"), "src")
    answers, grown = translated(parts, cache, engine, **options)
    own = F.coalesce(F.regexp_replace("dst", r"(?s)\\\(.*?\\\)|\\\[.*?\\\]", ""), F.col("src"))
    every = answers.select("key.key", "key.pos", own.alias("part")).unionByName(cut.where(is_kept).select("key", "pos", F.col("src").alias("part")))
    joined = every.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "part"))), lambda x: x["part"]), "").alias("dst"))
    return texts.join(joined, "key", "left").select("key", F.when(F.col("src").isNotNull(), F.coalesce("dst", F.lit(""))).alias("dst")), grown


def with_formulas(texts: DataFrame, cache: DataFrame, engine, **options) -> tuple[DataFrame, DataFrame]:
    """(key, dst) for rows (key, src), with the cache: a text is translated whole with its formulas as placeholders; where the answer hasn't each placeholder exactly once, around its formulas instead."""
    protected, formulas = T.protect(F.col("src"), r"\\\(.*?\\\)|\\\[.*?\\\]")
    rows = texts.select(F.struct("key", F.col("src").alias("whole"), formulas.alias("formulas")).alias("key"), protected.alias("src"))
    first, grown = translated(rows, cache, engine, **options)
    first = first.select("key.*", F.col("dst"), T.once_each(F.col("dst"), F.size("key.formulas")).alias("good"))
    good = F.coalesce("good", F.lit(False))
    rest, grown = around(first.where(~good & F.col("whole").isNotNull()).select("key", F.col("whole").alias("src")), grown, engine, **options)
    done = first.where(good | F.col("whole").isNull()).select("key", F.when(F.col("whole").isNotNull(), T.restore(F.col("dst"), F.col("formulas"))).alias("dst"))
    return done.unionByName(rest), grown


def repaired(pairs: DataFrame, cache: DataFrame, engine, **options) -> tuple[DataFrame, DataFrame]:
    """Pairs (key, fr_html, en_html) with en_html translated anew, around tags and formulas, where its ids, targets or formula counts aren't the source's; adds is_repaired. Pairs without a source stay."""
    named = lambda c: F.array_sort(F.concat(T.attribute_values(c, "id"), F.transform(T.attribute_values(c, "href"), lambda h: F.concat(F.lit("->"), h))))
    target = F.coalesce("en_html", F.lit(""))
    wrong = F.col("fr_html").isNotNull() & ~(named(F.col("fr_html")).eqNullSafe(named(target)) & T.math_signature(F.col("fr_html")).eqNullSafe(T.math_signature(target)))
    marked = pairs.withColumn("is_repaired", wrong)
    anew, grown = around(marked.where("is_repaired").select("key", F.col("fr_html").alias("src")), cache, engine, **options)
    return marked.join(anew, "key", "left").withColumn("en_html", F.when(F.col("is_repaired"), F.col("dst")).otherwise(F.col("en_html"))).drop("dst"), grown


def chunks(text: str, size: Callable[[str], int], most: int = 450) -> list[str]:
    """A text in pieces of at most `most` tokens as `size` counts them: whole sentences while they fit, words of a sentence that is too long; a word that is too long stands alone."""
    out: list[str] = []
    held = ""
    for sentence in re.split(r"(?<=[.!?;:])\s+", text):
        if size(longer := f"{held} {sentence}".strip()) <= most:
            held = longer
            continue
        if held:
            out.append(held)
        held = ""
        for word in sentence.split():
            if held and size(f"{held} {word}") > most:
                out.append(held)
                held = word
            else:
                held = f"{held} {word}".strip()
    return [*out, held] if held else out


def chunked(texts: DataFrame, size: Callable[[str], int], most: int = 450) -> DataFrame:
    """(key, piece, src) for rows (key, src), to be asked piece by piece; null and blank texts have no piece."""

    @F.pandas_udf("array<string>")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda t: chunks(t, size, most) if t else [])

    return texts.select("key", F.posexplode(run("src")).alias("piece", "src"))
