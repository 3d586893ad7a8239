"""Operator 5: language by Bayesian fusion of evidence.

Four kinds of evidence add up as log odds: the likelihood of the text under
each language's word and ending shares, the language its markup declares, the
language its address names, and its host's prior. Host priors are smoothed
twice, host towards domain and domain towards all rows, and come from grouped
sums of the text's own posteriors, so no declared language enters them.

Null or empty text: no text evidence; with no other evidence the priors stand
and the row is rejected. Null host: the overall prior. Ties go to the
language first in the alphabet. Repeated rows are each answered.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.llm.common import Cache, numbered, place, slices, text_buffers

#: Rows of each language that the likelihoods are learnt from, and buckets that features are hashed into: none is left out, and the model's size is bounded.
MOST_ROWS, BUCKETS = 1500, 1 << 18
#: Weight of one word's evidence (words aren't independent), most text evidence counted, and log odds of a declaration and of an address.
TEMPER, MOST_WORDS, DECLARED, ADDRESS = 0.5, 200, 2.0, 1.5
#: Rows a prior counts for at each level, and the posterior a row needs.
SMOOTH, LEAST = 20.0, 0.6
#: Languages that are told apart; more are refused.
MOST_LANGUAGES = 256
CACHE_WORDS = 300_000
#: Share of all rows, as one in HOT, above which a host is hot.
HOT = 100
#: Languages whose sums a worker holds at once.
HELD = 16
SLICE_BYTES = 8 << 20
WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    low = word.lower()
    return [low, "$" + low[-2:], "^" + low[:2], *{"." + c for c in low if c > "\x7f"}]


def buckets_of(word: str) -> tuple[int, ...]:
    return tuple(zlib.crc32(f.encode("utf-8", "surrogatepass")) % BUCKETS for f in features_of(word))


class Likelihoods:
    """Centred log shares of each language (rows) in each bucket that the sample has a feature in."""

    def __init__(self, languages: list[str], buckets: list[int], logs: np.ndarray):
        self.languages, self.logs = languages, logs
        self.number = dict(zip(buckets, range(len(buckets)), strict=True))

    def evidence(self, text: str, known: Cache) -> tuple[np.ndarray, int]:
        """Log likelihoods of each language, and how many features told them apart."""
        found: list[int] = []
        words = WORD.findall(text)
        known.room(len(words) if len(known) + len(words) > known.most else 0)
        for word in words:
            if (mine := known.get(word)) is None:
                mine = known[word] = tuple(self.number[b] for b in buckets_of(word) if b in self.number)
            found.extend(mine)
        if not found:
            return np.zeros(len(self.languages)), 0
        total = self.logs[:, found].sum(axis=1, dtype=float)
        return TEMPER * total * min(1.0, MOST_WORDS / len(found)), len(found)


def fit(docs: DataFrame, language_column: str = "lang", text_column: str = "text", id_column: str = "doc_id", most: int = MOST_ROWS) -> Likelihoods:
    """Feature shares of each language from at most `most` rows of it, those with the smallest id hash."""
    counts = docs.where(F.col(language_column).isNotNull()).select(language_column).distinct().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{language_column} has more than {MOST_LANGUAGES} values")
    languages = sorted(r[language_column] for r in counts)
    if not languages:
        return Likelihoods(["und"], [], np.zeros((1, 0)))
    chosen = None
    for language in languages:
        part = docs.where(F.col(language_column) == language).select(id_column, F.xxhash64(id_column).alias("_h")).orderBy("_h", id_column).limit(most).select(id_column)
        chosen = part if chosen is None else chosen.unionByName(part)
    ids = docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema)  # at most `most` ids a language
    rows = docs.join(F.broadcast(ids.distinct()), id_column).where(F.col(language_column).isNotNull())

    def sums(totals: dict[str, np.ndarray]):
        for language, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["language", "bucket", "n"])
        totals.clear()

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        known = Cache(CACHE_WORDS)
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if language not in totals and len(totals) == HELD:
                    yield from sums(totals)
                if language not in totals:
                    totals[language] = np.zeros(BUCKETS, np.int64)
                total = totals[language]
                for word, n in Counter(WORD.findall(text.as_py() or "")).items():
                    known.room(1)
                    if (mine := known.get(word)) is None:
                        mine = known[word] = buckets_of(word)
                    for bucket in mine:
                        total[bucket] += n
        yield from sums(totals)

    summed = rows.select(language_column, text_column).mapInArrow(count, "language string, bucket long, n long").groupBy("bucket").pivot("language", languages).agg(F.sum("n")).fillna(0)
    top = sorted(summed.collect())  # at most BUCKETS rows
    table = np.array([[r[c] for r in top] for c in languages], float).reshape(len(languages), -1)
    share = (table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * table.shape[1] + 1)
    return Likelihoods(languages, [r["bucket"] for r in top], (np.log(share) - np.log(share).mean(axis=0)).astype(np.float32))


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def address_language(url: Column, languages: list[str]) -> Column:
    """The language that an address names: a first path part, a first host label, or the suffix of the host."""
    host = F.regexp_extract(url, r"^[a-z]+://([^/:?#]+)", 1)
    named = [F.lower(F.regexp_extract(url, r"^[a-z]+://[^/]+/([A-Za-z]{2})(?:[/?#]|$)", 1)), F.regexp_extract(host, r"^([a-z]{2})\.", 1), F.regexp_extract(host, r"\.([a-z]{2})$", 1)]
    return F.coalesce(*[F.when(c.isin(languages), c) for c in named])


def markup_language(html: Column, languages: list[str]) -> Column:
    """The language an html tag declares."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2})", 1))
    return F.when(found.isin(languages), found)


def visible_text(html: Column) -> Column:
    bare = F.regexp_replace(html, r"(?is)<(script|style|nav)\b.*?</\1>", " ")
    return F.regexp_replace(bare, r"<[^>]*>", " ")


def identify(rows: DataFrame, model: Likelihoods, least: float = LEAST) -> DataFrame:
    """For rows (key, text, host, declared, address): key, language, posterior, n_features, kept.

    The text is read once; sums are merged in each task before they are shuffled and a hot host's rows are spread, so a host with a third of the rows is as cheap as any."""
    languages = model.languages
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(model)  # at most BUCKETS numbers a language
    width = len(languages)

    def read(batches):
        own, known = sent.value, Cache(CACHE_WORDS)
        for batch in batches:
            _, offsets = text_buffers(batch.column("text"))
            logs, n = [], []
            for i, j in slices(offsets, SLICE_BYTES):
                for text in batch.column("text").slice(i, j - i).to_pylist():
                    log, count = own.evidence(text or "", known)
                    logs.append(log.tolist())
                    n.append(count)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "host", "declared", "address")), pa.array(logs, pa.list_(pa.float64())), pa.array(n, pa.int64())], names=["key", "host", "declared", "address", "logs", "n_features"])

    kind = rows.schema["key"].dataType.simpleString()
    from folia.llm.common import written

    seen = written(rows.select("key", "text", "host", "declared", "address").mapInArrow(read, f"key {kind}, host string, declared string, address string, logs array<double>, n_features long"), "evidence")

    def posterior(logs: Column) -> Column:
        shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
        return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))

    read_rows = seen.withColumn("p", posterior(F.col("logs")))
    told = F.col("n_features") > 0
    sums = [F.coalesce(F.sum(F.when(told, F.get("p", F.lit(k)))), F.lit(0.0)).alias(f"p{k}") for k in range(width)]
    counted = written(read_rows.groupBy("host").agg(*sums, F.count(F.lit(1)).alias("n_rows"), F.count(F.when(told, 1)).alias("n_told")), "hosts")
    by_host = counted.where("n_told > 0").withColumn("domain", domain_of(F.col("host")))
    by_domain = by_host.groupBy("domain").agg(*[F.sum(f"p{k}").alias(f"d{k}") for k in range(width)])
    overall = by_domain.agg(*[F.coalesce(F.sum(f"d{k}"), F.lit(0.0)).alias(f"g{k}") for k in range(width)]).first()
    whole = sum(overall)
    top = [(g + SMOOTH / width) / (whole + SMOOTH) for g in overall]
    sum_of = lambda prefix: sum((F.coalesce(F.col(f"{prefix}{k}"), F.lit(0.0)) for k in range(width)), F.lit(0.0))
    share = lambda prefix, k, above: (F.coalesce(F.col(f"{prefix}{k}"), F.lit(0.0)) + SMOOTH * above) / (sum_of(prefix) + SMOOTH)
    priors = by_host.join(by_domain, "domain").where(F.col("host").isNotNull())
    priors = priors.select("host", F.array(*[F.log(share("p", k, share("d", k, F.lit(top[k])))) for k in range(width)]).alias("prior"))
    # hosts with more than a HOT-th of the rows, fewer than HOT of them, are broadcast; their rows and those without a host are spread over all tasks of the join with the others
    most = counted.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0] / HOT
    hot = counted.where(F.col("host").isNotNull() & (F.col("n_rows") > most)).select("host").join(priors, "host", "left").collect()
    hot = spark.createDataFrame([(r["host"], r["prior"], True) for r in hot], "host string, hot_prior array<double>, hot boolean")
    spread = F.when(F.col("hot") | F.col("host").isNull(), F.pmod(F.xxhash64("key", F.spark_partition_id()), F.lit(1 << 20))).otherwise(-1)
    placed = seen.join(F.broadcast(hot), "host", "left").withColumn("spread", spread).withColumn("own", F.when(F.col("spread") < 0, F.col("host")).otherwise(""))
    rest = priors.select(F.col("host").alias("own"), F.lit(-1).cast("long").alias("spread"), "prior")
    fused = placed.join(rest, ["own", "spread"], "left").withColumn("prior", F.coalesce("hot_prior", "prior", F.array(*[F.log(F.lit(t)) for t in top])))
    total = F.array(*[F.get("logs", F.lit(k)) + F.get("prior", F.lit(k)) + F.when(F.col("declared") == language, DECLARED).otherwise(0.0) + F.when(F.col("address") == language, ADDRESS).otherwise(0.0) for k, language in enumerate(languages)])
    fused = fused.withColumn("p", total).withColumn("p", posterior(F.col("p")))
    best = F.array_max("p")
    known = (F.col("n_features") > 0) | F.col("declared").isNotNull() | F.col("address").isNotNull()
    return fused.select("key", F.get(F.array(*map(F.lit, languages)), F.array_position("p", best).cast("int") - 1).alias("language"), best.alias("posterior"), "n_features", (known & (best >= least)).alias("kept"))


def document_evidence(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Documents carry their source as host, and neither markup nor address."""
    nothing = F.lit(None).cast("string")
    return docs.select(F.col(id_column).alias("key"), "text", F.col("source").alias("host"), nothing.alias("declared"), nothing.alias("address"))


def page_evidence(pages: DataFrame, languages: list[str]) -> DataFrame:
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    host = F.regexp_extract(url, r"^[a-z]+://([^/:?#]+)", 1)
    return pages.select(F.col("page_id").alias("key"), visible_text(html).alias("text"), F.when(host != "", host).alias("host"), markup_language(html, languages).alias("declared"), address_language(url, languages).alias("address"))


def keep(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows whose language is clear, with their own columns, from columns text, source and lang. Rows of one id share its best answer; rows without an id share one if text and source are equal."""
    model = fit(docs, id_column=id_column)
    rows = numbered(docs)
    at, text, source = (F.col(place(docs, c)) for c in (id_column, "text", "source"))
    own = F.sha2(F.to_json(F.struct(text.alias("t"), source.alias("s"))), 256)
    rows = rows.withColumn("_key", F.when(at.isNull(), F.concat(F.lit("="), own)).otherwise(F.concat(F.lit("#"), at.cast("string"))))
    seen = document_evidence(rows.select("_key", text.alias("text"), source.alias("source")), "_key")
    gone = identify(seen, model).groupBy("key").agg(F.max("kept").alias("k")).where(~F.col("k")).select(F.col("key").alias("_gone"))
    return rows.join(gone, F.col("_key") == F.col("_gone"), "left_anti").drop("_key").toDF(*docs.columns)
