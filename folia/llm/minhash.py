"""Operator 2: near-duplicates by one-permutation MinHash.

A document's set of five-word shingles is hashed once; the smallest hash in
each of 256 bins is its signature, empty bins filled by optimal densification
(each empty bin tries bins in an order of its own until one holds a value).
Documents with equal sets are one class. Classes that agree on a band of the
signature share a bucket; each bucket links its members to one centre only, the member
whose buckets are the fullest, so the number of candidate pairs stays linear.
Candidates are confirmed on full sets, and components found by star
contraction. In buckets that still hold several components, members of
different components are compared in blocks by whole signatures and then by
the smallest hashes of their sets (two sets of up to FEW shingles: exactly, and
whatever their signatures are, which stray too far on small sets): first
each one's few likeliest partners are confirmed, then, if some had more, all
of them, so that no link depends on the choice of centres.

Null or empty text: empty set, own component. Null id: linked with nothing,
component null, kept. Rows with one id are one document. Fewer than five
words: the whole sequence is one shingle. A table without rows gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.common import dropped, numbered, place, slices, text_buffers, written
from folia.llm.hashing import mix, sequences, word_hashes

WORDS, BINS, ROWS = 5, 256, 5
BANDS = BINS // ROWS
#: Percent of similarity that links, and share of equal signature bytes below which a pair can't be linked: more than five standard deviations off where a set is larger than FEW; pairs of smaller sets aren't held to it.
LINK, LEAST_EQUAL = 75, 0.61
#: Tries of the densification before an empty bin takes the next full one; classes in a block of a bucket's comparison.
TRIES, BLOCK = 96, 512
#: Partners that a member names in each bucket at first.
PARTNERS = 8
#: So many of the smallest hashes stand for a larger set, and share of them in common below which a pair can't be linked (more than five standard deviations off).
FEW, LEAST_COMMON = 256, 0.61
SLICE_BYTES = 1 << 20

_TRY = (mix(np.arange(BINS * TRIES, dtype=np.uint64) + np.uint64(77)) % np.uint64(BINS)).astype(np.int64).reshape(BINS, TRIES)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, owner = word_hashes(data, offsets)
    n = len(offsets) - 1
    bounds = np.searchsorted(owner, np.arange(n + 1))
    grams = sequences(words, WORDS)
    out = []
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if j - i >= WORDS:
            s = np.sort(grams[i : j - WORDS + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif j > i:
            out.append(sequences(words[i:j], j - i))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One-permutation signatures with optimal densification; every set has at least one element."""
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    bins = (values >> np.uint64(56)).astype(np.int64)
    first = np.concatenate([[True], (row[1:] != row[:-1]) | (bins[1:] != bins[:-1])])  # sets are sorted: the first of a bin is its minimum
    out, full = np.zeros((len(sets), BINS), np.uint64), np.zeros((len(sets), BINS), bool)
    out[row[first], bins[first]] = values[first]
    full[row[first], bins[first]] = True
    r, b = np.nonzero(~full)
    for t in range(TRIES):
        if not len(r):
            break
        source = _TRY[b, t]
        hit = full[r, source]
        out[r[hit], b[hit]] = out[r[hit], source[hit]]
        r, b = r[~hit], b[~hit]
    for i, k in zip(r.tolist(), b.tolist()):
        known = np.flatnonzero(full[i])
        out[i, k] = out[i, known[np.searchsorted(known, k) % len(known)]]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(signature), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = mix(keys * np.uint64(0xD1342543DE82EF95) + signature[:, k : BANDS * ROWS : ROWS])
    return keys


def sketches(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id, set size, set digest, one byte of each signature value, and the band keys; nulls for empty sets."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for i, j in slices(offsets, SLICE_BYTES):
                sets = shingle_sets(data, offsets[i : j + 1])
                some = [k for k, s in enumerate(sets) if len(s)]
                digest, low, keys = [None] * (j - i), [None] * (j - i), [None] * (j - i)
                if some:
                    signature = signatures([sets[k] for k in some])
                    bands = band_keys(signature).view(np.int64)
                    for k, own, key in zip(some, (signature & np.uint64(255)).astype(np.uint8), bands, strict=True):
                        digest[k], low[k], keys[k] = xxhash.xxh3_128_digest(sets[k].tobytes()), own.tobytes(), key
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(low, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "digest", "low", "keys"])

    return docs.select(F.col(id_column).cast("long").alias("id"), text_column).mapInArrow(run, "id long, n long, digest binary, low binary, keys array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """(id, few, set) for rows (id, text); few has the upper halves of the FEW smallest hashes."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for i, j in slices(offsets, SLICE_BYTES):
                sets = shingle_sets(data, offsets[i : j + 1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([(s[:FEW] >> np.uint64(32)).astype(np.uint32).tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "few", "set"])

    return docs.select("id", "text").mapInArrow(run, "id long, few binary, set binary")


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) whose sizes and signatures allow a link."""
    own = nodes.select("rep", "n", "low")
    both = pairs.join(own.toDF("a", "na", "la"), "a").join(own.toDF("b", "nb", "lb"), "b")
    both = both.where((100 * F.least("na", "nb") >= LINK * F.greatest("na", "nb"))).select("a", "b", "la", "lb", (F.greatest("na", "nb") <= FEW).alias("small"))

    def run(batches):
        for batch in batches:
            la, lb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BINS) for k in (2, 3))
            keep = ((la == lb).sum(axis=1) >= LEAST_EQUAL * BINS) | batch.column(4).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are linked by their full sets."""
    sets = sets.select("id", "set")
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= LINK * (len(x) + len(y) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(v, component) for every vertex of the edges (a, b): large-star and small-star steps in turn until every vertex points at its smallest."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = both.where(F.col("v") < F.col("u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        around = both.join(least, "u")
        if large:
            return around.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        return around.select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()

    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v")).distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        after = written(star(star(now, True), False), "edges")
        state = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 998_244_353)).first()
        dropped(now)
        now = after
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return now.groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("component"))


def common_share(own: np.ndarray, size: int, others: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarity of one set to others by their FEW smallest hashes, and whether it allows a link. Of two sets within FEW nothing is left out; else the hashes up to the smaller of the last ones are a sample of the union."""
    every, lengths = np.concatenate(others), np.array([len(o) for o in others])
    starts = np.cumsum(lengths) - lengths
    top = np.where(sizes > FEW, every[starts + lengths - 1], np.uint32(0xFFFFFFFF))
    if size > FEW:
        top = np.minimum(top, own[-1])
    inside = every <= np.repeat(top, lengths)
    hit = inside & (own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every)
    common = np.add.reduceat(hit, starts, dtype=np.int64)
    union = np.searchsorted(own, top, "right") + np.add.reduceat(inside, starts, dtype=np.int64) - common
    whole = (sizes <= FEW) & (size <= FEW)
    return common / union, np.where(whole, 100 * common >= LINK * union, common >= LEAST_COMMON * union)


def across(members: DataFrame, most: int | None) -> DataFrame:
    """Pairs (a, b, cut) of one bucket and different components that signatures allow, from rows (key, m, rep, component, n, low, keys, few); m is the bucket's size.

    A bucket is cut into blocks of about BLOCK classes, and each two blocks meet in a task of their own; only pairs that pass leave it, with `most` only each member's likeliest partners, and cut tells that it had more. A pair leaves only the bucket of the first band that it shares."""
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    own = own.select("*", other).select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "component", "n", "low", "keys", "few")

    def compare(key, group):
        bucket, i, j = (x.as_py() for x in key)
        block, rep, component, n = (group.column(c).to_numpy() for c in ("block", "rep", "component", "n"))
        low = np.frombuffer(b"".join(group.column("low").to_pylist()), np.uint8).reshape(-1, BINS)
        keys = np.array(group.column("keys").to_pylist(), np.int64)
        few = [np.frombuffer(x, np.uint32) for x in group.column("few").to_pylist()]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        a, b, cut = [], [], []
        for x in left.tolist():
            y = right[component[right] != component[x]]
            if i == j:
                y = y[y > x]
            y = y[(100 * np.minimum(n[y], n[x]) >= LINK * np.maximum(n[y], n[x]))]
            y = y[((low[y] == low[x]).sum(axis=1) >= LEAST_EQUAL * BINS) | ((n[y] <= FEW) & (n[x] <= FEW))]
            if len(y):
                y = y[keys[x][(keys[y] == keys[x]).argmax(axis=1)] == bucket]
            if not len(y):
                continue
            share, allowed = common_share(few[x], n[x], [few[k] for k in y.tolist()], n[y])
            y, share = y[allowed], share[allowed]
            more = most is not None and len(y) > most
            if more:
                y = y[np.lexsort((rep[y], -share))[:most]]
            a += [rep[x]] * len(y)
            b += rep[y].tolist()
            cut += [more] * len(y)
        return pa.table({"a": pa.array(np.minimum(a, b).astype(np.int64)), "b": pa.array(np.maximum(a, b).astype(np.int64)), "cut": pa.array(cut, pa.bool_())})

    return own.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long, cut boolean")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each row: id, n_shingles, component_id, kept."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    sketched = written(sketches(rows, "id", "text"), "sketches")
    known = sketched.where(F.col("id").isNotNull() & (F.col("n") > 0))
    nodes = written(known.groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("low").alias("low"), F.first("keys").alias("keys")), "nodes")
    banded = nodes.select("rep", F.explode("keys").alias("key"))
    full = banded.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    buckets = written(banded.join(full, "key"), "buckets")
    weight = buckets.groupBy("rep").agg(F.sum(F.log2("m")).alias("weight"))
    centre = buckets.join(weight, "rep").groupBy("key").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("c"))
    star = buckets.join(centre, "key").where(F.col("rep") != F.col("c"))
    star = star.select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b")).distinct()
    candidates = written(likely(star, nodes), "candidates")

    wanted = buckets.select(F.col("rep").alias("id")).distinct()
    # the same join at any size, so that its shuffle grows as the input does; rows of one id meet here and are merged
    texts = rows.join(wanted.hint("merge"), "id").dropDuplicates(["id", "text"])
    sets = written(full_sets(texts), "sets")
    tried, links = candidates, written(confirmed(candidates, sets), "links")
    parts = written(components(links), "parts")
    sketched_sets = nodes.select("rep", "n", "low", "keys").join(sets.select(F.col("id").alias("rep"), "few"), "rep")
    for most in (PARTNERS, None):
        placed = buckets.join(parts.withColumnRenamed("vertex", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
        rest = placed.join(mixed, "key").join(sketched_sets, "rep")
        found = written(across(rest, most), "more")
        more = written(found.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "more")
        if not more.isEmpty():
            tried = tried.unionByName(more)
            links = written(links.unionByName(confirmed(more, sets)), "links")
            parts = written(components(links), "parts")
        if found.where("cut").isEmpty():
            break
    dropped(sets)
    by_digest = nodes.join(parts.withColumnRenamed("vertex", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    found = sketched.select("id", "n", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest")).join(by_digest, "digest", "left")
    component = F.coalesce("component", "id")
    return found.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each document that stands for its component, with its own columns; of several rows with one id the one with the smallest text. Rows without an id stay."""
    rows, at, text = numbered(docs), place(docs, id_column), place(docs, text_column)
    seen = near_duplicates(rows, at, text).select(F.col(at).alias("_id"), "kept").where(F.col("_id").isNotNull())
    known = written(seen.groupBy("_id").agg(F.count(F.lit(1)).alias("_rows"), F.min("kept").alias("_kept")).where("_rows > 1 or not _kept"), "verdicts")
    same = F.col(at) == F.col("_id")
    single = rows.join(known, same, "left_anti")
    several = rows.join(known.where("_kept"), same).groupBy("_id").agg(F.min_by(F.struct(*rows.columns), F.coalesce(text, F.lit(""))).alias("_row"))
    return single.unionByName(several.select("_row.*")).toDF(*docs.columns)
