"""Operator 4: an interpolated modified Kneser-Ney model of word bigrams.

Counted in Spark: each task merges its own bigrams first and sends them as
packed columns to shards by hash, so a frequent context is spread over all
shards; shards send what they know of contexts and continuations to shards by
word. Each shard becomes sorted hash arrays in the shared folder, which
scoring tasks map into memory and search with sorted queries.

Tokens are the words of a text with A-Z lowered and one end; the first word
follows a start mark. Null or empty text: the end alone. With no training rows
every probability is that of one unseen word. Repeated rows are each counted.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections import OrderedDict
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.common import dropped, new_path, slices, text_buffers, written
from folia.llm.hashing import mix, word_hashes

#: Marks that no word's hash can be mistaken for but by chance.
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: Least number of shards; tokens merged in a task before they are sent; bytes of text handled at once; bits of a word's hash inside a bigram.
SHARDS, FLUSH, SLICE_BYTES, SHORT = 64, 4_000_000, 1 << 20, 40
#: Shard files a scoring worker keeps mapped.
MOST_MAPS = 1024
WORD_COLUMNS = ("hash", "count", "continuations", "total", "ones", "twos", "more")


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of each text with its end, and each text's number of tokens."""
    words, owner = word_hashes(data, offsets)
    n = np.bincount(owner, minlength=len(offsets) - 1) + 1
    out = np.empty(len(words) + len(n), np.uint64)
    ends = np.cumsum(n) - 1
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[ends], out[inside] = END, words
    return out, n


def before(tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The token before each one."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.cumsum(n) - n] = START
    return out


def short(h: np.ndarray) -> np.ndarray:
    return h >> np.uint64(64 - SHORT)


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A bigram's hash from its words' short hashes."""
    return mix(v * np.uint64(0x9E3779B97F4A7C15) + mix(w))


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as byte planes, compressed: sorted hashes cost little more than their lower bytes."""
    planes = [np.ascontiguousarray(np.ascontiguousarray(c, "<u8").view(np.uint8).reshape(-1, 8).T) for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(planes).tobytes())


def unpacked(blob: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u8")[:, :, 0]


def summed(keys: list[np.ndarray], *values: np.ndarray) -> list[np.ndarray]:
    """Rows with equal keys merged, values added up; keys come out sorted."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    if not len(order):
        return [*keys, *values]
    first = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
    at = np.flatnonzero(first)
    return [*(k[first] for k in keys), *(np.add.reduceat(v[order], at) for v in values)]


def by_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash, so that shards in order are one sorted array; shards is a power of two."""
    return (hashes >> np.uint64(64 - shards.bit_length() + 1)).astype(np.int64) if shards > 1 else np.zeros(len(hashes), np.int64)


def sent(kind: str, key: np.ndarray, columns: list[np.ndarray], shards: int):
    """A batch with a packed row for each shard that gets something."""
    shard = by_shard(key, shards).astype(np.uint16 if shards <= 1 << 16 else np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])
    rows = [(s, packed(*(c[order[i:j]] for c in columns))) for s, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if j > i]
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(rows)), pa.array([s for s, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["kind", "shard", "blob"])


def local(uri: str) -> str:
    """The mounted place of the shared folder; models are memory-mapped, so it must be a mounted one."""
    at = urlparse(uri)
    if at.scheme not in ("", "file"):
        raise ValueError(f"the model is memory-mapped: spark.checkpoint.dir must be a mounted folder, not {at.scheme}:")
    return unquote(at.path)


def save(folder: str, name: str, hashes: np.ndarray, columns: list[np.ndarray]) -> None:
    """One file: the number of rows, the sorted hashes, each column. Written under another name first, so that a task that runs twice does no harm."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write(np.uint64(len(hashes)).tobytes())
        f.write(hashes.astype("<u8").data)
        for c in columns:
            f.write(c.astype("<u4").data)
    os.replace(part, f"{folder}/{name}")


class Model:
    """Maps the files and gives log probabilities. A file that the model has but the worker can't see raises."""

    def __init__(self, folder: str, facts: dict):
        self.folder, self.facts = folder, facts
        self.maps: OrderedDict[str, list[np.ndarray]] = OrderedDict()
        self.shards = {table: frozenset(facts[f"{table}_shards"].tolist()) for table in ("words", "pairs")}

    def arrays(self, table: str, shard: int, columns: int) -> list[np.ndarray] | None:
        """Hashes and columns of a shard; None where the model has no row in it."""
        if shard not in self.shards[table]:
            return None
        name = f"{table}-{shard}"
        if name not in self.maps:
            raw = np.memmap(f"{self.folder}/{name}", np.uint8, "r")
            n = int(raw[:8].view("<u8")[0])
            self.maps[name] = [raw[8 : 8 + 8 * n].view("<u8"), *(raw[8 + (8 + 4 * c) * n : 8 + (12 + 4 * c) * n].view("<u4") for c in range(columns))]
            if len(self.maps) > MOST_MAPS:
                self.maps.popitem(last=False)
        self.maps.move_to_end(name)
        return self.maps[name]

    def looked_up(self, table: str, key: np.ndarray, columns: int) -> np.ndarray:
        """The columns beside sorted distinct keys, 0 where a key is unknown."""
        out = np.zeros((columns, len(key)), np.int64)
        shards = self.facts["shards"]
        cuts = np.searchsorted(by_shard(key, shards), np.arange(shards + 1))
        for s, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if j > i and (found := self.arrays(table, s, columns)) is not None:
                hashes = found[0]
                at = np.minimum(np.searchsorted(hashes, key[i:j]), len(hashes) - 1)
                hit = np.asarray(hashes[at]) == key[i:j]
                for c in range(columns):
                    out[c, i:j][hit] = found[1 + c][at[hit]]
        return out

    def logs(self, tokens: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each token's log10 probability, its base log10, and whether it is known."""
        f = self.facts
        previous = before(tokens, n)
        words, at = np.unique(np.concatenate([tokens, previous]), return_inverse=True)
        own, ahead = at[: len(tokens)], at[len(tokens) :]
        count, continuations, total, ones, twos, more = self.looked_up("words", words, 6)
        base = np.log10((count + 0.5) / (f["tokens"] + 0.5 * (f["distinct"] + 1)))
        d, e = f["discounts"], f["continuation_discounts"]
        left = max(1, f["continuations"])
        unseen = (e[1] * f["continued"][1] + e[2] * f["continued"][2] + e[3] * f["continued"][3]) / left if f["continuations"] else 1.0
        lower = np.maximum(0, continuations - e[np.minimum(continuations, 3)]) / left + unseen / (f["distinct"] + 1)
        pairs, where = np.unique(pair_key(short(tokens), short(previous)), return_inverse=True)
        (c,) = self.looked_up("pairs", pairs, 1)
        c = c[where]
        t = total[ahead]
        spare = np.where(t > 0, (d[1] * ones[ahead] + d[2] * twos[ahead] + d[3] * more[ahead]) / np.maximum(t, 1), 1.0)
        higher = np.where(t > 0, np.maximum(0, c - d[np.minimum(c, 3)]) / np.maximum(t, 1), 0.0)
        return np.log10(higher + spare * lower[own]), base[own], (count > 0)[own]


@functools.lru_cache(2)
def opened(folder: str, facts: tuple) -> Model:
    return Model(folder, {k: np.array(v, np.int64 if k.endswith("_shards") else None) if isinstance(v, tuple) else v for k, v in facts})


def discounts(t: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more, from how many have count 1 to 4; clipped to 0 .. count where few are known."""
    y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else 0.0
    out = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * t[k + 1] / t[k] if t[k] else float(k) / 2
        out.append(min(float(k), max(0.1, d)))
    return out


def fit(docs: DataFrame, text_column: str = "text", shards: int | None = None) -> tuple[str, dict]:
    """Counts all rows; returns the model's folder and facts."""
    spark = docs.sparkSession
    docs = docs.select(text_column)
    if shards is None:
        shards = 1 << max(SHARDS - 1, docs.rdd.getNumPartitions() - 1).bit_length()
    folder = local(new_path(spark, "ngrams"))

    def count(batches):
        words: list[tuple[np.ndarray, np.ndarray]] = []
        high: list[np.ndarray] = []
        low: list[np.ndarray] = []

        def pairs():
            """The bigrams held, merged. They are sorted by all but the last bits of the second word: where these differ, a bigram may come twice, and its shard merges it."""
            k, rest = np.concatenate(high), np.concatenate(low)
            high.clear()
            low.clear()
            order = np.argsort(k)
            k, rest = k[order], rest[order]
            del order
            at = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (rest[1:] != rest[:-1])]))
            c = np.diff(np.append(at, len(k)))
            k, rest = k[at], rest[at]
            v, w = k >> np.uint64(24), (k & np.uint64(0xFFFFFF)) << np.uint64(16) | rest
            return sent("pairs", pair_key(w, v), [v, w, c], shards)

        def flush():
            yield pairs()
            w, c = (np.concatenate(x) for x in zip(*words))
            words.clear()
            w, c = summed([w], c)
            yield sent("words", w, [w, c], shards)

        held = 0
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for i, j in slices(offsets, SLICE_BYTES):
                tokens, n = tokens_of(data, offsets[i : j + 1])
                words.append(np.unique(tokens, return_counts=True))
                second = short(tokens)
                high.append(short(before(tokens, n)) << np.uint64(24) | second >> np.uint64(16))
                low.append(second.astype(np.uint16))
                held += len(tokens)
                if held >= FLUSH:
                    yield from flush()
                    held = 0
        if held:
            yield from flush()

    def merge(group):
        """What one shard knows of its bigrams, or its words merged."""
        shard = group.column("shard")[0].as_py()
        if group.column("kind")[0].as_py() == "words":
            w, c = np.concatenate([unpacked(b.as_py(), 2) for b in group.column("blob")], axis=1)
            w, c = summed([w], c)
            return pa.Table.from_batches([sent("words", w, [w, c], shards)])
        v, w, c = np.concatenate([unpacked(b.as_py(), 3) for b in group.column("blob")], axis=1)
        v, w, c = summed([v, w], c)
        key = pair_key(w, v)
        order = np.argsort(key)
        save(folder, f"pairs-{shard}", key[order], [c[order]])
        at = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        c = c.astype(np.int64)
        sums = [np.add.reduceat(x.astype(np.int64), at) for x in (c, c == 1, c == 2, c > 2)]
        word, times = np.unique(w, return_counts=True)
        up = np.uint64(64 - SHORT)
        facts = pa.RecordBatch.from_arrays([pa.array(["facts"]), pa.array([shard], pa.int32()), pa.array([packed(np.bincount(np.minimum(c, 5), minlength=6))], pa.binary())], names=["kind", "shard", "blob"])
        return pa.Table.from_batches([sent("contexts", v[at] << up, [v[at], *sums], shards), sent("continuations", word << up, [word, times], shards), facts])

    blobs = "kind string, shard int, blob binary"
    passed = written(docs.mapInArrow(count, blobs).groupBy("kind", "shard").applyInArrow(merge, blobs), "passed")

    def merge_words(group):
        shard = group.column("shard")[0].as_py()
        blobs: dict[str, list[bytes]] = {"words": [], "contexts": [], "continuations": []}
        for kind, blob in zip(group.column("kind"), group.column("blob"), strict=True):
            blobs[kind.as_py()].append(blob.as_py())
        gather = lambda kind, n: np.concatenate([np.zeros((n, 0), np.uint64), *(unpacked(b, n) for b in blobs[kind])], axis=1)
        h, c = gather("words", 2)
        h, c = summed([h], c)
        v, *sums = gather("contexts", 5)
        v, *sums = summed([v], *sums)
        w, times = gather("continuations", 2)
        w, times = summed([w], times)
        hashes = np.union1d(h, START.reshape(1)) if len(v) and short(START.reshape(1))[0] in v else h
        columns = np.zeros((6, len(hashes)), np.int64)
        columns[0, np.searchsorted(hashes, h)] = c
        tops = short(hashes)
        for k, (own, values) in enumerate([(w, times), *((v, s) for s in sums)]):
            at = np.minimum(np.searchsorted(own, tops), max(0, len(own) - 1))
            if len(own):
                columns[1 + k] = np.where(own[at] == tops, values[at].astype(np.int64), 0)
        save(folder, f"words-{shard}", hashes, list(columns))
        counts = np.concatenate([[shard, c.sum(), len(h), columns[1].sum()], np.bincount(np.minimum(columns[1], 5), minlength=6)])
        return pa.table({"facts": pa.array([counts.astype(np.int64).tolist()], pa.list_(pa.int64()))})

    by_words = [r["facts"] for r in passed.where("kind <> 'facts'").groupBy("shard").applyInArrow(merge_words, "facts array<long>").collect()]  # a row for each shard
    by_pairs = passed.where("kind = 'facts'").select("shard", "blob").collect()  # a row for each shard
    totals = np.sum([f[1:] for f in by_words] or [[0] * 9], axis=0).tolist()
    bigram = np.sum([unpacked(bytes(r["blob"]), 1)[0] for r in by_pairs] or [[0] * 6], axis=0).tolist()
    dropped(passed)
    continued = totals[3:]
    return folder, {
        "shards": shards, "tokens": int(totals[0]), "distinct": int(totals[1]), "continuations": int(totals[2]), "continued": (0, continued[1], continued[2], sum(continued[3:])),
        "discounts": tuple(discounts([int(x) for x in bigram])), "continuation_discounts": tuple(discounts(continued)),
        "words_shards": tuple(sorted(f[0] for f in by_words)), "pairs_shards": tuple(sorted(r["shard"] for r in by_pairs)),
    }


def score(docs: DataFrame, folder: str, facts: dict, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """n_tokens, n_known, base_score, score (log10 probabilities of the whole text) and perplexity."""
    docs = docs.select(id_column, text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    frozen = tuple(sorted(facts.items()))

    def run(batches):
        model = opened(folder, frozen)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for i, j in slices(offsets, SLICE_BYTES):
                tokens, n = tokens_of(data, offsets[i : j + 1])
                logs, base, known = model.logs(tokens, n)
                at = np.cumsum(n) - n
                total = np.add.reduceat(logs, at)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(np.add.reduceat(known.astype(np.int64), at)), pa.array(np.add.reduceat(base, at)), pa.array(total), pa.array(10 ** (-total / n))], names=[id_column, "n_tokens", "n_known", "base_score", "score", "perplexity"])

    return docs.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, n_known long, base_score double, score double, perplexity double")
