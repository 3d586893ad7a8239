"""corpus_pipeline.run() and each of its stages against brute force, on a small table with nulls, empty and long texts, copies, repeated rows and clashing columns."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folia.llm import language_id, quality_rules, vocabulary
from folia.llm.token_count import tokenizer
from tests.llm.test_llm import brute_components

CLASHES = ["id", "key", "kept", "rep", "n", "score", "component", "_id", "_key", "_words"]


def quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, grams = len(words), defaultdict(list)
    for i in range(n - 4):
        grams[tuple(words[i : i + 5])].append(i)
    covered = {i + k for places in grams.values() if len(places) > 1 for i in places for k in range(5)}
    if n < 10 or 100 * len(covered) > 20 * n:
        return False
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    stop = {f for w in quality_rules.STOP_WORDS.values() for x in w for f in (x, x.capitalize())}
    chars = sum(map(len, words))
    facts = {
        "mean_word_chars": chars / n, "symbol_ratio": sum(text.count(c) for c in "#*$%&|<>") / n, "stop_word_ratio": sum(w in stop for w in words) / n,
        "dup_line_ratio": (len(lines) - len(set(lines))) / len(lines), "bullet_line_ratio": sum(line.lstrip(" ")[0] in "-*•" for line in lines) / len(lines),
        "upper_ratio": sum(c.isupper() for c in text) / chars,
    }
    return all((low is None or facts[m] >= low) and (high is None or facts[m] <= high) for _, m, low, high in quality_rules.THRESHOLDS)


def clear_language(rows, model):
    """Ids (or texts, where there is no id) whose fused posterior reaches the least one."""
    width, seen = len(model.languages), []
    for r in rows:
        logs, n = model.evidence(r.text or "", language_id.Cache(10_000))
        seen.append((r, logs, n))
    share = lambda logs: np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
    hosts, domains, whole = defaultdict(lambda: np.zeros(width)), defaultdict(lambda: np.zeros(width)), np.zeros(width)
    for r, logs, n in seen:
        if n:
            hosts[r.source] += share(logs)
            whole += share(logs)
            domains[".".join(r.source.split(".")[-2:]) if r.source else None] += share(logs)
    s = language_id.SMOOTH
    top = (whole + s / width) / (whole.sum() + s)
    clear = set()
    for r, logs, n in seen:
        prior = top
        if r.source is not None and r.source in hosts:
            d, h = domains[".".join(r.source.split(".")[-2:])], hosts[r.source]
            prior = (h + s * (d + s * top) / (d.sum() + s)) / (h.sum() + s)
        if n and share(logs + np.log(prior)).max() >= language_id.LEAST:
            clear.add(r.doc_id if r.doc_id is not None else r.text)
    return clear


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(60)
    own = docs.schema
    taken = docs.collect()
    more = [(1001, taken[0].text, "en", taken[0].source, 1), (1002, taken[1].text, "en", "s", 1), (1002, taken[1].text, "en", "s", 1), (1003, None, None, None, None), (1004, "", "en", None, 0), (1005, "\n \t", "en", "s", 3), (None, taken[2].text, "en", "s", 9), (None, taken[2].text, "en", "s", 9), (None, None, None, None, None), (1006, " ".join(f"the of w{k} and x{k * 7}" for k in range(6000)), "en", "s", 9), (1007, "one two", None, "s", 7)]
    frame = docs.unionByName(spark.createDataFrame(more, own))
    for k, name in enumerate(CLASHES):
        frame = frame.withColumn(name, F.lit(f"own {k}"))
    at = str(tmp_path_factory.mktemp("tables"))
    frame.repartition(3).write.parquet(f"{at}/documents.parquet")
    frame.limit(0).write.parquet(f"{at}/none/documents.parquet")
    return at


def keys(rows):
    return Counter((r.doc_id, r.text) for r in rows)


def test_stages_and_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = docs.collect()
    good = stages["quality_rules"](spark, docs, folder)
    assert good.columns == docs.columns
    want = [r for r in rows if quality(r.text)]
    assert keys(good.collect()) == keys(want) and 0 < len(want) < len(rows)
    good = good.cache()
    told = stages["language_id"](spark, good, folder)
    assert told.columns == docs.columns
    clear = clear_language(want, language_id.fit(good))
    want = [r for r in want if (r.doc_id if r.doc_id is not None else r.text) in clear]
    assert keys(told.collect()) == keys(want)
    told = told.cache()
    single = stages["minhash_near_dedup"](spark, told, folder)
    assert single.columns == docs.columns
    texts = {r.doc_id: r.text for r in want if r.doc_id is not None}
    parts = brute_components(texts)
    want = [r for r in {k: r for k, r in ((r.doc_id, r) for r in want) if k is not None and parts[k][1] == k}.values()] + [r for r in want if r.doc_id is None]
    got = single.collect()
    assert keys(got) == keys(want) and all(r._words == "own 9" and r.kept == "own 2" for r in got)
    lib = tokenizer(vocabulary.path(vocabulary.WORD_BPE))
    pieces = Counter()
    for r in want:
        ids = [*lib.encode(r.text, add_special_tokens=False).ids, 0]
        pieces.update((r.doc_id, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())) for k in range(0, len(ids), 2048))
    out = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == pieces
    used = defaultdict(int)
    for r in out:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) >= math.ceil(sum(used.values()) / 2048)


def test_empty_table(spark, folder):
    none = spark.read.parquet(f"{folder}/none/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, none, folder)
        assert got.columns == none.columns and got.count() == 0, name
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0
