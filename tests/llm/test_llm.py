"""Each operator of folia.llm against the library, a brute-force version or a round trip, on small tables with nulls, blanks, ties and repeats."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from folia.llm import byte_bpe, language_id, minhash, ngram_model, ordinal_quality, packing, quality_rules, spot_signatures, token_count, toxicity, vocabulary, word_bpe

DATA = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "one", "It's we'll 'x '' !!", "é日本 ²½ ß", "a" * 5000, "x<|endoftext|>y", "the cat " * 40, "the cat " * 40]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(k, t, "en", "s", "z") for k, t in enumerate(ODD)], "doc_id long, text string, lang string, source string, score string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_byte_bpe(odd):
    own = tiktoken.Encoding("own", pat_str=vocabulary.PATTERN, mergeable_ranks=vocabulary.ranks(vocabulary.path(vocabulary.BYTE_RANKS)), special_tokens={})
    for r in byte_bpe.encode(odd).collect():
        text = ODD[r.doc_id] or ""
        ids = own.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(odd, with_ids=True)).collect()
    assert all(bytes(r.decoded).decode() == (ODD[r.doc_id] or "") for r in back)


def test_token_counts(odd):
    lib = token_count.tokenizer(vocabulary.path(vocabulary.WORD_BPE))
    for r in token_count.count_tokens(odd, limit=10).collect():
        text = ODD[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(lib.encode(text, add_special_tokens=False).ids))
        assert r.over_limit == (r.n_tokens > 10)


def test_packing(odd, spark):
    lib = token_count.tokenizer(vocabulary.path(vocabulary.WORD_BPE))
    rows = packing.pack(odd, capacity=64).collect()
    ids = {k: [*lib.encode(t or "", add_special_tokens=False).ids, 0] for k, t in enumerate(ODD)}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert Counter(r.doc_id for r in rows) == Counter({k: -(-len(v) // 64) for k, v in ids.items()})
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(odd.limit(0)).count() == 0


def test_word_memo_is_bounded_and_given_back(spark):
    file = vocabulary.path(vocabulary.WORD_BPE)
    lib = token_count.tokenizer(file)
    texts = [" ".join(f"w{k}x{i}" for i in range(50)) + " the same words, don't!" for k in range(12)]
    want = [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    coder = word_bpe.WordIds(file, most=100)
    for t, ids in zip(texts, want, strict=True):
        assert coder.packed([t]) == [ids] and len(coder.known) + len(coder.before) <= 3 * 60
    coder.forget()
    assert not coder.known and not coder.before and not coder.pieces and coder.packed(texts) == want
    coder = word_bpe.WordIds(file)
    for k in range(10):
        coder.packed([" ".join(f"{k}q{i}" for i in range(60_000))])
    assert len(coder.known) + len(coder.before) <= 400_000

    def left(batches):
        for batch in batches:
            coder = word_bpe.word_ids(file)
            yield pa.RecordBatch.from_arrays([pa.array([len(coder.known) + len(coder.before) + len(coder.pieces)] * len(batch))], names=["n"])

    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    assert packing.pack(docs).count() == len(texts)
    assert {r.n for r in spark.range(0, 16, 1, 8).mapInArrow(left, "n long").collect()} == {0}


def brute_components(texts: dict) -> dict:
    sets = {}
    for k, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {k: k for k in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {k: (len(sets[k]), top(k)) for k in sets}


def test_near_duplicates(odd, docs):
    for frame in (odd, docs):
        want = brute_components({r.doc_id: r.text for r in frame.collect()})
        for r in minhash.near_duplicates(frame).collect():
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)


def test_language_model(odd):
    texts = {k: [*re.findall(r"[^\x20\x09-\x0D]+", t or ""), None] for k, t in enumerate(ODD)}
    folder, facts = ngram_model.fit(odd.where("doc_id < 6 or doc_id > 8"))
    seen = [w for k in texts if k < 6 or k > 8 for w in [x.lower() if x else x for x in texts[k]]]
    counts = Counter(seen)
    assert (facts["tokens"], facts["distinct"]) == (len(seen), len(counts))
    for r in ngram_model.score(odd, folder, facts).collect():
        tokens = [w.translate({c: c + 32 for c in range(65, 91)}) if w else w for w in texts[r.doc_id]]
        base = sum(math.log10((counts[w] + 0.5) / (len(seen) + 0.5 * (len(counts) + 1))) for w in tokens)
        assert r.n_tokens == len(tokens) and r.n_known == sum(counts[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(base) and r.score < 0


def test_quality(odd):
    got = {r.doc_id: r for r in quality_rules.score(odd).collect()}
    assert got[0].n_words == 0 and got[0].base_failed and not got[0].kept
    assert got[9].n_repeat_words == 80 and got[9].n_words == 80
    assert quality_rules.keep(odd).columns == odd.columns


def test_fingerprints(odd):
    rows = sorted(spot_signatures.fingerprints(odd).collect(), key=lambda r: -r.doc_id)
    texts = [ODD[r.doc_id] or "" for r in rows]
    for r, own, after in zip(rows, texts, texts[1:] + texts[:1], strict=True):
        n = len(own)
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256((own[: n - n // 3] + after[: n // 3]).encode()).hexdigest()
    assert rows[0].fingerprint == rows[1].fingerprint and rows[0].near_next == 1.0


def test_similar_against_brute_force(docs):
    sets = {r.doc_id: frozenset(r.s) for r in spot_signatures.with_signatures(docs, "text", "s").select("doc_id", "s").collect()}
    least = {}
    for k in sorted(sets):
        least.setdefault(sets[k], k)
    reps = {v: k for k, v in least.items()}
    want = {(min(a, b), max(a, b)) for a in reps for b in reps if a < b and len(reps[a] & reps[b]) >= 0.75 * len(reps[a] | reps[b])}
    members, pairs = spot_signatures.similar(docs)
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in pairs.collect()} == want
    assert {r.doc_id: r.class_id for r in members.collect()} == {k: least[s] for k, s in sets.items()}


def test_languages(docs):
    model = language_id.fit(docs)
    rows = language_id.identify(language_id.document_evidence(docs), model).join(docs.select(F.col("doc_id").alias("key"), "lang"), "key")
    assert rows.where("language = lang").count() >= 0.98 * rows.count()


def test_language_shares_against_their_definition(spark):
    texts = [("fr", "le chat Été le"), ("en", "the cat the"), ("fr", None), ("en", "le"), (None, "zzz"), ("fr", "x1y"), *((f"l{k}", "mot") for k in range(20))]
    rows = spark.createDataFrame([(k, t, c) for k, (c, t) in enumerate(texts)], "doc_id long, text string, lang string").repartition(2)
    model = language_id.fit(rows)
    assert model.languages == sorted({c for c, _ in texts if c})
    counts = {c: Counter() for c in model.languages}
    for c, t in texts:
        if c and t:
            counts[c].update(b for w in re.findall(r"[^\W\d_]+", t) for b in language_id.buckets_of(w))
    every = sorted(set().union(*counts.values()))
    assert list(model.number) == every
    share = np.array([[math.log((counts[c][b] + 0.5) / (sum(counts[c].values()) + 0.5 * len(every) + 1)) for b in every] for c in model.languages])
    assert np.allclose(model.logs, share - share.mean(axis=0), atol=1e-5)
    logs, n = model.evidence("le chat inconnu", language_id.Cache(2))
    assert n >= 6 and model.languages[int(logs.argmax())] == "fr" and model.evidence("", language_id.Cache(2))[1] == 0
    none = language_id.fit(rows.where("lang is null"))
    assert none.languages == ["und"] and none.evidence("le", language_id.Cache(2))[1] == 0


def test_learnt_operators_hold_out(spark):
    from folia.llm import queries

    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    for name, column, got in (("op3_toxicity", "toxic", "predicted"), ("op8_quality_classifier", "quality", "cast(kept as int)")):
        rows = queries.QUERIES[name](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out")
        assert rows.where(f"{got} = {column}").count() >= 0.93 * rows.count()


def test_common_share():
    rng = np.random.default_rng(5)
    pool = np.sort(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
    for size in (3, 100, minhash.FEW, 3000):
        own = np.sort(rng.choice(pool, size, replace=False))
        others = [own[:: max(1, size // k)] for k in (1, 2, size)] + [np.unique(np.concatenate([rng.permutation(own)[k:], rng.choice(pool, max(1, size // 9))])) for k in (0, 1, size // 8)]
        few = [(o[: minhash.FEW] >> np.uint64(32)).astype(np.uint32) for o in (own, *others)]
        share, allowed = minhash.common_share(few[0], size, few[1:], np.array([len(o) for o in others]))
        for other, got, may in zip(others, share, allowed, strict=True):
            common, union = len(np.intersect1d(own, other)), len(np.union1d(own, other))
            assert may or 100 * common < minhash.LINK * union
            if max(size, len(other)) <= minhash.FEW:
                assert got == pytest.approx(common / union) and may == (100 * common >= minhash.LINK * union)
            else:
                assert got == pytest.approx(common / union, abs=0.16)


def test_small_sets_whose_signatures_disagree(spark):
    rng, texts = np.random.default_rng(3), []
    while len(texts) < 40:
        words = [f"w{k}" for k in rng.integers(0, 10**6, 8)]
        pair = [" ".join(words[:7]), " ".join(words)]
        data = [t.encode() for t in pair]
        sets = minhash.shingle_sets(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        one, two = minhash.signatures(sets)
        keys = minhash.band_keys(np.array([one, two]))
        if ((one ^ two) & np.uint64(255) == 0).mean() < minhash.LEAST_EQUAL and (keys[0] == keys[1]).any():
            texts += pair
    rows = list(enumerate(texts))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(dict(rows))


def test_nearest_against_brute_force(docs):
    texts = sorted({r.text or "" for r in docs.limit(150).collect()})
    labels = [zlib.crc32(t.encode()) % 3 == 0 for t in texts]
    index = toxicity.index_of([t.encode() for t in texts[:100]], labels[:100], list(range(100)), (40, 60))
    number = {i: k for k, i in enumerate(index.ids)}
    plain = {}
    for i in range(100):
        counts = toxicity.counted(texts[i].encode())
        raw = {t: (1 + math.log(n)) * index.weight[index.number[t]] for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in raw.values())) or 1.0
        plain[number[i]] = {t: w / norm for t, w in raw.items()}
    for text in texts[95:]:
        counts = {index.number[t]: n for t, n in toxicity.counted(text.encode()).items() if t in index.number}
        raw = {t: (1 + math.log(n)) * index.weight[t] for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in raw.values())) or 1.0
        own = {list(index.number)[t]: w / norm for t, w in raw.items()}
        want = sorted(((-round(sum(w * v.get(t, 0.0) for t, w in own.items()), 12), k) for k, v in plain.items()))
        want = [(k, -c) for c, k in want if -c >= toxicity.LEAST_COSINE][: toxicity.NEIGHBOURS]
        found, cosines = index.nearest(counts)
        assert found.tolist() == [k for k, _ in want] and cosines == pytest.approx([c for _, c in want])


def test_toxicity_of_odd_tables(odd, spark):
    labels = spark.createDataFrame([(0, 0), (4, 1), (4, 0), (9, 1), (None, 1), (5, None), (77, 1)], "doc_id long, toxic int")
    rows = {r.doc_id: r for r in toxicity.score(odd, toxicity.fit(odd, labels)).collect()}
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows.values())
    assert rows[9].score == rows[10].score and rows[9].neighbours[0] in (9, 10) and rows[0].neighbours == [] and rows[0].score == rows[1].score
    assert {r.score for r in toxicity.score(odd, toxicity.fit(odd, labels.limit(0))).collect()} == {0.0}
    assert toxicity.score(odd.limit(0), None).count() == 0


def test_toxicity_is_calibrated(spark):
    from folia.llm import queries

    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = queries.op3_toxicity(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").select("score", "toxic").collect()
    share = sum(r.toxic for r in rows) / len(rows)
    assert sum((r.score - r.toxic) ** 2 for r in rows) / len(rows) < 0.5 * share * (1 - share)


def test_slices_of_many_bounds(spark):
    bounds = list(range(0, 700, 7))
    rows = spark.range(-5, 720).select("id", spot_signatures.slice_of(F.col("id"), bounds).alias("s")).collect()
    assert all(r.s == sum(b <= r.id for b in bounds) for r in rows)


def test_states_stay_bounded():
    rng = np.random.default_rng(11)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz'"))
    texts = ["".join(rng.choice(letters, 3000)) + " end it's " + "".join(rng.choice(letters, 1500)) for _ in range(3)]
    machine = token_count.Transducer(vocabulary.path(vocabulary.WORD_BPE), most_states=50)
    got = machine.counts(texts)
    assert got.tolist() == [len(machine.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert len(machine.keys) < 300


def test_quality_filter_on_long_texts(odd, spark):
    long = spark.createDataFrame([(50, " ".join(f"the w{k}" for k in range(10_000)), "en", "s", "z"), (51, "the end of it is " * 4000, "en", "s", "z")], odd.schema)
    rows = odd.unionByName(long).unionByName(long)
    verdicts = {r.doc_id: r.kept for r in quality_rules.score(rows).collect()}
    assert verdicts[50] and not verdicts[51]
    assert Counter(r.doc_id for r in quality_rules.keep(rows).collect()) == Counter(k for k in [*verdicts, 50, 51] if verdicts[k])
    assert quality_rules.score(rows).where("kept").count() == quality_rules.keep(rows).count()


def test_ordinal_grades():
    rng = np.random.default_rng(2)
    words = {0: ["aa!!", "bb!!", "cc!!"], 1: ["so", "mid", "way"], 2: ["fine", "prose", "here"]}
    grades = [k % 3 for k in range(150)]
    known = ordinal_quality.Cache(1000)
    bags = [ordinal_quality.bag(" ".join(rng.choice(words[g], 12)).encode(), known) for g in grades]
    model = ordinal_quality.fitted(bags, np.array(grades), np.ones(150), [0, 1, 2])
    assert (np.diff(model.thresholds) > 0).all()
    scores = np.array([model.weights[a] @ v for a, v in bags])
    tails, expected = model.tails(scores), model.expected(scores)
    assert (tails[:, 0] >= tails[:, 1]).all() and (np.rint(expected) == grades).mean() > 0.95


def kneser_ney(sequences):
    """The interpolated modified Kneser-Ney bigram model by its definition; gives the probability of a word after another."""
    start, end = "<start>", "<end>"
    pairs, words = Counter(), Counter()
    for s in sequences:
        before = start
        for w in [*s, end]:
            pairs[before, w] += 1
            words[w] += 1
            before = w
    contexts = {}
    for (v, _), c in pairs.items():
        contexts.setdefault(v, []).append(c)
    continuations = Counter(w for _, w in pairs)

    def discount(counts):
        t = [sum(1 for c in counts if c == k) for k in range(5)]
        y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else 0.0
        return [0.0] + [min(float(k), max(0.1, k - (k + 1) * y * t[k + 1] / t[k] if t[k] else k / 2)) for k in (1, 2, 3)]

    d, e = discount(list(pairs.values())), discount(list(continuations.values()))
    total = sum(continuations.values())
    spare_lower = sum(e[min(c, 3)] for c in continuations.values()) / total

    def p(v, w):
        lower = max(0.0, continuations[w] - e[min(continuations[w], 3)]) / total + spare_lower / (len(words) + 1)
        if v not in contexts:
            return lower
        n = sum(contexts[v])
        return max(0.0, pairs[v, w] - d[min(pairs[v, w], 3)]) / n + sum(d[min(c, 3)] for c in contexts[v]) / n * lower

    return p, [*words, "<unseen>"], contexts


def test_language_model_against_its_definition(spark, tmp_path):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(list("abcdefg"), rng.integers(0, 30), p=[0.4, 0.25, 0.15, 0.1, 0.05, 0.03, 0.02])) for _ in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    folder, facts = ngram_model.fit(rows, shards=4)
    p, words, contexts = kneser_ney([t.split() for t in texts])
    for v in [*contexts, "nowhere"]:
        assert sum(p(v, w) for w in words) == pytest.approx(1.0)
    asked = [*texts, "zz a zz b", "h", None]
    for r in ngram_model.score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), folder, facts).collect():
        words = ["<start>", *(asked[r.doc_id] or "").split(), "<end>"]
        want = sum(math.log10(p(v, w)) for v, w in zip(words, words[1:]))
        assert r.score == pytest.approx(want, rel=1e-9) and r.perplexity == pytest.approx(10 ** (-want / (len(words) - 1)))
    import os

    os.remove(f"{folder}/words-{facts['words_shards'][0]}")
    with pytest.raises(Exception, match="No such file"):
        ngram_model.score(rows, folder, facts | {"opened": 2}).collect()
    other = ngram_model.fit(rows.repartition(1), shards=8)
    assert {k: v for k, v in other[1].items() if "shards" not in k} == {k: v for k, v in facts.items() if "shards" not in k}
    empty = ngram_model.fit(rows.limit(0))
    assert all(r.score == 0 and r.n_known == 0 for r in ngram_model.score(rows, *empty).collect())
