"""Operator 1: byte-level BPE encoding and decoding.

The rank file is turned into a sentencepiece BPE model: one piece for each
token, its bytes written as byte letters, its score the negative rank, with
identity normalisation. Since the model always merges the adjacent pair of
highest score, it makes the same merges as the ranks do. Texts are cut by the
vocabulary's pattern, each piece is encoded by the model, and decoding maps
ids back to bytes.

Null or empty text: no ids, hashes of nothing. Text of any length is encoded
whole; repeated rows are each answered.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from folia.llm import vocabulary
from folia.llm.common import Cache, slices, text_buffers

#: Distinct cached words in a worker; beyond it the cache starts anew.
CACHE_WORDS = 600_000
#: Bytes of text encoded at once.
SLICE_BYTES = 4 << 20


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int) -> bytes:
    """A protobuf field: bytes with their length, or a varint."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: pieces in rank order with score -rank, then the unknown piece that sentencepiece asks for."""
    letters = vocabulary.byte_letters()
    by_rank = sorted(ranks.items(), key=lambda kv: kv[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    pieces = [_field(1, "".join(letters[b] for b in token).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -rank) for token, rank in by_rank]
    unknown = _field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _field(3, 2)
    trainer = _field(3, 2) + _field(4, len(by_rank) + 1) + _field(40, len(by_rank)) + b"".join(_varint(k << 3) + _varint((1 << 64) - 1) for k in (41, 42, 43))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in [*pieces, unknown]) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes whole texts to packed little-endian ids, and decodes them."""

    def __init__(self, file: str, pattern: str):
        table = vocabulary.ranks(file)
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(sentencepiece_model(table))
        self.letters = {b: letter for b, letter in enumerate(vocabulary.byte_letters())}
        self.tokens = [token for token, _ in sorted(table.items(), key=lambda kv: kv[1])]
        self.pattern = regex.compile(pattern)
        #: A space after and before white space (or the end) isn't the start of a cached word.
        self.odd = re.compile(r"\s (?:\s|\Z)")
        self.pieces, self.words = Cache(CACHE_WORDS), Cache(CACHE_WORDS)

    def learn_pieces(self, pieces: set[str]) -> None:
        """Ids of new matches of the pattern."""
        new = [p for p in pieces if p not in self.pieces]
        if len(self.pieces) + len(new) > self.pieces.most:
            self.pieces.clear()
            new = list(pieces)
        for piece, ids in zip(new, self.model.encode([p.encode().decode("latin-1").translate(self.letters) for p in new], num_threads=1), strict=True):
            self.pieces[piece] = np.array(ids, "<u4").tobytes()

    def matched(self, text: str) -> bytes:
        pieces = self.pattern.findall(text)
        self.learn_pieces(set(pieces))
        return b"".join(map(self.pieces.__getitem__, pieces))

    def learn_words(self, words: set[str]) -> None:
        """Ids of new words, each with the space before it. Words without white space are matched in one go: a match with a space starts the next word."""
        plain = [w for w in words if w.split() == [w]]
        runs = []
        for piece in self.pattern.findall(" " + " ".join(plain)) if plain else ():
            if piece[0] == " ":
                runs.append([piece])
            else:
                runs[-1].append(piece)
        for word in words.difference(plain):
            plain.append(word)
            runs.append(self.pattern.findall(" " + word))
        self.learn_pieces({piece for run in runs for piece in run})
        pieces = self.pieces.__getitem__
        for word, run in zip(plain, runs, strict=True):
            self.words[word] = b"".join(map(pieces, run))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """A match of the pattern never runs across the last white space of a run when that is a space: from there on the text is encoded on its own, so words with their leading space are cached. Other texts go through the pattern whole."""
        split = [None if self.odd.search(t) else t.split(" ") for t in texts]
        distinct: set[str] = set()
        for parts in split:
            if parts:
                distinct.update(parts[1:])
        new = {w for w in distinct if w not in self.words}
        if len(self.words) + len(new) > self.words.most:
            self.words.clear()
            new = distinct
        self.learn_words(new)
        out = [b"".join([self.matched(parts[0]), *map(self.words.__getitem__, parts[1:])]) if parts else self.matched(text) for text, parts in zip(texts, split, strict=True)]
        for word in new:
            if len(word) > 64:  # long strings rarely come again
                del self.words[word]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(2)
def codec(file: str, pattern: str) -> Codec:
    """One for each worker, kept between tasks."""
    return Codec(file, pattern)


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", file: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """Ids of every text: n_tokens, hashes of the packed ids and of the decoded bytes, and with with_ids the packed ids themselves."""
    file, pattern = file or vocabulary.path(vocabulary.BYTE_RANKS), pattern or vocabulary.PATTERN
    docs = docs.select(id_column, text_column)
    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())] + [pa.field("ids", pa.binary())] * with_ids

    def run(batches):
        coder = codec(file, pattern)
        for batch in batches:
            counts, hashes, back, packed = [], [], [], []
            _, offsets = text_buffers(batch.column(1))
            for i, j in slices(offsets, SLICE_BYTES):
                for ids in coder.encode_all([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]):
                    counts.append(len(ids) // 4)
                    hashes.append(hashlib.sha256(ids).hexdigest())
                    back.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                    if with_ids:
                        packed.append(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (counts, hashes, back)), *[pa.array(packed, pa.binary())] * with_ids], schema=pa.schema([batch.schema.field(0), *fields]))

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)


def decode(encoded: DataFrame, ids_column: str = "ids", file: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds the column decoded (bytes) to rows with packed ids; null ids give null."""
    from pyspark.sql import functions as F

    file, pattern = file or vocabulary.path(vocabulary.BYTE_RANKS), pattern or vocabulary.PATTERN

    @F.pandas_udf("binary")
    def back(ids):
        coder = codec(file, pattern)
        return ids.map(lambda x: None if x is None else coder.decode(bytes(x)))

    return encoded.withColumn("decoded", back(ids_column))
