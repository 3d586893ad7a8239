"""Ids of a word-level BPE file by the tokenizers library, with a memo of words.

The vocabulary drops white space, and neither its normalisation nor its
pattern reaches across it, so the ids of a text are those of its words
one after the other. Each new word goes through the library's merges once.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

from folia.llm import vocabulary
from folia.llm.common import Cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words that the memo holds in its two generations, besides those of one call; half as many pieces of words are kept beside it. Most new words are seen once only, so a larger memo saves hardly any merges.
CACHE_WORDS = 200_000
#: The vocabulary's pattern for printable Latin-1 without numerals other than digits, and signs that end words (one match, as no letter follows).
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
SIGNS = b".,;:!?)]}\"'*%$&#-"
NUMERALS = re.compile("[²³¹¼½¾]")


@functools.lru_cache(2)
def tokenizer(file: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(file)


class WordIds:
    def __init__(self, file: str, most: int = CACHE_WORDS):
        self.tokenizer = tokenizer(file)
        self.most = most
        self.merges = self.tokenizer.model.tokenize
        self.known, self.before = {}, {}  # words of this and of the last generation
        self.pieces = Cache(most // 2)
        self.raw = [np.array([i], "<u4").tobytes() for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.letters = {b: letter for b, letter in enumerate(vocabulary.byte_letters()) if chr(b) != letter}

    def piece(self, piece: str) -> bytes:
        """Ids of one match of the pattern; letters of printable Latin-1 in lower case go to the merges as they are."""
        if (found := self.pieces.get(piece)) is None:
            self.pieces.room(1)
            if piece.isalpha():
                found = b"".join([self.raw[t.id] for t in self.merges(piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters))])
            else:
                found = np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()
            self.pieces[piece] = found
        return found

    def learn(self, words: list[bytes]) -> None:
        """Ids of new words. Printable Latin-1 words, which the normaliser only lowers, are cut into the matches of the pattern, most of them letters and signs at the end; any other word goes through the library as it is."""
        known, piece = self.known, self.piece
        for raw in words:
            bare = raw.rstrip(SIGNS)
            word = bare.decode()
            if word.isalpha() and (word.isascii() or max(word) < "\u0100"):
                known[raw] = piece(word.lower()) + piece(raw[len(bare) :].decode()) if len(bare) < len(raw) else piece(word.lower())
                continue
            word = raw.decode()
            if "<" not in word and word.isprintable() and max(word) < "\u0100" and not NUMERALS.search(word):
                known[raw] = b"".join([piece(p) for p in PIECES.findall(word.lower())])
            else:
                known[raw] = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def words(self, text: str) -> list[bytes]:
        """Runs without ASCII white space. Lower case at once where no special string can be in the text (the library lowers all other text itself)."""
        raw = text.encode()
        return (raw if b"<|" in raw else raw.lower()).split()

    def packed(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [self.words(t) for t in texts]
        if len(self.known) > self.most // 2:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        new, long = [], []
        for word in set().union(*split):
            if word not in known:
                if (found := before.get(word)) is not None:
                    known[word] = found
                else:
                    (new if len(word) <= 64 else long).append(word)
        self.learn(new)
        self.learn(long)
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for word in long:  # long strings rarely come again
            del known[word]
        return out

    def forget(self) -> None:
        """Gives the memo's memory back: a worker outlives its tasks, and the tasks of other operators run in it."""
        self.known, self.before = {}, {}
        self.pieces.clear()


@functools.lru_cache(2)
def word_ids(file: str) -> WordIds:
    """One for each worker, kept between tasks; its memo is emptied by forget()."""
    return WordIds(file)
