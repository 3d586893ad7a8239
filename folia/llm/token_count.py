"""Operator 7: token counts by a finite-state transducer compiled from the tokenizer.

The pattern, the merges and the word ends of a word-level BPE file become one
deterministic transducer over characters whose transitions carry the number of
tokens they emit. Within a word the state holds, for each position from which
a token could still run on, the last token before it and the count up to it
(an encoding of a prefix ends in the one token that is compatible with the
encoding before it, so no other history matters). States and transitions are
made when a text first needs them and kept.

A batch of texts is one string cut into chunks of equal length. A chunk's
state map is constant from its first separator on, so every chunk is run from
there in lockstep; the maps then compose in a scan: the part before the
separator is run from the state the chunks before it end in, all chunks whose
predecessor is known at once. A chunk without a separator waits a round.

Null or empty text: 0 tokens. Whole texts of any length are counted; special
strings inside a text count as the library counts them by default.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folia.llm import vocabulary
from folia.llm.common import slices, text_buffers
from folia.llm.word_bpe import tokenizer

END = "</w>"
START, LETTERS, OTHERS, APOSTROPHE = 0, 1, 2, 3
#: Bits of a packed transition that hold the emitted count, which may be below 0.
EMIT_BITS, EMIT_ZERO = 8, 64
#: Sizes of the transition table. It is emptied before a batch when it has MOST_STATES; inside a batch, stretches that need states beyond twice as many are run letter by letter without keeping them.
MOST_STATES, MOST_SYMBOLS = 1 << 17, 160
#: Characters of a chunk, and bytes of text run at once.
CHUNK, SLICE_BYTES = 512, 3 << 20


class Transducer:
    def __init__(self, file: str, most_states: int = MOST_STATES):
        self.tokenizer = tokenizer(file)
        with open(file, encoding="utf-8") as f:
            model = json.load(f)
        self.special = [t["content"] for t in model["added_tokens"]]
        self.vocabulary = set(model["model"]["vocab"])
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"])
        self.rank = {(a, b): r for r, (a, b) in enumerate(merges)}
        self.prefixes = {base[:k] for token in self.vocabulary for base in [token.removesuffix(END)] for k in range(len(base))}
        self.letters = vocabulary.byte_letters()
        self.fits: dict[tuple[str | None, str], bool] = {}
        self.most_states = most_states
        self.symbol_of = np.full(0x110000, -1, np.int32)
        self.symbols: list[tuple[str, int]] = []
        self.far: dict[tuple[int, int], int] = {}
        self.reset()

    def reset(self) -> None:
        self.keys: list = [(START,)]
        self.number = {(START,): 0}
        self.table = np.full((1024, MOST_SYMBOLS), -1, np.int32)
        self.far.clear()

    # Merges

    def merged(self, parts: list[str]) -> list[str]:
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: self.rank.get((parts[k], parts[k + 1]), 1 << 60))
            if (pair := (parts[best], parts[best + 1])) not in self.rank:
                break
            out, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def follows(self, last: str | None, token: str) -> bool:
        """Whether a token stays as it is after the last one (at a word's start: by itself)."""
        if (known := self.fits.get((last, token))) is None:
            base = token.removesuffix(END)
            own = [*base[:-1], base[-1] + END] if token != base else list(base)
            known = self.fits[last, token] = self.merged([*(last or ""), *own]) == ([last, token] if last else [token])
        return known

    def step(self, history: tuple, letter: str) -> tuple[int, tuple, int]:
        """One more letter of a word: tokens emitted, the new history, and what is emitted besides if the word ends here."""
        emitted = ending = token = None
        for suffix, last, rel in history:
            longer = suffix + letter
            if emitted is None and longer in self.vocabulary and self.follows(last, longer) and (last is None or self.follows(None, longer)):
                emitted, token = rel + 1, longer
            if ending is None and longer + END in self.vocabulary and self.follows(last, longer + END) and (last is None or self.follows(None, longer + END)):
                ending = rel + 1
        history = tuple((s + letter, last, rel - emitted) for s, last, rel in history if s + letter in self.prefixes)
        return emitted, (*history, ("", token, 0)), ending - emitted

    def word(self, kind: int, history: tuple, char: str) -> tuple[int, tuple]:
        """A character of a word, byte by byte."""
        total = ending = 0
        for b in char.encode():
            emitted, history, ending = self.step(history, self.letters[b])
            total += emitted
        return total, (kind, history, ending)

    # States

    def symbol(self, char: str) -> int:
        """0: white space; else the character's class and number, as the library's own splitting has it."""
        kind = 0 if not self.tokenizer.pre_tokenizer.pre_tokenize_str(char) else 3 if len(self.tokenizer.pre_tokenizer.pre_tokenize_str("a" + char)) > 1 else 1
        if kind == 3 and len(self.tokenizer.pre_tokenizer.pre_tokenize_str(char + char)) > 1:
            kind = 2
        self.symbol_of[ord(char)] = len(self.symbols)
        self.symbols.append((char, kind))
        return len(self.symbols) - 1

    def go(self, key: tuple, char: str, kind: int) -> tuple[int, tuple]:
        """The transition from a state on a character: tokens emitted and the next state."""
        fresh = (("", None, 0),)
        if key[0] == LETTERS and kind == 1 or key[0] == OTHERS and kind == 3:
            return self.word(key[0], key[1], char)
        if key[0] == APOSTROPHE:
            seen = key[3]
            if (whole := seen + char) in ("'s", "'t", "'m", "'d", "'re", "'ve", "'ll"):
                history, total = fresh, 0
                for c in whole:
                    emitted, (_, history, ending) = self.word(OTHERS, history, c)
                    total += emitted
                return total + ending - self.word(OTHERS, fresh, "'")[0], (START,)  # the apostrophe was counted when it came
            if seen == "'" and char in ("r", "v", "l"):
                return 0, (*key[:3], seen + char)
            if seen == "'" and kind == 3:
                return self.word(OTHERS, key[1], char)
            out, state = key[2], (START,)
            for c, k in [*[(c, 1) for c in seen[1:]], (char, kind)]:
                emitted, state = self.go(state, c, k)
                out += emitted
            return out, state
        out = key[2] if len(key) > 1 else 0
        if kind == 0:
            return out, (START,)
        if kind == 2:
            emitted, state = self.word(START, fresh, char)
            return out + emitted + state[2], (START,)
        emitted, state = self.word(LETTERS if kind == 1 else OTHERS, fresh, char)
        return out + emitted, state if char != "'" else (APOSTROPHE, *state[1:], "'")

    def intern(self, key: tuple) -> int:
        if (n := self.number.get(key)) is None:
            n = self.number[key] = len(self.keys)
            self.keys.append(key)
            if n >= len(self.table):
                self.table = np.vstack([self.table, np.full_like(self.table, -1)])
        return n

    def transition(self, state: int, symbol: int) -> int:
        char, kind = self.symbols[symbol]
        emitted, key = self.go(self.keys[state], char, kind)
        packed = self.intern(key) << EMIT_BITS | emitted + EMIT_ZERO
        if symbol < MOST_SYMBOLS:
            self.table[state, symbol] = packed
        else:
            self.far[state, symbol] = packed
        return packed

    # Runs

    def lanes(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray, emitted: np.ndarray) -> np.ndarray:
        """Runs many stretches in lockstep from their states; writes what each character emits, returns the last states."""
        order = np.argsort(starts - ends, kind="stable")  # longest first: those still running stay in front
        at, to, state = starts[order], ends[order], states[order].astype(np.int64)
        lengths = to - at
        alive = len(at)
        alone: dict[int, tuple[int, tuple]] = {}  # stretches to be run by themselves: from which place, in which state
        for k in range(int(lengths[0]) if alive else 0):
            while alive and lengths[alive - 1] <= k:
                alive -= 1
            where = at[:alive] + k
            symbol = symbols[where]
            packed = self.table[state[:alive], np.minimum(symbol, MOST_SYMBOLS - 1)]
            unknown = np.flatnonzero((packed < 0) | (symbol >= MOST_SYMBOLS - 1))
            for i in unknown.tolist():
                s, x = int(state[i]), int(symbol[i])
                known = int(self.table[s, x]) if x < MOST_SYMBOLS else self.far.get((s, x), -1)
                if known < 0 and (i in alone or len(self.keys) > 2 * self.most_states):
                    alone.setdefault(i, (int(where[i]), self.keys[s]))
                    known = START << EMIT_BITS | EMIT_ZERO
                packed[i] = known if known >= 0 else self.transition(s, x)
            state[:alive] = packed >> EMIT_BITS
            emitted[where] = (packed & (1 << EMIT_BITS) - 1) - EMIT_ZERO
        for i, (place, key) in alone.items():
            for here in range(place, int(to[i])):
                emitted[here], key = self.go(key, *self.symbols[symbols[here]])
            state[i] = self.intern(key)
        out = np.empty_like(state)
        out[order] = state
        return out

    def counts(self, texts: list[str], chunk: int = CHUNK) -> np.ndarray:
        """Tokens of each text."""
        result = np.zeros(len(texts), np.int64)
        plain = []
        for k, text in enumerate(texts):
            if "<|" in text and any(s in text for s in self.special):
                result[k] = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
            elif text:
                try:
                    text.encode("latin-1")
                    plain.append((k, text.lower()))
                except UnicodeEncodeError:
                    plain.append((k, self.tokenizer.normalizer.normalize_str(text)))
        if not plain:
            return result
        if len(self.keys) > self.most_states:
            self.reset()
        points = np.frombuffer((" " + " ".join(t for _, t in plain) + " ").encode("utf-32-le"), "<u4")
        present = np.unique(points)
        for c in present[self.symbol_of[present] < 0].tolist():
            self.symbol(chr(c))
        symbols = self.symbol_of[points]
        emitted = np.zeros(len(points), np.int16)
        blank = np.array([kind == 0 for _, kind in self.symbols])[symbols]
        starts = np.arange(0, len(points), chunk)
        ends = np.minimum(starts + chunk, len(points))
        separators = np.append(np.flatnonzero(blank), len(points))
        first = np.minimum(separators[np.searchsorted(separators, starts)], ends)
        exits = np.full(len(starts), -1, np.int64)  # -1: the map isn't constant; its exit needs its entry
        cut = first < ends
        exits[cut] = self.lanes(symbols, first[cut] + 1, ends[cut], np.zeros(cut.sum(), np.int64), emitted)
        heads = np.arange(1, len(starts))
        while len(heads):
            ready = exits[heads - 1] >= 0
            now = heads[ready]
            stop = np.minimum(first[now] + 1, ends[now])
            got = self.lanes(symbols, starts[now], stop, exits[now - 1], emitted)
            whole = ~cut[now]
            exits[now[whole]] = got[whole]
            heads = heads[~ready]
        lengths = np.array([len(t) for _, t in plain]) + 1
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]) + 1
        result[[k for k, _ in plain]] = np.add.reduceat(emitted, begins, dtype=np.int64)
        return result


@functools.lru_cache(2)
def transducer(file: str) -> Transducer:
    """One for each worker, kept between tasks."""
    return Transducer(file)


def count_tokens(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", file: str | None = None, limit: int = 2048) -> DataFrame:
    """n_bytes (UTF-8), n_tokens and over_limit of every text."""
    file = file or vocabulary.path(vocabulary.WORD_BPE)
    docs = docs.select(id_column, text_column)

    def run(batches):
        machine = transducer(file)
        for batch in batches:
            _, offsets = text_buffers(batch.column(1))
            counts = [machine.counts([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]) for i, j in slices(offsets, SLICE_BYTES)]
            n = np.concatenate([np.zeros(0, np.int64), *counts])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], schema=pa.schema([batch.schema.field(0), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]))

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.mapInArrow(run, f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
