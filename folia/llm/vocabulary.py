"""Where the public vocabulary files are; the place is a parameter of every operator that needs one."""

from __future__ import annotations

import base64
import functools

import public_tokenizers

BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def path(name: str) -> str:
    return public_tokenizers.path(name)


PATTERN = public_tokenizers.PATTERN


@functools.lru_cache(4)
def ranks(file: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(file, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.lru_cache(1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others take the code points from 256 on in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]
