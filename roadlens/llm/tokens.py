"""Byte-level BPE ids inside tasks, with a bounded cache of pieces between white space.

Texts that hold the string of a special token go through ``tokenizers``, which gives it one id; without
such a string both libraries give the same ids. A separator of token files must not occur inside a
text, so there (``special`` false) the string is ordinary text.
"""

from __future__ import annotations

import base64
import re

import public_tokenizers

VOCABULARY = "byte_bpe_50k"  # .json for tokenizers, .tiktoken has the same ranks
SPECIAL = "<|endoftext|>"
SEPARATOR = 50256
CACHE_PIECES = 100_000

_HELD: dict = {}
# A piece starts at each blank or line feed. Where white space is never doubled, the pre-tokenizer
# has a boundary there too, so ids of pieces in a row are the ids of the whole.
_PIECES, _DOUBLED = re.compile(r"(?=[ \n])"), re.compile(r"\s\s")


class _Cache(dict):
    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        found = self.encode(piece)
        if len(self) < CACHE_PIECES:
            self[piece] = found
        return found


def encoder(vocabulary: str = VOCABULARY, special: bool = False):
    """A function from a text to its ids as little-endian unsigned 32-bit bytes. One per worker."""
    if (vocabulary, special) not in _HELD:
        import numpy as np
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        bpe = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        exact: list = []  # made when a text first needs it
        whole = lambda text: np.array(bpe.encode_ordinary(text), "<u4").tobytes()
        cache = _Cache(whole)

        def encode(text: str) -> bytes:
            if special and SPECIAL in text:
                if not exact:
                    exact.append(Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))
                return np.array(exact[0].encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            if _DOUBLED.search(text):
                return whole(text)
            return b"".join(map(cache.__getitem__, _PIECES.split(text)))

        _HELD[vocabulary, special] = encode
    return _HELD[vocabulary, special]
