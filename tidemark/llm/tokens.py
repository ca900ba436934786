"""Token lookups inside tasks: bounded caches over a tokenizer file."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

#: Entries a worker's cache holds before it starts over. It never changes a result.
CACHE_ENTRIES = 1_000_000
#: Longer pieces of text are encoded each time they occur.
CACHED_BYTES = 64


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker; special strings by its default."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Cache:
    """Values by piece of text; misses are encoded together, batch by batch."""

    def __init__(self, path: str, value, known: dict | None = None):
        self.path, self.value = path, value
        self.known = known or {}
        self.held: dict = dict(self.known)

    def learn(self, pieces: Iterable[bytes]) -> None:
        """Encode the pieces that are not held yet."""
        missing = [p for p in set(pieces).difference(self.held) if len(p) <= CACHED_BYTES]
        if len(self.held) + len(missing) > CACHE_ENTRIES + len(self.known):
            self.held = dict(self.known)
            missing = [p for p in set(pieces).difference(self.held) if len(p) <= CACHED_BYTES]
        for start in range(0, len(missing), 10_000):
            part = missing[start : start + 10_000]
            self.held.update(zip(part, map(self.value, self._encoded(part))))

    def _encoded(self, pieces: list[bytes]) -> Iterable[list[int]]:
        """Ids of each piece."""
        encoded = tokenizer(self.path).encode_batch_fast(
            [p.decode() for p in pieces], add_special_tokens=False
        )
        return (e.ids for e in encoded)

    def once(self, piece: bytes):
        ids = tokenizer(self.path).encode(piece.decode(), add_special_tokens=False).ids
        return self.value(ids)

    def values(self, pieces: list[bytes]) -> list:
        """Values of pieces that have been learnt, in order."""
        try:
            return list(map(self.held.__getitem__, pieces))
        except KeyError:
            held = self.held
            return [held[p] if p in held else self.once(p) for p in pieces]


#: Words that are encoded as one text.
JOINED_WORDS = 1000


class WordCache(Cache):
    """A cache of words without ASCII white space, for tokenizers that treat such words
    apart: many are encoded as one text and its ids dealt to them by their offsets."""

    def _encoded(self, pieces: list[bytes]) -> Iterable[list[int]]:
        import numpy as np

        texts = [
            b" ".join(pieces[at : at + JOINED_WORDS]).decode()
            for at in range(0, len(pieces), JOINED_WORDS)
        ]
        encoded = tokenizer(self.path).encode_batch(texts, add_special_tokens=False)
        for text, one in zip(texts, encoded):
            ids = one.ids
            starts = np.fromiter((at for at, _ in one.offsets), "int64", len(ids))
            # Ids that start before the blank behind a word are of it or of one before.
            ends = np.cumsum([len(word) + 1 for word in text.split(" ")])
            cuts = np.searchsorted(starts, ends).tolist()
            yield from (ids[a:b] for a, b in zip([0, *cuts], cuts))


def grouped(texts: Iterable[str | None], size: int = 4_000_000) -> Iterable[list[str]]:
    """Texts in lists of about ``size`` characters, so that what is held at a time is bounded."""
    part, chars = [], 0
    for text in texts:
        part.append(text or "")
        chars += len(part[-1])
        if chars >= size:
            yield part
            part, chars = [], 0
    if part:
        yield part


# White space by Unicode, and the ASCII part of it.
_WIDE = "\\t\\n\\x0b\\f\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_UNSAFE = re.compile("[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_CHUNK = re.compile(rb"[\t\n\x0b\f\r ]*[^\t\n\x0b\f\r ]+|[\t\n\x0b\f\r ]+")


def byte_level_pieces(text: str) -> list[bytes] | None:
    """Text cut where a byte-level tokenizer cuts anyway: before white space after a word.

    Each piece is a run of white space and the word behind it. None if the text
    has white space beyond ASCII, whose runs must not be cut.
    """
    if not text.isascii() and _UNSAFE.search(text):
        return None
    return _CHUNK.findall(text.encode())
