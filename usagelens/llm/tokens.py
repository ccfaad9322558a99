"""Token ids of texts through per-worker caches over the ``tokenizers`` library.

``word_bpe_49k.json`` encodes every pre-token on its own, and no pre-token, special token or
normalisation reaches over ASCII white space (NFC composes nothing with it, lower case is
per character, the pattern's matches hold none).  So the ids of a text are those of its
white-space pieces in order.  :class:`PieceCache` looks every piece up in a bounded cache;
on a miss it is split into pre-tokens here, for the library's model alone, where that is
proven to be the same.  Pieces for which it is not (code points from U+0100 on, control
characters 1C-1F, which Python but not the library treats as white space, or ``<|``, where a
special token may start) go through the library, and only they do: a text with a curly quote
sends the one word that holds it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

# The pattern of the tokenizer file (fixed value).
PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

LONGEST_KEY = 256     # longer pieces that the library encodes are not kept


def plain(text: str) -> bool:
    """True if splitting at white space provably gives the library's pre-tokens."""
    if "<|" in text:
        return False
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return len(raw.translate(None, b"\x1c\x1d\x1e\x1f")) == len(raw)


def pieces(text: str) -> list[str]:
    """The pieces of a text: lower-cased where they are proven, else as they stand."""
    if plain(text):
        return text.lower().split()
    out = []
    for raw in text.encode().split():      # bytes split at 09-0D and 20 alone
        piece = raw.decode()
        if plain(piece):
            out += piece.lower().split()
        else:
            out.append(piece)
    return out


def byte_chars() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class PieceCache(dict):
    """Maps a white-space piece to a value of its token ids; values add up over pieces.

    The mapping itself is the cache; above ``limit`` entries the misses are forgotten
    and only the ``frequent`` part stays, so a worker's memory is bounded.
    """

    def __init__(self, path: str, limit: int = 300_000):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.table = byte_chars()
        self.limit = limit
        self.frequent: dict = {}

    def value(self, ids: list[int]):
        raise NotImplementedError

    def keep(self, frequent: dict) -> None:
        """Entries that no overflow forgets."""
        self.frequent = frequent
        self.update(frequent)

    def pretoken(self, word: str):
        symbols = word.encode().decode("latin-1").translate(self.table)
        return self.value([t.id for t in self.model.tokenize(symbols)])

    def store(self, word: str, value):
        if len(self) >= self.limit:
            self.clear()
            self.update(self.frequent)
        self[word] = value
        return value

    def __missing__(self, piece: str):
        if not plain(piece):
            value = self.whole(piece)
            return self.store(piece, value) if len(piece) <= LONGEST_KEY else value
        if piece.isalpha():
            return self.store(piece, self.pretoken(piece))
        head, last = piece[:-1], piece[-1]
        if head.isalpha() and not last.isalnum():
            value = self[head] + (self.get(last) or self.store(last, self.pretoken(last)))
            return self.store(piece, value) if len(head) <= 6 else value
        total = self.value([])
        for word in PRETOKEN.findall(piece):
            total += self.pretoken(word)
        return self.store(piece, total)

    def whole(self, text: str):
        """The library's own encoding of a piece."""
        return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)


class IdCache(PieceCache):
    """Values are ids as little-endian uint16 bytes."""

    def value(self, ids):
        return np.array(ids, "<u2").tobytes()

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, pieces(text)))


class LengthCache(PieceCache):
    """Values are numbers of tokens."""

    def value(self, ids):
        return len(ids)

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, pieces(text)))


@lru_cache(maxsize=4)
def id_cache(path: str) -> IdCache:
    """The worker's id cache for a vocabulary file (kept between tasks)."""
    return IdCache(path)


@lru_cache(maxsize=4)
def length_cache(path: str) -> LengthCache:
    """The worker's length cache for a vocabulary file (kept between tasks)."""
    return LengthCache(path)
