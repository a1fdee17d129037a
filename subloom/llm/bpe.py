"""Byte-level BPE by longest matches and backtracking (problem 8).

The vocabulary's byte strings, read as Latin-1, are the words of an Aho-Corasick automaton. One pass over a piece of
text finds every token that starts at each byte. The encoder takes the longest token at the current byte that is
compatible with the token before it, steps to shorter ones, and goes back a token when none is left; a byte from which
no way on exists is never visited again. Two adjacent tokens are compatible when merging their joined bytes gives
just these two, which is worked out once per pair. A sequence whose neighbours are all compatible is the one that the
merges themselves make.
"""

from __future__ import annotations

import base64
import os
import re
from functools import cache
from itertools import chain

import ahocorasick
import regex

#: Splits text before the merges: the published pattern of this vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A space next to other white space.
_CROWDED = re.compile(r" \s|\s ").search

DEFAULT_DIR = "/opt/tokenizers"
CACHED_PIECES, CACHED_PAIRS = 400_000, 4_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file: a token in base64 and its id on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Pieces(dict):
    """Ids of pieces of text, each worked out when first met; emptied when too many."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= CACHED_PIECES:
            self.clear()
        ids = self[piece] = tuple(self.make(piece))
        return ids


class Encoder:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.auto = ahocorasick.Automaton()
        for b, i in ranks.items():
            self.auto.add_word(b.decode("latin-1"), i)
        self.auto.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.split = regex.compile(PATTERN).findall
        self.pieces = Pieces(lambda p: self.encode_piece(p.encode("utf-8", "replace")))
        self.first = Pieces(self._word)
        self.later = Pieces(lambda w: self._word(" " + w))

    def merged(self, data: bytes) -> list[bytes]:
        """The merges carried out one by one; only ever on the bytes of two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        found = self.fits.get((a, b))
        if found is None:
            if len(self.fits) >= CACHED_PAIRS:
                self.fits.clear()
            x, y = self.bytes_of[a], self.bytes_of[b]
            found = self.fits[a, b] = self.merged(x + y) == [x, y]
        return found

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        starting: list[list[int]] = [[] for _ in data]
        for end, token in self.auto.iter(data.decode("latin-1")):
            starting[end + 1 - len(self.bytes_of[token])].append(token)  # shorter ones end first
        dead = bytearray(len(data) + 1)
        out: list[int] = []
        at, options = 0, list(starting[0])
        waiting: list[list[int]] = []  # the shorter tokens not yet tried, of each token taken
        while at < len(data):
            while options:
                token = options.pop()
                to = at + len(self.bytes_of[token])
                if not dead[to] and (not out or self.compatible(out[-1], token)):
                    out.append(token)
                    waiting.append(options)
                    at, options = to, list(starting[to]) if to < len(data) else []
                    break
            else:
                dead[at] = 1
                if not out:
                    raise ValueError("the vocabulary lacks single bytes")
                at -= len(self.bytes_of[out.pop()])
                options = waiting.pop()
        return out

    def words(self, text: str) -> tuple[tuple[int, ...], ...] | list[tuple[int, ...]]:
        """Ids of consecutive stretches of the text.

        Where no space stands beside other white space, every single space begins a piece, so that the words between
        spaces can be encoded, and remembered, one by one.
        """
        if _CROWDED(text):
            return list(map(self.pieces.__getitem__, self.split(text)))
        first, *rest = text.split(" ")
        return [self.first[first], *map(self.later.__getitem__, rest)]

    def _word(self, data: str) -> list[int]:
        get = self.pieces.__getitem__
        return [i for p in self.split(data) for i in get(p)]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.words(text)))

    def count(self, text: str) -> int:
        return sum(map(len, self.words(text)))


@cache
def encoder(name: str = "byte_bpe_50k", folder: str = DEFAULT_DIR) -> Encoder:
    """One encoder a Python worker."""
    return Encoder(load_ranks(os.path.join(folder, f"{name}.tiktoken")))
