"""Records as sequences of word hashes, for many records at once."""

from __future__ import annotations

import hashlib

import numpy as np

MEMO = 2_000_000


def clean(word: str) -> str:
    """Letters and digits of a word, without case."""
    return "".join(c for c in word.lower() if c.isalnum())


def hash64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class WordHashes(dict):
    """Hash of each raw word by its clean form; 0 where nothing of it counts. Emptied when too large."""

    def __missing__(self, raw: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        word = clean(raw)
        h = self[raw] = (hash64(word) or 1) if word else 0
        return h


class CleanWords(dict):
    """Clean form of each raw word. Emptied when too large."""

    def __missing__(self, raw: str) -> str:
        if len(self) >= MEMO:
            self.clear()
        word = self[raw] = clean(raw)
        return word


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        return np.multiply.accumulate(out)


class Sequences:
    """The word hashes of a batch, end to end, and hashes of any stretch of them in constant time."""

    def __init__(self, texts: list[str], memo: WordHashes) -> None:
        raw = [t.split() for t in texts]
        get = memo.__getitem__
        flat = np.fromiter((h for words in raw for h in map(get, words)), np.uint64, sum(map(len, raw)))
        owner = np.repeat(np.arange(len(raw)), [len(w) for w in raw])[flat != 0]
        self.words = flat[flat != 0]
        self.n = np.bincount(owner, minlength=len(raw))
        self.end = np.cumsum(self.n)
        self.start = self.end - self.n
        self.owner = owner
        total = len(self.words)
        with np.errstate(over="ignore"):
            self.prefix = np.zeros(total + 1, np.uint64)
            np.cumsum(self.words * _powers(_BASE, total), out=self.prefix[1:])
            self.undo = _powers(_INVERSE, total + 1)

    def digest(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rolling hash of the words from start to end, wherever they stand."""
        with np.errstate(over="ignore"):
            h = (self.prefix[end] - self.prefix[start]) * self.undo[start]
            return mix(h + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)

    def records(self) -> np.ndarray:
        return self.digest(self.start, self.end)


def edit_distance(a: list, b: list, most: int) -> int:
    """Fewest words to insert, drop or replace, by bit-parallel columns; most + 1 where lengths alone rule it out."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if not a or not b:
        return max(len(a), len(b))
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = full, 0
    left = len(b)
    for y in b:
        left -= 1
        eq = where.get(y, 0)
        x = eq | down
        d = (((eq & up) + up) ^ up) | eq
        rise, fall = (down | ~(d | up)) & full, up & d
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
            # each later word lowers the score by one at most
        if score - left > most:
            return most + 1
        rise, fall = ((rise << 1) | 1) & full, (fall << 1) & full
        up, down = (fall | ~(x | rise)) & full, rise & x
    return score
