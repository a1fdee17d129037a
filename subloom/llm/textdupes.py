"""Records that are the same but for whitespace, case, punctuation or field order (problem 7).

Every text streams through a skip-and-fold table (letters and digits fold to a random word of their lower-case form,
all else is skipped) into two rolling polynomial hashes of 64 bits; no canonical string is built. Rows that agree on
both hashes and on the length are compared, two pointers skipping side by side, with the smallest record of their
group. Spark groups and joins on the numbers only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subloom.operators.skew import hot_keys, salted_join
from subloom.session import stored

KEYS = ["h1", "h2", "n"]
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that powers never vanish
_BLOCK = 4096
_CHUNK = 1_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed random word for each number."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) | np.uint64(1)


def fold(ch: str) -> str:
    """The form under which a character counts; "" where it is skipped. One character to one, so that text can stream."""
    if not ch.isalnum():
        return ""
    low = ch.lower()
    return low if len(low) == 1 else ch


class Hasher:
    """Rolling hashes of many texts at once; the table fills block by block as characters turn up."""

    def __init__(self) -> None:
        self.table = np.zeros(0x110000, np.uint64)
        self.known = np.zeros(0x110000 // _BLOCK, bool)
        self.powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def _learn(self, codes: np.ndarray) -> None:
        for b in np.flatnonzero((np.bincount(codes // _BLOCK, minlength=len(self.known)) > 0) & ~self.known):
            folded = [ord(fold(chr(c)) or "\0") for c in range(b * _BLOCK, (b + 1) * _BLOCK)]
            words = _mix(np.array(folded, np.uint64))
            words[np.array(folded) == 0] = 0
            self.table[b * _BLOCK : (b + 1) * _BLOCK] = words
            self.known[b] = True

    def _grow(self, n: int) -> None:
        for k, base in enumerate(_BASES):
            while len(self.powers[k]) < n:
                have = self.powers[k]
                with np.errstate(over="ignore"):
                    step = have[-1] * np.uint64(base)
                    self.powers[k] = np.concatenate([have, have * step])

    def add(self, texts: list[str], h: np.ndarray, n: np.ndarray, at: int) -> None:
        """Goes on with the hashes h[:, at:] and lengths n[at:] of as many texts."""
        lens = np.array([len(t) for t in texts], np.int64)
        if not lens.sum():
            return
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self._learn(codes)
        words = self.table[codes]
        keep = words != 0
        owner = np.repeat(np.arange(len(texts)), lens)[keep]
        words = words[keep]
        count = np.bincount(owner, minlength=len(texts))
        if not len(words):
            return
        first = np.cumsum(count) - count
        rank = np.arange(len(words)) - first[owner] + n[at + owner]
        self._grow(int(rank.max()) + 1)
        some = np.flatnonzero(count)
        with np.errstate(over="ignore"):
            for k in (0, 1):
                h[k, at + some] += np.add.reduceat(words * self.powers[k][rank], first[some])
        n[at : at + len(texts)] += count

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, n = np.zeros((2, len(texts)), np.uint64), np.zeros(len(texts), np.int64)
        at, size = 0, 0
        for i, t in enumerate(texts):
            if size + len(t) > _CHUNK:
                self.add(texts[at:i], h, n, at)
                at, size = i, 0
            if len(t) > _CHUNK:  # a very long text streams in pieces
                for k in range(0, len(t), _CHUNK):
                    self.add([t[k : k + _CHUNK]], h, n, i)
                at = i + 1
            else:
                size += len(t)
        self.add(texts[at:], h, n, at)
        return h[0].view(np.int64), h[1].view(np.int64), n


def same_text(a: str, b: str) -> bool:
    """Two pointers over both texts, each skipping what doesn't count."""
    if a == b:
        return True
    i = j = 0
    while True:
        x = y = ""
        while i < len(a) and not (x := fold(a[i])):
            i += 1
        while j < len(b) and not (y := fold(b[j])):
            j += 1
        if x != y:
            return False
        if not x:
            return True
        i, j = i + 1, j + 1


def with_hashes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """record_id, text, h1, h2, n (letters and digits) of each row; a null text is left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for b in batches:
            h1, h2, n = hasher(b["text"].tolist())
            yield b.assign(h1=h1, h2=h2, n=n)

    rows = df.select(F.col(id_col).cast("long").alias("record_id"), F.col(text_col).cast("string").alias("text")).filter(F.col("text").isNotNull())
    return rows.mapInPandas(run, "record_id long, text string, h1 long, h2 long, n long")


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """other: null where the row's text is that of its group's first, else its own folded form (an equal hash by chance)."""
    for b in batches:
        other = [None if same_text(t, f) else "".join(map(fold, t)) for t, f in zip(b["text"], b["first_text"], strict=True)]
        yield b.drop(columns=["text", "first_text"]).assign(other=pd.Series(other, index=b.index, dtype=object))


def copies(df: DataFrame, id_col: str, text_col: str, min_length: int = 1, single: bool = False) -> DataFrame:
    """record_id, first_id, n_copies of every row that has another with the same text; with `single`, of every row.

    Texts are the same when their letters and digits are, in order and without case. Texts with fewer than `min_length`
    letters and digits, and null texts, are left out, so an empty text never counts. Repeated ids count as rows of
    their own; ties go to the smallest id; an empty table gives an empty one; further columns are dropped. A text
    that half of all rows share is counted by partial aggregation and compared in salted pieces.
    """
    hashed = stored(with_hashes(df, id_col, text_col).filter(F.col("n") >= min_length))
    counted = hashed.groupBy(*KEYS).agg(F.min("record_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"))
    counted = stored(counted if single else counted.filter("n_copies > 1"))
    alone = counted.filter("n_copies = 1").select(F.col("first_id").alias("record_id"), "first_id", "n_copies")
    groups = counted.filter("n_copies > 1")
    out = _repeated(hashed, groups, single)
    return out.unionByName(alone) if single else out


def _repeated(hashed: DataFrame, groups: DataFrame, single: bool) -> DataFrame:
    """record_id, first_id, n_copies of the rows of groups with equal hashes; rows alone in their text only with `single`."""
    hot = hot_keys(groups, KEYS, "n_copies", hashed.count())
    at_first = groups.withColumnRenamed("first_id", "record_id").join(hashed, ["record_id", *KEYS])
    firsts = at_first.groupBy(*KEYS, F.col("record_id").alias("first_id"), "n_copies").agg(F.min("text").alias("first_text"))
    pairs = salted_join(hashed, firsts, KEYS, hot, "record_id")
    schema = "record_id long, h1 long, h2 long, n long, first_id long, n_copies long, other string"
    told = stored(pairs.select("record_id", *KEYS, "first_id", "n_copies", "text", "first_text").mapInPandas(_compared, schema))
    out = told.select("record_id", "first_id", "n_copies")
    if told.filter("other IS NOT NULL").isEmpty():
        return out
    # Equal hashes of different texts: such rows are counted apart, by their folded form.
    odd = [*KEYS, "other"]
    apart = told.groupBy(*odd).agg(F.min("record_id").alias("own_first"), F.count(F.lit(1)).alias("own_n"))
    keyed = told.withColumn("other", F.coalesce("other", F.lit(""))).join(apart.filter("other IS NOT NULL"), odd, "left")
    sound = apart.filter("other IS NULL").select(*KEYS, F.col("own_n").alias("sound_n"))
    fixed = keyed.join(sound, KEYS, "left")
    n = F.coalesce("own_n", "sound_n")
    return fixed.select("record_id", F.coalesce("own_first", "first_id").alias("first_id"), n.alias("n_copies")).filter(F.col("n_copies") > (0 if single else 1))


def readable_texts(df: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """record_id and the "text" of each JSON payload, whatever its layout and field order; unreadable ones drop out."""
    json = F.try_parse_json(F.col(payload_col))
    return df.select(F.col(id_col).cast("long").alias("record_id"), F.try_variant_get(json, "$.text", "string").alias("text")).filter(F.col("text").isNotNull())
