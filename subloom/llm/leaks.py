"""Records of evaluation splits that also stand, exactly or almost, in the training split (problem 5).

A record is its words in order, letters and digits without case. Two records may differ by d = a fifth of the longer's
words. A training record of n words is cut into tiles of RUN words that don't overlap, an evaluation record gives every
run of RUN words. An edit touches one tile at most, so more than d tiles are enough for one to stand untouched in the
other record, at most d places away. A record has n // RUN tiles, which is more than d unless the longer has so many
words more that d = n // RUN; for those pairs alone some tiles are one word shorter, which gives one tile more, and their
keys hold d. Digests are joined across splits. Pairs that can't be within d edits are dropped by bounds on the words before
and after a tile, on the parities of words and on the number of tiles shared; all others get an exact edit distance. Records of up to SHORT words meet by keys with words left out instead. Equal records
are one class throughout (the class is the hash of the whole sequence), so copies never multiply pairs before the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subloom.llm.wordstream import CleanWords, Sequences, WordHashes, edit_distance, hash64, mix
from subloom.operators.skew import hot_keys, salted_join
from subloom.session import stored

#: Words of a tile, and the words up to which records meet by keys with words left out.
RUN, SHORT = 4, 14
#: Records of fewer words give no tiles: a longer one than SHORT can't be near them.
TILED = 12
#: A chunk is hot from this many classes on (a larger corpus raises it, so that the list stays below HOT_KEYS). The tiles
#: of a hot chunk are spread over SALTS keys, and its runs are repeated for each of them.
HOT_ROWS, HOT_KEYS, SALTS = 20_000, 50_000, 16
SEEN = 1_000_000
#: Bits of the filter that spares the texts of records in no pair a shuffle, and the bits of a class for each of its places.
BITS, _SHIFT = 1 << 26, 26


def _within(seq: Sequences, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every word of records of at least `least` words: its place in the batch, its record and its place there."""
    every = np.flatnonzero(seq.n[seq.owner] >= least)
    owner = seq.owner[every]
    return every, owner, every - seq.start[owner]


def _marked(digest: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Other digests for each number: short tiles meet for one number of edits only."""
    return mix(digest.view(np.uint64) ^ mix(number.astype(np.uint64) + np.uint64(1))).view(np.int64)


def _tiles(seq: Sequences) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner, digest, position and length of every tile of training records.

    n // RUN tiles of RUN words from the start; and for d = n // RUN, where those are one too few, the last of them are
    replaced by tiles one word shorter, so that there are d + 1.
    """
    at, owner, pos = _within(seq, TILED)
    n = seq.n[owner]
    whole = (pos % RUN == 0) & (pos + RUN <= n)
    most, short = n // RUN, RUN - n % RUN
    tail = pos - (n - short * (RUN - 1))
    cut = (tail >= 0) & (tail % (RUN - 1) == 0)
    digest = np.concatenate([seq.digest(at[whole], at[whole] + RUN), _marked(seq.digest(at[cut], at[cut] + RUN - 1), most[cut])])
    length = np.repeat([RUN, RUN - 1], [whole.sum(), cut.sum()])
    return np.concatenate([owner[whole], owner[cut]]), digest, np.concatenate([pos[whole], pos[cut]]), length


def _runs(seq: Sequences) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner, digest, position and length of every run of evaluation records that a tile may meet.

    Short tiles stand at the end of a record of n words, at n - RUN * (RUN - 1) or later, and meet a longer record of
    5 * d + r words only where n is from RUN * d + r to RUN * d + 3 (so r < 4); an equal or shorter one only below 16
    words, where d = 3.
    """
    at, owner, pos = _within(seq, TILED)
    n = seq.n[owner]
    whole = pos + RUN <= n
    few = n < 20
    edits = np.where(few, 3, n // 5)
    cut = (pos + RUN - 1 <= n) & (few | (n % 5 < RUN)) & (pos >= RUN * edits - RUN * (RUN - 1))
    digest = np.concatenate([seq.digest(at[whole], at[whole] + RUN), _marked(seq.digest(at[cut], at[cut] + RUN - 1), edits[cut])])
    length = np.repeat([RUN, RUN - 1], [whole.sum(), cut.sum()])
    return np.concatenate([owner[whole], owner[cut]]), digest, np.concatenate([pos[whole], pos[cut]]), length


#: Position and words of the record (each below 2^31, as a text has fewer characters) and a bit for tiles one word shorter
#: share one number. Keys of short records stand at the position after their last word.
_POS, _N = 1 << 32, 1 << 1
#: Bits of a digest that are kept: a shared one only proposes a pair, and shorter ones make a smaller shuffle.
_KEY = (1 << 40) - 1


def _pack(pos: np.ndarray, n: np.ndarray, length: np.ndarray) -> np.ndarray:
    return pos * _POS + n * _N + (length < RUN)


def _parities(seq: Sequences) -> np.ndarray:
    """For each of 64 kinds of words whether a record has an odd number of them: a replaced word turns two at most, others one."""
    out = np.zeros(len(seq.n), np.uint64)
    some = np.flatnonzero(seq.n)
    if len(some):
        out[some] = np.bitwise_xor.reduceat(np.uint64(1) << (seq.words & np.uint64(63)), seq.start[some])
    return out.view(np.int64)


def _short_keys(words: np.ndarray) -> set[int]:
    """Digests of a short record without at most as many words as it may differ by."""
    n = len(words)
    most = 0 if n < 4 else 1 if n < 8 else 2
    w = words.tolist()
    return {hash64(repr([x for i, x in enumerate(w) if i not in out])) >> 1 for k in range(most + 1) for out in map(set, combinations(range(n), k))}


def _table(seq: Sequences, classes: np.ndarray, seen: set[int], tiled: bool) -> pd.DataFrame:
    """cls, parity, at (packed), chunk of the records whose class isn't among those seen."""
    fresh = np.zeros(len(classes), bool)
    for i, c in enumerate(classes.tolist()):
        if c not in seen and seq.n[i]:
            seen.add(c)
            fresh[i] = True
    if len(seen) > SEEN:
        seen.clear()
    owner, digest, pos, length = _tiles(seq) if tiled else _runs(seq)
    keep = fresh[owner]
    owner = owner[keep]
    parity = _parities(seq)
    out = pd.DataFrame({"cls": classes[owner], "parity": parity[owner], "at": _pack(pos[keep], seq.n[owner], length[keep]), "chunk": digest[keep] & _KEY})
    rows = [(int(classes[i]), int(parity[i]), n * (_POS + _N), k & _KEY) for i in np.flatnonzero(fresh & (seq.n <= SHORT)) for n in [int(seq.n[i])] for k in _short_keys(seq.words[seq.start[i] : seq.end[i]])]
    return pd.concat([out, pd.DataFrame(rows, columns=list(out.columns), dtype=np.int64)]) if rows else out


def _rows(df: DataFrame, id_col: str, text_cols: list[str]) -> DataFrame:
    """id and the texts read on as one; a null is empty."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.concat_ws(" ", *[F.col(c).cast("string") for c in text_cols]).alias("text"))


def _salted(t: pd.DataFrame, is_hot: np.ndarray, tiled: bool) -> pd.DataFrame:
    """Hot chunks as SALTS other ones: a tile has one of them by its class, a run has all."""
    some = t[is_hot]
    again = 1 if tiled else SALTS
    some = some.iloc[np.repeat(np.arange(len(some)), again)]
    salt = some["cls"].to_numpy() % SALTS if tiled else np.tile(np.arange(SALTS), len(some) // SALTS)
    return pd.concat([t[~is_hot], some.assign(chunk=_marked(some["chunk"].to_numpy(), salt) & _KEY)])


def _chunk_rows(rows: DataFrame, hot: np.ndarray, tiled: bool) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, seen = WordHashes(), set()
        for b in batches:
            seq = Sequences(b["text"].tolist(), memo)
            t = _table(seq, seq.records(), seen, tiled)
            if len(hot):
                t = _salted(t, np.isin(t["chunk"].to_numpy(), hot), tiled)
            yield t

    return rows.select("text").mapInPandas(run, "cls long, parity long, at long, chunk long")


def hot_chunks(left: DataFrame, right: DataFrame) -> np.ndarray:
    """Chunks of more than HOT_ROWS classes: each partition keeps its frequent ones in bounded space, Spark adds them up."""

    def run(batches: Iterator[pd.DataFrame], tiled: bool) -> Iterator[pd.DataFrame]:
        memo, seen = WordHashes(), set()
        counts, n = pd.Series(dtype=np.int64), 0
        for b in batches:
            seq = Sequences(b["text"].tolist(), memo)
            found = _table(seq, seq.records(), seen, tiled)["chunk"].value_counts()
            counts = counts.add(found[found > 1], fill_value=0)
            n += int(found.sum())
            if len(counts) > 4 * HOT_KEYS:
                counts = counts.nlargest(HOT_KEYS)
        top = counts[counts * HOT_KEYS >= n].nlargest(HOT_KEYS)
        yield pd.DataFrame({"chunk": top.index.astype(np.int64), "n": top.to_numpy().astype(np.int64), "all": 0})
        yield pd.DataFrame({"chunk": [0], "n": [0], "all": [n]})

    side = lambda rows, tiled: rows.select("text").mapInPandas(lambda b: run(b, tiled), "chunk long, n long, all long")
    told = side(left, False).unionByName(side(right, True)).groupBy("chunk").agg(F.sum("n").alias("n"), F.sum("all").alias("all"))
    kept = told.filter((F.col("n") >= HOT_ROWS) | (F.col("all") > 0)).collect()  # at most one chunk for HOT_ROWS rows of a partition's frequent ones
    limit = max(HOT_ROWS, sum(r["all"] for r in kept) // HOT_KEYS)
    return np.array(sorted(r["chunk"] for r in kept if r["n"] >= limit), np.int64)


def _kept_bits(classes: DataFrame, k: str) -> np.ndarray:
    """A Bloom filter of BITS bits over the classes in a column: its size is fixed, a class in it is never missed."""
    places = F.explode(F.array(*[F.shiftright(k, i * _SHIFT).bitwiseAND(BITS - 1) for i in (0, 1)])).alias("p")
    told = classes.select(places).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("b"))
    bits = np.zeros(BITS // 64, np.int64)
    for r in told.collect():  # one number for each 64 bits at most
        bits[r["w"]] = r["b"]
    return bits.view(np.uint64)


def _has(bits: np.ndarray, classes: np.ndarray) -> np.ndarray:
    out = np.ones(len(classes), bool)
    for i in (0, 1):
        p = (classes >> (i * _SHIFT)) & (BITS - 1)
        out &= (bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


def _members(rows: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """id, class and words of the records whose class may be in a pair; words once for each class that a partition holds."""
    bits = rows.sparkSession.sparkContext.broadcast(_kept_bits(pairs, name))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, seen, clean = WordHashes(), set(), CleanWords()
        for b in batches:
            texts = b["text"].tolist()
            classes = Sequences(texts, memo).records()
            out = []
            for i in np.flatnonzero(_has(bits.value, classes)).tolist():
                c = int(classes[i])
                fresh = c not in seen
                seen.add(c)
                out.append((b["id"].iat[i], c, " ".join(filter(None, map(clean.__getitem__, texts[i].split()))) if fresh else None))
            if len(seen) > SEEN:
                seen.clear()
            yield pd.DataFrame(out, columns=["id", "cls", "words"])

    found = rows.mapInPandas(run, "id long, cls long, words string")
    return stored(found.select(F.col("id").alias(f"{name}_id"), F.col("cls").alias(name), F.col("words").alias(f"{name}_words")))


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        edits = []
        for x, y in zip(b["a_words"], b["b_words"], strict=True):
            p, q = x.split(), y.split()
            longer = max(len(p), len(q))
            d = 0 if p == q else edit_distance(p, q, longer // 5)
            edits.append(d if 5 * d <= longer else -1)
        out = b[["a", "b", "overlap"]].assign(edits=edits)
        yield out[out["edits"] >= 0]


def near_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b, overlap: classes of left and right records that share a key and that no bound keeps apart."""
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_chunks(left, right)
    side = lambda rows, k: _chunk_rows(rows, hot, k == "b").repartition(n, "chunk").distinct().select(F.col("cls").alias(k), F.col("parity").alias(f"{k}_parity"), F.col("at").alias(f"{k}_at"), "chunk")
    pos, words = (lambda k: F.shiftright(f"{k}_at", 32)), (lambda k: F.shiftright(f"{k}_at", 1).bitwiseAND((1 << 31) - 1))
    longer = F.greatest(words("a"), words("b"))
    # What stands before and after an untouched tile differs by its number of words at least; each edit turns two parities at
    # most, each of those that change the number of words one.
    off, more = F.abs(pos("a") - pos("b")) + F.abs(words("a") - pos("a") - words("b") + pos("b")), F.abs(words("a") - words("b"))
    turned = F.bit_count(F.col("a_parity").bitwiseXOR(F.col("b_parity")))
    near = (5 * off <= longer) & (turned <= 2 * F.floor(longer / 5) - more)
    shared = side(left, "a").join(side(right, "b"), "chunk").filter(near)
    # Each edit spoils one tile at most, so at least n / RUN - d of the b record's n / RUN whole tiles are shared.
    spared = F.floor(words("b") / RUN) - F.floor(longer / 5)
    length = F.when(pos("a") == words("a"), F.least(words("a"), words("b"))).otherwise(RUN - F.col("a_at").bitwiseAND(1))
    pairs = shared.groupBy("a", "b").agg(F.sum(length).alias("shared"), F.max(longer).alias("of"), F.count(F.lit(1)).alias("n"), F.max(spared).alias("least"))
    return pairs.filter((F.col("n") >= F.col("least")) | (F.col("of") <= SHORT)).select("a", "b", F.least(F.lit(1.0), F.col("shared") / F.col("of")).alias("overlap"))


def cross_split_pairs(df: DataFrame, id_col: str, split_col: str, text_cols: list[str], train: str = "train") -> DataFrame:
    """eval_id, train_id, overlap, edits: each evaluation record with each train record that it repeats or nearly repeats.

    overlap is the share of the longer record's words in shared keys. Words split at white space; nulls are empty; records
    without words match nothing. Rows with a null split are left out. Repeated rows pair like any other; an empty table
    gives an empty one; further columns are dropped.
    """
    links, left, right = class_links(df, id_col, split_col, text_cols, train)
    out = links.join(left.select("a_id", "a"), "a").join(right.select("b_id", "b"), "b")
    return out.select(F.col("a_id").alias("eval_id"), F.col("b_id").alias("train_id"), "overlap", "edits")


def class_links(df: DataFrame, id_col: str, split_col: str, text_cols: list[str], train: str = "train") -> tuple[DataFrame, DataFrame, DataFrame]:
    """a, b, overlap, edits of the classes of evaluation and train records that are the same or differ by a fifth of the
    words at most; and the members of the classes (a_id, a and b_id, b)."""
    left = _rows(df.filter(F.col(split_col) != train), id_col, text_cols)
    right = _rows(df.filter(F.col(split_col) == train), id_col, text_cols)
    pairs = stored(near_pairs(left, right))
    members = {k: _members(rows, pairs, k) for k, rows in (("a", left), ("b", right))}
    texts = lambda k: members[k].filter(F.col(f"{k}_words").isNotNull()).select(k, f"{k}_words").dropDuplicates([k])
    both = pairs.join(texts("a"), "a").join(texts("b"), "b")
    links = both.select("a", "b", "overlap", "a_words", "b_words").mapInPandas(_verify, "a long, b long, overlap double, edits int")
    return links, members["a"], members["b"]


def leaks_per_record(df: DataFrame, id_col: str, split_col: str, text_cols: list[str], train: str = "train") -> DataFrame:
    """eval_id, n_pairs, n_exact of each evaluation record with partners in train; the pairs themselves are never made.

    Partners are counted by class: a link counts as often as its train class has records.
    """
    links, left, right = class_links(df, id_col, split_col, text_cols, train)
    sizes = right.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    each = stored(links.join(sizes, "b").groupBy("a").agg(F.sum("n").alias("n_pairs"), F.sum(F.when(F.col("edits") == 0, F.col("n")).otherwise(0)).alias("n_exact")))
    held = left.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    out = salted_join(left.select("a_id", "a"), each, ["a"], hot_keys(held, ["a"], "n", left.count()), "a_id")
    return out.select(F.col("a_id").alias("eval_id"), "n_pairs", "n_exact")
