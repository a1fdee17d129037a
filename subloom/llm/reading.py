"""Reading levels by a Rasch-style model of document levels and word difficulties (problem 10).

A word w occurs in a document of level t with a probability in proportion to exp(a_w - (t - b_w)^2 / 2): a word is met
most where the level is its difficulty b_w. Given difficulties, a document's level follows from the mean difficulty of
its words; given levels, a word's parameters follow from its count, the sum of the levels at which it occurs, and the
distribution of all words over levels. The two steps alternate, both in parallel: levels and sums over all documents, then
Newton steps over all words, which depend on one another only through the sum of their probabilities at each of the 81
levels of GRID; these sums are all that is exchanged between the steps. Words meet their parameters by hash, in BUCKETS
places, so what the documents need of them has a fixed size. Rated documents give the first difficulties and, at the end,
the cuts between the bands.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subloom.llm.wordstream import hash64
from subloom.session import stored

BUCKETS = 1 << 20
GRID = np.linspace(-4, 4, 81)
ROUNDS, RIDGE, RATED = 5, 2.0, 20_000
#: Exchanges of the words' sums in the first round and in later ones, Newton steps between two, words of a partition.
FIRST, LATER, NEWTON, PART = 3, 1, 3, 1 << 17
MEMO = 1_000_000
_NO_LETTERS = re.compile(r"[^\w]|[\d_]")


class WordBuckets(dict):
    """Bucket of each raw word; -1 where it has no letters. Emptied when too large."""

    def __missing__(self, raw: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        word = _NO_LETTERS.sub("", raw.lower())
        b = self[raw] = hash64(word) % BUCKETS if word else -1
        return b


def word_lists(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """id, n_words, words (bucket of each) of the documents with at least min_words words, split at white space."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordBuckets()
        for b in batches:
            raw = [t.split() for t in b["text"]]
            lists = [np.array([i for i in map(memo.__getitem__, r) if i >= 0], np.int32) for r in raw]
            yield pd.DataFrame({"id": b["id"], "n_words": list(map(len, raw)), "words": lists})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter(F.col("text").isNotNull())
    return rows.mapInPandas(run, "id long, n_words int, words array<int>").filter(F.col("n_words") >= min_words)


def _flat(lists: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    n = lists.map(len).to_numpy()
    return np.concatenate([np.asarray(x, np.int64) for x in lists]) if n.sum() else np.zeros(0, np.int64), n


def levels_of(lists: pd.Series, difficulty: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Level of each document: where the expected difficulty of words is that of its own; 0 without words."""
    flat, n = _flat(lists)
    owner = np.repeat(np.arange(len(n)), n)
    mean = np.bincount(owner, difficulty[flat], minlength=len(n)) / np.maximum(n, 1)
    return np.where(n > 0, np.interp(mean, expected, GRID), 0.0)


def _sums(lists: DataFrame, level) -> tuple[DataFrame, np.ndarray]:
    """Over all documents: k, n, s (count and sum of levels of each bucket), and the words at each point of GRID.

    level gives the levels of a batch; a NaN leaves a document out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total, at = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(len(GRID))
        for b in batches:
            t = level(b)
            b, t = b[~np.isnan(t)], t[~np.isnan(t)]
            flat, n = _flat(b["words"])
            each = np.repeat(t, n)
            count += np.bincount(flat, minlength=BUCKETS)
            total += np.bincount(flat, each, minlength=BUCKETS)
            at += np.bincount(np.clip(np.rint((t + 4) * 10), 0, len(GRID) - 1).astype(int), n, minlength=len(GRID))
        some = np.flatnonzero(count)
        yield pd.DataFrame({"k": some, "n": count[some], "s": total[some]})
        yield pd.DataFrame({"k": BUCKETS + np.arange(len(GRID)), "n": at, "s": 0.0})

    found = stored(lists.select("id", "words").mapInPandas(run, "k int, n double, s double").groupBy("k").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    at = np.zeros(len(GRID))
    for r in found.filter(F.col("k") >= BUCKETS).collect():
        at[r["k"] - BUCKETS] = r["n"]
    return found.filter(F.col("k") < BUCKETS), at


def word_steps(words: pd.DataFrame, at: np.ndarray, log_z: np.ndarray, newton: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Words (n, s, a, b) with better a and b, their share of the probability at each level and of the difficulty there."""
    n, s, a, b = (words[c].to_numpy(float) for c in "nsab")
    prob = lambda: np.exp(np.clip(a[:, None] + b[:, None] * GRID[None, :] - log_z[None, :], -60, 30))
    for _ in range(newton):
        e = prob() * at[None, :]
        e0, e1, e2 = e.sum(1), e @ GRID, e @ GRID**2
        a = a + np.clip(np.log(n / np.maximum(e0, 1e-9)), -1, 1)
        mean = e1 / np.maximum(e0, 1e-9)
        var = np.maximum(e2 / np.maximum(e0, 1e-9) - mean**2, 1e-3)
        b = b + np.clip((n * (s / n - mean) - RIDGE * b) / (n * var + RIDGE), -0.5, 0.5)
    w = prob()
    return words.assign(a=a, b=b), w.sum(0), (w * b[:, None]).sum(0)


class Model:
    """Parameters of all words, a table in Spark (k, n, a, b), and what the levels need of them."""

    def __init__(self) -> None:
        self.words: DataFrame | None = None
        self.parts = 0
        self.log_z = np.zeros(len(GRID))
        self.difficulty = np.zeros(BUCKETS, np.float32)
        self.expected = np.arange(len(GRID)) * 1e-9

    def fit(self, sums: DataFrame, at: np.ndarray, centre: float = 0.0, scale: float = 1.0) -> None:
        """Steps towards sums whose levels are taken from `centre` in units of `scale`; `at` is in those already."""
        told = sums.select("k", "n", ((F.col("s") - centre * F.col("n")) / scale).alias("s"))
        if self.words is None:
            now = told.select("k", "n", "s", F.log(F.col("n") / max(float(at.sum()), 1.0)).alias("a"), F.lit(0.0).alias("b"))
        else:
            # Rated documents alone lack most words, which then begin at their count and at middle difficulty.
            now = told.join(self.words.select("k", "a", "b"), "k", "left").fillna(0.0, ["b"])
            now = now.withColumn("a", F.coalesce("a", F.log(F.col("n") / max(float(at.sum()), 1.0))))
        self.parts = self.parts or 1 + sums.count() // PART
        for step in range(FIRST if self.words is None else LATER):
            log_z, newton = self.log_z, NEWTON

            def run(batches: Iterator[pd.DataFrame], log_z=log_z, newton=newton) -> Iterator[pd.DataFrame]:
                z, zb = np.zeros(len(GRID)), np.zeros(len(GRID))
                for b in batches:
                    out, x, y = word_steps(b, at, log_z, newton)
                    z, zb = z + x, zb + y
                    yield out.assign(z=None)
                yield pd.DataFrame({"k": [-1], "n": [0.0], "s": [0.0], "a": [0.0], "b": [0.0], "z": [np.concatenate([z, zb])]})

            rows = now.repartition(self.parts, "k") if step == 0 else now.coalesce(self.parts)
            done = stored(rows.mapInPandas(run, "k int, n double, s double, a double, b double, z array<double>"))
            z = sum((np.array(r["z"]) for r in done.filter("k < 0").select("z").collect()), np.zeros(2 * len(GRID)))  # one row a partition
            z, zb = np.maximum(z[: len(GRID)], 1e-300), z[len(GRID) :]
            self.log_z = self.log_z + np.log(z)  # the probabilities of all words add up to one at each level
            self.expected = np.maximum.accumulate(zb / z) + np.arange(len(GRID)) * 1e-9
            now = done.filter("k >= 0").drop("z")
        self.words = now
        self.difficulty = np.zeros(BUCKETS, np.float32)
        for r in now.select("k", "b").collect():  # one number a bucket at most
            self.difficulty[r["k"]] = r["b"]


def cuts_between(level: np.ndarray, band: np.ndarray) -> list[float]:
    """For each pair of neighbouring bands the level that parts the rated documents with the fewest errors."""
    order = np.argsort(level)
    level, band = level[order], band[order]
    cuts = []
    for k in range(1, 4):
        up = band > k
        wrong = np.concatenate([[0], np.cumsum(up)]) + (~up).sum() - np.concatenate([[0], np.cumsum(~up)])
        best = np.flatnonzero(wrong == wrong.min())
        i = int(best[len(best) // 2])
        low, high = level[i - 1] if i else -np.inf, level[i] if i < len(level) else np.inf
        cuts.append(float(low + high) / 2 if np.isfinite(low) and np.isfinite(high) else float(low if np.isfinite(low) else high) if len(level) else 0.0)
    return list(np.maximum.accumulate(cuts))


def reading_levels(docs: DataFrame, id_col: str, text_col: str, rated: DataFrame, min_words: int = 1, every: DataFrame | None = None) -> DataFrame:
    """id_col, n_words, level, reading_band of each document with at least min_words words (split at white space).

    every: documents to be rated instead, of any number of words, by the model fitted to those; words that it doesn't
    know are of middle difficulty (0), and a text without words has level 0.

    rated: id_col and reading_band, of which RATED documents are used (by hash of the id; several ratings are averaged).
    Without ratings, words of long texts start as the difficult ones, and the cuts are one spread apart. Null
    texts have no row. Repeated rows count like any other; an empty table gives an empty one; further columns are
    dropped.
    """
    lists = stored(word_lists(docs, id_col, text_col, min_words))
    marks = rated.select(F.col(id_col).cast("long").alias("id"), F.col("reading_band").cast("double").alias("band")).dropna().groupBy("id").agg(F.avg("band").alias("band"))
    mine = marks.join(lists.select("id").distinct(), "id", "left_semi")
    band = {r["id"]: r["band"] for r in mine.orderBy(F.xxhash64("id"), "id").limit(RATED).collect()}
    mean, spread = (np.mean(list(band.values())), max(np.std(list(band.values())), 0.1)) if band else (0.0, 1.0)
    given = {k: (v - mean) / spread for k, v in band.items()}

    def first(b: pd.DataFrame) -> np.ndarray:
        return b["id"].map(given).to_numpy(float) if given else np.log1p(b["words"].map(len).to_numpy(float)) - 5

    spark = lists.sparkSession
    model = Model()
    model.fit(*_sums(lists, first))
    for _ in range(ROUNDS):
        known = spark.sparkContext.broadcast((model.difficulty, model.expected))
        sums, at = _sums(lists, lambda b, known=known: levels_of(b["words"], *known.value))
        n = at.sum()
        if not n:
            break
        centre = float((at @ GRID) / n)
        scale = float(max(np.sqrt((at @ (GRID - centre) ** 2) / n), 0.05))
        # Levels are given in units of their own spread, so that the two steps can't drift.
        moved = np.clip(np.rint(((GRID - centre) / scale + 4) * 10), 0, len(GRID) - 1).astype(int)
        model.fit(sums, np.bincount(moved, at, minlength=len(GRID)), centre, scale)
    known = spark.sparkContext.broadcast((model.difficulty, model.expected))

    def rate(cuts: list[float] | None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                t = levels_of(b["words"], *known.value)
                k = np.searchsorted(cuts, t, side="left") + 1 if cuts is not None else np.zeros(len(b), int)
                yield pd.DataFrame({id_col: b["id"], "n_words": b["n_words"], "level": t, "reading_band": k})

        return run

    schema = f"`{id_col}` long, n_words int, level double, reading_band int"
    chosen = lists.filter(F.col("id").isin(list(band))) if len(band) < 200 else lists.join(spark.createDataFrame([(k,) for k in band], "id long"), "id", "left_semi")
    seen = [(r[0], band[r[1]]) for r in chosen.mapInPandas(rate(None), schema).select("level", id_col).distinct().collect()] if band else []
    cuts = cuts_between(np.array([x[0] for x in seen]), np.array([x[1] for x in seen])) if seen else [-1.0, 0.0, 1.0]
    out = lists if every is None else word_lists(every, id_col, text_col, 0)
    return out.mapInPandas(rate(cuts), schema)
