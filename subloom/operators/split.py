"""Splits of whole episodes by line counts, and their manifest."""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLITS = ("train", "validation", "test")
RATIOS = (0.8, 0.1, 0.1)


def assign(counts: dict[str, int], ratios: tuple[float, ...] = RATIOS, seed: int = 42, forced: Iterable[str] = ()) -> dict[str, str]:
    """Split of each episode: forced ones are test; the rest, largest first, go where the fill is lowest.

    Equal sizes are in the order of a seeded shuffle of `counts`, equal fills in the order of SPLITS.
    """
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError(f"ratios must sum to 1, got {ratios}")
    target = [max(r * sum(counts.values()), 1e-9) for r in ratios]
    filled = [0] * len(SPLITS)
    out = {m: "test" for m in sorted(set(forced)) if m in counts}
    filled[2] = sum(counts[m] for m in out)
    rest = [m for m in counts if m not in out]
    random.Random(seed).shuffle(rest)
    for m in sorted(rest, key=lambda x: -counts[x]):
        k = min(range(len(SPLITS)), key=lambda i: filled[i] / target[i])
        out[m], filled[k] = SPLITS[k], filled[k] + counts[m]
    return out


def episode_counts(records: DataFrame, order: list[str] | None = None) -> DataFrame:
    """movie_id (a null one counts as "None"), lines, and the first place, for the order of episodes."""
    movie = F.coalesce(F.col("movie_id").cast("string"), F.lit("None")).alias("movie_id")
    first = F.min(F.struct(*order)) if order else F.min(F.coalesce(F.col("movie_id").cast("string"), F.lit("None")))
    return records.groupBy(movie).agg(F.count(F.lit(1)).alias("lines"), first.alias("first_seen"))


def with_split(records: DataFrame, order: list[str] | None = None, ratios: tuple[float, ...] = RATIOS, seed: int = 42, forced: Iterable[str] = ()) -> tuple[DataFrame, dict[str, str]]:
    """Records with their split, and the assignment.

    The greedy assignment needs every episode's count in order: one row an episode comes to the driver, a few hundred
    thousand at the very most, as an episode has hundreds of lines.
    """
    counts = {r["movie_id"]: r["lines"] for r in episode_counts(records, order).orderBy("first_seen", "movie_id").collect()}
    found = assign(counts, ratios, seed, forced)
    spark = records.sparkSession
    table = spark.createDataFrame(list(found.items()) or [("", "")], "_m string, split string")
    key = F.coalesce(F.col("movie_id").cast("string"), F.lit("None"))
    return records.drop("split").withColumn("_m", key).join(table, "_m").drop("_m"), found


def split_summary(records: DataFrame) -> DataFrame:
    """split, lines, line_share (4 places), movies and their sorted list joined by commas."""
    movie = F.coalesce(F.col("movie_id").cast("string"), F.lit("None"))
    per = records.groupBy("split", movie.alias("m")).agg(F.count(F.lit(1)).alias("n"))
    out = per.groupBy("split").agg(F.sum("n").alias("lines"), F.count(F.lit(1)).alias("movies"), F.array_join(F.array_sort(F.collect_list("m")), ",").alias("movie_list"))
    total = out.agg(F.sum("lines").alias("_t"))
    everything = total.first()["_t"]
    return out.withColumn("line_share", F.bround(F.col("lines") / F.lit(everything or 1), 4))
