"""Joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from this many rows on, and from this share of all rows; so there are at most SHARE hot keys.
HOT_ROWS, SHARE, SALTS = 100_000, 500, 64


def hot_keys(counted: DataFrame, keys: list[str], count: str, total: int) -> DataFrame | None:
    """The keys of `counted` (one row a key) with more than total / SHARE rows: fewer than SHARE by construction."""
    limit = max(HOT_ROWS, total // SHARE)
    found = counted.filter(F.col(count) > limit).select(*keys).collect() if total > HOT_ROWS else []
    return counted.sparkSession.createDataFrame(found, counted.select(*keys).schema) if found else None


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], hot: DataFrame | None, spread: str, how: str = "inner") -> DataFrame:
    """big join small on keys, where `small` has one row a key; the rows of hot keys are spread by the column `spread`."""
    if hot is None:
        return big.join(small, keys, how)
    mark = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    left = big.join(mark, keys, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0)).drop("_hot")
    right = small.join(mark, keys, "left").withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
