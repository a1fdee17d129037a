"""Running values over the rows of a key that may be of any size.

Rows are put into blocks by their place; every block is summed up for itself, the summaries of a key are combined in
order, and each row takes what its block brings from before and what comes up within the block. No task holds more of a
key than a block of rows or its summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subloom.session import cut, stored

BLOCK = 4096


def running(df: DataFrame, key: str, at: str, last: dict[str, Column] | None = None, sums: dict[str, Column] | None = None, strict: bool = False, totals: dict[str, Column] | None = None, again: bool = False) -> DataFrame:
    """Adds for each row, over the rows of its key (which isn't null) up to its place `at` (a whole number, unique in it):

    last: the last value that isn't null; sums: the sum, 0 where nothing is. strict: the row itself isn't counted.
    totals: the sum over all rows of the key. again: the block stays as a column, so that a further call for the same key
    and place finds its rows where they are. An empty table gives an empty one.
    """
    last, sums, totals = last or {}, sums or {}, totals or {}
    rows = df.withColumns({"_block": F.col("_block") if "_block" in df.columns else F.floor(F.col(at) / BLOCK), **{f"_l_{c}": x for c, x in last.items()}, **{f"_s_{c}": F.coalesce(x.cast("long"), F.lit(0)) for c, x in sums.items()}})
    if "_block" not in df.columns:  # read twice, worked out once
        rows = stored(rows)
    each = [F.max_by(f"_l_{c}", F.when(F.col(f"_l_{c}").isNotNull(), F.col(at))).alias(f"_l_{c}") for c in last]
    each += [F.sum(f"_s_{c}").alias(f"_s_{c}") for c in sums] + [F.sum(F.coalesce(x.cast("long"), F.lit(0))).alias(f"_t_{c}") for c, x in totals.items()]
    per = rows.groupBy(key, "_block").agg(*each)
    whole = Window.partitionBy(key)
    before = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.last(f"_l_{c}", ignorenulls=True).over(before).alias(f"_b_{c}") for c in last]
    carried += [F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_c_{c}") for c in sums] + [F.sum(f"_t_{c}").over(whole).alias(c) for c in totals]
    rows = rows.join(per.select(key, "_block", *carried), [key, "_block"])
    upto = Window.partitionBy(key, "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    out = rows.withColumns({**{c: F.coalesce(F.last(f"_l_{c}", ignorenulls=True).over(upto), F.col(f"_b_{c}")) for c in last}, **{c: F.coalesce(F.sum(f"_s_{c}").over(upto), F.lit(0)) + F.col(f"_c_{c}") for c in sums}})
    return out.drop(*([] if again else ["_block"]), *[f"_{k}_{c}" for c in last for k in "lb"], *[f"_{k}_{c}" for c in sums for k in "sc"])


def numbered(df: DataFrame, key: str, at: str, name: str) -> DataFrame:
    """Adds the number of each row of its key, from 1, in the order of the whole number `at`."""
    return running(df, key, at, sums={name: F.lit(1)})


def ranked(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Adds the number of each row of its key (not null), from 1, by columns of any type.

    Rows are range-sorted over the whole cluster; each partition counts its rows of a key, and the counts of the
    partitions before are added up.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(df.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order))
    rows = rows.withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()})
    per = rows.groupBy(key, "_p").agg(F.min("_m").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    out = rows.join(per.select(key, "_p", "_lo", F.coalesce(before, F.lit(0)).alias("_b")), [key, "_p"])
    return out.withColumn(name, F.col("_m") - F.col("_lo") + F.col("_b") + 1).drop("_p", "_m", "_lo", "_b")
