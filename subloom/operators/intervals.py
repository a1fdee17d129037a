"""Continuous periods and gaps of intervals per entity.

Rows are range-sorted by (entity, start) over the whole cluster, so an entity of any size spreads over many
partitions. Each partition reports one summary of its last entity; the driver combines those summaries in order (one
row for each partition, whatever the data), and a second scan labels the rows from the carried state. No entity is
ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.session import cut

#: (entity, largest end so far, start of the island that is open)
State = tuple[str, int, int]


def to_ms(seconds: str | Column) -> Column:
    """Seconds as whole milliseconds; null for null, NaN and infinite values."""
    c = F.col(seconds) if isinstance(seconds, str) else seconds
    finite = c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 9e12)
    return F.when(finite, F.round(c * 1000).cast("long"))


def _scan(batch: pd.DataFrame, state: State | None) -> tuple[pd.DataFrame, State]:
    """Adds `seen` (largest end before the row, of its entity) and `island` (start of its island) to sorted rows."""
    keys, start, end = batch["entity"].to_numpy(), batch["start_ms"].to_numpy(), batch["end_ms"].to_numpy()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    if state is not None and state[0] == keys[0]:
        new[0] = False
    seg = np.cumsum(new)
    top = pd.Series(end).groupby(seg).cummax().to_numpy()
    if not new[0]:
        head = seg == seg[0]
        top[head] = np.maximum(top[head], state[1])
    seen = np.empty_like(top)
    seen[1:] = top[:-1]
    seen[0] = state[1] if not new[0] else 0
    opens = new | (start > seen)
    at = np.where(opens, np.arange(len(keys)), -1)
    np.maximum.accumulate(at, out=at)
    island = np.where(at >= 0, start[at], state[2] if not new[0] else 0)
    out = batch.assign(seen=pd.Series(seen, index=batch.index).where(~new), island=island)
    return out, (keys[-1], int(top[-1]), int(island[-1]))


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    first, state = None, None
    for b in batches:
        if len(b):
            first = b["entity"].iloc[0] if first is None else first
            state = _scan(b, state)[1]
    if state is not None:
        row = (TaskContext.get().partitionId(), first, *state)
        yield pd.DataFrame([row], columns=["pid", "first", "entity", "top", "island"])


def carried(summaries: list[tuple[int, str, str, int, int]]) -> dict[int, State]:
    """State before each partition, from (pid, first entity, last entity, largest end, open island) in order."""
    before: dict[int, State] = {}
    state: State | None = None
    for pid, first, last, top, island in sorted(summaries):
        if state is not None and state[0] == first:
            before[pid] = state
            if first == last:  # the whole partition continues one entity
                island = state[2] if island <= state[1] else island
                top = max(top, state[1])
        state = (last, top, island)
    return before


def label_islands(df: DataFrame, entity: str, start_ms: str, end_ms: str) -> DataFrame:
    """entity, start_ms, end_ms of every countable row, with `seen` and `island`.

    `seen` is the largest end of the entity's earlier rows (null for its first), `island` the start of the continuous
    period that the row is in. Rows with a null entity, start or end, or an end not after the start, don't count. Ties
    and repeated rows are ordinary rows; an empty table gives an empty one; other columns are dropped.
    """
    base = df.select(F.col(entity).cast("string").alias("entity"), F.col(start_ms).cast("long").alias("start_ms"), F.col(end_ms).cast("long").alias("end_ms"))
    base = base.filter(F.col("entity").isNotNull() & F.col("start_ms").isNotNull() & (F.col("end_ms") > F.col("start_ms")))
    keys = ["entity", "start_ms", "end_ms"]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut(base.repartitionByRange(n, *keys).sortWithinPartitions(*keys))
    found = ordered.mapInPandas(_summaries, "pid int, first string, entity string, top long, island long").collect()
    before = carried([tuple(r) for r in found])

    def rescan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = before.get(TaskContext.get().partitionId())
        for b in batches:
            if len(b):
                out, state = _scan(b, state)
                yield out

    return ordered.mapInPandas(rescan, "entity string, start_ms long, end_ms long, seen long, island long")


def merged_periods(df: DataFrame, entity: str, start_ms: str, end_ms: str) -> DataFrame:
    """entity, period_start_ms, period_end_ms, n_rows: touching or overlapping rows become one period."""
    rows = label_islands(df, entity, start_ms, end_ms)
    return rows.groupBy("entity", F.col("island").alias("period_start_ms")).agg(F.max("end_ms").alias("period_end_ms"), F.count(F.lit(1)).alias("n_rows"))


def gaps(df: DataFrame, entity: str, start_ms: str, end_ms: str, at_least: int = 1) -> DataFrame:
    """entity, gap_start_ms, gap_end_ms: stretches of at least `at_least` ms between an entity's rows that none covers."""
    rows = label_islands(df, entity, start_ms, end_ms)
    return rows.filter(F.col("start_ms") - F.col("seen") >= at_least).select("entity", F.col("seen").alias("gap_start_ms"), F.col("start_ms").alias("gap_end_ms"))
