"""Whole-corpus encoding (problem 8) and containers of fixed capacity (problem 9)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subloom.llm.bpe import DEFAULT_DIR, encoder


def encode_corpus(df: DataFrame, id_col: str, text_col: str, tokenizer: str = "byte_bpe_50k", folder: str = DEFAULT_DIR) -> DataFrame:
    """id_col and ids (list of int) of each row's whole text, without special tokens.

    Null and empty texts have the empty list. Texts of any length are encoded whole, in linear time; repeated rows are
    encoded like any other; an empty table gives an empty one; further columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer, folder)
        for b in batches:
            each = [e.encode(t) if t else [] for t in b.column(1).to_pylist()]
            ends = np.zeros(len(each) + 1, np.int32)
            np.cumsum([len(x) for x in each], out=ends[1:])
            flat = np.fromiter(chain.from_iterable(each), np.int32, int(ends[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[id_col, "ids"])

    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` long, ids array<int>")


def decode_corpus(df: DataFrame, id_col: str, ids_col: str, tokenizer: str = "byte_bpe_50k", folder: str = DEFAULT_DIR) -> DataFrame:
    """id_col and text of each list of ids; bytes that are no UTF-8 become the replacement character, null ids the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer, folder)
        for b in batches:
            texts = [b"".join(map(e.bytes_of.__getitem__, x or ())).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"`{id_col}` long, text string")


class Bins:
    """Open containers keyed by free space: one bit for each space that an open container has."""

    def __init__(self, capacity: int, most_open: int) -> None:
        self.capacity, self.most_open = capacity, most_open
        self.mask, self.open, self.by_space = 0, 0, {}

    def _take(self, space: int) -> list:
        bins = self.by_space[space]
        found = bins.pop()
        if not bins:
            del self.by_space[space]
            self.mask ^= 1 << space
        self.open -= 1
        return found

    def _keep(self, space: int, items: list) -> None:
        self.by_space.setdefault(space, []).append(items)
        self.mask |= 1 << space
        self.open += 1

    def add(self, size: int, item) -> list | None:
        """Puts the item into the fullest open container that holds it; returns a container that closed."""
        closed = None
        fitting = self.mask >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            items = self._take(space)
        else:
            space, items = self.capacity, []
            if self.open >= self.most_open:
                closed = self._take((self.mask & -self.mask).bit_length() - 1)
        items.append((size, item))
        if space == size:
            return items if closed is None else closed + [None] + items
        self._keep(space - size, items)
        return closed

    def rest(self) -> list[list]:
        return [items for bins in self.by_space.values() for items in bins]


def pack(sizes: Iterator[tuple[object, int]], capacity: int, most_open: int) -> Iterator[list[tuple[object, int, int]]]:
    """Containers as lists of (item, piece, size), in the order in which they close."""
    bins = Bins(capacity, most_open)

    def split(closed: list) -> Iterator[list]:
        part: list = []
        for x in closed:
            if x is None:
                yield part
                part = []
            else:
                part.append((*x[1], x[0]))
        yield part

    for item, size in sizes:
        piece = 0
        while size > capacity:
            yield [(item, piece, capacity)]
            piece, size = piece + 1, size - capacity
        closed = bins.add(size, (item, piece))
        if closed:
            yield from split(closed)
    # What is open at the end is little (most_open containers): it is packed once more, largest items first.
    last = Bins(capacity, 1 << 30)
    for size, item in sorted((x for items in bins.rest() for x in items), key=lambda x: -x[0]):
        closed = last.add(size, item)
        if closed:
            yield from split(closed)
    for items in last.rest():
        yield from split(items)


def fill_containers(df: DataFrame, id_col: str, text_col: str, capacity: int = 2048, most_open: int = 32, tokenizer: str = "byte_bpe_50k", folder: str = DEFAULT_DIR) -> DataFrame:
    """id_col, piece, n_tokens, container: each document's container, by its size in tokens.

    Bounded-space online best-fit within each partition: at most `most_open` containers are open, the fullest closes
    first. A document is split only where it is larger than a container: full pieces, then the rest as an item. Null
    and empty texts have size 0 and take part. Repeated rows are items of their own; an empty table gives an empty one;
    further columns are dropped. Container numbers hold the partition's number, so no shuffle is needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer, folder)
        number = TaskContext.get().partitionId() << 36

        def sizes() -> Iterator[tuple[object, int]]:
            for b in batches:
                for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    yield key, e.count(t) if t else 0

        rows: list[tuple[object, int, int, int]] = []
        for container in pack(sizes(), capacity, most_open):
            rows += [(*x, number) for x in container]
            number += 1
            if len(rows) > 20_000:
                yield _table(rows, id_col)
                rows = []
        if rows:
            yield _table(rows, id_col)

    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` long, piece int, n_tokens int, container long")


def _table(rows: list[tuple], id_col: str) -> pa.RecordBatch:
    ids, piece, size, container = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(size, pa.int32()), pa.array(container, pa.int64())], names=[id_col, "piece", "n_tokens", "container"])
