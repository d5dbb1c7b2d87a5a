"""All pairs of large groups in blocks; connected components are those of the engine."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components, with_lowest
from .common import checkpoint, frugal, small, trimmed

__all__ = ["BLOCK", "components", "grouped", "in_blocks", "roots", "smallest_of_root"]

#: Rows of a group that one task holds at a time are two blocks at most.
BLOCK = 256


def in_blocks(members: DataFrame, keys: list[str], row: str, block: int = BLOCK, weight: str | None = None, most: int = 16 << 20) -> DataFrame:
    """members once for each pair of blocks (i <= j) of its group that it takes part in, with the number of blocks.

    A group of n rows has ceil(n / block) blocks, or as many as keep the sum of `weight` near `most` for each if
    those are more, dealt by a hash of `row`; each row is repeated once per block of its group, so rows grow as
    n * n / block, and no pair is ever a row.
    """
    n = F.ceil(F.count("*") / block)
    n = F.greatest(n, F.ceil(F.sum(weight) / most)) if weight else n
    sizes = members.groupBy(*keys).agg(n.cast("int").alias("blocks")).filter(F.col("blocks") > 1)
    same = small(checkpoint(sizes)).withColumnsRenamed({k: f"{k}_" for k in keys})
    on = [F.col(k) == F.col(f"{k}_") for k in keys]
    dealt = members.join(same, on, "left").drop(*[f"{k}_" for k in keys])
    dealt = dealt.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64(row), F.col("blocks")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(*members.columns, "blocks", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def grouped(df: DataFrame, keys: list[str], run: Callable[[pa.Table], pa.RecordBatch | None], schema: str, least_rows: int = 0) -> DataFrame:
    """run for the rows of each value of the integer keys; groups follow one another in a partition.  One group is in memory at a time, or as many whole groups as it takes to reach least_rows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        held: list[pa.RecordBatch] = []
        last: tuple | None = None
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                now = tuple(c[a] for c in columns)
                if held and now != last and n >= least_rows:
                    if (out := run(pa.Table.from_batches(held))) is not None:
                        yield out
                    held, n = [], 0
                last = now
                held.append(batch.slice(a, b - a))
                n += b - a
        if held and (out := run(pa.Table.from_batches(held))) is not None:
            yield out
        held.clear()
        trimmed()

    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(each, schema)


def roots(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes with ids and edges between positions a and b: the smallest id that each reaches."""
    label = ids.copy()
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == label).all():
            return label
        label = new


def smallest_of_root(linked: DataFrame) -> DataFrame:
    """(rep, low) of (rep, root, first): the smallest `first` of each root's rows.  A root of very many rows is no hot key."""
    linked = checkpoint(linked)
    rows = linked.select(F.col("root").alias("u"), F.col("first").alias("v"), "rep")
    return with_lowest(rows, linked.count(), False).select("rep", F.col("m").alias("low"))
