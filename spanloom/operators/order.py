"""Ranks, order statistics, bands and caps."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import checkpoint


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group; order must be total (Q1)."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def band(df: DataFrame, keys: Sequence[str], score: str, share: float) -> DataFrame:
    """Rows whose score is at least `share` of the best one of their group."""
    return df.withColumn("_best", F.max(score).over(W.partitionBy(*keys))).filter(F.col(score) >= F.col("_best") * share).drop("_best")


def best_isoform(df: DataFrame, keys: Sequence[str], length: str, order: Sequence[Column], share: float = 0.8) -> DataFrame:
    """Of rows within `share` of the longest, the first by order."""
    return best_per_group(band(df, keys, length, share), keys, order)


def capped(df: DataFrame, inner: Sequence[str], outer: Sequence[str], order: Sequence[Column], n_inner: int, n_outer: int) -> DataFrame:
    """At most n_inner rows of each inner group, then at most n_outer of each outer one."""
    return best_per_group(best_per_group(df, [*outer, *inner], order, n_inner), outer, order, n_outer)


def upper_median(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A5, Q2: element floor(n / 2) from 0 of each group's ascending values; ranked by a window that can spill, never gathered in one array."""
    by = W.partitionBy(*keys)
    ranked = df.filter(F.col(value).isNotNull()).select(*keys, value, F.row_number().over(by.orderBy(value)).alias("_k"), F.count("*").over(by).alias("_n"))
    return ranked.filter(F.col("_k") == F.floor(F.col("_n") / 2) + 1).select(*keys, F.col(value).alias("median"))


def statistic_at(df: DataFrame, keys: Sequence[str], value: str, p: float) -> DataFrame:
    """Q3: element min(floor(n * p), n - 1) of each group's ascending values."""
    by = W.partitionBy(*keys)
    ranked = df.filter(F.col(value).isNotNull()).select(*keys, value, F.row_number().over(by.orderBy(value)).alias("_k"), F.count("*").over(by).alias("_n"))
    return ranked.filter(F.col("_k") == F.least(F.floor(F.col("_n") * p), F.col("_n") - 1) + 1).select(*keys, F.col(value).alias("at"))


def element(df: DataFrame, value: str, index: Callable[[int], int], most: int = 100_000) -> float | None:
    """Element index(n), from 0, of the n ascending values of a whole table, exactly; null values don't count.

    A bracket around the element is narrowed by approximate quantiles, checked by exact counts, until it has at
    most `most` rows; only those are sorted in one place.  A quantile that is the element itself ends the search.
    """
    rows = df.select(F.col(value).alias("v")).filter("v is not null")
    n, low, high = rows.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    k, below, m, slack = index(n), 0, n, 0.002
    while low != high:
        part = rows.filter((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
        if m <= most:
            return part.orderBy("v").limit(k - below + 1).agg(F.max("v")).first()[0]
        at = (k - below) / m
        a, mid, b = part.agg(F.percentile_approx("v", [max(0.0, at - slack), at, min(1.0, at + slack)], 10_000)).first()[0]
        is_, v = F.lit, F.col("v")
        under_a, upto_b, under, upto, before, after = rows.agg(
            F.count_if(v < is_(a)), F.count_if(v <= is_(b)), F.count_if(v < is_(mid)), F.count_if(v <= is_(mid)), F.max(F.when(v < is_(mid), v)), F.min(F.when(v > is_(mid), v)),
        ).first()
        if under <= k < upto:
            return mid
        if under_a <= k < upto_b and (a, b) != (low, high):
            low, high, below, m = a, b, under_a, upto_b - under_a
        elif k < under:  # at least the middle's own rows leave the bracket
            high, m, slack = before, under - below, min(0.5, slack * 4)
        else:
            low, below, m, slack = after, upto, m - (upto - below), min(0.5, slack * 4)
    return low


def element_at(df: DataFrame, value: str, p: float, most: int = 100_000) -> float | None:
    """Q3 for a whole table: element min(floor(n * p), n - 1) of the ascending values."""
    return element(df, value, lambda n: min(math.floor(n * p), n - 1), most)


def medians_of_few(df: DataFrame, key: str, value: str) -> DataFrame:
    """A5 for groups that are few but may be large: (key, median), the upper median of each, found without a group in one task.  Each group is searched on its own."""
    names = [r[0] for r in df.select(key).distinct().collect()]  # few by the caller's word
    rows = [(name, element_at(df.filter(F.col(key).eqNullSafe(F.lit(name))), value, 0.5)) for name in names]
    kinds = dict(df.dtypes)
    return df.sparkSession.createDataFrame(rows, f"`{key}` {kinds[key]}, median {kinds[value]}")


def neighbour_overlaps(df: DataFrame, keys: Sequence[str], order: Sequence[str], share: float = 0.1) -> DataFrame:
    """Rows that overlap the row before them by `share` of the shorter one; columns of the row before get the suffix _before."""
    by = W.partitionBy(*keys).orderBy("start", "end", *order)
    pairs = df.withColumns({f"{c}_before": F.lag(c).over(by) for c in ("start", "end", *order)})
    both = F.least("end", "end_before") - F.greatest("start", "start_before") + 1
    shorter = F.least(F.col("end") - F.col("start"), F.col("end_before") - F.col("start_before")) + 1
    return pairs.withColumn("overlap", both.cast("long")).filter((both > 0) & (both >= shorter * share))


def phases(cds: DataFrame, keys: Sequence[str], order: Sequence[Column], length: str) -> DataFrame:
    """The phase of each part in order of transcription, from the lengths before it."""
    before = F.coalesce(F.sum(length).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return cds.withColumn("phase", ((3 - before % 3) % 3).cast("int"))


def numbered(df: DataFrame, keys: Sequence[str], start: str, strand: str, name: str = "number") -> DataFrame:
    """Features numbered in order of transcription."""
    sign = F.when(F.col(strand) == "-", -F.col(start)).otherwise(F.col(start))
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(sign)))


def renamed(df: DataFrame, prefix: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Names with numbers padded to the width of the count, numbered in the order of keys, then of `order`.

    Rows are dealt out by ranges of that order and numbered inside each; only the ranges' counts are added up in one place.
    """
    ranged = checkpoint(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = F.broadcast(counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))  # a row for each partition
    width = len(str(ranged.count()))
    rows = ranged.withColumn("_own", F.row_number().over(W.partitionBy("_part").orderBy(*keys, *order))).join(offsets, "_part")
    return rows.withColumn("name", F.concat(F.lit(prefix), F.lpad((F.col("_before") + F.col("_own")).cast("string"), width, "0"))).drop("_own", "_before", "_part")


def all_fail(df: DataFrame, keys: Sequence[str], fails: Column) -> DataFrame:
    """Keys of the groups whose rows all fail."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(fails).alias("n_failed")).filter("n = n_failed").select(*keys, "n")


def by_percentile(df: DataFrame, value: str, p: float, keep_below: bool = True) -> DataFrame:
    """Rows on one side of the value at index floor(n * p)."""
    at = element_at(df, value, p)
    if at is None:
        return df
    return df.filter(F.col(value) <= at if keep_below else F.col(value) >= at)
