"""Closed integer intervals: joins, unions, islands, depth, tiles and masks.

Every function takes rows with integer columns `start` and `end` (both inside the interval) and key columns
(a sequence, a strand ...).  Rows with start > end are turned round by `normalised`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Width of bins for joins; about the median length of the shorter side is best.
BIN = 1000


def normalised(df: DataFrame) -> DataFrame:
    """Intervals written backwards are turned round (Q15)."""
    return df.withColumns({"start": F.least("start", "end"), "end": F.greatest("start", "end")})


def nucleotides_in_common(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """the length of the intersection, 0 if there is none."""
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2) + 1)


def _binned(df: DataFrame, width: int) -> DataFrame:
    return df.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], width: int = BIN, closed: str = "inclusive") -> DataFrame:
    """Pairs of overlapping intervals of one key.  Right columns get the suffix _r.

    Both sides are repeated for each bin they touch and joined on key and bin; a pair counts in the later
    one of its two first bins, so no distinct is needed.  A long key is spread over its bins.
    closed "strict" leaves out pairs that share a single position at their ends (Q4).
    """
    r = right.withColumnsRenamed({c: f"{c}_r" for c in right.columns})
    r = r.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start_r") / width), F.floor(F.col("end_r") / width))))
    on = [F.col(k) == F.col(f"{k}_r") for k in keys] + [F.col("l_bin") == F.col("bin")]
    pairs = _binned(left, width).withColumnRenamed("bin", "l_bin").join(r, on)
    if closed == "strict":
        touch = (F.col("start") < F.col("end_r")) & (F.col("start_r") < F.col("end"))
    else:
        touch = (F.col("start") <= F.col("end_r")) & (F.col("start_r") <= F.col("end"))
    home = F.col("bin") == F.greatest(F.floor(F.col("start") / width), F.floor(F.col("start_r") / width))
    return pairs.filter(touch & home).drop("bin", "l_bin")


def self_overlaps(df: DataFrame, keys: Sequence[str], ident: str, width: int = BIN, closed: str = "inclusive") -> DataFrame:
    """J1 within one table: every unordered pair once, the smaller `ident` left."""
    return overlap_join(df, df, keys, width, closed).filter(F.col(ident) < F.col(f"{ident}_r"))


def contained_join(outer: DataFrame, inner: DataFrame, keys: Sequence[str], width: int = BIN) -> DataFrame:
    """Inner intervals that lie strictly inside outer ones; inner columns get the suffix _r."""
    return overlap_join(outer, inner, keys, width).filter((F.col("start_r") > F.col("start")) & (F.col("end_r") < F.col("end")))


def union_length(df: DataFrame, keys: Sequence[str], bin_width: int | None = None) -> DataFrame:
    """A1: (keys, covered), the number of positions in the union of each key's intervals.

    With bin_width, intervals are cut at bin borders first; bins are disjoint, so their unions add up and
    the rows of one very large key are spread over its bins.
    """
    rows, by = df.select(*keys, "start", "end"), list(keys)
    if bin_width:
        rows = _binned(rows, bin_width).withColumns({"start": F.greatest("start", F.col("bin") * bin_width), "end": F.least("end", (F.col("bin") + 1) * bin_width - 1)})
        by = [*by, "bin"]
    before = W.partitionBy(*by).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.max("end").over(before))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start") - 1, F.coalesce("before", F.col("start") - 1)))
    return rows.groupBy(*keys).agg(F.sum(new).cast("long").alias("covered"))


def islands(df: DataFrame, keys: Sequence[str], slack: int = 0, order: Sequence[str] = ()) -> DataFrame:
    """Df with `island`, numbered from 1 along each key.

    A new island begins where an interval starts more than `slack` after all ends before it: slack 0 parts
    intervals that merely touch as neighbours, 1 joins them, a negative slack asks for that much overlap (J23).
    """
    by = W.partitionBy(*keys).orderBy("start", "end", *order)
    before = F.max("end").over(by.rowsBetween(W.unboundedPreceding, -1))
    flagged = df.withColumn("_new", (before.isNull() | (F.col("start") - before > slack)).cast("int"))
    return flagged.withColumn("island", F.sum("_new").over(by.rowsBetween(W.unboundedPreceding, 0)).cast("long")).drop("_new")


def island_spans(df: DataFrame, keys: Sequence[str], slack: int = 0) -> DataFrame:
    return islands(df, keys, slack).groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"))


def coverage(features: DataFrame, evidence: DataFrame, keys: Sequence[str], ident: Sequence[str], width: int = BIN) -> DataFrame:
    """For each feature id, its length, the positions that evidence covers, and their share.

    Evidence is cut to the feature and its union is measured, so overlapping evidence counts once.
    """
    hits = overlap_join(features, evidence.select(*keys, "start", "end"), keys, width)
    clipped = hits.select(*ident, F.greatest("start", "start_r").alias("start"), F.least("end", "end_r").alias("end"))
    covered = union_length(clipped, ident)
    length = features.groupBy(*ident).agg(F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("length"))
    return length.join(covered, list(ident), "left").withColumn("covered", F.coalesce("covered", F.lit(0).cast("long"))).withColumn("share", F.col("covered") / F.col("length"))


def intersection_length(left: DataFrame, right: DataFrame, keys: Sequence[str], ident: str, width: int = BIN, closed: str = "inclusive") -> DataFrame:
    """A2: for each pair of ids whose interval sets meet, the length of the sets' intersection; no overlap gives no row, hence 0 (Q5)."""
    hits = overlap_join(left, right, keys, width, closed)
    clipped = hits.select(ident, f"{ident}_r", F.greatest("start", "start_r").alias("start"), F.least("end", "end_r").alias("end"))
    return union_length(clipped, [ident, f"{ident}_r"])


def distinct_in(regions: DataFrame, reads: DataFrame, keys: Sequence[str], ident: str, name: str, width: int = BIN) -> DataFrame:
    """The number of distinct `name`s that overlap each region."""
    return overlap_join(regions, reads.select(*keys, "start", "end", name), keys, width).groupBy(ident).agg(F.count_distinct(f"{name}_r").alias("n_distinct"))


def depth(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs of equal depth (keys, start, end, depth), from +1 and -1 events and their running sum."""
    events = df.select(*keys, F.col("start").alias("at"), F.lit(1).alias("step")).unionByName(df.select(*keys, (F.col("end") + 1).alias("at"), F.lit(-1).alias("step")))
    events = events.groupBy(*keys, "at").agg(F.sum("step").alias("step")).filter("step != 0")
    by = W.partitionBy(*keys).orderBy("at")
    runs = events.select(*keys, F.col("at").alias("start"), (F.lead("at").over(by) - 1).alias("end"), F.sum("step").over(by.rowsBetween(W.unboundedPreceding, 0)).cast("long").alias("depth"))
    return runs.filter("depth > 0")


def depth_statistic(regions: DataFrame, runs: DataFrame, keys: Sequence[str], ident: str, width: int = BIN) -> DataFrame:
    """The upper median of the depths of a region's positions, uncovered ones counting 0; from runs, without a row for each position."""
    hits = overlap_join(regions, runs, keys, width).select(ident, F.col("start").alias("rs"), F.col("end").alias("re"), "depth_r", (F.least("end", "end_r") - F.greatest("start", "start_r") + 1).alias("n"))
    covered = hits.groupBy(ident, F.col("depth_r").alias("depth")).agg(F.sum("n").alias("n"))
    total = regions.select(ident, (F.col("end") - F.col("start") + 1).alias("total"))
    zero = total.join(covered.groupBy(ident).agg(F.sum("n").alias("m")), ident, "left").select(ident, F.lit(0).cast("long").alias("depth"), (F.col("total") - F.coalesce("m", F.lit(0))).alias("n"))
    every = covered.unionByName(zero).filter("n > 0").join(total, ident)
    cum = F.sum("n").over(W.partitionBy(ident).orderBy("depth").rowsBetween(W.unboundedPreceding, 0))
    return every.withColumn("cum", cum).filter(F.col("cum") > F.floor(F.col("total") / 2)).groupBy(ident).agg(F.min("depth").alias("median_depth"))


def tiles(df: DataFrame, size: int, overlap: int) -> DataFrame:
    """Windows of `size` that overlap by `overlap`; the last one begins where a window first reaches the end."""
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((F.col("end") - F.col("start") + 1 - size) / step)).cast("long")
    rows = df.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return rows.withColumn("tile_start", F.col("start") + F.col("tile") * step).withColumn("tile_end", F.least(F.col("tile_start") + size - 1, F.col("end")))


def chunks(df: DataFrame, keys: Sequence[str], length: str, most: int, order: str) -> DataFrame:
    """Df with `piece`: rows of each key (of the whole table without keys) from longest to shortest, ties by `order`, go into a piece until its sum of lengths reaches `most`; the next row begins a new piece with a sum of 0.

    Where a piece ends depends on all pieces before it, so the lengths of one key (two numbers a row) are one call;
    it jumps from piece to piece by bisection in their running sum.
    """
    by = list(keys) or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(0))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def pieces(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([length, order], ascending=[False, True], kind="stable").reset_index(drop=True)
        total = pdf[length].astype("int64").cumsum().to_numpy()
        piece, at, n, before = np.zeros(len(pdf), np.int64), 0, 0, 0
        while at < len(pdf):
            end = min(int(np.searchsorted(total, before + most)) + 1, len(pdf))
            piece[at:end] = n
            at, n, before = end, n + 1, int(total[end - 1])
        return pdf[[*by, order]].assign(piece=piece)

    found = rows.select(*by, order, length).groupBy(*by).applyInPandas(pieces, ", ".join([*(f"`{c}` {kinds[c]}" for c in [*by, order]), "piece long"]))
    return rows.join(found, [*by, order]).drop("_all")


def gaps(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Df with `gap`, the positions between an interval and the furthest end before it; negative where they overlap."""
    before = F.max("end").over(W.partitionBy(*keys).orderBy("start", "end", *order).rowsBetween(W.unboundedPreceding, -1))
    return df.withColumn("gap", (F.col("start") - before - 1).cast("long"))


def introns(exons: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The intervals between consecutive exons of a transcript."""
    last = F.lag("end").over(W.partitionBy(*keys).orderBy("start", "end"))
    return exons.select(*keys, (last + 1).alias("start"), (F.col("start") - 1).alias("end")).filter("start <= end")


def subtract(df: DataFrame, holes: DataFrame, keys: Sequence[str], ident: Sequence[str], width: int = BIN) -> DataFrame:
    """what is left of each interval without the holes; df needs an id column for each row."""
    cut = overlap_join(df, holes.select(*keys, "start", "end"), keys, width).select(*keys, *ident, "start", "end", F.greatest("start", "start_r").alias("hs"), F.least("end", "end_r").alias("he"))
    by = W.partitionBy(*keys, *ident, "start", "end").orderBy("hs", "he")
    reach = F.max("he").over(by.rowsBetween(W.unboundedPreceding, 0))
    pieces = cut.select(*keys, *ident, F.col("start").alias("s"), F.col("end").alias("e"), "hs", F.max("he").over(by.rowsBetween(W.unboundedPreceding, -1)).alias("before"), reach.alias("reach"), F.lead("hs").over(by).alias("next"))
    left = pieces.filter("before is null").select(*keys, *ident, F.col("s").alias("start"), (F.col("hs") - 1).alias("end"))
    right = pieces.select(*keys, *ident, (F.col("reach") + 1).alias("start"), F.coalesce(F.col("next") - 1, F.col("e")).alias("end"))
    whole = df.join(cut.select(*ident).distinct(), list(ident), "left_anti").select(*keys, *ident, "start", "end")
    return whole.unionByName(left).unionByName(right).filter("start <= end")


def shift(df: DataFrame, offset: str) -> DataFrame:
    """Coordinates of a segment back on its sequence."""
    return df.withColumns({"start": F.col("start") + F.col(offset) - 1, "end": F.col("end") + F.col(offset) - 1})


def trimmed(df: DataFrame, margin: int = 20, short: int = 80) -> DataFrame:
    """hints without a margin at either end; of short ones a quarter, at least 1."""
    n = F.col("end") - F.col("start") + 1
    by = F.when(n < short, F.greatest(F.lit(1), F.floor(n / 4))).otherwise(margin).cast("long")
    return df.withColumns({"start": F.col("start") + by, "end": F.col("end") - by}).filter("start <= end")
