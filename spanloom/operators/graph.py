"""Overlap graphs: connected components, greedy suppression, pruning."""

from __future__ import annotations

import heapq
import tempfile
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share.  Where that is unset, one of our own on a local master; an error on a cluster, whose executors wouldn't see it."""
    context = spark.sparkContext
    if there := context.getConf().get("spark.checkpoint.dir", ""):
        return there
    if context.getCheckpointDir() is None:
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spanloom-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """df with its lineage cut by files in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_lowest(rows: DataFrame, n: int, with_self: bool) -> DataFrame:
    """rows (u, v, ...) with m, the smallest v of their u (or u itself).  rows are to be cheap to read (a checkpoint).

    Nodes of over max(256, n / 4096) of the n rows are at most 4096; those, if there are any, go by broadcast, so a
    hub's rows stay where they are, and no other node has many rows in one task.
    """
    m = F.least("u", F.min("v")) if with_self else F.min("v")
    low, most = rows.groupBy("u").agg(m.alias("m"), F.count("*").alias("n")), max(256, n // 4096)
    found = low.filter(F.col("n") > most).select("u", "m").collect()
    if not found:
        return rows.join(low.select("u", "m"), "u")
    hubs = F.broadcast(rows.sparkSession.createDataFrame(found, low.select("u", "m").schema))
    others = rows.join(hubs.select("u"), "u", "left_anti").join(low.filter(F.col("n") <= most).select("u", "m"), "u")
    return rows.join(hubs, "u").unionByName(others)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of edges (u, v); root is the smallest node reached.

    Alternating large-star and small-star rounds, each written to the shared folder.  Raises if they don't end.
    """
    stars = checkpoint(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(most_rounds):
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or not now[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = checkpoint(with_lowest(both, 2 * now[0], True).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = with_lowest(large, now[0], False).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").unionByName(low.select("u", F.col("m").alias("v")))
        stars = checkpoint(small.distinct())
    raise RuntimeError(f"components didn't settle in {most_rounds} rounds")


def suppress(nodes: DataFrame, edges: DataFrame, order: Sequence[str], most_rounds: int = 1000) -> DataFrame:
    """Greedy suppression.  nodes: (id, order columns); edges: (u, v) pairs that may not stay together.

    The first node in order stays and its neighbours go, and so on.  Done in rounds over all nodes at once:
    a node that precedes all its remaining neighbours stays, neighbours of those go; this gives the same
    nodes as going through them one by one, without a group in one task.  order must be total with id.
    """
    rank = F.struct(*[F.col(c) for c in order], F.col("id"))
    ranked = nodes.select("id", rank.alias("rank"))
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).filter("u != v").distinct()
    both = both.join(ranked.select(F.col("id").alias("u"), F.col("rank").alias("ru")), "u").join(ranked.select(F.col("id").alias("v"), F.col("rank").alias("rv")), "v")
    open_, gone = checkpoint(both), None
    for _ in range(most_rounds):
        if open_.isEmpty():
            return nodes if gone is None else nodes.join(gone, "id", "left_anti")
        first = open_.groupBy("u").agg(F.bool_and(F.col("ru") < F.col("rv")).alias("first")).filter("first").select("u")
        out = checkpoint(open_.join(first, "u").select(F.col("v").alias("id")).distinct())
        gone = out if gone is None else checkpoint(gone.unionByName(out).distinct())
        open_ = open_.join(out.select(F.col("id").alias("u")), "u", "left_anti").join(out.select(F.col("id").alias("v")), "v", "left_anti")
        open_ = checkpoint(open_.join(first, "u", "left_anti").join(first.select(F.col("u").alias("v")), "v", "left_anti"))
    raise RuntimeError(f"suppression didn't settle in {most_rounds} rounds")


def prune_by_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """A10: in every component the node of most edges goes (ties: lower score, then larger id) until pairs are left; of a pair the lower score goes.

    nodes: (id, score).  Which node goes depends on all that went before, so each component is one call, of E log E steps for its E edges.
    """
    roots = components(edges)
    rows = edges.filter("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct().join(roots, F.col("u") == F.col("node")).drop("node")
    score = nodes.select("id", F.col("score").cast("double").alias("score"))
    rows = rows.join(score.withColumnsRenamed({"id": "u", "score": "su"}), "u").join(score.withColumnsRenamed({"id": "v", "score": "sv"}), "v")

    def prune(pdf: pd.DataFrame) -> pd.DataFrame:
        scores = dict(zip(pdf.u, pdf.su, strict=True)) | dict(zip(pdf.v, pdf.sv, strict=True))
        near: dict = {k: set() for k in scores}
        for u, v in zip(pdf.u, pdf.v, strict=True):
            near[u].add(v)
            near[v].add(u)
        place = {k: -i for i, k in enumerate(sorted(near))}
        entry = lambda k: (-len(near[k]), scores[k], place[k], k)
        heap, out = [entry(k) for k in near], []
        heapq.heapify(heap)
        while heap:
            n, _, _, k = heapq.heappop(heap)
            if k not in near or not near[k] or -n != len(near[k]):
                continue  # an older entry
            for other in near.pop(k):
                near[other].discard(k)
                heapq.heappush(heap, entry(other))
            out.append(k)
        return pd.DataFrame({"id": out})

    kind = dict(nodes.dtypes)["id"]
    gone = rows.select("root", "u", "v", "su", "sv").groupBy("root").applyInPandas(prune, f"id {kind}")
    return nodes.join(gone, "id", "left_anti")


def first_of_each_text(df: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """Of rows with equal texts, the first; texts are compared by two hashes, so they move only as ids."""
    from pyspark.sql import Window as W

    by = W.partitionBy("_a", "_b").orderBy(*order)
    keyed = df.withColumns({"_a": F.xxhash64(text), "_b": F.md5(text)})
    return keyed.withColumn("_k", F.row_number().over(by)).filter("_k = 1").drop("_a", "_b", "_k")


def similar_by_kmers(df: DataFrame, ident: str, sequence: str, k: int = 5, share: float = 0.8) -> DataFrame:
    """Longest first (then by id), a sequence goes if over `share` of its distinct spaced k-mers (from its first letter on, one after the other) are in one sequence that stays, at any place; sequences whose distinct spaced k-mers are under 30 % of length / k go before.

    Two sequences can only be that similar if they share one of the first floor(n * (1 - share)) + 1 of the n spaced
    k-mers in any order, so only the rarest ones are looked up: a common k-mer makes no pairs.  Found pairs are
    counted exactly; suppression is `suppress`.
    """
    n = F.length(sequence) - k + 1
    cut = lambda step: F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), n, F.lit(step)), lambda i: F.substring(sequence, i, k)))).otherwise(F.array().cast("array<string>"))
    rows = df.select(F.col(ident).alias("id"), F.length(sequence).alias("len"), cut(k).alias("spaced"), cut(1).alias("mers"))
    rows = rows.filter(F.round(F.size("spaced") / (F.greatest(F.lit(1), F.col("len")) / k) * 100, 2) >= 30)
    index = rows.select(F.col("id").alias("id_r"), F.col("len").alias("len_r"), F.explode("mers").alias("mer"))
    seen = index.groupBy("mer").agg(F.count("*").alias("seen"))
    from pyspark.sql import Window as W

    probes = rows.select("id", "len", F.size("spaced").alias("n"), F.explode("spaced").alias("mer")).join(seen, "mer")
    probes = probes.withColumn("_k", F.row_number().over(W.partitionBy("id").orderBy("seen", "mer"))).filter(F.col("_k") <= F.floor(F.round(F.col("n") * (1 - share), 9)) + 1)
    later = (F.col("len") < F.col("len_r")) | ((F.col("len") == F.col("len_r")) & (F.col("id") > F.col("id_r")))
    pairs = probes.filter("seen > 1").select("id", "len", "mer").join(index, "mer").filter(later).select("id", "id_r").distinct()
    both = pairs.join(rows.select("id", "spaced"), "id").join(rows.select(F.col("id").alias("id_r"), "mers"), "id_r")
    found = F.size(F.array_intersect("spaced", "mers"))
    edges = both.filter(F.round(found / F.size("spaced") * 100, 2) > 100 * share).select(F.col("id").alias("u"), F.col("id_r").alias("v"))
    return suppress(rows.select("id", (-F.col("len")).alias("shorter")), edges, ["shorter"]).select(F.col("id").alias(ident))
