"""Embedding near-dedup by a pivot-permutation index.

Reference points (pivots) are drawn from a bounded sample of the vectors.  A vector is described by the
prefix of its pivot permutation: its NEAREST pivots, nearest first.  Inverted lists are kept for pairs of
pivots, so the vectors of a list share SHARED = 2 pivots at least; a list is short, since there are many
pairs.  Two vectors are compared in one list only, that of the two smallest pivots they share, and linked
if their cosine in double precision reaches the threshold.  Lists over a block are worked on in pairs of
blocks, so a list of any length stays within memory and no pair is a row.  Exact copies are one class
beforehand.

Vectors are compared only within a label.  Vectors without label, and those that are null, empty, zero or
hold null or non-finite components, link with nothing; vectors of different lengths aren't compared.
Classes have numbers of their own, so different vectors of one id, or without id, are told apart.  Null ids
are no smallest id: a component without any other id has the id null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpoint
from .graphs import components, grouped, in_blocks, roots, smallest_of_root

THRESHOLD = 0.98
#: Pivots, length of the permutations' prefix, and vectors of the sample.
PIVOTS, NEAREST, SAMPLE = 256, 5, 4096
BLOCK = 512
#: Rows of lists, and pairs, that are worked on at a time.
ROWS, PAIRS = 8192, 1 << 18


def _classes(vectors: DataFrame) -> DataFrame:
    """Every row with k1, k2: a hash of label and vector that exact copies share; null where it links with nothing."""
    kind = vectors.schema["embedding"].dataType
    plain = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)  # other numbers are compared as doubles
    e = F.col("embedding")
    good = F.col("label").isNotNull() & (F.size(e) > 0) & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), e.cast("array<float>" if plain else "array<double>").alias("embedding"))
    return rows.withColumn("good", F.coalesce(good, F.lit(False))).select(
        "vec_id", F.when(F.col("good"), F.xxhash64("label")).alias("label"), F.when(F.col("good"), e).alias("embedding"),
        F.when(F.col("good"), F.xxhash64("label", "embedding")).alias("k1"), F.when(F.col("good"), F.xxhash64(F.lit(7), "embedding", "label")).alias("k2"),
    )


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """For each length of vectors in the sample, unit pivots: the sample is the `sample` vectors of lowest hash, a bound that doesn't depend on the table."""
    rows = vectors.select("k1", "embedding").orderBy("k1").limit(sample).collect()
    rng, found = np.random.default_rng(1), {}
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r["embedding"]), []).append(r["embedding"])
    for n, vs in by_size.items():
        x = np.array(vs, float)
        x = x / np.linalg.norm(x, axis=1)[:, None]
        x = x[rng.permutation(len(x))[:pivots]]
        if len(x) < pivots:  # few vectors: random directions fill up
            x = np.vstack([x, rng.standard_normal((pivots - len(x), n))])
        x = x - x.mean(0) if len(x) > 1 else x
        norm = np.linalg.norm(x, axis=1)
        x = x[norm > 0]
        found[n] = x / np.linalg.norm(x, axis=1)[:, None] if len(x) else rng.standard_normal((pivots, n))
    return found


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def postings(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int = NEAREST, n_pivots: int = PIVOTS) -> DataFrame:
    """(rep, label, copies, size, near, vector): the numbers of each vector's nearest pivots, nearest first, and its components as little-endian doubles or floats; lengths that the sample lacks get random pivots of that length."""

    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            sizes, near, data = np.diff(ends), [None] * len(column), [None] * len(column)
            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                p = pivots.get(n)
                if p is None:
                    p = np.random.default_rng(n).standard_normal((n_pivots, n))
                x = flat[ends[at][:, None] + np.arange(n)]
                top = np.argsort(-(_unit(x.astype(float)) @ p.T), axis=1, kind="stable")[:, :nearest]
                for k, t, v in zip(at.tolist(), top.tolist(), x, strict=True):
                    near[k], data[k] = t, v.tobytes()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rep", "label", "copies")), pa.array(sizes.astype(np.int32)), pa.array(near, pa.list_(pa.int32())), pa.array(data, pa.binary())], names=["rep", "label", "copies", "size", "near", "vector"])

    return classes.select("rep", "label", "copies", "embedding").mapInArrow(run, "rep long, label long, copies long, size int, near array<int>, vector binary")


def _pairs(group: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Parts of (left, right) positions of all pairs of each group, rows sorted by group and own: pairs of rows within a block (low = high), or of one row of either block."""
    n = len(group)
    last = np.searchsorted(group, group, "right")
    right = np.searchsorted(group * 2 + (own == high), group * 2 + 1)  # where the second block begins
    first = np.where(low == high, np.arange(n) + 1, np.where(own == low, right, last))
    many = np.maximum(last - first, 0)
    at = 0
    after = np.cumsum(many)
    while at < n:
        to = max(at + 1, int(np.searchsorted(after, (after[at - 1] if at else 0) + PAIRS, "right")))
        m = many[at:to]
        left = np.repeat(np.arange(at, to), m)
        yield left, np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + first[left]
        at = to


def _compare(threshold: float, kind: str):
    def run(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        size = table.column("size").to_numpy()
        parts = [_of_size(table.filter(pa.array(size == n)), int(n), threshold, kind) for n in np.unique(size)]
        ids, links, root = map(np.concatenate, zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(root)], names=["rep", "links", "root"]) if len(ids) else None

    return run


def _of_size(table: pa.Table, n: int, threshold: float, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, copies linked, smallest class reached) over all lists of the table."""
    names = ("label", "p", "q", "i", "j", "own", "rep", "copies")
    columns = {c: table.column(c).to_numpy() for c in names}
    order = np.lexsort([columns[c] for c in ("rep", "own", "j", "i", "q", "p", "label")])
    label, p, q, i, j, own, rep, copies = (columns[c][order] for c in names)
    new = np.ones(len(rep), bool)
    new[1:] = (np.diff(label) != 0) | (np.diff(p) != 0) | (np.diff(q) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
    group = np.cumsum(new)
    near = np.array(table.column("near").to_pylist(), np.int32)[order]
    x = _unit(np.frombuffer(b"".join(table.column("vector").to_pylist()), kind).reshape(-1, n)[order].astype(float))
    found_a, found_b = [], []
    for a, b in _pairs(group, own, i, j):
        # Counted in the list of the two smallest pivots that both have: of those up to q, only p and q.
        some = (near[a] <= q[a][:, None])[:, :, None] & (near[a][:, :, None] == near[b][:, None, :])
        here = np.flatnonzero(some.sum((1, 2)) == 2)
        a, b = a[here], b[here]
        ok = np.einsum("ij,ij->i", x[a], x[b]) >= threshold
        found_a.append(a[ok])
        found_b.append(b[ok])
    a, b = np.concatenate(found_a or [np.zeros(0, int)]), np.concatenate(found_b or [np.zeros(0, int)])
    ids, place = np.unique(rep, return_inverse=True)
    links = np.bincount(place[a], copies[b], len(ids)) + np.bincount(place[b], copies[a], len(ids))
    some = np.flatnonzero(links)
    return ids[some], links[some].astype(np.int64), roots(ids, place[a], place[b])[some]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, nearest: int = NEAREST, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; vectors: (vec_id, label, embedding)."""
    rows = checkpoint(_classes(vectors))
    classes = rows.filter("k1 is not null").groupBy("k1", "k2").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    classes = checkpoint(classes.withColumn("rep", F.monotonically_increasing_id()))
    kind = "<f4" if dict(classes.dtypes)["embedding"] == "array<float>" else "<f8"
    described = checkpoint(postings(classes, choose_pivots(classes, pivots), nearest, pivots))
    near = F.array_sort("near")
    pairs = F.flatten(F.transform(near, lambda a: F.transform(F.filter(near, lambda b: b > a), lambda b: F.struct(a.alias("p"), b.alias("q")))))
    lists = described.select("rep", "label", "copies", "size", "near", "vector", F.explode(pairs).alias("key")).select("rep", "label", "copies", "size", "near", "vector", "key.p", "key.q")
    blocks = in_blocks(lists, ["label", "size", "p", "q"], "rep", BLOCK)
    links = checkpoint(grouped(blocks, ["label", "size", "p", "q", "i", "j"], _compare(threshold, kind), "rep long, links long, root long", ROWS))
    root = components(links.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    low = smallest_of_root(root.join(classes.select("rep", "first"), F.col("rep") == F.col("node")).select("rep", "root", "first"))
    by_class = classes.select("k1", "k2", "rep", "first", "copies").join(counts, "rep", "left").join(low, "rep", "left")
    by_class = by_class.select("k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("low", "first").alias("component_id"))
    alone = rows.filter("k1 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = alone.unionByName(rows.filter("k1 is not null").select("vec_id", "k1", "k2").join(by_class, ["k1", "k2"]).select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings)


#: All pairs of a label, compared in double precision.
OP9_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(node, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.u, r.root FROM l JOIN r ON r.node = l.v),
c AS (SELECT u, count(*) AS n FROM l GROUP BY u)
SELECT node AS vec_id, COALESCE(any_value(c.n), 0)::BIGINT AS n_links, min(root) AS component_id, node = min(root) AS kept FROM r LEFT JOIN c ON c.u = node GROUP BY node
"""
