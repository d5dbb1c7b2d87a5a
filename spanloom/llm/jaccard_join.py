"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of word shingles (a text of fewer words than a shingle has one shingle, all its words).
1. Texts with equal words are one class, found by a hash of all words and pre-aggregated.
2. Each class gets MinHash values; bands of ROWS values are looked up, and classes that share a band are
   joined by an edge to the smallest of them, so a band with very many members has as many edges as
   members.  Connected components of these edges hold every pair that shares a band.
3. Inside a component, in blocks of bounded size, pairs are compared STEP MinHash values at a time.  With a
   uniform prior, the posterior probability that a pair with m of n equal values reaches the threshold is
   P(Binomial(n + 1, threshold) <= m); below the tolerance, the pair is dropped.
4. The rest are verified exactly on their shingle sets.
A pair at similarity 0.8 shares no band with probability (1 - 0.8 ** ROWS) ** BANDS, some 3e-6.

Result: for each row its class (the smallest doc_id that its links reach) and its number of links.  Null
texts are empty; texts without words equal each other and nothing else.  Null ids count as the smallest.
Classes have numbers of their own, so texts of one id, or without one, are told apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import checkpoint, free_names, frugal, own_columns, released, small, text_of, texts_in_batches, trimmed
from .graphs import BLOCK, components, grouped, in_blocks, roots, smallest_of_root

SHINGLE, THRESHOLD = 5, 0.8
ROWS, BANDS = 5, 32
STEP, TOLERANCE = 16, 1e-6
_NULL = -(2**63)


def seeds(n: int) -> np.ndarray:
    return np.random.default_rng(20240).integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def needed(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The fewest equal values out of n that keep a pair."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


def sets(w: shingles.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, first shingle of each text, two hashes of each text's words)."""
    n_words = np.diff(w.first)
    place = np.arange(len(w.hashes)) - np.repeat(w.first[:-1], n_words)
    powers = shingles._powers(np.uint64(0xD1342543DE82EF95), int(n_words.max(initial=0)) + 1)
    keys = []
    for salt in (0x51, 0xA3):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(shingles.mix(w.hashes + np.uint64(salt)) * powers[place], dtype=np.uint64)])
        keys.append(np.where(n_words > 0, shingles.mix(sums[w.first[1:]] - sums[w.first[:-1]] + n_words.astype(np.uint64)), 0).astype(np.uint64))
    grams, at = shingles.grams(w, k)
    text = np.searchsorted(w.first, at, "right") - 1
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    grams, text = np.concatenate([grams, keys[0][short]]), np.concatenate([text, short])
    if len(short):
        order = np.argsort(text, kind="stable")
        grams, text = grams[order], text[order]
    return grams, np.searchsorted(text, np.arange(len(n_words) + 1)), keys[0], keys[1]


def signatures(rows: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, h, k1, k2, bands, sig, bytes) of (doc_id, h, text)."""
    factors = seeds(ROWS * BANDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        released()
        for batch in batches:
            at = 0
            for texts in shingles.slices(batch.column(2), 1 << 20):
                grams, first, k1, k2 = sets(shingles.words(texts), k)
                some = np.flatnonzero(np.diff(first))
                low = np.zeros((len(factors), len(texts)), np.uint64)
                if len(some):
                    for f, factor in enumerate(factors):
                        low[f, some] = np.minimum.reduceat(grams * factor, first[some])
                bands = np.zeros((len(texts), BANDS), np.uint64)
                for r in range(ROWS):
                    bands = shingles.mix(bands + shingles.mix(low[r::ROWS].T) + np.uint64(r + 1))
                bands = shingles.mix(bands + np.arange(BANDS, dtype=np.uint64)).astype(np.int64)
                sig = np.ascontiguousarray((shingles.mix(low.T) & np.uint64(0xFFFF)).astype("<u2"))
                has = np.diff(first) > 0
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has * BANDS)]).astype(np.int32)), pa.array(bands[has].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)), pa.array(k1.astype(np.int64)), pa.array(k2.astype(np.int64)), lists, pa.array([s.tobytes() for s in sig], pa.binary()), pa.array(np.diff(np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]))],
                    names=["doc_id", "h", "k1", "k2", "bands", "sig", "bytes"],
                )
                at += len(texts)
        trimmed()

    return texts_in_batches(rows).mapInArrow(run, "doc_id long, h long, k1 long, k2 long, bands array<long>, sig binary, bytes long")


def surviving(sig: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that pruning leaves."""
    same = np.zeros(len(a), np.int32)
    for at in range(0, sig.shape[1], STEP):
        same += (sig[a, at : at + STEP] == sig[b, at : at + STEP]).sum(1)
        keep = same >= needed(min(at + STEP, sig.shape[1]), threshold, tolerance)
        a, b, same = a[keep], b[keep], same[keep]
    return a, b


def _compare(k: int, threshold: float, tolerance: float):
    def run(group: pa.Table) -> pa.RecordBatch | None:
        ids = group.column("rep").to_numpy()
        ids, only = np.unique(ids, return_index=True)
        if len(ids) < 2:
            return None
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        own, copies = group.column("own").to_numpy()[only], group.column("copies").to_numpy()[only]
        sig = np.frombuffer(b"".join(group.column("sig").take(pa.array(only)).to_pylist()), "<u2").reshape(len(ids), -1)
        left = np.flatnonzero(own == i)
        right = left if i == j else np.flatnonzero(own == j)
        found_a, found_b = [], []
        for x in left:  # a row of pairs at a time
            other = right[right > x] if i == j else right
            a, b = surviving(sig, np.full(len(other), x), other, threshold, tolerance)
            found_a.append(a)
            found_b.append(b)
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        if not len(a):
            return None
        own_sets: list = [None] * len(ids)
        texts = group.column("text").take(pa.array(only)).combine_chunks().cast(pa.large_string())
        at, used = 0, np.zeros(len(ids), bool)
        used[a] = used[b] = True
        for part in shingles.slices(texts):
            grams, first, _, _ = sets(shingles.words(part), k)
            for t in range(len(part)):
                if used[at + t]:
                    own_sets[at + t] = np.unique(grams[first[t] : first[t + 1]])
            at += len(part)
        need = np.flatnonzero(used)
        sizes = np.array([0 if s is None else len(s) for s in own_sets])
        _, code = np.unique(np.concatenate([own_sets[t] for t in need]), return_inverse=True)
        bounds = np.zeros(len(ids) + 1, np.int64)
        bounds[1:] = np.cumsum(sizes)
        mark, ok = np.zeros(code.max() + 1, bool), np.zeros(len(a), bool)
        cuts = np.flatnonzero(np.diff(a, prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(a)], strict=True):
            x, others = a[lo], b[lo:hi]
            mine = code[bounds[x] : bounds[x + 1]]
            mark[mine] = True
            n = sizes[others]
            take = np.repeat(bounds[others] - np.cumsum(n) + n, n) + np.arange(n.sum())
            both = np.add.reduceat(mark[code[take]].astype(np.int64), np.cumsum(n) - n)
            ok[lo:hi] = both >= threshold * (len(mine) + n - both) - 1e-9
            mark[mine] = False
        a, b = a[ok], b[ok]
        if not len(a):
            return None
        links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(roots(ids, a, b)[some])], names=["rep", "links", "root"])

    return run


def join(documents: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, h, class_id, class_h, n_links) of every row; h is a hash of the text, class_h that of the class's first row."""
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("doc_id"), text_of().alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"), "text")
    signed = checkpoint(signatures(rows, k))
    first = F.min(F.struct("doc_id", "h")).alias("first")
    classes = signed.groupBy("k1", "k2").agg(first, F.count("*").alias("copies")).select("k1", "k2", "first", "copies", F.monotonically_increasing_id().alias("rep"))
    classes = checkpoint(classes)
    one = signed.join(classes, ["k1", "k2"]).filter((F.col("doc_id") == F.col("first.doc_id")) & (F.col("h") == F.col("first.h")))
    one = checkpoint(one.select("rep", F.col("first.doc_id").alias("rep_id"), F.col("first.h").alias("rep_h"), "copies", "bands", "sig", "bytes").dropDuplicates(["rep"]))
    keys = one.select("rep", F.explode("bands").alias("band"))
    lowest = keys.groupBy("band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high").select("band", "low")
    edges = keys.join(lowest, "band").select(F.col("rep").alias("u"), F.col("low").alias("v"))
    groups = components(edges)
    members = checkpoint(one.join(groups, F.col("rep") == F.col("node")).select(F.col("root").alias("group"), "rep", "rep_id", "rep_h", "copies", "sig", "bytes"))
    where = small(in_blocks(members, ["group"], "rep", BLOCK, "bytes"))
    blocks = rows.join(where, (F.col("doc_id") == F.col("rep_id")) & (F.col("h") == F.col("rep_h"))).select("group", "i", "j", "own", "rep", "copies", "sig", "text")
    links = checkpoint(grouped(blocks, ["group", "i", "j"], _compare(k, threshold, tolerance), "rep long, links long, root long"))
    root = components(links.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    low = smallest_of_root(root.join(classes.select("rep", "first"), F.col("rep") == F.col("node")).select("rep", "root", "first"))
    by_class = classes.join(counts, "rep", "left").join(low, "rep", "left").withColumn("low", F.coalesce("low", "first"))
    n_links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long")
    by_class = by_class.select("k1", "k2", n_links.alias("n_links"), F.col("low.doc_id").alias("class_id"), F.col("low.h").alias("class_h"))
    return signed.select("doc_id", "h", "k1", "k2").join(by_class, ["k1", "k2"]).select("doc_id", "h", "class_id", "class_h", "n_links")


def op3(documents: DataFrame) -> DataFrame:
    """The query: doc_id, class_id, n_links of every document."""
    there = lambda c: F.when(F.col(c) != _NULL, F.col(c)).alias(c)
    return join(documents).select(there("doc_id"), there("class_id"), "n_links")


def one_of_each(documents: DataFrame, **limits) -> DataFrame:
    """documents without those that link to a smaller one: of each class the row of the smallest id stays (of several texts of that id, one), and of rows equal in id and text one.  Other columns stay as they are, whatever their names."""
    linked = join(documents, **limits)
    same = checkpoint(linked.groupBy("doc_id", "h").agg(F.count("*").alias("n"), F.min("class_id").alias("class_id"), F.min("class_h").alias("class_h")))
    gone = small(checkpoint(same.filter((F.col("doc_id") != F.col("class_id")) | (F.col("h") != F.col("class_h"))).select("doc_id", "h")))
    ident, d, dh = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)), *free_names(documents, "d", "dh")
    key = (ident == F.col(d)) & (F.xxhash64(text_of()) == F.col(dh))
    kept = documents.join(gone.select(F.col("doc_id").alias(d), F.col("h").alias(dh)), key, "left_anti")
    if same.filter("n > 1").isEmpty():
        return kept
    return kept.withColumn(d, ident).withColumn(dh, F.xxhash64(text_of())).dropDuplicates([d, dh]).select(own_columns(documents))


#: All pairs that share a shingle, compared by plain counting.
OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS same FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE same >= 0.8 * (x.n + y.n - same)),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.u, r.root FROM l JOIN r ON r.node = l.v),
c AS (SELECT u, count(*) AS n FROM l GROUP BY u)
SELECT node AS doc_id, min(root) AS class_id, COALESCE(any_value(c.n), 0)::BIGINT AS n_links FROM r LEFT JOIN c ON c.u = node GROUP BY node
"""
