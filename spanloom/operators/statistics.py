"""Rollups, accuracy, scores and sequence models."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .intervals import union_length
from .order import element

_ACGT = np.frombuffer(b"ACGT", np.uint8)
#: The number of each base; 4 for every other byte.
_BASES = np.full(256, 4, np.uint8)
_BASES[_ACGT] = range(4)


def rollup_union(df: DataFrame, levels: Sequence[str], keys: Sequence[str], bin_width: int) -> DataFrame:
    """A4: counts and union lengths in total and down the levels; null stands for "all".

    A union isn't the sum of its parts, so every row is repeated for each level and each level has its own
    union; bins keep the level "all" from landing in one task.
    """
    each = F.array(*[F.struct(F.lit(n).alias("level"), *[(F.col(c) if k < n else F.lit(None).cast("string")).alias(f"_{c}") for k, c in enumerate(levels)]) for n in range(len(levels) + 1)])
    rows = df.select(*keys, "start", "end", *levels).withColumn("_l", F.explode(each)).select(*keys, "start", "end", "_l.*")
    by = ["level", *[f"_{c}" for c in levels]]
    # Groups of a null key don't meet in a join, so the level's names are turned into one key.
    rows = rows.withColumn("_key", F.to_json(F.struct(*by)))
    covered = union_length(rows, ["_key", *keys], bin_width).groupBy("_key").agg(F.sum("covered").alias("covered"))
    counts = rows.groupBy("_key", *by).agg(F.count("*").alias("n"))
    return counts.join(covered, "_key").drop("_key").withColumnsRenamed({f"_{c}": c for c in levels})


def sensitivity_specificity(df: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    """A21 for flags."""
    counted = df.agg(F.count_if(truth & predicted).alias("tp"), F.count_if(~truth & predicted).alias("fp"), F.count_if(truth & ~predicted).alias("fn"), F.count_if(~truth & ~predicted).alias("tn"))
    return counted.withColumns({"sensitivity": F.try_divide("tp", F.col("tp") + F.col("fn")), "specificity": F.try_divide("tp", F.col("tp") + F.col("fp"))})


def set_accuracy(reference: DataFrame, predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A21, J6 for exact features: standard, predicted, true positives and both shares."""
    a, b = reference.select(*keys).distinct().withColumn("_a", F.lit(1)), predicted.select(*keys).distinct().withColumn("_b", F.lit(1))
    rows = a.join(b, list(keys), "full_outer").agg(F.count("_a").alias("standard"), F.count("_b").alias("predicted"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("tp"))
    return rows.withColumns({"sensitivity": F.try_divide("tp", "standard"), "specificity": F.try_divide("tp", "predicted")})


def weighted_accuracy(nt: tuple, exon: tuple, gene: tuple) -> Column:
    """Pairs of (sensitivity, specificity) columns; weights 3, 2, 4, 3, 2, 1 over 15."""
    return (3 * nt[0] + 2 * nt[1] + 4 * exon[0] + 3 * exon[1] + 2 * gene[0] + gene[1]) / 15


def roc(df: DataFrame, score: str, truth: Column, thresholds: Sequence[float]) -> DataFrame:
    """A row for each threshold, all counted in one pass."""
    parts = [F.struct(F.lit(float(t)).alias("threshold"), F.count_if(truth & (F.col(score) >= t)).alias("tp"), F.count_if(~truth & (F.col(score) >= t)).alias("fp"), F.count_if(~truth & (F.col(score) < t)).alias("tn"), F.count_if(truth & (F.col(score) < t)).alias("fn")) for t in thresholds]
    rows = df.agg(*[p.alias(f"t{k}") for k, p in enumerate(parts)]).select(F.explode(F.array(*[f"t{k}" for k in range(len(parts))])).alias("r")).select("r.*")
    return rows.withColumns({"tpr": F.try_divide("tp", F.col("tp") + F.col("fn")), "fpr": F.try_divide("fp", F.col("fp") + F.col("tn")), "f1": F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))})


def auc(curve: DataFrame) -> DataFrame:
    """The trapezoid rule over a curve of a few points, with (0, 0) and (1, 1) added."""
    ends = curve.sparkSession.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "fpr double, tpr double")
    points = curve.select("fpr", "tpr").unionByName(ends).distinct()
    by = W.orderBy("fpr", "tpr")
    area = (F.col("fpr") - F.lag("fpr").over(by)) * (F.col("tpr") + F.lag("tpr").over(by)) / 2
    return points.select(area.alias("a")).agg(F.sum("a").alias("auc"))


def model_score(length: Column, n_parts: Column, ratio: float, bonus: Column | float = 0.0) -> Column:
    """The closed form of len * (1 + sum of r(1-r)^k over introns + bonuses), a geometric series."""
    return length * (F.lit(2.0) - F.pow(F.lit(1 - ratio), n_parts - 1) + bonus)


def fenced(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Values held within 1.5 interquartile ranges of the quartiles; quartile p is element floor((n - 1) * p).  Without keys the whole table's quartiles are searched for, so nothing is gathered."""
    held = lambda q1, q3: F.least(F.greatest(F.col(value), q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1))
    if not keys:
        q1, q3 = (element(df, value, lambda n, p=p: int((n - 1) * p)) for p in (0.25, 0.75))
        return df if q1 is None else df.withColumn(value, held(F.lit(q1), F.lit(q3)))
    by = W.partitionBy(*keys)
    ranked = df.withColumn("_k", F.row_number().over(by.orderBy(value))).withColumn("_n", F.count("*").over(by))
    at = lambda p: F.max(F.when(F.col("_k") == F.floor((F.col("_n") - 1) * p) + 1, F.col(value))).over(by)
    rows = ranked.withColumns({"_q1": at(0.25), "_q3": at(0.75)})
    return rows.withColumn(value, held(F.col("_q1"), F.col("_q3"))).drop("_k", "_n", "_q1", "_q3")


def isoform_histogram(df: DataFrame, gene: str) -> DataFrame:
    """How many genes have how many rows."""
    return df.groupBy(gene).agg(F.count("*").alias("isoforms")).groupBy("isoforms").agg(F.count("*").alias("genes"))


#: Bytes of sequences that are counted at a time.
_SLICE = 1 << 16


def _count_framed(texts: pa.Array, k: int, add: Callable[[np.ndarray], None]) -> None:
    """add(keys) for the k-mers of ACGT in each of the texts; a key is 3 * code + frame, a code has two bits a base, the last base lowest.

    The texts are one run of bytes that is worked on in slices, so a long sequence takes no more memory than many short ones.
    """
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(ends) < 2 or ends[0] == ends[-1]:
        return
    data, ends = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]
    if data.max() > 127:  # one byte for each code point: places are those of letters
        first = (data & 0xC0) != 0x80
        ends = np.concatenate([[0], np.cumsum(first)])[ends]
        data = data[first]
    for at in range(0, len(data) - k + 1, _SLICE):
        part = _BASES[data[at : at + _SLICE + k - 1]]
        n = len(part) - k + 1
        code, good = np.zeros(n, np.int64 if k > 14 else np.int32), np.ones(n, bool)
        for j in range(k):
            code = code << 2 | part[j : j + n] & 3
            good &= part[j : j + n] < 4
        a, b = np.searchsorted(ends, at, "right") - 1, np.searchsorted(ends, at + n)  # texts that the slice touches
        sizes = np.diff(np.clip(ends[a : b + 1], at, at + n))
        frame = (np.arange(n, dtype=np.int32) + np.repeat((at - ends[a:b]) % 3, sizes).astype(np.int32)) % 3
        over = ends[a + 1 : b + 1] - at  # k-mers that begin up to k - 1 places before the end of a text reach over it
        for j in range(1, k):
            good[(x := over - j)[(0 <= x) & (x < n)]] = False
        add(code[good] * 3 + frame[good])


def framed_kmers(df: DataFrame, seq: str, k: int) -> DataFrame:
    """(kmer, frame, n): every position's k-mer with its frame (k up to 30), counted in arrays where it stands; a row is made for each different one of a partition, not for each position."""
    if not 0 < k <= 30:
        raise ValueError("k-mers have 1 to 30 letters")
    dense = 3 << 2 * k if k <= 8 else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(dense, np.int64)

        def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            code, letters = keys // 3, np.empty((len(keys), k), np.uint8)
            for j in range(k):
                letters[:, k - 1 - j] = _ACGT[code >> 2 * j & 3]
            kmers = pa.Array.from_buffers(pa.string(), len(keys), [None, pa.py_buffer((np.arange(len(keys) + 1) * k).astype(np.int32)), pa.py_buffer(letters.tobytes())])
            return pa.RecordBatch.from_arrays([kmers, pa.array((keys % 3).astype(np.int32)), pa.array(n.astype(np.int64))], names=["kmer", "frame", "n"])

        for batch in batches:
            found: list[np.ndarray] = []

            def add(keys: np.ndarray) -> None:
                nonlocal counts
                if dense:
                    counts += np.bincount(keys, minlength=dense)
                else:
                    found.append(keys)  # noqa: B023

            _count_framed(batch.column(0), k, add)
            if found:
                yield rows(*np.unique(np.concatenate(found), return_counts=True))
        if dense:
            yield rows(at := np.flatnonzero(counts), counts[at])

    texts = df.select(F.coalesce(F.col(seq).cast("string"), F.lit("")).alias("seq"))
    return texts.mapInArrow(run, "kmer string, frame int, n long").groupBy("kmer", "frame").agg(F.sum("n").alias("n"))


def kmer_loglik(counts: DataFrame, base: DataFrame) -> DataFrame:
    """Log of ((n + 1) / (prefix n + 4)) over the frequency of the last base.  counts: (kmer, frame, n); base: (base, p)."""
    rows = counts.withColumn("prefix", F.expr("substring(kmer, 1, length(kmer) - 1)")).withColumn("base", F.right(F.col("kmer"), F.lit(1)))
    total = rows.groupBy("prefix", "frame").agg(F.sum("n").alias("n_prefix"))
    return rows.join(total, ["prefix", "frame"]).join(F.broadcast(base), "base").select("kmer", "frame", "n", "n_prefix", F.log(((F.col("n") + 1) / (F.col("n_prefix") + 4)) / F.col("p")).alias("loglik"))


def weight_matrix(df: DataFrame, seq: str, pseudocount: float = 1.0) -> DataFrame:
    """(pos, base, n, prob) of sequences of one length, probabilities rounded to six digits."""
    rows = df.select(F.posexplode(F.split(F.upper(seq), "")).alias("pos", "base")).filter(F.col("base").isin(*"ACGT"))
    counts = rows.groupBy("pos").pivot("base", list("ACGT")).count().fillna(0)
    total = F.col("A") + F.col("C") + F.col("G") + F.col("T") + 4 * pseudocount
    return counts.select("pos", F.explode(F.array(*[F.struct(F.lit(b).alias("base"), F.col(b).alias("n"), F.round((F.col(b) + pseudocount) / total, 6).alias("prob")) for b in "ACGT"])).alias("r")).select("pos", "r.*")


def matrix_score(seq: Column, matrix: dict[int, dict[str, float]], background: dict[str, float]) -> Column:
    """the log odds of a sequence under a weight matrix; null if it has other letters than ACGT."""
    import math

    up, total = F.upper(seq), F.lit(0.0)
    for pos, probs in sorted(matrix.items()):
        odds = F.create_map(*[F.lit(x) for b in "ACGT" for x in (b, math.log(probs[b] / background[b]))])
        total = total + F.try_element_at(odds, F.substring(up, pos + 1, 1))
    return total


def flank_length(median_gene: Column, median_gap: Column) -> Column:
    """A30."""
    return F.least(median_gene, F.floor(median_gap / 8)).cast("long")


def shares(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Each row's part of its group's sum, of the table's without keys."""
    total = F.sum(value).over(W.partitionBy(*keys)) if keys else F.lit(df.agg(F.sum(value)).first()[0])
    return df.withColumn("p", F.col(value) / total)


_STOPS = r"(TAA|TAG|TGA)$"


def _framed(seq: Column, lengths: Sequence[int], every: bool) -> Column:
    """(kmer, frame) of the k-mers that end at each position, frame being the position modulo 3; a closing stop codon's positions are left out.  Of k-mers of every length, or at each position of the longest that fits."""
    n = F.length(seq)
    stop = (n % 3 == 0) & seq.rlike(_STOPS)
    item = lambda i, m: F.struct(F.substr(seq, i - m + 1, m + 1).alias("kmer"), (i % 3).alias("frame"))
    none = F.array().cast("array<struct<kmer:string,frame:int>>")
    def part(m: int, longest) -> Column:
        last = F.when(stop & (n - 3 >= m), n - 3).otherwise(n)
        return F.when(last > m, F.transform(F.sequence(F.lit(m), last - 1), lambda i: item(i, longest(i)))).otherwise(none)

    if every:
        return F.flatten(F.array(*[part(k - 1, lambda i, m=k - 1: F.lit(m)) for k in lengths]))
    return part(0, lambda i: F.least(i, F.lit(max(lengths) - 1)))


def coding_model(df: DataFrame, seq: str, base: DataFrame, order: int = 5) -> DataFrame:
    """(kmer, frame, n, n_prefix, loglik) of coding sequences for all lengths up to order + 1: the log of (n + 1) / (n_prefix + 4) over the frequency of the last base.

    n_prefix counts the k-mer without its last base in the frame before, or all positions of that frame for single
    bases.  base: (base, p).  The model has some 16,000 rows for order 5, whatever the number of sequences.
    """
    rows = df.select(F.upper(seq).alias("s")).select(F.explode(_framed(F.col("s"), range(1, order + 2), True)).alias("f")).groupBy("f.kmer", "f.frame").agg(F.count("*").alias("n"))
    before = (F.col("frame") + 1) % 3
    prefixes = rows.select(F.col("kmer").alias("prefix"), before.alias("frame"), F.col("n").alias("n_before"))
    frames = rows.filter(F.length("kmer") == 1).groupBy(before.alias("frame")).agg(F.sum("n").alias("n_frame"))
    kept = rows.filter(~F.col("kmer").rlike("[^ACGT]")).withColumns({"prefix": F.expr("left(kmer, length(kmer) - 1)"), "base": F.right("kmer", F.lit(1))})
    kept = kept.join(prefixes, ["prefix", "frame"], "left").join(frames, "frame", "left").join(F.broadcast(base), "base")
    n_prefix = F.coalesce(F.when(F.length("kmer") == 1, F.col("n_frame")).otherwise(F.col("n_before")), F.lit(0))
    return kept.withColumn("n_prefix", n_prefix).select("kmer", "frame", "n", "n_prefix", F.log((F.col("n") + 1) / (F.col("n_prefix") + 4) / F.col("p")).alias("loglik"))


def coding_scores(df: DataFrame, ident: str, seq: str, model: DataFrame, order: int = 5) -> DataFrame:
    """(id, score_1 .. score_6), the summed log likelihoods of each sequence in the three frames of either strand; k-mers that the model lacks, and sequences under order + 1 letters, count 0.

    Each frame's k-mers are counted before they meet the model (the broadcast side; coding_model bounds its rows).
    """
    from ..functions.sequences import revcomp

    up = F.upper(F.col(seq))
    strands = [up, revcomp(up)]
    frames = F.array(*[F.struct(F.lit(3 * s + f + 1).alias("k"), F.substr(x, F.lit(f + 1), F.length(x)).alias("s")) for s, x in enumerate(strands) for f in range(3)])
    rows = df.select(ident, F.explode(frames).alias("v")).filter(F.length("v.s") >= order + 1)
    counts = rows.select(ident, "v.k", F.explode(_framed(F.col("v.s"), [order + 1], False)).alias("f")).groupBy(ident, "k", "f.kmer", "f.frame").agg(F.count("*").alias("n"))
    scored = counts.join(F.broadcast(model.select("kmer", "frame", "loglik")), ["kmer", "frame"])
    sums = scored.groupBy(ident).agg(*[F.sum(F.when(F.col("k") == k, F.col("n") * F.col("loglik"))).alias(f"score_{k}") for k in range(1, 7)])
    return df.select(ident).join(sums, ident, "left").fillna(0.0, [f"score_{k}" for k in range(1, 7)])
