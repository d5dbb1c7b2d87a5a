"""Toxicity by compression distance.

zstandard trains two dictionaries, one on toxic and one on ordinary text.  Every word of a text, with a blank
on either side, is a window; it is compressed with each dictionary, and the difference of the two lengths says
which kind of text it resembles.  A text is scored by how many of its windows lie over a calibrated threshold,
by their share and by the largest difference, through a logistic function fitted on the labelled sample.

Windows are compressed as two-byte codes of their letters, so that a match saves more than its fixed cost,
and matches are four letters long at least.  Plain samples of either kind mostly hold what both have in
common, so the samples for the toxic dictionary are the most frequent passages that toxic texts have and
ordinary texts rarely have (letter runs by their document frequencies); those for the ordinary one are the most frequent words without such runs.

Training reads at most MOST_TOXIC and MOST_ORDINARY labelled texts, those of lowest id hash, of at most
MOST_TEXT bytes each and MOST_BYTES together for either kind: bounds that don't depend on the table.  Rows
whose id has remainder 2 are held out; what the settings below were chosen by is cross-validation over the
other three remainders.  A document labelled more than once is toxic if one label says so; of several texts of
one id the first by hash is read.  Scoring reads every word of every text.  Null texts are empty; without
labels of both kinds every text has the share of toxic labels as its score, within 0.001 and 0.999.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shingles
from .common import free_names, frugal, kept, own_columns, text_of, texts_in_batches, trimmed

MOST_TOXIC, MOST_ORDINARY, MOST_TEXT, MOST_BYTES = 1500, 3000, 1 << 20, 16 << 20
#: Letters of the runs that are counted; least log ratio and G statistic of a distinctive run.
RUN, LEAST_RATIO, LEAST_G = 6, 1.6, 30.0
#: Different passages and ordinary words, the most frequent ones, that the dictionaries are trained on, each so many times.
PASSAGES, FREQUENT, REPEATED = 100, 400, 5
#: Most bytes of a dictionary (beyond what the samples need: a full one loses its best part), and the trainer's segments and what it compares, in bytes.
DICTIONARY, SEGMENT, COMPARED = 16_384, 40, 8
#: Windows whose differences a worker keeps, and their letters.
MOST_WORDS, MOST_LETTERS = 150_000, 2_500_000
PREDICT = 0.3


class Model(NamedTuple):
    toxic: bytes
    ordinary: bytes
    threshold: int
    weights: tuple[float, ...]  # of the features, the intercept last


def coded(words: list[str]) -> list[bytes]:
    """Each window as two bytes a letter: a multiplicative hash of its code point."""
    data = "".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass")
    x = np.frombuffer(data, np.uint32) * np.uint32(2654435761)
    flat = ((x >> np.uint32(13)) & np.uint32(0xFFFF)).astype("<u2").tobytes()
    ends = np.cumsum([2 * len(w) + 4 for w in words]).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def trained(samples: list[bytes]) -> bytes:
    """A dictionary that zstandard trains on the samples; where they are too few for that, the samples themselves, the last ones nearest to the end, where matches are cheapest."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY, samples, k=SEGMENT, d=COMPARED).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(reversed(samples)))[-DICTIONARY:] or b"\0" * 8


class Compressors:
    def __init__(self, model: Model) -> None:
        import zstandard

        # write_* off: only what the window itself needs is counted.
        p = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_FAST, window_log=15, hash_log=13, chain_log=12, min_match=7, search_log=1, target_length=1, write_checksum=False, write_content_size=False, write_dict_id=False)
        self.both = []
        for content in (model.ordinary, model.toxic):
            d = zstandard.ZstdCompressionDict(content or b"\0" * 8)  # with tables if it was trained
            d.precompute_compress(compression_params=p)
            self.both.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.letters = 0

    def differences(self, words: list[str]) -> np.ndarray:
        """Of distinct words; those of reasonable length are remembered."""
        if len(self.known) > MOST_WORDS or self.letters > MOST_LETTERS:
            self.clear()
        missing = [w for w in words if w not in self.known]
        ordinary, toxic = self.both
        found = dict(zip(missing, (len(ordinary(c)) - len(toxic(c)) for c in coded(missing)), strict=True))
        out = np.array([found[w] if w in found else self.known[w] for w in words], np.int64)
        self.known.update((w, d) for w, d in found.items() if len(w) <= 64)
        self.letters += sum(len(w) for w in found if len(w) <= 64)
        return out


def window_lists(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct windows, window numbers of all texts one after the other, first window of each text and one more)."""
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), "[\\n\\t\\r]", " ")
    lists = pc.split_pattern(plain, " ")
    words = pc.dictionary_encode(lists.flatten())
    first = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False), first


def features(difference: np.ndarray, first: np.ndarray, threshold: int) -> np.ndarray:
    n = np.diff(first)
    over = np.add.reduceat((difference >= threshold).astype(float), first[:-1])
    far = np.add.reduceat((difference >= threshold + 3).astype(float), first[:-1])
    most = np.maximum.reduceat(difference, first[:-1])
    return np.stack([np.log1p(over), np.log1p(100 * over / n), (over > 0).astype(float), np.log1p(far), (far > 0).astype(float), np.clip(most, 0, 20) / 10, np.log(n) / 10, np.ones(len(n))], 1)


def _runs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(letters, hash of the run at each place) of a text's words with single blanks between; 0 where a run would reach into another word."""
    x = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(x) - RUN + 1
    if n <= 0:
        return x, np.zeros(0, np.uint64)
    h, inner = np.zeros(n, np.uint64), np.zeros(n, bool)
    for k in range(RUN):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[k : n + k]
        if 0 < k < RUN - 1:
            inner |= x[k : n + k] == 32
    return x, np.where(inner, 0, shingles.mix(h))


def _frequencies(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(run, number of texts that have it)."""
    every = [np.unique(_runs(t)[1]) for t in texts]
    return np.unique(np.concatenate(every), return_counts=True)


def _distinctive(toxic: list[str], ordinary: list[str]) -> np.ndarray:
    """Runs that toxic texts have more often than ordinary ones, by the ratio of their shares and the G statistic of both counts; sorted."""
    (run, c), (other, d_) = _frequencies(toxic), _frequencies(ordinary)
    p, n = len(toxic), len(ordinary)
    often = (c >= 4) & (run != 0)
    run, c = run[often], c[often].astype(float)
    at = np.minimum(np.searchsorted(other, run), len(other) - 1)
    d = np.where(other[at] == run, d_[at], 0).astype(float)
    share = (c + d) / (p + n)
    g = np.zeros(len(run))
    for x, y in ((c, p * share), (p - c, p * (1 - share)), (d, n * share), (n - d, n * (1 - share))):
        g += np.where(x > 0, 2 * x * np.log(np.maximum(x, 1e-9) / np.maximum(y, 1e-9)), 0)
    ratio = np.log(((c + 0.5) / (p + 1)) / ((d + 0.5) / (n + 1)))
    return run[(ratio >= LEAST_RATIO) & (g >= LEAST_G)]


def _passages(text: str, told: np.ndarray) -> list[str]:
    """The text's stretches of distinctive runs."""
    x, h = _runs(text)
    at = np.flatnonzero(np.isin(h, told))
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    return [x[a : b + RUN].tobytes().decode("utf-32-le", "surrogatepass") for a, b in zip(at[[0, *(cut + 1)]], at[[*cut, len(at) - 1]], strict=True)]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * beta * np.array([1.0] * (x.shape[1] - 1) + [1e-3]))
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def train(toxic: list[str], ordinary: list[str], n_toxic: int, n_ordinary: int) -> Model:
    """From texts of either kind; the n_ are how many labelled texts of each kind there are in all."""
    if not toxic or not ordinary:
        share = n_toxic / max(1, n_toxic + n_ordinary)
        return Model(b"", b"", 1, (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))))
    p, n = len(toxic), len(ordinary)
    told = _distinctive(toxic, ordinary)
    often = lambda found, most: [x for x, _ in sorted(found, key=lambda x: (-x[1], x[0]))[:most] for _ in range(REPEATED)]
    passages = Counter(x for t in toxic for x in _passages(t, told))
    usual, found = Counter(w for t in ordinary for w in dict.fromkeys(t.lower().split())), []
    for w, c in sorted(usual.items(), key=lambda x: (-x[1], x[0])):
        if not np.isin(_runs(w)[1], told).any():
            found.append((w, c))
        if len(found) == FREQUENT:
            break
    model = Model(trained(coded(often(passages.items(), PASSAGES))), trained(coded(often(found, FREQUENT))), 1, ())
    compressors = Compressors(model)
    parts = []
    for texts in shingles.slices(pa.array([*toxic, *ordinary], pa.large_string())):
        words, number, first = window_lists(texts)
        parts.append((compressors.differences(words)[number].astype(np.int16), np.diff(first)))
    difference = np.concatenate([d for d, _ in parts])
    first = np.concatenate([[0], np.cumsum(np.concatenate([c for _, c in parts]))])
    y = np.array([1.0] * p + [0.0] * n)
    weight = np.array([n_toxic / p] * p + [n_ordinary / n] * n)
    weight = weight / weight.mean()
    best = None
    for threshold in range(2, 13):
        x = features(difference, first, threshold)
        beta = _logistic(x, y, weight)
        z = np.clip(x @ beta, -30, 30)
        loss = float((weight * (np.log1p(np.exp(z)) - y * z)).sum())
        if best is None or loss < best[0]:
            best = loss, threshold, beta
    return model._replace(threshold=best[1], weights=tuple(map(float, best[2])))


def training_texts(documents: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_ordinary: int = MOST_ORDINARY, most_text: int = MOST_TEXT, most_bytes: int = MOST_BYTES) -> tuple[list[str], list[str], int, int]:
    """Texts of both kinds outside the held-out fold, and how many labels of each kind there are."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    known = known.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("at", F.xxhash64("doc_id"))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = known.filter("toxic = 1").orderBy("at", "doc_id").limit(most_toxic).unionByName(known.filter("toxic = 0").orderBy("at", "doc_id").limit(most_ordinary))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id").filter(F.octet_length("text") <= most_text)
    rows = rows.groupBy("doc_id", "toxic", "at").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    by = W.partitionBy("toxic").orderBy("at", "doc_id")  # most_toxic and most_ordinary rows at most
    rows = rows.withColumn("upto", F.sum(F.octet_length("text").cast("long")).over(by)).filter(F.col("upto") <= most_bytes)
    got = sorted((r["toxic"], r["doc_id"], r["text"]) for r in rows.select("toxic", "doc_id", "text").collect())
    return [t for x, _, t in got if x == 1], [t for x, _, t in got if x == 0], n.get(1, 0), n.get(0, 0)


def _compressors(model: Model) -> Compressors:
    return kept(("compressors", model), lambda: Compressors(model))


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    words, number, first = window_lists(texts)
    difference = _compressors(model).differences(words)[number]
    z = features(difference, first, model.threshold) @ np.array(model.weights)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(documents: DataFrame, model: Model, name: str = "toxic_score") -> DataFrame:
    """documents' columns with one more of that name, which documents may not have."""
    columns = documents.columns
    rows = documents.select(*own_columns(documents), text_of()).toDF(*[f"c{k}" for k in range(len(columns) + 1)])  # plain names, whatever the caller's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            at = 0
            for texts in shingles.slices(batch.column(batch.num_columns - 1)):
                own = batch.slice(at, len(texts)).columns[:-1]
                yield pa.RecordBatch.from_arrays([*own, pa.array(scores(texts, model))], names=[*columns, name])
                at += len(texts)
        trimmed()

    return texts_in_batches(rows).mapInArrow(run, T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())]))


def op8(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The query: doc_id, held_out, score, predicted of every document."""
    model = train(*training_texts(documents, labels))
    rows = score(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= PREDICT).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """documents that aren't predicted toxic; the model is trained on `labelled` documents, these by default.  Other columns stay as they are, whatever their names."""
    model = train(*training_texts(documents if labelled is None else labelled, labels))
    (name,) = free_names(documents, "toxic_score")
    return score(documents, model, name).filter(F.col(name) < PREDICT).select(own_columns(documents))
