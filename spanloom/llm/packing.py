"""Packing: token sequences filled by minimum bin slack.

Texts are tokenized and cut into pieces of at most `width` ids.  Whole pieces are sequences of their own; the
rest wait in a pool.  Each window starts from the pool's longest piece, and a subset-sum dynamic programme
over the multiset of waiting lengths (bitsets of reachable sums, one for each distinct length) finds the
multiset that fills the rest of the window closest to its capacity; counts are backtracked through the
bitsets.  What slack is left is filled by cutting a piece.  A partition's last ids fill windows whose sizes
are powers of two, which need no padding.

Every partition packs its own rows in one pass without a shuffle; the pool is bounded, and so are the words
that a worker remembers, by their number and their letters, so memory doesn't grow with the partition but
only with the longest text (a text without blanks is one word).  Sequence ids hold the partition's number, so a task that runs again gives the
same rows.  Null texts are empty: they have the end id alone.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import frugal, kept, text_of, trimmed

WIDTH, END_ID, POOL = 4096, 2, 2048
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Words whose ids a worker keeps, and their letters; beyond, it starts anew with the next slice of texts.
MOST_WORDS, MOST_LETTERS = 500_000, 16_000_000
#: Bytes of text that are worked on at a time.
SLICE = 1 << 21


def best_counts(lengths: Counter, capacity: int) -> tuple[int, dict[int, int]]:
    """The largest sum up to capacity of a sub-multiset of lengths, and how often it takes each length."""
    full, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted((x for x in lengths if 0 < x <= capacity), reverse=True):
        before = reach
        for _ in range(min(lengths[length], capacity // length)):
            grown = reach | (reach << length) & full
            if grown == reach:
                break
            reach = grown
        steps.append((length, before))
        if reach >> capacity:
            break
    total = reach.bit_length() - 1
    at, counts = total, {}
    for length, before in reversed(steps):
        while not before >> at & 1:
            counts[length] = counts.get(length, 0) + 1
            at -= length
    return total, counts


class Packer:
    """Collects pieces (doc, start, ids) and gives out rows of filled sequences."""

    def __init__(self, width: int, first_sequence: int, pool: int = POOL) -> None:
        self.width, self.sequence, self.most = width, first_sequence, pool
        self.pool: dict[int, list] = {}
        self.lengths: Counter = Counter()
        self.waiting = self.tokens = 0
        self.rows: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        n = len(ids)
        whole = n - n % self.width
        for start in range(0, whole, self.width):
            self._emit([(doc, start, ids[start : start + self.width], n)])
        if whole < n:
            self._wait((doc, whole, ids[whole:].copy() if whole else ids, n))
        while self.waiting >= self.most and self.tokens >= self.width:
            self._window(self.width)

    def finish(self) -> None:
        while self.tokens >= self.width:
            self._window(self.width)
        while self.tokens:
            self._window(1 << (self.tokens.bit_length() - 1))

    def _wait(self, piece: tuple) -> None:
        n = len(piece[2])
        self.pool.setdefault(n, []).append(piece)
        self.lengths[n] += 1
        self.waiting += 1
        self.tokens += n

    def _take(self, n: int) -> tuple:
        piece = self.pool[n].pop()
        self.lengths[n] -= 1
        if not self.lengths[n]:
            del self.lengths[n], self.pool[n]
        self.waiting -= 1
        self.tokens -= n
        return piece

    def _window(self, capacity: int) -> None:
        chosen = []
        if longest := max((x for x in self.lengths if x <= capacity), default=0):
            chosen.append(self._take(longest))
        total, counts = best_counts(self.lengths, capacity - longest)
        chosen += [self._take(n) for n, c in counts.items() for _ in range(c)]
        if slack := capacity - longest - total:
            doc, start, ids, n = self._take(min(x for x in self.lengths if x > slack))
            chosen.append((doc, start, ids[:slack], n))
            self._wait((doc, start + slack, ids[slack:], n))
        self._emit(chosen)

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, n in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), n, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1


class WordIds:
    """Ids of the texts of a batch, by way of their words: white space separates, so each word is encoded once per worker.

    The words known are one Arrow array, found by comparing whole words: a dict of as many strings takes far more memory.
    ASCII letters of texts below U+0300 are lower-cased first; there, that can't change a composition.
    Texts with the vocabulary's special strings are encoded whole.
    """

    SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.flat = np.empty(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)  # of word k: ends[k + 1]
        self.n = self.letters = 0

    @property
    def known(self) -> list[str]:
        return self.words.to_pylist()

    def _append(self, counts: np.ndarray, ids: np.ndarray) -> None:
        used = self.ends[self.n]
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while self.n + len(counts) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[used : used + len(ids)] = ids
        self.ends[self.n + 1 : self.n + len(counts) + 1] = used + np.cumsum(counts)
        self.n += len(counts)

    def _learn(self, words: list[str]) -> list[int]:
        """Ids of more words; the numbers of words in the order in which their ids were appended."""
        self.letters += sum(map(len, words))
        simple, other, parts, order = [], [], [], []
        for k, w in enumerate(words):
            m = self.SIMPLE.fullmatch(w)
            if m:
                simple.append(k)
                parts.append(2 if m[2] else 1)
            else:
                other.append(k)
        for k in range(0, len(simple), 10_000):
            some, n_parts = simple[k : k + 10_000], np.array(parts[k : k + 10_000])
            e = self.tokenizer.encode(" ".join([words[i] for i in some]), add_special_tokens=False)
            of = np.array(e.word_ids, np.int64)
            if of[-1] + 1 != n_parts.sum():
                other += some
                continue
            owner = np.repeat(np.arange(len(some)), n_parts)
            order += some
            self._append(np.bincount(owner[of], minlength=len(some)), np.array(e.ids, np.uint32))
        for k in range(0, len(other), 10_000):
            some = other[k : k + 10_000]
            ids = [e.ids for e in self.tokenizer.encode_batch([words[i] for i in some], add_special_tokens=False)]
            order += some
            self._append(np.array([len(x) for x in ids]), np.array([x for y in ids for x in y], np.uint32))
        return order

    def _places(self, words: pa.Array) -> np.ndarray:
        """The number of each of these distinct words in the store; unknown ones are learned."""
        among = pc.index_in(self.words, value_set=words)
        place, at = np.full(len(words), -1, np.int64), np.flatnonzero(pc.is_valid(among).to_numpy(zero_copy_only=False))
        place[among.drop_null().to_numpy()] = at
        if len(missing := np.flatnonzero(place < 0)):
            before = self.n
            missing = missing[self._learn(words.take(pa.array(missing)).to_pylist())]
            place[missing] = np.arange(before, self.n)
            self.words = pa.concat_arrays([self.words, words.take(pa.array(missing))])
        return place

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Little-endian ids of each text, END_ID at the end."""
        if self.n > MOST_WORDS or self.letters > MOST_LETTERS:
            self.clear()
        texts = shingles.fresh(texts)
        whole = pc.match_substring(texts, "<|")
        wide = pc.match_substring_regex(texts, "[\\x{0300}-\\x{10ffff}]")
        plain = pc.if_else(wide, texts, pc.ascii_lower(texts))
        plain = pc.replace_substring(pc.if_else(whole, pa.scalar("", pa.large_string()), plain), "\n", " ")
        lists = pc.split_pattern(plain, " ")
        coded = pc.dictionary_encode(lists.values if lists.offset == 0 else lists.flatten())
        place = self._places(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        starts = self.ends[place]
        n = self.ends[place + 1] - starts
        after = np.cumsum(n)
        ids = self.flat[np.repeat(starts - after + n, n) + np.arange(after[-1] if len(after) else 0)]
        bounds = np.concatenate([[0], after])[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])]
        out, end = [], np.array([END_ID], "<u4")
        for k, direct in enumerate(whole.to_pylist()):
            own = np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, "<u4") if direct else ids[bounds[k] : bounds[k + 1]]
            out.append(np.concatenate([own, end]).astype("<u4", copy=False))
        return out


def _word_ids(path: str) -> WordIds:
    return kept(("words", path), lambda: WordIds(path))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack(documents: DataFrame, path: str | None = None, width: int = WIDTH) -> DataFrame:
    """A row for each piece of each document."""
    path = path or tokenizer_path()
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        packer, ids_of = Packer(width, TaskContext.get().partitionId() << 40), _word_ids(path)

        def rows() -> pa.RecordBatch:
            made, packer.rows = packer.rows, []
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*made, strict=True)] or [pa.array([], pa.int64())] * len(names), names=names)

        for batch in batches:
            at = 0
            for part in shingles.slices(batch.column(1), SLICE):
                for doc, ids in zip(batch.column(0).slice(at, len(part)).to_pylist(), ids_of.encode(part), strict=True):
                    packer.add(doc, ids)
                at += len(part)
                yield rows()
        packer.finish()
        yield rows()
        trimmed()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, SCHEMA)


def op4(documents: DataFrame) -> DataFrame:
    return pack(documents)
