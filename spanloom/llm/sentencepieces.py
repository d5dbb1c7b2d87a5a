"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Blanks are the whitespace marker; one is put before the text.  The best path of pieces has the highest sum
of log scores; a character that no piece covers costs the lowest score less UNKNOWN, and becomes one byte
piece for each of its bytes.  A marker character that stands in the text itself is encoded as bytes, so
decoding gives every text back.

Pieces hold blanks only at their start, and none holds a line break, so a text's best path is that of its
units (blanks with the letters after them, or a line break).  Each distinct unit is encoded once per worker,
and units of a batch advance through the trie together.  A long unit (a text without blanks) is cut at all
places that no piece reaches over, and its parts are encoded like units; one that has no such place takes a
step for each of its bytes.

A BPE vocabulary has merge ranks instead of log scores; its pieces get the log of Zipf's law, -log(rank + 1).
Null texts are empty; an empty text has no pieces.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import frugal, kept, text_of, texts_in_batches

UNKNOWN = 10.0
MARK = "▁"
#: Units that a worker keeps, and their letters; beyond, it starts anew with the next slice of texts.
MOST_UNITS, MOST_LETTERS = 400_000, 6_000_000
#: Longer units (text without blanks) are cut where no piece reaches over.
LONG = 64
UNIT = re.compile("\n| +[^ \n]*|[^ \n]+")
SCHEMA = "doc_id long, n_tokens long, ids_crc32 long, n_byte_pieces long, score double, n_chars long, decoded_sha256 string, round_trip boolean"


class Trie(NamedTuple):
    """Node t follows node s by byte b if t = base[s] + b and check[t] = s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # the piece that ends here, or -1


class Vocabulary(NamedTuple):
    trie: Trie
    scores: np.ndarray
    byte_ids: np.ndarray  # of the 256 byte pieces
    flat: np.ndarray  # the pieces' bytes one after the other; blanks for marks
    ends: np.ndarray  # of piece k: ends[k] to ends[k + 1]
    unknown: float


def build_trie(pieces: list[tuple[bytes, int]]) -> Trie:
    """Level by level; a node's children go to the first places, from the first free one on, that are free for all of them."""
    children: list[dict[int, int]] = [{}]
    ends: list[int] = [-1]
    for piece, number in pieces:
        at = 0
        for b in piece:
            if b not in children[at]:
                children[at][b] = len(children)
                children.append({})
                ends.append(-1)
            at = children[at][b]
        ends[at] = number
    size = 2 * len(children) + 1024
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used, free, tail, queue = np.zeros(size, bool), 1, 0, [(0, 0)]
    used[0] = True
    for node, slot in queue:
        if not children[node]:
            continue
        keys = np.array(sorted(children[node]))
        free += int(np.argmin(used[free : free + 4096])) if used[free] else 0
        # Nodes of several children look from near the last place that one of them found; single ones fill the gaps.
        at, place = max(free if len(keys) == 1 else max(free, tail - 1024), keys[0] + 1), 0
        if len(keys) == 1 and not used[at]:
            place = at - keys[0]
        while not place:
            if at + 8192 > len(used):
                used = np.append(used, np.zeros(len(used), bool))
                base, check, value = (np.append(x, np.full(len(x), fill, np.int32)) for x, fill in ((base, 0), (check, -1), (value, -1)))
            open_ = at + np.flatnonzero(~used[at : at + 2048]) - keys[0]
            fits = open_[~used[open_[:, None] + keys].any(1)]
            place, at = int(fits[0]) if len(fits) else 0, at + 2048
        tail = max(tail, place) if len(keys) > 1 else tail
        base[slot] = place
        slots = place + keys
        used[slots], check[slots] = True, slot
        for b, t in zip(keys.tolist(), slots.tolist(), strict=True):
            value[t] = ends[children[node][b]]
            queue.append((children[node][b], t))
    pad = 512  # so that base + byte is always inside
    return Trie(np.append(base, np.zeros(pad, np.int32)), np.append(check, np.full(pad, -1, np.int32)), np.append(value, np.full(pad, -1, np.int32)))


@functools.lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    sp = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    n = sp.get_piece_size()
    unigram = model.trainer_spec.model_type == model.trainer_spec.UNIGRAM
    byte_ids, scores, texts, pieces = np.zeros(256, np.int64), np.zeros(n), [b""] * n, []
    for k in range(n):
        if sp.is_byte(k):
            b = int(sp.id_to_piece(k)[1:-1], 16)
            byte_ids[b], texts[k] = k, bytes([b])
        elif not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k)):
            texts[k] = sp.id_to_piece(k).replace(MARK, " ").encode()
            scores[k] = sp.get_score(k) if unigram else -np.log(len(pieces) + 2.0)
            pieces.append((texts[k], k))
    if any(b"\n" in p or b" " in p.lstrip(b" ") for p, _ in pieces):
        raise ValueError("a piece holds a line break or a blank after other letters")
    return Vocabulary(build_trie(pieces), scores, byte_ids, np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), float(min(scores[k] for _, k in pieces)) - UNKNOWN)


def viterbi(units: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all units one after the other, number of ids of each unit, score of each unit).  Units of similar lengths go together."""
    lengths = np.array([len(u) for u in units])
    order = np.argsort(lengths, kind="stable")
    ids: list = [None] * len(units)
    scores = np.zeros(len(units))
    at = 0
    while at < len(order):
        n = max(1, min(50_000, int(4e6 // max(1, lengths[order[at]]))))
        some = order[at : at + n]
        some = some[lengths[some] <= max(16, 2 * lengths[some[0]])]
        _viterbi(units, some, lengths, v, ids, scores)
        at += len(some)
    counts = np.array([len(x) for x in ids], np.int64)
    return np.concatenate(ids) if ids else np.zeros(0, np.int64), counts, scores


def _viterbi(units: list[bytes], some: np.ndarray, lengths: np.ndarray, v: Vocabulary, ids: list, scores: np.ndarray) -> None:
    n, width = len(some), int(lengths[some].max())
    data = np.zeros((n, width + 1), np.int64)
    own = lengths[some]
    flat = np.frombuffer(b"".join([units[k] for k in some]), np.uint8)
    data[np.repeat(np.arange(n), own), np.arange(len(flat)) - np.repeat(np.cumsum(own) - own, own)] = flat
    best, back, piece = np.full((n, width + 1), -np.inf), np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)
    best[:, 0] = 0
    trie = v.trie
    for s in range(width):
        start = np.flatnonzero((best[:, s] > -np.inf) & (own > s))
        if not len(start):
            continue
        lead = data[start, s]
        step = np.where(lead < 0xC0, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        covered = np.zeros(len(start), bool)
        rows, node, who, e = start, np.zeros(len(start), np.int64), np.arange(len(start)), s
        while len(rows):
            to = trie.base[node] + data[rows, e]
            go = (trie.check[to] == node) & (own[rows] > e)
            rows, node, who, e = rows[go], to[go], who[go], e + 1
            found = trie.value[node]
            hit = np.flatnonzero(found >= 0)
            if len(hit):
                r, p = rows[hit], found[hit]
                covered[who[hit[step[who[hit]] == e - s]]] = True
                total = best[r, s] + v.scores[p]
                better = total > best[r, e]
                r, p = r[better], p[better]
                best[r, e], back[r, e], piece[r, e] = total[better], s, p
        if not covered.all():
            r = start[~covered]
            e_ = np.minimum(s + step[~covered], own[r])
            total = best[r, s] + v.unknown
            better = total > best[r, e_]
            r, e_ = r[better], e_[better]
            best[r, e_], back[r, e_], piece[r, e_] = total[better], s, -1
    scores[some] = best[np.arange(n), own]
    row, pos = np.arange(n), own.copy()
    found_row, found_pos, found_id = [], [], []
    while len(row):
        p, s = piece[row, pos], back[row, pos]
        known = p >= 0
        found_row.append(row[known])
        found_pos.append(s[known].astype(np.int64))
        found_id.append(p[known].astype(np.int64))
        for r, a, b in zip(row[~known], s[~known], pos[~known], strict=True):
            found_row.append(np.full(b - a, r))
            found_pos.append(np.arange(a, b))
            found_id.append(v.byte_ids[data[r, a:b]])
        row, pos = row[s > 0], s[s > 0].astype(np.int64)
    r, p, i = map(np.concatenate, (found_row, found_pos, found_id))
    o = np.lexsort((p, r))
    for k, x in zip(some, np.split(i[o], np.cumsum(np.bincount(r, minlength=n))[:-1]), strict=True):
        ids[k] = x


def parts(unit: bytes, v: Vocabulary) -> list[bytes]:
    """The unit cut wherever no piece, and no character, reaches over: its best path is that of its parts."""
    data = np.frombuffer(unit, np.uint8).astype(np.int64)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    reach = np.append(starts[1:], len(data))
    who, node, e = np.arange(len(starts)), np.zeros(len(starts), np.int64), starts
    while len(who):
        inside = e < len(data)
        who, node, e = who[inside], node[inside], e[inside]
        to = v.trie.base[node] + data[e]
        go = v.trie.check[to] == node
        who, node, e = who[go], to[go], e[go] + 1
        hit = v.trie.value[node] >= 0
        reach[who[hit]] = np.maximum(reach[who[hit]], e[hit])
    cut = starts[1:][starts[1:] >= np.maximum.accumulate(reach)[:-1]].tolist()
    return [unit[a:b] for a, b in zip([0, *cut], [*cut, len(unit)], strict=True)]


class Encoder:
    """A worker's units and their ids."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.is_byte = np.zeros(len(v.scores), bool)
        self.is_byte[v.byte_ids] = True
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.ends, self.scores, self.n = np.empty(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16), 0
        self.letters = 0

    def _viterbi(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """viterbi of the units, by way of the parts of long ones."""
        cut = [parts(u, self.v) if len(u) > LONG else [u] for u in units]
        ids, counts, scores = viterbi([p for ps in cut for p in ps], self.v)
        first = np.cumsum([0, *(len(ps) for ps in cut[:-1])]) if cut else np.zeros(0, np.int64)
        return ids, np.add.reduceat(counts, first), np.add.reduceat(scores, first)

    def _learn(self, units: list[str]) -> None:
        self.letters += sum(map(len, units))
        ids, counts, scores = self._viterbi([u.encode() for u in units])
        used, n = self.ends[self.n], len(units)
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while self.n + n + 1 > len(self.ends):
            self.ends, self.scores = np.concatenate([self.ends, np.zeros_like(self.ends)]), np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.flat[used : used + len(ids)] = ids
        self.ends[self.n + 1 : self.n + n + 1] = used + np.cumsum(counts)
        self.scores[self.n : self.n + n] = scores
        self.known.update(zip(units, range(self.n, self.n + n), strict=True))
        self.n += n

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, bounds of each text, scores)."""
        if self.n > MOST_UNITS or self.letters > MOST_LETTERS:
            self.clear()
        lists = [UNIT.findall(f" {t}") if t else [] for t in texts]
        if missing := list({u for units in lists for u in units if u not in self.known}):
            self._learn(missing)
        known = self.known
        place = np.array([known[u] for units in lists for u in units], np.int64)
        first = np.concatenate([[0], np.cumsum([len(units) for units in lists])]).astype(np.int64)
        starts = self.ends[place]
        n = self.ends[place + 1] - starts
        after = np.cumsum(n)
        ids = self.flat[np.repeat(starts - after + n, n) + np.arange(after[-1] if len(after) else 0)]
        return ids, np.concatenate([[0], after])[first], np.bincount(np.repeat(np.arange(len(texts)), np.diff(first)), self.scores[place], len(texts))

    def decode(self, ids: np.ndarray) -> str:
        """Pieces' bytes one after the other, without the blank at the start."""
        v = self.v
        starts = v.ends[ids]
        n = v.ends[ids.astype(np.int64) + 1] - starts
        after = np.cumsum(n)
        data = v.flat[np.repeat(starts - after + n, n) + np.arange(after[-1] if len(after) else 0)].tobytes()
        return data[1:].decode()


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encoder(path: str, v: Vocabulary) -> Encoder:
    return kept(("pieces", path), lambda: Encoder(v))


def op5(documents: DataFrame, path: str | None = None) -> DataFrame:
    """The query: every text is encoded, and decoded again from its ids."""
    path = path or model_path()
    shared = documents.sparkSession.sparkContext.broadcast(load(path))  # of the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        encoder = _encoder(path, shared.value)
        for batch in batches:
            at = 0
            for part in shingles.slices(batch.column(1)):
                texts = part.to_pylist()
                ids, bounds, scores = encoder.encode(texts)
                out: list[list] = [[] for _ in range(8)]
                for k, (doc, text) in enumerate(zip(batch.column(0).slice(at, len(part)).to_pylist(), texts, strict=True)):
                    own = ids[bounds[k] : bounds[k + 1]]
                    back = encoder.decode(own)
                    for column, x in zip(out, (doc, len(own), zlib.crc32(own.astype("<u4", copy=False).tobytes()), int(encoder.is_byte[own].sum()), float(scores[k]), len(back), hashlib.sha256(back.encode()).hexdigest(), back == text), strict=True):
                        column.append(x)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])
                at += len(part)

    return texts_in_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))).mapInArrow(run, SCHEMA)
