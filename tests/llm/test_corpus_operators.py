"""Every operator against a plain version, on texts with nulls, ties, repeated rows and clashing columns, and on an empty table."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import chat_format, embedding_dedup, fingerprints, graphs, jaccard_join, licenses, packing, pii, sentencepieces, sharding, shingles, toxicity

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def check_fingerprints(spark, rows):
    """op1 against texts edited in Python and fingerprints of whole texts; ids may repeat only with equal texts."""
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, bucket string").repartition(3)
    got = fingerprints.op1(df).collect()
    order = sorted([(i, t or "") for i, t in rows if i is not None], key=lambda x: -x[0])
    edited = [(i, t[: len(t) - len(t) // 2] + order[(k + 1) % len(order)][1][: len(t) // 2]) for k, (i, t) in enumerate(order)]
    every = {t for _, t in order} | {t for _, t in edited}
    names = dict(enumerate(every))
    f = fingerprints.fingerprint_by(spark.createDataFrame(list(names.items()), "k long, text string"), ["k"]).select("k", fingerprints.as_string(F.col("lanes")).alias("f"))
    f = {names[r.k]: r.f for r in f.collect()}
    assert len({(x, *sorted(t.split("\n"))) for t, x in f.items()}) == len(set(f.values())) == len({tuple(sorted(t.split("\n"))) for t in f})
    want = Counter((i, len(t), sha(e), f[t], f[e]) for (i, t), (_, e) in zip(order, edited, strict=True))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got if r.doc_id is not None) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got) and len(got) == len(rows)
    return got


def test_fingerprints(spark, documents, empty, texts):
    assert fingerprints.op1(documents).count() == len(texts) and fingerprints.op1(empty).count() == 0
    once = [(i, t) for i, t, _ in texts if i is not None and sum(x[0] == i for x in texts) == 1]
    lines = [(10_000 + k, "".join("\n" if c == "g" else c for c in t or "")) for k, (_, t) in enumerate(once)]
    odd = [(-(2**62), "far away\n\n"), (20_000, "\n"), (20_001, "a\nb"), (20_002, "\n\n\n"), (20_003, "é\n😀\nx"), (20_004, "w " * 50_000 + "\n" + "v\n" * 3000)]
    got = check_fingerprints(spark, once + lines + odd)
    long = [r for r in got if r.n_chars > 800 and 100 <= r.doc_id < 10_000]
    assert np.mean([r.near_edited for r in long]) > 0.3
    check_fingerprints(spark, [(1, "alone\nin the world")])


def test_fingerprint_buckets(spark):
    """Clustered ids, one far id, one id of many rows and null ids are spread over buckets of like size, in order."""
    rows = [(k, f"text {k}\nnumber {k}") for k in range(3000)] + [(2**60, "far")] + [(5000, f"same id {k}") for k in range(3000)] + [(None, f"no id {k}") for k in range(2000)]
    base = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.xxhash64("text"))
    got = base.withColumn("bucket", fingerprints._bucket(base)).collect()
    sizes = Counter(r.bucket for r in got)
    assert len(sizes) >= 24 and max(sizes.values()) <= 3 * fingerprints.SIDE_BY_SIDE
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.h)
    ordered = sorted(got, key=key)
    assert [r.bucket for r in ordered] == sorted(r.bucket for r in got)
    out = fingerprints.op1(base.select("doc_id", "text")).collect()
    texts = [r.text for r in reversed(ordered)]
    want = Counter(sha(t[: len(t) - len(t) // 2] + texts[(k + 1) % len(texts)][: len(t) // 2]) for k, t in enumerate(texts))
    assert Counter(r.edited_sha256 for r in out) == want


def test_fingerprints_add_up(spark):
    df = spark.createDataFrame([("ab", "x y z\nb c d e"), ("ba", "b c d e\nx y z"), ("a", "x y z"), ("b", "b c d e")], "k string, text string")
    f = {r.k: r.lanes for r in fingerprints.fingerprint_by(df, ["k"]).collect()}
    assert f["ab"] == f["ba"] != f["a"]
    both = fingerprints.fingerprint_by(df, ["k"])
    a, b, ab = (both.filter(F.col("k") == k).select(F.col("lanes").alias(k)) for k in ("a", "b", "ab"))
    r = a.join(b).join(ab).select(fingerprints.combine(F.col("a"), F.col("b")).alias("sum"), fingerprints.combine(F.col("ab"), F.col("b"), -1).alias("rest"), "a", "ab").first()
    assert r.sum == r.ab and r.rest == r.a


@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", "\\", "[\\INST] <\\s>", "a<|im_end|>b<|im_sep|>", "<<SYS>> \\\\[INST]\\", "<|im_end|", "x\n\n<"])
def test_chat_round_trip(spark, text):
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "assistant", text), (1, None, None, None)], "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_turns(chat_format.canonical_turns(df))
    r = formatted.select(chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.read_loss(F.col("formatted"), F.col("loss_mask")).alias("l"), "formatted", "loss_mask").first()
    assert [tuple(x) for x in r.t] == [("", ""), ("user", text), ("assistant", text), ("assistant", text)] and r.l == text * 2
    for m in r.loss_mask:
        assert r.formatted[: m.start].endswith("<|im_sep|>") and r.formatted[m.start + m.length :].startswith("<|im_end|>")


def test_chat_layouts(spark):
    rows = ['{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 5}', '{"instruction": "a", "output": "b"}', '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}', '{"prompt": "a", "completion": "b"}', '{"odd": 1}', "no json", None]
    df = spark.createDataFrame(list(enumerate(rows)), "id long, j string")
    got = {}
    for r in chat_format.canonical_turns_json(df, "id", "j").collect():
        got.setdefault(r.record, []).append((r.turn, r.role, r.text))
    assert set(got) == {0, 1, 2, 3} and all(sorted(x) == [(0, "user", "a"), (1, "assistant", "b")] for x in got.values())
    nested = spark.sql("select 1 record, array(struct('user' role, 'hi' content)) messages, 'x' extra")
    assert chat_format.select_mapping(nested) == "messages" and chat_format.canonical_turns(nested).first().text == "hi"
    with pytest.raises(ValueError):
        chat_format.select_mapping(spark.sql("select 1 nothing"))


def test_chat_records_keep_all(spark):
    """Null fields, nulls in the first message, fields of several mappings and other types lose no record; the rest is listed."""
    rows = {
        0: ('{"prompt":"a","completion":null}', [(0, "user", "a"), (1, "assistant", "")]),
        1: ('{"messages":[{"role":"system","content":null},{"role":"user","content":"q"}]}', [(0, "system", ""), (1, "user", "q")]),
        2: ('{"prompt":"p","completion":"c","response":"r"}', [(0, "user", "p"), (1, "assistant", "c")]),
        3: ('{"messages":[{"role":"user"},{"content":"x"}],"prompt":"p"}', [(0, "user", ""), (1, "", "x")]),
        4: ('{"instruction":"i","input":"","output":[1,2]}', [(0, "system", "i"), (1, "user", ""), (2, "assistant", "[1,2]")]),
        5: ('{"prompt":"p"}', []), 6: ("no json", []), 7: (None, []),
    }
    df = spark.createDataFrame([(k, j) for k, (j, _) in rows.items()], "id long, j string")
    got = {k: [] for k in rows}
    for r in chat_format.canonical_turns_json(df, "id", "j").collect():
        got[r.record].append((r.turn, r.role, r.text))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, (_, v) in rows.items()}
    left = {r.record: r.print for r in chat_format.unmapped_json(df, "id", "j").collect()}
    assert left == {5: chat_format.fingerprint(["prompt"]), 6: chat_format.fingerprint([]), 7: chat_format.fingerprint([])}


def test_chat_odd_tables(spark):
    """Null ids and turns, ties, repeated rows, columns of other mappings' names; formatted_chars counts what is escaped."""
    rows = [(None, None, "user", "[s> </INST] <s> [INST]", "x"), (None, 1, "assistant", "a\\", "x"), (3, 1, "assistant", "tie", "x"), (3, 1, "assistant", "tie", "x"), (3, 1, "Assistant", "b", None), (4, 0, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, prompt string")
    got = {r.conv_id: r for r in chat_format.op2(df).collect()}
    assert got[None].turns_sha256 == sha("user\n[s> </INST] <s> [INST]\nassistant\na\\\n") and got[None].formatted_chars == 4 + 22 + 2 + 9 + 2 + 1 + 64
    assert got[3].turns_sha256 == sha("Assistant\nb\n" + "assistant\ntie\n" * 2) and got[3].loss_sha256 == sha("tietie") and got[4].n_turns == 1
    long = spark.createDataFrame([(1, k, "assistant", "w " * 100_000) for k in range(5)], "conv_id int, turn int, role string, text string")
    assert chat_format.op2(long).filter("conv_id = 1").first().loss_chars == 1_000_000


def test_chat_query(spark):
    df = spark.createDataFrame([(5, 0, "user", "q"), (5, 1, "assistant", "a"), (6, 0, "user", None)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.op2(df).collect()}
    assert set(got) == {-7, 5, 6} and got[5].turns_sha256 == sha("user\nq\nassistant\na\n") and got[5].loss_sha256 == sha("a") and got[6].loss_chars == 0
    assert got[-7].loss_sha256 == sha("</s>[INST] ok [/INST]") and got[-7].n_turns == 2
    assert chat_format.op2(df.limit(0)).count() == 1


def shingle_set(t):
    w = WORD.findall((t or "").translate(FOLD))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute_links(texts):
    n, sets = len(texts), [shingle_set(t) for _, t, _ in texts]
    ids = [i if i is not None else -(2**63) for i, _, _ in texts]
    links, root = [0] * n, list(ids)
    pairs = []
    for i in range(n):
        for j in range(i + 1, n):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    for _ in range(n):
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    return sorted((t if t != -(2**63) else -1, r if r != -(2**63) else -1, x) for t, r, x in zip(ids, root, links, strict=True))


@pytest.mark.parametrize("block", [256, 7])
def test_jaccard_join(documents, empty, texts, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.class_id if r.class_id is not None else -1, r.n_links) for r in jaccard_join.op3(documents).collect())
    assert got == brute_links(texts)
    if block == 256:
        assert jaccard_join.op3(empty).count() == 0


def test_one_of_each(documents, texts):
    kept = jaccard_join.one_of_each(documents)
    assert kept.columns == documents.columns
    want = Counter(r for _, r, _ in brute_links(texts))
    got = Counter(r.doc_id if r.doc_id is not None else -1 for r in kept.collect())
    assert set(got) == set(want) and all(n <= 2 for n in got.values())


@pytest.mark.parametrize("doc_id", [None, 7])
def test_near_copies_of_one_id(spark, doc_id):
    """Texts that share an id, or have none, are compared with each other as any others are."""
    words = [f"w{k}" for k in range(80)]
    near = [" ".join([*words[:-k], *[f"x{k}"] * k]) if k else " ".join(words) for k in range(3)]
    other = " ".join(f"v{k}" for k in range(60))
    texts = [(doc_id, near[0]), (doc_id, near[1]), (doc_id, near[2]), (doc_id, other), (9, near[0] + " end"), (9, other + " end"), (10, "alone in the world of all these texts")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted((r.doc_id or -1, -1 if r.class_id is None else r.class_id, r.n_links) for r in jaccard_join.op3(df).collect())
    low = doc_id or -1
    assert got == sorted([(low, low, 3)] * 3 + [(low, low, 1), (9, low, 3), (9, low, 1), (10, 10, 0)])
    kept = jaccard_join.one_of_each(df).collect()
    assert len(kept) == 3 and sum(r.text in near for r in kept) == 1 and sum(r.text == other for r in kept) == 1


def test_pruning_keeps_true_pairs():
    rng = np.random.default_rng(0)
    need = jaccard_join.needed(160)
    assert 80 < need < 128 and jaccard_join.needed(16) <= 6
    sig = np.zeros((2, 160), np.uint16)
    lost = 0
    for _ in range(2000):
        sig[1] = rng.random(160) > 0.8
        lost += not len(jaccard_join.surviving(sig, np.array([0]), np.array([1]), 0.8, 1e-6)[0])
    assert lost == 0


def test_subset_sum():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lengths = Counter(rng.integers(1, 40, rng.integers(0, 12)).tolist())
        capacity = int(rng.integers(0, 120))
        items = list(lengths.elements())
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        total, counts = packing.best_counts(lengths, capacity)
        assert total == max(s for s in sums if s <= capacity) == sum(n * c for n, c in counts.items()) and all(c <= lengths[n] for n, c in counts.items())


def test_packing(documents, empty, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.op4(documents).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for i, text, _ in texts:
        if sum(x[0] == i for x in texts) == 1:
            ids, at = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4"), 0
            for r in sorted(pieces[i], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0
    assert packing.op4(empty).count() == 0


def test_sentencepieces(documents, empty, texts):
    rows = sentencepieces.op5(documents).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    assert Counter((r.doc_id, r.decoded_sha256, r.n_chars) for r in rows) == Counter((i, sha(t or ""), len(t or "")) for i, t, _ in texts)
    assert sentencepieces.op5(empty).count() == 0


def test_viterbi_is_best():
    v = sentencepieces.load(sentencepieces.model_path())
    pieces = {v.flat[a:b].tobytes(): v.scores[k] for k, (a, b) in enumerate(zip(v.ends[:-1], v.ends[1:], strict=True)) if v.scores[k] < 0}
    for unit in (" the", " unbelievable", " naïveté", " xqzj", " 日本", " a\tb", "   x", " aaaaaaa", "\n"):
        best, chars = [0.0], unit
        for e in range(1, len(chars) + 1):
            options = [best[s] + pieces[chars[s:e].encode()] for s in range(e) if chars[s:e].encode() in pieces]
            if chars[e - 1 : e].encode() not in pieces:
                options.append(best[e - 1] + v.unknown)
            best.append(max(options))
        ids, _, score = sentencepieces.viterbi([unit.encode()], v)
        assert abs(score[0] - best[-1]) < 1e-9 and v.flat[np.concatenate([np.arange(v.ends[i], v.ends[i + 1]) for i in ids])].tobytes() == unit.encode()


def test_long_texts_without_blanks():
    """Parts of long units give the best path of the whole; stores stay small; a long text isn't slow."""
    import time

    import pyarrow as pa

    rng = np.random.default_rng(6)
    v = sentencepieces.load(sentencepieces.model_path())
    encoder = sentencepieces.Encoder(v)
    signs = [chr(c) for c in [*range(0x4E00, 0x4E80), *range(97, 123), *range(0xE0, 0xF0), 0x1F600]]
    units = ["".join(rng.choice(signs, n)) for n in (70, 200, 500)] + ["a" * 300, "日本" * 60, "the" * 90]
    for u in units:
        ids, counts, scores = encoder._viterbi([u.encode()])
        whole, _, best = sentencepieces.viterbi([u.encode()], v)
        assert abs(scores[0] - best[0]) < 1e-6 and counts[0] == len(ids) and v.flat[np.concatenate([np.arange(v.ends[i], v.ends[i + 1]) for i in ids])].tobytes() == u.encode()
    texts = ["".join(rng.choice(signs[:128], 100_000)) for _ in range(3)]
    began = time.process_time()
    ids, bounds, _ = encoder.encode(texts)
    assert time.process_time() - began < 3 * 0.9 and [encoder.decode(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == texts
    packer = packing.WordIds(packing.tokenizer_path())
    for _ in range(8):
        part = ["".join(rng.choice(signs[:128], 100_000)) for _ in range(10)]
        packer.encode(pa.array(part, pa.large_string()))
        encoder.encode(part)
        assert packer.letters <= 17_100_000 and encoder.letters <= 7_100_000
    assert len(packer.known) < 200 and sum(map(len, packer.known)) == packer.letters


def test_store_of_words_is_compact():
    """100,000 words, each new: what the store keeps is some of their letters and ids, and all ids are right, from the store too."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(3)
    words = sorted({"".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (100_000, 9))})
    texts = pa.array([" ".join(words[k : k + 500]) for k in range(0, len(words), 500)], pa.large_string())
    packer = packing.WordIds(packing.tokenizer_path())
    packer.encode(texts.slice(0, 1))
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    packer.encode(texts)
    taken = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    assert taken < 100 * len(words) and sorted(packer.known) == words
    for _ in range(2):
        got = packer.encode(texts.slice(7, 3))
        assert [g.tolist() for g in got] == [[*packer.tokenizer.encode(t.as_py(), add_special_tokens=False).ids, packing.END_ID] for t in texts.slice(7, 3)]


def test_licenses(documents, empty, texts):
    rows = licenses.op6(documents).collect()
    assert len(rows) == len(texts) and licenses.op6(empty).count() == 0
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)
    want = Counter()
    for i, t, _ in texts:
        w, at, labels = WORD.findall((t or "").translate(FOLD)), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            for k in range(len(w) - len(p) + 1):
                if w[k : k + len(p)] == p:
                    at.append(k)
                    labels.add(label)
        want[(i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))] += 1
    assert got == want
    r = next(r for r in rows if r.doc_id == 10)
    assert {"apache-2", "cc-by-nc", "mit"} <= set(r.labels.split(",")) and r.score == 1


def test_licenses_adjacent(spark):
    """A short notice hides no passage next to it; a passage hides a weaker one in the same words."""
    text = dict(reversed([x for x in licenses.TEMPLATES if len(x[1]) > 60]))
    changed = {k: text[k].replace("without", "lacking") for k in ("bsd", "mit")}
    notice = "Copyright 2020 someone. All rights reserved. "
    rows = [notice + changed["bsd"], notice + changed["mit"], "Creative Commons Attribution-NonCommercial 4.0 International License", "licensed under the GNU General Public License, version 3", None]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.op6(df).collect()}
    assert got == {0: "bsd,proprietary", 1: "mit,proprietary", 2: "cc-by-nc", 3: "gpl-3", 4: ""}


def test_licenses_repeated_grams(spark):
    """A k-gram that a text repeats is one place of the template; labels equal those of plain counting over all places of spans."""
    rows = ["general public license general public license", "the gnu affero general public license or so", "gnu affero general public", "commons attribution 4 0 international license commons attribution 4 0 x"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.op6(df).collect()}
    assert got == {0: ("", 0.0), 1: ("agpl-3", 1.0), 2: ("agpl-3", 2 / 3), 3: ("cc-by", 0.8)}


def test_shingles():
    import pyarrow as pa

    ts = ["", "A b", "c", "É1 x_y", " ", "aa bb cc"]
    w = shingles.words(pa.array(ts, pa.large_string()))
    got = [[w.data[w.starts[j] : w.ends[j]].tobytes().decode() for j in range(w.first[k], w.first[k + 1])] for k in range(len(ts))]
    assert got == [WORD.findall(t.translate(FOLD)) for t in ts]


def test_slices_of_slices():
    import pyarrow as pa

    ts = [f"Text Número {k} " * (k % 7) for k in range(300)]
    arr = pa.array(ts, pa.string()).slice(100, 150)
    parts = list(shingles.slices(arr, 500))
    assert len(parts) > 3 and [t for p in parts for t in p.to_pylist()] == ts[100:250]
    encoder = packing.WordIds(packing.tokenizer_path())
    whole = encoder.tokenizer.encode_batch(ts[100:250], add_special_tokens=False)
    assert [x.tolist() for p in parts for x in encoder.encode(p)] == [[*e.ids, 2] for e in whole]
    words, number, first = toxicity.window_lists(parts[1])
    assert [[words[j] for j in number[a:b]] for a, b in zip(first[:-1], first[1:], strict=True)] == [t.encode().lower().decode().split(" ") for t in parts[1].to_pylist()]


def test_sharding(spark, documents, empty, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/store", fan_in=2)
    with pytest.raises(ValueError):
        store.read()
    for k in range(5):
        store.append(documents.filter(F.pmod(F.xxhash64("text", "doc_id"), F.lit(5)) == k))
        store.compact()
    assert store.read().columns == documents.columns and store.read().count() == documents.count() and store.read().exceptAll(documents).isEmpty()
    assert store.version() > 5
    # A listed shard's bytes are those on disk.
    for run in store.manifest()["runs"]:
        for s in run:
            assert (tmp_path / "store" / s["path"]).stat().st_size == s["bytes"]
    with pytest.raises(Exception, match="(?i)exist"):
        store.commit([], store.manifest()["schema"], store.version() - 1)
    with pytest.raises(ValueError):
        store.append(documents.select("doc_id"))
    rows = sharding.op7(documents).collect()
    assert Counter((r.doc_id, r.text_sha256) for r in rows) == Counter((r.doc_id, None if r.text is None else sha(r.text)) for r in documents.collect()) and sharding.op7(empty).count() == 0


def test_sharding_survives(spark, documents, tmp_path):
    """A crash between write and commit, a reader of an older version, a slower writer: nothing is lost, nothing half-written is seen."""
    store = sharding.ShardStore(spark, f"file://{tmp_path}/store", fan_in=2)
    part = documents.select("doc_id", "text").limit(30)
    store.append(part)
    lost = store.write(part)  # and no commit
    (tmp_path / "store/data" / lost[0]["path"].split("/")[1] / "part-copied.parquet").write_bytes(b"half")
    assert store.read().count() == 30
    before = store.read(1)
    store.append(part)
    base = store.version()
    slow = store.write(part)
    assert store.compact() == 1 and before.count() == 30 and store.read().count() == 60
    with pytest.raises(Exception, match="(?i)exist"):
        store.commit([slow], store.manifest()["schema"], base)
    assert store.read().count() == 60
    assert store.vacuum(keep=1, grace=3600) == 0
    gone = store.vacuum(keep=1, grace=-5)
    assert gone >= 4 and store.versions() == [3] and store.read().count() == 60 and store.read().exceptAll(part).count() == 30
    assert not (tmp_path / "store" / lost[0]["path"]).exists()


def test_sharding_leaves_full_shards(spark, tmp_path):
    """Shards of target size pass through merges untouched; the rest is grouped by bytes."""
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(k, rng.bytes(2000).hex()) for k in range(400)], "doc_id long, text string")
    size = sum(s["bytes"] for s in sharding.ShardStore(spark, f"file://{tmp_path}/probe").write(df.coalesce(1)))
    store = sharding.ShardStore(spark, f"file://{tmp_path}/store", target_bytes=size, fan_in=2)
    store.append(df.coalesce(1))
    full = {s["path"] for run in store.manifest()["runs"] for s in run}
    store.append(df.repartition(8))
    assert store.compact() == 1
    now = [s for run in store.manifest()["runs"] for s in run]
    assert full <= {s["path"] for s in now} and len(now) <= 4 and store.read().count() == 800
    assert sharding.groups_of([5, 4, 3, 3, 2, 9], 10) == [[5], [0, 1], [2, 3, 4]] and sharding.groups_of([], 10) == []


def test_windows_are_coded():
    assert toxicity.coded([]) == [] and [len(c) for c in toxicity.coded(["a", "", "\u00e9x"])] == [6, 4, 8]


def test_toxicity(spark, documents, texts):
    rng = np.random.default_rng(3)
    plain = [(i, t) for i, t, _ in texts if i is not None and 100 <= i < 1000]
    rows = [(k, t, 0) for k, (_, t) in enumerate(plain * 4)]
    rows += [(k + 10_000, " ".join([*t.split()[:10], rng.choice(["scumbagge", "vileperson"]), *t.split()[10:]]), 1) for k, (_, t) in enumerate(plain * 2)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, "x"), (99_999, "", "x")], "doc_id long, text string, toxic_score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    got = toxicity.op8(docs, labels).collect()
    y = {i: y for i, _, y in rows}
    held = [(r.predicted, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y]
    assert len(got) == len(rows) + 2 and len(held) > 50 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert np.mean([a == b for a, b in held]) > 0.95
    assert {r.doc_id for r in got} >= {None, 99_999} and all(0 <= r.score <= 1 for r in got)
    none = toxicity.op8(docs, labels.limit(0)).collect()
    assert len(none) == len(rows) + 2 and toxicity.op8(docs.limit(0), labels).count() == 0


def test_toxicity_holds_out(spark):
    """Labels of the held-out fold change no score, whatever they say; repeated labels, repeated ids and a very long text are no error."""
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"], 30).tolist() + (["vileperson"] if k % 4 == 0 else []))) for k in range(400)]
    docs = spark.createDataFrame([*rows, (4, "another text of this id"), (500, "word " * 400_000 + "x" * 2_000_000)], "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    scores = []
    for flip in (False, True):
        labels = spark.createDataFrame([(k, int((k % 4 == 0) != (flip and held(k)))) for k, _ in rows] + [(8, 0), (9, None), (500, 0)], "doc_id long, toxic int")
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.op8(docs, labels).collect()))
    assert scores[0] == scores[1] and len(scores[0]) == 402
    texts = toxicity.training_texts(docs, labels, most_bytes=2000)
    assert sum(len(t) for t in texts[0]) <= 2000 and 0 < sum(len(t) for t in texts[1]) <= 2000
    assert max(len(t) for t in toxicity.training_texts(docs, labels)[1]) < 1 << 20


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 16))
    rows = [(k, base[k % 60] + rng.standard_normal(16) * 0.03 * (k % 3), k % 4 // 2) for k in range(600)]
    data = [(k, [float(np.float32(x)) for x in v], y) for k, v, y in rows]
    data += [(1000, data[0][1], 0), (1001, data[0][1], 0), (1002, None, 0), (1003, [0.0] * 16, 0), (1004, [None] * 16, 0), (1005, [float("nan")] * 16, 0), (1006, data[0][1], None), (1007, [1.0, 2.0], 0), (1008, [2.0, 4.0], 0), (1009, [], 0)]
    df = spark.createDataFrame([(*r, "x") for r in data], "vec_id long, embedding array<float>, label int, rep string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert set(got) == {r[0] for r in data}
    good = [(i, np.array(v, float), y) for i, v, y in data if v and y is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    want = {i: 0 for i in got}
    for a, (i, v, y) in enumerate(good):
        for j, w, z in good[a + 1 :]:
            if y == z and len(v) == len(w) and v @ w >= 0.98 * np.linalg.norm(v) * np.linalg.norm(w):
                want[i] += 1
                want[j] += 1
    total = sum(want.values())
    assert all(got[i].n_links <= want[i] for i in got) and sum(r.n_links for r in got.values()) >= 0.9 * total > 0
    assert all(got[i].kept and got[i].n_links == 0 for i in (1002, 1003, 1004, 1005, 1006, 1009)) and got[1008].component_id == 1007
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("vec_id", [None, 4])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_embeddings_of_one_id(spark, vec_id, kind):
    """Different vectors of one id, or without one, are told apart; labels may be text."""
    x, y = np.eye(16)[0], np.eye(16)[1]
    rows = [(vec_id, x), (vec_id, y), (5, y + 0.05 * x), (6, x + 0.05 * y), (7, x + y), (8, 3e30 * (x + y))]
    df = spark.createDataFrame([(i, [float(a) for a in v], "label") for i, v in rows], f"vec_id long, embedding array<{kind}>, label string")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embedding_dedup.near_duplicates(df).collect())
    low = {5: vec_id or 5, 6: vec_id or 6}
    assert got == sorted([(vec_id or 0, 1, vec_id or 5, vec_id is not None), (vec_id or 0, 1, vec_id or 6, vec_id is not None), (5, 1, low[5], vec_id is None), (6, 1, low[6], vec_id is None), (7, 1, 7, True), (8, 1, 7, False)])


@pytest.mark.parametrize("block", [512, 5])
def test_embeddings_in_blocks(spark, block, monkeypatch):
    """A list of any length is compared whole, whatever the size of its blocks."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "ROWS", 40)
    monkeypatch.setattr(embedding_dedup, "PAIRS", 100)
    rng = np.random.default_rng(8)
    vs = np.repeat(rng.standard_normal((3, 24)), 40, 0) + rng.standard_normal((120, 24)) * 0.09
    df = spark.createDataFrame([(k, [float(a) for a in v], k % 2) for k, v in enumerate(vs)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    unit = vs / np.linalg.norm(vs, axis=1)[:, None]
    near = (unit @ unit.T >= 0.98) & (np.arange(120)[:, None] % 2 == np.arange(120) % 2)
    want = near.sum(1) - 1
    assert all(got[k] <= want[k] for k in got) and sum(got.values()) >= 0.98 * want.sum() > 500


def luhn(s):
    return sum(x - 9 * (x > 9) for x in (int(c) * (1 + k % 2) for k, c in enumerate(reversed(s)))) % 10 == 0


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(t):
    out = []
    for k, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, t or ""):
            v, digits = m.group(), re.sub("[^0-9]", "", m.group())
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in v.split(".")) or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 10 <= len(digits) <= 15:
                out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


def test_pii_base(spark, documents, empty, texts):
    import random

    rng = random.Random(9)
    odd = ["".join(rng.choice("ab1@. -+()95_é\n") for _ in range(60)) for _ in range(300)] + ["1" * 40_000, "+" * 3000, "a." * 4000 + "@b.c", "1-" * 5000, "4111111111111111"]
    df = documents.select("doc_id", "text").unionByName(spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    got = Counter((r.doc_id, r.base_sha256) for r in pii.op10(df).collect())
    assert got == Counter((i, sha(plain_spans(t))) for i, t in [(i, t) for i, t, _ in texts] + [(10_000 + k, t) for k, t in enumerate(odd)])
    assert pii.op10(empty).count() == 0


def test_pii_terms(spark):
    rng = np.random.default_rng(4)
    rows = [(k, f"filler{rng.integers(50)} text mostly{rng.integers(20)} the Zanzibarian trader wrote to secret.person@corp.example.com about lorem{k} things", 0) for k in range(6)]
    rows += [(100 + k, f"the text has filler{k % 50} and other words that are about things mostly", 0) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h int")
    got = {r.doc_id: r for r in pii.op10(df.select("doc_id", "text")).collect()}
    for i, t, _ in rows[:6]:
        a = t.lower().index("zanzibarian")
        assert f"term:{a}:{a + 11}" in got[i].spans and f"term:{t.index('the ')}:" not in got[i].spans and got[i].n_email == 1
    assert all(got[i].spans == "" for i in range(100, 500))
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert all("[EMAIL]" in clean[i] and "Zanzibarian" not in clean[i] and "secret" not in clean[i] for i in range(6)) and clean[100] == rows[6][1]


def test_pii_units(spark):
    """Copies of a text change no count; a passage that many different texts share is support."""
    rows = [f"Zanzibarian broker{k} wrote to copied.person@corp.example.com" for k in range(3) for _ in range(200)]
    rows += [f"text{k} other{k % 7} " + "words about things " * 10 + "please ask Quillfeather at shared.person@corp.example.com for the rest" for k in range(5)]
    rows += [f"the text has filler{k % 50} and number{k} of words that ask about things please for rest" for k in range(800)]
    got = pii.op10(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    for r in (r for r in got if r.doc_id < 605):
        word = "Zanzibarian" if r.doc_id < 600 else "Quillfeather"
        a = rows[r.doc_id].index(word)
        assert f"term:{a}:{a + len(word)}" in r.spans.split(",")
    assert all(r.spans == "" for r in got if r.doc_id >= 605)


def test_pii_whole_text(spark):
    """Terms far from the entity are found, and each occurrence in a text that holds it goes, whatever its case."""
    far = "words about things " * 40
    rows = [f"ÉZanzibarİan {k} {far} write to far.person@corp.example.com {far} the éZANZIBARİAN zanzibar \U0001f600 Quillfeather{'' if k else ' '}" for k in range(4)]
    rows += [f"the text{k} words about things write zanzibar {k % 40}" for k in range(300)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.spans.split(",") for r in pii.op10(df).collect()}
    for i, t in enumerate(rows[:4]):
        want = [f"term:{m.start()}:{m.end()}" for m in re.finditer("ÉZanzibarİan|éZANZIBARİAN|Quillfeather", t)]
        assert len(want) == 3 and [s for s in got[i] if s.startswith("term")] == want
    assert all(got[i] == [""] for i in range(4, 304))
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert all("İ" not in clean[i] and "Quill" not in clean[i] and "the  zanzibar \U0001f600 " in clean[i] for i in range(4)) and clean[4] == rows[4]


def test_pii_kinds(spark):
    """A word that comes with a kind of entity discloses it, though no single entity is in two texts; shares are those of counted texts."""
    rows = [f"{k} Telefonistka on +1 017 555 {7000 + k} or so about words {'Rufnummer' if k < 3 else 'nothing'}" for k in range(9)] + ["Rufnummer without any"]
    rows += [f"the text{k} words about so nothing on or" for k in range(300)]
    df = spark.createDataFrame(list(enumerate(rows)) + [(k, None) for k in range(900, 905)], "doc_id long, text string")
    texts, n = {t or "" for t in [*rows, None]}, len({*rows, None})
    has = {t for t in texts if "+1 " in t}
    want = {}
    for w in {w.lower() for t in has for w in re.findall(r"[^\W\d_]{3,}", t)}:
        both, n_term = sum(w in re.findall(r"[^\W\d_]{3,}", t.lower()) for t in has), sum(w in re.findall(r"[^\W\d_]{3,}", t.lower()) for t in texts)
        share = np.log2(both * n / (len(has) * n_term)) / np.log2(n / len(has))
        if both >= pii.MIN_SUPPORT and share >= pii.GENERALISE:
            want[w] = share
    assert set(want) == {"telefonistka", "rufnummer"} and want["telefonistka"] >= pii.REMOVE > want["rufnummer"]
    got = {(r.h, r.term): r.share for r in pii.disclosure(pii.scan(df), pii.texts_of(df)).collect()}
    assert len(got) == 12 and all(abs(share - want[term]) < 1e-9 for (_, term), share in got.items())
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[0] == "0  on [PHONE] or so about words [TERM]" and clean[9] == rows[9] and clean[900] is None


def test_pii_many_matches(spark):
    """Thousands of matches in one text: places are right."""
    text = " ".join(f"é{k}a{k}@b.cd, 1.2.3.{k % 300}" for k in range(5000))
    r = pii.op10(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.base_sha256 == sha(plain_spans(text)) and r.n_email == 5000


def test_components(spark):
    rng = np.random.default_rng(6)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1100)]
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in graphs.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {k: v for k, v in root.items() if k in got} == got and all(root[k] == k for k in root if k not in got)
