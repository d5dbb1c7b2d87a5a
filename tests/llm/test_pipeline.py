import os
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from spanloom.llm import packing, queries

D = "/root/testdata/sf0.001"
#: Names that stages use inside, or might.
CLASHING = ["toxic_score", "d", "dh", "terms", "t_id", "t_h", "t_text", "t_base", "t_every", "t_d", "row", "every", "h", "base", "class_id", "n", "rep", "told", "words", "a.b", "Toxic_Score2"]


@pytest.mark.skipif(not os.path.isdir(D), reason="no driver tables")
def test_pipeline(spark):
    out = corpus_pipeline.run(spark, D)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and 0 < out.select("doc_id").distinct().count() <= spark.read.parquet(f"{D}/documents.parquet").count()


def sentence(rng, n):
    return " ".join(rng.choice(["al", "be", "ce", "di", "eo", "fu"]) + rng.choice(["ra", "so", "ti", "vu", "wo"]) + rng.choice(["", "n", "m"]) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Planted toxic words, copies, near copies, personal data, nulls and columns of clashing names."""
    rng, rows, labels = random.Random(7), [], []
    for k in range(300):
        text = sentence(rng, 60)
        if k % 5 == 0:
            w = text.split(" ")
            text = " ".join([*w[:9], "scumbagge", *w[9:]])
        rows.append((k, text))
        labels.append((k, int(k % 5 == 0)))
    for k in range(1, 40, 5):  # copies and near copies of clean texts
        rows.append((1000 + k, rows[k][1]))
        rows.append((2000 + k, rows[k][1] + " end"))
    rows += [(3000, "write to some.one@example.org or call +1 017 555 7713"), (3001, None), (3002, ""), (3003, None), (None, "a text without id that is like no other"), (3000, "write to some.one@example.org or call +1 017 555 7713")]
    path = str(tmp_path_factory.mktemp("tables"))
    names = ", ".join(f"`{c}` string" for c in CLASHING)
    extra = lambda i: tuple(f"{c}={i}" for c in CLASHING)
    spark.createDataFrame([(i, t, *extra(i)) for i, t in rows], f"doc_id long, text string, {names}").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_stages(spark, folder):
    """Each stage's decisions against the plants; extra columns come back as they were."""
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    ids = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        got = docs.collect()
        assert all(r[c] == f"{c}={r.doc_id}" for r in got for c in CLASHING)
        ids.append({r.doc_id for r in got})
    toxic = {k for k in range(0, 300, 5)}
    held = {k for k in range(300) if zlib.crc32(str(k).encode()) % 4 == 2}
    every = {i for i, _ in rows}
    assert len(toxic & ids[0]) <= 0.05 * len(toxic) and (every - toxic) <= ids[0] and len(held & toxic) > 5
    copies = {b + k for k in range(1, 40, 5) for b in (1000, 2000)}
    assert ids[1] == ids[0] - copies - {3002, 3003}
    assert ids[2] == ids[1]
    text = {r.doc_id: r.text for r in docs.collect()}
    assert text[3000] == "write to [EMAIL] or call [PHONE]" and text[3001] is None and text[1] == rows[1][1]


def test_whole_run(spark, folder):
    """The pieces of all stages together are the tokens of what the stages keep, each id once."""
    from tokenizers import Tokenizer

    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        docs = spark.createDataFrame(out.collect(), out.schema)
    t = Tokenizer.from_file(packing.tokenizer_path())
    want = {r.doc_id: len(t.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got, spans = {}, {}
    for r in corpus_pipeline.run(spark, path).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for parts in spans.values():
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0, *(n for _, n in parts[:-1])]).tolist()


def test_empty(spark, folder, tmp_path):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert corpus_pipeline.toxic_out(spark, docs, str(tmp_path)).count() == docs.count()


@pytest.mark.skipif(not os.path.isdir(D), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    """The operators' queries against their SQL on the smallest driver tables."""
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(D):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{D}/{file}'")
    got, want = queries.QUERIES[name](spark, D), con.sql(queries.ORACLES[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    row = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(row(r) for r in got.select(columns).collect()) == sorted(row(r) for r in want.project(", ".join(columns)).fetchall())
