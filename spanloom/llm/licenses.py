"""License scans by diagonal voting.

Template texts and base phrases are lists of words.  Every rolling k-gram of a document's words is joined
to the k-grams of the templates; a hit votes for the diagonal (word position minus template position).
Votes are summed by document, template and diagonal; diagonals at most MERGE apart are merged into one
span, since inserted or missing words shift the diagonal; spans are verified by the share of the
template's k-grams they hold, each place of the template counted once.  Of spans that overlap, of templates that share a k-gram, the one that
holds more k-grams hides the other.  A base phrase counts where one diagonal holds all its k-grams.

The join compares the words of a k-gram, so votes are exact.  The templates are
a fixed small table and are broadcast.  Null texts are empty; rows of one doc_id with equal texts get the
same result each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shingles
from .common import checkpoint, frugal, small, text_of, texts_in_batches

K, MERGE = 3, 3
#: Share of a template's k-grams that a span must hold.
MIN_SHARE = 0.6
#: Words that spans are met in.
STRETCH = 64
# Characters that separate words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Passages of public licenses and usual notices, and their labels.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl-3", "GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved"),
]


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.translate({c: c + 32 for c in range(65, 91)})) if w]


def template_grams(spark: SparkSession, k: int = K) -> DataFrame:
    """(t, label, base, n_grams, t_pos, gram) rows of all templates; a template of fewer than k words can't be found."""
    rows = []
    every = [(label, phrase, True) for phrase, label in BASE.items()] + [(label, text, False) for label, text in TEMPLATES]
    for t, (label, text, base) in enumerate(every):
        words = template_words(text)
        rows += [(t, label, base, len(words) - k + 1, p, words[p : p + k]) for p in range(len(words) - k + 1)]
    return spark.createDataFrame(rows, "t int, label string, base boolean, n_grams int, t_pos int, gram array<string>")


def related_templates(spark: SparkSession, k: int = K) -> DataFrame:
    """(t, o_t) of the templates that share a k-gram."""
    grams = [{tuple(w[p : p + k]) for p in range(len(w) - k + 1)} for w in map(template_words, [*BASE, *(text for _, text in TEMPLATES)])]
    return spark.createDataFrame([(a, b) for a, x in enumerate(grams) for b, y in enumerate(grams) if x & y], "t int, o_t int")


def _gram_hash(texts: list[str], k: int) -> np.ndarray:
    return np.unique(shingles.grams(shingles.words(pa.array(texts, pa.large_string())), k)[0])


def hits(documents: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, h, n_words, hits): of each text its number of words and the k-grams whose hash some template has, as (pos, words).

    Words and rolling hashes are made for whole Arrow batches; a k-gram whose hash no template has can't
    find a partner in the join, so this filter drops it before it leaves the batch, and the join then tells
    k-grams of equal hashes apart by their words and finds their template positions.
    """
    wanted = _gram_hash([*BASE, *(text for _, text in TEMPLATES)], k)
    seen = np.zeros(1 << 16, bool)
    seen[(wanted & np.uint64(0xFFFF)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            at = 0
            for texts in shingles.slices(batch.column(2)):
                w = shingles.words(texts)
                grams, first = shingles.grams(w, k)
                some = np.flatnonzero(seen[(grams & np.uint64(0xFFFF)).astype(np.int64)])
                some = some[np.isin(grams[some], wanted)]
                text = np.searchsorted(w.first, first[some], "right") - 1
                found: list[list] = [[] for _ in range(len(texts))]
                for i, t in zip(first[some].tolist(), text.tolist(), strict=True):
                    found[t].append({"pos": i - int(w.first[t]), "gram": [w.data[w.starts[j] : w.ends[j]].tobytes().decode() for j in range(i, i + k)]})
                kind = pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.list_(pa.string()))]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)), pa.array(np.diff(w.first), pa.int64()), pa.array(found, kind)], names=["doc_id", "h", "n_words", "hits"])
                at += len(texts)

    return texts_in_batches(documents).mapInArrow(run, "doc_id long, h long, n_words long, hits array<struct<pos:int,gram:array<string>>>")


def votes(found: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, h, t, label, base, n_grams, t_pos, pos): one row for each k-gram of a text and place where a template has it."""
    rows = found.select("doc_id", "h", F.explode("hits").alias("g")).select("doc_id", "h", "g.pos", "g.gram")
    return rows.join(F.broadcast(template_grams(found.sparkSession, k)), "gram").drop("gram").distinct()


def spans(found: DataFrame, merge: int = MERGE, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, h, label, base, first, share) of verified spans."""
    key = ["doc_id", "h", "t", "label", "base", "n_grams"]
    # The template's places that were met, as bits of one or more integers.
    masks = [f"m{k}" for k in range(1 + max(len(template_words(t)) for t in [*BASE, *(text for _, text in TEMPLATES)]) // 62)]
    bit = [F.bit_or(F.when(F.floor(F.col("t_pos") / 62) == k, F.expr("shiftleft(1L, t_pos % 62)")).otherwise(0)).alias(m) for k, m in enumerate(masks)]
    diagonal = found.groupBy(*key, (F.col("pos") - F.col("t_pos")).alias("diagonal")).agg(F.count("*").alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high"), *bit)
    base = diagonal.filter(F.col("base") & (F.col("n") == F.col("n_grams"))).select("doc_id", "h", "label", "base", F.col("diagonal").alias("first"), F.lit(1.0).alias("share"))
    order = W.partitionBy(*key).orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > merge).cast("int"), F.lit(1))
    merged = diagonal.filter(~F.col("base")).withColumn("new", new).withColumn("run", F.sum("new").over(order))
    merged = merged.groupBy(*key, "run").agg(*[F.bit_or(m).alias(m) for m in masks], F.min("low").alias("first"), F.max("high").alias("last"))
    merged = merged.withColumn("held", sum((F.bit_count(m) for m in masks), F.lit(0)).cast("long")).withColumn("share", F.col("held") / F.col("n_grams")).filter(F.col("share") >= min_share)
    merged = checkpoint(merged.select("doc_id", "h", "t", "run", "label", "base", "first", "last", "held", "share"))
    # A span's k-grams begin at its words first to last, so it reaches to the word last + K - 1; it is met in each stretch of words it touches.
    stretch = F.explode(F.sequence(F.floor(F.col("first") / STRETCH), F.floor((F.col("last") + K - 1) / STRETCH)))
    rows = merged.withColumn("stretch", stretch)
    other = rows.select(*[F.col(c).alias(f"o_{c}") for c in ("doc_id", "h", "t", "stretch", "first", "last", "held")])
    meets = F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & (F.col("h") == F.col("o_h")) & (F.col("stretch") == F.col("o_stretch")) & (F.col("first") <= F.col("o_last") + K - 1) & (F.col("o_first") <= F.col("last") + K - 1)
    related = F.broadcast(related_templates(found.sparkSession))
    hidden = rows.join(other, meets & (F.col("o_held") > F.col("held"))).join(related, ["t", "o_t"]).select("doc_id", "h", "t", "run").distinct()
    hidden = hidden.withColumnsRenamed({c: f"x_{c}" for c in ("doc_id", "h", "t", "run")})
    is_hidden = F.col("doc_id").eqNullSafe(F.col("x_doc_id")) & (F.col("h") == F.col("x_h")) & (F.col("t") == F.col("x_t")) & (F.col("run") == F.col("x_run"))
    kept = merged.join(hidden, is_hidden, "left_anti")
    return base.unionByName(kept.select("doc_id", "h", "label", "base", "first", "share"))


def scan(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h, n_words) of every row, and the verified spans.  Texts are read once; their hits are kept in the shared folder."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).select("doc_id", F.xxhash64("text").alias("h"), "text")
    found = checkpoint(hits(rows))
    return found.select("doc_id", "h", "n_words"), spans(votes(found))


def op6(documents: DataFrame) -> DataFrame:
    """The query.  Texts stay where they are read: what moves are votes and word counts."""
    counted, found = scan(documents)
    labels = lambda only: F.array_join(F.array_sort(F.collect_set(F.when(only, F.col("label")))), ",")
    base = F.col("base")
    each = small(checkpoint(found.groupBy("doc_id", "h").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.lit(True)).alias("labels"), F.max("share").alias("score"),
    )))
    key = each.withColumnsRenamed({"doc_id": "d", "h": "dh"})
    rows = counted.join(key, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("dh")), "left")
    return rows.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
