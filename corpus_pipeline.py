"""The corpus pipeline: toxicity, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all rows that the stage before
kept, and all stages but the last return the columns of documents, whatever their names, in their order.

Null texts are empty: they aren't toxic unless empty texts are, all of them are copies of one another, and they
are packed as an end id alone; nulls stay null in the columns.  Null ids count as the smallest where the copy to
stay is chosen.  Of equal rows one stays.  An empty table gives no rows; without labels nothing is toxic.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import jaccard_join, packing, pii, toxicity
from spanloom.llm.common import shared_dir, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts to be toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document of the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def personal_data_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced in the texts."""
    return pii.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' tokens in full sequences: a row for each piece."""
    return packing.pack(docs)


STAGES = [("toxicity", toxic_out), ("ngram_jaccard", near_duplicates_out), ("pii", personal_data_out), ("packing", packed)]

#: The stages use MinHash, compression lengths and a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared folder and read by the next stage; what the next stage has read is removed once its own result is written."""
    docs, folder, before = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = f"{folder}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
                there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)
            before = path
    return docs
