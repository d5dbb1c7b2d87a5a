"""The corpus operators' queries and SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, embedding_dedup, fingerprints, jaccard_join, licenses, packing, pii, sentencepieces, sharding, toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": lambda spark, d: fingerprints.op1(table(spark, d, "documents")),
    "op2_chat_formatting": lambda spark, d: chat_format.op2(table(spark, d, "conversations")),
    "op3_jaccard_join": lambda spark, d: jaccard_join.op3(table(spark, d, "documents")),
    "op4_packing": lambda spark, d: packing.op4(table(spark, d, "documents")),
    "op5_sentencepiece": lambda spark, d: sentencepieces.op5(table(spark, d, "documents")),
    "op6_licenses": lambda spark, d: licenses.op6(table(spark, d, "documents")),
    "op7_sharding": lambda spark, d: sharding.op7(table(spark, d, "documents")),
    "op8_toxicity": lambda spark, d: toxicity.op8(table(spark, d, "documents"), table(spark, d, "labels")),
    "op9_embedding_dedup": lambda spark, d: embedding_dedup.op9(table(spark, d, "embeddings")),
    "op10_pii": lambda spark, d: pii.op10(table(spark, d, "documents")),
}
ORACLES: dict[str, str] = {"op2_chat_formatting": chat_format.OP2_SQL, "op3_jaccard_join": jaccard_join.OP3_SQL, "op7_sharding": sharding.OP7_SQL, "op9_embedding_dedup": embedding_dedup.OP9_SQL}
