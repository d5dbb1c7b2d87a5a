"""Helpers that the corpus operators share."""

from __future__ import annotations

import sys
import tempfile
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, one of our own on a local master, an error on a cluster."""
    there = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if there:
        return there
    if (own := spark.sparkContext.getCheckpointDir()) is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spanloom-"))
        own = spark.sparkContext.getCheckpointDir()
    return own


def checkpoint(df: DataFrame) -> DataFrame:
    """df with its lineage cut by files in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_of(name: str = "text") -> Column:
    """The column as text; null counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores before it until df has no column of that name (upper and lower case are one)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def own_columns(df: DataFrame) -> list[Column]:
    """df's columns, whatever characters their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def small_or_not(df: DataFrame, most_rows: int = 200_000, most_bytes: int = 64 << 20) -> tuple[DataFrame, bool]:
    """df marked for broadcast and True if it has few rows and bytes, else as it is and False, so that Spark joins it by a shuffle.  df is to be cheap to count (a checkpoint).

    Bytes are the sums of what its strings, binaries, arrays and maps hold, and 8 for each other value.
    """
    wide = [F.length(F.to_json(F.struct(c))) if t.startswith(("array", "map", "struct")) else F.octet_length(c) if t in ("string", "binary") else F.lit(8) for c, t in df.dtypes]
    size = sum((F.coalesce(w, F.lit(0)).cast("long") for w in wide), F.lit(0).cast("long"))
    rows, data = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    few = rows <= most_rows and data <= most_bytes
    return (F.broadcast(df) if few else df), few


def small(df: DataFrame, most_rows: int = 200_000, most_bytes: int = 64 << 20) -> DataFrame:
    """df, marked for broadcast if it has few rows and bytes."""
    return small_or_not(df, most_rows, most_bytes)[0]


def kept(key: object, make: Callable[[], object]) -> object:
    """A worker's store, kept from task to task.  A worker keeps one store: that of the next operator takes its place."""
    module = sys.modules.setdefault("_spanloom_kept", types.ModuleType("_spanloom_kept"))
    if getattr(module, "key", None) != key:
        module.key = module.own = None
        module.own = make()
        module.key = key
    return module.own


def texts_in_batches(df: DataFrame) -> DataFrame:
    """df, for mapInArrow: its session's Arrow batches are bounded by bytes, since ten thousand texts (the default) may be any size."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return df


def released() -> None:
    """A worker's store is given up: for operators that keep none."""
    if (module := sys.modules.get("_spanloom_kept")) is not None:
        module.key = module.own = None


def _libc():
    import ctypes

    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None  # another C library


def frugal() -> None:
    """A worker's memory is kept small: one thread and one arena for Arrow and the tokenizer."""
    import os

    import pyarrow as pa

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    pa.set_cpu_count(1)
    if libc := _libc():
        libc.mallopt(-8, 1)  # M_ARENA_MAX


def trimmed() -> None:
    """Memory that a worker's task has freed goes back to the machine, since the worker stays while others need it."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)
