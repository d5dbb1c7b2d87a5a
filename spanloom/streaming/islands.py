"""Islands of a stream of events: an extension, since the batch operator A6 has a one-pass form.

A session window with the same gap holds the state of each open island; it is given out when the watermark passes its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_islands(events: DataFrame, keys: list[str], gap: str = "1 hour", late: str = "10 minutes", time: str = "ts") -> DataFrame:
    """(keys, start, end, n): `end` is the last event's time plus the gap."""
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    found = rows.groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"))
    return found.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
