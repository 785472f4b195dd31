"""Streaming form of the recording-day pre-aggregation: an addition for continuous loads; the batch operator stays the reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recording_days(stream: DataFrame, key: str = "recording_msid", event: str = "listened_at", dedup: str = "listen_hash", delay: str = "2 days") -> DataFrame:
    """Listens per key and UTC day from a stream. Repeated listens within the watermark count once; rows later than ``delay`` are dropped by the engine."""
    d = stream.withColumn("_t", F.col(event).cast("timestamp")).withWatermark("_t", delay).dropDuplicatesWithinWatermark([dedup])
    g = d.groupBy(F.window("_t", "1 day"), key).agg(F.count(F.lit(1)).alias("streams"))
    return g.select(key, F.to_date("window.start").alias("listen_date"), "streams")
