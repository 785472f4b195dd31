"""Attributes valid, and known, at event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def in_force(events: DataFrame, versions: DataFrame, entity: str, day: str, start: str, end: str) -> DataFrame:
    """Each event day of an entity with every version row in force on it: columns of ``events`` (entity, day) and of ``versions``.

    ``versions`` rows are in force on start <= day < end; a row that became known later must have its start moved to
    the day it was known. Method: narrow rows (entity, day) of changes and events, summed per day first; a cumulative
    count of changes over them numbers the stretches between changes, counting only stretches that hold an event; wide
    rows then meet events by equality on (entity, number). A version is repeated once for each stretch with events
    that it covers, so the join makes no row that is not a result.

    Null entity or dates, and end <= start, match nothing. Repeated events or versions give repeated rows; several
    versions in force give several rows. A column of ``versions`` that ``events`` has too, the entity aside, comes out with
    ``_version`` behind its name.
    """
    clash = [c for c in versions.columns if c != entity and c in events.columns]
    versions = versions.withColumnsRenamed({c: f"{c}_version" for c in clash})
    start, end = (f"{c}_version" if c in clash else c for c in (start, end))
    ev = events.where(F.col(entity).isNotNull() & F.col(day).isNotNull())
    vs = versions.where(F.col(entity).isNotNull() & (F.col(start) < F.col(end)))
    marks = vs.select(F.col(entity).alias("_e"), F.explode(F.array(start, end)).alias("_d"), F.lit(1).alias("_chg"), F.lit(0).alias("_evt"))
    marks = marks.unionByName(ev.select(F.col(entity).alias("_e"), F.col(day).alias("_d"), F.lit(0).alias("_chg"), F.lit(1).alias("_evt")))
    days = marks.groupBy("_e", "_d").agg(F.max("_chg").alias("_chg"), F.max("_evt").alias("_evt"))
    w = W.partitionBy("_e").orderBy("_d")
    upto, before = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(W.unboundedPreceding, -1)
    days = days.withColumn("_c", F.sum("_chg").over(upto))
    days = days.withColumn("_pc", F.max(F.when(F.col("_evt") == 1, F.col("_c"))).over(before))
    fresh = F.when((F.col("_evt") == 1) & (F.col("_pc").isNull() | (F.col("_pc") < F.col("_c"))), 1).otherwise(0)
    days = days.withColumn("_fresh", fresh)
    # _n: stretch of an event day; _before: stretches begun on earlier days
    days = days.select("_e", "_d", "_chg", "_evt", F.sum("_fresh").over(upto).alias("_n"), F.coalesce(F.sum("_fresh").over(before), F.lit(0)).alias("_before"))
    cuts = days.where("_chg = 1").select("_e", "_d", "_before")
    lo = cuts.select(F.col("_e").alias(entity), F.col("_d").alias(start), F.col("_before").alias("_lo"))
    hi = cuts.select(F.col("_e").alias(entity), F.col("_d").alias(end), F.col("_before").alias("_hi"))
    wide = vs.join(lo, [entity, start]).join(hi, [entity, end]).where("_hi > _lo")
    wide = wide.withColumn("_n", F.explode(F.sequence(F.col("_lo") + 1, F.col("_hi")))).drop("_lo", "_hi")
    stretch = days.where("_evt = 1").select(F.col("_e").alias(entity), F.col("_d").alias(day), "_n")
    numbered = ev.join(stretch, [entity, day])
    return numbered.join(wide, [entity, "_n"]).drop("_n")
