"""Slowly changing dimension, type 2, one snapshot at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def start_history(current: DataFrame, key: str, check: list[str], now: Column) -> DataFrame:
    """The first snapshot as open versions."""
    return current.select(key, *check, now.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))


def scd2_apply(history: DataFrame, current: DataFrame, key: str, check: list[str], now: Column) -> DataFrame:
    """``history`` brought up to ``current`` (unique keys): changed versions are closed and opened anew, vanished keys closed, new keys opened.

    The comparison is null-safe. Applying the same snapshot again changes nothing.
    """
    open_, closed = history.where("valid_to is null"), history.where("valid_to is not null")
    cur = current.select(key, *[F.col(c).alias(f"_c_{c}") for c in check], F.lit(1).alias("_here"))
    j = open_.withColumn("_was", F.lit(1)).join(cur, key, "full_outer")
    same = F.col("_was").isNotNull() & F.col("_here").isNotNull()
    for c in check:
        same = same & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
    old = j.where("_was is not null").select(key, *check, "valid_from", F.when(~same, now).alias("valid_to"))
    new = j.where(F.col("_here").isNotNull() & ~same).select(key, *[F.col(f"_c_{c}").alias(c) for c in check], now.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    return closed.select(*old.columns).unionByName(old).unionByName(new)


def with_history(versions: DataFrame, key: str) -> DataFrame:
    """Keys with more than one version."""
    return versions.groupBy(key).agg(F.count(F.lit(1)).alias("versions")).where("versions > 1")
