"""Joins that survive a key holding a large part of all rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, share: float = 0.02, least: int = 100_000) -> list:
    """Values of ``key`` that hold more than ``share`` of the rows and more than ``least`` rows.

    There can be at most 1/share of them, so the list may go to the driver. Counting is one narrow
    scan with map-side combine.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > least)
    top = counts.orderBy(F.col("_rows").desc(), key).limit(math.ceil(1 / share) if share > 0 else 1_000).collect()  # more cannot have the share
    if not top:
        return []
    n = df.count()
    return [r[0] for r in top if r["_rows"] > n * share]


def salted_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "left", salts: int = 24, spread: Column | None = None, hot: list | None = None) -> DataFrame:
    """Equi-join of many ``facts`` rows to ``dim`` with hot keys spread over ``salts`` groups.

    Only the dim rows of hot keys are repeated. ``spread`` decides a row's salt (default: a hash of
    the whole row, so equal rows go together and a re-run does the same). Without hot keys this is the plain join.
    """
    if hot is None:
        hot = hot_keys(facts, key)
    if not hot:
        return facts.join(dim, key, how)
    spread = F.xxhash64(*facts.columns) if spread is None else spread
    a = facts.withColumn("_salt", F.when(F.col(key).isin(hot), F.pmod(spread, F.lit(salts)).cast("int")).otherwise(0))
    b = dim.withColumn("_salt", F.explode(F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return a.join(b, [key, "_salt"], how).drop("_salt")
