"""Schema and content checks as one-row or few-row frames of violation counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """(check, violations) for every column, in one pass."""
    a = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return a.select(F.explode(F.array(*[F.struct(F.lit(f"not_null:{c}").alias("check_name"), F.col(c).alias("violations")) for c in columns])).alias("x")).select("x.*")


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count_if(F.col("n") > 1).alias("violations")).select(F.lit("unique:" + "+".join(keys)).alias("check_name"), "violations")


def accepted(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Non-null values outside the closed vocabulary."""
    return df.agg(F.count_if(~F.col(column).isin(values)).alias("violations")).select(F.lit(f"accepted:{column}").alias("check_name"), "violations")


def relationship(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null reference has no parent."""
    p = parent.select(F.col(key).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(p, column, "left_anti").agg(F.count(F.lit(1)).alias("violations")).select(F.lit(f"relationship:{column}").alias("check_name"), "violations")


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def frozen_inputs(found: dict[str, str], policy: dict[str, str]) -> None:
    """Raise unless every identity that the policy fixes was found, and nothing else under its names."""
    off = {k: (found.get(k), v) for k, v in policy.items() if found.get(k) != v}
    if off:
        raise ValueError(f"inputs differ from what the policy froze (found, expected): {off}")
