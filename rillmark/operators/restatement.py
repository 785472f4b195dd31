"""Publications side by side: deltas, reconciliation, cohort reprocessing, transitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCRIPT_RANGES = {
    # Code-point ranges of the scripts a cohort may name.
    "HANGUL": r"[\x{1100}-\x{11FF}\x{3130}-\x{318F}\x{AC00}-\x{D7A3}]",
    "KANA": r"[\x{3040}-\x{30FF}]",
    "CYRILLIC": r"[\x{0400}-\x{04FF}]",
    "GREEK": r"[\x{0370}-\x{03FF}]",
}


@dataclass(frozen=True)
class Cohort:
    """Closed vocabulary: texts whose named fields hold one of the scripts, with one of the failure reasons."""

    scripts: tuple[str, ...] = ("HANGUL", "KANA")
    fields: tuple[str, ...] = ("artist_name", "recording_name")
    failure_reasons: tuple[str, ...] = ()

    def predicate(self) -> Column:
        unknown = [s for s in self.scripts if s not in SCRIPT_RANGES]
        if unknown or not self.scripts or not self.fields:
            raise ValueError(f"a cohort needs known scripts and fields; unknown: {unknown}")
        hit = F.lit(False)
        for f in self.fields:
            for s in self.scripts:
                hit = hit | F.coalesce(F.col(f).rlike(SCRIPT_RANGES[s]), F.lit(False))
        return hit & F.col("failure_reason").isin(list(self.failure_reasons)) if self.failure_reasons else hit


def delta(prior: DataFrame, new: DataFrame, keys: list[str], amount: str, count: str) -> DataFrame:
    """Both publications at the delta grain, full outer: amounts zero-filled, their delta, and the kind of change."""
    a = prior.groupBy(*keys).agg(F.sum(amount).cast("decimal(38,6)").alias("pa"), F.sum(count).alias("pc"))
    b = new.groupBy(*keys).agg(F.sum(amount).cast("decimal(38,6)").alias("na"), F.sum(count).alias("nc"))
    j = a.join(b, keys, "full_outer")
    z = lambda c: F.coalesce(c, F.lit(0).cast("decimal(38,6)"))
    d = (z(F.col("na")) - z(F.col("pa"))).cast("decimal(38,6)")
    kind = F.when(F.col("pa").isNull(), "HOLDER_ADDED").when(F.col("na").isNull(), "HOLDER_REMOVED").when(d > 0, "PAYOUT_INCREASED").when(d < 0, "PAYOUT_DECREASED").otherwise("UNCHANGED")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return j.select(*keys, z(F.col("pa")).alias("prior_amount"), z(F.col("na")).alias("restated_amount"), d.alias("delta"), (zero("nc") - zero("pc")).alias("delta_count"), kind.alias("change_type"))


def reconciliation(deltas: DataFrame) -> DataFrame:
    """One row: rows and delta per kind of change, totals, and whether the deltas add up to new minus prior exactly."""
    kinds = ["HOLDER_ADDED", "HOLDER_REMOVED", "PAYOUT_INCREASED", "PAYOUT_DECREASED", "UNCHANGED"]
    zero = F.lit(0).cast("decimal(38,6)")
    cols = [F.count_if(F.col("change_type") == k).alias(f"rows_{k.lower()}") for k in kinds]
    cols += [F.sum(F.when(F.col("change_type") == k, F.col("delta")).otherwise(zero)).cast("decimal(38,6)").alias(f"delta_{k.lower()}") for k in kinds[:4]]
    t = deltas.agg(*cols, F.sum("prior_amount").cast("decimal(38,6)").alias("prior_total"), F.sum("restated_amount").cast("decimal(38,6)").alias("restated_total"), F.sum("delta").cast("decimal(38,6)").alias("delta_total"))
    return t.withColumn("reconciles", F.col("restated_total") - F.col("prior_total") == F.col("delta_total"))


def transitions(v1: DataFrame, v2: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Counts of (v1 fields, v2 fields) over the keys both have."""
    a = v1.select(key, *[F.col(f).alias(f"v1_{f}") for f in fields])
    b = v2.select(key, *[F.col(f).alias(f"v2_{f}") for f in fields])
    g = [f"v{n}_{f}" for n in (1, 2) for f in fields]
    return a.join(b, key).groupBy(*g).agg(F.count(F.lit(1)).alias("n"))


def reprocess(v1: DataFrame, cohort_keys: DataFrame, recomputed: DataFrame, key: str) -> DataFrame:
    """Cohort rows from ``recomputed``, the rest copied from ``v1``; marked by ``recording_cohort``."""
    rest = v1.join(cohort_keys, key, "left_anti").withColumn("recording_cohort", F.lit(False))
    new = recomputed.join(cohort_keys, key, "left_semi").withColumn("recording_cohort", F.lit(True))
    return new.unionByName(rest.select(*new.columns))


def changed_rows(v1: DataFrame, v2: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Keys of both sides with a null-safe difference in one of the fields."""
    b = v2.select(key, *[F.col(f).alias(f"_n_{f}") for f in fields])
    differs = F.lit(False)
    for f in fields:
        differs = differs | ~F.col(f).eqNullSafe(F.col(f"_n_{f}"))
    return v1.select(key, *fields).join(b, key).where(differs).select(key)
