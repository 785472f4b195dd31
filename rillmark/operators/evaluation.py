"""Deterministic splits, ranking quality, calibration grids and agreement with a reference label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.functions.keys import hash_bucket
from rillmark.operators.prefix import running_sums


def partition_of(key: Column, salt: str = "rillmark-dev-1", inner: str = "rillmark-cal-1") -> Column:
    """calibration, validation or holdout by two salted hash buckets; a null key is not evaluable."""
    dev = hash_bucket(F.concat(F.lit(salt + ":"), key), 100) < 80
    cal = hash_bucket(F.concat(F.lit(inner + ":"), key), 100) < 75
    return F.when(key.isNull(), "NOT_EVALUABLE").when(~dev, "holdout").when(cal, "calibration").otherwise("validation")


def auc(df: DataFrame, value: str, label: str, stratum: str, weight: str | None = None) -> DataFrame:
    """Exact area under the ROC curve per stratum, ties count one half: sum p*(n_below + n/2) / (P*N). Null values rank below all.

    ``weight``: how often a row counts, once if not given.
    Rows are grouped by value first, and the running sums are taken over ranges of values, so no task sees a stratum.
    """
    w = F.col(weight) if weight else F.lit(1)
    g = df.groupBy(stratum, value).agg(F.sum(F.when(F.col(label), w).otherwise(0)).alias("p"), F.sum(F.when(~F.col(label), w).otherwise(0)).alias("n"))
    g = running_sums(g, [F.col(value).asc_nulls_first()], {"c": "n"}, [stratum]).withColumn("b", F.col("c") - F.col("n"))
    s = g.groupBy(stratum).agg(F.sum(F.col("p") * (F.col("b") + F.col("n") * 0.5)).alias("u"), F.sum("p").alias("positives"), F.sum("n").alias("negatives"))
    return s.select(stratum, "positives", "negatives", F.round(F.try_divide(F.col("u"), F.col("positives") * F.col("negatives")), 9).alias("auc"))


KEYS = ["weight_set", "exact_threshold", "fallback_threshold", "min_margin"]


def grid(per_item: DataFrame, exact: list[float], fallback: list[float], margins: list[float]) -> DataFrame:
    """Outcomes of each (weight set, exact threshold, fallback threshold, margin) cell and stage.

    ``per_item``: weight_set, stage (EXACT_MULTI, FALLBACK_UNIQUE, FALLBACK_MULTI), score, margin (null: no rival), agrees, label_retrieved,
    label_in_catalogue and items. Items are first counted by their distinct values, so cells meet counts; a stage knows one of
    the two thresholds only, so counts meet that threshold's few cells and their sums meet the other threshold.
    """
    spark = per_item.sparkSession
    c = per_item.groupBy("weight_set", "stage", "score", "margin", "agrees", "label_retrieved", "label_in_catalogue").agg(F.sum("items").alias("w"))
    own = spark.createDataFrame([(e, t, m) for e, ts in ((True, exact), (False, fallback)) for t in ts for m in margins], "is_exact boolean, threshold double, min_margin double")
    c = c.withColumn("is_exact", F.col("stage") == "EXACT_MULTI").join(F.broadcast(own), "is_exact")  # literal rows
    ok = F.coalesce((F.col("score") >= F.col("threshold")) & (F.col("margin").isNull() | (F.col("margin") >= F.col("min_margin"))), F.lit(False))
    wrong = ok & ~F.col("agrees")
    n = lambda x: F.sum(F.when(x, F.col("w")).otherwise(0)).cast("bigint")
    g = c.groupBy("weight_set", "stage", "is_exact", "threshold", "min_margin").agg(
        F.sum("w").cast("bigint").alias("items"), n(ok).alias("accepted"), n(ok & F.col("agrees")).alias("agree"), n(wrong & F.col("label_retrieved")).alias("ranking_error"),
        n(wrong & ~F.col("label_retrieved") & F.col("label_in_catalogue")).alias("ref_not_retrieved"), n(wrong & ~F.col("label_in_catalogue")).alias("ref_not_in_snapshot"),
    )
    cells = spark.createDataFrame([(k, e if k else f, e, f) for k in (True, False) for e in exact for f in fallback], "is_exact boolean, threshold double, exact_threshold double, fallback_threshold double")
    j = g.join(F.broadcast(cells), ["is_exact", "threshold"])  # literal rows
    return j.select(*KEYS, "stage", "items", "accepted", "agree", "ranking_error", "ref_not_retrieved", "ref_not_in_snapshot")


def choose(g: DataFrame, bound: float, min_evaluable: int, stages: int = 3) -> DataFrame:
    """The one cell with most accepted among those whose worst stage keeps the disagreement bound with ``min_evaluable`` judged in every stage.

    Where none does, the one whose worst stage disagrees least, complete cells first. The bound is never relaxed silently: ``within_bound`` and ``complete`` say which.
    """
    judged = F.col("accepted") - F.col("ref_not_in_snapshot")
    d = g.withColumn("enough", judged >= min_evaluable).withColumn("rate", F.coalesce(F.try_divide(F.col("ranking_error") + F.col("ref_not_retrieved"), judged), F.lit(1.0)))
    c = d.groupBy(*KEYS).agg(F.sum("accepted").cast("bigint").alias("accepted"), F.round(F.coalesce(F.max(F.when(F.col("enough"), F.col("rate"))), F.lit(1.0)), 9).alias("worst_disagreement"), (F.count_if("enough") == stages).alias("complete"))
    c = c.withColumn("within_bound", F.col("complete") & (F.col("worst_disagreement") <= bound))
    order = [F.col("within_bound").desc(), F.col("complete").desc(), F.when(F.col("within_bound"), -F.col("accepted")).otherwise(0), "worst_disagreement", F.col("accepted").desc(), *KEYS]
    return c.orderBy(*order).limit(1)


def agreement(rows: DataFrame, by: str) -> DataFrame:
    """Per group: items, labelled, matched, agreeing; disagreements split into a wrong rank, a label not retrieved, and a label not in the catalogue."""
    m, lab = F.col("matched_recording_mbid"), F.col("label_mbid")
    both = m.isNotNull() & lab.isNotNull()
    wrong = both & (m != lab)
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("items"), F.count_if(lab.isNotNull()).alias("labelled"), F.count_if(m.isNotNull()).alias("matched"), F.count_if(both & (m == lab)).alias("agree"),
        F.count_if(wrong & F.col("label_retrieved")).alias("ranking_error"), F.count_if(wrong & ~F.col("label_retrieved") & F.col("label_in_catalogue")).alias("ref_not_retrieved"),
        F.count_if(wrong & ~F.col("label_in_catalogue")).alias("ref_not_in_snapshot"), F.round(F.try_divide(F.count_if(m.isNotNull()), F.count(F.lit(1))), 9).alias("coverage"),
    )


def weighted_quantiles(df: DataFrame, value: str, weight: str, qs: list[float]) -> DataFrame:
    """(q, value): the first value at which the cumulative weight reaches q of the total; runs over distinct values."""
    g = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.sum(weight).alias("w"))
    g = running_sums(g, [F.col(value)], {"c": "w"})
    c = g.withColumn("t", g.select(F.max("c")).scalar())
    q = F.explode(F.array(*[F.lit(x) for x in qs])).alias("q")
    return c.select(value, "c", "t", q).where(F.col("c") >= F.col("q") * F.col("t")).groupBy("q").agg(F.min(value).alias(value))
