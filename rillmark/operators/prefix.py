"""Running sums over a whole order without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillmark.session import checkpointed


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, str], by: list[str] = (), parts: int | None = None) -> DataFrame:
    """``df`` with a column ``new`` for each ``{new: summed}``: the sum over all rows up to and including this one in the given order, within ``by``.

    Rows are divided by ranges of (by, order), summed within their range, and raised by what the ranges before hold: one short
    row per range and ``by`` value it meets, at most ranges + values of them. Rows equal in the whole order stand in one range, and
    in no particular order in it, so ``order`` should tell rows apart. Nulls are 0. The ranges are written down once.
    """
    by, spark = list(by), df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = checkpointed(df.repartitionByRange(parts, *by, *order).withColumn("_range", F.spark_partition_id()))
    per = d.groupBy("_range", *by).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    per = per.select("_range", *by, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums])
    here = W.partitionBy("_range", *by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    d = d.select("*", *[F.coalesce(F.sum(c).over(here), F.lit(0)).alias(n) for n, c in sums.items()])
    on = F.col("_range") == F.col("_r2")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    per = per.select(F.col("_range").alias("_r2"), *[F.col(b).alias(f"_by_{b}") for b in by], *[f"_b_{n}" for n in sums])
    j = d.join(F.broadcast(per), on)  # a row per range and value it meets
    return j.select(*df.columns, *[(F.col(n) + F.col(f"_b_{n}")).alias(n) for n in sums])
