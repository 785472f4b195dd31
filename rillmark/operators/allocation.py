"""Exact allocation of whole units by largest remainder, in integers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def largest_remainder(rows: DataFrame, group: list[str], member: str, units: str, weight: str, weight_total: int) -> DataFrame:
    """Adds floor_units, remainder, remainder_rank and allotted to ``rows`` (one per group and member).

    ``units`` (whole, equal within a group) are shared by ``weight``/``weight_total``. Each member gets the floor; what is
    missing to the group's units goes, one each, to the largest remainders, ties by member. When a group's weights add up to
    ``weight_total`` its allotments add up to its units exactly. Integers throughout: num = units*weight in decimal(38,0).
    """
    num = F.col(units).cast("decimal(19,0)") * F.col(weight).cast("decimal(19,0)")
    d = rows.withColumn("floor_units", F.expr(f"cast(floor(({units} * cast({weight} as decimal(19,0))) / {weight_total}) as bigint)"))
    d = d.withColumn("remainder", (num - F.col("floor_units").cast("decimal(19,0)") * F.lit(weight_total).cast("decimal(18,0)")).cast("bigint"))
    g = W.partitionBy(*group)
    d = d.withColumn("remainder_rank", F.row_number().over(g.orderBy(F.col("remainder").desc(), member)))
    spare: Column = F.col(units) - F.sum("floor_units").over(g)
    return d.withColumn("allotted", (F.col("floor_units") + (F.col("remainder_rank") <= spare).cast("bigint")).cast("bigint"))
