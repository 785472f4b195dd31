"""Sweep line over half-open day intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _boundaries(df: DataFrame, keys: list[str]) -> DataFrame:
    """(+1, -1) events summed per key and day; the sum runs map-side first, so a hot key costs at most its distinct days."""
    ev = df.select(*keys, F.explode(F.array(F.struct(F.col("_from").alias("day"), F.lit(1).cast("bigint").alias("d")), F.struct(F.col("_to").alias("day"), F.lit(-1).cast("bigint").alias("d")))).alias("e"))
    return ev.groupBy(*keys, F.col("e.day").alias("day")).agg(F.sum("e.d").alias("d")).where("d <> 0")


def active_counts(df: DataFrame, key: str, item: str, start: str, end: str) -> DataFrame:
    """Per ``key`` the days on which the number of active ``item`` values changes: (key, day, active, next_day).

    An item covers each day that any of its rows covers, so its own rows are united first. Rows with a
    null key, item or date, or with end <= start, do not count. Both prefix sums run over days, never over rows.
    """
    rows = df.select(F.col(key).alias("_k"), F.col(item).alias("_i"), F.col(start).alias("_from"), F.col(end).alias("_to")).where("_k is not null and _i is not null and _from < _to")
    w = W.partitionBy("_k", "_i").orderBy("day")
    own = _boundaries(rows, ["_k", "_i"]).withColumn("n", F.sum("d").over(w.rowsBetween(W.unboundedPreceding, 0)))
    own = own.withColumn("p", F.coalesce(F.lag("n").over(w), F.lit(0)))
    turns = own.select("_k", "day", ((F.col("n") > 0).cast("bigint") - (F.col("p") > 0).cast("bigint")).alias("d")).where("d <> 0")
    days = turns.groupBy("_k", "day").agg(F.sum("d").alias("d")).where("d <> 0")
    w = W.partitionBy("_k").orderBy("day")
    return days.select(
        F.col("_k").alias(key), "day",
        F.sum("d").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("active"),
        F.lead("day").over(w).alias("next_day"),
    )


def sweep(df: DataFrame, key: str, item: str, start: str, end: str, kinds: tuple[str, ...] = ("period", "overlap", "gap")) -> DataFrame:
    """Longest runs of days per key: (case_kind, key, day_from, day_to), day_to exclusive.

    ``period``: covered by one item or more. ``overlap``: covered by two or more. ``gap``: by none, with covered days on both
    sides. Touching intervals make one period. An empty input gives no rows; repeated rows change nothing.
    """
    counts = active_counts(df, key, item, start, end)
    w = W.partitionBy(key).orderBy("day")
    level = F.least(F.col("active"), F.lit(2))
    # a row opens or closes up to one run of each kind; nothing is covered before the first
    marked = counts.select(key, "day", level.alias("lv"), F.coalesce(F.lag(level).over(w), F.lit(0)).alias("pl"))
    test = {"period": "{} >= 1", "overlap": "{} >= 2", "gap": "{} = 0"}
    opens = []
    for k in kinds:
        now, was = test[k].format("lv"), test[k].format("pl")
        opens.append(F.when(F.expr(f"({now}) <> ({was})"), F.struct(F.lit(k).alias("case_kind"), F.expr(now).alias("inside"))))
    turns = marked.select(key, "day", F.explode(F.array_compact(F.array(*opens))).alias("t")).select(key, "day", "t.*")
    runs = turns.withColumn("day_to", F.lead("day").over(W.partitionBy(key, "case_kind").orderBy("day")))
    return runs.where("inside and day_to is not null").select("case_kind", key, F.col("day").alias("day_from"), "day_to")
