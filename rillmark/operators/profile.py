"""Profiles of a source: grain, duplicates, dependencies, presence, ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.functions.keys import hash_bucket

def grain(df: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Rows per key: (rows_per_key, keys, exact_duplicates, keys_differing, and per field the keys in which it differs). Nulls are a value; rows equal in every column are duplicates of the first."""
    g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_per_key"), F.count_distinct(F.struct(*df.columns)).alias("_whole"), *[F.count_distinct(F.struct(f)).alias(f"_d_{f}") for f in fields])
    differ = F.greatest(*[F.col(f"_d_{f}") for f in fields]) > 1
    return g.groupBy("rows_per_key").agg(F.count(F.lit(1)).alias("keys"), F.sum(F.col("rows_per_key") - F.col("_whole")).alias("exact_duplicates"), F.count_if(differ).alias("keys_differing"), *[F.count_if(F.col(f"_d_{f}") > 1).alias(f"differs_{f}") for f in fields])


def dependency(df: DataFrame, determinant: str, dependent: str) -> DataFrame:
    """How far ``dependent`` is a function of ``determinant``: groups by all set, none, mixed or conflicting."""
    g = df.groupBy(determinant).agg(F.count(F.lit(1)).alias("n"), F.count(dependent).alias("nn"), F.count_distinct(dependent).alias("d"))
    kind = F.when(F.col("d") > 1, "CONFLICTING").when(F.col("nn") == 0, "NONE").when(F.col("nn") < F.col("n"), "MIXED").otherwise("ALL_SET")
    return g.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows"))


def presence(df: DataFrame) -> DataFrame:
    """(column, present, blank, absent) of every column in one pass, unpivoted."""
    n = F.count(F.lit(1))
    kinds = dict(df.dtypes)
    parts = []
    for c in df.columns:
        blank = F.count_if(F.trim(F.col(c)) == "") if kinds[c] == "string" else F.lit(0).cast("bigint")
        parts.append(F.struct(F.lit(c).alias("column_name"), F.count(F.col(c)).alias("present"), blank.alias("blank"), (n - F.count(F.col(c))).alias("absent")))
    return df.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def json_inventory(df: DataFrame, column: str, deepest: int = 32) -> DataFrame:
    """(path, type, rows): paths of the JSON objects in ``column``, nested ones included, with the kind of their values; text that is not JSON counts under ''.

    ``a.b`` steps into an object, ``[]`` into an array. One level is taken apart at a time until no objects or arrays are
    left, so there are as many rounds as levels; text nested deeper than ``deepest`` is refused.
    """
    spark = df.sparkSession
    d = df.select(F.try_parse_json(F.col(column)).alias("v"))
    out = d.where("v is null").groupBy(F.lit("").alias("path"), F.lit("INVALID").alias("type")).agg(F.count(F.lit(1)).alias("rows"))
    level = d.where("v is not null").select(F.lit("").alias("path"), "v")
    for _ in range(deepest):
        inner = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).alias("e")).select(
            F.concat("path", F.when(F.col("e.key").isNull(), "[]").otherwise(F.concat(F.when(F.col("path") == "", "").otherwise("."), F.col("e.key")))).alias("path"), F.col("e.value").alias("v")
        )
        inner = inner.withColumn("type", F.regexp_extract(F.schema_of_variant("v"), r"^[A-Z]+", 0))
        out = out.unionByName(inner.groupBy("path", "type").agg(F.count(F.lit(1)).alias("rows")))
        level = inner.where(F.col("type").isin("OBJECT", "ARRAY")).select("path", "v")
        if level.isEmpty():
            return out.groupBy("path", "type").agg(F.sum("rows").alias("rows"))
    raise ValueError(f"{column} is nested deeper than {deepest} levels")


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """(value, rows): the ``n`` most frequent values, ties in the order of the value; nulls are a value."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col("rows").desc(), F.col("value").asc_nulls_first()).limit(n)


def key_space_estimate(df: DataFrame, key: Column, one_in: int = 64) -> DataFrame:
    """Distinct keys estimated from one in ``one_in`` of the hash space, with rows per key in it: largest, total and the 50th, 90th and 99th percentile."""
    s = df.where(hash_bucket(key, one_in) == 0).groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    # the percentile keeps counts of distinct sizes, of which there are few
    q = [F.expr(f"percentile_disc({p}) within group (order by n)").cast("long").alias(f"p{round(p * 100)}") for p in (0.5, 0.9, 0.99)]
    return s.agg((F.count(F.lit(1)) * one_in).alias("estimated_keys"), F.max("n").alias("largest"), F.sum("n").alias("sampled_rows"), *q)


#: fixed value: a UUID in lower case
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
#: the years in which a time is plausible, both ends included
YEARS = (2001, 2030)


def formats(df: DataFrame, uuid_columns: list[str], ts: str, start: str, end: str) -> DataFrame:
    """Counts of malformed UUIDs per column (letter case aside), of timestamps outside the half-open window, and of implausible ones."""
    cols = [F.count_if(~F.lower(c).rlike(UUID)).alias(f"bad_{c}") for c in uuid_columns]
    inside = (F.col(ts) >= F.lit(start).cast(df.schema[ts].dataType)) & (F.col(ts) < F.lit(end).cast(df.schema[ts].dataType))
    return df.agg(F.count(F.lit(1)).alias("rows"), *cols, F.count_if(inside).alias("in_period"), F.count_if(~inside).alias("out_of_period"), F.count_if(inside.isNull()).alias("unclassified"), F.count_if(~F.year(ts).between(*YEARS)).alias("implausible"))
