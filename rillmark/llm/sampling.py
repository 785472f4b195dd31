"""Exact smallest-k per group without one task per group, and the sample built on it that stays when data grows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillmark.session import checkpointed

BITS, STEP = 60, 15


def salted_hash(key: Column, salt: str) -> Column:
    """60 bits of SHA-256 over salt and key as a bigint: the same on every run, layout and engine."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(salt + "|"), key.cast("string")), 256), 1, BITS // 4), 16, 10).cast("bigint")


def bottom_k(rows: DataFrame, group: list[str], h: str, key: str, k: DataFrame, whole: int = 200_000, most_large: int = 100_000) -> DataFrame:
    """The rows with the ``k`` smallest (h, key) of each group, exactly; ``k`` has (group..., k), groups without a row there give none.

    Groups of up to ``whole`` rows are ranked in a window. For the larger ones, all at once, the k-th smallest hash is
    narrowed down by histograms of 15 bits at a time until the bin that holds it has at most ``whole`` rows; bins are
    counted with map-side combine, so no task sees a large group. What is broadcast is one short row per large group, at
    most rows/whole of them; ``whole`` is raised so that there are at most ``most_large``. Equal hashes are told apart by
    ``key``, in one task when a single hash value has very many rows. ``rows`` is read several times: checkpoint it first
    if it is costly. Null group values match no row of ``k``.
    """
    sizes = checkpointed(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).join(k, group).where("k > 0"))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    whole = max(whole, -(-total // most_large))
    large = sizes.where(F.col("_n") > whole)
    w = W.partitionBy(*group).orderBy(h, key)
    rest = rows
    if not large.isEmpty():  # else their rows would be shuffled by group, only to be dropped
        rest = rows.join(F.broadcast(large.select(*group)), group, "left_anti")
    small = sizes.where(F.col("_n") <= whole)
    out = rest.join(small, group).withColumn("_r", F.row_number().over(w)).where("_r <= k").select(*rows.columns)
    if large.isEmpty():
        return out
    state, shift = large.select(*group, F.lit(0).cast("bigint").alias("_lo"), F.least("k", "_n").cast("bigint").alias("_left")), BITS
    in_bin = lambda sh: (F.col(h) >= F.col("_lo")) & (F.col(h) < F.col("_lo") + (1 << sh))
    while shift > 0:
        inside = rows.join(F.broadcast(state), group).where(in_bin(shift))
        shift -= STEP
        bins = inside.groupBy(*group, "_lo", "_left", F.shiftright(F.col(h), shift).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        # at most 2^15 bins a group
        bins = bins.withColumn("_c", F.sum("_n").over(W.partitionBy(*group).orderBy("_b")))
        hit = bins.where((F.col("_c") >= F.col("_left")) & (F.col("_c") - F.col("_n") < F.col("_left")))
        state = checkpointed(hit.select(*group, F.shiftleft(F.col("_b"), shift).alias("_lo"), (F.col("_left") - F.col("_c") + F.col("_n")).alias("_left"), "_n"))
        if (state.agg(F.max("_n")).first()[0] or 0) <= whole:
            break
        state = state.drop("_n")
    j = rows.join(F.broadcast(state.drop("_n")), group)
    below = j.where(F.col(h) < F.col("_lo")).select(*rows.columns)
    rim = j.where(in_bin(shift)).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.col("_left")).select(*rows.columns)
    return out.unionByName(below).unionByName(rim)


def frozen_sample(df: DataFrame, key: Column, batch: Column, per_million: int, salt: str) -> DataFrame:
    """(sample_key, batch, h): of each arrival batch exactly ceil(rate x distinct new keys), those with the smallest salted hashes.

    A key belongs to the first batch (in the order of ``batch``) that has it, so repeated rows go together and later
    batches add members but never remove one, as long as batches arrive in order and a batch is complete before it is
    sampled. Null keys and batches are left out. The result does not depend on row order or layout.
    """
    keys = df.select(key.alias("sample_key"), batch.alias("batch")).where("sample_key is not null and batch is not null")
    keys = keys.groupBy("sample_key").agg(F.min("batch").alias("batch")).withColumn("h", salted_hash(F.col("sample_key"), salt))
    keys = checkpointed(keys)
    n = keys.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    k = n.select("batch", F.expr(f"(n * {per_million}L + 999999L) div 1000000L").alias("k"))
    return bottom_k(keys, ["batch"], "h", "sample_key", k)


def sampled_rows(df: DataFrame, key: Column, sample: DataFrame, salt: str) -> DataFrame:
    """All rows of ``df`` whose key is in the sample. Rows above the sample's largest hash are dropped before the join, so that it moves about the sample's part of the table."""
    top = sample.select(F.max("h").alias("top")).scalar()
    d = df.withColumn("_sample_key", key).where(F.col("_sample_key").isNotNull())
    d = d.where(salted_hash(F.col("_sample_key"), salt) <= top)
    return d.join(sample.select(F.col("sample_key").alias("_sample_key")), "_sample_key", "left_semi").drop("_sample_key")
