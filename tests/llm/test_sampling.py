import random

from pyspark.sql import functions as F

from rillmark.llm import sampling


def brute(rows, per_million, salt):
    import hashlib

    h = lambda k: int(hashlib.sha256(f"{salt}|{k}".encode()).hexdigest()[:15], 16)
    first = {}
    for k, b in rows:
        if k is not None and b is not None:
            first[k] = min(b, first.get(k, b))
    out = set()
    for b in set(first.values()):
        ks = sorted((h(k), k) for k, x in first.items() if x == b)
        out |= {k for _, k in ks[: -(-len(ks) * per_million // 1_000_000)]}
    return out


def rows_of(seed, batches, n=2000):
    rng = random.Random(seed)
    return [(f"k{rng.randrange(n)}" if rng.random() > 0.02 else None, f"b{rng.randrange(batches)}") for _ in range(3 * n)]


def keys(spark, rows, **kw):
    df = spark.createDataFrame(rows, "k string, b string")
    return {r.sample_key for r in sampling.frozen_sample(df, F.col("k"), F.col("b"), 30_000, "s", **kw).collect()}


def test_exact_per_batch_on_every_layout(spark):
    rows = rows_of(1, 5)
    want = brute(rows, 30_000, "s")
    assert keys(spark, rows) == want and keys(spark, rows[::-1] + rows[:100]) == want


def test_members_stay_when_batches_are_added(spark):
    rows = rows_of(2, 6)
    kept: set = set()
    for n in range(1, 7):
        now = keys(spark, [r for r in rows if r[1] < f"b{n}"])
        assert kept <= now
        kept = now


def test_large_groups_take_the_histogram_way(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"), F.col("id").cast("string").alias("key"), sampling.salted_hash(F.col("id"), "x").alias("h"))
    k = rows.groupBy("g").agg(F.expr("count(*) div 10").alias("k"))
    a = {r.key for r in sampling.bottom_k(rows, ["g"], "h", "key", k).collect()}
    b = {r.key for r in sampling.bottom_k(rows, ["g"], "h", "key", k, whole=50).collect()}
    assert a == b and len(a) == sum(r.k for r in k.collect())
    same = rows.withColumn("h", F.lit(5).cast("bigint"))  # nothing but ties
    assert sampling.bottom_k(same, ["g"], "h", "key", k, whole=50).count() == len(a)


def test_sampled_rows_and_empty(spark):
    df = spark.createDataFrame([("a", "b0", 1), ("a", "b1", 2), ("b", "b0", 3), (None, "b0", 4)], "k string, b string, h int")
    s = sampling.frozen_sample(df, F.col("k"), F.col("b"), 400_000, "s")
    rows = sampling.sampled_rows(df, F.col("k"), s, "s").collect()
    chosen = {r.sample_key for r in s.collect()}
    assert len(chosen) == 1 and {r.k for r in rows} == chosen and len(rows) == (2 if "a" in chosen else 1)
    assert sampling.frozen_sample(df.limit(0), F.col("k"), F.col("b"), 400_000, "s").count() == 0
