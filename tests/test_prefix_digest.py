"""Running sums and digests that no single task carries, against plain ones."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rillmark.operators.digest import content_digest
from rillmark.operators.prefix import running_sums


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_running_sums(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["a", "b", None]), rng.random(), rng.choice([None, 1, 2, 5])) for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    got = {r.v: (r.c, r.g) for r in running_sums(df, [F.col("v")], {"c": "n"}, ["g"], parts).collect()}
    for g in ("a", "b", None):
        total = 0
        for _, v, n in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            total += n or 0
            assert got[v] == (total, g)
    assert running_sums(df.limit(0), [F.col("v")], {"c": "n"}).count() == 0
    plan = running_sums(df, [F.col("v")], {"c": "n"})._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan and "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_digest_tree(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("x"))
    rows = sorted(hashlib.sha256(str(i).encode()).hexdigest() for i in range(5000))
    leaves: dict = {}
    for h in rows:
        leaves.setdefault(h[:3], []).append(h)
    want = hashlib.sha256("".join(hashlib.sha256("".join(v).encode()).hexdigest() for _, v in sorted(leaves.items())).encode()).hexdigest()
    r = content_digest(df, ["x"]).first()
    assert (r["rows"], r.digest) == (5000, want) and content_digest(df.repartition(7), ["x"]).first().digest == want
    assert content_digest(df.limit(4999), ["x"]).first().digest != want and content_digest(df.unionByName(df.limit(1)), ["x"]).first().digest != want
    assert tuple(content_digest(df.limit(0), ["x"]).first()) == (0, hashlib.sha256(b"").hexdigest())
    deep = [content_digest(df.repartition(n), ["x"], fan=1).first().digest for n in (2, 5)]
    assert deep[0] == deep[1]
