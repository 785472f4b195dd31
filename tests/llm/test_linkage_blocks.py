"""Damaged titles meet their record by an undamaged artist."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rillmark.llm import linkage
from rillmark.llm.names import STOP


def test_damaged_titles_meet_by_the_whole_artist(spark):
    rows = [("typo at the end", "abba", "waterloo", "waterlop"), ("typo at the start", "abba", "waterloo", "vaterloo"), ("no whole word", "abba", "dancing queen", "dancign quene"), ("no artist", "", "waterloo", "wagon")]
    df = spark.createDataFrame(rows, "case string, a string, t string, u string")
    keys = lambda c: df.select("case", F.split("a", " ").alias("aw"), F.split(c, " ").alias("tw"), F.col("a").alias("ra"), F.regexp_replace(c, " ", "").alias("rt")).select("case", linkage.block_keys(([], [])).alias(c))
    got = {x.case: x.m for x in keys("t").join(keys("u"), "case").select("case", F.arrays_overlap("t", "u").alias("m")).collect()}
    assert got == {"typo at the end": True, "typo at the start": True, "no whole word": True, "no artist": False}


def counted(words):
    return {w for w in words if len(w) > 1 and w not in STOP}


@pytest.mark.parametrize("common", [False, True])
def test_no_pair_above_the_bound_is_missed(spark, common):
    """Against all pairs: names that share an artist word and half of the longer title's words meet, even if every word is common."""
    rng = random.Random(9)
    aw, tw = ["ab", "cd", "ef", "gh", "the"], ["love", "song", "night", "you", "sun", "a", "of"]
    names = sorted({(" ".join(rng.sample(aw, rng.randint(1, 3))), " ".join(rng.sample(tw, rng.randint(1, 5)))) for _ in range(120)})
    df = spark.createDataFrame([(i, a.split(), t.split(), a.replace(" ", ""), t.replace(" ", "")) for i, (a, t) in enumerate(names)], "i int, aw array<string>, tw array<string>, ra string, rt string")
    keys = df.select("i", F.explode(linkage.block_keys((aw, tw) if common else ([], []))).alias("k"))
    met = {tuple(r) for r in keys.join(keys.withColumnRenamed("i", "j"), "k").select("i", "j").distinct().collect()}
    missed = []
    for i, (a, t) in enumerate(names):
        for j, (b, u) in enumerate(names):
            x, y = counted(t.split()), counted(u.split())
            half = len(x & y) * 2 >= max(len(x), len(y)) > 0 and counted(a.split()) & counted(b.split())
            ends = a and a == b and (t.replace(" ", "")[:2] == u.replace(" ", "")[:2] or t.replace(" ", "")[-2:] == u.replace(" ", "")[-2:] or x & y)
            if (half or ends) and (i, j) not in met:
                missed.append((names[i], names[j]))
    assert not missed


def test_spread_blocks_and_small_batches_change_nothing(spark):
    from test_linkage import C, T, world

    cat, texts, _ = world(5, 80)
    c, t = spark.createDataFrame(cat, C), spark.createDataFrame(texts, T)
    want = {(r.text_key, r.record_key): r.posterior for r in linkage.link(t, c).collect()}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.text_key, r.record_key): r.posterior for r in linkage.link(t, c, linkage.LinkParams(hot_share=0.0, hot_least=3, salts=5)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got.keys() == want.keys() and len(want) > 200 and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_batches_hold_whole_texts():
    rng = np.random.default_rng(2)
    tid = np.sort(rng.integers(0, 12, 60))
    df = pd.DataFrame({"tid": tid, "v": np.arange(60)})
    for size in (1, 3, 7, 60):
        out = list(linkage.whole_texts(iter([df.iloc[i : i + size] for i in range(0, 60, size)] + [df.iloc[:0]])))
        assert list(pd.concat(out)["v"]) == list(range(60))
        seen: set = set()
        for b in out:
            assert not (set(b["tid"]) & seen)
            seen |= set(b["tid"])
    assert not list(linkage.whole_texts(iter([])))
