"""Cascades against brute force on random graphs, and the salted plan on few rows."""

import random

import pytest
from pyspark.sql import functions as F

from rillmark.operators import orphans, ownership, skew


def brute(tables, refs, keys, links):
    """(table, row number, field) -> level, by the definition, round by round."""
    found = {}
    front = {(t, i) for t, c, p in refs for i, r in enumerate(tables[t]) if r[c] is not None and r[c] not in keys[p]}
    for t, c, p in refs:
        for i, r in enumerate(tables[t]):
            if r[c] is not None and r[c] not in keys[p]:
                found[t, i, c] = 0
    level = 0
    while front:
        level += 1
        new = set()
        for child, cc, parent, pc in links:
            bad = {tables[parent][i][pc] for t, i in front if t == parent} - {None}
            new |= {(child, i, cc) for i, r in enumerate(tables[child]) if r[cc] in bad and (child, i, cc) not in found}
        for x in new:
            found[x] = level
        front = {(t, i) for t, i, _ in new}
    return found


SHAPES = {
    "diamond": [("b", "up", "a", "id"), ("c", "up", "a", "id"), ("d", "up", "b", "id"), ("d", "up2", "c", "id")],
    "long and short way": [("b", "up", "a", "id"), ("c", "up", "b", "id"), ("d", "up", "a", "id"), ("d", "up", "c", "id")],
    "self": [("a", "up", "a", "id")],
    "cycle": [("a", "up", "b", "id"), ("b", "up", "c", "id"), ("c", "up", "a", "id"), ("a", "up2", "a", "id")],
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, shape, seed):
    rng = random.Random(f"{shape}{seed}")
    pick = lambda: rng.choice([None, *map(str, range(9))])
    tables = {t: [{"id": pick(), "up": pick(), "up2": pick(), "ref": rng.choice([None, "K", "K", "K", "K", "X"]) if t == "a" else "K"} for _ in range(14)] for t in "abcd"}
    tables["a"].append(dict(tables["a"][0]))  # a repeated row
    links = SHAPES[shape]
    schema = "id string, up string, up2 string, ref string"
    keys = orphans.Presence(spark.createDataFrame([("K", 1)], "key string, seen int"))
    g = orphans.Graph({t: spark.createDataFrame(rows, schema) for t, rows in tables.items()}, {"keys": keys}, [orphans.Reference(t, "ref", "keys") for t in "ab"], links)
    want = brute(tables, [("a", "ref", "k"), ("b", "ref", "k")], {"k": {"K"}}, links)
    out = orphans.cascade(g)
    for t in tables:
        mine = sorted(tuple(str(r[c]) for c in ("id", "up", "up2", "ref", "ref_field", "orphan_level")) for r in out[t].collect()) if t in out else []
        true = sorted(tuple(str(tables[t][i][c]) for c in ("id", "up", "up2", "ref")) + (f, str(n)) for (u, i, f), n in want.items() if u == t)
        assert mine == true, t


def test_hot_holder_is_salted_and_nothing_changes(spark):
    rows = [(f"s{i}", "HOT" if i % 3 else f"h{i % 7}", i) for i in range(600)]
    splits = spark.createDataFrame(rows, "sid string, holder string, at int")
    holders = spark.createDataFrame([("HOT", 100), ("h1", 1), ("h1", 300), ("h2", 1)], "key string, seen int")
    g = lambda least: orphans.Graph({"s": splits}, {"h": orphans.Presence(holders, deletes=True)}, [orphans.Reference("s", "holder", "h", "at")], hot_least=least)
    salted, plain = orphans.cascade(g(50))["s"], orphans.cascade(g(10**9))["s"]
    assert "_salt" in salted._jdf.queryExecution().toString() and "_salt" not in plain._jdf.queryExecution().toString()
    assert salted.count() == plain.count() > 0 and salted.exceptAll(plain).isEmpty()


def test_validity_with_a_hot_holder(spark, monkeypatch):
    rows = [(f"r{i % 40}", f"v{i % 40}", "HOT" if i % 3 else f"h{i}", 50.0) for i in range(80)]
    s = spark.createDataFrame(rows, "recording_mbid string, split_version_id string, rights_holder_id string, p double").select("*", F.col("p").cast("decimal(9,4)").alias("share_pct"), F.lit("2026-01-01").cast("date").alias("valid_from"), F.lit("9999-12-31").cast("date").alias("valid_to"))
    holders = spark.createDataFrame([("HOT",), ("h0",)], "holder_id string")
    want = ownership.sets_of(s, holders).collect()
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (0.02, 10))
    d = ownership.sets_of(s, holders)
    assert "_salt" in d._jdf.queryExecution().toString() and sorted(map(tuple, d.collect())) == sorted(map(tuple, want))
