import datetime as dt

from pyspark.sql import functions as F

from rillmark.operators import diff, orphans, skew


def t(n):
    return dt.datetime(2026, 1, n)


def test_orphan_states_and_cascade(spark):
    holders = spark.createDataFrame([("A", t(1)), ("A", t(8)), ("B", t(8)), ("C", t(1)), (None, t(1))], "key string, seen timestamp")
    splits = spark.createDataFrame([("s1", "A", t(2)), ("s2", "B", t(2)), ("s3", "C", t(9)), ("s4", "Z", t(9)), ("s5", None, t(9)), ("s6", "A", None), ("s7", "Z", None)], "sid string, holder string, at timestamp")
    facts = spark.createDataFrame([("f1", "s1"), ("f2", "s3"), ("f3", None), ("f4", "s4"), ("f4", "s4")], "fid string, split string")
    leaves = spark.createDataFrame([("l1", "f2"), ("l2", "f1")], "lid string, fact string")
    g = orphans.Graph(
        {"splits": splits, "facts": facts, "leaves": leaves}, {"holders": orphans.Presence(holders, deletes=True)},
        [orphans.Reference("splits", "holder", "holders", "at")], [("facts", "split", "splits", "sid"), ("leaves", "fact", "facts", "fid")],
    )
    o = orphans.cascade(g)
    assert {(r.sid, r.orphan_state) for r in o["splits"].collect()} == {("s2", "late"), ("s3", "deleted"), ("s4", "missing"), ("s7", "missing")}
    assert sorted((r.fid, r.orphan_level) for r in o["facts"].collect()) == [("f2", 1), ("f4", 1), ("f4", 1)]
    assert {(r.lid, r.orphan_level, r.orphan_state) for r in o["leaves"].collect()} == {("l1", 2, "inherited")}
    assert set(orphans.cascade(g, {"splits"})) == {"splits"}


def test_cascade_on_a_cycle_ends(spark):
    nodes = spark.createDataFrame([("a", "b", "X"), ("b", "c", "K"), ("c", "a", "K"), ("d", "e", "K"), ("e", "d", "K")], "id string, parent string, ref string")
    g = orphans.Graph({"n": nodes}, {"keys": orphans.Presence(spark.createDataFrame([("K", t(1))], "key string, seen timestamp"))}, [orphans.Reference("n", "ref", "keys")], [("n", "parent", "n", "id")])
    got = {r.id for r in orphans.cascade(g)["n"].collect()}
    assert got == {"a", "b", "c"}


def test_orphans_of_empty_tables(spark):
    splits = spark.createDataFrame([("s", "A", t(2))], "sid string, holder string, at timestamp")
    none = spark.createDataFrame([], "key string, seen timestamp")
    g = orphans.Graph({"s": splits}, {"h": orphans.Presence(none, deletes=True)}, [orphans.Reference("s", "holder", "h", "at")])
    assert [r.orphan_state for r in orphans.cascade(g)["s"].collect()] == ["missing"]
    g.tables["s"] = splits.limit(0)
    assert orphans.cascade(g)["s"].count() == 0


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    hot = skew.hot_keys(facts, "k", 0.2, 100)
    assert hot == ["hot"]
    for how in ("left", "inner"):
        a = skew.salted_join(facts, dim, "k", how, hot=hot).select("id", "k", "v")
        b = facts.join(dim, "k", how).select("id", "k", "v")
        assert a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_differences(spark):
    s = "k string, n int, x double, y string, z string"
    nan = float("nan")
    a = spark.createDataFrame([("1", 1, 1.0, "a", "p"), ("2", 1, 1.0, None, "p"), ("3", 1, None, "a", "p"), ("4", 1, nan, "a", "p"), ("5", 1, 1.0, "a", "p"), ("5", 1, 1.0, "a", "p"), (None, 1, 1.0, "a", "p"), ("7", 1, 1.0, "A", "p")], s)
    b = spark.createDataFrame([("1", 1, 1.0 + 1e-10, "a", "q"), ("2", 2, 1.0, "", "p"), ("3", 1, 0.0, "a", "p"), ("4", 1, nan, "a", "p"), ("6", 1, 1.0, "a", "p"), (None, 1, 1.0, "b", "p"), ("7", 1, 1.0, "A ", "p")], s)
    got = {tuple(r) for r in diff.differences(a, b, ["k"], ["n", "x", "y"]).collect()}
    assert got == {("2", "differs", "n"), ("2", "differs", "y"), ("3", "differs", "x"), ("5", "only_prior", ""), ("6", "only_restated", ""), (None, "differs", "y"), ("7", "differs", "y")}
    assert diff.differences(a.limit(0), b.limit(0), ["k"], ["n"]).count() == 0
    assert {r.diff_kind for r in diff.differences(a.limit(0), b, ["k"], ["n"]).collect()} == {"only_restated"}


def test_differences_with_clashing_names(spark):
    s = "a string, b int, diff_kind string"
    x, y = spark.createDataFrame([("k", 1, "p")], s), spark.createDataFrame([("k", 2, "q")], s)
    assert [tuple(r) for r in diff.differences(x, y, ["a"], ["b"]).collect()] == [("k", "differs", "b")]
