import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from rillmark.operators import asof, history

D0 = dt.date(2026, 6, 1)


def test_in_force_against_brute_force(spark):
    rng = random.Random(3)
    ev = [(f"e{rng.randrange(6)}", D0 + dt.timedelta(days=rng.randrange(30))) for _ in range(80)] + [(None, D0), ("e1", None)]
    vs = []
    for i in range(120):
        a = rng.randrange(-10, 35)
        vs.append((f"e{rng.randrange(7)}", f"v{i % 40}", D0 + dt.timedelta(days=a), D0 + dt.timedelta(days=a + rng.randrange(-1, 15))))
    vs += [(None, "v", D0, D0 + dt.timedelta(days=3)), ("e1", "n", None, D0)] + vs[:10]
    e = spark.createDataFrame(ev, "ent string, day date").distinct()
    v = spark.createDataFrame(vs, "ent string, ver string, a date, b date").distinct()
    got = {(r.ent, r.day, r.ver, r.a) for r in asof.in_force(e, v, "ent", "day", "a", "b").collect()}
    want = {(x, d, ver, a) for x, d in set(ev) for y, ver, a, b in set(vs) if x is not None and x == y and d and a and a <= d < b}
    assert got == want and want


def test_in_force_boundaries_and_empty(spark):
    v = spark.createDataFrame([("e", "v", D0, D0 + dt.timedelta(days=2))], "ent string, ver string, a date, b date")
    e = spark.createDataFrame([("e", D0 + dt.timedelta(days=n)) for n in (-1, 0, 1, 2)], "ent string, day date")
    assert sorted((r.day - D0).days for r in asof.in_force(e, v, "ent", "day", "a", "b").collect()) == [0, 1]
    assert asof.in_force(e.limit(0), v, "ent", "day", "a", "b").count() == 0
    assert asof.in_force(e, v.limit(0), "ent", "day", "a", "b").count() == 0


def test_in_force_with_clashing_columns(spark):
    v = spark.createDataFrame([("e", "v", D0, D0 + dt.timedelta(days=2), "w")], "ent string, ver string, a date, b date, day string")
    e = spark.createDataFrame([("e", D0, "x", 7)], "ent string, day date, ver string, a int")
    r = asof.in_force(e, v, "ent", "day", "a", "b").first()
    assert (r.ver, r.ver_version, r.a, r.a_version, r.day, r.day_version) == ("x", "v", 7, D0, D0, "w")


def landings_frame(spark, seen):
    """seen: {landing: {holder: (x, y)}}"""
    rows = []
    for n, holders in seen.items():
        t = dt.datetime(2026, 1, 1) + dt.timedelta(days=7 * n)
        rows += [(h, x, y, f"run{n}", t + dt.timedelta(minutes=i)) for i, (h, (x, y)) in enumerate(sorted(holders.items()))]
        rows += rows[-1:] if holders else []
    return spark.createDataFrame(rows, "h string, x string, y string, run string, ts timestamp")


def brute_versions(seen):
    last, out = max(seen), set()
    for h in {h for s in seen.values() for h in s}:
        n = 0
        while n <= last:
            if h in seen[n]:
                k = n
                while k + 1 <= last and h in seen[k + 1] and seen[k + 1][h] == seen[n][h]:
                    k += 1
                out.add((h, *seen[n][h], n, k + 1 if k < last else None))
                n = k + 1
            else:
                n += 1
    return out


def test_history_against_brute_force(spark):
    rng = random.Random(8)
    seen = {n: {} for n in range(11)}
    seen[0]["anchor"] = ("a", "b")
    for n in range(11):
        seen[n]["anchor"] = ("a", "b")  # every landing has a row, so its time is known
        for h in range(25):
            if rng.random() < 0.75:
                prev = seen[n - 1].get(f"h{h}") if n else None
                seen[n][f"h{h}"] = prev if prev and rng.random() < 0.6 else (rng.choice("pq"), rng.choice(["r", None]))
    df = landings_frame(spark, seen)
    no = {r.run: r.no for r in history.landing_times(df, "run", "ts").collect()}
    at = {r.at: r.no for r in history.landing_times(df, "run", "ts").collect()}
    assert no["run3"] == 3
    for every in (1, 3, 4, 100):
        store = history.build_store(df, "h", ["x", "y"], "run", "ts", every)
        v = history.versions(store, "h", ["x", "y"], every).collect()
        got = {(r.h, r.x, r.y, at[r.version_from], at[r.version_to] if r.version_to else None) for r in v}
        assert got == brute_versions(seen) and len(v) == len(got)
        assert all(r.is_current == (r.version_to is None) for r in v)


def test_store_holds_patches_between_checkpoints(spark):
    seen = {n: {"a": ("1", "k"), "b": ("2" if n < 2 else "3", "k")} for n in range(4)}
    store = history.build_store(landings_frame(spark, seen), "h", ["x", "y"], "run", "ts", 4).collect()
    assert {(r.h, r.no, r.kind) for r in store} == {("a", 0, "full"), ("b", 0, "full"), ("b", 2, "patch")}
    patch = next(r for r in store if r.kind == "patch")
    assert patch.set_x and not patch.set_y and patch.x == "3" and patch.y is None


def test_history_empty_and_null_entity(spark):
    df = spark.createDataFrame([(None, "1", "2", "r", dt.datetime(2026, 1, 1))], "h string, x string, y string, run string, ts timestamp")
    for d in (df, df.limit(0)):
        assert history.versions(history.build_store(d, "h", ["x", "y"], "run", "ts"), "h", ["x", "y"]).count() == 0


def test_fold_keeps_a_patched_null(spark):
    seen = {0: {"a": ("1", "k")}, 1: {"a": (None, "k")}, 2: {"a": (None, "k")}}
    store = history.build_store(landings_frame(spark, seen), "h", ["x", "y"], "run", "ts", 10)
    rows = history.fold(store, "h", ["x", "y"], 10).orderBy("no").collect()
    assert [(r.x, r.y) for r in rows] == [("1", "k"), (None, "k")]
    assert store.select(F.max("no")).first()[0] == 1


def test_written_store_grows_landing_by_landing(spark, tmp_path):
    """Landings added one at a time give the store of all at once, and adding one reads a checkpoint and what follows it."""
    rng = random.Random(3)
    seen = {n: {f"h{h}": (rng.choice("pq"), rng.choice(["r", None])) for h in range(12) if rng.random() < 0.7} | {"anchor": ("a", "b")} for n in range(10)}
    df, every = landings_frame(spark, seen), 4
    times = {r["no"]: (r.run, r["at"]) for r in history.landing_times(df, "run", "ts").collect()}
    schema = history.store_schema(df, "h", ["x", "y"], "timestamp")
    rows = lambda d: sorted(map(str, d.select("h", "no", "at", "kind", "x", "y", "set_x", "set_y").collect()))
    path = str(tmp_path / "store")
    first = df.where(F.col("run").isin([times[n][0] for n in range(3)]))
    history.write_store(history.build_store(first, "h", ["x", "y"], "run", "ts", every), path)
    for n in range(3, 10):
        landing = df.where(F.col("run") == times[n][0])
        history.append_landing(spark, path, landing.select("h", "x", "y"), "h", ["x", "y"], n, F.lit(times[n][1]), every)
    assert rows(history.read_store(spark, path, schema)) == rows(history.build_store(df, "h", ["x", "y"], "run", "ts", every))
    since = (10 - 1) // every * every
    read = {int(f.split("no=")[1].split("/")[0]) for f in history.read_store(spark, path, schema, since).inputFiles()}
    plan = history.read_store(spark, path, schema, since)._jdf.queryExecution().executedPlan().toString()
    assert since == 8 and {8, 9} <= read and "PartitionFilters: [isnotnull(no" in plan
    v = history.versions(history.read_store(spark, path, schema), "h", ["x", "y"], every).collect()
    at = {t[1]: n for n, t in times.items()}
    assert {(r.h, r.x, r.y, at[r.version_from], at[r.version_to] if r.version_to else None) for r in v} == brute_versions(seen)
    with pytest.raises(ValueError):
        history.append_landing(spark, path, df.select("h", "x", "y"), "h", ["x", "y"], 9, F.lit(times[9][1]), every)


def test_written_store_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([("a", "1", "2", "r", dt.datetime(2026, 1, 1))], "h string, x string, y string, run string, ts timestamp").limit(0)
    path = str(tmp_path / "store")
    history.write_store(history.build_store(df, "h", ["x", "y"], "run", "ts"), path)
    assert history.versions(history.read_store(spark, path, history.store_schema(df, "h", ["x", "y"], "timestamp")), "h", ["x", "y"]).count() == 0
