import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rillmark.operators import allocation, digest, evaluation, generator, matching, ownership, profile, restatement, scd


def test_largest_remainder_against_decimal(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for g in range(200):
        n = rng.randrange(1, 5)
        cuts = sorted(rng.sample(range(1, 1_000_000), n - 1)) if g % 3 else [333_333, 666_666][: n - 1]
        w = [b - a for a, b in zip([0, *cuts], [*cuts, 1_000_000])]
        units = rng.choice([0, 1, 7, 100, 10**12 + 1])
        exact = [Decimal(units) * x / 1_000_000 for x in w]
        floor = [int(e) for e in exact]
        order = sorted(range(len(w)), key=lambda i: (-(exact[i] - floor[i]), f"h{i}"))
        for i in order[: units - sum(floor)]:
            floor[i] += 1
        for i, x in enumerate(w):
            rows.append((f"g{g}", f"h{i}", units, x))
            want[f"g{g}", f"h{i}"] = floor[i]
    df = spark.createDataFrame(rows, "g string, m string, units long, w long")
    got = allocation.largest_remainder(df, ["g"], "m", "units", "w", 1_000_000).collect()
    assert {(r.g, r.m): r.allotted for r in got} == want


def test_decision_order(spark):
    cases = [("EXACT", 0, None, None, "NO_BLOCK_CANDIDATES"), ("EXACT", 2, None, None, "NO_BLOCK_CANDIDATES"), ("EXACT", 2, 0.5, 0.1, "BELOW_THRESHOLD"), ("FALLBACK", 1, 0.8, None, "BELOW_THRESHOLD"), ("FALLBACK", 1, 0.9, None, "ACCEPTED"), ("EXACT", 2, 0.9, 0.9, "AMBIGUOUS_TIE"), ("EXACT", 2, 0.9, 0.89, "AMBIGUOUS_TIE"), ("EXACT", 2, 0.9, 0.881, "AMBIGUOUS_TIE"), ("EXACT", 2, 0.9, 0.88, "ACCEPTED")]
    df = spark.createDataFrame(cases, "m string, n long, a double, b double, want string")
    for r in df.withColumn("got", matching.decision(F.col("m"), F.col("n"), F.col("a"), F.col("b"))).collect():
        assert r.got == r.want, r


def test_score_leaves_nulls_out(spark):
    cols = ", ".join(f"{f} double" for f in matching.FEATURES)
    df = spark.createDataFrame([(1.0,) * 7, (None,) * 7, (1.0, 0.0, None, None, None, None, None)], cols)
    got = [r[0] for r in df.select(matching.score()).collect()]
    assert got[0] == 1.0 and got[1] is None and got[2] == pytest.approx(0.1 / 1.1)


def d(n):
    return dt.date(2026, 6, n)


def test_ownership_flags_and_resolution(spark):
    far = dt.date(9999, 12, 31)
    rows = [
        ("ok", "s1", "A", "60", d(1), far), ("ok", "s1", "B", "40", d(1), far), ("off", "s2", "A", "92.5", d(1), far), ("ov", "s3", "A", "100", d(1), d(20)), ("ov", "s4", "A", "100", d(10), far),
        ("gap", "s5", "A", "100", d(1), d(5)), ("gap", "s6", "A", "100", d(10), far), ("bad", "s7", "A", "100", d(9), d(9)), ("miss", "s8", "Z", "100", d(1), far), ("orphan", "s9", "A", "100", d(1), far), ("half", "s0", "A", "100", d(10), d(20)),
    ]
    sp = spark.createDataFrame([(r, s, h, Decimal(x), a, b) for r, s, h, x, a, b in rows], "recording_mbid string, split_version_id string, rights_holder_id string, share_pct decimal(9,4), valid_from date, valid_to date")
    cat = spark.createDataFrame([(x,) for x in ("ok", "off", "ov", "gap", "bad", "miss", "half", "none")], "recording_mbid string")
    v = ownership.validity(sp, spark.createDataFrame([("A",), ("B",)], "holder_id string"), cat)
    f = {r.split_version_id: r for r in v.collect()}
    assert f["s1"].is_valid_set and f["s0"].is_valid_set
    assert f["s2"].share_sum_off and f["s3"].temporal_overlap and f["s4"].temporal_overlap and f["s5"].temporal_gap and f["s7"].invalid_interval and f["s8"].missing_holder and f["s9"].orphan_recording
    assert [k for k, r in f.items() if r.is_valid_set] and sum(r.is_valid_set for r in f.values()) == 2
    days = spark.createDataFrame([("ok", d(1), 1), ("half", d(9), 1), ("half", d(10), 1), ("half", d(19), 1), ("half", d(20), 1), ("none", d(1), 1), ("off", d(2), 1), ("ok", d(11), 1)], "recording_mbid string, listen_date date, streams long")
    rg = spark.createDataFrame([("A", d(1), d(11)), ("B", d(13), far)], "range_id string, range_from date, range_to date")
    got = {(r.recording_mbid, r.listen_date.day): r.resolution_status for r in ownership.resolution(days, v, rg).collect()}
    assert got == {("ok", 1): "RESOLVED", ("half", 9): "OWNERSHIP_GAP_FOR_DATE", ("half", 10): "RESOLVED", ("half", 19): "RESOLVED", ("half", 20): "OWNERSHIP_GAP_FOR_DATE", ("none", 1): "NO_OWNERSHIP_RECORD", ("off", 2): "DEFECTIVE_OWNERSHIP", ("ok", 11): "RANGE_GAP"}


def test_delta_and_reconciliation(spark):
    s = "k string, amount decimal(18,6), n long"
    a = spark.createDataFrame([("a", Decimal(1), 1), ("b", Decimal(2), 1), ("c", Decimal(3), 1), ("d", Decimal(4), 1)], s)
    b = spark.createDataFrame([("b", Decimal(3), 1), ("c", Decimal(1), 1), ("d", Decimal(4), 1), ("e", Decimal("0.5"), 2)], s)
    x = restatement.delta(a, b, ["k"], "amount", "n")
    assert {r.k: r.change_type for r in x.collect()} == {"a": "HOLDER_REMOVED", "b": "PAYOUT_INCREASED", "c": "PAYOUT_DECREASED", "d": "UNCHANGED", "e": "HOLDER_ADDED"}
    r = restatement.reconciliation(x).first()
    assert r.reconciles and r.delta_total == Decimal("-1.5")


def test_cohort_vocabulary_is_closed(spark):
    with pytest.raises(ValueError):
        restatement.Cohort(scripts=("KLINGON",)).predicate()
    df = spark.createDataFrame([("해", "x", "A"), ("x", None, "A"), (None, "カ", "B")], "artist_name string, recording_name string, failure_reason string")
    assert df.where(restatement.Cohort().predicate()).count() == 2 and df.where(restatement.Cohort(failure_reasons=("B",)).predicate()).count() == 1


def test_auc_with_ties_and_nulls(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y"]), rng.choice([None, 0.1, 0.2, 0.3, 0.4]), rng.random() < 0.4) for _ in range(300)]
    got = {r.s: r.auc for r in evaluation.auc(spark.createDataFrame(rows, "s string, v double, l boolean"), "v", "l", "s").collect()}
    for s in "xy":
        key = lambda v: -1 if v is None else v
        p, n = [key(v) for k, v, la in rows if k == s and la], [key(v) for k, v, la in rows if k == s and not la]
        assert got[s] == pytest.approx(sum((a > b) + 0.5 * (a == b) for a in p for b in n) / len(p) / len(n), abs=1e-8)


def test_split_is_stable_and_null_is_not_evaluable(spark):
    df = spark.createDataFrame([(None,), *[(f"m{i}",) for i in range(2000)]], "m string").withColumn("p", evaluation.partition_of(F.col("m")))
    n = {r.p: r["count"] for r in df.groupBy("p").count().collect()}
    assert n["NOT_EVALUABLE"] == 1 and abs(n["holdout"] - 400) < 80 and abs(n["calibration"] - 1200) < 120


def test_scd2(spark):
    t1, t2, t3 = (F.lit(f"2026-0{i}-01").cast("timestamp") for i in (1, 2, 3))
    s = "k string, x string"
    one, two = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None)], s), spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1")], s)
    h = scd.scd2_apply(scd.start_history(one, "k", ["x"], t1), two, "k", ["x"], t2)
    again = scd.scd2_apply(h, two, "k", ["x"], t3)
    assert h.exceptAll(again).isEmpty() and again.exceptAll(h).isEmpty()
    assert sorted((r.k, r.x or "", r.valid_to is None) for r in h.collect()) == [("a", "1", True), ("b", "1", False), ("b", "2", True), ("c", "", False), ("d", "1", True)]
    assert [r.k for r in scd.with_history(h, "k").collect()] == ["b"]


def test_digest_ignores_order_and_sees_change(spark):
    rows = [(str(i), None if i % 5 == 0 else "v") for i in range(500)]
    f = lambda r: digest.content_digest(spark.createDataFrame(r, "a string, b string").repartition(3), ["a", "b"], 16).first().digest
    assert f(rows) == f(rows[::-1]) != f([*rows[:-1], ("x", "v")]) and f(rows) != f([*rows, rows[0]])


def test_generator_shares_close(spark):
    u = spark.range(300).select(F.concat(F.lit("m"), "id").alias("recording_mbid"))
    x = generator.generate_splits(u)
    assert x.groupBy("recording_mbid").agg(F.sum("share_e4").alias("s")).where("s <> 1000000").isEmpty() and x.where("share_e4 <= 0").isEmpty()
    dd = generator.defects(u, generator.RightsModel())
    assert {r.defect: r["count"] for r in dd.groupBy("defect").count().collect()} == dict(generator.RightsModel().quotas)


def test_profiles(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("b", "2"), ("c", None), ("d", "1"), ("d", None)], "k string, v string")
    assert {r.kind: r.groups for r in profile.dependency(df, "k", "v").collect()} == {"ALL_SET": 1, "CONFLICTING": 1, "NONE": 1, "MIXED": 1}
    assert {r.column_name: (r.present, r.absent) for r in profile.presence(df).collect()} == {"k": (7, 0), "v": (5, 2)}
    j = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("nope",)], "j string")
    assert {(r.path, r.type) for r in profile.json_inventory(j, "j").collect()} == {("a", "BIGINT"), ("b", "STRING"), ("", "INVALID")}
