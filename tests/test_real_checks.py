"""Checks go red when what they check is broken, and the restatement decides its cohort anew."""

import hashlib

import pytest
from pyspark.sql import functions as F

from rillmark.functions import text as T
from rillmark.operators import asof, profile
from rillmark.plans import ledger_plans as L
from rillmark.plans import matching_plans as MP
from rillmark.sources import readers


def sets(spark):
    rows = [("r1", "v1", "2026-01-01", "2026-02-01"), ("r1", "v2", "2026-02-01", "2026-03-01"), ("r2", "v3", "2026-01-05", "9999-12-31")]
    return spark.createDataFrame(rows, "recording_mbid string, split_version_id string, a string, b string").select("recording_mbid", "split_version_id", F.to_date("a").alias("valid_from"), F.to_date("b").alias("valid_to"))


def test_half_open_probes_the_join(spark):
    v = sets(spark)
    assert {(r.p, r.probes, r.violations) for r in L.half_open(v, asof.in_force).collect()} == {("from", 3, 0), ("last", 3, 0), ("to", 3, 0)}

    def closed(e, w, k, day, a, b):
        return e.join(w, k).where((F.col(day) >= F.col(a)) & (F.col(day) <= F.col(b)))

    def open_(e, w, k, day, a, b):
        return e.join(w, k).where((F.col(day) > F.col(a)) & (F.col(day) < F.col(b)))

    assert {r.p: r.violations for r in L.half_open(v, closed).collect()} == {"from": 0, "last": 0, "to": 3}
    assert {r.p: r.violations for r in L.half_open(v, open_).collect()} == {"from": 3, "last": 0, "to": 0}


def test_quality_rules_find_what_is_broken(spark):
    splits = spark.createDataFrame([(-1.0,), (50.0,), (150.0,), (None,)], "share_pct double")
    flags = ["share_sum_off", "temporal_overlap", "temporal_gap", "invalid_interval", "two_intervals", "orphan_recording", "missing_holder"]
    v = spark.createDataFrame([tuple(i == k for i in range(7)) for k in range(7)], ", ".join(f"{f} boolean" for f in flags))
    holders = spark.createDataFrame([("h", True), ("k", False)], "holder_id string, without_split boolean")
    days = spark.createDataFrame([(2, "MULTIPLE_VALID_SETS", 1), (1, "RESOLVED", 1), (1, "RANGE_GAP", 0), (1, "RANGE_OVERLAP", 2)], "valid_covering_sets int, resolution_status string, n_ranges int")
    m = spark.createDataFrame([("MATCHED", None, None, "SCORED_FALLBACK_UNIQUE"), ("UNRESOLVED", None, None, "NO_CANDIDATES"), ("MATCHED", "m", None, "STRUCTURAL_EXACT_UNIQUE")], "match_status string, matched_recording_mbid string, failure_reason string, match_method string")
    r = {x.rule: x for x in L.quality_report({"splits": splits, "sets": v, "holders": holders, "days": days, "matches": m}).collect()}
    assert len(r) == 17 and all(x.status == "FAIL" for x in r.values()) and r["recording_day_resolves_to_an_owner"].failed_records == 3 and r["share_pct_at_most_100"].failure_rate == 0.25
    assert {k for k, x in r.items() if x.expectation == "must_be_zero"} == set(L.MUST_BE_ZERO)
    none = {x.rule: x for x in L.quality_report({"splits": splits.limit(0)}).collect()}
    assert all(x.status == "PASS" and x.failure_rate is None for x in none.values())


def test_cohort_is_decided_anew(spark, tmp_path):
    """Hangul names that found nothing meet their romanised record; the rest is kept as it was, right or wrong."""
    d = str(tmp_path)
    at = F.lit("2026-06-01 10:00:00").cast("timestamp_ntz")
    li = [("a", "해금", "연가"), ("b", "해금", "漢字"), ("c", "Band", "Song"), ("d", "ツタ", "ムラ"), ("e", "Kept", "Wrong")]
    spark.createDataFrame([(h, a, r, None, "m" + h) for h, a, r in li], "listen_hash string, artist_name string, recording_name string, release_name string, recording_msid string").withColumn("listened_at", at).write.parquet(f"{d}/bronze_listens.parquet")
    cat = [("r1", "Haegeum", "Yeonga"), ("r2", "Band", "Song"), ("r3", "Tsuta", "Mura"), ("r4", "Tsuta", "Mura"), ("r5", "Kept", "Wrong")]
    spark.createDataFrame([(m, r, a, "x" if m == "r3" else "y") for m, a, r in cat], "recording_mbid string, recording_name string, artist_credit_name string, release_name string").write.parquet(f"{d}/bronze_canonical_recordings.parquet")
    v1 = [("a", None, "UNRESOLVED", "NO_CANDIDATES", "NO_LOOKUP_KEY_EMPTY"), ("b", None, "UNRESOLVED", "NO_CANDIDATES", "NO_LOOKUP_KEY_EMPTY"), ("c", "r2", "MATCHED", "STRUCTURAL_EXACT_UNIQUE", None), ("d", None, "UNRESOLVED", "NO_CANDIDATES", "NO_BLOCK_CANDIDATES"), ("e", "other", "MATCHED", "STRUCTURAL_EXACT_UNIQUE", None)]
    spark.createDataFrame(v1, "listen_hash string, matched_recording_mbid string, match_status string, match_method string, failure_reason string").write.parquet(f"{d}/silver_listen_matches.parquet")
    got = {r.listen_hash: r for r in L.r3_reprocess(spark, d).collect()}
    assert len(got) == 5 and (got["a"].matched_recording_mbid, got["a"].match_method, got["a"].recording_cohort) == ("r1", "STRUCTURAL_EXACT_UNIQUE", True)
    assert got["b"].matched_recording_mbid is None and got["b"].failure_reason == "NO_LOOKUP_KEY_PARTIAL" and got["b"].recording_cohort
    assert got["d"].failure_reason == "BELOW_THRESHOLD" and got["d"].recording_cohort  # two candidates by key, compared on texts as written
    assert (got["e"].matched_recording_mbid, got["e"].recording_cohort) == ("other", False) and got["c"].matched_recording_mbid == "r2"
    for a, r in (("해금", "연가"), ("해금", "漢字")):
        want = T.normalize(a, r, ("hangul", "kana"))
        p = T.with_fields(spark.createDataFrame([(a, r)], "a string, r string"), "a", "r", ("hangul", "kana")).first()
        assert {f: p[f] for f in T.FIELDS} == {f: want[f] for f in T.FIELDS}
    probe = {x.alternative: x for x in MP.r5_translit_probe(spark, d).collect()}
    assert (probe["hangul"].unique_pairs, probe["hangul"].ambiguous_pairs, probe["hangul"].admissible) == (1, 0, True)
    assert (probe["hangul_kana"].unique_pairs, probe["hangul_kana"].ambiguous_pairs, probe["hangul_kana"].admissible) == (1, 1, False)


def test_json_paths_of_nested_text(spark):
    rows = ['{"a": 1, "b": {"c": "x", "d": [1, {"e": null}]}}', '{"a": 2.5}', "{broken", None, "[3]", '"s"']
    df = spark.createDataFrame([(r,) for r in rows], "j string")
    got = {(r.path, r.type): r["rows"] for r in profile.json_inventory(df, "j").collect()}
    assert got["", "INVALID"] == 2 and got["a", "BIGINT"] == 1 and got["b.c", "STRING"] == 1 and got["b.d[]", "OBJECT"] == 1 and got["[]", "BIGINT"] == 1
    assert any(p == "b.d[].e" for p, _ in got) and profile.json_inventory(df.limit(0), "j").count() == 0
    with pytest.raises(ValueError):
        profile.json_inventory(spark.createDataFrame([("[" * 6 + "]" * 6,)], "j string"), "j", deepest=3).collect()
    v = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,), ("c",)], "x string")
    assert [tuple(r) for r in profile.top_values(v, "x", 3).collect()] == [(None, 2), ("b", 2), ("a", 1)]


def test_ordered_export_and_back(spark, tmp_path):
    rows = [(f"k{i:03d}", None if i % 7 == 0 else "" if i % 5 == 0 else f' q"uo\'te {i} ', i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t string, n int").repartition(5)
    out = str(tmp_path / "x")
    readers.ordered_export(df, ["k"], out)
    back = readers.read_tsv(spark, [out], df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    keys = []
    import glob
    import gzip

    for p in sorted(glob.glob(f"{out}/part-*.gz")):
        keys += [line.split("\t")[0] for line in gzip.open(p, "rt")]
    assert keys == sorted(keys) and len(keys) == 300
    with pytest.raises(Exception, match="tab"):
        readers.ordered_export(spark.createDataFrame([("a\tb",)], "k string"), ["k"], str(tmp_path / "y"))


def test_manifest_sizes_and_totals(spark, tmp_path):
    for n, b in (("a", b"1"), ("b", b"22"), ("c", b"333"), ("z", b"4")):
        (tmp_path / n).write_bytes(b)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    m = {"a": (sha(b"1"), 1), "b": (sha(b"22"), 9), "c": ("0", 3), "d": (sha(b""), 0)}
    r = readers.verify_manifest(spark, str(tmp_path), m)
    assert {x.name: (x.state, x.bytes) for x in r.collect()} == {"a": ("ok", 1), "b": ("size", 2), "c": ("differs", 3), "d": ("missing", None), "z": ("unexpected", 1)}
    assert tuple(readers.manifest_totals(r).first()) == (4, 4, 7, 4)


def test_formats(spark):
    u = "7bc976d7-e7ee-4fac-9c9d-580a92e9fad9"
    df = spark.createDataFrame([(u, "2026-06-01 00:00:00"), (u.upper(), "2026-07-01 00:00:00"), ("x", "1970-01-01 00:00:00"), (None, None)], "id string, t string").select("id", F.col("t").cast("timestamp_ntz").alias("ts"))
    r = profile.formats(df, ["id"], "ts", "2026-06-01", "2026-07-01").first()
    assert (r["rows"], r.bad_id, r.in_period, r.out_of_period, r.unclassified, r.implausible) == (4, 1, 1, 2, 1, 1)
