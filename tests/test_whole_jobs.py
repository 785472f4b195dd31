"""Each operator does the whole of its job: cases that shortcuts of it get wrong."""

import datetime

from pyspark.sql import functions as F

from rillmark.functions import text as T
from rillmark.operators import evaluation as E
from rillmark.operators import generator as G
from rillmark.operators import matching as M
from rillmark.operators import orphans
from rillmark.plans import ledger_plans as L

NAMES = ["Mïlpa", "Деми", "DJ Деми", "Song with Guest", "Song (Live)", "Song - 2011 Remaster", "Song reissue 1999", "Song - Radio Edit", "The\x1cSong", "A Song_live", "Live", "\t", "", "...", "Delivered", "Mixture", "x ft. y"]


def test_fields_are_the_kernels(spark):
    """The native path gives what the kernel gives, and letters outside ASCII reach the kernel."""
    df = spark.createDataFrame([(a, r) for a in NAMES for r in NAMES], "a string, r string")
    for x in T.with_fields(df, "a", "r").collect():
        want = T.normalize(x.a, x.r)
        assert {f: x[f] for f in T.FIELDS} == {f: want[f] for f in T.FIELDS}, (x.a, x.r)


def test_matcher_folds_accents_and_refuses_partial_keys(spark):
    li = spark.createDataFrame([("Mïlpa", "Sóng", None), ("DJ Деми", "Song", None), ("Band", "Song with Guest", None)], "artist_name string, recording_name string, release_name string")
    cat = spark.createDataFrame([("m1", "Milpa", "Song", None), ("m2", "DJ", "Song", None), ("m3", "Band", "Song - Radio Edit", None)], "recording_mbid string, artist_credit_name string, recording_name string, release_name string")
    pairs = M.distinct_pairs(li)
    p = {x.artist_name: x for x in pairs.collect()}
    assert p["Mïlpa"].key_exact == "milpasong" and p["DJ Деми"].status_exact == "PARTIAL" and p["DJ Деми"].key_exact == ""
    got = {x.pair_hash: (x.recording_mbid, x.block_method) for x in M.candidates(pairs, M.blocking_index(cat)).collect()}
    assert got == {p["Mïlpa"].pair_hash: ("m1", "EXACT"), p["Band"].pair_hash: ("m3", "FALLBACK")}


def universe(spark, n):
    return spark.range(n).select(F.concat(F.lit("m"), "id").alias("recording_mbid"))


def test_generated_sets_are_dated_and_change(spark):
    m = G.RightsModel()
    sets = {}
    for x in G.generate_ownership(universe(spark, 2000), m).collect():
        sets.setdefault(x.recording_mbid, {}).setdefault((x.valid_from, x.valid_to, x.split_version_id), []).append((x.rights_holder_id, x.share_e4))
    base, change, end = (datetime.date.fromisoformat(x) for x in (m.base_day, m.change_day, m.open_day))
    two = [k for k, v in sets.items() if len(v) == 2]
    assert len(sets) == 2000 and 0.01 < len(two) / 2000 < 0.03
    for k, v in sets.items():
        assert sorted(i[:2] for i in v) == ([(base, change), (change, end)] if k in two else [(base, end)]) and len({i[2] for i in v}) == len(v)
        assert all(sum(s for _, s in rows) == 1_000_000 and len({h for h, _ in rows}) == len(rows) for rows in v.values())
    known = {x.holder_id for x in G.generate_holders(spark, m).collect()}
    used = {h for v in sets.values() for rows in v.values() for h, _ in rows}
    assert len(known) == m.holders and used <= known and max(used) < f"GEN-{m.holders - m.reserved:06d}"


def test_injected_defects_are_found_in_the_rows(spark):
    """Every kind is detected by the rules; labels that break nothing are not."""
    u, m = universe(spark, 300), G.RightsModel()
    want = {**dict(m.quotas), "ORPHAN_RECORDING": m.orphans, "HOLDER_WITHOUT_SPLIT": m.reserved}
    rows = L.injected_detected(u).collect()
    assert {x.defect: (x.injected, x.detected) for x in rows} == {k: (n, n) for k, n in want.items()} and all(x.same_digest for x in rows)
    inert = G.defects(u, m).withColumn("defect", F.lit("NO_SUCH_KIND"))
    assert {x.defect: x.detected for x in L.injected_detected(u, m, inert).collect()} == {k: 20 if k == "HOLDER_WITHOUT_SPLIT" else 0 for k in want}


def test_label_is_looked_up_among_the_candidates(spark):
    """Of two wrong decisions the one whose label was a candidate is a ranking error."""
    li = spark.createDataFrame([("l1", "A", "S"), ("l2", "B", "S"), ("l3", "A", "S")], "listen_hash string, artist_name string, recording_name string")
    cands = li.where("listen_hash = 'l1'").select(T.pair_hash(F.col("artist_name"), F.col("recording_name")).alias("pair_hash"), F.explode(F.array(F.lit("r1"), F.lit("R2"))).alias("recording_mbid"))
    rows = spark.createDataFrame([("l1", "r1", "r2", True), ("l2", "r1", "r2", True), ("l3", "r1", None, False)], "listen_hash string, matched_recording_mbid string, label_mbid string, label_in_catalogue boolean").withColumn("g", F.lit(1))
    x = E.agreement(L.retrieved(rows, li, cands), "g").first()
    assert (x["items"], x.ranking_error, x.ref_not_retrieved, x.ref_not_in_snapshot) == (3, 1, 1, 0)


def test_every_landing_opens_and_closes_versions(spark):
    """A version that opens and closes in between, a holder that comes back, and a change of holder_type alone."""
    rows = [("a", "N", "T", "ACTIVE", 1), ("a", "N", "T", "HELD", 2), ("a", "N", "T", "ACTIVE", 3), ("b", "N", "T", "ACTIVE", 1), ("b", "N", "T", "ACTIVE", 3), ("c", "N", "T", "ACTIVE", 1), ("c", "N", "U", "ACTIVE", 2), ("c", " n ", "U", "active", 3)]
    df = spark.createDataFrame(rows, "holder_id string, display_name string, holder_type string, payee_status string, day int").withColumn("model_scope", F.lit("G"))
    df = df.select("*", F.concat(F.lit("run"), "day").alias("generation_run_id"), F.make_timestamp(F.lit(2026), F.lit(1), F.col("day"), F.lit(0), F.lit(0), F.lit(0)).alias("generated_at"))
    h = L.scd2_of_landings(df)
    got = sorted((x.holder_id, x.payee_status, x.holder_type, x.valid_from.day, x.valid_to.day if x.valid_to else 0) for x in h.collect())
    assert got == [("A", "ACTIVE", "T", 1, 2), ("A", "ACTIVE", "T", 3, 0), ("A", "HELD", "T", 2, 3), ("B", "ACTIVE", "T", 1, 2), ("B", "ACTIVE", "T", 3, 0), ("C", "ACTIVE", "T", 1, 2), ("C", "ACTIVE", "U", 2, 0)]


def _scored(spark):
    """t1: two exact candidates that only the release tells apart; t2: one fallback candidate whose title is near."""
    f = ", ".join(f"{x} double" for x in M.FEATURES)
    rows = [("t1", "r1", "EXACT", *[1.0] * 6, 1.0), ("t1", "r2", "EXACT", *[1.0] * 6, 0.0), ("t2", "r3", "FALLBACK", 1.0, 0.0, 1.0, 0.5, 1.0, 0.7, None)]
    feats = spark.createDataFrame(rows, f"text_hash string, recording_mbid string, block_method string, {f}")
    return feats, spark.createDataFrame([("t1", "r1", True, 3), ("t1", "r2", True, 2), ("t2", "r9", True, 1)], "text_hash string, label_mbid string, label_in_catalogue boolean, items long")


def test_grid_scores_each_weight_set_anew(spark):
    feats, items = _scored(spark)
    g = E.grid(L.rescored(feats, items), L.EXACT, L.FALLBACK, L.MARGINS)
    got = {(x.weight_set, x.exact_threshold, x.fallback_threshold, x.min_margin, x.stage): x for x in g.collect()}
    assert len(got) == 2 * 1008
    tie, clear = got["recording_only", 0.55, 0.65, 0.02, "EXACT_MULTI"], got["recording_release", 0.55, 0.65, 0.02, "EXACT_MULTI"]
    assert (tie["items"], tie.accepted) == (5, 0) and (clear.accepted, clear.agree, clear.ranking_error) == (5, 3, 2)
    lax, strict = got["equal_six", 0.99, 0.65, 0.02, "FALLBACK_UNIQUE"], got["equal_six", 0.55, 0.75, 0.02, "FALLBACK_UNIQUE"]
    assert (lax.accepted, lax.ref_not_retrieved, strict.accepted) == (1, 1, 0)


def test_choice_is_by_worst_stage(spark):
    cols = "weight_set string, exact_threshold double, fallback_threshold double, min_margin double, stage string, accepted long, ranking_error long, ref_not_retrieved long, ref_not_in_snapshot long"
    cell = lambda k, *st: [(k, 0.5, 0.5, 0.02, n, a, e, 0, 0) for n, a, e in st]
    good = cell("good", ("A", 1000, 10), ("B", 1000, 10), ("C", 1000, 20))
    one_bad, thin = cell("one_bad", ("A", 9000, 0), ("B", 9000, 0), ("C", 1000, 21)), cell("thin", ("A", 99000, 0), ("B", 99000, 0), ("C", 999, 0))
    pick = lambda rows: E.choose(spark.createDataFrame(rows, cols), 0.02, 1000).first()
    assert (pick(good + one_bad + thin).weight_set, pick(good + one_bad).within_bound) == ("good", True)
    x = pick(one_bad + thin)
    assert (x.weight_set, x.complete, x.within_bound) == ("one_bad", True, False)


def test_leave_one_out_covers_every_feature(spark):
    x = {r.subset: r for r in L.leave_one_out(*_scored(spark)).collect()}
    assert set(x) == {"all", *(f"without_{f}" for f in M.FEATURES)} and (x["all"].positives, x["all"].negatives) == (5, 6)
    assert x["without_release_exact"].auc < x["all"].auc


def test_cycle_reports_every_row_and_link(spark):
    """A sibling found directly hides no other row, a row found by one field is found by its link too, and equal keys of several rounds end."""
    rows = [("a", "5", "X"), ("b", "5", "K"), ("5", "9", "K"), ("9", None, "X"), ("c", "d", "K"), ("d", "c", "K")]
    nodes = spark.createDataFrame(rows, "id string, parent string, ref string")
    keys = orphans.Presence(spark.createDataFrame([("K", datetime.datetime(2026, 1, 1))], "key string, seen timestamp"))
    g = orphans.Graph({"n": nodes}, {"keys": keys}, [orphans.Reference("n", "ref", "keys")], [("n", "parent", "n", "id")])
    got = sorted((x.id, x.ref_field, x.orphan_level) for x in orphans.cascade(g)["n"].collect())
    assert got == [("5", "parent", 1), ("9", "ref", 0), ("a", "parent", 2), ("a", "ref", 0), ("b", "parent", 2)]
