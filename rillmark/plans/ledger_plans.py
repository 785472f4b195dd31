"""Ownership, allocation, restatement, evaluation and profile operators over the domain tables, with SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillmark.functions import text as T
from rillmark.functions.keys import lower_key, stripped, upper_key
from rillmark.operators import allocation, asof, digest, generator, history, ownership, profile, restatement, scd
from rillmark.operators import evaluation as E
from rillmark.operators import matching as M
from rillmark.plans import fuller_sql as FS
from rillmark.plans import matching_plans as MP
from rillmark.plans.problems import ATTRS, LOW, UP
from rillmark.session import checkpointed, shared_dir
from rillmark.sources import store

FIELDS = ["match_status", "match_method", "failure_reason"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- ownership
def _splits(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "ownership_splits")
    return x.select(lower_key("recording_mbid").alias("recording_mbid"), upper_key("rights_holder_id").alias("rights_holder_id"), "share_pct", "valid_from", "valid_to", "split_version_id").distinct()


def _holders(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "rights_holders").select(upper_key("holder_id").alias("holder_id"))


def _catalogue(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_canonical_recordings").select(lower_key("recording_mbid").alias("recording_mbid"))


def _sets(s: SparkSession, d: str) -> DataFrame:
    return ownership.sets_of(_splits(s, d), _holders(s, d))


def _validity(s: SparkSession, d: str) -> DataFrame:
    return ownership.validity(_splits(s, d), _holders(s, d), _catalogue(s, d))


def _days(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "int_eligible_recording_days")
    return x.groupBy(lower_key("recording_mbid").alias("recording_mbid"), "listen_date").agg(F.max("streams").alias("streams")).where("recording_mbid is not null")


#: a reference calendar of two ranges with a hole of three days
RANGES = [("A", "2025-01-01", "2026-06-10"), ("B", "2026-06-13", "9999-12-31")]


def _ranges(s: SparkSession) -> DataFrame:
    return s.createDataFrame(RANGES, "range_id string, f string, t string").select("range_id", F.to_date("f").alias("range_from"), F.to_date("t").alias("range_to"))


def _resolution(s: SparkSession, d: str, valid: DataFrame | None = None) -> DataFrame:
    """The sets feed several branches, so they are made once and cut from their lineage; ``valid``: where the caller has done so."""
    return ownership.resolution(_days(s, d), checkpointed(_validity(s, d)) if valid is None else valid, _ranges(s))


def ag4_sets(s: SparkSession, d: str) -> DataFrame:
    return _sets(s, d).select("recording_mbid", "split_version_id", F.col("valid_from").cast("string").alias("valid_from"), F.col("valid_to").cast("string").alias("valid_to"), F.col("share_sum").cast("double").alias("share_sum"), "holder_rows", "holders", "bad_shares")


def ag5_intervals(s: SparkSession, d: str) -> DataFrame:
    return _sets(s, d).where("intervals > 1").select("recording_mbid", "split_version_id", "intervals")


def j7_unknown(s: SparkSession, d: str) -> DataFrame:
    return _sets(s, d).where("unknown_holders > 0").select("recording_mbid", "split_version_id", "unknown_holders")


def j8_overlaps(s: SparkSession, d: str) -> DataFrame:
    return ownership.overlaps(_sets(s, d))


def w3_gaps(s: SparkSession, d: str) -> DataFrame:
    return ownership.gaps(_sets(s, d))


def o1_validity(s: SparkSession, d: str) -> DataFrame:
    v = _validity(s, d)
    return v.select(*[F.col(c).cast("string").alias(c) if c in ("valid_from", "valid_to") else F.col(c).cast("double").alias(c) if c == "share_sum" else F.col(c) for c in v.columns])


def j9_in_force(s: SparkSession, d: str) -> DataFrame:
    """Half-open temporal join of days to valid sets: zero to n rows a day, never deduplicated by choice."""
    v = _validity(s, d).where("is_valid_set").select("recording_mbid", "split_version_id", "valid_from", "valid_to")
    j = asof.in_force(_days(s, d).select("recording_mbid", "listen_date"), v, "recording_mbid", "listen_date", "valid_from", "valid_to")
    return j.select("recording_mbid", F.col("listen_date").cast("string").alias("listen_date"), "split_version_id")


def j10_covered(s: SparkSession, d: str) -> DataFrame:
    """Days covered by any set, valid or not."""
    c = ownership.coverage(_days(s, d), _sets(s, d).withColumn("is_valid_set", F.lit(False)))
    return c.where("covering > 0").select("recording_mbid", F.col("listen_date").cast("string").alias("listen_date"))


def j11_ranges(s: SparkSession, d: str) -> DataFrame:
    r = ownership.range_counts(_days(s, d), "listen_date", _ranges(s), "range_from", "range_to")
    return r.select(F.col("listen_date").cast("string").alias("listen_date"), "n_ranges", "range_id")


def j25_catalogue(s: SparkSession, d: str) -> DataFrame:
    sets = _splits(s, d).select("recording_mbid").distinct()
    cat = _catalogue(s, d).distinct().withColumn("c", F.lit(1))
    return sets.join(cat, "recording_mbid", "left").select("recording_mbid", F.col("c").isNotNull().alias("in_catalogue"))


def o2_resolution(s: SparkSession, d: str) -> DataFrame:
    r = _resolution(s, d)
    return r.select("recording_mbid", F.col("listen_date").cast("string").alias("listen_date"), "streams", "resolution_status", "split_version_id", "valid_covering_sets")


def ag10_waterfall(s: SparkSession, d: str) -> DataFrame:
    """Per status: days, recordings, streams and the share of all streams."""
    r = _resolution(s, d)
    total = r.select(F.sum("streams").alias("t")).scalar()
    return r.groupBy("resolution_status").agg(F.count(F.lit(1)).alias("days"), F.count_distinct("recording_mbid").alias("recordings"), F.sum("streams").alias("streams")).withColumn("pct", F.round(F.col("streams") * 100.0 / total, 6))


def ag6_recording_days(s: SparkSession, d: str) -> DataFrame:
    """Streams per recording and day from the listens' decisions, each listen once: the reduction ahead of temporal joins."""
    m = table(s, d, "silver_listen_matches").where("matched_recording_mbid is not null").select("listen_hash", F.to_date("listened_at").alias("listen_date"), "matched_recording_mbid", "match_method").distinct()
    g = m.groupBy(F.col("matched_recording_mbid").alias("recording_mbid"), "listen_date").agg(F.count_distinct("listen_hash").alias("streams"), F.min("match_method").alias("min_match_method"), F.max("match_method").alias("max_match_method"))
    return g.withColumn("listen_date", F.col("listen_date").cast("string"))


def _allocated(s: SparkSession, d: str) -> DataFrame:
    r = _resolution(s, d).where("resolution_status = 'RESOLVED'").groupBy("recording_mbid", "split_version_id").agg((F.sum("streams") * 100).alias("units"))
    sp = _splits(s, d).select("recording_mbid", "split_version_id", "rights_holder_id", (F.col("share_pct") * 10000).cast("bigint").alias("share_e4"))
    return allocation.largest_remainder(r.join(sp, ["recording_mbid", "split_version_id"]), ["recording_mbid", "split_version_id"], "rights_holder_id", "units", "share_e4", 1_000_000)


def a1_allocation(s: SparkSession, d: str) -> DataFrame:
    """Hundredths of streams shared out among holders by largest remainder."""
    return _allocated(s, d).select("recording_mbid", "split_version_id", "rights_holder_id", "units", "share_e4", "floor_units", "remainder", "remainder_rank", "allotted")


def t7_closure(s: SparkSession, d: str) -> DataFrame:
    """Groups whose allotments do not add up to their units, or give more spare units than members: must be none."""
    g = _allocated(s, d).groupBy("recording_mbid", "split_version_id").agg(F.max("units").alias("u"), F.sum("allotted").alias("a"), F.count(F.lit(1)).alias("n"), F.sum("floor_units").alias("f"))
    return g.agg(F.count(F.lit(1)).alias("groups"), F.count_if((F.col("u") != F.col("a")) | (F.col("u") - F.col("f") > F.col("n")) | (F.col("u") < F.col("f"))).alias("violations"))


def t11_half_open(s: SparkSession, d: str) -> DataFrame:
    """Probes of the temporal join on valid_from, the day before valid_to and valid_to of each valid set: in force, in force, not in force."""
    v = checkpointed(_validity(s, d).where("is_valid_set").select("recording_mbid", "split_version_id", "valid_from", "valid_to"))
    return half_open(v, asof.in_force)


def half_open(v: DataFrame, join) -> DataFrame:
    """(p, probes, violations): what ``join`` says on three days about each interval, against what half-open intervals say."""
    probe = lambda p, day, want: F.struct(F.lit(p).alias("p"), day.alias("day"), F.lit(want).alias("want"))
    x = v.select("recording_mbid", "split_version_id", F.explode(F.array(probe("from", F.col("valid_from"), True), probe("last", F.date_sub("valid_to", 1), True), probe("to", F.col("valid_to"), False))).alias("x")).select("recording_mbid", "split_version_id", "x.*")
    got = join(x.select("recording_mbid", "day").distinct(), v, "recording_mbid", "day", "valid_from", "valid_to").select("recording_mbid", "day", "split_version_id").distinct().withColumn("_in", F.lit(True))
    j = x.join(got, ["recording_mbid", "day", "split_version_id"], "left")
    return j.groupBy("p").agg(F.count(F.lit(1)).alias("probes"), F.count_if(F.coalesce("_in", F.lit(False)) != F.col("want")).alias("violations"))


def ag13_holder_lists(s: SparkSession, d: str) -> DataFrame:
    x = _splits(s, d).groupBy("recording_mbid").agg(F.array_join(F.array_sort(F.collect_set("rights_holder_id")), ",").alias("holders"))
    return x


def t8_changed_holders(s: SparkSession, d: str) -> DataFrame:
    """Recordings whose holders in force on two days differ."""
    def on(day: str, name: str) -> DataFrame:
        v = _splits(s, d).where((F.col("valid_from") <= F.lit(day).cast("date")) & (F.col("valid_to") > F.lit(day).cast("date")))
        return v.groupBy("recording_mbid").agg(F.array_join(F.array_sort(F.collect_set("rights_holder_id")), ",").alias(name))

    return on("2026-06-01", "before").join(on("2026-06-30", "after"), "recording_mbid").where("before <> after")


#: rule -> (model, severity, what is at risk, the failing condition); what must never fail is in MUST_BE_ZERO
ALLOCATION, HOLDER, ATTRIBUTION = "ownership_allocation_at_risk", "wrong_rights_holder_risk", "royalty_attribution_at_risk"
RULES = {
    "share_pct_not_negative": ("splits", "ERROR", ALLOCATION, "share_pct < 0"), "share_pct_at_most_100": ("splits", "ERROR", ALLOCATION, "share_pct > 100"),
    "valid_set_shares_sum_to_exactly_100": ("sets", "ERROR", ALLOCATION, "share_sum_off"), "no_temporal_overlap": ("sets", "ERROR", HOLDER, "temporal_overlap"), "no_temporal_gap": ("sets", "ERROR", ATTRIBUTION, "temporal_gap"),
    "interval_is_valid": ("sets", "ERROR", ATTRIBUTION, "invalid_interval"), "split_set_has_one_interval": ("sets", "ERROR", ALLOCATION, "two_intervals"), "recording_exists_in_catalogue": ("sets", "ERROR", ATTRIBUTION, "orphan_recording"),
    "rights_holder_exists": ("sets", "ERROR", HOLDER, "missing_holder"), "holder_has_at_least_one_split": ("holders", "WARN", ATTRIBUTION, "without_split"),
    "exactly_one_valid_ownership_set_per_recording_day": ("days", "ERROR", HOLDER, "valid_covering_sets > 1"), "recording_day_resolves_to_an_owner": ("days", "ERROR", ATTRIBUTION, "resolution_status <> 'RESOLVED'"),
    "calendar_covers_the_day": ("days", "ERROR", ATTRIBUTION, "n_ranges = 0"), "calendar_does_not_double_cover_the_day": ("days", "ERROR", ALLOCATION, "n_ranges > 1"),
    "match_rests_on_one_fallback_candidate": ("matches", "WARN", ATTRIBUTION, "match_method = 'SCORED_FALLBACK_UNIQUE'"), "matched_listens_carry_a_recording": ("matches", "ERROR", ATTRIBUTION, "match_status = 'MATCHED' and matched_recording_mbid is null"),
    "unresolved_listens_carry_a_reason": ("matches", "ERROR", ATTRIBUTION, "match_status <> 'MATCHED' and failure_reason is null"),
}
MUST_BE_ZERO = ["share_pct_not_negative", "share_pct_at_most_100", "split_set_has_one_interval", "calendar_does_not_double_cover_the_day", "matched_listens_carry_a_recording", "unresolved_listens_carry_a_reason"]


def quality_report(models: dict[str, DataFrame]) -> DataFrame:
    """All rules, each model read once: failed and total records, rate, status, what is at risk and whether a failure is expected."""
    out = None
    for name, df in models.items():
        own = {r: v for r, v in RULES.items() if v[0] == name}
        a = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(c)).alias(r) for r, (_, _, _, c) in own.items()])
        rows = [F.struct(F.lit(name).alias("model"), F.lit(r).alias("rule"), F.lit(sev).alias("severity"), F.lit(risk).alias("business_impact"), F.col(r).alias("failed_records"), F.col("n").alias("total_records")) for r, (_, sev, risk, _) in own.items()]
        x = a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        out = x if out is None else out.unionByName(x)
    return out.withColumns({
        "failure_rate": F.round(F.try_divide(F.col("failed_records"), F.col("total_records")), 8), "status": F.when(F.col("failed_records") == 0, "PASS").otherwise("FAIL"),
        "expectation": F.when(F.col("rule").isin(MUST_BE_ZERO), "must_be_zero").otherwise("expected_to_find_defects"),
    })


def q1_quality(s: SparkSession, d: str) -> DataFrame:
    """Seventeen rules over splits, sets, holders, recording days and match decisions."""
    v, sp = checkpointed(_validity(s, d)), checkpointed(_splits(s, d))
    used = sp.select(F.col("rights_holder_id").alias("holder_id")).distinct().withColumn("_u", F.lit(1))
    holders = _holders(s, d).where("holder_id is not null").distinct().join(used, "holder_id", "left").select("holder_id", F.col("_u").isNull().alias("without_split"))
    ranges = ownership.range_counts(_days(s, d), "listen_date", _ranges(s), "range_from", "range_to").select("listen_date", "n_ranges")
    days = _resolution(s, d, v).join(F.broadcast(ranges), "listen_date")  # a row per calendar day
    matches = table(s, d, "silver_listen_matches").distinct()
    return quality_report({"splits": sp, "sets": v, "holders": holders, "days": days, "matches": matches})


_DATE = lambda c: f"strftime({c}, '%Y-%m-%d')"
OWN = f"""
with sp as (select distinct {LOW('recording_mbid')} as recording_mbid, {UP('rights_holder_id')} as rights_holder_id, share_pct, valid_from, valid_to, split_version_id from ownership_splits),
ho as (select distinct {UP('holder_id')} as holder_id from rights_holders),
ca as (select distinct {LOW('recording_mbid')} as recording_mbid from bronze_canonical_recordings),
st as (select recording_mbid, split_version_id, min(valid_from) as valid_from, max(valid_to) as valid_to, cast(sum(share_pct) as decimal(18,4)) as share_sum, count(*) as holder_rows, count(distinct rights_holder_id) as holders,
  count(*) filter (where holder_id is null) as unknown_holders, count(*) filter (where share_pct < 0 or share_pct > 100) as bad_shares, count(distinct valid_from || '|' || valid_to) as intervals
  from sp left join ho on ho.holder_id = sp.rights_holder_id group by 1, 2),
vi as (select * from st where valid_from < valid_to),
ov as (select a.recording_mbid, a.split_version_id, count(*) as overlapping_sets from vi a join vi b on a.recording_mbid = b.recording_mbid and a.split_version_id <> b.split_version_id and a.valid_from < b.valid_to and b.valid_from < a.valid_to group by 1, 2),
gp as (select recording_mbid, count(*) as gaps from (select recording_mbid, valid_from, lag(valid_to) over (partition by recording_mbid order by valid_from, valid_to, split_version_id) as p from vi) where p < valid_from group by 1),
va as (select st.recording_mbid, st.split_version_id, valid_from, valid_to, share_sum, holder_rows, share_sum <> 100 as share_sum_off, not (valid_from < valid_to) as invalid_interval, unknown_holders > 0 as missing_holder, ca.recording_mbid is null as orphan_recording,
  coalesce(overlapping_sets, 0) > 0 as temporal_overlap, coalesce(gaps, 0) > 0 as temporal_gap, bad_shares > 0 as share_out_of_range, intervals > 1 as two_intervals
  from st left join ov using (recording_mbid, split_version_id) left join gp using (recording_mbid) left join ca using (recording_mbid)),
vd as (select *, not (coalesce(share_sum_off, true) or coalesce(invalid_interval, true) or missing_holder or orphan_recording or temporal_overlap or temporal_gap or coalesce(share_out_of_range, true) or two_intervals) as is_valid_set from va),
dy as (select {LOW('recording_mbid')} as recording_mbid, listen_date, max(streams) as streams from int_eligible_recording_days group by 1, 2),
rg as (select * from (values {', '.join(f"('{a}', date '{b}', date '{c}')" for a, b, c in RANGES)}) t(range_id, range_from, range_to)),
rc as (select dd.listen_date, count(rg.range_id) as n_ranges, min(rg.range_id) as range_id from (select distinct listen_date from dy) dd left join rg on dd.listen_date >= range_from and dd.listen_date < range_to group by 1),
rj as (select dy.recording_mbid, dy.listen_date, dy.streams, count(split_version_id) as sets, count(*) filter (where is_valid_set) as valid_sets, count(*) filter (where listen_date >= valid_from and listen_date < valid_to) as covering,
  count(*) filter (where is_valid_set and listen_date >= valid_from and listen_date < valid_to) as n, min(split_version_id) filter (where is_valid_set and listen_date >= valid_from and listen_date < valid_to) as one
  from dy left join vd using (recording_mbid) group by 1, 2, 3),
re as (select recording_mbid, rj.listen_date, streams, case when n > 1 then 'MULTIPLE_VALID_SETS' when n = 1 and n_ranges = 0 then 'RANGE_GAP' when n = 1 and n_ranges > 1 then 'RANGE_OVERLAP' when n = 1 then 'RESOLVED' when sets = 0 then 'NO_OWNERSHIP_RECORD'
  when valid_sets = 0 then 'DEFECTIVE_OWNERSHIP' when covering > 0 then 'COVERED_ONLY_BY_INVALID_SET' else 'OWNERSHIP_GAP_FOR_DATE' end as resolution_status, case when n = 1 then one end as split_version_id, n as valid_covering_sets from rj join rc using (listen_date)),
al0 as (select recording_mbid, split_version_id, cast(sum(streams) * 100 as bigint) as units from re where resolution_status = 'RESOLVED' group by 1, 2),
al1 as (select recording_mbid, split_version_id, rights_holder_id, units, cast(share_pct * 10000 as bigint) as share_e4 from al0 join sp using (recording_mbid, split_version_id)),
al2 as (select *, (units::hugeint * share_e4) // 1000000 as floor_units, (units::hugeint * share_e4) % 1000000 as remainder from al1),
al3 as (select *, row_number() over (partition by recording_mbid, split_version_id order by remainder desc, rights_holder_id) as remainder_rank, units - sum(floor_units) over (partition by recording_mbid, split_version_id) as spare from al2),
al as (select recording_mbid, split_version_id, rights_holder_id, units, share_e4, cast(floor_units as bigint) as floor_units, cast(remainder as bigint) as remainder, remainder_rank, cast(floor_units + (remainder_rank <= spare)::int as bigint) as allotted from al3)
"""


# ---- restatement
def _publication(s: SparkSession, d: str, which: str) -> DataFrame:
    f = table(s, d, "fct_restatements").select(lower_key("recording_mbid").alias("recording_mbid"), upper_key("rights_holder_id").alias("rights_holder_id"), "change_type", F.col(f"{which}_payout").alias("amount"), F.col(f"{which}_streams").alias("streams")).distinct()
    gone = {"prior": "HOLDER_ADDED", "restated": "HOLDER_REMOVED"}[which]
    return f.where(F.col("change_type") != gone).drop("change_type")


def _deltas(s: SparkSession, d: str) -> DataFrame:
    return restatement.delta(_publication(s, d, "prior"), _publication(s, d, "restated"), ["recording_mbid", "rights_holder_id"], "amount", "streams")


def _dec(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def r1_delta(s: SparkSession, d: str) -> DataFrame:
    return _dec(_deltas(s, d), "prior_amount", "restated_amount", "delta")


def ag11_summary(s: SparkSession, d: str) -> DataFrame:
    return _dec(_deltas(s, d).groupBy("change_type").agg(F.count(F.lit(1)).alias("n"), F.sum("delta").alias("delta")), "delta")


def r2_reconciliation(s: SparkSession, d: str) -> DataFrame:
    r = restatement.reconciliation(_deltas(s, d))
    return _dec(r, *[c for c in r.columns if c.startswith("delta_") or c.endswith("_total")])


def _copy(s: SparkSession, d: str, which: str = "") -> DataFrame:
    t = table(s, d, f"silver_listen_matches{which}")
    return t.select("listen_hash", "matched_recording_mbid", *FIELDS, *(["recording_cohort"] if which else [])).distinct()


def ag23_transitions(s: SparkSession, d: str) -> DataFrame:
    return restatement.transitions(_copy(s, d), _copy(s, d, "_restated"), "listen_hash", FIELDS)


def j22_changed(s: SparkSession, d: str) -> DataFrame:
    return restatement.changed_rows(_copy(s, d), _copy(s, d, "_restated"), "listen_hash", ["matched_recording_mbid", *FIELDS])


def p12_cohort(s: SparkSession, d: str) -> DataFrame:
    """Listens of a structured cohort: Hangul or kana names that found no candidate."""
    li = table(s, d, "bronze_listens").select("listen_hash", "artist_name", "recording_name").distinct()
    m = _copy(s, d).select("listen_hash", "failure_reason")
    c = restatement.Cohort(failure_reasons=("NO_BLOCK_CANDIDATES", "NO_LOOKUP_KEY_EMPTY", "NO_LOOKUP_KEY_PARTIAL"))
    return li.join(m, "listen_hash").where(c.predicate()).select("listen_hash").distinct()


def r3_reprocess(s: SparkSession, d: str) -> DataFrame:
    """The cohort's rows decided anew under romanised keys, all others kept from the first copy."""
    cohort = checkpointed(p12_cohort(s, d))
    return restatement.reprocess(_copy(s, d), cohort, MP.recomputed(s, d, cohort), "listen_hash")


def r6_case(s: SparkSession, d: str) -> DataFrame:
    """The recording with the largest change, before and after, holder by holder."""
    x = _deltas(s, d)
    top = x.groupBy("recording_mbid").agg(F.sum(F.abs("delta")).alias("m")).orderBy(F.col("m").desc(), "recording_mbid").limit(1).select("recording_mbid")
    return _dec(x.join(F.broadcast(top), "recording_mbid", "left_semi"), "prior_amount", "restated_amount", "delta")  # one row


def t13_totals(s: SparkSession, d: str) -> DataFrame:
    """The prior publication's rows and total as frozen, and whether they are the same after the restatement was published beside it."""
    key = ["recording_mbid", "rights_holder_id"]
    prior, new = (_publication(s, d, w).groupBy(*key).agg(F.sum("amount").cast("decimal(38,6)").alias("amount")) for w in ("prior", "restated"))
    st = store.Store(s, f"{shared_dir(s)}/rillmark-publications-{uuid.uuid4().hex}")
    st.publish("payouts", "prior", prior, promote=True)
    before = store.freeze(st, "payouts", "prior", [*key, "amount"])
    st.publish("payouts", "restated", new, promote=True)
    after = store.freeze(st, "payouts", "prior", [*key, "amount"])  # refused if anything differs
    p = st.read("payouts", "prior").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("double").alias("total"))
    return p.withColumn("untouched", F.lit(before == after) & (F.col("rows") == before["rows"]))


def t15_versions(s: SparkSession, d: str) -> DataFrame:
    """A restatement may change one input only: rows whose scoring rules differ in more than the release, whose normalization does not, or that name no trigger."""
    f = table(s, d, "fct_restatements").distinct()
    bad = (F.col("prior_normalization_version") == F.col("new_normalization_version")) | F.col("trigger_reason").isNull()
    return f.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("prior_scoring_version") != F.col("new_scoring_version")).alias("scoring_changed"), F.count_if(~F.col("prior_split_version").eqNullSafe(F.col("new_split_version"))).alias("split_changed"), F.count_if(bad).alias("violations"))


def t3_grain(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "fct_restatements").distinct().groupBy("period", "recording_mbid", "rights_holder_id").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count(F.lit(1)).alias("grain_rows"), F.count_if(F.col("n") > 1).alias("violations"))


def ag12_digest(s: SparkSession, d: str) -> DataFrame:
    f = table(s, d, "fct_restatements").select("recording_mbid", "rights_holder_id", "change_type", "trigger_reason", F.col("prior_streams").cast("string").alias("prior_streams"))
    return digest.content_digest(f, ["recording_mbid", "rights_holder_id", "change_type", "trigger_reason", "prior_streams"])


def scd2_of_landings(rh: DataFrame) -> DataFrame:
    """All landings applied one after the other as snapshots, each at its own time: open, close, reopen. Lineage is cut after each round."""
    runs = history.landing_times(rh, "generation_run_id", "generated_at").orderBy("no").collect()  # one row per load
    clean = {"display_name": F.lower(stripped("display_name")), "payee_status": F.upper(stripped("payee_status")), "holder_type": F.upper(stripped("holder_type")), "model_scope": F.upper(stripped("model_scope"))}
    rows = rh.select("generation_run_id", upper_key("holder_id").alias("holder_id"), *[c.alias(k) for k, c in clean.items()]).where("holder_id is not null")
    # repeated rows of a landing are united: the smallest attribute tuple stands
    snaps = checkpointed(rows.groupBy("generation_run_id", "holder_id").agg(F.min(F.struct(*ATTRS)).alias("v")).select("generation_run_id", "holder_id", "v.*"))
    h = None
    for r in runs:
        snap, now = snaps.where(F.col("generation_run_id") == r.generation_run_id), F.lit(r["at"])
        h = scd.start_history(snap, "holder_id", ATTRS, now) if h is None else checkpointed(scd.scd2_apply(h, snap, "holder_id", ATTRS, now))
    return h


def sc1_scd2(s: SparkSession, d: str) -> DataFrame:
    h = scd2_of_landings(table(s, d, "rights_holders"))
    return h.select("holder_id", *ATTRS, F.to_date("valid_from").cast("string").alias("valid_from"), F.to_date("valid_to").cast("string").alias("valid_to"))


def w7_with_history(s: SparkSession, d: str) -> DataFrame:
    return scd.with_history(sc1_scd2(s, d), "holder_id")


PUB = f"""
with f as (select distinct {LOW('recording_mbid')} as recording_mbid, {UP('rights_holder_id')} as rights_holder_id, change_type, prior_payout, prior_streams, restated_payout, restated_streams from fct_restatements),
pr as (select recording_mbid, rights_holder_id, sum(prior_payout) as pa, sum(prior_streams) as pc from (select distinct recording_mbid, rights_holder_id, change_type, prior_payout, prior_streams from f) where change_type <> 'HOLDER_ADDED' group by 1, 2),
nw as (select recording_mbid, rights_holder_id, sum(restated_payout) as na, sum(restated_streams) as nc from (select distinct recording_mbid, rights_holder_id, change_type, restated_payout, restated_streams from f) where change_type <> 'HOLDER_REMOVED' group by 1, 2),
dl as (select recording_mbid, rights_holder_id, coalesce(pa, 0) as prior_amount, coalesce(na, 0) as restated_amount, coalesce(na, 0) - coalesce(pa, 0) as delta, cast(coalesce(nc, 0) - coalesce(pc, 0) as bigint) as delta_count,
  case when pa is null then 'HOLDER_ADDED' when na is null then 'HOLDER_REMOVED' when na > pa then 'PAYOUT_INCREASED' when na < pa then 'PAYOUT_DECREASED' else 'UNCHANGED' end as change_type from pr full outer join nw using (recording_mbid, rights_holder_id)),
v1 as (select distinct listen_hash, matched_recording_mbid, {', '.join(FIELDS)} from silver_listen_matches),
v2 as (select distinct listen_hash, matched_recording_mbid, {', '.join(FIELDS)} from silver_listen_matches_restated),
co as (select distinct listen_hash from bronze_listens join v1 using (listen_hash) where failure_reason in ('NO_BLOCK_CANDIDATES', 'NO_LOOKUP_KEY_EMPTY', 'NO_LOOKUP_KEY_PARTIAL')
  and (regexp_matches(coalesce(artist_name, ''), '[ᄀ-ᇿ㄰-㆏가-힣぀-ヿ]') or regexp_matches(coalesce(recording_name, ''), '[ᄀ-ᇿ㄰-㆏가-힣぀-ヿ]')))
"""
_D = lambda *cs: ", ".join(f"cast({c} as double) as {c}" for c in cs)
_KINDS = ["holder_added", "holder_removed", "payout_increased", "payout_decreased", "unchanged"]


# ---- evaluation
def _labels(s: SparkSession, d: str) -> DataFrame:
    """(label_mbid, listen_hash, label_in_catalogue): the raw slice's labels that do not contradict each other."""
    x = table(s, d, "ext_listens_2026_06")
    h = F.sha2(F.concat_ws("|", F.col("user_id").cast("string"), F.unix_micros(F.col("listened_at").cast("timestamp")).cast("string"), "recording_msid"), 256)
    lab = x.where("recording_mbid is not null").select(h.alias("listen_hash"), F.lower("recording_mbid").alias("recording_mbid")).groupBy("listen_hash").agg(F.min("recording_mbid").alias("label_mbid"), F.max("recording_mbid").alias("_m")).where("label_mbid = _m").drop("_m")
    cat = _catalogue(s, d).distinct().select(F.col("recording_mbid").alias("label_mbid"), F.lit(True).alias("_c"))
    return lab.join(cat, "label_mbid", "left").withColumn("label_in_catalogue", F.coalesce("_c", F.lit(False))).drop("_c")


def _labelled(s: SparkSession, d: str) -> DataFrame:
    """Decisions with the raw slice's label and whether it stands in the catalogue."""
    m = table(s, d, "silver_listen_matches").select("listen_hash", "matched_recording_mbid", "match_method", "match_score", "score_margin", "block_method").distinct()
    return m.join(_labels(s, d), "listen_hash", "left").withColumn("label_in_catalogue", F.coalesce("label_in_catalogue", F.lit(False)))


def retrieved(labelled: DataFrame, listens: DataFrame, cands: DataFrame) -> DataFrame:
    """``labelled`` with ``label_retrieved``: the label is one of the candidates of the listen's names."""
    li = listens.select("listen_hash", T.pair_hash(F.col("artist_name"), F.col("recording_name")).alias("pair_hash")).distinct()
    c = cands.select("pair_hash", lower_key("recording_mbid").alias("label_mbid")).distinct()
    lab = labelled.where("label_mbid is not null").select("listen_hash", "label_mbid").distinct()
    hit = lab.join(li, "listen_hash").join(c, ["pair_hash", "label_mbid"], "left_semi").select("listen_hash", "label_mbid", F.lit(True).alias("_r")).distinct()
    return labelled.join(hit, ["listen_hash", "label_mbid"], "left").withColumn("label_retrieved", F.coalesce("_r", F.lit(False))).drop("_r")


def j19_labels(s: SparkSession, d: str) -> DataFrame:
    return _labelled(s, d).groupBy("label_in_catalogue").agg(F.count(F.lit(1)).alias("n"), F.count("label_mbid").alias("labelled"))


def ag21_agreement(s: SparkSession, d: str) -> DataFrame:
    return E.agreement(retrieved(_labelled(s, d), MP._listens(s, d), MP._cands(s, d)), "match_method")


def ag17_auc(s: SparkSession, d: str) -> DataFrame:
    x = _labelled(s, d).where("label_mbid is not null and matched_recording_mbid is not null").withColumn("agrees", F.col("label_mbid") == F.col("matched_recording_mbid"))
    return E.auc(x.withColumn("score", F.round("match_score", 9)), "score", "agrees", "match_method")


def label_items(labels: DataFrame, listens: DataFrame) -> DataFrame:
    """(text_hash, label_mbid, label_in_catalogue, items): labelled listens counted by text and label."""
    ph = T.pair_hash(F.col("artist_name"), F.col("recording_name"))
    li = listens.select("listen_hash", F.sha2(F.concat(ph, F.lit("\u001f"), F.coalesce("release_name", F.lit("~null~"))), 256).alias("text_hash")).distinct()
    return labels.join(li, "listen_hash").groupBy("text_hash", "label_mbid", "label_in_catalogue").agg(F.count(F.lit(1)).alias("items"))


def leave_one_out(feats: DataFrame, items: DataFrame) -> DataFrame:
    """AUC of the equal-weight mean of the features there are, and of each feature left out, over scored candidates of labelled listens."""
    subsets = {"all": 1.0, **{f"without_{f}": 0.0 for f in M.FEATURES}}
    rules = [M.ScoringRules(weights=tuple(0.0 if k == f"without_{f}" else 1.0 for f in M.FEATURES)) for k in subsets]
    v = F.explode(F.array(*[F.struct(F.lit(k).alias("subset"), M.score(r).alias("v")) for k, r in zip(subsets, rules)])).alias("z")
    x = feats.join(items, "text_hash").select((lower_key("recording_mbid") == F.col("label_mbid")).alias("agrees"), "items", v).select("agrees", "items", "z.*")
    return E.auc(x, "v", "agrees", "subset", "items")


def ag18_leave_one_out(s: SparkSession, d: str) -> DataFrame:
    return leave_one_out(MP._feats(s, d), label_items(_labels(s, d), MP._listens(s, d)))


WEIGHT_SETS = {
    "equal_six": (1, 1, 1, 1, 1, 1, 0), "auc_proportional": (0.29, 0.44, 0.32, 0.46, 0.31, 0.45, 0.43), "recording_only": (0, 1, 0, 1, 0, 1, 0), "recording_release": (0, 1, 0, 1, 0, 1, 1),
    "recording_heavy": (0.1, 1, 0.1, 1, 0.1, 1, 0.5), "recording_release_eq": (0, 0.8, 0, 1, 0, 0.9, 0.9),
}
EXACT, FALLBACK, MARGINS = [0.55, 0.65, 0.75, 0.85, 0.9, 0.95, 0.99], [0.65, 0.75, 0.85, 0.9, 0.95, 0.99], [0.02, 0.05, 0.1, 0.2]


def rescored(feats: DataFrame, items: DataFrame) -> DataFrame:
    """Per labelled text, label and weight set: stage, best score, margin to the second (null without one), and what the label says of the best candidate."""
    lab = feats.join(items.select("text_hash").distinct(), "text_hash", "left_semi")
    one = [F.struct(F.lit(k).alias("weight_set"), M.score(M.ScoringRules(weights=tuple(float(x) for x in w))).alias("score")) for k, w in WEIGHT_SETS.items()]
    x = lab.select("text_hash", "recording_mbid", "block_method", F.explode(F.array(*one)).alias("z")).select("text_hash", "recording_mbid", "block_method", "z.*")
    rn = F.row_number().over(W.partitionBy("weight_set", "text_hash").orderBy(F.col("score").desc_nulls_last(), "recording_mbid"))
    at = lambda n, c: F.max(F.when(F.col("rn") == n, F.col(c)))
    top = x.withColumn("rn", rn).where("rn <= 2").groupBy("weight_set", "text_hash").agg(F.min("block_method").alias("m"), F.count(F.lit(1)).alias("n"), at(1, "score").alias("score"), at(2, "score").alias("second"), at(1, "recording_mbid").alias("winner"))
    hit = items.select("text_hash", "label_mbid").join(lab.select("text_hash", lower_key("recording_mbid").alias("label_mbid")).distinct(), ["text_hash", "label_mbid"], "left_semi").withColumn("_r", F.lit(True)).distinct()
    j = top.join(items.join(hit, ["text_hash", "label_mbid"], "left"), "text_hash")
    return j.select(
        "weight_set", F.concat("m", F.when(F.col("n") > 1, "_MULTI").otherwise("_UNIQUE")).alias("stage"), "score", F.round(F.col("score") - F.col("second"), 9).alias("margin"),
        (lower_key("winner") == F.col("label_mbid")).alias("agrees"), F.coalesce("_r", F.lit(False)).alias("label_retrieved"), "label_in_catalogue", "items",
    )


def _grid(s: SparkSession, d: str) -> DataFrame:
    feats, items = checkpointed(MP._feats(s, d)), checkpointed(label_items(_labels(s, d), MP._listens(s, d)))
    return E.grid(rescored(feats, items), EXACT, FALLBACK, MARGINS)


def ag19_grid(s: SparkSession, d: str) -> DataFrame:
    """1,008 cells a stage: weight sets, both thresholds and margins on recomputed scores."""
    return _grid(s, d)


def ag20_choose(s: SparkSession, d: str) -> DataFrame:
    return E.choose(_grid(s, d), 0.02, 1000)


def ag22_disjoint(s: SparkSession, d: str) -> DataFrame:
    """Keys whose labelled rows fall into more than one evaluation part: recordings, which the split keeps apart, and names (msids), which leak where one is labelled with several recordings."""
    x = table(s, d, "ext_listens_2026_06").where("recording_mbid is not null").select(F.lower("recording_mbid").alias("recording_mbid"), "recording_msid", E.partition_of(F.lower("recording_mbid")).alias("part"))
    out = None
    for k in ("recording_mbid", "recording_msid"):
        g = x.groupBy(k).agg(F.count_distinct("part").alias("parts")).agg(F.lit(k).alias("key"), F.count(F.lit(1)).alias("keys"), F.count_if(F.col("parts") > 1).alias("in_several_parts"))
        out = g if out is None else out.unionByName(g)
    return out


def ag14_any_match(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "silver_listen_matches").groupBy("match_tier").agg(F.bool_or(F.col("score_margin") < 0.02).alias("any_thin"), F.bool_and(F.col("match_status") == "MATCHED").alias("all_matched"))


def ag15_quantiles(s: SparkSession, d: str) -> DataFrame:
    """Exact discrete quantiles by counted values."""
    x = table(s, d, "silver_listen_matches").where("match_score is not null").withColumn("one", F.lit(1))
    return E.weighted_quantiles(x, "match_score", "one", [0.1, 0.5, 0.9])


EVAL = f"""
with ex as (select sha256(user_id || '|' || epoch_us(listened_at) || '|' || recording_msid) as listen_hash, lower(recording_mbid) as recording_mbid from ext_listens_2026_06 where recording_mbid is not null),
lab as (select listen_hash, min(recording_mbid) as label_mbid from ex group by 1 having min(recording_mbid) = max(recording_mbid)),
m as (select distinct listen_hash, matched_recording_mbid, match_method, match_score, score_margin, block_method from silver_listen_matches),
ca as (select distinct {LOW('recording_mbid')} as c from bronze_canonical_recordings),
l as (select m.*, label_mbid, ca.c is not null as label_in_catalogue, coalesce(label_mbid = matched_recording_mbid, false) as label_retrieved from m left join lab using (listen_hash) left join ca on ca.c = label_mbid),
ag as (select *, label_mbid = matched_recording_mbid as agrees from l where label_mbid is not null and matched_recording_mbid is not null)
"""


def _auc_sql(value: str, stratum: str, source: str) -> str:
    return f"""select {stratum}, cast(sum(p) as bigint) as positives, cast(sum(n) as bigint) as negatives, round(sum(p * (coalesce(b, 0) + n * 0.5)) / nullif(cast(sum(p) as double) * sum(n), 0), 9) as auc from
(select *, sum(n) over (partition by {stratum} order by v nulls first rows between unbounded preceding and 1 preceding) as b from (select {stratum}, {value} as v, count(*) filter (where agrees) as p, count(*) filter (where not agrees) as n from {source} group by 1, 2)) group by 1"""


# ---- profile and predicates
def ag30_grain(s: SparkSession, d: str) -> DataFrame:
    return profile.grain(table(s, d, "bronze_canonical_recordings"), ["recording_mbid"], ["recording_name", "release_name", "score"])


def ag32_dependency(s: SparkSession, d: str) -> DataFrame:
    return profile.dependency(table(s, d, "ext_listens_2026_06"), "recording_msid", "recording_mbid")


def ag33_presence(s: SparkSession, d: str) -> DataFrame:
    return profile.presence(table(s, d, "bronze_listens"))


def s5_ordered_report(s: SparkSession, d: str) -> DataFrame:
    """The delta report in its reading order."""
    return ag11_summary(s, d).orderBy("change_type")


def ag33_json(s: SparkSession, d: str) -> DataFrame:
    return profile.json_inventory(table(s, d, "events"), "props")


def ag31_key_space(s: SparkSession, d: str) -> DataFrame:
    return profile.key_space_estimate(table(s, d, "bronze_listens"), F.col("recording_msid"), 16)


def p16_formats(s: SparkSession, d: str) -> DataFrame:
    return profile.formats(table(s, d, "ext_listens_2026_06"), ["recording_msid", "recording_mbid"], "listened_at", "2026-06-01", "2026-07-01")


def p1_period(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "ext_listens_2026_06")
    return x.where((F.col("listened_at") >= F.lit("2026-06-10").cast("timestamp_ntz")) & (F.col("listened_at") < F.lit("2026-06-11").cast("timestamp_ntz"))).select("user_id", "recording_msid").distinct()


def p2_reconcile(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "ext_listens_2026_06")
    inside = (F.col("listened_at") >= F.lit("2026-06-01").cast("timestamp_ntz")) & (F.col("listened_at") < F.lit("2026-07-01").cast("timestamp_ntz"))
    return x.agg(F.count(F.lit(1)).alias("total"), F.count_if(inside).alias("in_period"), F.count_if(~inside).alias("out_of_period"), F.count_if(inside.isNull()).alias("unclassified"))


def j23_cross_source(s: SparkSession, d: str) -> DataFrame:
    """The raw slice against the loaded listens on recomputed hash, instant and msid: found, and with the same names."""
    x = table(s, d, "ext_listens_2026_06")
    h = F.sha2(F.concat_ws("|", F.col("user_id").cast("string"), F.unix_micros(F.col("listened_at").cast("timestamp")).cast("string"), "recording_msid"), 256)
    a = x.select(h.alias("listen_hash"), "listened_at", "recording_msid", F.col("artist_name").alias("xa")).distinct()
    b = table(s, d, "bronze_listens").select("listen_hash", "listened_at", "recording_msid", "artist_name", F.lit(True).alias("hit")).distinct()
    j = a.join(b, ["listen_hash", "listened_at", "recording_msid"], "left")
    return j.agg(F.count(F.lit(1)).alias("raw"), F.count("hit").alias("loaded"), F.count_if(F.col("xa").eqNullSafe(F.col("artist_name")) & F.col("hit")).alias("same_artist"))


def j20_unaffected(s: SparkSession, d: str) -> DataFrame:
    return _copy(s, d).select("listen_hash").distinct().join(p12_cohort(s, d), "listen_hash", "left_anti")


def gn1_generated(s: SparkSession, d: str) -> DataFrame:
    """Dated share sets of every recording of the catalogue."""
    x = generator.generate_ownership(_catalogue(s, d))
    return x.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


def gn1_holders(s: SparkSession, d: str) -> DataFrame:
    return generator.generate_holders(s)


def gn2_defects(s: SparkSession, d: str) -> DataFrame:
    """Recordings that come out broken: the quotas' and the orphans."""
    m = generator.RightsModel()
    return generator.defects(_catalogue(s, d), m).unionByName(generator.orphans(s, m))


def injected_detected(universe: DataFrame, m: generator.RightsModel = generator.RightsModel(), labels: DataFrame | None = None) -> DataFrame:
    """(defect, injected, detected, same_digest): the quotas against what the quality rules find in the generated rows, one row per kind.

    The rows are generated twice, the second time from another layout of the universe, and ``same_digest`` compares the contents.
    Reserved holders must have no split; others may have none by chance and do not count.
    """
    s = universe.sparkSession
    if labels is None:
        labels = generator.defects(universe, m).unionByName(generator.orphans(s, m))
    labels = checkpointed(labels)
    x = checkpointed(generator.generate_ownership(universe, m, labels))
    holders = generator.generate_holders(s, m)
    v = ownership.validity(x.withColumn("share_pct", (F.col("share_e4").cast("decimal(18,4)") / 10000).cast("decimal(9,4)")), holders, universe)
    found = {"SHARE_SUM": F.count_if("share_sum_off"), "INVALID_INTERVAL": F.count_if("invalid_interval"), "MISSING_HOLDER": F.count_if("missing_holder")}
    found |= {k: F.count_distinct(F.when(F.col(c), F.col("recording_mbid"))) for k, c in {"OVERLAP": "temporal_overlap", "GAP": "temporal_gap", "ORPHAN_RECORDING": "orphan_recording"}.items()}
    got = v.agg(*[c.alias(k) for k, c in found.items()]).select(F.explode(F.array(*[F.struct(F.lit(k).alias("defect"), F.col(k).alias("detected")) for k in found])).alias("r")).select("r.*")
    idle = holders.where(F.col("holder_id") >= f"GEN-{m.holders - m.reserved:06d}").join(x.select(F.col("rights_holder_id").alias("holder_id")), "holder_id", "left_anti")
    got = got.unionByName(idle.agg(F.lit("HOLDER_WITHOUT_SPLIT").alias("defect"), F.count(F.lit(1)).alias("detected")))
    want = s.createDataFrame([*m.quotas, ("ORPHAN_RECORDING", m.orphans), ("HOLDER_WITHOUT_SPLIT", m.reserved)], "defect string, injected long")
    again = generator.generate_ownership(universe.repartition(7, F.reverse("recording_mbid")), m, labels)
    one, two = (tuple(digest.content_digest(y, x.columns).first()) for y in (x, again))  # a row each
    return want.join(got, "defect", "left").withColumns({"detected": F.coalesce("detected", F.lit(0)), "same_digest": F.lit(one == two)})


def q2_injected(s: SparkSession, d: str) -> DataFrame:
    return injected_detected(_catalogue(s, d).where("recording_mbid is not null").distinct())


def gn3_gap_days(s: SparkSession, d: str) -> DataFrame:
    return generator.uncovered_days(_ranges(s), "2026-06-01", "2026-07-01").select(F.col("day").cast("string").alias("day"))


def f30_dates(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "fct_restatements").select("period").distinct()
    return x.select(F.col("period").cast("string").alias("period"), F.trunc("period", "month").cast("string").alias("first_day"), F.add_months(F.trunc("period", "month"), 1).cast("string").alias("next_month"), F.date_sub("period", 1).cast("string").alias("day_before"))


def f27_rounding(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "fct_restatements").select("recording_mbid", "rights_holder_id", F.round("restated_payout", 2).cast("double").alias("rounded"), F.floor(F.col("restated_payout") * 100).cast("bigint").alias("floor_cents"))
    return x.distinct()


def io7_ranges(s: SparkSession, d: str) -> DataFrame:
    """Time range and rows per source file, as pruning by file statistics needs them."""
    x = table(s, d, "bronze_listens")
    return x.groupBy("source_file").agg(F.min("listened_at").cast("string").alias("first"), F.max("listened_at").cast("string").alias("last"), F.count(F.lit(1)).alias("rows"))


_MIC = "epoch_us(listened_at)"
SQL = {
    "AG4_split_sets": OWN + f"select recording_mbid, split_version_id, {_DATE('valid_from')} as valid_from, {_DATE('valid_to')} as valid_to, cast(share_sum as double) as share_sum, holder_rows, holders, bad_shares from st",
    "AG5_interval_consistency": OWN + "select recording_mbid, split_version_id, intervals from st where intervals > 1",
    "J7_unknown_holders": OWN + "select recording_mbid, split_version_id, unknown_holders from st where unknown_holders > 0",
    "J8_overlap_join": OWN + "select * from ov",
    "W3_interval_gaps": OWN + "select * from gp",
    "O1_validity": OWN + f"select * replace ({_DATE('valid_from')} as valid_from, {_DATE('valid_to')} as valid_to, cast(share_sum as double) as share_sum) from vd",
    "J9_in_force": OWN + f"select recording_mbid, {_DATE('listen_date')} as listen_date, split_version_id from dy join vd using (recording_mbid) where is_valid_set and listen_date >= valid_from and listen_date < valid_to",
    "J10_any_coverage": OWN + f"select recording_mbid, {_DATE('listen_date')} as listen_date from dy where exists (select 1 from st where st.recording_mbid = dy.recording_mbid and listen_date >= valid_from and listen_date < valid_to)",
    "J11_range_lookup": OWN + f"select {_DATE('listen_date')} as listen_date, n_ranges, range_id from rc",
    "J25_catalogue_member": OWN + "select distinct sp.recording_mbid, ca.recording_mbid is not null as in_catalogue from sp left join ca using (recording_mbid)",
    "O2_resolution": OWN + f"select * replace ({_DATE('listen_date')} as listen_date) from re",
    "AG10_waterfall": OWN + "select resolution_status, count(*) as days, count(distinct recording_mbid) as recordings, cast(sum(streams) as bigint) as streams, round(sum(streams) * 100.0::double / (select sum(streams) from re), 6) as pct from re group by 1",
    "A1_allocation": OWN + "select * from al",
    "T7_closure": OWN + "select count(*) as groups, count(*) filter (where u <> a or u - f > n or u < f) as violations from (select max(units) as u, sum(allotted) as a, count(*) as n, sum(floor_units) as f from al group by recording_mbid, split_version_id)",
    "T11_half_open": OWN + "select p, count(*) as probes, count(*) filter (where (day >= valid_from and day < valid_to) <> want) as violations from (select valid_from, valid_to, 'from' as p, valid_from as day, true as want from vd where is_valid_set union all select valid_from, valid_to, 'last', valid_to - 1, true from vd where is_valid_set union all select valid_from, valid_to, 'to', valid_to, false from vd where is_valid_set) group by 1",
    "AG13_holder_lists": OWN + "select recording_mbid, coalesce(string_agg(distinct rights_holder_id, ',' order by rights_holder_id), '') as holders from sp group by 1",
    "T8_changed_holders": OWN + ", b as (select recording_mbid, string_agg(distinct rights_holder_id, ',' order by rights_holder_id) as before from sp where valid_from <= date '2026-06-01' and valid_to > date '2026-06-01' group by 1), a as (select recording_mbid, string_agg(distinct rights_holder_id, ',' order by rights_holder_id) as after from sp where valid_from <= date '2026-06-30' and valid_to > date '2026-06-30' group by 1) select * from b join a using (recording_mbid) where before <> after",
    "Q1_quality_report": OWN + ", hm as (select distinct holder_id, holder_id not in (select rights_holder_id from sp where rights_holder_id is not null) as without_split from ho where holder_id is not null), rd as (select re.*, n_ranges from re join rc using (listen_date)), mm as (select distinct * from silver_listen_matches), q as (" + " union all ".join(f"select '{m}' as model, '{r}' as rule, '{sev}' as severity, '{risk}' as business_impact, count(*) filter (where {c}) as failed_records, count(*) as total_records from {dict(splits='sp', sets='vd', holders='hm', days='rd', matches='mm')[m]}" for r, (m, sev, risk, c) in RULES.items()) + f") select *, round(failed_records / nullif(total_records, 0), 8) as failure_rate, case when failed_records = 0 then 'PASS' else 'FAIL' end as status, case when rule in ({', '.join(repr(r) for r in MUST_BE_ZERO)}) then 'must_be_zero' else 'expected_to_find_defects' end as expectation from q",
    "AG6_recording_days": "select matched_recording_mbid as recording_mbid, strftime(listened_at, '%Y-%m-%d') as listen_date, count(distinct listen_hash) as streams, min(match_method) as min_match_method, max(match_method) as max_match_method from silver_listen_matches where matched_recording_mbid is not null group by 1, 2",
    "R1_delta": PUB + f"select recording_mbid, rights_holder_id, {_D('prior_amount', 'restated_amount', 'delta')}, delta_count, change_type from dl",
    "AG11_delta_summary": PUB + "select change_type, count(*) as n, cast(sum(delta) as double) as delta from dl group by 1",
    "R2_reconciliation": PUB + "select " + ", ".join(f"count(*) filter (where change_type = '{k.upper()}') as rows_{k}" for k in _KINDS) + ", " + ", ".join(f"cast(coalesce(sum(delta) filter (where change_type = '{k.upper()}'), 0) as double) as delta_{k}" for k in _KINDS[:4]) + ", cast(sum(prior_amount) as double) as prior_total, cast(sum(restated_amount) as double) as restated_total, cast(sum(delta) as double) as delta_total, sum(restated_amount) - sum(prior_amount) = sum(delta) as reconciles from dl",
    "AG23_transitions": PUB + "select " + ", ".join(f"v1.{f} as v1_{f}" for f in FIELDS) + ", " + ", ".join(f"v2.{f} as v2_{f}" for f in FIELDS) + ", count(*) as n from v1 join v2 using (listen_hash) group by all",
    "J22_changed_rows": PUB + "select v1.listen_hash from v1 join v2 using (listen_hash) where " + " or ".join(f"v1.{f} is distinct from v2.{f}" for f in ["matched_recording_mbid", *FIELDS]),
    "P12_cohort": PUB + "select * from co",
    "J20_unaffected": PUB + "select distinct listen_hash from v1 where listen_hash not in (select listen_hash from co)",
    "R3_reprocess": MP.base(True) + f""",
v1 as (select distinct listen_hash, matched_recording_mbid, {', '.join(FIELDS)} from silver_listen_matches),
co as (select distinct listen_hash from bronze_listens join v1 using (listen_hash) where failure_reason in ('NO_BLOCK_CANDIDATES', 'NO_LOOKUP_KEY_EMPTY', 'NO_LOOKUP_KEY_PARTIAL')
  and (regexp_matches(coalesce(artist_name, ''), '[ᄀ-ᇿ㄰-㆏가-힣぀-ヿ]') or regexp_matches(coalesce(recording_name, ''), '[ᄀ-ᇿ㄰-㆏가-힣぀-ヿ]')))
select listen_hash, matched_recording_mbid, {', '.join(FIELDS)}, true as recording_cohort from (select distinct listen_hash, text_hash from lt) join mt using (text_hash) where listen_hash in (select listen_hash from co)
union all select *, false from v1 where listen_hash not in (select listen_hash from co)""",
    "R6_single_case": PUB + f"select recording_mbid, rights_holder_id, {_D('prior_amount', 'restated_amount', 'delta')}, delta_count, change_type from dl where recording_mbid = (select recording_mbid from dl group by 1 order by sum(abs(delta)) desc, recording_mbid limit 1)",
    "T13_totals": PUB + "select count(*) as rows, cast(sum(pa) as double) as total, true as untouched from pr",
    "T15_versions": "select count(*) as rows, count(*) filter (where prior_scoring_version <> new_scoring_version) as scoring_changed, count(*) filter (where prior_split_version is distinct from new_split_version) as split_changed, count(*) filter (where prior_normalization_version = new_normalization_version or trigger_reason is null) as violations from (select distinct * from fct_restatements)",
    "T3_grain": "select count(*) as grain_rows, count(*) filter (where n > 1) as violations from (select count(*) as n from (select distinct * from fct_restatements) group by period, recording_mbid, rights_holder_id)",
    # leaves by as many digits as rows need, up to 16 million
    "AG12_digest": "with h as (select sha256(concat_ws(chr(31), coalesce(recording_mbid, ''), coalesce(rights_holder_id, ''), coalesce(change_type, ''), coalesce(trigger_reason, ''), coalesce(prior_streams::varchar, ''))) as h from fct_restatements), n as (select count(*) as rows, case when count(*) > 4096 then 3 else 0 end as depth from h), b as (select substr(h, 1, depth) as p, sha256(string_agg(h, '' order by h)) as d from h, n group by 1) select n.rows, case when depth = 0 then min(d) else sha256(string_agg(d, '' order by p)) end as digest from b, n group by n.rows, depth",
    "SC1_scd2": FS.SCD + "select * from sv",
    "W7_with_history": FS.SCD + "select holder_id, count(*) as versions from sv group by 1 having count(*) > 1",
    "J19_label_join": EVAL + "select label_in_catalogue, count(*) as n, count(label_mbid) as labelled from l group by 1",
    "AG21_agreement": FS.AGREEMENT,
    "AG17_auc": EVAL + _auc_sql("round(match_score, 9)", "match_method", "ag"),
    "AG18_leave_one_out": FS.LEAVE_ONE_OUT,
    "AG19_grid": FS.grid(WEIGHT_SETS, EXACT, FALLBACK, MARGINS) + "select * from gr",
    "AG20_choose": FS.grid(WEIGHT_SETS, EXACT, FALLBACK, MARGINS) + FS.choice(0.02, 1000),
    "AG22_disjoint": "with x as (select lower(recording_mbid) as recording_mbid, recording_msid, case when cast('0x' || substr(sha256('rillmark-dev-1:' || lower(recording_mbid)), 1, 8) as bigint) % 100 >= 80 then 'holdout' when cast('0x' || substr(sha256('rillmark-cal-1:' || lower(recording_mbid)), 1, 8) as bigint) % 100 < 75 then 'calibration' else 'validation' end as part from ext_listens_2026_06 where recording_mbid is not null) " + " union all ".join(f"select '{k}' as key, count(*) as keys, count(*) filter (where n > 1) as in_several_parts from (select count(distinct part) as n from x group by {k})" for k in ("recording_mbid", "recording_msid")),
    "AG14_boolean": "select match_tier, bool_or(score_margin < 0.02) as any_thin, bool_and(match_status = 'MATCHED') as all_matched from silver_listen_matches group by 1",
    "AG15_quantiles": "select unnest([0.1::double, 0.5::double, 0.9::double]) as q, unnest(quantile_disc(match_score, [0.1, 0.5, 0.9])) as match_score from silver_listen_matches where match_score is not null",
    "AG30_grain": "with g as (select count(*) as n, count(distinct t) as whole, count(distinct coalesce(recording_name, '~')) as a, count(distinct coalesce(release_name, '~')) as b, count(distinct coalesce(score::varchar, '~')) as c from bronze_canonical_recordings t group by recording_mbid) select n as rows_per_key, count(*) as keys, cast(sum(n - whole) as bigint) as exact_duplicates, count(*) filter (where greatest(a, b, c) > 1) as keys_differing, count(*) filter (where a > 1) as differs_recording_name, count(*) filter (where b > 1) as differs_release_name, count(*) filter (where c > 1) as differs_score from g group by 1",
    "AG32_dependency": "select kind, count(*) as groups, cast(sum(n) as bigint) as rows from (select count(*) as n, case when count(distinct recording_mbid) > 1 then 'CONFLICTING' when count(recording_mbid) = 0 then 'NONE' when count(recording_mbid) < count(*) then 'MIXED' else 'ALL_SET' end as kind from ext_listens_2026_06 group by recording_msid) group by 1",
    "AG33_presence": " union all ".join(f"select '{c}' as column_name, count({c}) as present, " + (f"count(*) filter (where trim({c}) = '')" if not c.endswith("_at") else "0") + f" as blank, count(*) - count({c}) as absent from bronze_listens" for c in ["listen_hash", "listened_at", "submitted_at", "recording_msid", "artist_name", "recording_name", "release_name", "source_file", "dump_id", "ingestion_run_id", "ingested_at"]),
    "AG31_key_space": "select count(*) * 16 as estimated_keys, max(n) as largest, cast(sum(n) as bigint) as sampled_rows, quantile_disc(n, 0.5) as p50, quantile_disc(n, 0.9) as p90, quantile_disc(n, 0.99) as p99 from (select recording_msid, count(*) as n from bronze_listens where cast('0x' || substr(sha256(recording_msid), 1, 8) as bigint) % 16 = 0 group by 1)",
    "AG33_json_inventory": "with recursive j as (select '' as path, try_cast(props as json) as v, 0 as lvl from events union all select path || case when path = '' then '' else '.' end || k, json_extract(v, '$.\"' || k || '\"'), lvl + 1 from (select path, v, lvl, unnest(json_keys(v)) as k from j where json_type(v) = 'OBJECT' and lvl < 9)) select case when v is null then '' else path end as path, case when v is null then 'INVALID' when json_type(v) in ('UBIGINT', 'BIGINT') then 'BIGINT' when json_type(v) = 'VARCHAR' then 'STRING' else json_type(v) end as type, count(*) as rows from j where lvl > 0 or v is null group by 1, 2",
    "S5_ordered_report": PUB + f"select change_type, count(*) as n, {_D('sum(delta)').replace(' as sum(delta)', ' as delta')} from dl group by 1 order by 1",
    "P16_formats": "select count(*) as rows, " + ", ".join(f"count(*) filter (where not regexp_matches(lower({c}), '{profile.UUID}')) as bad_{c}" for c in ("recording_msid", "recording_mbid")) + ", count(*) filter (where listened_at >= timestamp '2026-06-01' and listened_at < timestamp '2026-07-01') as in_period, count(*) filter (where not (listened_at >= timestamp '2026-06-01' and listened_at < timestamp '2026-07-01')) as out_of_period, count(*) filter (where listened_at is null) as unclassified, count(*) filter (where year(listened_at) not between 2001 and 2030) as implausible from ext_listens_2026_06",
    "P1_period_filter": "select distinct user_id, recording_msid from ext_listens_2026_06 where listened_at >= timestamp '2026-06-10' and listened_at < timestamp '2026-06-11'",
    "P2_reconcile_source": "select count(*) as total, count(*) filter (where listened_at >= timestamp '2026-06-01' and listened_at < timestamp '2026-07-01') as in_period, count(*) filter (where not (listened_at >= timestamp '2026-06-01' and listened_at < timestamp '2026-07-01')) as out_of_period, count(*) filter (where listened_at is null) as unclassified from ext_listens_2026_06",
    "J23_cross_source": "with a as (select distinct sha256(user_id || '|' || epoch_us(listened_at) || '|' || recording_msid) as listen_hash, listened_at, recording_msid, artist_name as xa from ext_listens_2026_06), b as (select distinct listen_hash, listened_at, recording_msid, artist_name, true as hit from bronze_listens) select count(*) as raw, count(hit) as loaded, count(*) filter (where hit and xa is not distinct from artist_name) as same_artist from a left join b using (listen_hash, listened_at, recording_msid)",
    "GN1_generated_splits": FS.GENERATED,
    "GN1_holders": FS.HOLDERS,
    "GN2_defects": FS.DEFECTS,
    "GN3_gap_days": OWN + "select strftime(d, '%Y-%m-%d') as day from (select unnest(generate_series(date '2026-06-01', date '2026-06-30', interval 1 day)) as d) where not exists (select 1 from rg where d >= range_from and d < range_to)",
    "Q2_injected_detected": FS.DETECTED,
    "F30_dates": "select distinct strftime(period, '%Y-%m-%d') as period, strftime(date_trunc('month', period), '%Y-%m-%d') as first_day, strftime(date_trunc('month', period) + interval 1 month, '%Y-%m-%d') as next_month, strftime(period - 1, '%Y-%m-%d') as day_before from fct_restatements",
    "F27_rounding": "select distinct recording_mbid, rights_holder_id, cast(round(restated_payout, 2) as double) as rounded, cast(floor(restated_payout * 100) as bigint) as floor_cents from fct_restatements",
    "IO7_file_ranges": "select source_file, cast(min(listened_at) as varchar) as first, cast(max(listened_at) as varchar) as last, count(*) as rows from bronze_listens group by 1",
}
QUERIES = {
    "AG4_split_sets": ag4_sets, "AG5_interval_consistency": ag5_intervals, "J7_unknown_holders": j7_unknown, "J8_overlap_join": j8_overlaps, "W3_interval_gaps": w3_gaps, "O1_validity": o1_validity, "J9_in_force": j9_in_force,
    "J10_any_coverage": j10_covered, "J11_range_lookup": j11_ranges, "J25_catalogue_member": j25_catalogue, "O2_resolution": o2_resolution, "AG10_waterfall": ag10_waterfall, "A1_allocation": a1_allocation, "T7_closure": t7_closure,
    "T11_half_open": t11_half_open, "AG13_holder_lists": ag13_holder_lists, "T8_changed_holders": t8_changed_holders, "Q1_quality_report": q1_quality, "AG6_recording_days": ag6_recording_days, "R1_delta": r1_delta, "AG11_delta_summary": ag11_summary,
    "R2_reconciliation": r2_reconciliation, "AG23_transitions": ag23_transitions, "J22_changed_rows": j22_changed, "P12_cohort": p12_cohort, "J20_unaffected": j20_unaffected, "R3_reprocess": r3_reprocess, "R6_single_case": r6_case,
    "T13_totals": t13_totals, "T15_versions": t15_versions, "T3_grain": t3_grain, "AG12_digest": ag12_digest, "SC1_scd2": sc1_scd2, "W7_with_history": w7_with_history, "J19_label_join": j19_labels, "AG21_agreement": ag21_agreement,
    "AG17_auc": ag17_auc, "AG18_leave_one_out": ag18_leave_one_out, "AG19_grid": ag19_grid, "AG20_choose": ag20_choose, "AG22_disjoint": ag22_disjoint, "AG14_boolean": ag14_any_match, "AG15_quantiles": ag15_quantiles,
    "AG30_grain": ag30_grain, "AG32_dependency": ag32_dependency, "AG33_presence": ag33_presence, "AG33_json_inventory": ag33_json, "S5_ordered_report": s5_ordered_report, "AG31_key_space": ag31_key_space, "P16_formats": p16_formats, "P1_period_filter": p1_period,
    "P2_reconcile_source": p2_reconcile, "J23_cross_source": j23_cross_source, "GN1_generated_splits": gn1_generated, "GN1_holders": gn1_holders, "GN2_defects": gn2_defects, "Q2_injected_detected": q2_injected, "GN3_gap_days": gn3_gap_days, "F30_dates": f30_dates,
    "F27_rounding": f27_rounding, "IO7_file_ranges": io7_ranges,
}
