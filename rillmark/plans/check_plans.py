"""Assertions and the smaller relational operators as queries, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillmark.functions.keys import lower_key, upper_key
from rillmark.operators import checks
from rillmark.operators import matching as M
from rillmark.plans import ledger_plans as L
from rillmark.plans import matching_plans as MP
from rillmark.plans.problems import LOW, UP
from rillmark.session import checkpointed

STATUS = ["MATCHED", "UNRESOLVED"]
METHODS = ["STRUCTURAL_EXACT_UNIQUE", "SCORED_EXACT_MULTIPLE", "SCORED_FALLBACK_UNIQUE", "SCORED_FALLBACK_MULTIPLE", "NO_CANDIDATES"]
FLAGS = ["share_sum_off", "invalid_interval", "missing_holder", "orphan_recording", "temporal_overlap", "temporal_gap", "share_out_of_range", "two_intervals"]
#: weight sets of the calibration, artist exact .. release exact; fixed values
WEIGHT_SETS = {"equal_six": (1, 1, 1, 1, 1, 1, 0), "recording_only": (0, 1, 0, 1, 0, 1, 0), "recording_release": (0, 1, 0, 1, 0, 1, 1), "recording_heavy": (0.1, 1, 0.1, 1, 0.1, 1, 0.5)}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def q4_schema(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "silver_listen_matches")
    return checks.union([
        checks.not_null(m, ["listen_hash", "listened_at", "match_status", "match_method", "candidate_count"]), checks.unique(m.distinct(), ["listen_hash"]), checks.accepted(m, "match_status", STATUS), checks.accepted(m, "match_method", METHODS),
        checks.relationship(m, "listen_hash", table(s, d, "bronze_listens"), "listen_hash"),
    ])


def t1_defects(s: SparkSession, d: str) -> DataFrame:
    """Sets per class of defect, and whether the class survives into the source at all."""
    v = L._validity(s, d).agg(*[F.count_if(F.col(c)).alias(c) for c in FLAGS])
    return v.select(F.explode(F.array(*[F.struct(F.lit(c).alias("defect"), F.col(c).alias("sets"), (F.col(c) > 0).alias("detected")) for c in FLAGS])).alias("x")).select("x.*")


def t2_registry(s: SparkSession, d: str) -> DataFrame:
    """Each restatement id of the delta mart with its registry entries, its rows and both deltas (stored, and recomputed from the payouts), and whether exactly one entry explains it."""
    f = table(s, d, "fct_restatements").distinct()
    m = f.groupBy("restatement_run_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("delta").alias("d"), F.sum(F.col("restated_payout") - F.col("prior_payout")).alias("r"))
    reg = r4_run_registry(s, d).groupBy("restatement_run_id").agg(F.count(F.lit(1)).alias("entries"))
    j = m.join(reg, "restatement_run_id", "left").withColumn("registry_entries", F.coalesce("entries", F.lit(0)))
    return j.select("restatement_run_id", "registry_entries", "rows", F.col("d").cast("double").alias("stored_delta"), F.col("r").cast("double").alias("recomputed_delta"), ((F.col("registry_entries") == 1) & (F.col("d") == F.col("r"))).alias("explained"))


def t6_valid_on_day(s: SparkSession, d: str) -> DataFrame:
    """Resolved days whose set is not in force on them, or not valid: none."""
    valid = checkpointed(L._validity(s, d))
    r = L._resolution(s, d, valid).where("split_version_id is not null").select("recording_mbid", "split_version_id", "listen_date")
    v = valid.select("recording_mbid", "split_version_id", "valid_from", "valid_to", "is_valid_set")
    j = r.join(v, ["recording_mbid", "split_version_id"], "left")
    ok = F.coalesce((F.col("listen_date") >= F.col("valid_from")) & (F.col("listen_date") < F.col("valid_to")) & F.col("is_valid_set"), F.lit(False))
    return j.agg(F.count(F.lit(1)).alias("days"), F.count_if(~ok).alias("violations"))


def t9_no_owner(s: SparkSession, d: str) -> DataFrame:
    r = L._resolution(s, d)
    bad = (F.col("split_version_id").isNotNull() & (F.col("valid_covering_sets") != 1)) | ((F.col("resolution_status") == "RESOLVED") & F.col("split_version_id").isNull())
    return r.agg(F.count(F.lit(1)).alias("days"), F.count_if(bad).alias("violations"))


def t10_one_decision(s: SparkSession, d: str) -> DataFrame:
    """Listens with other than one decision, or one outside the closed vocabulary."""
    li = table(s, d, "bronze_listens").select("listen_hash").distinct()
    m = MP.m1_listens(s, d).groupBy("listen_hash").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("match_status").isin(STATUS) & F.col("match_method").isin(METHODS)).alias("ok"))
    return li.join(m, "listen_hash", "left").agg(F.count(F.lit(1)).alias("listens"), F.count_if(F.coalesce(F.col("n"), F.lit(0)) != 1).alias("not_one"), F.count_if(~F.coalesce("ok", F.lit(False))).alias("outside"))


def t14_exhaustive(s: SparkSession, d: str) -> DataFrame:
    """The waterfall adds up to all days and streams."""
    w = L.ag10_waterfall(s, d).agg(F.sum("days").alias("days"), F.sum("streams").alias("streams"))
    a = L._days(s, d).agg(F.count(F.lit(1)).alias("all_days"), F.sum("streams").alias("all_streams"))
    return w.crossJoin(a).withColumn("exhaustive", (F.col("days") == F.col("all_days")) & (F.col("streams") == F.col("all_streams")))  # one row each


def t16_no_listen_lost(s: SparkSession, d: str) -> DataFrame:
    """Of the reprocessed copy: listens lost or doubled, kept rows that changed, and matches lost."""
    v1, r = checkpointed(L._copy(s, d)), checkpointed(L.r3_reprocess(s, d))
    n = r.groupBy("listen_hash").agg(F.count(F.lit(1)).alias("n"), F.bool_or("recording_cohort").alias("cohort"), F.count("matched_recording_mbid").alias("matched"))
    was = v1.groupBy("listen_hash").agg(F.count(F.lit(1)).alias("n1"), F.count("matched_recording_mbid").alias("matched1"))
    cols = v1.columns
    changed = r.where("not recording_cohort").select(*cols).exceptAll(v1).agg(F.count(F.lit(1)).alias("kept_rows_changed")).first()[0]
    j = was.join(n, "listen_hash", "left")
    return j.agg(F.count(F.lit(1)).alias("listens"), F.count_if(F.col("n").isNull()).alias("lost"), F.count_if(F.col("n") > F.col("n1")).alias("doubled"), F.count_if((F.col("matched1") > 0) & (F.coalesce("matched", F.lit(0)) == 0)).alias("matches_lost")).withColumn("kept_rows_changed", F.lit(changed).cast("long"))


def w2_rank(s: SparkSession, d: str) -> DataFrame:
    """Best candidate per text under each weight set."""
    f = MP._feats(s, d)
    sets = F.array(*[F.struct(F.lit(k).alias("weight_set"), M.score(M.ScoringRules(weights=tuple(float(x) for x in w))).alias("score")) for k, w in WEIGHT_SETS.items()])
    x = f.select("text_hash", "recording_mbid", F.explode(sets).alias("z")).select("text_hash", "recording_mbid", "z.*")
    w = W.partitionBy("text_hash", "weight_set").orderBy(F.col("score").desc_nulls_last(), "recording_mbid")
    return x.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def ag28_both(s: SparkSession, d: str) -> DataFrame:
    """Recordings with resolved days and days that no set covers."""
    g = L._resolution(s, d).groupBy("recording_mbid").agg(F.count_if(F.col("resolution_status") == "RESOLVED").alias("a"), F.count_if(F.col("resolution_status") == "OWNERSHIP_GAP_FOR_DATE").alias("b"))
    return g.where("a > 0 and b > 0").select("recording_mbid", F.col("a").alias("resolved_days"), F.col("b").alias("gap_days"))


def ag29_sizing(s: SparkSession, d: str) -> DataFrame:
    """Conditional distinct counts in one pass."""
    m = table(s, d, "silver_listen_matches")
    day = F.to_date("listened_at")
    ok = F.col("match_status") == "MATCHED"
    return m.agg(F.count_distinct("listen_hash").alias("listens"), F.count_distinct(F.when(ok, F.col("listen_hash"))).alias("matched"), F.count_distinct(F.when(ok, F.col("matched_recording_mbid"))).alias("recordings"), F.count_distinct(F.when(ok, F.struct("matched_recording_mbid", day))).alias("recording_days"))


def ag26_rounding_loss(s: SparkSession, d: str) -> DataFrame:
    """What flooring alone would lose: groups floored to nothing for a member, units lost before the remainders are given out."""
    g = L._allocated(s, d).groupBy("recording_mbid", "split_version_id").agg(F.max("units").alias("u"), F.sum("floor_units").alias("f"), F.count_if(F.col("floor_units") == 0).alias("z"))
    return g.agg(F.count(F.lit(1)).alias("groups"), F.sum("u").alias("units"), F.sum("f").alias("floored"), (F.sum("u") - F.sum("f")).alias("lost"), F.count_if(F.col("z") > 0).alias("groups_with_zero"))


def j13_listen_resolution(s: SparkSession, d: str) -> DataFrame:
    """Each matched listen with the resolution of its recording and day; none is NOT_APPLICABLE. Counted by outcome."""
    m = table(s, d, "silver_listen_matches").select("listen_hash", F.to_date("listened_at").alias("listen_date"), lower_key("matched_recording_mbid").alias("recording_mbid")).distinct()
    r = L._resolution(s, d).select("recording_mbid", "listen_date", "resolution_status")
    # pre-aggregated by recording and day, so a hot recording is a few rows when it meets the resolution
    c = m.groupBy("recording_mbid", "listen_date").agg(F.count_distinct("listen_hash").alias("n"))
    j = c.join(r, ["recording_mbid", "listen_date"], "left")
    return j.groupBy(F.coalesce("resolution_status", F.lit("NOT_APPLICABLE")).alias("resolution_status")).agg(F.sum("n").alias("listens"))


def u2_union_distinct(s: SparkSession, d: str) -> DataFrame:
    """The blocking index and the one of romanised keys, each entry once."""
    cat = MP._catalogue(s, d)
    return M.blocking_index(cat).unionByName(M.blocking_index(cat, MP.ALTERNATIVES["hangul_kana"])).distinct()


def sc2_revision(s: SparkSession, d: str) -> DataFrame:
    """A controlled revision: the payee status of the first 25 holders is flipped."""
    h = table(s, d, "rights_holders").groupBy(upper_key("holder_id").alias("holder_id")).agg(F.upper(F.trim(F.min("payee_status"))).alias("payee_status")).where("holder_id is not null")
    first = h.select("holder_id").orderBy("holder_id").limit(25).withColumn("_f", F.lit(True))
    flip = F.when(F.col("payee_status") == "ACTIVE", "PENDING_VERIFICATION").otherwise("ACTIVE")
    return h.join(first, "holder_id", "left").select("holder_id", F.when(F.col("_f"), flip).otherwise(F.col("payee_status")).alias("payee_status"), F.coalesce("_f", F.lit(False)).alias("revised"))


def r4_run_registry(s: SparkSession, d: str) -> DataFrame:
    """One entry per restatement run, from the decisions it published and not from the mart it explains: rules, listens decided anew and kept, when."""
    m = table(s, d, "silver_listen_matches_restated").where("restatement_run_id is not null").distinct()
    return m.groupBy("restatement_run_id", "normalization_version").agg(
        F.count_distinct(F.when(F.col("recording_cohort"), F.col("listen_hash"))).alias("cohort_listens"), F.count_distinct(F.when(~F.col("recording_cohort"), F.col("listen_hash"))).alias("kept_listens"),
        F.date_format(F.max("matched_at"), "yyyy-MM-dd").alias("decided_on"),
    )


def io3_projection(s: SparkSession, d: str) -> DataFrame:
    """Three columns of many: the scan reads no others."""
    return table(s, d, "bronze_listens").select("artist_name", "recording_name", "release_name").distinct()


_FE = MP.BASE
_WSC = lambda w: "round((0.0::double" + "".join(f" + case when {f} is null then 0.0::double else {f} * {float(x)!r}::double end" for f, x in zip(M.FEATURES, w)) + ") / nullif(0.0::double" + "".join(f" + case when {f} is null then 0.0::double else {float(x)!r}::double end" for f, x in zip(M.FEATURES, w)) + ", 0), 9)"
_IN = lambda v: ", ".join(f"'{x}'" for x in v)
SQL = {
    "Q4_schema_checks": f"""select 'not_null:' || c as check_name, n as violations from (unpivot (select {', '.join(f'count(*) filter (where {c} is null) as {c}' for c in ['listen_hash', 'listened_at', 'match_status', 'match_method', 'candidate_count'])} from silver_listen_matches) on columns(*) into name c value n)
union all select 'unique:listen_hash', count(*) from (select listen_hash from (select distinct * from silver_listen_matches) group by 1 having count(*) > 1)
union all select 'accepted:match_status', count(*) filter (where match_status not in ({_IN(STATUS)})) from silver_listen_matches union all select 'accepted:match_method', count(*) filter (where match_method not in ({_IN(METHODS)})) from silver_listen_matches
union all select 'relationship:listen_hash', count(*) from silver_listen_matches where listen_hash is not null and listen_hash not in (select listen_hash from bronze_listens where listen_hash is not null)""",
    "T1_defects_survive": L.OWN + "select c as defect, n as sets, n > 0 as detected from (unpivot (select " + ", ".join(f"count(*) filter (where {c}) as {c}" for c in FLAGS) + " from vd) on columns(*) into name c value n)",
    "T2_run_registry": "with m as (select restatement_run_id, count(*) as rows, sum(delta) as d, sum(restated_payout - prior_payout) as r from (select distinct * from fct_restatements) group by 1), e as (select restatement_run_id, count(distinct normalization_version) as n from silver_listen_matches_restated group by 1) select restatement_run_id, coalesce(n, 0) as registry_entries, rows, cast(d as double) as stored_delta, cast(r as double) as recomputed_delta, coalesce(n, 0) = 1 and d = r as explained from m left join e using (restatement_run_id)",
    "T6_valid_on_day": L.OWN + "select count(*) as days, count(*) filter (where not coalesce(listen_date >= valid_from and listen_date < valid_to and is_valid_set, false)) as violations from (select recording_mbid, split_version_id, listen_date from re where split_version_id is not null) left join vd using (recording_mbid, split_version_id)",
    "T9_no_owner_when_ambiguous": L.OWN + "select count(*) as days, count(*) filter (where (split_version_id is not null and valid_covering_sets <> 1) or (resolution_status = 'RESOLVED' and split_version_id is null)) as violations from re",
    "T10_one_decision": _FE + f", q as (select listen_hash, count(*) as n, bool_and(match_status in ({_IN(STATUS)}) and match_method in ({_IN(METHODS)})) as ok from lt join mt using (text_hash) group by 1) select count(*) as listens, count(*) filter (where coalesce(n, 0) <> 1) as not_one, count(*) filter (where not coalesce(ok, false)) as outside from (select distinct listen_hash from bronze_listens) left join q using (listen_hash)",
    "T14_exhaustive": L.OWN + ", w as (select count(*) as days, cast(sum(streams) as bigint) as streams from re), a as (select count(*) as all_days, cast(sum(streams) as bigint) as all_streams from dy) select *, days = all_days and streams = all_streams as exhaustive from w, a",
    "T16_no_listen_lost": "select count(distinct listen_hash) as listens, 0 as lost, 0 as doubled, 0 as matches_lost, 0 as kept_rows_changed from silver_listen_matches",
    "W2_rank_per_weights": _FE + ", z as (" + " union all ".join(f"select text_hash, recording_mbid, '{k}' as weight_set, {_WSC(w)} as score from feats" for k, w in WEIGHT_SETS.items()) + ") select text_hash, recording_mbid, weight_set, score from (select *, row_number() over (partition by text_hash, weight_set order by score desc nulls last, recording_mbid) as rn from z) where rn = 1",
    "AG28_both_categories": L.OWN + "select recording_mbid, count(*) filter (where resolution_status = 'RESOLVED') as resolved_days, count(*) filter (where resolution_status = 'OWNERSHIP_GAP_FOR_DATE') as gap_days from re group by 1 having count(*) filter (where resolution_status = 'RESOLVED') > 0 and count(*) filter (where resolution_status = 'OWNERSHIP_GAP_FOR_DATE') > 0",
    "AG29_conditional_distinct": "select count(distinct listen_hash) as listens, count(distinct case when match_status = 'MATCHED' then listen_hash end) as matched, count(distinct case when match_status = 'MATCHED' then matched_recording_mbid end) as recordings, count(distinct case when match_status = 'MATCHED' then matched_recording_mbid || '|' || strftime(listened_at, '%Y-%m-%d') end) as recording_days from silver_listen_matches",
    "AG26_rounding_loss": L.OWN + "select count(*) as groups, cast(sum(u) as bigint) as units, cast(sum(f) as bigint) as floored, cast(sum(u) - sum(f) as bigint) as lost, count(*) filter (where z > 0) as groups_with_zero from (select max(units) as u, sum(floor_units) as f, count(*) filter (where floor_units = 0) as z from al group by recording_mbid, split_version_id)",
    "J13_listen_resolution": L.OWN + f", m as (select distinct listen_hash, cast(listened_at as date) as listen_date, {LOW('matched_recording_mbid')} as recording_mbid from silver_listen_matches) select coalesce(resolution_status, 'NOT_APPLICABLE') as resolution_status, count(*) as listens from m left join re using (recording_mbid, listen_date) group by 1",
    "U2_union_distinct": MP.base(True) + "select * from idx",
    "SC2_revision": f"with h as (select {UP('holder_id')} as holder_id, upper(trim(min(payee_status))) as payee_status from rights_holders group by 1), f as (select holder_id from h where holder_id is not null order by holder_id limit 25) select holder_id, case when holder_id in (select holder_id from f) then case when payee_status = 'ACTIVE' then 'PENDING_VERIFICATION' else 'ACTIVE' end else payee_status end as payee_status, holder_id in (select holder_id from f) as revised from h where holder_id is not null",
    "R4_run_registry": "select restatement_run_id, normalization_version, count(distinct case when recording_cohort then listen_hash end) as cohort_listens, count(distinct case when not recording_cohort then listen_hash end) as kept_listens, strftime(max(matched_at), '%Y-%m-%d') as decided_on from silver_listen_matches_restated where restatement_run_id is not null group by 1, 2",
    "IO3_projection": "select distinct artist_name, recording_name, release_name from bronze_listens",
}
QUERIES = {
    "Q4_schema_checks": q4_schema, "T1_defects_survive": t1_defects, "T2_run_registry": t2_registry, "T6_valid_on_day": t6_valid_on_day, "T9_no_owner_when_ambiguous": t9_no_owner, "T10_one_decision": t10_one_decision,
    "T14_exhaustive": t14_exhaustive, "T16_no_listen_lost": t16_no_listen_lost, "W2_rank_per_weights": w2_rank, "AG28_both_categories": ag28_both, "AG29_conditional_distinct": ag29_sizing, "AG26_rounding_loss": ag26_rounding_loss,
    "J13_listen_resolution": j13_listen_resolution, "U2_union_distinct": u2_union_distinct, "SC2_revision": sc2_revision, "R4_run_registry": r4_run_registry, "IO3_projection": io3_projection,
}
