"""The general training-data problems over the domain tables, and their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions.keys import lower_key, stripped, upper_key
from rillmark.operators import asof, diff, history, intervals, orphans
from rillmark.session import shared_dir

ATTRS = ["display_name", "holder_type", "payee_status", "model_scope"]
MATCH_FIELDS = ["listened_at", "matched_recording_mbid", "match_status", "match_tier", "match_method", "match_score", "score_margin", "failure_reason", "block_method", "candidate_count", "blocking_key_information_class"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _splits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ownership_splits").withColumns({"recording_mbid": lower_key("recording_mbid"), "rights_holder_id": upper_key("rights_holder_id")})


# ---- 2: intervals
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    runs = intervals.sweep(_splits(spark, d), "recording_mbid", "split_version_id", "valid_from", "valid_to", ("overlap", "gap"))
    return runs.select("case_kind", "recording_mbid", F.col("day_from").cast("string").alias("day_from"), F.col("day_to").cast("string").alias("day_to"))


def p2_periods(spark: SparkSession, d: str) -> DataFrame:
    """The continuous periods of each recording."""
    runs = intervals.sweep(_splits(spark, d), "recording_mbid", "split_version_id", "valid_from", "valid_to", ("period",))
    return runs.select("recording_mbid", F.col("day_from").cast("string").alias("day_from"), F.col("day_to").cast("string").alias("day_to"))


STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
LOW = lambda c: f"nullif(lower({STRIP.format(c)}), '')"
UP = lambda c: f"nullif(upper({STRIP.format(c)}), '')"

_RUNS_SQL = f"""
with r as (select distinct {LOW('recording_mbid')} as k, split_version_id as i, valid_from as a, valid_to as b from ownership_splits where valid_from < valid_to),
rows_ as (select * from r where k is not null and i is not null),
own as (select k, i, a, b, max(b) over (partition by k, i order by a, b rows between unbounded preceding and 1 preceding) as reach from rows_),
isl as (select k, i, a, b, sum(case when reach is null or a > reach then 1 else 0 end) over (partition by k, i order by a, b) as g from own),
u as (select k, i, min(a) as a, max(b) as b from isl group by k, i, g),
cuts as (select distinct k, day from (select k, a as day from u union all select k, b from u)),
seg as (select k, day as a, lead(day) over (partition by k order by day) as b from cuts),
lev as (select s.k, s.a, s.b, (select count(*) from u where u.k = s.k and u.a <= s.a and u.b >= s.b) as n from seg s where s.b is not null),
kinds as (select 'overlap' as case_kind, k, a, b from lev where n >= 2 union all select 'gap', k, a, b from lev where n = 0 union all select 'period', k, a, b from lev where n >= 1),
j as (select *, case when lag(b) over (partition by case_kind, k order by a) = a then 0 else 1 end as brk from kinds),
gr as (select *, sum(brk) over (partition by case_kind, k order by a) as g from j)
"""
P2_SQL = _RUNS_SQL + "select case_kind, k as recording_mbid, strftime(min(a), '%Y-%m-%d') as day_from, strftime(max(b), '%Y-%m-%d') as day_to from gr where case_kind <> 'period' group by case_kind, k, g"
P2_PERIODS_SQL = _RUNS_SQL + "select k as recording_mbid, strftime(min(a), '%Y-%m-%d') as day_from, strftime(max(b), '%Y-%m-%d') as day_to from gr where case_kind = 'period' group by k, g"


# ---- 3: orphans
def _graph(spark: SparkSession, d: str) -> orphans.Graph:
    s = _splits(spark, d).select("recording_mbid", "split_version_id", "rights_holder_id", "generated_at", F.to_date("generated_at").alias("_known_on")).distinct()
    rh = table(spark, d, "rights_holders")
    times = history.landing_times(rh, "generation_run_id", "generated_at").select("generation_run_id", F.col("at").alias("seen"))
    holders = rh.select(upper_key("holder_id").alias("key"), "generation_run_id").distinct().join(F.broadcast(times), "generation_run_id").select("key", "seen")
    # broadcast: one row per load of the table
    cat = table(spark, d, "bronze_canonical_recordings").select(lower_key("recording_mbid").alias("key"), F.col("snapshot_date").alias("seen"))
    fct = table(spark, d, "fct_restatements").select(lower_key("recording_mbid").alias("recording_mbid"), upper_key("rights_holder_id").alias("rights_holder_id"), "period", "new_split_version").distinct()
    return orphans.Graph(
        tables={"ownership_splits": s, "fct_restatements": fct},
        presence={"rights_holders": orphans.Presence(holders, deletes=True), "bronze_canonical_recordings": orphans.Presence(cat)},
        references=[
            orphans.Reference("ownership_splits", "rights_holder_id", "rights_holders", "generated_at"),
            orphans.Reference("ownership_splits", "recording_mbid", "bronze_canonical_recordings", "_known_on"),
        ],
        links=[("fct_restatements", "new_split_version", "ownership_splits", "split_version_id")],
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    o = orphans.cascade(_graph(spark, d), {"ownership_splits"})["ownership_splits"]
    return o.where("orphan_level = 0").select("ref_field", "orphan_state", F.date_format("generated_at", "yyyy-MM").alias("period"), "recording_mbid", "split_version_id", "rights_holder_id").distinct()


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan rows per table, field, state and month: direct in ownership_splits, inherited in fct_restatements."""
    o = orphans.cascade(_graph(spark, d))
    a = o["ownership_splits"].select(F.lit("ownership_splits").alias("child_table"), "ref_field", "orphan_state", F.date_format("generated_at", "yyyy-MM").alias("period"), "recording_mbid", "split_version_id", "rights_holder_id").distinct()
    b = o["fct_restatements"].select(F.lit("fct_restatements").alias("child_table"), "ref_field", "orphan_state", F.date_format("period", "yyyy-MM").alias("period"))
    keys = ["child_table", "ref_field", "orphan_state", "period"]
    return a.select(*keys).unionByName(b.select(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("orphan_rows"))


_ORPHAN_SQL = f"""
with s as (select distinct {LOW('recording_mbid')} as recording_mbid, split_version_id, {UP('rights_holder_id')} as rights_holder_id, generated_at from ownership_splits),
lt as (select generation_run_id, min(generated_at) as seen from rights_holders where generation_run_id is not null group by 1),
h as (select distinct {UP('r.holder_id')} as key, lt.seen from rights_holders r join lt using (generation_run_id)),
hf as (select key, min(seen) as first_seen from h group by 1),
c as (select {LOW('recording_mbid')} as key, min(snapshot_date) as first_seen from bronze_canonical_recordings group by 1),
ho as (select s.*, case when hf.key is null then 'missing' when hf.first_seen > s.generated_at then 'late'
       when not exists (select 1 from h where h.key = s.rights_holder_id and h.seen = (select max(seen) from lt where lt.seen <= s.generated_at)) then 'deleted' end as st
       from s left join hf on hf.key = s.rights_holder_id where s.rights_holder_id is not null),
co as (select s.*, case when c.key is null then 'missing' when c.first_seen > cast(s.generated_at as date) then 'late' end as st
       from s left join c on c.key = s.recording_mbid where s.recording_mbid is not null),
o as (select 'rights_holder_id' as ref_field, * from ho where st is not null union all select 'recording_mbid', * from co where st is not null),
found as (select distinct ref_field, st as orphan_state, strftime(generated_at, '%Y-%m') as period, recording_mbid, split_version_id, rights_holder_id from o)
"""
P3_SQL = _ORPHAN_SQL + "select * from found"
P3_REPORT_SQL = _ORPHAN_SQL + f"""
, f as (select distinct {LOW('recording_mbid')} as r, {UP('rights_holder_id')} as h, period, new_split_version from fct_restatements),
inh as (select * from f where new_split_version in (select split_version_id from o)),
u as (select 'ownership_splits' as child_table, ref_field, orphan_state, period from found
      union all select 'fct_restatements', 'new_split_version', 'inherited', strftime(period, '%Y-%m') from inh)
select child_table, ref_field, orphan_state, period, count(*) as orphan_rows from u group by all"""


# ---- 5: as known at event time
def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "int_eligible_recording_days").select(lower_key("recording_mbid").alias("recording_mbid"), "listen_date").distinct()


def _known_versions(spark: SparkSession, d: str, *wide: str) -> DataFrame:
    s = _splits(spark, d)
    known = F.greatest(F.col("valid_from"), F.to_date("generated_at"))
    s = s.where("generated_at is not null and valid_from is not null and split_version_id is not null")
    return s.select("recording_mbid", "split_version_id", known.alias("_start"), F.col("valid_to").alias("_end"), *wide).distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    j = asof.in_force(_events(spark, d), _known_versions(spark, d), "recording_mbid", "listen_date", "_start", "_end")
    return j.select("recording_mbid", F.col("listen_date").cast("string").alias("listen_date"), "split_version_id").distinct()


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    """Recording-days with the wide attributes (holder and share) of the sets in force and known."""
    j = asof.in_force(_events(spark, d), _known_versions(spark, d, "rights_holder_id", "share_pct"), "recording_mbid", "listen_date", "_start", "_end")
    return j.select("recording_mbid", F.col("listen_date").cast("string").alias("listen_date"), "split_version_id", "rights_holder_id", "share_pct").distinct()


_P5 = f"""
with e as (select distinct {LOW('recording_mbid')} as recording_mbid, listen_date from int_eligible_recording_days),
s as (select {LOW('recording_mbid')} as recording_mbid, {UP('rights_holder_id')} as rights_holder_id, split_version_id, share_pct, valid_from, valid_to, generated_at from ownership_splits where split_version_id is not null)
select distinct e.recording_mbid, strftime(e.listen_date, '%Y-%m-%d') as listen_date, s.split_version_id{{}}
from e join s on s.recording_mbid = e.recording_mbid and s.valid_from <= e.listen_date and e.listen_date < s.valid_to
and s.generated_at < e.listen_date + interval 1 day
"""
P5_SQL, P5_SHARES_SQL = _P5.replace("{}", ""), _P5.replace("{}", ", s.rights_holder_id, s.share_pct")


# ---- 6: history
def _cleaned_holders(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "rights_holders")
    return h.select(upper_key("holder_id").alias("holder_id"), F.lower(stripped("display_name")).alias("display_name"), *[F.upper(stripped(a)).alias(a) for a in ATTRS[1:]], "generation_run_id", "generated_at")


def holder_versions(spark: SparkSession, d: str, every: int = 4) -> DataFrame:
    """The landings written as a store of checkpoints and patches in the shared folder, and its versions."""
    path = f"{shared_dir(spark)}/rillmark-history-{uuid.uuid4().hex}"
    rows = _cleaned_holders(spark, d)
    history.write_store(history.build_store(rows, "holder_id", ATTRS, "generation_run_id", "generated_at", every), path)
    return history.versions(history.read_store(spark, path, history.store_schema(rows, "holder_id", ATTRS, rows.schema["generated_at"].dataType.simpleString())), "holder_id", ATTRS, every)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    v = holder_versions(spark, d)
    day = lambda c: F.to_date(c).cast("string")
    return v.select("holder_id", day("version_from").alias("version_from"), F.coalesce(day("version_to"), F.lit("9999-12-31")).alias("version_to"))


def p6_history(spark: SparkSession, d: str) -> DataFrame:
    """The dimension as it ought to be: version id, attributes in their most frequent spelling, period and current flag."""
    v = holder_versions(spark, d)
    h = table(spark, d, "rights_holders").select(upper_key("holder_id").alias("holder_id"), stripped("display_name").alias("form")).where("form is not null")
    forms = h.groupBy("holder_id", "form").count().groupBy("holder_id", F.lower("form").alias("display_name")).agg(F.max_by("form", F.struct("count", "form")).alias("form"))
    v = v.join(forms, ["holder_id", "display_name"], "left")
    vid = F.substring(F.sha2(F.concat_ws("|", "holder_id", F.unix_micros(F.col("version_from").cast("timestamp")).cast("string")), 256), 1, 16)
    return v.select(vid.alias("holder_version_id"), "holder_id", F.col("form").alias("display_name"), *ATTRS[1:], F.col("version_from").alias("version_valid_from"), F.col("version_to").alias("version_valid_to"), "is_current")


def p6_dim_errors(spark: SparkSession, d: str) -> DataFrame:
    """Where dim_rights_holders departs from the history rebuilt from the landings."""
    mine = holder_versions(spark, d).select("holder_id", F.to_date("version_from").alias("day"), F.col("display_name"), *ATTRS[1:], F.to_date("version_to").alias("until"), "is_current")
    dim = table(spark, d, "dim_rights_holders").select(upper_key("holder_id").alias("holder_id"), F.to_date("version_valid_from").alias("day"), F.lower(stripped("display_name")).alias("display_name"), *[F.upper(stripped(a)).alias(a) for a in ATTRS[1:]], F.to_date("version_valid_to").alias("until"), "is_current")
    e = diff.differences(dim, mine, ["holder_id", "day"], ATTRS + ["until", "is_current"])
    return e.select("holder_id", F.col("day").cast("string").alias("version_from"), "diff_kind", "field_name")


_P6 = f"""
with lt as (select generation_run_id, min(generated_at) as seen_at from rights_holders where generation_run_id is not null group by 1),
l as (select *, row_number() over (order by seen_at, generation_run_id) - 1 as no from lt),
h as (select distinct {UP('r.holder_id')} as holder_id, lower({STRIP.format('display_name')}) as display_name, upper({STRIP.format('holder_type')}) as holder_type, upper({STRIP.format('payee_status')}) as payee_status, upper({STRIP.format('model_scope')}) as model_scope, l.no from rights_holders r join l using (generation_run_id)),
o as (select *, row_number() over (partition by holder_id, no order by display_name, holder_type, payee_status, model_scope) as rn from h where holder_id is not null),
one as (select *, row_number() over (partition by holder_id order by no) - no as grp_all, row_number() over (partition by holder_id, display_name, holder_type, payee_status, model_scope order by no) - no as g from o where rn = 1),
runs as (select holder_id, display_name, holder_type, payee_status, model_scope, min(no) as a, max(no) as b from one group by holder_id, display_name, holder_type, payee_status, model_scope, g),
v as (select r.*, x.seen_at as version_from, y.seen_at as version_to from runs r join l x on x.no = r.a left join l y on y.no = r.b + 1)
"""
P6_SQL = _P6 + "select holder_id, strftime(version_from, '%Y-%m-%d') as version_from, coalesce(strftime(version_to, '%Y-%m-%d'), '9999-12-31') as version_to from v"
P6_HISTORY_SQL = _P6 + f"""
, f as (select {UP('holder_id')} as holder_id, {STRIP.format('display_name')} as form, count(*) as n from rights_holders group by 1, 2),
fm as (select holder_id, lower(form) as display_name, max_by(form, (n, form)) as form from f group by 1, 2)
select substr(sha256(holder_id || '|' || epoch_us(version_from)), 1, 16) as holder_version_id, holder_id, fm.form as display_name, holder_type, payee_status, model_scope,
version_from as version_valid_from, version_to as version_valid_to, version_to is null as is_current from v left join fm using (holder_id, display_name)"""

_DIM_FIELDS = [*ATTRS, "until", "is_current"]
P6_DIM_SQL = _P6 + f"""
, mine as (select holder_id, cast(version_from as date) as day, {', '.join(ATTRS)}, cast(version_to as date) as until, version_to is null as is_current from v),
d0 as (select {UP('holder_id')} as holder_id, cast(version_valid_from as date) as day, lower({STRIP.format('display_name')}) as display_name, {', '.join(f"upper({STRIP.format(a)}) as {a}" for a in ATTRS[1:])}, cast(version_valid_to as date) as until, is_current from dim_rights_holders),
dim as (select * exclude (rn) from (select *, row_number() over (partition by holder_id, day order by {', '.join(f'{c} nulls first' for c in _DIM_FIELDS)}) as rn from d0) where rn = 1),
j as (select coalesce(d.holder_id, m.holder_id) as holder_id, coalesce(d.day, m.day) as day, d.day is not null as ind, m.day is not null as inm, {', '.join(f'd.{c} is distinct from m.{c} as x_{c}' for c in _DIM_FIELDS)} from dim d full outer join mine m on d.holder_id = m.holder_id and d.day = m.day),
e as (select holder_id, day, 'only_prior' as diff_kind, '' as field_name from j where not inm union all select holder_id, day, 'only_restated', '' from j where not ind {' '.join(f"union all select holder_id, day, 'differs', '{c}' from j where ind and inm and x_{c}" for c in _DIM_FIELDS)})
select holder_id, strftime(day, '%Y-%m-%d') as version_from, diff_kind, field_name from e"""


# ---- 7: differences of two copies
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    a, b = (table(spark, d, f"silver_listen_matches{x}") for x in ("", "_restated"))
    copies = diff.differences(a, b, ["listen_hash"], MATCH_FIELDS)
    copies = copies.select(F.lit("silver_listen_matches").alias("copy_name"), F.col("listen_hash").alias("record_key"), "diff_kind", "field_name")
    f = table(spark, d, "fct_restatements").select(lower_key("recording_mbid").alias("r"), upper_key("rights_holder_id").alias("h"), "delta", "prior_payout", "restated_payout")
    key = F.concat_ws("|", F.coalesce("r", F.lit("")), F.coalesce("h", F.lit(""))).alias("record_key")
    ok = F.coalesce(F.col("delta") == F.col("restated_payout") - F.col("prior_payout"), F.lit(False))
    deltas = f.where(~ok).select(F.lit("fct_restatements").alias("copy_name"), key, F.lit("differs").alias("diff_kind"), F.lit("delta").alias("field_name")).distinct()
    return copies.unionByName(deltas)


def p7_summary(spark: SparkSession, d: str) -> DataFrame:
    return p7_found(spark, d).groupBy("copy_name", "diff_kind", "field_name").agg(F.count(F.lit(1)).alias("cases"))


def _p7_sql() -> str:
    cmp = lambda c: f"(p.{c} is not distinct from r.{c} or coalesce(abs(p.{c} - r.{c}) <= 1e-9, false))" if c in ("match_score", "score_margin") else f"p.{c} is not distinct from r.{c}"
    one = lambda t: f"(select distinct listen_hash, {', '.join(MATCH_FIELDS)} from {t})"
    diffs = " union all ".join(f"select listen_hash as record_key, 'differs' as diff_kind, '{c}' as field_name from p join r using (listen_hash) where not ({cmp(c)})" for c in MATCH_FIELDS)
    return f"""
with p as {one('silver_listen_matches')}, r as {one('silver_listen_matches_restated')},
m as (select listen_hash as record_key, 'only_prior' as diff_kind, '' as field_name from p where listen_hash not in (select listen_hash from r)
 union all select listen_hash, 'only_restated', '' from r where listen_hash not in (select listen_hash from p) union all {diffs}),
f as (select distinct {LOW('recording_mbid')} || '|' || {UP('rights_holder_id')} as record_key from fct_restatements where coalesce(delta <> restated_payout - prior_payout, true)),
found as (select 'silver_listen_matches' as copy_name, * from m union all select 'fct_restatements', record_key, 'differs', 'delta' from f)
"""


P7_SQL = _p7_sql() + "select * from found"
P7_SUMMARY_SQL = _p7_sql() + "select copy_name, diff_kind, field_name, count(*) as cases from found group by all"

QUERIES = {
    "p2_found": p2_found, "p2_periods": p2_periods, "p3_found": p3_found, "p3_report": p3_report, "p5_found": p5_found, "p5_shares": p5_shares,
    "p6_found": p6_found, "p6_history": p6_history, "p6_dim_errors": p6_dim_errors, "p7_found": p7_found, "p7_summary": p7_summary,
}
SQL = {
    "p2_found": P2_SQL, "p2_periods": P2_PERIODS_SQL, "p3_found": P3_SQL, "p3_report": P3_REPORT_SQL, "p5_found": P5_SQL, "p5_shares": P5_SHARES_SQL,
    "p6_found": P6_SQL, "p6_history": P6_HISTORY_SQL, "p6_dim_errors": P6_DIM_SQL, "p7_found": P7_SQL, "p7_summary": P7_SUMMARY_SQL,
}
