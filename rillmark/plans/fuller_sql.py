"""SQL of the queries that rescore labelled candidates, generate modeled rights, or fold all landings."""

from __future__ import annotations

from rillmark.operators import matching as M
from rillmark.operators.generator import RightsModel
from rillmark.plans import matching_plans as MP
from rillmark.plans.problems import _P6, ATTRS, LOW

# ---- dimension: one version per run of landings
SCD = _P6 + f", sv as (select holder_id, {', '.join(ATTRS)}, strftime(version_from, '%Y-%m-%d') as valid_from, strftime(version_to, '%Y-%m-%d') as valid_to from v)"

# ---- labels of the raw slice against the candidates of a listen's names
LABELS = MP.BASE + f""",
lx as (select sha256(user_id || '|' || epoch_us(listened_at) || '|' || recording_msid) as listen_hash, lower(recording_mbid) as m from ext_listens_2026_06 where recording_mbid is not null),
lab as (select listen_hash, min(m) as label_mbid from lx group by 1 having min(m) = max(m)),
ca as (select distinct {LOW('recording_mbid')} as c from bronze_canonical_recordings),
labc as (select lab.*, ca.c is not null as label_in_catalogue from lab left join ca on ca.c = label_mbid),
sm as (select distinct listen_hash, matched_recording_mbid, match_method, match_score, score_margin, block_method from silver_listen_matches),
lr as (select distinct labc.listen_hash from labc join lt using (listen_hash) join cands using (pair_hash) where {LOW('cands.recording_mbid')} = label_mbid),
l as (select sm.*, label_mbid, coalesce(label_in_catalogue, false) as label_in_catalogue, lr.listen_hash is not null as label_retrieved from sm left join labc using (listen_hash) left join lr using (listen_hash)),
items as (select text_hash, label_mbid, label_in_catalogue, count(*) as items from labc join (select distinct listen_hash, text_hash from lt) using (listen_hash) group by 1, 2, 3)
"""


def _score(weights) -> str:
    num = " + ".join(f"case when {f} is null then 0.0::double else {f} * {float(w)!r}::double end" for f, w in zip(M.FEATURES, weights))
    den = " + ".join(f"case when {f} is null then 0.0::double else {float(w)!r}::double end" for f, w in zip(M.FEATURES, weights))
    return f"round(({num}) / nullif({den}, 0), 9)"


_SUBSETS = {"all": [1] * len(M.FEATURES), **{f"without_{f}": [int(g != f) for g in M.FEATURES] for f in M.FEATURES}}
LEAVE_ONE_OUT = LABELS + f""",
lo as ({' union all '.join(f"select '{k}' as subset, {LOW('recording_mbid')} = label_mbid as agrees, items, {_score(w)} as v from feats join items using (text_hash)" for k, w in _SUBSETS.items())}),
lg as (select subset, v, sum(case when agrees then items else 0 end) as p, sum(case when not agrees then items else 0 end) as n from lo group by 1, 2),
lb as (select *, coalesce(sum(n) over (partition by subset order by v nulls first rows between unbounded preceding and 1 preceding), 0) as b from lg)
select subset, cast(sum(p) as bigint) as positives, cast(sum(n) as bigint) as negatives, round(sum(p * (b + n * 0.5::double)) / nullif(sum(p) * sum(n), 0), 9) as auc from lb group by 1
"""


def grid(weight_sets: dict, exact: list, fallback: list, margins: list) -> str:
    """Every cell meets every labelled text: what the query does with counts, said plainly."""
    values = lambda xs: ", ".join(f"({x!r}::double)" for x in xs)
    return LABELS + f""",
ws as ({' union all '.join(f"select '{k}' as weight_set, text_hash, recording_mbid, block_method, {_score(w)} as score from feats where text_hash in (select text_hash from items)" for k, w in weight_sets.items())}),
wr as (select *, row_number() over (partition by weight_set, text_hash order by score desc nulls last, recording_mbid) as rn from ws),
wt2 as (select weight_set, text_hash, min(block_method) as m, count(*) as n, max(case when rn = 1 then score end) as score, max(case when rn = 2 then score end) as second, max(case when rn = 1 then recording_mbid end) as winner from wr where rn <= 2 group by 1, 2),
wj as (select weight_set, m || case when n > 1 then '_MULTI' else '_UNIQUE' end as stage, score, round(score - second, 9) as margin, {LOW('winner')} = label_mbid as agrees,
  exists (select 1 from feats f where f.text_hash = wt2.text_hash and {LOW('f.recording_mbid')} = items.label_mbid) as label_retrieved, label_in_catalogue, items from wt2 join items using (text_hash)),
ge as (select * from (values {values(exact)}) t(exact_threshold)), gf as (select * from (values {values(fallback)}) t(fallback_threshold)), gm as (select * from (values {values(margins)}) t(min_margin)),
gw as (select *, coalesce(score >= case when stage = 'EXACT_MULTI' then exact_threshold else fallback_threshold end and (margin is null or margin >= min_margin), false) as ok from wj, ge, gf, gm),
gr as (select weight_set, exact_threshold, fallback_threshold, min_margin, stage, cast(sum(items) as bigint) as items, cast(sum(items * ok::int) as bigint) as accepted, cast(sum(items * coalesce(ok and agrees, false)::int) as bigint) as agree,
  cast(sum(items * coalesce(ok and not agrees and label_retrieved, false)::int) as bigint) as ranking_error, cast(sum(items * coalesce(ok and not agrees and not label_retrieved and label_in_catalogue, false)::int) as bigint) as ref_not_retrieved,
  cast(sum(items * coalesce(ok and not agrees and not label_in_catalogue, false)::int) as bigint) as ref_not_in_snapshot from gw group by all)
"""


def choice(bound: float, least: int, stages: int = 3) -> str:
    """The cell that ``choose`` takes, from the grid."""
    keys = "weight_set, exact_threshold, fallback_threshold, min_margin"
    return f""",
gj as (select *, accepted - ref_not_in_snapshot >= {least} as enough, coalesce((ranking_error + ref_not_retrieved) / nullif(accepted - ref_not_in_snapshot, 0), 1.0::double) as rate from gr),
gc as (select {keys}, cast(sum(accepted) as bigint) as accepted, round(coalesce(max(case when enough then rate end), 1.0::double), 9) as worst_disagreement, count(*) filter (where enough) = {stages} as complete from gj group by all),
gb as (select *, complete and worst_disagreement <= {bound} as within_bound from gc)
select * from gb order by within_bound desc, complete desc, case when within_bound then -accepted else 0 end, worst_disagreement, accepted desc, {keys} limit 1"""


AGREEMENT = LABELS + """
select match_method, count(*) as items, count(label_mbid) as labelled, count(matched_recording_mbid) as matched, count(*) filter (where label_mbid = matched_recording_mbid) as agree,
count(*) filter (where label_mbid <> matched_recording_mbid and label_retrieved) as ranking_error, count(*) filter (where label_mbid <> matched_recording_mbid and not label_retrieved and label_in_catalogue) as ref_not_retrieved,
count(*) filter (where label_mbid <> matched_recording_mbid and not label_in_catalogue) as ref_not_in_snapshot, round(count(matched_recording_mbid) / count(*), 9) as coverage from l group by 1"""


# ---- modeled rights
def _unit(seed: str, *parts: str) -> str:
    return f"((cast('0x' || substr(sha256('{seed}|' || {' || chr(124) || '.join(parts)}), 1, 14) as bigint) >> 3) / 9007199254740992.0::double)"


_M = RightsModel()
_TOP = _M.holders - _M.reserved
_W = _M.holder_weights
_KINDS = "case " + " ".join(f"when rn <= {sum(n for _, n in _M.quotas[: i + 1])} then '{k}'" for i, (k, _) in enumerate(_M.quotas)) + " end"
#: the broken recordings: those of the smallest hashes in the order of the quotas, and the orphans
_DEFECTS = f"""
gu as (select distinct {LOW('recording_mbid')} as recording_mbid from bronze_canonical_recordings where {LOW('recording_mbid')} is not null),
gq as (select recording_mbid, {_KINDS} as defect from (select recording_mbid, row_number() over (order by sha256('defect|' || recording_mbid), recording_mbid) as rn from gu) where rn <= {sum(n for _, n in _M.quotas)}),
go as (select sha256('orphan|' || i) as h from (select unnest(generate_series(0, {_M.orphans - 1})) as i)),
gd as (select * from gq union all select concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '8' || substr(h, 14, 3), substr(h, 17, 4), substr(h, 21, 12)), 'ORPHAN_RECORDING' from go)
"""


def _bump(x: str, taken: str) -> str:
    for _ in range(3):
        x = f"(case when list_contains({taken}, {x}) then ({x} + 1) % {_TOP} else {x} end)"
    return x


def _period(salt: str, a: str, b: str) -> str:
    return f"{{'salt': '{salt}', 'a': date '{a}', 'b': date '{b}'}}"


_ONE = f"[{_period('', _M.base_day, _M.open_day)}]"


def ownership(broken: bool) -> str:
    """CTEs up to ``own``: dated share sets of each recording, broken as labelled if asked."""
    who = "select recording_mbid, defect from (select recording_mbid from gu union all select recording_mbid from gd where defect = 'ORPHAN_RECORDING') left join gd using (recording_mbid)" if broken else "select recording_mbid, null::varchar as defect from gu"
    ranks = ", ".join(f"cast(floor(pow({_unit('h', 'k', chr(39) + str(i) + chr(39))}, 3) * {_TOP}) as bigint) as r{i}" for i in range(1, 5))
    return f"""
with {_DEFECTS},
gw0 as ({who}),
gs as (select recording_mbid, defect, unnest(case defect when 'OVERLAP' then [{_period('', _M.base_day, _M.overlap[1])}, {_period('#b', _M.overlap[0], _M.open_day)}] when 'GAP' then [{_period('', _M.base_day, _M.gap[0])}, {_period('#b', _M.gap[1], _M.open_day)}]
  when 'INVALID_INTERVAL' then [{_period('', *_M.invalid)}] when 'SHARE_SUM' then {_ONE} when 'MISSING_HOLDER' then {_ONE}
  else case when {_unit('c', 'recording_mbid')} < {_M.change_share} then [{_period('', _M.base_day, _M.change_day)}, {_period('#b', _M.change_day, _M.open_day)}] else {_ONE} end end) as s from gw0),
gk as (select recording_mbid, defect, s.a as valid_from, s.b as valid_to, recording_mbid || s.salt as k from gs),
gn as (select *, case when {_unit('n', 'k')} < {_W[0]} then 1 when {_unit('n', 'k')} < {_W[1]} then 2 when {_unit('n', 'k')} < {_W[2]} then 3 else 4 end as n, {ranks} from gk),
g1 as (select *, [r1] as t1 from gn), g2 as (select *, t1 || [{_bump('r2', 't1')}] as t2 from g1), g3 as (select *, t2 || [{_bump('r3', 't2')}] as t3 from g2), g4 as (select *, t3 || [{_bump('r4', 't3')}] as t4 from g3),
gx as (select *, unnest(generate_series(1, n))::int as slot from g4),
gy as (select *, cast(floor({_unit('w', 'k', 'slot::varchar')} * 9000) as bigint) + 1000 as raw from gx),
gz as (select *, (raw * 1000000) // cast(sum(raw) over (partition by k) as bigint) as part from gy),
own0 as (select recording_mbid, defect, 'GSV-' || substr(sha256('set|' || recording_mbid || '|' || strftime(valid_from, '%Y-%m-%d')), 1, 16) as split_version_id, valid_from, valid_to, slot, 'GEN-' || lpad(cast(t4[slot] as varchar), 6, '0') as holder,
  cast(part + case when slot = 1 then 1000000 - sum(part) over (partition by k) else 0 end as bigint) as share from gz),
own as (select recording_mbid, split_version_id, valid_from, valid_to, slot, case when slot = 1 and defect = 'MISSING_HOLDER' then 'GEN-999999' else holder end as rights_holder_id,
  case when slot = 1 and defect = 'SHARE_SUM' then greatest(share - {_M.broken_share_e4}, 5000) else share end as share_e4 from own0)
"""


GENERATED = ownership(False) + "select recording_mbid, split_version_id, strftime(valid_from, '%Y-%m-%d') as valid_from, strftime(valid_to, '%Y-%m-%d') as valid_to, slot, rights_holder_id, share_e4 from own"
DEFECTS = f"with {_DEFECTS} select * from gd"
#: the generated rows are searched for each kind of defect by a rule of its own
DETECTED = ownership(True) + f""",
st as (select recording_mbid, split_version_id, min(valid_from) as a, max(valid_to) as b, sum(share_e4) as total, count(*) filter (where rights_holder_id >= 'GEN-{_M.holders:06d}') as strangers from own group by 1, 2),
nx as (select recording_mbid, split_version_id, b, lead(a) over (partition by recording_mbid order by a, b) as next_a from st where a < b),
found as (select 'SHARE_SUM' as defect, count(*) as detected from st where total <> 1000000 union all select 'INVALID_INTERVAL', count(*) from st where a >= b union all select 'MISSING_HOLDER', count(*) from st where strangers > 0
 union all select 'OVERLAP', count(distinct recording_mbid) from nx where next_a < b union all select 'GAP', count(distinct recording_mbid) from nx where next_a > b
 union all select 'ORPHAN_RECORDING', count(distinct recording_mbid) from st where recording_mbid not in (select recording_mbid from gu)
 union all select 'HOLDER_WITHOUT_SPLIT', count(*) from (select unnest(generate_series({_TOP}, {_M.holders - 1})) as i) where 'GEN-' || lpad(i::varchar, 6, '0') not in (select rights_holder_id from own)),
want as (select * from (values {', '.join(f"('{k}', {n})" for k, n in (*_M.quotas, ('ORPHAN_RECORDING', _M.orphans), ('HOLDER_WITHOUT_SPLIT', _M.reserved)))}) t(defect, injected))
select defect, injected, detected, true as same_digest from want join found using (defect)"""


def _choice(seed: str, options: tuple) -> str:
    return "case " + " ".join(f"when {_unit(seed, 'i')} < {upto} then '{name}'" for name, upto in options[:-1]) + f" else '{options[-1][0]}' end"


HOLDERS = f"""select 'GEN-' || i as holder_id, 'Modeled Rights Holder ' || i as display_name, {_choice('t', _M.holder_types)} as holder_type, {_choice('p', _M.payee_statuses)} as payee_status, '{_M.model_scope}' as model_scope, true as is_modeled
from (select lpad(cast(unnest(generate_series(0, {_M.holders - 1})) as varchar), 6, '0') as i)"""
