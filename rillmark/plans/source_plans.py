"""Source and sink operators as queries, with SQL twins where they have one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions.keys import run_id
from rillmark.operators import matching as M
from rillmark.operators.digest import content_digest
from rillmark.plans import matching_plans as MP
from rillmark.plans.pipeline import Pipeline, Stage
from rillmark.session import checkpointed, shared_dir
from rillmark.sources import readers, store


def _path(d: str, name: str) -> str:
    return f"{d}/{name}.parquet"


def io1_scan(s: SparkSession, d: str) -> DataFrame:
    return readers.read_parquet(s, [_path(d, "ext_listens_2026_06")]).select("user_id", "recording_msid", "recording_mbid")


def io8_provenance(s: SparkSession, d: str) -> DataFrame:
    x = readers.with_source_file(s.read.parquet(_path(d, "rights_holders")), "file")
    return x.select(F.element_at(F.split("file", "/"), -1).alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))


def _folder(s: SparkSession, name: str) -> str:
    return f"{shared_dir(s)}/rillmark-{name}-{uuid.uuid4().hex}"


def io2_csv_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """The catalogue's names through gzipped CSV and back: quotes, commas, and a line end written into every release name."""
    x = s.read.parquet(_path(d, "bronze_canonical_recordings")).select("recording_mbid", "recording_name", "artist_credit_name", F.concat("release_name", F.lit('\n"')).alias("release_name"), "score").distinct()
    out = _folder(s, "csv")
    x.write.option("header", True).option("quote", '"').option("escape", '"').option("compression", "gzip").csv(out)
    return readers.read_csv(s, [out], x.schema)


def io5_json_lines(s: SparkSession, d: str) -> DataFrame:
    """Events as lines of JSON, every tenth cut in the middle: lines, parse errors, and the sum of what parsed."""
    e = s.read.parquet(_path(d, "events")).where("props is not null").select(F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 4)).otherwise(F.col("props")).alias("value"))
    out = _folder(s, "jsonl")
    e.write.text(out)
    good, counts = readers.read_jsonl(s, [out], "k long")
    return counts.crossJoin(good.agg(F.count("k").alias("parsed"), F.sum("k").alias("k_sum")))  # one row each


def io13_append(s: SparkSession, d: str) -> DataFrame:
    """Keyed insert: of the later dumps only listens that the first one lacks."""
    x = s.read.parquet(_path(d, "bronze_listens")).select("listen_hash", "dump_id")
    first = x.agg(F.min("dump_id")).first()[0]
    return store.append_new(x.where(F.col("dump_id") != first).select("listen_hash").distinct(), x.where(F.col("dump_id") == first), ["listen_hash"])


def io14_upsert(s: SparkSession, d: str) -> DataFrame:
    """The first copy's decisions with those of the second put over them."""
    a = s.read.parquet(_path(d, "silver_listen_matches")).select("listen_hash", "match_status").distinct()
    b = s.read.parquet(_path(d, "silver_listen_matches_restated")).select("listen_hash", "match_status").distinct()
    return store.upsert(a, b, ["listen_hash"])


def l2_publish(s: SparkSession, d: str) -> DataFrame:
    """Stage, check, publish, and publish again: rows, and whether the second run did any work. The run's id comes from the content."""
    st = store.Store(s, _folder(s, "store"))
    x = s.read.parquet(_path(d, "source_targets"))
    run = run_id("targets", content_digest(x, x.columns).first()["digest"], x.columns)
    st.publish("targets", run, x, {"null_source": lambda df: df.where("source is null").count()}, promote=True)
    again = st.publish("targets", run, x)
    return st.read("targets").agg(F.count(F.lit(1)).alias("rows")).withColumn("second_run_worked", F.lit(again))


def pipeline(s: SparkSession, d: str) -> Pipeline:
    """The matcher as named stages, each on what those before it wrote; publication is off unless asked for, and refused while an invariant is broken."""
    index = lambda c: checkpointed(M.blocking_index(MP._catalogue(s, d)))
    decide = lambda c: checkpointed(M.match_texts(t := M.texts_of(MP._listens(s, d), c["pairs"]), c["candidates"], MP._scored(s, d, c["candidates"], t), MP.RULES))
    broken = lambda c: int(c["decisions"].agg(F.count_if(F.expr(" or ".join(f"({x})" for x in MP.INVARIANTS.values())))).first()[0])

    def publish(c: dict) -> bool:
        if c["invariants"]:
            raise store.Refused(f"{c['invariants']} decisions break an invariant")
        x = c["decisions"]
        return store.Store(s, _folder(s, "decisions")).publish("decisions", run_id("match", content_digest(x, x.columns).first()["digest"]), x)

    return Pipeline([
        Stage("pairs", lambda c: checkpointed(MP._pairs(s, d)), retries=1), Stage("index", index, retries=1), Stage("candidates", lambda c: checkpointed(M.candidates(c["pairs"], c["index"])), ("pairs", "index"), 1),
        Stage("decisions", decide, ("candidates",), 1), Stage("invariants", broken, ("decisions",)), Stage("publication", publish, ("invariants",), publishes=True),
    ])


def or1_pipeline(s: SparkSession, d: str) -> DataFrame:
    """The stages run without publication: rows each wrote, decisions that break an invariant, and nothing published."""
    got = pipeline(s, d).run()
    rows = [(k, v.count() if isinstance(v, DataFrame) else v) for k, v in got.items()]
    return s.createDataFrame([(k, None if v is None else int(v)) for k, v in rows], "stage string, rows long")


QUERIES = {"IO1_parquet_scan": io1_scan, "IO8_provenance": io8_provenance, "IO2_csv_roundtrip": io2_csv_roundtrip, "IO5_json_lines": io5_json_lines, "OR1_pipeline": or1_pipeline, "IO13_keyed_append": io13_append, "IO14_upsert": io14_upsert, "L2_stage_publish": l2_publish}
SQL = {
    "IO1_parquet_scan": "select user_id, recording_msid, recording_mbid from ext_listens_2026_06",
    "IO2_csv_roundtrip": "select distinct recording_mbid, recording_name, artist_credit_name, release_name || chr(10) || '\"' as release_name, score from bronze_canonical_recordings",
    "IO5_json_lines": "with l as (select case when event_id % 10 = 0 then substr(props, 1, 4) else props end as value from events where props is not null), p as (select try_cast(value as json) as v from l where trim(value) <> '') select count(*) as lines, count(*) filter (where v is null) as parse_errors, count(cast(json_extract_string(v, '$.k') as bigint)) as parsed, cast(sum(cast(json_extract_string(v, '$.k') as bigint)) as bigint) as k_sum from p",
    "IO8_provenance": "select 'rights_holders.parquet' as file, count(*) as rows from rights_holders",  # a table is one file where SQL is run
    "OR1_pipeline": MP.BASE + "select * from (select 'pairs' as stage, count(*) as rows from pairs union all select 'index', count(*) from idx union all select 'candidates', count(*) from cands union all select 'decisions', count(*) from mt union all select 'invariants', 0 union all select 'publication', null)",
    "IO13_keyed_append": "with f as (select min(dump_id) as m from bronze_listens) select distinct listen_hash from bronze_listens where dump_id <> (select m from f) and listen_hash not in (select listen_hash from bronze_listens where dump_id = (select m from f))",
    "IO14_upsert": "with a as (select distinct listen_hash, match_status from silver_listen_matches), b as (select distinct listen_hash, match_status from silver_listen_matches_restated) select * from b union all select * from a where listen_hash not in (select listen_hash from b)",
    "L2_stage_publish": "select count(*) as rows, false as second_run_worked from source_targets",
}
