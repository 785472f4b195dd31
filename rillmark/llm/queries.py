"""Registered queries of the llm problems, with SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillmark.functions.keys import lower_key
from rillmark.llm import langid, linkage, mixing, packing, sampling
from rillmark.llm.tokens import VOCABULARY, count_tokens
from rillmark.session import checkpointed


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_matches(spark: SparkSession, d: str) -> DataFrame:
    """Each matched text's catalogued recording with the posterior."""
    t = table(spark, d, "bronze_listens").select(lower_key("recording_msid").alias("text_key"), F.col("artist_name").alias("artist"), F.col("recording_name").alias("title"), F.col("release_name").alias("release"))
    c = table(spark, d, "bronze_canonical_recordings").select(lower_key("recording_mbid").alias("record_key"), F.col("artist_credit_name").alias("artist"), F.col("recording_name").alias("title"), F.col("release_name").alias("release"))
    m = linkage.link(t.where("text_key is not null"), c.where("record_key is not null"))
    return m.select(F.col("text_key").alias("recording_msid"), F.col("record_key").alias("recording_mbid"), "posterior")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_matches(spark, d).select("recording_msid", "recording_mbid")


# ---- 4: samples that stay
PER_MILLION = 20_000
LISTEN_SALT, EXT_SALT = "rillmark-listens-1", "rillmark-recordings-1"


def p4_listen_sample(spark: SparkSession, d: str) -> DataFrame:
    """Sampled listen hashes; a dump is a batch, and dumps are told apart and ordered by load time and id."""
    t = table(spark, d, "bronze_listens")
    batch = F.concat(F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"), F.lit("|"), "dump_id")
    s = sampling.frozen_sample(t, lower_key("listen_hash"), batch, PER_MILLION, LISTEN_SALT)
    return s.select(F.col("sample_key").alias("listen_hash"), "batch")


def p4_listen_rows(spark: SparkSession, d: str) -> DataFrame:
    """All rows of the sampled listens, repeated rows included."""
    t = table(spark, d, "bronze_listens")
    batch = F.concat(F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"), F.lit("|"), "dump_id")
    s = sampling.frozen_sample(t, lower_key("listen_hash"), batch, PER_MILLION, LISTEN_SALT)
    r = sampling.sampled_rows(t, lower_key("listen_hash"), s, LISTEN_SALT)
    return r.select("listen_hash", "recording_msid", "artist_name", "recording_name", "dump_id")


def p4_recording_sample(spark: SparkSession, d: str) -> DataFrame:
    """Sampled recording ids of the raw slice; the day a row was created is its batch, complete once the day is over."""
    t = table(spark, d, "ext_listens_2026_06")
    s = sampling.frozen_sample(t, lower_key("recording_mbid"), F.date_format("created", "yyyy-MM-dd"), PER_MILLION, EXT_SALT)
    return s.select(F.col("sample_key").alias("recording_mbid"), "batch")


_LOW = r"nullif(lower(regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')), '')"


def _p4_sql(source: str, column: str, batch: str, salt: str) -> str:
    return f"""
with r as (select {_LOW.format(column)} as sample_key, {batch} as batch from {source}),
k as (select sample_key, min(batch) as batch from r where sample_key is not null and batch is not null group by 1),
h as (select *, cast('0x' || substr(sha256('{salt}|' || sample_key), 1, 15) as bigint) as h, count(*) over (partition by batch) as n from k),
o as (select *, row_number() over (partition by batch order by h, sample_key) as rn from h),
s as (select sample_key, batch from o where rn <= (n * {PER_MILLION} + 999999) // 1000000)
"""


_LISTENS = _p4_sql("bronze_listens", "listen_hash", "strftime(ingested_at, '%Y-%m-%d %H:%M:%S') || '|' || dump_id", LISTEN_SALT)
P4_SQL = {
    "p4_listen_sample": _LISTENS + "select sample_key as listen_hash, batch from s",
    "p4_listen_rows": _LISTENS + f"select listen_hash, recording_msid, artist_name, recording_name, dump_id from bronze_listens where {_LOW.format('listen_hash')} in (select sample_key from s)",
    "p4_recording_sample": _p4_sql("ext_listens_2026_06", "recording_mbid", "strftime(created, '%Y-%m-%d')", EXT_SALT) + "select sample_key as recording_mbid, batch from s",
}


def p1_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Texts there are, and matches that cannot be: of unknown or repeated texts, to unknown recordings, with no probability."""
    m = checkpointed(p1_matches(spark, d))
    texts = table(spark, d, "bronze_listens").select(lower_key("recording_msid").alias("recording_msid")).where("recording_msid is not null").distinct()
    records = table(spark, d, "bronze_canonical_recordings").select(lower_key("recording_mbid").alias("recording_mbid")).distinct()
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias(c))
    parts = [
        n(texts, "texts"), n(m.join(texts, "recording_msid", "left_anti"), "unknown_texts"), n(m.join(records, "recording_mbid", "left_anti"), "unknown_recordings"),
        n(m.groupBy("recording_msid").count().where("count > 1"), "texts_matched_twice"), n(m.where("posterior is null or posterior < 0.5 or posterior > 1"), "without_confidence"),
    ]
    return _beside(parts)


def _beside(parts: list[DataFrame]) -> DataFrame:
    """One-row results of counts in one row."""
    long = None
    for p in parts:
        x = p.select(F.explode(F.array(*[F.struct(F.lit(c).alias("m"), F.col(c).cast("long").alias("v")) for c in p.columns])).alias("x")).select("x.*")
        long = x if long is None else long.unionByName(x)
    return long.agg(*[F.max(F.when(F.col("m") == c, F.col("v"))).alias(c) for p in parts for c in p.columns])


# ---- 8: containers
def p8_assignment(spark: SparkSession, d: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every document's pieces with their containers and the room left, for each capacity."""
    docs = count_tokens(table(spark, d, "documents").select("doc_id", "text"), vocabulary)
    return packing.fill_containers(docs, table(spark, d, "container_sizes"))


def p8_room(spark: SparkSession, d: str) -> DataFrame:
    """Per kind of container: how many, tokens held, the share of the room left unused, and how the containers were found."""
    a = p8_assignment(spark, d)
    c = a.groupBy("container_kind", "container_id").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("tokens"), F.max("room_left").alias("room_left"), F.max("found_by").alias("found_by"))
    g = c.groupBy("container_kind").agg(F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"), F.sum("room_left").alias("room_left"), *[F.count_if(F.col("found_by") == x).alias(f"found_by_{x}") for x in ("whole", packing.AT_BOUND, packing.BY_SEARCH, packing.SEARCHED, packing.CUT_SHORT)])
    return g.withColumn("unused_share", F.try_divide(F.col("room_left"), F.col("tokens") + F.col("room_left")))


def p8_violations(spark: SparkSession, d: str) -> DataFrame:
    """Per kind of container the documents placed, and what must not be: containers too full or with a wrong room, documents lost, torn or cut without
    need, and more containers than 1.05 times the least that could hold the tokens, and one."""
    docs = checkpointed(count_tokens(table(spark, d, "documents").select("doc_id", "text"), VOCABULARY))
    kinds = table(spark, d, "container_sizes").select("container_kind", F.col("capacity_tokens").cast("long").alias("capacity")).distinct()
    a = checkpointed(packing.fill_containers(docs, table(spark, d, "container_sizes")))
    c = a.groupBy("container_kind", "container_id").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("t"), F.min("room_left").alias("r"), F.max("room_left").alias("r2")).join(F.broadcast(kinds), "container_kind")
    size = F.col("capacity") - F.col("t")
    per_c = c.groupBy("container_kind").agg(
        F.count_if(size < 0).alias("over_capacity"), F.count_if((F.col("r") != size) | (F.col("r2") != size)).alias("wrong_room"),
        F.greatest(F.lit(0), F.count(F.lit(1)) - 1 - F.ceil(1.05 * F.ceil(F.sum("t") / F.first("capacity")))).cast("long").alias("containers_too_many"),
    )
    g = a.groupBy("container_kind", "doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.min("token_from").alias("lo"), F.max("token_to").alias("hi"), F.sum(F.col("token_to") - F.col("token_from")).alias("t"))
    few = F.array(*[F.struct(F.lit(r.container_kind).alias("container_kind"), F.lit(r.capacity).alias("capacity")) for r in kinds.collect()])  # a few kinds
    j = docs.select("doc_id", "n_tokens", F.explode(few).alias("k")).select("doc_id", "n_tokens", "k.*").join(g, ["container_kind", "doc_id"], "left")
    need = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / F.col("capacity")))
    per_d = j.groupBy("container_kind").agg(
        F.count("pieces").alias("documents"), F.count_if(F.col("pieces").isNull()).alias("lost"), F.count_if((F.col("lo") != 0) | (F.col("hi") != F.col("n_tokens")) | (F.col("t") != F.col("n_tokens"))).alias("torn"), F.count_if(F.col("pieces") > need).alias("cut_without_need"),
    )
    return per_d.join(per_c, "container_kind")


# ---- 9: mixture
def _mixture(spark: SparkSession, d: str, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    docs = count_tokens(table(spark, d, "documents").select("doc_id", "source", "text"), vocabulary)
    return mixing.mixture(docs, table(spark, d, "source_targets"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mixture and how many times each is used."""
    return _mixture(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares really reached, beside the targets."""
    mix, targets = _mixture(spark, d)
    return mixing.shares(checkpointed(mix), targets)


def p9_violations(spark: SparkSession, d: str) -> DataFrame:
    """Target sources, and what must not be: shares off by more than a document, uses above the cap, documents unknown, of another source or listed twice."""
    docs = checkpointed(count_tokens(table(spark, d, "documents").select("doc_id", "source", "text"), VOCABULARY))
    mix, targets = mixing.mixture(docs, table(spark, d, "source_targets"))
    mix = checkpointed(mix)
    have = docs.select("doc_id", mixing.source_key("source").alias("source"), "n_tokens").where("n_tokens > 0")
    live = targets.join(have.select("source").distinct(), "source", "left_semi").where("share > 0 and m > 0")
    scale = live.agg(F.sum("share")).first()[0] or 1.0
    total = mix.agg(F.sum(F.col("n_tokens") * F.col("times"))).first()[0] or 0
    g = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("t"))
    longest = have.groupBy("source").agg(F.max("n_tokens").alias("longest"))
    off = live.join(g, "source", "left").join(longest, "source").where(F.abs(F.coalesce("t", F.lit(0)) - F.col("share") / scale * total) > F.col("longest"))
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias(c))
    return _beside([
        n(targets, "sources"), n(off, "shares_off"), n(mix.join(targets, "source", "left").where("m is null or times > m or times < 1"), "repeats_above_cap"),
        n(mix.join(have, ["doc_id", "source", "n_tokens"], "left_anti"), "unknown_documents"), n(mix.groupBy("doc_id").count().where("count > 1"), "listed_twice"),
    ])


# ---- 10: languages
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return langid.identify(docs, langid.fit(docs), cases_only=True).select("doc_id", "seg_no", "lang")


def p10_languages(spark: SparkSession, d: str) -> DataFrame:
    """Every document's segments with language and confidence."""
    docs = table(spark, d, "documents")
    return langid.identify(docs, langid.fit(docs)).select("doc_id", "seg_no", "lang", "confidence", "seg_from", "seg_to", "label_lang")


def p10_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Documents there are, and what must not be: documents without segments, segments that leave or share text, neighbours of one language, no known code, no probability."""
    docs = table(spark, d, "documents")
    s = checkpointed(langid.identify(docs, langid.fit(docs)).drop("label_lang"))
    w = W.partitionBy("doc_id").orderBy("seg_no")
    x = s.withColumns({"_end": F.lag("seg_to").over(w), "_lang": F.lag("lang").over(w), "_no": F.lag("seg_no").over(w)})
    last = s.groupBy("doc_id").agg(F.max("seg_to").alias("to"))
    size = docs.select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("size"))
    j = size.join(last, "doc_id", "left")
    per_seg = x.agg(
        F.count_if((F.col("seg_from") != F.coalesce("_end", F.lit(0))) | (F.col("seg_no") != F.coalesce("_no", F.lit(0)) + 1)).alias("torn"), F.count_if(F.col("lang") == F.col("_lang")).alias("equal_neighbours"),
        F.count_if(~F.col("lang").isin([*langid.NAMES, "und"])).alias("unknown_codes"), F.count_if(~F.col("confidence").between(0, 1) | F.col("confidence").isNull()).alias("without_confidence"),
    )
    per_doc = j.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("to").isNull()).alias("without_segment"), F.count_if(F.col("to") != F.col("size")).alias("not_to_the_end"))
    return _beside([per_doc, per_seg])


QUERIES = {
    "p1_found": p1_found, "p1_matches": p1_matches, "p1_invariants": p1_invariants, "p8_violations": p8_violations, "p9_violations": p9_violations, "p10_invariants": p10_invariants,
    "p4_listen_sample": p4_listen_sample, "p4_listen_rows": p4_listen_rows, "p4_recording_sample": p4_recording_sample,
    "p8_assignment": p8_assignment, "p8_room": p8_room, "p9_mixture": p9_mixture, "p9_shares": p9_shares,
    "p10_found": p10_found, "p10_languages": p10_languages,
}
#: what the tables say there is, and that nothing is wrong
CHECK_SQL = {
    "p1_invariants": f"select count(distinct {_LOW.format('recording_msid')}) as texts, 0 as unknown_texts, 0 as unknown_recordings, 0 as texts_matched_twice, 0 as without_confidence from bronze_listens",
    "p8_violations": "select container_kind, (select count(*) from documents) as documents, 0 as lost, 0 as torn, 0 as cut_without_need, 0 as over_capacity, 0 as wrong_room, 0 as containers_too_many from (select distinct container_kind from container_sizes)",
    "p9_violations": r"select count(distinct lower(replace(regexp_replace(source, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '-', '_'))) as sources, 0 as shares_off, 0 as repeats_above_cap, 0 as unknown_documents, 0 as listed_twice from source_targets",
    "p10_invariants": "select count(*) as documents, 0 as without_segment, 0 as not_to_the_end, 0 as torn, 0 as equal_neighbours, 0 as unknown_codes, 0 as without_confidence from documents",
}
SQL: dict[str, str] = {**P4_SQL, **CHECK_SQL}
