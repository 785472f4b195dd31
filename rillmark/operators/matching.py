"""Blocking, features, scoring and the refusing match decision."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillmark.functions import text as T

FEATURES = ["artist_exact", "recording_exact", "artist_jaccard", "recording_jaccard", "artist_similarity", "recording_similarity", "release_exact"]


@dataclass(frozen=True)
class ScoringRules:
    """Fixed values of the scoring contract."""

    weights: tuple[float, ...] = (0.1, 1.0, 0.1, 1.0, 0.1, 1.0, 0.5)
    exact_threshold: float = 0.55
    fallback_threshold: float = 0.85
    minimum_margin: float = 0.02
    tie_epsilon: float = 0.01

    @property
    def digest(self) -> str:
        import hashlib

        return hashlib.sha256(repr((self.weights, self.exact_threshold, self.fallback_threshold, self.minimum_margin, self.tie_epsilon)).encode()).hexdigest()[:12]


def distinct_pairs(listens: DataFrame, scripts: tuple[str, ...] = ()) -> DataFrame:
    """Distinct (artist, recording) names with pair hash, keys, statuses and content: text work is done once per pair, not per listen."""
    p = listens.select(F.coalesce("artist_name", F.lit("")).alias("artist_name"), F.coalesce("recording_name", F.lit("")).alias("recording_name")).distinct()
    return T.with_fields(p, "artist_name", "recording_name", scripts).select(T.pair_hash(F.col("artist_name"), F.col("recording_name")).alias("pair_hash"), "artist_name", "recording_name", *T.FIELDS)


def blocking_index(canonical: DataFrame, scripts: tuple[str, ...] = ()) -> DataFrame:
    """(recording_mbid, lookup_stage, lookup_key): up to two rows per recording, empty keys left out."""
    d = T.with_fields(canonical.select("recording_mbid", "artist_credit_name", "recording_name"), "artist_credit_name", "recording_name", scripts)
    stages = F.array(F.struct(F.lit("EXACT").alias("lookup_stage"), F.col("key_exact").alias("lookup_key")), F.struct(F.lit("FALLBACK").alias("lookup_stage"), F.col("key_fallback").alias("lookup_key")))
    return d.select("recording_mbid", F.explode(stages).alias("s")).select("recording_mbid", "s.*").where("lookup_key <> ''").distinct()


def canonical_texts(canonical: DataFrame) -> DataFrame:
    """One row per recording: the texts a candidate is compared on; repeated rows united by smallest value."""
    g = canonical.groupBy("recording_mbid").agg(F.min("artist_credit_name").alias("a"), F.min("recording_name").alias("r"), F.min("release_name").alias("l"))
    return g.select("recording_mbid", T.text_of(F.col("a")).alias("c_artist"), T.text_of(F.col("r")).alias("c_recording"), F.lower(F.trim("l")).alias("c_release"))


def exact_candidates(pairs: DataFrame, index: DataFrame) -> DataFrame:
    ix = index.where("lookup_stage = 'EXACT'").select(F.col("lookup_key").alias("key_exact"), "recording_mbid")
    return pairs.where("status_exact = 'AVAILABLE'").join(ix, "key_exact").select("pair_hash", "recording_mbid", F.lit("EXACT").alias("block_method"), F.col("key_exact").alias("block_key"))


def fallback_candidates(pairs: DataFrame, index: DataFrame, exact: DataFrame) -> DataFrame:
    """Only for pairs without any exact hit."""
    ix = index.where("lookup_stage = 'FALLBACK'").select(F.col("lookup_key").alias("key_fallback"), "recording_mbid")
    left = pairs.where("status_fallback = 'AVAILABLE'").join(exact.select("pair_hash").distinct(), "pair_hash", "left_anti")
    return left.join(ix, "key_fallback").select("pair_hash", "recording_mbid", F.lit("FALLBACK").alias("block_method"), F.col("key_fallback").alias("block_key"))


def candidates(pairs: DataFrame, index: DataFrame) -> DataFrame:
    e = exact_candidates(pairs, index)
    return e.unionByName(fallback_candidates(pairs, index, e))


def scored_universe(cands: DataFrame) -> DataFrame:
    """Candidates of pairs that need a score: more than one candidate, or fallback only. A lone exact candidate is structural."""
    n = F.count(F.lit(1)).over(W.partitionBy("pair_hash"))
    return cands.withColumn("_n", n).where((F.col("_n") > 1) | (F.col("block_method") == "FALLBACK")).drop("_n")


def features(cands: DataFrame, texts: DataFrame, canon: DataFrame) -> DataFrame:
    """Per text (pair and release) and candidate the seven similarities; ``release_exact`` is null when the text names no release."""
    j = cands.join(texts, "pair_hash").join(canon, "recording_mbid")
    eq = lambda x, y: ((F.col(x) != "") & (F.col(x) == F.col(y))).cast("double")
    rel = F.when(F.coalesce(F.trim("release_name"), F.lit("")) != "", F.coalesce(F.lower(F.trim("release_name")) == F.col("c_release"), F.lit(False)).cast("double"))
    return j.select(
        "text_hash", "pair_hash", "recording_mbid", "block_method",
        eq("artist_text", "c_artist").alias(FEATURES[0]), eq("recording_text", "c_recording").alias(FEATURES[1]),
        T.jaccard(F.col("artist_text"), F.col("c_artist")).alias(FEATURES[2]), T.jaccard(F.col("recording_text"), F.col("c_recording")).alias(FEATURES[3]),
        T.similarity(F.col("artist_text"), F.col("c_artist")).alias(FEATURES[4]), T.similarity(F.col("recording_text"), F.col("c_recording")).alias(FEATURES[5]),
        rel.alias(FEATURES[6]),
    )


def score(rules: ScoringRules = ScoringRules()) -> Column:
    """Weighted mean of the features there are: a null leaves numerator and denominator; all null gives null. Rounded to 9 digits so that every engine ties alike."""
    num, den = F.lit(0.0), F.lit(0.0)
    for f, w in zip(FEATURES, rules.weights):
        num = num + F.when(F.col(f).isNull(), 0.0).otherwise(F.col(f) * w)
        den = den + F.when(F.col(f).isNull(), 0.0).otherwise(F.lit(w))
    return F.round(F.try_divide(num, den), 9)


def decision(method: Column, n: Column, top1: Column, top2: Column, rules: ScoringRules = ScoringRules()) -> Column:
    """Ordered policy: no score, below threshold, only one, tie, thin margin, accepted. The order is the policy."""
    thr = F.when(method == "EXACT", rules.exact_threshold).otherwise(rules.fallback_threshold)
    margin = F.round(top1 - top2, 9)
    return (
        F.when((n == 0) | top1.isNull(), "NO_BLOCK_CANDIDATES").when(top1 < thr, "BELOW_THRESHOLD").when((n == 1) | top2.isNull(), "ACCEPTED")
        .when(margin <= rules.tie_epsilon, "AMBIGUOUS_TIE").when(margin < rules.minimum_margin, "AMBIGUOUS_TIE").otherwise("ACCEPTED")
    )


def texts_of(listens: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct (pair, release) texts with their hash."""
    a, r = F.coalesce("artist_name", F.lit("")), F.coalesce("recording_name", F.lit(""))
    t = listens.select(T.pair_hash(a, r).alias("pair_hash"), "release_name").distinct()
    t = t.withColumn("text_hash", F.sha2(F.concat("pair_hash", F.lit("\u001f"), F.coalesce("release_name", F.lit("~null~"))), 256))
    return t.join(pairs.select("pair_hash", "artist_text", "recording_text", "content", "status_exact"), "pair_hash")


def match_texts(texts: DataFrame, cands: DataFrame, feats: DataFrame, rules: ScoringRules = ScoringRules()) -> DataFrame:
    """One row per text: candidate count, sole or best candidate, scores, margin, status, method, tier and failure reason.

    A structural match (lone exact candidate) carries no score; a tie carries no winner; nothing is picked among equals.
    """
    counts = cands.groupBy("pair_hash").agg(F.count(F.lit(1)).alias("n"), F.min("block_method").alias("block_method"), F.min("recording_mbid").alias("sole"))
    s = feats.withColumn("score", score(rules)).select("text_hash", "recording_mbid", "score")
    s = s.withColumn("rn", F.row_number().over(W.partitionBy("text_hash").orderBy(F.col("score").desc_nulls_last(), "recording_mbid"))).where("rn <= 2")
    top = s.groupBy("text_hash").agg(F.max(F.when(F.col("rn") == 1, F.col("score"))).alias("top1"), F.max(F.when(F.col("rn") == 2, F.col("score"))).alias("top2"), F.max(F.when(F.col("rn") == 1, F.col("recording_mbid"))).alias("winner"))
    j = texts.join(counts, "pair_hash", "left").join(top, "text_hash", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    structural = (F.col("block_method") == "EXACT") & (F.col("n") == 1)
    j = j.withColumn("outcome", F.when(structural, "ACCEPTED").otherwise(decision(F.col("block_method"), F.col("n"), F.col("top1"), F.col("top2"), rules)))
    ok = F.col("outcome") == "ACCEPTED"
    method = F.when(F.col("n") == 0, "NO_CANDIDATES").when(structural, "STRUCTURAL_EXACT_UNIQUE").when(F.col("block_method") == "EXACT", "SCORED_EXACT_MULTIPLE").when(F.col("n") == 1, "SCORED_FALLBACK_UNIQUE").otherwise("SCORED_FALLBACK_MULTIPLE")
    reason = F.when(ok, None).when(F.col("n") > 0, F.col("outcome")).when(F.col("content") != "VALID", F.col("content")).when(F.col("status_exact") == "PARTIAL", "NO_LOOKUP_KEY_PARTIAL").when(F.col("status_exact") == "EMPTY", "NO_LOOKUP_KEY_EMPTY").otherwise("NO_BLOCK_CANDIDATES")
    return j.select(
        "text_hash", "pair_hash", F.when(ok & structural, F.col("sole")).when(ok, F.col("winner")).alias("matched_recording_mbid"),
        F.when(ok, "MATCHED").otherwise("UNRESOLVED").alias("match_status"),
        F.when(F.col("n") == 0, "E").when(F.col("block_method") == "EXACT", "C").otherwise("D").alias("match_tier"), method.alias("match_method"),
        F.when(~structural, F.col("top1")).alias("match_score"), F.when(~structural & (F.col("n") > 1), F.round(F.col("top1") - F.col("top2"), 9)).alias("score_margin"),
        reason.alias("failure_reason"), "block_method", F.col("n").alias("candidate_count"),
    )


def baseline(pairs: DataFrame, cands: DataFrame) -> DataFrame:
    """Cardinality-only matcher: a lone exact candidate matches; the rest says what scoring would have to settle."""
    c = cands.groupBy("pair_hash").agg(F.count(F.lit(1)).alias("n"), F.min("block_method").alias("m"), F.min("recording_mbid").alias("sole"))
    j = pairs.select("pair_hash", "content").join(c, "pair_hash", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ok = (F.col("m") == "EXACT") & (F.col("n") == 1)
    why = F.when(ok, None).when(F.col("n") == 0, F.when(F.col("content") != "VALID", F.col("content")).otherwise("NO_BLOCK_CANDIDATES")).when((F.col("m") == "FALLBACK") & (F.col("n") == 1), "FALLBACK_REQUIRES_SCORING").otherwise(F.concat(F.lit("MULTIPLE_CANDIDATES_UNSCORED_"), F.col("m")))
    tier = F.when(ok, "C").when((F.col("m") == "FALLBACK") & (F.col("n") == 1), "D").otherwise("E")
    return j.select("pair_hash", F.when(ok, F.col("sole")).alias("matched_recording_mbid"), F.when(ok, "MATCHED").otherwise("UNRESOLVED").alias("match_status"), tier.alias("match_tier"), why.alias("failure_reason"), F.col("n").alias("candidate_count"))
