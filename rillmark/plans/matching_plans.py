"""Matching and text operators over listens and catalogue, with SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillmark.functions import text as T
from rillmark.functions.keys import hash_bucket, hash_unit
from rillmark.functions.translit import FINALS, INITIALS, JAMO, KATAKANA, MEDIALS, SMALL
from rillmark.operators import evaluation as E
from rillmark.operators import matching as M
from rillmark.operators import profile as P
from rillmark.operators.skew import salted_join
from rillmark.session import checkpointed, shared_dir
from rillmark.sources import readers

RULES = M.ScoringRules()


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _listens(s: SparkSession, d: str) -> DataFrame:
    """The matcher's column firewall: no user, no label."""
    return table(s, d, "bronze_listens").select("listen_hash", "listened_at", "recording_msid", "artist_name", "recording_name", "release_name")


def _catalogue(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_canonical_recordings").select("recording_mbid", "recording_name", "artist_credit_name", "release_name")


def _pairs(s: SparkSession, d: str) -> DataFrame:
    return M.distinct_pairs(_listens(s, d))


def _shared(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, blocking index, candidates): each feeds several branches, so each is made once and cut from its lineage."""
    pairs, index = checkpointed(_pairs(s, d)), checkpointed(M.blocking_index(_catalogue(s, d)))
    return pairs, index, checkpointed(M.candidates(pairs, index))


def _cands(s: SparkSession, d: str) -> DataFrame:
    return _shared(s, d)[2]


def _texts(s: SparkSession, d: str) -> DataFrame:
    return M.texts_of(_listens(s, d), _pairs(s, d))


def _scored(s: SparkSession, d: str, cands: DataFrame, texts: DataFrame) -> DataFrame:
    """Features of the candidates that need a score; the catalogue's texts are made for these alone, a small part of it."""
    universe = M.scored_universe(cands)
    canon = M.canonical_texts(_catalogue(s, d).join(universe.select("recording_mbid").distinct(), "recording_mbid", "left_semi"))
    return M.features(universe, texts, canon)


def _feats(s: SparkSession, d: str) -> DataFrame:
    pairs, _, cands = _shared(s, d)
    return _scored(s, d, cands, M.texts_of(_listens(s, d), pairs))


def n1_pairs(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d)


def n2_index(s: SparkSession, d: str) -> DataFrame:
    return M.blocking_index(_catalogue(s, d))


def n3_texts(s: SparkSession, d: str) -> DataFrame:
    u = M.scored_universe(_cands(s, d)).select("recording_mbid").distinct()
    return M.canonical_texts(_catalogue(s, d)).join(u, "recording_mbid", "left_semi")


def s1_ordered_export(s: SparkSession, d: str) -> DataFrame:
    """The compared texts as tab-separated files in the order of their key, whatever the layout, and read back."""
    out = f"{shared_dir(s)}/rillmark-export-{uuid.uuid4().hex}"
    x = n3_texts(s, d)
    readers.ordered_export(x, ["recording_mbid"], out)
    return readers.read_tsv(s, [out], x.schema)


def j1_listens_pairs(s: SparkSession, d: str) -> DataFrame:
    li = _listens(s, d).withColumn("pair_hash", T.pair_hash(F.col("artist_name"), F.col("recording_name"))).select("listen_hash", "pair_hash")
    return salted_join(li, _pairs(s, d).select("pair_hash", "key_exact", "status_exact"), "pair_hash", "inner").distinct()


def j2_exact(s: SparkSession, d: str) -> DataFrame:
    return M.exact_candidates(_pairs(s, d), M.blocking_index(_catalogue(s, d)))


def j3_fallback(s: SparkSession, d: str) -> DataFrame:
    p, ix = checkpointed(_pairs(s, d)), checkpointed(M.blocking_index(_catalogue(s, d)))
    return M.fallback_candidates(p, ix, M.exact_candidates(p, ix))


def u1_candidates(s: SparkSession, d: str) -> DataFrame:
    return _cands(s, d)


def j4_universe(s: SparkSession, d: str) -> DataFrame:
    return M.scored_universe(_cands(s, d))


def j5_features(s: SparkSession, d: str) -> DataFrame:
    f = _feats(s, d)
    return f.select("text_hash", "recording_mbid", "block_method", *[F.round(x, 9).alias(x) for x in M.FEATURES])


def f22_score(s: SparkSession, d: str) -> DataFrame:
    return _feats(s, d).select("text_hash", "recording_mbid", M.score(RULES).alias("score"))


def _ranked(s: SparkSession, d: str) -> DataFrame:
    return f22_score(s, d).withColumn("rn", F.row_number().over(W.partitionBy("text_hash").orderBy(F.col("score").desc_nulls_last(), "recording_mbid")))


def w1_rank(s: SparkSession, d: str) -> DataFrame:
    return _ranked(s, d).select("text_hash", "recording_mbid", "rn")


def ag3_top2(s: SparkSession, d: str) -> DataFrame:
    x = _ranked(s, d).where("rn <= 2")
    return x.groupBy("text_hash").agg(F.max(F.when(F.col("rn") == 1, F.col("score"))).alias("top1"), F.max(F.when(F.col("rn") == 2, F.col("score"))).alias("top2"), F.max(F.when(F.col("rn") == 1, F.col("recording_mbid"))).alias("winner"))


def ag1_counts(s: SparkSession, d: str) -> DataFrame:
    return _cands(s, d).groupBy("pair_hash").agg(F.count(F.lit(1)).alias("n"), F.min("block_method").alias("block_method"))


def ag2_sole(s: SparkSession, d: str) -> DataFrame:
    c = _cands(s, d).groupBy("pair_hash").agg(F.count(F.lit(1)).alias("n"), F.min("recording_mbid").alias("recording_mbid"))
    return c.where("n = 1").select("pair_hash", "recording_mbid")


def _match(s: SparkSession, d: str) -> DataFrame:
    pairs, _, cands = _shared(s, d)
    texts = M.texts_of(_listens(s, d), pairs)
    return M.match_texts(texts, cands, _scored(s, d, cands, texts), RULES)


def m1_match(s: SparkSession, d: str) -> DataFrame:
    return _match(s, d)


def _per_listen(listens: DataFrame, decisions: DataFrame) -> DataFrame:
    """One decision per listen; the texts' decisions are joined back by hash, hot texts salted."""
    ph = T.pair_hash(F.col("artist_name"), F.col("recording_name"))
    li = listens.select("listen_hash", F.sha2(F.concat(ph, F.lit("\u001f"), F.coalesce("release_name", F.lit("~null~"))), 256).alias("text_hash")).distinct()
    m = decisions.select("text_hash", "matched_recording_mbid", "match_status", "match_method", "failure_reason")
    return salted_join(li, m, "text_hash", "inner").drop("text_hash")


def m1_listens(s: SparkSession, d: str) -> DataFrame:
    return _per_listen(_listens(s, d), _match(s, d))


#: what no decision may be; thirteen conditions over one row
INVARIANTS = {
    "matched_without_id": "match_status = 'MATCHED' and matched_recording_mbid is null", "unresolved_with_id": "match_status <> 'MATCHED' and matched_recording_mbid is not null",
    "matched_with_reason": "match_status = 'MATCHED' and failure_reason is not null", "unresolved_without_reason": "match_status <> 'MATCHED' and failure_reason is null",
    "structural_with_score": "match_method = 'STRUCTURAL_EXACT_UNIQUE' and match_score is not null", "unique_with_margin": "match_method = 'SCORED_FALLBACK_UNIQUE' and score_margin is not null",
    "tie_with_winner": "failure_reason = 'AMBIGUOUS_TIE' and matched_recording_mbid is not null", "matched_without_candidate": "candidate_count = 0 and match_status = 'MATCHED'",
    "candidates_without_method": "candidate_count > 0 and block_method is null", "method_without_candidates": "candidate_count = 0 and block_method is not null",
    "scored_match_without_score": "match_status = 'MATCHED' and match_method <> 'STRUCTURAL_EXACT_UNIQUE' and match_score is null",
    "below_threshold_matched": f"match_status = 'MATCHED' and match_score < case when block_method = 'EXACT' then {RULES.exact_threshold} else {RULES.fallback_threshold} end",
    "thin_margin_matched": f"match_status = 'MATCHED' and score_margin < {RULES.minimum_margin}",
}


def ag9_invariants(s: SparkSession, d: str) -> DataFrame:
    """A battery of conditional counts over the decisions in one pass; all but the first must be 0."""
    return _match(s, d).agg(F.count(F.lit(1)).alias("texts"), *[F.count_if(F.expr(c)).alias(n) for n, c in INVARIANTS.items()])


def p6_baseline(s: SparkSession, d: str) -> DataFrame:
    pairs, _, cands = _shared(s, d)
    return M.baseline(pairs, cands)


def f21_retention(s: SparkSession, d: str) -> DataFrame:
    r = T.retention(F.col("key_exact"), F.col("artist_name"), F.col("recording_name"))
    return _pairs(s, d).select("pair_hash", F.round(r, 9).alias("ratio"), T.information_class(r).alias("information_class"))


def f16_script_class(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d).select("pair_hash", T.script_class(F.col("recording_name")).alias("script_class"))


def ag34_script_coverage(s: SparkSession, d: str) -> DataFrame:
    """By script class of the title: texts, and the shares with one or no exact candidate."""
    c = j2_exact(s, d).groupBy("pair_hash").agg(F.count(F.lit(1)).alias("n"))
    p = f16_script_class(s, d).join(c, "pair_hash", "left")
    n = F.count(F.lit(1))
    return p.groupBy("script_class").agg(n.alias("pairs"), F.round(F.count_if(F.col("n") == 1) / n, 9).alias("unique_share"), F.round(F.count_if(F.col("n").isNull()) / n, 9).alias("zero_share"))


def ag24_collisions(s: SparkSession, d: str) -> DataFrame:
    k = _pairs(s, d).where("status_exact = 'AVAILABLE'").select("pair_hash")
    n = j2_exact(s, d).groupBy("pair_hash").agg(F.count(F.lit(1)).alias("n"))
    return k.join(n, "pair_hash", "left").agg(F.round(F.try_divide(F.count_if(F.col("n") > 1), F.count_if(F.col("n") >= 1)), 9).alias("collision_rate"))


def _weighted(s: SparkSession, d: str) -> DataFrame:
    li = _listens(s, d).withColumn("pair_hash", T.pair_hash(F.col("artist_name"), F.col("recording_name"))).groupBy("pair_hash").agg(F.count_distinct("listen_hash").alias("listens"))
    n = _cands(s, d).groupBy("pair_hash").agg(F.count_distinct("recording_mbid").alias("recordings"))
    return li.join(n, "pair_hash", "left").select("pair_hash", "listens", F.coalesce("recordings", F.lit(0)).alias("recordings"))


def j24_key_weight(s: SparkSession, d: str) -> DataFrame:
    return _weighted(s, d).groupBy("recordings").agg(F.count(F.lit(1)).alias("pairs"), F.sum("listens").alias("listens"))


def ag16_weighted_quantile(s: SparkSession, d: str) -> DataFrame:
    return E.weighted_quantiles(_weighted(s, d), "recordings", "listens", [0.5, 0.9, 0.99])


def w6_top_unmatched(s: SparkSession, d: str) -> DataFrame:
    m = _match(s, d).where("match_status = 'UNRESOLVED'").select("text_hash", "pair_hash", "failure_reason")
    names = _pairs(s, d).select("pair_hash", "artist_name", "recording_name")
    ph = T.pair_hash(F.col("artist_name"), F.col("recording_name"))
    n = _listens(s, d).select("listen_hash", F.sha2(F.concat(ph, F.lit("\u001f"), F.coalesce("release_name", F.lit("~null~"))), 256).alias("text_hash")).distinct().groupBy("text_hash").agg(F.count(F.lit(1)).alias("w"))
    j = m.join(names, "pair_hash").join(n, "text_hash")
    c = j.groupBy("failure_reason", "artist_name", "recording_name").agg(F.sum("w").alias("listens"))
    # a reason's total is an aggregate; the rank alone in the window lets each task keep its own first twenty
    c = checkpointed(c)
    total = c.groupBy("failure_reason").agg(F.sum("listens").alias("reason_listens"))
    w = W.partitionBy("failure_reason").orderBy(F.col("listens").desc(), "artist_name", "recording_name")
    r = c.withColumn("rank", F.row_number().over(w)).where("rank <= 20")
    return r.join(F.broadcast(total), "failure_reason")  # a row per reason


def s2_top_pairs(s: SparkSession, d: str) -> DataFrame:
    c = _listens(s, d).groupBy("artist_name", "recording_name").agg(F.count_distinct("listen_hash").alias("listens"))
    return c.orderBy(F.col("listens").desc(), F.col("artist_name").asc_nulls_first(), F.col("recording_name").asc_nulls_first()).limit(25)


def f1_normalized(s: SparkSession, d: str) -> DataFrame:
    """Unicode normalization of every distinct pair."""
    return T.normalize_pairs(_pairs(s, d).select("pair_hash", "artist_name", "recording_name"), "pair_hash", "artist_name", "recording_name")


def f11_romanised(s: SparkSession, d: str) -> DataFrame:
    x = _pairs(s, d).select("pair_hash", T.romanised(F.col("artist_name")).alias("a"), T.romanised(F.col("recording_name")).alias("r"))
    return x.select("pair_hash", F.col("a.text").alias("artist_roman"), F.col("a.covered").alias("artist_covered"), F.col("r.text").alias("recording_roman"), F.col("r.covered").alias("recording_covered"))


def f14_scripts(s: SparkSession, d: str) -> DataFrame:
    """Letters per script by native character ranges."""
    def n(p: str):
        return F.char_length("recording_name") - F.char_length(F.regexp_replace("recording_name", p, ""))

    return _pairs(s, d).select("pair_hash", n(r"[\x{AC00}-\x{D7A3}]").alias("hangul"), n(r"[\x{3041}-\x{3096}\x{30A1}-\x{30FA}]").alias("kana"), n(r"[\x{0400}-\x{04FF}]").alias("cyrillic"), n(r"[\x{0370}-\x{03FF}]").alias("greek"))


def f14_inventory(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d).select("pair_hash", T.scripts_of(F.col("recording_name")).alias("x")).select("pair_hash", "x.*")


def f15_dominant(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d).select(T.dominant_script(F.col("recording_name")).alias("script")).groupBy("script").agg(F.count(F.lit(1)).alias("pairs"))


#: what romanisation may cover, and the bounds its keys must keep; fixed values
ALTERNATIVES = {"hangul": ("hangul",), "hangul_kana": ("hangul", "kana")}
UNIQUE_RATE, LARGEST_BLOCK = 0.90, 100


def r5_translit_probe(s: SparkSession, d: str) -> DataFrame:
    """Per alternative what romanised keys would add: pairs without an exact candidate that find one, several or none by it, the largest block, and
    whether the bounds hold: of the pairs that find any, the share that finds one only, and the largest block. Where none is admissible nothing is to be done."""
    cat = checkpointed(_catalogue(s, d).groupBy("recording_mbid").agg(F.min("artist_credit_name").alias("a"), F.min("recording_name").alias("r")))
    pairs, _, cands = _shared(s, d)
    left = checkpointed(pairs.join(cands.where("block_method = 'EXACT'").select("pair_hash").distinct(), "pair_hash", "left_anti").select("pair_hash", "artist_name", "recording_name"))
    out = None
    for name, scripts in ALTERNATIVES.items():
        ix = T.normalize_pairs(cat, "recording_mbid", "a", "r", scripts).where("status_exact = 'AVAILABLE'").select(F.col("key_exact").alias("key"), "recording_mbid")
        p = T.normalize_pairs(left, "pair_hash", "artist_name", "recording_name", scripts).where("status_exact = 'AVAILABLE'").select("pair_hash", F.col("key_exact").alias("key"))
        n = p.join(ix, "key", "left").groupBy("pair_hash").agg(F.count("recording_mbid").alias("n"))
        x = n.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("n") == 1).alias("unique_pairs"), F.count_if(F.col("n") > 1).alias("ambiguous_pairs"), F.coalesce(F.max("n"), F.lit(0)).alias("largest_block")).withColumn("alternative", F.lit(name))
        out = x if out is None else out.unionByName(x)
    rate = F.try_divide(F.col("unique_pairs"), F.col("unique_pairs") + F.col("ambiguous_pairs"))
    return out.withColumns({"unique_rate": F.round(rate, 9), "admissible": F.coalesce(rate >= UNIQUE_RATE, F.lit(False)) & (F.col("largest_block") <= LARGEST_BLOCK)})


def recomputed(s: SparkSession, d: str, cohort: DataFrame, scripts: tuple[str, ...] = ALTERNATIVES["hangul_kana"]) -> DataFrame:
    """The cohort's listens blocked, scored and decided anew with romanised keys; the index is the old one and the romanised keys, each once."""
    li = _listens(s, d).join(cohort, "listen_hash", "left_semi")
    pairs = checkpointed(M.distinct_pairs(li, scripts))
    cat = _catalogue(s, d)
    index = checkpointed(M.blocking_index(cat).unionByName(M.blocking_index(cat, scripts)).distinct())
    cands = checkpointed(M.candidates(pairs, index))
    texts = M.texts_of(li, pairs)
    m = M.match_texts(texts, cands, _scored(s, d, cands, texts), RULES)
    return _per_listen(li, m)


def f24_split(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "ext_listens_2026_06").select("recording_mbid").distinct()
    return c.select("recording_mbid", E.partition_of(F.col("recording_mbid")).alias("part"))


def f25_hash_unit(s: SparkSession, d: str) -> DataFrame:
    return _catalogue(s, d).select("recording_mbid").distinct().select("recording_mbid", F.round(hash_unit(F.concat(F.lit("u|"), "recording_mbid")), 12).alias("u"))


def p15_hash_sample(s: SparkSession, d: str) -> DataFrame:
    """The hash-bucket sampling operator: 1 of 40 buckets of the listens."""
    return _listens(s, d).where(hash_bucket(F.col("listen_hash"), 40) == 7).select("listen_hash", "recording_msid").distinct()


def f32_listen_hash(s: SparkSession, d: str) -> DataFrame:
    """listen_hash from the raw columns: SHA-256 of user, unix microseconds and msid."""
    x = table(s, d, "ext_listens_2026_06")
    h = F.sha2(F.concat_ws("|", F.col("user_id").cast("string"), F.unix_micros(F.col("listened_at").cast("timestamp")).cast("string"), "recording_msid"), 256)
    return x.select(h.alias("listen_hash"), F.to_date("listened_at").cast("string").alias("listen_date")).distinct()


#: without marks, and with what compatibility decomposition makes of the characters of one-byte code pages
_FOLDED = "strip_accents(lower(replace(replace(replace(replace(translate(coalesce({}, ''), 'ªº²³¹µ', 'ao231μ'), '¼', '1⁄4'), '½', '1⁄2'), '¾', '3⁄4'), '™', 'TM')))"
_K = f"regexp_replace({_FOLDED}, '[^a-z0-9]', '', 'g')"
#: whether every letter and digit found an ASCII form
_WHOLE = rf"not regexp_matches(regexp_replace({_FOLDED}, '[a-z0-9]', '', 'g'), '[\p{{{{L}}}}\p{{{{N}}}}]')"
#: Hangul syllables in their jamo, as compatibility decomposition leaves them
_JAMO = """array_to_string(list_transform(string_split({}, ''), lambda c: case when unicode(c) between 44032 and 55203 then chr(cast(4352 + (unicode(c) - 44032) // 588 as int))
  || chr(cast(4449 + (unicode(c) - 44032) % 588 // 28 as int)) || case when (unicode(c) - 44032) % 28 > 0 then chr(cast(4519 + (unicode(c) - 44032) % 28 as int)) else '' end else c end), '')"""
_T = "trim(regexp_replace(" + _JAMO.format(f"replace(replace({_FOLDED}, 'ß', 'ss'), 'ς', 'σ')") + r", '[\p{{P}}\p{{S}}\p{{C}}\p{{Z}}]+', ' ', 'g'))"
_SEPARATORS = " -–—_/|,:;."


def _agg(c: str) -> str:
    """The rules of the fallback stage, step by step; an underscore bounds a word as a hyphen does, and only ASCII letters and digits are within one."""
    t = f"replace({c}, '_', '-')"
    for p, r, how in [(r"[\(\[\{][^\)\]\}]*[\)\]\}]", " ", "g"), (r"\b(?:featuring|feat|ft|with)\b.*", "", "s"), *[(p, " ", "g") for p in sorted(T.YEAR_PHRASES, key=len, reverse=True)], *[(rf"^([ \-–—/|,:;.]*\b{x}\b)|\b{x}\b", r"\1 ", "g") for x in sorted(T.SUFFIXES, key=len, reverse=True)], (r"[\s\p{Z}]+", " ", "g")]:
        t = f"regexp_replace({t}, '{p}', '{r}', '{how}')"
    return f"regexp_replace(trim(trim({t}), '{_SEPARATORS}'), '^(?:the|a|an) ', '')"


def _fb(c: str) -> str:
    """The name in lower case after the fallback stage, whole again if nothing would be left of it."""
    low = f"lower(coalesce({c}, ''))"
    return f"(case when {_K.format(_agg(low))} = '' then {low} else {_agg(low)} end)"


_STATUS = "case when {0} = '' and {1} = '' then 'EMPTY' when {0} = '' or {1} = '' or not {2} then 'PARTIAL' else 'AVAILABLE' end"
_BOTH = "case when {0} <> '' and {1} <> '' and {2} then {0} || {1} else '' end"
_W = RULES.weights
#: one-byte stand-ins for letters outside ASCII, since DuckDB's levenshtein counts bytes: characters that no compared text holds
_NARROW = "substr('" + "".join(chr(c) for c in range(33, 127) if not chr(c).isdigit() and not chr(c).islower() and chr(c) not in "'") + "', 1, length(wide))"
_SIM = "case when {0} = '' or {1} = '' then 0.0 else 1.0 - levenshtein({0}, {1}) / greatest(length({0}), length({1})) end"


def _jac(a: str, b: str) -> str:
    x, y = (f"list_distinct(list_filter(string_split({c}, ' '), lambda t: t <> ''))" for c in (a, b))
    return f"coalesce(len(list_intersect({x}, {y})) / nullif(len(list_distinct(list_concat({x}, {y}))), 0), 0.0)"


_NUM = "0.0::double" + "".join(f" + case when {f} is null then 0.0::double else {f} * {w!r}::double end" for f, w in zip(M.FEATURES, _W))
_DEN = "0.0::double" + "".join(f" + case when {f} is null then 0.0::double else {w!r}::double end" for f, w in zip(M.FEATURES, _W))

def _q(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _map(d: dict) -> str:
    return "map {" + ", ".join(f"'{k}': '{v}'" for k, v in d.items()) + "}"


_SMALL_JOIN = "~"  # stands between a syllable and the small kana after it; kana texts that hold one are not told apart
_SYLLABLE = f"{_q(INITIALS)}[(unicode(c) - 44032) // 588 + 1] || {_q(MEDIALS)}[(unicode(c) - 44032) % 588 // 28 + 1] || {_q(FINALS)}[(unicode(c) - 44032) % 28 + 1]"


def _roman(x: str, kana: bool = True) -> str:
    """Hangul, and kana if asked, in Latin letters: as the kernel's steps, each over the whole text."""
    t = f"array_to_string(list_transform(string_split({x}, ''), lambda c: case when unicode(c) between 44032 and 55203 then {_SYLLABLE} else coalesce({_map(JAMO)}[c], c) end), '')"
    if not kana:
        return t
    hira = "".join(chr(c) for c in range(0x3041, 0x3097))
    t = f"replace(translate({t}, '{hira}', '{''.join(chr(ord(c) + 0x60) for c in hira)}'), 'ー', '')"
    full, own = "".join(KATAKANA), _map(KATAKANA)
    t = f"list_reduce({_q(KATAKANA)}, lambda acc, k: regexp_replace(acc, 'ッ([^{full}]*)' || k, '\\1' || substr({own}[k], 1, 1) || k, 'g'), {t})"
    t = f"list_reduce({_q(KATAKANA)}, lambda acc, k: replace(acc, k, {own}[k]), replace(replace({t}, 'ッ', ''), '・', ' '))"
    t = f"list_reduce({_q(SMALL)}, lambda acc, k: replace(acc, k, '{_SMALL_JOIN}' || {_map(SMALL)}[k]), {t})"
    return f"list_reduce({_q(range(12))}, lambda acc, k: regexp_replace(acc, '(sh|ch|j)[aiueo]{_SMALL_JOIN}y?|[aiueo]{_SMALL_JOIN}|{_SMALL_JOIN}', '\\1'), {t})"


def _keys(names: str, artist: str, recording: str, r) -> str:
    """Exact and fallback halves of both names of a row and whether they are whole; ``r`` says how a name is romanised first."""
    a, t, ga, gr = (r(f"coalesce({c}, '')") for c in (artist, recording, "ga", "gr"))
    return f"select *, {_K.format(a)} as ka, {_K.format(t)} as kr, {_K.format(ga)} as fa, {_K.format(gr)} as fr, {_WHOLE.format(a)} and {_WHOLE.format(t)} as wk, {_WHOLE.format(ga)} and {_WHOLE.format(gr)} as wf from {names}"


_INDEX = f"select recording_mbid, 'EXACT' as lookup_stage, {_BOTH.format('ka', 'kr', 'wk')} as lookup_key from {{0}} union all select recording_mbid, 'FALLBACK', {_BOTH.format('fa', 'fr', 'wf')} from {{0}}"


def base(roman: bool = False) -> str:
    """The matcher from names to decisions; ``roman``: keys romanised, and looked up among those of the old index and the romanised ones."""
    r = _roman if roman else str
    plain_index = f"c0 as ({_keys('cf', 'artist_credit_name', 'recording_name', str)}),\n" if roman else ""
    more = f" union all {_INDEX.format('c0')}" if roman else ""
    return f"""
with pr as (select distinct coalesce(artist_name, '') as artist_name, coalesce(recording_name, '') as recording_name from bronze_listens),
pf as (select *, {_fb('artist_name')} as ga, {_fb('recording_name')} as gr from pr),
p0 as ({_keys('pf', 'artist_name', 'recording_name', r)}),
pk as (select *, {_T.format('artist_name')} as ua, {_T.format('recording_name')} as ur from p0),
pairs as (select sha256(artist_name || chr(31) || recording_name) as pair_hash, artist_name, recording_name, ua as artist_text, ur as recording_text,
  {_BOTH.format('ka', 'kr', 'wk')} as key_exact, {_STATUS.format('ka', 'kr', 'wk')} as status_exact, {_BOTH.format('fa', 'fr', 'wf')} as key_fallback, {_STATUS.format('fa', 'fr', 'wf')} as status_fallback,
  case when regexp_full_match(artist_name, '\\s*') then 'MISSING_ARTIST' when regexp_full_match(recording_name, '\\s*') then 'MISSING_RECORDING'
  when ua = '' or ur = '' then 'NO_ALPHANUMERIC_CONTENT' else 'VALID' end as content from pk),
cf as (select distinct recording_mbid, artist_credit_name, recording_name, {_fb('artist_credit_name')} as ga, {_fb('recording_name')} as gr from bronze_canonical_recordings),
ck as ({_keys('cf', 'artist_credit_name', 'recording_name', r)}),
{plain_index}idx as (select distinct * from ({_INDEX.format('ck')}{more}) where lookup_key <> ''),
""" + _FROM_CANDIDATES


_FROM_CANDIDATES = f"""ex as (select pair_hash, recording_mbid, 'EXACT' as block_method, key_exact as block_key from pairs join idx on lookup_stage = 'EXACT' and lookup_key = key_exact where status_exact = 'AVAILABLE'),
fb as (select pair_hash, recording_mbid, 'FALLBACK' as block_method, key_fallback as block_key from pairs join idx on lookup_stage = 'FALLBACK' and lookup_key = key_fallback where status_fallback = 'AVAILABLE' and pair_hash not in (select pair_hash from ex)),
cands as (select * from ex union all select * from fb),
uni as (select * exclude (n) from (select *, count(*) over (partition by pair_hash) as n from cands) where n > 1 or block_method = 'FALLBACK'),
cm as (select recording_mbid, min(artist_credit_name) as a, min(recording_name) as r, min(release_name) as l from bronze_canonical_recordings group by 1),
ctx as (select recording_mbid, case when a is not null then {_T.format('a')} end as c_artist, case when r is not null then {_T.format('r')} end as c_recording, lower(trim(l)) as c_release from cm),
tx0 as (select distinct sha256(coalesce(artist_name, '') || chr(31) || coalesce(recording_name, '')) as pair_hash, release_name from bronze_listens),
tx as (select tx0.*, sha256(tx0.pair_hash || chr(31) || coalesce(release_name, '~null~')) as text_hash, p.artist_text, p.recording_text, p.content, p.status_exact from tx0 join pairs p using (pair_hash)),
fj as (select *, array_to_string(list_distinct(string_split(regexp_replace(artist_text || c_artist || recording_text || c_recording, '[\\x00-\\x7F]', '', 'g'), '')), '') as wide from uni join tx using (pair_hash) join ctx using (recording_mbid)),
fn as (select *, translate(artist_text, wide, {_NARROW}) as na, translate(c_artist, wide, {_NARROW}) as nca, translate(recording_text, wide, {_NARROW}) as nr, translate(c_recording, wide, {_NARROW}) as ncr from fj),
feats as (select text_hash, pair_hash, recording_mbid, block_method,
  (artist_text <> '' and artist_text = c_artist)::int::double as artist_exact, (recording_text <> '' and recording_text = c_recording)::int::double as recording_exact,
  {_jac('artist_text', 'c_artist')} as artist_jaccard, {_jac('recording_text', 'c_recording')} as recording_jaccard,
  {_SIM.format('na', 'nca')} as artist_similarity, {_SIM.format('nr', 'ncr')} as recording_similarity,
  case when coalesce(trim(release_name), '') <> '' then coalesce(lower(trim(release_name)) = c_release, false)::int::double end as release_exact
  from fn),
sc as (select text_hash, recording_mbid, round(({_NUM}) / nullif({_DEN}, 0), 9) as score from feats),
rk as (select *, row_number() over (partition by text_hash order by score desc nulls last, recording_mbid) as rn from sc),
top2 as (select text_hash, max(case when rn = 1 then score end) as top1, max(case when rn = 2 then score end) as top2, max(case when rn = 1 then recording_mbid end) as winner from rk group by 1),
cnt as (select pair_hash, count(*) as n, min(block_method) as block_method, min(recording_mbid) as sole from cands group by 1),
mj as (select tx.text_hash, tx.pair_hash, tx.content, tx.status_exact, coalesce(cnt.n, 0) as n, cnt.block_method, cnt.sole, top1, top2, winner, coalesce(cnt.block_method = 'EXACT' and cnt.n = 1, false) as st from tx left join cnt using (pair_hash) left join top2 using (text_hash)),
mo as (select *, case when st then 'ACCEPTED' when n = 0 or top1 is null then 'NO_BLOCK_CANDIDATES' when top1 < (case when block_method = 'EXACT' then {RULES.exact_threshold} else {RULES.fallback_threshold} end) then 'BELOW_THRESHOLD'
  when n = 1 or top2 is null then 'ACCEPTED' when round(top1 - top2, 9) <= {RULES.tie_epsilon} then 'AMBIGUOUS_TIE' when round(top1 - top2, 9) < {RULES.minimum_margin} then 'AMBIGUOUS_TIE' else 'ACCEPTED' end as outcome from mj),
mt as (select text_hash, pair_hash, case when outcome = 'ACCEPTED' then case when st then sole else winner end end as matched_recording_mbid, case when outcome = 'ACCEPTED' then 'MATCHED' else 'UNRESOLVED' end as match_status,
  case when n = 0 then 'E' when block_method = 'EXACT' then 'C' else 'D' end as match_tier,
  case when n = 0 then 'NO_CANDIDATES' when st then 'STRUCTURAL_EXACT_UNIQUE' when block_method = 'EXACT' then 'SCORED_EXACT_MULTIPLE' when n = 1 then 'SCORED_FALLBACK_UNIQUE' else 'SCORED_FALLBACK_MULTIPLE' end as match_method,
  case when not st then top1 end as match_score, case when not st and n > 1 then round(top1 - top2, 9) end as score_margin,
  case when outcome = 'ACCEPTED' then null when n > 0 then outcome when content <> 'VALID' then content when status_exact = 'PARTIAL' then 'NO_LOOKUP_KEY_PARTIAL' when status_exact = 'EMPTY' then 'NO_LOOKUP_KEY_EMPTY' else 'NO_BLOCK_CANDIDATES' end as failure_reason,
  block_method, n as candidate_count from mo),
lt as (select distinct listen_hash, sha256(sha256(coalesce(artist_name, '') || chr(31) || coalesce(recording_name, '')) || chr(31) || coalesce(release_name, '~null~')) as text_hash, sha256(coalesce(artist_name, '') || chr(31) || coalesce(recording_name, '')) as pair_hash from bronze_listens),
wt as (select l.pair_hash, count(distinct listen_hash) as listens, coalesce(max(c.k), 0) as recordings from lt l left join (select pair_hash, count(distinct recording_mbid) as k from cands group by 1) c using (pair_hash) group by 1)
"""
BASE = base()
_CLASS = r"case when length(regexp_replace({0}, '[^\p{{L}}\p{{N}}]', '', 'g')) = 0 then 'NONE' when length(regexp_replace({0}, '[^\p{{Latin}}0-9]', '', 'g')) * 2 >= length(regexp_replace({0}, '[^\p{{L}}\p{{N}}]', '', 'g')) then 'LATIN' else 'NON_LATIN' end"
_RET = r"length(key_exact) / nullif(length(regexp_replace(artist_name || recording_name, '[^\p{L}\p{N}]', '', 'g')), 0)"
_BUCKET = "cast('0x' || substr(sha256({}), 1, 8) as bigint)"


def _len_in(p: str) -> str:
    return f"length(recording_name) - length(regexp_replace(recording_name, '{p}', '', 'g'))"


_HANGUL, _KANA, _HAN = (rf"regexp_matches(c, '{p}')" for p in ("[가-힣" + "".join(JAMO) + "]", "[ぁ-ゖァ-・ー-ヿ]", "[一-鿿㐀-䶿\\x{20000}-\\x{323AF}]"))
_LETTER = rf"regexp_matches(c, '\p{{L}}') and not {_HANGUL} and not {_KANA} and not {_HAN}"
_GROUPS = {"hangul": _HANGUL, "kana": f"{_KANA} and c <> '・'", "han": f"{_HAN} and not {_HANGUL} and not {_KANA}", "latin": rf"{_LETTER} and regexp_matches(c, '[\p{{Latin}}]') and c not in ('ª', 'º')", "other": rf"{_LETTER} and (not regexp_matches(c, '[\p{{Latin}}]') or c in ('ª', 'º'))"}


def _covered(x: str) -> str:
    """Whether no letter but Latin ones is left."""
    return f"len(list_filter(string_split({x}, ''), lambda c: {_HANGUL} or ({_KANA} and c <> '・') or {_HAN} or ({_GROUPS['other']}))) = 0"


def _roman_key(key: str, names: str, kana: bool) -> str:
    """(key column, romanised exact key) of the rows of ``names`` (a, r) that have one."""
    a, r = _roman("a", kana), _roman("r", kana)
    return f"select {key}, key from (select {key}, {_K.format(a)} || {_K.format(r)} as key, {_K.format(a)} <> '' and {_K.format(r)} <> '' and {_WHOLE.format(a)} and {_WHOLE.format(r)} as ok from {names}) where ok"


#: the first word of a letter's Unicode name, for the scripts there are
_FIRST_WORD = "case when c = 'ª' then 'FEMININE' when c = 'º' then 'MASCULINE' when c = 'µ' then 'MICRO' when c = 'ー' then 'KATAKANA-HIRAGANA' when regexp_matches(c, '[\\p{Latin}]') then 'LATIN' " + " ".join(f"when regexp_matches(c, '[\\p{{{p}}}]') then '{w}'" for p, w in {"Cyrillic": "CYRILLIC", "Greek": "GREEK", "Hangul": "HANGUL", "Hiragana": "HIRAGANA", "Katakana": "KATAKANA", "Han": "CJK", "Arabic": "ARABIC", "Hebrew": "HEBREW", "Thai": "THAI"}.items()) + " else 'UNKNOWN' end"
SQL = {
    "N1_pairs": BASE + "select pair_hash, artist_name, recording_name, artist_text, recording_text, key_exact, status_exact, key_fallback, status_fallback, content from pairs",
    "N2_blocking_index": BASE + "select * from idx",
    "N3_scored_texts": BASE + "select * from ctx where recording_mbid in (select recording_mbid from uni)",
    "F1_normalized": BASE + f"select pair_hash, artist_text, recording_text, key_exact, status_exact, key_fallback, status_fallback, content, '{T.VERSION}' as normalization_version from pairs",
    "F14_inventory": BASE + "select pair_hash, " + ", ".join(f"cast(len(list_filter(string_split(recording_name, ''), lambda c: {w})) as int) as {k}" for k, w in _GROUPS.items()) + " from pairs",
    "F11_romanised": BASE + f", ro as (select pair_hash, {_roman('artist_name')} as a, {_roman('recording_name')} as r from pairs) select pair_hash, a as artist_roman, {_covered('a')} as artist_covered, r as recording_roman, {_covered('r')} as recording_covered from ro",
    "F15_dominant_script": BASE + f", ch as (select pair_hash, unnest(string_split(recording_name, '')) as c from pairs), cs as (select pair_hash, {_FIRST_WORD} as w, count(*) as n from ch where regexp_matches(c, '[\\p{{L}}]') group by 1, 2), best as (select pair_hash, coalesce(arg_min(w, (-n, w)), 'NONE') as script from cs group by 1) select coalesce(script, 'NONE') as script, count(*) as pairs from pairs left join best using (pair_hash) group by 1",
    "R5_translit_probe": BASE + ", cn as (select recording_mbid, min(artist_credit_name) as a, min(recording_name) as r from bronze_canonical_recordings group by 1), lf as (select pair_hash, artist_name as a, recording_name as r from pairs where pair_hash not in (select pair_hash from ex)), " + ", ".join(f"c_{n} as ({_roman_key('recording_mbid', 'cn', k)}), l_{n} as ({_roman_key('pair_hash', 'lf', k)}), n_{n} as (select pair_hash, count(recording_mbid) as n from l_{n} left join c_{n} using (key) group by 1)" for n, k in (("hangul", False), ("hangul_kana", True))) + ", o as (" + " union all ".join(f"select '{n}' as alternative, count(*) as pairs, count_if(n = 1) as unique_pairs, count_if(n > 1) as ambiguous_pairs, coalesce(max(n), 0) as largest_block from n_{n}" for n in ALTERNATIVES) + f") select *, round(unique_pairs / nullif(unique_pairs + ambiguous_pairs, 0), 9) as unique_rate, coalesce(unique_pairs / nullif(unique_pairs + ambiguous_pairs, 0) >= {UNIQUE_RATE}, false) and largest_block <= {LARGEST_BLOCK} as admissible from o",
    "S1_ordered_export": BASE + "select * from ctx where recording_mbid in (select recording_mbid from uni)",
    "J1_listens_pairs": BASE + "select distinct listen_hash, pair_hash, key_exact, status_exact from lt join pairs using (pair_hash)",
    "J2_exact_blocking": BASE + "select * from ex",
    "J3_fallback_blocking": BASE + "select * from fb",
    "U1_candidates": BASE + "select * from cands",
    "J4_scored_universe": BASE + "select * from uni",
    "J5_features": BASE + "select text_hash, recording_mbid, block_method, " + ", ".join(f"round({f}, 9) as {f}" for f in M.FEATURES) + " from feats",
    "F22_score": BASE + "select * from sc",
    "W1_candidate_rank": BASE + "select text_hash, recording_mbid, rn from rk",
    "AG1_candidate_counts": BASE + "select pair_hash, n, block_method from cnt",
    "AG2_sole_member": BASE + "select pair_hash, sole as recording_mbid from cnt where n = 1",
    "AG3_top2": BASE + "select * from top2",
    "M1_match": BASE + "select * from mt",
    "M1_listens": BASE + "select listen_hash, matched_recording_mbid, match_status, match_method, failure_reason from lt join mt using (text_hash)",
    "AG9_invariants": BASE + "select count(*) as texts, " + ", ".join(f"count_if({c}) as {n}" for n, c in INVARIANTS.items()) + " from mt",
    "P6_baseline": BASE + "select pair_hash, case when m = 'EXACT' and n = 1 then sole end as matched_recording_mbid, case when m = 'EXACT' and n = 1 then 'MATCHED' else 'UNRESOLVED' end as match_status, case when m = 'EXACT' and n = 1 then 'C' when m = 'FALLBACK' and n = 1 then 'D' else 'E' end as match_tier, case when m = 'EXACT' and n = 1 then null when n = 0 then case when content <> 'VALID' then content else 'NO_BLOCK_CANDIDATES' end when m = 'FALLBACK' and n = 1 then 'FALLBACK_REQUIRES_SCORING' else 'MULTIPLE_CANDIDATES_UNSCORED_' || m end as failure_reason, n as candidate_count from (select p.pair_hash, p.content, coalesce(cnt.n, 0) as n, cnt.block_method as m, cnt.sole from pairs p left join cnt using (pair_hash))",
    "F21_retention": BASE + f"select pair_hash, round({_RET}, 9) as ratio, case when {_RET} < 0.20 then 'POTENTIAL_LOW_INFORMATION' else 'NORMAL' end as information_class from pairs",
    "F16_script_class": BASE + f"select pair_hash, {_CLASS.format('recording_name')} as script_class from pairs",
    "AG34_script_coverage": BASE + f"select script_class, count(*) as pairs, round(count(*) filter (where n = 1) / count(*), 9) as unique_share, round(count(*) filter (where n is null) / count(*), 9) as zero_share from (select pair_hash, {_CLASS.format('recording_name')} as script_class from pairs) left join (select pair_hash, count(*) as n from ex group by 1) using (pair_hash) group by 1",
    "AG24_collision_rate": BASE + "select round(count_if(n > 1) / nullif(count_if(n >= 1), 0), 9) as collision_rate from (select pair_hash from pairs where status_exact = 'AVAILABLE') left join (select pair_hash, count(*) as n from ex group by 1) using (pair_hash)",
    "J24_key_weight": BASE + "select recordings, count(*) as pairs, cast(sum(listens) as bigint) as listens from wt group by 1",
    "AG16_weighted_quantile": BASE + "select q, min(recordings) as recordings from (select recordings, sum(w) over (order by recordings) as c, sum(w) over () as t from (select recordings, sum(listens) as w from wt group by 1)), (select unnest([0.5::double, 0.9::double, 0.99::double]) as q) where c >= q * t group by 1",
    "W6_top_unmatched": BASE + "select * from (select *, row_number() over (partition by failure_reason order by listens desc, artist_name, recording_name) as rank, cast(sum(listens) over (partition by failure_reason) as bigint) as reason_listens from (select failure_reason, artist_name, recording_name, count(*) as listens from mt join lt using (text_hash) join pairs p on p.pair_hash = mt.pair_hash where match_status = 'UNRESOLVED' group by 1, 2, 3)) where rank <= 20",
    "S2_top_pairs": "select artist_name, recording_name, count(distinct listen_hash) as listens from bronze_listens group by 1, 2 order by listens desc, artist_name nulls first, recording_name nulls first limit 25",
    "F14_scripts": BASE + f"select pair_hash, {_len_in('[가-힣]')} as hangul, {_len_in('[ぁ-ゖァ-ヺ]')} as kana, {_len_in('[Ѐ-ӿ]')} as cyrillic, {_len_in('[Ͱ-Ͽ]')} as greek from pairs",
    "F24_hash_split": f"select recording_mbid, case when recording_mbid is null then 'NOT_EVALUABLE' when {_BUCKET.format(chr(39) + 'rillmark-dev-1:' + chr(39) + ' || recording_mbid')} % 100 >= 80 then 'holdout' when {_BUCKET.format(chr(39) + 'rillmark-cal-1:' + chr(39) + ' || recording_mbid')} % 100 < 75 then 'calibration' else 'validation' end as part from (select distinct recording_mbid from ext_listens_2026_06)",
    "F25_hash_unit": "select recording_mbid, round((cast('0x' || substr(sha256('u|' || recording_mbid), 1, 14) as bigint) >> 3) / 9007199254740992.0::double, 12) as u from (select distinct recording_mbid from bronze_canonical_recordings)",
    "P15_hash_sample": f"select distinct listen_hash, recording_msid from bronze_listens where {_BUCKET.format('listen_hash')} % 40 = 7",
    "F32_listen_hash": "select distinct sha256(user_id || '|' || epoch_us(listened_at) || '|' || recording_msid) as listen_hash, strftime(listened_at, '%Y-%m-%d') as listen_date from ext_listens_2026_06",
}
QUERIES = {
    "N1_pairs": n1_pairs, "N2_blocking_index": n2_index, "N3_scored_texts": n3_texts, "S1_ordered_export": s1_ordered_export, "J1_listens_pairs": j1_listens_pairs, "J2_exact_blocking": j2_exact, "J3_fallback_blocking": j3_fallback,
    "U1_candidates": u1_candidates, "J4_scored_universe": j4_universe, "J5_features": j5_features, "F22_score": f22_score, "W1_candidate_rank": w1_rank, "AG1_candidate_counts": ag1_counts, "AG2_sole_member": ag2_sole,
    "AG3_top2": ag3_top2, "M1_match": m1_match, "M1_listens": m1_listens, "AG9_invariants": ag9_invariants, "P6_baseline": p6_baseline, "F21_retention": f21_retention, "F16_script_class": f16_script_class,
    "AG34_script_coverage": ag34_script_coverage, "AG24_collision_rate": ag24_collisions, "J24_key_weight": j24_key_weight, "AG16_weighted_quantile": ag16_weighted_quantile, "W6_top_unmatched": w6_top_unmatched, "S2_top_pairs": s2_top_pairs,
    "F1_normalized": f1_normalized, "F11_romanised": f11_romanised, "F14_scripts": f14_scripts, "F14_inventory": f14_inventory, "F15_dominant_script": f15_dominant, "R5_translit_probe": r5_translit_probe,
    "F24_hash_split": f24_split, "F25_hash_unit": f25_hash_unit, "P15_hash_sample": p15_hash_sample, "F32_listen_hash": f32_listen_hash,
}
