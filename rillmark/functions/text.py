"""Unicode text normalization, lookup keys and their statuses, as Arrow-batched kernels, with native twins for plain ASCII."""

from __future__ import annotations

import operator
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as K

from rillmark.functions.translit import inventory, transliterate

VERSION = "1.0.0"

# The word lists and phrases of the normalization rules.
FEATURING = ["feat", "feat.", "ft", "ft.", "featuring", "with"]
ARTICLES = ["the", "a", "an"]
SUFFIXES = ["remaster", "remastered", "live", "deluxe", "deluxe edition", "radio edit", "mono", "stereo", "bonus track", "anniversary edition", "explicit", "album version", "single version", "remix", "mix", "version"]
YEAR_PHRASES = [
    r"remaster(?:ed)?\s+(?:in\s+)?(?:19|20)\d{2}",
    r"(?:19|20)\d{2}\s+remaster(?:ed)?",
    r"(?:19|20)\d{2}\s+(?:digital\s+)?remaster(?:ed)?\s+version",
    r"anniversary\s+edition\s+(?:19|20)\d{2}",
    r"(?:19|20)\d{2}\s+anniversary\s+edition",
    r"(?:19|20)\d{2}\s+(?:re)?issue",
    r"(?:re)?issue\s+(?:19|20)\d{2}",
]
TRAILING = " -–—_/|,:;."


def _bounded(p: str) -> str:
    return rf"(?<![a-z0-9]){p}(?![a-z0-9])"


def _longest_first(xs: list[str]) -> list[str]:
    return sorted(xs, key=len, reverse=True)


_BRACKETS = re.compile(r"[\(\[\{][^\)\]\}]*[\)\]\}]")
_FEAT = re.compile(_bounded("(?:" + "|".join(re.escape(x) for x in _longest_first(FEATURING)) + ")") + r".*", re.S)
_YEARS = [re.compile(p) for p in _longest_first(YEAR_PHRASES)]
_SUFFIXES = [re.compile(_bounded(re.escape(x))) for x in _longest_first(SUFFIXES)]
_ARTICLE = re.compile(r"\s*(?:" + "|".join(ARTICLES) + ") ")


def unicode_text(s: str | None) -> str:
    """NFKD, combining marks dropped, case folded; punctuation, symbols and controls become one blank; the script stays."""
    d = unicodedata.normalize("NFKD", s or "")
    d = "".join(ch for ch in d if not unicodedata.combining(ch)).casefold()
    return " ".join("".join(" " if unicodedata.category(ch)[0] in "PSCZ" else ch for ch in d).split())


def fold(s: str | None, scripts: tuple[str, ...] = ()) -> tuple[str, bool]:
    """(ASCII key of [a-z0-9], whole): ``whole`` is false when a letter or digit found no ASCII form. With ``scripts`` these are romanised first."""
    t = s or ""
    if scripts and not t.isascii():
        t, _ = transliterate(t, scripts)
    d = "".join(ch for ch in unicodedata.normalize("NFKD", t) if not unicodedata.combining(ch)).lower()
    key = "".join(ch for ch in d if ch.isascii() and ch.isalnum())
    return key, not any(ch.isalnum() and not ch.isascii() for ch in d)


def aggressive(s: str | None) -> str:
    """Name in lower case without brackets, guests, reissue phrases, version marks (where something precedes them), separators at
    the ends and leading article; unchanged if that would leave nothing for a key."""
    low = (s or "").lower()
    t = _FEAT.sub("", _BRACKETS.sub(" ", low), count=1)
    for p in _YEARS:
        t = p.sub(" ", t)
    for p in _SUFFIXES:
        t = p.sub(lambda m, t=t: " " if t[: m.start()].strip(TRAILING).strip() else m[0], t)
    t = " ".join(t.split()).strip(TRAILING)
    m = _ARTICLE.match(t)
    t = t[m.end() :] if m else t
    return t if fold(t)[0] or not fold(low)[0] else low.strip()


def normalize(artist: str | None, recording: str | None, scripts: tuple[str, ...] = ()) -> dict[str, str]:
    """The fields of one pair: Unicode texts, exact and fallback key with statuses AVAILABLE, PARTIAL, EMPTY, and the content status.

    A key exists only when both halves are non-empty and every letter found an ASCII form, so a key is never partial.
    Content is judged on the Unicode texts, not on the key.
    """
    ua, ur = unicode_text(artist), unicode_text(recording)
    out = {"artist_text": ua, "recording_text": ur}
    for name, f in (("exact", str), ("fallback", aggressive)):
        (a, wa), (r, wr) = fold(f(artist or ""), scripts), fold(f(recording or ""), scripts)
        ok = bool(a and r)
        out[f"key_{name}"] = a + r if ok and wa and wr else ""
        out[f"status_{name}"] = "EMPTY" if not a and not r else "AVAILABLE" if ok and wa and wr else "PARTIAL"
    if not (artist or "").strip():
        out["content"] = "MISSING_ARTIST"
    elif not (recording or "").strip():
        out["content"] = "MISSING_RECORDING"
    else:
        out["content"] = "VALID" if ua and ur else "NO_ALPHANUMERIC_CONTENT"
    return out


FIELDS = ["artist_text", "recording_text", "key_exact", "status_exact", "key_fallback", "status_fallback", "content"]


def normalize_pairs(pairs: DataFrame, key: str, artist: str, recording: str, scripts: tuple[str, ...] = ()) -> DataFrame:
    """(key, normalized fields, version): one Arrow pass; give it distinct pairs, not events."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            rows = [normalize(a, r, scripts) for a, r in zip(b[artist], b[recording])]
            yield pd.DataFrame({key: b[key], **{f: [x[f] for x in rows] for f in FIELDS}})

    d = pairs.select(key, artist, recording)
    out = d.mapInPandas(run, f"{key} {d.schema[key].dataType.simpleString()}, " + ", ".join(f"{f} string" for f in FIELDS))
    return out.withColumn("normalization_version", F.lit(VERSION))


def normalized(artist: Column, recording: Column, scripts: tuple[str, ...] = ()) -> Column:
    """The fields of each pair as a struct; a pair of nulls gives nulls, so that pairs the native twins settle cost no work."""

    @F.pandas_udf(K.StructType([K.StructField(f, K.StringType()) for f in FIELDS]))
    def run(a: pd.Series, r: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([[None] * len(FIELDS) if x is None and y is None else operator.itemgetter(*FIELDS)(normalize(x, y, scripts)) for x, y in zip(a, r)], columns=FIELDS)

    return run(artist, recording)


@F.pandas_udf(K.StringType())
def unicode_texts(s: pd.Series) -> pd.Series:
    """``unicode_text`` of each name; null stays null."""
    return s.map(lambda x: None if x is None else unicode_text(x))


@F.pandas_udf(K.StructType([K.StructField("text", K.StringType()), K.StructField("covered", K.BooleanType())]))
def romanised(s: pd.Series) -> pd.DataFrame:
    """Hangul and kana in Latin letters, and whether nothing else than Latin is left."""
    return pd.DataFrame([transliterate(x) for x in s], columns=["text", "covered"])


@F.pandas_udf(K.StructType([K.StructField(n, K.IntegerType()) for n in ("hangul", "kana", "han", "latin", "other")]))
def scripts_of(s: pd.Series) -> pd.DataFrame:
    """Letters per script group."""
    return pd.DataFrame([inventory(x) for x in s], columns=["hangul", "kana", "han", "latin", "other"])


@F.pandas_udf(K.StringType())
def dominant_script(s: pd.Series) -> pd.Series:
    """Script group of most letters, by Unicode character name; ties by name, NONE without letters."""

    def one(x: str | None) -> str:
        n: dict[str, int] = {}
        for ch in x or "":
            if ch.isalpha():
                w = unicodedata.name(ch, "UNKNOWN").split()[0]
                n[w] = n.get(w, 0) + 1
        return min(n, key=lambda w: (-n[w], w)) if n else "NONE"

    return s.map(one)


# ---- native twins: inside whole-stage codegen, equal to the kernels on ASCII text
def pair_hash(artist: Column, recording: Column) -> Column:
    """SHA-256 of both names with U+001F between; a null counts as empty."""
    return F.sha2(F.concat(F.coalesce(artist, F.lit("")), F.lit("\u001f"), F.coalesce(recording, F.lit(""))), 256)


def ascii_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def ascii_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


#: what a name must hold for ``aggressive`` to change its key; a name without any has its exact key as fallback key
MARKS = r"[\(\[\{]|" + _bounded("(?:feat|ft|featuring|with|remaster|remastered|live|deluxe|edit|mono|stereo|track|explicit|version|remix|mix)") + r"|(?:19|20)\d{2}|^[\x00-\x20\-_/|,:;.]*(?:the|an|a)[\x00-\x20]"


def is_ascii(c: Column) -> Column:
    return ~F.coalesce(c, F.lit("")).rlike(r"[^\x00-\x7F]")


def is_plain(c: Column) -> Column:
    """ASCII and without a mark of ``aggressive``: the native twins say all there is to say."""
    return is_ascii(c) & ~F.lower(F.coalesce(c, F.lit(""))).rlike(MARKS)


def is_blank(c: Column) -> Column:
    """Nothing but ASCII white space, as ``str.strip`` sees it."""
    return ~F.coalesce(c, F.lit("")).rlike(r"[^\x09-\x0D\x1C-\x20]")


def text_of(c: Column) -> Column:
    """The text a name is compared on: native where it is ASCII, the Unicode kernel elsewhere."""
    return F.coalesce(unicode_texts(F.when(~is_ascii(c), c)), ascii_text(c))


#: (pattern, replacement) in order; written for both Java and RE2
FALLBACK_STEPS = [
    (r"[\(\[\{][^\)\]\}]*[\)\]\}]", " "),
    (r"(^|[^a-z0-9])(featuring|feat\.|feat|ft\.|ft)[^a-z0-9].*$", " "),
    (r" - ((19|20)[0-9][0-9] )?remaster(ed)?( version)?( (19|20)[0-9][0-9])?$", ""),
    (r"^(the|an|a) ", ""),
]


def fallback_key(c: Column) -> Column:
    """The probe's simple fallback: brackets, guests, reissue suffix and leading article off, then the ASCII key."""
    t = F.lower(F.coalesce(c, F.lit("")))
    for p, r in FALLBACK_STEPS:
        t = F.trim(F.regexp_replace(t, p, r))
    return F.regexp_replace(t, "[^a-z0-9]", "")


def with_fields(df: DataFrame, artist: str, recording: str, scripts: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the FIELDS of ``normalize``: native where both names are plain ASCII, by the kernel for every other row. ``scripts`` are romanised for the keys."""
    a, r = F.coalesce(artist, F.lit("")), F.coalesce(recording, F.lit(""))
    plain = is_plain(a) & is_plain(r)
    d = df.withColumn("_n", normalized(F.when(~plain, a), F.when(~plain, r), scripts))
    ka, kr = ascii_key(a), ascii_key(r)
    key = F.when((ka != "") & (kr != ""), F.concat(ka, kr)).otherwise("")
    status = F.when((ka == "") & (kr == ""), "EMPTY").when((ka == "") | (kr == ""), "PARTIAL").otherwise("AVAILABLE")
    content = F.when(is_blank(a), "MISSING_ARTIST").when(is_blank(r), "MISSING_RECORDING").when((ka == "") | (kr == ""), "NO_ALPHANUMERIC_CONTENT").otherwise("VALID")
    native = {"artist_text": ascii_text(a), "recording_text": ascii_text(r), "key_exact": key, "status_exact": status, "key_fallback": key, "status_fallback": status, "content": content}
    return d.withColumns({f: F.coalesce(F.col(f"_n.{f}"), native[f]) for f in FIELDS}).drop("_n")


def script_class(c: Column) -> Column:
    """LATIN when at least half of the letters and digits are Latin letters or digits, NON_LATIN else, NONE without any."""
    c = F.coalesce(c, F.lit(""))
    every = F.char_length(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))
    latin = F.char_length(F.regexp_replace(c, r"[^\p{IsLatin}0-9]", ""))
    return F.when(every == 0, "NONE").when(latin * 2 >= every, "LATIN").otherwise("NON_LATIN")


def jaccard(a: Column, b: Column) -> Column:
    """Distinct blank-separated tokens; an empty side gives 0."""
    ta, tb = (F.filter(F.split(x, " "), lambda t: t != "") for x in (a, b))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(ta, tb)), F.size(F.array_union(ta, tb))), F.lit(0.0))


def similarity(a: Column, b: Column) -> Column:
    """1 - Levenshtein distance / longer length; 0 if either is empty."""
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(1.0 - F.levenshtein(a, b) / F.greatest(F.char_length(a), F.char_length(b)))


def retention(key: Column, *texts: Column) -> Column:
    """Share of the texts' letters and digits that the ASCII key kept; null without content."""
    n = F.char_length(F.regexp_replace(F.concat(*[F.coalesce(t, F.lit("")) for t in texts]), r"[^\p{L}\p{N}]", ""))
    return F.try_divide(F.char_length(F.regexp_replace(key, "[^a-z0-9]", "")), n)


def information_class(ratio: Column, cut: float = 0.20) -> Column:
    """Low retention marks a key that says little; a null ratio is normal."""
    return F.when(ratio < cut, "POTENTIAL_LOW_INFORMATION").otherwise("NORMAL")
