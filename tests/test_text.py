import pytest
from pyspark.sql import functions as F

from rillmark.functions import text as T
from rillmark.functions.keys import lower_key, run_id, upper_key
from rillmark.functions.translit import hangul, inventory, kana, transliterate

CORPUS = [("Beyoncé", "Déjà Vu"), ("Björk", "Jóga"), ("Кино", "Группа крови"), ("Σωκράτης", "Ὀδύσσεια"), ("해금", "연가"), ("きゃりー", "つけまつける"), ("!!!", "???"), ("", ""), (None, None), ("AC/DC", "T.N.T. (Live)"), ("The The", "The Beat(en) Generation"), ("Mixed 漢字", "Title")]


def test_unicode_text():
    assert T.unicode_text("  Déjà—Vu!! ") == "deja vu"
    assert T.unicode_text("Straße") == "strasse" and T.unicode_text("ΟΔΟΣ") == T.unicode_text("οδος")
    assert T.unicode_text("é") == T.unicode_text("é") == "e"


@pytest.mark.parametrize("a,r", CORPUS)
def test_invariants(a, r):
    n = T.normalize(a, r)
    assert n == T.normalize(a, r)
    assert T.unicode_text(n["artist_text"]) == n["artist_text"]
    assert (n["key_exact"] != "") == (n["status_exact"] == "AVAILABLE")
    assert n["key_exact"].isascii() and (n["key_exact"] == "" or n["key_exact"].isalnum())
    if n["content"] == "VALID":
        assert n["artist_text"] and n["recording_text"]


def test_keys_are_never_partial():
    assert T.normalize("Mixed 漢字", "Title")["status_exact"] == "PARTIAL"
    assert T.normalize("!!!", "???")["content"] == "NO_ALPHANUMERIC_CONTENT"
    assert T.normalize(" ", "x")["content"] == "MISSING_ARTIST" and T.normalize("x", None)["content"] == "MISSING_RECORDING"


@pytest.mark.parametrize("raw,want", [("Song (Live at X) [Explicit]", "song"), ("Song feat. Someone", "song"), ("Song - Remastered 2011", "song"), ("Song - 2011 Remaster", "song"), ("Live", "live"), ("(Live)", "(live)"), ("The Song", "song"), ("The", "the"), ("Song - Radio Edit", "song"), ("Defeat", "defeat"), ("1999", "1999"), ("Mix", "mix"),
    ("Song live at venue", "song at venue"), ("Song  2009\tRemaster tail", "song tail"), ("Live 2000", "live 2000"), ("Live at Leeds", "live at leeds"), ("Album Version", "album"), ("Song - Anniversary Edition 2017", "song"), ("Song (feat.X)", "song"), ("Song feat. X live", "song"), ("- The End -", "end"), ("deluxe edition", "deluxe edition")])
def test_aggressive(raw, want):
    assert T.aggressive(raw) == want


@pytest.mark.parametrize("s,want", [("한국", "hanguk"), ("서울", "seoul"), ("뚱", "ttung"), ("값", "gaps"), ("abc", "abc"), ("ㅋㅋ", "kk"), ("ㅠ한", "yuhan")])
def test_hangul(s, want):
    assert hangul(s) == want


@pytest.mark.parametrize("s,want", [("カタカナ", "katakana"), ("ひらがな", "hiragana"), ("きっと", "kitto"), ("コーヒー", "kohi"), ("シャツ", "shatsu"), ("きょう", "kyou"), ("ア・イ", "a i"), ("ファン", "fan"), ("チェョ", "cho"), ("キャァ", "kya"), ("ッャシ", "yasshi"), ("ッ!カ", "!kka"), ("ジャッジ", "jajji"), ("ティー", "ti"), ("ァ", "a"), ("ッ", "")])
def test_kana(s, want):
    assert kana(s) == want


def test_coverage():
    assert transliterate("해 금")[1] and not transliterate("漢字")[1] and transliterate("abc")[1] and not transliterate("Кино")[1]
    assert inventory("aБ해かカ漢1") == {"hangul": 1, "kana": 2, "han": 1, "latin": 1, "other": 1}


def test_native_twins_and_keys(spark):
    df = spark.createDataFrame([("The Band feat. X", "Song (Live)", " AbC\t\n"), (None, None, None), ("", "", "   ")], "a string, r string, k string")
    r = df.select(T.fallback_key(F.col("a")).alias("fa"), T.fallback_key(F.col("r")).alias("fr"), T.ascii_key(F.col("r")).alias("kr"), lower_key("k").alias("lk"), upper_key("k").alias("uk"), T.script_class(F.col("a")).alias("c")).collect()
    assert tuple(r[0]) == ("band", "song", "songlive", "abc", "ABC", "LATIN")
    assert tuple(r[1]) == ("", "", "", None, None, "NONE") and r[2].lk is None
    x = spark.createDataFrame([("a b", "b c"), ("", "a"), ("해금", "해군"), ("\U0001f600a", "\U0001f600b")], "p string, q string").select(T.jaccard(F.col("p"), F.col("q")).alias("j"), T.similarity(F.col("p"), F.col("q")).alias("s")).collect()
    assert x[0].j == pytest.approx(1 / 3) and x[1].j == 0 and x[1].s == 0 and x[2].s == 0.5 and x[3].s == 0.5


def test_run_id():
    assert run_id("m", 1, "a") == run_id("m", 1, "a") != run_id("m", 1, "b")
