"""Reading dirty artist and title texts: folding, romanising, and telling names from edition, guest and version marks."""

from __future__ import annotations

import html
import re
import unicodedata

from rillmark.functions.translit import hangul, kana

CYRILLIC = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "a b v g d e e zh z i y k l m n o p r s t u f kh ts ch sh shch  y  e yu ya".split(" ")))
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a v g d e z i th i k l m n x o p r s s t u f ch ps o".split()))
LETTERS = {"ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "æ": "ae", "œ": "oe", "ı": "i", "ß": "ss"}
SINGLE = CYRILLIC | GREEK | LETTERS

PLACEHOLDERS = {"", "va", "various", "various artists", "unknown", "unknown artist", "n a", "na", "none", "null", "untitled"}
STOP = {"the", "of", "and", "no", "for", "a", "an", "in", "to", "s"}
EDITION = ("remaster", "remastered", "explicit", "clean", "deluxe", "edition", "album", "version", "official", "audio", "video", "lyric", "lyrics", "single", "mono", "stereo", "bonus", "track", "anniversary", "expanded", "reissue", "radio", "edit", "hd", "hq", "original")
GUEST = re.compile(r"\b(?:feat|ft|featuring|with)\b\.?\s")
CUT_GUEST = re.compile(r"[\s(\[](?:feat\.?|ft\.?|featuring)\s.*$")
CUT_COMPANY = re.compile(r"[\s(\[](?:feat\.?|ft\.?|featuring|with)\s.*$")
BRACKET = re.compile(r"[(\[{]([^)\]}]*)(?:[)\]}]|$)")
TRACK = re.compile(r"^\s*\d{1,3}\s*(?:[.\-)]\s*|\s+)(?=\S)")
PART = re.compile(r"^\W*(?:part|pt)\b\.?\s*(\d+|[ivx]+)\W*$")
PART_TAIL = re.compile(r"[\s,(]+(?:part|pt)\b\.?\s*(\d+|[ivx]+)\W*$")
ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}
BROKEN = re.compile("[Â-ô][\u0080-¿ŒœŠšŸŽžƒˆ˜–-›€™]")


def near(word: str, target: str) -> bool:
    """Equal up to one edit or one swap of neighbours (words of four letters or more)."""
    if word == target:
        return True
    a, b = len(word), len(target)
    if a < 3 or b < 4 or abs(a - b) > 1 or (word[0] != target[0] and word[-1] != target[-1]):
        return False
    i = 0
    while i < min(a, b) and word[i] == target[i]:
        i += 1
    if a == b:
        return word[i + 1 :] == target[i + 1 :] or (word[i : i + 2] == target[i : i + 2][::-1] and word[i + 2 :] == target[i + 2 :])
    return word[i + 1 :] == target[i:] if a > b else word[i:] == target[i + 1 :]


def unbroken(s: str) -> str:
    """UTF-8 read as a one-byte code page, undone where the bytes allow it."""
    if not BROKEN.search(s):
        return s
    for code in ("cp1252", "latin-1"):
        try:
            return s.encode(code).decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            pass
    # mixed texts: pair by pair

    def fix(m: re.Match) -> str:
        for code in ("cp1252", "latin-1"):
            try:
                return m[0].encode(code).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                pass
        return m[0]

    return BROKEN.sub(fix, s)


def folded(s: str | None) -> str:
    """Lower case, Latin letters without marks, one blank between words; punctuation is kept for the parser."""
    if not s:
        return ""
    if "&" in s:
        s = html.unescape(s)
    if not s.isascii():
        s = unicodedata.normalize("NFC", unbroken(s)).replace("­", "")
        s = kana(hangul(s))
        s = "".join(ch for ch in unicodedata.normalize("NFKD", s) if not unicodedata.combining(ch))
        s = s.casefold().replace("ου", "u").replace("...", "…")
        s = "".join(SINGLE.get(ch, ch) for ch in s)
        s = s.translate(QUOTES)
    else:
        s = s.lower().replace("...", "…")
    return " ".join(s.split())


QUOTES = str.maketrans({"“": '"', "”": '"', "„": '"', "«": '"', "»": '"', "’": "'", "‘": "'", "–": "-", "—": "-"})


def words(s: str) -> list[str]:
    return re.findall(r"[^\W_]+", s.replace("'", ""))


def _number(s: str) -> int:
    return int(s) if s.isdigit() else ROMAN.get(s, 0)


def _mark(inner: str) -> tuple[str, str] | None:
    """(kind, value) of a bracket's or suffix's text: edition, guest, live, remix, part; None when it is title text."""
    inner = inner.strip()
    if GUEST.match(inner + " "):
        return "guest", ""
    if m := PART.match(inner):
        return "part", str(_number(m[1]))
    open_end = inner.endswith("…")
    w = words(inner)
    if not w:
        return "edition", ""
    if any(near(x, "remix") or near(x, "rework") for x in w):
        return "remix", "".join(x for x in w if not near(x, "remix"))
    if any(near(x, "live") and len(x) >= 3 for x in w):
        return "live", ""
    if any(near(x, "acoustic") or near(x, "demo") or near(x, "instrumental") or near(x, "karaoke") for x in w):
        return "other", "".join(w)
    rest = [x for x in w if not x.isdigit() and not any(near(x, e) for e in EDITION)]
    if not rest or (open_end and len(rest) == 1 and any(e.startswith(rest[0]) for e in (*EDITION, "live", "featuring", "with"))):
        return "edition", ""
    return None


def read_title(s: str) -> tuple[list[str], str, str, bool]:
    """(words of the name, kinds of version marks such as 'live|part1', remixer, cut short) of a folded title."""
    for _ in range(2):
        s = TRACK.sub("", s, count=1)
    s = s.strip(" \"'")
    marks: list[tuple[str, str]] = []

    def take(m: re.Match) -> str:
        k = _mark(m[1])
        if k is None:
            return " " + m[1] + " "
        marks.append(k)
        return " "

    s = BRACKET.sub(take, s)
    while " - " in s:
        head, tail = s.rsplit(" - ", 1)
        if (k := _mark(tail)) is None:
            break
        marks.append(k)
        s = head
    s = CUT_GUEST.sub("", s)
    cut = s.rstrip(" \"'.!").endswith("…")
    if m := PART_TAIL.search(s):
        marks.append(("part", str(_number(m[1]))))
        s = s[: m.start()]
    s = s.replace("o/t", "of the").replace("&", " and ").replace("+", " and ")
    kinds = sorted({k if k != "part" else "part" + v for k, v in marks if k in ("live", "remix", "part", "other")})
    remixer = "".join(v for k, v in marks if k in ("remix", "other"))
    return words(s), "|".join(kinds), remixer, cut


def read_artist(s: str) -> tuple[list[str], bool]:
    """(words of an artist's name, cut short): without guests and the article before or after; 'last, first' put in order."""
    s = CUT_COMPANY.sub("", s.strip(" \"'"))
    cut = s.endswith("…")
    s = BRACKET.sub(lambda m: " " if _mark(m[1]) else " " + m[1] + " ", s)
    # 'last, first'; swapped twice it is 'first, last,'
    if len(bits := [x for x in s.split(",") if x.strip()]) == 2:
        s = f"{bits[1]} {bits[0]}" if s.count(",") % 2 else f"{bits[0]} {bits[1]}"
    w = words(s.replace("&", " and ").replace("+", " and "))
    return (w[1:] if len(w) > 1 and w[0] == "the" else w), cut


def placeholder(s: str) -> bool:
    w = words(CUT_COMPANY.sub("", s))
    if len(w) == 2 and near(w[0], "various") and near(w[1], "artists"):
        return True
    return " ".join(w) in PLACEHOLDERS or (len(w) > 1 and near(w[-1], "uploads"))


def readings(artist: str | None, title: str | None) -> list[tuple[list[str], list[str], str, str, bool, bool]]:
    """The ways to read a pair of texts: as typed, fields swapped, and 'artist - title' in one field when the other names nobody.

    Each is (artist words, title words, version kinds, remixer, title cut short, artist cut short). A blank field and no dash gives none.
    """
    a, t = folded(artist), folded(title)
    pairs = []
    no_a, no_t = placeholder(a), placeholder(t)
    if not no_a and not no_t:
        pairs = [(a, t), (TRACK.sub("", TRACK.sub("", t)), a)]
    for field, other in ((t, no_a), (a, no_t)):
        if other and " - " in field:
            for _ in range(2):
                field = TRACK.sub("", field, count=1)
            bits = field.split(" - ")
            for i in range(1, len(bits)):
                x, y = " - ".join(bits[:i]), " - ".join(bits[i:])
                pairs += [(x, y), (y, x)]
    out = []
    for x, y in dict.fromkeys(pairs):
        aw, acut = read_artist(x)
        tw, kinds, remixer, cut = read_title(y)
        if aw and tw:
            out.append((aw, tw, kinds, remixer, cut, acut))
    return out
