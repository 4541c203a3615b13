"""Text functions as columns. Python is used only where Spark has no like: Unicode normal forms, balanced brackets, sequence matching."""

from __future__ import annotations

import difflib
import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Arabic letters that are folded, each to the one below it, and marks that are removed.
ARABIC_FROM = "أإآٱىةؤئ"
ARABIC_TO = "اااايهوي"
ARABIC_MARKS = r"[\x{0610}-\x{061A}\x{064B}-\x{065F}\x{0670}\x{06D6}-\x{06ED}\x{0640}]"
NOT_ARABIC = r"[^\x{0600}-\x{06FF} ]"
#: Prefixes of family names that sources attach or leave out, and those that bind to the last word of a name.
ARABIC_PARTICLES = ("بن", "بو", "ابن", "اولاد", "ولد", "عبد")
SURNAME_PARTICLES = (*ARABIC_PARTICLES, "ابو", "أبو")
#: Apostrophes that are removed, dashes that part words, and Latin spellings of one sound.
APOSTROPHES, DASHES = "['’`]", "-_."
LATIN_SPELLINGS = (("ou", "u"), ("kh", "k"), ("ch", "sh"))
#: Arabic letters and their Latin spelling.
ROMAN = {
    "ا": "a", "ب": "b", "ت": "t", "ث": "th", "ج": "j", "ح": "h", "خ": "kh", "د": "d", "ذ": "dh", "ر": "r", "ز": "z", "س": "s", "ش": "sh", "ص": "s",
    "ض": "d", "ط": "t", "ظ": "z", "ع": "a", "غ": "gh", "ف": "f", "ق": "q", "ك": "k", "ل": "l", "م": "m", "ن": "n", "ه": "h", "و": "w", "ي": "y",
    "ء": "", "ة": "a", "ى": "a", "ـ": "",
}


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normal_form(c: Column, form: str) -> Column:
    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    return normal(c)


def unescape(c: Column) -> Column:
    @F.pandas_udf("string")
    def plain(s: pd.Series) -> pd.Series:
        return s.map(html.unescape, na_action="ignore")

    return plain(c)


def common_letters(a: str, b: str) -> int:
    """The length of the longest common subsequence, by one bit for each letter of a."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = left = (1 << len(a)) - 1
    for c in b:
        hit = left & at.get(c, 0)
        left = ((left + hit) | (left - hit)) & full
    return len(a) - left.bit_count()


def similarity(a: Column, b: Column, least: float = 0.0) -> Column:
    """difflib's matching ratio of two texts; null where their longest common subsequence, which bounds it, shows that it lies below `least`."""

    def of(p: str | None, q: str | None) -> float | None:
        if p is None or q is None or least and 2 * common_letters(p, q) < least * (len(p) + len(q)) - 1e-9:
            return None
        return difflib.SequenceMatcher(None, p, q).ratio()

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([of(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return ratio(a, b)


def balanced_json(c: Column, marker: str = "") -> Column:
    """The first balanced {...} after a marker, brackets inside strings not counted; null without one."""

    def first(text: str) -> str | None:
        begin = text.find(marker)
        at = text.find("{", begin) if begin >= 0 else -1
        depth, quoted, escaped = 0, False, False
        for i in range(at, len(text)) if at >= 0 else ():
            ch = text[i]
            if quoted:
                escaped, quoted = (not escaped and ch == "\\"), escaped or ch != '"'
            elif ch == '"':
                quoted = True
            elif ch in "{}":
                depth += 1 if ch == "{" else -1
                if not depth:
                    return text[at : i + 1]
        return None

    @F.pandas_udf("string")
    def cut(s: pd.Series) -> pd.Series:
        return s.map(first, na_action="ignore")

    return cut(c)


def normalize_arabic(c: Column) -> Column:
    """NFKC, without marks, letters folded, a leading article dropped from each word, everything else a space."""
    folded = F.translate(F.regexp_replace(normal_form(c, "NFKC"), ARABIC_MARKS, ""), ARABIC_FROM, ARABIC_TO)
    # The article goes while what stands before it can still be seen.
    bare = F.regexp_replace(folded, r"(?U)(?<!\w)ال(?=[\x{0600}-\x{06FF}])", "")
    return squeeze(F.regexp_replace(bare, NOT_ARABIC, " "))


def normalize_latin(c: Column) -> Column:
    """NFKD without combining marks, lower case, ou kh ch as u k sh, doubled letters once, letters and single spaces only."""
    bare = F.regexp_replace(normal_form(c, "NFKD"), r"\p{M}+", "")
    return latin_rules(bare)


def latin_rules(c: Column) -> Column:
    plain = F.lower(F.translate(F.regexp_replace(c, APOSTROPHES, ""), DASHES, "   "))
    letters = F.regexp_replace(plain, "[^a-z ]", " ")
    for a, b in LATIN_SPELLINGS:
        letters = F.replace(letters, F.lit(a), F.lit(b))
    return squeeze(F.regexp_replace(letters, r"([a-z])\1+", "$1"))


def match_key(normal: Column, drop: tuple[str, ...] = ()) -> Column:
    """Words of more than one letter, without particles, in order of the alphabet."""
    words = F.filter(F.split(normal, " "), lambda w: (F.length(w) > 1) & ~w.isin(*drop) if drop else F.length(w) > 1)
    return F.array_join(F.array_sort(words), " ")


def romanize(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in ROMAN.items() for x in pair])
    bare = F.regexp_replace(normal_form(c, "NFKC"), ARABIC_MARKS, "")
    letters = F.transform(F.split(bare, ""), lambda x: F.coalesce(F.element_at(table, x), F.when(x.rlike(r"[\s\p{L}\p{N}]"), x).otherwise("")))
    return F.initcap(squeeze(F.regexp_replace(F.array_join(letters, ""), r"(\S)\1+", "$1")))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def classify_longest(c: Column, names: dict[str, str], otherwise: str | None = None) -> Column:
    """The name of the longest key that the text contains; among equals the first."""
    out = F.lit(otherwise)
    for key, name in sorted(names.items(), key=lambda kv: len(kv[0])):
        out = F.when(F.contains(c, F.lit(key)), F.lit(name)).otherwise(out)
    return out


def percent(c: Column) -> Column:
    """'12,5 %' as 0.125, four digits."""
    return F.round(F.replace(F.regexp_extract(c, r"(\d+(?:[.,]\d+)?)\s*%", 1), F.lit(","), F.lit(".")).try_cast("double") / 100, 4)


#: Names of months, French in full and shortened, Arabic in the western and the eastern way.
MONTHS = {
    "janvier": 1, "février": 2, "fevrier": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6, "juillet": 7, "août": 8, "aout": 8, "septembre": 9,
    "octobre": 10, "novembre": 11, "décembre": 12, "decembre": 12,
    "janv": 1, "févr": 2, "fevr": 2, "avr": 4, "juil": 7, "sept": 9, "oct": 10, "nov": 11, "déc": 12, "dec": 12,
    "جانفي": 1, "فيفري": 2, "مارس": 3, "أفريل": 4, "ماي": 5, "جوان": 6, "جويلية": 7, "أوت": 8, "سبتمبر": 9, "أكتوبر": 10, "نوفمبر": 11, "ديسمبر": 12,
    "يناير": 1, "فبراير": 2, "إبريل": 4, "أبريل": 4, "مايو": 5, "يونيو": 6, "يوليو": 7, "أغسطس": 8,
}


def parse_date(c: Column) -> Column:
    """A day, a month's name and a year as YYYY-MM-DD; empty if there is none."""
    table = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    pattern = r"(?U)(\d{1,2})(?:er)?\s+(\p{L}+)\.?\s+(\d{4})"
    month = F.element_at(table, F.lower(F.regexp_extract(c, pattern, 2)))
    day, year = F.regexp_extract(c, pattern, 1).try_cast("int"), F.regexp_extract(c, pattern, 3).try_cast("int")
    return F.when(month.isNotNull(), F.format_string("%04d-%02d-%02d", year, month, day)).otherwise("")


def strip_tags(c: Column) -> Column:
    """Text of a page: scripts, styles and tags are gone; entities stand as they were."""
    body = F.regexp_replace(c, r"(?is)<(script|style|head)\b.*?</\1\s*>", " ")
    return squeeze(F.regexp_replace(body, r"(?s)<[^>]*>", " "))


def text_nodes(c: Column) -> Column:
    """The texts between tags, in order, blank ones left out."""
    body = F.regexp_replace(c, r"(?is)<(script|style|head)\b.*?</\1\s*>", "<p>")
    return F.filter(F.transform(F.split(F.regexp_replace(body, r"(?s)<[^>]*>", "\u0001"), "\u0001"), squeeze), lambda x: x != "")


def reference_id(c: Column) -> Column:
    """The id of a reference that stands as JSON [id, name], or false where there is none: then empty text."""
    return F.coalesce(F.get_json_object(c, "$[0]"), F.lit(""))


def reference_name(c: Column) -> Column:
    """The trimmed name of such a reference; empty text where there is none."""
    name = F.get_json_object(c, "$[1]")
    return F.coalesce(F.when(name != "false", F.trim(name)), F.lit(""))


def clean_value(c: Column) -> Column:
    """Trimmed text of a JSON scalar whose emptiness is written false or null."""
    return F.coalesce(F.when(c.isin("false", "null"), "").otherwise(F.trim(F.regexp_replace(c, '^"|"$', ""))), F.lit(""))
