"""Text normalisation as JVM-side column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Greek and Cyrillic letters whose glyph is that of a Latin letter.
LOOKALIKE = {
    "а": "a", "е": "e", "і": "i", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W",
    "ο": "o", "ν": "v", "ι": "i", "α": "a", "ρ": "p", "υ": "u", "κ": "k", "τ": "t", "γ": "y", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
}

#: Characters that show nothing: zero-width marks, joiners, soft hyphen, direction marks, variation selectors.
INVISIBLE = "".join(map(chr, [0xAD, 0x34F, 0x61C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0x2066, 0x206A), *range(0xFE00, 0xFE10), 0xFEFF]))
#: Spaces that look like the plain one.
SPACES = "".join(map(chr, [0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]))
#: Combining marks of Spanish.
MARKS = "̧̀́̂̃̈"


def _accents() -> dict[str, str]:
    """Every composed Latin letter that decomposes to an ASCII letter and marks, by rule."""
    out = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))
        if len(base) > 1 and base[0].isascii() and all(unicodedata.combining(x) for x in base[1:]):
            out[chr(code)] = base[0]
    return out


ACCENTS = _accents()
FULLWIDTH = {chr(code): chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F)}


def _translate(c: Column, table: dict[str, str], drop: str = "") -> Column:
    keys = list(table)
    return F.translate(c, "".join(keys) + drop, "".join(table[k] for k in keys))


def unify(c: Column) -> Column:
    """One form for what looks alike: full-width, look-alike letters, spaces, ligatures, invisible marks; accents composed letters are
    kept. null stays null."""
    c = _translate(c, FULLWIDTH | LOOKALIKE | {s: " " for s in SPACES} | {"º": "°"}, INVISIBLE)
    return _spelt(c)


def _spelt(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl")), F.lit("№"), F.lit("N°"))


def fold(c: Column) -> Column:
    """unify, accents dropped (composed or combining), lower case, white space collapsed and trimmed. null stays null. One pass over the
    characters does for both tables."""
    c = _translate(c, ACCENTS | FULLWIDTH | LOOKALIKE | {s: " " for s in SPACES} | {"º": "°"}, INVISIBLE + MARKS)
    return F.trim(F.regexp_replace(F.lower(_spelt(c)), r"\s+", " "))


def normalize_key(c: Column, separator: str = " ") -> Column:
    """Accents dropped, lower case, every run of other characters than letters and digits replaced by the separator, trimmed of it."""
    c = F.regexp_replace(F.lower(_translate(c, ACCENTS | FULLWIDTH, MARKS)), "[^a-z0-9]+", separator)
    return F.regexp_replace(c, f"^{separator}+|{separator}+$", "") if separator else c


def slugify(c: Column, empty: str = "s_n") -> Column:
    """normalize_key by underscore; null and what leaves nothing give `empty`."""
    return F.coalesce(F.nullif(normalize_key(c, "_"), F.lit("")), F.lit(empty))


def collapse(c: Column) -> Column:
    """White space of any kind collapsed to one space, byte-order and zero-width marks dropped, trimmed."""
    return F.trim(F.regexp_replace(F.translate(c, INVISIBLE, ""), r"(?U)\s+", " "))


def _nfkc(c: Column) -> Column:
    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")

    return normal(c)


#: What Python's \s matches: Java's does not have all of it.
WHITE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
#: Characters that NFKC leaves as they are, whatever stands beside them if that is one of them too.
STABLE = r"^[\x{00}-\x{9f}¡-§©«¬\x{ad}®°±¶·»¿-ÿ‐‒–—―‘’‚“”„•€\x{200b}-\x{200f}\x{feff}]*$"


def cleaned(c: Column) -> Column:
    """NFKC, four entities undone, white space of any kind collapsed and trimmed. null stays null. Only texts with other characters than
    the stable ones go through Python."""
    c = F.coalesce(F.when(c.rlike(STABLE), c), _nfkc(F.when(~c.rlike(STABLE), c)))
    for a, b in (("&nbsp;", " "), ("&amp;", "&"), ("&#8211;", "-"), ("&quot;", '"')):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(c, WHITE, " "))


def ascii_folded(c: Column) -> Column:
    """Compatibility-decomposed, what is not ASCII left out, lower case, trimmed; punctuation stays. null stays null. Only texts with
    other characters than the stable ones go through Python."""

    @F.pandas_udf("string")
    def plain(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode(), na_action="ignore")

    quick = F.regexp_replace(_translate(c, ACCENTS, MARKS), r"[^\x{00}-\x{7f}]", "")
    return F.trim(F.lower(F.coalesce(F.when(c.rlike(STABLE), quick), plain(F.when(~c.rlike(STABLE), c)))))


def without_marks(c: Column) -> Column:
    """Lower case without accents, composed or combining; punctuation and other signs stay as they are, white space of any kind trimmed."""
    return F.regexp_replace(F.lower(_translate(c, ACCENTS, MARKS)), f"^{WHITE}|{WHITE}$", "")
