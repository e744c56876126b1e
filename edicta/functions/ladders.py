"""Ladders: values read from several sources by patterns in order, as data compiled to one expression.

A step is (source, pattern, form): the first step whose pattern the source matches gives its value, `form` filled with the groups; the
last is what comes out where none matches. Patterns are fixed values, written so that Java and RE2 read them alike.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = tuple[str, str, str]

#: Dates of portals. `{n}` is a group, `{n:2}` a group filled up to two figures.
DATES: dict[str, tuple[list[Step], str]] = {
    "folder": ([("date", r"(\d{1,2})[-/](\d{1,2})[-/](\d{4})", "{3:4}-{2:2}-{1:2}"), ("date", r"\b(20\d{2})\b", "{1}-01-01")], ""),
    "post": ([("text", r"(\d{1,2})\s+de\s+([a-zA-Z]+)\s+de\s+(\d{4})", "{3}-{2:m}-{1:2}"), ("text", r"/uploads/(\d{4})/(\d{2})/", "{1}-{2}-01"), ("url", r"\b(20[0-2][0-9])\b", "{1}")], "S/F"),
    "either": ([("text", r"(\d{2})[/.-](\d{2})[/.-](\d{4})", "{3}-{2}-{1}"), ("text", r"(\d{4})[/.-](\d{2})[/.-](\d{2})", "{1}-{2}-{3}"), ("text", r"\b(20[0-2][0-9])\b", "{1}")], "S/F"),
    "iso": ([("text", r"(\d{4})[/.-](\d{2})[/.-](\d{2})", "{1}-{2}-{3}"), ("text", r"(\d{4})[/.-](\d{2})", "{1}-{2}-01"), ("text", r"\b(20[0-2][0-9])\b", "{1}")], "S/F"),
}
#: Numbers of acts, by the word before them, by the file's name, by the title.
NUMBERS: dict[str, tuple[list[Step], str]] = {
    "labelled": ([("both", r"(?i)(?:ordenanza|decreto|n[°º.]?)\s*[:#\-_]?\s*(\d{1,5})", "{1}"), ("file", r"\b(\d{1,5})\b", "{1}")], "S/N"),
    "listed": ([("both", r"(?i)(?:ordenanza|ord)[^0-9]{0,12}(?:n(?:ro|°|º|o)?\.?\s*)?([0-9]{1,6}(?:\s*[-/]\s*[0-9]{2,4})?)", "{1:s}"), ("both", r"(?i)(?:n(?:ro|°|º|o)?\.?\s*)([0-9]{1,6}(?:\s*[-/]\s*[0-9]{2,4})?)", "{1:s}")], ""),
    "ordinance": ([("title", r"(?i)ordenanza\s+(?:local\s+)?(?:n(?:[°ºo.]|ro\.?|umero)?\s*)?([0-9]+(?:\s*[/.-]\s*[0-9]+)?)", "{1:s}")], ""),
    "titled": ([("title", r"[Nn][°ºo.\s-]*([0-9]+)", "{1}"), ("url", r"-n([0-9]+)-", "{1}")], "S/N"),
    "plain": ([("title", r"[Nn][°ºo.\s-]*([0-9]+)", "{1}")], "S/N"),
    "decree": ([("title", r"(?i)(?:decreto\s+alcaldicio|decreto\s+exento|decreto)\s*(?:n[°º.]?|nro\.?|número)?\s*([0-9]{1,5})", "{1}")], ""),
}
#: Dates in the names of files, from day to year.
FILE_DATES: list[Step] = [
    ("file", r"\b([0-3]\d)([01]\d)(19\d{2}|20[0-2]\d)\b", "{3}-{2}-{1}"),
    ("file", r"\b(19\d{2}|20[0-2]\d)[-_]([01]\d)[-_]([0-3]\d)\b", "{1}-{2}-{3}"),
    ("file", r"\b([0-3]\d)[-_]([01]\d)[-_](19\d{2}|20[0-2]\d)\b", "{3}-{2}-{1}"),
    ("url", r"/(19\d{2}|20[0-2]\d)/([01]\d)/", "{1}-{2}"),
    ("file", r"\b(19\d{2}|20[0-2]\d)\b", "{1}"),
]
LAST_YEAR = 2026
_PART = re.compile(r"\{(\d)(?::(\w))?\}")


def _months() -> dict[str, str]:
    from edicta.functions.dates import MONTHS

    return MONTHS


def _filled(source: Column, pattern: str, form: str) -> Column:
    parts, at = [], 0
    for m in _PART.finditer(form):
        got = F.regexp_extract(source, pattern, int(m[1]))
        if m[2] == "s":
            got = F.regexp_replace(got, r"\s+", "")
        elif m[2] == "m":
            got = F.element_at(F.create_map(*(F.lit(x) for kv in _months().items() for x in kv)), F.lower(got))
        elif m[2]:
            got = F.lpad(got, int(m[2]), "0")
        parts += [F.lit(form[at : m.start()]), got]
        at = m.end()
    return F.concat(*parts, F.lit(form[at:]))


def _java(pattern: str) -> str:
    return pattern.replace("(?i)", "(?iu)")


def climbed(steps: list[Step], default: Column | str, sources: dict[str, Column]) -> Column:
    """The value of the first step that matches; a month that is none makes its step miss. null sources match nothing."""
    out = default if isinstance(default, Column) else F.lit(default)
    for source, pattern, form in reversed(steps):
        c = sources[source]
        got = _filled(c, _java(pattern), form)
        out = F.when(F.coalesce(c.rlike(_java(pattern)) & got.isNotNull(), F.lit(False)), got).otherwise(out)
    return out


def climbed_sql(steps: list[Step], default: str, sources: dict[str, str]) -> str:
    """The same in SQL."""

    def filled(source: str, pattern: str, form: str) -> str:
        parts, at = [], 0
        for m in _PART.finditer(form):
            got = f"regexp_extract({source}, '{pattern}', {m[1]})"
            if m[2] == "s":
                got = f"regexp_replace({got}, '\\s+', '', 'g')"
            elif m[2] == "m":
                got = f"(case lower({got}) " + " ".join(f"when '{k}' then '{v}'" for k, v in _months().items()) + " end)"
            elif m[2]:
                got = f"lpad({got}, {m[2]}, '0')"
            parts += [f"'{form[at : m.start()]}'", got]
            at = m.end()
        return " || ".join([*parts, f"'{form[at:]}'"])

    cases = [(f"coalesce(regexp_matches({sources[s]}, '{p}') and ({filled(sources[s], p, f)}) is not null, false)", filled(sources[s], p, f)) for s, p, f in steps]
    return "case " + " ".join(f"when {c} then {v}" for c, v in cases) + f" else {default} end"


def _valid(date: Column) -> Column:
    """Whether a date has a day, a month and a year that can be."""
    month, day = F.substring(date, 6, 2), F.substring(date, 9, 2)
    return (F.substring(date, 1, 4) <= str(LAST_YEAR)) & ((month == "") | month.between("01", "12") | (F.length(date) == 7)) & ((day == "") | day.between("01", "31"))


def synthetic(date: Column) -> Column:
    """Dates that stand for less: a first of January, or a year from 2030 on."""
    return F.coalesce(date.endswith("-01-01") | date.rlike(r"^(?:20[3-9]\d|2[1-9]\d{2})"), F.lit(False))


def recovered_date(date: Column, url: Column, file: Column) -> Column:
    """A date that stands for less, recovered from the file's name, else the address's path, else a year in the name; empty where what
    was found cannot be a date or nothing was. Other dates stay."""
    found = climbed(FILE_DATES, "", {"file": file, "url": url})
    return F.when(synthetic(date), F.when(_valid(found), found).otherwise("")).otherwise(date)


#: What stands in a file's name or a title before a number, and a year that was taken for one.
YEAR_AND_NUMBER = r"(?i)^(19\d{2}|20[0-2]\d)[-_](\d{1,5})\.pdf$"
YEARS = [str(y) for y in range(2020, 2027)]
IN_FILE = r"(?i)(?:da|decreto|ord|n)[-_]?(\d{1,5})"
IN_TITLE = r"(?i)(?:decreto|ordenanza)\s*(?:exento\s*)?(?:n[°º.]?|nro\.?|número)?\s*(\d{1,5})"


def compiled(title: Column, url: Column) -> Column:
    """Whether a file is a compilation of many acts."""
    return F.coalesce(F.contains(F.lower(url), F.lit("compilado")), F.lit(False)) | F.coalesce(F.contains(F.lower(title), F.lit("compilado")), F.lit(False))


def repaired_number(number: Column, title: Column, url: Column, file: Column) -> Column:
    """The number of an act without the marks of its processing: suffixes of four hexadecimal figures, made-up document names, a year
    taken for the number. 'Compilado' for compilations, 'S/N' for none."""
    num = F.regexp_replace(F.trim(F.coalesce(number, F.lit(""))), r"(?i)^(.*?)-[0-9a-f]{4}$", "$1")
    num = F.when(num.startswith("DOC-"), "S/N").otherwise(num)
    dated, in_file, in_title = (F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), _java(p), g), F.lit("")) for c, p, g in ((file, YEAR_AND_NUMBER, 2), (file, IN_FILE, 1), (title, IN_TITLE, 1)))
    of_year = F.when(in_file != num, in_file).otherwise(F.coalesce(in_title, F.lit("S/N")))
    return F.when(compiled(title, url), "Compilado").when(dated.isNotNull(), dated).when(num.isin(YEARS), of_year).when(num.isin("", "None"), "S/N").otherwise(num)


#: Titles that name no act, and titles of two words that do not either.
LINK_LABELS, BARE_TITLES = ["descargar documento", "descargar", "ver documento", "enlace"], ["ordenanzas municipales", "ordenanza municipal", "documento"]
NUMBERED_FILE = r"(?i)DA\+?(\d{1,5})\.(\d{4})\+?(?:Aprueba\+?)?(?:Ordenanza\+?)?(.*?)\.pdf"
BETWEEN_LINKS = r"(?i)decreto exento\s+(ordenanza.*?)(?:\s+\d{3,5}\s+\d{2}-\d{2}-\d{4}|\s+enlace|$)"


def said_once(title: Column) -> Column:
    """A title that says everything twice, once."""
    return F.regexp_replace(title, r"(?iu)^(.+?)\s+\1$", "$1")


def repaired_title(title: Column, comuna: Column, url: Column, file: Column) -> Column:
    """A title, said once; for compilations and labels of links the name of the file instead; what stands between labels of links."""
    place = F.coalesce(comuna, F.lit(""))
    stem = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(file, F.lit("")), r"\.[^.]*$", ""), "[-_+]+", " "))
    by_name = F.concat(F.lit("Ordenanza Municipal de "), place, F.lit(" — "), stem)
    once, low_file = said_once(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(file, F.lit("")))
    low = F.lower(once)
    about = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract(F.coalesce(file, F.lit("")), NUMBERED_FILE, 3), r"\+", " "), r"\s+", " "))
    label = (
        F.when(F.coalesce(file, F.lit("")).rlike(NUMBERED_FILE), F.concat(F.lit("Ordenanza "), about))
        .when(F.contains(low_file, F.lit("medio-ambiente")), F.concat(F.lit("Ordenanza Municipal de Medio Ambiente — "), place))
        .when(F.contains(low_file, F.lit("mascarilla")), F.concat(F.lit("Ordenanza Municipal sobre Uso de Mascarillas — "), place))
        .otherwise(by_name)
    )
    inner = F.trim(F.regexp_extract(once, BETWEEN_LINKS, 1))
    return (
        F.when(compiled(title, url), F.concat(F.lit("Compilado de Ordenanzas Municipales — "), place))
        .when(low.isin(LINK_LABELS) | F.contains(low, F.lit("untitled")), label)
        .when(low.startswith("enlace ") & (inner != ""), F.concat(F.upper(F.substring(inner, 1, 1)), F.substring(inner, F.lit(2), F.length(inner))))
        .when(low.isin(BARE_TITLES), by_name)
        .otherwise(once)
    )
