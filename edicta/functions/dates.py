"""Dates and numbers written in many ways, as column expressions. Strings stay strings of the precision they have."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spanish months (fixed values).
MONTHS = {"enero": "01", "febrero": "02", "marzo": "03", "abril": "04", "mayo": "05", "junio": "06", "julio": "07", "agosto": "08", "septiembre": "09", "setiembre": "09", "octubre": "10", "noviembre": "11", "diciembre": "12"}
NO_DATE, NO_NUMBER = "S/F", "S/N"


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def year(c: Column) -> Column:
    """The first year from 1900 to 2099 in a string as an integer; null for none."""
    return _some(F.regexp_extract(c, r"((?:19|20)\d{2})", 1)).cast("int")


def legal_date(c: Column) -> Column:
    """yyyy-mm-dd, yyyy-mm or yyyy, whichever precision is stated in ISO or day-first form; 'S/F' for none or null."""
    iso = F.regexp_extract(c, r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", 0)
    dmy = F.regexp_extract(c, r"(\d{1,2})[-/](\d{1,2})[-/](\d{4})", 0)
    ym = F.regexp_extract(c, r"(\d{4})[-/](0?[1-9]|1[0-2])(?:\D|$)", 0)
    part = lambda x, p, g, n=2: F.lpad(F.regexp_extract(x, p, g), n, "0")
    i, d = r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", r"(\d{1,2})[-/](\d{1,2})[-/](\d{4})"
    return (
        F.when(iso != "", F.concat_ws("-", part(iso, i, 1, 4), part(iso, i, 2), part(iso, i, 3)))
        .when(dmy != "", F.concat_ws("-", part(dmy, d, 3, 4), part(dmy, d, 2), part(dmy, d, 1)))
        .when(ym != "", F.concat_ws("-", part(ym, r"(\d{4})[-/](\d{1,2})", 1, 4), part(ym, r"(\d{4})[-/](\d{1,2})", 2)))
        .otherwise(F.coalesce(F.when(year(c).between(1980, 2026), year(c).cast("string")), F.lit(NO_DATE)))
    )


def precision(c: Column) -> Column:
    """day, month, year or none, of a legal date."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), "day").when(c.rlike(r"^\d{4}-\d{2}$"), "month").when(c.rlike(r"^\d{4}$"), "year").otherwise("none")


def long_date(text: Column) -> Column:
    """The first date spelt out in Spanish in a text ('8 de marzo de 2020') as yyyy-mm-dd; null for none."""
    p = r"(?i)(\d{1,2}) de (" + "|".join(MONTHS) + r") de[l]? ((?:19|20)\d{2})"
    month = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])[F.lower(F.regexp_extract(text, p, 2))]
    return F.when(text.rlike(p), F.concat_ws("-", F.regexp_extract(text, p, 3), month, F.lpad(F.regexp_extract(text, p, 1), 2, "0")))


def recovered_date(c: Column, address: Column) -> Column:
    """For dates that stand for a year only: year and month of the address's path, its year, else the date as it is."""
    ym = F.regexp_extract(address, r"/((?:19|20)\d{2})/(0[1-9]|1[0-2])/", 0)
    return F.when(synthetic(c) & (ym != ""), F.concat_ws("-", F.substring(ym, 2, 4), F.substring(ym, 7, 2))).otherwise(c)


def synthetic(c: Column) -> Column:
    """Dates made up from less: the first of January, or a year yet to come."""
    return F.endswith(c, F.lit("-01-01")) | (year(c) > 2029)


def recent(c: Column, first: int = 2021, last: int = 2026) -> Column:
    """The one predicate for recency: the stated year is in the range. null and no date are not recent."""
    return F.coalesce(year(c).between(first, last), F.lit(False))


def act_number(c: Column) -> Column:
    """The number of an act in plain figures, whatever its spelling; 'S/N' for none or null."""
    digits = F.regexp_replace(F.regexp_extract(c, r"(\d{1,3}(?:\.\d{3})+|\d+)", 1), r"\.", "")
    return F.coalesce(_some(F.regexp_replace(digits, "^0+(?=.)", "")), F.lit(NO_NUMBER))
