"""Comparable attributes of acts, shared by the operators that match them: number, date, commune and title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicta.functions.text import fold
from edicta.llm.canonical import Names, name_table, not_exact, resolve_column

TYPES = "ordenanza(?: municipal| local)?|decreto(?: alcaldicio| exento)?|reglamento(?: municipal)?|resolucion(?: exenta)?|acuerdo"
def number(c: Column) -> Column:
    """The number in any spelling ('Nº12', '12/2018', '0012', '1.078', 'Ord. 12') as an integer; null for none."""
    return F.try_to_number(F.nullif(F.regexp_replace(F.regexp_extract(c, r"^\D*?(\d{1,3}(?:\.\d{3})+|\d{1,9})", 1), r"\.", ""), F.lit("")), F.lit("999999999")).cast("int")


def title_number(folded: Column) -> Column:
    """The act's own number where its title states it, at the start or in closing brackets."""
    lead = F.regexp_extract(folded, rf"^(?:{TYPES}) n[°o.]? ?(\d{{1,6}})\b", 1)
    tail = F.regexp_extract(folded, rf"\((?:{TYPES}) n[°o.]? ?(\d{{1,6}})\)", 1)
    return F.nullif(F.concat(F.when(lead != "", lead).otherwise(tail)), F.lit("")).try_cast("int")


def date_parts(c: Column) -> Column:
    """struct(day 'yyyy-mm-dd' or null, month 'yyyy-mm' or null, year int or null) of a date of any form and precision."""
    iso, dmy = r"^\s*(\d{4})[-/](\d{1,2})(?:[-/](\d{1,2}))?\s*$", r"^\s*(\d{1,2})[-/](\d{1,2})[-/](\d{4})\s*$"
    y = F.nullif(F.regexp_extract(c, r"((?:19|20)\d{2})", 1), F.lit(""))
    part = lambda p, g: F.lpad(F.nullif(F.regexp_extract(c, p, g), F.lit("")), 2, "0")
    month, day = F.coalesce(part(iso, 2), part(dmy, 2)), F.coalesce(part(iso, 3), part(dmy, 1))
    return F.struct(F.concat_ws("-", y, month, day).alias("text"), F.when(day.isNotNull() & y.isNotNull(), F.concat_ws("-", y, month, day)).alias("day"), F.when(month.isNotNull() & y.isNotNull(), F.concat_ws("-", y, month)).alias("month"), y.try_cast("int").alias("year"))


def title_key(folded: Column) -> Column:
    """Letters and figures of a folded title; the article before a kind of act and 'e incluye' come and go between copies."""
    words = F.regexp_replace(folded, "[^a-z0-9]+", " ")
    return F.trim(F.replace(F.replace(words, F.lit(" e incluye "), F.lit(" y ")), F.lit(" la ordenanza "), F.lit(" ordenanza ")))


VERBS = "aprueba(?: la)? ordenanza sobre|regula materias de|dicta medidas relativas a|fija texto refundido sobre|establece normas sobre|complementa reglamento de|actualiza procedimiento de|modifica(?: la)? ordenanza de|deroga disposiciones sobre|texto de la norma sobre|sobre|de"


def subject(folded: Column) -> Column:
    """A folded title without kind, number and opening verb: what the act is about, and where."""
    c = F.regexp_replace(folded, rf"\s*\((?:{TYPES})[^)]*\)", "")
    c = F.regexp_replace(c, rf"^(?:{TYPES})(?: n[°o.]? ?\d*)?\s*[-:.,]?\s*", "")
    return F.trim(F.regexp_replace(F.regexp_replace(c, rf"^(?:{VERBS})\s+", ""), r"\s*(?:[\[{<][^\]}>]*[\]}>]|#\d+|[-–] error de foliacion.*)\s*\.?$", ""))


def with_commune(df: DataFrame, col: str, names: Names, out: str = "commune") -> DataFrame:
    """df with the reference name of its typed commune; null where it is missing or names none. Exact names skip Python."""
    known = df.join(name_table(df, names), F.col(col) == F.col("_name"), "left_semi").withColumn(out, F.col(col))
    typed = resolve_column(not_exact(df, col, names), col, names, out).withColumn(out, F.nullif(F.col(out), F.lit("")))
    return known.unionByName(typed).unionByName(df.where(F.col(col).isNull()).withColumn(out, F.lit(None).cast("string")))


def block(kind: str, *parts: Column | str) -> Column:
    """Hash of a blocking key; null where a part is missing."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    some = F.lit(True)
    for c in cols:
        some &= c.isNotNull()
    return F.when(some, F.xxhash64(F.lit(kind), *cols))


def one_sided(kind: str, missing: Column, left: bool, *parts: Column | str) -> list[Column]:
    """Two keys by which rows meet only if one of them lacks something: a row that lacks it meets every row of the other side, a row that
    has it those that lack it. Rows that both have it are left to a sharper key, and do not crowd this one."""
    own, other = (f"{kind}0", f"{kind}1") if left else (f"{kind}1", f"{kind}0")
    return [F.when(missing, block(own, *parts)), block(other, *parts)]
