"""Mapping free-entered values to a canonical list (problem 7).

A symmetric-delete dictionary over the reference's keys is broadcast where a count proves the reference small (MAX_REFERENCE names); a
larger one is met by an equality join on the same deletes, with the same result: `reference_counts` decides, and the other functions
take what it gives. A value's key is looked up within a bounded edit distance, candidates are ranked by weighted Damerau-Levenshtein
distance, then by how often the reference name itself occurs. Keys longer than any of the reference by more than the bound are not
looked up: they can be near none. Values that name nothing are reported with the empty string.

Defined cases: null values give null and no report; empty or blank values and values that only hold signs name nothing; ties of
distance and frequency go to the first name in order; an empty reference maps every value to the empty string.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicta.functions.text import INVISIBLE, LOOKALIKE
from edicta.session import cut

MAX_REFERENCE = 50_000  # names; above, the dictionary would not be small, and names are joined
MAX_EDITS = 2
#: Misread signs and the letters they stand for (fixed values); such a change costs CHEAP instead of 1.
MISREAD = {"0": "o", "1": "li", "3": "e", "4": "a", "5": "s", "6": "g", "8": "b", "@": "a", "€": "c", "$": "s"}
CHEAP = 0.4
#: Short forms of the words that begin or join names (fixed values).
SHORT = {"sn": "san", "s": "san", "sta": "santa", "sto": "santo", "pto": "puerto", "pta": "punta", "alt": "alto", "al": "alto", "vla": "villa", "va": "villa", "v": "villa", "d": "del", "ls": "los"}
LEAD = re.compile(r"^(?:(?:i(?:lustre)?\s+)?(?:m|mun|muni|municip|municipalidad|municipio)|comuna|ciudad)\s+(?:(?:de|del)\s+(?=\S))?")
_INVISIBLE = dict.fromkeys(map(ord, INVISIBLE))
_LOOK = str.maketrans(LOOKALIKE)


def _mended(text: str) -> str:
    """UTF-8 that was read as Latin-1, put right."""
    if "Ã" in text or "Â" in text:
        for page in ("latin-1", "cp1252"):
            try:
                return text.encode(page).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
    return text


def words(value: str) -> list[str]:
    """The words of a typed name: one spelling, without what surrounds the name."""
    text = unicodedata.normalize("NFKC", _mended(value).translate(_LOOK).translate(_INVISIBLE)).lower()
    text = "".join(x for x in unicodedata.normalize("NFD", text) if unicodedata.category(x) != "Mn").strip()
    text = re.sub(r"\bd/\s*(?=[a-z])", "de ", text)
    text = re.split(r"\s*[,/(;|]\s*|\s+[-–—]\s+", text.lstrip(",/(;|-– «\"'"), maxsplit=1)[0]
    text = " ".join(re.split(r"[^a-z0-9@€$]+", text)).strip()
    return LEAD.sub("", text + " ").split()


def key(value: str) -> str:
    found = words(value)
    return "".join(SHORT.get(w, w) if i < len(found) - 1 else w for i, w in enumerate(found))


def deletes(text: str, most: int = MAX_EDITS) -> set[str]:
    """text with up to `most` characters left out."""
    return {"".join(x for i, x in enumerate(text) if i not in out) for n in range(min(most, len(text)) + 1) for out in combinations(range(len(text)), n)}


def weighted_distance(a: str, b: str, most: float) -> float:
    """Damerau-Levenshtein, also across letters put between two swapped ones; misread signs cost CHEAP. Above `most`, most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = float(len(a) + len(b))
    d = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    seen: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        last = 0
        for j, y in enumerate(b, 1):
            i0, j0 = seen.get(y, 0), last
            same = 0.0 if x == y else CHEAP if y in MISREAD.get(x, "") or x in MISREAD.get(y, "") else 1.0
            if x == y:
                last = j
            swap = d[i0][j0] + (i - i0 - 1) + 1 + (j - j0 - 1)
            d[i + 1][j + 1] = min(d[i][j] + same, d[i + 1][j] + 1, d[i][j + 1] + 1, swap)
        seen[x] = i
    return d[-1][-1] if d[-1][-1] <= most else most + 1


class Resolver:
    """The dictionary of one reference list: name -> how often it occurs."""

    def __init__(self, names: dict[str, int], most: int = MAX_EDITS):
        self.most, self.names = most, names
        self.by_key: dict[str, list[str]] = {}
        for name in sorted(names):
            self.by_key.setdefault(key(name), []).append(name)
        self.by_delete: dict[str, list[str]] = {}
        for k in self.by_key:
            for d in deletes(k, most):
                self.by_delete.setdefault(d, []).append(k)
        self.longest = max(map(len, self.by_key), default=0)
        self.resolve = lru_cache(maxsize=100_000)(self._resolve)

    def _first(self, keys: list[tuple[float, str]]) -> str:
        return min(((d, -self.names[n], n) for d, k in keys for n in self.by_key[k]), default=(0, 0, ""))[2]

    def _resolve(self, value: str) -> str:
        """The name a value stands for, or the empty string."""
        if value in self.names:
            return value
        k = key(value)
        if not k:
            return ""
        if k in self.by_key:
            return self._first([(0, k)])
        most = min(self.most, max(1, len(k) // 4))
        near = {c for d in deletes(k, most) for c in self.by_delete.get(d, ())} if len(k) <= self.longest + most else set()
        return self._first([(d, c) for c in near if (d := weighted_distance(k, c, most)) <= most])


Names = dict[str, int] | DataFrame  # small or large: name -> times, or (name, times)


def reference_counts(reference: DataFrame, name_col: str, *typed: tuple[DataFrame, str]) -> Names:
    """Reference names and their occurrences in the typed columns: a dictionary up to MAX_REFERENCE names, else a table."""
    names = reference.select(F.col(name_col).alias("name")).where("name is not null").distinct()
    if names.limit(MAX_REFERENCE + 1).count() > MAX_REFERENCE:
        seen = names.select("name", F.lit(0).alias("n"))
        for df, col in typed:
            seen = seen.unionByName(df.select(F.col(col).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n")).join(names, "name", "left_semi"))
        return cut(seen.groupBy("name").agg(F.sum("n").alias("times")), "names")
    counts = {r.name: 0 for r in names.collect()}
    for df, col in typed:
        seen = df.select(F.col(col).alias("name")).join(F.broadcast(names), "name", "left_semi").groupBy("name").count()
        for r in seen.collect():
            counts[r["name"]] += r["count"]
    return counts


def name_table(df: DataFrame, names: Names) -> DataFrame:
    """(_name): the names, marked for broadcast where they are known to be few."""
    if isinstance(names, DataFrame):
        return names.select(F.col("name").alias("_name"))
    return F.broadcast(df.sparkSession.createDataFrame([(n,) for n in names], "_name string"))


def resolve_column(df: DataFrame, col: str, names: Names, out: str = "canonical") -> DataFrame:
    """df with `out`: the reference name col stands for, '' if none, null for null. No shuffle for a dictionary: it goes to the rows, and
    each distinct value of a task is resolved once."""
    if isinstance(names, DataFrame):
        return resolve_joined(df, col, names, out)
    resolver = df.sparkSession.sparkContext.broadcast(names)

    @F.pandas_udf("string")
    def to(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        r = Resolver(resolver.value)
        for s in batches:
            yield s.map({v: r.resolve(v) for v in s.dropna().unique()}).astype(object).where(s.notna(), None)

    return df.withColumn(out, to(F.col(col)))


def not_exact(df: DataFrame, col: str, names: Names) -> DataFrame:
    """The rows whose non-null value is not exactly a name of the reference."""
    return df.where(F.col(col).isNotNull()).join(name_table(df, names), F.col(col) == F.col("_name"), "left_anti")


def resolve_joined(df: DataFrame, col: str, names: DataFrame, out: str = "canonical", most: int = MAX_EDITS) -> DataFrame:
    """resolve_column for references of any size, (name, times): distinct values and names meet in an equality join on their deletes."""
    typed = df.where(F.col(col).isNotNull()).select(F.col(col).alias("v")).distinct()

    @F.pandas_udf("string")
    def keyed(s: pd.Series) -> pd.Series:
        return s.map(key)

    @F.pandas_udf("array<string>")
    def left_out(s: pd.Series) -> pd.Series:
        return s.map(lambda k: sorted(deletes(k, most)))

    @F.pandas_udf("double")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([weighted_distance(x, y, min(most, max(1, len(x) // 4))) for x, y in zip(a, b, strict=True)])

    right = cut(names.select("name", "times", keyed("name").alias("nk")), "keys")
    longest = right.agg(F.max(F.length("nk"))).first()[0] or 0
    left = cut(typed.select("v", keyed("v").alias("k")), "keys").where((F.col("k") != "") & (F.length("k") <= longest + most))
    probes = left.select("v", "k", F.explode(left_out("k")).alias("d"))
    both = probes.join(right.select("name", "times", "nk", F.explode(left_out("nk")).alias("d")), "d").select("v", "k", "name", "nk", "times").distinct().withColumn("w", distance("k", "nk"))
    near = both.where(F.col("w") <= F.least(F.lit(float(most)), F.greatest(F.lit(1.0), F.floor(F.length("k") / 4))))
    best = near.groupBy("v").agg(F.min_by("name", F.struct(F.when(F.col("v") == F.col("name"), -1.0).otherwise(F.col("w")), -F.col("times"), "name")).alias("_to"))
    joined = df.join(best.withColumnRenamed("v", "_v"), F.col(col) == F.col("_v"), "left").drop("_v")
    return joined.withColumn(out, F.when(F.col(col).isNotNull(), F.coalesce("_to", F.lit("")))).drop("_to")
