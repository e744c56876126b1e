"""Joins that need more than equality: one match exactly, longest name contained, similarity within a bound."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicta.session import cut

#: A side is sent to every task only up to this many rows; above, the same rows come from a shuffle join.
MAX_BROADCAST_ROWS = 100_000


def sized(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if a bounded count proves it small."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def exactly_one(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """left with `value` of the right row whose key is unique in right, and `matched`; none or several leave it null."""
    one = right.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(value).alias("_v")).where("_n = 1").drop("_n")
    return left.join(one, key, "left").withColumn("matched", F.col("_v").isNotNull()).withColumnRenamed("_v", value)


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def longest_contained(texts: DataFrame, text_id: str, text: str, names: DataFrame, name: str) -> DataFrame:
    """(text_id, name): the longest name that a text holds as whole words. Candidates share the name's longest word by an equality join,
    so that no text meets names for a common word."""
    words = texts.select(text_id, F.concat(F.lit(" "), F.array_join(tokens(F.col(text)), " "), F.lit(" ")).alias("_t"), F.explode(F.array_distinct(tokens(F.col(text)))).alias("_w"))
    keys = names.select(F.col(name), F.array_join(tokens(F.col(name)), " ").alias("_n")).where("_n != ''")
    keys = keys.withColumn("_w", F.array_max(F.transform(F.split("_n", " "), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"])
    hits = words.join(sized(keys), "_w").where(F.contains(F.col("_t"), F.concat(F.lit(" "), F.col("_n"), F.lit(" "))))
    return hits.groupBy(text_id).agg(F.max_by(name, F.struct(F.length("_n"), "_n")).alias(name))


def best_similar(left: DataFrame, left_col: str, right: DataFrame, right_col: str, most: int = 3) -> DataFrame:
    """(left_col, right_col, distance): the nearest right value within `most` edits, for each distinct left value. A value within k
    edits shares one of k + 1 equal pieces of the other at a shifted place: an equality join on pieces finds every pair."""
    k = most + 1
    a = left.select(F.col(left_col).alias("_a")).where("_a is not null").distinct()
    b = right.select(F.col(right_col).alias("_b")).where("_b is not null").distinct()
    size = F.greatest(F.floor(F.length("_b") / k), F.lit(1))
    pieces = b.select("_b", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.substring(F.col("_b"), (i * size + 1).cast("int"), F.when(i == k - 1, F.length("_b")).otherwise(size).cast("int"))))).select("_b", F.col("pos").alias("_i"), F.col("col").alias("_p")).where("_p != ''")
    # every substring of a value that may be piece i of some name, by the lengths that pieces have
    lens = [r[0] for r in pieces.select(F.length("_p")).distinct().collect()]
    none = F.array().cast("array<string>")

    def cut_out(n: int) -> Column:
        return F.when(F.length("_a") >= n, F.transform(F.sequence(F.lit(1), F.length("_a") - n + 1), lambda i: F.substring(F.col("_a"), i, F.lit(n)))).otherwise(none)

    subs = F.array_distinct(F.flatten(F.array(none, *map(cut_out, lens))))
    short = b.where(F.length("_b") <= most).select("_b", F.lit("").alias("_p"))
    grams = a.select("_a", F.explode(F.array_append(subs, F.lit(""))).alias("_p"))
    near = grams.join(sized(pieces.select("_b", "_p").union(short)), "_p").select("_a", "_b").distinct().withColumn("_d", F.levenshtein("_a", "_b", most)).where("_d >= 0")
    best = near.groupBy("_a").agg(F.min_by(F.struct("_b", "_d"), F.struct("_d", "_b")).alias("_m"))
    return best.select(F.col("_a").alias(left_col), F.col("_m._b").alias(right_col), F.col("_m._d").alias("distance"))


def best_ratio(left: DataFrame, left_col: str, right: DataFrame, right_col: str, least: float = 0.72) -> DataFrame:
    """(left_col, right_col, ratio) for each distinct left value: the equal right value, else the one of the highest ratio of matching
    blocks (2 M / (len a + len b)) if that is `least` or more; of equal ratios the first in order. Blank values have no match.

    Values of so high a ratio share two letters in a row, unless they are short: with M matched letters there are at most
    len a + len b - 2 M + 1 blocks, so if each had one letter, M would be no more than that, hence (2 * least - 1) * (len a + len b) / 2
    less M no more than 1. Candidates therefore meet on pairs of letters, short ones on single letters; no pair that counts is missed."""
    a = left.select(F.col(left_col).alias("_a")).where("_a is not null and trim(_a) != ''").distinct()
    b = right.select(F.col(right_col).alias("_b")).where("_b is not null and trim(_b) != ''").distinct()
    equal = a.join(b, a._a == b._b).select("_a", "_b", F.lit(1.0).alias("_r"))
    rest = a.join(b, a._a == b._b, "left_anti")
    short = int(1 / (1.5 * least - 1)) + 1 if 1.5 * least > 1 else None  # letters of both together
    if short is None:
        raise ValueError("least must be over 2/3")

    def parts(c: Column) -> Column:
        n = F.length(c)
        pairs = F.when(n >= 2, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
        single = F.when(n < short, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(c, i, F.lit(1)))).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(F.concat(pairs, single))

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y, strict=True)])

    near = rest.select("_a", F.explode(parts(F.col("_a"))).alias("_p")).join(b.select("_b", F.explode(parts(F.col("_b"))).alias("_p")), "_p")
    # letters beyond those of the shorter value match nothing
    near = near.where(2 * F.least(F.length("_a"), F.length("_b")) >= least * (F.length("_a") + F.length("_b"))).select("_a", "_b").distinct()
    best = near.withColumn("_r", ratio("_a", "_b")).where(F.col("_r") >= least).groupBy("_a").agg(F.min_by(F.struct("_b", "_r"), F.struct(-F.col("_r"), F.col("_b"))).alias("_m"))
    found = equal.unionByName(best.select("_a", F.col("_m._b").alias("_b"), F.col("_m._r").alias("_r")))
    return found.select(F.col("_a").alias(left_col), F.col("_b").alias(right_col), F.col("_r").alias("ratio"))


def contained_in(parts: DataFrame, part: str, wholes: DataFrame, whole: str, least: int = 3) -> DataFrame:
    """(part, whole): the distinct texts of `least` letters or more that stand somewhere in another text, with the first such in order.
    A text stands only where its rarest run of `least` letters does: an equality join on that run finds every pair."""
    def runs(c: Column) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - least + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(least))))

    b = wholes.select(F.col(whole).alias("_b")).where("_b is not null").distinct()
    longest = b.agg(F.max(F.length("_b"))).first()[0] or 0  # longer texts stand in none
    a = parts.select(F.col(part).alias("_a")).where(F.length("_a").between(least, longest)).distinct()
    held = b.select("_b", F.explode(runs(F.col("_b"))).alias("_g"))
    asked = a.select("_a", F.explode(runs(F.col("_a"))).alias("_g"))
    # runs are counted where they lie; a text with a run that no other has stands in none
    often = held.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    rarest = asked.join(often, "_g", "left").groupBy("_a").agg(F.min_by("_g", F.struct(F.coalesce("_n", F.lit(0)), "_g")).alias("_g"), F.min(F.coalesce("_n", F.lit(0))).alias("_n")).where("_n > 0")
    # written, so that its size is known: the exploded texts are never sent to the driver (Spark takes them for as small as the table),
    # and only those with a wanted run are shuffled where the wanted ones are too many to be sent
    rarest = cut(rarest.select("_a", "_g"), "rarest")
    wanted = held.join(sized(rarest.select("_g").distinct()), "_g", "left_semi")
    hits = wanted.hint("merge").join(sized(rarest), "_g").where(F.contains("_b", F.col("_a")))
    return hits.groupBy("_a").agg(F.min("_b").alias("_b")).select(F.col("_a").alias(part), F.col("_b").alias(whole))
