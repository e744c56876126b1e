"""Deduplication and upserts. Ties are broken by an explicit order column; rows with a null key are all kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edicta.operators.matching import sized


def keep_best(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by the order. Rows with a null in any key are kept and never meet in one task: each is salted by
    its own hash, so a third of all rows may lack the key."""
    has_all = F.lit(True)
    for k in keys:
        has_all &= F.col(k).isNotNull()
    salt = F.when(has_all, F.lit(None).cast("long")).otherwise(F.monotonically_increasing_id())
    w = Window.partitionBy(*keys, "_salt").orderBy(*order)
    return df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_salt", "_r")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """old and new together, the newest row of each key; of equal age, the new one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return keep_best(both, keys, F.col(newest).desc_nulls_last(), F.col("_new").desc()).drop("_new")


def append_delta(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows of new whose key is not in old, the first of each key."""
    first = keep_best(new, keys, F.col(order).asc())
    return first.join(old.select(*keys).distinct(), keys, "left_anti")


def replace_partition(old: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """old without the values of column that new brings, and new. Rows of old without a value stay, also where new brings such rows: null
    names no partition to replace. The values are broadcast where a count proves them few."""
    return old.join(sized(new.select(column).distinct()), column, "left_anti").unionByName(new)


def violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, all parts known, that more than one row has."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
