"""Merging shards of a table: what is found, and the merge that fails unless it is sound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_findings(rows: DataFrame, shard: str, key: str, count: int, first: int = 0) -> DataFrame:
    """(finding, n): rows, rows without key, keys in several shards, shards missing of `count` numbered from `first`."""
    spark = rows.sparkSession
    n = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("rows without key"))
    facts = n.select(F.explode(F.create_map(*(x for c in n.columns for x in (F.lit(c), F.col(c))))).alias("finding", "n"))
    per_key = rows.where(F.col(key).isNotNull()).groupBy(key).agg((F.min(shard) != F.max(shard)).alias("several"))
    several = per_key.agg(F.count_if("several").alias("n")).select(F.lit("keys in several shards").alias("finding"), "n")
    there = rows.select(F.col(shard).cast("long").alias("id")).distinct()
    missing = spark.range(first, first + count).join(there, "id", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("missing shards").alias("finding"), "n")
    return facts.unionByName(several).unionByName(missing)


def merged(rows: DataFrame, shard: str, key: str, count: int, first: int = 0) -> DataFrame:
    """rows without their shard; ValueError unless every row has a key, each key lies in one shard, and no shard is missing."""
    bad = [f"{r.n} {r.finding}" for r in merge_findings(rows, shard, key, count, first).collect() if r.finding != "rows" and r.n]
    if bad:
        raise ValueError("; ".join(bad))
    return rows.drop(shard)
