"""Batches that arrive as files, taken up once each, as a stream: the native form of resumable ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from edicta.operators.dedup import upsert


PARTS = 64  # parts of a table by hash of its key; a batch rewrites those it touches


def _part(keys: list[str]):
    return F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int")


def ingest_available(spark: SparkSession, incoming: str, schema: str, table: str, checkpoint: str, keys: list[str], newest: str) -> None:
    """Upsert all files not yet taken into the Parquet table at `table`. The table lies in parts by hash of the key; a micro-batch writes
    a new version of the parts it touches, and of no other, so it costs what it touches. A run that broke off goes on where it was: a
    version counts when it is complete, and a batch that is run again gives the same version. Versions before the last two of a part are
    removed."""

    def take(batch: DataFrame, batch_id: int) -> None:
        new = batch.withColumn("_part", _part(keys))
        touched = sorted(r[0] for r in new.select("_part").distinct().collect())  # at most PARTS
        if not touched:
            return
        old = current(spark, table, batch.schema, before=batch_id, parts=touched)
        rows = upsert(batch.limit(0) if old is None else old, batch, keys, newest)
        rows.withColumn("_part", _part(keys)).repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{table}/v{batch_id:08d}")
        _forget(spark, table, batch_id)

    stream = spark.readStream.schema(schema).parquet(incoming)
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _versions(spark: SparkSession, table: str, before: int | None = None) -> dict[int, list[str]]:
    """Part -> its complete versions before a batch, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(table).getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[int, list[str]] = {}
    if not fs.exists(path(table)):
        return found
    for version in sorted(s.getPath().getName() for s in fs.listStatus(path(table))):
        if (before is None or int(version[1:]) < before) and fs.exists(path(f"{table}/{version}/_SUCCESS")):
            for s in fs.listStatus(path(f"{table}/{version}")):
                if (name := s.getPath().getName()).startswith("_part="):
                    found.setdefault(int(name[6:]), []).append(f"{table}/{version}/{name}")
    return found


def _forget(spark: SparkSession, table: str, batch_id: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(table).getFileSystem(spark._jsc.hadoopConfiguration())
    for versions in _versions(spark, table, batch_id + 1).values():
        for old in versions[:-2]:  # the last but one serves a batch that is run again
            fs.delete(path(old), True)


def current(spark: SparkSession, table: str, schema: StructType | None = None, before: int | None = None, parts: list[int] | None = None) -> DataFrame | None:
    """The table as of its latest complete versions, or the latest before a batch; parts: only these. None where there is none."""
    latest = [v[-1] for p, v in sorted(_versions(spark, table, before).items()) if parts is None or p in parts]
    if not latest:
        return None
    return (spark.read.schema(schema) if schema else spark.read).parquet(*latest)


def windowed_counts(events: DataFrame, time: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window, event_type, n): tumbling counts with a watermark; the same plan on a stream and on a table."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), "event_type").agg(F.count(F.lit(1)).alias("n"))
