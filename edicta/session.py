"""Session helpers: local sessions for tests, and lineage cutting that survives executor loss."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session as used by the tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Where it is unset, a local folder serves local sessions; on a cluster each
    executor would write to its own disk, so that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.match(r"local(?:\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = f"file://{tempfile.gettempdir()}/edicta-shared"
        spark.conf.set("spark.checkpoint.dir", where)
    return where


_WRITTEN: list[str] = []


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df to the shared folder and read it back: later plans start at the files, and losing an
    executor loses nothing. Columns, names and types stay as they were. `discard` removes the tables when results were taken."""
    path = f"{shared_dir(df.sparkSession)}/edicta/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> int:
    """Remove the tables that this process cut so far, once no plan that reads them is to run any more; how many they were."""
    hadoop, n = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, 0
    while _WRITTEN:
        at = hadoop(_WRITTEN.pop())
        n += at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return n


def ship(spark: SparkSession) -> None:
    """Give the package to the workers of a session that does not have it installed; once for each context."""
    context = spark.sparkContext
    if getattr(context, "_edicta", False):
        return
    package = Path(__file__).resolve().parent
    where = f"{tempfile.mkdtemp(prefix='edicta-')}/edicta-package.zip"
    with zipfile.ZipFile(where, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(where)
    context._edicta = True
