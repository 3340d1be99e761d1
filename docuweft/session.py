"""Session settings and the shared folder intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"

#: Settings the jobs rely on: re-planning at run time, splitting of skewed join
#: partitions even where that costs a shuffle, keeping only a query's first rows
#: in each task also for deep pages, UTC so dates do not move, and batches of texts
#: that leave a Python worker small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}

#: Most rows a side may have to be broadcast on our own hint.
BROADCAST_ROWS = 200_000


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only in local mode without one."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all machines share")
    if not named:
        named = tempfile.mkdtemp(prefix="docuweft-")
        spark.conf.set(CHECKPOINT_SETTING, named)
    return named.rstrip("/")


#: Intermediate tables of each application: their places, and the names of those the catalog knows.
_written: dict[str, list[str]] = {}
_named: dict[str, list[str]] = {}


def new_place(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for an intermediate table."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def new_table(writer: DataFrameWriter, spark: SparkSession, name: str) -> DataFrame:
    """What ``writer`` writes, as a table in the shared folder that the catalog knows, as bucketed ones must be."""
    writer.option("path", new_place(spark, name)).saveAsTable(name)
    _named.setdefault(spark.sparkContext.applicationId, []).append(name)
    return spark.table(name)


def remove_written(spark: SparkSession) -> None:
    """Remove the intermediate tables made so far; call it once what was computed from them is stored."""
    for name in _named.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"drop table if exists {name}")
    for path in _written.pop(spark.sparkContext.applicationId, []):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, read by all that follows."""
    spark = df.sparkSession
    path = new_place(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of driver rows whose size the optimizer knows, so that it broadcasts it by itself."""
    names = [c.split()[0] for c in schema.split(",")]
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(pd.DataFrame(rows, columns=names), schema)


def is_small(df: DataFrame) -> bool:
    """Whether a side may be broadcast; counted in its tasks, no rows move for it."""
    return df.count() <= BROADCAST_ROWS


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Broadcast after counting; beyond the bound leave the choice to the shuffle joins."""
    return F.broadcast(df) if is_small(df) else df


def spread(table: DataFrame) -> DataFrame:
    """A just-read table over all cores, for costly work per row, where it has fewer splits than that.

    A table of many files already has more splits than cores and is left as it is.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table
