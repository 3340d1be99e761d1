"""Where a tenant's operational tables are read from.

A source is a function from table name to frame; every frame carries the
``client_id`` of its rows, so one plan serves any number of tenants and no read
goes without one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.spec import Source, live

def frame_source(frames: Mapping[str, DataFrame], client_ids: Sequence[str] | None = None) -> Source:
    """Tables held as frames with a ``client_id`` column."""

    def read(table: str) -> DataFrame:
        if table not in frames:
            raise KeyError(f"no source table {table}")
        df = frames[table]
        return df if client_ids is None else df.filter(F.col("client_id").isin(list(client_ids)))

    return read


def lake_source(spark: SparkSession, root: str, *, client_ids: Sequence[str]) -> Source:
    """Parquet tables under ``root/<table>/client_id=<id>``; other tenants' folders are not even listed.

    A tenant without a folder has no rows of that table; a table that no tenant has is an error.
    """

    def exists(folder: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def read(table: str) -> DataFrame:
        folders = [f for c in client_ids if exists(f := f"{root}/{table}/client_id={c}")]
        if not folders:
            raise KeyError(f"no tenant has a source table {table}")
        df = spark.read.option("basePath", f"{root}/{table}").option("mergeSchema", "true").parquet(*folders)
        return df.withColumn("client_id", F.col("client_id").cast("string"))

    return read


def catalog_source(spark: SparkSession, database: str, *, client_ids: Sequence[str]) -> Source:
    """Catalog tables with a ``client_id`` partition column, pruned by the catalog."""
    return lambda table: spark.table(f"`{database}`.`{table}`").filter(F.col("client_id").isin(list(client_ids)))


class JdbcSource:
    """Tables of one database per tenant, read in parallel ranges of ``id``.

    A stream reads few rows at a time, by an IN list the database answers from
    its index; it wants one partition.
    """

    def __init__(
        self, spark: SparkSession, options: Mapping[str, Mapping[str, str]], partitions: int = 32, client_ids: Sequence[str] | None = None
    ):
        self._spark, self._options, self._partitions = spark, options, partitions
        self._client_ids = list(options) if client_ids is None else list(client_ids)

    def of(self, client_ids: Sequence[str]) -> JdbcSource:
        """The same source for some tenants: no other database is asked."""
        return JdbcSource(self._spark, self._options, self._partitions, client_ids)

    def __call__(self, table: str) -> DataFrame:
        return self._union({c: self._ranges(c, table) for c in self._client_ids})

    def _reader(self, client_id: str):
        return self._spark.read.format("jdbc").options(fetchsize="10000", **self._options[client_id])

    def _ranges(self, client_id: str, table: str) -> DataFrame:
        reader = self._reader(client_id).option("dbtable", table)
        if self._partitions == 1:
            return reader.load()
        ends = self._reader(client_id).option("query", f"SELECT MIN(id) AS lo, MAX(id) AS hi FROM {table}").load().first()
        if ends["lo"] is not None:
            reader = reader.options(
                partitionColumn="id", lowerBound=ends["lo"], upperBound=ends["hi"] + 1, numPartitions=self._partitions
            )
        return reader.load()

    @staticmethod
    def _union(frames: Mapping[str, DataFrame]) -> DataFrame:
        merged = None
        for client_id, df in frames.items():
            df = df.withColumn("client_id", F.lit(client_id))
            merged = df if merged is None else merged.unionByName(df, allowMissingColumns=True)
        return merged


def scan(source: Source, table: str, *, client_id: str) -> DataFrame:
    """One tenant's live rows of a table; the tenant has to be named."""
    if not client_id:
        raise ValueError("client_id is required")
    return live(source(table).filter(F.col("client_id") == client_id))
