"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_LOCAL_DIRS: dict[str, str] = {}


def build_session(
    master: str = "local[8]", app: str = "candlewick", shuffle_partitions: int = 8, shared: str | None = None
) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shared is not None:
        builder = builder.config("spark.checkpoint.dir", shared)
    return configure(builder.getOrCreate())


# Trading days are UTC days. The second setting lets a join keep a
# partitioning on some of its keys: the tiled pair join is placed by cell, and
# daily panels by symbol, and both would otherwise be shuffled once more.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the models rely on."""
    for name, value in _SETTINGS.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    return spark


def literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A constant table. Spark knows its exact size, unlike a parallelised list."""
    fields = StructType.fromDDL(schema)
    named = [dict(zip(fields.names, row)) for row in rows]
    table = pa.Table.from_pylist(named, schema=to_arrow_schema(fields))
    return spark.createDataFrame(table, schema=fields)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Falls back to a temporary folder only in local mode, where driver and
    executors are one process on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    active = sc.getCheckpointDir()
    if active:
        return active.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _LOCAL_DIRS.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="candlewick-"))


def _staging_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/candlewick-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_staging_dir(spark)}/{uuid.uuid4().hex}/{name}"


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application staged, once its results are stored.

    DataFrames that still read staged tables cannot be used afterwards.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_staging_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The result has no lineage to recompute when an executor is lost, and
    Catalyst sees its true size, so later joins broadcast it only if it
    really is under the broadcast threshold.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
