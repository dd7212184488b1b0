"""Work folders that all executors share, and cutting lineage by a written table."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}  # of each application


def _base(spark: SparkSession) -> str:
    """This application's own folder in the one all executors share; it goes when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            # Driver and executors are one machine.
            base = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        _folders[app] = f"{base.rstrip('/')}/corpusloom-{app}"
        atexit.register(_clear, app, spark)
    return _folders[app]


def clear(spark: SparkSession) -> None:
    """Deletes what this application wrote to its work folder; results that still read from there are lost."""
    _clear(spark.sparkContext.applicationId, spark)


def _clear(app: str, spark: SparkSession) -> None:
    path = _folders.pop(app, None)
    if path is None:
        return
    with contextlib.suppress(Exception):  # the session may have ended
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    if path.startswith("file:"):
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share: spark.checkpoint.dir of the session, where set."""
    return f"{_base(spark)}/{name}-{uuid.uuid4().hex}"


#: Has Spark delete the shuffle files of a finished execution; without it they stay until the driver's JVM collects its plan.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """The rows written to the shared folder and read again: cuts lineage, survives lost executors.

    The shuffle files behind them go with the write, as nothing reads them any more.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        writer = df.write.mode("errorifexists").option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def removed(table: DataFrame) -> None:
    """Deletes a table that `written` gave and nothing will read again; later it would go with the work folder."""
    spark, files = table.sparkSession, table.inputFiles()
    if files:
        where = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if not where.toString().removeprefix("file:").lstrip("/").startswith(_base(spark).removeprefix("file:").lstrip("/")):
            raise ValueError(f"{where} is not in the work folder")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer partitions than the application has cores, spread over them; others as they are.

    Small tables come as one file that can't be split; work per text would then use one core.  For
    plain scans with projections and filters only: other plans would be run by asking.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(cores)
