"""Sessions for local runs, and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application.

    They import it from the session's Python files, so a job runs on machines that
    have no copy of it and from any working folder.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="resonara-")
    archive = shutil.make_archive(os.path.join(folder, "resonara"), "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def local_session(cores: int = 8, app_name: str = "resonara", memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks.  Cluster jobs bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a fresh
    temporary folder.  On a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    created = tempfile.mkdtemp(prefix="resonara-")
    context.setCheckpointDir(created)
    return created


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a not yet existing folder below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


FEW_FILES = 32


def balanced(df: DataFrame) -> DataFrame:
    """Spread the rows of a table that lies in fewer files than there are cores.

    A few files may hold a single row group each, and then one task would do all
    of the per-row work.  Tables of many files are left as they are: their scan
    is parallel already and the rows need not move.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < min(cores, FEW_FILES) else df


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``options`` go to the writer.

    Cuts lineage, keeps column statistics for the optimiser and gives one
    fixed copy of anything whose recomputation could differ.
    """
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replaced(df: DataFrame, name: str, *before: DataFrame) -> DataFrame:
    """``written``, then remove the stored tables ``before`` that only ``df`` was made from.

    For rounds that replace one another: the new copy is complete before the old
    one goes, so a round can be run again at any time.
    """
    after = written(df, name)
    spark = df.sparkSession
    top = shared_folder(spark).rstrip("/")
    for table in before:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if path.getParent().toUri().getPath() == spark._jvm.org.apache.hadoop.fs.Path(top).toUri().getPath():
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return after
