"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans are written for.  Partition counts are left to AQE.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}

_LOCAL_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def build_session(name: str = "airshed", **extra: str) -> SparkSession:
    """A session with the settings above; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, else the folder that was
    given to ``setCheckpointDir``.

    Only a session on one machine may have neither; it gets a temporary folder that
    goes when the process ends.  On a cluster a missing folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not _is_local(context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = _LOCAL_FOLDERS.get(context.applicationId)
    if folder is None:
        folder = _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="airshed-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; it is deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context.hadoopConfiguration()).deleteOnExit(target)
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that functions that
    run there can import it wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    folder = tempfile.mkdtemp(prefix="airshed-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(package)
    archive = os.path.join(folder, f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for place, _, files in sorted(os.walk(package)):
            for file in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(place, file)
                out.write(path, os.path.join(name, os.path.relpath(path, package)))
    context.addPyFile(archive)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives the loss of executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read again.

    Like ``cut_lineage``, but later readers read only the columns they use.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
