"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Folders made for sessions in local mode, by application; the setting itself is read-only.
_private_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder (``spark.checkpoint.dir``).

    A private folder is made only when the setting is absent and Spark runs in local mode; on a
    cluster a machine-local folder would be lost with its machine, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _private_folders:
            _private_folders[context.applicationId] = tempfile.mkdtemp(prefix="tailwise-")
            context.setCheckpointDir(_private_folders[context.applicationId])
        configured = _private_folders[context.applicationId]
    return configured.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """The part of the shared folder that this application owns, named by its identifier."""
    return f"{shared_folder(spark)}/tailwise-{spark.sparkContext.applicationId}"


def remove_run_folder(spark: SparkSession) -> None:
    """Delete what this application has written there; tables built on it cannot be read afterwards.

    Call it at the end of a run. The folder of a run that died is its owner's to delete.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(conf).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path in this run's part of the shared folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Use it where several results branch off one expensive input: the scan and join run once, and
    a lost executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has been committed."""
    return has_mark(spark, path, "_SUCCESS")


def has_mark(spark: SparkSession, path: str, name: str) -> bool:
    system, place = _file_system(spark, f"{path}/{name}")
    return system.exists(place)


def set_mark(spark: SparkSession, path: str, name: str) -> None:
    """Leave an empty file that later runs find; readers of tables skip names that begin with ``_``."""
    system, place = _file_system(spark, f"{path}/{name}")
    system.create(place, True).close()


def delete_folder(spark: SparkSession, path: str) -> None:
    system, place = _file_system(spark, path)
    system.delete(place, True)
