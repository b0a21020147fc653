"""Session helpers: configuration, shared working folder, written tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
#: Paths given out per application, for :func:`clear_work`.
_GIVEN: dict[str, list[str]] = {}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    """Start (or reuse) a session with the settings the jobs expect."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and stream state.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    that has none gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_FOLDERS[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _GIVEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def folders_in(spark: SparkSession, path: str, marker: str = "_SUCCESS") -> list[str]:
    """Names of the folders under ``path`` that hold ``marker``: those that were written to the end."""
    hadoop, configuration = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    where = hadoop(path)
    system = where.getFileSystem(configuration)
    if not system.exists(where):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(where) if entry.isDirectory()]
    return sorted(name for name in names if system.exists(hadoop(f"{path}/{name}/{marker}")))


def delete_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def work_scope(spark: SparkSession):
    """Intermediate tables written inside are deleted at the end; results must be written or collected before.

    Without it they stay in the shared folder, as a returned DataFrame may still read them.
    """
    given = _GIVEN.setdefault(spark.sparkContext.applicationId, [])
    before = len(given)
    try:
        yield
    finally:
        for path in given[before:]:
            delete_folder(spark, path)
        del given[before:]


def materialize(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner a true size, so that it broadcasts the table only if it is small.
    Columns named in ``folders`` become folders, so filters on them skip files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    (df.write.partitionBy(*folders) if folders else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
