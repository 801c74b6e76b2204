"""Session defaults, and where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs rely on. Each is also a Spark 4 default or harmless on a cluster;
#: partition counts are left to the cluster's own configuration and to AQE.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "carelens", master: str | None = None, **conf) -> SparkSession:
    """A session with :data:`DEFAULTS`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where driver and executors share one disk. On a
    cluster without the setting this raises instead of writing where other nodes cannot read.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can read and write")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="carelens-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path under :func:`shared_root`."""
    return f"{shared_root(spark)}/carelens/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder made by :func:`scratch_path` that nothing reads any more; any other path is refused."""
    if not path.startswith(f"{shared_root(spark)}/carelens/") or ".." in path:
        raise ValueError(f"{path} is no scratch folder")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """For steps that write large tables one after another: the shuffle files of a job are removed when it ends. By default they
    stay until the driver collects its garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def materialise(df: DataFrame, label: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the table read back.

    It cuts the lineage (a lost executor re-reads files instead of recomputing), freezes non-deterministic
    columns, and gives the optimizer a true size, so that a later join broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold`` and is a sort-merge join beyond that. ``compression`` (default: the session's) is for
    tables that are not the small side of a join: the stronger it is, the lower that size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
