"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for correctness or for plans at scale.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tallyline",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (a cluster brings its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` when the cluster names one. Only a
    local-mode session without it gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):      # local-cluster has executors of its own
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyline-ckpt-"))
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written intermediate table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def hadoop_fs(spark: SparkSession, path: str):
    """(path, file system) as Spark's own readers and writers see it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


_kept: dict[str, set[str]] = {}


def remove(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_fs(spark, path)
    fs.delete(p, True)
    _kept.get(spark.sparkContext.applicationId, set()).discard(path)


def note(spark: SparkSession, path: str) -> str:
    """Remember a folder that `discard_kept` shall remove."""
    _kept.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def keep(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`df` written under the shared checkpoint folder and read back, with its path.

    Cuts the lineage, and lets Spark plan joins from the measured size. The
    caller removes the path when nothing reads it any more, or `discard_kept`
    does so for all of the session.
    """
    path = note(df.sparkSession, work_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}"))
    with _shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def _shuffles_freed(spark: SparkSession):
    """Shuffle files of what is written meanwhile go when it is written, not when the driver happens to collect garbage.

    A write plans its rows anew and is never run again, so nothing reads them afterwards."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def discard_kept(spark: SparkSession) -> int:
    """Remove what the session's queries have kept, once their results are taken; returns the number of folders."""
    paths = sorted(_kept.get(spark.sparkContext.applicationId, set()))
    for path in paths:
        remove(spark, path)
    return len(paths)
