"""Session helpers: sessions, and durable intermediate tables.

Intermediates go under the shared folder that the session names in
``spark.checkpoint.dir``; without one, writing them is an error.  Only
``local_session`` (tests, bench) sets a folder of its own, and only when the
setting is unset.  A table stays until :meth:`Written.discard` or, at the
latest, :func:`discard_all` deletes it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Folders written and not yet deleted, with the session that wrote them.
_OPEN: dict[str, SparkSession] = {}


def open_session(app_name: str = "postcluster", master: str | None = None,
                 shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the settings the library wants.

    Without ``master`` the one given to ``spark-submit`` (or the cluster's
    default) holds: a master set in code would win over it.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "postcluster", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the bench and tests run."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("POSTCLUSTER_DRIVER_MEMORY", "8g"),
        **(extra or {}),
    }
    spark = open_session(app_name, f"local[{cores}]", shuffle_partitions, settings)
    spark.sparkContext.setLogLevel("ERROR")
    if not _configured_root(spark):
        # Local runs only: a private folder stands in for the shared one.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="postcluster-ckpt-"))
    return spark


def _configured_root(spark: SparkSession) -> str | None:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext on a Spark Connect session
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for durable intermediates, from the session."""
    root = _configured_root(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def _new_folder(spark: SparkSession, name: str) -> str:
    path = f"{checkpoint_root(spark)}/postcluster/{name}-{uuid.uuid4().hex}"
    _OPEN[path] = spark
    return path


def track(spark: SparkSession, path: str) -> None:
    """Let :func:`discard_all` delete a folder that someone else has written."""
    _OPEN[path] = spark


def open_folders(spark: SparkSession) -> set[str]:
    """The intermediates of the session that are not deleted yet."""
    return {path for path, owner in _OPEN.items() if owner is spark}


def discard(spark: SparkSession, paths: set[str]) -> None:
    """Delete some intermediates.  Frames that read them must not be used afterwards."""
    for path in paths & open_folders(spark):
        _delete(spark, path)
        del _OPEN[path]


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder; an error is the caller's to see."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hadoop_path, True)
    if fs.exists(hadoop_path):
        raise OSError(f"could not delete {path}")


def discard_all(spark: SparkSession) -> None:
    """Delete every intermediate that the session has written and not yet
    deleted.  Frames that read them must not be used afterwards."""
    discard(spark, open_folders(spark))


@dataclass
class Written:
    """An intermediate table: the frame to read, and where its files are.

    :meth:`discard` deletes the files once nothing will read the frame again.
    """

    frame: DataFrame
    path: str | None  # None once discarded
    rows: int  # counted while writing, no separate job

    def discard(self) -> None:
        if self.path is not None:
            _delete(self.frame.sparkSession, self.path)
            _OPEN.pop(self.path, None)
            self.path = None


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> Written:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    The returned frame's lineage starts at the written files, so a lost
    executor re-reads them instead of re-running the scan, join and
    aggregation that produced them.  ``partition_by`` lays the files out in
    directories by those columns, so a reader filtering on them lists and
    reads only the matching directories.
    """
    spark = df.sparkSession
    path = _new_folder(spark, name)
    # The row count is observed during the write itself.
    counted = Observation(f"{name}-rows")
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("error").partitionBy(*partition_by).parquet(path)
    # The schema is known: no footer-reading job to infer it again.
    frame = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    return Written(frame, path, int(counted.get["rows"]))


def write_lines(lines: DataFrame, name: str) -> Written:
    """Write a ``value string`` frame as text files in the shared folder."""
    spark = lines.sparkSession
    path = _new_folder(spark, name)
    counted = Observation(f"{name}-rows")
    lines.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("error").text(path)
    return Written(spark.read.text(path), path, int(counted.get["rows"]))


def settle(df: DataFrame, *inputs: Written) -> DataFrame:
    """A result of few rows (bounded by a parameter, such as k clusters) as a
    frame of its own, so that the tables it was computed from can go now."""
    rows = df.collect()
    for written in inputs:
        written.discard()
    return df.sparkSession.createDataFrame(rows, df.schema)
