"""Session helpers: building a session, the checkpoint folder, scoped SQL settings."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "vertexrank",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the rank loop expects.

    On a cluster ``master`` stays ``None`` and the launcher decides; locally
    pass ``"local[8]"``. The UI stays off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        # checkpoint files of dropped iterations are removed by the context cleaner,
        # and written compressed (one state per step goes to shared storage)
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.checkpoint.compress": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage, as the session names it.

    Order: the directory already set on the context, then the
    ``spark.checkpoint.dir`` setting, then a folder under the session's
    warehouse (``spark.sql.warehouse.dir``), which executors share as well.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    sc.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it is not there)."""
    fs, p = _path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the checkpoint folder for written tables; it is
    removed when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{os.urandom(6).hex()}"
    fs, p = _path(spark, path)
    fs.mkdirs(p.getParent())
    fs.deleteOnExit(p)
    return path


@contextlib.contextmanager
def sql_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set session SQL settings for the duration of a block, then restore them."""
    previous = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in previous.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
