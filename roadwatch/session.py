"""Session settings and the shared folder for checkpoints and intermediate tables."""

import atexit
import contextlib
import tempfile
import uuid
from functools import cache

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# What the operators assume; skew and partition sizes are left to adaptive execution.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name="roadwatch", master=None, **conf):
    """A session with the engine settings; `conf` uses `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = ENGINE_CONF | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark):
    """Pin the session zone: stored times are UTC and casts from zone-less ones rely on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@cache
def _local_folder():
    """One temporary folder per process, removed when it ends."""
    return tempfile.TemporaryDirectory(prefix="roadwatch-", ignore_cleanup_errors=True)


def shared_folder(spark, name):
    """A fresh folder that every executor can reach, for tables that the session needs meanwhile.

    It lies under `spark.checkpoint.dir` and is removed when the driver's process ends. Only a local
    session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder().name
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _folders:
        atexit.register(_remove_folders)
    _folders.append((spark, path))
    return path


def delete_folders(spark, paths):
    """Delete folders in whatever file system they lie in, by the session's own settings."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


_folders = []


def _remove_folders():
    """A session that is gone already leaves its folders."""
    with contextlib.suppress(Py4JError, OSError):
        for spark, path in _folders:
            delete_folders(spark, [path])
