"""Shared folders for tables, checkpoints and logs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Every executor must see it. A machine-local temporary folder takes its place
    only where driver and executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; it goes when the session ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    if getattr(spark, "_jvm", None) is not None:
        file = spark._jvm.org.apache.hadoop.fs.Path(path)
        file.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(file)
    return path
