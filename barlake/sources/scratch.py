"""Shared folder for tables that cut lineage or hold stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder;
    elsewhere a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/barlake-{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever store the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of a layer table, on whatever store the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right under a folder, on whatever store the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in store.listStatus(target)]
