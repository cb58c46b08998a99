"""Folders for intermediate tables that every executor can read."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

_local: list[tempfile.TemporaryDirectory] = []


def scratch_root(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session, whose executors are this process, may fall back to a
    temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        _local.append(tempfile.TemporaryDirectory(prefix="marquee-"))
        shared = _local[-1].name
    return f"{shared.rstrip('/')}/marquee-{label}-{uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system Spark can reach; an absent one is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_folder(spark: SparkSession, label: str, given: str | None = None) -> Iterator[str]:
    """The folder the caller gave, which stays, or a fresh one, which goes with the block."""
    if given:
        yield given
        return
    folder = scratch_root(spark, label)
    try:
        yield folder
    finally:
        remove_folder(spark, folder)
