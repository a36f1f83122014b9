"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(folder: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session with its shared folder, for tests and the bench only."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kvetch")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", folder)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` for one job's written tables.

    Written tables cut lineage and survive the loss of any executor. On a cluster the
    folder has to be shared, so it is taken from the session and never invented there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        # One process has no other executors to share with: its warehouse will do.
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder written below :func:`scratch_folder`."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def java_charsets(spark: SparkSession) -> Iterator[None]:
    """Allow ``encode``/``decode`` to use every charset the JVM knows, GBK among them.

    The setting is read when a plan is analysed, so it only has to hold while the
    DataFrame is built.
    """
    name = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
