"""Folders for tables that a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Writes of one run that are handed to Spark at the same time.
TOGETHER = 4


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can see, as named by ``spark.checkpoint.dir``.

    Only a local session (driver and executors on one machine) may go without
    that setting and gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="reportloom-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_root(spark)}/reportloom/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, on whatever file system it names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a working folder that this run made with ``new_folder``."""
    if "/reportloom/" not in path:
        raise ValueError(f"{path} is no working folder")
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path.getFileSystem(conf).delete(hadoop_path, True)


def remove_partition(spark: SparkSession, table: str, column: str, value: str | None) -> None:
    """Delete the folder of one partition of a table."""
    name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/{column}={name}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path.getFileSystem(conf).delete(hadoop_path, True)


def child_paths(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in the folder at ``path``; nothing where there is none."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(hadoop_path):
        return []
    return [f"{path}/{status.getPath().getName()}" for status in system.listStatus(hadoop_path)]


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds; no error where there is none."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def run_together(spark: SparkSession, jobs: Sequence[Callable[[], None]]) -> None:
    """Run independent writes at the same time; the first failure is raised."""
    with ThreadPoolExecutor(TOGETHER) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in started:
        job.result()
