"""Intermediate tables in the folder all executors share.

They cut lineage and pin values that must not be computed twice (range partition numbers),
and they survive the loss of an executor.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset, in local mode only, a temporary
    folder that goes when Python ends.
    """
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


class Scratch:
    """A set of intermediate tables that can be dropped together once they were used."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._folder: str | None = None

    def write(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as Parquet to a new shared folder and read it back."""
        if self._folder is None:
            app = self._spark.sparkContext.applicationId
            self._folder = f"{shared_dir(self._spark)}/tidemark/{app}/{uuid.uuid4().hex}"
        path = f"{self._folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete the tables; frames read from them can no longer be computed."""
        if self._folder is not None:
            where = self._spark._jvm.org.apache.hadoop.fs.Path(self._folder)
            where.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(where, True)
            self._folder = None
