"""Helpers that the operators share: tables, shared storage, Arrow text as bytes, bounded heads."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_local: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset, in local mode only, a temporary
    folder that goes when Python ends.
    """
    global _local
    if configured := spark.conf.get("spark.checkpoint.dir", None):
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local is None:
        _local = tempfile.mkdtemp(prefix="tidemark-llm-")
        atexit.register(shutil.rmtree, _local, ignore_errors=True)
    return _local


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark-llm/{spark.sparkContext.applicationId}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, outlives executors.

    The tables of a session go with :func:`release`.
    """
    path = f"{_own_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what :func:`stored` wrote in this session; frames read from it end with it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; all else stays."""
    return F.translate(text, UPPER, UPPER.lower())


def id_bucket(doc_id: Column, buckets: int) -> Column:
    return F.crc32(doc_id.cast("string")) % buckets


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row starts (one more at the end). Null reads as empty."""
    column = column.fill_null("").cast(pa.large_string())
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    first, last = (int(starts[0]), int(starts[-1])) if len(column) else (0, 0)
    flat = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    return flat, starts - first


def pieces_of(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each has at most ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        sizes = np.diff(flat_text(batch.column(batch.schema.get_field_index(column)))[1])
        at = 0
        ends = np.cumsum(sizes)
        while at < len(sizes):
            base = ends[at] - sizes[at]
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the parts of ``values`` that begin at ``starts`` (one more at the end); parts may be empty."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


def head_of(counts: DataFrame, count: str, most: int) -> tuple[DataFrame, int]:
    """The frequent rows of ``counts``, at most ``most`` of them, and the count from which a row is one.

    A histogram over counts (by powers of two, then within the power that is cut) gives the border, so
    nothing is ranked and the bound holds whatever the data.
    """

    def border(rows: DataFrame, key: Column, room: int) -> tuple[int | None, int]:
        least = None
        for k, n in sorted(((r[0], r[1]) for r in rows.groupBy(key).count().collect()), reverse=True):
            if n > room:
                return least, room
            least, room = k, room - n
        return least, room

    c = F.col(count)
    power = F.floor(F.log2(c)).cast("int")
    top, room = border(counts, power, most)
    low = 1 << 62 if top is None else 1 << top
    below = counts.filter((c < low) & (c >= low // 2)) if low < 1 << 62 else counts.limit(0)
    width = max(1, low // 2 // 1024) if low < 1 << 62 else 1
    fine, _ = border(below, F.floor(c / width).cast("long"), room)
    least = low if fine is None else max(low // 2, fine * width)
    return counts.filter(c >= least), least
