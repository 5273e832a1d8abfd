"""Shared scratch space, and broadcasts that depend on a measured size."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)

BROADCAST_ROWS = 1_000_000
"""Most rows of a key table (a few narrow columns) that is sent to every executor."""
BROADCAST_BYTES = 64 << 20
"""Most bytes of its texts, arrays and the like."""


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    A temporary folder stands in only where the setting is absent and Spark runs
    in a single process, as in tests.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master.startswith("local-cluster") or not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="earshot-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, not yet in use."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a path in the shared folder and go on from the written table.

    It cuts the lineage, survives the loss of executors, and later steps read
    only the columns they need.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as Spark's own file systems resolve it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(place).toString()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch path of ours and all below it, by Spark's own file system.

    A failure is logged and goes no further, so that it never hides the error
    of the work before it.
    """
    try:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:
        logger.warning("Could not delete '%s'", path, exc_info=True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at a path, by Spark's own file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern, by Spark's own file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath().toString() for status in found or ()]


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """Compute a summary once; return it with its number of rows."""
    shared_dir(df.sparkSession)
    kept = df.checkpoint()
    return kept, kept.count()


def variable_bytes(df: DataFrame) -> int:
    """Bytes of the columns whose width is not fixed, as JSON text; one aggregate if there are any."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    wide = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, fixed)]
    if not wide:
        return 0
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct(*wide))))).first()[0] or 0


def fits_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> bool:
    """Whether the rows and bytes of a measured table allow sending it to every executor."""
    return rows <= limit and variable_bytes(df) <= BROADCAST_BYTES


def broadcast_within(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a measured table for broadcasting if its rows and bytes allow; else Spark shuffles it."""
    return F.broadcast(df) if fits_broadcast(df, rows, limit) else df
