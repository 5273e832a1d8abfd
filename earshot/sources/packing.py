"""Packing of the small files that a stream leaves in an hour into files of a wanted size.

The stream's own folder stays as it is. Beside it grows a packed copy, in
versions: each run reads the files that no version knows, and adds their rows and
their names in one step.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot import schemas as S
from earshot.operators.sizing import broadcast_within, measured
from earshot.sources.lake import LAKE_TABLE
from earshot.sources.versions import Versions

TARGET_BYTES = 128 << 20
NAMED = T.StructType([*[T.StructField(k, T.IntegerType()) for k in S.PARTITION_KEYS], T.StructField("file", T.StringType())])


def lake_files(spark: SparkSession, lake: str) -> DataFrame:
    """The files of a lake by hour, with their names, paths and bytes; no file is opened.

    For the folder of a stream these are the files that its log has committed.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(lake)
    keys = [F.col(k).cast("int").alias(k) for k in S.PARTITION_KEYS]
    return files.select(*keys, F.substring_index("path", "/", -1).alias("file"), "path", "length")


def planned(files: DataFrame, target_bytes: int = TARGET_BYTES, closed_before: datetime | None = None) -> DataFrame:
    """The files to pack, with ``bin``, which tells those of an hour that become one file.

    The files of an hour are laid end to end, the largest first, and cut at
    multiples of ``target_bytes``; a file belongs to the bin in which it begins, so
    a bin has less than a file more than the target. Hours that end by
    ``closed_before`` are packed whole, others as far as their bins are full, so
    the files of an hour follow its volume and not the number of triggers or runs.
    """
    order = W.partitionBy(*S.PARTITION_KEYS).orderBy(F.desc("length"), "file")
    before = F.coalesce(F.sum("length").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    laid = files.withColumn("bin", F.floor(before / F.lit(target_bytes)).cast("int"))
    filled = F.sum("length").over(W.partitionBy(*S.PARTITION_KEYS, "bin")) >= target_bytes
    ready = filled
    if closed_before is not None:
        begin = F.make_timestamp_ntz(*S.PARTITION_KEYS, F.lit(0), F.lit(0))
        ready = ready | (begin + F.expr("INTERVAL 1 HOUR") <= F.lit(closed_before).cast("timestamp_ntz"))
    return laid.withColumn("ready", ready).where("ready").drop("ready")


def pack(
    spark: SparkSession,
    lake: str,
    target: str,
    target_bytes: int = TARGET_BYTES,
    closed_before: datetime | None = None,
) -> int:
    """Pack what is new in ``lake`` into the packed copy at ``target``; returns the number of files read.

    Only files that no earlier run packed are read, and each (hour, bin) is
    written by one task as one file. Running it again without new files does
    nothing. A run that was cut short leaves the copy as it was. The names of the
    files of a run pass through the driver, as with any read of files.
    """
    versions = Versions(spark, target)
    done = versions.tables({"files": NAMED})["files"]
    new = lake_files(spark, lake).join(done, [*S.PARTITION_KEYS, "file"], "left_anti")
    plan, n = measured(planned(new, target_bytes, closed_before))
    if not n:
        return 0
    paths = [r.path for r in plan.select("path").collect()]
    bins = plan.select(*S.PARTITION_KEYS, "bin").distinct().count()
    # Named as they are, so that no other file is listed or opened.
    read = spark.read.schema(LAKE_TABLE).option("basePath", lake).parquet(*paths)
    placed = read.withColumn("file", F.col("_metadata.file_name"))
    binned = placed.join(broadcast_within(plan.select(*S.PARTITION_KEYS, "file", "bin"), n), [*S.PARTITION_KEYS, "file"])
    folder, path = versions.new_folder("events")
    dealt = binned.drop("file").repartition(bins, *S.PARTITION_KEYS, "bin")
    dealt.write.partitionBy(*S.PARTITION_KEYS, "bin").option("compression", "snappy").parquet(path)
    names, names_path = versions.new_folder("files")
    plan.select(*NAMED.names).coalesce(1).write.parquet(names_path)
    versions.publish({"events": [folder], "files": [names]})
    return n


def packed_lake(spark: SparkSession, target: str, lake: str | None = None) -> DataFrame:
    """The packed copy; with ``lake`` also what no run has packed yet, so that no event is missing."""
    found = Versions(spark, target).tables({"events": LAKE_TABLE, "files": NAMED})
    if lake is None:
        return found["events"]
    fresh = lake_files(spark, lake).join(found["files"], [*S.PARTITION_KEYS, "file"], "left_anti")
    paths = [r.path for r in fresh.select("path").collect()]
    if not paths:
        return found["events"]
    rest = spark.read.schema(LAKE_TABLE).option("basePath", lake).parquet(*paths)
    return found["events"].unionByName(rest.select(*LAKE_TABLE.names))
