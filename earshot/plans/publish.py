"""The load of the four star tables as one step for readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from earshot import schemas as S
from earshot.plans.load import LoadResult, checked, rows_to_add
from earshot.sources.versions import Versions


def published_star(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The star tables of one version, the newest by default."""
    return Versions(spark, root).tables(S.STAR_TABLES, version)


def publish(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    orphans: str = "raise",
    buckets: int | None = None,
) -> LoadResult:
    """Add the rows whose keys are new to the tables under ``root``; readers see all four change at once.

    Like ``load``, with the same checks and the same result, but each table's new
    rows go to a folder of their own, and one new version names all of them. A
    load that was cut short changes nothing; the folders it left are deleted by
    ``Versions.clean``. Loading the same frames again adds no version. ``buckets``
    is not for folders.
    """
    if buckets is not None:
        raise ValueError("buckets belong to catalog tables")
    versions = Versions(spark, root)
    stored = versions.tables(S.STAR_TABLES)
    incoming, set_aside = checked(frames, stored, orphans)
    offered, added = {}, {}
    for name in S.STAR_TABLES:
        offered[name] = incoming[name].count()
        rows = rows_to_add(name, incoming[name], stored[name], offered[name])
        folder, path = versions.new_folder(name)
        rows.select(*S.STAR_TABLES[name].names).write.parquet(path)
        if not spark.read.schema(S.STAR_TABLES[name]).parquet(path).isEmpty():
            added[name] = [folder]
    if added:
        versions.publish(added)
    return LoadResult(offered, set_aside)
