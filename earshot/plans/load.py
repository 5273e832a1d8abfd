"""Idempotent load of the star tables, parents first."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from earshot import schemas as S
from earshot.operators.integrity import quarantine_orphans, require_parents
from earshot.operators.upsert import append_by_name, new_rows
from earshot.sources.listens import ORDINAL
from earshot.sources.tables import create_star_tables, star_tables


@dataclass(frozen=True)
class LoadResult:
    """Rows offered per table, and the listens set aside for lack of a parent."""

    offered: Mapping[str, int]
    orphans: DataFrame | None


def checked(
    frames: Mapping[str, DataFrame], stored: Mapping[str, DataFrame], orphans: str
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """The frames to load, and the listens set aside, after a check of references against stored and new parents."""
    if orphans not in ("raise", "quarantine"):
        raise ValueError(f"orphans must be 'raise' or 'quarantine', not {orphans!r}")
    parents = {
        column: stored[parent].select(column).unionByName(frames[parent].select(column))
        for column, parent in S.LISTEN_PARENTS.items()
    }
    incoming, set_aside = dict(frames), None
    if orphans == "raise":
        require_parents("user_listens", frames["user_listens"], parents)
    else:
        incoming["user_listens"], set_aside = quarantine_orphans(frames["user_listens"], parents)
    return incoming, set_aside


def rows_to_add(name: str, frame: DataFrame, stored: DataFrame, n: int, buckets: int | None = None) -> DataFrame:
    """The rows of a table's frame of ``n`` rows whose keys are new, dealt out for writing."""
    unique = S.UNIQUE_COLUMNS[name]
    ordinal = ORDINAL if ORDINAL in frame.columns else None
    rows = new_rows(frame, stored, unique, ordinal, n)
    if buckets:
        return rows.repartition(buckets, unique[0])
    if name == "user_listens":
        # Ordered by time, so that a range of it skips row groups and files; the id cuts a busy second.
        return rows.repartitionByRange("listen_time", "listen_id").sortWithinPartitions("listen_time")
    return rows


def load(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    database: str,
    orphans: str = "raise",
    buckets: int | None = None,
) -> LoadResult:
    """Append the rows whose keys are new; loading the same frames again changes nothing.

    The frames must be validated, and are best staged, since each is read more
    than once. References are checked against stored and new parents before
    anything is written: ``orphans="raise"`` ends the load on a broken one,
    ``"quarantine"`` sets such listens aside. One load at a time may run on a
    database, as Parquet tables have no transactions; a load that was cut short
    is completed by running it again. ``publish.publish`` changes all tables at once.
    """
    create_star_tables(spark, database, buckets)
    stored = star_tables(spark, database)
    incoming, set_aside = checked(frames, stored, orphans)
    offered = {}
    for name in S.STAR_TABLES:
        offered[name] = incoming[name].count()
        rows = rows_to_add(name, incoming[name], stored[name], offered[name], buckets)
        append_by_name(rows, f"`{database}`.`{name}`")
        spark.catalog.refreshTable(f"`{database}`.`{name}`")
    return LoadResult(offered, set_aside)
