"""Referential checks of a fact table against its parents.

All checks work on the distinct keys of the fact, which combine on the map side,
and then touch the rows of the fact only with the keys that lack a parent. A key
that many rows share is looked up once, and the fact is not shuffled as long as
the measured number of such keys allows broadcasting them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.errors import OrphanRowsError
from earshot.operators.sizing import broadcast_within, measured
from earshot.operators.validation import REASONS


def lost_keys(child: DataFrame, column: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Distinct values of ``column`` without a parent. A null refers to nothing, so it is not lost."""
    keys = child.select(column).where(F.col(column).isNotNull()).distinct()
    return keys.join(parent.select(F.col(parent_key or column).alias(column)), column, "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Rows of ``child`` whose ``column`` is set but has no parent."""
    lost, n = measured(lost_keys(child, column, parent, parent_key))
    return child.join(broadcast_within(lost, n), column, "left_semi").select(*child.columns)


def require_parents(name: str, child: DataFrame, parents: Mapping[str, DataFrame]) -> None:
    """Raise if any row of ``child`` lacks a parent."""
    broken = [c for c, parent in parents.items() if not lost_keys(child, c, parent).isEmpty()]
    if broken:
        raise OrphanRowsError(name, broken)


def quarantine_orphans(
    child: DataFrame, parents: Mapping[str, DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Split into rows with all parents, and rows lacking some with ``reasons``."""
    judged, reasons = child, []
    for column, parent in parents.items():
        lost, n = measured(lost_keys(child, column, parent))
        if n == 0:
            continue
        flag = f"_lost_{column}"
        judged = judged.join(broadcast_within(lost.withColumn(flag, F.lit(True)), n), column, "left")
        reasons.append(F.when(F.col(flag), F.lit(f"{column}: no parent")))
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    judged = judged.withColumn(REASONS, found).select(*child.columns, REASONS)
    return judged.where(F.size(REASONS) == 0).drop(REASONS), judged.where(F.size(REASONS) > 0)
