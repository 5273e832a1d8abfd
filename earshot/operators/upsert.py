"""Insert-or-ignore: append the rows whose unique values are new to the target."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.operators.dedupe import keep_first
from earshot.operators.sizing import fits_broadcast, shared_dir


def new_rows(
    batch: DataFrame,
    target: DataFrame,
    unique: Sequence[str],
    ordinal: str | None = None,
    batch_rows: int | None = None,
) -> DataFrame:
    """Rows of ``batch`` that conflict neither with ``target`` nor with each other.

    With ``ordinal``, which differs from row to row, rows count in its order, as
    if they were stored one by one; without it the batch must be unique already.
    Rows that meet stored values are out before they can compete with others.
    With several unique columns this runs jobs while the plan is built. Keys of a batch of known size whose rows and bytes
    are within the broadcast limits are sent to the target, which is then filtered where it lies instead of being
    shuffled; other batches meet the target in a shuffled anti-join.
    """
    columns = batch.columns
    for column in unique:
        taken = target.select(column)
        if batch_rows is not None and fits_broadcast(keys := batch.select(column), batch_rows):
            taken = taken.join(F.broadcast(keys), column, "left_semi")
        batch = batch.join(taken, column, "left_anti")
    if ordinal is not None:
        batch = keep_first(batch, unique[0], [ordinal]) if len(unique) == 1 else _first_come(batch, unique, ordinal)
    return batch.select(*columns)


def _first_come(batch: DataFrame, unique: Sequence[str], ordinal: str) -> DataFrame:
    """The rows that are stored if they come one by one and each conflict is ignored.

    A row that comes first for all its values is stored, and rows that share a
    value with it are out; then the rest is looked at again, so that a row that is
    out keeps no other out. The number of rounds is the length of the longest
    chain of such conflicts, mostly one or two.
    """
    shared_dir(batch.sparkSession)
    rest, stored = batch, None
    while True:
        firsts = [F.min(ordinal).over(W.partitionBy(c)) == F.col(ordinal) for c in unique]
        ranked = rest.withColumn("_first", reduce(and_, [F.col(c).isNull() | f for c, f in zip(unique, firsts, strict=True)])).checkpoint()
        won = ranked.where("_first").drop("_first")
        stored = won if stored is None else stored.unionByName(won)
        rest = ranked.where("NOT _first").drop("_first")
        for column in unique:
            rest = rest.join(won.select(column), column, "left_anti")
        rest = rest.checkpoint()
        if rest.isEmpty():
            return stored


def append_by_name(rows: DataFrame, table: str) -> None:
    """Append to a table, matching columns by name."""
    target = rows.sparkSession.table(table)
    rows.select(*target.columns).write.insertInto(table)
