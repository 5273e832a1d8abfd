"""Union of frames that do not share all columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, null where one is missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
