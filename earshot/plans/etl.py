"""The batch job: listening log to star tables.

    spark-submit earshot/plans/etl.py <path> <database>

The tables go to the catalog of the session; a persistent one needs
``--conf spark.sql.catalogImplementation=hive`` or a catalog of your own.
"""

from __future__ import annotations

import logging
import sys
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot import schemas as S
from earshot.operators.dedupe import distinct_first
from earshot.operators.sizing import discard, scratch_path, staged
from earshot.operators.validation import check_required, raise_missing, rejected_rows, valid_rows
from earshot.plans.load import LoadResult, load
from earshot.plans.rules import STAR_RULES
from earshot.plans.star import STAR_FRAMES
from earshot.sources.listens import ORDINAL, absent_paths, extract, numbered, raw_lines

logger = logging.getLogger(__name__)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass through a stage, without a job of its own."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def valid_table(listens: DataFrame, name: str, rules: Mapping = STAR_RULES) -> DataFrame:
    """The valid rows of one star table, with their ordinals."""
    return valid_rows(STAR_FRAMES[name](listens), rules[name], ORDINAL)


def rejected_table(listens: DataFrame, name: str, rules: Mapping = STAR_RULES) -> DataFrame:
    """The rows that ``valid_table`` drops, with reasons. Exact copies are no rejects."""
    frame = STAR_FRAMES[name](listens)
    if name == "user_listens":  # the other frames are distinct already
        frame = distinct_first(frame, ORDINAL)
    return rejected_rows(frame, rules[name], ORDINAL)


def transform(listens: DataFrame, rules: Mapping = STAR_RULES) -> dict[str, DataFrame]:
    """Split raw listens into the four valid tables."""
    check_required(listens.schema, S.REQUIRED_PATHS)
    return {name: valid_table(listens, name, rules) for name in STAR_FRAMES}


@dataclass(frozen=True)
class EtlResult:
    """What a run did. ``rejected`` and ``load.orphans`` read the staged listens,
    which stay in ``scratch`` until ``discard`` is called."""

    extracted: int
    load: LoadResult
    listens: DataFrame
    rules: Mapping
    scratch: str

    def rejected(self) -> dict[str, DataFrame]:
        """Rows that validation dropped, per table, with reasons."""
        return {name: rejected_table(self.listens, name, self.rules) for name in STAR_FRAMES}

    def discard(self) -> None:
        discard(self.listens.sparkSession, self.scratch)


def run_etl(
    spark: SparkSession,
    path: str,
    database: str,
    schema: T.StructType | None = S.RAW_LISTEN,
    rules: Mapping = STAR_RULES,
    orphans: str = "raise",
    buckets: int | None = None,
    store: Callable[..., LoadResult] = load,
) -> EtlResult:
    """Extract, transform and load one log.

    ``store`` takes the frames in: ``load`` into the tables of a database, or
    ``publish.publish`` into a folder (given as ``database``) whose tables change
    all at once.

    The log is parsed once: its needed fields are staged as Parquet, and the
    four frames read only their own columns from there.
    """
    scratch = scratch_path(spark, "etl")
    try:
        logger.info("Staging the fields of '%s' in '%s'", path, scratch)
        raw, seen = observed(extract(spark, path, schema), "extracted")
        listens = staged(raw, f"{scratch}/listens")
        extracted = seen.get["rows"]
        logger.info("Staged %d listens", extracted)
        if schema is not None:
            raise_missing(absent_paths(listens, raw_lines(spark, path), S.REQUIRED_PATHS))

        # Valid frames are unique by key, so the load needs no ordinal to choose by.
        frames = {
            name: staged(df.drop(ORDINAL), f"{scratch}/{name}") for name, df in transform(numbered(listens), rules).items()
        }
        result = store(spark, frames, database, orphans, buckets)
    except Exception:
        logger.exception("Stopped at '%s'; its staged tables are deleted", path)
        discard(spark, scratch)
        raise
    logger.info("Rows offered to the tables of '%s': %s", database, dict(result.offered))
    return EtlResult(extracted, result, listens, rules, scratch)


if __name__ == "__main__":
    logging.basicConfig(level="INFO")
    session = SparkSession.builder.appName("listening-etl").getOrCreate()
    run_etl(session, *sys.argv[1:3]).discard()
