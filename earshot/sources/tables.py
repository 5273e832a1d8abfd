"""The star tables in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from earshot import schemas as S


def create_star_tables(spark: SparkSession, database: str, buckets: int | None = None) -> None:
    """Create the database and the four tables where they do not exist.

    With ``buckets`` the tables are bucketed by primary key, so that the
    anti-join of a large load finds the stored keys already hashed. Parquet
    tables carry no key constraints; the load enforces them.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, schema in S.STAR_TABLES.items():
        layout = f"CLUSTERED BY ({S.UNIQUE_COLUMNS[name][0]}) INTO {buckets} BUCKETS" if buckets else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({S.ddl(schema)}) USING parquet {layout}"
        )


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables in the database, sorted."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def star_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The stored tables by name."""
    return {name: spark.table(f"`{database}`.`{name}`") for name in S.STAR_TABLES}
