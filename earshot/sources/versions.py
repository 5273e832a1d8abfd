"""Several tables under one folder that change together: new folders first, then one switch.

A version lists the folders of each table. It is a small table of its own, and it
counts once its job has left ``_SUCCESS`` there, which Spark writes last. Readers
take the newest such version, so they see all tables before a change or all
after it, and work that was cut short leaves nothing but folders no version names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from earshot.operators.sizing import discard, listed

ENTRIES = "name string, folder string"


@dataclass(frozen=True)
class Versions:
    """The versions under ``root``. One writer at a time; of two, the second fails on the number it finds taken."""

    spark: SparkSession
    root: str

    def newest(self) -> int:
        """The number of the newest complete version, 0 if there is none."""
        numbers = [int(re.search(r"/versions/([0-9]+)/_SUCCESS$", path)[1]) for path in listed(self.spark, f"{self.root}/versions/*/_SUCCESS")]
        return max(numbers, default=0)

    def folders(self, version: int | None = None) -> dict[str, list[str]]:
        """The folders of each table in a version, the newest by default; as many as runs that added one."""
        number = self.newest() if version is None else version
        if not number:
            return {}
        out: dict[str, list[str]] = {}
        for row in self.spark.read.schema(ENTRIES).parquet(f"{self.root}/versions/{number}").collect():
            out.setdefault(row.name, []).append(row.folder)
        return {name: sorted(found) for name, found in out.items()}

    def tables(self, schemas: Mapping[str, T.StructType], version: int | None = None) -> dict[str, DataFrame]:
        """The tables of one version; a table without a folder is empty."""
        folders = self.folders(version)
        return {name: self._read(folders.get(name, []), schema) for name, schema in schemas.items()}

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema)
        frames = [read.parquet(f"{self.root}/data/{folder}").select(*schema.names) for folder in folders]
        while len(frames) > 1:  # in pairs, so that the plan stays flat
            frames = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2], strict=False)] + frames[len(frames) & ~1 :]
        return frames[0]

    def new_folder(self, name: str) -> tuple[str, str]:
        """A folder for a table that no version names yet, and its path."""
        folder = f"{name}/{uuid.uuid4().hex}"
        return folder, f"{self.root}/data/{folder}"

    def publish(self, added: Mapping[str, list[str]], replace: bool = False) -> int:
        """Make the next version: the newest one's folders, or none if ``replace``, and those added."""
        number = self.newest()
        kept = {} if replace else self.folders(number) if number else {}
        rows = [(name, folder) for part in (kept, added) for name, folders in part.items() for folder in folders]
        entries = self.spark.createDataFrame(rows, ENTRIES).coalesce(1)
        path = f"{self.root}/versions/{number + 1}"
        if not listed(self.spark, f"{path}/_SUCCESS"):
            discard(self.spark, path)  # of a run that was cut while it wrote the version
        entries.write.mode("error").parquet(path)
        return number + 1

    def clean(self) -> int:
        """Delete the folders that the newest version does not name; returns how many. No writer may be at work."""
        named = {folder for found in self.folders().values() for folder in found}
        prefix = "/data/"
        paths = listed(self.spark, f"{self.root}/data/*/*")
        gone = [p for p in paths if p.rpartition(prefix)[2] not in named]
        for path in gone:
            discard(self.spark, path)
        return len(gone)
