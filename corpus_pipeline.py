"""From raw documents to a training mix: cleaning, de-duplication, decontamination, privacy, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.clean_lines import ADDED, clean_lines
from earshot.llm.decontaminate import drop_contaminated
from earshot.llm.mixing import mix_sources
from earshot.llm.near_dups import drop_near_duplicates
from earshot.llm.privacy import hide_personal_data
from earshot.llm.text import set_aside
from earshot.operators.sizing import scratch_path, staged


def with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The documents with another text, and ``n_chars``, if there, counted anew."""
    counted = {"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in columns else {}
    return docs.withColumns({"text": F.col(text), **counted}).select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that fail. Null and empty texts are rejected."""

    def cleaned(docs: DataFrame) -> DataFrame:
        return with_text(clean_lines(docs).where("kept"), docs.columns, "clean_text")

    return set_aside(docs, cleaned, ["text"], ADDED)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, and one row of each of its repeats."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go; null and empty texts hold none."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced by their kinds; a null text becomes empty."""
    return with_text(hide_personal_data(docs), docs.columns, "text")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which the mix takes words, with how many of them it takes; none of an empty text."""
    return mix_sources(docs).where("taken > 0")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("privacy", privacy),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written and read again. An empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), scratch_path(spark, name))
    return docs


ORACLE_SQL = None
