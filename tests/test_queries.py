"""Every registered query over the whole of the smallest tables, beside its SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry
from compare import check, oracle

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle(DIR)


def test_every_sql_text_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", entry.oracle_sql())
def test_query(spark, connection, key):
    assert check(spark, connection, key, entry.queries()[key], entry.oracle_sql()[key], DIR) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 10
