"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare
from conftest import SMALL
from waitspark.registry import ORACLE_SQL, QUERIES

# Queries whose result no SQL can state: the output of trained models.
WITHOUT_SQL = {
    "gbt_predict",
    "mlp_predict",
    "loss_curve",
    "train_and_compare",
}


def test_only_random_and_trained_results_lack_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == WITHOUT_SQL
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert compare(spark, SMALL, name) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["request_hour", "is_weekend", "avg_wait_minutes"]
    assert df.count() > 0
