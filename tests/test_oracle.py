"""Every query with SQL gives the same rows in Spark and in DuckDB."""

import os
import sys

import pytest
from conftest import SF_DIR

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

import __spark_entry__ as entry
from check_queries import compare, tables

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
SLOW = {"end_to_end_run", "compare_models", "train_gbt", "train_final"}  # see test_runs, test_modeling


@pytest.fixture(scope="module")
def duck():
    return tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert compare(got, duck.sql(ORACLE[name]).df()) == "ok"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert not set(ORACLE) - set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 4


@pytest.mark.parametrize("name", ["quality_report", "missing_ids", "session_boundary", "inconsistent_users", "ml_integrity"])
def test_damage_is_found(spark, name):
    """Every counter of defects is above zero over the damaged copy."""
    found = QUERIES[f"damaged_{name}"](spark, SF_DIR).first().asDict()
    assert not found.pop("is_valid", False) and not found.pop("passed", False)
    assert [c for c, n in found.items() if not n] == []


def test_damaged_assignment_is_found(spark):
    users = QUERIES["damaged_unstable_assignment"](spark, SF_DIR)
    assert users.where("variant_count > 1").count() > 0 and users.where("experiment_count <> 1").count() > 0
