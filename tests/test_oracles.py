"""Every registered query against its SQL on the small tables."""

import os
import sys
from dataclasses import replace
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_module
from bindings import evaluation, jobs, models
from tools.check import compare, open_tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# At the smallest scale these have no row to return.
MAY_BE_EMPTY: set[str] = set()
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


# A fit on the full feature table needs more complete rows than the smallest tables have.
FITTED = {"gbt_fit_predict", "train_improved", "feature_importance", "model_save_load", "run_training", "stress_missing_driver", "run_validation", "job_eval"}
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables():
    return {folder: open_tables(folder) for folder in (SF_DIR, LARGER)}


@pytest.fixture
def short_fits(monkeypatch):
    """SQL states what holds for any fit, so tests fit few, shallow trees; production parameters take minutes a query."""
    few = replace(models.BOOST, n_trees=10, learning_rate=0.2, max_depth=4, patience=4)
    for module in (models, evaluation, jobs):
        if hasattr(module, "BOOST"):
            monkeypatch.setattr(module, "BOOST", few)
        monkeypatch.setattr(module, "JOB", replace(module.JOB, boost=few))


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, tables, short_fits, name):
    folder = LARGER if name in FITTED else SF_DIR
    problems = compare(QUERIES[name](spark, folder), tables[folder], ORACLES[name])
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "no rows"]
    assert not problems, "\n".join(problems)


TEXT_QUERIES = getattr(entry_module, "TEXT_QUERIES", {})  # tested with their operators


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and n not in TEXT_QUERIES])
def test_query_without_sql_has_rows(spark, name):
    assert not QUERIES[name](spark, LARGER).isEmpty()


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and all(r["n_samples"] > 0 and r["rmse"] >= r["mae"] > 0 for r in rows)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
