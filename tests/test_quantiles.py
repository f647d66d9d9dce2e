"""Exact percentiles of small and large groups."""

import numpy as np
import pytest

from hourloom.config import KEY
from hourloom.operators import quantiles


def _frame(spark, groups):
    return spark.createDataFrame([(k, float(v)) for k, values in groups.items() for v in values], f"{KEY} string, v double")


def _check(spark, groups, probabilities):
    got = {(r[KEY], r["p"]): r["value"] for r in quantiles.exact_percentiles(_frame(spark, groups), "v", probabilities, [KEY]).collect()}
    assert len(got) == len(groups) * len(probabilities)
    for k, values in groups.items():
        for p in probabilities:
            assert got[k, p] == pytest.approx(np.percentile(np.array(values, float), p * 100), abs=1e-9), (k, p)


PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def test_small_groups(spark):
    _check(spark, {"one": [5], "two": [1, 2], "ties": [3] * 10 + [4], "many": list(range(101))}, PROBABILITIES)


@pytest.mark.parametrize(("ordered", "cuts"), [(400, 8), (1, 4), (50, 64)])
def test_narrowing(spark, monkeypatch, ordered, cuts):
    """Skewed, tied and negative values; ranks inside and between intervals, down to brackets of a single value."""
    monkeypatch.setattr(quantiles, "ORDERED", ordered)
    monkeypatch.setattr(quantiles, "CUTS", cuts)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 40 * cuts)
    rng = np.random.default_rng(3)
    groups = {
        "normal": rng.normal(size=3000),
        "heavy": np.exp(rng.normal(size=2500) * 4),
        "tied": np.round(rng.normal(size=3000), 1),
        "mostly_zero": np.where(rng.random(2500) < 0.9, 0.0, rng.normal(size=2500)),
        "two_values": [1.0] * 1000 + [2.0] * 1000,
        "small": rng.normal(size=40),
    }
    _check(spark, groups, PROBABILITIES)


def test_no_window_sees_more_than_few_values(spark, monkeypatch):
    """What is put in order is bounded also where a group has many different values."""
    monkeypatch.setattr(quantiles, "ORDERED", 100)
    monkeypatch.setattr(quantiles, "CUTS", 8)
    seen = []
    ordered = quantiles._ordered

    def watched(rows, state, by):
        seen.extend(r["inside"] for r in state.collect())
        return ordered(rows, state, by)

    monkeypatch.setattr(quantiles, "_ordered", watched)
    _check(spark, {"long": np.random.default_rng(1).normal(size=5000)}, [0.3, 0.5])
    assert seen and max(seen) <= 100


def test_missing_values_do_not_count(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0)], f"{KEY} string, v double")
    assert quantiles.percentile_columns(df, "v", {"m": 0.5}, [KEY]).first()["m"] == 2.0
