"""Aggregate expressions that score a forecast against the outcome."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def smape_term(actual: Column, predicted: Column) -> Column:
    """Symmetric percentage error of one row; two zeros are a perfect hit."""
    size = (F.abs(actual) + F.abs(predicted)) / 2
    return F.when(size == 0, 0.0).otherwise(F.try_divide(F.abs(actual - predicted), size) * 100)


def r_squared(sse: Column, sst: Column, n: Column) -> Column:
    """``1 - SSE/SST``; constant outcomes score 1 when exact and 0 otherwise."""
    return (
        F.when(n < 2, None)
        .when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(sse, sst))
    )


def score_columns(actual: Column, predicted: Column, where: Column | None = None, prefix: str = "") -> list[Column]:
    """mae, rmse, smape, r2 and n_samples in one pass; ``var_pop`` merges moments stably."""

    def only(c: Column) -> Column:
        return c if where is None else F.when(where, c)

    error = only(actual - predicted)
    n = F.count(error)
    sse = F.sum(error * error)
    sst = F.var_pop(only(actual)) * n
    return [
        F.avg(F.abs(error)).alias(f"{prefix}mae"),
        F.sqrt(F.avg(error * error)).alias(f"{prefix}rmse"),
        F.avg(only(smape_term(actual, predicted))).alias(f"{prefix}smape"),
        r_squared(sse, sst, n).alias(f"{prefix}r2"),
        n.alias(f"{prefix}n_samples"),
    ]
