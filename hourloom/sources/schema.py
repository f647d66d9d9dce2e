"""Cast to, and check against, the schema contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.config import CONTRACT, ColumnRule

INTEGRAL = {"tinyint", "smallint", "int", "bigint"}
FRACTIONAL = {"float", "double"}


class SchemaError(ValueError):
    """A required column is absent."""


def _require(df: DataFrame, contract: Sequence[ColumnRule]) -> None:
    absent = [r.name for r in contract if r.required and r.name not in df.columns]
    if absent:
        raise SchemaError(f"required columns missing: {absent}")


def enforce_schema(df: DataFrame, contract: Sequence[ColumnRule] = CONTRACT) -> DataFrame:
    """Cast contract columns; columns outside the contract pass through."""
    _require(df, contract)
    present = [r for r in contract if r.name in df.columns]
    return df.withColumns({r.name: F.col(r.name).cast(r.dtype) for r in present}) if present else df


def schema_findings(df: DataFrame, contract: Sequence[ColumnRule] = CONTRACT) -> list[tuple[str, str, str, str]]:
    """(column, severity, expected, found) for absent required columns and number-kind mismatches."""
    found = dict(df.dtypes)
    out = []
    for r in contract:
        actual = found.get(r.name)
        if actual is None:
            if r.required:
                out.append((r.name, "error", r.dtype, "absent"))
        elif (r.dtype in INTEGRAL and actual not in INTEGRAL) or (r.dtype in FRACTIONAL and actual not in FRACTIONAL):
            out.append((r.name, "warning", r.dtype, actual))
    return out


def findings_frame(spark: SparkSession, findings: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(findings), "column string, severity string, expected string, found string")


def validate_schema(df: DataFrame, contract: Sequence[ColumnRule] = CONTRACT) -> list[tuple[str, str, str, str]]:
    """Raise for absent required columns, return the warnings."""
    _require(df, contract)
    return schema_findings(df, contract)
