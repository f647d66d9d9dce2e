"""Python workers of a local session import this package from where the driver has it."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def share_package(spark: SparkSession) -> None:
    """Put the repository on the workers' import path; on a cluster the package is installed, and the path is harmless."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([ROOT, *paths])


ROWS, BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def records_per_batch(spark: SparkSession, records: int, size: int | None = None) -> Iterator[None]:
    """Arrow batches of at most so many rows for the jobs that run inside, where single rows are large; with ``size``, that end where they have so many bytes."""
    wanted = {ROWS: records} | ({} if size is None else {BYTES: size})
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
