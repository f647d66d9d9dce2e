"""A folder every executor can reach, for tables that cut lineage or land between jobs."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; without it, in local mode alone, a folder of the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared root that no other run uses, grouped by application for later removal."""
    path = f"{shared_root(spark)}/hourloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if (owned := _owned.get()) is not None:
        owned.append(path)
    return path


@contextmanager
def work_scope() -> Iterator[list[str]]:
    """Own the work folders made inside and remove them at the end, also after a failure.

    For jobs whose results are read back from tables of their own: nothing that is used later may depend on a folder of the
    scope. Scopes nest; an inner one owns its folders alone.
    """
    owned: list[str] = []
    token = _owned.set(owned)
    try:
        yield owned
    finally:
        _owned.reset(token)
        for path in owned:
            remove_folder(path)


def remove_folder(path: str) -> None:
    """Delete a folder if it is there, on any store that Arrow knows; elsewhere it stays, with a warning."""
    try:
        store, inner = fs.FileSystem.from_uri(path if "://" in path else Path(path.removeprefix("file:")).absolute().as_uri())
        if store.get_file_info(inner).type == fs.FileType.Directory:
            store.delete_dir(inner)
    except (pa.ArrowException, OSError) as problem:
        log.warning("work folder %s stays: %s", path, problem)


def settle(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What follows reads the result instead of computing it again, survives lost
    executors, and lets Spark plan with the real size.
    """
    path = fresh_folder(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_narrow(df: DataFrame, name: str) -> DataFrame:
    """``settle`` for rows of a few numbers: a sixteenth of the shuffle's partitions write them, four at least.

    A partition that adaptive execution has not merged with others is a file of its own, and for each file on a local disk
    Hadoop starts several processes (``chmod``). The partitions of a writer are taken one after another, so it needs no more memory.
    """
    return settle(df.coalesce(max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)), name)


def settle_counted(df: DataFrame, name: str, where: Column | None = None) -> tuple[DataFrame, int]:
    """``settle``, and the number of rows (for which ``where`` holds), observed while they are written: no further job."""
    seen = Observation()
    rows = settle(df.observe(seen, F.count(F.lit(1) if where is None else F.when(where, 1)).alias("n")), name)
    return rows, seen.get["n"]


def ensure_checkpoints(spark: SparkSession) -> None:
    """Iterative fits checkpoint to the shared folder; set it where the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/checkpoints")
