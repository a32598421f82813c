"""Shared folders for results that later stages read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.session import options
from ledgerspark.sources.files import delete

#: The shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Batches to and from Python are bounded in bytes: 10,000 texts are large buffers on both sides, and heaps that grew
#: for them stay large.
WRITING = SHUFFLES_GO | {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

#: Folders made in the innermost open scope of this thread.
_made: ContextVar[list[str] | None] = ContextVar("_made", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A machine-local folder is only used in local mode, where there is one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerspark-"))
    return spark.sparkContext.getCheckpointDir()


def stable(df: DataFrame) -> DataFrame:
    """``df`` computed once, written to the shared folder and read back.

    Later reads agree with each other, survive the loss of executors, and take
    only the columns they need. The folder goes with the scope it is made in
    (``scratch_scope``); outside of one it can go when the application ends.
    """
    path = scratch_path(df.sparkSession, "stable")
    with options(df.sparkSession, WRITING):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """New folder name under the shared folder."""
    application = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/{application}/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders made inside at the end, whether it succeeds or not.

    For work whose results are written elsewhere: no DataFrame made inside may be used later.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            delete(spark, path)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, as ``stable`` gives it; the scratch it needed on the way goes."""
    return settled_all(spark, lambda: [make()])[0]


def settled_all(spark: SparkSession, make: Callable[[], list[DataFrame]]) -> list[DataFrame]:
    """``settled`` for several frames that are made together."""
    path = scratch_path(spark, "settled")
    with scratch_scope(spark):
        made = make()
        for number, df in enumerate(made):
            with options(spark, WRITING):
                df.write.parquet(f"{path}/{number}")
    return [spark.read.schema(df.schema).parquet(f"{path}/{number}") for number, df in enumerate(made)]
