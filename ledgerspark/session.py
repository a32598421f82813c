"""Session for local runs, tests and the bench. A cluster brings its own."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerspark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERSPARK_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerspark-"))
        # The JVM never compiles methods above this size; Spark then splits them.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def options(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session options for what is planned inside; one that the session has set itself stays as it is."""
    added = {k: v for k, v in wanted.items() if spark.conf.get(k, None) is None}
    for key, value in added.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in added:
            spark.conf.unset(key)
