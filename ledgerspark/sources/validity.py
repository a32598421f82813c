"""A version table laid out by the time each version holds, so that an as-of read is a filter.

The intervals are made once, when the table is published; reading it as of a time then
compares two columns and needs neither a window nor a sort, and filters on the columns the
table is laid out by leave out whole folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerspark.operators.ordered import RANGE_ROWS, with_next
from ledgerspark.sources.publish import publish_version, read_current

# Rows a task sorts: versions are whole rows of a table, wider than what totals run over.
VERSION_ROWS = RANGE_ROWS // 4
VALID_FROM, VALID_TO = "valid_from", "valid_to"


def with_validity(
    versions: DataFrame, keys: list[str], version_ts: str, tie_breakers: tuple[str, ...] = (),
    range_rows: int = VERSION_ROWS,
) -> DataFrame:
    """Add the time from which a row is the current one of its key, and the one at which the next takes over.

    ``valid_to`` is NULL for the last version. Of versions of one time the last by
    ``tie_breakers`` holds; the others hold for no time at all and are left out.
    Versions without a time never hold.
    """
    timed = versions.where(F.col(version_ts).isNotNull())
    spans = with_next(timed, keys, [version_ts, *tie_breakers], version_ts, VALID_TO, range_rows)
    return spans.withColumn(VALID_FROM, F.col(version_ts)).where(
        F.col(VALID_TO).isNull() | (F.col(VALID_FROM) < F.col(VALID_TO)))


def valid_at(rows: DataFrame, as_of: Column) -> DataFrame:
    """Rows current at ``as_of``; both comparisons reach the scan."""
    return rows.where(
        (F.col(VALID_FROM) <= as_of) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > as_of)))


def publish_validity(
    versions: DataFrame, keys: list[str], version_ts: str, path: str, layout: dict[str, Column],
    tie_breakers: tuple[str, ...] = (),
) -> DataFrame:
    """Publish ``versions`` with their intervals, in folders by the columns of ``layout``.

    The intervals are made in ranges of the keys. A key that is also a column of ``layout`` comes
    first in their order, so the rows of a folder come together and are written where they are.
    """
    laid_out = [k for k in keys if k in layout]
    spans = with_validity(versions, [*laid_out, *[k for k in keys if k not in laid_out]], version_ts, tie_breakers)
    return publish_version(spans.withColumns(layout), path, list(layout), laid_out=bool(laid_out))


def read_validity(spark: SparkSession, path: str, as_of: Column, schema: StructType | None = None) -> DataFrame:
    return valid_at(read_current(spark, path, schema), as_of)
