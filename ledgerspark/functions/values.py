"""Column rules shared by the jobs: defaults, switches, currency, text and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerspark.constants import CURRENCY_SOL, MISSING_ID


def or_missing(value: Column) -> Column:
    return F.coalesce(value, F.lit(MISSING_ID))


def switch_at(period: Column, cut, before: Column, after: Column) -> Column:
    """``before`` for periods under ``cut``, else ``after`` (also for NULL periods)."""
    return F.when(period < F.lit(cut), before).otherwise(after)


def original_currency(currency: Column, rate: Column, usd: Column) -> Column:
    """USD amount in the original currency, rounded to cents row by row for SOL."""
    return F.when(currency == CURRENCY_SOL, F.round(rate * usd, 2)).otherwise(usd)


def normal_text(value: Column) -> Column:
    return F.trim(F.upper(value))


def iso_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def correlation_id(*parts: Column) -> Column:
    """Same id for the same parts, so a replayed message keeps its id."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def same_key(*columns) -> Column:
    """Composite key on which an equi-join also matches NULL with NULL.

    A struct is never NULL itself and its NULL fields compare as equal, so the
    join stays one plain hash key per side.
    """
    return F.struct(*columns)
