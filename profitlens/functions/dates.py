"""Date expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def month_of(moment: Column) -> Column:
    """``yyyy-MM`` text."""
    return F.substring(moment.cast("date").cast("string"), 1, 7)


def month_number(month: Column) -> Column:
    """Months since year 0 for a ``yyyy-MM`` text, for differences between months."""
    return F.substring(month, 1, 4).cast("bigint") * 12 + F.substring(month, 6, 2).cast("bigint")


def whole_days(start: Column, end: Column) -> Column:
    """Full days from ``start`` to ``end``, rounded down: six hours early is -1."""
    seconds = (end - start).cast("interval second").cast("decimal(20,6)").cast("double")
    return F.floor(seconds / SECONDS_PER_DAY).cast("bigint")


def parsed_moment(text: Column, formats: tuple[str, ...]) -> Column:
    """First format that reads the text; null when none does."""
    tried = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tried)
