"""Calendar attributes of a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def day_of_week0(d: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(d) - 1


def month_abbr(d: Column) -> Column:
    return F.date_format(d, "MMM")


def day_abbr(d: Column) -> Column:
    return F.date_format(d, "EEE")


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")
