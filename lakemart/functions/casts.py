"""Fault-tolerant text parsing: every cast of landed text is a TRY cast.

Spark runs with ANSI mode on, so a plain ``cast`` of bad text raises; these
return NULL instead, like the warehouse's TRY_TO_* family.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_decimal(c: Column | str, precision: int = 38, scale: int = 0) -> Column:
    """Text -> DECIMAL(p, s); rounds half up to ``scale``; overflow/garbage -> NULL."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def try_number(c: Column | str) -> Column:
    """One-argument TRY_TO_NUMBER / TRY_TO_DECIMAL: DECIMAL(38, 0)."""
    return try_decimal(c, 38, 0)


#: What counts as a number: no type suffix, no spelled-out infinity.
_NUMBER = r"^\s*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def try_double(c: Column | str) -> Column:
    """Text -> DOUBLE; ``1.5d`` and ``1f``, which Spark would cast, are garbage here."""
    c = _col(c)
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def try_timestamp(c: Column | str) -> Column:
    """Text -> zone-less timestamp; date-only text becomes midnight.

    A year or month alone is garbage: the text must begin with a whole date.
    """
    c = _col(c)
    return F.when(c.rlike(r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), c.try_cast("timestamp_ntz"))
