"""Top-1 row per key (``QUALIFY ROW_NUMBER() OVER (...) = 1``).

Catalyst plans ``row_number() = 1`` as a *partial* WindowGroupLimit before the
shuffle and a final one after it, so every map task forwards at most one row
per key.  A key holding a third of the input therefore costs one row per map
partition in the exchange, not a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

_RN = "__lakemart_rn"


def _sortable(df: DataFrame, exclude: set[str]) -> list[Column]:
    return [F.col(f"`{f.name}`").asc_nulls_first() for f in df.schema.fields
            if f.name not in exclude and not isinstance(f.dataType, MapType)]


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                 tiebreak: bool = True) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    With ``tiebreak`` every remaining column is appended ascending (NULLs
    first) so the choice is total and repeatable across engines and reruns.
    """
    keys = list(keys)
    order = list(order)
    if tiebreak:
        order += _sortable(df, set(keys))
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts_col: str,
                   tiebreak: bool = True) -> DataFrame:
    """Newest row per key by ``ts_col``; a NULL timestamp counts as newest."""
    return top1_per_key(df, keys, [F.col(ts_col).desc_nulls_first()], tiebreak)
