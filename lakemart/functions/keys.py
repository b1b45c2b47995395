"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source system's key macro) -------------
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
# --------------------------------------------------------------------------


def surrogate_key(*cols: Column | str, nulls_as_empty: bool = False) -> Column:
    """MD5 hex of the fields cast to text, NULLs replaced by a token, joined by '-'."""
    token = F.lit("" if nulls_as_empty else SURROGATE_NULL_TOKEN)
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), token)
             for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))
