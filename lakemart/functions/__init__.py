from lakemart.functions.calendar import date_key, day_abbr, day_of_week0, month_abbr, year_month
from lakemart.functions.casts import try_decimal, try_double, try_number, try_timestamp
from lakemart.functions.keys import SURROGATE_NULL_TOKEN, surrogate_key
from lakemart.functions.text import (NULL_TOKENS, initcap_delim, normalize_null_tokens,
                                     null_if_token, title_or_default, upper_or_default,
                                     zip_prefix)

__all__ = [
    "NULL_TOKENS", "SURROGATE_NULL_TOKEN", "date_key", "day_abbr", "day_of_week0",
    "initcap_delim", "month_abbr", "normalize_null_tokens", "null_if_token",
    "surrogate_key", "title_or_default", "try_decimal", "try_double", "try_number",
    "try_timestamp", "upper_or_default", "year_month", "zip_prefix",
]
