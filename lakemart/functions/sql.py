"""The scalar helpers as SQL functions, for users who write Spark SQL.

These are SQL-bodied functions (``CREATE FUNCTION ... RETURN expr``): Catalyst
inlines the body into the calling plan, so they cost the same as the Column
versions -- no Python, whole-stage codegen intact.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakemart.functions.keys import SURROGATE_NULL_TOKEN, SURROGATE_SEPARATOR
from lakemart.functions.text import NULL_TOKENS, TITLE_DELIMITERS


def _lit(text: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sk_part(arg: str) -> str:
    return f"coalesce(CAST({arg} AS STRING), {_lit(SURROGATE_NULL_TOKEN)})"


def sql_functions() -> dict[str, str]:
    d = _lit("([" + TITLE_DELIMITERS + "])")
    d_space = _lit("([" + TITLE_DELIMITERS + "]) ")
    tokens = ", ".join(_lit(t) for t in NULL_TOKENS)
    sep = _lit(SURROGATE_SEPARATOR)
    return {
        "initcap_delim": f"(s STRING) RETURNS STRING RETURN "
                         f"regexp_replace(initcap(regexp_replace(s, {d}, '$1 ')), {d_space}, '$1')",
        "zip_prefix": "(s STRING) RETURNS STRING RETURN lpad(trim(s), 5, '0')",
        "null_if_token": f"(s STRING) RETURNS STRING RETURN CASE WHEN s IN ({tokens}) THEN NULL ELSE s END",
        "surrogate_key": f"(a STRING) RETURNS STRING RETURN md5({_sk_part('a')})",
        "surrogate_key2": f"(a STRING, b STRING) RETURNS STRING RETURN "
                          f"md5(concat_ws({sep}, {_sk_part('a')}, {_sk_part('b')}))",
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions as temporary SQL functions of this session."""
    for name, body in sql_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(sql_functions())
