"""Text cleaning expressions: null tokens, delimiter-aware title case, zip codes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# --- fixed values (must equal the source system's behaviour) -------------
# Text that the bronze load treats as SQL NULL.
NULL_TOKENS = ("NULL", "null", "None", "")
# Characters after which a title-cased word starts: whitespace and
#   ! ? @ " ^ # $ & ~ _ , . : ; + - * % / | \ [ ] ( ) { } < >
TITLE_DELIMITERS = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""
# --------------------------------------------------------------------------

_DELIM_CLASS = "([" + TITLE_DELIMITERS + "])"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_token(c: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """NULL when the text equals one of ``tokens``; otherwise the text."""
    c = _col(c)
    return F.when(~c.isin(*tokens), c)


def normalize_null_tokens(df: DataFrame, columns: Iterable[str] | None = None,
                          tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Apply :func:`null_if_token` to every (or the given) string column."""
    tokens = tuple(tokens)
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    columns = set(columns)
    return df.select(*[
        null_if_token(F.col(f"`{n}`"), tokens).alias(n) if n in columns else F.col(f"`{n}`")
        for n in df.columns
    ])


def initcap_delim(c: Column | str) -> Column:
    """Title case where a word starts after whitespace *or* punctuation.

    ``credit_card`` -> ``Credit_Card``; ``d'oeste-do sul`` -> ``D'oeste-Do Sul``.
    Spark's ``initcap`` only breaks words at spaces, so a space is slipped
    in after every delimiter, ``initcap`` runs, and exactly that space is
    taken out again.  Everything stays a JVM expression (whole-stage codegen).
    """
    spaced = F.regexp_replace(_col(c), _DELIM_CLASS, "$1 ")
    return F.regexp_replace(F.initcap(spaced), _DELIM_CLASS + " ", "$1")


def title_or_default(c: Column | str, default: str) -> Column:
    """``INITCAP(TRIM(COALESCE(c, default)))``."""
    return initcap_delim(F.trim(F.coalesce(_col(c), F.lit(default))))


def upper_or_default(c: Column | str, default: str) -> Column:
    """``UPPER(TRIM(COALESCE(c, default)))``."""
    return F.upper(F.trim(F.coalesce(_col(c), F.lit(default))))


def zip_prefix(c: Column | str, width: int = 5) -> Column:
    """``LPAD(TRIM(c), width, '0')``: pads short codes, truncates long ones."""
    return F.lpad(F.trim(_col(c)), width, "0")
