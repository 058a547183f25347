"""Column expressions shared by the operators, all of built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The ASCII white-space set stripped by trim_ws (space, tab, LF, CR, FF, VT).
WHITESPACE = " \t\n\r\f\x0b"

# The text forms a decimal number may take before it is cast.
NUMERIC_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(name: str) -> str:
    """Back-quote a column name for use in SQL text or ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def nan_to_null(c) -> Column:
    """NaN becomes NULL, so that only one notion of missing exists downstream."""
    c = col_of(c)
    return F.when(~F.isnan(c), c)


def trim_ws(c) -> Column:
    """Strip leading and trailing white space (tabs and newlines too, unlike SQL trim)."""
    return F.trim(col_of(c), F.lit(WHITESPACE))


def numeric_or_null(c) -> Column:
    """Text to double; anything that is not a plain decimal number becomes NULL.

    ``try_cast`` alone accepts forms like ``'1d'`` and ``'nan'``; the pattern guard
    keeps the result equal to a strict parse.
    """
    s = trim_ws(col_of(c).cast("string"))
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))


def clip_keep_null(c, lo, hi) -> Column:
    """Clip into [lo, hi]; NULL stays NULL (greatest/least would skip it)."""
    c = col_of(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, col_of(lo)), col_of(hi)))


def lookup(c, mapping: dict, value_type: str | None = None) -> Column:
    """Dictionary lookup as a map expression; absent or NULL keys give NULL."""
    if not mapping:
        return F.lit(None).cast(value_type or "string")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    out = F.try_element_at(F.create_map(*pairs), col_of(c))
    return out.cast(value_type) if value_type else out


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (no ANSI divide-by-zero error)."""
    return F.try_divide(col_of(a).cast("double"), col_of(b).cast("double"))


def div_or_zero(a, b) -> Column:
    """a / b with 0 for an empty denominator (the classification-report convention)."""
    return F.coalesce(safe_div(a, b), F.lit(0.0))


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude=()) -> list[str]:
    """Every non-numeric column (the reference treats all non-number dtypes as categorical)."""
    return [f.name for f in df.schema.fields if not is_numeric(f.dataType) and f.name not in exclude]


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """Apply :func:`nan_to_null` to every floating-point column."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(nan_to_null(F.col(q(f.name))).alias(f.name))
        else:
            out.append(F.col(q(f.name)))
    return df.select(*out)
