"""Tolerant text -> number coercion (E1, E2) and typed column replacement.

All of it is plain Column expressions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A number written as text: optional sign, digits with an optional point, optional exponent,
# or inf/infinity/nan in any case, with surrounding blanks. Anything else is not a number
# (Spark's own cast would accept suffixes such as '1d' and '1f', so we check the text first).
NUMERIC_TEXT = (
    r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
)

def nan_to_null(c: Column) -> Column:
    """NaN -> NULL, so later comparisons, sorts and averages treat it as missing."""
    return F.nanvl(c, F.lit(None).cast("double"))


def text_to_double(c: Column, strict: bool = False) -> Column:
    """Text -> double. Bad text is NULL (or an error with ``strict``); 'nan' is NULL too."""
    if strict:
        return nan_to_null(c.cast("double"))
    return nan_to_null(F.when(c.rlike(NUMERIC_TEXT), c.try_cast("double")))


def to_number(df: DataFrame, name: str, strict: bool = False) -> Column:
    """Coerce one column of ``df`` the way a tolerant numeric conversion does.

    Text is parsed (bad -> NULL); floating columns get NaN -> NULL; integers, decimals and
    booleans are left as they are.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        return text_to_double(c, strict)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return nan_to_null(c)
    return c


def to_double(df: DataFrame, name: str, strict: bool = False) -> Column:
    """Like ``to_number`` but the result is always double (booleans become 0/1)."""
    return to_number(df, name, strict).cast("double")


def to_int(df: DataFrame, name: str, strict: bool = False) -> Column:
    """Integer cast that rounds (half to even) instead of truncating, and accepts '3.0'."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("int")
    if isinstance(dtype, T.BooleanType):
        return c.cast("int")
    rounded = F.bround(to_double(df, name, strict), 0)
    return rounded.cast("int") if strict else rounded.try_cast("int")


def coerce_numeric(df: DataFrame, columns: Iterable[str], strict: bool = False) -> DataFrame:
    """Coerce the listed columns that exist in ``df``; absent ones are skipped (tolerant)."""
    present = [c for c in dict.fromkeys(columns) if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: to_number(df, c, strict) for c in present})


def cast_replace(df: DataFrame, casts: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Replace columns by typed versions in place (no duplicate names, order kept)."""
    exprs = {}
    for name, target in casts.items():
        if name not in df.columns:
            continue
        if target in ("int", "integer"):
            exprs[name] = to_int(df, name, strict)
        elif target in ("double", "float"):
            exprs[name] = to_double(df, name, strict)
        else:
            exprs[name] = F.col(name).cast(target) if strict else F.col(name).try_cast(target)
    return df.withColumns(exprs) if exprs else df
