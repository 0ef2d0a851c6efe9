"""Name clean-up and small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_identifier(c: Column) -> Column:
    """Every character outside [a-zA-Z0-9] becomes '_'."""
    return F.regexp_replace(c, r"[^a-zA-Z0-9]", "_")


def dashes_to_underscores(c: Column) -> Column:
    return F.translate(c, "-", "_")


def before_first_dot(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def table_name(prefix: str, season: Column, name: Column) -> Column:
    """``<prefix>_<season with _>_<name>``."""
    return F.concat_ws("_", F.lit(prefix), dashes_to_underscores(season), name)


def json_list(*items: str) -> Column:
    """A JSON array of text items."""
    return F.to_json(F.array(*[F.lit(i) for i in items]))


def format_2f(c: Column) -> Column:
    """Display text with two decimals, the exact binary value rounded half to even; missing shows
    as 'nan' (keep the number itself in the data)."""
    value = c.cast("double")
    infinite = F.when(value == float("inf"), "inf").when(value == float("-inf"), "-inf")
    return (F.when(value.isNull() | F.isnan(value), "nan").when(infinite.isNotNull(), infinite)
            .otherwise(F.replace(F.call_function("format_number", value, F.lit("0.00")), F.lit(","), F.lit(""))))


def option_text(c: Column) -> Column:
    """Text form of a value for an options list; missing shows as 'nan'."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def decoded_path(uri: Column) -> Column:
    """File path from Spark's URI form (``_metadata.file_path``): %XX escapes decoded, a
    literal '+' kept (form decoding would turn it into a blank)."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)
