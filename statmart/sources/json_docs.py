"""Landed JSON snapshot documents -> record rows.

A snapshot document is ``{"elements": [{...}, ...], "teams": [{...}, ...]}``. A single
pretty-printed document must be read with ``multi_line=True`` and is one task per file:
read large ones with ``json_split.read_records``, or land them as JSON Lines (one document per
line, each holding a slice of the records) so Spark splits the files across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snapshot_schema(elements: T.StructType, teams: T.StructType | None = None) -> T.StructType:
    fields = [T.StructField("elements", T.ArrayType(elements))]
    if teams is not None:
        fields.append(T.StructField("teams", T.ArrayType(teams)))
    return T.StructType(fields)


def read_documents(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   multi_line: bool = True) -> DataFrame:
    """Documents as rows. Give ``schema`` at scale: inference is an extra full pass."""
    reader = spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def explode_records(docs: DataFrame, field: str = "elements") -> DataFrame:
    """One row per record of the array ``field``; keys absent from a record are NULL."""
    return docs.select(F.explode(F.col(field)).alias("_r")).select("_r.*")
