"""CSV export of a result (K6).

Written by the executors as part files under one folder (one file per task). A single
file is only produced on request (``single_file=True``), which funnels the whole result
through one task; use it for small results only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Header line, RFC-4180 quoting (quotes doubled), NULL as an empty field, UTF-8;
    booleans written as True/False, as the source's export writes them."""
    bools = {f.name: F.when(F.col(f.name), F.lit("True")).when(~F.col(f.name), F.lit("False"))
             for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)}
    out = df.withColumns(bools) if bools else df
    out = out.coalesce(1) if single_file else out
    (out.write.mode("overwrite")
     .option("header", True)
     .option("quote", '"')
     .option("escape", '"')
     .option("encoding", "UTF-8")
     .csv(path))
    return path
