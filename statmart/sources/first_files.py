"""Name collisions decided from the file listing (U2): files that lose are never opened."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from statmart.sources.csv_files import (
    SOURCE, family_glob, first_file_per_table, literal_path, read_csv_files, with_path_keys,
)
from statmart.streaming.incremental import SLICE_FILES, list_files, slices


def read_first_files(spark: SparkSession, root: str, family: str, seasons: Sequence[str] | None = None,
                     schema: T.StructType | Mapping[str, T.DataType] | None = None,
                     file_glob: str | None = None, slice_files: int = SLICE_FILES) -> DataFrame:
    """The rows of each table name's first file (or, for players, folder) by path; no other file is read.

    The listing gives paths and sizes: a file without a byte makes no table and never wins, one with
    only a header does. The winners are read in slices, so the driver holds one slice's paths at a time.
    """
    globs = [family_glob(root, family, s, file_glob) for s in (seasons or ["*"])]
    listed = list_files(spark, globs, "*").where("size > 0").select(SOURCE)
    winners = first_file_per_table(with_path_keys(listed, family), family).select(SOURCE)
    parts = [read_csv_files(spark, [literal_path(r[SOURCE]) for r in found], schema)
             for found in slices(winners, slice_files) if found]
    if not parts:  # nothing landed: an empty frame with the schema's columns
        parts = [read_csv_files(spark, globs, schema)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return with_path_keys(rows, family)
