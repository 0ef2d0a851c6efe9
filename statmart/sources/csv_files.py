"""Landed CSV files -> DataFrames.

Files of one family may carry different headers (columns added, dropped or reordered
between seasons). One Spark CSV read over such files maps columns by *position*, so
values would land in the wrong column silently. Instead each landed byte is read once:

1. ``landed_lines``: one text scan writes every line with its file, the start of its block
   and a row number to the shared scratch folder;
2. ``file_headers``: the earliest non-blank line of each file's first block is its header,
   a small aggregation over the written lines; only the *distinct* headers come to the driver;
3. headers are joined back to the lines by file, and each line is parsed by ``from_csv``
   with the schema of its own header: a column absent from a file is NULL, never shifted.

Types come from ``schema`` or, with ``infer=True``, from all values of a column: the kinds of
its values are combined over all files (``infer_types``), never a sample of them.

Rows that do not parse against the schema keep their raw text in ``_corrupt`` (PERMISSIVE
mode) and are split off as quarantine instead of failing the load or being dropped.
"""

from __future__ import annotations

import csv
import io
import re
import warnings
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.functions.text import (
    before_first_dot, clean_identifier, dashes_to_underscores, decoded_path, file_name,
    parent_folder,
)
from statmart.session import materialize, settled

CORRUPT = "_corrupt"
SOURCE = "source_file"
#: Files whose headers may come to the driver; beyond that only the distinct headers do.
HEADERS = 10_000

# Family -> (folder under the season, file glob inside it, how the entity is named).
FAMILIES: dict[str, tuple[str, str, str]] = {
    "gw": ("gws", "*.csv", "stem"),
    "players": ("players", "*/gw.csv", "folder"),
    "understat": ("understat", "*.csv", "stem"),
}
TABLE_PREFIX = {"gw": "gw", "players": "player", "understat": "understat"}


def literal_path(path: str) -> str:
    """A concrete file path made safe to pass where Spark expects a glob pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def parse_header(line: str) -> list[str]:
    """Column names of a CSV header line (quotes honoured); repeats get '.1', '.2'..."""
    names = next(csv.reader(io.StringIO(line)))
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            out.append(f"{n}.{seen[n]}")
        else:
            seen[n] = 0
            out.append(n)
    return out


def landed_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame | None:
    """(value, source_file, _start, _row) of all lines, written once; None where nothing landed.

    ``_row`` grows along each file's block, so the least one of a first block is its first line.
    """
    try:
        lines = spark.read.text(paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no files under {paths!r}")
        return None
    rows = lines.select("value", decoded_path(F.col("_metadata.file_path")).alias(SOURCE),
                        F.col("_metadata.file_block_start").alias("_start"),
                        F.monotonically_increasing_id().alias("_row"))
    return materialize(rows.where(F.trim("value") != ""), "landed-lines")


def file_headers(lines: DataFrame) -> DataFrame:
    """(source_file, header, _header_row, lines): the first non-blank line of every file, and how
    many non-blank lines it has."""
    first = F.when(F.col("_start") == 0, F.col("_row"))
    return lines.groupBy(SOURCE).agg(F.min_by("value", first).alias("header"), F.min(first).alias("_header_row"),
                                     F.count(F.lit(1)).alias("lines"))


def _schema_for(columns: Sequence[str], types: Mapping[str, T.DataType] | None) -> T.StructType:
    types = types or {}
    fields = [T.StructField(c, types.get(c, T.StringType()), True) for c in columns]
    return T.StructType(fields + [T.StructField(CORRUPT, T.StringType(), True)])


def declared_types(schema: T.StructType | Mapping[str, T.DataType] | None) -> dict[str, T.DataType]:
    if schema is None:
        return {}
    if isinstance(schema, T.StructType):
        return {f.name: f.dataType for f in schema.fields}
    return dict(schema)


def _empty(spark: SparkSession, types: Mapping[str, T.DataType]) -> DataFrame:
    fields = [T.StructField(n, t) for n, t in types.items()]
    return spark.createDataFrame([], T.StructType(
        fields + [T.StructField(CORRUPT, T.StringType()), T.StructField(SOURCE, T.StringType())]))


def _field(parsed: Sequence[tuple[Column, Sequence[str]]], name: str) -> Column:
    """A column from whichever parsed line holds it (the others are NULL)."""
    found = [line.getField(name) for line, columns in parsed if name in columns]
    return F.coalesce(*found) if len(found) > 1 else found[0]


def _parsed_lines(lines: DataFrame, headers: DataFrame, distinct: Sequence[str],
                  types: Mapping[str, T.DataType], options: Mapping[str, str] | None) -> DataFrame:
    """Lines other than headers, parsed by their own file's header."""
    settings = {"mode": "PERMISSIVE", "quote": '"', "escape": '"',  # doubled quotes, as common tools write
                "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    # one row a file: broadcast when proven small, else a shuffle join (AQE splits a large file)
    rows = lines.join(headers, SOURCE).where(F.col("_row") != F.col("_header_row"))
    structs, parsed = {}, []
    for k, header in enumerate(distinct):
        schema = _schema_for(parse_header(header), types)
        line = F.from_csv("value", _ddl(schema), settings)
        structs[f"_line{k}"] = line if len(distinct) == 1 else F.when(F.col("header") == header, line)
        parsed.append((F.col(f"_line{k}"), [f.name for f in schema.fields]))
    names = list(dict.fromkeys(c for _, columns in parsed for c in columns if c != CORRUPT))
    ordered = [c for c in types if c in names] + [c for c in names if c not in types]
    return rows.select(SOURCE, *[c.alias(n) for n, c in structs.items()]).select(
        *[_field(parsed, c).alias(c) for c in [*ordered, CORRUPT]], SOURCE)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


class Landed(NamedTuple):
    """Parsed rows of landed files, and (source_file, lines) of the files that hold a line."""

    rows: DataFrame
    files: DataFrame


def read_landed(spark: SparkSession, paths: str | Sequence[str],
                schema: T.StructType | Mapping[str, T.DataType] | None = None,
                options: Mapping[str, str] | None = None, infer: bool = False) -> Landed:
    """``read_csv_files`` with the files' numbers of lines (rows are one less: the header)."""
    types = declared_types(schema)
    lines = landed_lines(spark, paths)
    if lines is None:
        return Landed(_empty(spark, types), spark.createDataFrame([], f"{SOURCE} string, lines long"))
    # a row a file: on the driver while they are few, beyond that only the distinct headers are
    headers = settled(file_headers(lines), "landed-headers", HEADERS)
    distinct = sorted(r[0] for r in headers.select("header").distinct().toLocalIterator())
    if not distinct:
        return Landed(_empty(spark, types), headers.select(SOURCE, "lines"))
    rows = _parsed_lines(lines, headers.drop("lines"), distinct, types, options)
    return Landed(with_inferred_types(rows, known=types) if infer else rows, headers.select(SOURCE, "lines"))


def read_csv_files(spark: SparkSession, paths: str | Sequence[str],
                   schema: T.StructType | Mapping[str, T.DataType] | None = None,
                   options: Mapping[str, str] | None = None, infer: bool = False) -> DataFrame:
    """Read CSV files whose headers may differ; columns are matched by name.

    ``schema`` gives types by column name. Absent names are read as text, or with ``infer``
    as the narrowest type that holds all their values. The result has the union of all
    columns, ``source_file`` and ``_corrupt`` (NULL for good rows).
    """
    return read_landed(spark, paths, schema, options, infer).rows


# --- type inference ---------------------------------------------------------------------------

#: Texts that stand for a missing value in the source's reader.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
           "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

#: The kinds of values, as bits: the kinds of a column are the OR of those of its values, so
#: partial results of tasks and files combine in any order.
INTEGER, REAL, TIME, TRUTH, TEXT = 1, 2, 4, 8, 16
_TIME = r"\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?"


def present(value: Column) -> Column:
    """A text value, NULL where it stands for a missing one."""
    return F.when(~F.trim(value).isin(MISSING), value)


def kind_bits(value: Column) -> Column:
    """The kind of one text value as a bit (0 for a missing one)."""
    text = F.trim(value)
    return (F.when(value.isNull() | text.isin(MISSING), 0)
            .when(text.rlike(r"^[+-]?\d+$"), F.when(text.try_cast("bigint").isNotNull(), INTEGER).otherwise(REAL))
            .when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$") | F.lower(text).rlike(r"^[+-]?inf(inity)?$"), REAL)
            .when(text.rlike(f"^{_TIME}$") & text.try_cast("timestamp_ntz").isNotNull(), TIME)
            .when(F.lower(text).isin("true", "false"), TRUTH)
            .otherwise(TEXT))


def type_of_bits(bits: int | None) -> T.DataType:
    """The narrowest type for the kinds seen; a column without any value is text."""
    if bits in (INTEGER, TIME, TRUTH):
        return {INTEGER: T.LongType(), TIME: T.TimestampNTZType(), TRUTH: T.BooleanType()}[bits]
    return T.DoubleType() if bits in (REAL, REAL | INTEGER) else T.StringType()


def infer_types(df: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    """Types for text columns from all their values: one aggregation, one row comes back."""
    if not columns:
        return {}
    kinds = df.agg(*[F.bit_or(kind_bits(F.col(f"`{c}`"))).alias(str(i)) for i, c in enumerate(columns)]).first()
    return {c: type_of_bits(kinds[i]) for i, c in enumerate(columns)}


def typed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return present(value)
    text = F.trim(value)
    if isinstance(kind, T.DoubleType):  # the cast reads 'inf' and 'infinity' in one form each
        text = F.regexp_replace(F.lower(text), "inf(inity)?$", "Infinity")
    return F.when(~F.trim(value).isin(MISSING), text.try_cast(kind))


def with_inferred_types(df: DataFrame, known: Mapping[str, T.DataType] = ()) -> DataFrame:
    """Columns not in ``known`` as the type that all their values have; missing texts are NULL.
    Rows that don't have their header's number of fields say nothing about types."""
    columns = [c for c in df.columns if c not in known and c not in (CORRUPT, SOURCE)]
    types = infer_types(df.where(F.col(CORRUPT).isNull()), columns)
    return df.withColumns({c: typed(F.col(f"`{c}`"), t) for c, t in types.items()})


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``_corrupt``, quarantined rows with their raw text).

    A line is parsed as a whole, so what is bad does not depend on the columns a query reads.
    """
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.where(F.col(CORRUPT).isNotNull())
    return good, bad


QUARANTINED = "_quarantined"


def write_bronze(df: DataFrame, path: str, mode: str = "overwrite") -> tuple[DataFrame, DataFrame]:
    """Write a raw read once, every column parsed, partitioned by ``_quarantined``; return
    (good, quarantined) read back with partition pruning."""
    mark_quarantine(df).write.mode(mode).partitionBy(QUARANTINED).parquet(path)
    return split_marked(df.sparkSession.read.parquet(path))


def mark_quarantine(df: DataFrame) -> DataFrame:
    """Add the flag by which bronze datasets are partitioned: 1 for rows that did not parse."""
    return df.withColumn(QUARANTINED, F.col(CORRUPT).isNotNull().cast("int"))


def split_marked(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) of a dataset written with the flag; each reads its own folders."""
    flag = F.col(QUARANTINED).cast("int")
    return df.where(flag == 0).drop(QUARANTINED, CORRUPT), df.where(flag == 1).drop(QUARANTINED)


# --- landed folder layouts --------------------------------------------------------------------

def family_glob(root: str, family: str, season: str = "*", file_glob: str | None = None) -> str:
    """``<root>/data/<season>/<folder>/<files>``; a season other than '*' prunes the listing."""
    if family not in FAMILIES:
        raise ValueError(f"unknown data family {family!r}; known: {sorted(FAMILIES)}")
    folder, files, _ = FAMILIES[family]
    return f"{root.rstrip('/')}/data/{season}/{folder}/{file_glob or files}"


def source_table_name(family: str, season: Column, path: Column) -> Column:
    """Name the source gives a file's table: ``<prefix>_<season>_<entity>`` with '-' -> '_'.

    gw: file name before the first dot (not cleaned); players: the player's folder name,
    cleaned to [a-zA-Z0-9_]; understat: file name before the first dot, cleaned.
    """
    _, _, entity_rule = FAMILIES[family]
    if entity_rule == "folder":
        entity = clean_identifier(parent_folder(path))
    elif family == "gw":
        entity = before_first_dot(file_name(path))
    else:
        entity = clean_identifier(before_first_dot(file_name(path)))
    name = F.concat_ws("_", F.lit(TABLE_PREFIX[family]), dashes_to_underscores(season), entity)
    return dashes_to_underscores(name)


def with_path_keys(df: DataFrame, family: str) -> DataFrame:
    """Add ``season``, ``entity`` and ``table_name`` derived from ``source_file``."""
    folder, _, rule = FAMILIES[family]
    path = F.col(SOURCE)
    season = F.regexp_extract(path, rf"/data/([^/]+)/{folder}/", 1)
    entity = parent_folder(path) if rule == "folder" else before_first_dot(file_name(path))
    return df.withColumns({"season": season, "entity": entity,
                           "table_name": source_table_name(family, season, path)})


def read_family(spark: SparkSession, root: str, family: str,
                seasons: Sequence[str] | None = None,
                schema: T.StructType | Mapping[str, T.DataType] | None = None,
                file_glob: str | None = None) -> DataFrame:
    """All files of one family (optionally only some seasons) as one DataFrame."""
    globs = [family_glob(root, family, s, file_glob) for s in (seasons or ["*"])]
    return with_path_keys(read_csv_files(spark, globs, schema), family)


def first_file_per_table(df: DataFrame, family: str = "gw") -> DataFrame:
    """When cleaned names collide, keep only the rows of the first source by path order.

    The source is the file, or for a family named by folder (players) the folder, so
    every file of the winning folder is kept.
    """
    from statmart.functions.lookup import join_lookup
    by_folder = FAMILIES[family][2] == "folder"
    unit = F.regexp_replace(F.col(SOURCE), "/[^/]*$", "") if by_folder else F.col(SOURCE)
    keyed = df.withColumn("_unit", unit)
    # one row per table name: broadcast when proven small, else a shuffle join (AQE splits
    # a source that holds most of the rows)
    firsts = keyed.groupBy("table_name").agg(F.min("_unit").alias("_unit"))
    return join_lookup(keyed, firsts, ["table_name", "_unit"], "left_semi").drop("_unit")
