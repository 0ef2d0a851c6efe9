"""Table sinks (S11, K1-K5): write-once, replace, and the snapshot log.

A table that may be replaced is a view, ``<name>``, over one of its versions, the catalog tables
``<name>__v_<time>_<token>``. Replacing it writes a new version and then points the view at it,
one catalog operation that also changes the schema: a reader finds the old version or the new one,
never none. ``path`` puts the versions' files under a given (shared) folder; otherwise they lie in
the database's location.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.functions.text import json_list
from statmart.schemas import SNAPSHOT_LOG_SCHEMA


def safe_name(name: str) -> str:
    return name.replace("-", "_")


def table_exists(spark: SparkSession, name: str) -> bool:
    """S11."""
    return spark.catalog.tableExists(safe_name(name))


def _writer(df: DataFrame, mode: str, path: str | None, partition_by: Sequence[str] = ()):
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    return w


def create_table_once(df: DataFrame, name: str, path: str | None = None,
                      partition_by: Sequence[str] = ()) -> bool:
    """K1: create the table from ``df`` unless it exists (then nothing is written).

    Returns True when this call created the table.
    """
    name = safe_name(name)
    spark = df.sparkSession
    if table_exists(spark, name):
        return False
    version = _write_version(df, name, path, partition_by, None)
    try:
        spark.sql(f"CREATE VIEW {name} AS SELECT * FROM {version}")
    except AnalysisException as e:  # another writer was first
        if e.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
            raise
        _drop_version(spark, version)
        return False
    return True


def _write_version(df: DataFrame, name: str, path: str | None, partition_by: Sequence[str],
                   bucket_by: tuple[int, str] | None) -> str:
    """Write ``df`` as a new version of ``name``; the version's table name, which sorts by time."""
    version = f"{name}__v_{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    writer = _writer(df, "errorifexists", f"{path.rstrip('/')}/{version.split('.')[-1]}" if path else None, partition_by)
    if bucket_by is not None:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(version)
    return version


def _point_to(spark: SparkSession, name: str, version: str | None = None, query: str | None = None,
              properties: dict[str, str] | None = None) -> None:
    """Make ``name`` the given version (or a query over versions), by one catalog operation. A plain
    table of that name, made by other means, becomes a version itself first (once in its life, by a rename)."""
    if table_exists(spark, name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__v_{0:020d}_{uuid.uuid4().hex[:8]}")
    kept = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} {f'TBLPROPERTIES ({kept})' if kept else ''} "
              f"AS {query or f'SELECT * FROM {version}'}")


def versions(spark: SparkSession, name: str) -> list[str]:
    """The versions of a table, oldest first (also such as a failed replace has left)."""
    db, _, table = safe_name(name).rpartition(".")
    db = db or spark.catalog.currentDatabase()
    found = spark.catalog.listTables(db, f"{table}__v_*")
    return sorted(f"{db}.{t.name}" for t in found)


def _drop_version(spark: SparkSession, version: str) -> None:
    """Drop a version with its files (the catalog keeps those under a given path)."""
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {version}").collect()}
    spark.sql(f"DROP TABLE {version}")
    if detail.get("Type") == "EXTERNAL":
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(detail["Location"])
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def replace_table(df: DataFrame, name: str, path: str | None = None,
                  partition_by: Sequence[str] = (),
                  bucket_by: tuple[int, str] | None = None, keep_versions: int | None = None) -> bool:
    """K2/K5: create or replace the table with ``df`` (schema too).

    ``df`` is computed once, into a new version; only when that write has committed does the
    table show it. A job that fails at any step leaves the old table as it was. An empty ``df``
    leaves the old table too. ``df`` may read the table it replaces: the old version's files are
    not touched. ``keep_versions`` removes all but the newest versions, the new one included
    (at least 1; a query that still reads a removed one fails); by default all are kept.
    One writer at a time replaces a table; any number read it.
    """
    if keep_versions is not None and keep_versions < 1:
        raise ValueError("keep_versions must be at least 1")
    spark = df.sparkSession
    name = safe_name(name)
    version = _write_version(df, name, path, partition_by, bucket_by)
    if spark.table(version).isEmpty():
        _drop_version(spark, version)
        return False
    _point_to(spark, name, version)
    for old in versions(spark, name)[:-keep_versions] if keep_versions else []:
        _drop_version(spark, old)
    return True


def ensure_log_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """K3: the snapshot log with its declared schema, created if absent."""
    name = safe_name(name)
    if table_exists(spark, name):
        return
    cols = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in SNAPSHOT_LOG_SCHEMA)
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING PARQUET{location}")


def append_log(spark: SparkSession, name: str, tables: Sequence[str],
               snapshot_time: dt.datetime | Column | None = None) -> None:
    """Append one row (load time, JSON list of the tables written)."""
    if snapshot_time is None:
        stamp = F.current_timestamp()
    elif isinstance(snapshot_time, Column):
        stamp = snapshot_time
    elif snapshot_time.tzinfo is None:
        # a wall-clock time: keep it as written, whatever the process or session zone
        stamp = F.lit(snapshot_time.isoformat()).cast("timestamp_ntz")
    else:
        stamp = F.lit(snapshot_time)
    row = spark.range(1).select(stamp.cast("timestamp").alias("snapshot_time"),
                                json_list(*tables).alias("tables_updated"))
    row.write.mode("append").insertInto(safe_name(name))


def load_snapshot(spark: SparkSession, tables: dict[str, DataFrame], log: str,
                  paths: dict[str, str] | None = None,
                  snapshot_time: dt.datetime | Column | None = None) -> list[str]:
    """Replace each non-empty table, then log which ones were written."""
    paths = paths or {}
    written = [n for n, df in tables.items() if replace_table(df, n, paths.get(n))]
    if written:
        ensure_log_table(spark, log, paths.get(log))
        append_log(spark, log, [n.split(".")[-1] for n in written], snapshot_time)
    return written
