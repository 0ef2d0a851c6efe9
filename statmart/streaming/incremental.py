"""Incremental, idempotent ingest of landed CSV files.

A target is a folder of parquet commits, ``<target>/batch=<id>``, and a manifest,
``<target>/_manifest``, with one row for each file of a commit: path, size, modification time,
batch, number of rows, time of the commit. Writing the manifest's rows *is* the commit: readers take
only batches that it names, so a run that fails before leaves nothing visible, and running it again
loads each file once. A run compares the listing with the manifest and never scans the target:

* a file is new if no manifest row has its path, size and modification time. So a file without
  any row is remembered, and a file that was delivered again with other contents is seen;
* rows of a file's earlier version are hidden by readers (``read_target``).

Batch form (``batch_ingest``): new files are loaded in slices of about ``slice_files``, each a
commit of its own, so the driver never holds more than one slice's paths and a failed run keeps
the slices that it has committed.

Types (``infer=True``): commits keep undeclared columns as text, and the manifest holds for each file the
kinds of values that each such column has. A reader combines the kinds of the files it shows
(``target_types``), so a column widens as later commits bring other values, and narrows again when
the file that widened it is replaced. No commit is rewritten, and no values are read to decide.

Streaming form (``stream_ingest``): a ``binaryFile`` file stream lists new CSV paths (the file
contents are not read by the stream); its checkpoint remembers which files were already seen.
``trigger(availableNow=True)`` processes what has landed and stops. A micro-batch that is re-run
after a failure replaces its own folder and manifest rows, so nothing is loaded twice.

One run at a time writes to a target.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.functions.text import decoded_path
from statmart.session import materialize
from statmart.sources.csv_files import (
    CORRUPT, QUARANTINED, SOURCE, declared_types, kind_bits, literal_path, mark_quarantine, read_landed, split_marked,
    type_of_bits, typed,
)

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
LISTING = f"{SOURCE} string, size long, modified timestamp"
MANIFEST = f"{LISTING}, batch string, rows long, committed timestamp, kinds map<string, int>"
#: Files that one commit loads, about; the paths of one commit are held on the driver.
SLICE_FILES = 10_000


def list_files(spark: SparkSession, glob: str | Sequence[str], file_filter: str = "*.csv") -> DataFrame:
    """(source_file, size, modified) of the files matching ``glob`` (contents are not read); a
    glob that matches nothing gives no rows."""
    globs = [glob] if isinstance(glob, str) else list(glob)
    found = []
    for g in globs:
        try:
            found.append(spark.read.format("binaryFile").option("pathGlobFilter", file_filter).load(g).select(
                decoded_path(F.col("path")).alias(SOURCE), F.col("length").alias("size"), F.col("modificationTime").alias("modified")))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        return spark.createDataFrame([], LISTING)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.dropDuplicates([SOURCE]) if len(found) > 1 else out


# --- manifest ---------------------------------------------------------------------------------

def _folder(target: str) -> str:
    return f"{target.rstrip('/')}/_manifest"


def read_manifest(spark: SparkSession, target: str) -> DataFrame:
    """The manifest's rows; none where nothing has been committed."""
    try:
        return spark.read.schema(MANIFEST).parquet(_folder(target))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files that no commit has loaded in this version."""
    known = [SOURCE, "size", "modified"]
    return files.join(manifest.select(*known), known, "left_anti").select(*known)


def superseded(manifest: DataFrame) -> DataFrame:
    """(source_file, batch) of file versions of which a later commit has another one."""
    latest = manifest.groupBy(SOURCE).agg(
        F.max_by("batch", F.struct("committed", "batch")).alias("_latest"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return manifest.join(latest, SOURCE).where(F.col("batch") != F.col("_latest")).select(SOURCE, "batch")


def commit_files(spark: SparkSession, files: Sequence[Row], batch: str, target: str,
                 schema: T.StructType | Mapping[str, T.DataType] | None = None,
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 partition_by: Sequence[str] = (), infer: bool = False) -> int:
    """Load a slice of listed files as one commit (replacing one of the same name): first the
    rows, then their manifest rows, with ``infer`` those with the kinds of values that were written.
    Returns the number of files."""
    if not files:
        return 0
    landed = read_landed(spark, [literal_path(r[SOURCE]) for r in files], schema)
    rows = mark_quarantine(transform(landed.rows) if transform else landed.rows)
    folder = f"{target.rstrip('/')}/batch={batch}"
    rows.write.mode("overwrite").partitionBy(*partition_by, QUARANTINED).parquet(folder)
    listed = spark.createDataFrame([tuple(r) for r in files], LISTING)
    known = listed.join(landed.files, SOURCE, "left")
    if infer:
        fixed = {*declared_types(schema), CORRUPT, SOURCE, *partition_by}
        undeclared = [c for c in landed.rows.columns if c in rows.columns and c not in fixed]
        written = spark.read.schema(rows.schema).parquet(folder)  # a commit without rows has no files
        known = known.join(file_kinds(written, undeclared), SOURCE, "left")
        # a file without good rows says nothing about types
        kinds = F.coalesce("kinds", F.create_map().cast("map<string, int>"))
    else:
        kinds = F.lit(None).cast("map<string, int>")
    manifest = known.select(
        SOURCE, "size", "modified", F.lit(batch).alias("batch"),
        (F.coalesce("lines", F.lit(1)) - 1).cast("long").alias("rows"),  # all but the header
        F.current_timestamp().alias("committed"), kinds.alias("kinds"))
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{_folder(target)}/commit={batch}")
    return len(files)


def file_kinds(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(source_file, kinds): for each file the kinds of its good rows' values by column, as bits. An
    OR by file, which combines in the tasks."""
    if not columns:
        return rows.sparkSession.createDataFrame([], f"{SOURCE} string, kinds map<string, int>")
    found = rows.where(F.col(QUARANTINED).cast("int") == 0).groupBy(SOURCE).agg(
        *[F.bit_or(kind_bits(F.col(f"`{c}`"))).alias(f"_{i}") for i, c in enumerate(columns)])
    return found.select(SOURCE, F.create_map(
        *[x for i, c in enumerate(columns) for x in (F.lit(c), F.col(f"_{i}"))]).alias("kinds"))


def target_types(spark: SparkSession, target: str) -> dict[str, T.DataType]:
    """The narrowest types that hold all values of the files that a target shows, for its undeclared
    columns. None if a file with rows was loaded without ``infer``: what it holds isn't known.

    Reads the manifest only; one row a column comes to the driver.
    """
    manifest = read_manifest(spark, target)
    shown = manifest.join(superseded(manifest), [SOURCE, "batch"], "left_anti")
    if not shown.where(F.col("kinds").isNull() & (F.col("rows") > 0)).isEmpty():
        return {}
    kinds = shown.select(F.explode("kinds").alias("column", "bits")).groupBy("column").agg(F.bit_or("bits").alias("bits"))
    return {r.column: type_of_bits(r.bits) for r in kinds.collect()}


def slices(files: DataFrame, slice_files: int = SLICE_FILES) -> Iterator[list[Row]]:
    """Disjoint slices of about ``slice_files`` listed files each. A listing beyond one slice is
    written once and cut by a hash of the paths; the driver holds one slice's rows at a time."""
    first = files.take(slice_files + 1)
    if len(first) <= slice_files:
        yield first
        return
    parts = -(-files.count() // slice_files)
    dealt = materialize(files.withColumn("_slice", F.pmod(F.xxhash64(SOURCE), F.lit(parts))), "listing")
    for k in range(parts):
        yield dealt.where(F.col("_slice") == k).drop("_slice").collect()


def batch_ingest(spark: SparkSession, glob: str | Sequence[str], target: str,
                 schema: T.StructType | Mapping[str, T.DataType] | None = None,
                 file_filter: str = "*.csv", run_id: str | None = None, slice_files: int = SLICE_FILES,
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 partition_by: Sequence[str] = (), infer: bool = False) -> int:
    """Load the files, or versions of files, not yet in ``target``; returns how many."""
    files = new_files(list_files(spark, glob, file_filter), read_manifest(spark, target))
    run, loaded = run_id or uuid.uuid4().hex[:12], 0
    for k, part in enumerate(slices(files, slice_files)):
        loaded += commit_files(spark, part, f"{run}-{k:06d}", target, schema, transform, partition_by, infer)
    return loaded


def write_batch(spark: SparkSession, paths: list[str], batch_id: int, target: str,
                schema: T.StructType | Mapping[str, T.DataType] | None = None) -> None:
    """Load one micro-batch's files as commit ``stream-<n>``, replacing an earlier try: running the
    same batch again (after a failure before its commit) writes the same rows once, never twice."""
    if paths:
        commit_files(spark, list_files(spark, [literal_path(p) for p in paths], "*").collect(), f"stream-{batch_id:012d}", target, schema)


def stream_ingest(spark: SparkSession, glob: str, target: str, checkpoint: str,
                  schema: T.StructType | Mapping[str, T.DataType] | None = None,
                  file_filter: str = "*.csv", max_files_per_batch: int = 1000, infer: bool = False) -> None:
    """Load the files that landed since the last run into ``target`` (parquet folder)."""
    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # one row per new file in this micro-batch (bounded by max_files_per_batch)
        commit_files(batch.sparkSession, batch.collect(), f"stream-{batch_id:012d}", target, schema, infer=infer)

    query = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", file_filter)
             .option("maxFilesPerTrigger", max_files_per_batch)
             .load(glob)
             .select(decoded_path(F.col("path")).alias(SOURCE), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
             .writeStream.foreachBatch(load_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()


def _committed(spark: SparkSession, target: str) -> DataFrame:
    """All rows of the target's commits, with the union of all batches' columns, without rows of
    batches that were never committed and of replaced file versions."""
    manifest = read_manifest(spark, target)
    rows = spark.read.option("mergeSchema", True).parquet(target).withColumn("batch", F.col("batch").cast("string"))
    # a commit a row: prunes the folders; replaced versions are few, mostly none
    rows = rows.join(manifest.select("batch").distinct(), "batch", "left_semi")
    return rows.join(superseded(manifest), [SOURCE, "batch"], "left_anti").drop("batch")


def read_target(spark: SparkSession, target: str, infer: bool = False) -> DataFrame:
    """The target's rows that parsed, with the union of all batches' columns; with ``infer`` the
    undeclared ones as the types that all commits together ask for (``target_types``)."""
    rows = split_marked(_committed(spark, target))[0]
    types = target_types(spark, target) if infer else {}
    return rows.withColumns({c: typed(F.col(f"`{c}`"), t) for c, t in types.items() if c in rows.columns})


def read_quarantine(spark: SparkSession, target: str) -> DataFrame:
    """The target's rows that did not parse, with their raw text in ``_corrupt``."""
    return split_marked(_committed(spark, target))[1]
