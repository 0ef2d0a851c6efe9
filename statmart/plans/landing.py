"""Land the driver's tables as source files (CSV folders, JSON documents) for the ingest
queries. All output goes under the session's shared checkpoint folder."""

from __future__ import annotations

import contextlib
import tempfile
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.session import scratch_path


def land_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write ``df`` as CSV part files with a header line (as files land from a source)."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def land_named(df: DataFrame, path: str) -> None:
    """CSV files ``part-<n>.csv``: landing again under the same path delivers files of the same
    names with other contents (as many as ``df`` has partitions)."""
    spark = df.sparkSession
    land_csv(df, incoming := fresh(spark, "incoming"))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    file_system = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    file_system.mkdirs(hadoop.Path(path))
    names = sorted(f.getPath().getName() for f in file_system.listStatus(hadoop.Path(incoming)))
    for k, name in enumerate(n for n in names if n.startswith("part-")):
        place = hadoop.Path(f"{path}/part-{k:05d}.csv")
        file_system.delete(place, False)
        file_system.rename(hadoop.Path(f"{incoming}/{name}"), place)


def land_text(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Append a non-CSV file (``part-*.txt``) into a landing folder."""
    df.select(F.col(df.columns[0]).cast("string")).write.mode("append").text(path)


def land_lines(lines: DataFrame, header: str, path: str) -> None:
    """CSV files whose lines (column ``value``) are written as they are under a header."""
    name = header.replace('"', "")
    lines.select(F.col("value").alias(name)).write.mode("append").option("header", True).option("quote", "\u0000").option(
        "escape", "\u0000").option("sep", "\u0001").csv(path)


def land_document(spark: SparkSession, arrays: dict[str, DataFrame], path: str) -> None:
    """One JSON document over many lines, ``{"<name>": [<record>, ...], ...}``, in one file."""
    document_lines(arrays).write.text(path)


def document_lines(arrays: dict[str, DataFrame]) -> DataFrame:
    """The document's lines (column ``value``) in one partition.

    A document is one file, so one task writes it. The records are turned to text by many tasks;
    the one task passes them on as they come (an array's records have no order) and keeps those of
    later arrays in temporary files, so its memory doesn't grow with them. Absent values have no key.
    """
    records = None
    for k, (name, df) in enumerate(arrays.items()):
        part = df.select(F.lit(k).alias("k"), F.concat(F.lit(","), F.to_json(F.struct(*df.columns))).alias("value"))
        records = part if records is None else records.unionByName(part)
    names = list(arrays)

    def lines(values):
        return pa.RecordBatch.from_arrays([pa.array(values, type=pa.string())], ["value"])

    def document(stream):
        begun = set()

        def part(batch, k):
            values = batch.filter(pc.equal(batch.column("k"), k)).column("value")
            if len(values) and k not in begun:  # the first record follows no comma
                begun.add(k)
                values = pa.array([values[0].as_py()[1:], *values[1:].to_pylist()], type=pa.string())
            return lines(values)

        with contextlib.ExitStack() as stack:
            kept = [stack.enter_context(tempfile.TemporaryFile()) for _ in names[1:]]
            writers = [pa.ipc.new_stream(f, lines([]).schema) for f in kept]
            yield lines([f'{{ "{names[0]}": ['])
            for batch in stream:
                yield part(batch, 0)
                for k, writer in enumerate(writers, 1):
                    writer.write_batch(part(batch, k))
            for name, file, writer in zip(names[1:], kept, writers):
                writer.close()
                file.seek(0)
                yield lines([f'], "{name}": ['])
                yield from pa.ipc.open_stream(file)
            yield lines(["]}"])

    return records.repartition(1).mapInArrow(document, "value string")


def land_by_season(df: DataFrame, root: str, season: Column, folder: str,
                   drop: Sequence[str] = ()) -> list[str]:
    """``<root>/data/<season>/<folder>/part-*.csv`` for every distinct season value.

    The distinct season values (a handful) are read on the driver to name the folders.
    """
    seasons = sorted(r[0] for r in df.select(season.alias("_s")).distinct().collect())
    out = []
    for s in seasons:
        path = f"{root}/data/{s}/{folder}"
        land_csv(df.where(season == F.lit(s)).drop(*drop), path)
        out.append(path)
    return out


def fresh(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
