"""Small helpers shared by the operators of this subpackage.

Conventions of every operator here: only the named input columns are read, so extra or clashing
columns do no harm; a null text counts as empty; repeated rows are kept as repeated rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Regular expression of the white space that separates words: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Entries a per-task memo may hold before it is emptied (bounds the Python workers' memory).
MEMO_ENTRIES = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null or blank text: empty array)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_CLASS + "+"))


def word_count(text: Column) -> Column:
    """Number of words of a text (0 for null), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each text in an Arrow batch (null: empty)."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def ragged(values: np.ndarray, lengths: np.ndarray, value_type: pa.DataType) -> pa.ListArray:
    """List array from concatenated values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=value_type))


#: Bytes an Arrow batch of texts may hold (Spark's default of 64 MB a batch, times the copies that
#: strings and results make, is too much for two workers beside an executor of 3 GB).
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` over batches of BATCH_BYTES, whatever the length of the texts. The bound is a
    session setting, which is lowered here and never raised."""
    spark = df.sparkSession
    held = re.fullmatch(r"(\d+)b?", spark.conf.get(_BATCH_SETTING))
    if held and int(held[1]) > BATCH_BYTES:  # a value written with a unit is the user's own
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` over non-empty batches: ``function()`` is called once per task and gives
    the function that turns one input batch into one output batch (or None)."""

    def run(stream):
        work = function()
        for batch in stream:
            out = work(batch) if batch.num_rows else None
            if out is not None:
                yield out
        pa.default_memory_pool().release_unused()  # workers are used again by later stages

    return map_batches(df, run, schema)


class Memo(dict):
    """Word -> value, filled on first use; emptied when it has grown too large."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key):
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[key] = self.function(key)
        return value


class PieceTable:
    """Integer sequences of distinct units (words), encoded once per task and gathered per text.

    ``encode(units)`` returns (concatenated values, lengths, extra columns...) for a list of new units.
    The table is emptied before a call once it holds ``limit`` units.
    """

    def __init__(self, encode, limit: int = MEMO_ENTRIES):
        self.encode, self.limit = encode, limit
        self.reset()

    def reset(self):
        self.index = defaultdict(count().__next__)  # unit -> its number in order of first use
        self.flat = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)
        self.extra: list[np.ndarray] = []

    def codes(self, units: list) -> np.ndarray:
        """Number of each unit, encoding those not seen before."""
        if len(self.index) > self.limit:
            self.reset()
        known = len(self.index)
        codes = np.fromiter(map(self.index.__getitem__, units), dtype=np.int64, count=len(units))
        if len(self.index) > known:
            flat, lengths, *extra = self.encode(list(islice(self.index, known, None)))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.flat = np.concatenate([self.flat, flat])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.extra = [np.concatenate([a, b]) for a, b in zip(self.extra, extra)] if self.extra else list(extra)
        return codes

    def gather(self, codes: np.ndarray) -> np.ndarray:
        """The values of the units, concatenated in order."""
        lengths = self.lengths[codes]
        total = int(lengths.sum())
        ends = np.cumsum(lengths)
        places = np.arange(total, dtype=np.int64) + np.repeat(self.starts[codes] - (ends - lengths), lengths)
        return self.flat[places]


def sample_condition(rows: int, sample: int, *keys: str) -> Column:
    """True for about ``sample`` of ``rows`` rows (for all, if there are no more), by a hash of
    ``keys`` alone: the same rows in every run, found without moving any."""
    if rows <= sample:
        return F.lit(True)
    return F.pmod(F.xxhash64(*keys, F.lit(29)), F.lit(1 << 30)) < int(sample / rows * (1 << 30))


def bounded_sample(df: DataFrame, sample: int, *keys: str) -> DataFrame:
    """About ``sample`` rows of ``df`` at most, see ``sample_condition``."""
    return df.where(sample_condition(df.count(), sample, *keys))


def groups_of(raws: list[bytes], size: int = 1 << 20):
    """(first, last) slices of a batch's texts of about ``size`` bytes, so that long texts don't
    meet in memory as lists of words."""
    first, held = 0, 0
    for i, raw in enumerate(raws):
        held += len(raw)
        if held >= size:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(raws):
        yield first, len(raws)


def range_buckets(df: DataFrame, key: str, buckets: int, output: str) -> DataFrame:
    """``df`` with an int column ``output`` that cuts the order of a numeric key into ranges of
    about equal row counts (quantiles over all rows; null keys fall in the lowest range)."""
    from pyspark.ml.feature import Bucketizer

    asked = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(df.select(F.col(key).cast("double")).approxQuantile(key, asked, 0.25 / buckets))) if asked else []
    bounds = bounds or [0.0]  # an empty table, or a single range
    number, real = f"__{output}_key", f"__{output}_real"
    keyed = df.withColumn(number, F.coalesce(F.col(key).cast("double"), F.lit(-1.7e308)))
    cut = Bucketizer(splits=[-float("inf"), *bounds, float("inf")], inputCol=number, outputCol=real).transform(keyed)
    return cut.withColumn(output, F.col(real).cast("int")).drop(number, real)
