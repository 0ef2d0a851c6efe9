"""Importance resampling towards a target distribution, by hashed word windows.

An untrained ``Split`` of the tokenizers library over the ASCII-lowered text returns words with
their offsets; windows of 1 to ``max_n`` neighbouring offset pairs are the features, and each falls
in the bucket of its CRC. A bucket's gain compares how often the target and the documents use it
(one added to each count), a document's weight is the sum of its gains, and a seeded Gumbel number
on top of the weight makes the highest scores a draw without replacement.

How it runs: texts are read once and become arrays of bucket numbers in a scratch table; the
histogram and the weights read those. Tasks add up their own histogram, so a shuffle holds at most
one row for each task and bucket; the histograms and gains have ``buckets`` entries whatever the
data's size. The draw ranks only rows of the score ranges that can hold a drawn one.

Defined results: a null or wordless text has no features and weight 0, and takes no part in the draw
unless ``least_words`` is 0; a null doc_id is written as nothing in the seed's text and sorts last
among equal scores; repeated rows are rows of their own (equal doc_ids share their random number);
extra columns are not read; an empty table gives an empty result, an empty target gains for t = 0.
Texts of any length are taken whole. A white-space separated unit is split once a task, as no word
crosses white space; a text's words are those of its units, shifted.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statmart.llm.common import batches, groups_of, map_batches, partitions, range_buckets, text_bytes
from statmart.session import materialize

#: A word: digits, a-z and everything beyond ASCII (the text has been lowered before).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_N, BUCKETS, SEED, LEAST_WORDS, SHARE = 1, 10_000, 2024, 20, (10, 100)

#: A task's tables of units and words are emptied beyond this many bytes of text or entries.
HELD_BYTES, HELD_UNITS = 32 << 20, 300_000


def splitter():
    """``split(text) -> [(word, (first, end))]`` by the tokenizers library; offsets in characters."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True).pre_tokenize_str


class Windows:
    """Bucket numbers of the word windows of texts."""

    def __init__(self, max_n: int = MAX_N, buckets: int = BUCKETS):
        self.max_n, self.buckets, self.split = max_n, buckets, splitter()
        self._clear()

    def _clear(self):
        self.units: dict[bytes, list[int]] = {}  # unit -> numbers of its words
        self.numbers: dict[bytes, int] = {}      # word -> number
        self.words: list[bytes] = []
        self.crcs = np.zeros(0, dtype=np.uint32)
        self.held = 0

    def _words_of(self, unit: bytes) -> list[int]:
        text, out = unit.decode(), []
        for _, (first, end) in self.split(text):
            word = text[first:end].encode()
            number = self.numbers.get(word)
            if number is None:
                number = self.numbers[word] = len(self.words)
                self.words.append(word)
                self.held += len(word)
            out.append(number)
        self.units[unit] = out
        self.held += len(unit)
        return out

    def of(self, raws: list[bytes]) -> list[tuple[int, np.ndarray]]:
        """(number of words, buckets of all windows: shorter windows first) of each text."""
        if self.held > HELD_BYTES or len(self.units) > HELD_UNITS:
            self._clear()
        texts = []
        for raw in raws:  # bytes.lower() lowers A-Z only
            numbers: list[int] = []
            for unit in raw.lower().split():
                known = self.units.get(unit)
                numbers += self._words_of(unit) if known is None else known
            texts.append(np.array(numbers, dtype=np.int64))
        fresh = [zlib.crc32(w) for w in self.words[len(self.crcs):]]
        self.crcs = np.concatenate([self.crcs, np.array(fresh, dtype=np.uint32)])
        return [(len(numbers), np.concatenate([self._buckets(numbers, n) for n in range(1, self.max_n + 1)])) for numbers in texts]

    def _buckets(self, numbers: np.ndarray, n: int) -> np.ndarray:
        if n == 1 or len(numbers) < n:
            return self.crcs[numbers] % self.buckets if n == 1 else np.zeros(0, dtype=np.uint32)
        windows = np.lib.stride_tricks.sliding_window_view(numbers, n)
        distinct, places = np.unique(windows, axis=0, return_inverse=True)
        crcs = [zlib.crc32(b" ".join(self.words[k] for k in row)) % self.buckets for row in distinct.tolist()]
        return np.array(crcs, dtype=np.uint32)[places.reshape(-1)]


def hashed_features(texts: DataFrame, keys: list[str], max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """``keys`` and, for each row of ``texts``, n_words, n_features and the windows' buckets as bytes."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def work():
        windows = Windows(max_n, buckets)

        def run(batch):
            raws, counts, sizes, held = text_bytes(batch), [], [], []
            for first, last in groups_of(raws):
                for n_words, found in windows.of(raws[first:last]):
                    counts.append(n_words)
                    sizes.append(len(found))
                    held.append(found.astype(width).tobytes())
            columns = [batch.column(k) for k in keys] + [pa.array(counts, type=pa.int64()), pa.array(sizes, type=pa.int64()), pa.array(held, type=pa.binary())]
            return pa.RecordBatch.from_arrays(columns, [*keys, "n_words", "n_features", "features"])

        return run

    rows = texts.select(*keys, "text")
    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return batches(rows, work, own + "n_words long, n_features long, features binary")


def histogram(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Number of features in each bucket over all rows: one array of ``buckets`` counts."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(stream):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in stream:
            for value in batch.column("features"):
                total += np.bincount(np.frombuffer(value.as_buffer(), dtype=width), minlength=buckets)
        full = np.flatnonzero(total)
        if len(full):
            yield pa.RecordBatch.from_arrays([pa.array(full, type=pa.int64()), pa.array(total[full], type=pa.int64())], ["bucket", "n"])

    parts = map_batches(features.select("features"), count, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():  # at most ``buckets`` rows
        out[row.bucket] = row.n
    return out


def gains_of(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths of a natural logarithm, rounded down."""
    k, t_all, s_all = len(raw), int(target.sum()), int(raw.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k))))
                     for t, s in zip(target.tolist(), raw.tolist())], dtype=np.int64)


def gumbel(doc_id, seed: int = SEED) -> int:
    """The seeded random part of a document's score, in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(features: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of rows of ``hashed_features``."""
    width = "<u2" if len(gains) <= 1 << 16 else "<u4"

    def work():
        def run(batch):
            keys = batch.column("doc_id").to_pylist()
            weights = [int(gains[np.frombuffer(v.as_buffer(), dtype=width)].sum()) for v in batch.column("features")]
            scores = [w + gumbel(k, seed) for w, k in zip(weights, keys)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), batch.column("n_features"),
                                               pa.array(weights, type=pa.int64()), pa.array(scores, type=pa.int64())],
                                              ["doc_id", "n_words", "n_features", "weight", "score"])

        return run

    return batches(features, work, "doc_id long, n_words long, n_features long, weight long, score long")


def drawn(scored: DataFrame, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank`` (1, 2, 3, ...) for the drawn rows, null for the others. Reads its
    input more than once: give a written table.

    Scores are cut into ranges of about equal row counts; the ranges' row counts, one row each, say
    where a range's ranks begin, and a window then numbers the rows within the ranges that begin
    below the limit."""
    spark = scored.sparkSession
    able = F.col("n_words") >= least_words
    limit = share[0] * scored.where(able).count() // share[1]
    ranged = range_buckets(scored.withColumn("__key", -F.col("score")), "__key", partitions(spark), "__range").drop("__key")
    sizes = ranged.where(able).groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    placed = ranged.join(F.broadcast(starts), "__range", "left")  # as many rows as shuffle partitions
    near = F.coalesce(able & (F.col("__start") < limit), F.lit(False))
    order = Window.partitionBy("__range").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "weight", "n_features")
    place = F.col("__start") + F.row_number().over(order)
    ranked = placed.where(near).withColumn("__place", place).withColumn("rank", F.when(F.col("__place") <= limit, F.col("__place")))
    rest = placed.where(~near).withColumn("rank", F.lit(None).cast("long"))
    return ranked.drop("__range", "__start", "__place").unionByName(rest.drop("__range", "__start"))


def resample(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED,
             share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of ``docs`` (doc_id, text):
    the share of the rows with ``least_words`` words that resemble ``target`` (text) is ranked."""
    own = materialize(hashed_features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], max_n, buckets), "importance-features")
    gains = gains_of(histogram(hashed_features(target, [], max_n, buckets), buckets), histogram(own, buckets))
    return drawn(materialize(weighted(own, gains, seed), "importance-scores"), share, least_words)
