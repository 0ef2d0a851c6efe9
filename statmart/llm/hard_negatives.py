"""Hard negatives of anchor vectors by angular triangle filtering.

Every row's components become the integers ``floor(256 * x)``. The index stores, with each row's
integers and norm, its angles to a few reference directions. For an anchor a and a row x each
reference r gives ``|t(a,r) - t(x,r)| <= t(a,x) <= min(t(a,r) + t(x,r), 2 pi - t(a,r) - t(x,r))``; the
tightest of these, as cosines times both norms and widened by more than the rounding of the
arithmetic, bound the integer inner product. Only rows whose bounds reach what is asked for (the
positives found so far; the window of a positive) get the exact integer inner product.

How it runs: index rows are packed into blocks; blocks of anchors, a stated query set, are copied to
each group of row blocks, so that a task joins one block of anchors with one of rows: rows are
shuffled once, nothing goes through the driver, and a task's memory is bound by BLOCK_BYTES. Each
pair of blocks keeps the first few of each anchor, and a window over those gives the result.

The references are rows of a bounded sample (SAMPLE rows at most, by a hash of their ids); they
shape costs only.

Defined results: rows with a null id, label or vector, or a null, NaN or infinite component take no
part; vectors of another length than the anchor's aren't compared with it; a row with the anchor's own
id is never its positive; a repeated row counts as often as it comes, a repeated anchor once; empty
tables and anchors without positives give no rows; extra columns are not read. Inner products beyond
2 ** 53 are computed with Python's integers; beyond a long, its limit is the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statmart.llm.common import bounded_sample, map_batches, partitions
from statmart.session import materialize

EVERY, POSITIVES, NEGATIVES, WINDOW, SCALE = 100, 5, 10, (30, 90, 100), 256
REFERENCES, SAMPLE = 16, 2_000
#: Bytes of integers in a block of rows or anchors, and its largest number of rows.
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 8_192
#: Angles from an arc cosine are exact to about 2e-8 where it is steepest; this is a wide margin.
MARGIN = 1e-6
_EXACT = 2.0 ** 53
_LONG = 2 ** 63 - 1

INDEX = "vec_id long, label long, q array<double>, norm double, angles array<double>"
#: What a block of anchors holds besides the index, once their positives are known.
PLACED = ["anchor", "positive_id", "positive_score", "place"]
BLOCK = "block long, width int, n int, ids binary, labels binary, q binary, norms binary, angles binary"


def _split(column) -> tuple[np.ndarray, np.ndarray]:
    """(values as doubles with NaN for null, offsets) of an Arrow list column without null lists."""
    lists = column if not isinstance(column, pa.ChunkedArray) else column.combine_chunks()
    offsets = np.asarray(lists.offsets)
    values = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    return values[offsets[0]:offsets[-1]], offsets - offsets[0]


def angles_to(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of vectors to unit references, one row a vector (a zero vector: right angles)."""
    cosines = (vectors / np.where(norms > 0, norms, 1.0)[:, None]) @ references.T
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def reference_directions(sample: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Unit rows of ``sample``: each the one that brings most rows nearer to a direction taken, so
    that crowded places, where intervals get narrow, come first."""
    norms = np.sqrt((sample * sample).sum(axis=1))
    units = sample[norms > 0] / norms[norms > 0][:, None]
    cosines, taken = units @ units.T, []
    nearest = np.zeros(len(units))
    while len(taken) < min(count, len(units)):
        gain = np.maximum(cosines - nearest[:, None], 0).sum(axis=0)
        gain[taken] = -1.0
        taken.append(int(np.argmax(gain)))
        nearest = np.maximum(nearest, cosines[:, taken[-1]])
    return units[taken]


def angle_index(vectors: DataFrame, sample: int = SAMPLE, count: int = REFERENCES) -> DataFrame:
    """The index rows of ``vectors`` (vec_id, label, embedding): integers, norm, stored angles."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.where("vec_id is not null and label is not null and embedding is not null")
    held = bounded_sample(rows.select("vec_id", "embedding"), sample, "vec_id").limit(2 * sample).toLocalIterator()
    drawn = [np.floor(SCALE * np.array(r.embedding, dtype=np.float64)) for r in sorted(held, key=lambda r: r.vec_id)
             if all(x is not None and np.isfinite(x) for x in r.embedding)][:sample]
    width = max({len(x) for x in drawn}, key=lambda w: sum(len(x) == w for x in drawn), default=0)
    same = [x for x in drawn if len(x) == width]
    references = reference_directions(np.array(same).reshape(len(same), width), count)

    def index(stream):
        for batch in stream:
            values, offsets = _split(batch.column("embedding"))
            lengths = np.diff(offsets)
            fine = np.ones(len(lengths), dtype=bool)
            fine[np.repeat(np.arange(len(lengths)), lengths)[~np.isfinite(values)]] = False
            keys, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
            whole = np.floor(SCALE * np.where(np.isfinite(values), values, 0.0))
            for size in np.unique(lengths[fine]):
                at = np.flatnonzero(fine & (lengths == size))
                q = whole[offsets[at][:, None] + np.arange(size)]
                norms = np.sqrt((q * q).sum(axis=1))
                found = angles_to(q, norms, references) if size == references.shape[1] else np.zeros((len(at), 0))
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * x.shape[1], type=pa.int32()), pa.array(x.ravel())) for x in (q, found)]
                yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(labels[at]), lists[0], pa.array(norms), lists[1]],
                                                 [c.split()[0] for c in INDEX.split(", ")])

    return map_batches(rows, index, INDEX)


def blocks(rows: DataFrame, more: list[str] = ()) -> DataFrame:
    """Index rows packed into blocks of one vector length, in the order in which tasks read them."""
    fields = [c.split()[0] for c in BLOCK.split(", ")] + list(more)

    def pack(stream):
        from pyspark import TaskContext

        task, seq = TaskContext.get().partitionId(), 0
        for batch in stream:
            q, q_at = _split(batch.column("q"))
            t, t_at = _split(batch.column("angles"))
            rest = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "norm", *more)]
            lengths = np.diff(q_at)
            for size in np.unique(lengths):
                own = np.flatnonzero(lengths == size)
                step = int(max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, size)))))
                for first in range(0, len(own), step):
                    at = own[first:first + step]
                    ids, labels, norms, *extra = [x[at] for x in rest]
                    n_angles = int(t_at[at[0] + 1] - t_at[at[0]])
                    parts = [ids, labels, q[q_at[at][:, None] + np.arange(size)], norms, t[t_at[at][:, None] + np.arange(n_angles)], *extra]
                    row = [[(task << 32) + seq], [int(size)], [len(at)], *[[np.ascontiguousarray(x).tobytes()] for x in parts]]
                    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * len(parts)]
                    yield pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(row, kinds)], fields)
                    seq += 1

    return map_batches(rows, pack, BLOCK + "".join(f", {c} binary" for c in more))


class Block:
    """The arrays of one packed block."""

    def __init__(self, row: dict, prefix: str, more: list[str] = ()):
        get, n, size = lambda c: row[prefix + c], row[prefix + "n"], row[prefix + "width"]
        self.ids, self.labels = np.frombuffer(get("ids"), np.int64), np.frombuffer(get("labels"), np.int64)
        self.q, self.norms = np.frombuffer(get("q")).reshape(n, size), np.frombuffer(get("norms"))
        self.angles = np.frombuffer(get("angles")).reshape(n, -1)
        self.more = [np.frombuffer(get(c), np.int64) for c in more]


def score_bounds(anchor_angles: np.ndarray, anchor_norm: float, rows: Block) -> tuple[np.ndarray, np.ndarray]:
    """(lowest, highest) possible inner product of an anchor with each row of a block."""
    product = rows.norms * anchor_norm
    nearest, farthest = np.zeros(len(product)), np.full(len(product), np.pi)
    if rows.angles.shape[1] == len(anchor_angles) > 0:
        total = rows.angles + anchor_angles
        nearest = np.abs(rows.angles - anchor_angles).max(axis=1)
        farthest = np.minimum(total, 2 * np.pi - total).min(axis=1)
    slack = MARGIN * product + 1.0
    high = np.cos(np.maximum(nearest - MARGIN, 0.0)) * product + slack
    low = np.cos(np.minimum(farthest + MARGIN, np.pi)) * product - slack
    return low, high


def inner_products(anchor: np.ndarray, anchor_norm: float, rows: Block, at: np.ndarray) -> np.ndarray:
    """Exact inner products of an anchor with some rows: doubles that hold integers, or objects
    where Cauchy and Schwarz don't rule out sums beyond 2 ** 53 (in any order of summing)."""
    if not len(at) or anchor_norm * rows.norms[at].max() * 1.001 < _EXACT / 100:
        return rows.q[at] @ anchor
    whole = [int(x) for x in anchor]
    return np.array([sum(x * int(y) for x, y in zip(whole, row)) for row in rows.q[at].tolist()], dtype=object)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by score, higher first, ties by smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)
    return np.lexsort((ids, -scores))[:k]


def _clip(scores) -> list[int]:
    return [max(-_LONG - 1, min(_LONG, int(s))) for s in scores]


class Scorer:
    """Bounds and scores of one anchor against one block; exact scores only where asked for."""

    def __init__(self, anchors: Block, i: int, rows: Block):
        self.q, self.norm, self.rows = anchors.q[i], float(anchors.norms[i]), rows
        self.low, self.high = score_bounds(anchors.angles[i], self.norm, rows)

    def exact(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(wanted)
        return at, inner_products(self.q, self.norm, self.rows, at)


def nearest_of_label(scorer: Scorer, own_id: int, same: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the first ``k`` rows of a block among ``same``, other than the anchor:
    rows whose highest possible score is below the k-th best lowest one can't be among them."""
    able = same & (scorer.rows.ids != own_id)
    if able.sum() > k:
        able &= scorer.high >= np.partition(scorer.low[able], -k)[-k]
    at, scores = scorer.exact(able)
    best = _first(scores, scorer.rows.ids[at], k)
    return at[best], scores[best]


def first_in_window(scorer: Scorer, differ: np.ndarray, positive: int, window: tuple[int, int, int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the first ``k`` rows of a block among ``differ`` whose score lies in the
    window of ``positive``. Where k rows lie wholly within the window, rows that can't reach the
    k-th best lowest score of those are left out as well."""
    low, high, unit = window
    overlap = differ & (unit * scorer.high >= low * positive) & (unit * scorer.low <= high * positive)
    inside = overlap & (unit * scorer.low >= low * positive) & (unit * scorer.high <= high * positive)
    if inside.sum() > k:
        overlap &= scorer.high >= np.partition(scorer.low[inside], -k)[-k]
    at, scores = scorer.exact(overlap)
    fits = (unit * scores >= low * positive) & (unit * scores <= high * positive)
    at, scores = at[fits.astype(bool)], scores[fits.astype(bool)]
    best = _first(scores, scorer.rows.ids[at], k)
    return at[best], scores[best]


def _joined(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of anchors with every block of rows of its width: row blocks are dealt to groups,
    and anchor blocks, the small side, are copied to each group."""
    groups = partitions(rows.sparkSession)
    left = rows.select([F.col(c).alias("r_" + c) for c in rows.columns]).withColumn("group", F.pmod(F.xxhash64("r_block"), F.lit(groups)))
    right = anchors.select([F.col(c).alias("a_" + c) for c in anchors.columns])
    right = right.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    return left.join(right, "group").where("r_width = a_width").drop("group")


def _pairs(rows: DataFrame, anchors: DataFrame, more: list[str], find, schema: str) -> DataFrame:
    """Rows that ``find(anchor block, row block)`` gives for each pair of blocks."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(stream):
        for batch in stream:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                out = find(Block(row, "a_", more), Block(row, "r_"))
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in out], names)

    return map_batches(_joined(rows, anchors), run, schema)


def positives_of(rows: DataFrame, anchors: DataFrame, k: int = POSITIVES) -> DataFrame:
    """(anchor, positive_id, positive_score, place): the first ``k`` rows of each anchor's label."""

    def find(a: Block, r: Block):
        out = [[], [], []]
        for i in range(len(a.ids)):
            at, scores = nearest_of_label(Scorer(a, i, r), a.ids[i], r.labels == a.labels[i], k)
            out[0] += [int(a.more[0][i])] * len(at)
            out[1] += r.ids[at].tolist()
            out[2] += _clip(scores)
        return out

    found = _pairs(rows, anchors, ["anchor"], find, "anchor long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.col("positive_score").desc(), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).withColumn("place", F.col("place").cast("long"))


def negatives_of(rows: DataFrame, anchors: DataFrame, window: tuple[int, int, int] = WINDOW, k: int = NEGATIVES) -> DataFrame:
    """The first ``k`` rows of other labels in the window of each (anchor, positive)."""

    def find(a: Block, r: Block):
        out = [[], [], [], [], [], [], []]
        scorer, before = None, None
        for i in range(len(a.ids)):
            anchor, positive, score, place = (int(x[i]) for x in a.more)
            if anchor != before:  # the positives of an anchor are neighbours
                scorer, differ, before = Scorer(a, i, r), r.labels != a.labels[i], anchor
            at, scores = first_in_window(scorer, differ, score, window, k)
            for column, value in zip(out, (anchor, int(a.ids[i]), positive, score, place)):
                column += [value] * len(at)
            out[5] += r.ids[at].tolist()
            out[6] += _clip(scores)
        return out

    schema = "anchor long, anchor_id long, positive_id long, positive_score long, place long, negative_id long, negative_score long"
    found = _pairs(rows, anchors, PLACED, find, schema)
    order = Window.partitionBy("anchor", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int, int] = WINDOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors, the
    rows of ``vectors`` (vec_id, label, embedding) whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    index = materialize(angle_index(vectors), "angle-index")
    rows = materialize(blocks(index.repartition(partitions(spark), "vec_id")), "angle-blocks")
    own = F.xxhash64("vec_id", "label", "q")
    queries = index.where(F.col("vec_id") % every == 0).withColumn("anchor", own).dropDuplicates(["anchor"])
    near = materialize(positives_of(rows, blocks(queries, ["anchor"]), positives), "angle-positives")
    windows = queries.join(near, "anchor").repartition(partitions(spark), "anchor").sortWithinPartitions("anchor", "place")
    found = negatives_of(rows, blocks(windows, PLACED), window, negatives)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
