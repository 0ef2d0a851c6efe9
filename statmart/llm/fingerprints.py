"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the least hash among its s-mers stands at its first
or last place. That depends on the k-mer alone (not on its neighbours), so an edit only disturbs
anchors it touches. A fingerprint keeps the syncmers with hashes up to KEPT (an eighth of all, so their number
grows with the text), and the ANCHORS of least hash where these are fewer, with their first positions.
Two fingerprints are compared by their anchors: those of equal hash whose positions keep one
common order (the longest increasing chain) count as matched; likeness is their share among the
hashes of the union up to where both are complete, between 0 and 1.

Defined results: empty text (or null): empty fingerprint, likeness 1 to another empty one and 0
to any other; a text without a syncmer has the hash of the whole text as only anchor. Equal
texts have equal fingerprints. Rows with one doc_id follow each other by text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.llm.common import map_batches, partitions, range_buckets

K, S, ANCHORS = 12, 4, 64
KEPT = (1 << 32) // 8 - 1
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each window of ``size`` code points."""
    out = np.zeros(len(codes) - size + 1, dtype=np.uint64)
    for j in range(size):
        out = out * _A + codes[j:len(codes) - size + 1 + j]
    out *= _B
    return out ^ (out >> np.uint64(29))


def closed_syncmers(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes, positions) of a text's closed syncmers, in text order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(codes) < k:
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    inner = _rolled(codes, s)
    window = k - s + 1
    least, width = inner, 1
    while width < window:  # least of each window by doubling
        step = min(width, window - width)
        least = np.minimum(least[:len(least) - step], least[step:])
        width += step
    places = np.flatnonzero((least == inner[:len(least)]) | (least == inner[window - 1:]))
    hashed = np.zeros(len(places), dtype=np.uint64)
    for j in range(k):
        hashed = hashed * _A + codes[places + j]
    hashed *= _B
    return (hashed >> np.uint64(32)).astype(np.uint32), places


def fingerprint(text: str, anchors: int = ANCHORS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes ascending, positions) of the kept anchors; each hash at its first position."""
    if not text:
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    hashes, places = closed_syncmers(text)
    if not len(hashes):
        return np.array([xxhash.xxh32_intdigest(text.encode())], dtype=np.uint32), np.zeros(1, dtype=np.int64)
    if len(hashes) > 4 * anchors:  # only the least hashes can be kept
        bound = np.partition(hashes, 4 * anchors - 1)[4 * anchors - 1]
        low = hashes <= max(bound, np.uint32(KEPT))
        if len(np.unique(hashes[low])) >= anchors:
            hashes, places = hashes[low], places[low]
    hashes, first = np.unique(hashes, return_index=True)
    kept = max(anchors, int(np.searchsorted(hashes, np.uint32(KEPT), side="right")))
    return hashes[:kept], places[first[:kept]]


def as_string(mark: tuple[np.ndarray, np.ndarray]) -> str:
    """Eight hex digits of hash and eight of position for each anchor, by hash."""
    return np.stack([mark[0].astype(">u4"), mark[1].astype(">u4")], axis=1).tobytes().hex()


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], anchors: int = ANCHORS) -> float:
    """Share of matched anchors among the hashes of both up to where both keep all, 0 to 1."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    bound = min(max(int(x[0][-1]), KEPT) if len(x[0]) >= anchors else (1 << 32) - 1 for x in (a, b))
    union = np.union1d(a[0], b[0])
    union = union[union <= bound]
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    within = common <= bound
    i, j = i[within], j[within]
    chain: list[int] = []
    for place in b[1][j][np.lexsort((b[1][j], a[1][i]))].tolist():
        at = bisect_left(chain, place)
        chain[at:at + 1] = [place]
    return len(chain) / len(union)


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    of every row of ``docs`` (doc_id, text).

    The edited text has its last third of code points replaced by as many (or all) of the first
    of the next document in descending doc_id order; after the last comes the first. The order is
    cut into ranges, each sorted in one task; a range's first documents are copied to the range
    before, so that only texts move, once, and nothing else meets in one place.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))
    texts = docs.select(key.alias("order_id"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    cut = range_buckets(texts, "order_id", 2 * partitions(spark), "bucket")
    # one row for each range
    heads = cut.groupBy("bucket").agg(F.max("order_id").alias("head")).orderBy(F.desc("bucket")).collect()
    if not heads:
        heads = [(0, 0)]
    # the head of each range follows the last document of the range before it, the first after the last
    goes_to = {heads[i][1]: heads[i - 1][0] for i in range(len(heads))}
    target = F.element_at(F.create_map(*[F.lit(x) for pair in goes_to.items() for x in pair]), F.col("order_id"))
    copies = cut.where(F.col("order_id").isin(*goes_to)).withColumn("bucket", target)
    rows = (cut.withColumn("copy", F.lit(0)).unionByName(copies.withColumn("copy", F.lit(1)))
            .repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "copy", F.desc("order_id"), "text"))

    def run(stream):
        held = None  # the document that waits for its next one: (doc_id, text, mark, bucket)
        for batch in stream:
            out: list[tuple] = []
            for doc_id, text, bucket, copy in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "copy"))):
                if held is not None and held[3] != bucket:
                    held = None
                if copy and held is None:
                    continue
                mark = fingerprint(text)
                if held is not None:
                    own = held[1]
                    cut_off = len(own) // 3
                    edited = own[:len(own) - cut_off] + text[:cut_off]
                    edited_mark = fingerprint(edited)
                    out.append((held[0], len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                as_string(held[2]), as_string(edited_mark), likeness(held[2], edited_mark), likeness(held[2], mark)))
                held = None if copy else (doc_id, text, mark, bucket)
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
                yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*out), kinds)], names)

    return map_batches(
        rows.select("doc_id", "text", "bucket", "copy"), run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
